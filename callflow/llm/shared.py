"""What several operators share: stable keys, gapless numbers, hot groups, components."""

from __future__ import annotations

import contextlib
import os
import zlib
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callflow.session import written

#: Rows that one task numbers or sorts at once, about.
CELL_ROWS = 1 << 19
#: Bytes of text that Python takes at once, about.
SLICE_BYTES = 1 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough where workers see the driver's folders; elsewhere submit it with --py-files.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the folder, by Spark's reader alone."""
    importable(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def small_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about ``SLICE_BYTES`` of a text column, a row at least.

    Spark's batches have 10,000 rows, of which lists and results would be held whole. Arrow's free memory goes back
    after each batch: workers are kept for later tasks, and it would stay theirs beside all other memory.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        for start, end in runs(np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES):
            yield batch.slice(start, end - start)
        pa.default_memory_pool().release_unused()


def crc32(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def cells_for(rows: int, each: int, least: int = 1) -> int:
    return max(least, -(-rows // each))


def dense_positions(
    df: DataFrame, group: list[str], order: list[Column], spread: Column, cells: int, name: str
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large a group is.

    Rows are spread over ``cells`` by ``spread``; a window numbers them inside a
    (group, cell), and counts of the cells, which are few, are added up. ``df`` is
    read twice, so it must be a table or a checkpoint.
    """
    split = df.withColumn("_cell", F.pmod(spread, F.lit(cells)).cast("int"))
    counts = split.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("_cell").alias("_c"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*group, "_cell").orderBy(*order)
    numbered = split.withColumn("_n", F.row_number().over(inside) - 1)
    matches = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    joined = numbered.join(starts, reduce(Column.__and__, matches, F.col("_cell") == F.col("_c")))
    return joined.select(*df.columns, (F.col("_start") + F.col("_n")).cast("long").alias(name))


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest one it reaches.

    Every round sends each node to the smallest of its neighbours and itself, then
    links the nodes that are left; the number of nodes falls fast, and the smallest
    of a component never moves. Each round is written, so a lost executor costs one
    round. Nothing is collected but a count.
    """
    edges = written(
        edges.where("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    roots = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")).select(F.col("a").alias("node"), "to"),
            "step",
        )
        if roots is None:
            roots = step.select("node", F.col("to").alias("root"))
        else:
            moved = step.select(F.col("node").alias("_node"), "to")
            roots = written(
                roots.join(moved, F.col("root") == F.col("_node"), "left").select(
                    "node", F.coalesce("to", "root").alias("root")
                ),
                "roots",
            )
        left = step.select(F.col("node").alias("_n"), F.col("to").alias("_a"))
        right = step.select(F.col("node").alias("_m"), F.col("to").alias("_b"))
        edges = written(
            edges.join(left, F.col("a") == F.col("_n"))
            .join(right, F.col("b") == F.col("_m"))
            .where("_a != _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            .distinct(),
            "edges",
        )
        if edges.isEmpty():
            return roots


def pair_units(rows: DataFrame, group: list[str], member: Column, most: int) -> DataFrame:
    """Deal the members of each group to units of at most about two blocks of ``most``.

    A group of up to ``most`` members is one unit. A larger one is cut into blocks,
    and every pair of blocks is a unit, so all pairs of members meet, each in exactly
    one unit, and no task holds a large group. Adds ``block``, ``first``, ``second``
    (blocks of the unit; equal for pairs inside a block). ``rows`` is read twice. Sizes are written, as adaptive
    execution splits a hot group of rows only beside a table, not beside an aggregate.
    """
    sizes = written(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_size")).where("_size > 1"), "sizes")
    dealt = rows.join(sizes.hint("merge"), group).withColumn("_blocks", F.ceil(F.col("_size") / most).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(member, F.lit(7)), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        dealt.withColumn("_other", other)
        .withColumn("first", F.least("block", "_other").cast("int"))
        .withColumn("second", F.greatest("block", "_other").cast("int"))
        .drop("_size", "_blocks", "_other")
    )


def forget(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more; left alone where Arrow cannot reach them."""
    for table in tables:
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            with contextlib.suppress(pa.ArrowInvalid, OSError):
                system, path = fs.FileSystem.from_uri("s3" + folder[3:] if folder.startswith("s3a://") else folder)
                system.delete_dir(path)


class Forest:
    """Union-find over 0..n-1; the smaller index is the root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def runs(keys: np.ndarray):
    """``(start, end)`` of each run of equal neighbours."""
    if len(keys):
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        yield from zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(keys)].tolist(), strict=True)


# Hashes of byte strings by prefix sums: sum of table[byte] * BASE**position, modulo 2**64.
_RNG = np.random.default_rng(20240607)
BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64; kept per process."""
    if len(_POWERS.get(base, ())) < n:
        size = -(-n // (1 << 18)) << 18
        out = np.ones(size, np.uint64)
        out[1:] = np.uint64(base)
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(BASE, len(data)), out=out[1:])
    return out


def spans_hash(sums: np.ndarray, starts, ends) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, the same wherever the bytes stand."""
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes hashed at once; longer texts are hashed in parts cut between words.
PART = 1 << 20


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of some bytes."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _WORD[raw]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` in order."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PART)
        if end < len(data):
            while end < len(data) and _WORD[data[end]]:
                end += 1
        raw = np.frombuffer(data, np.uint8, end - at, at)
        out.append(spans_hash(prefix_sums(raw), *word_bounds(raw)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


_STEPS = np.array([pow(0xD6E8FEB86659FD93, j, 1 << 64) for j in range(64)], np.uint64)


def shingles(data: bytes, words: int = 5) -> np.ndarray:
    """The sorted distinct hashes of ``words`` words in a row.

    A text of fewer words, but one at least, has all its words as its one shingle.
    """
    hashed = word_hashes(data)
    if not len(hashed):
        return hashed
    width = min(words, len(hashed))
    n = len(hashed) - width + 1
    total = np.full(n, np.uint64(width))
    for j in range(width):
        total += hashed[j : j + n] * _STEPS[j]
    return np.unique(mix(total))
