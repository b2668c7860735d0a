"""Near-duplicate texts by a chosen-path join on the Jaccard similarity of word shingles."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callflow.llm.embedding_links import whole_units
from callflow.llm.shared import Forest, importable, pair_units, shingles, small_slices, smallest_reachable
from callflow.session import written

SIMILARITY = 0.8
#: The least chance of a pair at the threshold to be found, were all its buckets large at every split.
RECALL = 0.99999
#: The share of what may be lost that the bound on agreeing coordinates takes; runs take the rest.
SKETCH_SHARE = 0.01
#: Coordinates of a signature; paths split on them.
COORDINATES = 64
#: A bucket of at most so many sets is compared in one task; larger ones are split on.
SMALL = 512
#: Coordinates that a bucket is split on.
CHILDREN = 2
#: A large bucket with at least this share of the bucket it was split from is one family: its
#: sets agree on most tokens, so splitting would not end. After ``DEPTH`` splits any large bucket is.
DENSE = 0.5
DEPTH = 5
#: Sets of a family that meet in one task; larger families are dealt out by blocks.
BLOCK_ROWS = 768

_RNG = np.random.default_rng(99)
_FACTORS = _RNG.integers(1, 1 << 62, COORDINATES, dtype=np.int64).astype(np.uint64) * 2 + 1
_ADDENDS = _RNG.integers(1, 1 << 62, COORDINATES, dtype=np.int64).astype(np.uint64)


def run_recall(agreeing: float) -> float:
    """The least chance that one run brings together a pair whose signatures agree on this share of coordinates.

    A run splits on one coordinate, on which the pair agrees with chance s, and its
    large buckets on two each, so the pair is lost below with chance q = (1 - s + s q)^2.
    """
    lost = 0.0
    for _ in range(DEPTH):
        lost = (1 - agreeing + agreeing * lost) ** CHILDREN
    return agreeing * (1 - lost)


def agreement(similarity: float) -> list[float]:
    """The chance that a pair at the threshold agrees on 0, 1, ... 64 coordinates."""
    return [
        math.comb(COORDINATES, k) * similarity**k * (1 - similarity) ** (COORDINATES - k) for k in range(COORDINATES + 1)
    ]


def sketch_bound(similarity: float, recall: float) -> int:
    """Agreeing coordinates below which sets are not compared: few pairs at the threshold, see ``SKETCH_SHARE``."""
    lost, bound = 0.0, 0
    for chance in agreement(similarity):
        lost += chance
        if lost > (1 - recall) * SKETCH_SHARE:
            break
        bound += 1
    return bound


def runs_for(similarity: float, recall: float) -> int:
    """Runs by which pairs at the threshold lose at most the rest.

    All runs split by one signature, so their chances are those of the coordinates
    that a pair agrees on, averaged over how many these are.
    """
    bound = sketch_bound(similarity, recall)
    pairs = [(chance, 1 - run_recall(k / COORDINATES)) for k, chance in enumerate(agreement(similarity)) if k >= bound]
    runs = 1
    while sum(chance * lost**runs for chance, lost in pairs) > (1 - recall) * (1 - SKETCH_SHARE):
        runs += 1
    return runs


def signature(shingle_hashes: np.ndarray) -> np.ndarray:
    """The least of 64 hashes of the set, 32 bits each: a token per coordinate."""
    out = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingle_hashes), 8192):
        part = shingle_hashes[at : at + 8192]
        mixed = (np.multiply.outer(_FACTORS, part) + _ADDENDS[:, None]) >> np.uint64(32)
        np.minimum(out, mixed.min(axis=1).astype(np.uint32), out=out)
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_slices(batches, "bytes"):
        names, signs = [], []
        for value in batch["bytes"]:
            own = shingles(value.as_buffer().to_pybytes() if value.is_valid else b"")
            names.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            signs.append(signature(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["hash"], pa.array(names, pa.binary()), pa.array(signs, pa.binary())],
            names=["doc_id", "hash", "set", "sign"],
        )


def _mix(*values) -> np.ndarray:
    """A 64-bit hash of columns, as signed integers."""
    total = np.uint64(0x243F6A8885A308D3)
    for v in values:
        total = (total ^ np.asarray(v).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        total = total ^ (total >> np.uint64(29))
    return total.view(np.int64)


def _split(children: int, root: bool = False):
    """Each set of a bucket to the children it chose: (path, sampled coordinate, token there).

    Coordinates are sampled by a hash of the path, so all sets of a bucket choose alike.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            path = batch["path"].to_numpy()
            sign = np.frombuffer(b"".join(batch["sign"].to_pylist()), "<u4").reshape(-1, COORDINATES)
            # Runs, numbered from 1, begin with coordinates of their own.
            chosen = (path if root else _mix(path, np.full(len(path), 17))).view(np.uint64) % np.uint64(COORDINATES)
            for child in range(children):
                # Distinct coordinates: an odd step visits all of them.
                at = ((chosen + np.uint64(child * 23)) % np.uint64(COORDINATES)).astype(np.int64)
                token = sign[np.arange(len(path)), at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_mix(path, at, token)), batch["set"], batch["sign"], batch["size"]],
                    names=["path", "set", "sign", "above"],
                )

    return split


def _similar(bound: int):
    """Edges of a forest that spans the sets of a small bucket whose signatures agree on ``bound`` coordinates."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in whole_units(batches, ["path"]):
            names = unit["set"]
            if len(names) < 2:
                continue
            signs = np.frombuffer(b"".join(unit["sign"]), "<u4").reshape(-1, COORDINATES)
            forest = Forest(len(names))
            for k in range(len(names) - 1):
                for other in np.flatnonzero((signs[k + 1 :] == signs[k]).sum(axis=1) >= bound).tolist():
                    forest.join(k, k + 1 + other)
            edges = [(names[k], names[r]) for k in range(len(names)) if (r := forest.find(k)) != k]
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return similar


def candidate_families(sets: DataFrame, similarity: float, recall: float) -> DataFrame:
    """``(node, root)``: sets that a run put together and whose signatures agree, as components.

    ``sets(set, sign)`` holds distinct sets. Buckets are counted, with partial sums,
    before any of their rows move; small ones are compared within a task, large ones
    split on. A large bucket that a split hardly shrinks, or that is left after the last, is one
    family without comparison; the exact step settles which of its sets link.
    """
    names = "path long, set binary, sign binary, above long"
    roots = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs_for(similarity, recall)).cast("long")))
    started = sets.select(roots.alias("path"), "set", "sign", F.lit(sets.count()).cast("long").alias("size"))
    rows = written(started.mapInArrow(_split(1, root=True), names), "paths")
    edges, similar = [], _similar(sketch_bound(similarity, recall))
    for depth in range(DEPTH + 1):
        # Written, as adaptive execution splits a hot bucket beside a table only.
        sizes = written(rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        sized = written(rows.join(sizes.hint("merge"), "path"), "sized")  # alike at every size
        small = sized.where(F.col("size") <= SMALL).select("path", "set", "sign")
        found = small.repartition("path").sortWithinPartitions("path", "set").mapInArrow(similar, "a binary, b binary")
        edges.append(written(found.distinct(), "similar"))
        dense = F.col("size") >= DENSE * F.col("above") if depth else F.lit(False)
        large = sized.where(F.col("size") > SMALL).withColumn("dense", dense | F.lit(depth == DEPTH))
        family = large.where("dense").select("path", "set")
        first = written(family.groupBy("path").agg(F.min("set").alias("b")), "first")
        edges.append(written(family.join(first, "path").select(F.col("set").alias("a"), "b").distinct(), "families"))
        large = large.where("NOT dense").select("path", "set", "sign", "size")
        if large.isEmpty():
            break
        rows = written(large.mapInArrow(_split(CHILDREN), names), "paths")
    union = edges[0]
    for more in edges[1:]:
        union = union.unionByName(more)
    return smallest_reachable(union)


def _exact_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_slices(batches, "bytes"):
        own = [shingles(v.as_buffer().to_pybytes()).astype("<u8").tobytes() for v in batch["bytes"]]
        yield pa.RecordBatch.from_arrays(
            [batch["root"], batch["set"], batch["copies"], pa.array(own, pa.binary())],
            names=["root", "set", "copies", "shingles"],
        )


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, through the shingles that both sides hold, in blocks of columns."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out
    joined = np.concatenate(left)
    shared = np.intersect1d(np.unique(joined), np.unique(np.concatenate(right)))
    places = []
    for side in (left, right):
        rows = np.repeat(np.arange(len(side)), [len(s) for s in side])
        flat = np.concatenate(side)
        column = np.searchsorted(shared, flat)
        column[column == len(shared)] = 0
        held = shared[column] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(column[held], kind="stable")
        places.append((rows[held][order], column[held][order]))
    for at in range(0, len(shared), 4096):
        sides = []
        for (rows, column), side in zip(places, (left, right), strict=True):
            start, end = np.searchsorted(column, [at, at + 4096])
            dense = np.zeros((len(side), min(4096, len(shared) - at)), np.float32)
            dense[rows[start:end], column[start:end] - at] = 1
            sides.append(dense)
        # Columns that only one set of a side holds meet few pairs: those rows alone are multiplied.
        a, b = (np.flatnonzero(s.any(axis=1)) for s in sides)
        out[np.ix_(a, b)] += sides[0][a] @ sides[1][b].T
    return out


def _links(similarity: float):
    def links(unit) -> tuple[list, list, list]:
        names, copies, block = unit["set"], unit["copies"], unit["block"]
        own = [np.frombuffer(s, "<u8") for s in unit["shingles"]]
        size = np.array([len(s) for s in own], np.float64)
        inside = unit["first"][0] == unit["second"][0]
        left = np.flatnonzero(block == unit["first"][0])
        right = left if inside else np.flatnonzero(block == unit["second"][0])
        common = intersections([own[k] for k in left], [own[k] for k in right]).astype(np.float64)
        total = size[left][:, None] + size[right][None, :] - common
        x, y = np.nonzero(common >= similarity * total - 1e-9)
        x, y = left[x], right[y]
        if inside:
            x, y = x[x < y], y[x < y]
        degree = np.bincount(x, copies[y], len(names)) + np.bincount(y, copies[x], len(names))
        forest = Forest(len(names))
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            forest.join(a, b)
        touched = np.flatnonzero(degree)
        return (
            [names[k] for k in touched],
            degree[touched].astype(np.int64).tolist(),
            [names[forest.find(k)] for k in touched.tolist()],
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in whole_units(batches, ["root_key", "first", "second"]):
            if len(unit["first"]) > 1:
                found = links(unit)
                if found[0]:
                    kinds = (pa.binary(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names=["set", "links", "to"]
                    )

    return meet


def near_duplicates(
    documents: DataFrame, text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """doc_id, hash, class_id, n_links, kept for every row of ``documents``.

    Sets of five-word shingles (words ``[^\\x20\\x09-\\x0D]+``, as they are) are compared.
    Equal sets are one class with a number of copies. Every set has a signature of 64
    tokens; a run splits the sets by the token at a sampled coordinate, large buckets
    again and again, and runs repeat until a pair at the threshold has met with
    chance ``recall``. Sets of small buckets with signatures alike form families;
    inside a family all sets are compared exactly, in units of two blocks at most. What
    leaves a unit is a row per set: links there, and an edge of a spanning forest.

    ``n_links`` counts the other rows at similarity 0.8 or more, ``class_id`` is the smallest
    doc_id reachable by links, itself included; of a class the row with that doc_id
    is ``kept`` (of equal doc_ids the one with the least hash of its text, then one of
    the equal rows). A text of one to four words has one shingle, all its words. A text
    without words, or null, links with nothing and is kept. Rows without
    doc_id take part; they are kept only if no row of their class has one. Other
    columns are not read; an empty table gives no rows. ``documents`` is read twice.
    """
    importable(documents.sparkSession)
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("hash"),
        F.col(text).cast("binary").alias("bytes"),
    )
    rows = written(docs.mapInArrow(_sets, "doc_id long, hash long, set binary, sign binary"), "sets")
    sets = written(
        rows.where("set IS NOT NULL")
        .groupBy("set")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.first("sign").alias("sign"),
            F.min(F.struct("doc_id", "hash")).alias("first"),
        ),
        "distinct_sets",
    )
    families = candidate_families(sets.select("set", "sign"), similarity, recall)
    members = sets.join(families.select(F.col("node").alias("set"), "root"), "set").select(
        "set", "root", "copies", F.col("first.doc_id").alias("_id"), F.col("first.hash").alias("_hash")
    )
    texts = docs.join(members, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")))
    exact = written(
        texts.select("root", "set", "copies", "bytes").mapInArrow(
            _exact_sets, "root binary, set binary, copies long, shingles binary"
        ).dropDuplicates(["set"]),
        "exact_sets",
    )
    units = pair_units(exact, ["root"], F.col("set"), BLOCK_ROWS).withColumn("root_key", F.xxhash64("root"))
    by = ["root_key", "first", "second"]
    found = written(
        units.drop("root").repartition(*by).sortWithinPartitions(*by, "set").mapInArrow(
            _links(similarity), "set binary, links long, to binary"
        ),
        "links",
    )
    degrees = found.groupBy("set").agg(F.sum("links").alias("links"))
    linked = smallest_reachable(found.select(F.col("set").alias("a"), F.col("to").alias("b")))
    named = written(
        sets.select("set", "copies", "first")
        .join(degrees, "set", "left")
        .join(linked.select(F.col("node").alias("set"), F.col("root").alias("to")), "set", "left")
        .select(
            "set",
            F.coalesce("to", "set").alias("class"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "named",
    )
    members = written(
        rows.select("doc_id", "hash", "set", F.monotonically_increasing_id().alias("_row"))
        .join(named, "set", "left")
        .select("doc_id", "hash", "class", "n_links", "_row"),
        "members",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "_row")
    firsts = written(members.where("class IS NOT NULL").groupBy("class").agg(F.min(order).alias("_first")), "firsts")
    return members.join(firsts, "class", "left").select(
        "doc_id",
        "hash",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("_first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("_first._row") == F.col("_row"), F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents without all but one of each class, with their own columns.

    Of rows equal in id and text one stays, whichever; without words, all do. Null, empty and very long texts,
    ties, an empty table and clashing names are as for ``near_duplicates``.
    """
    names = documents.columns
    plain = documents.toDF(*[f"c{k}" for k in range(len(names))])
    id_, text = (f"c{names.index(n)}" for n in ("doc_id", "text"))
    source = plain.select(F.col(id_).alias("doc_id"), F.col(text).alias("text"))
    kept = near_duplicates(source).where("kept")
    keys = [F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64("doc_id", "hash").alias("_hash")]
    kept = written(kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "kept")
    own = F.col(id_).cast("long")
    keyed = plain.withColumn("_id", F.coalesce(own, F.lit(0))).withColumn("_hash", F.xxhash64(own, F.xxhash64(F.col(text))))
    met = keyed.join(kept, ["_id", "_hash"])
    # A text with words is kept once; Spark lets one of equal rows out of each task, however many there are.
    same = Window.partitionBy("_id", "_hash").orderBy("_id")
    one = met.where("_rows = 1").withColumn("_number", F.row_number().over(same)).where("_number = 1")
    both = one.select(*plain.columns).unionByName(met.where("_rows > 1").select(*plain.columns))
    return both.toDF(*names)
