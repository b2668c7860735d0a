"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callflow.llm.shared import cells_for, importable, mix, pair_units, smallest_reachable
from callflow.session import written

#: The width of a projection's steps, in distances of the threshold.
STEPS = 8.0
RECALL = 0.9999
#: Members of a bucket or family that meet in one task; larger ones are dealt out by blocks.
BLOCK_ROWS = 1024
#: Signs of projections that stand for a vector in its buckets.
SIGNS = 128
#: Vectors that one task hashes, about.
HASHED_ROWS = 1 << 14


def collision(distance: float, width: float) -> float:
    """The chance that a Gaussian projection with steps of ``width`` keeps two points together."""
    r = width / distance
    tail = math.erfc(r / math.sqrt(2)) / 2
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def projections_for(rows: int) -> int:
    """Projections per table: they grow with the logarithm of the rows, as buckets must stay small."""
    return max(8, round(0.75 * math.log2(max(2, rows))))


def tables_for(cosine: float, projections: int, recall: float = RECALL) -> int:
    """Tables after which a pair just at the threshold has been met with chance ``recall``."""
    distance = math.sqrt(2 - 2 * cosine)
    one = collision(distance, STEPS * distance) ** projections
    return math.ceil(math.log(1 - recall) / math.log(1 - one))


class PStable:
    """``tables`` hashes of unit vectors: floor((projections + offset) / width), mixed to 32 bits."""

    def __init__(self, dimensions: int, cosine: float, projections: int, tables: int, seed: int = 5):
        rng = np.random.default_rng(seed + dimensions)
        self.shape, self.width = (tables, projections), STEPS * math.sqrt(2 - 2 * cosine)
        self.lines = rng.standard_normal((dimensions, tables * projections))
        self.offset = rng.uniform(0, self.width, tables * projections)
        self.factors = rng.integers(1, 1 << 62, self.shape, dtype=np.int64).astype(np.uint64) * 2 + 1

    def keys(self, units: np.ndarray) -> np.ndarray:
        steps = np.floor((units @ self.lines + self.offset) / self.width).astype(np.int64).astype(np.uint64)
        mixed = (steps.reshape(len(units), *self.shape) * self.factors).sum(axis=2, dtype=np.uint64)
        mixed ^= mixed >> np.uint64(31)
        return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _raw(values) -> np.ndarray | None:
    """The vector in double precision, or None for one that links with nothing."""
    if values is None or not len(values):
        return None
    x = np.array([math.nan if v is None else v for v in values], np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _shortest(x: np.ndarray) -> bytes:
    """The bytes of the vector, in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = x.astype("<f4")
    return single.tobytes() if (single == x).all() else x.astype("<f8").tobytes()


def _vector(data: bytes, size: int) -> np.ndarray:
    return _unit(np.frombuffer(data, "<f4" if len(data) == 4 * size else "<f8").astype(np.float64))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for values in batch["embedding"].to_pylist():
            x = _raw(values)
            if x is None:
                rows.append((None, None, None))
            else:
                key = hashlib.blake2b(_unit(x).astype("<f8").tobytes(), digest_size=16).digest()
                rows.append((key, len(x), _shortest(x)))
        keys, sizes, data = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())],
            names=["vec_id", "class", "size", "data"],
        )


def sketch_bound(cosine: float, loss: float = 1e-6) -> int:
    """The most signs of ``SIGNS`` in which a pair at the threshold differs, but with chance ``loss``."""
    p, total = math.acos(cosine) / math.pi, 0.0
    for k in range(SIGNS + 1):
        total += math.comb(SIGNS, k) * p**k * (1 - p) ** (SIGNS - k)
        if 1 - total <= loss:
            return k
    return SIGNS


class Hashes:
    """Buckets and signs of unit vectors of any size, the same in every task."""

    def __init__(self, cosine: float, projections: int, tables: int):
        self.given, self.of_size = (cosine, projections, tables), {}

    def __call__(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers, buckets (a column per table) and signs (two words) of some vectors at a time."""
        sizes, numbers, data = batch["size"].to_numpy(), batch["number"].to_numpy(), batch["data"].to_pylist()
        tables = self.given[2]
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            if size not in self.of_size:
                lines = np.random.default_rng(17 + size).standard_normal((size, SIGNS))
                self.of_size[size] = PStable(size, *self.given), lines
            table, lines = self.of_size[size]
            for part in np.array_split(rows, -(-len(rows) // 1000)):
                units = np.stack([_vector(data[k], size) for k in part])
                keys = table.keys(units).astype(np.int64).astype(np.uint64) << np.uint64(24)
                keys = mix(keys + np.arange(tables, dtype=np.uint64) + (np.uint64(size) << np.uint64(12)))
                yield numbers[part], keys.view(np.int64), np.packbits(units @ lines > 0, axis=1).view("<i8")


def _cells(hashes: Hashes, cells: int):
    """How many rows of a task fall in each of some cells of buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for _, keys, _ in hashes(batch):
                total += np.bincount(keys.reshape(-1) % cells, minlength=cells)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["cell", "n"])

    return count


def _buckets(hashes: Hashes):
    """A row per vector and table: bucket, number of the vector, and its signs."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, keys, signs in hashes(batch):
                tables = keys.shape[1]
                columns = [keys.reshape(-1), np.repeat(numbers, tables), *(np.repeat(signs[:, k], tables) for k in range(2))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "number", "s0", "s1"])

    return buckets


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least index that each of 0..n-1 reaches over the pairs."""
    label = np.arange(n)
    while len(u):
        least = np.minimum(label[u], label[v])
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]
        open_pairs = label[u] != label[v]
        u, v = u[open_pairs], v[open_pairs]
    while (label[label] != label).any():
        label = label[label]
    return label


#: Units of fewer rows are compared by lags, all together; others by a product of their signs.
SMALL_UNIT = 24


def _near(bound: int, by: list[str]):
    """Edges that span what is near by its signs inside each unit of a bucket."""

    def joined(signs: np.ndarray) -> np.ndarray:
        """The least row that each row of a unit reaches over near pairs."""
        x = np.unpackbits(signs.view(np.uint8).reshape(len(signs), -1), axis=1).astype(np.float32) * 2 - 1
        label = np.arange(len(x))
        for start in range(0, len(x), 512):
            u, v = np.nonzero(x[start : start + 512] @ x[start:].T >= SIGNS - 2 * bound)
            u, v = u + start, v + start
            apart = label[u] != label[v]
            label = components(len(x), np.r_[u[apart], label], np.r_[v[apart], np.arange(len(x))])
        return label

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for units in unit_groups(batches, by, 1 << 15):
            unit, signs = units["unit"], np.stack([units["s0"], units["s1"]], axis=1).view(np.uint64)
            sizes = np.bincount(unit)
            ends = np.cumsum(sizes)
            label = np.arange(len(unit))
            for k in np.flatnonzero(sizes >= SMALL_UNIT).tolist():
                start = int(ends[k] - sizes[k])
                label[start : ends[k]] = joined(signs[start : ends[k]]) + start
            at, pairs = np.flatnonzero(sizes[unit] < SMALL_UNIT), []
            for lag in range(1, SMALL_UNIT):
                at = at[: np.searchsorted(at, len(unit) - lag)]
                at = at[unit[at + lag] == unit[at]]
                close = at[np.bitwise_count(signs[at] ^ signs[at + lag]).sum(axis=1, dtype=np.int64) <= bound]
                pairs.append((close, close + lag))
            pairs.append((label, np.arange(len(unit))))
            label = components(len(unit), *map(np.concatenate, zip(*pairs, strict=True)))
            own = np.flatnonzero(label != np.arange(len(unit)))
            if len(own):
                number = units["number"]
                yield pa.RecordBatch.from_arrays([pa.array(number[own]), pa.array(number[label[own]])], names=["a", "b"])

    return near


def unit_groups(batches: Iterator[pa.RecordBatch], by: list[str], most: int) -> Iterator[dict[str, np.ndarray]]:
    """Columns of whole units (runs of rows that agree in ``by``) from sorted batches, with ``unit``
    telling them apart; several units together while they have up to ``most`` rows."""
    kept: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        for name in batch.schema.names:
            kept.setdefault(name, []).append(batch[name].to_numpy())
        if sum(map(len, kept[by[0]])) < most:
            continue
        whole = {name: np.concatenate(parts) for name, parts in kept.items()}
        cuts = _unit_cuts(whole, by)
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield {n: c[:last] for n, c in whole.items()} | {"unit": np.searchsorted(cuts, np.arange(last), "right")}
        kept = {name: [column[last:]] for name, column in whole.items()}
    if kept and sum(map(len, kept[by[0]])):
        whole = {name: np.concatenate(parts) for name, parts in kept.items()}
        cuts = _unit_cuts(whole, by)
        yield whole | {"unit": np.searchsorted(cuts, np.arange(len(whole[by[0]])), "right")}


def _unit_cuts(columns: dict[str, np.ndarray], by: list[str]) -> np.ndarray:
    """Where another unit begins."""
    other = np.zeros(max(0, len(columns[by[0]]) - 1), bool)
    for name in by:
        other |= columns[name][1:] != columns[name][:-1]
    return np.flatnonzero(other) + 1


def _meet(cosine: float):
    """Links inside the units of a family: per vector its links, and edges that span them."""

    def links(unit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        block, first, second = unit["block"], unit["first"][0], unit["second"][0]
        numbers, copies = unit["number"], unit["copies"]
        vectors = np.stack([_vector(d, int(unit["size"][0])) for d in unit["data"]])
        left = np.flatnonzero(block == first)
        right = left if first == second else np.flatnonzero(block == second)
        degree, label = np.zeros(len(numbers), np.int64), np.arange(len(numbers))
        for start in range(0, len(left), 256):
            part = left[start : start + 256]
            x, y = np.nonzero(vectors[part] @ vectors[right].T >= cosine)
            x, y = part[x], right[y]
            if first == second:
                x, y = x[x < y], y[x < y]
            degree += np.bincount(x, copies[y], len(numbers)).astype(np.int64)
            degree += np.bincount(y, copies[x], len(numbers)).astype(np.int64)
            apart = label[x] != label[y]
            label = components(len(numbers), np.r_[x[apart], label], np.r_[y[apart], np.arange(len(numbers))])
        touched = np.flatnonzero(degree)
        return numbers[touched], degree[touched], numbers[label[touched]]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in whole_units(batches, ["root", "first", "second"]):
            if len(unit["number"]) > 1:
                found = links(unit)
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["number", "links", "root"])

    return meet


def whole_units(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[dict]:
    """The columns of each run of rows that agree in ``by``, from sorted batches."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = np.zeros((batch.num_rows, len(by)), np.int64)
        for k, name in enumerate(by):
            codes[:, k] = batch[name].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((codes[1:] != codes[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(start, end - start)
            if kept and any(kept[-1][n][0].as_py() != part[n][0].as_py() for n in by):
                yield _columns(kept)
                kept = []
            kept.append(part)
    if kept:
        yield _columns(kept)


def _columns(parts: list[pa.RecordBatch]) -> dict:
    table = pa.Table.from_batches(parts)
    return {
        name: (
            table[name].to_pylist()
            if pa.types.is_binary(table.schema.field(name).type)
            else table[name].to_numpy()
        )
        for name in table.schema.names
    }


def link_vectors(vectors: DataFrame, cosine: float = 0.95, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors(vec_id, embedding)``.

    Rows whose unit vectors are equal bit for bit are one class with a number of copies. Classes are
    hashed into the buckets of several tables; as many tables as a pair at the threshold needs to
    meet with chance ``recall``. A bucket holds numbers of classes and 128 signs of projections, 40
    bytes in place of the vector: those of its members that differ in so few signs as a pair at
    the threshold does are joined, all tables' edges together make families, and only in families the
    vectors meet. There all pairs are compared exactly, in double precision, each in one unit of two
    blocks at most, so no task holds a large bucket or family, and a link inside a family is found
    whatever the tables missed. A vector that is null, empty, zero or holds null or non-finite
    components links with nothing. Vectors of different length never link. Rows with equal vec_id are
    rows of their own; one without vec_id takes part, and is kept if it is alone.
    Other columns are not read; an empty table gives no rows.
    """
    importable(vectors.sparkSession)
    plain = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = written(plain.mapInArrow(_classes, "vec_id long, class binary, size int, data binary"), "vectors")
    classes = written(
        rows.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("data").alias("data"))
        .withColumn("number", F.monotonically_increasing_id())
        .repartition(cells_for(rows.count(), HASHED_ROWS, 2), "number"),  # as many tasks hash them
        "classes",
    )
    count = classes.count()
    projections = projections_for(count)
    tables = tables_for(cosine, projections, recall)
    spread = classes.select("number", "size", "data")
    hashes = Hashes(cosine, projections, tables)
    # Cells with no more rows than a unit hold no large bucket; buckets of others are measured and dealt out.
    cells = cells_for(count * tables, BLOCK_ROWS // 4)
    counted = spread.mapInArrow(_cells(hashes, cells), "cell long, n long")
    full = written(counted.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > BLOCK_ROWS).select("cell"), "full")
    rows_of = spread.mapInArrow(_buckets(hashes), "bucket long, number long, s0 long, s1 long")
    cell, edge = F.pmod("bucket", F.lit(cells)), "a long, b long"
    near = _near(sketch_bound(cosine), ["bucket"])
    loose = rows_of.join(full, cell == F.col("cell"), "left_anti")
    edges = loose.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(near, edge)
    if not full.isEmpty():
        by = ["bucket", "first", "second"]
        dense = written(rows_of.join(full, cell == F.col("cell"), "left_semi"), "dense")
        units = pair_units(dense, ["bucket"], F.col("number"), BLOCK_ROWS).select(*by, "number", "s0", "s1")
        units = units.repartition(*by).sortWithinPartitions(*by)
        edges = edges.unionByName(units.mapInArrow(_near(sketch_bound(cosine), by), edge))
    edges = edges.distinct()
    families = smallest_reachable(edges)
    together = classes.join(families.withColumnRenamed("node", "number"), "number")
    together = written(together.select("root", "number", "copies", "size", "data"), "families")
    by = ["root", "first", "second"]
    units = pair_units(together, ["root"], F.col("number"), BLOCK_ROWS)
    found = written(
        units.repartition(*by).sortWithinPartitions(*by, "number").mapInArrow(
            _meet(cosine), "number long, links long, root long"
        ),
        "links",
    )
    degrees = found.groupBy("number").agg(F.sum("links").alias("links"))
    roots = smallest_reachable(found.select(F.col("number").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("class", "number", "copies")
        .join(degrees, "number", "left")
        .join(roots.select(F.col("node").alias("number"), "root"), "number", "left")
        .select(
            "class",
            F.coalesce("root", "number").alias("root"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    named = written(named, "named")
    members = rows.select("vec_id", "class").join(named, "class", "left")
    smallest = written(
        members.where("class IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("smallest")), "smallest"
    )
    component = F.coalesce("smallest", "vec_id")
    return members.join(smallest, "root", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.col("smallest").isNull()).alias("kept"),
    )


__all__ = ["PStable", "components", "link_vectors", "sketch_bound", "tables_for", "whole_units"]
