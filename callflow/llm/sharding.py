"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callflow.llm.shared import CELL_ROWS, cells_for, dense_positions, importable
from callflow.session import written

#: A parcel holds at most this share of an even shard.
PARCELS = 64
#: Groups that one task packs into parcels, about.
CELL_GROUPS = 1 << 16


class RoomTree:
    """A balanced search tree (treap) over ``(room left, bin)``."""

    def __init__(self, seed: int = 1):
        self.root, self.rng = None, random.Random(seed)

    @staticmethod
    def _split(node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = RoomTree._split(node[3], key)
            return (node[0], node[1], node[2], low), high
        low, high = RoomTree._split(node[2], key)
        return low, (node[0], node[1], high, node[3])

    @staticmethod
    def _merge(low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return (low[0], low[1], low[2], RoomTree._merge(low[3], high))
        return (high[0], high[1], RoomTree._merge(low, high[2]), high[3])

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, (key, self.rng.random(), None, None)), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that is at least ``size``."""
        node, best = self.root, None
        while node:
            if node[0] >= (size, -1):
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best:
            low, rest = self._split(self.root, best)
            _, high = self._split(rest, (best[0], best[1] + 1))
            self.root = self._merge(low, high)
        return best


def best_fit(sizes, capacity: int) -> list[int]:
    """The bin of each size, in the given (decreasing) order.

    A size goes to the tightest bin with room for it, else to a new one; one over
    the capacity gets a bin of its own.
    """
    tree, bins, out = RoomTree(), 0, []
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            found = (max(capacity, size), bins)
            bins += 1
        out.append(found[1])
        tree.add((found[0] - size, found[1]))
    return out


def fewest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity, bisected to one in 65536, at which best fit needs at most ``shards`` bins."""
    low = max([1, *sizes, -(-sum(sizes) // shards)])
    high = 2 * low
    while high - low > low >> 16:
        mid = (low + high) // 2
        if max(best_fit(sizes, mid), default=0) < shards:
            high = mid
        else:
            low = mid + 1
    return high


def _pack_cells(capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, tree, bins = None, None, 0
        for batch in batches:
            parcels = []
            for c, size in zip(batch["cell"].to_pylist(), batch["bytes"].to_pylist(), strict=True):
                if c != cell:
                    cell, tree, bins = c, RoomTree(), 0
                found = tree.take_tightest(size)
                if found is None:
                    found, bins = (max(capacity, size), bins), bins + 1
                parcels.append(found[1])
                tree.add((found[0] - size, found[1]))
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["piece"], batch["cell"], pa.array(parcels, pa.int64()), batch["bytes"]],
                names=["key", "piece", "cell", "parcel", "bytes"],
            )

    return pack


def shard(df: DataFrame, group: str, size: str, shards: int, order: list[str]) -> DataFrame:
    """Deal rows to ``shards`` shards of near equal size, rows of a group together.

    The smallest groups of one hash cell are packed, largest first, into parcels of a
    256th of a shard at most; the parcels of all cells, some thousand, are packed into
    the shards at the least capacity that suffices. Both steps are best fit decreasing
    through a balanced tree. A group larger than an even shard cannot stay whole there:
    it is cut into pieces of rows of at most one parcel. Adds ``shard`` and ``slot`` (gapless from 0,
    by ``order``). ``group`` is a binary key (null is a group too), ``size`` a whole
    number from 1 on, the same for all rows of a group. Rows repeated in full each take a slot.
    An empty table gives no rows. ``df`` is read several times: pass a table.
    """
    importable(df.sparkSession)
    spark = df.sparkSession
    columns = df.columns
    rows = df.withColumn("_key", F.coalesce(F.col(group), F.lit(b"")))
    groups = written(
        rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.first(size).cast("long").alias("each")), "groups"
    )
    count, total, number = groups.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("n") * F.col("each")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    even = -(-int(total) // shards) if total else 1
    parcel = max(1, even // PARCELS)
    # Fewer than ``shards`` groups are larger than an even shard.
    large = groups.where(F.col("n") * F.col("each") > even).select(
        "_key", F.greatest(F.lit(1), F.floor(F.lit(parcel) / F.col("each"))).cast("long").alias("per_piece")
    )
    cut = rows.join(F.broadcast(large), "_key")
    spread_cells = cells_for(int(number), CELL_ROWS, 16)
    cut = dense_positions(
        written(cut, "cut"), ["_key"], [F.col(c) for c in order], F.xxhash64(*order), spread_cells, "_at"
    ).withColumn("_piece", F.floor(F.col("_at") / F.col("per_piece")).cast("long"))
    whole = rows.join(F.broadcast(large), "_key", "left_anti").withColumn("_piece", F.lit(0).cast("long"))
    placed = cut.select(*columns, "_key", "_piece").unionByName(whole.select(*columns, "_key", "_piece"))
    items = placed.groupBy(F.col("_key").alias("key"), F.col("_piece").alias("piece")).agg(
        F.sum(F.col(size).cast("long")).alias("bytes")
    )
    cells = cells_for(int(count), CELL_GROUPS)
    items = items.withColumn("cell", F.pmod(F.xxhash64("key", "piece"), F.lit(cells)).cast("int"))
    dealt = items.repartitionById(cells, "cell").sortWithinPartitions("cell", F.desc("bytes"), "key", "piece")
    packed = written(
        dealt.mapInArrow(_pack_cells(parcel), "key binary, piece long, cell int, parcel long, bytes long"), "parcels"
    )
    # At most 2 * 64 * shards parcels and one per cell.
    parcels = (
        packed.groupBy("cell", "parcel").agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("bytes"), "cell", "parcel")
    ).collect()
    sizes = [r.bytes for r in parcels]
    bins = best_fit(sizes, fewest_capacity(sizes, shards)) if sizes else []
    homes = spark.createDataFrame(
        [(r.cell, r.parcel, b) for r, b in zip(parcels, bins, strict=True)], "cell int, parcel long, shard int"
    )
    of_items = packed.join(F.broadcast(homes), ["cell", "parcel"]).select(
        F.col("key").alias("_key"), F.col("piece").alias("_piece"), "shard"
    )
    sharded = written(placed.join(of_items, ["_key", "_piece"]).select(*columns, "shard"), "sharded")
    return dense_positions(sharded, ["shard"], [F.col(c) for c in order], F.xxhash64(*order), spread_cells, "slot")


def shard_documents(documents: DataFrame, shards: int = 24) -> DataFrame:
    """Documents with their shard; equal texts are a group (null counts as the empty text).

    ``size`` is the UTF-8 bytes of the text plus 8. Returns doc_id, size, text_crc32,
    law (``bytes``), shard, slot, grown_shard (null: this law has none). Other columns
    of ``documents`` are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = written(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("_text"),
        ),
        "sizes",
    )
    out = shard(rows, "_text", "size", shards, ["doc_id", "text_crc32", "size"])
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write rows that ``shard`` has dealt, one folder per shard, each file in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
