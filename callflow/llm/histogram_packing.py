"""Best-fit packing planned on the histogram of lengths; documents join the planned slots by rank."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callflow.llm.byte_units import byte_encoder
from callflow.llm.encoding import text_parts
from callflow.llm.shared import crc32, importable
from callflow.session import written

WINDOW = 2048
#: Ranks of a length that meet their slots under one join key.
RANKS = 1 << 12
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, at long"
RUNS = "length int, first long, ranks long, sequence long, per long, base long"


def plan_slots(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing of ``counts[length]`` pieces of each length, worked out on the counts.

    Sequences that are filled alike are one group, whose numbers are consecutive. A length
    goes to the groups with the least sufficient room first, and fills each sequence with as
    many pieces as fit before it goes on, as best fit does piece by piece; then to new sequences.

    Returns runs ``(length, first, ranks, sequence, per, base)``: the pieces of ``length``
    ranked from ``first`` on, ``ranks`` of them, stand ``per`` to a sequence from number
    ``sequence`` on, the first of each at ``base``. A length splits at most one group, so there
    are at most some ``4 * window`` groups, and a sequence holds fewer than ``sqrt(2 * window)``
    different lengths: the number of runs is bounded by the window alone, however many pieces.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, how many)
    runs, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= window:
            raise ValueError(f"a piece of {length} tokens in windows of {window}")

        def fill(room: int, sequence: int, many: int) -> None:
            """Up to ``many`` sequences with ``room`` take what is left."""
            nonlocal left, rank
            per = room // length
            whole = min(many, left // per)
            if whole:
                runs.append((length, rank, whole * per, sequence, per, window - room))
                rooms[room - per * length].append((sequence, whole))
                rank, left = rank + whole * per, left - whole * per
            if left and whole < many:
                runs.append((length, rank, left, sequence + whole, left, window - room))
                rooms[room - left * length].append((sequence + whole, 1))
                rank, left, whole = rank + left, 0, whole + 1
            if whole < many:
                rooms[room].append((sequence + whole, many - whole))

        for room in sorted(r for r in rooms if r >= length):
            groups = rooms.pop(room)
            while groups and left:
                fill(room, *groups.pop())
            if groups:
                rooms[room] += groups
            if not left:
                break
        if left:
            new = -(-left // (window // length))
            fill(window, sequences, new)
            sequences += new
    return runs


def _pieces(tokenizer: str, end_id: int, window: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_encoder(tokenizer), TaskContext.get().partitionId()
        last = np.array([end_id], "<u4").tobytes()
        seen = [0] * (window + 1)
        for batch in batches:
            texts, keys = batch["text"].to_pylist(), batch["doc_id"].to_pylist()
            for begin, stop in text_parts(texts):
                rows = []
                for key, ids in zip(keys[begin:stop], encoder.encode(texts[begin:stop]), strict=True):
                    ids = ids.tobytes() + last
                    n = len(ids) // 4
                    start, piece = 0, 0
                    while start < n:
                        end = start + ((n - start) % window or window)
                        some = ids[4 * start : 4 * end]
                        at = seen[end - start]
                        seen[end - start] += 1
                        rows.append((key, piece, start, end - start, crc32(some), part, at, some if with_ids else None))
                        start, piece = end, piece + 1
                columns = list(zip(*rows, strict=True))[: 8 if with_ids else 7]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "at", "ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names[: len(columns)]
                )

    return cut


def cut_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """The pieces of each document: itself, or whole windows after a shorter first piece.

    A null text is empty: one ``end_id``. ``part`` and ``at`` tell the task and the place among
    its pieces of the same length; they are unique together with the length, for repeated rows too.
    """
    importable(documents.sparkSession)
    schema = PIECES + (", ids binary" if with_ids else "")
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pieces(tokenizer, end_id, window, with_ids), schema
    )


def place_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``length`` (1 to ``window``), ``part`` and ``at``.

    Only the histogram, at most ``window`` rows, goes to the driver, and the plan, bounded by the
    window, comes back. A piece's rank within its length is ``at`` plus the pieces of that length in
    earlier parts; slots are joined by (length, rank / 4096), so a length that a third of all rows
    share is spread over as many keys as it has thousands of rows. ``pieces`` is read twice: pass a
    table. Columns other than part and at are kept; no pieces give no rows.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        counted.select("length", "part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "starts"
    )
    histogram = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(plan_slots(histogram, window), RUNS)
    last = F.col("first") + F.col("ranks") - 1
    slots = runs.select(
        F.col("length").alias("_length"),
        F.explode(F.sequence(F.floor(F.col("first") / RANKS), F.floor(last / RANKS))).alias("_key"),
        F.col("first").alias("_first"),
        last.alias("_last"),
        "sequence",
        "per",
        "base",
    )
    ranked = pieces.join(starts.drop("n"), ["length", "part"]).withColumn("_rank", F.col("at") + F.col("before"))
    ranked = ranked.withColumn("_rank_key", F.floor(F.col("_rank") / RANKS))
    met = (F.col("length") == F.col("_length")) & (F.col("_rank_key") == F.col("_key"))
    placed = ranked.join(slots, met & F.col("_rank").between(F.col("_first"), F.col("_last")))
    nth = F.col("_rank") - F.col("_first")
    return placed.select(
        *[c for c in pieces.columns if c not in ("part", "at")],
        (F.col("sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("base") + nth % F.col("per") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """The place of every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents longer than ``window`` with their ``end_id`` are cut into whole windows, the first
    piece being shorter; no other is cut. A null text is empty, a very long one is encoded in parts,
    ties and repeated rows (null ids too) each take slots of their own, an empty table gives no rows,
    and other columns of ``documents`` are not read.
    """
    placed = place_pieces(written(cut_documents(documents, tokenizer, end_id, window), "pieces"), window)
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


def _assemble(window: int, pad_id: int):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, used = None, None, 0

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([used], pa.int32()), pa.array([held.tolist()], pa.list_(pa.int32()))],
                names=["sequence_id", "n_tokens", "ids"],
            )

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("sequence_id", "offset", "ids"))
            for sequence, offset, ids in zip(*columns, strict=True):
                if sequence != now:
                    if now is not None:
                        yield done()
                    now, held, used = sequence, np.full(window, pad_id, np.int32), 0
                some = np.frombuffer(ids, "<u4")
                held[offset : offset + len(some)] = some
                used += len(some)
        if now is not None:
            yield done()

    return assemble


def sequences(documents: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The padded sequences themselves: sequence_id, n_tokens, ids (``window`` integers)."""
    pieces = written(cut_documents(documents, tokenizer, end_id, window, with_ids=True), "pieces")
    placed = place_pieces(pieces, window).select("sequence_id", "offset", "ids")
    return (
        placed.repartition("sequence_id")
        .sortWithinPartitions("sequence_id", "offset")
        .mapInArrow(_assemble(window, pad_id), "sequence_id long, n_tokens int, ids array<int>")
    )
