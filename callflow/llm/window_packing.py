"""Documents packed into windows by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callflow.llm.encoding import text_encoder, text_parts
from callflow.llm.shared import cells_for, crc32, importable, small_slices
from callflow.session import written

WINDOW = 4096
#: Pieces that one task packs in its own windows, about.
CELL_PIECES = 1 << 14
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class SumOfSquares:
    """Online packing of pieces into windows of ``size`` tokens.

    ``levels[h]`` counts the partially filled windows that hold ``h`` tokens. A piece
    goes to the level, or to a new window, after which the sum of the squared counts
    is least; of equal ones the fullest.
    """

    def __init__(self, size: int = WINDOW):
        self.size = size
        self.levels = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[int]] = {}
        self.windows = 0

    def place(self, length: int) -> tuple[int, int]:
        """``(window, offset)`` of a piece of 1 to ``size`` tokens."""
        if length >= self.size:
            self.windows += 1
            return self.windows - 1, 0
        top = self.size - length
        cost = 2 * self.levels[length:] + 1  # of a window that comes to level h + length
        cost[-1] = 0  # a full window is counted no more
        cost[1:] -= 2 * self.levels[1 : top + 1] - 1
        cost[1:][self.levels[1 : top + 1] == 0] = np.iinfo(np.int64).max
        level = top - int(np.argmin(cost[::-1]))
        if level:
            self.levels[level] -= 1
            window = self.open[level].pop()
        else:
            window = self.windows
            self.windows += 1
        if level + length < self.size:
            self.levels[level + length] += 1
            self.open.setdefault(level + length, []).append(window)
        return window, level


def _pieces(tokenizer: str, end_id: int, window: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer)
        last = np.array([end_id], "<u4").tobytes()
        for batch in small_slices(batches, "text"):
            texts, keys = batch["text"].to_pylist(), batch["doc_id"].to_pylist()
            for begin, stop in text_parts(texts):
                rows = []
                for key, ids in zip(keys[begin:stop], encoder.encode(texts[begin:stop]), strict=True):
                    ids = ids.tobytes() + last
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        part = ids[4 * start : 4 * (start + window)]
                        rows.append((key, start, len(part) // 4, crc32(part), n, part if with_ids else None))
                columns = list(zip(*rows, strict=True))[: 6 if with_ids else 5]
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(columns)],
                )

    return cut


def cut_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """The pieces of each document: whole windows, and the rest. Null text is empty: one ``end_id``."""
    importable(documents.sparkSession)
    schema = PIECES + (", ids binary" if with_ids else "")
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pieces(tokenizer, end_id, window, with_ids), schema
    )


def _pack(window: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, packer = None, None
        for batch in batches:
            windows, offsets = [], []
            for c, length in zip(batch["cell"].to_pylist(), batch["length"].to_pylist(), strict=True):
                if c != cell:
                    cell, packer = c, SumOfSquares(window)
                w, offset = packer.place(length)
                windows.append(w)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(windows, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*batch.schema.names, "window", "offset"],
            )

    return pack


def pack_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``window`` tokens.

    Pieces are dealt by a hash of their content to cells of some 16 thousand; each
    cell fills windows of its own, so the padding of a cell (some hundred open
    windows at most) stays a small share at any size. ``pieces`` is read several
    times: pass a table. Columns other than doc_id, start, length, ids_crc32,
    doc_tokens are kept. No pieces: no rows. Repeated pieces are each placed.
    """
    importable(pieces.sparkSession)
    cells = cells_for(pieces.count(), CELL_PIECES)
    order = F.xxhash64("doc_id", "start", "length", "ids_crc32", F.lit(11))
    dealt = pieces.withColumn("order", order).withColumn("cell", F.pmod("order", F.lit(cells)).cast("int"))
    dealt = dealt.repartitionById(cells, "cell").sortWithinPartitions("cell", "order", "doc_id", "start")
    schema = StructType(list(dealt.schema.fields)).add("window", "long").add("offset", "long")
    packed = written(dealt.mapInArrow(_pack(window), schema).drop("order"), "packed")
    # One row per cell.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = packed.groupBy("cell").agg((F.max("window") + 1).alias("windows"))
    first = first.select("cell", F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("first"))
    return (
        packed.join(F.broadcast(first), "cell")
        .withColumn("sequence_id", (F.col("first") + F.col("window")).cast("long"))
        .drop("cell", "window", "first")
    )


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """Placement of every piece of every document: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset. Sequences are padded to ``window`` by their reader."""
    pieces = written(cut_documents(documents, tokenizer, end_id, window), "pieces")
    placed = pack_pieces(pieces, window)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _assemble(window: int, pad_id: int):
    def assemble(key, frame):
        import pandas as pd

        out = np.full(window, pad_id, np.int32)
        for offset, ids in zip(frame["offset"], frame["ids"], strict=True):
            part = np.frombuffer(ids, "<u4")
            out[offset : offset + len(part)] = part
        return pd.DataFrame({"sequence_id": [key[0]], "n_tokens": [int(frame["length"].sum())], "ids": [out]})

    return assemble


def sequences(documents: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The padded windows themselves: sequence_id, n_tokens, ids (``window`` integers)."""
    pieces = written(cut_documents(documents, tokenizer, end_id, window, with_ids=True), "pieces")
    packed = pack_pieces(pieces, window)
    return packed.groupBy("sequence_id").applyInPandas(
        _assemble(window, pad_id), "sequence_id long, n_tokens long, ids array<int>"
    )
