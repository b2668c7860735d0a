"""Removal of long byte strings that occur anywhere else, by bucket-pointer refinement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.llm.shared import BASE, INVERSE, forget, importable, mix, powers, prefix_sums, small_slices
from callflow.session import written

LENGTH = 200
GRAM = 32
#: Windows of one text hashed at once; longer texts are hashed in parts that overlap.
PART_WINDOWS = 1 << 20
#: Bytes of short texts hashed together.
TOGETHER = 1 << 18
#: Offsets that the second round takes together.
BLOCK = 16
#: Bytes that all windows of a block share.
SHARED = LENGTH - BLOCK + 1
#: Rows of the later rounds, each at most 368 bytes of text, that Python takes at once.
ROUND_ROWS = 4096


def pointers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of its smallest (the first of equal ones)."""
    value, place, size = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        left, right = value[:-step], value[step:]
        take = left <= right
        value = np.where(take, left, right)
        place = np.where(take, place[:-step], place[step:])
        size += step
    return place


def gram_buckets(sums: np.ndarray) -> np.ndarray:
    """The initial buckets: the identifier of the q-gram at every offset."""
    return mix((sums[GRAM:] - sums[:-GRAM]) * powers(INVERSE, len(sums))[: len(sums) - GRAM])


def _pair(own: np.ndarray, later: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bucket that ``own`` is refined to by the bucket at a later offset, for strings of ``length`` bytes."""
    return mix(mix(own + length * np.uint64(BASE)) + later * np.uint64(INVERSE))


def refined(buckets: np.ndarray, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Identifiers of the buckets that strings of ``length`` bytes (``GRAM`` or more) at offsets ``at`` fall in.

    A bucket of strings of 32, 64, 128 ... bytes, the most that are fewer than
    ``length``, is refined by the bucket of as many bytes at the later offset where
    they end with the string; both are refinements of shorter ones. The identifier
    follows from the pair and the length, so equal strings have the same one in all
    texts and no task has to look up a number that another one gave.
    """
    length = np.broadcast_to(np.asarray(length, np.int64), at.shape)
    out, known = buckets[at], GRAM
    while len(longer := np.flatnonzero(length > known)):
        rows = longer[length[longer] <= 2 * known]
        if len(rows):
            ends = np.stack([at[rows], at[rows] + length[rows] - known])
            parts, size = buckets[ends[..., None] + np.arange(0, known, GRAM)], GRAM
            while size < known:
                size *= 2
                parts = _pair(parts[..., ::2], parts[..., 1::2], np.array([size], np.uint64))
            out[rows] = _pair(parts[0, :, 0], parts[1, :, 0], length[rows].astype(np.uint64))
        known *= 2
    return out


def _pieces(data) -> Iterator[tuple[int, np.ndarray]]:
    """A text in parts of at most ``PART_WINDOWS`` windows, each with where it begins."""
    windows = len(data) - LENGTH + 1
    for at in range(0, windows, PART_WINDOWS):
        yield at, np.frombuffer(data, np.uint8, min(PART_WINDOWS, windows - at) + LENGTH - 1, at)


def piece_segments(pieces: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Runs of windows that point to the same q-gram: (piece, bucket, refined bucket, start, windows - 1, offset).

    A window of 200 bytes points to its smallest q-gram, by identifier, which depends
    on its content alone. So equal windows lie at equal offsets from q-grams of one
    bucket. The bucket is refined by those at later offsets up to the end of the run.
    The pieces are laid end to end; windows across their borders are left out.
    """
    sizes = np.array([len(p) for p in pieces])
    first = np.cumsum(sizes) - sizes
    past = first + sizes - LENGTH + 1
    buckets = gram_buckets(prefix_sums(np.concatenate(pieces)))
    place = pointers(buckets, LENGTH - GRAM + 1)
    starts = np.unique(np.concatenate([np.flatnonzero(place[1:] != place[:-1]) + 1, first, past[:-1]]))
    ends = np.r_[starts[1:], len(place)] - 1
    piece = np.searchsorted(first, starts, "right") - 1
    inside = starts < past[piece]
    starts, ends, piece = starts[inside], ends[inside], piece[inside]
    anchor = place[starts]
    return (
        piece,
        buckets[anchor].view(np.int64),
        refined(buckets, starts, ends - starts + LENGTH).view(np.int64),
        starts - first[piece],
        ends - starts,
        anchor - starts,
    )


def text_segments(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """The runs of one text by parts: (bucket, refined bucket, start, windows - 1, offset)."""
    for at, piece in _pieces(data):
        _, core, whole, start, more, offset = piece_segments([piece])
        yield core, whole, start + at, more, offset


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_slices(batches, "bytes"):
        rows, begins, pieces, size = [], [], [], 0
        for row, text in enumerate(batch["bytes"]):
            data = text.as_buffer()
            if data is None or len(data) < LENGTH:
                continue
            for at, piece in _pieces(data):
                rows.append(row)
                begins.append(at)
                pieces.append(piece)
                size += len(piece)
                if size >= TOGETHER:
                    yield _segment_batch(batch, rows, begins, pieces)
                    rows, begins, pieces, size = [], [], [], 0
        if rows:
            yield _segment_batch(batch, rows, begins, pieces)


def _segment_batch(batch: pa.RecordBatch, rows: list[int], begins: list[int], pieces: list[np.ndarray]) -> pa.RecordBatch:
    piece, core, whole, start, more, offset = piece_segments(pieces)
    place = (start + np.array(begins)[piece]) << 16 | more << 8 | offset
    rows = pa.array(np.array(rows)[piece])
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in (core, whole, place)], batch["doc_id"].take(rows), batch["hash"].take(rows)],
        names=["core", "whole", "place", "doc_id", "hash"],
    )


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of each range ``first..last``, with the row of its range."""
    sizes = last - first + 1
    rows = np.repeat(np.arange(len(first)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[rows]


def _contents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The q-gram buckets of all contents of a batch, laid end to end, and where each content begins."""
    parts = batch["content"].to_pylist()
    begins = np.cumsum([0, *map(len, parts)])[:-1]
    return gram_buckets(prefix_sums(np.frombuffer(b"".join(parts), np.uint8))), begins


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROUND_ROWS):
            yield batch.slice(at, ROUND_ROWS)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows cut into blocks of offsets from their q-gram, with the buckets of what a block shares and of all of it."""
    for batch in _small(batches):
        buckets, begins = _contents(batch)
        low, top = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "high"))
        row, block = _expand(low // BLOCK, top // BLOCK)
        first = np.maximum(low[row], block * BLOCK)
        last = np.minimum(top[row], block * BLOCK + BLOCK - 1)
        begin = begins[row] + top[row]
        shared = refined(buckets, begin - block * BLOCK, SHARED)
        union = refined(buckets, begin - last, last - first + LENGTH)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch[c].take(take) for c in ("doc_id", "hash", "anchor", "gram")],
                *[pa.array(c, pa.int64()) for c in (first, last, block, shared.view(np.int64), union.view(np.int64))],
            ],
            names=["doc_id", "hash", "anchor", "gram", "low", "high", "block", "shared", "union"],
        )


def _singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of open blocks, with the q-gram buckets at their first and last offset.

    All windows of a block share the bytes between, which the bucket of the block stands for.
    """
    for batch in _small(batches):
        buckets, begins = _contents(batch)
        low, high, top = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "high", "top"))
        row, at = _expand(low, high)
        begin = begins[row] + top[row] - at
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch[c].take(take) for c in ("doc_id", "hash", "anchor", "bucket")],
                *[pa.array(c.view(np.int64)) for c in (at, buckets[begin], buckets[begin + LENGTH - GRAM])],
            ],
            names=["doc_id", "hash", "anchor", "bucket", "at", "own", "later"],
        )


def refine(rows: DataFrame, row: Column, *keys: str) -> tuple[DataFrame, list[DataFrame]]:
    """One round on ``rows(core, whole, ...)``; ``row`` numbers them by their keys.

    ``core`` is what all windows of a row share, ``whole`` all their bytes. A row
    whose core is alone in its bucket has no repeated window and goes. Rows with equal
    whole are repeated (``done``). Rows still ``open`` go to the next round: those not
    done, and of each set of equal rows one, if its bucket holds others that may match
    a part of it. Counts are aggregated before the shuffle, so a hot bucket is a few sums.
    Aggregates are written before they meet rows: beside a table, adaptive execution splits a hot core.
    ``rows``, a written table, is deleted; so may be the tables returned, once the result is written.
    """
    shared = rows.groupBy("core").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("core")
    shared = written(shared, "cores")
    source, rows = rows, written(rows.join(shared, "core"), "shared")
    forget(source)
    parts = rows.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("_same"), F.min(row).alias("_first"))
    parts = written(parts, "parts")
    buckets = written(parts.groupBy("core").agg(F.sum("_same").alias("_all")), "sizes")
    marked = parts.join(buckets, "core").select(
        "core",
        "whole",
        (F.col("_same") > 1).alias("done"),
        F.when(F.col("_all") > F.col("_same"), F.col("_first")).alias("_first"),
    )
    marked = written(marked, "marked")
    joined = rows.join(marked, ["core", "whole"])
    is_open = (row == F.col("_first")) | (~F.col("done"))
    return joined.select(*keys, "core", "done", F.coalesce(is_open, F.lit(False)).alias("open")), [rows, shared, parts, buckets, marked]


def _merge(spans: np.ndarray) -> np.ndarray:
    """Sorted, overlapping or touching spans made one; ``(n, 2)``."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    begin = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.stack([spans[begin, 0], reach[np.r_[np.flatnonzero(begin)[1:] - 1, len(spans) - 1]]], axis=1)


def _kept(data: bytes, spans: np.ndarray) -> bytes:
    at, parts = 0, []
    for start, end in spans.tolist():
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]])


SPANS = "spans array<long>"
OPEN = "open_segments array<struct<core:bigint,place:bigint>>"


def _first_pass(carry: list[str], keep_bytes: bool):
    """Spans of what the first round settled, and the segments that stay open."""

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "bytes"):
            out = {"n_bytes": [], "spans": [], "open": [], "kept_sha256": [], "kept": [], "bytes": []}
            for value, found in zip(batch["bytes"], batch["found"].to_pylist(), strict=True):
                data = value.as_py() or b""
                found = found or []
                done = np.array([f["place"] for f in found if f["done"]], np.int64)
                spans = _merge(np.stack([done >> 16, (done >> 16) + (done >> 8 & 255) + LENGTH], axis=1))
                left = [{"core": f["core"], "place": f["place"]} for f in found if f["open"]]
                kept = None if left else _kept(data, spans)
                out["n_bytes"].append(len(data))
                out["spans"].append(spans.reshape(-1).tolist())
                out["open"].append(left or None)
                out["kept_sha256"].append(None if left else hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept if keep_bytes else None)
                out["bytes"].append(data if left else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in carry],
                    pa.array(out["n_bytes"], pa.int64()),
                    pa.array(out["spans"], pa.list_(pa.int64())),
                    pa.array(out["open"], pa.list_(pa.struct([("core", pa.int64()), ("place", pa.int64())]))),
                    pa.array(out["kept_sha256"], pa.string()),
                    pa.array(out["kept"], pa.binary()),
                    pa.array(out["bytes"], pa.binary()),
                ],
                names=[*carry, "n_bytes", "spans", "open_segments", "kept_sha256", "kept", "bytes"],
            )

    return first_pass


def _last_pass(carry: list[str], keep_bytes: bool):
    def last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "bytes"):
            all_spans, digests, rest = [], [], []
            for value, spans, more in zip(
                batch["bytes"], batch["spans"].to_pylist(), batch["more"].to_pylist(), strict=True
            ):
                data = value.as_py()
                pairs = [*zip(spans[::2], spans[1::2], strict=True), *[(m["start"], m["end"]) for m in more or []]]
                merged = _merge(np.array(pairs, np.int64).reshape(-1, 2))
                kept = _kept(data, merged)
                all_spans.append(merged.reshape(-1).tolist())
                digests.append(hashlib.sha256(kept).hexdigest())
                rest.append(kept if keep_bytes else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in carry],
                    batch["n_bytes"],
                    pa.array(all_spans, pa.list_(pa.int64())),
                    pa.array(digests, pa.string()),
                    pa.array(rest, pa.binary()),
                ],
                names=[*carry, "n_bytes", "spans", "kept_sha256", "kept"],
            )

    return last_pass


def repeated_spans(documents: DataFrame, carry: list[str], text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """``carry`` columns with n_bytes, spans (flat starts and ends), kept_sha256 and kept.

    Each byte covered by a 200-byte string that also starts anywhere else in a text of
    the input is in a span. Round one buckets the windows by the q-gram they point
    to, in runs; round two refines what is open by blocks of 16 offsets from that
    q-gram; round three by single offsets. In each, a row's bucket is refined by the
    identifiers of the buckets at later offsets, and the refined bucket is the one
    that the next round starts from. Buckets are told apart by two 64-bit names together. Texts move twice at most: once to meet the spans of round one, and those
    with open rows once more. ``carry`` must hold doc_id. Null text is empty; texts under 200 bytes and an empty table
    lose nothing; of equal texts of 200 bytes or more all bytes go, equal rows
    included. ``kept`` is null unless ``keep_bytes``. ``documents`` is read twice.
    """
    importable(documents.sparkSession)
    names = [f"c{k}" for k in range(len(carry))]
    types = [documents.schema[c].dataType.simpleString() for c in carry]
    docs = documents.select(
        *[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)],
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("hash"),
        F.col(text).cast("binary").alias("bytes"),
    )
    fields = ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
    segments = docs.where(F.length("bytes") >= LENGTH).select("doc_id", "hash", "bytes").mapInArrow(
        _segments, "core long, whole long, place long, doc_id long, hash long"
    )
    row = F.xxhash64("doc_id", "hash", "place")
    first, used = refine(written(segments, "segments"), row, "doc_id", "hash", "place")
    first = first.where("done OR open")
    found = first.groupBy("doc_id", "hash").agg(
        F.collect_set(F.struct("place", "core", "done", "open")).alias("found")
    ).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "found")
    met = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["hash"] == F.col("_hash")), "left")
    inner = ["doc_id", "hash", *names]
    schema = f"doc_id long, hash long, {fields}, n_bytes long, {SPANS}, {OPEN}, kept_sha256 string, kept binary, bytes binary"
    passed = written(
        met.select(*inner, "bytes", "found").mapInArrow(_first_pass(inner, keep_bytes), schema), "first_pass"
    )
    forget(*used)
    open_docs = passed.where("open_segments IS NOT NULL")
    start, more, offset = (F.expr("place >> 16"), F.expr("(place >> 8) & 255"), F.expr("place & 255"))
    # Equal rows that are both here are repeated anyway, so that they count twice is right.
    rows = (
        open_docs.select("doc_id", "hash", "bytes", F.explode("open_segments").alias("s"))
        .select("doc_id", "hash", "s.core", "s.place", "bytes")
        .select(
            "doc_id",
            "hash",
            F.col("core").alias("gram"),
            (start + offset).alias("anchor"),
            (offset - more).alias("low"),
            offset.alias("high"),
            F.col("bytes").substr((start + 1).cast("int"), (more + LENGTH).cast("int")).alias("content"),
        )
    )
    rows = written(rows, "open_rows")
    ends = ["doc_id", "hash", "anchor", "low", "high"]
    blocks = rows.mapInArrow(
        _blocks,
        "doc_id long, hash long, anchor long, gram long, low long, high long, block long, shared long, `union` long",
    ).select(
        *ends,
        F.xxhash64("gram", "block", "shared").alias("core"),
        F.xxhash64("low", "high", "union", "gram").alias("whole"),
    )
    second, used = refine(written(blocks, "blocks"), F.xxhash64(*ends), *ends)
    second = written(second.where("done OR open"), "second")
    forget(*used)
    # The bytes of open blocks are fetched from their rows again.
    inside = rows.select(
        F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), F.col("anchor").alias("_anchor"),
        F.col("high").alias("top"), F.col("low").alias("_low"), "gram", "content",
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.col("hash") == F.col("_hash"))
        & (F.col("anchor") == F.col("_anchor"))
        & (F.col("high") <= F.col("top"))
        & (F.col("low") >= F.col("_low"))
    )
    singles = second.where("open").select(*ends, F.col("core").alias("bucket")).distinct().join(inside.distinct(), same)
    singles = singles.select(*ends, "bucket", "top", "content").mapInArrow(
        _singles, "doc_id long, hash long, anchor long, bucket long, at long, own long, later long"
    )
    singles = singles.select(
        "doc_id", "hash", "anchor", "at",
        F.xxhash64("bucket", "at", "own").alias("core"),
        F.xxhash64("bucket", "at", "later").alias("whole"),
    )
    # Equal windows: of one core and one whole. Those of one place are one window.
    singles = written(singles, "singles")
    twice = singles.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("core", "whole")
    twice = written(twice, "twice")
    third = singles.join(twice, ["core", "whole"])
    spans = second.where("done").select(
        "doc_id", "hash", (F.col("anchor") - F.col("high")).alias("start"),
        (F.col("anchor") - F.col("low") + LENGTH).alias("end"),
    ).unionByName(
        third.select(
            "doc_id", "hash", (F.col("anchor") - F.col("at")).alias("start"),
            (F.col("anchor") - F.col("at") + LENGTH).alias("end"),
        )
    )
    spans = spans.groupBy("doc_id", "hash").agg(F.collect_set(F.struct("start", "end")).alias("more"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "more")
    last = open_docs.join(
        spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left"
    ).select(*names, "n_bytes", "spans", "bytes", "more")
    closed = last.mapInArrow(
        _last_pass(names, keep_bytes), f"{fields}, n_bytes long, {SPANS}, kept_sha256 string, kept binary"
    )
    columns = [*names, "n_bytes", "spans", "kept_sha256", "kept"]
    done = passed.where("open_segments IS NULL").select(*columns).unionByName(closed.select(*columns))
    return done.toDF(*carry, "n_bytes", "spans", "kept_sha256", "kept")


def span_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.

    Null, short, empty and very long texts, equal rows and an empty table are as for ``repeated_spans``.
    """
    ends = F.aggregate(
        F.sequence(F.lit(0), F.size("spans") - 1),
        F.lit(0).cast("long"),
        lambda total, k: total + F.get("spans", k) * F.when(k % 2 == 1, 1).otherwise(-1),
    )
    removed = F.when(F.size("spans") > 0, ends).otherwise(F.lit(0).cast("long"))
    return repeated_spans(documents, ["doc_id"]).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        "kept_sha256",
    )


def remove_repeats(documents: DataFrame) -> DataFrame:
    """The documents without their repeated bytes, and without characters cut by that.

    Rows stay, even if nothing of their text does; ``n_chars``, where there is one, is
    counted anew. Null text stays null.
    """
    names = documents.columns
    plain = documents.toDF(*[f"d{k}" for k in range(len(names))])
    at = {n: f"d{names.index(n)}" for n in names}
    source = plain.withColumn("no_text", F.col(at["text"]).isNull()).withColumn("doc_id", F.col(at["doc_id"]))
    carry = [*[c for c in plain.columns if c != at["text"]], "no_text", "doc_id"]
    out = repeated_spans(source, carry, text=at["text"], keep_bytes=True)
    out = out.withColumn(at["text"], F.when(~F.col("no_text"), whole_characters(F.col("kept"))))
    if "n_chars" in names:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn(at["n_chars"], F.coalesce(F.length(at["text"]), F.lit(0)).cast(kind))
    return out.select(*plain.columns).toDF(*names)


def whole_characters(data: Column) -> Column:
    """UTF-8 text of bytes; a text that was cut inside characters loses what is left of them."""
    text = data.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))
