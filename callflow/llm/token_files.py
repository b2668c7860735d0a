"""Token ids in files of fixed-width bits with block offsets, and their reader."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callflow.llm.encoding import text_encoder, text_parts
from callflow.llm.shared import crc32, importable
from callflow.session import new_work_path, written

#: Ids per block; a multiple of 8, so that every block ends on a byte.
BLOCK = 1 << 16
#: Documents per file, about.
FILE_DOCUMENTS = 1 << 14
MAGIC = b"FWBP1\0"
# Bits per id, ids per block, documents, ids, blocks, place of the index; then MAGIC again.
FOOTER = struct.Struct("<IIQQQQ6s")


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids ``0 .. vocabulary - 1``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids of up to 32 bits each as ``width`` bits, least significant first; padded to 8 ids."""
    rows = -(-len(ids) // 8)
    padded = np.zeros((rows, 8), np.uint64)
    padded.reshape(-1)[: len(ids)] = ids
    if len(ids) and int(padded.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    out = np.zeros((rows, width), np.uint8)
    for j in range(8):
        for byte in range(j * width // 8, (j * width + width - 1) // 8 + 1):
            shift = byte * 8 - j * width
            part = padded[:, j] >> np.uint64(shift) if shift >= 0 else padded[:, j] << np.uint64(-shift)
            out[:, byte] |= part.astype(np.uint8)
    return out.tobytes()


def unpack_bits(data: bytes, width: int, count: int) -> np.ndarray:
    """The inverse of ``pack_bits``, without a loop over ids."""
    packed = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(packed), 8), np.uint64)
    for j in range(8):
        for byte in range(j * width // 8, (j * width + width - 1) // 8 + 1):
            shift = byte * 8 - j * width
            part = packed[:, byte].astype(np.uint64)
            out[:, j] |= part << np.uint64(shift) if shift >= 0 else part >> np.uint64(-shift)
    return (out & np.uint64((1 << width) - 1)).reshape(-1)[:count].astype("<u4")


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a folder that all executors share."""
    if path.startswith("s3a://"):
        path = "s3" + path[3:]
    return pafs.FileSystem.from_uri(path)


class TokenFileWriter:
    """One file: packed blocks, then the index, then a footer. Holds one block and the index."""

    def __init__(self, path: str, width: int):
        system, inner = file_system(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.out, self.width = system.open_output_stream(inner), width
        self.out.write(MAGIC)
        self.at, self.ids, self.waiting = len(MAGIC), 0, 0
        self.parts: list[np.ndarray] = []  # ids that no block holds yet
        self.blocks: list[int] = []
        self.documents: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, document: int | None, ids: np.ndarray) -> None:
        self.documents.append(document)
        self.lengths.append(len(ids))
        self.ids += len(ids)
        self.parts.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            rest = np.concatenate(self.parts)
            whole = len(rest) // BLOCK * BLOCK
            for start in range(0, whole, BLOCK):
                self._block(rest[start : start + BLOCK])
            self.parts, self.waiting = [rest[whole:]], len(rest) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack_bits(ids, self.width)
        self.blocks.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> int:
        if self.waiting:
            self._block(np.concatenate(self.parts))
        index = self.at
        self.out.write(np.array([*self.blocks, index], "<i8").tobytes())
        self.out.write(np.array([d is not None for d in self.documents], np.uint8).tobytes())
        self.out.write(np.array([d or 0 for d in self.documents], "<i8").tobytes())
        self.out.write(np.array(self.lengths, "<i8").tobytes())
        self.out.write(
            FOOTER.pack(self.width, BLOCK, len(self.documents), self.ids, len(self.blocks), index, MAGIC)
        )
        self.out.close()
        return self.ids


class TokenFile:
    """Random access to the documents of a file; reads only the blocks they lie in."""

    def __init__(self, path: str):
        system, inner = file_system(path)
        self.file = system.open_input_file(inner)
        size = self.file.size()
        footer = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        self.width, self.block, count, self.ids, blocks, index, magic = footer
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        raw = self.file.read_at(size - FOOTER.size - index, index)
        at = 8 * (blocks + 1)
        self.blocks = np.frombuffer(raw, "<i8", blocks + 1)
        known = np.frombuffer(raw, np.uint8, count, at)
        ids = np.frombuffer(raw, "<i8", count, at + count)
        self.documents = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.starts = np.r_[0, np.cumsum(np.frombuffer(raw, "<i8", count, at + 9 * count))]
        self._last: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def _unpacked(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            data = self.file.read_at(int(self.blocks[k + 1] - self.blocks[k]), int(self.blocks[k]))
            self._last = (k, unpack_bits(data, self.width, min(self.block, self.ids - k * self.block)))
        return self._last[1]

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids ``start .. end - 1`` of the file."""
        parts = [
            self._unpacked(k)[max(0, start - k * self.block) : end - k * self.block]
            for k in range(start // self.block, -(-end // self.block))
        ]
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's ``k``-th document."""
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


def _encode(tokenizer: str, end_id: int, width: int, bounds: list[int]):
    cuts = np.array(bounds, np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for start, stop in text_parts(texts):
                ids = [np.append(x, np.uint32(end_id)) for x in encoder.encode(texts[start:stop])]
                keys = batch["doc_id"].slice(start, stop - start)
                known = np.array(keys.is_valid())
                file = np.where(known, np.searchsorted(cuts, np.array(keys.fill_null(0)), "right"), 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file, pa.int32()),
                        keys,
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([pack_bits(x, width) for x in ids], pa.binary()),
                    ],
                    names=["file_no", "doc_id", "n_tokens", "packed"],
                )

    return encode


def _write(folder: str, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = number = path = None
        done = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("file_no", "doc_id", "n_tokens", "packed")]
            for file_no, document, count, packed in zip(*columns, strict=True):
                if writer is None or file_no != number:
                    if writer:
                        done.append((number, path, len(writer.documents), writer.close()))
                    # A name no other attempt uses; only files of attempts that end well are listed.
                    number, path = file_no, f"{folder}/{file_no:06d}-{uuid.uuid4().hex}.tok"
                    writer = TokenFileWriter(path, width)
                writer.add(document, unpack_bits(packed, width, count))
        if writer:
            done.append((number, path, len(writer.documents), writer.close()))
        if done:
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)],
                names=["file_no", "path", "n_documents", "n_ids"],
            )

    return write


def write_token_files(documents: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order; returns the list of files.

    Bounds of doc_id, from its quantiles, deal the documents to files; a file is
    sorted and written by one task, block by block. The list (file_no, path,
    n_documents, n_ids, first_id) is itself a table; files of failed attempts are not
    in it. Null text is empty, so its only id is ``end_id``. Documents without doc_id
    come first; equal doc_ids are ordered by their length and packed ids. No documents: no files.
    ``folder`` must be one that all executors and Arrow can open (file, S3, HDFS, GCS).
    """
    importable(documents.sparkSession)
    from callflow.llm.encoding import load_tokenizer

    width = bits_for(max(load_tokenizer(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1))
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    count = rows.count()
    files = -(-count // FILE_DOCUMENTS)
    shares = [k / files for k in range(1, files)]
    bounds = sorted({int(b) for b in rows.approxQuantile("doc_id", shares, 1 / (8 * files))}) if shares else []
    encoded = rows.mapInArrow(
        _encode(tokenizer, end_id, width, bounds), "file_no int, doc_id long, n_tokens long, packed binary"
    )
    dealt = encoded.repartitionById(max(1, files), "file_no").sortWithinPartitions(
        "file_no", "doc_id", "n_tokens", "packed"
    )
    listed = written(
        dealt.mapInArrow(_write(folder, width), "file_no int, path string, n_documents long, n_ids long"), "files"
    )
    # One row per file: a window over all of them is small.
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first in zip(batch["path"].to_pylist(), batch["first_id"].to_pylist(), strict=True):
            file = TokenFile(path)
            n = len(file.documents)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(file.documents, pa.int64()),
                    pa.array(file.starts[:-1] + first, pa.int64()),
                    pa.array(np.diff(file.starts), pa.int64()),
                    pa.array([crc32(file.document(k).tobytes()) for k in range(n)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files listed."""
    importable(files.sparkSession)
    spread = files.select("file_no", "path", "first_id").repartition(max(1, files.count()), "file_no")
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(documents: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write all documents as token files under the shared folder, and read them back."""
    folder = new_work_path(documents.sparkSession, "tokens")
    return read_digests(write_token_files(documents, tokenizer, end_id, folder))


__all__ = ["TokenFile", "read_digests", "token_digests", "write_token_files"]
