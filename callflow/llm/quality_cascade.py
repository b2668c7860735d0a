"""Quality rules as a short-circuit cascade, ordered by rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callflow.llm.shared import importable, small_slices

#: Rows that the costs and selectivities are estimated on, at most.
SAMPLE_ROWS = 2000
SPACE = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of ``width`` words that are found twice or more, first ones included."""
    windows = list(zip(*[words[k:] for k in range(width)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    codes: dict[tuple, int] = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in windows])
    twice = np.flatnonzero(np.bincount(ids)[ids] > 1)
    covered = np.zeros(len(words), bool)
    for j in range(width):
        covered[twice + j] = True
    return int(covered.sum())


@dataclass
class Text:
    """A whole text as bytes, and what more than one rule needs of it."""

    data: bytes
    words: list[bytes] = field(init=False)

    def __post_init__(self):
        self.words = self.data.split()

    def base(self) -> tuple[int, int, int, int, int]:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
        data = self.data
        lines = [line for line in data.split(b"\n") if line.strip()] if b"\n" in data else []
        return (
            len(self.words),
            len(data.translate(None, SPACE + CONTINUATION)),
            len(data) - len(data.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)),
            repeated_words(self.words),
        )


Base = tuple[int, int, int, int, int]


@dataclass(frozen=True)
class Rule:
    """``rejects(text, base)`` is true for a text that must go; texts have a word at least."""

    name: str
    rejects: Callable[[Text, Base], bool]


def _count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def _no_letters(text: Text, base: Base) -> bool:
    """Of ten words, fewer than six hold a letter (ASCII, or any character beyond it)."""
    plain = sum(1 for w in text.words if w.translate(None, NOT_LETTERS))
    return 10 * plain < 6 * base[0]


def _shouting(text: Text, base: Base) -> bool:
    """Over 40 % of the characters in words are ASCII capitals."""
    return 100 * _count(text.data, CAPITALS) > 40 * base[1]


def _exclaiming(text: Text, base: Base) -> bool:
    """Over half as many exclamation and question marks as words."""
    return 2 * _count(text.data, b"!?") > base[0]


def _few_distinct(text: Text, base: Base) -> bool:
    """Over 100 words of which fewer than 3 % are distinct, with at most 50 distinct ones."""
    distinct = len(set(text.words))
    return base[0] > 100 and distinct <= 50 and 100 * distinct < 3 * base[0]


def _endless_lines(text: Text, base: Base) -> bool:
    """Over 30 % of the lines, three at least, end in an ellipsis."""
    lines = [line.rstrip() for line in text.data.split(b"\n")]
    cut = sum(1 for line in lines if line.endswith((b"...", "\N{HORIZONTAL ELLIPSIS}".encode())))
    return cut >= 3 and 10 * cut > 3 * len(lines)


def _bullets(text: Text, base: Base) -> bool:
    """Over 90 % of the lines, three at least, begin with a bullet."""
    lines = [line.lstrip() for line in text.data.split(b"\n")]
    begun = sum(1 for line in lines if line.startswith((b"- ", b"* ", "\N{BULLET}".encode())))
    return begun >= 3 and 10 * begun > 9 * len(lines)


CAPITALS = bytes(range(0x41, 0x5B))
NOT_LETTERS = bytes(x for x in range(0x80) if not chr(x).isalpha())

RULES = [
    Rule("word_length", lambda t, b: not 2 * b[0] <= b[1] <= 15 * b[0]),
    Rule("symbols", lambda t, b: 10 * b[2] > b[0]),
    # A repeated heading or licence line is no fault: four lines at least, and over 30 %.
    Rule("duplicate_lines", lambda t, b: b[3] >= 4 and 10 * b[3] > 3 * (t.data.count(b"\n") + 1)),
    Rule("repeated_words", lambda t, b: 100 * b[4] > 30 * b[0]),
    Rule("letters", _no_letters),
    Rule("capitals", _shouting),
    Rule("exclamation", _exclaiming),
    Rule("distinct_words", _few_distinct),
    Rule("ellipses", _endless_lines),
    Rule("bullets", _bullets),
]


def base_failed(base: Base) -> bool:
    return base[0] < 50 or 100 * base[4] > 50 * base[0]


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / self.seconds


def estimate(texts: list[bytes], rules: list[Rule]) -> list[Estimate]:
    """Cost and share of rejections of each rule on texts that pass the base."""
    pairs = [(t, b) for t in map(Text, texts) if not base_failed(b := t.base())]
    out = []
    for rule in rules:
        begin = time.perf_counter()
        rejected = sum(rule.rejects(t, b) for t, b in pairs)
        seconds = time.perf_counter() - begin
        out.append(Estimate(rule.name, max(seconds, 1e-9) / max(1, len(pairs)), rejected / max(1, len(pairs))))
    return out


def _sampled(rules: list[Rule]):
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch["text"].to_pylist()]
            found = estimate(texts, rules)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([e.name for e in found]),
                    pa.array([e.seconds * len(texts) for e in found]),
                    pa.array([e.rejected * len(texts) for e in found]),
                    pa.array([len(texts)] * len(found), pa.int64()),
                ],
                names=["name", "seconds", "rejected", "n"],
            )

    return sampled


def order_rules(documents: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample, most first.

    A twentieth of the rows is drawn until there are ``rows``, so only the first
    partitions are read; the order changes the time taken and never a verdict. The
    texts stay on the executors; a few numbers per rule come back.
    """
    sample = documents.select("text").sample(0.05, seed=17).limit(rows)
    measured = sample.mapInArrow(_sampled(rules), "name string, seconds double, rejected double, n long")
    sums = measured.groupBy("name").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r")).collect()
    rank = {row.name: row.r / row.s for row in sums}
    return sorted(rules, key=lambda rule: -rank.get(rule.name, 0.0))


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _cascade(rules: list[Rule], names: list[str]):
    def cascade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "_text"):
            bases, failed, reasons = [], [], []
            for value in batch["_text"].to_pylist():
                text = Text((value or "").encode())
                base = text.base()
                bases.append(base)
                failed.append(base_failed(base))
                reasons.append(
                    "base" if failed[-1] else next((r.name for r in rules if r.rejects(text, base)), None)
                )
            columns = list(zip(*bases, strict=True)) if bases else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[n] for n in names],
                    *[pa.array(c, pa.int64()) for c in columns],
                    pa.array(failed, pa.bool_()),
                    pa.array([r is None for r in reasons], pa.bool_()),
                    pa.array(reasons, pa.string()),
                ],
                names=[*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "rejected_by"],
            )

    return cascade


def judge(
    documents: DataFrame, carry: list[str], rules: list[Rule] | None = None, text: str = "text"
) -> DataFrame:
    """``carry`` columns with base counts, base_failed, kept and rejected_by of every text.

    One pass without a shuffle after the sample. The base check comes first; a text
    that passes meets the rules in their estimated order until one rejects it, so
    ``rejected_by`` may name another rule on another day, ``kept`` never changes. Null
    and empty texts have no words and fail the base. Every row is judged by itself:
    repeated rows and ids give the same verdict each. An empty table gives no rows.
    """
    importable(documents.sparkSession)
    ordered = order_rules(documents.select(F.col(text).alias("text")), list(RULES if rules is None else rules))
    rows = documents.select(*carry, F.col(text).alias("_text"))
    fields = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(
        _cascade(ordered, carry), f"{fields}, {COLUMNS}, base_failed boolean, kept boolean, rejected_by string"
    )


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows that every rule keeps, with their own columns, whatever their names."""
    names = documents.columns
    plain = documents.toDF(*[f"c{k}" for k in range(len(names))])
    return judge(plain, plain.columns, text=f"c{names.index('text')}").where("kept").select(*plain.columns).toDF(*names)


def document_quality(documents: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every document."""
    return judge(documents, ["doc_id"]).drop("rejected_by")
