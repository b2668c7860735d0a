"""Token ids of whole texts by the tokenizers library, with a bounded cache of words."""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from functools import cache

import numpy as np
import regex

from callflow.llm.shared import prefix_sums, spans_hash

#: Distinct units that a worker keeps, up to twice. Results do not depend on it.
CACHED_UNITS = 150_000


#: Characters that are cut into units at once, about. Longer texts are cut at white space first.
PART = 2 << 20
_SPACE = re.compile(r"[ \t-\r]")


def load_tokenizer(path: str):
    """The tokenizer of a file, with truncation and padding off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_letters() -> dict[int, str]:
    """The letter of each byte in byte-level vocabularies: itself if printable, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(0x100) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


#: A character beyond usual Latin text: there, letters, digits and white space are the same
#: to every library, and lower case does not depend on neighbours.
UNUSUAL = re.compile("[^\\t-\\r -~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]")


#: Of bytes: white space, letters (and all bytes beyond ASCII), digits, others.
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 0


def text_units(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of usual text, across which no pre-token reaches.

    Units are runs of letters, single digits and runs of others; but a run between white
    space that holds an apostrophe or a sign beyond ASCII is one unit, as contractions
    and such signs take a closer look.
    """
    raw = np.frombuffer(data, np.uint8)
    kind = np.r_[np.uint8(0), _KIND[raw], np.uint8(0)]
    space = kind == 0
    turn = kind[1:] != kind[:-1]
    turn[1:] |= (kind[1:-1] == 2) & (kind[2:] == 2)
    odd = (raw == 0x27) | (raw == 0xC2)
    odd[:-1] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
    odd = np.flatnonzero(odd)
    if len(odd):
        edges = np.flatnonzero(space[1:] != space[:-1])
        run = np.unique(np.searchsorted(edges, odd, "right") - 1)
        inner = np.zeros(len(turn) + 1, np.int8)
        inner[edges[run] + 1] += 1
        inner[edges[run + 1]] -= 1
        turn &= np.cumsum(inner[:-1]) == 0
    cuts = np.flatnonzero(turn)
    held = ~space[1:-1][cuts[:-1]] if len(cuts) else np.zeros(0, bool)
    return cuts[:-1][held], cuts[1:][held]


def distinct_units(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct units of some texts, the number in that list of each unit in order, and
    where each text's units begin (one number more than texts)."""
    data = b"\n".join(texts)
    starts, ends = text_units(data)
    hashes = spans_hash(prefix_sums(np.frombuffer(data, np.uint8)), starts, ends)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    units = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return units, inverse, np.searchsorted(starts, begins)


def text_cuts(text: str) -> list[str]:
    """A text in parts of about ``PART`` characters, cut before white space where there is some."""
    out, at = [], 0
    while len(text) - at > PART:
        found = _SPACE.search(text, at + PART)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


class UsualText:
    """Whether a tokenizer file cuts usual Latin text in a way that can be followed here.

    Texts in composed form, of usual characters and without added tokens, are put in lower
    case and cut into units; ``words`` cuts a unit by the pattern of the file.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.letters = byte_letters()
        self.find = self._pattern(spec)

    @staticmethod
    def _pattern(spec: dict):
        def types(part, inner):
            return [x["type"] for x in (part or {}).get(inner, [])]

        cut = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if types(spec["normalizer"], "normalizers") != ["NFC", "Replace", "Lowercase"]:
            return None
        if types(spec["pre_tokenizer"], "pretokenizers") != ["Split", "ByteLevel"] or cut[1]["use_regex"]:
            return None
        if cut[0]["behavior"] != "Removed" or not cut[0]["invert"] or spec["model"]["type"] != "BPE":
            return None
        # The units below are those of this pattern and of no other.
        known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        return regex.compile(known).findall if cut[0]["pattern"].get("Regex") == known else None

    def holds(self, text: str) -> bool:
        return (
            self.find is not None
            and not UNUSUAL.search(text)
            and (text.isascii() or unicodedata.is_normalized("NFC", text))
            and not any(a in text for a in self.added)
        )

    def words(self, unit: bytes) -> list[str]:
        """The pre-tokens of a unit, in the letters of the vocabulary."""
        if unit.isalpha():
            return [unit.decode()]
        return [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in self.find(unit.decode())]


class Kept(dict):
    """A mapping of bounded size: when full, it lets go of what was not used since it last was."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def missing(self, keys: list) -> list:
        """Those of ``keys`` that must be worked out; the others are in the mapping afterwards."""
        new = [k for k in keys if k not in self]
        if len(self) + len(new) > self.most:
            self.older = dict(self)
            self.clear()
            new = keys
        for k in new:
            if k in self.older:
                self[k] = self.older[k]
        return [k for k in new if k not in self]


class TextEncoder:
    """Encodes whole texts by the tokenizers library, with the ids of words kept.

    New words of usual text go to the library's model one by one; other texts, and
    files with another normaliser or pre-tokenizer, go to the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.usual = UsualText(path)
        self.units = Kept(CACHED_UNITS)

    def _learn(self, units: list[bytes]) -> None:
        tokenize, words = self.tokenizer.model.tokenize, self.usual.words
        for unit in units:
            ids = [t.id for w in words(unit) for t in tokenize(w)]
            self.units[unit] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        texts = [t or "" for t in texts]
        usual = [self.usual.holds(t) for t in texts]
        long = [u and len(t) > 2 * PART for t, u in zip(texts, usual, strict=True)]
        together = iter(self._encode([t for t, u, x in zip(texts, usual, long, strict=True) if u and not x]))
        others = [t for t, u in zip(texts, usual, strict=True) if not u]
        whole = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else ())
        out = []
        for text, simple, is_long in zip(texts, usual, long, strict=True):
            if is_long:
                out.append(np.concatenate([self._encode([p])[0] for p in text_cuts(text)]))
            else:
                out.append(next(together) if simple else np.array(next(whole).ids, "<u4"))
        return out

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of usual texts."""
        units, which, begins = distinct_units([t.lower().encode() for t in texts])
        self._learn(self.units.missing(units))
        parts = [self.units[u] for u in units]
        flat = np.frombuffer(b"".join(parts), "<u4")
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        sources = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        places = np.repeat(sources[which] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        ids = flat[places]
        bounds = np.r_[0, ends][begins].tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@cache
def text_encoder(path: str) -> TextEncoder:
    """One per worker process."""
    return TextEncoder(path)


def text_parts(texts: list[str | None], most: int = PART):
    """``(start, end)`` of runs of rows with about ``most`` characters, one row at least."""
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)
