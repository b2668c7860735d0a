"""Token ids of whole texts by byte-level vocabularies of the tokenizers library, with a bounded cache of words."""

from __future__ import annotations

import json
import re
import struct
from functools import cache

import numpy as np
import regex

from callflow.llm.encoding import CACHED_UNITS, PART, UNUSUAL, Kept, byte_letters, load_tokenizer
from callflow.llm.shared import prefix_sums, spans_hash

#: The rule by which byte-level pre-tokenizers of the library cut text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_GAP, _SPACE, _BLANK, _LETTER, _DIGIT, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x09:0x0E] = _BLANK
_KIND[0x20] = _SPACE
_KIND[0] = _GAP  # between texts; usual text holds none

_WORD_END = re.compile(r"(?<=[^ \t-\r])[ \t-\r]")


def unit_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of usual texts that a zero byte parts.

    A unit is a run of letters, of digits or of others with one space before it, or a run of
    white space without the character that its follower needs: no word of the rule reaches
    across two units. A run between white space that holds an apostrophe or a sign beyond
    ASCII is one unit, as contractions and such signs take a closer look.
    """
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = _KIND[raw]
    solid = kind >= _LETTER
    white = (kind == _SPACE) | (kind == _BLANK)
    cut = kind[1:] != kind[:-1]
    odd = (raw == 0x27) | (raw == 0xC2)
    odd[:-1] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
    odd = np.flatnonzero(odd)
    if len(odd):
        edge = np.flatnonzero(np.diff(np.r_[False, solid, False].view(np.int8)))
        run = np.unique(np.searchsorted(edge, odd, "right") - 1)
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[edge[run]] += 1
        inside[edge[run + 1] - 1] -= 1
        cut &= np.cumsum(inside[:-1])[:-1] == 0
    # One space goes with what follows it; the last of several blanks stands apart if something follows.
    cut[white[:-1] & solid[1:]] = raw[:-1][white[:-1] & solid[1:]] != 0x20
    cut[white[:-1] & white[1:]] = False
    cut[:-1][white[:-2] & white[1:-1] & solid[2:]] = True
    at = np.flatnonzero(cut) + 1
    starts, ends = np.r_[0, at], np.r_[at, len(raw)]
    held = kind[starts] != _GAP
    return starts[held], ends[held]


class ByteEncoder:
    """Encodes whole texts by a byte-level file of the library, with the ids of words kept.

    New words of usual Latin text go to the library's model one by one; other texts, and
    files with a normaliser or another pre-tokenizer, go to the library whole.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"] or {}
        self.known = (
            spec["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("ignore_merges")
        )
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.letters = [letter for _, letter in sorted(byte_letters().items())]
        self.find = regex.compile(WORDS).findall
        self.tokenizer = load_tokenizer(path)
        self.units = Kept(CACHED_UNITS)

    def usual(self, text: str) -> bool:
        return self.known and not UNUSUAL.search(text) and not any(a in text for a in self.added)

    def _learn(self, units: list[bytes]) -> None:
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        for unit in units:
            ids = []
            for word in self.find(unit.decode()):
                ids += [t.id for t in tokenize("".join([letters[b] for b in word.encode()]))]
            self.units[unit] = struct.pack(f"<{len(ids)}I", *ids)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of usual texts."""
        data = b"\0".join([t.encode() for t in texts])
        raw = np.frombuffer(data, np.uint8)
        starts, ends = unit_bounds(raw)
        hashes = spans_hash(prefix_sums(raw), starts, ends)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        units = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        self._learn(self.units.missing(units))
        parts = [self.units[u] for u in units]
        flat = np.frombuffer(b"".join(parts), "<u4")
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        sources = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        upto = np.r_[0, np.cumsum(lengths)]
        ids = flat[np.repeat(sources[which] - upto[:-1], lengths) + np.arange(upto[-1])]
        begins = np.r_[0, np.flatnonzero(raw == 0) + 1, len(raw) + 1]
        bounds = upto[np.searchsorted(starts, begins)].tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _long(self, text: str) -> np.ndarray:
        """The ids of a long usual text, worked out in parts that end where a word does."""
        out, at = [], 0
        while at < len(text):
            found = _WORD_END.search(text, at + PART)
            end = found.start() if found else len(text)
            out.append(self._encode([text[at:end]])[0])
            at = end
        return np.concatenate(out)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        texts = [t or "" for t in texts]
        out: list[np.ndarray] = [np.empty(0, "<u4")] * len(texts)
        usual = [k for k, t in enumerate(texts) if self.usual(t)]
        short = [k for k in usual if len(texts[k]) <= 2 * PART]
        for k in set(usual) - set(short):
            out[k] = self._long(texts[k])
        for k, ids in zip(short, self._encode([texts[k] for k in short]) if short else (), strict=True):
            out[k] = ids
        others = sorted(set(range(len(texts))) - set(usual))
        found = self.tokenizer.encode_batch_fast([texts[k] for k in others], add_special_tokens=False) if others else ()
        for k, encoding in zip(others, found, strict=True):
            out[k] = np.array(encoding.ids, "<u4")
        return out


@cache
def byte_encoder(path: str) -> ByteEncoder:
    """One per worker process."""
    return ByteEncoder(path)
