"""Byte-pair encoding by a deterministic automaton over tokens, compiled from the merges."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callflow.llm.encoding import (
    CACHED_UNITS,
    PART,
    Kept,
    UsualText,
    distinct_units,
    load_tokenizer,
    text_cuts,
    text_parts,
)
from callflow.llm.shared import importable


class MergeAutomaton:
    """The deterministic automaton that accepts exactly the token sequences of BPE.

    State 0 is where a word begins; it has an arc for every symbol, as has the state that each
    symbol leads to. Each merge ``(u, v) -> w``, in order, adds a gadget: a new state that is a copy
    of the one ``v`` leads to, as it is then, an arc ``w`` to it from every state in which ``u`` and
    then ``v`` can be read, and the state behind ``u`` loses its arc ``v``. So the state after
    a token is known from the token, and states are numbered in the order of their gadgets.

    A copy shares what it was copied from: a state holds the number of its ``origin``, the gadget
    ``made`` that copied it, and ``lost``, the arcs that later gadgets took from it. A row of the
    transition table, ``table[state][token]`` to the next state or -1, is filled from these as tokens are
    met: with 49 thousand states written out it would take gigabytes. ``ARCS`` bounds the table.
    """

    ARCS = 400_000

    def __init__(self, merges: list[tuple[str, str]], vocabulary: dict[str, int], suffix: str = ""):
        self.suffix = suffix
        self.state_of: dict[int, int] = {}  # the state after each token
        self.label: dict[int, str] = {i: t for t, i in vocabulary.items()}
        # Of a state: the state it was copied from, the gadget that made it, and lost arcs with theirs.
        self.origin, self.made, self.lost = [-1], [-1], [{}]
        # Of a token: the merge that made it, and its first part.
        self.born: dict[int, int] = {}
        self.first: dict[int, int] = {}
        parts = {u + v for u, v in merges}
        for token, number in vocabulary.items():
            if token not in parts:
                self.state_of[number] = self._state(-1, -1)
        for rank, (u, v) in enumerate(merges):
            self._gadget(rank, vocabulary[u], vocabulary[v], vocabulary[u + v])
        # Labels as a tree, to read a word's tokens from any place on; a suffix ends a word.
        self.letters: dict = {}
        for token, number in vocabulary.items():
            ends = bool(suffix) and token.endswith(suffix)
            node = self.letters
            for letter in token[: len(token) - len(suffix)] if ends else token:
                node = node.setdefault(letter, {})
            if ends or not suffix:
                node["last"] = number
            if not ends:
                node["token"] = number
        self.table: list[dict[int, int]] = [{} for _ in self.origin]
        self.filled = 0

    def _state(self, origin: int, rank: int) -> int:
        self.origin.append(origin)
        self.made.append(rank)
        self.lost.append({})
        return len(self.origin) - 1

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if w in self.first:
            raise ValueError("two merges give one token")
        self.first[w] = u
        if u not in self.state_of or v not in self.state_of or not self._has(self.state_of[u], v):
            return  # earlier merges always part u from v: no path reads them, so no arc w is added
        self.born[w] = rank
        self.state_of[w] = self._state(self.state_of[v], rank)
        self.lost[self.state_of[u]][v] = rank

    def step(self, state: int, token: int) -> int:
        """The state that ``token`` leads to from ``state``, or -1: one entry of the table."""
        after = self.table[state].get(token)
        if after is None:
            if self.filled == self.ARCS:
                self.table, self.filled = [{} for _ in self.origin], 0
            found = token in self.state_of and self._has(state, token)
            after = self.table[state][token] = self.state_of[token] if found else -1
            self.filled += 1
        return after

    def _has(self, state: int, token: int) -> bool:
        """Whether the gadgets so far left the arc: a copy has what its origin had when it was made,
        and an arc ``w`` was only added where its first part could be read then."""
        until = 1 << 60  # of the states copied from, only what came before the copy counts
        while state > 0:
            part, begun = token, 1 << 60
            while part is not None:
                rank = self.lost[state].get(part)
                if rank is not None and rank < until and rank <= begun:
                    return False
                begun = self.born.get(part, -1)
                part = self.first.get(part) if begun >= 0 else None
            until, state = self.made[state], self.origin[state]
        return True

    def encode(self, word: str) -> list[int] | None:
        """The labels' numbers on the one path that spells the word; None if a symbol is unknown.

        ``word`` is a sequence of symbols of one character, the last with the suffix. What is read
        goes forward: exactly one path spells each prefix, so each place has one state at most, and
        the tokens that begin there are looked up in that state's row.
        """
        n, step = len(word), self.step
        states, came = [-1] * (n + 1), [None] * (n + 1)
        states[0] = 0
        for at in range(n):
            state, node = states[at], self.letters
            if state < 0:
                continue
            for to in range(at, n):
                node = node.get(word[to])
                if node is None:
                    break
                token = node.get("token" if to + 1 < n else "last")
                if token is not None and (after := step(state, token)) >= 0:
                    states[to + 1], came[to + 1] = after, (token, at)
        if states[n] < 0:
            return None
        out, at = [], n
        while at:
            token, at = came[at]
            out.append(token)
        return out[::-1]

    def decode(self, ids: list[int]) -> list[str]:
        """The labels of the arcs."""
        return [self.label[i] for i in ids]


class AutomatonTokenizer:
    """Whole texts to ids and back, for a tokenizer file with a BPE model.

    The file's normaliser and pre-tokenizer split the words; the automaton does the
    encoding. Words and chunks between ASCII white space are kept, up to a bound.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, tokenizer = spec["model"], load_tokenizer(path)
        if model["type"] != "BPE" or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("a BPE model without decoder and post-processor is needed")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = MergeAutomaton(merges, model["vocab"], model.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.normalize = tokenizer.normalizer.normalize_str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.label = self.automaton.label | {i: t for t, i in self.added.items()}
        self.usual = UsualText(path)
        self.words, self.units = Kept(CACHED_UNITS // 4), Kept(CACHED_UNITS)

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            ids = self.words[word] = self.automaton.encode(word) or []
        return ids

    def _plain(self, text: str) -> Iterator[int]:
        words = [w for w, _ in self.split(self.normalize(text))] if text else []
        for word in self.words.missing(list(set(words))):
            self._word(word)
        for word in words:
            yield from self._word(word)

    def encode(self, text: str) -> list[int]:
        """The ids of a text; added tokens are found in the raw text, as the library does."""
        out: list[int] = []
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                out.append(self.added[part])
            else:
                out.extend(self._plain(part))
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library without a decoder: the labels joined by spaces, added tokens included."""
        return " ".join(self.label[i] for i in ids)

    def _learn(self, units: list[bytes]) -> None:
        for unit in units:
            # A symbol that the vocabulary lacks is left out, as without unk_token.
            ids = [i for w in self.usual.words(unit) for i in self.automaton.encode(w) or []]
            self.units[unit] = (len(ids), " ".join(map(str, ids)), self.decode(ids))

    def _labels(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, ids and decoded text of usual texts."""
        units, which, begins = distinct_units([t.lower().encode() for t in texts])
        self._learn(self.units.missing(units))
        known = [self.units[u] for u in units]
        counts = np.r_[0, np.cumsum(np.array([k[0] for k in known], np.int64)[which])][begins]
        columns = [np.array([k[j] for k in known], object)[which] for j in (1, 2)]
        return [
            (int(n), *(" ".join([x for x in c[a:b].tolist() if x]) for c in columns))
            for n, a, b in zip(np.diff(counts), begins[:-1], begins[1:], strict=True)
        ]

    def digests(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Ids, SHA-256 of the decimal ids, SHA-256 of the decoded text of each; null is empty."""
        texts = [t or "" for t in texts]
        usual = [self.usual.holds(t) for t in texts]
        short = [u and len(t) <= 2 * PART for t, u in zip(texts, usual, strict=True)]
        together = iter(self._labels([t for t, s in zip(texts, short, strict=True) if s]))
        out = []
        for text, simple, is_short in zip(texts, usual, short, strict=True):
            if is_short:
                count, ids, decoded = next(together)
            elif simple:
                parts = [self._labels([p])[0] for p in text_cuts(text)]
                count = sum(p[0] for p in parts)
                ids, decoded = (" ".join([p[j] for p in parts if p[j]]) for j in (1, 2))
            else:
                found = self.encode(text)
                count, ids, decoded = len(found), " ".join(map(str, found)), self.decode(found)
            out.append((count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        return out


@cache
def automaton_tokenizer(path: str) -> AutomatonTokenizer:
    """Compiled once per worker process."""
    return AutomatonTokenizer(path)


def _digests(path: str):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = automaton_tokenizer(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            rows = [d for a, b in text_parts(texts) for d in tokenizer.digests(texts[a:b])]
            counts, ids, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digests


def _encoded(path: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = automaton_tokenizer(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for start, stop in text_parts(texts):
                ids = [tokenizer.encode(t or "") for t in texts[start:stop]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, stop - start),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([tokenizer.decode(i) for i in ids], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return encoded


def encode_documents(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids, decoded text. One pass without a shuffle; null text is empty."""
    importable(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_encoded(tokenizer), "doc_id long, ids array<int>, decoded string")


def document_digests(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what ``encode_documents`` gives.

    Rows of equal doc_id stay apart, null text is empty, a very long one is cut at white space,
    an empty table gives no rows, and other columns are not read.
    """
    importable(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(
        _digests(tokenizer), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
