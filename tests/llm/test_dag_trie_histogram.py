"""Planned packing, the Merkle manifest and the prefix trie against brute force, with odd rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from callflow.llm import byte_units, histogram_packing, merkle_manifest, prefix_trie
from callflow.llm.encoding import load_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return load_tokenizer(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_byte_encoder_equals_library(library):
    rng = random.Random(3)
    texts = [
        "", None, " ", "  a", " a\n\n b ", "it's don't I'LL 's ''s x''s  's", "a\t b", "\n x\n", "é×a « b", "12 345a6",
        "<|endoftext|> a", "中文 a", "a" * 500, "a\0b", "x y", "tab\t", "\r\n",
    ]
    texts += ["".join(rng.choice("ab'st .,1é×«  \n\t") for _ in range(30)) for _ in range(2000)]
    texts += ["".join(chr(rng.randrange(9, 0x250)) for _ in range(50)) for _ in range(300)]
    encoder = byte_units.ByteEncoder(PATH)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == ids_of(library, text), text


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice(["word", "it's", " ", "  ", "\n\n ", "é«", "42", "\t"]) for _ in range(3000))
    monkeypatch.setattr(byte_units, "PART", 150)
    encoder = byte_units.ByteEncoder(PATH)
    assert encoder.encode([text, None, "ab"])[0].tolist() == ids_of(library, text)


def best_fit_one_by_one(lengths, window):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= length
        else:
            rooms.append(window - length)
    return sorted(rooms)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=25))
def test_plan_equals_best_fit_decreasing(counts):
    window = 40
    used = collections.defaultdict(list)
    for length, first, ranks, sequence, per, base in histogram_packing.plan_slots(counts, window):
        for rank in range(first, first + ranks):
            nth = rank - first
            used[sequence + nth // per].append((base + nth % per * length, length, rank))
    seen = collections.Counter((length, rank) for rows in used.values() for _, length, rank in rows)
    assert seen == collections.Counter((n, r) for n, c in counts.items() for r in range(c))
    for rows in used.values():
        rows.sort()
        assert [r[0] for r in rows] == np.cumsum([0, *(r[1] for r in rows[:-1])]).tolist()
    lengths = [n for n, c in counts.items() for _ in range(c)]
    rooms = sorted(window - sum(r[1] for r in rows) for rows in used.values())
    assert rooms == best_fit_one_by_one(lengths, window)


def test_plan_is_bounded_by_the_window():
    rng = random.Random(2)
    for scale in (10**3, 10**9):
        counts = {n: rng.randrange(scale) for n in range(1, 2049)}
        runs = histogram_packing.plan_slots(counts)
        assert len(runs) < 40 * 2048
        assert sum(r[2] for r in runs) == sum(counts.values())


ROWS = [(i, t) for i, t in enumerate(
    ["", " ", "a b c", "hello world " * 300, "hello world " * 300, "x" * 9000, "é中" * 40, "short one", "<|endoftext|>"]
)] + [(None, None), (None, None), (3, None), (7, "again"), (7, "again"), *[(100 + k, "copy of a text") for k in range(40)]]


def test_op11_places_every_piece(spark, library, monkeypatch):
    monkeypatch.setattr(histogram_packing, "RANKS", 8)
    schema = "doc_id long, text string, part int, at long, length int, sequence_id long, ids string"
    documents = spark.createDataFrame([(i, t, 1, 2, 3, 4, "x") for i, t in ROWS], schema).repartition(4)
    window = 512
    got = histogram_packing.pack_documents(documents, PATH, window=window).collect()
    want, sizes = collections.Counter(), []
    for i, t in ROWS:
        ids = [*ids_of(library, t), 0]
        first = len(ids) % window or window
        cuts = [0, *range(first, len(ids) + 1, window)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want[(i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
            sizes.append(b - a)
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = collections.defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for rows in filled.values():
        rows.sort()
        assert [a for a, _ in rows] == np.cumsum([0, *(n for _, n in rows[:-1])]).tolist()
    assert sorted(window - sum(n for _, n in rows) for rows in filled.values()) == best_fit_one_by_one(sizes, window)
    whole = histogram_packing.sequences(documents, PATH, window=window).collect()
    assert {r.sequence_id: r.n_tokens for r in whole} == {s: sum(n for _, n in rows) for s, rows in filled.items()}
    by_id = {r.sequence_id: r.ids for r in whole}
    for r in got:
        part = by_id[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_over(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k : k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        begin = at // 3 * 3
        out.append(("".join(level[begin:at]), "".join(level[at + 1 : begin + 3])))
        at //= 3
    return out


def brute_proofs(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, row_digest(*row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda e: e[:3])
        trees[name] = levels_over([e[2] for e in groups[name]])
    top = levels_over([trees[name][-1][0] for name in names])
    root, out = top[-1][0], collections.Counter()
    for k, name in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(groups[name]):
            path = siblings(trees[name], at) + siblings(top, k)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = row_digest(*row[:4], text)
            for left, right in path:
                now = digest(left + now + right)
            proof = digest("".join(a + b for a, b in path))
            out[(row[0], leaf, trees[name][-1][0], root, proof, now, now == root)] += 1
    return out


def manifest_rows(n):
    rng = random.Random(n)
    rows = []
    for k in range(n):
        source = rng.choice(["a", "a", "a", "é", "zz", None, "", f"lone{k}" if k % 9 == 0 else "a"])
        text = rng.choice([None, "", "one\ntwo", "one two", "\n", "é\nü" * 50, "long " * 9000 + "\nend"])
        rows.append((rng.choice([k, k, k, None, 5]), source, rng.choice(["en", None]), rng.choice([k, None]), text))
    return rows + [rows[0]] * 7 + [(5, "a", "en", 1, "x\ny")] * 5


@pytest.mark.parametrize("n", [1, 2, 30, 120])
def test_op12_equals_brute_force(spark, n):
    rows = manifest_rows(n) if n > 2 else manifest_rows(n)[:n]
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree long, at long, leaf string, path string, n int"
    documents = spark.createDataFrame([(*r, 1, 2, "leaf", "p", 3) for r in rows], schema).repartition(3)
    got = merkle_manifest.document_proofs(documents).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_proofs(rows)


def test_manifest_proves_some_rows_and_is_saved(spark, tmp_path):
    rows = [r for r in manifest_rows(60) if r[0] is not None]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    documents = spark.createDataFrame(rows, schema)
    leaves = documents.withColumn("leaf", merkle_manifest.row_digest([merkle_manifest.F.col(c) for c in documents.columns]))
    manifest = merkle_manifest.build(leaves, "source", ["doc_id"])
    whole = {(r.tree, r.at): r for r in merkle_manifest.prove(manifest).collect()}
    some = merkle_manifest.prove(manifest, manifest.leaves.where("doc_id % 7 = 0")).collect()
    assert len(some) == sum(r[0] % 7 == 0 for r in rows) and len(whole) == len(rows)
    assert all(whole[(r.tree, r.at)] == r for r in some)
    manifest.save(str(tmp_path / "manifest"))
    records = spark.read.parquet(str(tmp_path / "manifest" / "records")).collect()
    assert len({(r.tree, r.level, bytes(r.digest)) for r in records}) == len(records)
    for r in records:
        assert digest("".join(bytes(c).hex() for c in r.children)) == bytes(r.digest).hex()
    assert any(bytes(r.digest) == manifest.root for r in records)


def brute_trie(rows):
    turns = collections.defaultdict(list)
    for conversation, turn, role, text in rows:
        if conversation is not None:
            role, text = role or "", text or ""
            tie = digest(f"{len(role.encode())}:{role}{text}")[:32]
            turns[conversation].append(((turn is not None, turn or 0, tie), role, text))
    own = {c: [e[1:] for e in sorted(v)] for c, v in turns.items()}
    sequences = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        sequences[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[sequences[c][:d]].append(c)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return collections.Counter(
        (
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
            digest(",".join(str(c) for c in members[p] if len(sequences[c]) == len(p))),
        )
        for p in members
    )


@pytest.mark.parametrize(("shard", "ends"), [(7, 2), (60, 3), (1 << 17, 1 << 16)])
def test_op13_equals_brute_force(spark, monkeypatch, shard, ends):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    rng = random.Random(shard)
    rows = [(None, 0, "u", "x"), (None, None, None, None)]
    for c in [*range(-103, -97), *range(-3, 50), *range(300, 390), 505]:
        for t in range(rng.choice([1, 2, 3, 8, 8, 12])):
            turn, text = rng.choice([t, t, t, None]), rng.choice(["", "x", "yé", None]) if t < 6 else "z"
            rows.append((c, turn, rng.choice(["u", None, "a"]), text))
    rows += [(44, t, "u", "long " * 5000 if t % 50 else "w") for t in range(400)]
    rows += [(c, t, "u", f"copy {t}") for c in range(1000, 1080) for t in range(6)]
    rows += rows[5:9]
    schema = "conv_id long, turn long, role string, text string, key string, base int, depth string, n_convs string"
    conversations = spark.createDataFrame([(*r, "k", 1, "d", "n") for r in rows], schema).repartition(4)
    got = prefix_trie.conversation_trie(conversations).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_trie(rows)


def test_ternary_tree_is_balanced_by_median_insertion():
    tree = prefix_trie.TernaryTree()
    for k in prefix_trie.median_order(1000):
        tree.insert([k])
    deepest, level = 0, [tree.down[0]]
    while level:
        deepest, level = deepest + 1, [c for v in level for c in (tree.low[v], tree.high[v]) if c]
    assert deepest == 10 and sorted(prefix_trie.median_order(1000)) == list(range(1000))
