"""Nulls, empty and very long texts, ties, repeated rows and clashing columns, against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from callflow.llm import (
    bpe_automaton,
    embedding_links,
    encoding,
    html_extraction,
    jaccard_join,
    quality_cascade,
    repeated_spans,
    sharding,
    token_files,
    toxicity_chain,
    window_packing,
)
from callflow.llm.encoding import TextEncoder, load_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
#: Columns whose names the operators use for results or inside.
CLASH = ["kept", "shard", "slot", "hash", "core", "spans", "_text", "toxic", "n_words", "set", "c0"]


def sentence(rng, words):
    return " ".join("".join(rng.choice("abcdeinrst") for _ in range(rng.randint(1, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    shared = sentence(rng, 70)
    base = sentence(rng, 300)
    near = base.split()
    near[100] = "changed"
    texts = [
        None, "", " \n\t", "one", "three words only", base, base, " ".join(near), base + " tail",
        f"{sentence(rng, 40)} {shared} {sentence(rng, 30)}", f"{shared}\n{sentence(rng, 60)}",
        "é" * 150 + " ünï cödé " + "é" * 150, "aaaa " * 200, "x" * 450, "y" * 199, "It's don't I'LL <|endoftext|> 42 中文",
        sentence(rng, 40_000), "\n".join(["same line of words here"] * 9 + [sentence(rng, 90)]), shared[:210],
        shared[:210] + shared[:210],
    ]
    ids = [*range(len(texts))]
    found = list(zip(ids, texts, strict=True))
    found += [(5, base), (5, base), (None, shared), (None, None), (7, "three words only")]
    return found


@pytest.fixture(scope="module")
def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in CLASH
    )
    data = [(i, t, "en", "s", len(t or ""), *CLASH) for i, t in rows]
    return spark.createDataFrame(data, schema).repartition(3)


def counted(values):
    return collections.Counter(values)


def test_encoder_equals_library(rows):
    rng = random.Random(5)
    texts = [t for _, t in rows] + [
        "".join(chr(rng.randrange(32, 0x250)) for _ in range(50)) for _ in range(300)
    ] + ["".join(rng.choice("ab'st .,1é×«") for _ in range(30)) for _ in range(300)]
    library = load_tokenizer(PATH)
    got = TextEncoder(PATH).encode(texts)
    automaton = bpe_automaton.AutomatonTokenizer(PATH)
    for text, ids in zip(texts, got, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want
        assert automaton.encode(text or "") == want
        assert automaton.decode(want) == library.decode(want, skip_special_tokens=False)


def test_long_texts_are_cut_at_white_space(monkeypatch):
    rng = random.Random(13)
    text = sentence(rng, 3000) + "\n\n" + "x" * 900 + " it's 42. " + sentence(rng, 50)
    want = library_ids(text)
    digest = bpe_automaton.AutomatonTokenizer(PATH).digests([text])
    for module in (encoding, bpe_automaton):
        monkeypatch.setattr(module, "PART", 200)
    assert "".join(encoding.text_cuts(text)) == text and len(encoding.text_cuts(text)) > 20
    assert [x.tolist() for x in TextEncoder(PATH).encode([text, None, "ab 中", "ab"])] == [
        want, [], library_ids("ab 中"), library_ids("ab")
    ]
    assert bpe_automaton.AutomatonTokenizer(PATH).digests([text]) == digest


def library_ids(text):
    return load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def test_op7_digests(documents, rows):
    library = load_tokenizer(PATH)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    got = bpe_automaton.document_digests(documents, PATH).collect()
    assert counted(tuple(r) for r in got) == counted(want)


def test_op5_files_are_in_order(documents, rows):
    got = sorted(tuple(r) for r in token_files.token_digests(documents, PATH).collect() for r in [r[1:] + r[:1]])
    at, ids_in_order = 0, []
    for start, n, _, doc in got:
        assert start == at
        at += n
        ids_in_order.append(-1 if doc is None else doc)
    assert ids_in_order == sorted(ids_in_order)
    want = counted((i, zlib.crc32(np.array([*library_ids(t), 1], "<u4").tobytes())) for i, t in rows)
    assert counted((d, c) for _, _, c, d in got) == want


@pytest.mark.parametrize("width", [1, 7, 8, 13, 16, 17, 31, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1003, dtype=np.uint64)
    packed = token_files.pack_bits(ids, width)
    assert len(packed) == width * -(-1003 // 8)
    assert (token_files.unpack_bits(packed, width, 1003) == ids).all()
    with pytest.raises(ValueError):
        token_files.pack_bits(np.array([1 << width]), width)


def test_token_file_random_access(tmp_path):
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 49408, n).astype(np.uint32) for n in (0, 5, 200_000, 1, 65_536, 3)]
    writer = token_files.TokenFileWriter(str(tmp_path / "a.tok"), 16)
    for k, ids in enumerate(documents):
        writer.add(None if k == 1 else k, ids)
    writer.close()
    file = token_files.TokenFile(str(tmp_path / "a.tok"))
    assert file.documents == [0, None, 2, 3, 4, 5]
    for k in (5, 2, 0, 4, 1, 3):
        assert (file.document(k) == documents[k]).all()


def test_op4_places_every_token_once(documents, rows):
    got = window_packing.pack_documents(documents, PATH).collect()
    windows = collections.defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    lengths = collections.Counter()
    for r in got:
        lengths[r.doc_id] += r.length
    want = collections.Counter()
    for i, t in rows:
        want[i] += len(library_ids(t)) + 1
    assert lengths == want
    total = sum(want.values())
    assert len(windows) <= total // 4096 + 3


def test_sum_of_squares_rule():
    packer = window_packing.SumOfSquares(10)
    rng = random.Random(0)
    levels = collections.Counter()
    for _ in range(500):
        size = rng.randint(1, 9)
        costs = {}
        for level in [0, *[h for h, n in levels.items() if n]]:
            if level + size <= 10:
                after = levels.copy()
                after[level] -= level > 0
                after[level + size] += level + size < 10
                costs[level] = sum(n * n for n in after.values())
        best = max(h for h, c in costs.items() if c == min(costs.values()))
        assert packer.place(size)[1] == best
        levels[best] -= best > 0
        levels[best + size] += best + size < 10


def test_sequences_hold_the_ids(documents, rows):
    got = window_packing.sequences(documents.where("doc_id = 16 OR doc_id = 3"), PATH).collect()
    tokens = sum(r.n_tokens for r in got)
    assert tokens == sum(len(library_ids(t)) + 1 for i, t in rows if i in (3, 16))
    assert all(len(r.ids) == 4096 for r in got)


def test_op8_shards(documents, rows):
    got = sharding.shard_documents(documents, 4).collect()
    want = counted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert counted((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    homes = collections.defaultdict(set)
    for r in got:
        assert 0 <= r.shard < 4 and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        homes[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_op8_near_equal_with_a_group_larger_than_a_shard(spark):
    texts = ["copy of a text"] * 900 + [f"text {k} " * (k % 7 + 1) for k in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard_documents(df, 8).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.03 * max(sizes)


def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 100) for _ in range(400)), reverse=True)
    rooms, want = [], []
    for size in sizes:
        fits = [(room, k) for k, room in enumerate(rooms) if room >= size]
        if fits:
            k = min(fits)[1]
            rooms[k] -= size
        else:
            k = len(rooms)
            rooms.append(120 - size)
        want.append(k)
    got = sharding.best_fit(sizes, 120)
    assert len(set(got)) == len(rooms) and collections.Counter(got).keys() == collections.Counter(want).keys()
    filled = collections.Counter()
    for k, size in zip(got, sizes, strict=True):
        filled[k] += size
    assert max(filled.values()) <= 120


def brute_spans(rows):
    texts = [(t or "").encode() for _, t in rows]
    starts = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if starts[t[i : i + 200]] > 1:
                covered[i : i + 200] = True
        edges = np.flatnonzero(np.diff(np.r_[0, covered.astype(int), 0]) == 1)
        kept = np.frombuffer(t, np.uint8)[~covered].tobytes()
        out.append((len(t), int(covered.sum()), len(edges), kept))
    return out


def test_op9_spans(documents, rows):
    want = [(r[0], *b[:3], hashlib.sha256(b[3]).hexdigest()) for r, b in zip(rows, brute_spans(rows), strict=True)]
    assert counted(tuple(r) for r in repeated_spans.span_digests(documents).collect()) == counted(want)


def test_op9_equal_strings_share_refined_buckets():
    rng = random.Random(3)
    data = (sentence(rng, 300) + "a" * 900 + "xy" * 400 + sentence(rng, 200)).encode() * 2
    buckets = repeated_spans.gram_buckets(repeated_spans.prefix_sums(np.frombuffer(data, np.uint8)))
    known = {}
    for length in (32, 33, 64, 65, 128, 185, 200, 215, 256, 257, 368):
        at = np.arange(len(data) - length + 1)
        for start, name in zip(at.tolist(), repeated_spans.refined(buckets, at, length).tolist(), strict=True):
            assert known.setdefault(data[start : start + length], name) == name
    assert len(set(known.values())) == len(known)
    mixed = np.array([200, 368, 256, 257, 64])
    got = repeated_spans.refined(buckets, np.full(5, 7), mixed)
    assert got.tolist() == [known.get(data[7 : 7 + n]) for n in mixed.tolist()]


def test_op9_long_texts_in_parts(spark, monkeypatch):
    rng = random.Random(8)
    passage = sentence(rng, 400)
    rows = [(1, sentence(rng, 3000) + passage + sentence(rng, 500)), (2, passage[100:1500]), (3, "ab" * 700)]
    want = [[x.tolist() for x in part] for part in repeated_spans.text_segments(rows[0][1].encode())]
    monkeypatch.setattr(repeated_spans, "PART_WINDOWS", 1000)
    parts = list(repeated_spans.text_segments(rows[0][1].encode()))
    covered = [w for p in parts for s, m in zip(p[2], p[3], strict=True) for w in range(s, s + m + 1)]
    assert len(parts) > 1 and covered == list(range(len(rows[0][1].encode()) - 199)) and len(want) == 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeated_spans.span_digests(df).collect()}
    assert got == {r[0]: b[1] for r, b in zip(rows, brute_spans(rows), strict=True)}


def test_op9_documents_keep_columns_and_rows(documents, rows):
    out = repeated_spans.remove_repeats(documents)
    assert out.columns == documents.columns
    got = counted((r.doc_id, r.text) for r in out.collect())
    want = counted(
        (i, None if t is None else b[3].decode(errors="ignore"))
        for (i, t), b in zip(rows, brute_spans(rows), strict=True)
    )
    assert got == want


def brute_near(rows):
    sets = []
    for _, t in rows:
        words = (t or "").encode().split()
        k = min(5, len(words))
        sets.append({tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set())
    links = [
        {y for y in range(len(sets)) if y != x and sets[x] and sets[y]
         and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
        for x in range(len(sets))
    ]
    classes = []
    for x in range(len(sets)):
        seen, todo = {x}, [x]
        while todo:
            for y in links[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        named = [rows[y][0] for y in seen if rows[y][0] is not None]
        classes.append(min(named) if named else None)
    return links, classes


def test_op2_links(documents, rows):
    got = jaccard_join.near_duplicates(documents).collect()
    links, classes = brute_near(rows)
    want = counted((r[0], c, len(k)) for r, c, k in zip(rows, classes, links, strict=True))
    assert counted((r.doc_id, r.class_id, r.n_links) for r in got) == want
    linked = collections.Counter(r.class_id for r in got if r.kept and r.n_links)
    assert linked and set(linked.values()) == {1}
    assert all(r.kept for r in got if not r.n_links)


def test_op2_large_buckets_are_split(spark, monkeypatch):
    rng = random.Random(2)
    base = sentence(rng, 120).split()
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, sentence(rng, 80)) for k in range(60)]
    for name, value in (("SMALL", 4), ("DEPTH", 2), ("BLOCK_ROWS", 7)):
        monkeypatch.setattr(jaccard_join, name, value)
    links, classes = brute_near(rows)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {r[0]: (c, len(k)) for r, c, k in zip(rows, classes, links, strict=True)}
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == want


def test_op2_keep_one(documents, rows):
    out = jaccard_join.keep_one(documents)
    assert out.columns == documents.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    texts = [t for _, t in kept if t and t.split()]
    assert len(texts) == len(set(texts))
    assert sum(1 for _, t in kept if not (t or "").split()) == sum(1 for _, t in rows if not (t or "").split())


def test_op10_links(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    vectors = [*base.tolist(), *(base[:20] + 0.05 * rng.standard_normal((20, 16))).tolist(), *base[:5].tolist(),
               (base[0] * 7).tolist(), None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [1.0, 2.0], [2.0, 4.0],
               [float("inf")] * 16, [1e-200] * 4, [2e200] * 4]
    ids = [*range(len(vectors) - 1), None]
    df = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>, kept int, root string"
    )
    units = [embedding_links._unit(x) if (x := embedding_links._raw(v)) is not None else None for v in vectors]
    links = [
        {y for y in range(len(units)) if y != x and units[x] is not None and units[y] is not None
         and len(units[x]) == len(units[y]) and units[x] @ units[y] >= 0.95}
        for x in range(len(units))
    ]
    got = embedding_links.link_vectors(df).collect()
    want = []
    for x, i in enumerate(ids):
        seen, todo = {x}, [x]
        while todo:
            for y in links[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        named = [ids[y] for y in seen if ids[y] is not None]
        want.append((i, len(links[x]), min(named) if named else None))
    assert counted((r.vec_id, r.n_links, r.component_id) for r in got) == counted(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_op10_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_links, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(5)
    base = rng.standard_normal(8)
    rows = [(k, (base + 0.02 * rng.standard_normal(8)).tolist()) for k in range(40)]
    got = embedding_links.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(39, 0)}


def test_op3_order_changes_no_verdict(documents, rows):
    got = quality_cascade.judge(documents.select("doc_id", "text"), ["doc_id"]).collect()
    turned = quality_cascade.judge(documents.select("doc_id", "text"), ["doc_id"], quality_cascade.RULES[::-1]).collect()
    assert counted((r.doc_id, r.kept) for r in got) == counted((r.doc_id, r.kept) for r in turned)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.rejected_by is None) and (not r.base_failed or not r.kept)
    out = quality_cascade.keep_good(documents)
    assert out.columns == documents.columns
    assert counted(r.doc_id for r in out.collect()) == counted(r.doc_id for r in got if r.kept)


def test_op3_repeated_words():
    rng = random.Random(6)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 25))]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        held = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert quality_cascade.repeated_words(words) == len(held)


def test_op3_rules_that_reject_more_per_second_come_first(spark):
    rules = [
        quality_cascade.Rule("never", lambda t, b: False),
        quality_cascade.Rule("slow", lambda t, b: sum(range(50_000)) > 0),
        quality_cascade.Rule("fast", lambda t, b: True),
    ]
    text = " ".join(f"word{k}" for k in range(60))
    df = spark.createDataFrame([(k, text) for k in range(400)], "doc_id long, text string")
    assert [r.name for r in quality_cascade.order_rules(df, rules)] == ["fast", "slow", "never"]


def toxic_rows(rng, n):
    bad = ["idiot", "trash", "scumlike", "scumbags", "worthless"]
    rows = []
    for k in range(n):
        words = sentence(rng, 60).split()
        toxic = k % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(bad)
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_op6_held_out_accuracy(spark):
    rows = toxic_rows(random.Random(7), 1000)
    rows += [(2000, None, 0), (2001, "", 0)]
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = [(i, 1, t) for i, _, t in rows[:600]] + [(None, 1, 1), (3, None, None), (0, 1, 0), (9999, 0, 1)]
    got = toxicity_chain.document_toxicity(
        documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ).collect()
    verdict = {r.doc_id: r.toxic for r in got}
    assert len(got) == len(rows)
    assert all(verdict[i] == bool(t) for i, _, t in rows)
    assert all(r.kept != r.toxic for r in got)


def test_op6_without_labels_keeps_all(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity_chain.keep_clean(documents, none)
    assert out.columns == documents.columns and out.count() == documents.count()


def test_op6_labels_of_other_documents_take_no_place(spark):
    rows = toxic_rows(random.Random(7), 600)
    documents = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = [(i, bad) for i, _, bad in rows[:300]] + [(i, i % 2) for i in range(10_000, 30_000)]
    chain = toxicity_chain.train(documents, spark.createDataFrame(labels, "doc_id long, toxic int"), rows=300)
    assert chain.weights == (1.0, 1.0)
    wrong = [i for i, t, bad in rows[300:] if (chain.probabilities(t)[-1] >= chain.threshold) != bool(bad)]
    assert len(wrong) <= 6


def test_op6_rare_toxic_documents_are_in_the_sample(spark):
    rows = toxic_rows(random.Random(7), 3000)
    rows = [r for r in rows if not r[2] or r[0] < 100]  # 20 of 2,420
    documents = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id long, toxic int")
    chain = toxicity_chain.train(documents, labels, rows=200)
    assert chain.weights == (1.0, 2400 / 180)
    caught = [chain.probabilities(t)[-1] >= chain.threshold for _, t, bad in rows if bad]
    assert sum(caught) >= 18
    assert not toxicity_chain.train(documents, labels.where("toxic = 0"), rows=200)
    # A document as likely toxic as not in the sample is less likely so among all.
    assert toxicity_chain.among_all([0.25, 0.5], (1.0, 3.0)) == [0.125, 0.25]


def test_op6_one_row_of_an_id_is_in_the_sample(spark, monkeypatch):
    rows = toxic_rows(random.Random(7), 900)
    ids = [0 if k % 3 == 0 else k for k in range(900)]
    documents = [(i, t) for i, (_, t, _) in zip(ids, rows, strict=True)] + [(0, None), (1, None)]
    labels = spark.createDataFrame([(i, rows[i][2]) for i in set(ids)], "doc_id long, toxic int")
    seen = []
    fit = toxicity_chain.fit_chain
    monkeypatch.setattr(toxicity_chain, "fit_chain", lambda w, f, *a, **b: seen.append((w, f)) or fit(w, f, *a, **b))
    for order in (documents, documents[::-1]):
        toxicity_chain.train(spark.createDataFrame(order, "doc_id long, text string").repartition(5), labels)
    assert [len(f) for _, f in seen] == [len(set(ids))] * 2
    assert seen[0][0] == seen[1][0] and [set(x) for x in seen[0][1]] == [set(x) for x in seen[1][1]]


def test_op6_links_see_only_out_of_fold_probabilities():
    rng = np.random.default_rng(1)
    features = [[int(x)] for x in rng.integers(0, 2, 400)]
    first = np.array([f[0] == 0 for f in features])
    chain = toxicity_chain.fit_chain(["a", "b"], features, {"one": first, "two": first})
    assert [name for name, _ in chain.links] == ["one", "two"]
    assert len(chain.links[1][1].dense) == 1
    assert chain.probabilities("a")[1] > 0.9 > 0.1 > chain.probabilities("b")[1]


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body><nav><ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy it now.</div><article><h1>A title &amp; more</h1><p><b>First   paragraph
of the article&nbsp;here.<br><p>Second &lt;paragraph&gt; of it, a little longer.</p><p>Third one.</article>
<footer>&copy; someone</footer></body></html>"""


def test_op1_pages(spark):
    rng = random.Random(9)
    rows = [(k, "u", PAGE.replace("Third one.", sentence(rng, 30))) for k in range(30)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "no tags at all"), (103, "u", PAGE), (103, "u", PAGE),
             (None, "u", "<p" + "<" * 50), (104, "u", "<article>" + "<p>word here.</p>" * 20_000 + "</article>")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = collections.defaultdict(list)
    for r in html_extraction.extract_pages(df).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    want = (
        "A title & more\nFirst paragraph of the article here.\nSecond <paragraph> of it, a little longer.\nThird one."
    )
    assert got[103] == [want, want]
    assert got[100] == got[101] == [""]
    assert all(got[k][0].startswith(want.rsplit("\n", 1)[0]) for k in range(30))
    assert got[104][0].count("\n") > 19_000


def test_op1_held_out_pages():
    rng = random.Random(11)
    sources = [PAGE.replace("Third one.", sentence(rng, 30) + ".") for _ in range(40)]
    model = html_extraction.train_labeller(sources)
    pages, labels = html_extraction.labelled(sources, made=150, seed=99)
    found = model.probabilities([html_extraction.page_features(p) for p in pages])
    wrong = sum(((f >= 0.5) != y).sum() for f, y in zip(found, labels, strict=True))
    assert wrong < 0.04 * sum(map(len, labels))


def test_op1_parts_inside_an_article_are_not_taught_as_text():
    rng = random.Random(12)
    parts = ["<section class='comments'><article>{}</article></section>", "<div class='ad'>{}</div>", "<nav>{}</nav>",
             "<div><aside><div>{}</div></aside></div>", "<form>{}</form>", "<footer>{}</footer>"]

    def page(k):
        part = parts[k % len(parts)].format("<p>Buy this now. Call us today.</p>")
        return PAGE.replace("<p>Third one.", f"<header><p>{sentence(rng, 30)}.</p></header>{part}<p>Third one.")

    sources = [page(k) for k in range(80)]
    for k, known in enumerate([0, -1, 0, 0, 0, -1]):
        labels = html_extraction.labelled([sources[k]], made=0)[1][0].tolist()
        assert [x for x in labels if x != 0] == [1] * 4 + [known] * (known != 0) + [1]
    model = html_extraction.train_labeller(sources)
    for k in range(80, 92):
        blocks = html_extraction.page_blocks(page(k))
        text = html_extraction.main_text(blocks, model.probabilities([html_extraction.page_features(blocks)])[0])
        assert "Third one." in text and "Buy this" not in text


def test_op1_network_gradients():
    model = html_extraction.BlockLabeller(inputs=5, hidden=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rng = np.random.default_rng(0)
    x, lengths = html_extraction._padded([rng.standard_normal((n, 5)) for n in (4, 2)])
    x = x.astype(np.float64)
    mask = np.arange(len(x))[:, None] < lengths

    def loss():
        return float((model._both(x, lengths)[0] * mask).sum())

    logits, states, turned, ahead, back = model._both(x, lengths)
    d = mask[:, :, None] * model.weights["out"][:, 0]
    grads = {}
    model._back("forward", x, ahead, d[:, :, :3], grads)
    model._back("backward", turned, back, model._turned(d[:, :, 3:], lengths), grads)
    for name in ("forward", "backward"):
        for place in ((0, 0), (6, 5), (3, 10)):
            model.weights[name][place] += 1e-3
            up = loss()
            model.weights[name][place] -= 2e-3
            slope = (up - loss()) / 2e-3
            model.weights[name][place] += 1e-3
            assert abs(slope - grads[name][place]) < 1e-3


def test_op2_bound_and_runs_follow_from_the_recall():
    rng = np.random.default_rng(5)
    for similarity in (0.5, 0.65, 0.8, 0.95):
        for recall in (0.9, 0.999):
            bound, runs = jaccard_join.sketch_bound(similarity, recall), jaccard_join.runs_for(similarity, recall)
            agreeing = rng.binomial(jaccard_join.COORDINATES, similarity, 200_000)
            met = 1 - (1 - np.array([jaccard_join.run_recall(k / 64) for k in range(65)])[agreeing]) ** runs
            assert recall - 0.002 < (met * (agreeing >= bound)).mean()
    assert jaccard_join.sketch_bound(0.8, 0.99999) == 33 and jaccard_join.runs_for(0.8, 0.99999) == 12
    assert jaccard_join.sketch_bound(0.5, 0.99) < 20


def test_op2_low_similarity_loses_no_link(spark):
    rng = random.Random(17)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.sample(range(120), 7):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{tuple(t.split()[j : j + 5]) for j in range(116)} for _, t in rows]
    for similarity in (0.35, 0.45):
        near = [[len(a & b) >= similarity * len(a | b) - 1e-9 for b in sets] for a in sets]
        want = {k: sum(near[k]) - 1 for k in range(60)}
        assert 0 < sum(want.values()) < 60 * 59
        got = jaccard_join.near_duplicates(df, similarity=similarity, recall=0.99)
        assert {r.doc_id: r.n_links for r in got.collect()} == want
