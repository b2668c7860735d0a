"""The pipeline against what a plain reading of its stages keeps."""

import random

import public_tokenizers
import pytest

import corpus_pipeline
from callflow.llm.encoding import load_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def words(rng, n):
    return ["".join(rng.choice("abcdeinrst") for _ in range(rng.randint(2, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Documents by kind: what each stage must drop, cut or keep."""
    rng = random.Random(21)
    clean = [(k, " ".join(words(rng, 80))) for k in range(300)]
    passage = " ".join(words(rng, 60))
    near = list(words(rng, 200))
    changed = [*near[:50], "other", *near[51:]]
    toxic = []
    for k in range(300, 400):
        text = words(rng, 80)
        for _ in range(3):
            text[rng.randrange(80)] = rng.choice(["idiot", "trash", "moron", "scum"])
        toxic.append((k, " ".join(text)))
    bad = [(400, "too short"), (401, None), (402, ""), (403, "same words here " * 40),
           (404, " ".join(f"{w}%%% ###" for w in words(rng, 70)))]
    copies = [(500, " ".join(near)), (501, " ".join(changed)), (502, " ".join(near)), (502, " ".join(near))]
    halves = [" ".join(words(rng, 60)) for _ in range(4)]
    shared = [(600, f"{halves[0]} {passage} {halves[1]}"), (601, f"{halves[2]} {passage} {halves[3]}")]
    rows = [*clean, *toxic, *bad, *copies, *shared]
    rng.shuffle(rows)
    return {"rows": rows, "clean": clean, "toxic": toxic, "copies": copies, "shared": shared, "passage": passage}


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """The rows of each stage, run as the driver runs them."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in corpus["rows"]], schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in corpus["clean"][:250]] + [(i, 1, 1) for i, _ in corpus["toxic"][:80]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{number}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = (docs.columns, docs.collect())
    out["run"] = corpus_pipeline.run(spark, folder).collect()
    return out


def ids(stages, name):
    return sorted(r.doc_id for r in stages[name][1])


def test_columns_of_documents_stay(stages):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(stages[name][0] == names for name, _ in corpus_pipeline.STAGES[:-1])


def test_quality_drops_bad_documents_only(stages, corpus):
    good = [i for kind in ("clean", "toxic", "copies", "shared") for i, _ in corpus[kind]]
    assert ids(stages, "quality") == sorted(good)


def test_toxic_documents_go(stages, corpus):
    want = [i for kind in ("clean", "copies", "shared") for i, _ in corpus[kind]]
    assert ids(stages, "toxicity") == sorted(want)


def test_one_of_each_class_stays(stages, corpus):
    assert ids(stages, "near_duplicates") == sorted([*[i for i, _ in corpus["clean"]], 500, 600, 601])


def test_the_shared_passage_goes(stages, corpus):
    texts = {r.doc_id: r for r in stages["repeated_spans"][1]}
    assert sorted(texts) == ids(stages, "near_duplicates")
    for i, text in corpus["shared"]:
        assert corpus["passage"] not in texts[i].text
        # the space on either side repeats too
        assert texts[i].text == text.replace(f" {corpus['passage']} ", "")
    untouched = dict(corpus["clean"])
    assert all(texts[i].text == t for i, t in untouched.items())
    assert all(r.n_chars == len(r.text) for r in texts.values())


def test_every_token_is_packed(stages):
    library = load_tokenizer(PATH)
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in stages["repeated_spans"][1]}
    for rows in (stages["packing"][1], stages["run"]):
        got: dict[int, int] = {}
        for r in rows:
            got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert got == want
