"""Toxicity by a chain of linear classifiers over words, trained on labelled documents."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.llm.shared import importable, small_slices
from callflow.session import written

#: Labelled documents that the chain is fitted on, at most; half of each kind where both abound.
LABELLED_ROWS = 20_000
#: Words and stems that it uses stand so many standard deviations more often in documents of a kind
#: than in the others; there is no bound on their number.
BAR = 4.0
#: Letters of the beginnings that count as stems, written with a star.
STEMS = (4, 5, 6)
#: Toxic documents of the sample that a word must occur in.
LEAST_TOXIC = 3
FOLDS = 3

#: Kinds that toxic documents of the sample are clustered into.
KINDS = 3
#: The links in their order: documents labelled of low quality, the kinds of toxic documents, and the label itself.
LOW, LAST = "low_quality", "toxic"
NAMES = [LOW, *[f"kind_{k + 1}" for k in range(KINDS)], LAST]
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def with_stems(words: set[str]) -> set[str]:
    """The words, and the beginnings of longer ones: inflected words share a stem."""
    return words | {w[:k] + "*" for k in STEMS for w in words if len(w) > k}


@dataclass
class Linear:
    """Logistic regression over word sets and a few dense inputs, with an L1 penalty."""

    weights: np.ndarray
    dense: np.ndarray
    bias: float

    def margin(self, features: list[int], dense: list[float]) -> float:
        return self.bias + float(self.weights[features].sum()) + float(self.dense @ np.array(dense))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_linear(
    rows: np.ndarray, columns: np.ndarray, dense: np.ndarray, labels: np.ndarray, width: int,
    penalty: float = 2e-5, steps: int = 200,
) -> Linear:
    """Accelerated proximal gradient on the mean log loss; ``rows, columns`` are the set bits."""
    n, extra = dense.shape
    held = np.bincount(columns, minlength=width)
    # The curvature is a quarter of the largest eigenvalue of the mean outer product of rows.
    v, norm = np.ones(width + extra + 1), 1.0
    for _ in range(12):
        z = np.bincount(rows, v[columns], n) + dense @ v[width:-1] + v[-1]
        v = np.r_[np.bincount(columns, z[rows], width), dense.T @ z, z.sum()] / n
        norm = np.sqrt(v @ v)
        v /= norm
    rate = 4.0 / (1.1 * norm)
    x = np.zeros(width + extra + 1)
    rate_of = np.log((labels.mean() + 1e-6) / (1 - labels.mean() + 1e-6))
    x[-1] = rate_of
    y, t = x.copy(), 1.0
    for _ in range(steps):
        z = np.bincount(rows, y[columns], n) + dense @ y[width:-1] + y[-1]
        error = (sigmoid(z) - labels) / n
        gradient = np.r_[np.bincount(columns, error[rows], width), dense.T @ error, error.sum()]
        new = y - rate * gradient
        shrunk = np.sign(new[:width]) * np.maximum(np.abs(new[:width]) - rate * penalty, 0)
        new[:width] = np.where(held > 0, shrunk, 0)
        faster = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / faster * (new - x)
        x, t = new, faster
    return Linear(x[:width], x[width:-1], float(x[-1]))


@dataclass
class Chain:
    """One classifier per category in order; each sees the probabilities of those before it."""

    words: dict[str, int]
    links: list[tuple[str, Linear]]
    threshold: float = 0.5
    #: Labelled documents that a toxic and a clean one of the sample stand for.
    weights: tuple[float, float] = (1.0, 1.0)

    def __post_init__(self):
        # Any feature of a word begins with the word's first letters.
        self.begins = {w.rstrip("*")[: min(STEMS)] for w in self.words}

    def probabilities(self, text: str | None) -> list[float]:
        least = min(STEMS)
        near = {w for w in words_of(text) if w[:least] in self.begins}
        features = [self.words[w] for w in with_stems(near) & self.words.keys()]
        before: list[float] = []
        for _, link in self.links:
            before.append(float(sigmoid(link.margin(features, before))))
        return among_all(before, self.weights)


def among_all(probabilities: list[float], weights: tuple[float, float]) -> list[float]:
    """Probabilities in the sample, the last that of a toxic document, as those among all labelled."""
    toxic, clean = weights
    if toxic == clean:
        return probabilities
    last = probabilities[-1]
    rest = last * toxic + (1 - last) * clean
    # Low quality, where it is a link, is no part of toxic: it stays as it is.
    whole = len(probabilities) - len(NAMES) + 1 if len(probabilities) == len(NAMES) else 0
    return [p if k < whole else min(1.0, p * toxic / rest) for k, p in enumerate(probabilities)]


def kinds_of(rows: np.ndarray, columns: np.ndarray, n: int, width: int, toxic: np.ndarray, kinds: int = KINDS):
    """A function that clusters the toxic documents of some rows, and tells the kind of any document or -1.

    Spherical k-means over the features that a document holds, from seeds that lie far apart. What
    is clustered inside a fold starts from the centres over all rows, so that kinds keep their numbers.
    """
    size = np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
    value = 1 / size[rows]

    def towards(centre: np.ndarray) -> np.ndarray:
        return np.bincount(rows, value * centre[columns], n)

    def mean_of(chosen: np.ndarray) -> np.ndarray:
        held = chosen[rows]
        total = np.bincount(columns[held], value[held], width)
        return total / max(1e-12, np.sqrt(total @ total))

    def cluster(inside: np.ndarray, centres: list[np.ndarray] | None) -> tuple[np.ndarray, list[np.ndarray]]:
        some = toxic & inside
        if centres is None:
            centres = [mean_of(some)]
            nearest = np.full(n, -np.inf)
            for _ in range(kinds):
                nearest = np.maximum(nearest, towards(centres[-1]))
                far = np.where(some & (size > 1), nearest, np.inf)
                first = np.zeros(n, bool)
                first[int(np.argmin(far))] = True
                centres.append(mean_of(first))
            centres = centres[1:]
        kind = np.zeros(n, int)
        for _ in range(10):
            kind = np.argmax(np.column_stack([towards(c) for c in centres]), axis=1)
            centres = [mean_of(some & (kind == k)) if (some & (kind == k)).any() else c for k, c in enumerate(centres)]
        return np.where(toxic, kind, -1), centres

    everything, shared = cluster(np.ones(n, bool), None)

    def kind(inside: np.ndarray) -> np.ndarray:
        return everything if inside.all() else cluster(inside, shared)[0]

    return kind


def fit_chain(
    words: list[str], features: list[list[int]], labels: dict[str, np.ndarray | Callable], folds: int = FOLDS,
    weights: tuple[float, float] = (1.0, 1.0),
) -> Chain:
    """Fit the links in the order of ``labels``; ``weights`` count for the threshold and the probabilities.

    The links are fitted on the sample as it is: weighted by kind, the loss of rare toxic documents
    would vanish beside the penalty.
    What a later link learns from are out-of-fold probabilities of the earlier ones: a
    document's own label never made the probability that it is trained with. A label that is a function gives the
    targets as far as the rows inside a mask tell.
    """
    n = len(features)
    rows = np.repeat(np.arange(n), [len(f) for f in features])
    columns = np.array([c for f in features for c in f], np.int64)
    fold = np.arange(n) % folds
    dense = np.zeros((n, 0))
    links = []
    everything = np.ones(n, bool)
    for name, label in labels.items():
        target_of = label if callable(label) else lambda _, label=label: label
        target = target_of(everything).astype(np.float64)
        links.append((name, fit_linear(rows, columns, dense, target, len(words))))
        outside = np.zeros(n)
        for k in range(folds):
            inside = fold != k
            place = np.cumsum(inside) - 1
            bits = inside[rows]
            known = target_of(inside)[inside].astype(np.float64)
            part = fit_linear(place[rows[bits]], columns[bits], dense[inside], known, len(words))
            z = np.bincount(rows, part.weights[columns], n) + dense @ part.dense + part.bias
            outside[~inside] = sigmoid(z[~inside])
        dense = np.column_stack([dense, outside])
    threshold = best_threshold(dense[:, -1], target, weights)
    return Chain({w: i for i, w in enumerate(words)}, links, among_all([threshold], weights)[0], weights)


def chain_labels(features: list[list[int]], width: int, low: np.ndarray, toxic: np.ndarray) -> dict:
    """The targets of the links: low quality, each kind of toxic documents, toxic."""
    n = len(features)
    rows = np.repeat(np.arange(n), [len(f) for f in features])
    columns = np.array([c for f in features for c in f], np.int64)
    kind = kinds_of(rows, columns, n, width, toxic)
    found: dict[str, np.ndarray | Callable] = {LOW: low}
    for k, name in enumerate(NAMES[1:-1]):
        found[name] = lambda inside, k=k: kind(inside) == k
    return found | {LAST: toxic}


def best_threshold(
    probabilities: np.ndarray, target: np.ndarray, weights: tuple[float, float] = (1.0, 1.0)
) -> float:
    """Where out-of-fold probabilities part best (F1), halfway in log odds to the next one below."""
    order = np.argsort(-probabilities, kind="stable")
    sorted_p = probabilities[order]
    toxic, clean = weights
    hits = np.cumsum(target[order]) * toxic
    misses = np.cumsum(1 - target[order]) * clean
    last = np.r_[sorted_p[1:] != sorted_p[:-1], True]
    score = np.where(last, 2 * hits / (hits + misses + target.sum() * toxic), -1)
    best = int(np.argmax(score))
    pair = np.clip([sorted_p[best], sorted_p[best + 1] if best + 1 < len(order) else 0.0], 1e-6, 1 - 1e-6)
    return float(sigmoid(np.log(pair / (1 - pair)).mean()))


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_slices(batches, "text"):
        yield pa.RecordBatch.from_arrays(
            [
                batch["_doc"],
                batch["_toxic"],
                batch["_low"],
                pa.array([sorted(with_stems(words_of(t))) for t in batch["text"].to_pylist()], pa.list_(pa.string())),
            ],
            names=["doc_id", "toxic", "low", "words"],
        )


def _excess(of: Column, of_all: int, others: Column, others_all: int) -> Column:
    """How many standard deviations a word is more frequent in some documents than in the others."""
    rate = (of + others) / (of_all + others_all)
    spread = rate * (1 - rate) * (1 / max(1, of_all) + 1 / max(1, others_all))
    return (of / max(1, of_all) - others / max(1, others_all)) / F.sqrt(spread + 1e-12)


def train(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Chain | None:
    """The chain for labelled ``documents``; None if no toxic or no clean one is among them.

    ``labels(doc_id, toxic, quality)``, quality if there is one: rows without id or toxic are left out, as are
    those of ids that ``documents`` does not hold, and of several for a document the toxic one and the low quality
    hold. The sample is, of each kind, the ids with the
    least hash, half of ``rows`` or what the other kind leaves, so it is the same in any
    run; of several rows of an id it holds the text with the least hash. Its words are counted by Spark. Those that
    stand ``BAR`` standard deviations more often in toxic documents than in clean ones, or in low ones than in others,
    are the features; they and which documents hold them are collected, which the sample bounds.
    """
    importable(documents.sparkSession)
    present = documents.select(F.col("doc_id").cast("long").alias("_doc")).distinct()
    low = F.coalesce(F.col("quality") == 0, F.lit(False)) if "quality" in labels.columns else F.lit(False)
    labelled = written(
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("_doc"))
        .agg(F.max("toxic").cast("int").alias("_toxic"), F.max(low).alias("_low"))
        .join(present, "_doc", "left_semi"),
        "labels",
    )
    kinds = {r.bad: r["count"] for r in labelled.groupBy((F.col("_toxic") != 0).alias("bad")).count().collect()}
    if len(kinds) < 2:
        return None
    drawn = {bad: min(n, max(1, rows // 2, rows - kinds[not bad])) for bad, n in kinds.items()}
    chosen = reduce(
        DataFrame.unionAll,
        [
            labelled.where((F.col("_toxic") != 0) == bad).orderBy(F.xxhash64("_doc"), "_doc").limit(n)
            for bad, n in drawn.items()
        ],
    )
    weights = (kinds[True] / drawn[True], kinds[False] / drawn[False])
    texts = documents.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    # One row per id, reduced within each task before any text moves: ids may be shared by many rows.
    text = F.struct(F.col("text").isNull(), F.xxhash64("text"), F.col("text").alias("text"))
    found = texts.join(F.broadcast(chosen), "_doc").groupBy("_doc", "_toxic", "_low").agg(F.min(text).alias("first"))
    sample = found.select("_doc", "_toxic", "_low", F.col("first.text").alias("text"))
    schema = "doc_id long, toxic int, low boolean, words array<string>"
    sample = written(sample.mapInArrow(_word_lists, schema), "labelled")
    is_bad, is_low = F.col("toxic") != 0, F.col("low")
    bad, low, size = sample.agg(F.count_if(is_bad), F.count_if(is_low), F.count(F.lit(1))).first()
    counted = (
        sample.select("toxic", "low", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count_if(is_bad).alias("bad"), F.count_if(is_low).alias("poor"), F.count(F.lit(1)).alias("all"))
    )
    tells_bad = (_excess(F.col("bad"), bad, F.col("all") - F.col("bad"), size - bad) >= BAR) & (
        F.col("bad") >= min(LEAST_TOXIC, bad)
    )
    tells_low = (_excess(F.col("poor"), low, F.col("all") - F.col("poor"), size - low) >= BAR) & (
        F.col("poor") >= LEAST_TOXIC
    )
    words = [r.word for r in counted.where(tells_bad | tells_low).select("word").orderBy("word").collect()]
    # From Arrow: Spark knows its size, and so need not shuffle all words of the sample to meet a few.
    listed = pa.table({"word": pa.array(words, pa.string()), "number": pa.array(range(len(words)), pa.int32())})
    numbers = documents.sparkSession.createDataFrame(listed)
    # The sample's documents as numbers of features: what goes to the driver is bounded by the sample.
    held = (
        sample.select("doc_id", F.explode("words").alias("word"))
        .join(numbers, "word")
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.collect_list("number").alias("numbers"))
    )
    found = sample.select("doc_id", "toxic", "low").join(held, F.col("doc_id") == F.col("_doc"), "left")
    found = found.select("toxic", "low", "numbers", F.xxhash64("doc_id").alias("order")).orderBy("order").toArrow()
    toxic = found["toxic"].to_numpy() != 0
    poor = found["low"].to_numpy()
    features = [sorted(n or ()) for n in found["numbers"].to_pylist()]
    return fit_chain(words, features, chain_labels(features, len(words), poor, toxic), weights=weights)


def _score(chain: Chain | None, carry: list[str], text: str, threshold: float | None):
    limit = threshold if threshold is not None or chain is None else chain.threshold

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, text):
            texts = batch[text].to_pylist()
            found = [chain.probabilities(t) if chain else [0.0] * len(NAMES) for t in texts]
            columns = list(zip(*found, strict=True)) if found else [()] * len(NAMES)
            toxic = [chain is not None and p[-1] >= limit for p in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in carry],
                    *[pa.array(c, pa.float64()) for c in columns],
                    pa.array(toxic, pa.bool_()),
                    pa.array([not t for t in toxic], pa.bool_()),
                ],
                names=[*carry, *[f"p_{n}" for n in NAMES], "toxic", "kept"],
            )

    return score


def classify(
    documents: DataFrame, labels: DataFrame, carry: list[str], text: str = "text",
    threshold: float | None = None,
) -> DataFrame:
    """``carry`` columns with p_low_quality, p_kind_1 to p_kind_3, p_toxic, toxic and kept of every text.

    Whole texts are scored in one pass without a shuffle, against ``threshold`` or else the one at
    which out-of-fold probabilities of the labelled sample part best. A null or empty text has no
    words, so it gets the probability of a text that says nothing; without labelled rows
    of both kinds all probabilities are 0 and all is kept. Repeated rows get the same scores; an empty table gives no rows.
    """
    importable(documents.sparkSession)
    chain = train(documents.select(F.col(_id(documents, carry)).alias("doc_id"), F.col(text).alias("text")), labels)
    used = list(dict.fromkeys([*carry, text]))
    fields = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carry)
    scores = ", ".join(f"p_{n} double" for n in NAMES)
    return documents.select(*used).mapInArrow(
        _score(chain, carry, text, threshold), f"{fields}, {scores}, toxic boolean, kept boolean"
    )


def _id(documents: DataFrame, carry: list[str]) -> str:
    return "doc_id" if "doc_id" in documents.columns else carry[0]


def document_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the probability of each category, toxic and kept for every document.

    Null, empty and very long texts, repeated rows and empty tables are as for ``classify``; other columns
    are not read.
    """
    return classify(documents.select("doc_id", "text"), labels, ["doc_id"])


def keep_clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with their own columns, whatever their names; see ``classify``."""
    names = documents.columns
    order = ["doc_id", *[n for n in names if n != "doc_id"]]
    plain = documents.select(*order).toDF(*[f"c{k}" for k in range(len(order))])
    out = classify(plain, labels, plain.columns, text=f"c{order.index('text')}").where("kept")
    return out.select(*plain.columns).toDF(*order).select(*names)
