"""Python passes take Spark's batches in small slices."""

import pyarrow as pa
import pytest

from callflow.llm import jaccard_join, quality_cascade, repeated_spans, shared


def batch_of(texts):
    n = len(texts)
    columns = {
        "doc_id": pa.array(range(n), pa.int64()), "hash": pa.array(range(n), pa.int64()),
        "_text": pa.array(texts), "bytes": pa.array(texts).cast(pa.binary()),
        "found": pa.array([None] * n, pa.list_(pa.struct([("place", pa.int64()), ("core", pa.int64()), ("done", pa.bool_()), ("open", pa.bool_())]))),
    }
    return pa.RecordBatch.from_pydict(columns)


def test_slices_are_small_and_lose_no_row(monkeypatch):
    monkeypatch.setattr(shared, "SLICE_BYTES", 100)
    texts = ["a" * 30, None, "", "b" * 1000, "c" * 99, *["d" * 10] * 50, ""]
    slices = list(shared.small_slices(iter([batch_of(texts), batch_of([])]), "bytes"))
    assert [t for s in slices for t in s["_text"].to_pylist()] == texts
    assert max(sum(len(t or "") for t in s["_text"].to_pylist()[1:]) for s in slices) <= 100


@pytest.mark.parametrize("run", [
    quality_cascade._cascade(quality_cascade.RULES, ["doc_id"]), repeated_spans._first_pass(["doc_id"], True), jaccard_join._sets,
])
def test_a_large_batch_is_not_answered_at_once(run):
    texts = ["some words of a text " * 500] * 400  # 4.2 MB
    sizes = [b.num_rows for b in run(iter([batch_of(texts)]))]
    assert sum(sizes) == 400 and max(sizes) < 110
