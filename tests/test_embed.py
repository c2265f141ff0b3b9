"""Embeddings by a caller's model: loads, batches, failures."""

import os

import pytest

from quarry.operators import embed as E


def test_batches_are_bounded_and_alike():
    lengths = [5, 900, 5, 0, 40, 41, 3000, 7] * 9
    batches = list(E.length_batches(lengths, 8, 1000))
    assert sorted(i for b in batches for i in b) == list(range(len(lengths)))
    for b in batches:
        assert len(b) <= 8 and (len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 1000)


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, None if i % 50 == 0 else f"{'bad' if i % 33 == 0 else 'text'} {'x' * (i % 71)}", "old") for i in range(400)]
    return spark.createDataFrame(rows, "id int, text string, error string").repartition(6)


def test_one_model_per_worker_and_failed_rows_are_kept(texts, tmp_path):
    folder = str(tmp_path)

    class Model:
        def __init__(self):
            open(f"{folder}/{os.getpid()}-{len(os.listdir(folder))}", "w").close()

        def __call__(self, batch):
            assert len(batch) <= 10
            if any(t.startswith("bad") for t in batch):
                raise RuntimeError("cannot read")
            return [[float(len(t)), 1.0] for t in batch]

    for _ in range(2):
        rows = {r.id: r for r in E.embed_with(texts, Model, f"test model {folder}", max_rows=10).collect()}
        assert len(rows) == 400
        for i, r in rows.items():
            if i % 50 == 0:
                assert r.embedding is None and r.error is None
            elif i % 33 == 0:
                assert r.embedding is None and r.error == "RuntimeError: cannot read"
            else:
                assert r.embedding == [float(len(r.text)), 1.0] and r.error is None
    loads = [f.split("-")[0] for f in os.listdir(folder)]
    assert loads and len(loads) == len(set(loads))  # never twice in one process


def test_wrong_outputs_are_errors(texts):
    few = E.embed_with(texts, lambda: lambda batch: [[1.0]], "too few", max_rows=4)
    assert few.where("text IS NOT NULL AND embedding IS NULL").count() == 0  # row by row the model gives one each
    flat = E.embed_with(texts, lambda: lambda batch: [1.0 for _ in batch], "no vectors")
    assert flat.where("error LIKE 'ValueError%'").count() == flat.where("text IS NOT NULL").count()
    assert E.embed_with(texts.limit(0), lambda: None, "none").count() == 0
