"""The written vector index: recall, pruning, appends, odd vectors."""

import numpy as np
import pytest

from quarry.operators import vector_index as VI
from quarry.operators import vectors as V


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 3000)] + 0.25 * rng.normal(size=(3000, 24))
    rows = [(f"c{i:05d}", v.tolist(), (f"k{i % 3}",)) for i, v in enumerate(x)]
    odd = [("null", None, ("k0",)), ("zero", [0.0] * 24, ("k0",)), ("nan", [float("nan")] + [1.0] * 23, ("k0",)), ("hole", [None] + [1.0] * 23, ("k0",))]
    schema = "chunk_id string, embedding array<double>, metadata struct<corpus:string>"
    q = centres[:20] + 0.25 * rng.normal(size=(20, 24))
    queries = spark.createDataFrame([(i, v.tolist(), "k1" if i % 2 else None) for i, v in enumerate(q)] + [(99, [0.0] * 24, None)],
                                    "question_id long, embedding array<double>, corpus string")
    return spark.createDataFrame(rows + odd, schema).repartition(4), queries


@pytest.fixture(scope="module")
def index(spark, clustered, tmp_path_factory):
    chunks, _ = clustered
    path = str(tmp_path_factory.mktemp("vectors")) + "/index"
    VI.build_index(chunks.where("chunk_id < 'c02500'"), path)
    return path


def test_recall_pruning_and_appends(spark, clustered, index):
    chunks, queries = clustered
    late = chunks.where("chunk_id >= 'c02500'")
    assert VI.append_chunks(late, index, "late") and not VI.append_chunks(late, index, "late")
    opened = VI.open_index(spark, index)
    assert opened.vectors.count() == 3000  # the odd ones have no direction
    exact = {(r.question_id, r.chunk_id): r.distance for r in V.vector_topk(chunks.where("chunk_id LIKE 'c%'"), queries.where("question_id < 99")).collect()}
    got = {(r.question_id, r.chunk_id): r.distance for r in VI.search(opened, queries).collect()}
    assert len(exact) == 100 and len(set(exact) & set(got)) >= 95
    assert all(abs(exact[k] - got[k]) < 1e-6 for k in set(exact) & set(got))
    # clustered vectors: few cells are enough
    assert opened.probes < 0.1 * len(opened.centres)
    _, qmat, _ = V._collect_queries(queries.where("question_id = 0"), 24)
    cells = VI.probed_cells(opened, qmat, opened.probes)[0]
    read = VI.read_cells(opened, cells)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cell" in plan.split("PartitionFilters")[1][:200]
    assert read.count() < 0.15 * 3000


def test_all_cells_are_exact(spark, clustered, index):
    chunks, queries = clustered
    opened = VI.open_index(spark, index)
    stored = chunks.join(opened.vectors.select("chunk_id"), "chunk_id", "left_semi")
    key = lambda rows: sorted((r.question_id, r.rank, r.chunk_id, r.distance) for r in rows)
    assert key(VI.search(opened, queries, probes=10**6).collect()) == key(V.vector_topk(stored, queries.where("question_id < 99")).collect())


def test_empty_tables(spark, clustered, tmp_path):
    chunks, queries = clustered
    index = VI.build_index(chunks.limit(0), str(tmp_path / "none"))
    assert VI.search(index, queries).count() == 0
    assert VI.search(index, queries.limit(0)).count() == 0
