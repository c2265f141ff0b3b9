import random

import numpy as np
from llm_rows import SF, corpus, make_docs, prose  # noqa: F401

from quarry.llm import toxicity

INSULTS = ["grubnak", "zotface", "plimhead"]


def test_finds_planted_insults_and_leaves_the_rest(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1200):
        bad = rng.random() < 0.15
        words = prose(rng, rng.randrange(5, 200)).split()
        if bad:
            words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", ".", ","])
        rows.append((i, " ".join(words), "a", "s"))
        if i < 800:  # some labels are wrong
            labels.append((i, 1, int(bad) if rng.random() < 0.97 else 1))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity_report(make_docs(spark, rows), labels).collect()}
    assert len(found) == 1200
    for i, t, *_ in rows[800:]:
        assert found[i].rejected == any(w in t for w in INSULTS), t


def test_later_models_see_out_of_fold_odds():
    rng = np.random.default_rng(0)
    words = [np.unique(rng.integers(0, 50, 12)).astype(np.uint64) for _ in range(600)]
    first = np.array([3 in w for w in words], float)
    labels = np.stack([first, np.where(rng.random(600) < 0.9, first, 1 - first)], axis=1)
    chain = toxicity.fit_chain(words, labels, ("one", "two"))
    assert chain.models[1].earlier.shape == (1,) and chain.models[1].earlier[0] > 0
    assert chain.probabilities([3])[1] > 0.6 > 0.4 > chain.probabilities([4])[1]


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.train(docs, toxicity.category_labels(labels.where("doc_id % 3 <> 0")))
    rows = toxicity.predict(docs, chain).drop("toxic").join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    marked = [r.rejected for r in rows if r["toxic"] == 1]
    clean = [r.rejected for r in rows if r["toxic"] == 0]
    assert sum(marked) >= 0.5 * len(marked) and sum(clean) <= 0.02 * len(clean)


def test_edge_rows(spark, corpus):
    docs = make_docs(spark, corpus)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(10)] + [(1, None, 1), (2, 0, None), (None, 1, 1), (400, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_report(docs, labels).count() == len(corpus)
    none = toxicity.toxicity_report(docs, labels.limit(0)).collect()
    assert all(r["toxic"] == 0 and not r.rejected for r in none)
    chain = toxicity.train(docs, toxicity.category_labels(labels))
    assert toxicity.keep_clean(docs, chain).columns == docs.columns
    assert toxicity.toxicity_report(make_docs(spark, []), labels).count() == 0


def test_the_threshold_follows_the_clean_documents():
    few, many = np.linspace(0, 0.05, 200), np.linspace(0, 0.05, 5000)
    assert toxicity._threshold(few) == toxicity.REJECT and toxicity._threshold(np.empty(0)) == toxicity.REJECT
    # one rule at every number: the share that is rejected grows towards the bound and never passes it
    shares = [(x >= toxicity._threshold(x)).mean() for x in (np.linspace(0, 0.05, n) for n in (400, 800, 1600, 6400, 25_600, 102_400))]
    assert shares == sorted(shares) and shares[-1] <= toxicity.CLEAN_REJECTED < shares[-1] + 0.001
    assert 0.04 < toxicity._threshold(many) <= 0.05 and 0 < (many >= toxicity._threshold(many)).mean() <= toxicity.CLEAN_REJECTED
    assert toxicity._threshold(np.full(5000, 0.9)) == toxicity.REJECT


def test_held_out_recall_of_the_chosen_threshold(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.train(docs, toxicity.category_labels(labels.where("doc_id % 3 <> 0")))
    rows = toxicity.predict(docs, chain).drop("toxic").join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    marked = [r.rejected for r in rows if r["toxic"] == 1]
    clean = [r.rejected for r in rows if r["toxic"] == 0]
    assert sum(marked) >= 0.88 * len(marked) and sum(clean) <= 0.005 * len(clean)
