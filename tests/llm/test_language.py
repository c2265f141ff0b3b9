import random
import zlib

import numpy as np
from llm_rows import SF, corpus, make_docs  # noqa: F401

from quarry.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_a_mixture_names_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs)
    by = {r.lang: r.t for r in docs.where("length(text) > 1500").groupBy("lang").agg({"text": "first"}).toDF("lang", "t").collect()}
    text = by["en"][:1500] + " " + by["de"][:500]
    [row] = langid.predict(make_docs(spark, [(1, text, None, None)]), model).collect()
    assert row.languages[:2] == ["en", "de"] and 0.6 < row.score < 0.9


def test_edge_rows(spark, corpus):
    rows = langid.language_report(make_docs(spark, corpus)).collect()
    assert len(rows) == len(corpus)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i in (400, 401, 402, 404, 406):
        assert (by[i][0].lang_pred, by[i][0].score) == ("und", 0.0)
    assert {r.lang_pred for r in rows} <= {"aa", "bb", "und"}
    assert not any(r.held_out for r in by[None])
    assert langid.language_report(make_docs(spark, [])).count() == 0
    nothing = langid.language_report(make_docs(spark, [(1, "some words", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]


def invented(rng, letters, n):
    return ["".join(rng.choices(letters, k=rng.randint(3, 7))) for _ in range(n)]


def learned(pools):
    counts = np.stack([np.bincount(langid.trigrams(" ".join(p)), minlength=langid.BUCKETS) for p in pools.values()], axis=1)
    return langid.Languages(list(pools), np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * langid.BUCKETS)))


def found(texts, model):
    return [{model.names[i]: float(x) for i, x in enumerate(row) if x > 0} for row in langid.mixtures(texts, model)]


def test_a_distinct_language_among_many_related_ones():
    rng = random.Random(3)
    common = invented(rng, "абвгдежзик", 300)
    pools = {f"c{i:02}": common + invented(rng, "абвгдежзик", 60) for i in range(11)} | {"zh": invented(rng, "的一是不了人我在有他", 300)}
    [row] = found([" ".join(rng.choices(pools["c03"], k=210) + rng.choices(pools["zh"], k=90))], learned(pools))
    assert set(row) == {"c03", "zh"} and 0.25 < row["zh"] < 0.45


def test_documents_are_split_up_when_there_are_many_languages(monkeypatch):
    rng = random.Random(5)
    pools = {f"l{i:02}": invented(rng, "abcdefghijklmnop", 50) for i in range(20)}
    texts = [" ".join(rng.choices(p, k=5 + i)) for i, p in enumerate(pools.values())] + [""]
    whole = found(texts, learned(pools))
    monkeypatch.setattr(langid, "CELLS", 1000)
    assert found(texts, learned(pools)) == whole and [max(r, key=r.get) for r in whole[:-1]] == list(pools)


def test_a_row_does_not_depend_on_its_neighbours():
    rng = random.Random(1010)
    common = invented(rng, "abcdefghij", 300)
    pools = {k: common + invented(rng, "abcdefghij", 10) for k in ("a1", "a2")} | {"x": invented(rng, "qrstuvwxyz", 300)}
    close = " ".join(rng.choices(common, k=120) + rng.choices(pools["a1"][300:], k=4) + rng.choices(pools["a2"][300:], k=2)
                     + rng.choices(pools["x"], k=20))
    texts = [close, " ".join(rng.choices(pools["a1"], k=150) + rng.choices(pools["x"], k=100)), " ".join(pools["a1"]), "xyz", ""]
    model = learned(pools)
    alone = [found([t], model)[0] for t in texts]
    assert alone == found(texts, model) and alone[::-1] == found(texts[::-1], model)
    assert set(alone[0]) == {"a1", "a2", "x"}  # two of them gain too little, three enough


def test_every_set_size_that_could_be_better_is_tried():
    rng = random.Random(8)
    common = invented(rng, "abcdefgh", 80)
    pools = {f"l{i}": common[: 12 * i] + invented(rng, "abcdefghijkl", 60) for i in range(6)}
    texts = [" ".join(w for p in rng.sample(list(pools.values()), k=1 + i % 4) for w in rng.choices(p, k=rng.randint(5, 80))) for i in range(60)]
    model = learned(pools)
    for text, row in zip(texts, langid.mixtures(texts, model), strict=True):
        n = np.bincount(langid.trigrams(text), minlength=langid.BUCKETS).astype(float)
        p = np.exp(model.log_p[n > 0])
        n = n[n > 0]

        def climb(share, steps, p=p, n=n):
            for _ in range(steps):
                share = (p * share * (n / (p @ share))[:, None]).sum(axis=0) / n.sum()
            return share, n @ np.log(p @ share)

        full, _ = climb(np.full(6, 1 / 6), langid.STEPS)
        tried = []
        for size in range(1, 7):
            start = np.where(np.argsort(np.argsort(-full)) < size, np.maximum(full, 1e-6), 0)
            share, value = climb(start / start.sum(), langid.STEPS // 2)
            tried.append((value - (size - 1) * langid.PENALTY * np.log(n.sum()), share))
        assert np.allclose(row, max(tried, key=lambda v: v[0])[1], atol=1e-9)
