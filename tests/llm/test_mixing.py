import math
import re
from collections import defaultdict

from llm_rows import corpus, make_docs  # noqa: F401

from quarry.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(sizes):
    """Water filling by repeated resharing."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        each = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if each * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: each * weight[s] for s in open_}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_taken_and_reruns(spark, corpus):
    docs = make_docs(spark, corpus)
    rows = mixing.mix_report(docs).collect()
    assert len(rows) == len(corpus)
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, _, s in corpus:
        sizes[s] += len(WORD.findall(t or ""))
    for r in rows:
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size and r.source_size == sizes[r.source]
    target = goals(dict(sizes))
    for r in rows:
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
    for s, t in target.items():
        assert abs(taken[s] - t) <= longest[s]
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_multipliers_tilt_rates_to_the_target(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 17)), "a", "abcd"[i % 4]) for i in range(400)]
    sized = make_docs(spark, rows, clashing=False).select("doc_id", mixing.row_key("source").alias("key"), mixing.size_of().alias("size"))
    sizes = sized.groupBy("key", "size").count().withColumnRenamed("count", "n")
    goal = mixing.targets(sizes)
    lam = {r.key: r.lam for r in mixing.multipliers(sizes, goal, 2.0).collect()}
    for g in goal.collect():
        words = sum(r.n * r.size * (2.0 if lam.get(g.key) is None else min(2.0, math.exp(lam[g.key] * r.size / g["mean"])))
                    for r in sizes.where(sizes.key == g.key).collect())
        assert math.isclose(words, g.target, rel_tol=1e-5)


def test_bucketed_cells_agree_with_plain_ranks(spark, monkeypatch):
    docs = make_docs(spark, [(i, "w " * (1 + i % 2), "a", "abc"[i % 3]) for i in range(900)], clashing=False)
    plain = sorted(map(str, mixing.mix_report(docs).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    assert sorted(map(str, mixing.mix_report(docs).collect())) == plain


def test_mix_keeps_columns_and_counts(spark, corpus):
    docs = make_docs(spark, corpus)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = sum(r.copies for r in mixing.mix_report(docs).collect())
    assert mixed.where("text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").count() == copies


def test_rows_that_share_a_hash_meet_the_target(spark, monkeypatch):
    """No doc_id and one size, or one doc_id and one size, for most rows."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rows = [(None, "w " * 37, "a", "abc"[i % 3]) for i in range(450)] + [(7, "w " * 37, "a", "a") for _ in range(150)]
    rows += [(i, "w " * (30 + i % 9), "a", "abc"[i % 3]) for i in range(1000, 1060)]
    docs = make_docs(spark, rows)
    got = mixing.mix_report(docs).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert len(got) == len(rows) and all(abs(taken[s] - t) <= 38 for s, t in target.items())
    assert mixing.mix(docs).count() == sum(r.copies for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_report(docs).collect()))


def test_no_words_and_no_rows(spark):
    assert mixing.mix_report(make_docs(spark, [(1, " ", "a", "x"), (2, None, "a", None)])).select("taken", "target").collect() == [(0, 0.0)] * 2
    assert mixing.mix_report(make_docs(spark, [])).count() == 0
