import random
from collections import defaultdict

import pytest
from llm_rows import corpus, make_docs, prose  # noqa: F401

from quarry.llm import minhash
from quarry.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows):
    """doc_id -> set size and smallest reachable id, by all pairs and depth-first search."""
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    near = defaultdict(set)
    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1:]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 75 * len(a | b):
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, a in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        low = None if i is None else min(seen)
        out.append((str(i), len(a), str(low), i is None or i == low))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def test_equals_all_pairs(spark, corpus):
    assert got(minhash.near_groups(make_docs(spark, corpus))) == brute(corpus)


@pytest.mark.parametrize("leaders", [0, 1, 2])
def test_chains_hot_groups_and_shared_passages(spark, monkeypatch, leaders):
    """Chains of edits, a group of near copies and a passage in every document; short lists in blocks."""
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", leaders)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(3)
    passage, rows = prose(rng, 40), []
    words = prose(rng, 120).split()
    for i in range(25):  # each differs a little from the one before
        words[rng.randrange(len(words))] = f"x{i}"
        rows.append((1000 - i, " ".join(words), "a", "s"))
    hub = prose(rng, 100).split()
    for i in range(60):
        mine = list(hub)
        for _ in range(rng.randrange(1, 5)):
            mine[rng.randrange(100)] = f"y{i}"
        rows.append((2000 + i, " ".join(mine), "a", "s"))
    rows += [(3000 + i, f"{prose(rng, 60)} {passage} {prose(rng, 40)}", "a", "s") for i in range(60)]
    rows += [(4000 + i, f"{passage} {prose(rng, 3 + i)}", "a", "s") for i in range(12)]
    expected = brute(rows)
    assert got(minhash.near_groups(make_docs(spark, rows, clashing=False))) == expected
    assert len({c for _, _, c, _ in expected}) < len(rows) - 60


def test_keep_one_and_empty_table(spark, corpus):
    docs = make_docs(spark, corpus)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(k for *_, k in brute(corpus))
    assert minhash.near_groups(make_docs(spark, [])).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(500, 500)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, **{200 + i: 100 for i in range(50)}}
