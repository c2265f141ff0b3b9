import hashlib
import zlib

import pytest
from llm_rows import corpus, make_docs  # noqa: F401

from quarry.llm import merkle

NAMES = ("doc_id", "source", "lang", "n_chars", "text")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def h(data):
    return hashlib.sha256(data.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climb(tree, i, digest):
    """The root from ``digest`` at leaf i, and the siblings on the way."""
    proof = []
    for nodes in tree[:-1]:
        a = i // 16 * 16
        before, after = nodes[a:i], nodes[i + 1:a + 16]
        proof += before + after
        digest, i = h("".join([*before, digest, *after])), i // 16
    return digest, proof


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row, sorted."""
    by: dict = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        by[s] = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in by[s]]))
    top = levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, s in enumerate(order):
        for i, row in enumerate(by[s]):
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].translate(FOLD))
            _, proof = climb(trees[k], i, leaf(row))
            folded, _ = climb(trees[k], i, leaf(changed))
            folded, above = climb(top, k, folded)
            root = top[-1][0]
            out.append((str(row[0]), leaf(row), trees[k][-1][0], root, h("".join(proof + above)), folded, folded == root))
    return sorted(out)


def plain(rows):
    return [(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in rows]


def report(docs):
    return sorted((str(r[0]), *r[1:]) for r in merkle.manifest_report(docs).collect())


def test_equals_brute_force(spark, corpus):
    got = report(make_docs(spark, corpus))
    assert got == brute(plain(corpus))
    assert any(r[6] for r in got) and not all(r[6] for r in got)


@pytest.mark.parametrize(("leaves", "sources"), [(1, 1), (16, 1), (17, 1), (300, 1), (4200, 1), (40, 40), (700, 23)])
def test_tree_shapes(spark, leaves, sources):
    rows = [(i, f"Text {i}", "aa", f"s{i % sources}" if i % sources else None) for i in range(leaves)]
    assert report(make_docs(spark, rows, clashing=False)) == brute(plain(rows))


def test_small_partitions_and_one_hot_source(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 37)  # partitions that begin and end inside runs
    rows = [(i, f"Words {i % 90}", None, "hot" if i % 3 else f"s{i % 41}") for i in range(900)]
    assert report(make_docs(spark, rows)) == brute(plain(rows))


def test_equal_rows_are_leaves_of_their_own(spark):
    rows = [(5, "Same", "aa", "s")] * 50 + [(None, None, None, None)] * 20
    assert report(make_docs(spark, rows)) == brute(plain(rows))


def test_multiproof_is_the_least_set():
    for lo, hi, n in ((0, 1, 1), (0, 300, 300), (3, 40, 300), (255, 257, 300), (299, 300, 300)):
        missing = {(level, i) for level, a, b, first, end in merkle.covered(lo, hi, n) for i in [*range(first, a), *range(b, end)]}
        wanted, known, size, level = set(), set(range(lo, hi)), n, 0
        while size > 1:
            wanted |= {(level, j) for i in known for j in range(i // 16 * 16, min(size, i // 16 * 16 + 16))} - {(level, i) for i in known}
            known, size, level = {i // 16 for i in known}, -(-size // 16), level + 1
        assert missing == wanted


def test_a_partition_asks_for_every_node_once(spark):
    rows = [(i, f"t{i}", None, f"s{i % 3}") for i in range(2000)]
    runs = merkle.source_runs(merkle.ordered_leaves(merkle.leaves(make_docs(spark, rows, clashing=False))))
    asked = merkle.requests(runs)
    assert asked.count() == asked.distinct().count()
    assert asked.groupBy("pid", "skey", "level").count().agg({"count": "max"}).first()[0] <= 30


def test_empty_table(spark):
    got = merkle.manifest_report(make_docs(spark, []))
    assert got.count() == 0 and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
