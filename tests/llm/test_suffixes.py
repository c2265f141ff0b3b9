import hashlib
import random
from collections import Counter

import pytest
from llm_rows import corpus, make_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import suffixes

N = suffixes.LENGTH


def brute(rows):
    raws = [(str(i), (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(raw[k:k + N] for _, raw in raws for k in range(len(raw) - N + 1))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - N + 1):
            if seen[raw[k:k + N]] > 1:
                gone[k:k + N] = b"\1" * N
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def passages(seed, n=40):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcdefghij klmnopé", "xyzäöü€ "])
    text = lambda k: "".join(rng.choices(alphabet, k=k))
    shared = [text(rng.choice([120, 199, 200, 201, 260, 700])) for _ in range(5)]
    rows = [(i, "".join(rng.choice([text(rng.randint(0, 150)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 50):]])
                        for _ in range(rng.randint(0, 6))), "a", "s") for i in range(n)]
    return [*rows, (900, "a" * 199, "a", "s"), (901, "q" * 200, "a", "s"), (902, "z" * 700, "a", "s"), (903, "qr" * 300, "a", "s")]


def test_equals_brute_force(spark, corpus):
    expected = brute(corpus)
    assert got(suffixes.suffix_report(make_docs(spark, corpus))) == expected
    assert sum(x[2] > 0 for x in expected) > 20


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("group_rows", [3, suffixes.GROUP_ROWS])
def test_large_groups_by_windows(spark, seed, group_rows):
    """The distributed window count for frequent grams gives the same bytes."""
    rows = passages(seed)
    assert got(suffixes.suffix_report(make_docs(spark, rows, clashing=False), group_rows=group_rows)) == brute(rows)


def test_saturated_filter_and_long_pieces(spark, monkeypatch):
    rows = passages(5)
    docs = make_docs(spark, rows, clashing=False)
    assert got(suffixes.suffix_report(docs, log2_bits=18)) == brute(rows)
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefgh", k=2 * suffixes.PIECE + 500))
    at = suffixes.PIECE - 100
    rows = [(1, long, "a", "s"), (2, "x" + long[at:at + 260] + "y", "a", "s")]
    report = {r.doc_id: r for r in suffixes.suffix_report(make_docs(spark, rows, clashing=False)).collect()}
    assert report[1].removed == [[at, at + 260]] and report[2].removed == [[1, 261]]


def test_empty_table(spark):
    assert suffixes.suffix_report(make_docs(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.binary(min_size=6, max_size=6), min_size=1))
def test_blind_trie_sorts(strings):
    assert list(suffixes.BlindTrie(list(strings)).ordered()) == sorted(strings)


def test_deep_shallow_sorts_long_common_prefixes():
    import numpy as np

    rng = random.Random(4)
    strings = [b"p" * rng.choice([0, 40, 90, 130]) + bytes(rng.choices(b"ab", k=136)) for _ in range(400)]
    strings = [s[:136] for s in strings] * 2
    group = np.array([rng.randrange(3) for _ in strings])
    order = suffixes.deep_shallow(group, np.array([list(s) for s in strings], np.uint8))
    keys = [(group[i], strings[i]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(strings)))
