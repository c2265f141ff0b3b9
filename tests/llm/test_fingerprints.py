import hashlib

import numpy as np
import pytest
from llm_rows import corpus, make_docs, prose  # noqa: F401

from quarry.llm import fingerprints
from quarry.llm.shingles import Shingler


def jaccard(a, b):
    x, y = (set(Shingler().distinct(t).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_edits_hashes_and_likeness(spark, corpus, partitions):
    rows = [(i, t or "") for i, t, *_ in corpus]
    rows.sort(key=lambda r: (r[0] is None, r[0], r[1].encode()))
    found = fingerprints.fingerprint_report(make_docs(spark, corpus), partitions=partitions).collect()
    assert len(found) == len(rows)
    got = sorted(found, key=lambda r: (r.doc_id is None, r.doc_id, r.n_chars, r.edited_sha256))
    expected = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        expected.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), jaccard(text, new), jaccard(text, following)))
    expected.sort(key=lambda r: (r[0] is None, r[0], r[1], r[2]))
    for r, (i, n, sha, near, following) in zip(got, expected, strict=True):
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, n, sha)
        assert abs(r.near_edited - near) < 0.15 and abs(r.near_next - following) < 0.15


def test_equal_sets_agree_and_estimates_are_unbiased():
    import random

    rng, of = random.Random(2), fingerprints.Fingerprinter()
    assert of.packed(of.low_bits("A  b\tC")) == of.packed(of.low_bits("a b c"))
    assert of.packed(of.low_bits(None)) == "" and of.likeness(None, None) == 1.0 and of.likeness(None, of.low_bits("a")) == 0.0
    errors = []
    for _ in range(120):
        words = prose(rng, rng.choice([12, 30, 100, 400])).split()
        other = words[:rng.randrange(6, len(words))] + prose(rng, 20).split()
        a, b = " ".join(words), " ".join(other)
        errors.append(of.likeness(of.low_bits(a), of.low_bits(b)) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_narrow_form_and_empty_table(spark, corpus):
    docs = make_docs(spark, corpus)
    assert fingerprints.fingerprints(docs).count() == len(corpus)
    assert fingerprints.fingerprint_report(make_docs(spark, [])).count() == 0
    assert fingerprints.fingerprint_report(make_docs(spark, [(1, "a b", "x", "s")])).first().near_next == 1.0
