import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import WORDS, corpus, make_docs, prose  # noqa: F401

from quarry.functions import wordhash
from quarry.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def split(text):
    return WORD.findall((text or "").translate(FOLD))


def windows(text, size=10):
    w = split(text)
    n = min(size, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows, items):
    out = []
    for i, text, *_ in rows:
        w, hit, listed = split(text), set(), set()
        for item, passage in items:
            for window in windows(passage):
                n = len(window)
                for a in range(len(w) - n + 1):
                    if tuple(w[a:a + n]) == window:
                        hit |= set(range(a, a + n))
                        listed.add(item)
        names = sorted(str(x) for x in listed - {None})
        out.append((str(i), len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def make_items(spark, items):
    rows = [(i, t, "x", 1, [1]) for i, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, segment long, terms array<int>").repartition(2)


def report(docs, items):
    return sorted((str(r[0]), *r[1:]) for r in decontaminate.decontamination_report(docs, items).collect())


@pytest.fixture(scope="module")
def planted(corpus):
    rng = random.Random(3)
    passages = [prose(rng, n) for n in (40, 25, 12, 10, 9, 3, 1)]
    items = list(enumerate(passages)) + [(20, passages[0]), (None, prose(rng, 15)), (21, None), (22, ""), (23, " .,;"),
                                         (24, "ÉTÉ déjà-vu 42"), (25, "lan ren " * 9), (0, prose(rng, 11)), (26, "a" * 900)]
    rows = list(corpus)
    for i, passage in enumerate(p for _, p in items if p):
        w = split(passage)
        rows += [(1000 + i, f"{prose(rng, 30)} {passage.upper()}! {prose(rng, 10)}", "aa", "s1"),
                 (1100 + i, " ".join(w[:len(w) // 2]) + " zzz " + " ".join(w[len(w) // 2:]), "aa", "s1"),
                 (1200 + i, passage, "aa", "s1"), (1201 + i, " ".join(w[:11]), "aa", "s1")]
    rows += [(2000, "ren lan " * 300, "aa", "s0"), (2001, "été DÉJÀ vu 42", "aa", "s0"), (2002, "ÉTÉ DÉJà vu 42", "aa", "s0")]
    return rows, items


def test_equals_brute_force(spark, planted):
    rows, items = planted
    got = report(make_docs(spark, rows), make_items(spark, items))
    assert got == brute(rows, items)
    assert sum(r[5] for r in got) > 20 and not all(r[5] for r in got)


def test_small_segments_and_blocks_change_nothing(spark, planted, monkeypatch):
    rows, items = planted
    docs = make_docs(spark, rows).select("doc_id", "text")
    index = decontaminate.build_index(docs, segment_words=50)
    assert index.count() > 50
    monkeypatch.setattr(decontaminate, "STARTS", 3)
    names = "segment, doc, items, starts, lengths".split(", ")
    one = decontaminate.phrase_matches(index, make_items(spark, items)).select(names)
    assert decontaminate.item_blocks(make_items(spark, items), block_words=20).count() > 2
    spans = lambda df: sorted((r.segment, r.doc, i) for r in df.collect() for i in r["items"])
    whole = spans(one)
    blocks = decontaminate.item_blocks
    monkeypatch.setattr(decontaminate, "item_blocks", lambda df: blocks(df, block_words=20))
    assert sorted(set(spans(decontaminate.phrase_matches(index, make_items(spark, items))))) == sorted(set(whole))


def test_proximity_equals_brute_force(spark):
    rng = random.Random(5)
    few = WORDS[:7]
    texts = [" ".join(rng.choices(few, k=rng.randrange(1, 60))) for _ in range(40)]
    items = [(i, " ".join(rng.sample(few, k=4))) for i in range(12)] + [(50, few[0]), (51, f"{few[0]} nowhere {few[1]}")]
    rows = [(i, t, "aa", "s") for i, t in enumerate(texts)]
    for span in (4, 6, 64):
        index = decontaminate.build_index(make_docs(spark, rows), segment_words=100)
        found = decontaminate.proximity_matches(index, make_items(spark, items), window=4, span=span)
        got = {(r.doc_id, int(x)) for r in found.join(decontaminate.indexed_documents(index), ["segment", "doc"]).collect() for x in r["items"]}
        expected = {(d, i) for d, t in enumerate(texts) for i, p in items for need in windows(p, 4)
                    if any(set(need) <= set(split(t)[a:a + span]) for a in range(len(split(t))))}
        assert got == expected


def test_empty_tables(spark, corpus):
    items = make_items(spark, [(1, "lan ren")])
    assert decontaminate.decontamination_report(make_docs(spark, []), items).count() == 0
    got = report(make_docs(spark, corpus), make_items(spark, []))
    assert len(got) == len(corpus) and not any(r[5] for r in got)


def test_word_hashes_stand_for_words(corpus):
    texts = [t for _, t, *_ in corpus] + ["x" * 70_000 + " y", "x" * 69_999 + " y", "AbÉ abÉ ABé"]
    found = wordhash.words(pa.array(texts, pa.string()).slice(1), wordhash.LETTERS_DIGITS)
    flat = [w for t in texts[1:] for w in split(t)]
    assert [found.word(i).decode() for i in range(len(found.starts))] == flat
    assert np.diff(found.texts).tolist() == [len(split(t)) for t in texts[1:]]
    assert len(set(zip(flat, found.hashes.tolist(), strict=True))) == len(set(flat)) == len(np.unique(found.hashes))
    some = sorted({w for w in flat if len(w) < 20})
    assert wordhash.hash_words([w.encode() for w in some]).tolist() == [dict(zip(flat, found.hashes.tolist(), strict=True))[w] for w in some]
