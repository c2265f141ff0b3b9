import random
import re
import zlib
from collections import Counter

from llm_rows import corpus, make_docs  # noqa: F401

from quarry.llm import variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def misspelt(rng):
    """Texts with words, their variants and the variants' variants, in steep counts."""
    base = ["harbour", "planète", "straße", "mississippi", "abcabc", "zzzzzzzz", "banana" * 300, "Éclair", "éclair"]
    words = []
    for w in base:
        words += [w] * 800
        for _ in range(8):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("aeéz") + w[k + 1:], w[:k] + rng.choice("aeéz") + w[k:]])
            words += [v] * rng.choice([4, 5, 30, 120, 160, 400])
            k = rng.randrange(len(v))
            words += [v[:k] + "q" + v[k:]] * rng.choice([5, 6])
    words += ["listen"] * 5 + ["silent"] * 30 + ["enlist"] * 30 + ["tinsel"] * 5  # the same letters
    rng.shuffle(words)
    return [(i, " ".join(words[i::60]), "aa", "s0") for i in range(60)]


def report(docs):
    return sorted((tuple(r) for r in variants.spelling_variants(docs).collect()), key=str)


def test_equals_brute_force(spark, corpus):
    rows = corpus + misspelt(random.Random(1))
    got = report(make_docs(spark, rows))
    assert got == brute(rows)
    assert sum(r[1] is not None for r in got) > 20 and any(r[1] not in (None, r[2]) for r in got)


def test_partenum_loses_no_pair_whatever_the_parameters(spark):
    rng = random.Random(2)
    words = {"".join(rng.choices("abcé", k=rng.randrange(6, 9))) for _ in range(1500)}
    vocabulary = spark.createDataFrame([(w, rng.randrange(5, 500)) for w in sorted(words)], "word string, n long").repartition(4)
    expected = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    for parts, bucket in ((3, 200), (5, 3), (7, 200)):  # 3 parts: crowded signatures, met by halves
        pairs = variants.near_words(vocabulary, parts, bucket)
        got = [(r.a, r.b) for r in pairs.collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_typos_depend_on_document_and_word(spark):
    rows = [(i, "harbour " * 3, "aa", "s") for i in range(4000)]
    assert report(make_docs(spark, rows, clashing=False)) == brute(rows)


def test_empty_and_wordless(spark):
    assert report(make_docs(spark, [])) == []
    assert report(make_docs(spark, [(1, None, "a", "s"), (2, "", None, None), (3, "12 3456", "a", "s")])) == []
