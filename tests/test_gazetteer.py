"""Dictionary mentions against a search written the plain way."""

import random
import re

import pyarrow as pa
import pytest

from quarry import schemas as S
from quarry.functions import wordhash
from quarry.operators import gazetteer as G

WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def brute(pages, names, types=S.ENTITY_TYPES, cap=None):
    known = {(" ".join(n.split()), t) for n, t in names if n and t in types}
    known = {(n, t) for n, t in known if len(n) >= 2 and WORD.search(n)}
    out = []
    for doc, num, text in pages:
        text = (text or "").strip()
        seen = text[:cap]
        starts, ends = {m.start() for m in WORD.finditer(seen)}, {m.end() for m in WORD.finditer(seen)}
        found = set()
        for name, kind in known:
            pattern = r"\s+".join(map(re.escape, name.split(" ")))
            n_words = len(WORD.findall(name))
            for m in re.finditer(f"(?={'(' + pattern + ')'})", seen):
                a, b = m.start(1), m.end(1)
                lead, trail = WORD.search(name).start(), len(name) - [x.end() for x in WORD.finditer(name)][-1]
                # a no-break space is part of a word
                if a + lead in starts and b - trail in ends and WORD.findall(seen[a:b]) == WORD.findall(name):
                    found.add((a, b, n_words, name, kind))
        free, span = 0, None
        for a, b, _, name, kind in sorted(found, key=lambda f: (f[0], -f[2], -f[1], f[3:])):
            if a >= free or (a, b) == span:
                out.append((doc, num, kind, name, a, text[max(0, a - 60):b + 60].replace("\n", " ").strip()))
                free, span = b, (a, b)
    return sorted(out, key=str)


def run(spark, pages, names, **options):
    p = spark.createDataFrame([(*r, "x", 1) for r in pages], "doc_id string, page_num int, text string, name string, row int").repartition(3)
    d = spark.createDataFrame(names, "name string, type string").repartition(2)
    got = G.extract_mentions_gazetteer(p, d, **options)
    assert got.columns == ["doc_id", "page_num", "row", "type", "name", "start", "context"]
    return sorted((tuple(r[c] for c in ("doc_id", "page_num", "type", "name", "start", "context")) for r in got.collect()), key=str)


NAMES = [("Paris", "GPE"), ("Paris", "PERSON"), ("New York", "GPE"), ("New York Times", "ORG"), ("York", "GPE"), ("U.S.", "GPE"), ("U.S", "LOC"),
         ("(the) Firm", "ORG"), ("Élan vital", "EVENT"), ("naïve", "PERSON"), ("a", "GPE"), ("...", "ORG"), (None, "GPE"), ("x", None), ("Paris", "GPE"),
         ("Times Square Garden", "FAC"), ("skip me", "EMAIL"), ("42nd Street", "FAC"), ("  New \n York ", "GPE"), ("日本", "GPE")]
PAGES = [("1", 1, "  Paris, New York Times Square Garden; the U.S. and U.S of A. Parisian New\n\n York\tYork"), ("1", 2, None), ("2", 1, ""), ("3", 1, " \n "),
         ("4", 1, "élan Élan vital naïve naïves ünaïve 日本 日本語 42nd Street 42nd  Street"), ("5", 1, "x (the) Firm the Firm (the) Firm skip me New YorkTimes"),
         ("6", 1, "Paris " * 500), ("6", 1, "Paris"), (None, None, "U.S.")]


def test_equals_brute_force_on_awkward_pages(spark):
    expected = brute(PAGES, NAMES)
    assert run(spark, PAGES, NAMES) == expected and len(expected) > 500


@pytest.fixture(scope="module")
def random_case():
    rng = random.Random(4)
    vocabulary = ["ab", "cd", "Ef", "é", "x1", "Q"]
    joins = [" ", " ", " ", ", ", "-", "\n", ".", " ("]
    phrase = lambda n: "".join(rng.choice(vocabulary) + (rng.choice(joins) if i < n - 1 else "") for i in range(n))
    names = [(phrase(rng.randrange(1, 5)) + rng.choice(["", "", "."]), rng.choice(["GPE", "ORG", "PERSON", "EMAIL"])) for _ in range(120)]
    pages = [(str(i), i % 3, phrase(rng.randrange(1, 60))) for i in range(150)]
    return pages, names


def test_equals_brute_force_on_random_overlaps(spark, random_case):
    pages, names = random_case
    got = run(spark, pages, names)
    assert got == brute(pages, names) and len(got) > 500
    assert run(spark, pages, names, text_cap=40) == brute(pages, names, cap=40)


def test_blocks_of_the_dictionary_change_nothing(spark, random_case):
    pages, names = random_case
    assert run(spark, pages, names, block_bytes=300) == brute(pages, names)


def test_types_and_empty_tables(spark):
    assert run(spark, PAGES[:1], NAMES, types=["EMAIL"]) == []
    assert run(spark, PAGES[:1], []) == []
    assert run(spark, [], NAMES) == []


def test_a_large_dictionary_is_compact():
    names = [f"Name{i} of Place{i % 977}" for i in range(200_000)]
    g = G.Gazetteer.build(pa.array(names), pa.array(["GPE"] * len(names)))
    assert g.prefixes.nbytes + g.ends.nbytes < 40 * 3 * len(names)
    text = pa.array(["xx ".join(names[i:i + 50]) + " " + names[i] for i in range(0, 200_000, 5000)])
    first, last, _ = g.candidates(wordhash.words(text, wordhash.WORD_CHARS, fold=False))
    assert len(first) >= 40 and ((last - first) == 2).all()
