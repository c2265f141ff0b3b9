import random

import pytest

SF = "/root/testdata/sf0.01"
WORDS = [a + b for a in "ba be bi bo bu da de di do du ka ke ki ko ku ma me mi mo mu".split()
         for b in "lan len lin lon lun ran ren rin ron run san sen sin son sun".split()]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def make_docs(spark, rows, clashing=True):
    """doc_id, text, lang, source, n_chars and, by default, columns whose names
    the operators use for themselves."""
    full = [(i, t, lang, s, None if t is None else len(t)) + (("x", 1, "y") if clashing else ()) for i, t, lang, s in rows]
    extra = ", key string, n long, digest string, rep int, hash long, size int" if clashing else ""
    full = [r[:5] + ((*r[5:], 1, 2, 3) if clashing else ()) for r in full]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long" + extra).repartition(3)


def awkward_rows():
    """Every kind of awkward row: nulls, empty and long texts, ties, repeats, near copies, a hot source."""
    rng = random.Random(7)
    base = [prose(rng, n) for n in (3, 4, 5, 6, 12, 40, 40, 90, 150, 300)]
    rows = [(i, t, "aa", f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(100 + i, base[7], "aa", "s0") for i in range(12)]  # exact copies
    for i in range(14):  # near copies, a few words changed
        words = base[8].split()
        for _ in range(1 + i % 3):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((200 + i, " ".join(words), "bb", "s0"))
    shared = [prose(rng, 14), prose(rng, 30)]
    rows += [(300 + i, "\n".join([prose(rng, 20), "  " + shared[0].upper() + "\t", prose(rng, 5), shared[1], shared[0]]), "bb", "s0")
             for i in range(9)]
    rows += [(400, None, "aa", "s1"), (401, "", "aa", None), (402, " \t\n ", None, ""), (403, prose(rng, 6000), "aa", "s3"),
             (404, "\n\n", "bb", "s2"), (405, "é" * 45 + "\n" + "É" * 45, "bb", "s2"), (406, "12 34", "aa", None),
             (407, "a" * 900, "aa", "s1"), (408, base[9] + base[9], None, "s1"), (408, base[9] + base[9], None, "s1"),
             (409, base[5], "aa", "s1"), (409, base[6], "aa", "s1"), (None, base[9], "aa", "s1"), (None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def corpus():
    return awkward_rows()
