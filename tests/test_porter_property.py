"""Porter stems of random words (with the suffixes the rules act on) equal
SQLite FTS5's 'porter' tokenizer, read back through fts5vocab."""

import sqlite3

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.functions.porter import STEP2, STEP3, STEP4, stem

SUFFIXES = sorted({s for s, _ in STEP2} | {s for s, _ in STEP3} | set(STEP4)
                  | {"s", "es", "ies", "sses", "ss", "ed", "eed", "ing", "y", "e", "ll", "at", "bl", "iz"})
STEMS = st.text(st.sampled_from(list("abcdefghijklmnopqrstuvwxyz")), min_size=0, max_size=7)
WORDS = st.builds(lambda a, s1, s2: a + s1 + s2, STEMS, st.sampled_from(SUFFIXES + [""]),
                  st.sampled_from(SUFFIXES + [""]))


def fts5_stems(words):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(x, tokenize='porter ascii')")
    con.executemany("INSERT INTO f(rowid, x) VALUES (?, ?)", [(i + 1, w) for i, w in enumerate(words)])
    con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, 'instance')")
    return dict(con.execute("SELECT doc, term FROM v").fetchall())


@settings(max_examples=60, deadline=None)
@given(st.lists(WORDS.filter(lambda w: w.isalpha()), min_size=1, max_size=200))
def test_stems_equal_fts5(words):
    got = fts5_stems(words)
    assert [stem(w) for w in words] == [got[i + 1] for i in range(len(words))]


def test_replacements_only_change_the_last_two_characters():
    """What the page prefilter of a stemmed search relies on."""
    for suffix, replacement in STEP2 + STEP3:
        assert len(replacement) <= len(suffix) and suffix.startswith(replacement[:-2])


@settings(max_examples=200, deadline=None)
@given(st.one_of(WORDS, st.builds(lambda a, b, c: a + b + c, st.text(st.sampled_from("aeioubtlséßтя語𝒳"), max_size=6),
                                  st.sampled_from(SUFFIXES), st.sampled_from([*SUFFIXES, ""]))))
def test_any_token_has_a_valid_stem_that_keeps_its_prefix(word):
    found = stem(word)
    found.encode("utf-8")
    assert word.startswith(found[:max(len(found) - 2, 0)])


def test_mixed_script_tokens_through_the_arrow_function(spark):
    from quarry.operators.search import stem_vocabulary

    words = ["aтed", "語ing", "éies", "ßational", "running", "a𝒳ed", "тly"]
    got = {r.token: r.term for r in stem_vocabulary(spark.createDataFrame([(w,) for w in words], "token string")).collect()}
    assert got == {w: stem(w) for w in words}
