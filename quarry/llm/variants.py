"""Spelling variants: words one edit apart, grouped under their frequent form.

Words are counted over whole texts, per task first. A word's letters are a multiset, seen as a
binary vector with one dimension for each (letter, copy): an inserted or
deleted letter changes one dimension, a replaced letter two, so words one
edit apart lie within Hamming distance two. PartEnum finds all such pairs by equality:
dimensions are dealt to PARTS parts, two vectors within distance two agree in
all parts but two, and a word is posted under every choice of PARTS - 2 parts (its
signature: the choice and what the word has in those parts). Words that share a
signature meet and are verified as they meet; nothing is lost, whatever PARTS is.

Words of the same letters in another order share all signatures. Where more than
BUCKET words share one, they are posted once more by halves: one edit leaves the first or the
second half of the shorter word as it is, so these words meet under (signature, half) instead.

Then every word points to the most frequent near word that is at least ``ratio`` times as
frequent, and the pointers are followed by doubling: counts grow along them, so
rounds grow with the logarithm of a logarithm of the corpus.

Defined edge cases: null and empty texts have no words; a missing doc_id counts as the empty string in the
checksum that deletes letters; rows that repeat a doc_id are counted each; very long runs are ordinary
words; ties between near words go to the first in code-point order; an empty table gives
no words; further columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, slices

RUN = re.compile("[a-zÀ-ÿ]+")  # of texts whose A-Z are lower-cased
MIN_CHARS, MIN_COUNT, RATIO, TYPO_EVERY = 6, 5, 5, 199
PARTS = 7
BUCKET = 200
HELD_WORDS, HELD_CHARS = 200_000, 1 << 24


def typed(run: str, doc: int, every: int = TYPO_EVERY) -> str:
    """The run, less one code point where ``every`` divides the checksum of document and run;
    ``doc`` is the CRC-32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), doc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, every: int = TYPO_EVERY) -> DataFrame:
    """word, n of all words of at least ``min_chars`` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        chars = 0

        def flush():
            words, counts = list(held), list(held.values())
            for i in range(0, len(words), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(words[i:i + 8192], pa.string()), pa.array(counts[i:i + 8192], pa.int64())],
                                                 ["word", "n"])

        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                doc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                runs = Counter(RUN.findall((text or "").encode().lower().decode()))  # bytes.lower() maps A-Z only
                for word, n in runs.items():
                    if len(word) >= min_chars:
                        word = typed(word, doc, every)
                        if len(word) >= min_chars:
                            held[word] += n
                            chars += len(word)
                if len(held) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield from flush()
                    held.clear()
                    chars = 0
        yield from flush()

    counted = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def part_contents(words: list[str], parts: int) -> np.ndarray:
    """For each word and part a 64-bit hash of the dimensions that the word has in it."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    order = np.lexsort((letters, owner))
    letters, owner = letters[order], owner[order]
    new = np.r_[True, (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])]
    first = np.flatnonzero(new)
    copy = np.arange(len(letters)) - np.repeat(first, np.diff(np.r_[first, len(letters)]))
    dimension = (letters.astype(np.uint64) << np.uint64(32)) + copy.astype(np.uint64)
    value = dimension + np.uint64(1)
    for _ in range(2):
        value *= np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
    out = np.zeros((len(words), parts), np.uint64)
    np.add.at(out, (owner, (value >> np.uint64(16)) % np.uint64(parts)), value * np.uint64(0x9E3779B97F4A7C15))
    return out


def signatures(vocabulary: DataFrame, parts: int = PARTS) -> DataFrame:
    """signature, word, n: every word under its PartEnum signatures."""
    chosen = np.array(list(combinations(range(parts), parts - 2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            contents = part_contents(part.column(0).to_pylist(), parts)
            signed = np.zeros((part.num_rows, len(chosen)), np.uint64)
            for k, choice in enumerate(chosen):
                total = np.full(part.num_rows, k + 1, np.uint64)
                for p in choice:
                    total = (total ^ contents[:, p]) * np.uint64(0xD6E8FEB86659FD93)
                    total ^= total >> np.uint64(32)
                signed[:, k] = total
            rows = np.repeat(np.arange(part.num_rows), len(chosen))
            taken = part.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(signed.ravel().view(np.int64)), *taken.columns], ["signature", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "signature long, word string, n long")


def _verified(posted: DataFrame, keys: list[str]) -> DataFrame:
    """a, na, b, nb: words under one key that are one edit apart."""
    left = posted.select(*keys, F.col("word").alias("a"), F.col("n").alias("na"), F.col("length").alias("la"))
    right = posted.select(*keys, F.col("word").alias("b"), F.col("n").alias("nb"), F.col("length").alias("lb"))
    return (left.join(right, keys).where("a < b AND abs(la - lb) <= 1 AND levenshtein(a, b, 1) = 1")
            .select("a", "na", "b", "nb"))


def near_words(vocabulary: DataFrame, parts: int = PARTS, bucket: int = BUCKET) -> DataFrame:
    """a, na, b, nb: every pair of words one edit apart, once, a < b."""
    posted = cut(signatures(vocabulary, parts), "variant-signatures")
    sizes = posted.groupBy("signature").agg(F.count("*").alias("members")).where("members > 1")
    shared = cut(posted.join(sizes, "signature").withColumn("length", F.length("word")), "variant-shared")
    plain = _verified(shared.where(F.col("members") <= bucket), ["signature"])
    # halves of the shorter of two words: a word is the shorter one, of equal length, or the longer one
    shorter = F.explode(F.array(F.col("length"), F.col("length") - 1)).alias("shorter")
    half = F.floor(F.col("shorter") / 2).cast("int")
    sides = F.explode(F.array(F.concat(F.lit("<"), F.substring(F.col("word"), F.lit(1), half)),
                              F.concat(F.lit(">"), F.right(F.col("word"), F.col("shorter") - half)))).alias("half")
    halved = (shared.where(F.col("members") > bucket).select("signature", "word", "n", "length", shorter)
              .select("*", sides))
    crowded = _verified(halved, ["signature", "shorter", "half"])
    return plain.unionByName(crowded).distinct()


def forms(vocabulary: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form (null if there is none), form_n."""
    both = (pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n"))
            .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n"))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best"))
    frequent = (-F.col("best.least")) >= F.lit(ratio) * F.col("n")
    return (vocabulary.join(best, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                    F.when(frequent, F.col("best.near")).alias("form"),
                    F.when(frequent, -F.col("best.least")).alias("form_n")))


def roots(formed: DataFrame) -> DataFrame:
    """``formed`` with root: the last word on the way from form to form."""
    hops = cut(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "variant-hops")
    while True:
        onward = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(hops.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                    "variant-hops")
        hops = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            break
    return formed.join(hops, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      every: int = TYPO_EVERY) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word with ``min_count`` occurrences."""
    vocabulary = cut(word_counts(docs, min_chars, every).where(F.col("n") >= min_count), "variant-words")
    formed = cut(forms(vocabulary, near_words(vocabulary), ratio), "variant-forms")
    return roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


# DuckDB: pairs by single deletions at the same place (replaced) or onto the other word (inserted).
REPORT_SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, j: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS b)),
runs AS (
  SELECT doc_id, word, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{C0}-\x{FF}]+')) AS word FROM documents)
  WHERE length(word) >= 6 GROUP BY ALL),
bytes AS (
  SELECT doc_id, word, n, hex(encode(doc_id::VARCHAR || ':' || word)) AS digits FROM runs),
checked AS (
  SELECT doc_id, word, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(length(digits) // 2), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::INT])), 4294967295::BIGINT) AS h
  FROM bytes, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(word, 1, (h % length(word))::INT) || substr(word, (h % length(word) + 2)::INT) ELSE word END AS word, n
    FROM checked)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT DISTINCT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION
  SELECT DISTINCT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other COLLATE "C") AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
walk(word, last, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL
  SELECT k.word, f.form, k.step + 1 FROM walk k JOIN formed f ON f.word = k.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(last, step) AS root FROM walk GROUP BY word) r USING (word)
"""
