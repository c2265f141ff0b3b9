"""Full-text page search (X1-X12) over the page index (doc_id, page_num, text).

The reference keeps an FTS5 table (all three columns indexed, ``porter ascii``
tokenizer) and passes the user's query string through. Here:

* X1 ``fts_tokens``: runs of ASCII letters/digits and any non-ASCII character,
  ASCII-only case folding; a built-in ``split``, no UDF.
* X3 stemming runs on the distinct vocabulary only: a written index keeps
  postings of folded tokens plus a (bucket, token, stem) vocabulary; a stemmed
  query joins the postings with the vocabulary rows of its stems on (bucket,
  token), where Spark prunes the bucket folders at run time. Searching pages without
  an index stems the (prefilter-reduced) token occurrences with an Arrow UDF
  that stems each batch's distinct words.
* X2 ``build_postings``: one row per token occurrence
  (bucket, term, doc_id, page_num, col, pos), term = the folded token. Written partitioned by the term
  bucket and sorted by term, so a term lookup prunes to one bucket folder and
  skips row groups by min/max statistics.
* X5-X12 are structured predicates (no query-string parser):
  ``Term, Prefix, Phrase, Near, Initial, Col`` combined with ``&`` (AND),
  ``|`` (OR) and ``-`` (NOT). The occurrences of all words of a query come from
  one filtered scan of the postings and are written once to the shared scratch
  folder; leaves read them there, and AND / OR / NOT are semi / union / anti
  joins on the page key.
* Without a built index (``PageSource``) a query first keeps only pages whose
  folded text contains one of its terms (or a term's stem minus two
  characters, a prefix of every token with that stem) and tokenizes just those.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry import schemas as S
from quarry.functions import postings
from quarry.functions.paging import paginate
from quarry.functions.porter import stem as _stem
from quarry.functions.scratch import materialize
from quarry.functions.text import ascii_lower, py_strip

# The separators of the ASCII tokenizer (every ASCII character
# that is not a letter or digit), and the indexed columns in table order.
TOKEN_SEPARATORS = "[\\x00-/:-@\\[-`{-\\x7f]+"
FTS_COLUMNS = ("doc_id", "page_num", "text")
NEAR_DEFAULT = 10
PAGE_KEY = ["doc_id", "page_num"]


def fts_tokens(c: Column) -> Column:
    """Array of tokens of one column value."""
    ascii_only = F.octet_length(c) == F.char_length(c)  # most texts; folding them needs no table
    return F.array_remove(F.split(F.when(ascii_only, F.lower(c)).otherwise(ascii_lower(c)), TOKEN_SEPARATORS), "")


def fold_query_token(t: str, stem: bool) -> str:
    """A query word through the same tokenizer: ASCII fold (+ stem)."""
    t = t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return _stem(t) if stem else t


def _query_tokens(text: str) -> list[str]:
    import re
    folded = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [t for t in re.split(r"[\x00-/:-@\[-`{-\x7f]+", folded) if t]


@F.arrow_udf(T.IntegerType())
def count_tokens_udf(s: pa.Array) -> pa.Array:
    """X1 in numbers: the tokens of each text."""
    return postings.count_tokens(s)


@F.pandas_udf(T.StringType())
def stem_udf(s: pd.Series) -> pd.Series:
    """Porter stem of each distinct term (Arrow batches)."""
    return s.map(_stem)


def page_tokens(pages: DataFrame, columns: Sequence[str] = FTS_COLUMNS) -> DataFrame:
    """Token occurrences (doc_id, page_num, col, pos, token) of the indexed
    columns; positions count tokens per column from 0."""
    arr = F.array(*[F.struct(F.lit(c).alias("col"), fts_tokens(F.col(c).cast("string")).alias("toks"))
                    for c in columns])
    # ``col`` is its own column before the token explode: otherwise every
    # token row would keep the struct -- and with it the column's whole
    # token array -- alive for the operators above
    x = pages.select(*PAGE_KEY, F.explode(arr).alias("c")) \
        .select(*PAGE_KEY, F.col("c.col").alias("col"), F.col("c.toks").alias("toks"))
    return x.select(*PAGE_KEY, "col", F.posexplode("toks").alias("pos", "token"))


def token_counts(pages: DataFrame, columns: Sequence[str] = FTS_COLUMNS) -> DataFrame:
    """X1 in numbers: (doc_id, page_num, col, n_tokens, n_distinct) of every page row's columns that have
    tokens, counted in the row."""
    arr = F.array(*[F.struct(F.lit(c).alias("col"), fts_tokens(F.col(c).cast("string")).alias("toks")) for c in columns])
    counted = F.transform(arr, lambda c: F.struct(c["col"].alias("col"), F.size(c["toks"]).alias("n_tokens"),
                                                  F.size(F.array_distinct(c["toks"])).alias("n_distinct")))
    return pages.select(*PAGE_KEY, F.explode(counted).alias("c")).select(*PAGE_KEY, "c.*").where("n_tokens > 0")


def stem_vocabulary(tokens: DataFrame) -> DataFrame:
    """(token, term) for the distinct tokens. The distinct runs map-side
    first, so the Python step sees each word once."""
    return tokens.select("token").distinct().repartition(_cores(tokens), "token").withColumn("term", stem_udf("token"))


def _cores(df: DataFrame) -> int:
    """Tasks for a vocabulary's Python stage: it is small next to the occurrences, and AQE would
    coalesce it into a few tasks."""
    try:
        return df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # remote session: fall back to the shuffle width
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


_STEM_CACHE: dict = {}
_STEM_CACHE_MAX = 1_000_000


def _stem_cached(t: str) -> str:
    r = _STEM_CACHE.get(t)
    if r is None:
        if len(_STEM_CACHE) >= _STEM_CACHE_MAX:
            _STEM_CACHE.clear()
        r = _STEM_CACHE[t] = _stem(t)
    return r


@F.pandas_udf(T.StringType())
def stem_tokens_udf(s: pd.Series) -> pd.Series:
    """Stem token occurrences: each Arrow batch stems its distinct words once,
    through a bounded per-task cache (word frequencies are Zipfian, so most
    occurrences are cache hits)."""
    uniq = pd.unique(s)
    return s.map({t: _stem_cached(t) for t in uniq})


def with_terms(tokens: DataFrame, stem: bool = True) -> DataFrame:
    """``token`` -> ``term`` (Porter stem when ``stem``). Stemming is a narrow
    Arrow step on the occurrences: no join back to a vocabulary, so no
    shuffle and nothing whose size would need to be bounded for a broadcast."""
    if not stem:
        return tokens.withColumnRenamed("token", "term")
    return tokens.withColumn("term", stem_tokens_udf("token")).drop("token")


def index_pages(pages: DataFrame) -> DataFrame:
    """The rows of the page index: pages whose stripped text is not empty."""
    return pages.filter(F.length(py_strip(F.coalesce(F.col("text"), F.lit("")))) > 0)


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_postings(pages: DataFrame, buckets: int = 64, lists: str | None = None) -> DataFrame:
    """Postings (bucket, term, doc_id, page_num, col, pos) of the folded
    tokens. Stemming is not applied per occurrence: a stemmed index pairs the
    postings with :func:`build_vocabulary` (the distinct tokens and their
    stems), so the Python stemmer runs once per distinct word.

    ``lists="page"`` gives a row for every term of a page column, ``pos`` the list of
    its places there; ``lists="pages"`` a row for every term of some thousand pages, with
    equally long lists in ``doc_id``, ``page_num`` and ``pos`` (:func:`posting_rows` unfolds them)."""
    if lists is None:
        return posting_rows(build_postings(pages, buckets, "pages"))
    p = index_pages(pages).select(*PAGE_KEY, *[F.col(c).cast("string").alias(f"_v_{c}") for c in FTS_COLUMNS])
    kinds = [p.schema[k].dataType for k in PAGE_KEY]
    keys = kinds if lists == "page" else [T.ArrayType(t) for t in kinds]
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("col", T.StringType()),
                           *[T.StructField(k, t) for k, t in zip(PAGE_KEY, keys, strict=True)],
                           T.StructField("pos", T.ArrayType(T.IntegerType()))])
    t = p.mapInArrow(postings.of_pages(PAGE_KEY, FTS_COLUMNS, lists == "page"), schema)
    return t.select(term_bucket(F.col("term"), buckets).alias("bucket"), "term", *PAGE_KEY, "col", "pos")


def posting_rows(lists: DataFrame) -> DataFrame:
    """One row per occurrence from postings in lists over pages, with the lists' further columns. Conditions
    on bucket, term and col are applied to the lists' rows, before they are unfolded."""
    more = [c for c in lists.columns if c not in ("bucket", "term", *PAGE_KEY, "col", "pos")]
    return (lists.select("bucket", "term", "col", *more, F.explode(F.arrays_zip(*PAGE_KEY, "pos")).alias("o"))
            .select("bucket", "term", *[F.col(f"o.{k}").alias(k) for k in PAGE_KEY], "col", F.col("o.pos").alias("pos"), *more))


def repeated_keys(pages: DataFrame) -> DataFrame:
    """The page keys (nulls are equal) that several rows share, usually none; written, so that the joins
    with it know its size."""
    n = pages.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialize(n.select(*[F.col(k).alias(f"_{k}") for k in PAGE_KEY]), "repeated-keys")


def by_repetition(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages whose key no other row has, and the rest. What is counted per page needs no grouping for
    the first, so only the others' tokens are dealt out and gathered."""
    twice = repeated_keys(pages)
    same = F.lit(True)
    for k in PAGE_KEY:
        same = same & pages[k].eqNullSafe(twice[f"_{k}"])
    return pages.join(twice, same, "left_anti"), pages.join(twice, same, "left_semi")


def build_vocabulary(postings: DataFrame) -> DataFrame:
    """X3 for an index: (bucket, token, stem) of every distinct token of the
    postings."""
    tokens = postings.select(F.col("term").alias("token"), "bucket").distinct()
    # by ranges, as it is written: dealt out once, and each word is stemmed once
    return tokens.repartitionByRange(_cores(tokens), "token").withColumn("stem", stem_udf("token"))


RUN_BUCKETS = 64  # buckets up to which every task writes into each


def write_posting_lists(lists: DataFrame, path: str, buckets: int) -> None:
    """Persist postings in lists, not shuffled: a row already holds what a term has in some thousand pages, so
    every task writes a run of its own into each bucket's folder, sorted by term. A lookup reads the term's rows of
    every run; how many runs there are follows from the bytes of the input's splits. Into more than RUN_BUCKETS
    folders the runs would be many small files: there the rows are dealt out as by :func:`write_postings`."""
    if buckets > RUN_BUCKETS:
        return write_postings(lists, path, order=())
    lists.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_postings(postings: DataFrame, path: str, mode: str = "overwrite", order: Sequence[str] = (*PAGE_KEY, "col", "pos")) -> None:
    """Persist the index: one folder per term bucket, rows sorted by term.

    The shuffle is a ``rebalance`` on (bucket, term): AQE splits a partition
    that a very frequent term makes skewed (a stop word can be several percent
    of all occurrences) over several writer tasks and merges small ones, so
    no task writes a hot term alone. Within every file rows are sorted by
    term, so row-group min/max statistics skip most of a bucket folder. Postings in lists
    have no order of pages below that (``order=()``)."""
    (postings.hint("rebalance", "bucket", "term")
     .sortWithinPartitions("bucket", "term", *order)
     .write.mode(mode).partitionBy("bucket").parquet(path))


# ---------------------------------------------------------------------------
# Sources: a built index, or pages searched without one
# ---------------------------------------------------------------------------

@dataclass
class PostingsIndex:
    """A written index: postings of folded tokens and, for stemmed search, the
    (bucket, token, stem) vocabulary built with it. ``lists`` is the table that ``postings``
    unfolds, where it is written in lists."""
    postings: DataFrame
    buckets: int
    stem: bool = True
    vocab: DataFrame | None = None
    lists: DataFrame | None = None

    def of_terms(self, terms: DataFrame) -> DataFrame:
        """The postings of the (bucket, term) rows of ``terms``, with its further columns; lists are
        unfolded after the join."""
        if self.lists is not None:
            return posting_rows(self.lists.join(terms, ["bucket", "term"]))
        return self.postings.join(terms, ["bucket", "term"])


@dataclass
class PageSource:
    pages: DataFrame
    stem: bool = True


@dataclass
class QueryOccurrences:
    """The occurrences of all words of one query."""
    rows: DataFrame
    stem: bool


# ---------------------------------------------------------------------------
# Predicates
# ---------------------------------------------------------------------------

class Expr:
    def __and__(self, other):
        return And(self, other)

    def __or__(self, other):
        return Or(self, other)

    def __sub__(self, other):
        return Not(self, other)


@dataclass
class Term(Expr):
    """X5 leaf: one word (a multi-word string is an implicit AND)."""
    text: str


@dataclass
class Prefix(Expr):
    """``abc*``; the prefix goes through the tokenizer, stemming included."""
    text: str


@dataclass
class Phrase(Expr):
    """``"a b"``: consecutive tokens inside one column."""
    text: str


@dataclass
class Near(Expr):
    """``NEAR(a b .., k)``: at most k tokens between the end of the first
    and the start of the last member, all in one column. A member with several
    words is a phrase (``NEAR("a b" c, k)``)."""
    words: Sequence[str]
    k: int = NEAR_DEFAULT


@dataclass
class Initial(Expr):
    """``^a`` / ``^"a b"``: a word or phrase starting a column."""
    text: str


@dataclass
class Col(Expr):
    """X11: ``col : expr`` / ``{a b} : expr``: restrict leaves below to some
    columns; ``exclude=True`` is ``- {a b} : expr`` (every other column)."""
    columns: Sequence[str] | str
    expr: Expr
    exclude: bool = False

    def selected(self) -> list[str]:
        cols = [self.columns] if isinstance(self.columns, str) else list(self.columns)
        return [c for c in FTS_COLUMNS if c not in cols] if self.exclude else cols


@dataclass
class And(Expr):
    left: Expr
    right: Expr


@dataclass
class Or(Expr):
    left: Expr
    right: Expr


@dataclass
class Not(Expr):
    left: Expr
    right: Expr


def _leaf_words(e: Expr, stem: bool) -> list[tuple[str, bool]]:
    """(folded word, is_prefix) needed by a leaf."""
    if isinstance(e, (Term, Phrase, Initial)):
        return [(fold_query_token(w, stem), False) for w in _query_tokens(e.text)]
    if isinstance(e, Prefix):
        ws = _query_tokens(e.text)
        return [(fold_query_token(w, stem), i == len(ws) - 1) for i, w in enumerate(ws)]
    if isinstance(e, Near):
        return [(fold_query_token(w, stem), False) for m in e.words for w in _query_tokens(m)]
    raise TypeError(e)


def _candidate_pages(src: PageSource, words: list[str]) -> DataFrame:
    """Pages whose folded columns contain one of the words (a necessary
    condition for a token match)."""
    hay = ascii_lower(F.concat_ws(" ", F.col("doc_id").cast("string"),
                                  F.col("page_num").cast("string"), F.col("text")))
    p = index_pages(src.pages).select(*PAGE_KEY, "text")
    probes = [_probe(w, src.stem) for w in words]
    return p.filter(_any([hay.contains(x) for x in probes])) if all(probes) else p


def _probe(w: str, stem: bool) -> str:
    """A prefix every token carrying term ``w`` starts with: the word itself,
    or with stemming the stem minus two characters. Every step of the stemmer
    keeps that true: a rule shortens the word or replaces a suffix by one that is
    no longer, and all but the last two characters of the replacement start the
    suffix (asserted over the rule tables in the tests); an added ``e`` and a
    final ``i`` for ``y`` are single last characters."""
    return w[:max(len(w) - 2, 0)] if stem else w


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _carries(column: str, words: list[tuple[str, bool]]) -> Column:
    return _any([F.col(column).startswith(w) if is_prefix else (F.col(column) == w) for w, is_prefix in words])


def _occurrences(src, words: list[tuple[str, bool]], columns=None) -> DataFrame:
    """Token rows (doc_id, page_num, col, pos, term) matching any of ``words``."""
    if isinstance(src, QueryOccurrences):
        t = src.rows.filter(_carries("term", words))
    elif isinstance(src, PostingsIndex) and not src.stem:
        t = src.postings
        if not any(is_prefix for _, is_prefix in words):
            # literals: folded by the optimizer into a filter on the bucket folders
            t = t.filter(F.col("bucket").isin(*[term_bucket(F.lit(w), src.buckets) for w, _ in words])).filter(_carries("term", words))
        elif src.vocab is not None:
            # the sorted vocabulary turns prefixes into terms, their buckets prune the folders at run time
            terms = src.vocab.filter(_carries("token", words)).select("bucket", F.col("token").alias("term")).distinct()
            t = src.of_terms(terms)
        else:
            t = t.filter(_carries("term", words))
    elif isinstance(src, PostingsIndex):
        if src.vocab is None:
            raise ValueError("a stemmed PostingsIndex needs its vocabulary (build_vocabulary)")
        # a word may stand in the vocabulary of several index segments
        # written: their size is known to be small before the postings are read, so these are pruned and not shuffled
        forms = materialize(src.vocab.filter(_carries("stem", words)).select("bucket", F.col("token").alias("term"), "stem").distinct(), "forms")
        t = src.of_terms(forms).drop("term").withColumnRenamed("stem", "term")
    else:
        toks = page_tokens(_candidate_pages(src, [w for w, _ in words]))
        if src.stem:
            # only tokens that can carry a wanted stem go through the stemmer
            toks = with_terms(toks.filter(_any([F.col("token").startswith(_probe(w, True)) for w, _ in words])), True)
        else:
            toks = toks.withColumnRenamed("token", "term")
        t = toks.filter(_carries("term", words))
    if columns is not None:
        t = t.filter(F.col("col").isin(list(columns)))
    return t.select(*PAGE_KEY, "col", "pos", "term")


def _all_words(e: Expr, stem: bool) -> list[tuple[str, bool]]:
    if isinstance(e, (And, Or, Not)):
        return _all_words(e.left, stem) + _all_words(e.right, stem)
    if isinstance(e, Col):
        return _all_words(e.expr, stem)
    return _leaf_words(e, stem)


def query_occurrences(src, e: Expr) -> QueryOccurrences:
    """One scan for all words of the query, written once for its leaves."""
    if isinstance(src, QueryOccurrences):
        return src
    words = sorted(set(_all_words(e, src.stem)))
    if not words:
        raise ValueError(f"empty query {e!r}")
    return QueryOccurrences(materialize(_occurrences(src, words), "occurrences"), src.stem)


def _match(src, e: Expr, columns=None) -> DataFrame:
    """Distinct page keys (doc_id, page_num) matching ``e``."""
    stem = src.stem
    if isinstance(e, And):
        return _match(src, e.left, columns).join(_match(src, e.right, columns), PAGE_KEY, "left_semi")
    if isinstance(e, Or):
        return _match(src, e.left, columns).union(_match(src, e.right, columns)).distinct()
    if isinstance(e, Not):
        return _match(src, e.left, columns).join(_match(src, e.right, columns), PAGE_KEY, "left_anti")
    if isinstance(e, Col):
        cols = e.selected()
        if columns is not None:
            cols = [c for c in cols if c in columns]
        return _match(src, e.expr, cols)
    words = _leaf_words(e, stem)
    if not words:
        raise ValueError(f"empty query leaf {e!r}")
    if isinstance(e, Term):
        out = None
        for w in words:  # several words in one Term: implicit AND
            m = _occurrences(src, [w], columns).select(*PAGE_KEY).distinct()
            out = m if out is None else out.join(m, PAGE_KEY, "left_semi")
        return out
    if isinstance(e, (Phrase, Prefix, Initial)):
        # word i must sit at pos0 + i of the same column: equi-joins on the
        # shifted position.
        occ = _occurrences(src, words, columns)
        first = _word_rows(occ, words[0]).select(*PAGE_KEY, "col", F.col("pos").alias("p0"))
        if isinstance(e, Initial):
            first = first.filter(F.col("p0") == 0)
        for i, w in enumerate(words[1:], start=1):
            nxt = _word_rows(occ, w).select(*PAGE_KEY, "col", (F.col("pos") - i).alias("p0"))
            first = first.join(nxt, PAGE_KEY + ["col", "p0"], "left_semi")
        return first.select(*PAGE_KEY).distinct()
    if isinstance(e, Near):
        return (_near_instances(_occurrences(src, words, columns), _near_members(e, stem), e.k)
                .select(*PAGE_KEY).distinct())
    raise TypeError(e)


def _word_rows(occ: DataFrame, w: tuple[str, bool]) -> DataFrame:
    word, is_prefix = w
    return occ.filter(F.col("term").startswith(word) if is_prefix else F.col("term") == word)


def _instances(occ: DataFrame, toks: list[str]) -> DataFrame:
    """Where a word or phrase starts: (doc_id, page_num, col, start)."""
    inst = _word_rows(occ, (toks[0], False)).select(*PAGE_KEY, "col", F.col("pos").alias("start"))
    for i, w in enumerate(toks[1:], start=1):
        nxt = _word_rows(occ, (w, False)).select(*PAGE_KEY, "col", (F.col("pos") - i).alias("start"))
        inst = inst.join(nxt, PAGE_KEY + ["col", "start"], "left_semi")
    return inst


def _near_instances(occ: DataFrame, members: list[list[str]], k: int) -> DataFrame:
    """The instances (doc_id, page_num, col, m, start) that take part in a NEAR
    match. Instances of every member (a phrase: consecutive tokens; a word: one
    token) are [start, end]; a page column matches when, for some instance at
    ``start`` that ends at ``end``, every member has an instance starting in
    [start, end + k + 1] -- that instance is then the first one, and the last
    one starts at most k tokens after its end. A range-framed window over the
    instances of one page column: groups are bounded by the page size.
    Repeated members may share an instance, as in the full-text index."""
    distinct = {" ".join(t): t for t in members}
    inst = None
    for key, toks in distinct.items():
        p = _instances(occ, toks).withColumn("end", F.col("start") + len(toks) - 1).withColumn("m", F.lit(key))
        inst = p if inst is None else inst.unionByName(p)
    longest = max(len(t) for t in members)
    win = (Window.partitionBy(*PAGE_KEY, "col").orderBy("start")
           .rangeBetween(Window.currentRow, longest + k))
    reach = F.col("end") + k + 1
    near = F.filter(F.collect_list(F.struct("start", "m")).over(win), lambda x: x["start"] <= reach)
    first = (inst.withColumn("near", near)
             .filter(F.size(F.array_distinct(F.transform("near", lambda x: x["m"]))) >= len(distinct)))
    return (first.select(*PAGE_KEY, "col", F.explode("near").alias("x"))
            .select(*PAGE_KEY, "col", F.col("x.m").alias("m"), F.col("x.start").alias("start")).distinct())


def _near_members(e: Near, stem: bool) -> list[list[str]]:
    members = [[fold_query_token(w, stem) for w in _query_tokens(m)] for m in e.words]
    return [m for m in members if m]


def match_pages(src, e: Expr) -> DataFrame:
    """Page keys (doc_id, page_num) matching a predicate."""
    return _match(query_occurrences(src, e), e)


def search_pages(src, documents: DataFrame, e: Expr, corpus: str | None = None,
                 page: int = 1, limit: int | None = S.LIST_LIMITS[0]) -> DataFrame:
    """Distinct (id, corpus, filename, page_count, page_num) of matching
    pages (page keys and document ids are unique), optional corpus filter (pushed to the document scan), ordered by
    (id, page_num) -- the reference leaves the order unspecified -- then paged.
    ``limit=None`` returns every match."""
    hits = match_pages(src, e)
    d = documents.select("id", "corpus", "filename", "page_count")
    if corpus:
        d = d.filter(F.col("corpus") == corpus)
    j = hits.join(d, hits["doc_id"] == d["id"]).select("id", "corpus", "filename", "page_count", "page_num")
    return paginate(j, [F.col("id"), F.col("page_num")], page, limit, S.LIST_LIMITS[1])


# ---------------------------------------------------------------------------
# Ranking (optional): BM25 as the full-text index defines it
# ---------------------------------------------------------------------------

# BM25 parameters and the floor of a non-positive IDF.
BM25_K1 = 1.2
BM25_B = 0.75
BM25_MIN_IDF = 1e-6


def page_lengths(pages: DataFrame) -> DataFrame:
    """Tokens per index row over all indexed columns (``doc_id``, ``page_num``,
    ``n_tokens``; null where a column is): counted in Arrow batches, no explode. Build it
    with the postings and keep it next to them."""
    whole = F.concat(*[x for c in FTS_COLUMNS for x in (F.lit(" "), F.col(c).cast("string"))])
    return index_pages(pages).select(*PAGE_KEY, count_tokens_udf(whole).alias("n_tokens"))


def _phrases(e: Expr, columns=None) -> list[tuple[Expr, object]]:
    """The leaves a ranking sums over: every word of a Term, every Phrase,
    Prefix, Initial and Near; the excluded side of NOT never hits a
    matching row, so it adds nothing."""
    if isinstance(e, (And, Or)):
        return _phrases(e.left, columns) + _phrases(e.right, columns)
    if isinstance(e, Not):
        return _phrases(e.left, columns)
    if isinstance(e, Col):
        cols = e.selected()
        return _phrases(e.expr, cols if columns is None else [c for c in cols if c in columns])
    if isinstance(e, Term):
        return [(Term(w), columns) for w in _query_tokens(e.text)]
    return [(e, columns)]


def _phrase_hits(src, e: Expr, columns, tag: int) -> DataFrame:
    """(tag, doc_id, page_num, f): instances of one phrase per page, for every
    page with the phrase. A NEAR counts, for each member under a tag of its
    own, the instances that take part in the match."""
    words = _leaf_words(e, src.stem)
    occ = _occurrences(src, words, columns)
    if isinstance(e, Near):
        members = _near_members(e, src.stem)
        found = _near_instances(occ, members, e.k).withColumn("hit", F.lit(1))
        first = None
        for i, m in enumerate(members):
            inst = _instances(occ, m).withColumn("m", F.lit(" ".join(m))).withColumn("tag", F.lit(f"{tag}.{i}"))
            first = inst if first is None else first.unionByName(inst)
        # a page where a member takes part in no match still counts as a row with the member
        return (first.join(found, [*PAGE_KEY, "col", "m", "start"], "left")
                .groupBy("tag", *PAGE_KEY).agg(F.count("hit").alias("f")))
    first = _word_rows(occ, words[0]).select(*PAGE_KEY, "col", F.col("pos").alias("p0"))
    if isinstance(e, Initial):
        first = first.filter(F.col("p0") == 0)
    for i, w in enumerate(words[1:], start=1):
        nxt = _word_rows(occ, w).select(*PAGE_KEY, "col", (F.col("pos") - i).alias("p0"))
        first = first.join(nxt, PAGE_KEY + ["col", "p0"], "left_semi")
    first = first.select(*PAGE_KEY, F.lit(str(tag)).alias("tag"))
    return first.groupBy("tag", *PAGE_KEY).agg(F.count(F.lit(1)).alias("f"))


def rank_pages(src, e: Expr, lengths: DataFrame) -> DataFrame:
    """Matching pages with a BM25 ``score`` (higher is better):
    sum over phrases of idf * f * (k1 + 1) / (f + k1 * (1 - b + b * D / avgdl)),
    idf = ln((N - n + 0.5) / (n + 0.5)) floored at 1e-6, N = index rows,
    n = rows with the phrase, D = tokens of the row, avgdl = mean D.
    One plan: the hits of all phrases, tagged, are written once; n is an
    aggregate by tag, N and avgdl are scalar subqueries over ``lengths``."""
    src = query_occurrences(src, e)
    hits = match_pages(src, e)
    parts = [_phrase_hits(src, ph, cols, i) for i, (ph, cols) in enumerate(_phrases(e))]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = materialize(found, "phrase-hits")
    n_rows = lengths.agg(F.count(F.lit(1))).scalar()
    avgdl = lengths.agg(F.coalesce(F.avg("n_tokens"), F.lit(1.0))).scalar()
    rows_with = found.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))  # one row per phrase of the query text
    idf = F.greatest(F.log((n_rows - F.col("n") + 0.5) / (F.col("n") + 0.5)), F.lit(BM25_MIN_IDF))
    norm = F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * F.col("n_tokens") / avgdl)
    score = idf * F.col("f") * F.lit(BM25_K1 + 1) / (F.col("f") + norm)
    scored = (found.join(hits, PAGE_KEY, "left_semi").join(lengths.select(*PAGE_KEY, "n_tokens"), PAGE_KEY)
              .join(rows_with, "tag").groupBy(*PAGE_KEY).agg(F.sum(score).alias("score")))
    return hits.join(scored, PAGE_KEY, "left").fillna(0.0, ["score"])


def search_ranked(src, documents: DataFrame, e: Expr, lengths: DataFrame, corpus: str | None = None,
                  page: int = 1, limit: int | None = S.LIST_LIMITS[0]) -> DataFrame:
    """X4 with ranking: the search result plus ``score``, best first
    (ties by id and page)."""
    ranked = rank_pages(src, e, lengths)
    d = documents.select("id", "corpus", "filename", "page_count")
    if corpus:
        d = d.filter(F.col("corpus") == corpus)
    j = ranked.join(d, ranked["doc_id"] == d["id"]).select("id", "corpus", "filename", "page_count",
                                                            "page_num", "score")
    return paginate(j, [F.col("score").desc(), F.col("id"), F.col("page_num")], page, limit,
                    S.LIST_LIMITS[1])
