"""X4 in bulk: many page searches in one job.

Queries are compiled to rows: one for every word of every leaf (a word, phrase, prefix,
initial or NEAR), and for each query a small program over its leaves. The plan is the
same however many queries there are:

1. the distinct words become index terms (by the vocabulary for stems and
   prefixes), and one scan of the postings, pruned to the terms' buckets, finds their occurrences;
2. an occurrence of word i of a phrase votes for the phrase starting i places before it; a
   start with as many votes as words is an instance;
3. the instances of a NEAR are looked at through a window over one page column;
4. the leaves found on a page are gathered per query, and the query's program (leaf
   numbers and operators in postfix order) is run over that set.

A page counts for a query only if one of its leaves is there, which holds for AND, OR and
NOT (its left side must match). Groups are one page's occurrences of the queries' words.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.scratch import materialize
from quarry.operators.search import (
    FTS_COLUMNS,
    PAGE_KEY,
    And,
    Col,
    Expr,
    Initial,
    Near,
    Not,
    Or,
    PostingsIndex,
    Prefix,
    Term,
    _leaf_words,
    _near_members,
    _query_tokens,
    term_bucket,
)

AND, OR, NOT = -1, -2, -3
VOTES = 1_000_000  # rows of one task
WORDS = ("query_id string, leaf int, member int, place int, size int, word string, is_prefix boolean, cols array<string>, "
         "initial boolean, members int, reach int")
PROGRAMS = "query_id string, corpus string, program array<int>"


class _Compiler:
    """The rows of one query."""

    def __init__(self, query_id: str, stem: bool):
        self.query_id, self.stem, self.leaves, self.rows = query_id, stem, 0, []

    def _member(self, words: list[tuple[str, bool]], member: int, members: int, columns, initial: bool, reach: int) -> None:
        self.rows += [(self.query_id, self.leaves, member, place, len(words), word, is_prefix, list(columns), initial, members, reach)
                      for place, (word, is_prefix) in enumerate(words)]

    def program(self, e: Expr, columns: Sequence[str] = FTS_COLUMNS) -> list[int]:
        """Postfix program of ``e``; its leaves are added to the rows."""
        if isinstance(e, (And, Or, Not)):
            return [*self.program(e.left, columns), *self.program(e.right, columns), {And: AND, Or: OR, Not: NOT}[type(e)]]
        if isinstance(e, Col):
            return self.program(e.expr, [c for c in e.selected() if c in columns])
        words = _leaf_words(e, self.stem)
        if not words:
            raise ValueError(f"empty query leaf {e!r}")
        if isinstance(e, Term) and len(words) > 1:  # several words in one Term: implicit AND
            parts = [self.program(Term(w), columns) for w in _query_tokens(e.text)]
            return [*parts[0], *(op for part in parts[1:] for op in [*part, AND])]
        if isinstance(e, Near):
            members = list(dict.fromkeys(tuple(m) for m in _near_members(e, self.stem)))
            for i, m in enumerate(members):
                self._member([(w, False) for w in m], i, len(members), columns, False, e.k + 1)
        else:
            self._member(words, 0, 1, columns, isinstance(e, Initial), -1)
        self.leaves += 1
        return [self.leaves - 1]


def compile_queries(spark, queries: Iterable[tuple], stem: bool) -> tuple[DataFrame, DataFrame, set[int], int]:
    """From (query_id, expression[, corpus]) the tables of words and of programs, the lengths of the
    prefixes, and how far the widest NEAR looks."""
    words, programs = [], []
    for query_id, e, *corpus in queries:
        c = _Compiler(str(query_id), stem)
        programs.append((c.query_id, corpus[0] if corpus else None, c.program(e)))
        words += c.rows
    if len({p[0] for p in programs}) < len(programs):
        raise ValueError("query ids must be distinct")
    widest = max((size + reach for *_, size, _, _, _, _, _, reach in words if reach >= 0), default=0)
    return (spark.createDataFrame(words, WORDS), spark.createDataFrame(programs, PROGRAMS),
            {len(w[5]) for w in words if w[6]}, widest)


def _terms(index: PostingsIndex, asked: DataFrame, prefix_lengths: set[int]) -> DataFrame:
    """bucket, term, word, is_prefix: the index terms of the distinct words asked for."""
    exact = asked.where("NOT is_prefix")
    if index.stem:
        if index.vocab is None:
            raise ValueError("a stemmed PostingsIndex needs its vocabulary (build_vocabulary)")
        forms = index.vocab.select("bucket", F.col("token").alias("term"), F.col("stem").alias("word"))
        out = forms.join(exact, "word")
    else:
        out = exact.select(term_bucket(F.col("word"), index.buckets).alias("bucket"), F.col("word").alias("term"), "word", "is_prefix")
    out = out.select("bucket", "term", "word", "is_prefix")
    if prefix_lengths:
        vocabulary = index.vocab if index.vocab is not None else (
            index.postings.select("bucket", F.col("term").alias("token"), F.col("term").alias("stem")).distinct())
        key = F.col("stem" if index.stem else "token")
        cut = (vocabulary.select("bucket", F.col("token").alias("term"), key.alias("key"),
                                 F.explode(F.array(*[F.lit(n) for n in sorted(prefix_lengths)])).alias("n"))
               .where("length(key) >= n").select("bucket", "term", F.expr("substring(key, 1, n)").alias("word")))
        out = out.unionByName(cut.join(asked.where("is_prefix"), "word").select(*out.columns))
    return out.distinct()


def _near_hits(instances: DataFrame, widest: int) -> DataFrame:
    """Leaves (page, query_id, leaf) of the NEARs: some instance has an instance of every member start
    within its reach, itself included."""
    win = (Window.partitionBy(*PAGE_KEY, "col", "query_id", "leaf").orderBy("start").rangeBetween(Window.currentRow, widest))
    near = F.filter(F.collect_list(F.struct("start", "member")).over(win),
                    lambda x: x["start"] <= F.col("start") + F.col("size") - 1 + F.col("reach"))
    return (instances.withColumn("near", near)
            .where(F.size(F.array_distinct(F.transform("near", lambda x: x["member"]))) >= F.col("members"))
            .select(*PAGE_KEY, "query_id", "leaf"))


def _holds(program: Column, leaves: Column) -> Column:
    """The value of a postfix program, given the leaves that are there."""
    def step(stack: Column, op: Column) -> Column:
        a, b = F.try_element_at(stack, F.lit(-2)), F.try_element_at(stack, F.lit(-1))
        joined = F.when(op == AND, a & b).when(op == OR, a | b).otherwise(a & ~b)
        return F.when(op >= 0, F.concat(stack, F.array(F.array_contains(leaves, op)))).otherwise(
            F.concat(F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 2, F.lit(0))), F.array(joined)))
    return F.element_at(F.aggregate(program, F.array().cast("array<boolean>"), step), 1)


def match_batch(index: PostingsIndex, queries: Iterable[tuple]) -> DataFrame:
    """query_id, corpus (the one asked for), doc_id, page_num of every match."""
    spark = index.postings.sparkSession
    words, programs, prefix_lengths, widest = compile_queries(spark, queries, index.stem)
    terms = materialize(_terms(index, words.select("word", "is_prefix").distinct(), prefix_lengths), "batch-terms")
    buckets = [r.bucket for r in terms.select("bucket").distinct().collect()]  # at most the index's buckets
    pruned = F.col("bucket").isin(buckets)
    lists = None if index.lists is None else index.lists.where(pruned)
    found = (replace(index, postings=index.postings.where(pruned), lists=lists).of_terms(terms)
             .select(*PAGE_KEY, "col", "pos", "word", "is_prefix"))
    leaf_of = ["query_id", "leaf", "member", "size", "members", "reach"]
    votes = materialize(found.join(words, ["word", "is_prefix"]).where("array_contains(cols, col)")
                        .select(*PAGE_KEY, "col", (F.col("pos") - F.col("place")).alias("start"), "initial", *leaf_of)
                        .where("NOT initial OR start = 0"), "batch-votes")
    # Votes are small once written, but nearly all differ: counted where they are read, one task's table of them
    # would grow with the input. A page's votes go to one task first, about VOTES of them to each.
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    votes = votes.repartition(max(width, votes.count() // VOTES), *PAGE_KEY)
    several = (votes.where("size > 1").groupBy(*PAGE_KEY, "col", "start", *leaf_of).agg(F.count("*").alias("votes"))
               .where("votes = size").drop("votes"))
    instances = votes.where("size = 1").drop("initial").unionByName(several)
    plain = instances.where("reach < 0").select(*PAGE_KEY, "query_id", "leaf")
    near = _near_hits(instances.where("reach >= 0"), widest)
    there = plain.unionByName(near).groupBy(*PAGE_KEY, "query_id").agg(F.collect_set("leaf").alias("leaves"))
    return (there.join(programs, "query_id").where(_holds(F.col("program"), F.col("leaves")))
            .select("query_id", "corpus", *PAGE_KEY))


def search_batch(index: PostingsIndex, documents: DataFrame, queries: Iterable[tuple], page: int = 1,
                 limit: int | None = None) -> DataFrame:
    """X4 for many queries (query_id, expression[, corpus]): query_id, id, corpus, filename, page_count,
    page_num of the matching pages; with ``limit`` the given page of each query's result in
    order of (id, page_num). A query without a match has no rows; no queries give none."""
    hits = match_batch(index, queries).withColumnRenamed("corpus", "wanted")
    d = documents.select("id", "corpus", "filename", "page_count")
    out = (hits.join(d, hits["doc_id"] == d["id"]).where("wanted IS NULL OR wanted = corpus")
           .select("query_id", "id", "corpus", "filename", "page_count", "page_num"))
    if limit is None:
        return out
    if page < 1 or limit < 0:
        raise ValueError("page counts from 1, limit must not be negative")
    number = F.row_number().over(Window.partitionBy("query_id").orderBy("id", "page_num"))
    return (out.withColumn("_n", number).where(F.col("_n") <= page * limit).where(F.col("_n") > (page - 1) * limit).drop("_n"))
