"""The page index as loads keep it (X2, I6): segments with commit records.

Every load run or batch adds one named segment: its postings, vocabulary and page
lengths, each in a folder of its own. A segment counts once its commit record is
written, which is the last step; a killed attempt leaves files that no reader sees, and the
same name written again replaces them. A committed name is not written twice, so a
batch that is executed again adds nothing. Many small segments are merged by
``compact``: the merged segment's record names the ones it replaces, so readers change from
the old to the new ones at once, whatever happens in between.

Layout under the index path: ``postings/segment=S/bucket=B``, ``vocabulary/segment=S``,
``lengths/segment=S``, ``commits/segment=S``.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.search import (
    PostingsIndex,
    build_postings,
    build_vocabulary,
    page_lengths,
    posting_rows,
    write_posting_lists,
    write_postings,
)

COMMITS = "pages long, buckets int, replaces array<string>"
POSTINGS = "term string, doc_id array<string>, page_num array<int>, col string, pos array<int>, bucket int"  # lists over pages
VOCABULARY = "token string, bucket int, stem string"
LENGTHS = "doc_id string, page_num int, n_tokens int"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def commits(spark: SparkSession, path: str) -> dict:
    """Every committed segment's record, by name (one row per segment)."""
    if not _exists(spark, f"{path}/commits"):
        return {}
    rows = spark.read.schema(f"{COMMITS}, segment string").parquet(f"{path}/commits").collect()
    return {r.segment: r for r in rows}


def live_segments(spark: SparkSession, path: str) -> list[str]:
    """The committed segments that no committed one replaces."""
    known = commits(spark, path)
    gone = {s for r in known.values() for s in r.replaces}
    return sorted(s for s in known if s not in gone)


def _commit(spark: SparkSession, path: str, segment: str, pages: int, buckets: int, replaces: Sequence[str]) -> None:
    (spark.createDataFrame([(pages, buckets, list(replaces))], COMMITS).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/commits/segment={segment}"))


def _write(path: str, segment: str, buckets: int, postings: DataFrame, vocabulary: DataFrame | None, lengths: DataFrame) -> None:
    """The tables of a segment: new ones of a load, whose vocabulary is taken from the written postings, or
    merged ones with their vocabulary."""
    if vocabulary is not None:
        write_postings(postings, f"{path}/postings/segment={segment}", order=())  # many runs become one
        vocabulary = vocabulary.repartitionByRange("token")
    else:
        write_posting_lists(postings, f"{path}/postings/segment={segment}", buckets)
        vocabulary = build_vocabulary(postings.sparkSession.read.schema(POSTINGS).parquet(f"{path}/postings/segment={segment}"))
    # sorted by word: a prefix reads the files and row groups around it only
    (vocabulary.sortWithinPartitions("token")
     .write.mode("overwrite").parquet(f"{path}/vocabulary/segment={segment}"))
    lengths.write.mode("overwrite").parquet(f"{path}/lengths/segment={segment}")


def append_pages(pages: DataFrame, path: str, buckets: int, segment: str | None = None) -> bool:
    """Add ``pages`` as a segment and commit it. With a name (a run's or batch's id) the call may be
    repeated: what an attempt left that did not commit is replaced, and nothing is done (False) if the
    name is committed. Without one every call adds a segment."""
    spark = pages.sparkSession
    segment = segment or f"s-{uuid.uuid4().hex[:16]}"
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", segment):
        raise ValueError(f"a segment's name holds letters, digits, dots and dashes only, not {segment!r}")
    known = commits(spark, path)
    if segment in known:
        return False
    others = {r.buckets for r in known.values()} - {buckets}
    if others:
        raise ValueError(f"the index has {min(others)} buckets, not {buckets}")
    _write(path, segment, buckets, build_postings(pages, buckets, lists="pages"), None, page_lengths(pages))
    _commit(spark, path, segment, spark.read.schema(LENGTHS).parquet(f"{path}/lengths/segment={segment}").count(), buckets, [])
    return True


def _read(spark: SparkSession, path: str, table: str, segments: Sequence[str], schema: str) -> DataFrame:
    if not segments:
        return spark.createDataFrame([], schema)
    df = spark.read.option("basePath", f"{path}/{table}").parquet(*[f"{path}/{table}/segment={s}" for s in segments])
    return df.drop("segment")


def _filled(spark: SparkSession, path: str) -> list[str]:
    known = commits(spark, path)
    return [s for s in live_segments(spark, path) if known[s].pages]


def open_index(spark: SparkSession, path: str, stem: bool = True) -> PostingsIndex:
    """The committed pages, ready to be searched. A word may stand in the vocabulary of several segments."""
    known, segments = commits(spark, path), _filled(spark, path)
    buckets = next((r.buckets for r in known.values()), 1)
    lists = _read(spark, path, "postings", segments, POSTINGS)
    return PostingsIndex(posting_rows(lists), buckets, stem, _read(spark, path, "vocabulary", segments, VOCABULARY), lists)


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """Tokens of every committed page, for ranking."""
    return _read(spark, path, "lengths", _filled(spark, path), LENGTHS)


def compact(spark: SparkSession, path: str, segments: Sequence[str] | None = None) -> str | None:
    """Merge segments (default: all live ones) into one, with one row per word in its vocabulary. Returns
    its name, None if there is nothing to merge. The name follows from the merged ones', so a killed
    run that is repeated replaces its own files."""
    known, live = commits(spark, path), live_segments(spark, path)
    merged = sorted(live if segments is None else segments)
    if not set(merged) <= set(live):
        raise ValueError(f"not live: {sorted(set(merged) - set(live))}")
    if len(merged) < 2:
        return None
    name = "c-" + hashlib.sha256("\n".join(merged).encode()).hexdigest()[:16]
    filled = [s for s in merged if known[s].pages]
    _write(path, name, known[merged[0]].buckets, _read(spark, path, "postings", filled, POSTINGS),
           _read(spark, path, "vocabulary", filled, VOCABULARY).distinct(), _read(spark, path, "lengths", filled, LENGTHS))
    _commit(spark, path, name, sum(known[s].pages for s in merged), known[merged[0]].buckets, merged)
    return name


def drop_replaced(spark: SparkSession, path: str) -> list[str]:
    """Delete the files of segments that a merged one replaces (once no reader holds them). Their commit
    records stay, so that their names stay taken."""
    known = commits(spark, path)
    gone = sorted({s for r in known.values() for s in r.replaces})
    for s in gone:
        for table in ("postings", "vocabulary", "lengths"):
            p, fs = _path(spark, f"{path}/{table}/segment={s}")
            fs.delete(p, True)
    return gone
