"""Line dedup: repeated lines leave every document but one.

Two Bloom filters (hashes seen once, hashes seen twice) over the line keys of
each document decide which lines can be repeats. Only those lines' digests are
shuffled, counted exactly and resolved to the one document that keeps them; the
text itself moves once, to meet its document's list of dropped keys.

Key of a line: stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased;
digests are 128-bit BLAKE2b of the key.

Defined edge cases: a null or empty text is one empty line; a row without a
doc_id neither counts as a document nor loses lines; rows that repeat a doc_id
count as one document and are all rewritten; lines shorter than
``min_chars`` code points always stay; an empty table gives an empty result;
further columns are kept untouched (rows are matched by doc_id alone).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import bloom
from quarry.llm.common import cut, release, slices

STRIPPED = b" \t\n\x0b\x0c\r"
SALTS = 32


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def _digest(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip(STRIPPED)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()  # bytes.lower() maps A-Z only


def _digests(text: str | None, min_chars: int) -> set[bytes]:
    found = {_digest(line, min_chars) for line in _split(text)}
    found.discard(None)
    return found


def _hash64(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8")[::2]


def dropped_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5,
                  log2_bits: int = 27) -> DataFrame:
    """doc_id, dropped: the digests of the lines that each document loses."""
    spark = docs.sparkSession
    release(spark)
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")

    def hashes_of(batch: pa.RecordBatch) -> np.ndarray:
        out: list[bytes] = []
        for part in slices([batch]):
            for text in part.column(0).to_pylist():
                out.extend(_digests(text, min_chars))
        return _hash64(out)

    filter_bits = spark.sparkContext.broadcast(
        bloom.twice_filter(texts.select("text"), hashes_of, log2_bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(filter_bits.value, np.uint8)
        for part in slices(batches):
            ids, keys = [], []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                found = list(_digests(text, min_chars))
                if found:
                    hit = bloom.suspected(_hash64(found), bits, log2_bits)
                    keep = [d for d, x in zip(found, hit, strict=True) if x]
                    ids += [doc_id] * len(keep)
                    keys += keep
            yield pa.RecordBatch.from_arrays([pa.array(ids, part.schema.field(0).type), pa.array(keys, pa.binary())],
                                             ["doc_id", "digest"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("digest", T.BinaryType())])
    seen = cut(texts.mapInArrow(suspects, schema), "line-suspects").distinct()
    repeated = (seen.groupBy("digest").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
                .where(F.col("n_docs") >= min_docs)
                .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    return (seen.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
            .join(repeated, ["digest", "salt"]).where(F.col("doc_id") < F.col("keeper"))
            .groupBy("doc_id").agg(F.collect_list("digest").alias("dropped")))


def _rewritten(docs: DataFrame, min_chars: int, min_docs: int, log2_bits: int) -> DataFrame:
    """row (all columns of ``docs``, the repeated lines cut from ``text``), n_lines, n_dropped. The row travels as a
    struct, so that no column's name matters."""
    drops = dropped_lines(docs, min_chars=min_chars, min_docs=min_docs, log2_bits=log2_bits)
    names = docs.columns
    wide = docs.select(F.col("doc_id"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    joined = wide.join(drops, "doc_id", "left").select("row", "dropped")
    schema = T.StructType([joined.schema["row"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    at = names.index("text")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fields = part.column("row").flatten()
            texts, n_lines, n_dropped = [], [], []
            for text, dropped in zip(fields[at].to_pylist(), part.column("dropped").to_pylist(), strict=True):
                lines = _split(text)
                n_lines.append(len(lines))
                if dropped:
                    dropped = set(dropped)
                    kept = [x for x in lines if _digest(x, min_chars) not in dropped]
                    text = b"\n".join(kept).decode()
                    n_dropped.append(len(lines) - len(kept))
                else:
                    n_dropped.append(0)
                texts.append(text)
            fields[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, names), pa.array(n_lines, pa.int64()),
                                              pa.array(n_dropped, pa.int64())], ["row", "n_lines", "n_dropped"])

    return joined.mapInArrow(rewrite, schema)


def dedup_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5,
                log2_bits: int = 27) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated lines cut from
    ``text`` (null text stays null), plus ``n_lines`` (before) and
    ``n_dropped``; columns that already have these names are replaced."""
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return _rewritten(docs, min_chars, min_docs, log2_bits).select(*kept, "n_lines", "n_dropped")


def cut_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5, log2_bits: int = 27) -> DataFrame:
    """The rows of ``docs`` with exactly its columns, whatever their names: repeated lines are cut from
    ``text``, and ``n_chars``, if there is one, follows where a text lost lines."""
    size = F.when(F.col("n_dropped") > 0, F.length("row.text")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None
    return _rewritten(docs, min_chars, min_docs, log2_bits).select(
        *[size.cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what is left."""
    done = dedup_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


# DuckDB: keys of at least 40 code points in at least 5 documents.
REPORT_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.key IS NOT NULL AND l.doc_id < r.keeper) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i)
                       FILTER (WHERE r.key IS NULL OR l.doc_id >= r.keeper), '')) AS kept_sha256
FROM lines l LEFT JOIN repeated r ON l.key = r.key GROUP BY l.doc_id
"""
