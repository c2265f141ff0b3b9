"""Typed entity mentions with context (M1-M6).

The reference runs a statistical NER model per page. Its place is taken by a
table of typed patterns (the model stays pluggable: any
``DataFrame(doc_id, page_num, type, name, start)`` can feed the load path).
A page is matched by an Arrow-batched function that walks its matches once, so
the step is a narrow map, linear in the text and its matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S

PAGES_AT_ONCE = 256  # texts that are Python objects at one time

# The patterns that stand in for the NER model, as
# (entity type, regular expression). EMAIL is not a kept type and is
# dropped by the type filter, as the model's other labels are.
DEFAULT_PATTERNS = [
    ("PERSON", "[A-Z][a-z]{4,}"),
    ("ORG", "Licensed under [^\\n]+"),
    ("FAC", "[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}"),
    ("EMAIL", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"),
    ("DATE", "[0-9]{4}-[0-9]{2}-[0-9]{2}"),
]


def extract_mentions(pages: DataFrame, patterns: Sequence[tuple[str, str]] = DEFAULT_PATTERNS,
                     types: Sequence[str] = S.ENTITY_TYPES,
                     text_cap: int | None = None) -> DataFrame:
    """M1-M4: (doc_id, page_num, type, name, start, context) per mention.

    Per page: text is stripped, empty pages are skipped, patterns (Python
    regular expressions) run on the whole text; ``text_cap`` limits matching to
    the first characters of a page, for models with a bounded input
    (``schemas.MENTION_TEXT_CAP``). A name is the stripped span and must have
    >= 2 characters; the context is 60 characters each side clamped to the
    whole text, newlines made spaces, stripped. Patterns of types outside
    ``types`` are not even run (the filter of M2 applied at plan time).
    Extra columns of ``pages`` (corpus, filename, ...) are carried along.
    """
    keep = [(t, r) for t, r in patterns if t in set(types)]
    extra = [f for f in pages.schema.fields if f.name != "text"]
    schema = T.StructType([*extra, T.StructField("type", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("start", T.IntegerType()), T.StructField("context", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(t, re.compile(r)) for t, r in keep]
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                rows, found = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    text = (text or "").strip()
                    for type_, rx in compiled:
                        for m in rx.finditer(text if text_cap is None else text[:text_cap]):
                            name = m.group().strip()
                            if len(name) >= S.MENTION_MIN_LENGTH:
                                lo, hi = max(0, m.start() - S.MENTION_CONTEXT), m.end() + S.MENTION_CONTEXT
                                rows.append(i)
                                found.append((type_, name, m.start(), text[lo:hi].replace("\n", " ").strip()))
                take = pa.array(rows, pa.int64())
                columns = list(zip(*found, strict=True)) or [()] * 4
                kinds = (pa.string(), pa.string(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name).take(take) for f in extra),
                     *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names)

    return pages.mapInArrow(run, schema)


def distinct_entities_preview(mentions: DataFrame) -> DataFrame:
    """M5: distinct (type, name) per document with the first place seen."""
    return (mentions.groupBy("doc_id", "type", "name")
            .agg(F.min(F.struct("page_num", "start")).alias("_f"))
            .select("doc_id", "type", "name", F.col("_f.page_num").alias("first_page"),
                    F.col("_f.start").alias("first_start")))


def mention_count_report(mentions: DataFrame, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """M6: number of mentions found (per document by default)."""
    return mentions.groupBy(*by).agg(F.count(F.lit(1)).alias("mentions"))
