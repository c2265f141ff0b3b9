"""Ordering, paging and top-k helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validate_page(page: int, limit: int, cap: int) -> tuple[int, int]:
    """The endpoints' rules: page >= 1 and limit <= cap.

    A negative limit passes the reference's check and means "no limit" in its
    store; we refuse it instead (Spark rejects negative limits too).
    """
    if page is None or page < 1:
        raise ValueError(f"page must be >= 1, got {page}")
    if limit is None or limit < 0 or limit > cap:
        raise ValueError(f"limit must be in [0, {cap}], got {limit}")
    return page, limit


def paginate(df: DataFrame, order: Sequence[Column | str], page: int = 1,
             limit: int | None = 20, cap: int | None = 100) -> DataFrame:
    """Total order + ``OFFSET (page-1)*limit LIMIT limit``.

    ``order`` must be a total order (end with a key) so pages never overlap.
    ``limit=None`` returns the whole ordered result.
    Catalyst plans sort+limit as ``TakeOrderedAndProject``: each task keeps
    only ``offset+limit`` rows, so no full sort of the input happens.
    """
    out = df.orderBy(*order)
    if limit is None:
        return out
    if cap is not None:
        validate_page(page, limit, cap)
    offset = (page - 1) * limit
    if offset:
        out = out.offset(offset)
    return out.limit(limit)


Key = str | tuple[str, bool]  # a column, or a column and whether it ascends


def _parts(key: Sequence[Key]) -> list[tuple[str, bool]]:
    return [(k, True) if isinstance(k, str) else (k[0], k[1]) for k in key]


def order_of(key: Sequence[Key]) -> list[Column]:
    """The key as an order: nulls first where it ascends, last where it descends."""
    return [F.col(name).asc() if up else F.col(name).desc() for name, up in _parts(key)]


def page_after(df: DataFrame, key: Sequence[Key], after: Sequence | None = None, limit: int = 20) -> DataFrame:
    """The next ``limit`` rows in the total order ``key`` after the row whose key is ``after``
    (None: from the start). Columns may ascend or descend (``("created_at", False)``) and hold nulls. A whole
    traversal by the last key of each page keeps only ``limit`` rows per task, however deep."""
    if after is not None:
        beyond, equal = F.lit(False), F.lit(True)
        for (name, up), value in zip(_parts(key), after, strict=True):
            c = F.col(name)
            if value is None:
                here = c.isNotNull() if up else F.lit(False)
            else:
                here = c > F.lit(value) if up else (c < F.lit(value)) | c.isNull()
            beyond = beyond | (equal & F.coalesce(here, F.lit(False)))
            equal = equal & c.eqNullSafe(F.lit(value))
        df = df.filter(beyond)
    return df.orderBy(*order_of(key)).limit(limit)


def store_order(df: DataFrame, key: Sequence[Key], path: str, partitions: int | None = None) -> None:
    """Write ``df`` in the total order ``key`` for numbered pages: dealt by range, sorted, every row with
    its part and its place there, and the parts' sizes beside it."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    (df.repartitionByRange(n, *order_of(key)).sortWithinPartitions(*order_of(key)).withColumn("_at", at)
     .withColumn("_part", F.shiftright("_at", 33)).withColumn("_place", F.col("_at") % F.lit(1 << 33)).drop("_at")
     .write.mode("overwrite").partitionBy("_part").parquet(f"{path}/rows"))
    df.limit(0).write.mode("overwrite").parquet(f"{path}/empty")  # the columns, where there are no rows
    rows = df.sparkSession.read.schema("_part long").parquet(f"{path}/rows")
    rows.groupBy("_part").agg(F.count("*").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")


def numbered_page(spark, path: str, page: int, limit: int) -> DataFrame:
    """Page ``page`` (from 1) of a stored order, in order. The parts' sizes, one row each, tell which parts hold it; only
    these are read, and of them only the page's rows are kept: however deep, nothing before it is sorted or gathered."""
    if page < 1 or limit < 0:
        raise ValueError("page counts from 1, limit must not be negative")
    first, base, held = (page - 1) * limit, 0, []
    for r in spark.read.parquet(f"{path}/sizes").orderBy("_part").collect():
        low, high = max(0, first - base), min(r.n, first + limit - base)
        if low < high:
            held.append((r["_part"], low, high))
        base += r.n
    if not held:
        return spark.read.parquet(f"{path}/empty")
    rows = spark.read.parquet(f"{path}/rows")
    wanted = F.lit(False)
    for part, low, high in held:
        wanted = wanted | ((F.col("_part") == part) & (F.col("_place") >= low) & (F.col("_place") < high))
    return (rows.where(F.col("_part").isin([p for p, *_ in held])).where(wanted)
            .orderBy("_part", "_place").drop("_part", "_place"))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                    k: int, rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k within each group under a total ``order``.

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` below
    the shuffle, so a hot group sends at most k rows per map task, not all of
    its rows, to the final sort.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    rn = "__rn" if rank_col is None else rank_col
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out.drop("__rn") if rank_col is None else out
