"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame

INPUT_PARTITIONS = "spark.quarry.inputPartitions"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a skinny input out to the number of partitions that the session
    names in ``spark.quarry.inputPartitions`` before CPU-heavy row work.

    Unset (the default, and right wherever the files give enough splits) nothing
    is shuffled. It is for inputs of few files or row groups, as in the tests and
    the benchmark, whose scan would leave most cores idle.
    """
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n), *keys) if n else df
