"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from quarry.session import checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it
    back: computed once, shared by every output derived from it, and not lost
    with an executor."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/quarry-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
