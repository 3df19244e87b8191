"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tagweave/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage, and survives the loss of executors because the copy is in shared storage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    # Partition values come back from folder names, so the schema must be stated.
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
