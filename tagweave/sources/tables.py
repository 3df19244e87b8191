"""Tables: schema creation, overwrite, scans by split, and ingest bookkeeping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def save_table(df: DataFrame, table: str, path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite a catalog table (at ``path`` if given) and return a scan of it."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def append_runs(rows: DataFrame, path: str, key: str = "run_id") -> None:
    """Add the rows of one or more runs to the table at ``path``, in place of what these runs had there.

    The table is stored by run, and only the folders of the runs at hand are written anew: other
    runs stay as they are, and a run that is repeated, also after a failure, is not there twice.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def scan_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All runs of a table. The schema is stated, since keys come back from folder names."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def scan_split(table: DataFrame, split: str) -> DataFrame:
    """One split. On a table partitioned by split this reads that folder only."""
    return table.where(F.col("split") == split)


def row_count(table: DataFrame, name: str) -> DataFrame:
    return table.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def check_columns(df: DataFrame, required: dict[str, str], optional: dict[str, str]) -> DataFrame:
    """Apply a declared signature: a missing required column is an error, an optional one is null."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    for name, kind in {**required, **optional}.items():
        have = df.schema[name].dataType if name in df.columns else None
        if have is not None and not isinstance(have, T.NullType) and have.simpleString() != kind:
            raise ValueError(f"column {name} is {have.simpleString()}, expected {kind}")
    extra = [F.lit(None).cast(kind).alias(name) for name, kind in optional.items() if name not in df.columns]
    return df.select("*", *extra)


def resume_ingest(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The wanted items that are not done yet. Repeats of a done item collapse before the shuffle."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def scan_ledger(spark: SparkSession, path: str, key: T.StructField) -> DataFrame:
    """``(key, path_or_err, ok, batch)`` of all batches so far; no rows before the first one."""
    schema = T.StructType([key]).add("path_or_err", "string").add("ok", "boolean").add("batch", "integer")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return scan_runs(spark, path, schema)


def ingest(wanted: DataFrame, path: str, key: str, batch: int, load: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
    """One batch of an ingest that can be resumed; returns its ``n_loaded`` and ``n_failed``.

    ``load`` turns rows of ``wanted`` into ``(key, path_or_err, ok)``. It gets the rows that no other
    batch in the ledger at ``path`` has loaded, so what failed before is tried again. A batch that
    is repeated, also after a lost job, replaces its own rows, and a job that fails adds none; a
    repeated batch must want what it wanted before. A null key is never found in the ledger and so
    loaded by each batch; a null ``ok`` counts as failed. Rows are counted while they are written.
    """
    spark = wanted.sparkSession
    ledger = scan_ledger(spark, path, wanted.schema[key])
    done = ledger.where((F.col("batch") != batch) & F.col("ok"))
    outcomes = load(resume_ingest(wanted, done, key)).select(
        F.col(key), "path_or_err", F.coalesce("ok", F.lit(False)).alias("ok"), F.lit(batch).alias("batch")
    )
    counted = Observation()
    append_runs(outcomes.observe(counted, F.count_if("ok").alias("n_loaded"), F.count_if(~F.col("ok")).alias("n_failed")), path, "batch")
    return counted.get


def ingest_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count_if(F.col("ok")).alias("n_loaded"),
        F.count_if(~F.col("ok")).alias("n_failed"),
        F.count("*").alias("n_wanted"),
    )
