"""Run bookkeeping: metrics, parameters, model versions and training logs as tables."""

from __future__ import annotations

import json
import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.operators.retrieval import metric_rows

VERSION_ORDER = "try_cast(version AS BIGINT)"


def run_metrics(metrics: DataFrame, epoch_losses: DataFrame, run_id: str) -> DataFrame:
    """All logged values of a run: ``(run_id, name, step, value)``; nulls are not logged.

    ``metrics`` is keyed by phase and split; the final phase has no prefix.
    """
    prefix = F.when(F.col("phase") == "baseline", "baseline_").otherwise("")
    split_rows = metric_rows(metrics, ["phase", "split"]).select(
        F.concat(prefix, F.col("split"), F.lit("_"), F.col("metric")).alias("name"),
        F.lit(None).cast("bigint").alias("step"),
        "value",
    )
    loss_rows = epoch_losses.select(
        F.lit("train_loss").alias("name"), F.col("epoch").cast("bigint").alias("step"), F.col("loss").alias("value")
    )
    rows = split_rows.unionByName(loss_rows).where("value is not null")
    return rows.select(F.lit(run_id).alias("run_id"), "name", "step", "value")


def run_params(split_sizes: DataFrame, run_id: str, params: dict[str, object]) -> DataFrame:
    """Parameters of a run as ``(run_id, key, value)``, with the sizes of the splits."""
    fixed_part = [F.struct(F.lit(k).alias("key"), F.lit(_text(v)).alias("value")) for k, v in params.items()]
    counted = [
        F.struct(F.lit(f"{s}_samples").alias("key"), F.col(f"n_{s}").cast("string").alias("value"))
        for s in ("train", "valid", "test")
    ]
    rows = split_sizes.select(F.explode(F.array(*fixed_part, *counted)).alias("p"))
    return rows.select(F.lit(run_id).alias("run_id"), "p.key", "p.value")


def _text(value: object) -> str:
    return json.dumps(value) if isinstance(value, (list, dict)) else str(value)


def latest_version(versions: DataFrame, groups: list[str]) -> DataFrame:
    """Highest version as a number: versions are text, and '10' sorts before '9' as text."""
    return versions.groupBy(*groups).agg(F.max(F.expr(VERSION_ORDER)).alias("latest_version"))


def recent_versions(versions: DataFrame, n: int = 5, id_width: int = 12) -> DataFrame:
    shown = versions.select("version", "status", F.left("run_id", F.lit(id_width)).alias("run_id_prefix"))
    return shown.orderBy(F.expr(VERSION_ORDER).desc()).limit(n)


def register_head(weights: DataFrame, versions: DataFrame, status: str, run_id: str) -> DataFrame:
    """Weights under the next version number: ``(version, status, run_id, head, row, weights)``."""
    newest = versions.agg(F.coalesce(F.max(F.expr(VERSION_ORDER)), F.lit(0)).alias("v")).scalar()
    return weights.select(
        (newest + 1).cast("string").alias("version"),
        F.lit(status).alias("status"),
        F.lit(run_id).alias("run_id"),
        *weights.columns,
    )


def claim_version(spark: SparkSession, registry: str, newest: int = 0) -> int:
    """Take the next version number in the folder ``registry``; of two takers each gets its own.

    A version is taken by making its marker file, which the file system does for one caller only.
    Whoever comes second tries the next number, so numbers rise but may have gaps after a
    failure. ``newest`` is the highest version known from elsewhere.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(registry)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    taken = [s.getPath().getName() for s in store.listStatus(folder)]
    version = max([newest, *(int(name[1:]) for name in taken if name[:1] == "v" and name[1:].isdigit())]) + 1
    while not _made(jvm, store, jvm.org.apache.hadoop.fs.Path(folder, f"v{version}")):
        version += 1
    return version


def _made(jvm, store, marker) -> bool:
    """Make an empty file unless it is there, in one step of the file system."""
    if store.getScheme() == "file":  # whose Hadoop client looks first and creates then
        try:
            os.close(os.open(marker.toUri().getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        store.create(marker, False).close()
    except Py4JJavaError:
        if store.exists(marker):
            return False
        raise
    return True


def publish_head(weights: DataFrame, versions: DataFrame, registry: str, status: str, run_id: str) -> DataFrame:
    """Store weights under a version of their own and return that version's rows, as ``register_head`` does.

    ``registry`` holds a marker per version and the weights below ``heads``, one folder each.
    """
    spark = weights.sparkSession
    newest = versions.agg(F.coalesce(F.max(F.expr(VERSION_ORDER)), F.lit(0)).alias("v")).first()["v"]
    version = claim_version(spark, registry, newest)
    rows = weights.select(F.lit(str(version)).alias("version"), F.lit(status).alias("status"), F.lit(run_id).alias("run_id"), *weights.columns)
    path = f"{registry}/heads/{version}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def best_epoch(log: DataFrame, groups: list[str]) -> DataFrame:
    """First epoch with the highest recall; null if recall never rises above zero."""
    key = F.when(F.col("recall") > 0, F.struct(F.col("recall"), (-F.col("epoch")).alias("order")))
    best = log.groupBy(*groups).agg(F.max(key).alias("b"))
    return best.select(
        *groups,
        (-F.col("b.order")).alias("best_epoch"),
        F.coalesce(F.col("b.recall"), F.lit(0.0)).alias("best_recall"),
    )


def running_best(log: DataFrame, groups: list[str]) -> DataFrame:
    """Best recall up to each epoch. A group has as many rows as the run has epochs."""
    so_far = Window.partitionBy(*groups).orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("best_so_far", F.greatest(F.max("recall").over(so_far), F.lit(0.0)))


def name_has_any(name: Column, parts: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in parts]), lambda part: F.contains(name, part))


def trainable_share(params: DataFrame, trainable_parts: list[str]) -> DataFrame:
    """Parameter counts and the share in trainable layers, in percent."""
    trainable = F.when(name_has_any(F.col("name"), trainable_parts), F.col("numel")).otherwise(F.lit(0))
    sums = params.agg(F.sum("numel").alias("total_params"), F.sum(trainable).alias("trainable_params"))
    percent = F.round(F.lit(100.0) * F.col("trainable_params") / F.col("total_params"), 2)
    return sums.withColumn("trainable_pct", percent)
