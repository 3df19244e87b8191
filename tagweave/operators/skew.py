"""Order, prefix sums and joins that keep a hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with at least 1/HOT_SHARE of all rows is hot, so there are never more than HOT_SHARE of them.
HOT_SHARE = 1000
HOT_MIN_ROWS = 100_000
HOT_SALTS = 64

# Summary tables up to this many rows are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 10_000

# A side is broadcast up to this many bytes, counted or estimated from its rows.
BROADCAST_BYTES = 32 * 1024 * 1024

# Blocks of a hash order. A block is sorted in one task, so there are many: 10^10 rows make 10^4 per block.
HASH_BLOCKS = 1 << 20


def bounded(stored: DataFrame) -> DataFrame:
    """A stored table of fixed-width columns and short texts, marked for broadcast if its bytes are few."""
    width = 16 + sum(8 if f.dataType.simpleString() not in ("string", "binary") else 64 for f in stored.schema.fields)
    most = BROADCAST_BYTES // width
    return F.broadcast(stored) if stored.limit(most + 1).count() <= most else stored


def hash_block(u: Column, blocks: int = HASH_BLOCKS) -> Column:
    """Block number that rises with a uniform draw: equal-sized blocks in draw order."""
    return F.floor(u * F.lit(blocks)).cast("long")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Use all cores for costly per-row work on a table scan with fewer splits than there are cores.

    A large table has more splits than cores and is left as it is. Only for plain scans: to
    count the partitions of a plan with a shuffle, Spark would have to run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def running_sum(
    df: DataFrame,
    groups: list[str],
    block: Column,
    order_by: list[Column],
    out: str,
    weight: Column | None = None,
    total: str | None = None,
) -> DataFrame:
    """Sum of ``weight`` over the rows before this one in its group, without one task per group.

    ``block`` must rise with ``order_by``. Blocks are summed first (map-side combined), the
    block sums are accumulated, and only rows of one block are ever sorted together. So a
    group that holds most of the table is spread over its blocks. With the default weight
    this is ``row_number() - 1``.

    What comes before a block is not joined on but sorted in as a head row of the block, so the
    rows are shuffled once, whatever the number of blocks.
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    blocked = df.withColumn("_block", block).withColumn("_weight", weight)
    keys = [*groups, "_block"]

    sums = blocked.groupBy(*keys).agg(F.sum("_weight").alias("_sum"))
    along = Window.partitionBy(*groups).orderBy("_block")
    carried = {"_before": F.sum("_sum").over(along) - F.col("_sum")}
    if total:
        carried[total] = F.sum("_sum").over(Window.partitionBy(*groups))
    heads = sums.select(*keys, *[c.alias(name) for name, c in carried.items()], F.lit(0).alias("_kind"))
    rows = blocked.withColumn("_kind", F.lit(1)).unionByName(heads, allowMissingColumns=True)

    inside = Window.partitionBy(*keys).orderBy("_kind", *order_by)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = F.sum("_weight").over(inside) - F.col("_weight")
    found = {name: F.first(name).over(inside) for name in carried}
    rows = rows.withColumns({"_local": local, **found}).where("_kind = 1")
    rows = rows.withColumn(out, F.col("_before") + F.col("_local"))
    return rows.drop("_block", "_weight", "_kind", "_before", "_local")


def skew_join(
    big: DataFrame,
    unique: DataFrame,
    on: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    spread_by: list[str] | None = None,
    min_rows: int = HOT_MIN_ROWS,
    salts: int = HOT_SALTS,
) -> DataFrame:
    """Join ``big``, whose keys may be hot, to a side with one row per key.

    Only hot keys are salted: their one row is copied to every salt and the rows of ``big``
    are spread over the salts. The list of hot keys has at most ``HOT_SHARE`` rows by its
    definition, so broadcasting it is safe on any input. ``counts`` is ``(on, n_rows)`` of
    ``big`` if the caller has it, which saves a pass. ``spread_by`` names the columns whose hash
    picks the salt (all by default); a hash gives the same salt when a task is run again.
    """
    if counts is None:
        counts = big.groupBy(*on).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    n = F.col("n_rows")
    hot = counts.where((n >= F.lit(min_rows)) & (n * F.lit(HOT_SHARE) >= total))
    hot = F.broadcast(hot.select(*on, F.lit(True).alias("_hot")))

    spread = F.pmod(F.xxhash64(*(spread_by or big.columns)), F.lit(salts)).cast("int")
    big = big.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0)))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    unique = unique.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return big.drop("_hot").join(unique, [*on, "_salt"], how).drop("_salt")


def join_summary(df: DataFrame, summary: DataFrame, on: list[str]) -> DataFrame:
    """Attach a summary that has one row for each key of ``df``.

    A summary that proves small is fetched, so that it is computed once, and broadcast; a single
    row becomes constants. Any other is joined with hot keys salted.
    """
    rows = summary.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) == 1:
        new = [f for f in summary.schema.fields if f.name not in on]
        return df.withColumns({f.name: F.lit(rows[0][f.name]).cast(f.dataType) for f in new})
    if len(rows) > BROADCAST_ROWS:
        return skew_join(df, summary, on)
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, summary.schema)), on)
