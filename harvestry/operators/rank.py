"""Global ranks and exact quantiles without a single task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harvestry.workdir import written


def running_total(df: DataFrame, weight: Column, *order: str, out: str = "total") -> DataFrame:
    """df with the sum of weights (longs) of all rows up to its own in the order of the columns, which should leave no ties for a definite result.

    Rows are dealt out by range and written with the number of their partition; a total is that within the partition plus those of the
    partitions before it. Only one number for each partition is gathered.
    """
    parts = written(df.withColumn("_weight", weight.cast("long")).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.groupBy("_part").agg(F.sum("_weight").alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum("_weight").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("_inside", inside).join(F.broadcast(offsets), "_part").withColumn(out, F.col("_inside") + F.col("_before")).drop("_part", "_inside", "_before", "_weight")


def global_rank(df: DataFrame, *order: str, out: str = "rank") -> DataFrame:
    """df with its place (long, from 1) in the order of the columns."""
    return running_total(df, F.lit(1), *order, out=out)


def quantiles(df: DataFrame, column: str, shares: dict[str, float], by: str | None = None) -> DataFrame:
    """Exact quantiles by name, interpolated linearly between neighbours: one row (nulls for no values), or one row for each value of `by`, whose values must be few."""
    group = F.col(by) if by else F.lit(0)
    values = df.where(F.col(column).isNotNull()).select(group.alias("g"), F.col(column).alias("x"), F.xxhash64(*df.columns).alias("tie"))
    ranked = global_rank(values, "g", "x", "tie", out="place")
    ends = ranked.groupBy("g").agg(F.min("place").alias("first"), F.count("*").alias("total"))
    ranked = ranked.join(F.broadcast(ends), "g").withColumn("place", F.col("place") - F.col("first") + 1)
    at = lambda p: (F.col("total") - 1) * F.lit(p)
    picked = [c for name, p in shares.items() for c in (F.max(F.when(F.col("place") == F.floor(at(p)) + 1, F.col("x"))).alias(f"_{name}_lo"), F.max(F.when(F.col("place") == F.ceil(at(p)) + 1, F.col("x"))).alias(f"_{name}_hi"))]
    row = (ranked.groupBy(F.col("g").alias(by)) if by else ranked).agg(*picked, F.max("total").alias("total"))
    return row.select(*([by] if by else []), *((F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * (at(p) - F.floor(at(p)))).alias(n) for n, p in shares.items()))
