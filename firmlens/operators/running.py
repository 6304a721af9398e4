"""Running totals within groups of any size: no group is gathered in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.shared import written


def running_totals(rows: DataFrame, group: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """rows with the totals of sums over the rows of their group up to themselves, in a total order (ties in any order).

    Rows are dealt by ranges of (group, order) and written once; each range adds up its own rows, and what stands before it
    comes from the ranges' totals, a row a range and group. Null is a group.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, F.col(group), *order).withColumn("_range", F.spark_partition_id())
    dealt = written(dealt.withColumns({f"_v_{k}": c for k, c in sums.items()}), "ranges")
    own = Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(F.col("_range").alias("_r"), F.col(group).alias("_g")).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    totals = totals.select("_r", "_g", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in sums])
    summed = dealt.withColumns({f"_o_{k}": F.sum(f"_v_{k}").over(own) for k in sums})
    out = summed.join(totals, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g")))
    return out.select(*rows.columns, *[(F.col(f"_o_{k}") + F.col(f"_b_{k}")).alias(k) for k in sums])


def numbered(rows: DataFrame, group: str, order: list[Column], name: str = "_n") -> DataFrame:
    """rows with their number in their group, from 1, by order."""
    return running_totals(rows, group, order, {name: F.lit(1).cast("long")})
