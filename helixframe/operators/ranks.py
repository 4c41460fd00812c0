"""Places in an order, without one task for all rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import kept


def ranked(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Adds the place of each row in its group by order, from 0, and <name>_of, the rows of the group.

    A range partitioning deals rows out in order, whatever their group; a row's place is that in its
    task behind those of its group in the tasks before. Rows that are alike in group and order are dealt out at random: give an order
    that tells them apart, or expect any of them first.
    """
    keys = [*by, *order]
    dealt = kept(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    runs = dealt.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # A row a group and task.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_of"), (before - F.col("_first")).alias("_shift"), F.sum("_n").over(group).alias(f"{name}_of"))
    same = dealt["_part"] == starts["_of"]
    for c in by:
        same &= dealt[c].eqNullSafe(starts[f"_by_{c}"])
    return dealt.join(starts, same).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(name), f"{name}_of")
