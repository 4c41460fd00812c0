"""Choosing ids and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def id_slice(column: Column, selector: str) -> Column:
    """Condition of an id selector: all, i:n (remainder i of the trailing digits modulo n), or a comma-separated list."""
    if selector == "all":
        return F.lit(True)
    if ":" in selector:
        i, n = map(int, selector.split(":"))
        if not 0 <= i < n:
            raise ValueError(f"slice {selector} is not within 0:{n} to {n - 1}:{n}")
        return F.pmod(F.regexp_extract(column.cast("string"), r"(\d+)$", 1).cast("long"), F.lit(n)) == i
    return column.cast("string").isin([s.strip() for s in selector.split(",")])


def first_per_key(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), ordinal).alias("row")).select(*key, "row.*")


def last_per_key(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), ordinal).alias("row")).select(*key, "row.*")


def numbered(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """Serial number from 1 within each group."""
    return df.withColumn("serial", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
