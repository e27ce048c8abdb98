"""Deduplication with total orders, and the merge of a table with newer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[Column | str], order: list[Column | str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key by ``order``, which should be total; nulls are smallest. Null keys are keys like any other.

    The aggregate is combined on the map side, so a key that holds a third of all rows, the null key too, reaches its task as a row for each task.
    """
    named = {f"__k{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)}
    pick = F.max_by if last else F.min_by
    out = df.groupBy(*[c.alias(n) for n, c in named.items()]).agg(pick(F.struct(*df.columns), F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])).alias("__row"))
    return out.select("__row.*")


def per_bucket(df: DataFrame, key: str, ts: str, seconds: int, tie: str) -> DataFrame:
    """The latest row of each key and time bucket."""
    bucket = F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / seconds)
    return first_of(df, [key, bucket], [ts, tie], last=True)


def best_quality(df: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """The row with the highest score; unknown scores come last, and the smaller ``tie`` wins."""
    return first_of(df, keys, [F.col(score).isNull(), -F.col(score), F.col(tie)])


def flag_later(df: DataFrame, keys: list[str], order: list[Column], name: str = "is_duplicate") -> DataFrame:
    """Flags all but the first row of each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) > 1)


def flag_all(df: DataFrame, keys: list[str], name: str = "is_duplicate") -> DataFrame:
    """Flags every row of a key that occurs more than once."""
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)) > 1)


def deduplicated(df: DataFrame, strategy: str, vehicle: str = "vehicle_id", ts: str = "timestamp", tie: str = "row_id", seconds: int = 60) -> DataFrame:
    """``first`` of each vehicle and time, ``last`` of each vehicle, or the latest of each ``time_window``."""
    if strategy == "first":
        return first_of(df, [vehicle, ts], [tie])
    if strategy == "last":
        return first_of(df, [vehicle], [ts, tie], last=True)
    if strategy == "time_window":
        return per_bucket(df, vehicle, ts, seconds, tie)
    raise ValueError(f"unknown strategy: {strategy}")


def merged_latest(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Old and new rows, of each key the one with the highest version; the new one wins a tie.

    The aggregate is combined on the map side. A null version loses. Both sides have the same columns.
    """
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    top = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(version).isNotNull(), F.col(version), F.col("__side"))).alias("row"))
    return top.select(*keys, "row.*").select(*old.columns)
