"""Cleaning, typing and metadata of rows. All lazy; a null never raises."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspan.functions.columns import in_box
from fleetspan.settings import BOXES, Box

PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}


def mandatory(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of the columns is null."""
    return df.dropna(subset=columns)


def inside_box(df: DataFrame, lat: str = "latitude", lon: str = "longitude", box: Box = BOXES["strict"]) -> DataFrame:
    return df.where(in_box(F.col(lat), F.col(lon), box))


def trimmed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns if c in df.columns})


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns that exist cast to their type; what cannot be cast becomes null."""
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items() if c in df.columns})


def with_time_parts(df: DataFrame, ts: str, parts: tuple[str, ...] = ("year", "month", "day", "hour")) -> DataFrame:
    return df.withColumns({p: PARTS[p](ts) for p in parts})


def with_processing(df: DataFrame, stage: str, job: str, at: Column | None = None) -> DataFrame:
    return df.withColumns({"processed_at": F.current_timestamp() if at is None else at, "processing_stage": F.lit(stage), "job_id": F.lit(job)})


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Every float and double rounded."""
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)})


def plain_name(name: str) -> str:
    """Lower case, without accents; white space becomes ``_`` and other signs go."""
    flat = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower().strip()
    return re.sub(r"[^\w]", "", re.sub(r"\s+", "_", flat))


def plain_names(df: DataFrame) -> DataFrame:
    """Columns under plain names; clashes get a number."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = plain_name(c) or "column"
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*out)


def clean_routes(df: DataFrame) -> DataFrame:
    """Upper-case trimmed short names, trimmed long names; routes without a short name go."""
    named = df.withColumns({"route_short_name": F.upper(F.trim("route_short_name")), "route_long_name": F.trim("route_long_name")})
    return named.where(F.length("route_short_name") > 0)


def placed_stops(df: DataFrame, lat: str = "stop_lat", lon: str = "stop_lon", name: str = "stop_name") -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & (F.length(name) > 0))


def valid_messages(df: DataFrame, required: list[str], source: str, at: Column | None = None) -> DataFrame:
    """Messages that have all keys and numeric coordinates, with where and when they came in."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    ok = ok & F.col("latitude").try_cast("double").isNotNull() & F.col("longitude").try_cast("double").isNotNull()
    return df.where(ok).withColumns({"ingestion_timestamp": F.current_timestamp() if at is None else at, "source": F.lit(source)})


def profile(df: DataFrame) -> dict:
    """Rows, columns, types and the optimizer's estimate of the size."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return {"rows": df.count(), "columns": len(df.columns), "dtypes": dict(df.dtypes), "bytes": int(str(size))}
