"""Static timetable feeds: extraction, scan, typing, report."""

from __future__ import annotations

import shutil
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fleetspan.operators.clean import typed
from fleetspan.schemas import SCHEMAS, schema
from fleetspan.sources.sinks import exists

REQUIRED = ("stops", "routes", "trips", "stop_times")


def extract(archive: str, folder: str, again: bool = False) -> list[str]:
    """Files of a feed in ``folder``; an extracted feed is kept unless ``again``. Names that leave the folder are refused."""
    to = Path(folder)
    if again and to.exists():
        shutil.rmtree(to)
    if not to.exists():
        with zipfile.ZipFile(archive) as z:
            if any(not (to / n).resolve().is_relative_to(to.resolve()) for n in z.namelist()):
                raise ValueError("the archive has names outside its folder")
            z.extractall(to)
    return sorted(p.name for p in to.iterdir())


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file as text columns, without a byte order mark in the first name."""
    df = spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8").option("multiLine", False).csv(path)
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the feed, typed by its declared schema; columns without a declared type stay text."""
    kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema("gtfs", name))}
    return typed(scan(spark, f"{folder}/{name}.txt"), kinds)


def report(spark: SparkSession, folder: str) -> dict:
    """Rows of each known file, the required files that are missing, and the empty ones."""
    here = {n: f"{folder}/{n}.txt" for n in SCHEMAS["gtfs"] if exists(spark, f"{folder}/{n}.txt")}
    rows = {n: scan(spark, p).count() for n, p in here.items()}
    missing = [n for n in REQUIRED if n not in rows]
    return {"rows": rows, "missing": missing, "empty": [n for n, k in rows.items() if not k], "valid": not missing}
