"""Cutting lineage and keeping stores on storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and stores: the one the session names in ``spark.checkpoint.dir`` or has been given as checkpoint folder.

    Where neither is set, a session on one machine (``local[...]``) gets a folder of that machine; on a cluster that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    given = sc._jsc.sc().getCheckpointDir()
    if not given.isDefined():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fleetspan-"))
        given = sc._jsc.sc().getCheckpointDir()
    return given.get().rstrip("/")


def new_store(spark: SparkSession, name: str) -> str:
    """A path of its own for a store in the shared folder; it lives as long as the folder, as checkpoints do."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there."""
    sc = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(folder)
    return df.checkpoint()
