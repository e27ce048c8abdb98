"""Session builder with the settings that the operators rely on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


# What a session for streams adds: few state partitions, a stop that lets batches end, and the root of the queries' checkpoints.
STREAMING = {"spark.sql.shuffle.partitions": "10", "spark.streaming.stopGracefullyOnShutdown": "true", "spark.sql.streaming.metricsEnabled": "true"}


def build_session(app: str = "fleetspan", master: str | None = None, overrides: dict[str, str] | None = None, stream_root: str | None = None) -> SparkSession:
    """UTC session with adaptive execution; ``overrides`` win over the defaults.

    ``stream_root`` makes it a session for streams: the folder, on storage that all executors share, under which queries keep their
    checkpoints by name. ``spark.checkpoint.dir`` is the cluster's to name; see ``sources.lineage.shared_folder``.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if stream_root:
        conf |= STREAMING | {"spark.sql.streaming.checkpointLocation": stream_root}
    conf |= overrides or {}
    builder = SparkSession.builder.appName(app).config(map=conf)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors this package, once per context; they need neither the repository nor a search path.

    Spark distributes the archive; the temporary file is only the driver's copy of it.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_fleetspan_shipped", False):
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="fleetspan-")) / "fleetspan.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))
        sc._fleetspan_shipped = True
    return spark
