"""Run log, control tables, counters, timings, metrics and health of the pipeline."""

from __future__ import annotations

import json
import logging
import os
import resource
import time
import traceback
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime
from functools import wraps
from urllib.parse import quote, urlencode

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

RUNS = "job string, started_at timestamp, ended_at timestamp, seconds double, status string, records_in bigint, records_out bigint, error string"


@contextmanager
def job_run(spark: SparkSession, job: str, path: str | None = None, clock: Callable[[], datetime] = lambda: datetime.now(UTC)) -> Iterator[dict]:
    """Counts set on the yielded record go to the run log, with times and status; an error is logged and raised again."""
    record: dict = {"records_in": None, "records_out": None}
    begun, tick, status, error = clock(), time.monotonic(), "success", None
    try:
        yield record
    except Exception as e:
        status, error = "failed", "".join(traceback.format_exception_only(e)).strip()
        raise
    finally:
        record |= {"job": job, "started_at": begun, "ended_at": clock(), "seconds": time.monotonic() - tick, "status": status, "error": error}
        if path:
            row = tuple(record[c.split()[0]] for c in RUNS.split(", "))
            spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(path)


def observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also fills the metrics; no extra job. Distinct counts are not possible."""
    o = Observation(name)
    return df.observe(o, *[c.alias(n) for n, c in metrics.items()]), o


def long_metrics(df: DataFrame, metrics: dict[str, Column], labels: list[str] = ()) -> DataFrame:
    """Metrics of a frame in long form (``metric``, ``value`` and the labels), from one aggregate."""
    one = df.groupBy(*labels).agg(*[c.cast("double").alias(f"m{i}") for i, c in enumerate(metrics.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"m{i}").alias("value")) for i, n in enumerate(metrics)])
    return one.select(*labels, F.explode(pairs).alias("p")).select(*labels, "p.metric", "p.value")


def with_retries(call: Callable, times: int = 3, base: float = 1.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep):
    """The call's result; between tries it waits ``base`` doubled each time, at most ``most`` seconds."""
    for n in range(times):
        try:
            return call()
        except Exception:
            if n == times - 1:
                raise
            sleep(min(base * 2**n, most))
    raise ValueError("times has to be positive")


# Append-only tables of the pipeline's own record.
TABLES = {
    "runs": RUNS,
    "checks": "stage string, check_name string, value double, bound double, passed boolean, checked_at timestamp",
    "metrics": "metric string, label string, value double, at timestamp",
    "alerts": "metric string, severity string, value double, raised_at timestamp, resolved_at timestamp",
}


def record(df: DataFrame, root: str, name: str) -> None:
    """Appends rows to a control table; columns that are missing are null, others are left out."""
    have = set(df.columns)
    cols = [c.strip().rsplit(" ", 1) for c in TABLES[name].split(",")]
    df.select(*[(F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in cols]).write.mode("append").parquet(f"{root}/{name}")


def recall(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A control table."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def recent_runs(runs: DataFrame, order: list[str], most: int = 100) -> DataFrame:
    """The last runs; the order should be total."""
    return runs.orderBy(*[F.desc(c) for c in order]).limit(most)


class Counters:
    """Started, succeeded and failed runs of each stage, the seconds of the last one and when one last succeeded."""

    def __init__(self, clock: Callable[[], float] = time.time):
        self.clock, self.values = clock, {}

    def add(self, name: str, stage: str, by: float = 1.0) -> None:
        self.values[name, stage] = self.values.get((name, stage), 0.0) + by

    def put(self, name: str, stage: str, value: float) -> None:
        self.values[name, stage] = value

    def stage(self, name: str) -> Callable[[Callable], Callable]:
        """Decorator that counts the calls of a stage."""

        def around(f: Callable) -> Callable:
            @wraps(f)
            def run(*args, **kw):
                begun = time.monotonic()
                self.add("stage_started", name)
                try:
                    out = f(*args, **kw)
                except Exception:
                    self.add("stage_failed", name)
                    raise
                finally:
                    self.put("stage_seconds", name, time.monotonic() - begun)
                self.add("stage_succeeded", name)
                self.put("stage_last_success", name, self.clock())
                return out

            return run

        return around

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(m, s, float(v)) for (m, s), v in sorted(self.values.items())], "metric string, label string, value double")


def exposition(metrics: DataFrame, prefix: str = "fleet_", label: str = "label") -> DataFrame:
    """Metrics (``metric``, ``label``, ``value``) as lines of the text format that scrapers read."""
    name = F.regexp_replace(F.concat(F.lit(prefix), "metric"), "[^a-zA-Z0-9_:]", "_")
    text = F.regexp_replace(F.regexp_replace(F.coalesce(label, F.lit("")), r"\\", r"\\\\"), '"', r'\\"')
    return metrics.select(F.concat(name, F.lit('{' + label + '="'), text, F.lit('"} '), F.col("value").cast("string")).alias("line"))


def panels(series: DataFrame, top: int = 10, ts: str = "at") -> DataFrame:
    """A row for each metric and label of a series over time: mean, last value, increase (falls are restarts), rate a second; the ``top`` labels of each metric by their last value."""
    by = Window.partitionBy("metric", "label").orderBy(ts)
    step = F.col("value") - F.lag("value").over(by)
    grown = series.withColumn("up", F.when(step < 0, F.col("value")).otherwise(step))
    each = grown.groupBy("metric", "label").agg(F.avg("value").alias("mean"), F.max_by("value", ts).alias("last"), F.coalesce(F.sum("up"), F.lit(0.0)).alias("increase"), (F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))).alias("seconds"))
    ranked = each.withColumn("place", F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("last"), "label")))
    return ranked.where(F.col("place") <= top).select("metric", "label", "mean", "last", "increase", F.try_divide("increase", "seconds").alias("rate"), "place")


def histogram_quantile(buckets: DataFrame, share: float, by: str = "label") -> DataFrame:
    """The quantile of cumulative buckets (``le``, ``count``; the last bound may be infinite), by straight lines within a bucket."""
    w = Window.partitionBy(by).orderBy("le")
    b = buckets.withColumns({"low": F.coalesce(F.lag("le").over(w), F.lit(0.0)), "under": F.coalesce(F.lag("count").over(w), F.lit(0)), "want": F.lit(share) * F.max("count").over(Window.partitionBy(by))})
    hit = b.where("count >= want and (under < want or low = 0)").groupBy(by).agg(F.min_by(F.struct("le", "low", "under", "count", "want"), "le").alias("r")).select(by, "r.*")
    inside = F.col("low") + (F.col("le") - F.col("low")) * F.coalesce(F.try_divide(F.col("want") - F.col("under"), F.col("count") - F.col("under")), F.lit(1.0))
    return hit.select(by, F.when(F.col("le") == float("inf"), F.col("low")).otherwise(inside).alias("quantile"))


def probe(spark: SparkSession, components: dict[str, Callable[[], bool]]) -> DataFrame:
    """A row for each component: healthy, unhealthy (false or an error, with its text) and the seconds it took; rolled up by ``quality.health``."""
    rows = []
    for name, ask in components.items():
        begun, message = time.monotonic(), None
        try:
            ok = bool(ask())
        except Exception as e:
            ok, message = False, f"{type(e).__name__}: {e}"
        rows.append((name, "healthy" if ok else "unhealthy", message, time.monotonic() - begun))
    return spark.createDataFrame(rows, "component string, status string, message string, seconds double")


@contextmanager
def timed(into: dict[str, float], name: str) -> Iterator[None]:
    """Adds the seconds of a block, and the process's peak memory in bytes at its end."""
    begun = time.monotonic()
    try:
        yield
    finally:
        into[f"{name}_seconds"] = into.get(f"{name}_seconds", 0.0) + time.monotonic() - begun
        into[f"{name}_peak_bytes"] = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024.0


class JsonLines(logging.Formatter):
    """Log records as JSON, one a line."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"at": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            out["error"] = self.formatException(record.exc_info)
        return json.dumps(out, ensure_ascii=False)


def logger(name: str, level: str = "INFO") -> logging.Logger:
    """A logger that writes JSON lines, once."""
    log = logging.getLogger(name)
    if not any(isinstance(h.formatter, JsonLines) for h in log.handlers):
        h = logging.StreamHandler()
        h.setFormatter(JsonLines())
        log.addHandler(h)
    log.setLevel(level)
    return log


def env_flag(name: str, default: bool = False, env: dict[str, str] | None = None) -> bool:
    """An environment variable as yes or no."""
    text = (os.environ if env is None else env).get(name)
    return default if text is None or not text.strip() else text.strip().lower() in ("1", "true", "yes", "on")


def url(base: str, *parts: str, **query: object) -> str:
    """An address from its parts; a query without those that are None."""
    path = "/".join([base.rstrip("/"), *(quote(str(p).strip("/")) for p in parts)])
    asked = {k: v for k, v in query.items() if v is not None}
    return path + ("?" + urlencode(asked) if asked else "")
