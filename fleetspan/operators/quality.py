"""Row flags, data-set checks, scores, alerts. Each check of a data set is one aggregate over one scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.errors import QualityError, SchemaError
from fleetspan.functions.columns import banded, in_box
from fleetspan.settings import BOXES, Box


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def type_mismatches(df: DataFrame, kinds: dict[str, str]) -> dict[str, tuple[str, str | None]]:
    """Column -> (expected, found) where they differ; found is None for a missing column."""
    have = dict(df.dtypes)
    return {c: (k, have.get(c)) for c, k in kinds.items() if have.get(c) != k}


def check_schema(df: DataFrame, kinds: dict[str, str]) -> None:
    if wrong := type_mismatches(df, kinds):
        raise SchemaError(f"schema differs: {wrong}", "schema", {"mismatches": wrong})


def flags(df: DataFrame, required: list[str], now: Column, box: Box = BOXES["wide"], limit: float = 120.0, stale_hours: int = 24, ts: str = "ts") -> DataFrame:
    """``has_nulls``, ``out_of_bounds``, ``invalid_speed``, ``stale_timestamp`` and ``is_valid`` (none of them).

    An unknown place is no place out of bounds, an unknown speed not invalid and an unknown time not stale: nulls show in ``has_nulls``.
    """
    no = F.lit(False)
    out = {
        "has_nulls": reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required]),
        "out_of_bounds": F.coalesce(~in_box(F.col("latitude"), F.col("longitude"), box), no),
        "invalid_speed": F.coalesce(~F.col("speed").between(0, limit), no),
        "stale_timestamp": F.coalesce(F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp")) > stale_hours * 3_600_000_000, no),
    }
    flagged = df.withColumns(out)
    return flagged.withColumn("is_valid", ~reduce(lambda a, b: a | b, [F.col(c) for c in out]))


def flag_summary(flagged: DataFrame) -> DataFrame:
    """One row over flagged rows: totals and a score from 0 to 100 (0 if there are no rows)."""
    return flagged.agg(
        F.count("*").alias("total_records"), F.count_if("is_valid").alias("valid_records"), F.count_if(~F.col("is_valid")).alias("invalid_records"), F.count_if("has_nulls").alias("null_records"),
        F.count_if(F.col("out_of_bounds") | F.col("invalid_speed")).alias("out_of_range_records"), F.coalesce(F.try_divide(F.count_if("is_valid") * 100.0, F.count("*")), F.lit(0.0)).alias("quality_score"),
    )


def row_score(duplicate: Column, name: Column, destination: Column) -> Column:
    """First match counts: a duplicate 0.5, no name 0.8, no destination 0.9, else 1."""
    return F.when(duplicate, 0.5).when(name.isNull(), 0.8).when(destination.isNull(), 0.9).otherwise(1.0)


def null_rates(df: DataFrame, columns: list[str], most: float = 0.05) -> DataFrame:
    """A row for each column: nulls, rate, and whether the rate is at most ``most``; one aggregate for all."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count")) for i, c in enumerate(columns)])
    rate = F.coalesce(F.try_divide(F.col("p.null_count"), F.col("n")), F.lit(0.0))
    return one.select("n", F.explode(pairs).alias("p")).select("p.column_name", "p.null_count", rate.alias("null_rate"), (rate <= most).alias("passed"))


def checks(df: DataFrame, required: list[str], keys: list[str], now: Column, ts: str = "ts", box: Box = BOXES["strict"], valid_rate: float = 0.95, duplicate_rate: float = 0.01, fresh_minutes: float = 10, least: int = 1, most: int | None = None, slow: float = 5, fast: float = 80) -> DataFrame:
    """A row for each check (required fields, places, speeds, duplicates, freshness, row count): value, bound, passed.

    All figures come from two aggregates over one scan each (distinct keys need their own). No rows: rates are 0, the age is 999999.
    """
    n = F.count("*")
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    one = df.agg(
        n.alias("n"),
        F.coalesce(F.try_divide(F.count_if(complete).cast("double"), n), F.lit(0.0)).alias("required"),
        F.coalesce(F.try_divide(F.count_if(F.coalesce(in_box(F.col("latitude"), F.col("longitude"), box), F.lit(False))).cast("double"), n), F.lit(0.0)).alias("place"),
        F.coalesce(F.try_divide(F.count_if(F.col("speed").between(slow, fast)).cast("double"), n), F.lit(0.0)).alias("pace"),
        F.coalesce(F.min(F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp"))) / 60e6, F.lit(999999.0)).alias("age"),
    )
    grouped = df.groupBy(*keys).count()
    two = grouped.agg(F.coalesce(F.try_divide(F.sum(F.col("count") - 1).cast("double"), F.sum("count")), F.lit(0.0)).alias("dup"))
    rows = [
        ("required_fields", "required", valid_rate, F.col("required") >= valid_rate),
        ("coordinates", "place", valid_rate, F.col("place") >= valid_rate),
        ("speed", "pace", valid_rate, F.col("pace") >= valid_rate),
        ("duplicates", "dup", duplicate_rate, F.col("dup") <= duplicate_rate),
        ("freshness_minutes", "age", float(fresh_minutes), F.col("age") <= fresh_minutes),
        ("record_count", "n", float(least), (F.col("n") >= least) & (F.lit(True) if most is None else F.col("n") <= most)),
    ]
    table = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(c).cast("double").alias("value"), F.lit(float(b)).alias("bound"), ok.alias("passed")) for name, c, b, ok in rows])
    return one.join(F.broadcast(two)).select(F.explode(table).alias("r")).select("r.*")


def enforce(results: DataFrame, order: tuple[str, ...] = ("required_fields", "coordinates", "duplicates", "freshness_minutes")) -> None:
    """Raises on the first check of ``order`` that failed; ``results`` has one row a check."""
    found = {r["check_name"]: r for r in results.collect()}
    for name in order:
        if name in found and not found[name]["passed"]:
            raise QualityError(f"check {name} failed: {found[name]['value']} against {found[name]['bound']}", name, found[name].asDict())


def dimensions(df: DataFrame, completeness: dict[str, Column], validity: Column, keys: list[str]) -> DataFrame:
    """One row: percent of known values for each named column, of valid rows, and of distinct keys."""
    n = F.count("*")
    pct = lambda x: F.coalesce(F.try_divide(x * 100.0, n), F.lit(0.0))
    base = df.agg(n.alias("total"), *[pct(F.count(c)).alias(f"completeness_{k}") for k, c in completeness.items()], pct(F.count_if(validity)).alias("validity"))
    distinct = df.groupBy(*keys).count().agg(F.count("*").alias("keys"))
    return base.join(F.broadcast(distinct)).withColumn("uniqueness", F.coalesce(F.try_divide(F.col("keys") * 100.0, F.col("total")), F.lit(0.0))).drop("keys")


def four_dimensions(df: DataFrame, now: Column, keys: list[str], ts: str = "ts", box: Box = BOXES["strict"], fresh_minutes: int = 10) -> DataFrame:
    """One row: completeness, accuracy (in the box), consistency (rows whose key is unique), timeliness, mean and band."""
    n = F.count("*")
    pct = lambda x: F.coalesce(F.try_divide(x * 100.0, n), F.lit(0.0))
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("vehicle_id", "latitude", "longitude", ts)])
    fresh = F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp")) <= fresh_minutes * 60_000_000
    a = df.agg(pct(F.count_if(full)).alias("completeness"), pct(F.count_if(in_box(F.col("latitude"), F.col("longitude"), box))).alias("accuracy"), pct(F.count_if(fresh)).alias("timeliness"))
    b = df.groupBy(*keys).count().agg(F.coalesce(F.try_divide(F.sum(F.when(F.col("count") == 1, F.col("count")).otherwise(0)) * 100.0, F.sum("count")), F.lit(0.0)).alias("consistency"))
    out = a.join(F.broadcast(b)).withColumn("overall", (F.col("completeness") + F.col("accuracy") + F.col("consistency") + F.col("timeliness")) / 4)
    return out.withColumn("status", F.when(F.col("overall") >= 95, "EXCELLENT").when(F.col("overall") >= 90, "GOOD").otherwise("NEEDS_ATTENTION"))


def weighted_score(parts: dict[str, Column]) -> Column:
    """Completeness, accuracy, consistency, timeliness and uniqueness in percent, weighted 30, 25, 20, 15 and 10."""
    weight = {"completeness": 0.30, "accuracy": 0.25, "consistency": 0.20, "timeliness": 0.15, "uniqueness": 0.10}
    return reduce(lambda a, b: a + b, [parts[k] * w for k, w in weight.items()])


def score_band(score: Column) -> Column:
    return F.when(score >= 95, "Excellent").when(score >= 90, "Good").when(score >= 85, "Acceptable").otherwise("Critical")


def alerts(metrics: DataFrame) -> DataFrame:
    """Alerts of a frame of metrics (``metric``, ``value``): score, null, duplicate, out-of-bounds, invalid-speed and stale percent, delay minutes."""
    m, v = F.col("metric"), F.col("value")
    severity = (
        F.when((m == "quality_score") & (v < 90), "ERROR").when((m == "quality_score") & (v < 95), "WARNING")
        .when((m == "null_percent") & (v > 5), "WARNING").when((m == "duplicate_percent") & (v > 2), "WARNING")
        .when((m == "out_of_bounds_percent") & (v > 1), "WARNING").when((m == "invalid_speed_percent") & (v > 1), "WARNING").when((m == "stale_percent") & (v > 10), "WARNING")
        .when((m == "delay_minutes") & (v > 30), "CRITICAL").when((m == "delay_minutes") & (v > 10), "ERROR")
    )
    return metrics.withColumn("severity", severity).where("severity is not null")


def recommendations(metrics: DataFrame) -> DataFrame:
    """Advice by rule: a score under 95 is urgent, success under 99 % or latency above 60 s worth a look."""
    m, v = F.col("metric"), F.col("value")
    level = F.when((m == "quality_score") & (v < 95), "HIGH").when((m == "success_percent") & (v < 99), "MEDIUM").when((m == "latency_seconds") & (v > 60), "MEDIUM")
    return metrics.withColumns({"priority": level, "band": banded(-v, [(-95 + 1e-12, "EXCELLENT"), (-90 + 1e-12, "GOOD")], "ATTENTION")}).where("priority is not null")


def health(components: DataFrame) -> DataFrame:
    """One row: healthy if all components are, degraded if any is unhealthy, else unknown (also without components)."""
    s = F.col("status")
    return components.agg(F.when(F.coalesce(F.bool_and(s == "healthy"), F.lit(False)), "healthy").when(F.coalesce(F.bool_or(s == "unhealthy"), F.lit(False)), "degraded").otherwise("unknown").alias("status"))


def pipeline_score(df: DataFrame, complete: list[str], valid: dict[str, Column]) -> DataFrame:
    """One row: the share of known values of each column of ``complete``, of rows for which each test of ``valid`` holds, and the mean of all. No rows: 0."""
    share = lambda x: F.coalesce(F.try_divide(x.cast("double"), F.count("*")), F.lit(0.0))
    parts = {f"known_{c}": share(F.count(c)) for c in complete} | {f"valid_{n}": share(F.count_if(t)) for n, t in valid.items()}
    mean = reduce(lambda a, b: a + b, [F.col(n) for n in parts]) / len(parts)
    return df.agg(*[c.alias(n) for n, c in parts.items()]).withColumn("score", mean)


def schema_report(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """A row for each expected column: expected and found type (null if missing), whether they agree."""
    have = dict(df.dtypes)
    rows = [(c, k, have.get(c), have.get(c) == k) for c, k in kinds.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, found string, ok boolean")


def check_metrics(results: DataFrame, stage: str) -> DataFrame:
    """Results of ``checks`` as metrics (``metric``, ``label``, ``value``): one for each check (1 passed, 0 not) and the share that passed."""
    each = results.select(F.lit("check_passed").alias("metric"), F.col("check_name").alias("label"), F.col("passed").cast("double").alias("value"))
    share = results.agg(F.lit("checks_passed_share").alias("metric"), F.lit(stage).alias("label"), F.coalesce(F.avg(F.col("passed").cast("double")), F.lit(0.0)).alias("value"))
    return each.unionByName(share)
