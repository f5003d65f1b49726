"""Metrics as long rows: records, status, dictionary, report."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.columns import slug

KEYS = ("source_id", "library_type", "modality", "process_name", "metric_key")
SCHEMA = "source_id string, library_type string, modality string, process_name string, metric_key string, value double"
STATUS = "source_id string, library_type string, modality string, process_name string, reason_code string, message string"
#: The reasons for which a step may end early.
REASONS = ("INSUFFICIENT_READS", "LOW_COVERAGE", "LOW_BARCODES", "LOW_FEATURES", "NO_CELLS", "INCONSISTENT_MERGE")
LIBRARIES = ("DNA", "RNA")


def records(spark: SparkSession, source_id: str, library_type: str, modality: str, process_name: str, values: dict[str, float | None]) -> DataFrame:
    """Rows of metrics in the order of their keys; no values give an empty table of the same columns."""
    if library_type not in LIBRARIES:
        raise ValueError(f"unknown library type: {library_type}")
    if wrong := [k for k, v in values.items() if not isinstance(k, str) or v is not None and not isinstance(v, int | float)]:
        raise TypeError(f"not numbers under names: {wrong}")
    return spark.createDataFrame([(source_id, library_type, modality, process_name, k, None if v is None else float(v)) for k, v in sorted(values.items())], SCHEMA)


def status(spark: SparkSession, source_id: str, library_type: str, modality: str, process_name: str, reason: str, message: str) -> DataFrame:
    if reason not in REASONS:
        raise ValueError(f"unknown reason: {reason}; known are {', '.join(REASONS)}")
    if not isinstance(message, str):
        raise TypeError("a message is a string")
    return spark.createDataFrame([(source_id, library_type, modality, process_name, reason, message)], STATUS)


def extend(record: DataFrame, more: DataFrame) -> DataFrame:
    """record's rows and more, which must have its columns and types."""
    if record.dtypes != more.dtypes:
        raise ValueError(f"columns {more.dtypes} aren't {record.dtypes}")
    return record.unionByName(more)


def write_records(record: DataFrame, path: str, extension: str = "parquet") -> bool:
    """Writes a record in the order of its keys; an empty one writes nothing, and the answer is whether it did."""
    if extension not in ("parquet", "csv"):
        raise ValueError(f"neither parquet nor csv: {extension}")
    if record.isEmpty():
        return False
    own = record.orderBy(*record.columns[:5]).write.mode("overwrite")
    own.parquet(path) if extension == "parquet" else own.option("header", True).csv(path)
    return True


def wider_type(spark: SparkSession, a: str, b: str) -> str:
    """The type that Spark gives values of both; double for whole numbers with single precision, which would lose digits, and text beside text and for what Spark doesn't bring together."""
    if a == b or "string" in (a, b):
        return a if a == b else "string"
    if "float" in (a, b) and {a, b} & {"int", "bigint"}:
        return "double"
    try:
        return spark.sql(f"SELECT array(CAST(NULL AS {a}), CAST(NULL AS {b})) AS x").schema["x"].dataType.elementType.simpleString()
    except AnalysisException:
        return "string"


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """All rows by column names, of the widest type of each column; columns that a table lacks are null."""
    wider: dict[str, str] = {}
    for f in frames:
        for c, t in f.dtypes:
            wider[c] = wider_type(f.sparkSession, wider.get(c, t), t)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select(*[F.col(f"`{c}`").cast(wider[c]).alias(c) for c in f.columns]) for f in frames])


def unpivot(wide: DataFrame, ids: list[str]) -> DataFrame:
    """A row for each metric column; identifiers stay."""
    values = [c for c in wide.columns if c not in ids]
    return wide.select(*ids, *[F.col(v).cast("double") for v in values]).unpivot(ids, values, "metric_key", "value").where("value IS NOT NULL")


def pivot(long: DataFrame, keys: list[str], by: tuple[str, ...] = ("source_id",)) -> DataFrame:
    """A column for each key, in the given order."""
    return long.groupBy(*by).pivot("metric_key", keys).agg(F.first("value", ignorenulls=True))


def aggregate(*frames: DataFrame) -> DataFrame:
    """All rows in the order of their keys, values as single precision."""
    both = reduce(lambda a, b: a.unionByName(b), frames)
    return both.withColumn("value", F.col("value").cast("float")).orderBy(*KEYS)


def judged(value: str = "value") -> Column:
    """fail or warn where a value is below a least or above a most; bounds that the dictionary lacks judge nothing."""
    beyond = lambda lo, hi: F.coalesce(F.col(value) < F.col(lo), F.lit(False)) | F.coalesce(F.col(value) > F.col(hi), F.lit(False))
    return F.when(beyond("min_failure_threshold", "max_failure_threshold"), "fail").when(beyond("min_warning_threshold", "max_warning_threshold"), "warn").otherwise("pass")


def report(metrics: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Metrics that the dictionary has, with its texts and the verdict."""
    for c in ("min_warning_threshold", "max_warning_threshold", "min_failure_threshold", "max_failure_threshold"):
        if c not in dictionary.columns:
            dictionary = dictionary.withColumn(c, F.lit(None).cast("double"))
    return metrics.join(dictionary, ["library_type", "modality", "metric_key"]).withColumn("status", judged())


# the report

SCOPES = ("aggregated", "single")
BOUNDS = (("warn", "min_warning_threshold", "lt"), ("fail", "min_failure_threshold", "lt"), ("warn", "max_warning_threshold", "gt"), ("fail", "max_failure_threshold", "gt"))


def visible(dictionary: DataFrame, scope: str, internal: bool) -> DataFrame:
    """The dictionary's rows that a report shows: for its scope or both, and those for customers unless it is internal."""
    if scope not in SCOPES:
        raise ValueError(f"scope is one of {SCOPES}")
    own = dictionary if internal else dictionary.where("customer_facing")
    return own.where(F.lower("report").isin(scope, "both"))


def section_rows(metrics: DataFrame, dictionary: DataFrame, scope: str, internal: bool) -> DataFrame:
    """(section, source_id, metric_key, value, shown) of a report in long form; modality none counts as barcode. shown: the value in its format, three decimals for fractions and none for others unless the dictionary has one."""
    own = metrics.withColumn("modality", F.when(F.col("modality") == "none", "barcode").otherwise(F.col("modality")))
    both = own.join(visible(dictionary, scope, internal), ["library_type", "modality", "metric_key"])
    section = F.concat(F.lit("metrics_"), slug("library_type"), F.lit("_"), slug("modality"))
    places = F.when(F.col("format").isNotNull(), F.regexp_extract("format", r"\.(\d+)f", 1)).when(F.col("metric_key").startswith("fraction_"), "3").otherwise("0").cast("int")
    number = F.when(places == 3, F.format_number("value", 3)).when(places == 2, F.format_number("value", 2)).when(places == 1, F.format_number("value", 1)).otherwise(F.format_number("value", 0))
    grouped = F.when(F.col("format").isNotNull(), F.col("format").contains(",")).otherwise(~F.col("metric_key").startswith("fraction_"))
    return both.select(section.alias("section"), "source_id", "metric_key", "value", F.when(grouped, number).otherwise(F.regexp_replace(number, ",", "")).alias("shown"))


def sections(metrics: DataFrame, dictionary: DataFrame, scope: str, internal: bool) -> tuple[dict, dict[str, DataFrame]]:
    """The report's configuration, and of each section its wide table (Sample, metrics in the dictionary's order). The dictionary is small and comes to the driver; metrics don't."""
    own = metrics.withColumn("modality", F.when(F.col("modality") == "none", "barcode").otherwise(F.col("modality")))
    listed = [r.asDict() for r in visible(dictionary, scope, internal).collect()]
    present = {tuple(r) for r in own.select("library_type", "modality", "metric_key").distinct().collect()}  # at most as many as the dictionary's keys matter
    plain = lambda x: re.sub("^_+|_+$", "", re.sub("[^a-z0-9]+", "_", x.lower()))
    order, data, tables = [], {}, {}
    for lib, mod in dict.fromkeys((r["library_type"], r["modality"]) for r in listed):
        rows = [r for r in listed if (r["library_type"], r["modality"]) == (lib, mod) and (lib, mod, r["metric_key"]) in present]
        if not rows:
            continue
        name, title = f"metrics_{plain(lib)}_{plain(mod)}", f"{lib} {mod.replace('_', ' ').title()} Metrics"
        headers: dict[str, dict] = {"Sample": {"title": "Sample"}}
        for r in rows:
            key = r["metric_key"]
            head = {"title": r["human_readable_name"], "description": r.get("description"), "format": r.get("format") or ("{:.3f}" if key.startswith("fraction_") else "{:,.0f}")}
            rules: dict[str, list] = {}
            for level, bound, sign in BOUNDS:
                if r.get(bound) not in (None, ""):
                    rules.setdefault(level, []).append({sign: float(r[bound])})
            headers[key] = head | ({"cond_formatting_rules": {k: rules[k] for k in ("warn", "fail") if k in rules}} if rules else {})
        keys = [r["metric_key"] for r in rows]
        wide = own.where((F.col("library_type") == lib) & (F.col("modality") == mod) & F.col("metric_key").isin(keys))
        tables[name] = pivot(wide, keys).withColumnRenamed("source_id", "Sample")
        what = mod.replace("_", " ")
        data[name] = {
            "file_format": "tsv", "section_name": title, "description": f"Aggregated {lib} {what} metrics per sample or library.", "plot_type": "table", "parent_id": f"metrics_{plain(lib)}",
            "parent_name": f"{lib} Metrics", "parent_description": f"Custom metrics for {lib} libraries.", "pconfig": {"id": name, "title": title}, "headers": headers,
        }
        order.append(name)
    return {"custom_content": {"order": order}, "custom_data": data, "sp": {n: {"fn": f"{n}.tsv"} for n in order}}, tables
