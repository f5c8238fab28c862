"""Which filter a row goes to, and why a row was lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators import filters

# What an extraction error contains (or begins with) and the counter it belongs to,
# in the order they are tried.
ERROR_ROUTES = [
    ("contains", "robots.txt", "robots_blocked"),
    ("contains", "blocked:", "robots_blocked"),
    ("contains", "video/media", "video_skipped"),
    ("contains", "duration", "video_skipped"),
    ("begins", "HTTP ", "http_error"),
    ("contains", "not installed", "missing_dependency"),
    ("contains", "deps missing", "missing_dependency"),
    ("begins", "rejected:", "schema_rejected"),
]


def row_reason(kind: Column, text: Column, url: Column, prompt: Column, answer: Column, mode: str = "pretrain", least: int = 500) -> Column:
    """The reason by the filter that a row calls for: with ``mode`` sft and a labelled pair, that
    of pairs; otherwise that of its kind and url."""
    other = filters.reason_for(kind, text, url, least)
    if mode != "sft":
        return other
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.when(filled(prompt) & filled(answer), filters.pair_reason(prompt, answer)).otherwise(other)


def lost_to(error: Column, text: Column) -> Column:
    """The counter of a row without text or with an error; null for others."""
    said = F.coalesce(F.nullif(error, F.lit("")), F.lit("no response"))
    routes = [F.when(F.contains(said, F.lit(x)) if how == "contains" else F.startswith(said, F.lit(x)), name) for how, x, name in ERROR_ROUTES]
    gone = (F.coalesce(error, F.lit("")) != "") | (F.coalesce(text, F.lit("")) == "")
    return F.when(gone, F.coalesce(*routes, F.lit("other_extract_fail")))


def accounted(df: DataFrame, *by: str) -> DataFrame:
    """Rows by group, and over all of them (null), per counter and reason."""
    return df.withColumn("reason", F.coalesce("reason", F.lit("pass"))).rollup(*by, "reason").agg(F.count("*").alias("n"), *[F.grouping(c).alias(f"all_{c}") for c in (*by, "reason")])


def unsupported(schema: T.DataType, path: str = "") -> list[str]:
    """Columns, however deep, whose values are no JSON: binary ones, intervals, variants."""
    if isinstance(schema, T.StructType):
        return [x for f in schema.fields for x in unsupported(f.dataType, f"{path}.{f.name}".lstrip("."))]
    if isinstance(schema, T.ArrayType):
        return unsupported(schema.elementType, f"{path}[]")
    if isinstance(schema, T.MapType):
        return unsupported(schema.valueType, f"{path}{{}}")
    return [path] if isinstance(schema, (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType, T.VariantType)) else []
