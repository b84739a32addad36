"""Result columns in forms that compare across engines."""

from pyspark.sql import Column, DataFrame, functions as F


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as wall-clock timestamps of the session zone."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"})


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded; adding 0.0 turns a negative zero into zero."""
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n, t in df.dtypes if t == "double"})


def clean(df: DataFrame) -> DataFrame:
    return rounded(plain_times(df))


def history_text(history: Column) -> Column:
    """A list of averages as text: time=volume;..."""
    return F.array_join(F.transform(history, lambda h: F.concat_ws(
        "=", minute_text(h["end_time"]), number_text(h["avg_traffic_volume"]))), ";")


def forecast_text(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda f: F.concat_ws(
        "=", minute_text(f["prediction_timestamp"]), number_text(f["predicted_volume"]))), ";")


def counts_text(counts: Column) -> Column:
    """A map of counts as text: label=n;..., by label."""
    entries = F.array_sort(F.map_entries(counts))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def number_text(x: Column) -> Column:
    """A number in thousandths, as an integer."""
    return F.round(x * 1000).cast("bigint").cast("string")
