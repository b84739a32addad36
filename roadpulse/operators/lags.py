"""Row-based lag and lead over long series."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


SPAN_ROWS = 4_000_000
HOUR = 3_600_000_000  # microseconds


def lag_lead(df: DataFrame, series: str, order: Sequence[str], value: str, lags: int, leads: int,
             span_rows: int | None = SPAN_ROWS, max_gap_seconds: int | None = None) -> DataFrame:
    """Columns `lag_1`.. and `lead_1`.. of `value` along each series, by row.

    The first column of `order` is the time; `order` must be total within a series. Each series is cut
    into spans of time of about `span_rows` rows, which are sorted apart, so that one series may hold
    most of the rows. The first and last rows of a span look across its ends: for them, a handful in
    `span_rows`, lag and lead run once more along the whole series. None cuts no series, and none is cut if
    a count, which runs at once, finds that none is longer than a span: one pass over the rows then does.

    `max_gap_seconds` empties a lag or lead of k rows that lies more than k such gaps away.
    """
    steps = {f"lag_{k}": k for k in range(1, lags + 1)} | {f"lead_{k}": -k for k in range(1, leads + 1)}
    time = order[0]

    def step(k: int, along) -> Column:
        shifted = F.lag(F.struct(F.col(value).alias("v"), F.col(time).alias("t")), k).over(along)
        if max_gap_seconds is None:
            return F.lag(value, k).over(along)
        away = F.abs(F.unix_micros(time) - F.unix_micros(shifted["t"]))
        return F.when(away <= abs(k) * max_gap_seconds * 1_000_000, shifted["v"])

    across = Window.partitionBy(series).orderBy(*order)
    if span_rows is None or not _any_longer(df, series, span_rows):
        return df.select("*", *[step(k, across).alias(name) for name, k in steps.items()])

    reach = max(lags, leads)
    inside = Window.partitionBy(series, "__span").orderBy(*order)

    def exists(k: int) -> Column:
        return F.lag(F.lit(1), k).over(inside).isNotNull()

    placed = _with_spans(df, series, time, span_rows).select(
        "*",
        *[step(k, inside).alias(name) for name, k in steps.items()],
        *[exists(k).alias(f"__has_{name}") for name, k in steps.items()],
        (exists(reach) & exists(-reach)).alias("__settled"),
    )
    # The first and last `reach` rows of all spans hold every row a look across a span can meet.
    edges = placed.filter(~F.col("__settled")).select(*df.columns, *[
        F.when(F.col(f"__has_{name}"), F.col(name)).otherwise(step(k, across)).alias(name)
        for name, k in steps.items()
    ])
    return placed.filter("__settled").select(*df.columns, *steps).unionByName(edges)


def _any_longer(df: DataFrame, series: str, rows: int) -> bool:
    return not df.groupBy(series).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows).isEmpty()


def _with_spans(df: DataFrame, series: str, time: str, span_rows: int) -> DataFrame:
    """`__span` is in the order of time and holds about `span_rows` rows of a series.

    Quiet hours are merged by a running count of the hours before; an hour of more rows is cut at seconds,
    by a running count in the hour, and a second of more rows at equal parts of the time between its first and last. Hours are few for each
    series, and an hour has no more cuts than it has spans.
    """
    micros = F.unix_micros(time)
    rows = df.select(F.col(series).alias("s"), micros.alias("m")).withColumn("h", F.floor(F.col("m") / HOUR))
    hourly = rows.groupBy("s", "h").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hourly = hourly.withColumn("block", F.floor(before / span_rows))

    dense = hourly.filter(F.col("n") > span_rows).select("s", "h")
    seconds = (rows.join(dense, ["s", "h"], "left_semi").groupBy("s", "h", F.floor(F.col("m") / 1_000_000).alias("second"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("first"), F.max("m").alias("last")))
    in_hour = Window.partitionBy("s", "h").orderBy("second")
    begun = F.floor(F.coalesce(F.sum("n").over(in_hour.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) / span_rows)
    parts = F.ceil(F.col("n") / span_rows)
    cuts = (seconds.withColumn("begun", begun)
            .withColumn("new", F.col("begun") > F.coalesce(F.lag("begun").over(in_hour), F.lit(-1)))
            .filter(F.col("new") | (F.col("n") > span_rows))
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
            .filter(F.col("new") | (F.col("part") > 0))
            .groupBy("s", "h").agg(F.array_sort(F.collect_list(
                F.col("first") + F.floor(F.col("part") * (F.col("last") - F.col("first") + 1) / parts))).alias("__cuts")))
    spans = hourly.join(cuts, ["s", "h"], "left").select(F.col("s").alias("__s"), F.col("h").alias("__h"), F.col("block").alias("__block"), "__cuts")
    past = F.size(F.filter("__cuts", lambda c: c <= micros))
    span = F.struct(F.col("__block").alias("block"), F.when(F.col("__cuts").isNull(), 0).otherwise(past).alias("slice"))
    placed = df.join(spans, F.col(series).eqNullSafe(F.col("__s")) & F.floor(micros / HOUR).eqNullSafe(F.col("__h")), "left")
    return placed.withColumn("__span", span).drop("__s", "__h", "__block", "__cuts")
