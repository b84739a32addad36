"""Feature rows for training and for serving."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.functions.calendar import calendar_features, legacy_calendar_features
from roadpulse.functions.collections import FILLER, LAG_COUNT, lag_columns, newest_padded, ordered_field
from roadpulse.operators.lags import SPAN_ROWS, lag_lead

# Names and order of the model's inputs.
FEATURES = ["t", "t1", "t2", "t3", "t4", "hour_sin", "hour_cos", "dayofweek"]
TRAINING_COLUMNS = [*FEATURES, "target"]


@dataclass(frozen=True)
class FeatureSpec:
    """How lags and calendar features are made; saved with a model so that serving can follow it."""

    lag_step: str = "1 minute"
    horizon: str = "5 minutes"
    filler: float = FILLER
    legacy_calendar: bool = False
    legacy_padded_flag: bool = False

    @property
    def history(self) -> str:
        """How long the history is that the lags come from."""
        number, unit = self.lag_step.split()
        return f"{LAG_COUNT * int(number)} {unit.removesuffix('s')}s"

    def calendar(self, ts: Column) -> dict[str, Column]:
        return legacy_calendar_features(ts) if self.legacy_calendar else calendar_features(ts)


def training_features(history: DataFrame, spec: FeatureSpec = FeatureSpec(), series: str = "entity_id", time: str = "time",
                      flow: str = "traffic_flow", tie: str | None = None, keep: Sequence[str] = (),
                      span_rows: int | None = SPAN_ROWS, max_gap_seconds: int | None = None) -> DataFrame:
    """Lags t..t4, calendar features and the next value as `target`; rows with a null are dropped."""
    order = [time] + ([tie] if tie else [])
    lagged = lag_lead(history.filter(F.col(time).isNotNull()), series, order, flow, LAG_COUNT - 1, 1,
                      span_rows, max_gap_seconds)
    columns = {"t": F.col(flow)} | {f"t{k}": F.col(f"lag_{k}") for k in range(1, LAG_COUNT)}
    columns |= spec.calendar(F.col(time)) | {"target": F.col("lead_1")}
    complete = lagged.dropna(how="any")
    return complete.select(*keep, *[c.alias(name) for name, c in columns.items()])


def padded_lags(history: DataFrame, spec: FeatureSpec = FeatureSpec(), require_latest: bool = False) -> DataFrame:
    """Lags t..t4 per window and camera from a history list, padded at the old end.

    `require_latest` keeps the windows whose newest entry is one lag step before their end.
    """
    if require_latest:
        newest = F.element_at("history", -1)["end_time"]
        history = history.filter(newest == F.col("window_end") - F.expr(f"INTERVAL {spec.lag_step}"))
    padded = newest_padded(ordered_field(F.col("history"), "avg_traffic_volume"), filler=spec.filler)
    lags = lag_columns(F.col("padded"))
    flag = lags["t4"] == F.lit(spec.filler) if spec.legacy_padded_flag else F.col("n_observed") < LAG_COUNT
    return (history
            .select(F.col("window_end").alias("base_time_t"), "cam_id",
                    F.size("history").alias("n_observed"), padded.alias("padded"))
            .select("base_time_t", "cam_id", *[c.alias(name) for name, c in lags.items()], "n_observed",
                    F.when(flag, True).otherwise(False).alias("is_padded")))


def serving_features(history: DataFrame, spec: FeatureSpec = FeatureSpec(),
                     require_latest: bool = False) -> DataFrame:
    """Padded lags with the calendar features of the window's end."""
    return padded_lags(history, spec, require_latest).withColumns(spec.calendar(F.col("base_time_t")))
