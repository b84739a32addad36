"""The entries of each camera as state of a stream: maps by time in a RocksDB state store.

The state holds what the serving table holds: the newest history and forecast entries of a camera in their
last versions, its last reported location and when it was last heard of. A batch reads and writes the
state of the cameras it has messages of and of no others. Each task cuts its entries to those that may be held ahead
of the shuffle, so one busy camera sends few rows to its task. Times are microseconds since 1970 in the state.

`camera_lists` gives each changed camera's lists; `held_entries` reads the state from a checkpoint, without the stream.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadpulse.operators.serving import FORECAST_LIMIT, HISTORY_LIMIT
from roadpulse.session import ship_package

def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _TEXT, _DOUBLE = T.LongType(), T.StringType(), T.DoubleType()
#: Order of versions: offset, time of the message, and what it holds.
_VERSION = _struct(offset=_LONG, sent=_LONG, tie=_LONG)
_TIME = _struct(time_key=_LONG)
#: State variables by name: fields of a value beside its version. The maps have the entry's time as their key.
_FIELDS = {
    "history": _struct(end_time=_LONG, location=_TEXT, avg_traffic_volume=_DOUBLE),
    "forecast": _struct(base_time_t=_LONG, current_volume=_DOUBLE, predicted_volume=_DOUBLE, is_padded=T.BooleanType()),
    "place": _struct(location=_TEXT),
    "heard": _struct(updated_at=_LONG),
}
_VALUES = {kind: T.StructType([*_VERSION, *fields]) for kind, fields in _FIELDS.items()}
_STARTS = {"history": "start_time", "forecast": "prediction_timestamp"}
_LISTS = {kind: T.StructType([T.StructField(start, _LONG), *_FIELDS[kind]]) for kind, start in _STARTS.items()}
_OUTPUT = _struct(cam_id=_TEXT, location=_TEXT, last_updated=_LONG, **{kind: T.ArrayType(entry) for kind, entry in _LISTS.items()})


class CameraEntries(StatefulProcessor):
    """Merges a batch's entries of one camera into its state and gives its lists, oldest first."""

    def __init__(self, history_limit: int, forecast_limit: int):
        self.limits = {"history": history_limit, "forecast": forecast_limit}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.maps = {kind: handle.getMapState(kind, _TIME, _VALUES[kind]) for kind in _LISTS}
        self.last = {kind: handle.getValueState(kind, _VALUES[kind]) for kind in ("place", "heard")}

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # a batch may bring many versions and times; only the last versions of the newest times are held
        came = {kind: {} for kind in _LISTS}
        last = {kind: v if (v := state.get()) is None else tuple(v) for kind, state in self.last.items()}
        for row in rows:
            version = (row.offset, row.sent, row.tie)
            newest = came[row.kind]
            if row.time_key not in newest or newest[row.time_key][:3] < version:
                newest[row.time_key] = (*version, *(row[name] for name in _FIELDS[row.kind].names))
                if len(newest) > 4 * self.limits[row.kind]:
                    for time in sorted(newest)[: -self.limits[row.kind]]:
                        del newest[time]
            if row.kind == "history" and row.location is not None and (last["place"] is None or last["place"][:3] < version):
                last["place"] = (*version, row.location)
            if last["heard"] is None or last["heard"][:3] < version:
                last["heard"] = (*version, row.updated_at)
        lists = {kind: self._merged(kind, came[kind]) for kind in _LISTS}
        for kind, value in last.items():
            if value is not None:
                self.last[kind].update(value)
        yield Row(cam_id=key[0], location=last["place"] and last["place"][3], last_updated=last["heard"] and last["heard"][3],
                  **{kind: [dict(zip(_LISTS[kind].names, (time, *value[3:]))) for time, value in own] for kind, own in lists.items()})

    def _merged(self, kind: str, came: dict) -> list[tuple]:
        state = self.maps[kind]
        held = {key[0]: tuple(value) for key, value in state.iterator()}
        every = dict(held)
        for time, value in came.items():
            if time not in held or held[time][:3] < value[:3]:
                every[time] = value
        kept = sorted(every)[-self.limits[kind]:]
        for time in held.keys() - set(kept):
            state.removeKey((time,))
        for time in kept:
            if held.get(time) != every[time]:
                state.updateValue((time,), every[time])
        return [(time, every[time]) for time in kept]

    def close(self) -> None:
        pass


_CUT_ROWS, _HELD_ROWS = 50_000, 200_000


def _needed(table: pa.Table, limits: dict[str, int]) -> pa.Table:
    """The rows on which the state depends: last versions of each camera's newest times, its last message and its last location."""
    rows = table.select(["cam_id", "kind", "time_key", *_VERSION.names]).to_pandas()
    rows["cam_id"] = pd.factorize(rows["cam_id"])[0]
    rows["located"] = (rows["kind"] == "history") & pc.is_valid(table.column("location")).to_numpy()
    rows = rows.sort_values(_VERSION.names, kind="stable")
    newest = rows.drop_duplicates(["cam_id", "kind", "time_key"], keep="last").sort_values("time_key")
    later = newest.groupby(["cam_id", "kind"]).cumcount(ascending=False)
    kept = [newest[later < newest["kind"].map(limits)], *[r.drop_duplicates("cam_id", keep="last") for r in (rows, rows[rows["located"]])]]
    return table.take(pa.array(np.unique(np.concatenate([k.index.to_numpy() for k in kept]))))


def _cut(limits: dict[str, int]):
    """Cuts the batches of a task, many at once; what is held is sent on when it grows large."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, least = [], _CUT_ROWS
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= least:
                held = _needed(pa.Table.from_batches(held), limits).combine_chunks().to_batches()
                rows = sum(b.num_rows for b in held)
                if rows >= _HELD_ROWS:
                    yield from held
                    held, rows = [], 0
                least = 2 * rows + _CUT_ROWS
        if held:
            yield from _needed(pa.Table.from_batches(held), limits).to_batches()

    return run


def camera_lists(entries: DataFrame, history_limit: int = HISTORY_LIMIT, forecast_limit: int = FORECAST_LIMIT) -> DataFrame:
    """A stream of the cameras that a batch changes, from a stream of serving entries.

    Needs the RocksDB state store (`jobs.start(..., rocksdb=True)`) and update mode.
    """
    ship_package(entries.sparkSession)
    rows = entries.select(
        "cam_id", "kind", F.coalesce("seq.offset", F.lit(-1)).alias("offset"), F.coalesce(F.unix_micros("seq.timestamp"), F.lit(-1)).alias("sent"),
        F.col("seq.tie").alias("tie"), *[F.unix_micros(c).alias(c) for c in ("time_key", "end_time", "base_time_t", "updated_at")],
        "location", "avg_traffic_volume", "current_volume", "predicted_volume", "is_padded")
    rows = rows.mapInArrow(_cut({"history": history_limit, "forecast": forecast_limit}), rows.schema)
    states = rows.groupBy("cam_id").transformWithState(
        CameraEntries(history_limit, forecast_limit), outputStructType=_OUTPUT, outputMode="Update", timeMode="None")
    return states.select("cam_id", "location", F.timestamp_micros("last_updated").alias("last_updated"),
                         *[_with_times(kind).alias(kind) for kind in _LISTS])


def _with_times(kind: str):
    def field(entry, f):
        return (F.timestamp_micros(entry[f.name]) if f.dataType == _LONG else entry[f.name]).alias(f.name)

    return F.transform(kind, lambda e: F.struct(*[field(e, f) for f in _LISTS[kind]]))


def held_entries(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The entries that a checkpoint's state holds, after its last batch or a given one, as merged serving entries."""
    def variable(name):
        reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name)
        return (reader if batch_id is None else reader.option("batchId", batch_id)).load()

    def entries(kind, key, value):
        columns = [(F.timestamp_micros(f"{value}.{f.name}") if f.dataType == _LONG else F.col(f"{value}.{f.name}")).alias(f.name)
                   for f in _FIELDS[kind]]
        if key:
            columns += [F.timestamp_micros(f"{key}.time_key").alias(n) for n in ("time_key", _STARTS[kind])]
        seq = F.struct(*[F.col(f"{value}.{n}").alias(n) for n in ("offset", "sent", "tie")])
        return variable(kind).select(F.lit(kind).alias("kind"), F.col("key.cam_id").alias("cam_id"), seq.alias("seq"), *columns)

    parts = [entries(kind, "user_map_key", "user_map_value") for kind in _LISTS] + [entries(kind, None, "value") for kind in ("place", "heard")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
