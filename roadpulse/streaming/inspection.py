"""What streams have done: counts of each batch, and the state that a checkpoint holds."""

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_ARRIVED, _WRITTEN = "arrived", "written"


def count_arrivals(rows: DataFrame) -> DataFrame:
    """The rows as they are; those of each batch are counted as arrived."""
    return rows.observe(_ARRIVED, F.count(F.lit(1)).alias("n"))


def count_written(rows: DataFrame) -> DataFrame:
    """The rows as they are; those of each batch are counted as written."""
    return rows.observe(_WRITTEN, F.count(F.lit(1)).alias("n"))


class BatchCounts(StreamingQueryListener):
    """Counts of each batch of the queries that run while it is attached.

    `late` are rows that came after the watermark had closed their window, as stateful operators drop them:
    after rows of one task, window and camera have been summed into one.
    """

    def __init__(self):
        self.rows: list[tuple[str, int, int, int, int]] = []
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event):
        self._end(str(event.runId))

    def onQueryProgress(self, event):
        progress = event.progress
        seen = {name: row["n"] for name, row in progress.observedMetrics.items() if "n" in row}
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.rows.append((str(progress.runId), progress.batchId, seen.get(_ARRIVED, 0), late, seen.get(_WRITTEN, 0)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._end(str(event.runId)).set()

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def of(self, query: StreamingQuery, wait_seconds: float = 60) -> list[tuple[int, int, int, int]]:
        """(batch, rows in, late, written) of a query that has ended; its last events may still be on their way."""
        if not self._end(str(query.runId)).wait(wait_seconds):
            raise TimeoutError(f"no end of {query.runId} was heard of")
        return sorted(row[1:] for row in self.rows if row[0] == str(query.runId))


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Keys of the windows that a checkpoint's state holds, not closed yet after its last batch or a given one."""
    reader = spark.read.format("statestore").option("path", checkpoint)
    return (reader if batch_id is None else reader.option("batchId", batch_id)).load().select("key.*")


def generation(checkpoint: str, number: int) -> str:
    """The checkpoint of a query that has been started from scratch so many times; earlier ones stay as they are."""
    return f"{checkpoint}-{number:06d}"
