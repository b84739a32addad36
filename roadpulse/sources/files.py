"""CSV tables, image files and reports."""

import itertools
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadpulse.functions.envelope import parse_time
from roadpulse.functions.headers import make_headers
from roadpulse.operators.ingest import frame_messages
from roadpulse.schemas import SENSOR_HISTORY_CSV
from roadpulse.session import fresh_dir, session_settings, ship_package
from roadpulse.sources.paths import Folder


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the price of a second read."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_sensor_history(spark: SparkSession, path: str) -> DataFrame:
    """Sensor history CSV with `time` parsed; a time that cannot be parsed becomes null."""
    return read_csv(spark, path, SENSOR_HISTORY_CSV).withColumn("time", parse_time(F.col("time")))


def read_image_frames(spark: SparkSession, paths: Iterable[str], cam_id: str, location: str,
                      taken_at: Column | None = None) -> DataFrame:
    """Frame messages for a given list of image files; files that do not exist are skipped."""
    present = [p for p in paths if _exists(spark, p)]
    at = F.current_timestamp() if taken_at is None else taken_at
    headers = make_headers(
        cam_id=F.lit(cam_id),
        location=F.lit(location),
        timestamp=F.date_format(F.to_utc_timestamp(at, F.current_timezone()),
                                "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
    )
    if not present:
        files = spark.createDataFrame([], "path string, content binary")
    else:
        files = spark.read.format("binaryFile").option("ignoreMissingFiles", True).load(present)
    return files.select(F.encode(F.lit(cam_id), "UTF-8").alias("key"), F.col("content").alias("value"),
                        headers.alias("headers"), "path")


#: Tasks per core that list and read files. Spark would list each folder and read each 32 small files in a task of their own.
FILE_TASKS = 32
#: Tasks per core that write, list or read local files in Python, as streams.
LOCAL_TASKS = 4
#: What such a task holds: rows of a listing, and bytes of contents besides those of one file.
HELD_ROWS, HELD_BYTES = 10_000, 1 << 23
#: Spark's name for the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_texts(rows: DataFrame, by: list[str], folder: str) -> None:
    """A text file for each set of values of the columns `by`, with a line for each `value`; paths hold the columns as `name=value`.

    Tasks write into a local folder themselves, since Hadoop starts processes for each file that it makes in one.
    A task's files lie in a folder of its own. A file is there as a whole or not at all.
    """
    spark = rows.sparkSession
    dealt = rows.select(*by, "value").repartition(_local_tasks(spark), *by).withColumn("task", F.spark_partition_id())
    path = _local_path(spark, folder)
    if path is None:
        dealt.write.partitionBy("task", *by).text(folder)
        return
    names = ["task", *by]

    def write(batches):
        last = None
        lines = ((row[:-1], row[-1]) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for values, group in itertools.groupby(lines, key=lambda line: line[0]):
            *folders, name = (f"{n}={quote(v, safe='') if v else NO_VALUE}" for n, v in zip(names, values))
            into = "/".join([path, *folders])
            if into != last:
                os.makedirs(into, exist_ok=True)
                last = into
            draft = f"{into}/.{uuid.uuid4().hex}"
            with open(draft, "wb") as file:
                file.writelines((value or b"") + b"\n" for _, value in group)
            os.replace(draft, f"{into}/{name}.txt")
        yield from ()

    Folder(spark, folder).make()
    texts = dealt.sortWithinPartitions(*by).select(*(F.col(n).cast("string") for n in names), F.col("value").cast("binary"))
    texts.mapInArrow(write, "none int").write.format("noop").mode("overwrite").save()


def list_files(spark: SparkSession, folders: str | Iterable[str], contents: bool = True, **options) -> DataFrame:
    """Binary files of folders and of those in them, listed and read in a number of tasks that does not grow with the files.

    Without `contents`, and without options, local folders are listed by tasks, and the driver holds nothing of a file.
    """
    folders = [folders] if isinstance(folders, str) else list(folders)
    local = None if contents or options else _local_folders(spark, folders)
    if local is not None:
        return _walked(spark, local)
    tasks = FILE_TASKS * spark.sparkContext.defaultParallelism
    listing = {"parallelism": tasks, "threshold": min(32, spark.sparkContext.defaultParallelism - 1)}  # nested folders in one job
    with session_settings(spark, {f"spark.sql.sources.parallelPartitionDiscovery.{k}": v for k, v in listing.items()}):
        files = spark.read.format("binaryFile").options(recursiveFileLookup=True, **options).load(folders)
    return files.coalesce(tasks) if contents else files.coalesce(tasks).drop("content")


def backfill_frames(asked: DataFrame, folders: str | Iterable[str], decodes: Callable[[Column], Column],
                    taken_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Frame messages for a table of image files, and the files that give none, with the reason.

    `asked` has `path`, `cam_id` and `location`, for as many cameras as there are; `folders` hold the files, and are
    listed once, by Spark, when this is called. `decodes` tells of payloads whether they are images. A file that is
    asked for twice is sent twice. Reasons: "missing" and "undecodable".
    """
    spark = asked.sparkSession
    folders = [folders] if isinstance(folders, str) else list(folders)
    if _local_folders(spark, folders) is not None:
        files = written(list_files(spark, folders, contents=False).select("path"), "listed")
        found = _with_contents(asked.join(files, "path"))  # only those asked for are read, and contents are in no join
    else:
        files = list_files(spark, folders, ignoreMissingFiles=True)
        # The contents are on the side that is not moved as long as the list is small enough to be sent to it.
        found = files.select("path", "content").join(asked, "path")
    found = found.withColumn("__decodes", decodes(F.col("content")))
    missing = asked.join(files.select("path"), "path", "left_anti").withColumn("reason", F.lit("missing"))
    undecodable = found.filter("NOT __decodes").select(*asked.columns, F.lit("undecodable").alias("reason"))
    frames = found.filter("__decodes").withColumn("timestamp", F.current_timestamp() if taken_at is None else taken_at)
    return frame_messages(frames, "content", keep=["path"]), undecodable.unionByName(missing)


def _local_tasks(spark: SparkSession) -> int:
    return LOCAL_TASKS * spark.sparkContext.defaultParallelism


def _local_path(spark: SparkSession, path: str) -> str | None:
    """Where a path of the local file system lies, as tasks open it; None for those of others, and for patterns."""
    if any(c in path for c in "*?[{\\"):
        return None
    fs, target = _file_system(spark, path)
    at = fs.makeQualified(target).toUri()
    return at.getPath() if at.getScheme() == "file" else None


def _local_folders(spark: SparkSession, folders: list[str]) -> list[str] | None:
    """Where the folders lie if all are local, without those inside of others; None if one is not, or is not there."""
    paths = {_local_path(spark, f) if _exists(spark, f) and _status(spark, f).isDirectory() else None for f in folders}
    if not paths or None in paths:
        return None
    return [p for p in sorted(paths) if not any(p.startswith(f"{q}/") for q in paths)]


def _walked(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Path, time and length of files that are not empty or hidden, as Spark lists them: what lies in the folders, then what lies deeper."""
    ship_package(spark)
    names = ("path", "modificationTime", "length")  # a folder has no length

    def walk(batches, deep):
        rows = (row for batch in batches for known in zip(*(batch.column(n).to_pylist() for n in names))
                for row in ([known] if known[2] is not None else _entries(known[0], deep)))
        for chunk in itertools.batched(rows, HELD_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*chunk), (pa.string(), pa.int64(), pa.int64()))], names=names)

    schema = "path string, modificationTime bigint, length bigint"
    top = spark.createDataFrame([(f, None, None) for f in folders], schema).mapInArrow(lambda batches: walk(batches, False), schema)
    files = top.repartition(_local_tasks(spark)).mapInArrow(lambda batches: walk(batches, True), schema)
    return files.select(F.concat(F.lit("file:"), "path").alias("path"), F.timestamp_millis("modificationTime").alias("modificationTime"), "length")


def _entries(path: str, deep: bool) -> Iterator[tuple]:
    """What Spark would list in a folder; the folders in it are walked if `deep`, or else given without a length."""
    todo = [path]
    while todo:
        at = todo.pop()
        try:
            entries = os.scandir(at)
        except FileNotFoundError:  # gone since
            continue
        with entries:
            for entry in entries:
                if entry.name.startswith(".") or entry.name.startswith("_") and "=" not in entry.name or entry.name.endswith("._COPYING_"):
                    continue
                name = os.fsencode(entry.path).decode(errors="replace")
                try:
                    if not entry.is_dir():
                        told = entry.stat()
                        if told.st_size:
                            yield name, told.st_mtime_ns // 1_000_000, told.st_size
                    elif deep:
                        todo.append(entry.path)
                    else:
                        yield name, None, None
                except FileNotFoundError:
                    continue


def _with_contents(rows: DataFrame) -> DataFrame:
    """Rows with the `content` of the local file at their `path`; those whose file is gone are left out.

    Checksums that Hadoop keeps beside files it made are not looked at.
    """
    spark = rows.sparkSession

    def read(batches):
        for batch in batches:
            kept, contents, held = [], [], 0
            for row, path in enumerate(batch.column("path").to_pylist()):
                try:
                    with open(path.removeprefix("file:"), "rb") as file:
                        contents.append(file.read())
                except FileNotFoundError:
                    continue
                kept.append(row)
                held += len(contents[-1])
                if held >= HELD_BYTES:
                    yield with_column(batch, kept, contents)
                    kept, contents, held = [], [], 0
            yield with_column(batch, kept, contents)

    def with_column(batch, kept, contents):
        taken = batch.take(pa.array(kept, pa.int64()))
        return pa.RecordBatch.from_arrays([*taken.columns, pa.array(contents, pa.binary())], names=[*batch.schema.names, "content"])

    schema = T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())])
    return rows.repartition(_local_tasks(spark)).mapInArrow(read, schema)


def stream_parquet(spark: SparkSession, path: str, schema: str | T.StructType, per_trigger: int | None = None) -> DataFrame:
    """A stream of the rows of a Parquet table, be it a directory or a single file; `per_trigger` counts files."""
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if _status(spark, path).isDirectory():
        return reader.parquet(path)
    # A file source reads directories only.
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, for what reads them more than once."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(metrics: DataFrame, path: str) -> None:
    """A one-row metrics table as JSON."""
    metrics.write.mode("overwrite").json(path)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _status(spark: SparkSession, path: str):
    fs, target = _file_system(spark, path)
    return fs.getFileStatus(target)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
