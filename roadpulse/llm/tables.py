"""Where operators cut lineage, and rows with numbers."""

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import fresh_dir
from roadpulse.sources.paths import Folder


def settle(spark: SparkSession) -> None:
    """Make checkpoint() write to the shared folder the cluster names, if it does not already."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(fresh_dir(spark, "checkpoints"))


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of tables that nothing holds any more, which it does when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def kept(rows: DataFrame, name: str, instead_of: str | None = None) -> tuple[DataFrame, str]:
    """The rows as a written table, and its place; the table that they were made from goes, if its place is given."""
    spark = rows.sparkSession
    place = fresh_dir(spark, name)
    rows.write.parquet(place)
    if instead_of:
        Folder(spark, instead_of).delete("")
        release(spark)
    return spark.read.schema(rows.schema).parquet(place), place


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows in a written table, with `row`, a number from 0 without gaps in the order of the tasks and in them."""
    spark = rows.sparkSession
    place = fresh_dir(spark, name)
    # the number of the task and the place in it, which the table then holds fast
    rows.withColumn("__task", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).write.parquet(place)
    written = spark.read.parquet(place)
    before, starts = 0, []
    for task, count in sorted(map(tuple, written.groupBy("__task").count().collect())):  # one row for each task
        starts.append((task, before))
        before += count
    first = spark.createDataFrame(starts, "__task int, __first long")
    return written.join(first, "__task").withColumn("row", F.col("__first") + F.col("__at")).drop("__task", "__at", "__first")
