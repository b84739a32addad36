"""Settings that jobs take from the session."""

import contextlib
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and intermediate tables, or else one in the warehouse."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; it is not created, and goes with the application."""
    return f"{_application_dir(shared_dir(spark), spark.sparkContext)}/{name}-{uuid.uuid4().hex}"


_made: set[str] = set()


def _application_dir(shared: str, context) -> str:
    path = f"{shared}/{context.applicationId}"
    if path not in _made:
        _made.add(path)
        hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
        system = hadoop.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(hadoop)
        system.deleteOnExit(hadoop)
    return path


def ship_package(spark: SparkSession) -> None:
    """Put this package on the path of the Python workers, once per application."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)


@functools.lru_cache(maxsize=1)
def _ship(application_id: str, context) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="roadpulse-"), os.path.basename(package))
    context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))


@contextlib.contextmanager
def session_settings(spark: SparkSession, settings: dict):
    """Settings for the body only. A streaming query keeps those it was started under."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
