"""Seeded samples and splits that do not depend on how the rows are partitioned."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def sample_key(key: Sequence[str], seed: int) -> Column:
    """A uniform text key per row, from a seed and the columns that identify the row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


PREFIX = 6  # characters of a row's rank: the flag of preferred rows and five of its key, about a million values


def _first(df: DataFrame, n: int, rank: Column, key: Sequence[str]) -> DataFrame:
    """The n rows of the least ranks.

    Counts of rank prefixes give the prefix that the n-th row has, and rows beyond it are left out where
    they are read. So about n rows meet in the last sort, and not n rows of each task. `df` is read twice:
    give a written table, not a plan that is dear to run.
    """
    prefix = F.substring(rank, 1, PREFIX)
    counts = df.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    # no more rows than there are prefixes, so one task may add them up
    reached = counts.withColumn("reached", F.sum("rows").over(Window.orderBy("prefix"))).filter(F.col("reached") >= n)
    last = reached.agg(F.min("prefix")).scalar()
    return df.filter(F.coalesce(prefix <= last, F.lit(True))).orderBy(rank, *key).limit(n)


def sample_exact(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows, or all if there are fewer."""
    return _first(df, n, F.concat(F.lit("0"), sample_key(key, seed)), key)


def sample_preferring(df: DataFrame, n: int, preferred: Column, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows, from the preferred ones as far as they go and then from the others."""
    return _first(df, n, F.concat(F.when(preferred, "0").otherwise("1"), sample_key(key, seed)), key)


def hash_fraction(key: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) per row."""
    return F.conv(F.substring(sample_key(key, seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def split_by_hash(df: DataFrame, train: float, key: Sequence[str], seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split by row identity: the same rows on every run and cluster."""
    fraction = hash_fraction(key, seed)
    return df.filter(fraction < train), df.filter(fraction >= train)


def split_random(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split; its rows depend on the partitioning of the input."""
    first, second = df.randomSplit([train, 1 - train], seed)
    return first, second


def split_by_time(df: DataFrame, train: float, time: str) -> tuple[DataFrame, DataFrame]:
    """The first `train` part of the time range, and the rest: no neighbours on both sides."""
    micros = F.unix_micros(time)
    span = F.max(micros) - F.min(micros)
    cut = df.agg(F.min(micros) + F.floor(span * F.lit(train))).scalar()
    return df.filter(micros <= cut), df.filter(micros > cut)
