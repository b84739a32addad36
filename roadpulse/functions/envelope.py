"""JSON message envelopes: key and value in, typed columns out, and back."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt_record"


def parse_time(text: Column) -> Column:
    """ISO-8601 text to an instant; null, not an error, on bad text."""
    return F.try_to_timestamp(text)


def decode(df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = (),
           where: Callable[[Column], Column] | None = None, with_corrupt: bool = False) -> DataFrame:
    """Flat columns of a JSON value. Broken JSON gives nulls; `with_corrupt` adds its text.

    `where` picks records by their fields. It runs on the parsed record, inside a generator: Spark
    would move a filter below the parsing, and so parse each value once more per condition.
    """
    options = {}
    if with_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
    records = F.array(F.from_json(F.col(value).cast("string"), schema, options))
    return df.select(*keep, F.inline(F.filter(records, where) if where else records))


def encode(df: DataFrame, key: str | Column, fields: Sequence[str | Column],
           keep: Sequence[str | Column] = ()) -> DataFrame:
    """Columns `key` and `value`; null fields are left out of the JSON."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.alias("key"), F.to_json(F.struct(*fields)).alias("value"), *keep)
