"""Message headers: array<struct<key string, value binary>>."""

from pyspark.sql import Column, functions as F


def header_text(headers: Column, name: str) -> Column:
    """Text of the last header called `name`; null if absent or not valid UTF-8."""
    last = F.try_element_at(F.filter(headers, lambda h: h["key"] == name), F.lit(-1))
    return F.try_validate_utf8(last["value"].cast("string"))


def make_headers(**texts: Column) -> Column:
    return F.array(*[
        F.struct(F.lit(name).alias("key"), F.encode(text, "UTF-8").alias("value"))
        for name, text in texts.items()
    ])
