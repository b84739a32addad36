"""Array and map expressions."""

from pyspark.sql import Column, functions as F

# Number of lags, and the volume that stands in for a missing one.
LAG_COUNT = 5
FILLER = 20.0


def newest_padded(values: Column, size: int = LAG_COUNT, filler: float = FILLER) -> Column:
    """The last `size` values, with fillers on the left if there are fewer."""
    return F.slice(F.concat(F.array_repeat(F.lit(filler), size), values), -size, size)


def ordered_field(structs: Column, field: str) -> Column:
    """One field of an array of structs, in the order of the structs."""
    return F.transform(F.array_sort(structs), lambda s: s[field])


def lag_columns(padded: Column, size: int = LAG_COUNT) -> dict[str, Column]:
    """t (newest), t1, ... from an oldest-first array."""
    names = ["t"] + [f"t{i}" for i in range(1, size)]
    return {name: padded[size - 1 - i] for i, name in enumerate(names)}


def map_total(counts: Column) -> Column:
    return F.aggregate(F.map_values(counts), F.lit(0), lambda total, n: total + n)


def positive_entries(counts: Column) -> Column:
    return F.map_filter(counts, lambda _, n: n > 0)
