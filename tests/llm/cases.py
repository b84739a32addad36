"""Small documents with the cases every operator must take."""

import random

from pyspark.sql import types as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, stems: int = 60) -> str:
    draw = random.Random(seed)
    parts = ["the", "of", "and", "tion", "er", "sha", "ble", "ing", "on", "ea", "est", "wh", "und", "ê", "ciá"]
    lexicon = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(stems)]
    out = [draw.choice(lexicon) for _ in range(words)]
    for k in range(9, words, 17):
        out[k] += ".\n" if k % 2 else "."
    return " ".join(out).replace("\n ", "\n")


def texts() -> list[str | None]:
    base = prose(1, 160)
    changed = base.split(" ")
    changed[40] = "changed"
    edited = base[:30] + "x" + base[30:]
    far = base.split(" ")
    for k in range(0, len(far), 6):
        far[k] = f"w{k}"
    return [base, base, " ".join(changed), edited, " ".join(far), prose(2, 300), prose(3, 40), prose(3, 40).upper(), "One", "one",
            "two words", "", "   \n\t ", None, "…", "ß " * 50, prose(4, 20000, 2000), prose(5, 90) + "\n" + base]


def documents(spark, rows: list | None = None):
    rows = [(k, t, ("en", "de", None)[k % 3], f"src{k % 2}", len(t or "")) for k, t in enumerate(texts())] if rows is None else rows
    return spark.createDataFrame(rows, DOCUMENT)


def odd(spark):
    """Null ids, repeated rows, and columns whose names clash with those of the operators."""
    names = ("n_words", "KEPT", "score", "spans", "ids", "decoded", "hits", "removed", "n_shingles", "host", "rule", "x", "y", "n_chars")
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string")
    for name in names:
        schema = schema.add(name, "string")
    base = prose(1, 160)
    rows = [(1, base, "en"), (1, base, "en"), (None, base, None), (None, None, "en"), (2, None, None), (3, "", "xx"), (4, prose(9, 50), "en")]
    return spark.createDataFrame([r + ("v",) * len(names) for r in rows], schema)


def empty(spark):
    return documents(spark, [])
