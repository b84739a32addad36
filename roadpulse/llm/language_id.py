"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram is the product of its letters' vectors, each
rotated by its place; a text is the sum of its trigrams, and a language the sum of its texts. A text
gets the language whose vector has the largest cosine with its own. Trigrams cover words with a blank
on either side and do not cross them.

Nulls and texts without a letter are `und` with score 0; so is every text if no language is learned.
Ties go to the first language in order. Rows are judged one by one, so repeated rows and ids change
nothing; extra columns stay, and columns with the names of the result give way. Sums are of integers, so the order of rows does not matter.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import slices
from roadpulse.session import ship_package

DIMENSIONS = 1024
#: More languages than this are a mistake in the column; they would also be too many to collect.
MOST_LANGUAGES = 1000
NONE = "und"
_ROWS = 4096  # trigram vectors made at once


def _letters(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Code points with 0 for runs of anything but letters, and the text of each."""
    lowered = [f" {t.lower()} " if t else "  " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    which = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    seen = np.flatnonzero(np.bincount(points, minlength=1))
    table = np.zeros(int(seen[-1]) + 1 if len(seen) else 1, np.uint32)
    for p in seen:
        table[p] = p if chr(p).isalpha() else 0
    points = table[points]
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0) | (which[1:] != which[:-1])
    return points[keep], which[keep]


def _trigrams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct trigrams as rows of three code points, and for each occurrence its row and its text."""
    points, which = _letters(texts)
    alphabet, ids = np.unique(points, return_inverse=True)
    n = len(alphabet)
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    blank = 0 if n and alphabet[0] == 0 else -1
    inside = (which[:-2] == which[2:]) & (b != blank)
    codes = ((a * n + b) * n + c)[inside]
    if n**3 <= 1 << 22:
        seen = np.flatnonzero(np.bincount(codes, minlength=1)) if len(codes) else codes
        place = np.zeros(n**3, np.int64)
        place[seen] = np.arange(len(seen))
        at = place[codes]
    else:
        seen, at = np.unique(codes, return_inverse=True)
    return alphabet[np.stack([seen // (n * n), seen // n % n, seen % n], 1)] if n else np.zeros((0, 3), np.uint32), at, which[:-2][inside]


def letter_vector(point: int, dimensions: int) -> np.ndarray:
    """The vector of a letter, the same on every machine; the blank has one as well."""
    random = np.random.Generator(np.random.Philox(key=int(point) + 1))
    return (random.integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)


class _Space:
    """Vectors of trigrams, with the letters' kept for the task."""

    def __init__(self, dimensions: int):
        self.dimensions, self.letters = dimensions, {}

    def vectors(self, trigrams: np.ndarray) -> np.ndarray:
        out = np.ones((len(trigrams), self.dimensions), np.int8)
        for place in range(3):
            points, at = np.unique(trigrams[:, place], return_inverse=True)
            for p in points.tolist():
                if p not in self.letters:
                    self.letters[p] = letter_vector(p, self.dimensions)
            out *= np.roll(np.stack([self.letters[p] for p in points.tolist()]), 2 - place, axis=1)[at]
        return out.astype(np.float32)

    def bundles(self, group: np.ndarray, at: np.ndarray, trigrams: np.ndarray, groups: int) -> np.ndarray:
        """The sum of the trigram vectors of each group."""
        out = np.zeros((groups, self.dimensions), np.float64)
        for start in range(0, len(trigrams), _ROWS):
            part = trigrams[start : start + _ROWS]
            mine = (at >= start) & (at < start + len(part))
            counts = np.bincount(group[mine] * len(part) + at[mine] - start, minlength=groups * len(part))
            out += counts.reshape(groups, len(part)).astype(np.float32) @ self.vectors(part)
        return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS,
          most_languages: int = MOST_LANGUAGES) -> dict[str, np.ndarray]:
    """The vector of each language over all rows with a language and a text."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _Space(dimensions), {}
        for batch in slices(batches, "t"):
            names = batch.column("l").to_pylist()
            order = sorted(set(names))
            group = np.array([order.index(x) for x in names])
            trigrams, at, which = _trigrams(batch.column("t").to_pylist())
            if len(at):
                for name, vector in zip(order, space.bundles(group[which], at, trigrams, len(order))):
                    sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(vector.astype(np.int64))],
                names=["l", "i", "v"])

    ship_package(docs.sparkSession)
    rows = (docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).filter("t is not null and l is not null")
            .mapInArrow(bundle, "l string, i int, v long").groupBy("l", "i").agg(F.sum("v").alias("v")))
    found = rows.groupBy("l").agg(F.array_sort(F.collect_list(F.struct("i", "v")))["v"].alias("v")).limit(most_languages + 1).collect()
    if len(found) > most_languages:
        raise ValueError(f"{lang} has over {most_languages} values")
    return {r.l: np.array(r.v, np.float64) for r in sorted(found, key=lambda r: r.l)}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns, with the language and its cosine, which is 0 at least, in the two named columns."""
    order = list(profiles)
    unit = [v / (np.linalg.norm(v) or 1) for v in profiles.values()]
    matrix = np.stack(unit, 1) if unit else np.zeros((dimensions, 0))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _Space(dimensions)
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            trigrams, at, which = _trigrams(texts)
            languages, scores = [NONE] * len(texts), np.zeros(len(texts))
            if order and len(at):
                bundled = space.bundles(which, at, trigrams, len(texts))
                cosines = bundled @ matrix / np.maximum(np.linalg.norm(bundled, axis=1, keepdims=True), 1e-9)
                best = cosines.argmax(1)
                lettered = np.bincount(which, minlength=len(texts)) > 0
                languages = [order[b] if ok else NONE for b, ok in zip(best.tolist(), lettered.tolist())]
                scores = np.where(lettered, np.clip(cosines.max(1), 0, 1), 0)
            kept = [c for n, c in zip(batch.schema.names, batch.columns) if n in passed]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*passed, *names])

    ship_package(docs.sparkSession)
    passed = [c for c in docs.columns if c.lower() not in names]
    schema = docs.select(*[docs[c] for c in passed]).schema.add(names[0], "string").add(names[1], "double")
    return docs.select(*[docs[c] for c in passed]).mapInArrow(judge, schema)


def held_out(id: Column) -> Column:
    """One row in four; a null id is not held out."""
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(False))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = learn(docs.filter(~held_out(F.col("doc_id"))))
    judged = predict(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), profiles)
    return judged.select("doc_id", "held_out", "lang_pred", "score")
