"""Near-equal lines by a segment-partition edit join.

Lines within `edits` edits of each other are linked, and components of links are classes; the first
line of a class, by document and place, stays and the others go.

1. A line is split into edits + 1 segments: if two lines are within the distance, one segment of the
   shorter one stands unchanged in the longer one, close to its own place. Each line sends a key for each
   of its segments, and one for each part of itself that may be a segment of a line of its length or up to
   `edits` less (multi-match-aware places). Keys of one line only go no further.
2. Lines of one key meet in blocks. A pair whose character counts differ by more than edits can explain
   is out; lines without a partner go no further. Only then do the texts come.
3. Pairs are verified by banded bit-parallel edit distance, many at a time, and each block returns a
   spanning forest of its links. Large keys are cut into blocks, and each pair of blocks is one task.

Equal lines are one line here, by 96 bits of hash. Lines of fewer than `least` characters are linked with
equal ones only. Lines of white space stay, as do null and empty texts. Repeated rows are documents of their own. Of repeated ids,
and where ids are null (last), the order of equal places is that of the lines; rows with equal id and
text lose the same lines, so that the first occurrence stays in each of them. Extra columns stay; names that
begin with two underscores are reserved.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from roadpulse.llm.batches import groups
from roadpulse.llm.components import components
from roadpulse.llm.minhash import _Forest
from roadpulse.llm.tables import settle
from roadpulse.session import fresh_dir, ship_package

EDITS, LEAST = 2, 20
BLOCK_ROWS, BLOCK_BYTES = 1024, 2_000_000
BINS = 32
_PAIRS = 4096  # verified at once
_BLANK = " \t\x0b\f\r"
_CELLS = 4_000_000  # characters in a table of them


def segment(length, parts: int, k):
    """Start (from 0) and size of segment k of a text; the last segments are longer by one if need be. For numbers and columns."""
    short = (length - length % parts) / parts
    if isinstance(length, Column):
        extra = F.greatest(F.lit(0), F.lit(k) - (parts - length % parts))
        return (k * short + extra).cast("int"), (short + (F.lit(k) >= parts - length % parts).cast("int")).cast("int")
    return int(k * short + max(0, k - (parts - length % parts))), int(short + (k >= parts - length % parts))


def shifts(less: int, edits: int, k: int) -> range:
    """Where segment k of a line that is shorter by `less` may stand in the longer one, relative to its own start."""
    return range(max(-k, less - (edits - k)), min(k, less + (edits - k)) + 1)


def _keyed(lines: DataFrame, edits: int) -> DataFrame:
    """x, y, key and own (whether it is a segment of the line itself) of lines with x, y, n and `wide`, which has four bytes for each character.

    Places are exploded first and keys computed of each: all keys in one expression are more code than the JVM compiles.
    """
    places = F.array(*[F.struct(F.lit(less).alias("less"), F.lit(k).alias("k"), F.lit(shift).alias("shift"))
                       for less in range(edits + 1) for k in range(edits + 1) for shift in shifts(less, edits, k)])
    each = lines.select("x", "y", "n", "wide", F.inline(places))
    k, other = F.col("k"), F.col("n") - F.col("less")
    start, size = segment(other, edits + 1, k)
    key = F.xxhash64(k, other, F.substring("wide", 4 * (start + F.col("shift")) + 1, 4 * size))
    return each.select("x", "y", key.alias("key"), ((F.col("less") == 0) & (F.col("shift") == 0)).alias("own"))


def _lines(docs: DataFrame, id: str, text: str, least: int) -> DataFrame:
    """__id, __text, __at, line, and its hashes x and y, for lines of `least` characters that are not blank."""
    return (docs.select(F.col(id).alias("__id"), F.xxhash64(F.col(text)).alias("__text"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("__at", "line"))
            .filter((F.length("line") >= least) & (F.btrim("line", F.lit(_BLANK)) != ""))
            .withColumn("x", F.xxhash64("line")).withColumn("y", F.hash("line", F.lit(1))))


def distances(codes: np.ndarray, sizes: np.ndarray, long: np.ndarray, short: np.ndarray, edits: int) -> np.ndarray:
    """For pairs of rows of `codes`, the longer one first, their edit distance, or edits + 1 if it is more.

    Bit-vectors of vertical differences in a band of 2 * edits + 1 rows around the diagonal, all pairs
    at once: first down the lowest diagonal of the band, then along the last row.
    """
    m, n = sizes[long], sizes[short]
    width = 2 * edits + 1
    full = np.uint64((1 << width) - 1)
    one = np.uint64(1)
    vp = np.full(len(long), ((1 << (edits + 1)) - 1) << edits, np.uint64)
    vn = np.zeros(len(long), np.uint64)
    distance = np.full(len(long), edits, np.int64)
    # the band's characters of the longer line; beyond its ends nothing is equal
    pad = np.full((len(codes), edits), -1, codes.dtype)
    wide = np.concatenate([pad, codes, pad], axis=1)
    top = np.uint64(1 << (width - 1))
    for j in range(int(n.max(initial=0))):
        here = codes[short, j]
        match = np.zeros(len(long), np.uint64)
        for bit in range(width):
            column = wide[long, j + bit] if j + bit < wide.shape[1] else np.full(len(long), -1, codes.dtype)
            match |= (column == here).astype(np.uint64) << np.uint64(bit)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        along = j - (m - edits)  # from 0 on, the last row is below the band's lowest
        at = np.left_shift(one, np.maximum(width - 2 - along, 0).astype(np.uint64))
        step = np.where(along < 0, ((d0 & top) == 0).astype(np.int64), ((hp & at) != 0).astype(np.int64) - ((hn & at) != 0).astype(np.int64))
        distance = np.where(j < n, distance + step, distance)
        down = d0 >> one
        vp, vn = (hn | ~(down | hp)) & full, down & hp
    return np.where((np.abs(m - n) > edits) | (distance > edits), edits + 1, distance)


def _points(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le"), np.int32)


def _table(lines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in lines], np.int64)
    codes = np.full((len(lines), int(sizes.max(initial=0)) + 1), -2, np.int32)
    for k, s in enumerate(lines):
        codes[k, : len(s)] = s
    return codes, sizes


def _codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return _table([_points(s) for s in lines])


def bins(lines: list[str]) -> np.ndarray:
    """How often characters of each bin occur; an edit changes two counts by one at most."""
    out = np.zeros((len(lines), BINS), np.int32)
    for k, s in enumerate(lines):
        out[k] = np.bincount(np.frombuffer(s.encode("utf-32-le"), np.uint32) * np.uint32(2654435769) >> np.uint32(27), minlength=BINS)
    return out


def _near(counts: np.ndarray, a: np.ndarray, b: np.ndarray, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a and b whose counts allow the distance, some rows of a at a time."""
    for start in range(0, len(a), 64):
        part = a[start : start + 64]
        far = np.abs(counts[part][:, None, :] - counts[b][None, :, :]).sum(2) > 2 * edits
        i, j = np.nonzero(~far & (part[:, None] != b[None, :]))
        yield part[i], b[j]


class _Verifier:
    """Pairs of several groups, verified together; links are a spanning forest of each group."""

    def __init__(self, edits: int):
        self.edits, self.pairs, self.links = edits, [], []

    def add(self, forest: _Forest, names: list[str], lines: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            if forest.root(i) != forest.root(j):
                self.pairs.append((forest, names, i, j, *self._trimmed(lines[i], lines[j])))
                if len(self.pairs) >= _PAIRS:
                    self.verify()

    def _trimmed(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longer one first, without equal beginnings and ends, but for as much as the band needs."""
        x, y = (x, y) if len(x) >= len(y) else (y, x)
        n = len(y)
        other = np.flatnonzero(x[:n] != y)
        head = int(other[0]) if len(other) else n
        other = np.flatnonzero(x[len(x) - n :][::-1] != y[::-1])
        tail = int(other[0]) if len(other) else n
        spare = n - self.edits - 1
        head = max(0, min(head, spare))
        tail = max(0, min(tail, spare - head))
        return x[head : len(x) - tail], y[head : n - tail]

    def verify(self) -> None:
        pairs = sorted(self.pairs, key=lambda p: len(p[4]))
        self.pairs = []
        while pairs:
            # as many as fit in a table of bounded size
            count = 1
            while count < len(pairs) and (count + 1) * len(pairs[count][4]) <= _CELLS:
                count += 1
            part, pairs = pairs[:count], pairs[count:]
            codes, sizes = _table([p[4] for p in part] + [p[5] for p in part])
            near = distances(codes, sizes, np.arange(count), np.arange(count) + count, self.edits) <= self.edits
            for k in np.flatnonzero(near).tolist():
                forest, names, i, j, *_ = part[k]
                if forest.tie(i, j):
                    self.links.append((names[i], names[j]))


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the lower and of the upper block of a group (all of them, if it is one block)."""
    block = table.column("block").to_numpy()
    return np.flatnonzero(block == table.column("i")[0].as_py()), np.flatnonzero(block == table.column("j")[0].as_py())


_BLOCK = ["key", "i", "j"]


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a key in all pairs of blocks they take part in, sorted for groups. Blocks are bounded by rows and by bytes of lines."""
    in_key = W.partitionBy("key")
    size = F.count(F.lit(1)).over(in_key) / BLOCK_ROWS
    if "line" in rows.columns:
        size = F.greatest(size, F.sum(F.octet_length("line")).over(in_key) / BLOCK_BYTES)
    return (rows.withColumn("blocks", F.ceil(size).cast("int")).withColumn("block", F.pmod(F.xxhash64("x", "y"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "other")
            .repartition(*_BLOCK).sortWithinPartitions(*_BLOCK))


def line_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """x and y (the hashes of a line) and class, for lines that are linked to another text."""
    if least < (edits + 2) ** 2:
        raise ValueError(f"lines of {least} characters are too short for segments that move by {edits}")
    spark = docs.sparkSession
    settle(spark)
    ship_package(spark)
    lines = _lines(docs, id, text, least)
    wide = lines.select("x", "y", F.length("line").alias("n"), F.encode("line", "UTF-32").alias("wide"))
    keyed = (_keyed(wide, edits)
             .repartition("key").groupBy("key", "x", "y").agg(F.bool_or("own").alias("own")))
    in_key = W.partitionBy("key")
    shared = (keyed.withColumn("lines", F.count(F.lit(1)).over(in_key)).withColumn("any", F.bool_or("own").over(in_key))
              .filter("lines > 1 and any").select("key", "x", "y", "own").checkpoint())
    place = fresh_dir(spark, "lines")  # the candidates' texts are read twice
    candidates = shared.select("x", "y").distinct()
    # copies of a line combine in each task ahead of the shuffle
    once = lines.groupBy("x", "y").agg(F.min("line").alias("line"))
    once.join(candidates, ["x", "y"], "left_semi").write.parquet(place)
    texts = spark.read.parquet(place)

    counted_type = T.StructType().add("x", "long").add("y", "integer").add("counts", "binary")

    def count(batches):
        for batch in batches:
            counts = bins(batch.column("line").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array([c.astype(np.int32).tobytes() for c in counts], pa.binary())], names=counted_type.names)

    counted = texts.mapInArrow(count, counted_type)
    pair_type = T.StructType().add("key", "long").add("x", "long").add("y", "integer").add("own", "boolean")

    def partners(batches):
        for table in groups(batches, _BLOCK):
            counts = np.stack([np.frombuffer(c, np.int32) for c in table.column("counts").to_pylist()])
            own = table.column("own").to_numpy(zero_copy_only=False)
            low, high = _sides(table)
            hit = np.zeros(len(counts), bool)
            for a, b in _near(counts, low, high, edits):
                fits = own[a] | own[b]
                hit[a[fits]] = hit[b[fits]] = True
            if hit.any():
                out = table.filter(pa.array(hit))
                yield from out.select(pair_type.names).combine_chunks().to_batches()

    met = _in_blocks(shared.join(counted, ["x", "y"]).select("key", "x", "y", "own", "counts"))
    met = met.mapInArrow(partners, pair_type).distinct()
    link_type = T.StructType().add("a", "string").add("b", "string")

    def verify(batches):
        verifier = _Verifier(edits)
        for table in groups(batches, _BLOCK):
            names = [f"{x}:{y}" for x, y in zip(table.column("x").to_pylist(), table.column("y").to_pylist())]
            own = table.column("own").to_numpy(zero_copy_only=False)
            here = table.column("line").to_pylist()
            counts, points, forest = bins(here), [_points(s) for s in here], _Forest(len(here))
            for a, b in _near(counts, *_sides(table), edits):
                fits = own[a] | own[b]
                if table.column("i")[0] == table.column("j")[0]:
                    fits &= a < b
                verifier.add(forest, names, points, a[fits], b[fits])
            yield from links_of(verifier)
        verifier.verify()
        yield from links_of(verifier)

    def links_of(verifier):
        if verifier.links:
            a, b = zip(*verifier.links)
            verifier.links = []
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    blocks = _in_blocks(met.join(texts, ["x", "y"]).select("key", "x", "y", "own", "line"))
    links = blocks.mapInArrow(verify, link_type)
    found = components(links, "a", "b")
    part = F.split("node", ":")
    return found.select(part[0].cast("long").alias("x"), part[1].cast("int").alias("y"), F.col("component").alias("class"))


def removed_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """__id and __text (its hash) of documents that lose lines, with the numbers of those lines from 0 in order."""
    classes = line_classes(docs, id, text, edits, least).checkpoint()
    lines = _lines(docs, id, text, 1).select("__id", "__text", "__at", "x", "y")  # short ones are removed if they are equal
    at = F.struct(F.col("__id").isNull().alias("last"), "__id", "__text", "__at")
    # counts alone are merged without a sort; places matter of lines that are repeated or linked only
    counted = lines.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    named = counted.join(classes, ["x", "y"], "left").filter("n > 1 or class is not null")
    named = named.select("x", "y", F.coalesce("class", F.concat_ws(":", "x", "y")).alias("class")).checkpoint()
    places = lines.join(named, ["x", "y"]).select("__id", "__text", "__at", "class").checkpoint()
    first = places.groupBy("class").agg(F.min(at).alias("least"))
    gone = places.join(first, "class").filter(at != F.col("least"))
    return gone.groupBy("__id", "__text").agg(F.array_sort(F.collect_set("__at")).alias("removed"))


def remove_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", edits: int = EDITS, least: int = LEAST,
                 drop_emptied: bool = False) -> DataFrame:
    """All rows and columns; the text has the lines that stay. With `drop_emptied` documents that lose all but blank lines go."""
    gone = removed_lines(docs, id, text, edits, least).withColumnRenamed("removed", "__removed")
    joined = docs.join(gone, F.col(id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__text")), "left")
    # numbers and lines are both in order, so the lines that stay are those at the places not in `removed`
    kept = F.filter(F.split(F.col(text), "\n", -1), lambda _, k: ~F.array_contains("__removed", k))
    new = F.when(F.col("__removed").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    if drop_emptied:
        joined = joined.filter(F.col("__removed").isNull() | (F.btrim(F.array_join(kept, ""), F.lit(_BLANK)) != ""))
    return joined.select(*[new.alias(c) if c == text else docs[c] for c in docs.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """For each document its number of lines and the numbers of those that go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    sizes = docs.select("doc_id", F.xxhash64("text").alias("t"), F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"))
    joined = sizes.join(removed_lines(docs), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("t") == F.col("__text")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))
