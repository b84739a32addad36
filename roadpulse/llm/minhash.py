"""Near-duplicate documents by b-bit MinHash.

1. Each document becomes its set of word shingles: a digest of the set, the low bits of its minima, and
   a key for each band of minima. Documents of equal sets are one node from here on.
2. In each band, all nodes with a key are tied to the least of them, the hub. A tie stays if the similarity
   estimated from the low bits, corrected for chance agreement, is not far below the threshold. Nodes that
   are not so near to the hub that all they may be linked with is tied to it as well are compared with each
   other, block by block. Components of the ties are clusters: a link between documents lies inside a cluster.
3. Clusters are cut into blocks, and each pair of blocks is one task that confirms links on full sets
   and returns a spanning forest of them. Components of the links are the result.

With 64 bands of 6 minima, two documents of similarity 0.8 share no band with probability 3.5e-9. No
bucket is expanded into pairs of rows that are written, and no bucket's rest and no cluster is read by one task.

A null or empty text has no shingles and is linked with nothing. A text of fewer words than a shingle
is one shingle. Rows of equal sets are equal, also if they repeat an id; a null id is linked, but never
names a component. Extra columns stay, and columns with the names of the result, or of two underscores in front, give way.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from roadpulse.llm import batches as B
from roadpulse.llm.components import components
from roadpulse.llm.tables import release, settle
from roadpulse.session import fresh_dir, ship_package

BANDS, ROWS = 64, 6
BITS = 2  # kept of each minimum
TIE = 0.4  # estimated similarity from which a tie stays; eight standard errors and more below 0.8
#: Estimated similarity to the hub from which a node is done with the bucket. Bits that differ add up along a
#: path, so what it may be linked with (estimated six standard errors below 0.8 at least) is tied to the hub too.
DONE = 0.75
REST_ROWS = 1024  # nodes of a bucket in a block, compared by their bits
BLOCK_ROWS, BLOCK_BYTES = 600, 4_000_000
_random = np.random.Generator(np.random.Philox(key=7))
_XOR = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MULTIPLY = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in order, one after the other, and where each text's begin."""
    data, offsets = B.utf8(texts)
    data = B.LOWER[data]
    starts, ends, firsts = B.words(data, offsets)
    hashes = B.word_hashes(data, starts, ends)
    counts = np.diff(firsts)
    each = B.windows(hashes, words)
    of = np.concatenate([np.repeat(np.arange(len(counts)), np.maximum(counts - words + 1, 0)), np.flatnonzero((counts > 0) & (counts < words))])
    few = (counts > 0) & (counts < words)
    lone = B.ranges(hashes, firsts[:-1][few], firsts[1:][few], 4)  # hashed otherwise, so it equals no shingle of full length
    values = np.concatenate([each[B.inside(firsts, words)], lone])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    values, of = values[new], of[new]
    return values, np.searchsorted(of, np.arange(len(counts) + 1))


def _sets_in_slices(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many texts, of which a few are worked on at a time."""
    values, firsts, total = [], [], 0
    for part in B.slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text"):
        own, begin = shingle_sets(part.column("text"), words)
        values.append(own)
        firsts.append(begin[:-1] + total)
        total += len(own)
    return np.concatenate([np.zeros(0, np.uint64), *values]), np.concatenate([np.zeros(0, np.int64), *firsts, [total]]).astype(np.int64)


def digests(values: np.ndarray, firsts: np.ndarray) -> list[bytes]:
    """12 bytes for each set, equal for equal sets."""
    out = []
    for salt in (0x51ED270B7A2C3F15, 0x2545F4914F6CDD1D):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(B.mixed(values ^ np.uint64(salt)), out=sums[1:])
        out.append(B.mixed(sums[firsts[1:]] - sums[firsts[:-1]]))
    return [a.tobytes() + b.tobytes()[:4] for a, b in zip(*out)]


def _minima(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The minima of the sets that are not empty: one row for each hash function."""
    short = (B.mixed(values) >> np.uint64(32)).astype(np.uint32)
    at = firsts[:-1][np.diff(firsts) > 0]
    out = np.empty((BANDS * ROWS, len(at)), np.uint32)
    for k in range(BANDS * ROWS):
        out[k] = np.minimum.reduceat((short ^ _XOR[k]) * _MULTIPLY[k], at)
    return out


def signatures(docs: DataFrame, text: str, words: int) -> DataFrame:
    """All rows and columns but the text: n_shingles, and for sets that are not empty __set, __bands and __bits."""
    ship_package(docs.sparkSession)
    passed = [c for c in docs.columns if c != text]
    schema = (docs.select(*passed).schema.add("n_shingles", "long").add("__set", "binary")
              .add("__bands", T.ArrayType(T.LongType())).add("__bits", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in B.slices(batches, text):
            values, firsts = shingle_sets(batch.column(text), words)
            sizes = np.diff(firsts)
            full = sizes > 0
            if not full.any():
                longs = pa.nulls(len(sizes), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], pa.array(sizes), pa.nulls(len(sizes), pa.binary()), longs, longs], names=schema.names)
                continue
            minima = _minima(values, firsts)
            keys = np.zeros((BANDS, minima.shape[1]), np.uint64)
            for r in range(ROWS):
                keys = B.mixed(keys ^ minima[r::ROWS].astype(np.uint64)) + np.uint64(r)
            keys = B.mixed(keys + np.arange(BANDS, dtype=np.uint64)[:, None]).view(np.int64).T
            low = (B.mixed(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS, minima.shape[1])
            bits = (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))[None, :, None]).sum(1, dtype=np.uint64).view(np.int64).T
            place = np.where(full, np.cumsum(full) - 1, -1)
            take = pa.array(place, mask=~full)
            lists = [pa.array(list(np.ascontiguousarray(x)), pa.list_(pa.int64())).take(take) for x in (keys, bits)]
            sets = [d if ok else None for d, ok in zip(digests(values, firsts), full)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], pa.array(sizes), pa.array(sets, pa.binary()), *lists], names=schema.names)

    return docs.mapInArrow(run, schema)


def similarity(a: str, b: str):
    """Estimated from the low bits: agreement less the part that is due to chance."""
    mask = F.lit(sum(1 << (k * BITS) for k in range(64 // BITS))).cast("long")
    different = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    folded = F.transform(different, lambda x: F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(mask)))
    agree = 1 - F.aggregate(folded, F.lit(0), lambda n, x: n + x) / (BANDS * ROWS)
    chance = 1 / (1 << BITS)
    return (agree - chance) / (1 - chance)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def tie(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _confirmed(values: np.ndarray, firsts: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets of `left` and of `right`, by exact similarity in percent."""
    sizes = np.diff(firsts)
    of = np.repeat(np.arange(len(sizes)), sizes)
    mine = np.isin(of, right)
    order = np.argsort(values[mine], kind="stable")
    posted, owner = values[mine][order], of[mine][order]
    known, begin = np.unique(posted, return_index=True)
    end = np.r_[begin[1:], len(posted)]
    forest, links = _Forest(len(sizes)), []
    for a in left.tolist():
        own = values[firsts[a] : firsts[a + 1]]
        at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
        at = at[known[at] == own] if len(known) else at[:0]
        common = np.bincount(owner[B.spread(begin[at], end[at] - begin[at])], minlength=len(sizes))
        for b in np.flatnonzero((common > 0) & (100 * common >= least * (sizes[a] + sizes - common))).tolist():
            if a != b and forest.tie(a, b):
                links.append((a, b))
    return links


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """All rows and columns but the text, with n_shingles, component_id and kept."""
    spark = docs.sparkSession
    settle(spark)
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in ("n_shingles", "component_id", "kept") and not c.startswith("__")])
    place = fresh_dir(spark, "signatures")  # read for the buckets and for the result
    signatures(docs.withColumn("__text", F.xxhash64(text)), text, words).write.parquet(place)
    signed = spark.read.parquet(place)
    nodes = signed.filter("__set is not null").groupBy("__set").agg(F.min(id).alias("rep"), F.min("__text").alias("__text"), F.first("__bands").alias("bands"), F.first("__bits").alias("bits"))

    keyed = nodes.select("__set", F.explode("bands").alias("key"))
    in_bucket = W.partitionBy("key")
    met = keyed.withColumn("hub", F.min("__set").over(in_bucket)).filter("hub <> __set").select("key", "hub", F.col("__set").alias("spoke")).checkpoint()
    release(spark)
    bits = nodes.select("__set", "bits")
    pairs = (met.select("hub", "spoke").distinct().join(bits.toDF("hub", "x"), "hub").join(bits.toDF("spoke", "y"), "spoke")
             .select("hub", "spoke", similarity("x", "y").alias("similarity")).checkpoint())
    release(spark)
    rest = met.join(pairs.filter(F.col("similarity") < DONE), ["hub", "spoke"]).select("key", F.col("spoke").alias("__set"))
    ties = pairs.filter(F.col("similarity") >= TIE).select("hub", "spoke").unionByName(_rest_ties(rest, bits).toDF("hub", "spoke"))
    clusters = components(ties, "hub", "spoke").toDF("__set", "cluster")

    members = nodes.select("__set", "rep", "__text").join(clusters, "__set")
    texts = docs.select(F.col(id).alias("rep"), F.col(text).alias("text")).join(members.drop("__text"), "rep")
    # sets of null ids only: their texts by hash, one for each set
    unnamed = docs.filter(F.col(id).isNull()).select(F.xxhash64(text).alias("__text"), F.col(text).alias("text"))
    unnamed = unnamed.join(members.filter("rep is null"), "__text").dropDuplicates(["__set", "text"])
    texts = texts.unionByName(unnamed.drop("__text"))
    links = _links(texts, words, percent)
    found = components(links, "a", "b").toDF("__set", "component")

    named = nodes.select("__set", "rep").join(found, "__set", "left")
    least = named.filter("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    named = named.join(least, "component", "left").select("__set", F.coalesce("least", "rep").alias("component_id")).checkpoint()
    kept = [c for c in signed.columns if not c.startswith("__")]
    out = signed.select(*kept, "__set").join(named, "__set", "left")
    component = F.when(F.col("__set").isNull(), F.col(id)).otherwise(F.col("component_id"))
    return out.select(*kept, component.alias("component_id"), F.coalesce(F.col(id) == component, F.lit(False)).alias("kept"))


def _near_bits(bits: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of a row of `low` and one of `high` whose estimated similarity reaches TIE."""
    mask = np.uint64(sum(1 << (k * BITS) for k in range(64 // BITS)))
    most = BANDS * ROWS * (1 - TIE) * (1 - 1 / (1 << BITS))
    forest, found = _Forest(len(bits)), []
    for a in low.tolist():
        different = bits[high] ^ bits[a]
        for b in high[np.bitwise_count((different | (different >> np.uint64(1))) & mask).sum(1, dtype=np.int64) <= most].tolist():
            if a != b and forest.tie(a, b):
                found.append((a, b))
    return found


def _stars(n: int, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The least row of each component with each other row of it."""
    forest = _Forest(n)
    for a, b in pairs:
        forest.tie(a, b)
    return [(root, k) for k in sorted({k for pair in pairs for k in pair}) if (root := forest.root(k)) != k]


def _rest_ties(rest: DataFrame, bits: DataFrame) -> DataFrame:
    """Ties a, b between nodes that share a key in `rest`, each node with the least one of its component in a pair of blocks of a key.

    Nodes that meet under many keys are mostly tied to the same least one, so that few ties are left.
    """
    rows = (rest.withColumn("rows", F.count(F.lit(1)).over(W.partitionBy("key"))).filter("rows > 1")
            .withColumn("blocks", F.ceil(F.col("rows") / REST_ROWS).cast("int")).join(bits, "__set")
            .withColumn("block", F.pmod(F.xxhash64("__set"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .select("key", "i", "j", "block", "__set", "bits")
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    schema = T.StructType().add("a", "binary").add("b", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in B.groups(batches, ["key", "i", "j"]):
            sets, block = group.column("__set"), group.column("block").to_numpy()
            codes = group.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(block), -1)
            found = _near_bits(codes, np.flatnonzero(block == group.column("i")[0].as_py()), np.flatnonzero(block == group.column("j")[0].as_py()))
            if found:
                a, b = zip(*_stars(len(block), found))
                yield pa.RecordBatch.from_arrays([sets.take(pa.array(x)).combine_chunks() for x in (a, b)], names=schema.names)

    return rows.mapInArrow(run, schema).distinct()


def _links(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links a, b between sets of one cluster, as a spanning forest for each pair of blocks."""
    sizes = texts.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("size"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("size") / BLOCK_BYTES), F.lit(1)).cast("int")
    texts = (texts.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
             .withColumn("block", F.pmod(F.xxhash64("__set"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    schema = T.StructType().add("a", "binary").add("b", "binary")

    def confirm(table: pa.Table) -> pa.Table:
        values, firsts = _sets_in_slices(table.column("text").combine_chunks(), words)
        own, block = table.column("__set").to_pylist(), table.column("block").to_numpy()
        # an id may be repeated with other texts, and a row with itself: one row for each set goes on
        row = {}
        for k, digest in enumerate(digests(values, firsts)):
            if digest == own[k]:
                row.setdefault(digest, k)
        rows = np.array(sorted(row.values()), np.int64)
        low, high = (rows[block[rows] == f(block)] for f in (np.min, np.max)) if len(rows) else (rows, rows)
        links = _confirmed(values, firsts, low, high, percent) if len(rows) > 1 else []
        return pa.Table.from_arrays([pa.array([own[a] for a, _ in links], pa.binary()), pa.array([own[b] for _, b in links], pa.binary())], names=["a", "b"])

    return texts.select("cluster", "i", "j", "block", "__set", "text").groupBy("cluster", "i", "j").applyInArrow(confirm, schema)


def op7_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, words=2).select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
shingles as (select distinct doc_id, s from (select doc_id, unnest(case when len(ws) = 1 then ws
                 else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) as s from w where len(ws) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b using (s) where a.doc_id < b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select a as doc_id, a as other from both_ways union select reach.doc_id, b from reach join both_ways on a = other),
least as (select doc_id, min(other) as component from reach group by doc_id)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(least(component, d.doc_id), d.doc_id) as component_id,
       coalesce(least(component, d.doc_id), d.doc_id) = d.doc_id as kept
from documents d left join sizes using (doc_id) left join least using (doc_id)
"""
