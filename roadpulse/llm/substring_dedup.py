"""Removal of word sequences that occur elsewhere, by level-wise doubling.

A run of `length` words is repeated only if its parts are. Levels look at runs of about a quarter, half
and all of the length: what is repeated at one level alone goes on to the next. Below the full length a
window is judged by one run in it, the one with the least hash, which is the same in every copy of the
window; so the first level shuffles about one hash for fourteen words, and later ones only survivors.

Documents are dealt to chunks of a few MB by a hash. A chunk sends each hash once, with whether it has
it more than once, so a passage of all documents is one row for each chunk; the repeated hashes come
back to their chunks. Hashes have 64 bits, those of the last level 96.

Null texts have no words. Rows are documents: a row that is repeated loses its windows of full length
in both places. Extra columns stay, and columns with the names of the result give way.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from roadpulse.llm import batches as B
from roadpulse.session import ship_package

LENGTH = 35
CHUNK_BYTES = 4_000_000
_MADE = ("kept", "n_words", "n_removed")


def levels(length: int) -> list[int]:
    """Run lengths of the levels: the full length, and twice half of it, rounded up, while that is 8 or more."""
    out = [length]
    while out[0] >= 16:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of `width` values, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out, have = pick(out[:-step], out[step:]), have + step
    return out


class _Chunk:
    """The windows of one chunk's texts."""

    def __init__(self, texts: pa.ChunkedArray, length: int):
        data, offsets = B.utf8(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
        self.length = length
        starts, ends, self.firsts = B.words(data, offsets)
        self.hashes = B.word_hashes(data, starts, ends)
        self.windows = B.inside(self.firsts, length)

    def anchors(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window the hash of its anchor, a run of `run` words; and all hashes of runs."""
        grams = B.windows(self.hashes, run)
        width = self.length - run + 1
        least = _slide(grams, width, np.minimum) if len(grams) >= width else grams[:0]
        return least[self.windows], grams

    def alive(self, run: int, repeated: np.ndarray | None) -> np.ndarray:
        """The windows whose anchors of `run` words are among the repeated; all, if nothing has been looked at."""
        if repeated is None:
            return np.ones(len(self.windows), bool)
        own = B.windows(self.hashes, run)[self.windows] if run == self.length else self.anchors(run)[0]
        return np.isin(own, repeated)


def _candidates(chunk: _Chunk, alive: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes at this level, a second hash, and the number of places, 2 at most."""
    if run == chunk.length:
        at = chunk.windows[alive]
        h, g = B.windows(chunk.hashes, run)[at], B.windows(chunk.hashes, run, 4)[at] >> np.uint64(33)
        if not len(h):
            return h, h, h
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
        return h[new], g[new], np.minimum(np.diff(np.r_[new, len(h)]), 2)
    anchors, grams = chunk.anchors(run)
    # a place is an anchor if the largest anchor hash of the windows over it is its own
    width = chunk.length - run + 1
    held = np.zeros(len(grams) + width - 1, np.uint64)
    held[chunk.windows[alive] + width - 1] = anchors[alive]
    places = _slide(held, width, np.maximum) == grams if len(grams) else np.zeros(0, bool)
    h, n = np.unique(grams[places], return_counts=True)
    return h, np.zeros(len(h), np.uint64), np.minimum(n, 2)


def _hashes(table: pa.Table | None) -> np.ndarray | None:
    return None if table is None else np.unique(table.column("h").to_numpy().view(np.uint64))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All rows; the text is replaced by kept (its words that stay, joined by one space), n_words and n_removed."""
    ship_package(docs.sparkSession)
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in (*_MADE, "__chunk")])
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    spread = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    docs = docs.withColumn("__chunk", F.pmod(F.xxhash64(*spread), F.lit(chunks)).cast("int"))
    texts = docs.groupBy("__chunk")
    found = T.StructType().add("__chunk", "integer").add("h", "long").add("g", "long").add("n", "long")
    arrow = pa.schema([("__chunk", pa.int32()), ("h", pa.int64()), ("g", pa.int64()), ("n", pa.int64())])

    def look(run: int, last: int | None):
        def both(key: tuple, left: pa.Table, right: pa.Table | None) -> pa.Table:
            chunk = _Chunk(left.column(text), length)
            h, g, n = _candidates(chunk, chunk.alive(last, _hashes(right)), run)
            return pa.Table.from_arrays([pa.array(np.full(len(h), key[0].as_py(), np.int32)), pa.array(h.astype(np.uint64).view(np.int64)),
                                         pa.array(g.astype(np.uint64).view(np.int64)), pa.array(n.astype(np.int64))], schema=arrow)

        def first(key: tuple, left: pa.Table) -> pa.Table:
            return both(key, left, None)

        return both if last else first

    repeated, last = None, None
    for run in levels(length):
        here = texts.applyInArrow(look(run, last), found) if repeated is None else texts.cogroup(repeated.groupBy("__chunk")).applyInArrow(look(run, last), found)
        places = F.sum("n").over(W.partitionBy("h", "g"))
        repeated, last = here.withColumn("places", places).filter("places > 1").select("__chunk", "h"), run

    passed = [c for c in docs.columns if c not in (text, "__chunk")]
    schema = docs.select(*passed).schema.add("kept", "string").add("n_words", "long").add("n_removed", "long")

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left.column(text), length)
        at = chunk.windows[chunk.alive(length, _hashes(right))]
        edge = np.zeros(len(chunk.hashes) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        kept, removed = [], []
        for k, value in enumerate(left.column(text).to_pylist()):
            mine = gone[chunk.firsts[k] : chunk.firsts[k + 1]]
            own = (value or "").encode().split()
            removed.append(int(mine.sum()))
            kept.append(b" ".join(own if not removed[-1] else [w for w, out in zip(own, mine) if not out]).decode())
        return pa.Table.from_arrays([*[left.column(c) for c in passed], pa.array(kept, pa.string()),
                                     pa.array(np.diff(chunk.firsts), pa.int64()), pa.array(removed, pa.int64())],
                                    names=[*passed, *_MADE])

    return texts.cogroup(repeated.groupBy("__chunk")).applyInArrow(cut, schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
with w as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws from documents),
starts as (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w),
windows as (select doc_id, i, sha256(array_to_string(ws[i : i + 34], ' ')) as h from starts),
gone as (select doc_id, list(distinct k) as ks from (select doc_id, unnest(range(i, i + 35)) as k from windows
         where h in (select h from windows group by h having count(*) > 1)) group by doc_id),
kept as (select w.doc_id, len(ws) as n_words, coalesce(len(ks), 0) as n_removed,
         case when ks is null then ws else list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda p: not list_contains(ks, p[2])), lambda p: p[1]) end as words
         from w left join gone using (doc_id))
select doc_id, n_words::bigint as n_words, n_removed::bigint as n_removed, sha256(array_to_string(words, ' ')) as kept_sha256 from kept
"""
