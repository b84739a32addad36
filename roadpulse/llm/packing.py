"""Packing of documents into sequences of a fixed size, shortest pack first over the histogram of lengths.

Each document is cut into pieces of the full size and a rest. The histogram of the pieces' lengths, at
most one entry for each length, is all that the driver sees. It opens as many packs as all tokens fill,
the last tokens in packs of powers of two, and places the lengths longest first, each in the packs with
the most room; packs that are filled alike are one pattern with a count. A length that fits in no pack is
cut there, and its tail goes on as a shorter length. So every pack ends up full and nothing is padded.

Pieces of one length have ranks, from the counts of each task; a pattern takes a range of ranks to a range
of sequences, and a piece finds its range by a binary search. No list of documents meets in one task.

Texts are cut into ids of a byte-level vocabulary file and then get the id 0. Special tokens of the file that
stand in a text get their own ids, as the file's own library does it. A null text is an empty one and
has the id 0 alone. Null and repeated ids and repeated rows are rows like others; a long text is one more
run of pieces. No documents, no rows. Only the id and the text are read of the columns.
"""

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from roadpulse.llm.batches import slices, spread
from roadpulse.llm.pieces import read_model
from roadpulse.session import fresh_dir, ship_package

SIZE, LAST = 1024, 0
#: Fixed value: how byte-level vocabularies split a text before their merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_vocabulary(spark, path: str) -> bytes:
    """The vocabulary file, from the driver's disk or any file system Spark reads."""
    if os.path.exists(path):
        with open(path, "rb") as file:
            return file.read()
    return read_model(spark, path)


class Vocabulary:
    """A byte-level vocabulary whose merges are in the order of its ids."""

    def __init__(self, file: bytes):
        told = json.loads(file)
        splits = told["pre_tokenizer"] or {}
        if told["model"]["type"] != "BPE" or told["normalizer"] or splits.get("type") != "ByteLevel" or splits["add_prefix_space"]:
            raise ValueError("not a plain byte-level vocabulary")
        # bytes that print stand for themselves, the others for the characters from 256 on
        printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in set(printed)]
        byte = {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(other)}
        special = {a["content"]: a["id"] for a in told["added_tokens"]}
        ids = told["model"]["vocab"]
        ranks = {bytes(byte[c] for c in piece): id for piece, id in ids.items() if piece not in special}
        merges = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in told["model"]["merges"]]
        if merges != sorted(merges):
            raise ValueError("the merges are not in the order of their ids")
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.width = np.dtype("<u2" if max([*ids.values(), *special.values()]) < 1 << 16 else "<u4")

    def ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all")


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(file: bytes) -> Vocabulary:
    if hash(file) not in _loaded:
        _loaded.clear()
        _loaded[hash(file)] = Vocabulary(file)
    return _loaded[hash(file)]


class Plan:
    """Where the pieces of each length go. `patterns` are (number of packs, lengths in the pack).

    A slot takes `count` pieces of a length, from rank `first` on, to as many packs from `pack` on, at
    `offset`. It takes the first `takes` tokens of each; the tails are pieces of the length left, from rank
    `tail` on.
    """

    FIELDS = ("length", "first", "count", "pack", "offset", "takes", "tail")

    def __init__(self, histogram: dict[int, int], size: int):
        total = sum(length * count for length, count in histogram.items())
        room: dict[int, list] = {}  # groups of packs by the room they have: count, first pack, capacity, lengths
        self.patterns, slots, packs = [], [], 0
        powers = [1 << k for k in reversed(range(size.bit_length())) if total % size >> k & 1]
        for capacity, count in [(size, total // size), *((p, 1) for p in powers)]:
            if count:
                room[capacity] = [(count, packs, capacity, ())]
                packs += count
        widest = [-r for r in room]
        heapq.heapify(widest)
        left = dict(histogram)
        for length in range(max(left, default=0), 0, -1):
            rank, n = 0, left.pop(length, 0)
            while rank < n:
                r = -widest[0]
                count, pack, capacity, lengths = room[r].pop()
                m, takes = min(count, n - rank), min(length, r)
                if count > m:
                    room[r].append((count - m, pack + m, capacity, lengths))
                if not room[r]:
                    del room[r]
                    heapq.heappop(widest)
                tail = left.get(length - takes, 0)
                slots.append((length, rank, m, pack, capacity - r, takes, tail))
                if takes < length:
                    left[length - takes] = tail + m
                if takes == r:
                    self.patterns.append((m, (*lengths, takes)))
                else:
                    if r - takes not in room:
                        room[r - takes] = []
                        heapq.heappush(widest, takes - r)
                    room[r - takes].append((m, pack, capacity, (*lengths, takes)))
                rank += m
        self.packs = packs
        self.slots = {name: np.array([s[k] for s in slots], np.int64) for k, name in enumerate(self.FIELDS)}
        order = np.lexsort((self.slots["first"], self.slots["length"]))
        self.slots = {name: column[order] for name, column in self.slots.items()}


def _find(slots: dict[str, np.ndarray], lengths: np.ndarray, ranks: np.ndarray) -> list[np.ndarray]:
    """Row, tokens taken, pack and offset of each part of the pieces, in the order of the rows and their tokens."""
    keys = (slots["length"] << 40) + slots["first"]
    rows, found = np.arange(len(lengths)), []
    while len(rows):
        at = np.searchsorted(keys, (lengths << 40) + ranks, "right") - 1
        beyond = ranks - slots["first"][at]
        found.append((rows, slots["takes"][at], slots["pack"][at] + beyond, slots["offset"][at]))
        lengths, ranks = lengths - slots["takes"][at], slots["tail"][at] + beyond
        cut = lengths > 0
        rows, lengths, ranks = rows[cut], lengths[cut], ranks[cut]
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in zip(*found)] or [np.zeros(0, np.int64)] * 4
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


def _cut(docs: DataFrame, file, size: int, id: str, text: str) -> DataFrame:
    """Pieces of at most `size` tokens: id, start, length, tokens of the document, ids, and the rank in its task and length."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.spark_partition_id().alias("task"))
    schema = (rows.select("id", "task").schema.add("start", "long").add("length", "long").add("doc_tokens", "long").add("rank", "long").add("ids", "binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(file.value)
        seen = np.zeros(size + 1, np.int64)
        for batch in slices(batches, "text"):
            runs = []
            for value in batch.column("text").to_pylist():
                runs += [vocabulary.ids(value) if value else (), (LAST,)]
            totals = np.array([len(runs[k]) + 1 for k in range(0, len(runs), 2)], np.int64)
            data = np.concatenate(runs).astype(vocabulary.width).tobytes()
            del runs
            counts = -(-totals // size)
            row = np.repeat(np.arange(len(totals)), counts)
            start = (spread(np.zeros(len(totals), np.int64), counts)) * size
            length = np.minimum(totals[row] - start, size)
            order = np.argsort(length, kind="stable")
            ordered, rank = length[order], np.empty(len(length), np.int64)
            firsts = np.searchsorted(ordered, ordered)
            rank[order] = np.arange(len(ordered)) - firsts + seen[ordered]
            seen += np.bincount(length, minlength=size + 1)
            ends = np.r_[0, np.cumsum(length)] * vocabulary.width.itemsize
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("task").take(at), pa.array(start), pa.array(length), pa.array(totals[row]),
                                              pa.array(rank), ids], names=schema.names)

    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: bytes, size: int = SIZE, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Plan]:
    """The pieces, one row each, and the plan of the packs.

    Columns: `id`, `start` and `length` in the tokens of its document, `doc_tokens`, `ids` as little-endian
    unsigned 32-bit numbers, `sequence_id` and `offset`. At most 2**40 pieces may have one length.
    """
    spark = docs.sparkSession
    ship_package(spark)
    file = spark.sparkContext.broadcast(vocabulary)
    place = fresh_dir(spark, "packing-pieces")
    # the pieces of a task, and so their ranks, hold from here on
    _cut(docs, file, size, id, text).write.option("compression", "zstd").parquet(place)
    pieces = spark.read.parquet(place)
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = dict(map(tuple, counts.groupBy("length").agg(F.sum("n")).collect()))  # at most `size` rows
    plan = Plan(histogram, size)
    slots = spark.sparkContext.broadcast(plan.slots)
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["task", "length"]).select("id", "start", "length", "doc_tokens", (F.col("rank") + F.col("before")).alias("rank"), "ids")
    schema = T.StructType([ranked.schema["id"]])
    for name in ("start", "length", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    schema = schema.add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = _vocabulary(file.value).width
        for batch in slices(batches, "ids"):
            lengths, ranks, starts = (batch.column(c).to_numpy() for c in ("length", "rank", "start"))
            row, takes, packs, offsets = _find(slots.value, lengths, ranks)
            before = np.cumsum(takes) - takes  # tokens of the batch before each part; parts of a piece follow each other
            within = before - (np.cumsum(lengths) - lengths)[row]
            column = batch.column("ids").cast(pa.large_binary())
            _, at, data = column.buffers()
            at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
            wide = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(narrow).astype("<u4").tobytes() if data and len(column) else b""
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(np.r_[before, takes.sum()] * 4), pa.py_buffer(wide)]).cast(pa.binary())
            picked = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(picked), pa.array(starts[row] + within), pa.array(takes), batch.column("doc_tokens").take(picked),
                                              pa.array(packs), pa.array(offsets), ids], names=schema.names)

    return ranked.mapInArrow(run, schema), plan


def op12_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1,024 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces, _ = pack(docs, read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
