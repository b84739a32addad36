"""SentencePiece encoding and decoding with the pieces and scores of a model file.

An Aho-Corasick automaton over the pieces reads a text once; at each position the pieces that end
there, longest first along the output links, relax the best score of the position (unigram
segmentation). Characters without a piece cost the lowest score less 10 and become bytes, or the
unknown piece if the model has no bytes. The scores are taken as the file has them, also from a file
whose own segmentation is by merges: the pieces are the same, the cuts are those of the best sum.

No piece has a blank after another character, so a text is cut before each blank and the parts of up
to 64 characters are kept with their ids in two bounded tables for each task: one fills while the other goes out of use.

Nulls give null ids, "" gives none. Rows are encoded one by one, so repeated rows change nothing; the
output columns replace columns of the same name, other columns stay.
"""

import math
import re
import struct
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.batches import slices
from roadpulse.session import ship_package

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
MOST_MODEL_BYTES = 64 << 20
MOST_KEPT = 200_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the file format


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield key >> 3, message[at : at + size]
            at += size
        else:
            size = varint()
            yield key >> 3, message[at : at + size]
            at += size


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, model: bytes):
        self.pieces, scores, kinds = [], [], []
        dummy, squeeze = True, True
        for number, value in _fields(model):
            if number == 1:
                piece = {1: b"", 2: struct.pack("<f", 0), 3: _NORMAL} | dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0])
                kinds.append(piece[3])
            elif number == 3:
                rules = dict(_fields(value))
                if rules.get(2):
                    raise ValueError("models with normalisation rules are not supported")
                dummy, squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        if _USER in kinds:
            raise ValueError("models with user-defined pieces are not supported")
        self.dummy, self.squeeze = dummy, squeeze
        normal = [k for k, kind in enumerate(kinds) if kind == _NORMAL]
        self.unknown = kinds.index(_UNKNOWN)
        self.unknown_score = min((scores[k] for k in normal), default=0.0) - 10
        self.bytes = {int(self.pieces[k][3:5], 16): k for k, kind in enumerate(kinds) if kind == _BYTE}
        self.bytes = self.bytes if len(self.bytes) == 256 else {}
        self.automaton = ahocorasick.Automaton()
        for k in normal:
            self.automaton.add_word(self.pieces[k], (len(self.pieces[k]), scores[k], k))
        self.automaton.make_automaton()
        longer = "".join(self.pieces[k] for k in normal if len(self.pieces[k]) > 1)
        crossing = any(BLANK in self.pieces[k].lstrip(BLANK) for k in normal)
        line = "" if "\n" in longer else "\n"  # a line end that is in no longer piece stands alone
        self.part = re.compile(r"(?s).+" if crossing else f"{BLANK}+[^{BLANK}{line}]*|[^{BLANK}{line}]+" + ("|\n" if line else ""))
        self.surface = [{_CONTROL: b"", _UNKNOWN: " ⁇ ".encode()}.get(kind, piece.replace(BLANK, " ").encode())
                        for piece, kind in zip(self.pieces, kinds)]
        for byte, k in self.bytes.items():
            self.surface[k] = bytes([byte])
        self.single = {self.pieces[k] for k in normal if len(self.pieces[k]) == 1}
        self.lengths = [len(piece) for piece in self.pieces]
        #: Parts met of late, and those met before them.
        self.kept: dict[str, array] = {}
        self.older: dict[str, array] = {}

    def normal(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return ((BLANK if self.dummy else "") + text.replace(" ", BLANK)) if text else ""

    def best(self, part: str) -> array:
        """The ids of the best segmentation of a part."""
        return self._of_pieces(part) if self.single.issuperset(part) else self._with_unknown(part)

    def _of_pieces(self, part: str) -> array:
        """The same for a part whose characters all are pieces, so that each position is reached by pieces."""
        n = len(part)
        best, piece = [-math.inf] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for last, (length, score, k) in self.automaton.iter(part):
            last += 1
            score += best[last - length]
            if score > best[last]:
                best[last], piece[last] = score, k
        ids, end, lengths = [], n, self.lengths
        while end:
            ids.append(piece[end])
            end -= lengths[piece[end]]
        ids.reverse()
        return array("i", ids)

    def _with_unknown(self, part: str) -> array:
        n, unknown = len(part), self.unknown_score
        best, start, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        alone = bytearray(n)  # characters that are a piece
        best[0] = 0.0
        at = 0  # positions up to here are final

        for last, (length, score, k) in self.automaton.iter(part):
            while at <= last - 1:  # no more pieces end at at + 1
                if not alone[at]:
                    tried = best[at] + unknown
                    if best[at + 1] is None or tried > best[at + 1]:
                        best[at + 1], start[at + 1], piece[at + 1] = tried, at, -1
                at += 1
            first = last + 1 - length
            if length == 1:
                alone[first] = 1
            if (base := best[first]) is not None and (best[last + 1] is None or base + score > best[last + 1]):
                best[last + 1], start[last + 1], piece[last + 1] = base + score, first, k
        for at in range(at, n):
            if not alone[at]:
                tried = best[at] + unknown
                if best[at + 1] is None or tried > best[at + 1]:
                    best[at + 1], start[at + 1], piece[at + 1] = tried, at, -1
        ids, end = [], n
        while end:
            if piece[end] >= 0:
                ids.append(piece[end])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(part[start[end] : end].encode()))
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
            end = start[end]
        return array("i", ids[::-1])

    def encode(self, text: str) -> array:
        out, kept, older = array("i"), self.kept, self.older
        for part in self.part.findall(self.normal(text)):
            ids = kept.get(part)
            if ids is None:
                ids = older.get(part)
                if ids is None:
                    ids = self.best(part)
                if len(part) <= 64:
                    if len(kept) >= MOST_KEPT:  # what is not asked for while a new table fills goes
                        self.kept, self.older = kept, older = {}, kept
                    kept[part] = ids
            if not self.bytes and out and ids and out[-1] == ids[0] == self.unknown:
                ids = ids[1:]  # unknown characters in a row are one piece
            out.extend(ids)
        return out

    def decode(self, ids) -> str:
        surface = self.surface
        text = b"".join([surface[k] for k in ids]).decode(errors="replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


_loaded: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    if hash(model) not in _loaded:
        _loaded.clear()
        _loaded[hash(model)] = Pieces(model)
    return _loaded[hash(model)]


def read_model(spark, path: str = MODEL) -> bytes:
    """The model file, from any file system Spark reads."""
    row = spark.read.format("binaryFile").load(path).select("length", "content").filter(F.col("length") <= MOST_MODEL_BYTES).first()
    if row is None:
        raise ValueError(f"{path} has over {MOST_MODEL_BYTES} bytes")
    return bytes(row.content)


def _coded(df: DataFrame, model: bytes, text: str, ids: str, same: str | None) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)
    ship_package(df.sparkSession)
    passed = [c for c in df.columns if c.lower() not in (ids, same)]
    schema = df.select(*[df[c] for c in passed]).schema.add(ids, T.ArrayType(T.IntegerType()))
    if same:
        schema = schema.add(same, "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in slices(batches, text):
            flat, ends, back = array("i"), [0], []
            column = batch.column(text)
            for value in column.to_pylist():
                own = pieces.encode(value) if value else array("i")
                flat.extend(own)
                ends.append(len(flat))
                if same:
                    back.append(pieces.decode(own) == (value or ""))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()),
                                             mask=column.is_null() if column.null_count else None)
            told = [pa.array(back, pa.bool_())] if same else []
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], lists, *told], names=schema.names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows and columns with the ids of the pieces of the text."""
    return _coded(df, model, text, ids, None)


def encode_and_check(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", same: str = "round_trip") -> DataFrame:
    """The same, and whether decoding gives the text back; a null text is an empty one there. One step does both."""
    return _coded(df, model, text, ids, same)


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows and columns with the text that the ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    ship_package(df.sparkSession)
    passed = [c for c in df.columns if c.lower() != text]
    schema = df.select(*[df[c] for c in passed]).schema.add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            texts = [None if x.values is None else pieces.decode(x.values.to_numpy(zero_copy_only=False).tolist()) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], pa.array(texts, pa.string())], names=[*passed, text])

    return df.mapInArrow(run, schema)


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether decoding gives the text back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode_and_check(docs, read_model(spark))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")
