"""Secrets in texts: three patterns, and strings that a primed compressor cannot shorten.

Besides the patterns, a candidate is a run of 16 or more token characters near a word that announces a
secret, on either side of it. It is measured by the bytes it adds to the compressed size of the text around
it, with a dictionary of code identifiers. Its novelty is their share of what random strings of the same kinds
of characters add in its place. What is in the dictionary or around it adds little; a random string adds what
other random ones do, be it of letters, digits or both, and is reported as `novel` if it overlaps no pattern.

Offsets are code points, ends are exclusive. A null text is empty. Rows are scanned one by one, so
repeated rows change nothing; columns other than the result's stay.
"""

import itertools
import random
import re
import string as string_kinds
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.batches import slices
from roadpulse.session import ship_package

#: The patterns, in the order of their kinds.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGNED = ("passw", "secret", "token", "apikey", "api_key")

_SENSITIVE_PARTS = ("pass", "secret", "token", "credential", "key", "auth", "bearer", "signature", "salt", "pwd")
_ALPHANUMERIC = frozenset(string_kinds.ascii_letters + string_kinds.digits)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{16,}")
_SENSITIVE = re.compile(r"pass(?:word|wd|phrase)?\b|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|signature|salt\b|pwd", re.I | re.A)
NEAR = 64  # characters in which a sensitive word must stand before or after a candidate
AROUND = 1024  # characters of context on either side
NOVELTY = 0.8  # share of the bytes that random strings add
CONTROLS = 5  # random strings; a candidate is compared with the middle one
PART = 32  # characters measured at once; the coder shortens letters of longer strings by their frequency alone
LEAST_KINDS = 8  # different letters and digits in a candidate

#: What code is made of; a dictionary of raw content has its most likely parts last.
IDENTIFIERS = """abstract argument assert async await boolean break buffer callback catch channel class client column commit config connect const
container context continue controller counter create current database debug default delete description directory document element else encode
endpoint enum environment error event except exception export extends false field file filter final finally float format from function generate
handler hash header height host http https import include index init input instance integer interface internal iterator json lambda length
library list local logger manager message method model module mutable name namespace network null number object offset options output package
parameter parent parse path pattern payload pointer port position prefix private process property protected protocol provider public query
queue range read record reference register release request require resource response result return route schema scope select self send serialize
server service session settings size source start state static status stream string struct suffix super switch system table target task template
test thread throw timeout timestamp title transaction transform true tuple type undefined update upload user username utils validate value
variable vector version void while width window worker write abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789
access_key api_key auth_token bearer client_secret credentials password passwd private_key secret_key token""".split()


class Novelty:
    """Marginal compressed bytes of a string in its context."""

    def __init__(self, identifiers: list[str]):
        # as in constants, in the middle of names, and at their beginning
        written = [w.upper() for w in identifiers] + [w.capitalize() for w in identifiers] + identifiers
        content = " ".join(written).encode()
        draw = random.Random(1)
        # letters as in words, in no order that the dictionary has
        self.filler = " ".join("".join(draw.sample(w, len(w))) for w in identifiers or ["a"] * AROUND)[:AROUND]
        self.dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=6, dict_data=self.dictionary, write_content_size=False)

    def size(self, text: str) -> int:
        return len(self.compressor.compress(text.encode()))

    def of(self, text: str, start: int, end: int) -> float:
        before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        if len(before) + len(after) < AROUND:  # the coder leaves letters of short inputs as they are
            before = self.filler[len(before) + len(after) :] + " " + before
        alone = self.size(before + "\0" + after)  # that the text is cut here is no novelty of the string
        parts = -(-(end - start) // PART)
        cuts = [(end - start) * k // parts for k in range(parts + 1)]

        def added(string: str) -> int:
            return sum(self.size(before + string[a:b] + after) - alone for a, b in itertools.pairwise(cuts))

        own = text[start:end]
        draw = random.Random(own)  # the same controls whenever the string is met
        return added(own) / max(1, sorted(added(control(own, draw)) for _ in range(CONTROLS))[CONTROLS // 2])


def control(string: str, draw: random.Random) -> str:
    """A random string with a letter, capital or digit where the given one has one; one of hexadecimal digits for such a one."""
    letters = string_kinds.ascii_lowercase
    if all(c in string_kinds.hexdigits for c in string if c in string_kinds.ascii_letters):
        letters = letters[:6]
    kinds = (letters, letters.upper(), string_kinds.digits)
    return "".join(next((draw.choice(kind) for kind in kinds if c in kind), c) for c in string)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of the matches of the patterns, in order."""
    spans = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGNED):  # no match without one of them
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty, least: float) -> list[tuple[int, int, int]]:
    spans, lower = [], text.lower()
    if not any(w in lower for w in _SENSITIVE_PARTS):
        return spans
    for found in _CANDIDATE.finditer(text):
        start, end = found.span()
        if len(set(found[0]) & _ALPHANUMERIC) < LEAST_KINDS or any(a < end and start < b for a, _, b in base):
            continue
        # a word counts that ends before the string or begins after it
        if not (_SENSITIVE.search(text, max(0, start - NEAR), start) or _SENSITIVE.search(text, end, end + NEAR)):
            continue
        if novelty.of(text, start, end) >= least:
            spans.append((start, 3, end))
    return spans


def scan(docs: DataFrame, text: str = "text", spans: str = "spans", identifiers: list[str] = IDENTIFIERS, least: float = NOVELTY) -> DataFrame:
    """All rows and columns but the text, with an array of structs of kind, start and end, by start and then kind."""
    ship_package(docs.sparkSession)
    passed = [c for c in docs.columns if c != text and c.lower() != spans]
    span = T.StructType().add("kind", "string").add("start", "integer").add("end", "integer")
    schema = docs.select(*[docs[c] for c in passed]).schema.add(spans, T.ArrayType(span))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(identifiers)
        for batch in slices(batches, text):
            found = []
            for value in batch.column(text).to_pylist():
                value = value or ""
                base = base_spans(value)
                every = sorted(base + novel_spans(value, base, novelty, least))
                found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in every])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], pa.array(found, kind)], names=[*passed, spans])

    return docs.mapInArrow(run, schema)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secret_scans(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), number("novel"))
