"""Arrow batches of texts as numpy arrays: slices of bounded size, words and window hashes.

Hashes are polynomials modulo 2**64. They are the same on every machine and in every run.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1_000_000
#: Fixed odd multipliers.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
#: The white space of words: \x20 and \x09-\x0D.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Values that are hashed at once, and the longest run that is not put together from parts.
_CHUNK, _PART = 1 << 18, 1 << 16
_powers: dict[int, np.ndarray] = {}


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the column `text` has about `limit` bytes at most in each piece."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins, with the end as the last; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def powers(kind: int) -> np.ndarray:
    """The powers of a multiplier (kinds 0, 2, 4) for the places in a part of a run."""
    if kind not in _powers:
        steps = np.full(_PART, _BASES[kind // 2], np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int, plus: int = 0) -> np.ndarray:
    """A hash of each values[start:end] (plus a number each); equal runs have equal hashes wherever they stand.

    Works on some runs at a time, and on long ones in parts, so it needs little more memory than its result.
    """
    counts = np.maximum(-(-(ends - starts) // _PART), 1)
    owner, part = np.repeat(np.arange(len(starts)), counts), spread(np.zeros(len(starts), np.int64), counts)
    begin = starts[owner] + part * _PART
    sizes = np.minimum(begin + _PART, ends[owner]) - begin
    sums, table, until = np.zeros(len(begin), np.uint64), powers(kind), np.cumsum(sizes)
    at = 0
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + _CHUNK, "right")))
        size = sizes[at:stop]
        some = size > 0
        if some.any():
            read = values[spread(begin[at:stop], size)].astype(np.uint64) + np.uint64(plus)
            read *= table[spread(np.zeros(len(size), np.int64), size)]
            firsts = (np.cumsum(size) - size)[some]
            sums[at:stop][some] = np.add.reduceat(read, firsts)
        at = stop
    if len(begin) > len(starts):
        step, weights = pow(_BASES[kind // 2], _PART, 1 << 64), [1]
        for _ in range(int(part.max())):
            weights.append(weights[-1] * step % (1 << 64))
        sums = np.add.reduceat(sums * np.array(weights, np.uint64)[part], np.cumsum(counts) - counts)
    return mixed(sums)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of `[^\\x20\\x09-\\x0D]+`, and the first word of each text with the end as the last."""
    dark = np.zeros(len(data) + 2, bool)
    dark[1:-1] = ~_WHITE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(dark[1:-1] & (~dark[:-2] | first[:-1]))
    ends = np.flatnonzero(dark[1:-1] & (~dark[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    return ranges(data, starts, ends, kind, plus=1)


def windows(hashes: np.ndarray, length: int, kind: int = 2) -> np.ndarray:
    """The hash of each run of `length` words; runs over the end of a text are for the caller to leave out."""
    n = max(0, len(hashes) - length + 1)
    out, done = np.zeros(n, np.uint64), 0
    if not n:
        return out
    # sums over 1, 2, 4, ... words, and from them those over the length
    run, size, base = hashes, 1, _BASES[kind // 2]
    while True:
        if length & size:
            out += run[done : done + n] * np.uint64(pow(base, done, 1 << 64))
            done += size
        if done == length:
            return mixed(out)
        run = run[:-size] + run[size:] * np.uint64(pow(base, size, 1 << 64))
        size *= 2


def inside(firsts: np.ndarray, length: int) -> np.ndarray:
    """The starts of windows of `length` words that end in the text they begin in."""
    counts = np.maximum(np.diff(firsts) - length + 1, 0)
    return spread(firsts[:-1], counts)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        columns = [table.column(c).to_numpy() for c in keys]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = np.r_[0, new]
        for a, b in zip(edges[:-1], edges[1:]):
            yield table.slice(int(a), int(b - a))
        held = table.slice(int(edges[-1])).to_batches()
    if held:
        yield pa.Table.from_batches(held)
