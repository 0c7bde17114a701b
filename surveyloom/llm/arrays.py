"""Words, windows and packed integers as numpy arrays, for code inside tasks.

All functions work on UTF-8 bytes. A word is a run of bytes other than 0x20 and 0x09-0x0D. Hashes are of 64 bits and
depend on nothing but the content: polynomial sums over bytes or words, finished by a mixer. Such sums modulo a power of two fail on
long self-similar sequences, so words of more than `LONG_WORD` bytes go through BLAKE2b, and windows of more than `LONG_WINDOW` units
are hashed by doubling, with a mixer after each step. A `lane` gives a second, independent hash.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 17
LONG_WORD = 32
LONG_WINDOW = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    """`n` pseudo-random 64-bit integers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * U64(_BASE))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BYTE_VALUES = seeded(1, 256)
LANE_VALUES = (BYTE_VALUES, seeded(2, 256))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for base in (_BASE, _BASE_INVERSE):
        x = np.full(n, base, U64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(18, (n + 1).bit_length()))


def span_sums(values: Callable[[int, int], np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial sum of each span [start, end); both ascend. `values(lo, hi)` gives the symbols' values."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _BLOCK)))
        lo, hi = int(starts[i]), int(ends[i:j].max())
        power, inverse = powers(hi - lo)
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(values(lo, hi) * power[: hi - lo], out=sums[1:])
        at = starts[i:j] - lo
        out[i:j] = (sums[ends[i:j] - lo] - sums[at]) * inverse[at]
        i = j
    return out


def _doubled(symbols: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of `width` symbols: two runs of a power of two, which overlap, each of two halves."""
    span, runs = 1, symbols
    while 2 * span <= width:
        runs = mix(runs[:-span] * U64(_BASE) + runs[span:] + U64(span))
        span *= 2
    return runs if span == width else mix(runs[: len(symbols) - width + 1] * U64(_BASE) + runs[width - span :] + U64(width))


def _windows(values: Callable[[int, int], np.ndarray], positions: np.ndarray, width: int) -> np.ndarray:
    if width <= LONG_WINDOW:
        return mix(span_sums(values, positions, positions + width))
    out, i = np.empty(len(positions), U64), 0
    while i < len(positions):
        j = max(i + 1, int(np.searchsorted(positions, positions[i] + max(_BLOCK, width))))
        lo, hi = int(positions[i]), int(positions[j - 1]) + width
        out[i:j] = _doubled(mix(values(lo, hi)), width)[positions[i:j] - lo]
        i = j
    return out


def byte_windows(text: np.ndarray, positions: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Hashes of the byte strings of `width` at the ascending positions."""
    return _windows(lambda lo, hi: LANE_VALUES[lane][text[lo:hi]], positions, width)


def word_windows(words: np.ndarray, positions: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of the word sequences of `width` at the ascending positions."""
    return _windows(lambda lo, hi: mix(words[lo:hi] ^ U64(seed)), positions, width)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column one after another, and n + 1 offsets. A null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    text = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return text[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the bounds of its words (n + 1)."""
    if not len(text):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    space = SPACE[text]
    edge = np.zeros(len(text) + 1, bool)  # a document begins or ends here
    edge[offsets] = True
    begins = edge[:-1].copy()
    begins[1:] |= space[:-1]
    begins &= ~space
    stops = edge[1:].copy()
    stops[:-1] |= space[1:]
    stops &= ~space
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, lane: int = 0) -> np.ndarray:
    """A hash of each word, of its A-Z in lower case if asked for."""
    table = LANE_VALUES[lane][LOWER] if lower else LANE_VALUES[lane]
    out = mix(span_sums(lambda lo, hi: table[text[lo:hi]], starts, ends))
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        word = text[starts[i] : ends[i]]
        digest = hashlib.blake2b(np.ascontiguousarray(LOWER[word] if lower else word), digest_size=8, salt=bytes([lane])).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def shingles(words: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each document, ascending.

    A document of fewer words than `width` has its whole sequence as the only one; one without words has none.
    """
    counts = np.diff(bounds)
    starts = np.arange(len(words))
    left = np.repeat(bounds[1:], counts) - starts
    full = np.flatnonzero(left >= width)
    hashes = np.zeros(len(words), U64)
    hashes[full] = word_windows(words, full, width)
    for n in range(1, width):
        short = bounds[:-1][counts == n]
        if len(short):
            hashes[short] = word_windows(words, short, n, seed=n)
    out = []
    for first, n in zip(bounds[:-1].tolist(), counts.tolist()):
        out.append(np.unique(hashes[first : first + (n - width + 1 if n >= width else min(n, 1))]))
    return out


def expand(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """All integers of the intervals [start, stop), in order."""
    sizes = stops - starts
    keep = sizes > 0
    starts, sizes = starts[keep], sizes[keep]
    if not len(starts):
        return np.empty(0, np.int64)
    out = np.ones(int(sizes.sum()), np.int64)
    out[0] = starts[0]
    out[np.cumsum(sizes)[:-1]] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
    return np.cumsum(out)


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals whose starts and stops both ascend. Empty ones drop; touching ones join."""
    keep = stops > starts
    starts, stops = starts[keep], stops[keep]
    if not len(starts):
        return starts, stops
    fresh = np.flatnonzero(starts[1:] > stops[:-1]) + 1
    first = np.concatenate(([0], fresh))
    last = np.concatenate((fresh - 1, [len(stops) - 1]))
    return starts[first], stops[last]


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, the empty high ones left out, compressed."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    used = max(1, (int(values.max()).bit_length() + 7) // 8)
    body = np.ascontiguousarray(planes[:, :used].T).tobytes()
    return len(values).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, U64)
    n = int.from_bytes(blob[:8], "little")
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:]), np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(body)] = body.T
    return out.view("<u8").ravel()


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending unsigned integers by their differences."""
    steps = np.array(values, U64)
    steps[1:] -= values[:-1].astype(U64)
    return pack(steps)


def unpack_ascending(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=U64)


def signed_to_unsigned(values: np.ndarray) -> np.ndarray:
    """64-bit integers as unsigned ones in the same order."""
    return values.astype(np.int64).view(U64) ^ U64(1 << 63)


def unsigned_to_signed(values: np.ndarray) -> np.ndarray:
    return (values ^ U64(1 << 63)).view(np.int64)


_CACHES: list[Callable] = []


def stage_cache(make: Callable) -> Callable:
    """`make` with its last value kept in the worker for later tasks of its stage; a task of another stage drops it."""
    _CACHES.append(functools.lru_cache(1)(make))
    return _CACHES[-1]


def release(kept: Callable | None = None) -> None:
    """Give freed memory back, and what other stages than that of the cache `kept` have left, as Python workers live on."""
    for cache in _CACHES:
        if cache is not kept:
            cache.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def released(task: Callable) -> Callable:
    """A function of batches, for `mapInArrow`, that gives memory back before and after its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from task(batches)
        finally:
            release()

    return run


def parts(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold some `limit` bytes of the text column each, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j
