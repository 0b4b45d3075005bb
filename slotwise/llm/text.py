"""Words, hashes and compact integer lists over whole batches of texts, with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64

# Bytes 0x20 and 0x09-0x0D separate words; no byte of a multi-byte character is one of them.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)
_K0, _K1, _K2 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93)
_S29, _S32 = U64(29), U64(32)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, then eight zero bytes; and where each text begins (n + 1)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(offsets[-1] - offsets[0])
    buffer = np.zeros(size + 8, np.uint8)
    if size:
        buffer[:size] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return buffer, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """Parts of a batch whose texts take about ``limit`` bytes; a longer text stands alone."""
    array = batch.column(column).cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    begin = 0
    while begin < len(array):
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), len(array))
        yield batch.slice(begin, end - begin)
        begin = end


def word_spans(buffer: np.ndarray, offsets: np.ndarray, keep: np.ndarray = NOT_SPACE):
    """Begin and end of every word, and the number of words before each text (n + 1)."""
    n = int(offsets[-1])
    inside = keep[buffer[:n]]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[:-1][offsets[:-1] < n]
    begins[cut] = inside[cut]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    begin = np.flatnonzero(begins)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, offsets)


def span_hashes(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes at a time; ``buffer`` ends with eight spare bytes."""
    lanes = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    size = end - begin
    h = (size.astype(U64) + U64(seed)) * _K0
    which, at, left = None, begin, size
    while len(at):
        lane = lanes[at] & _MASK[np.minimum(left, 8)]
        part = ((h if which is None else h[which]) ^ lane) * _K1
        part ^= part >> _S29
        if which is None:
            h = part
        else:
            h[which] = part
        more = np.flatnonzero(left > 8)
        which = more if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    return mixed(h)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> _S32)) * _K2
    h = (h ^ (h >> _S29)) * _K1
    return h ^ (h >> _S32)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed((a * _K0) ^ (b + _K2) * _K1)


def window_hashes(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of every ``length`` consecutive word hashes: sum of w[i+j] * base^(length-1-j).

    Built by doubling: the hash of 2n words is that of the first n times base^n plus that of
    the second n, so a window of 20 takes five passes instead of 20.
    """
    done, size, power = None, 0, base
    part, width = words, 1
    while True:
        if length & width:
            if done is None:
                done, size = part, width
            else:
                n = len(words) - size - width + 1
                if n <= 0:
                    return np.empty(0, U64)
                done = part[:n] * U64(pow(base, size, 1 << 64)) + done[width : width + n]
                size += width
        if size == length:
            return done
        n = len(part) - width
        if n <= 0:
            return np.empty(0, U64)
        part = part[:n] * U64(power) + part[width:]
        power = power * power % (1 << 64)
        width *= 2


def pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32 with their differences split into byte planes.

    Planes of zero bytes all but vanish in Spark's block compression.
    """
    steps = np.diff(values.astype(np.int64), prepend=0).astype(np.uint32)
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32).astype(np.int64)


def pack_ids(values: np.ndarray) -> bytes:
    """64-bit integers, as :func:`pack`."""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_ids(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()
    return np.cumsum(steps, dtype=np.int64)
