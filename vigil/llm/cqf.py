"""Counting quotient filters that keep the whole fingerprint, so their counts are exact.

An n-gram of word ids is packed into two numbers: `high` holds the first
n // 2 ids, `low` the others, `width` bits each. `scramble` permutes the packed
values invertibly (a Feistel network within these bits), which spreads them
evenly. The top bits of a scrambled value are its quotient; what is left, the
remainder, is stored in full. A filter keeps its values in order as a bit per
quotient that occurs, a bit per slot that ends the run of a quotient, the
remainders, and a counter per slot (one byte, longer ones beside). So filters
of the same range merge in order, and every value comes back by `restore`.
"""

from __future__ import annotations

import struct

import numpy as np

from vigil.llm.packed import mixed

ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)  # any four different numbers
_HEAD = "<IB"  # how many values, bits of a quotient


def bits_of(n: int, width: int) -> tuple[int, int]:
    """Bits of `high` and `low` of a packed n-gram."""
    return n // 2 * width, (n - n // 2) * width


def pack(ids: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(high, low) of the n-grams whose i-th ids are ids[i]."""
    half = len(ids) // 2
    out = []
    for part in (ids[:half], ids[half:]):
        value = part[0].astype(np.uint64)
        for x in part[1:]:
            value = (value << np.uint64(width)) | x.astype(np.uint64)
        out.append(value)
    return out[0], out[1]


def unpack(high: np.ndarray, low: np.ndarray, n: int, width: int) -> np.ndarray:
    """Ids (rows of n) of packed n-grams."""
    mask, out = np.uint64((1 << width) - 1), []
    for value, count in ((high, n // 2), (low, n - n // 2)):
        out += [(value >> np.uint64(width * (count - 1 - i))) & mask for i in range(count)]
    return np.stack(out, axis=1).astype(np.int64)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def scramble(high: np.ndarray, low: np.ndarray, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    for i, key in enumerate(ROUNDS):
        if i % 2:
            high = high ^ (mixed(low ^ np.uint64(key)) & _mask(bits[0]))
        else:
            low = low ^ (mixed(high ^ np.uint64(key)) & _mask(bits[1]))
    return high, low


def restore(high: np.ndarray, low: np.ndarray, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    for i, key in reversed(list(enumerate(ROUNDS))):
        if i % 2:
            high = high ^ (mixed(low ^ np.uint64(key)) & _mask(bits[0]))
        else:
            low = low ^ (mixed(high ^ np.uint64(key)) & _mask(bits[1]))
    return high, low


def ordered(high: np.ndarray, low: np.ndarray, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): an order by (high, low), and where each distinct value starts in it."""
    if sum(bits) <= 64:
        whole = (high << np.uint64(bits[1])) | low if bits[1] < 64 else low
        order = np.argsort(whole)
        ranked = whole[order]
        new = ranked[1:] != ranked[:-1]
    else:
        order = np.lexsort((low, high))
        a, b = high[order], low[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(np.concatenate([[True], new])) if len(order) else np.zeros(0, np.int64)


def parts(high: np.ndarray, bits: tuple[int, int], given: int, most: int):
    """Places of the values of a range, dealt out by the bits after the `given` ones so that a part has about `most`; equal values stay together."""
    own = bits[0] - given
    cut = min(max(-(-len(high) // most) - 1, 0).bit_length(), own, 16)
    which = ((high & _mask(own)) >> np.uint64(own - cut)).astype(np.uint16) if cut else np.zeros(len(high), np.uint16)
    for part in range(1 << cut):
        at = np.flatnonzero(which == part)
        if len(at):
            yield at


def length(raw: bytes) -> int:
    """How many values a filter holds."""
    return struct.unpack_from(_HEAD, raw)[0]


def _thin(values: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :(bits + 7) // 8].tobytes()


def _wide(raw: memoryview, m: int, bits: int) -> tuple[np.ndarray, int]:
    size = (bits + 7) // 8
    out = np.zeros((m, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8, m * size).reshape(m, size)
    return out.view("<u8").reshape(m).astype(np.uint64), m * size


def build(high: np.ndarray, low: np.ndarray, counts: np.ndarray, bits: tuple[int, int], given: int) -> bytes:
    """The filter of distinct values in order; the top `given` bits of `high` are known from the range it covers."""
    m, own = len(high), bits[0] - given
    q = min(own, max(m.bit_length() - 1, 0))
    rest = own - q
    high = high & _mask(own)
    quotient = (high >> np.uint64(rest)).astype(np.int64)
    used = np.zeros(1 << q, bool)
    used[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True) if m else np.zeros(0, bool)
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join([struct.pack(_HEAD, m, q), np.packbits(used).tobytes(), np.packbits(ends).tobytes(), _thin(high & _mask(rest), rest), _thin(low, bits[1]),
                     small.tobytes(), counts[small == 255].astype("<u8").tobytes()])


def read(raw: bytes, bits: tuple[int, int], given: int, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high, low, counts) of a filter, in order; `start` holds the given top bits."""
    m, q = struct.unpack_from(_HEAD, raw)
    view, at, own = memoryview(raw), struct.calcsize(_HEAD), bits[0] - given
    size = ((1 << q) + 7) // 8
    used = np.flatnonzero(np.unpackbits(np.frombuffer(view[at:at + size], np.uint8), count=1 << q))
    at += size
    ends = np.unpackbits(np.frombuffer(view[at:at + (m + 7) // 8], np.uint8), count=m)
    at += (m + 7) // 8
    quotient = used[np.cumsum(ends) - ends].astype(np.uint64) if m else np.zeros(0, np.uint64)
    part, size = _wide(view[at:], m, own - q)
    at += size
    low, size = _wide(view[at:], m, bits[1])
    at += size
    counts = np.frombuffer(view[at:at + m], np.uint8).astype(np.uint64)
    counts[counts == 255] = np.frombuffer(view[at + m:], "<u8")
    return (np.uint64(start) << np.uint64(own)) | (quotient << np.uint64(own - q)) | part, low, counts
