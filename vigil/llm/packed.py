"""Totals per 64-bit key over batches, without a row per key.

A batch names its distinct keys in order and one or more values for each. The
key space is cut into `slices` equal ranges; every batch sends each slice one
binary row. A slice merges what it got and answers every batch with the totals
of that batch's keys, in the batch's order. A key is sent at most once by a
batch, so a key that fills a third of the input is as cheap as any other, and
the rows are few and large. The second value travels as its difference from the first:
where both are a key's lowest and highest of something, that is mostly 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from vigil.llm.common import give_back

REQUEST = "slice int, kind int, batch long, keys binary, first binary, second binary"
ANSWER = "batch long, kind int, slice int, first binary, second binary"


def shrink(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def widen(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences, place by place of their bytes: the high ones are mostly 0."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_keys(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64), dtype=np.uint64)


def sized(values: np.ndarray) -> bytes:
    """Packed values that tell their width, so that totals beyond 32 bits keep their value."""
    return bytes([values.itemsize]) + shrink(values)


def unsized(raw: bytes) -> np.ndarray:
    return widen(raw[1:], f"<u{raw[0]}")


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    """The range of each key: monotone, so sorted keys fall into runs."""
    return ((keys >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)


def requests(batch: int, kind: int, keys: np.ndarray, first: np.ndarray, second: np.ndarray, slices: int) -> pa.RecordBatch:
    """One row per slice for sorted distinct keys with two values each."""
    cuts = np.searchsorted(slice_of(keys, slices), np.arange(slices + 1, dtype=np.uint64))
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if b > a]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([kind] * len(rows), pa.int32()), pa.array([batch] * len(rows), pa.int64()),
         pa.array([pack_keys(keys[a:b]) for _, a, b in rows], pa.binary()),
         pa.array([shrink(first[a:b]) for _, a, b in rows], pa.binary()), pa.array([shrink(second[a:b] - first[a:b]) for _, a, b in rows], pa.binary())],
        names=["slice", "kind", "batch", "keys", "first", "second"])


def totals(asked: DataFrame, first: tuple[np.ufunc, type], second: tuple[np.ufunc, type], summary=None, differ: tuple[int, ...] = ()) -> DataFrame:
    """Answers to all requests. `first` and `second` name how values of one key join (np.add, np.minimum, np.maximum) and their type in a request.

    Values join in 64 bits, whatever their type.

    Of the kinds in `differ` an answer says no more than whether a key's two totals differ.

    With `summary`, each slice also gives a row of batch -1 whose `first` holds
    summary(first totals, second totals) as one 64-bit number.
    """
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("batch")
        kind, place = int(group["kind"].iloc[0]), int(group["slice"].iloc[0])
        parts = [unpack_keys(x) for x in group["keys"]]
        keys = np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        slot = np.empty(len(keys), np.int64)
        slot[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
        one = np.concatenate([widen(x, first[1]) for x in group["first"]])
        two = np.concatenate([widen(x, second[1]) for x in group["second"]]) + one
        out = {name: how.reduceat(values[order], starts, dtype=np.uint64) for name, values, (how, _) in (("first", one, first), ("second", two, second))}
        if max(out["first"].max(initial=0), out["second"].max(initial=0)) < 1 << 32 and first[1] is second[1] is np.uint32:
            out = {name: values.astype(np.uint32) for name, values in out.items()}
        ends = np.cumsum([len(p) for p in parts]).tolist()
        away = out["second"] - out["first"]
        spans = list(zip(group["batch"].tolist(), [0, *ends], ends))
        if kind in differ:
            rows = [(b, kind, place, shrink(away[slot[s:e]] != 0), b"") for b, s, e in spans]
        else:
            rows = [(b, kind, place, sized(out["first"][slot[s:e]]), sized(away[slot[s:e]])) for b, s, e in spans]
        if summary is not None:
            rows.append((-1, kind, place, np.int64(summary(out["first"], out["second"])).tobytes(), b""))
        del parts, keys, order, ranked, starts, slot, one, two, out, away
        give_back()
        return pd.DataFrame(rows, columns=["batch", "kind", "slice", "first", "second"])
    return asked.groupBy("kind", "slice").applyInPandas(merge, ANSWER)


def answers(frame: pd.DataFrame, kind: int, types: tuple[type, type]) -> tuple[np.ndarray, np.ndarray]:
    """The totals of one batch's keys of a kind, in key order."""
    frame = frame[frame["kind"] == kind].sort_values("slice")
    first, away = (np.concatenate([np.empty(0, t), *(unsized(x) for x in frame[c])]) for c, t in zip(("first", "second"), types))
    return first, away + first


def differing(frame: pd.DataFrame, kind: int) -> np.ndarray:
    """Whether the two totals of one batch's keys of a kind in `differ` are different, in key order."""
    frame = frame[frame["kind"] == kind].sort_values("slice")
    return np.concatenate([np.empty(0, bool), *(widen(x, bool) for x in frame["first"])])


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed multipliers of a well-known 64-bit finaliser


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))
