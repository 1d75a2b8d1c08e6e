"""Arrays packed into binary values, so that Spark shuffles few rows that hold many numbers each."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """One binary value for one-dimensional arrays. Ascending integers are better stored as steps (see ``steps``)."""
    head, body = [], []
    for a in arrays:
        kind = a.dtype.str.encode()
        head.append(struct.pack("<B", len(kind)) + kind + struct.pack("<q", len(a)))
        body.append(np.ascontiguousarray(a).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<i", len(arrays)) + b"".join(head + body))


def unpack(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    at, kinds = 4, []
    for _ in range(struct.unpack_from("<i", raw)[0]):
        n = raw[at]
        kinds.append((np.dtype(raw[at + 1:at + 1 + n].decode()), struct.unpack_from("<q", raw, at + 1 + n)[0]))
        at += 9 + n
    out = []
    for kind, n in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * kind.itemsize
    return out


def unpack_all(values: list[bytes]) -> list[np.ndarray]:
    """The arrays of several packs of one make, joined."""
    return [np.concatenate(a) for a in zip(*map(unpack, values))]


def steps(a: np.ndarray) -> np.ndarray:
    """Differences, the first from 0; ``np.cumsum`` undoes it."""
    return np.diff(a, prepend=a.dtype.type(0))


def by_key(key: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(value, places) for each value of ``key``, places ascending."""
    order = np.argsort(key, kind="stable")
    cut = np.flatnonzero(np.diff(key[order])) + 1
    return [(int(key[part[0]]), part) for part in np.split(order, cut) if len(part)]


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of ``data`` put end to end."""
    end = np.cumsum(length)
    if not len(end) or not end[-1]:
        return data[:0]
    return data[np.arange(end[-1]) + np.repeat(start - (end - length), length)]
