"""Counts under hashes, dealt to buckets of hash ranges as packed arrays.

Of a hash the first ``KEPT`` bits count, which is what a pack stores; hashes that agree in them are one key.

Every flush of a task makes at most ``FAN`` packs, whatever the number of buckets. Where there are more buckets than that,
a first shuffle gathers the packs of each of ``FAN`` wide ranges; its tasks read them as a stream and deal them out again
to the narrow ranges. A pack thus holds many numbers at any size of the input, and no task holds more than its flush.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tejado.llm.packs import pack, unpack

KEPT = 40
REST = np.uint64(64 - KEPT)
FAN_BITS = 12
FAN = 1 << FAN_BITS
FLUSH = 2_000_000  # numbers held before a second deal flushes


def bucket_bits(items: float, per_bucket: int = 1_000_000, least: int = 6) -> int:
    """Bits of the hash that number the buckets, so that one holds about ``per_bucket`` items."""
    return min(2 * FAN_BITS, max(least, int(max(items, 1) / per_bucket).bit_length()))


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (their first KEPT bits), ascending, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    keys = keys >> REST << REST
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts[order], starts)


def narrow(a: np.ndarray) -> np.ndarray:
    """The same numbers (none below 0) in the smallest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a


def packs(keys: np.ndarray, counts: np.ndarray, bits: int, group: int) -> Iterator[dict]:
    """Rows (group, bucket, body) for ascending ``keys`` (:func:`counted`); a bucket is the first ``bits`` bits of a key."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    ends = np.flatnonzero(np.diff(bucket)) + 1
    for low, high in zip([0, *ends.tolist()], [*ends.tolist(), len(keys)]):
        if high > low:
            start = np.uint64(bucket[low] << KEPT - bits)
            step = np.diff(keys[low:high] >> REST, prepend=start)
            yield {"group": group, "bucket": int(bucket[low]), "body": pack(start[None], narrow(step), narrow(counts[low:high]))}


ROW = pa.schema([("group", pa.int32()), ("bucket", pa.int64()), ("body", pa.binary())])
KIND = "group int, bucket long, body binary"


def batches_of(rows: Iterator[dict], size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=ROW)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=ROW)


def opened(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of several packs, put end to end."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for body in bodies:
        start, step, n = unpack(body)
        keys.append(start + np.cumsum(step, dtype=np.uint64) << REST)
        counts.append(n.astype(np.int64))
    return np.concatenate(keys), np.concatenate(counts)


def _redeal(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            held: dict[int, list[bytes]] = {}
            n = 0
            for batch in batches:
                for r in batch.to_pylist():
                    held.setdefault(r["group"], []).append(r["body"])
                    n += len(r["body"]) // 4
                    if n >= FLUSH:
                        yield from flush(held)
                        held, n = {}, 0
            yield from flush(held)

        def flush(held: dict[int, list[bytes]]) -> Iterator[dict]:
            for group, bodies in held.items():
                yield from packs(*counted(*opened(bodies)), bits, group)

        return batches_of(rows())

    return deal


def gathered(dealt: DataFrame, bits: int, reduce: Callable[[int, int, np.ndarray, np.ndarray], dict], schema: pa.Schema, kind: str) -> DataFrame:
    """``reduce(group, bucket, distinct keys, summed counts)`` -> columns of arrays, for each group and bucket of ``dealt``.

    ``dealt`` holds packs of at most FAN buckets; where ``bits`` asks for more, they are dealt again first.
    """
    if bits > FAN_BITS:
        dealt = dealt.repartition("group", "bucket").mapInArrow(_redeal(bits), KIND)

    def run(table: pa.Table) -> pa.Table:
        keys, counts = counted(*opened(table.column("body").to_pylist()))
        return pa.table(reduce(table.column("group")[0].as_py(), table.column("bucket")[0].as_py(), keys, counts), schema=schema)

    return dealt.groupBy("group", "bucket").applyInArrow(run, kind)
