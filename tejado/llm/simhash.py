"""Operator 6: near-duplicates by SimHash, linked through deletion-variant signatures.

Fingerprints (64 bits) come from the XXH64 of word shingles. To link those that differ in at most ``distance`` bits, a
fingerprint is cut into ``distance // 2 + 1`` segments: of two that differ so little, one segment differs by at most
one bit. Each segment is indexed under all its variants with one bit deleted, so segments one bit apart share a variant;
an equality join of the variants gives the candidates, which are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.llm.common import fresh, written
from tejado.llm.components import connected_components

LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, length: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of a text's words, A-Z lower-cased; too few words: of the whole sequence."""
    from xxhash import xxh64_intdigest

    w = text.encode().lower().split()  # bytes: only A-Z are lowered, only the six ASCII spaces split
    if not w:
        return np.empty(0, np.uint64)
    if len(w) <= length:
        return np.array([xxh64_intdigest(b" ".join(w), 42)], np.uint64)
    shingles = map(b" ".join, zip(*[w[i:] for i in range(length)]))
    return np.fromiter((xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(w) - length + 1)


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """For each array of hashes the 64 bits that are set in over half of them; none: zero.

    Bits are counted eight at a time in the byte lanes of a word, in blocks of at most 255 hashes.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat, n = np.concatenate([hashes[i] for i in full]), sizes[full]
    blocks = -(-n // 255)
    first = np.cumsum(blocks) - blocks
    starts = np.repeat(np.cumsum(n) - n - 255 * first, blocks) + 255 * np.arange(blocks.sum())
    counts = np.empty((len(full), 64), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(bit)) & LANES, starts)
        bytes_ = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts[:, bit::8] = np.add.reduceat(bytes_, first, axis=0)
    bits = (2 * counts > n[:, None]).astype(np.uint64)
    out[full] = (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def with_fingerprints(docs: DataFrame, text: str, length: int, name: str) -> DataFrame:
    """``docs`` plus ``name``: the fingerprint of each row's text, as a signed 64-bit integer (null text: zero)."""
    import pyarrow as pa

    schema = T.StructType([*docs.schema, T.StructField(name, T.LongType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                bits = fingerprints([shingle_hashes(t.as_py() or "", length) for t in part.column(at)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bits.view(np.int64))], names=schema.names)

    return docs.mapInArrow(run, schema)


def _segments(bits: int, parts: int, low: int = 0) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``parts`` segments of about equal width."""
    cuts = [low + bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _variants(fp: Column, spans: list[tuple[int, int]]) -> Column:
    """Array of (segment, deleted bit, rest of the segment) structs of a fingerprint column."""
    return F.array(*[
        F.struct(F.lit(s).cast("byte").alias("segment"), F.lit(bit).cast("byte").alias("bit"),
                 fp.bitwiseAND(F.lit(_signed(((1 << width) - 1 << low) & ~(1 << bit)))).alias("rest"))
        for s, (low, width) in enumerate(spans) for bit in range(low, low + width)])


def links(prints: DataFrame, distance: int = 2, dense: int = 256) -> DataFrame:
    """Pairs (u, v), u < v, of the distinct fingerprints in ``prints`` (column fp) that differ in 1 to ``distance`` bits.

    Variants that more than ``dense`` fingerprints share are indexed once more, under the variants of the other bits: what
    differs there is at most ``distance`` again, so the same cut is exact, and no bucket is compared whole.
    """
    parts = distance // 2 + 1
    spans = _segments(64, parts)
    index = prints.select("fp", F.explode(_variants(F.col("fp"), spans)).alias("k")).select("fp", "k.*")
    keys = ["segment", "bit", "rest"]
    crowded = written(index.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense).drop("n"), "simhash-crowded")
    if crowded.isEmpty():
        sparse, second = index, None
    else:
        sparse = index.join(crowded, keys, "left_anti")
        others = [[x for other, (low, width) in enumerate(spans) if other != s for x in _segments(width, 2, low)] or spans for s in range(parts)]
        deeper = F
        for s in range(parts):
            deeper = deeper.when(F.col("segment") == s, _variants(F.col("fp"), others[s]))
        second = index.join(crowded, keys, "left_semi").select("fp", *keys, F.explode(deeper).alias("d")).select("fp", *keys, "d.segment", "d.bit", "d.rest").toDF("fp", *keys, "segment2", "bit2", "rest2")

    def pairs(df: DataFrame, on: list[str]) -> DataFrame:
        a, b = df.alias("a"), df.alias("b")
        differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
        same = F.col(f"a.{on[0]}") == F.col(f"b.{on[0]}")
        for k in on[1:]:
            same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
        near = (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(differ) <= distance)
        # Spark sizes an exploded index like the prints, 64 times too low, and would broadcast it: always dealt and sorted.
        return a.join(b.hint("merge"), same & near).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))

    out = pairs(sparse, keys)
    if second is not None:
        out = out.unionByName(pairs(second, [*keys, "segment2", "bit2", "rest2"]))
    return out


def classes(rows: DataFrame, distance: int, dense: int) -> DataFrame:
    """``rows`` (doc_id, fp) -> (fp, component_id): the smallest id of all rows whose fingerprints are linked, over any steps."""
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    joined = connected_components(links(prints, distance, dense))
    rooted = prints.join(joined, prints["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, length: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text", dense: int = 256) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    A null or wordless text has fingerprint zero, and all such are one component. Null ids never become a component's id
    unless all of its rows have none (then null). Repeated rows share a fingerprint. Empty tables give empty results.
    """
    d = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    rows = written(with_fingerprints(d, "text", length, "fp").select("doc_id", "fp"), "simhash-rows")
    by_print = classes(rows, distance, dense).select("fp", "component_id")
    return rows.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, length: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text", dense: int = 256) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null ids last), of equal ids the first read."""
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    rows = written(with_fingerprints(docs, text, length, fp).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    thin = rows.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    by_print = classes(thin, distance, dense).select(F.col("fp").alias("fp2"), "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))["row"]
    stay = thin.join(by_print, F.col("fp") == F.col("fp2")).groupBy("root").agg(first.alias("stay")).select("stay")
    return rows.join(stay, rows[row] == F.col("stay"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
