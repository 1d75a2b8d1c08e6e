"""Operator 2: exact duplicates by an extendible-hash index on shared files, with DataFrame operations only.

Texts are equal when identical after white space is deleted. Every row becomes a small index entry: the 64-bit hash of
the squeezed text, its SHA-256, its length in code points, its id. The directory addresses buckets by the leading bits
of the hash. It doubles until no bucket holds more than ``capacity`` entries; buckets that need fewer bits keep several
slots. A bucket that is still overfull at ``max_depth`` bits (one text with very many copies) gets overflow pages. The
index is written to the shared folder, one directory of files per bucket, and owner tasks work on its buckets: entries
with one hash form a chain, told apart by SHA-256, and the bytes of all texts that share a slot with another are
compared, grouped by the squeezed text itself, so copies meet once per task and not once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.llm.common import squeeze, written
from tejado.session import scratch_path


def slot(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(counts: dict[int, int], capacity: int, max_depth: int) -> tuple[int, list[int], dict[int, int]]:
    """Depth, bucket of each of the 2**depth slots, and entries per bucket.

    ``counts``: entries by their leading ``max_depth`` bits. Starts with one bucket; while one is overfull, the
    directory doubles and the overfull buckets split on one more bit. A bucket is named by its first slot at full depth.
    """
    level = [{}]
    level[0] = dict(counts)
    for _ in range(max_depth):  # level[j]: entries by the leading max_depth - j bits
        half: dict[int, int] = {}
        for s, n in level[-1].items():
            half[s >> 1] = half.get(s >> 1, 0) + n
        level.append(half)
    depth, buckets = 0, [(0, 0)]  # (bits used, leading bits)
    while depth < max_depth and any(bits == depth and level[max_depth - bits].get(s, 0) > capacity for bits, s in buckets):
        buckets = [b for bits, s in buckets for b in
                   ([(bits + 1, 2 * s), (bits + 1, 2 * s + 1)] if bits == depth and level[max_depth - bits].get(s, 0) > capacity else [(bits, s)])]
        depth += 1
    slots, held = [0] * (1 << depth), {}
    for bits, s in buckets:
        first = s << (depth - bits)
        held[first] = level[max_depth - bits].get(s, 0)
        slots[first:first + (1 << (depth - bits))] = [first] * (1 << (depth - bits))
    return depth, slots, held


def build_index(entries: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """Write ``entries`` (with ``key``) as an index on shared files; the result has ``bucket`` too."""
    spark = entries.sparkSession
    counts = {r["s"]: r["n"] for r in entries.groupBy(slot(F.col("key"), max_depth).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}  # 2**max_depth rows at most
    depth, slots, held = directory(counts, capacity, max_depth)
    most_pages = max(1, -(-max(held.values()) // capacity))
    bucket = F.element_at(F.lit(slots), (slot(F.col("key"), depth) + 1).cast("int"))
    pages = F.element_at(F.lit([-(-held.get(b, 0) // capacity) or 1 for b in slots]), (slot(F.col("key"), depth) + 1).cast("int"))
    path = scratch_path(spark, "exact-index")
    paged = entries.withColumn("bucket", bucket).withColumn("page", F.when(pages > 1, F.pmod(F.xxhash64("row"), pages)).otherwise(0).cast("int"))
    (paged.repartition(max(1, min(len(held) * most_pages, 4096)), "bucket", "page").drop("page")
     .write.partitionBy("bucket").parquet(path))
    schema = paged.drop("page").schema
    return spark.read.schema(schema).parquet(path)


def check_bytes(docs: DataFrame, text: str, index: DataFrame, key) -> None:
    """Compare the bytes of all texts whose hash has several entries: a chain link must hold one byte string."""
    shared = written(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "exact-shared")
    texts = docs.select(squeeze(docs[f"`{text}`"]).alias("norm")).withColumn("key", key(F.col("norm")))
    links = texts.join(shared, "key", "left_semi").groupBy("key", "norm").agg(F.lit(1).alias("one"))
    clash = links.groupBy("key", F.sha2("norm", 256).alias("sha")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if clash.limit(1).count():
        raise ValueError("two different texts share a SHA-256")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 100_000, max_depth: int = 12,
                     key_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Of equal texts the row with the most code points in the original text stays, then the smallest id (null ids last),
    then, of rows equal in all that, the first read. A null text counts as empty; all texts without ink are equal. An
    empty table gives an empty result. ``key_bits`` under 64 weakens the hash, so that chains form (for tests).
    """
    def key(norm: Column) -> Column:
        h = F.xxhash64(norm)
        return h if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - key_bits), 64 - key_bits)

    norm = docs.select(F.monotonically_increasing_id().alias("row"), docs[f"`{doc_id}`"].alias("doc_id"),
                       F.coalesce(F.char_length(docs[f"`{text}`"]), F.lit(0)).cast("long").alias("n_chars"), squeeze(docs[f"`{text}`"]).alias("norm"))
    entries = written(norm.select("row", "doc_id", "n_chars", key(F.col("norm")).alias("key"), F.sha2("norm", 256).alias("text_sha256")), "exact-entries")
    if entries.isEmpty():
        return entries.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "n_chars")
    index = build_index(entries, capacity, max_depth)
    check_bytes(docs, text, index, key)
    best = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    # written, so that the join back is dealt anew and a text with very many copies can be split there
    groups = written(index.groupBy("bucket", "key", "text_sha256").agg(best, F.count(F.lit(1)).alias("group_size")), "exact-groups")
    return index.join(groups, ["bucket", "key", "text_sha256"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "n_chars")


SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(length(text), 0) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
w AS (
  SELECT doc_id, n_chars, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
         row_number() OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS place FROM n)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256, CAST(n_chars AS BIGINT) AS n_chars FROM w
"""
