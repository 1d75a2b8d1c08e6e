"""Operator 3: mixing sources to target weights, with DataFrame operations only.

Every row gets a hash-random key. Within a source the rows stand in key order, cut into ranges of about
``rows_per_range`` rows; sums of word counts per range, added up along the ranges, give the prefix sum at each range's
start, so only the one range that holds a source's budget is sorted row by row. What is left is a *cut* per source:
whole epochs, the key at which the last epoch ends and the words still due there. Applying the cut is a map over the
rows, whatever columns they carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tejado.llm.common import fresh, words, written

#: Keys are the first 15 hexadecimal digits of an MD5: 60 bits.
KEY_BITS = 60


def random_key(doc_id: Column, seed: int) -> Column:
    """A key that depends on the seed and the id alone, so reruns agree; all null ids share one key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``sizes`` (source, source_size, ...; one row per source) plus ``target``.

    Sources in code-point order, null last, take the weights in turn and share the total. A target stops at ``cap``
    times the source's size and the excess goes to the others by weight, until none is above. In order of size per
    weight the capped sources come first, so two running sums give the level that the others share.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    everything, before = Window.partitionBy(), by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    df = sizes.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    df = df.withColumn("level", left / open_weight)
    level = F.max(F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("level"))).over(everything)
    return df.withColumn("target", F.least(F.col("most"), F.coalesce(level * F.col("weight"), F.col("most")))).drop("weight", "most", "level")


def plan(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, rows_per_range: int = 5_000) -> DataFrame:
    """One row per source: source, source_size, target, and the cut (epochs, cut_key, cut_due, cut_size).

    ``sized`` has source, key, size, a row per document. Rows with keys under ``cut_key`` are taken once more than
    ``epochs`` times; those at it share ``cut_due`` words of their ``cut_size``; those above it are taken ``epochs`` times.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    budget = F.round("target").cast("long")
    sources = written(
        targets(sizes, weights, cap)
        .withColumn("n_ranges", F.ceil(F.col("n_docs") / rows_per_range))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size")), "mix-sources")
    at_range = F.floor(F.col("key") / F.lit(2.0 ** KEY_BITS) * F.col("n_ranges"))
    ranged = sized.alias("d").join(sources.select("source", "n_ranges", "rest").alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    ranged = ranged.select("d.source", "key", "size", "rest", at_range.alias("range"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (ranged.groupBy("source", "range", "rest").agg(F.sum("size").alias("block"))
              .withColumn("start", F.coalesce(F.sum("block").over(before), F.lit(0)))
              .where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("block"))))
    blocks = blocks.select(F.col("source").alias("b_source"), F.col("range").alias("b_range"), "start")
    in_cut = (ranged.join(blocks, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("range") == F.col("b_range")))
              .groupBy("source", "rest", "start", "key").agg(F.sum("size").alias("cut_size"))
              .withColumn("end", F.col("start") + F.sum("cut_size").over(Window.partitionBy("source").orderBy("key")))
              .withColumn("due", F.col("rest") - (F.col("end") - F.col("cut_size")))
              .where((F.col("due") >= 0) & (F.col("rest") < F.col("end"))))
    cuts = in_cut.select(F.col("source").alias("c_source"), F.col("key").alias("cut_key"), F.col("due").alias("cut_due"), "cut_size")
    joined = sources.join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left")
    return written(joined.select("source", "source_size", "target", "epochs", "cut_key", "cut_due", "cut_size"), "mix-plan")


def sized_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """doc_id, source, key and size (words of the whole text; null text: 0) of every row."""
    return docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{source}`"].cast("string").alias("source"),
                       random_key(docs[f"`{doc_id}`"], seed).alias("key"), F.size(words(docs[f"`{text}`"])).cast("long").alias("size"))


def apply_plan(rows: DataFrame, cuts: DataFrame, source: str, key: str, size: str) -> DataFrame:
    """``rows`` plus source_size, target and taken (words the mix takes of the row, repeats counted)."""
    names = {n: fresh(rows, n) for n in ("source_size", "target", "taken")}
    r, c = rows.alias("r"), cuts.alias("c")
    k, n, cut = F.col(f"r.{key}"), F.col(f"r.{size}"), F.col("c.cut_key")
    once_more = F.when(k < cut, n).when(k == cut, F.floor(F.col("c.cut_due") * n / F.greatest(F.col("c.cut_size"), F.lit(1)))).otherwise(0)
    return r.join(c, F.col(f"r.{source}").eqNullSafe(F.col("c.source")), "left").select(
        "r.*", F.col("c.source_size").alias(names["source_size"]), F.col("c.target").alias(names["target"]),
        (F.col("c.epochs") * n + once_more).cast("long").alias(names["taken"]))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 0, rows_per_range: int = 5_000,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``.

    A null text has size 0 and is taken 0 times; null sources form one source; an empty table gives an empty result.
    Rows with one key (repeated ids) are cut together: at the cut they share the words due in proportion to their size,
    rounded down. Sizes of a source add up to ``taken`` = its rounded target, but for that rounding.
    """
    sized = written(sized_rows(docs, doc_id, text, source, seed), "mix-sized")
    return apply_plan(sized, plan(sized, weights, cap, rows_per_range), "source", "key", "size").drop("key")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 0,
                    rows_per_range: int = 5_000, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as documents: every row as often as the mix takes it, with the columns of ``docs``.

    Documents stay whole: the one at a source's cut is taken once more if at least half of it is due. Texts without
    words have no share and are left out.
    """
    key, size = fresh(docs, "mix_key"), fresh(docs, "mix_size")
    cuts = plan(written(sized_rows(docs, doc_id, text, source, seed), "mix-sized"), weights, cap, rows_per_range)
    rows = docs.withColumn(key, random_key(docs[f"`{doc_id}`"], seed)).withColumn(size, F.size(words(docs[f"`{text}`"])).cast("long"))
    taken = apply_plan(rows, cuts, source, key, size)
    times = F.when(F.col(size) > 0, F.floor((F.col(taken.columns[-1]) * 2 + F.col(size)) / (F.col(size) * 2))).otherwise(0)
    copies = F.explode(F.array_repeat(F.lit(1), times.cast("int")))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], copies.alias(fresh(taken, "copy"))).select(*[f"`{c}`" for c in docs.columns])


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS BIGINT)]::DOUBLE AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, 3.0::DOUBLE * source_size AS most,
         (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER b, 0.0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level
  FROM s WINDOW b AS (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(most, coalesce(max(CASE WHEN most > level * weight THEN level END) OVER () * weight, most)) AS target FROM l),
e AS (
  SELECT *, CAST(round(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
r AS (
  SELECT d.doc_id, d.source, size, source_size, target, epochs, budget - epochs * source_size AS rest,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key) AS BIGINT) AS upto,
         CAST(sum(size) OVER (PARTITION BY d.source, key) AS BIGINT) AS peers
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + CASE WHEN rest >= upto THEN size WHEN rest <= upto - peers THEN 0
            ELSE ((rest - (upto - peers)) * size) // greatest(peers, 1) END AS BIGINT) AS taken
FROM r
"""
