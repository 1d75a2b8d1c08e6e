"""Operator 4: line dedup by a log-template tree.

Lines are parsed by a tree of fixed depth: by token count, then by the first ``depth`` tokens, with tokens that hold a
digit read as the variable ``<*>``. In a leaf a token is constant where at least ``min_docs`` lines hold it at its place;
other places are variable fields and become ``<*>`` too. What results is a line's template. A template recurs if at
least ``min_docs`` documents hold it, at least ``min_constants`` of its places are constant and at least ``min_share`` of
them; its lines are dropped from all these documents but the first (smallest id).

Leaves that one document alone visits can't hold a recurring template, so only lines of the others are parsed further. A
bitmap of fixed size tells most of them when the texts are read again; a join then tells exactly. Equal lines of a leaf
are counted first and parsed once, so a line that a third of the documents hold is one row. Tokens, lines and leaves go
by their 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.llm.common import INK, fresh, let, written

FIELD = b"<*>"
DIGIT = re.compile(rb"[0-9]")
BITS, CHUNK = 26, 19  # of the bitmap: 2**26 bits, made and sent in chunks of 2**19


def parsed(text: bytes, depth: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(place, leaf, masked tokens) of every line that has tokens. Bytes split at the six ASCII spaces only."""
    from xxhash import xxh64_intdigest

    digits = DIGIT.search(text) is not None
    for place, line in enumerate(text.split(b"\n")):
        token = line.split()
        if token:
            if digits and DIGIT.search(line):
                token = [FIELD if DIGIT.search(t) else t for t in token]
            yield place, xxh64_intdigest(b"%d %s" % (len(token), b" ".join(token[:depth]))), token


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _shared_leaves(docs: DataFrame, depth: int) -> DataFrame:
    """Leaves that more than one document visits."""
    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, doc = [], []
            for text, d in zip(batch.column("body"), batch.column("doc_hash").to_pylist()):
                own = {x for _, x, _ in parsed(text.as_py(), depth)}
                leaf += own
                doc += [d] * len(own)
            yield pa.RecordBatch.from_arrays([_signed(leaf), pa.array(doc, pa.int64())], names=["leaf", "doc"])

    seen = docs.select("body", F.xxhash64("doc_id").alias("doc_hash")).mapInArrow(visits, "leaf long, doc long")
    return written(seen.groupBy("leaf").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a <> b").select("leaf"), "line-leaves")


def _bitmap(leaves: DataFrame) -> np.ndarray:
    """Bits of the leaves' last BITS bits; 8 MB, whatever the number of leaves."""
    def chunk(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << CHUNK, bool)
        bits[table.column("bit").to_numpy() & (1 << CHUNK) - 1] = True
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "body": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    bit = F.col("leaf").bitwiseAND(F.lit((1 << BITS) - 1))
    rows = leaves.select(bit.alias("bit"), F.shiftright(bit, CHUNK).alias("chunk")).groupBy("chunk").applyInArrow(chunk, "chunk long, body binary").collect()
    out = np.zeros(1 << BITS - 3, np.uint8)
    for r in rows:
        out[r["chunk"] << CHUNK - 3:r["chunk"] + 1 << CHUNK - 3] = np.frombuffer(r["body"], np.uint8)
    return out


def _candidates(docs: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """leaf, line, doc_id, doc_hash, place and tokens of the lines in shared leaves; tokens only once for equal lines of a batch."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(leaves))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        bits = bitmap.value
        for batch in batches:
            row, leaves_, line, place, tokens, known = [], [], [], [], [], set()
            for k, text in enumerate(batch.column("body")):
                for at, leaf, token in parsed(text.as_py(), depth):
                    low = leaf & (1 << BITS) - 1
                    if not bits[low >> 3] >> (low & 7) & 1:
                        continue
                    key = xxh64_intdigest(b" ".join(token))
                    row.append(k)
                    leaves_.append(leaf)
                    line.append(key)
                    place.append(at)
                    tokens.append(None if key in known else np.array([0 if t == FIELD else xxh64_intdigest(t) | 1 for t in token], np.uint64).view(np.int64))
                    known.add(key)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([_signed(leaves_), _signed(line), batch.column("doc_id").take(take), batch.column("doc_hash").take(take), pa.array(place, pa.int32()), pa.array(tokens, pa.list_(pa.int64()))],
                                             names=["leaf", "line", "doc_id", "doc_hash", "place", "tokens"])

    found = docs.mapInArrow(lines, f"leaf long, line long, doc_id {kind}, doc_hash long, place int, tokens array<long>")
    return written(found.join(leaves, "leaf", "left_semi"), "line-candidates")


def _document(doc_id: Column) -> Column:
    """What tells documents apart when they are counted: the id; all null ids count as one document, after the others."""
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"))


def recurring_lines(docs: DataFrame, depth: int = 3, min_docs: int = 3, min_share: float = 0.75, min_constants: int = 3) -> DataFrame:
    """doc_id, doc_hash (XXH64 of the text), places: the lines to drop from each document that loses any. ``docs``: doc_id, text."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("doc_hash"), F.encode("text", "UTF-8").alias("body"))
    lines = _candidates(docs, _shared_leaves(docs, depth), depth)
    distinct = written(lines.groupBy("leaf", "line").agg(F.first("tokens", ignorenulls=True).alias("tokens"), F.count(F.lit(1)).alias("n")), "line-distinct")
    token = distinct.select("leaf", "line", "n", F.posexplode("tokens").alias("at", "token"))
    held = token.groupBy("leaf", "at", "token").agg(F.sum("n").alias("held"))
    field = token.join(held, ["leaf", "at", "token"]).select("leaf", "line", F.struct("at", F.when(F.col("held") >= min_docs, F.col("token")).otherwise(0).alias("token")).alias("place"))
    template = field.groupBy("leaf", "line").agg(F.sort_array(F.collect_list("place"))["token"].alias("template"))  # a line's own tokens
    constants = F.size(F.array_remove("template", 0))
    template = template.where((constants >= min_constants) & (constants >= min_share * F.size("template")))
    template = template.select("leaf", "line", F.xxhash64("leaf", "template").alias("template"))
    placed = written(lines.drop("tokens").join(template, ["leaf", "line"]).select("template", "doc_id", "doc_hash", "place"), "line-placed")
    per_doc = placed.select("template", "doc_id").distinct()
    counts = per_doc.groupBy("template").agg(F.count(F.lit(1)).alias("n_docs"), F.min(_document(F.col("doc_id"))).alias("first")).where(F.col("n_docs") >= min_docs)
    counts = written(counts.select("template", "first"), "line-recurring")  # the join back is dealt anew: a very common template can be split there
    drop = placed.join(counts, "template").where(~F.col("doc_id").eqNullSafe(F.col("first.id")))
    return drop.groupBy("doc_id", "doc_hash").agg(F.collect_set("place").alias("places"))  # a document's own lines


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **tree) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the kept lines as ``text``, plus n_lines and n_dropped; and the names these got.

    A null text stays null and has no lines; an empty text has one empty line. Lines without tokens are always kept.
    Rows that agree in id and text lose the same lines; rows with one id count as one document. Column names that are
    taken get numbers. Empty tables give empty results.
    """
    name = {n: fresh(docs, n) for n in ("n_lines", "n_dropped")}
    thin = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    drop = written(recurring_lines(thin.where(F.col("text").isNotNull()), **tree), "line-drop").toDF("d_id", "d_hash", "d_places")
    lines = F.split(F.col(f"`{text}`"), "\n")
    joined = docs.join(drop, F.col(f"`{doc_id}`").eqNullSafe(F.col("d_id")) & (F.xxhash64(f"`{text}`") == F.col("d_hash")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "d_places")
    rest = let(lines, lambda x: F.array_join(F.transform(kept, lambda i: F.get(x, i)), "\n"))
    rebuilt = F.when(F.col("d_places").isNull(), F.col(f"`{text}`")).otherwise(rest)
    own = [(rebuilt.alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns]
    n_lines = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(lines))
    return joined.select(*own, n_lines.cast("long").alias(name["n_lines"]), F.coalesce(F.size("d_places"), F.lit(0)).cast("long").alias(name["n_dropped"])), name


def without_recurring_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **tree) -> DataFrame:
    """``docs`` with the kept lines as text; documents of which nothing but white space is left are dropped, if lines went."""
    df, name = dedup_lines(docs, doc_id, text, **tree)
    return df.where((F.col(name["n_dropped"]) == 0) | F.col(f"`{text}`").rlike(INK)).select(*[f"`{c}`" for c in docs.columns])


SQL = r"""
WITH line AS (
  SELECT doc_id, r, i - 1 AS place, l[i] AS line FROM (
    SELECT doc_id, row_number() OVER () AS r, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) d, LATERAL (SELECT unnest(generate_series(1, len(l))) AS i)),
tok AS (
  SELECT doc_id, r, place, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS m FROM line),
leaf AS (
  SELECT *, len(m) || ' ' || array_to_string(m[1:3], ' ') AS leaf, array_to_string(m, ' ') AS line_key FROM tok WHERE len(m) > 0),
seen AS (SELECT leaf FROM leaf GROUP BY leaf HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'null')) > 1),
cand AS (SELECT * FROM leaf WHERE leaf IN (SELECT leaf FROM seen)),
dist AS (SELECT leaf, line_key, any_value(m) AS m, count(*) AS n FROM cand GROUP BY leaf, line_key),
token AS (SELECT leaf, line_key, n, unnest(m) AS token, generate_subscripts(m, 1) AS pos FROM dist),
held AS (SELECT leaf, pos, token, sum(n) AS held FROM token GROUP BY leaf, pos, token),
templ AS (
  SELECT leaf, line_key, string_agg(CASE WHEN held >= 3 THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS template,
         count(*) FILTER (WHERE held >= 3 AND token <> '<*>') AS constants, count(*) AS n
  FROM token JOIN held USING (leaf, pos, token) GROUP BY leaf, line_key),
placed AS (
  SELECT doc_id, r, place, leaf || '|' || template AS template FROM cand JOIN templ USING (leaf, line_key) WHERE constants >= 3 AND constants >= 0.75 * n),
counts AS (
  SELECT template, min(doc_id) AS first FROM placed GROUP BY template HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'null')) >= 3),
gone AS (SELECT r, place FROM placed JOIN counts USING (template) WHERE doc_id IS DISTINCT FROM first),
all_lines AS (SELECT l.doc_id, l.r, l.place, l.line, g.r IS NOT NULL AS dropped FROM line l LEFT JOIN gone g USING (r, place))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS text_sha256
FROM all_lines GROUP BY doc_id, r
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
