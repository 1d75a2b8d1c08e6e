"""Operator 11: collocations mined shard by shard (SON partitioning).

The text is dealt into ``shards`` shards. A phrase found ``min_count`` times in all is found at least
``min_count / shards`` times in one of them, so

1. every shard is mined completely at that lowered support: words and pairs first, then longer phrases, of which only
   those whose first and last part are already frequent in some shard are looked at;
2. the locally frequent phrases are united, as bits of a bitmap of fixed size;
3. all candidates are counted in the whole table, by their text. Phrases that the bitmap lets through by chance or that are
   frequent in a shard only fall short of ``min_count`` here, so the counts are exact.

A shard is a share of the table's partitions, mined by as many tasks; phrases go by 64-bit hashes there, which can only
add candidates. A task counts the phrases of about two million words at a time before it sends anything, so a phrase
that a third of all lines hold is one number per flush.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tejado.llm import buckets
from tejado.llm.common import written
from tejado.llm.packs import by_key, pack, unpack

BREAK = b"\xff"  # stands for a piece's end; no byte of UTF-8
MAP_BITS, CHUNK_BITS = 27, 19  # of the bitmap: 16 MB, made and sent in chunks of 64 kB
WORDS = 2_000_000  # held before a task counts them
SLICE = 4_000_000  # bytes of a text that are split at once
_APART = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_ENDS = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else b for b in bytes(range(256)).lower())  # lower() of bytes changes A-Z alone


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """Lists of the words of ``text`` (split at space and tab), BREAK between pieces; put end to end they are the whole text."""
    low = 0
    while low < len(text):
        end = _APART.search(text, low + SLICE)
        high = end.start() if end else len(text)
        yield text[low:high].translate(_ENDS).replace(BREAK, b" \xff ").split()
        low = high


class Held:
    """The words of one language that a task holds, as numbers; 0 ends a piece."""

    def __init__(self, lang: str):
        self.lang = lang
        self.number: dict[bytes, int] = defaultdict(numbers(0).__next__)
        self.number[BREAK]
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        for words in split_words(text):
            self.runs.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
            self.size += len(words)
        self.runs.append(np.zeros(1, np.int64))

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers in text order, the words by number, and their hashes by number."""
        from xxhash import xxh64_intdigest

        words = list(self.number)
        tag = self.lang.encode() + b"\0"
        hashes = np.array([xxh64_intdigest(tag + w) for w in words], np.uint64)
        return np.concatenate(self.runs), np.array(words, object), hashes


def flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[Held]:
    """The texts of a task, about WORDS words at a time, by language."""
    held: dict[str, Held] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = held.get(lang) or held.setdefault(lang, Held(lang))
            before = own.size
            own.add(text.as_py())
            size += own.size - before
            if size >= WORDS:
                yield from held.values()
                held, size = {}, 0
    yield from held.values()


def longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its words but the last and of the last word."""
    x = prefix * np.uint64(0x9E3779B97F4A7C15) + (word ^ word >> np.uint64(29))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


class Bitmap:
    """Hashes by their first MAP_BITS bits."""

    def __init__(self):
        self.bits = np.zeros(1 << MAP_BITS - 3, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def unite(self, candidates: DataFrame) -> Bitmap:
        """Adds the hashes of ``candidates`` (chunk, body): at most 2 ** (MAP_BITS - CHUNK_BITS) rows of 64 kB reach the driver."""
        def chunk(table: pa.Table) -> pa.Table:
            bits = np.zeros(1 << CHUNK_BITS, bool)
            for body in table.column("body").to_pylist():
                bits[unpack(body)[0]] = True
            return pa.table({"chunk": table.column("chunk").slice(0, 1), "body": pa.array([pack(np.packbits(bits, bitorder="little"))], pa.binary())})

        step = 1 << CHUNK_BITS - 3
        for r in candidates.groupBy("chunk").applyInArrow(chunk, "chunk int, body binary").collect():
            self.bits[r["chunk"] * step:(r["chunk"] + 1) * step] |= unpack(r["body"])[0]
        return self


def _places(ids: np.ndarray, hashes: np.ndarray, longest: int, known: Bitmap | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, hashes) of the phrases of each length that ``known`` leaves; without it, of all words and pairs.

    A place survives for length n if the phrases of length n - 1 at it and at the next place did.
    """
    inside = ids > 0
    hashed = hashes[ids]
    alive, phrase = inside, hashed
    for n in range(1, longest + 1):
        if n > 1:
            both = alive[:-1] & alive[1:]
            phrase = longer(phrase[:-1], hashed[n - 1:])
            alive = both
        if known is not None:
            at = np.flatnonzero(alive)
            passed = known.has(phrase[at])
            alive = np.zeros(len(alive), bool)
            alive[at[passed]] = True
        yield n, alive, phrase


def _mined(texts: DataFrame, length: int, known: Bitmap | None, shards: int, support: int, bits: int) -> DataFrame:
    """(chunk, body): hashes of the phrases of ``length`` words (of 1 and 2, if ``length`` is 2) frequent in some shard."""
    shared = texts.sparkSession.sparkContext.broadcast(known) if known else None
    first = min(bits, buckets.FAN_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards

        def rows() -> Iterator[dict]:
            for held in flushes(batches):
                ids, _, hashes = held.taken()
                got = []
                for n, alive, phrase in _places(ids, hashes, length - 1 if shared else length, shared.value if shared else None):
                    if not shared:
                        got.append(phrase[alive])
                if shared:  # only those whose two parts of one word less have passed
                    both = alive[:-1] & alive[1:]
                    got.append(longer(phrase[:-1], hashes[ids][length - 1:])[both])
                found = np.concatenate(got)
                yield from buckets.packs(*buckets.counted(found, np.ones(len(found), np.int64)), first, shard)

        return buckets.batches_of(rows())

    def frequent(shard: int, bucket: int, keys: np.ndarray, counts: np.ndarray) -> dict:
        at = np.unique((keys[counts >= support] >> np.uint64(64 - MAP_BITS)).astype(np.int64))
        chunk = at >> CHUNK_BITS
        parts = [(int(c), at[chunk == c] & (1 << CHUNK_BITS) - 1) for c in np.unique(chunk)]
        return {"chunk": [c for c, _ in parts], "body": [pack(p.astype(np.int32)) for _, p in parts]}

    schema = pa.schema([("chunk", pa.int32()), ("body", pa.binary())])
    return buckets.gathered(texts.mapInArrow(count, buckets.KIND), bits, frequent, schema, "chunk int, body binary")


TEXT_ROW = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("body", pa.binary())])
TEXT_KIND = "lang string, bucket long, body binary"


def _text_packs(lang: str, phrases: list[bytes], counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Phrases and counts of one language as packs, by the first ``bits`` bits of the phrase's hash. No phrase holds a line feed."""
    from xxhash import xxh64_intdigest

    bucket = np.array([xxh64_intdigest(p) for p in phrases], np.uint64) >> np.uint64(64 - bits)
    rows = [{"lang": lang, "bucket": b, "body": pack(buckets.narrow(counts[at]), np.frombuffer(b"\n".join([phrases[i] for i in at.tolist()]), np.uint8))}
            for b, at in by_key(bucket.astype(np.int64))]
    for low in range(0, len(rows), 256):
        yield pa.RecordBatch.from_pylist(rows[low:low + 256], schema=TEXT_ROW)


def _text_sums(bodies: list[bytes]) -> pa.Table:
    """phrase, f: the phrases of several packs, each once, with the sum of its counts."""
    held = [unpack(b) for b in bodies]
    phrases = pa.chunked_array([pa.array(p.tobytes().split(b"\n"), pa.binary()) for _, p in held])
    f = pa.chunked_array([pa.array(n.astype(np.int64)) for n, _ in held])
    return pa.table({"phrase": phrases, "f": f}).group_by("phrase").aggregate([("f", "sum")]).rename_columns(["phrase", "f"])


def _redealt(bits: int):
    """Packs of wide buckets, dealt again to the narrow ones; holds about WORDS phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            for lang, bodies in held.items():
                sums = _text_sums(bodies)
                yield from _text_packs(lang, sums.column("phrase").to_pylist(), sums.column("f").to_numpy(), bits)
            held.clear()

        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                held.setdefault(r["lang"], []).append(r["body"])
                size += len(r["body"])
                if size >= 8 * WORDS:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _counts(texts: DataFrame, longest: int, known: Bitmap, min_count: int, bits: int) -> DataFrame:
    """lang, n_words, phrase, f: the phrases that ``known`` has and the whole table holds ``min_count`` times; n_words 0 counts all words.

    Tasks send their counts as packs of phrases, which shrink to a few bytes a phrase; the phrases are summed by their text.
    """
    shared = texts.sparkSession.sparkContext.broadcast(known)
    first = min(bits, buckets.FAN_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in flushes(batches):
            ids, words, hashes = held.taken()
            found_texts, found_counts = [pa.array([b""], pa.binary())], [np.array([(ids > 0).sum()], np.int64)]  # all words, as the empty phrase
            number, texts_of = ids, pa.array(words.tolist(), pa.binary())  # of the phrases one word shorter
            word_of = texts_of
            for n, alive, _ in _places(ids, hashes, longest, shared.value):
                at = np.flatnonzero(alive)
                key = number[at] if n == 1 else number[at] << 32 | ids[at + n - 1]
                found, which, f = np.unique(key, return_inverse=True, return_counts=True)
                if n == 1:
                    texts_of = word_of.take(pa.array(found))
                else:
                    texts_of = _joined(texts_of.take(pa.array(found >> 32)), word_of.take(pa.array(found & 0xFFFFFFFF)))
                number = np.zeros(len(alive), np.int64)
                number[at] = which
                found_texts.append(texts_of)
                found_counts.append(f)
            yield from _text_packs(held.lang, pa.chunked_array(found_texts).to_pylist(), np.concatenate(found_counts), first)

    def total(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        sums = _text_sums(table.column("body").to_pylist())
        sums = sums.filter(pc.or_(pc.greater_equal(sums.column("f"), min_count), pc.equal(pc.binary_length(sums.column("phrase")), 0)))
        phrase = sums.column("phrase").combine_chunks().cast(pa.string())
        spaces = pc.count_substring(phrase, " ")
        n_words = pc.if_else(pc.equal(pc.binary_length(phrase), 0), 0, pc.add(spaces, 1)).cast(pa.int32())
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(sums), pa.string()), "n_words": n_words, "phrase": phrase, "f": sums.column("f")})

    dealt = texts.mapInArrow(count, TEXT_KIND)
    if bits > buckets.FAN_BITS:
        dealt = dealt.repartition("lang", "bucket").mapInArrow(_redealt(bits), TEXT_KIND)
    return dealt.groupBy("lang", "bucket").applyInArrow(total, "lang string, n_words int, phrase string, f long")


def _joined(left: pa.Array, right: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(left, right, pa.scalar(b" ", pa.binary()))


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, min_count: int = 10, shards: int = 4) -> DataFrame:
    """lang, n_words, phrase, f: every phrase of 1 to ``longest`` words found ``min_count`` times in its language; n_words 0 counts all words."""
    body = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), body.alias("body"))
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    support = -(-min_count // shards)
    known = Bitmap().unite(_mined(texts, 2, None, shards, support, buckets.bucket_bits(size / 4)))
    for length in range(3, longest + 1):
        known.unite(_mined(texts, length, known, shards, support, buckets.bucket_bits(size / 8)))
    return written(_counts(texts, longest, known, min_count, buckets.bucket_bits(size / 8)), "phrase-counts")


def _slice(words: str, start: str, length: str) -> str:
    return f"array_join(slice({words}, {start}, {length}), ' ')"


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, min_count: int = 10, contained: int = 50, top: int = 2000, shards: int = 4) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` collocations of each language.

    Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at space and tab into words. A
    candidate has 2 to ``longest`` words and a >= ``min_count`` occurrences (all contiguous ones within pieces). It is cut
    where floor(10**6 a a / (l r)) is least (ties: the earliest cut); l and r count the two parts, n all words of the
    language. A candidate that lies inside a longer one with 100 f >= ``contained`` * a is dropped. Order: score, a
    descending, phrase by its UTF-8 bytes.

    A null text counts as empty, a null language as ``und``; other columns are ignored, so names cannot clash. Repeated
    rows count each. An empty table, or one without a candidate, gives no rows. Whole-number arithmetic of up to 38 digits.
    """
    counts = phrase_counts(docs, lang, text, longest, min_count, shards)
    phrases = counts.where("n_words > 0").select("lang", "phrase", "f")
    candidates = counts.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").cast("decimal(18,0)").alias("a"), F.split("phrase", " ").alias("w"))
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.expr(_slice("w", "1", "k")).alias("first"), F.expr(_slice("w", "k + 1", "n_words - k")).alias("rest"))
    part = phrases.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("f").cast("decimal(18,0)").alias("x"))
    cut = cut.join(part, (F.col("lang") == F.col("of")) & (F.col("first") == F.col("part"))).drop("of", "part").withColumnRenamed("x", "l")
    cut = cut.join(part, (F.col("lang") == F.col("of")) & (F.col("rest") == F.col("part"))).drop("of", "part").withColumnRenamed("x", "r")
    cut = cut.withColumn("score", F.expr("(a * a * 1000000BD) div (l * r)"))
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
    inner = candidates.where("n_words > 2").select("lang", "w", "n_words", "a", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size"))
    inner = inner.select("lang", "w", "a", "size", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("start"))
    inner = inner.groupBy(F.col("lang").alias("of"), F.expr(_slice("w", "start", "size")).alias("part")).agg(F.max("a").alias("longer"))
    found = best.join(inner, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")), "left")
    found = found.where(F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("best.a")))
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("best.a").desc(), "phrase")
    first = found.select("lang", "phrase", "best", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)  # cut in every task before the shuffle
    total = counts.where("n_words = 0").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    out = first.join(total, F.col("lang") == F.col("of"))
    longs = [F.col(f"best.{c}").cast("long").alias(c) for c in ("a", "l", "r")]
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *longs, "n", F.col("best.score").cast("long").alias("score"))


SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
spot AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM w WHERE len(w) > 0),
gram AS (SELECT lang, unnest(list_transform(generate_series(1, least(3, len(w) - i + 1)), lambda k: {'k': k, 'p': array_to_string(w[i:i + k - 1], ' ')})) AS g FROM spot),
f AS MATERIALIZED (SELECT lang, g.k AS k, g.p AS p, count(*) AS f FROM gram GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.p, c.a, c.c, x.f AS l, y.f AS r, (1000000 * c.a::HUGEINT * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:c.c], ' ')
  JOIN f y ON y.lang = c.lang AND y.p = array_to_string(c.w[c.c + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
gone AS (
  SELECT DISTINCT s.lang, s.p FROM cand s
  JOIN (SELECT lang, a, w[1:2] AS part FROM cand WHERE k = 3 UNION ALL SELECT lang, a, w[2:3] FROM cand WHERE k = 3) t
  ON t.lang = s.lang AND s.p = array_to_string(t.part, ' ') AND 100 * t.a >= 50 * s.a),
top AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, score
  FROM best ANTI JOIN gone USING (lang, p) QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM top JOIN n USING (lang)
"""
