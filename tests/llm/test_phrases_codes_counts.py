"""Operators 11 to 13 against brute force and the library."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tejado.llm import buckets, phrases, token_counts, vector_codes
from tejado.llm.queries import QUERIES

from .helpers import SF, documents, odd_table, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def brute_phrases(rows, longest=3, min_count=10, contained=50, top=2000):
    import re

    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = {}, Counter()
    for lang, text in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    own[tuple(w[i:i + k])] += 1
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= contained * own[p[i:i + k]]:
                        gone.add(p[i:i + k])
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def texts_of(df):
    return [(r["lang"], r["text"]) for r in df.select("lang", "text").collect()]


def test_op11_matches_brute_force(spark):
    docs = documents(spark)
    got = sorted(tuple(r) for r in QUERIES["op11_phrases"][0](spark, SF).select(*COLUMNS).collect())
    assert got and got == brute_phrases(texts_of(docs))
    small = sorted(tuple(r) for r in phrases.collocations(docs.repartition(13), longest=4, min_count=3, contained=80, top=50, shards=2).select(*COLUMNS).collect())
    assert small == brute_phrases(texts_of(docs), 4, 3, 80, 50)


def test_op11_local_support_loses_no_phrase(spark):
    """Phrases spread as thinly as can be over the shards: each partition holds two of the ten."""
    rows = [("en", f"filler{i} alpha beta gamma, end{i}") for i in range(10)] + [(None, "Alpha\tBETA gamma! x")] * 10 + [("und", "alpha beta")] * 2
    docs = spark.createDataFrame(rows, "lang string, text string")
    for parts in (1, 5, 22):
        got = sorted(tuple(r) for r in phrases.collocations(docs.repartition(parts)).select(*COLUMNS).collect())
        assert got == brute_phrases(rows)
        assert ("en", "alpha beta gamma", 10) in {(r[0], r[2], r[3]) for r in got}


def test_op11_ties_long_texts_and_odd_rows(spark, monkeypatch):
    rng = random.Random(5)
    words = ["a", "b", "é", "Ünd", "x.", "y,", "\U0001f600", "z\n", " ", "long" * 30]
    rows = [("l" + str(i % 3), " ".join(rng.choices(words, k=rng.randint(0, 400)))) for i in range(60)]
    monkeypatch.setattr(phrases, "SLICE", 50)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert [w for part in phrases.split_words("a b.c d\te".encode() * 40) for w in part] == [w for part in [(("a b\xffc d\te") * 40)] for w in part.encode("latin-1").replace(b"\xff", b" \xff ").split()]
    got = sorted(tuple(r) for r in phrases.collocations(docs, min_count=2).select(*COLUMNS).collect())
    assert got == brute_phrases(rows, min_count=2)
    odd = odd_table(spark)
    assert sorted(tuple(r) for r in phrases.collocations(odd, min_count=1).select(*COLUMNS).collect()) == brute_phrases(texts_of(odd), min_count=1)
    assert phrases.collocations(odd.limit(0)).count() == 0
    assert phrases.collocations(odd.where("text is null")).count() == 0


def test_op11_products_beyond_64_bits(spark):
    """The score's expression on counts whose products pass 64 bits."""
    a, left, right = 3_000_000_000_001, 4_000_000_000_003, 5_000_000_000_007
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(*[F.col(c).cast("decimal(18,0)").alias(c) for c in "alr"])
    assert row.select(F.expr("(a * a * 1000000BD) div (l * r)")).first()[0] == 10**6 * a * a // (left * right)


def test_buckets_of_two_levels_keep_every_number(spark):
    """More buckets than a flush makes packs of: the second deal changes no count."""
    import pyarrow as pa

    def deal(batches):
        for _ in batches:
            rng = np.random.default_rng(1)
            keys, counts = np.unique(rng.integers(0, 1 << 20, 60_000).astype(np.uint64) << np.uint64(44), return_counts=True)
            yield from buckets.batches_of(buckets.packs(keys, counts, buckets.FAN_BITS, 0))

    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("keys", pa.int64())])
    kind = "bucket long, n long, keys long"

    def reduce(group, bucket, keys, counts):
        assert (keys >> np.uint64(64 - bits) == bucket).all()
        return {"bucket": [bucket], "n": [int(counts.sum())], "keys": [len(keys)]}

    seen = []
    for bits in (buckets.FAN_BITS, buckets.FAN_BITS + 3):
        rows = buckets.gathered(spark.range(0, 4, 1, 4).mapInArrow(deal, buckets.KIND), bits, reduce, schema, kind).collect()
        assert len({r["bucket"] for r in rows}) == len(rows)
        seen.append((sum(r["n"] for r in rows), sum(r["keys"] for r in rows)))
    assert seen[0] == seen[1] and seen[0][0] == 240_000
    assert buckets.bucket_bits(0) == 6 and buckets.bucket_bits(1e15) == 2 * buckets.FAN_BITS


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """Plain distances in Python's integers. ``rows``: (vec_id, vector, label) of finite vectors."""
    from fractions import Fraction

    ints = [(i, [math.floor(Fraction(x) * 4096) for x in v], lab) for i, v, lab in rows]
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0))
    width = -(-len(ints[0][1]) // parts)
    cut = [[(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in ints]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            took = [near(c[p], book)[1] for c in cut]
            for e in range(len(book)):
                mine = [c[p] for c, t in zip(cut, took) if t == e]
                if mine:
                    book[e] = [sum(xs) // len(mine) for xs in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, per_label = [], Counter()
    for (i, _, lab), c in zip(ints, cut):
        got = [near(x, b) for x, b in zip(c, books)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got)))
        per_label[lab] += out[-1][3]
    return sorted(((*r, per_label[r[1]], digest) for r in out), key=repr)


def test_op12_matches_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute_codes([(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()])
    assert rows_of(QUERIES["op12_vector_codes"][0](spark, SF), "vec_id", "label", "code", "error", "label_error", "codebooks_sha256") == want


@pytest.mark.parametrize("length, scale", [(40, 1.0), (13, 1.0), (16, 2.5e4), (24, 1e30), (5, 0.001)])
def test_op12_widths_and_large_numbers(spark, length, scale):
    rng = random.Random(length)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(length)], rng.choice([None, 1, 2])) for i in range(60)]
    rows += [(60 + i, rows[i][1], 3) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>, label int")
    got = rows_of(vector_codes.encode_vectors(df, parts=4, entries=5, rounds=3), "vec_id", "label", "code", "error", "label_error", "codebooks_sha256")
    want = brute_codes(rows, 4, 5, 3)
    if scale < 1e20:
        assert got == want
    else:  # errors don't fit into 64 bits
        assert [(r[0], r[1], r[2], r[5]) for r in got] == [(r[0], r[1], r[2], r[5]) for r in want] and all(r[3] is None for r in got)


def test_op12_elimination_is_exact():
    rng = np.random.default_rng(2)
    for size in (1, 2, 4, 16, 32):
        matrix = vector_codes.sequency_matrix(size)
        assert (matrix @ matrix.T == size * np.eye(size)).all() and (np.diff((matrix[:, 1:] != matrix[:, :-1]).sum(1)) > 0).all()
        parts, entries = rng.integers(-5, 6, (300, size)), rng.integers(-5, 6, (9, size))
        entries[4] = entries[2]
        entry, least = vector_codes.nearest(parts @ matrix.T, entries @ matrix.T)
        plain = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (entry == plain.argmin(1)).all() and (least == size * plain.min(1)).all()


def test_op12_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [1.0, 2.0], "a", "x"), (None, [0.5, 0.25], None, "x"), (1, [nan, 1.0], "a", "x"), (2, [inf, 1.0], "a", "x"), (4, None, "a", "x"), (5, [1.0, None], "a", "x"),
            (6, [1.0], "a", "x"), (6, [-1.0, -0.0], "b", "x"), (6, [-1.0, -0.0], "b", "x"), (7, [], None, "x")]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>, code string, extra string")
    out = vector_codes.encode_vectors(df, label="code", parts=2, entries=2)
    got = {(r["vec_id"], r["code"], r["code_1"] is None) for r in out.collect()}
    assert out.count() == 6 and got == {(3, "a", False), (None, None, False), (6, "a", True), (6, "b", False), (7, None, True)}
    assert vector_codes.encode_vectors(df.limit(0), label="code").count() == 0
    assert vector_codes.encode_vectors(df.where("vector is null"), label="code").count() == 0
    assert vector_codes.encode_vectors(df.where("vec_id = 7"), label="code").select("code_1", "error").first() == ("00" * 8, 0)


def test_op13_matches_the_library(spark):
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    for r in QUERIES["op13_token_counts"][0](spark, SF).collect():
        text = texts[r["doc_id"]] or ""
        want = len(LIBRARY.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), want, want > 1024)


def test_op13_hard_strings():
    counter, rng = token_counts.TokenCounter(token_counts.read_vocabulary(PATH), memory=300), random.Random(3)
    bits = ["a", "b", "aa", "中", "é", "\U0001f600", " ", "\n", "the", "1", "%", "’", "'s", "'", "ß", "한", "<|endoftext|>", "<|endof", "\x00", "\x1c", "\x85", "՘", "౜",
            "Ᲊ", "\U0002ebf0", "٣", "²", "​", "﻿", " ", " "]
    for _ in range(3000):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert counter.count(s) == len(LIBRARY.encode(s, add_special_tokens=False).ids), s
    for s in ("a" * 30_000, "xyz" * 7000, "=" * 5000, "thequickbrown" * 3000, " " * 9000, "<|endoftext|>" * 5, "é" * 9000):
        assert counter.count(s) == len(LIBRARY.encode(s, add_special_tokens=False).ids)
    assert len(counter.counts) <= 300 and len(counter.counts.before) <= 300


def test_op13_every_kind_of_character():
    counter = token_counts.TokenCounter(token_counts.read_vocabulary(PATH))
    for code in [*range(0x3000), *range(0x3000, 0x110000, 61)]:
        if not 0xD800 <= code < 0xE000:
            s = "a{0}1{0}#{0} {0}x".format(chr(code))
            assert counter.count(s) == len(LIBRARY.encode(s, add_special_tokens=False).ids), hex(code)


def test_op13_odd_rows(spark, monkeypatch):
    odd = odd_table(spark).withColumnRenamed("n_words", "n_tokens")
    out = token_counts.count_tokens(odd, PATH, limit=5)
    assert out.columns == [c for c in odd.columns if c != "text"] + ["n_bytes", "n_tokens_1", "over_limit"]
    want = sorted((len((r["text"] or "").encode()), len(LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    got = out.collect()
    assert sorted((r["n_bytes"], r["n_tokens_1"]) for r in got) == want and all(r["over_limit"] == (r["n_tokens_1"] > 5) for r in got)
    assert token_counts.count_tokens(odd.limit(0), PATH).count() == 0
    monkeypatch.setattr(token_counts, "LONG_TEXT", 10)
    counter = token_counts.TokenCounter(token_counts.read_vocabulary(PATH))
    assert counter.count("many words of one text, é") == len(LIBRARY.encode("many words of one text, é", add_special_tokens=False).ids)
    with pytest.raises(ValueError):
        token_counts.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
