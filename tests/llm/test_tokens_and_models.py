"""Operators 7 and 9, the pipeline, and the package's place in the library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from tejado.llm import bpe, line_templates, quality_rules, simhash, source_mix, toxicity
from tejado.llm.queries import QUERIES

from .helpers import SF, WORD, documents, labels, odd_table, rows_of

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_op7_matches_tiktoken(spark):
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    for r in QUERIES["op7_byte_bpe"][0](spark, SF).collect():
        ids = REFERENCE.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_op7_hard_strings():
    encoder, rng = bpe.TextEncoder(RANKS, public_tokenizers.PATTERN, memory=500), random.Random(3)
    bits = ["a", "b", "aa", "中", "é", "\U0001f600", " ", "\n", "the", "1", "%", "’", "'s", "ß", "한", "<|endoftext|>", "\x00", " "]
    for _ in range(2000):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        assert encoder.encode(s).tolist() == REFERENCE.encode_ordinary(s)
    for s in ("a" * 3000, "xyz" * 700, "Ġ" * 99, "=" * 500):
        assert encoder.encode(s).tolist() == REFERENCE.encode_ordinary(s)


def test_op7_appends_and_edits():
    tool, rng = bpe.PrefixEncoder(RANKS), random.Random(4)
    letters = b"thequickbrown etaoin shrdlu\xc3\xa9"
    for _ in range(150):
        data = bytes(rng.choice(letters) for _ in range(rng.randint(1, 200)))
        table = tool.table(data)
        assert tool.tokens(table) == tool.merge(data) and tool.decode(tool.tokens(table)) == data
        longer = tool.append(data, table, b"ing and more")
        assert table == tool.table(longer)
        a, b = sorted((rng.randint(0, len(longer)), rng.randint(0, len(longer))))
        edited, new = tool.edit(longer, table, a, b, bytes(rng.choice(letters) for _ in range(rng.randint(0, 9))))
        assert new == tool.table(edited)


def test_op7_round_trip_and_odd_rows(spark):
    odd = odd_table(spark)
    out = bpe.encode_documents(odd, PATH, public_tokenizers.PATTERN)
    back = bpe.decode_ids(out, PATH)
    assert back.count() == odd.count()
    assert sorted(bytes(r["decoded"]).decode() for r in back.collect()) == sorted(r["text"] or "" for r in odd.collect())
    assert bpe.encode_documents(odd.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def brute_kernel(x, y, decay):
    """Gap-weighted common subsequences of two and three letters, by listing them all."""
    from itertools import combinations

    def weights(w):
        out = {}
        for size in toxicity.SIZES:
            for at in combinations(range(len(w)), size):
                key = tuple(w[i] for i in at)
                out[key] = out.get(key, 0.0) + decay ** (at[-1] - at[0] + 1)
        return out

    a, b = weights(x), weights(y)
    return sum(v * b.get(k, 0.0) for k, v in a.items())


def test_op9_kernel():
    rng = random.Random(7)
    for _ in range(50):
        x, y = ([rng.randint(1, 4) for _ in range(rng.randint(2, 8))] for _ in range(2))
        got = toxicity.subsequence_kernel(np.array([x]), np.array([y + [0, 0]]))[0]
        assert np.isclose(got, brute_kernel(x, y, toxicity.DECAY))


def test_op9_held_out_accuracy(spark):
    sf = f"{SF}/../sf0.1"
    out = QUERIES["op9_toxicity"][0](spark, sf)
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in got.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    pairs = [(got[r["doc_id"]]["score"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    toxic, clean = [s for s, t in pairs if t == 1], [s for s, t in pairs if t == 0]
    area = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert area > 0.94
    assert np.mean([s >= 0.7 for s in toxic]) > 0.7 and np.mean([s >= 0.7 for s in clean]) < 0.01


def test_op9_gaps_odd_rows_and_no_labels(spark):
    docs, known = (spark.read.parquet(f"{SF}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, known)
    plain, spaced, dotted, clean = model.score(["he is an idiot you know", "he is an i d i o t you know", "he is an i.d.i.o.t you know", "he is a nice man you know"])
    assert min(plain, spaced, dotted) > 0.5 > clean
    odd = odd_table(spark)
    out = toxicity.scores(odd, model)
    assert out.count() == odd.count() and "score_1" in out.columns and out.where("score_1 is null or score_1 > 0.5").count() == 0
    none = toxicity.learn(odd, known.limit(0))
    assert toxicity.scores(odd, none).where("score_1 between 0 and 1").count() == odd.count()
    assert toxicity.scores(odd.limit(0), model).count() == 0


def test_pipeline_matches_its_stages_by_brute_force(spark):
    """Each stage on what the one before it kept, against what its operator's own columns say."""
    docs = documents(spark)
    good = corpus_pipeline.keep_good(spark, docs, SF)
    judged, names = quality_rules.judge(docs, quality_rules.learn(docs, labels(spark)))
    assert rows_of(good) == rows_of(judged.where(judged[names["kept"]]), *docs.columns)
    lines = corpus_pipeline.drop_recurring_lines(spark, good, SF)
    assert lines.columns == docs.columns and all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    first = {r["doc_id"]: r["text"] for r in line_templates.without_recurring_lines(good).collect()}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == first
    one = corpus_pipeline.one_of_near_duplicates(spark, lines, SF)
    stay = {r["component_id"] for r in simhash.near_duplicates(lines).collect()}
    assert {r["doc_id"] for r in one.collect()} == stay
    mixed = corpus_pipeline.mix_sources(spark, one, SF)
    taken = {r["doc_id"]: (2 * r["taken"] + r["size"]) // (2 * r["size"]) if r["size"] else 0 for r in source_mix.mix(one).collect()}
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert times == {k: v for k, v in taken.items() if v}
    text = {r["doc_id"]: r["text"] for r in one.collect()}
    last = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(d for d, n in times.items() for _ in range(n))
    for r in last:
        assert r["token_ids"] == REFERENCE.encode_ordinary(text[r["doc_id"]])


def test_pipeline_on_odd_and_empty_tables(spark):
    odd = odd_table(spark).selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) n_chars", "n_words")
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        assert corpus_pipeline.encode(spark, docs, SF).count() == docs.count()


def test_nothing_else_imports_the_package():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("tejado/**/*.py"), *root.glob("tests/*.py"), *root.glob("tools/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert "tejado.llm" not in path.read_text(), path
    assert WORD
