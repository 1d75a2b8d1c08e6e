"""Operators 1 to 3: quality rules, exact duplicates, mixing."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tejado.llm import exact_dedup, quality_rules, source_mix
from tejado.llm.queries import QUERIES

from .helpers import SF, WORD, documents, labels, odd_table, rows_of


def base(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_op1_statistics_match_brute_force(spark):
    out = {r["doc_id"]: r for r in QUERIES["op1_quality_rules"][0](spark, SF).collect()}
    for r in documents(spark).collect():
        expected = base(r["text"])
        got = out[r["doc_id"]]
        assert tuple(got[c] for c in COLUMNS) == expected
        assert got["base_failed"] == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (got["base_failed"] and got["kept"])


def test_op1_learns_and_prunes(spark):
    """Rows with a high symbol share are bad; a few mislabelled ones don't make rules."""
    rows = [(i, ("ab# " if i % 4 == 0 else "abc ") * (30 + i % 7) + f"w{i}", 0 if (i % 4 == 0) != (i % 97 == 1) else 1) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good int")
    rules = quality_rules.fit(*(lambda d, c: (d.withColumn("bad", 1 - F.col("good")), c))(*quality_rules.with_statistics(df)), "bad", "doc_id")
    assert rules.rules and all(len(r) <= 2 for r in rules.rules)
    out, names = quality_rules.judge(df, rules)
    fired = {r["doc_id"]: r["rule"] for r in out.select("doc_id", names["rule"]).collect()}
    wrong = sum((fired[i] > 0) != (i % 4 == 0) for i, _, _ in rows)
    assert wrong == 0


def test_op1_odd_rows_and_empty_tables(spark):
    odd = odd_table(spark)
    rules = quality_rules.learn(odd, labels(spark).limit(0))
    assert rules.rules == []
    out, names = quality_rules.judge(odd, rules)
    assert names["n_words"] == "n_words_1" and out.count() == odd.count()
    for r in out.collect():
        assert tuple(r[names[c]] for c in COLUMNS) == base(r["text"])
    assert quality_rules.good_documents(odd.limit(0), rules).columns == odd.columns
    assert quality_rules.good_documents(odd.limit(0), rules).count() == 0


@pytest.mark.parametrize("bits", [64, 3])
def test_op2_matches_brute_force(spark, bits):
    """With 3 bits of hash all texts share eight slots: chains and overflow pages."""
    docs = documents(spark).select("doc_id", "text").unionByName(odd_table(spark).select("doc_id", "text"))
    out = exact_dedup.exact_duplicates(docs, key_bits=bits, capacity=20, max_depth=5)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[WORD.pattern and "".join(WORD.findall(r["text"] or ""))].append((-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"]))
    expected = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        first = True
        for m in sorted(members, key=lambda m: (m[0], m[1], m[2] or 0)):
            expected.append((m[2], best[2], len(members), first, digest))
            first = False
    assert rows_of(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(expected, key=repr)


def test_op2_directory_doubles():
    depth, slots, held = exact_dedup.directory({0: 50, 1: 1, 2: 1, 3: 1, 15: 4}, capacity=10, max_depth=4)
    assert depth == 4 and len(slots) == 16 and sum(held.values()) == 57
    assert slots[0] != slots[1] and slots[8] == slots[15] and held[0] == 50
    assert exact_dedup.directory({0: 3, 9: 4}, 10, 4)[0] == 0
    assert exact_dedup.exact_duplicates


def test_op2_empty_table(spark):
    assert exact_dedup.exact_duplicates(documents(spark).limit(0)).count() == 0


def test_op3_budgets_and_limits(spark):
    docs = documents(spark).select("doc_id", "text", "source").unionByName(odd_table(spark).select("doc_id", "text", "source"))
    a = rows_of(source_mix.mix(docs, rows_per_range=7))
    assert a == rows_of(source_mix.mix(docs.repartition(5), rows_per_range=10_000))  # neither ranges nor partitions matter
    by_source = defaultdict(lambda: [0, 0, 0, 0])
    for doc_id, source, size, source_size, target, taken in a:
        s = by_source[source]
        s[0] += size
        s[1] += taken
        s[2], s[3] = source_size, target
        assert 0 <= taken <= 3 * size
    total = sum(s[0] for s in by_source.values())
    assert abs(sum(s[3] for s in by_source.values()) - total) < 1e-6 * total
    for source, (size, taken, source_size, target) in by_source.items():
        assert size == source_size and target <= 3 * size + 1e-9 and abs(taken - target) <= 3  # ties on a key round down


def test_op3_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 1000)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_mix.targets(sizes, (5, 2, 1), 3).collect()}
    assert got["a"] == 30 and got[None] == pytest.approx(2980 * 5 / 8) and got["b"] == pytest.approx(2980 * 2 / 8)
    many = spark.createDataFrame([(f"s{i:02d}", 1 + i * i) for i in range(20)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_mix.targets(many, (5, 2, 1), 3).collect()}
    size = {f"s{i:02d}": 1 + i * i for i in range(20)}
    weight = {f"s{i:02d}": (5, 2, 1)[i % 3] for i in range(20)}
    target, capped = {}, set()
    while True:  # share out, cap, share the excess again
        rest = sum(size.values()) - sum(3 * size[s] for s in capped)
        target = {s: 3 * size[s] if s in capped else rest * weight[s] / sum(weight[t] for t in size if t not in capped) for s in size}
        more = {s for s in size if s not in capped and target[s] > 3 * size[s]}
        if not more:
            break
        capped |= more
    assert got == pytest.approx(target)


def test_op3_documents_stay_whole(spark):
    odd = odd_table(spark)
    out = source_mix.mixed_documents(odd)
    assert out.columns == odd.columns
    known = {r["text"] for r in odd.collect()}
    assert all(r["text"] in known and WORD.search(r["text"]) for r in out.collect())
    assert source_mix.mix(odd.limit(0)).count() == 0 and source_mix.mixed_documents(odd.limit(0)).count() == 0
