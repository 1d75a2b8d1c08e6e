"""Operator 1: learned decision lists for text quality, with DataFrame operations only.

Statistics of every text are native expressions over its words. Sequential covering learns from labelled rows: a rule is
a conjunction of thresholds (``statistic <= t`` or ``> t``), grown one threshold at a time by information gain on two
thirds of the labelled rows and pruned from its end on the other third; rows it covers leave, and the next rule is
learned from the rest. Counts for all thresholds of a step come from one aggregate over the binned statistics. The list
becomes one ordered conditional expression, applied as a map over all rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.llm.common import INK, bounded_sample, fresh, let, words, written

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
#: Statistics the rules may test; shares, so that length alone decides nothing. word_spread is the logarithm of the number
#: of distinct words over that of all words, which long texts keep high.
FEATURES = ("symbol_share", "upper_share", "digit_share", "mark_share", "word_spread", "repeat_share", "dup_line_share", "mean_word")


def repeated_words(hashes: Column) -> Column:
    """How many words stand in a window of WINDOW words that the text holds at least twice (the first included).

    ``hashes``: 64-bit hashes of the words. Windows are hashed; only where two agree are (hash, place) pairs sorted, and
    the places of equal neighbours, in order, each add the words up to WINDOW that the place before didn't cover.
    """
    windows = let(hashes, lambda h: F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(h) - WINDOW + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))).otherwise(F.expr("array()").cast("array<bigint>")))

    def count(win: Column) -> Column:
        pairs = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return let(pairs, lambda s: F.aggregate(
            F.sort_array(F.transform(
                F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: (F.get(s, k - 1)["x"].eqNullSafe(F.get(s, k)["x"])) | (F.get(s, k + 1)["x"].eqNullSafe(F.get(s, k)["x"]))),
                lambda k: F.get(s, k)["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["at"])).alias("n"), p.alias("at")),
            lambda acc: acc["n"]))

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(count(w))).cast("long")


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus its statistics; the names they got (numbered where ``docs`` has such a column)."""
    name = {}
    taken = docs
    for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "quality_words", "quality_hashes", "quality_lines", *FEATURES):
        name[n] = fresh(taken, n)
    t = F.coalesce(docs[f"`{text}`"], F.lit(""))
    own = [F.col(f"`{c}`") for c in docs.columns]
    w, h, lines = F.col(name["quality_words"]), F.col(name["quality_hashes"]), F.col(name["quality_lines"])
    df = docs.select("*", words(docs[f"`{text}`"]).alias(name["quality_words"]),
                     F.filter(F.split(t, "\n"), lambda x: x.rlike(INK)).alias(name["quality_lines"]))
    df = df.select(*own, F.size(w).cast("long").alias(name["n_words"]), F.char_length(F.concat_ws("", w)).cast("long").alias(name["word_chars"]),
                   F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias(name["n_symbols"]),
                   (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(name["n_dup_lines"]), F.size(lines).alias(name["quality_lines"]),
                   F.regexp_count(t, F.lit(r"\p{Lu}")).alias(name["upper_share"]), F.regexp_count(t, F.lit("[0-9]")).alias(name["digit_share"]),
                   F.regexp_count(t, F.lit(r"[!?;:|]")).alias(name["mark_share"]),
                   F.transform(w, lambda x: F.xxhash64(x)).alias(name["quality_hashes"]))
    some = lambda c: F.greatest(c, F.lit(1))
    n, chars = F.col(name["n_words"]), F.col(name["word_chars"])
    df = df.select(*own, n, chars, F.col(name["n_symbols"]), F.col(name["n_dup_lines"]), lines,
                   repeated_words(h).alias(name["n_repeat_words"]), F.size(F.array_distinct(h)).alias(name["word_spread"]),
                   *[F.col(name[k]) for k in ("upper_share", "digit_share", "mark_share")])
    df = df.select(*own, *[F.col(name[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                   (F.col(name["n_symbols"]) / some(n)).alias(name["symbol_share"]), (F.col(name["upper_share"]) / some(chars)).alias(name["upper_share"]),
                   (F.col(name["digit_share"]) / some(chars)).alias(name["digit_share"]), (F.col(name["mark_share"]) / some(n)).alias(name["mark_share"]),
                   (F.log1p(F.col(name["word_spread"])) / F.log1p(some(n))).alias(name["word_spread"]), (F.col(name["n_repeat_words"]) / some(n)).alias(name["repeat_share"]),
                   (F.col(name["n_dup_lines"]) / some(lines)).alias(name["dup_line_share"]), (chars / some(n)).alias(name["mean_word"]))
    return df, name


@dataclass(frozen=True)
class Literal:
    feature: int
    bin: int
    above: bool  # statistic > threshold of the bin, else <=

    def on_bins(self) -> Column:
        b = F.element_at("bins", self.feature + 1)
        return b > self.bin if self.above else b <= self.bin


@dataclass
class DecisionList:
    features: tuple[str, ...]
    thresholds: list[list[float]]
    rules: list[list[Literal]]

    def rule_number(self, columns: dict[str, str]) -> Column:
        """1-based number of the first rule that holds, 0 where none does: one ordered conditional expression."""
        out = F
        for k, rule in enumerate(self.rules, 1):
            parts = [(F.col(columns[self.features[x.feature]]) > self.thresholds[x.feature][x.bin]) if x.above
                     else (F.col(columns[self.features[x.feature]]) <= self.thresholds[x.feature][x.bin]) for x in rule]
            out = out.when(all_of(parts), F.lit(k))
        return out.otherwise(0) if self.rules else F.lit(0)

    def __str__(self) -> str:
        return "; ".join(" and ".join(f"{self.features[x.feature]} {'>' if x.above else '<='} {self.thresholds[x.feature][x.bin]:.4g}" for x in r) for r in self.rules)


def all_of(parts: list[Column]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def fit(stats: DataFrame, columns: dict[str, str], bad: str, tie: str, features: tuple[str, ...] = FEATURES, n_bins: int = 64,
        max_rules: int = 12, max_literals: int = 4, min_precision: float = 0.95, min_cover: int = 5) -> DecisionList:
    """Learn rules for ``bad`` = 1 from labelled statistics. ``tie``: a column whose hash splits growing from pruning rows.

    A rule is kept if, on the pruning rows, it covers some and at least ``min_precision`` of them are bad. Ties between
    thresholds go to the first feature and lowest bin. No labelled rows, or none that are bad: an empty list.
    """
    quantiles = [i / n_bins for i in range(1, n_bins)]
    got = stats.agg(*[F.percentile_approx(columns[f], quantiles, 10_000).alias(f) for f in features]).first()
    values = [sorted(set(got[f] or [])) for f in features]
    thresholds = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in values]  # halfway, so that a rule keeps off both sides
    bins = F.array(*[sum(((F.col(columns[f]) > t).cast("int") for t in ts), F.lit(0)) for f, ts in zip(features, thresholds)])
    table = written(stats.select(bins.alias("bins"), F.col(bad).cast("int").alias("bad"), (F.pmod(F.xxhash64(tie, F.lit(5)), F.lit(3)) > 0).alias("grow")), "quality-bins")
    rules: list[list[Literal]] = []
    while len(rules) < max_rules:
        left = table
        for r in rules:
            left = left.where(~all_of([x.on_bins() for x in r]))
        rule = prune(left.where("not grow"), grow(left.where("grow"), thresholds, max_literals, min_cover), min_precision)
        if not rule:
            break
        rules.append(rule)
    return DecisionList(features, thresholds, rules)


def grow(rows: DataFrame, thresholds: list[list[float]], max_literals: int, min_cover: int) -> list[Literal]:
    rule: list[Literal] = []
    while len(rule) < max_literals:
        inside = rows.where(all_of([x.on_bins() for x in rule]))
        counts = inside.select("bad", F.posexplode("bins").alias("f", "b")).groupBy("f", "b").agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).collect()  # features x bins rows
        table: dict[int, dict[int, tuple[int, int]]] = {}
        for r in counts:
            table.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"] - r["p"])
        if not table:
            break
        p0 = sum(p for p, _ in next(iter(table.values())).values())
        n0 = sum(n for _, n in next(iter(table.values())).values())
        if p0 < min_cover or n0 == 0:
            break
        best, choice = 1e-9, None
        for f in sorted(table):
            p = n = 0
            for b in range(len(thresholds[f])):
                more = table[f].get(b, (0, 0))
                p, n = p + more[0], n + more[1]
                for above, q, m in ((False, p, n), (True, p0 - p, n0 - n)):
                    if q >= min_cover and q + m < p0 + n0:
                        gain = q * (math.log2(q / (q + m)) - math.log2(p0 / (p0 + n0)))
                        if gain > best + 1e-9:
                            best, choice = gain, Literal(f, b, above)
        if choice is None:
            break
        rule.append(choice)
    return rule


def prune(rows: DataFrame, rule: list[Literal], min_precision: float) -> list[Literal]:
    """The prefix of ``rule`` with the best (bad - good) / covered on ``rows``; none if its precision is too low."""
    if not rule:
        return []
    sums = []
    for k in range(1, len(rule) + 1):
        hit = all_of([x.on_bins() for x in rule[:k]])
        sums += [F.sum(F.when(hit, F.col("bad"))).alias(f"p{k}"), F.sum(F.when(hit, 1)).alias(f"n{k}")]
    got = rows.agg(*sums).first()
    score = [(got[f"p{k}"] or 0) / got[f"n{k}"] if got[f"n{k}"] else 0.0 for k in range(1, len(rule) + 1)]
    k = max(range(len(rule)), key=lambda i: score[i])
    return rule[:k + 1] if score[k] >= min_precision else []


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = 20_000) -> DecisionList:
    """Decision list from documents with a label (0: bad); a bounded sample of about ``fit_rows`` of them is read.

    Null labels don't count; of several labels of one id the lowest counts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("l_id")).agg(F.min(label).alias("l_good"))
    sample = F.broadcast(bounded_sample(known, F.col("l_id"), fit_rows))  # about fit_rows rows of two numbers
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(sample, F.col("doc_id") == F.col("l_id")).drop("l_id")
    stats, columns = with_statistics(d)
    stats = written(stats.drop("text").withColumn("l_bad", (F.col("l_good") == 0).cast("int")), "quality-stats")
    return fit(stats.where(~base_failed(columns)), columns, "l_bad", "doc_id")


def base_failed(columns: dict[str, str], min_words: int = 20, repeat_percent: int = 30) -> Column:
    n, repeated = F.col(columns["n_words"]), F.col(columns["n_repeat_words"])
    return (n < min_words) | (100 * repeated > repeat_percent * n)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus statistics, base_failed, rule (number of the rule that fired, 0: none) and kept.

    A null or empty text has no words and fails the base. Rows are judged one by one: repeated rows and ids, null ids
    and further columns don't matter; new columns get numbered names where ``docs`` has one of theirs.
    """
    stats, columns = with_statistics(docs, text)
    for n in ("base_failed", "rule", "kept"):
        columns[n] = fresh(stats, n)
    df = stats.withColumn(columns["base_failed"], base_failed(columns)).withColumn(columns["rule"], rules.rule_number(columns))
    return df.withColumn(columns["kept"], ~F.col(columns["base_failed"]) & (F.col(columns["rule"]) == 0)), columns


def good_documents(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns."""
    df, columns = judge(docs, rules, text)
    return df.where(F.col(columns["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])
