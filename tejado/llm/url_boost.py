"""Operator 5: URL filter by rules and gradient-boosted trees on lexical features, with DataFrame operations only.

URLs that a rule fits are labelled by it. On a bounded sample of them trees are boosted with the logistic loss: features
are cut into bins at quantiles, and each level of a tree is one aggregate that sums gradients and curvatures by node,
feature and bin. Sums are over whole numbers (millionths), so reruns grow the same trees. The ensemble becomes a sum of
nested conditional expressions over the features and judges the URLs without a rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.llm.common import bounded_sample, fresh, let, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNIT = 1_000_000
FEATURES = ("length", "host_length", "depth", "labels", "digit_ratio", "mark_ratio", "entropy", "n_params", "has_fragment",
            "suffix_block", "folder_block")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The contract's rules (fixed values).
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Text of the longest rule whose host is ``host`` or above it and whose path starts ``path``; else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.text)).otherwise(out)
    return out


def verdict_of(rule: Column, rules: tuple[Rule, ...]) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.text, F.lit(r.verdict)).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.char_length(text)

    def term(c: Column) -> Column:
        p = (n - F.char_length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    each = F.transform(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), term)
    return F.round(F.coalesce(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)), 6)


def lexical(pages: DataFrame, url: str) -> tuple[DataFrame, dict[str, str]]:
    """``pages`` plus host, path, the host's suffix, the path's first folder and the features that need no statistics."""
    name, taken = {}, pages
    for n in ("host", "path", "rule", "verdict", "url_suffix", "url_folder", *FEATURES):
        name[n] = fresh(taken, n)
    u = F.coalesce(pages[f"`{url}`"], F.lit(""))
    size = F.greatest(F.char_length(u), F.lit(1))
    df = pages.withColumns({name["host"]: host_of(u), name["path"]: path_of(u)})
    host, path = F.col(name["host"]), F.col(name["path"])
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    return df.withColumns({
        name["url_suffix"]: F.substring_index(host, ".", -2), name["url_folder"]: F.regexp_extract(path, "^/([^/]*)/", 1),
        name["length"]: F.char_length(u).cast("double"), name["host_length"]: F.char_length(host).cast("double"),
        name["depth"]: F.size(F.array_remove(F.split(path, "/"), "")).cast("double"), name["labels"]: F.size(F.split(host, r"\.")).cast("double"),
        name["digit_ratio"]: F.round(F.regexp_count(u, F.lit("[0-9]")) / size, 6), name["mark_ratio"]: F.round(F.regexp_count(u, F.lit("[^A-Za-z0-9]")) / size, 6),
        name["entropy"]: let(u, entropy), name["n_params"]: F.size(F.array_remove(F.split(query, "&"), "")).cast("double"),
        name["has_fragment"]: F.when(F.contains(u, F.lit("#")), 1.0).otherwise(0.0)}), name


def with_statistics(df: DataFrame, name: dict[str, str], suffixes: DataFrame, folders: DataFrame) -> DataFrame:
    """Join the shares of blocked URLs by host suffix and by first folder; without labelled URLs a share is a half."""
    s, f = suffixes.toDF("s_key", "s_block"), folders.toDF("f_key", "f_block")
    df = df.join(s, F.col(name["url_suffix"]) == F.col("s_key"), "left").join(f, F.col(name["url_folder"]) == F.col("f_key"), "left")
    return df.withColumns({name["suffix_block"]: F.coalesce("s_block", F.lit(0.5)), name["folder_block"]: F.coalesce("f_block", F.lit(0.5))}).drop("s_key", "s_block", "f_key", "f_block")


@dataclass
class Split:
    feature: int
    threshold: float
    low: "Split | float"
    high: "Split | float"

    def score(self, columns: dict[str, str]) -> Column:
        side = lambda x: x.score(columns) if isinstance(x, Split) else F.lit(x)
        return F.when(F.col(columns[FEATURES[self.feature]]) <= self.threshold, side(self.low)).otherwise(side(self.high))


def boost(sample: DataFrame, columns: dict[str, str], block: str, trees: int = 10, depth: int = 3, n_bins: int = 32, rate: float = 0.3,
          l2: float = 1.0, least_gain: float = 1e-3) -> list["Split | float"]:
    """Trees of log-odds for ``block`` = 1, both labels weighing the same in all. No rows: no trees, every score is 0."""
    quantiles = [i / n_bins for i in range(1, n_bins)]
    got = sample.agg(F.count(F.lit(1)).alias("n"), F.sum(block).alias("n_block"), *[F.percentile_approx(columns[f], quantiles, 10_000).alias(f) for f in FEATURES]).first()
    if not got["n"]:
        return []
    values = [sorted(set(got[f] or [])) for f in FEATURES]
    cuts = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in values]
    bin_of = [sum(((F.col(columns[f]) > t).cast("int") for t in ts), F.lit(0)) for f, ts in zip(FEATURES, cuts)]
    table = written(sample.select(F.array(*bin_of).alias("bins"), F.col(block).cast("int").alias("y"), F.lit(0.0).alias("margin")), "url-bins")
    weight = F.when(F.col("y") == 1, got["n"] / max(2 * got["n_block"], 1)).otherwise(got["n"] / max(2 * (got["n"] - got["n_block"]), 1))
    out: list[Split | float] = []
    for k in range(trees):
        p = 1 / (1 + F.exp(-F.col("margin")))
        rows = table.select("bins", F.round(weight * (F.col("y") - p) * UNIT).cast("long").alias("g"), F.round(weight * p * (1 - p) * UNIT).cast("long").alias("h"))
        tree = grow(rows, cuts, depth, rate, l2, least_gain)
        out.append(tree)
        table = table.withColumn("margin", F.round(F.col("margin") + on_bins(tree, cuts), 6))
        if k % 4 == 3 and k + 1 < trees:
            table = written(table, "url-margins")
        if not isinstance(tree, Split):
            break
    return out


def on_bins(node: "Split | float", cuts: list[list[float]]) -> Column:
    if not isinstance(node, Split):
        return F.lit(node)
    at = cuts[node.feature].index(node.threshold)
    return F.when(F.element_at("bins", node.feature + 1) <= at, on_bins(node.low, cuts)).otherwise(on_bins(node.high, cuts))


def grow(rows: DataFrame, cuts: list[list[float]], depth: int, rate: float, l2: float, least_gain: float) -> "Split | float":
    """One tree, level by level; nodes are numbered as in a heap from 1."""
    splits: dict[int, tuple[int, int]] = {}
    leaf: dict[int, float] = {}
    open_nodes, node = {1}, F.lit(1)
    for level in range(depth + 1):
        sums = (rows.withColumn("node", node).where(F.col("node").isin(sorted(open_nodes)))
                .select("node", "g", "h", F.posexplode("bins").alias("f", "b")).groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())  # nodes x features x bins rows
        hist: dict[int, dict[int, dict[int, tuple[int, int]]]] = {}
        for r in sums:
            hist.setdefault(r["node"], {}).setdefault(r["f"], {})[r["b"]] = (r["g"], r["h"])
        split_now = {}
        for n in sorted(open_nodes):
            by_feature = hist.get(n, {})
            first = next(iter(by_feature.values()), {})
            g0, h0 = sum(g for g, _ in first.values()), sum(h for _, h in first.values())
            gain_of = lambda g, h: (g / UNIT) ** 2 / (h / UNIT + l2)
            best, choice = least_gain, None
            for f in sorted(by_feature) if level < depth else ():
                g = h = 0
                for b in range(len(cuts[f])):
                    more = by_feature[f].get(b, (0, 0))
                    g, h = g + more[0], h + more[1]
                    gain = gain_of(g, h) + gain_of(g0 - g, h0 - h) - gain_of(g0, h0)
                    if gain > best + 1e-9:
                        best, choice = gain, (f, b)
            if choice is None:
                leaf[n] = round(rate * (g0 / UNIT) / (h0 / UNIT + l2), 6)
            else:
                split_now[n] = choice
        if not split_now:
            break
        splits.update(split_now)
        deeper = F
        for n, (f, b) in split_now.items():
            deeper = deeper.when(node == n, F.when(F.element_at("bins", f + 1) <= b, 2 * n).otherwise(2 * n + 1))
        node = deeper.otherwise(node)
        open_nodes = {c for n in split_now for c in (2 * n, 2 * n + 1)}

    def build(n: int) -> "Split | float":
        if n not in splits:
            return leaf[n]
        f, b = splits[n]
        return Split(f, cuts[f][b], build(2 * n), build(2 * n + 1))

    return build(1)


def judge(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, fit_rows: int = 50_000, trees: int = 10) -> DataFrame:
    """``pages`` without ``url``, plus host, path, rule and verdict (allow or block) and score (log-odds for block; null under a rule).

    A null url, or one without ://, has empty host and path, fits no rule and is judged by the trees. Trees are learned
    from a sample of about ``fit_rows`` URLs that a rule fits, suffix statistics from all. Rows are judged one by one,
    repeated ones alike; new columns get numbered names where ``pages`` has one of theirs. Empty tables: empty results.
    """
    df, name = lexical(pages, url)
    host, path, rule, verdict = (F.col(name[n]) for n in ("host", "path", "rule", "verdict"))
    df = df.withColumn(name["rule"], rule_of(host, path, rules)).withColumn(name["verdict"], verdict_of(rule, rules))
    thin = df.select(name["url_suffix"], name["url_folder"], (verdict == "block").cast("int").alias("block"))
    share = (F.sum("block") + 1) / (F.count("block") + 2)
    suffixes = written(thin.groupBy(name["url_suffix"]).agg(F.round(share, 6)).toDF("s_key", "s_block"), "url-suffixes")
    folders = written(thin.groupBy(name["url_folder"]).agg(F.round(share, 6)).toDF("f_key", "f_block"), "url-folders")
    full = with_statistics(df, name, suffixes, folders)
    labelled = full.where(verdict.isNotNull())
    sample = bounded_sample(labelled, F.col(f"`{url}`"), fit_rows).withColumn("url_block", (verdict == "block").cast("int"))
    score = F.lit(0.0)
    for tree in boost(sample, name, "url_block", trees):
        score = score + (tree.score(name) if isinstance(tree, Split) else F.lit(tree))
    out_score = fresh(full, "score")
    own = [F.col(f"`{c}`") for c in pages.columns if c != url]
    judged = full.withColumn(out_score, F.when(verdict.isNull(), F.round(score, 6)))
    return judged.select(*own, host, path, rule, F.coalesce(verdict, F.when(F.col(out_score) > 0, "block").otherwise("allow")).alias(name["verdict"]), out_score)

