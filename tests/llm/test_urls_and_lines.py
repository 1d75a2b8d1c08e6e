"""Operators 4 and 5: line dedup, URL filter."""

from tejado.llm import line_templates, url_boost
from tejado.llm.queries import QUERIES

from .helpers import SF, odd_table, rows_of

NOTICE = "Copyright notice of page number {} all rights reserved"


def test_op4_generalises_fields_and_keeps_the_first(spark):
    rows = [(3, NOTICE.format(1) + "\nown a b c"), (4, NOTICE.format(2) + "\nown d e f"), (5, NOTICE.format("last") + "\n\nown g"), (None, NOTICE.format(7)),
            (8, "two docs share\nown h"), (9, "two docs share\nown i"), (10, NOTICE.format(9)), (11, "only here\n" * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out, names = line_templates.dedup_lines(df)
    assert rows_of(out, "doc_id", "text", names["n_dropped"]) == sorted([
        (3, rows[0][1], 0), (4, "own d e f", 1), (5, "\nown g", 1), (None, "", 1), (8, rows[4][1], 0), (9, rows[5][1], 0), (10, "", 1), (11, rows[7][1], 0)], key=repr)
    assert {r["doc_id"] for r in line_templates.without_recurring_lines(df).collect()} == {3, 4, 5, 8, 9, 11}


def test_op4_odd_rows_and_empty_tables(spark):
    odd = odd_table(spark)
    out, names = line_templates.dedup_lines(odd)
    assert names["n_lines"] == "n_lines_1" and out.count() == odd.count()
    assert rows_of(out, "doc_id", "text") == rows_of(odd, "doc_id", "text")
    assert line_templates.without_recurring_lines(odd).columns == odd.columns
    assert line_templates.dedup_lines(odd.limit(0))[0].count() == 0


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, rest = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    ends = [rest.find(c) for c in "?#" if c in rest]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:min(ends)] if ends else rest


def rule(host, path):
    fits = [r for r in url_boost.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


URLS = [None, "", "no scheme", "http://", "HTTP://A.EXAMPLE.COM/en/x?y#z", "http://www.example.com/en/", "http://sub.www.example.com/en/a", "http://com/", "http://xcom/",
        "http://example.com", "http://example.com?q=1", "http://é.net/es/1", "http://net/fr/", "ftp://a.b://c/d", "http://x.org/en/\n1", "http://ÀB.com/EN/", "://x.net/es/", "http://a.net/es"]


def test_op5_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS)] + [(None, URLS[4], "own"), (4, URLS[4], "own")], "page_id long, url string, host string")
    out = url_boost.judge(df, trees=2).collect()
    assert len(out) == len(URLS) + 2
    for r in out:
        host, path = parts(URLS[r["page_id"]] if r["page_id"] is not None else URLS[4])
        found = rule(host, path)
        assert (r["host"], r["host_1"], r["path"]) == ("own", host, path)
        assert r["rule"] == (found and found.text) and (r["verdict"] == found.verdict if found else r["verdict"] in ("allow", "block"))
    assert url_boost.judge(df.limit(0)).count() == 0


def test_op5_query(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = QUERIES["op5_url_filter"][0](spark, SF).collect()
    assert len(out) == len(urls)
    for r in out:
        assert (r["host"], r["path"]) == parts(urls[r["page_id"]])
        assert (r["score"] is None) == (r["rule"] is not None)


def test_op5_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{SF}/../sf0.1/pages.parquet").select("page_id", "url")
    df, name = url_boost.lexical(pages, "url")
    rule_col = url_boost.rule_of(F.col(name["host"]), F.col(name["path"]), url_boost.RULES)
    df = df.withColumn("block", (url_boost.verdict_of(rule_col, url_boost.RULES) == "block").cast("int")).where("block is not null").withColumn("train", F.col("page_id") % 2 == 0)
    train = df.where("train")
    share = F.round((F.sum("block") + 1) / (F.count("block") + 2), 6)
    suffixes, folders = (train.groupBy(name[k]).agg(share) for k in ("url_suffix", "url_folder"))
    full = url_boost.with_statistics(df, name, suffixes, folders)
    score = F.lit(0.0)
    for t in url_boost.boost(full.where("train"), name, "block", trees=6):
        score = score + (t.score(name) if isinstance(t, url_boost.Split) else F.lit(t))
    right = full.where("not train").select(((score > 0).cast("int") == F.col("block")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.97
