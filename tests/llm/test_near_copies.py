"""Operators 6, 8 and 10: SimHash near-dedup, substring dedup, near-duplicate passages; and connected components."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from tejado.llm import components, packs, passage_dedup, simhash, suffix_dedup
from tejado.llm.common import written
from tejado.llm.queries import QUERIES

from .helpers import SF, WORD, documents, odd_table, rows_of


def root_of(parent, i):
    while parent[i] != i:
        i = parent[i]
    return i


def fingerprint(text, length=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    shingles = [" ".join(w[i:i + length]) for i in range(len(w) - length + 1)] if len(w) >= length else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("dense", [256, 1])
def test_op6_matches_brute_force(spark, dense):
    """With ``dense`` 1 every bucket goes by the second index."""
    docs = documents(spark).select("doc_id", "text").unionByName(odd_table(spark).select("doc_id", "text"))
    rows = [(r["doc_id"], fingerprint(r["text"])) for r in docs.collect()]
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 2:
                parent[root_of(parent, i)] = root_of(parent, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = root_of(parent, i)
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    expected = sorted(((d, f"{f:016x}", least[root_of(parent, i)]) for i, (d, f) in enumerate(rows)), key=repr)
    assert rows_of(simhash.near_duplicates(docs, dense=dense)) == expected
    stay = simhash.one_of_each(docs, dense=dense)
    assert stay.columns == docs.columns and stay.count() == len({root_of(parent, i) for i in range(len(rows))})


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_op6_links_at_any_distance(spark, distance):
    rng = random.Random(distance)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for p in list(prints):
        for _ in range(6):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 5)):
                q ^= 1 << b
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    mask = (1 << 64) - 1
    expected = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= distance}
    for dense in (256, 1):
        assert {tuple(r) for r in simhash.links(df, distance, dense).collect()} == expected


@pytest.mark.parametrize("dense", [256, 1])
def test_op6_index_is_dealt_not_broadcast(spark, dense):
    """The index has 64 rows for each print but is sized like the prints: its joins with itself must not go by that size."""
    prints = written(spark.createDataFrame([(x,) for x in (0, 1, 3, 1 << 40, -1)], "fp long"), "prints")
    found = simhash.links(prints, 2, dense)
    joins = set(re.findall(r"(\w+Join) \[segment.*?(Inner|LeftAnti|LeftSemi), (Build\w+)?", found._jdf.queryExecution().executedPlan().toString()))
    assert ("SortMergeJoin", "Inner", "") in joins
    assert {j for j in joins if j[0] != "SortMergeJoin"} <= {("BroadcastHashJoin", "LeftAnti", "BuildRight"), ("BroadcastHashJoin", "LeftSemi", "BuildRight")}  # the crowded keys
    assert set(rows_of(found)) == {(0, 1), (0, 3), (0, 1 << 40), (1, 3), (1, 1 << 40)}


def test_op6_empty_table(spark):
    empty = odd_table(spark).limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).columns == empty.columns


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)] + [(5, 5)]
    parent = list(range(3000))
    for a, b in edges:
        a, b = root_of(parent, a), root_of(parent, b)
        parent[max(a, b)] = min(a, b)
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {x: root_of(parent, x) for x in nodes}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def cut(rows, span):
    """Brute force of operator 8 over (doc_id, text)."""
    order = [(1 << 62 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in order:
        for a in range(len(b) - span + 1):
            first[b[a:a + span]] = min(first.get(b[a:a + span], i), i)
    out = []
    for (i, b), (doc_id, _) in zip(order, rows):
        gone = bytearray(len(b))
        for a in range(len(b) - span + 1):
            if first[b[a:a + span]] < i:
                gone[a:a + span] = b"\1" * span
        runs = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(b)))
        out.append((doc_id, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def kept(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 40_000}, {"hot_least": 2, "hot_share": 0.0, "bucket_bytes": 100_000}])
def test_op8_matches_brute_force(spark, options):
    """One bucket, many buckets, and all shared anchors dealt out window by window."""
    docs = documents(spark).select("doc_id", "text").unionByName(odd_table(spark).where("doc_id is null or doc_id <> 7").select("doc_id", "text"))
    assert kept(suffix_dedup.without_repeats(docs, **options)) == cut([tuple(r) for r in docs.collect()], 50)


def test_op8_dense_repeats(spark):
    rng = random.Random(5)
    rows = []
    for i in range(70):
        t = "".join(rng.choice("ab") for _ in range(rng.randint(0, 300)))
        rows.append((rng.choice([i, i, i // 2, None]), rng.choice([t, t, None, "", "é" * 60 + t[:80], "ab" * 100, "a" * rng.randint(0, 200), t * 3])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for span, gram in ((50, 20), (10, 4), (7, 7)):
        assert kept(suffix_dedup.without_repeats(df, span=span, gram=gram, bucket_bytes=700)) == cut(rows, span)
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


def test_op8_long_texts_in_pieces():
    """A text longer than a task's chunk is cut into overlapping pieces; the factors still cover every window once."""
    rng = random.Random(6)
    text = bytes(rng.choice(b"abc ") for _ in range(5000))
    f = suffix_dedup.Factors(50, 20, 3, 3, np.empty(0, np.uint64), chunk=400)
    seen = [r for r in [*f.add(1, 2, text), *f.flush()] if r[0] < 3]
    starts = sorted(int(s) + k for _, body in seen for s, c in zip(*packs.unpack(body)[4:6]) for k in range(int(c)))
    assert starts == list(range(len(text) - 49))


def test_op8_half_equal_content_hashes_are_not_equal_text(spark):
    """Two texts of one window with one anchor, whose content hashes agree in their upper 32 bits only."""
    rng = np.random.default_rng(7)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    grams = letters[rng.integers(0, 26, 200_000)]
    at = int(np.argmin(suffix_dedup.mix(suffix_dedup.Rolling(grams)(20))))
    texts = letters[rng.integers(0, 26, (250_000, 50))]
    texts[:, 15:35] = grams[at:at + 20]
    size = np.full(len(texts), 50, np.int64)
    anchor, content, doc, _, _ = suffix_dedup.factor_runs(texts.ravel(), np.cumsum(size) - size, size, 50, 20, np.empty(0, np.uint64))
    assert (anchor == anchor[0]).mean() > 0.99
    order = np.argsort(content)
    near = np.flatnonzero((content[order][1:] >> np.uint64(32) == content[order][:-1] >> np.uint64(32)) & (anchor[order][1:] == anchor[order][:-1]))
    assert len(near)
    rows = [(k, texts[doc[order[n + k % 2]]].tobytes().decode()) for n in near for k in (2 * int(n), 2 * int(n) + 1)]
    assert kept(suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == cut(rows, 50)


def test_op8_query(spark):
    out = QUERIES["op8_substring_dedup"][0](spark, SF)
    assert rows_of(out) == cut([tuple(r) for r in documents(spark).select("doc_id", "text").collect()], 50)


def test_op10_compact_windows_are_the_cartesian_trees():
    rng = np.random.default_rng(1)
    for _ in range(200):
        count, least = rng.integers(0, 40, int(rng.integers(1, 6))), int(rng.integers(1, 12))
        v = rng.integers(0, 25, int(count.sum())).astype(np.uint64)
        expected, begin = set(), 0
        for t, n in enumerate(count.tolist()):
            for i in range(begin, begin + n):
                a = b = i
                while a > begin and v[a - 1] > v[i]:
                    a -= 1
                while b < begin + n - 1 and v[b + 1] >= v[i]:
                    b += 1
                if b - a + 1 >= least:
                    expected.add((t, a, i, b))
            begin += n
        assert set(zip(*(c.tolist() for c in passage_dedup.compact_windows(v, count, least)))) == expected
        for reach in (1, 3, 8):
            near, begin = passage_dedup.near_least(v, count, reach).tolist(), 0
            for n in count.tolist():
                assert near[begin:begin + n] == [min(v[max(begin, i - reach):min(begin + n, i + reach + 1)]) for i in range(begin, begin + n)]
                begin += n


def test_op10_tokens_do_not_depend_on_their_company():
    texts = [b"One two  three four five six", b"", b"a b", b"x ONE two three\nfour five y", " é one two three four five\u00a0 z".encode()]
    joined, count = passage_dedup.tokens(texts, 5)
    alone = [passage_dedup.tokens([t], 5)[0] for t in texts]
    assert count.tolist() == [2, 0, 0, 3, 3] and joined.tolist() == [x for a in alone for x in a.tolist()]
    assert alone[0][0] == alone[3][1] and len(set(joined.tolist())) == 7


def test_op10_long_texts_in_pieces():
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000)).encode()
    w = passage_dedup.Windows(2, 5, 46, 1, 1, piece=700)
    rows = [*w.add(1, 2, text), *w.flush()]
    centres = np.concatenate([packs.unpack(body)[4] for bucket, body in rows if bucket == 0])
    assert centres.max() > 2900 and len(centres) >= 2 * 2 * 2996 / 47 * 0.8


def test_op10_longest_stretch():
    rng = np.random.default_rng(2)
    for _ in range(300):
        hit, loss = rng.random(int(rng.integers(1, 30))) < rng.random(), float(rng.choice([0.5, 2, 4]))
        best = None
        for i in range(len(hit)):
            for j in range(i + 1, len(hit) + 1):
                if hit[i] and hit[j - 1] and np.where(hit[i:j], 1.0, -loss).sum() >= 0 and j - i > (best[1] - best[0] if best else 0):
                    best = i, j
        assert passage_dedup.longest_stretch(hit, loss) == best


def test_op10_finds_planted_passages(spark):
    """Copies of 51 to 150 words, plain, with a changed or an inserted word, among words of their own."""
    rng = random.Random(2)
    fill = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    rows, groups = [], []
    for g in range(45):
        passage, ids = fill(rng.choice([51, 55, 60, 80, 150])), []
        for c in range(rng.choice([2, 2, 3, 5])):
            x = list(passage)
            if g % 3 == 1:
                x[rng.randrange(5, len(x) - 5)] = f"changed{c}"
            if g % 3 == 2:
                i = rng.randrange(20, len(x) - 20)
                x[i:i] = [f"ins{c}"]
            ids.append(len(rows))
            rows.append((len(rows), " ".join(fill(rng.randint(0, 200)) + x + fill(rng.randint(0, 200)))))
        groups.append(ids)
    clean = range(len(rows), len(rows) + 100)
    rows += [(i, " ".join(fill(rng.randint(0, 300)))) for i in clean]
    rows += [(9990, None), (9991, ""), (None, rows[0][1]), (9992, rows[0][1]), (9992, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    text = dict(rows)

    def shingles(i):
        w = WORD.findall(text[i])
        return [tuple(w[j:j + 5]) for j in range(len(w) - 4)]

    for options in ({}, {"bucket_bytes": 15_000}):
        out = passage_dedup.passage_classes(df, **options).collect()
        assert len(out) == len(rows)
        of = {r["doc_id"]: r["class_id"] for r in out}
        wanted = missed = 0
        for ids in groups:
            for x in ids:
                for y in ids:
                    if y < x:
                        a, b = shingles(x), shingles(y)
                        at = [[j for j, s in enumerate(p) if s in set(q)] for p, q in ((a, b), (b, a))]
                        if not at[0]:
                            continue
                        pa, pb = set(a[at[0][0]:at[0][-1] + 1]), set(b[at[1][0]:at[1][-1] + 1])
                        if min(at[0][-1] - at[0][0], at[1][-1] - at[1][0]) >= 45 and len(pa & pb) / len(pa | pb) >= 0.8:
                            wanted += 1
                            missed += of[x] != of[y]
        assert wanted > 40 and missed <= 0.02 * wanted
        for r in out:
            if r["doc_id"] in clean or r["doc_id"] in (9990, 9991):
                assert (r["class_id"], r["n_links"], r["n_passages"]) == (r["doc_id"], 0, 0)
            for p in r["passages"] or []:  # every reported pair holds
                mine, other = (set(s) for s in (shingles_of(text[r["doc_id"]], p["start"], p["end"]), shingles_of(text[p["other_id"]], p["other_start"], p["other_end"])))
                assert p["end"] - p["start"] >= 50 and p["other_end"] - p["other_start"] >= 50
                assert len(mine & other) / len(mine | other) == pytest.approx(p["similarity"], abs=1e-6) and p["similarity"] >= 0.8
        assert of[9992] == of[0] == 0 and of[None] is None
    assert passage_dedup.passage_classes(df.limit(0)).count() == 0


def test_op10_links_past_a_leader_that_fails(spark):
    """Groups of one plain text between variants of another changed word each, a variant with the smallest id, against brute force."""
    rng = random.Random(12)
    fill = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    rows, groups = [], []
    for g in range(60):
        passage, ids = fill([51, 55, 60, 70, 80][g % 5]), []
        for c in range(6):
            x = list(passage)
            if c != 3:
                x[8 + c * (len(x) - 16) // 5] = f"changed{g}x{c}"
            ids.append(len(rows))
            rows.append((len(rows), " ".join(fill(rng.randint(0, 80)) + x + fill(rng.randint(0, 80)))))
        groups.append(ids)
    token = [passage_dedup.tokens([t.encode()], 5)[0] for _, t in rows]
    of = {r["doc_id"]: r["class_id"] for r in passage_dedup.passage_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    wanted = missed = 0
    for ids in groups:
        for x in ids:
            for y in ids:
                if y < x and next(passage_dedup.best_passages(token[x], token[y], 46, 0.8), None):
                    wanted += 1
                    missed += of[x] != of[y]
        assert all(of[x] in ids for x in ids)
    print("wanted", wanted, "missed", missed)
    assert wanted > 300 and missed <= 0.02 * wanted


def shingles_of(text, start, end):
    w = WORD.findall(text)[start:end]
    return [tuple(w[j:j + 5]) for j in range(len(w) - 4)]


def test_op10_recall_with_edits(spark):
    """Pairs that share a passage of 60 to 200 words with 0 to 4 changed words, among words of their own."""
    rng = random.Random(21)
    fill = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    rows = []
    for g in range(100):
        passage, edits = fill(60 + 35 * (g % 5)), g // 5 % 5
        for c in range(2):
            x = list(passage)
            for e in range(edits if c else 0):
                x[rng.randrange(len(x))] = f"changed{g}x{e}"
            rows.append((len(rows), " ".join(fill(rng.randint(0, 100)) + x + fill(rng.randint(0, 100)))))
    token = [passage_dedup.tokens([t.encode()], 5)[0] for _, t in rows]
    of = {r["doc_id"]: r["class_id"] for r in passage_dedup.passage_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    wanted = [g for g in range(100) if next(passage_dedup.best_passages(token[2 * g + 1], token[2 * g], 46, 0.8), None)]
    assert len(wanted) > 60 and sum(of[2 * g] == of[2 * g + 1] for g in wanted) >= 0.95 * len(wanted)
    assert all(of[x] // 2 == x // 2 for x in of)


def test_op10_membership_and_links_by_arrays():
    rng, lookup, members = np.random.default_rng(4), passage_dedup.Lookup(8), passage_dedup.Members(500)
    for _ in range(200):
        a, b = (rng.integers(0, 300, int(rng.integers(1, 60))).astype(np.uint64) * np.uint64(0x100000001) for _ in range(2))
        assert (lookup.isin(a, b) == np.isin(a, b)).all() and not lookup.table.any()
        x, y = (rng.integers(0, 500, 40) for _ in range(2))
        assert (members.isin(x, y) == np.isin(x, y)).all() and not members.mark.any()
        assert (passage_dedup.distinct(a) == np.unique(a)).all()
    found = [(int(i), 5, int(j), 7, int(s), int(s) + 4) for i, j, s in rng.integers(0, 6, (40, 3))]
    pairs, place = rng.integers(0, 6, (300, 2)), rng.integers(0, 10, 300)
    got = passage_dedup.within(passage_dedup._pair(pairs[:, 0], np.full(300, 5), pairs[:, 1], np.full(300, 7)), place, found)
    want = [any(f[0] == i and f[2] == j and f[4] <= c < f[5] for f in found) for (i, j), c in zip(pairs.tolist(), place.tolist())]
    assert got.tolist() == want and not passage_dedup.within(np.zeros(3, np.uint64), np.zeros(3, np.int64), []).any()


def test_op10_windows_without_a_common_stretch_are_not_compared_one_by_one(monkeypatch):
    """60 windows of one key whose common tokens lie apart, and two that share a passage: few comparisons, the passage found."""
    rng, n, length = np.random.default_rng(5), 60, 120
    common = rng.integers(0, 1 << 32, length // 2, np.uint64)
    windows = []
    for _ in range(n):
        w = rng.integers(0, 1 << 32, length, np.uint64)
        w[::2] = common
        windows.append(w.astype(np.uint32))
    windows[40][20:80] = windows[7][10:70]
    calls = []
    plain = passage_dedup.best_passages
    monkeypatch.setattr(passage_dedup, "best_passages", lambda a, b, *more: calls.append(1) or plain(a, b, *more))
    ids = np.arange(n)
    zero = np.zeros(n, np.int64)
    found = list(passage_dedup.group_passages(np.full(n, 77, np.uint64), ids, ids, zero, zero, np.full(n, length), np.concatenate(windows), 46, 0.8))
    assert [(r[0], r[4], r[7] >= 0.8) for r in found] == [(40, 7, True)]
    assert len(calls) < 3 * n


def test_op10_long_enough_agrees_with_longest_stretch():
    rng = np.random.default_rng(6)
    rows = [rng.random(int(rng.integers(1, 140))) < share for share in (0.0, 0.5, 0.75, 0.8, 0.85, 0.95, 1.0) for _ in range(60)]
    for loss in (4.0, 8.0, 1e9):
        got = passage_dedup.long_enough(np.concatenate(rows), np.array([len(r) for r in rows]), 46, loss)
        stretch = [passage_dedup.longest_stretch(r, loss) for r in rows]
        wanted = [s is not None and s[1] - s[0] >= 46 for s in stretch]
        assert not any(w and not g for g, w in zip(got, wanted))
        assert loss > 8 or got.tolist() == wanted


def test_op10_numbered_agrees_with_unique():
    for kind in (np.uint32, np.uint64):
        a = np.random.default_rng(7).integers(0, 50, 500).astype(kind)
        for got, wanted in zip(passage_dedup.numbered(a), np.unique(a, return_inverse=True)):
            assert got.tolist() == wanted.tolist()
