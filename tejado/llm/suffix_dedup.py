"""Operator 8: substring dedup by longest-previous-factor arrays.

A byte goes if a string of ``span`` bytes that covers it also starts in an earlier document. Windows of ``span`` bytes
are dealt out by their anchor, the least-hashed ``gram`` in them: equal windows have equal anchors, and windows in a row
with one anchor travel as one factor. In the order of the factors of an anchor the previous smaller position, the copy
in the earliest document, settles whole factors; tasks settle their own copies first, so that a factor which a third of
all documents hold is sent once per task. Where factors of an anchor differ, they may still share windows: then their
bytes are fetched, all their windows are put in suffix order, and a window goes if its longest previous factor, found
at the previous or next smaller position of that order, reaches ``span``. Anchors that many documents hold have their
windows dealt out one by one, so that what differs around a common passage doesn't meet in one task.

Numbers travel as packed arrays, a value per task and bucket; buckets hold the anchors of about ``bucket_bytes`` of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.llm.common import written
from tejado.llm.packs import by_key, gather, pack, steps, unpack, unpack_all

BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> list[np.uint64]:
    out, p = [], 1
    for _ in range(n + 1):
        out.append(np.uint64(p))
        p = p * int(BASE) % (1 << 64)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class Rolling:
    """Hashes of all substrings of given lengths of a byte array, from those of lengths 1, 2, 4, ..."""

    def __init__(self, data: np.ndarray):
        rng = np.random.default_rng(8)
        self.power = _powers(64)
        self.of = {1: rng.integers(0, 1 << 64, 256, np.uint64)[data]}

    def __call__(self, length: int) -> np.ndarray:
        if length not in self.of:
            half = 1 << (length.bit_length() - 1)
            left = half // 2 if half == length else half
            a, b = self(left), self(length - left)
            self.of[length] = a[:len(a) - (length - left)] * self.power[length - left] + b[left:]
        return self.of[length]


def minimizers(order: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of the least, the leftmost of equals."""
    value, place, have = order, np.arange(len(order), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        left, right = value[:-step], value[step:]
        first = left <= right
        place = np.where(first, place[:-step], place[step:])
        value = np.minimum(left, right)
        have += step
    return place


LAST = np.iinfo(np.int64).max  # stands for a null id: after all others


def factor_runs(data: np.ndarray, begin: np.ndarray, size: np.ndarray, span: int, gram: int, hot: np.ndarray):
    """Cut the windows of ``span`` bytes of each document (``begin``, ``size`` in ``data``) into factors.

    Returns for each factor its anchor hash, content hash, document (ordinal), first window and number of windows. The
    windows of a factor stand in a row and have the same anchor: their least-hashed ``gram``. Equal windows have equal
    anchors wherever they are. Windows whose anchor is in ``hot`` become factors of their own, under their own hash.
    """
    none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(data) < span:
        return none
    hashes = Rolling(data)
    order = mix(hashes(gram))
    place = minimizers(order, span - gram + 1)
    whole = hashes(span)
    n = len(whole)
    of = np.repeat(np.arange(len(size), dtype=np.int32), size)
    inside = of[:n] == of[span - 1:]
    change = np.ones(n + 1, bool)
    change[1:n] = (place[1:n] != place[:n - 1]) | (inside[1:] != inside[:-1]) | (of[1:n] != of[:n - 1])
    edge = np.flatnonzero(change)
    first, end = edge[:-1], edge[1:]
    keep = inside[first]
    first, end = first[keep], end[keep]
    anchor = order[place[first]]
    if len(hot):
        at = np.searchsorted(hot, anchor)
        is_hot = hot[np.minimum(at, len(hot) - 1)] == anchor
        windows = gather(np.arange(n), first[is_hot], (end - first)[is_hot])
        first, end = np.concatenate([first[~is_hot], windows]), np.concatenate([end[~is_hot], windows + 1])
        anchor = np.concatenate([anchor[~is_hot], mix(whole[windows] ^ BASE)])
    count = end - first
    content = mix(whole[first] * np.uint64(3) + whole[end - 1] * np.uint64(5) + count.astype(np.uint64))
    doc = of[first].astype(np.int64)
    return anchor, content, doc, first - begin[doc], count


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join spans of one document that touch; ``doc`` is any number that tells documents apart."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    new_doc = np.ones(len(doc), bool)
    new_doc[1:] = doc[1:] != doc[:-1]
    reach = np.maximum.accumulate(end + np.cumsum(new_doc) * (1 << 40)) - np.cumsum(new_doc) * (1 << 40)
    fresh = new_doc.copy()
    fresh[1:] |= start[1:] > reach[:-1]
    head = np.flatnonzero(fresh)
    return doc[head], start[head], np.maximum.reduceat(end, head)


def doc_bucket(ids: np.ndarray, sigs: np.ndarray, n: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64) * np.uint64(3) ^ sigs.astype(np.uint64) << np.uint64(20)) % np.uint64(n)).astype(np.int64)


def span_rows(ids, sigs, start, end, n: int):
    """(document bucket, packed ids, signatures, starts, ends) of spans, joined where they touch."""
    if not len(ids):
        return
    key, of = np.unique(np.stack([ids, sigs.astype(np.int64)]), axis=1, return_inverse=True)
    doc, start, end = merged(of.ravel(), start, end)
    ids, sigs = key[0][doc], key[1][doc]
    for bucket, part in by_key(doc_bucket(ids, sigs, n)):
        yield bucket, pack(ids[part], sigs[part].astype(np.uint32), start[part], end[part])


class Factors:
    """Factors of the documents of one task: equal ones are settled here, one of each is sent on."""

    def __init__(self, span: int, gram: int, buckets: int, doc_buckets: int, hot: np.ndarray, most: int = 700_000, chunk: int = 1_000_000):
        self.span, self.gram, self.buckets, self.doc_buckets, self.hot, self.most, self.chunk = span, gram, buckets, doc_buckets, hot, most, chunk
        self.texts, self.text_size, self.parts, self.held = [], 0, [], 0

    def add(self, doc_id: int, sig: int, text: bytes):
        """Yields rows when enough has come together. A text over the chunk's size goes in overlapping pieces."""
        piece = max(self.chunk, 2 * self.span)
        for at in range(0, max(1, len(text) - self.span + 1), piece):
            self.texts.append((doc_id, sig, at, text[at:at + piece + self.span - 1]))
            self.text_size += len(self.texts[-1][3])
            if self.text_size >= self.chunk:
                self._cut()
                if self.held >= self.most:
                    yield from self.flush()

    def _cut(self):
        size = np.array([len(t[3]) for t in self.texts], np.int64)
        data = np.frombuffer(b"".join([t[3] for t in self.texts]), np.uint8)
        anchor, content, doc, first, count = factor_runs(data, np.cumsum(size) - size, size, self.span, self.gram, self.hot)
        ids, sigs, at = (np.array([t[i] for t in self.texts], np.int64) for i in range(3))
        self.parts.append((anchor, content, ids[doc], sigs[doc].astype(np.uint32), first + at[doc], count.astype(np.uint16)))
        self.held += len(anchor)
        self.texts, self.text_size = [], 0

    def flush(self):
        if self.texts:
            self._cut()
        if not self.held:
            return
        anchor, content, ids, sigs, first, count = (np.concatenate(a) for a in zip(*self.parts))
        self.parts, self.held = [], 0
        order = np.lexsort((ids, mix(anchor ^ content * np.uint64(3))))
        same = mix(anchor ^ content * np.uint64(3))[order]
        head = np.ones(len(order), bool)
        head[1:] = same[1:] != same[:-1]
        least = ids[order][head][np.cumsum(head) - 1]
        later = np.empty(len(order), bool)
        later[order] = ids[order] > least
        for bucket, body in span_rows(ids[later], sigs[later], first[later], first[later] + count[later] + self.span - 1, self.doc_buckets):
            yield self.buckets + bucket, body
        anchor, content, ids, sigs, first, count = (a[~later] for a in (anchor, content, ids, sigs, first, count))
        for bucket, part in by_key(((anchor >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)):
            # a document's factors stand together: its id and signature go once, with the number of factors
            i, s = ids[part], sigs[part]
            new = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (s[1:] != s[:-1])])
            yield bucket, pack(anchor[part], steps(i[new]), s[new], np.diff(np.r_[new, len(part)]).astype(np.uint32), first[part], count[part], content[part])


def read_factors(values: list[bytes]):
    out = []
    for v in values:
        anchor, ids, sigs, times, first, count, content = unpack(v)
        out.append((anchor, content, np.repeat(np.cumsum(ids), times), np.repeat(sigs, times), first, count))
    return [np.concatenate(a) for a in zip(*out)]


def settle(values: list[bytes], bucket: int, span: int, doc_buckets: int):
    """Rows (document bucket, kind, body) of a bucket of factors: spans (kind 0) and factors to compare (kind 1).

    In the order of (anchor, content, document) equal factors are neighbours, and all but the first document's have an
    earlier copy: 64 bits of the anchor and 64 of the content tell them apart. Factors of one anchor with different contents may share some of their windows only; if several
    documents hold such, one of each goes on to be compared by its bytes.
    """
    anchor, content, ids, sigs, first, count = read_factors(values)
    order = np.lexsort((ids, content, anchor))
    anchor, content, ids, sigs, first, count = (a[order] for a in (anchor, content, ids, sigs, first, count))
    head = np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])]
    of = np.cumsum(head) - 1
    least = ids[head]
    later = ids > least[of]
    for side, body in span_rows(ids[later], sigs[later], first[later], first[later] + count[later] + span - 1, doc_buckets):
        yield side, 0, body
    group = anchor[head]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])
    several = (size > 1) & (np.minimum.reduceat(least, start) < np.maximum.reduceat(least, start))
    ask = np.flatnonzero(np.repeat(several, size)[of] & ~later)
    name = (np.uint64(bucket) << np.uint64(32) | anchor & np.uint64(0xFFFFFFFF)).astype(np.int64)  # equal names of different anchors do no harm: bytes are compared
    for side, part in by_key(doc_bucket(ids[ask], sigs[ask], doc_buckets)):
        p = ask[part]
        yield side, 1, pack(name[p], ids[p], sigs[p], first[p], count[p])


def place_of(ids, sigs, want_ids, want_sigs) -> np.ndarray:
    """For each wanted document its place among ``ids``, ``sigs``."""
    order = np.lexsort((sigs, ids))
    table = {k: p for p, k in zip(order[::-1].tolist(), zip(ids[order][::-1].tolist(), sigs[order][::-1].tolist()))}
    return np.array([table[k] for k in zip(want_ids.tolist(), want_sigs.tolist())], np.int64)


def contexts(docs: list[bytes], asks: list[bytes], span: int):
    """Rows (bucket, body): the bytes of the factors asked for, from the packed documents of one document bucket."""
    ids, sigs, size, data = unpack_all(docs)
    begin = np.cumsum(size) - size
    name, want, sig, first, count = unpack_all(asks)
    start, length = begin[place_of(ids, sigs, want, sig)] + first, count.astype(np.int64) + span - 1
    for bucket, part in by_key(name >> 32):
        yield bucket, pack(name[part], want[part], sig[part], first[part], count[part], gather(data, start[part], length[part]))


def earlier_windows(values: list[bytes], span: int, doc_buckets: int):
    """Rows (document bucket, body): spans of the windows that also start in an earlier document, by suffix order.

    Every window is a suffix of its factor, cut at ``span`` bytes: longer matches don't matter here. In suffix order
    (within an anchor's factors) the previous and next smaller positions, those of earlier documents, hold the longest
    previous factor; it reaches ``span`` where such a one is in the run of neighbours whose common prefix does.
    """
    name, ids, sigs, first, count = [], [], [], [], []
    words = -(-span // 8)
    suffix = []
    for v in values:
        n, i, s, f, c, data = unpack(v)
        c = c.astype(np.int64)
        begin = np.cumsum(c + span - 1) - (c + span - 1)
        at = gather(np.arange(len(data)), begin, c)
        view = np.lib.stride_tricks.sliding_window_view(np.r_[data, np.zeros(8 * words - span, np.uint8)], 8 * words)
        cut = np.ascontiguousarray(view[at]).view(">u8").astype(np.uint64)
        if span % 8:
            cut[:, -1] &= np.uint64((1 << 64) - (1 << 64 - 8 * (span % 8)))
        suffix.append(cut)
        name.append(np.repeat(n, c))
        ids.append(np.repeat(i, c))
        sigs.append(np.repeat(s, c))
        first.append(gather(np.arange(int((f + c).max())), f, c))
    name, ids, sigs, first, suffix = (np.concatenate(a) for a in (name, ids, sigs, first, suffix))
    order = np.lexsort((ids, *suffix.T[::-1], name))
    name, ids, sigs, first, suffix = (a[order] for a in (name, ids, sigs, first, suffix))
    head = np.r_[True, (name[1:] != name[:-1]) | (suffix[1:] != suffix[:-1]).any(axis=1)]
    earlier = ids > ids[head][np.cumsum(head) - 1]
    yield from span_rows(ids[earlier], sigs[earlier], first[earlier], first[earlier] + span, doc_buckets)


def cut_documents(docs: list[bytes], spans: list[bytes]):
    """For each packed document its id, size, bytes removed, spans removed and the bytes that stay."""
    ids, sigs, size, data = unpack_all(docs)
    end = np.cumsum(size)
    begin = end - size
    span_of: dict[tuple[int, int], list[tuple[int, int]]] = {}
    if spans:
        i, s, a, b = unpack_all(spans)
        key, of = np.unique(np.stack([i, s.astype(np.int64)]), axis=1, return_inverse=True)
        of, a, b = merged(of.ravel(), a, b)
        for k, x, y in zip(zip(key[0][of].tolist(), key[1][of].tolist()), a.tolist(), b.tolist()):
            span_of.setdefault(k, []).append((x, y))
    for i, s, x, y in zip(ids.tolist(), sigs.tolist(), begin.tolist(), end.tolist()):
        gone = span_of.get((i, s), [])
        edge = [0, *[e for pair in gone for e in pair], y - x]
        kept = b"".join(data[x + edge[j]:x + edge[j + 1]].tobytes() for j in range(0, len(edge), 2))
        yield i, y - x, y - x - len(kept), len(gone), kept


def _table(rows: Iterator[tuple], schema: pa.Schema) -> pa.Table:
    rows = list(rows)
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _hot_anchors(rows: DataFrame, n: int, span: int, gram: int, sample: int, share: float, least: int) -> np.ndarray:
    """Anchors that many documents hold, by a sample of about ``sample`` documents. They only decide how windows are
    dealt out (one by one), not what is found, so a sample will do. At most (anchors of a document) / ``share``."""
    some = rows if n <= sample else rows.where(F.pmod(F.xxhash64("id", "sig"), F.lit(1 << 30)) < int((1 << 30) * sample / n))

    def run(batches):
        for batch in batches:
            for text in batch.column("body"):
                data = np.frombuffer(text.as_py(), np.uint8)
                one = np.zeros(1, np.int64)
                anchor = np.unique(factor_runs(data, one, one + len(data), span, gram, np.empty(0, np.uint64))[0])
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64))], names=["anchor"])

    counts = some.mapInArrow(run, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("n") >= max(least, int(share * min(n, sample)))).collect()
    return np.sort(np.array([r["anchor"] for r in found], np.int64).view(np.uint64))


def without_repeats(docs: DataFrame, span: int = 50, gram: int = 20, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = 8 << 20,
                    hot_sample: int = 4_000, hot_share: float = 0.01, hot_least: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of every row of ``docs``.

    Texts are UTF-8 bytes, a null text has none. Removed is each byte covered by a string of ``span`` bytes that also
    starts in a row with a smaller id; matches don't cross rows and are judged on the input. Rows with one id don't
    remove from each other; null ids come after all others. Rows equal in id and text fare alike. Empty tables give
    empty results. Ids are whole numbers.
    """
    rows = docs.select(F.coalesce(docs[f"`{doc_id}`"].cast("long"), F.lit(int(LAST))).alias("id"), F.xxhash64(docs[f"`{text}`"]).bitwiseAND(F.lit(0xFFFFFFFF)).alias("sig"),
                       F.encode(F.coalesce(docs[f"`{text}`"], F.lit("")), "UTF-8").alias("body"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)), F.count(F.lit(1))).first()
    buckets = doc_buckets = max(1, -(-total[0] // bucket_bytes))
    hot = _hot_anchors(rows, total[1], span, gram, hot_sample, hot_share, hot_least)

    def cut(batches):
        factors = Factors(span, gram, buckets, doc_buckets, hot)
        schema = pa.schema([("bucket", pa.int64()), ("body", pa.binary())])
        for batch in batches:
            for i, s, t in zip(*(batch.column(c) for c in ("id", "sig", "body"))):
                for row in factors.add(i.as_py(), s.as_py(), t.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.binary())], schema=schema)
        for row in factors.flush():
            yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.binary())], schema=schema)

    settled = pa.schema([("side", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())])
    sides = pa.schema([("side", pa.int64()), ("body", pa.binary())])

    def settle_bucket(table: pa.Table) -> pa.Table:
        bucket, values = table.column("bucket")[0].as_py(), table.column("body").to_pylist()
        if bucket >= buckets:  # spans that a task has settled by itself
            return _table(((bucket - buckets, 0, v) for v in values), settled)
        return _table(settle(values, bucket, span, doc_buckets), settled)

    first = written(rows.mapInArrow(cut, "bucket long, body binary").groupBy("bucket").applyInArrow(settle_bucket, "side long, kind int, body binary"), "factors-settled")

    def pack_docs(batches):
        for batch in batches:
            ids, sigs = (batch.column(c).to_numpy() for c in ("id", "sig"))
            texts = batch.column("body")
            for side, part in by_key(doc_bucket(ids, sigs, doc_buckets)):
                body = [texts[int(p)].as_py() for p in part]
                value = pack(ids[part], sigs[part].astype(np.uint32), np.array([len(b) for b in body], np.int64), np.frombuffer(b"".join(body), np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([side], pa.int64()), pa.array([value], pa.binary())], names=["side", "body"])

    packed = rows.mapInArrow(pack_docs, "side long, body binary")

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        return _table(contexts(left.column("body").to_pylist(), right.column("body").to_pylist(), span) if len(left) and len(right) else (), sides)

    def order(table: pa.Table) -> pa.Table:
        return _table(earlier_windows(table.column("body").to_pylist(), span, doc_buckets), sides)

    asks = first.where("kind = 1").select("side", "body")
    found = packed.groupBy("side").cogroup(asks.groupBy("side")).applyInArrow(ask, "side long, body binary")
    second = written(found.groupBy("side").applyInArrow(order, "side long, body binary"), "factors-ordered")
    spans = first.where("kind = 0").select("side", "body").unionByName(second)
    result = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return _table((), result)
        return _table(((None if r[0] == LAST else r[0], *r[1:]) for r in cut_documents(left.column("body").to_pylist(), right.column("body").to_pylist())), result)

    return packed.groupBy("side").cogroup(spans.groupBy("side")).applyInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
