"""Operator 13: token counts by byte-pair merging with a heap and a linked list; no token ids are made.

The vocabulary file is the JSON of a byte-level BPE tokenizer (``tokenizers``). A text is cut at the file's added tokens
(one token each), what stands between them into pieces by the byte-level pattern. A piece starts as its bytes, linked
in a list; a heap holds the rank and place of every adjacent pair that merges. The lowest rank, leftmost first, is popped
and merged, and the two new neighbouring pairs are pushed. The count is the number of bytes less the number of merges.

A worker keeps the counts of the last ``memory`` to 2 ``memory`` pieces it met, so a frequent word is merged once. Rows
pass through one by one: no shuffle, whatever the skew.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tejado.llm.common import fresh

LONG_PIECE = 64  # characters; the counts of longer pieces aren't kept
LONG_TEXT = 4_000_000  # characters; the pieces of longer texts are not listed all at once
#: Clitics, then runs of letters, digits or other signs after at most one space, then white space.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{digit}+| ?{sign}+|{space}+(?=\Z|{space})|{space}+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints in Latin-1, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def newer_characters() -> str:
    """Ranges (for a regex set) of the letters and digits that ``regex`` knows and the installed ``tokenizers`` doesn't.

    The two follow different versions of Unicode. Characters unassigned in Python's own tables are put to the test.
    """
    import unicodedata

    import regex
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    known = regex.compile(r"[\p{L}\p{N}]")
    ranges: list[list[int]] = []
    for code in range(0x110000):
        c = chr(code)
        if unicodedata.category(c) == "Cn" and known.match(c) and len(split("#" + c)) == 1:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def read_vocabulary(path: str) -> dict:
    """What counting needs of the file: merges as symbol pairs, byte symbols, added tokens. Other kinds of files raise."""
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    model, cut = own["model"], own.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or own.get("normalizer") or not plain:
        raise ValueError(f"{path} is not the file of a byte-level BPE tokenizer")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in own["added_tokens"]):
        raise ValueError(f"{path} has added tokens that take in what stands beside them")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {"ids": model["vocab"], "merges": merges, "added": [t["content"] for t in own["added_tokens"]], "prefix": bool(cut.get("add_prefix_space")), "newer": newer_characters()}


class PieceCounts(dict):
    """Number of tokens of each piece met; counted when first asked for."""

    def __init__(self, vocabulary: dict, memory: int):
        super().__init__()
        ids = vocabulary["ids"]
        self.symbol = [ids[c] for c in byte_symbols()]
        self.width = 1 + max(ids.values())
        #: symbol pair -> (rank, symbol it becomes)
        self.pairs = {ids[a] * self.width + ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(vocabulary["merges"])}
        self.memory, self.before = memory, {}

    def __missing__(self, piece: str) -> int:
        n = self.before.get(piece) or self.count(piece.encode())
        if len(piece) <= LONG_PIECE:
            if len(self) >= self.memory:
                self.before = dict(self)
                self.clear()
            self[piece] = n
        return n

    def count(self, piece: bytes) -> int:
        size = len(piece)
        if size < 2:
            return size
        pair_of, width, symbol = self.pairs.get, self.width, [self.symbol[b] for b in piece]
        left, right = list(range(-1, size - 1)), list(range(1, size + 1))  # the linked list; ``size`` ends it
        heap = []
        for at in range(size - 1):
            pair = pair_of(symbol[at] * width + symbol[at + 1])
            if pair:
                heap.append(pair[0] << 32 | at)
        heapify(heap)
        merged = 0
        while heap:
            top = heappop(heap)
            at = top & 0xFFFFFFFF
            after = right[at]
            if after >= size or symbol[at] < 0:
                continue
            pair = pair_of(symbol[at] * width + symbol[after])
            if not pair or pair[0] != top >> 32:  # the pair that was here has gone into another merge
                continue
            merged += 1
            symbol[at], symbol[after] = pair[1], -1
            beyond = right[at] = right[after]
            if beyond < size:
                left[beyond] = at
                pair = pair_of(symbol[at] * width + symbol[beyond])
                if pair:
                    heappush(heap, pair[0] << 32 | at)
            ahead = left[at]
            if ahead >= 0:
                pair = pair_of(symbol[ahead] * width + symbol[at])
                if pair:
                    heappush(heap, pair[0] << 32 | ahead)
        return size - merged


class TokenCounter:
    """Counts the tokens of texts."""

    def __init__(self, vocabulary: dict, memory: int = 250_000):
        import regex

        newer = vocabulary["newer"]
        self.ascii_pieces = re.compile(BYTE_LEVEL.format(letter="[A-Za-z]", digit="[0-9]", space=r"[\t-\r ]", sign=r"[^A-Za-z0-9\t-\r ]"))
        self.pieces = regex.compile(BYTE_LEVEL.format(letter=r"\p{L}", digit=r"\p{N}", space=r"\s", sign=r"[^\s\p{L}\p{N}]"))
        self.newer = regex.compile(f"[{newer}]") if newer else None
        if newer:
            old = {"letter": rf"[\p{{L}}--[{newer}]]", "digit": rf"[\p{{N}}--[{newer}]]", "space": r"\s", "sign": rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]"}
            self.old_pieces = regex.compile(BYTE_LEVEL.format(**old), regex.V1)
        added = sorted(filter(None, vocabulary["added"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.prefix = vocabulary["prefix"]
        self.counts = PieceCounts(vocabulary, memory)

    def _segment(self, text: str) -> int:
        if self.prefix and not text[:1].isspace():
            text = " " + text
        if text.isascii():
            pattern = self.ascii_pieces  # the same pattern, in the faster engine
        else:
            pattern = self.old_pieces if self.newer and self.newer.search(text) else self.pieces
        if len(text) < LONG_TEXT:
            return sum(map(self.counts.__getitem__, pattern.findall(text)))
        return sum(self.counts[m.group()] for m in pattern.finditer(text))

    def count(self, text: str) -> int:
        if not self.added or not self.added.search(text):
            return self._segment(text) if text else 0
        between = self.added.split(text)
        return len(between) - 1 + sum(self._segment(t) for t in between if t)


_COUNTERS: dict[str, TokenCounter] = {}


def _counter(path: str, vocabulary) -> TokenCounter:
    """One counter per Python worker, kept between its tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(vocabulary.value)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, plus n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``).

    A null text counts as empty: 0 bytes, 0 tokens. Added tokens that stand in a text count as one token each, as the
    library takes them by default; none are added at the ends; nothing is cut off. Rows pass through as they are, repeated
    ones and null ids too; an empty table gives an empty result. Where ``docs`` has a column of one of the new names, the
    new one gets a number (``n_tokens_1``).
    """
    import pyarrow as pa

    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))  # a fixed file of under 2 MB
    kept = [c for c in docs.columns if c != text]
    names = [fresh(docs.select(*[f"`{c}`" for c in kept]), n) for n in ("n_bytes", "n_tokens", "over_limit")]
    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(n, k) for n, k in zip(names, (T.LongType(), T.LongType(), T.BooleanType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary_path, vocabulary)
        for batch in batches:
            size, tokens = [], []
            for t in batch.column(len(kept)):
                t = t.as_py() or ""
                size.append(len(t) if t.isascii() else len(t.encode()))
                tokens.append(counter.count(t))
            new = [pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *new], names=[f.name for f in schema])

    return docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"]).mapInArrow(run, schema)
