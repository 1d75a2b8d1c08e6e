"""Operator 7: byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece exactly one token can end the prefix's BPE encoding. It is the token that is a suffix
of the prefix and forms a *valid pair* with the last token of what stands before it: a pair is valid when BPE leaves
the two tokens apart. Storing that last token for every prefix gives

* encoding: walk the last tokens backwards from the end;
* exact appends: the stored prefixes stay as they are, only the new ones are computed;
* re-encoding near an edit: prefixes before the edit stay, and behind it the old ones hold again as soon as
  ``longest token`` successive entries agree with the old table.

Ranks are a file's lines ``base64 rank``; the driver reads them (a fixed file of under 1 MB) and broadcasts them.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tejado.llm.common import fresh

INF = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PrefixEncoder:
    """Encodes byte strings by the ranks; keeps what it learnt about tokens and pairs."""

    def __init__(self, ranks: dict[bytes, int], pair_memory: int = 1 << 19):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.size_of = {r: len(b) for b, r in ranks.items()}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.made = {b: r for b, r in ranks.items() if self.split(r)}  # tokens that merges can make
        self.longest = max(map(len, self.made))
        self.suffixes = ahocorasick.Automaton()
        for b, r in self.made.items():
            self.suffixes.add_word(b.decode("latin-1"), (len(b), r))
        self.suffixes.make_automaton()
        self.valid: dict[int, bool] = {}
        self.pair_memory = pair_memory

    def merge(self, data: bytes, below: int = INF) -> list[int]:
        """Plain BPE with the ranks under ``below``: always the lowest rank, leftmost first."""
        cut = [data[i:i + 1] for i in range(len(data))]
        while len(cut) > 1:
            best, at = min((self.ranks.get(cut[i] + cut[i + 1], INF), i) for i in range(len(cut) - 1))
            if best >= below:
                break
            cut[at:at + 2] = [cut[at] + cut[at + 1]]
        return [self.ranks[c] for c in cut]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; (-1, -1) for a single byte, None if no merge makes it."""
        if token not in self.parts:
            data = self.bytes_of[token]
            if len(data) == 1:
                self.parts[token] = (-1, -1)
            else:
                two = self.merge(data, below=token)
                self.parts[token] = (two[0], two[1]) if len(two) == 2 else None
        return self.parts[token]

    def is_valid(self, left: int, right: int) -> bool:
        """Whether BPE keeps ``left`` and ``right`` apart when they stand side by side.

        Going back in time from the finished tokens, whichever of the two was merged last is undone. At every step the
        inner neighbours x, y must not be a token whose merge would have come before x or y went into its parent.
        """
        key = left << 32 | right
        known = self.valid.get(key)
        if known is None:
            if len(self.valid) >= self.pair_memory:
                self.valid.clear()
            known = self.valid[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, x: int, y: int) -> bool:
        bytes_of, ranks = self.bytes_of, self.ranks
        x_parent = y_parent = INF
        while True:
            across = ranks.get(bytes_of[x] + bytes_of[y])
            if across is not None and across < x_parent and across <= y_parent:
                return False
            x_made = x if len(bytes_of[x]) > 1 else -1
            y_made = y if len(bytes_of[y]) > 1 else -1
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                x_parent, x = x, self.split(x)[1]
            else:
                y_parent, y = y, self.split(y)[0]

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Append to ``last`` the last token of each further prefix of ``data``, up to length ``upto``."""
        have, end = len(last), len(data) if upto is None else upto
        known, is_valid, append = self.valid.get, self.is_valid, last.append
        done = have  # prefixes up to this length have their last token
        # the tokens that end at each byte, the longest first; a token of the first new prefix starts at most so far back
        for at, (size, token) in self.suffixes.iter(data.decode("latin-1"), max(0, have + 1 - self.longest), end):
            if at < done:
                continue
            if size <= at:
                left = last[at - size]
                stays = known(left << 32 | token)
                if not (is_valid(left, token) if stays is None else stays):
                    continue
            append(token)
            done += 1
        if done < end:
            raise ValueError("the ranks lack a single byte")

    def table(self, data: bytes) -> list[int]:
        """The last token of every prefix of ``data``, by the prefix's length from 1 on."""
        last: list[int] = []
        self.extend(data, last)
        return last

    def tokens(self, last: list[int]) -> list[int]:
        """Token ids of the whole byte string whose prefix table is ``last``."""
        out, end, size_of = [], len(last), self.size_of
        while end:
            token = last[end - 1]
            out.append(token)
            end -= size_of[token]
        out.reverse()
        return out

    def append(self, data: bytes, last: list[int], more: bytes) -> bytes:
        """Lengthen a table in place by ``more``; returns the longer byte string."""
        data += more
        self.extend(data, last)
        return data

    def edit(self, data: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """Byte string and table after ``data[start:end] = new``; only prefixes near the edit are computed anew."""
        text, shift = data[:start] + new + data[end:], start + len(new) - end
        table, same = last[:start], 0
        while len(table) < len(text):
            at = len(table)
            self.extend(text, table, at + 1)
            same = same + 1 if at >= start + len(new) and table[at] == last[at - shift] else 0
            if same >= self.longest:
                table.extend(last[at - shift + 1:])
                break
        return text, table

    def encode_piece(self, piece: bytes) -> list[int]:
        """A piece that is a token as a whole is that token; any other is encoded by its prefix table."""
        token = self.ranks.get(piece)
        return [token] if token is not None else self.tokens(self.table(piece))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class TextEncoder:
    """Splits texts into pieces by a pattern and encodes each; remembers the last ``memory`` to 2 ``memory`` pieces used."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = 250_000):
        import regex

        self.bpe = PrefixEncoder(ranks)
        self.pattern = regex.compile(pattern)
        self.memory = memory
        self.seen: dict[str, bytes] = {}
        self.seen_before: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        out = self.seen_before.get(piece) or array("I", self.bpe.encode_piece(piece.encode())).tobytes()
        self.seen[piece] = out
        return out

    def encode(self, text: str) -> array:
        """Ids of ``text`` without special tokens, as unsigned 32-bit integers."""
        if len(self.seen) >= self.memory:
            self.seen_before, self.seen = self.seen, {}
        seen, out = self.seen, array("I")
        pieces = self.pattern.findall(text) if len(text) < 4_000_000 else (m.group() for m in self.pattern.finditer(text))
        out.frombytes(b"".join([seen.get(p) or self._ids(p) for p in pieces]))
        return out


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def _encoder(name: str, ranks, pattern: str) -> TextEncoder:
    """One encoder per Python worker, kept between its tasks."""
    if (name, pattern) not in _ENCODERS:
        _ENCODERS[name, pattern] = TextEncoder(ranks.value, pattern)
    return _ENCODERS[name, pattern]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` without ``text``, plus token_ids (array<int>), n_tokens, ids_sha256 and decoded_sha256.

    A null text counts as empty: no ids. Empty tables give an empty result with the same columns. Rows pass through one
    by one, so repeated rows and null or repeated ids are kept as they are. Columns of ``docs`` that have one of the new
    names stay; the new ones then get a number (``n_tokens_1``). The ids are decoded again for ``decoded_sha256``.
    ``with_ids=False`` leaves out the array itself.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [c for c in docs.columns if c != text]
    names = [fresh(docs.select(kept), n) for n in ("token_ids", "n_tokens", "ids_sha256", "decoded_sha256")]
    new = [T.StructField(names[0], T.ArrayType(T.IntegerType()))] * with_ids + [T.StructField(names[1], T.LongType()), T.StructField(names[2], T.StringType()), T.StructField(names[3], T.StringType())]
    schema = T.StructType([docs.schema[c] for c in kept] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, ranks, pattern)
        for batch in batches:
            texts = batch.column(len(kept))
            for low in range(0, len(texts), 64):
                ids, n, digest, back = array("I"), [], [], []
                for t in texts[low:low + 64]:
                    got = encoder.encode(t.as_py() or "")
                    n.append(len(got))
                    digest.append(hashlib.sha256(got.tobytes()).hexdigest())
                    back.append(hashlib.sha256(encoder.bpe.decode(got)).hexdigest())
                    if with_ids:
                        ids += got
                columns = [batch.column(i).slice(low, 64) for i in range(len(kept))]
                if with_ids:
                    ends = pa.array(np.cumsum([0, *n]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(ids, np.int32))))
                columns += [pa.array(n, pa.int64()), pa.array(digest), pa.array(back)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"]).mapInArrow(run, schema)


def decode_ids(df: DataFrame, ranks_path: str, ids: str = "token_ids") -> DataFrame:
    """``df`` plus ``decoded``: the bytes of its id arrays (null ids: null)."""
    import pyarrow as pa

    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([*df.schema, T.StructField(fresh(df, "decoded"), T.BinaryType())])
    at = df.columns.index(ids)

    def run(batches):
        bytes_of = {r: b for b, r in ranks.value.items()}
        for batch in batches:
            back = [None if x is None else b"".join(map(bytes_of.__getitem__, x)) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.binary())], names=schema.names)

    return df.mapInArrow(run, schema)
