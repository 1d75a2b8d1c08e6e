"""Operator 9: toxicity by a subsequence string kernel with Nystroem landmarks and a support vector machine.

The kernel of two words is the gap-weighted count of their common subsequences of two and three letters, normalised and
raised to a power (which keeps it a kernel), so an insult with gaps or inserted characters stays near its plain form; a
word is compared whole and cut to the landmark's length, the larger value counts, so endings don't hide a stem.
Landmarks are words and word beginnings that go with the label most clearly in a bounded sample of labelled documents.
The inverse root of the landmarks' own kernel matrix turns kernel values into Nystroem features, and a linear SVM on
them scores every word, and every run of letters that stand spaced out. It is trained on one witness for each labelled text,
the word nearest to any landmark. A text's probability is a logistic curve over its most toxic word's margin, over how
many words look toxic, and over how many words it has. Words are screened by the landmarks' letter pairs (next to each other in the landmark,
up to three apart in the word) before their kernel is computed; what the screen drops, and very small values, count as 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.llm.common import SPACE, bounded_sample, fresh, written

DECAY, POWER, SIZES = 0.8, 4, (2, 3)
PAIRS = 8  # letter pairs per landmark in the screen: one byte
NEED = 0.75  # share of them that a word must hold
LEAST = 0.05  # smaller kernel values count as 0
STEMS = (4, 5, 6, 7, 8)  # lengths of word beginnings that may be landmarks
CHUNK = 3_000_000  # characters of text looked at together
PIECE = 32  # longer words are read in pieces of so many letters, each half over the next
SPACED = re.compile(r"(?<!\S)\S(?:[\x20\x09]\S){2,}(?!\S)")


def _letters() -> np.ndarray:
    """Letter code 1 to 26 of each character below U+0250 (digits that stand in for letters too), 0: not a letter."""
    out = np.zeros(0x250, np.uint8)
    for c in range(0x250):
        base = unicodedata.normalize("NFKD", chr(c).lower())[:1]
        if "a" <= base <= "z":
            out[c] = ord(base) - 96
    for digit, letter in zip("013457", "oieast"):
        out[ord(digit)] = ord(letter) - 96
    out[ord("ß")] = 19
    return out


LETTERS = _letters()


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter codes of all words in a row, and the start and length of each word among them. Non-letters are left out."""
    points = np.frombuffer("\n".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    end = points == 10
    low = points < 0x250
    code = np.where(low, LETTERS[np.where(low, points, 0)], 32 + points % 32).astype(np.uint8)
    keep = (code > 0) & ~end
    of = np.cumsum(end)
    length = np.bincount(of[keep], minlength=len(words))
    return code[keep], np.cumsum(length) - length, length


def subsequence_kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Kernel of each row of ``x`` with the same row of ``y``; code 0 fills up short rows of ``y`` and matches nothing."""
    n, length = x.shape
    width = y.shape[1]
    match = ((x[:, :, None] == y[:, None, :]) & (y[:, None, :] > 0)).transpose(1, 2, 0) * DECAY ** 2
    total, before = np.zeros(n), np.ones((length + 1, width + 1, n))
    for size in range(1, max(SIZES) + 1):
        if size in SIZES:
            total += (match * before[:-1, :-1]).sum(axis=(0, 1))
        now = np.zeros_like(before)
        for a in range(1, length + 1):
            gap = np.zeros(n)
            for b in range(1, width + 1):
                gap = DECAY * gap + match[a - 1, b - 1] * before[a - 1, b - 1]
                now[a, b] = DECAY * now[a - 1, b] + gap
        before = now
    return total


class Landmarks:
    def __init__(self, words: list[str]):
        code, start, length = codes(words)
        self.words = words
        self.length = length
        self.code = np.zeros((len(words), max(length, default=1)), np.int32)
        table = np.zeros((64 * 64, len(words)), np.uint8)
        need = []
        for k, (s, n) in enumerate(zip(start, length)):
            c = self.code[k, :n] = code[s:s + n]
            at = np.unique(np.linspace(0, n - 2, min(PAIRS, n - 1)).astype(int))
            for bit, i in enumerate(at):
                table[int(c[i]) * 64 + int(c[i + 1]), k] |= 1 << bit
            need.append(math.ceil(NEED * len(at)))
        self.need = np.array(need, np.uint8)
        self.own = subsequence_kernel(self.code, self.code) if words else np.zeros(0)
        self.table = np.ascontiguousarray(np.pad(table, ((0, 0), (0, -len(words) % 8)))).view(np.uint64)

    def _pairs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``x`` (words of one length) and landmarks that pass the screen."""
        held = np.zeros((len(x), self.table.shape[1]), np.uint64)
        for step in (1, 2, 3):
            for i in range(x.shape[1] - step):
                held |= self.table[x[:, i] * 64 + x[:, i + step]]
        return np.nonzero(np.bitwise_count(held.view(np.uint8))[:, :len(self.words)] >= self.need)

    def _kernel(self, x: np.ndarray, k: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for low in range(0, len(x), 5_000):
            part, marks = x[low:low + 5_000], k[low:low + 5_000]
            out[low:low + 5_000] = subsequence_kernel(part, self.code[marks]) / np.sqrt(subsequence_kernel(part, part) * self.own[marks])
        return out ** POWER

    def values(self, words: list[str]) -> dict[str, dict[int, float]]:
        """For each word that resembles a landmark: kernel value by landmark; other words are absent."""
        if not words or not self.words:
            return {}
        code, start, length = codes(words)
        index = np.arange(len(words))
        long = length > PIECE
        for i in np.flatnonzero(long):
            steps = np.arange(0, length[i] - PIECE // 2, PIECE // 2)
            start, index = np.append(start, start[i] + steps), np.append(index, np.full(len(steps), i))
            length = np.append(length, np.minimum(PIECE, length[i] - steps))
        length[:len(words)][long] = 0
        asked: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}  # by length: codes, landmark, word
        for n in np.unique(length[length >= 2]):
            rows = np.flatnonzero(length == n)
            for low in range(0, len(rows), 20_000):
                part = rows[low:low + 20_000]
                x = code[start[part][:, None] + np.arange(n)].astype(np.int32)
                r, k = self._pairs(x)
                asked.setdefault(int(n), []).append((x[r], k, index[part[r]]))
                for m in np.unique(self.length[k]):
                    cut = (self.length[k] == m) & (m < n)
                    if cut.any():
                        asked.setdefault(int(m), []).append((x[r[cut], :m], k[cut], index[part[r[cut]]]))
        out: dict[str, dict[int, float]] = {}
        for found in asked.values():
            x, k, word = (np.concatenate(part) for part in zip(*found))
            if not len(x):
                continue
            value = self._kernel(x, k)
            near = value >= LEAST
            for w, mark, v in zip(word[near].tolist(), k[near].tolist(), value[near].tolist()):
                of = out.setdefault(words[w], {})
                of[mark] = max(of.get(mark, 0.0), v)
        return out

    def matrix(self) -> np.ndarray:
        m = len(self.words)
        i, j = (a.ravel() for a in np.indices((m, m)))
        return (subsequence_kernel(self.code[i], self.code[j]) / np.sqrt(self.own[i] * self.own[j])).reshape(m, m) ** POWER

    def read(self, texts: list[str]) -> Iterator[tuple[int, list[dict[int, float]]]]:
        """For each text its number of distinct words, and the kernel values of those that resemble a landmark."""
        low = 0
        while low < len(texts):
            sets, size = [], 0
            while low < len(texts) and size < CHUNK:
                t = texts[low].lower()
                have = set(t.split())
                have.update("".join(m.split()) for m in SPACED.findall(t))
                sets.append(have)
                size, low = size + len(t), low + 1
            values = self.values(sorted(set().union(*sets)))
            hits = values.keys()
            for have in sets:
                yield len(have), [values[w] for w in sorted(have & hits)]


@dataclass
class Model:
    landmarks: Landmarks
    weights: np.ndarray  # on kernel values: the Nystroem map is folded in
    bias: float
    curve: np.ndarray  # on describe()

    def describe(self, texts: list[str]) -> np.ndarray:
        """For each text: 1, the largest margin of a word (of none: the bias), how many look toxic, how many there are (0
        where none looks toxic, so that length alone decides nothing)."""
        out = []
        for n, found in self.landmarks.read(texts):
            margins = [self.bias + sum(v * self.weights[k] for k, v in w.items()) for w in found]
            toxic = sum(1 / (1 + math.exp(-min(max(6 * m, -30), 30))) for m in margins)
            out.append((1.0, max([self.bias, *margins]), math.log1p(toxic), math.log1p(n) * math.tanh(toxic)))
        return np.array(out).reshape(-1, 4)

    def score(self, texts: list[str]) -> np.ndarray:
        return np.round(1 / (1 + np.exp(-np.clip(self.describe(texts) @ self.curve, -30, 30))), 6)


def landmark_words(sample: DataFrame, text: str, label: str, count: int, least: int = 5) -> list[str]:
    """Words and word beginnings that go with label 1 most clearly, by the z score of their share of toxic texts.

    Each word counts once for a text. Ties go to the longer, then by the word. What has fewer than three letters, or is
    in fewer than ``least`` toxic texts, is left out; so is what begins with a chosen one, or begins one as often toxic.
    """
    words = F.array_distinct(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\x20\x09-\x0D]+", ""), SPACE))
    by_word = sample.select(label, F.explode(words).alias("word")).where(F.length("word") >= 3).groupBy("word").agg(F.sum(label).alias("hit"), F.count(F.lit(1)).alias("all"))
    stems = F.array_distinct(F.array("word", *[F.substring("word", 1, n) for n in STEMS]))
    by_stem = by_word.select(F.explode(stems).alias("stem"), "hit", "all").groupBy("stem").agg(F.sum("hit").alias("hit"), F.sum("all").alias("all"))
    whole = by_word.agg(F.sum("hit").alias("hit"), F.sum("all").alias("all")).first()
    if not whole["hit"] or whole["hit"] == whole["all"]:
        return []
    share = whole["hit"] / whole["all"]
    z = (F.col("hit") - F.col("all") * share) / F.sqrt(F.col("all") * share * (1 - share))
    pure = F.col("hit") / F.col("all") > 0.5 + share / 2
    top = by_stem.where((F.col("hit") >= least) & pure).select("stem", F.round(z, 6).alias("z")).where("z > 5").orderBy(F.desc("z"), F.desc(F.length("stem")), "stem").limit(8 * count)
    chosen: list[tuple[str, float]] = []
    for r in top.collect():
        if not any(r["stem"].startswith(w) or w.startswith(r["stem"]) for w, _ in chosen):
            chosen.append((r["stem"], r["z"]))
    return [w for w, _ in chosen[:count]]


def train(x: np.ndarray, y: np.ndarray, kernel: np.ndarray, cost: float = 1000.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights on kernel values and bias of a squared-hinge SVM on Nystroem features.

    Newton steps on the whole sample, so the result doesn't depend on an order. Both labels weigh the same in all.
    """
    value, vector = np.linalg.eigh(kernel)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    phi = np.hstack([x @ root, np.ones((len(x), 1))])
    sign = np.where(y == 1, 1.0, -1.0)
    weight = cost * np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    keep = np.diag([1.0] * (phi.shape[1] - 1) + [1e-6])
    w = np.zeros(phi.shape[1])
    for _ in range(steps):
        active = sign * (phi @ w) < 1
        a, c = phi[active], weight[active]
        new = np.linalg.solve(keep + a.T @ (a * c[:, None]), a.T @ (c * sign[active]))
        if np.abs(new - w).max() < 1e-9:
            break
        w = 0.5 * w + 0.5 * new
    return root @ w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 100) -> np.ndarray:
    """Weights of a logistic regression (first column: constant, not penalised), by damped Newton steps."""
    w, keep = np.zeros(x.shape[1]), np.diag([1e-6] + [l2] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(keep + (x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y) + keep @ w)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = 20_000, landmarks: int = 48) -> Model:
    """Fit on about ``fit_rows`` labelled documents that are not held out. Null labels don't count; of several the highest does."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("l_id")).agg(F.max(label).cast("int").alias("l_toxic"))
    chosen = F.broadcast(bounded_sample(known.where(~held_out(F.col("l_id"))), F.col("l_id"), fit_rows))  # about fit_rows rows of two numbers
    rows = docs.select(F.col(f"`{doc_id}`").alias("d_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(chosen, F.col("d_id") == F.col("l_id")).select("text", "l_toxic")
    rows = written(rows, "toxic-sample")
    marks = Landmarks(landmark_words(rows, "text", "l_toxic", landmarks))
    if not marks.words:
        n = rows.agg(F.count(F.lit(1)), F.sum("l_toxic")).first()
        odds = ((n[1] or 0) + 0.5) / ((n[0] or 0) - (n[1] or 0) + 1.5)
        return Model(marks, np.zeros(0), 0.0, np.array([math.log(odds), 0.0, 0.0, 0.0]))

    def witness(texts: list[str], given: Landmarks) -> list[list[float]]:
        out = []
        for _, found in given.read(texts):
            near = max(found, key=lambda w: max(w.values()), default={})
            out.append([near.get(k, 0.0) for k in range(len(given.words))])
        return out

    x, y = _sample_rows(rows, marks, witness)
    weights, bias = train(x, y, marks.matrix())
    model = Model(marks, weights, bias, np.zeros(4))
    x, y = _sample_rows(rows, model, lambda texts, given: given.describe(texts).tolist())
    model.curve = logistic(x, y)
    return model


def _sample_rows(rows: DataFrame, given, describe) -> tuple[np.ndarray, np.ndarray]:
    """``describe(texts, given)`` of the bounded sample (fit_rows short rows of numbers) in a fixed order, and its labels."""
    shared = rows.sparkSession.sparkContext.broadcast(given)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = describe([t.as_py() for t in batch.column(0)], shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["y", "x"])

    got = rows.mapInArrow(run, "y int, x array<double>").toPandas()
    x, y = np.array(got["x"].tolist()), got["y"].to_numpy()
    order = np.lexsort([*x.T[::-1], y])
    return x[order], y[order].astype(float)


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def scores(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", cut: float = 0.7) -> DataFrame:
    """``docs`` without ``text``, plus held_out, score (0 to 1) and predicted (1 from ``cut`` on).

    A null or empty text has no words: it gets the score of a text that resembles no landmark. Null ids are not held out.
    Rows are scored one by one; new columns get numbered names where ``docs`` has one of theirs. Empty tables: empty.
    """
    kept = [c for c in docs.columns if c != text]
    name = {n: fresh(docs.select(*[f"`{c}`" for c in kept]), n) for n in ("held_out", "score", "predicted")}
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(name["score"], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            value = shared.value.score([t.as_py() or "" for t in batch.column(len(kept))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(value)], names=schema.names)

    scored = docs.select(*[f"`{c}`" for c in kept], f"`{text}`").mapInArrow(run, schema)
    return scored.select("*", held_out(F.col(f"`{doc_id}`")).alias(name["held_out"]), (F.col(name["score"]) >= cut).cast("int").alias(name["predicted"]))
