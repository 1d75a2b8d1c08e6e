"""Operator 12: vectors as codes of one codebook entry per part, found by the integer Walsh-Hadamard transform.

A component x becomes the whole number floor(4096 * x). Vectors are cut into equal parts; every part position has a
codebook, refined by rounds of assigning each part to its nearest entry and moving the entry to the floor of its parts'
mean. Parts and entries are padded with zeros to a power of two and transformed by the Walsh-Hadamard matrix, whose rows
stand in sequency order (fewest sign changes first). The transform multiplies every squared distance by its size, so
sums of squared differences in the transformed coefficients are exact scaled distances, and every partial sum is a
lower bound of one. The entry that leads after the first coefficients sets the bound; entries whose partial sum passes it
are dropped as further coefficients are added. All is whole-number arithmetic.

The transformed parts are written once; each round reads them, sums each entry's parts per task (by linearity the
transformed sums give the sums) and shuffles at most one row per entry and task. Only the codebooks, of fixed size,
go through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.llm.common import few_files, fresh, written

SCALE = 4096
BLOCK = 4  # coefficients added between two eliminations


def sequency_matrix(size: int) -> np.ndarray:
    """Walsh-Hadamard matrix of a power of two: entries 1 and -1, rows by their number of sign changes."""
    at = np.arange(size)
    signs = np.array([[1 - 2 * ((i & j).bit_count() & 1) for j in at.tolist()] for i in at.tolist()], np.int64)
    return signs[np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")]


def whole(x: float) -> int:
    """floor(SCALE * x), exactly, also where the product is no float any more."""
    return floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE


class Shape:
    """How vectors of ``length`` components fall into parts, and the numbers they need.

    A length that ``parts`` doesn't divide is filled up with zeros. ``largest`` bounds the whole components; where a scaled
    distance might pass 64 bits, numpy works on Python's integers (``object``) instead.
    """

    def __init__(self, length: int, parts: int, largest: int):
        self.length, self.parts = length, parts
        self.width = -(-length // parts)
        self.size = 1 << max(0, self.width - 1).bit_length()
        self.matrix = sequency_matrix(self.size)
        widest = 2 * largest * self.size  # of the difference of two coefficients
        self.narrow = widest < 1 << 31 and widest * widest * parts < 1 << 63
        self.kind = np.int64 if self.narrow else object
        self.stored = "array<int>" if self.narrow else "array<string>"

    def transform(self, vectors: np.ndarray) -> np.ndarray:
        """Whole vectors (rows, length) -> transformed parts (rows, parts, size)."""
        parts = np.zeros((len(vectors), self.parts * self.width), self.kind)
        parts[:, :self.length] = vectors
        padded = np.zeros((len(vectors), self.parts, self.size), self.kind)
        padded[:, :, :self.width] = parts.reshape(len(vectors), self.parts, self.width)
        return padded @ self.matrix.astype(self.kind).T

    def restore(self, transformed: np.ndarray) -> np.ndarray:
        """The (width) components whose transform is given, in Python's integers; exact, as the transform of whole numbers divides."""
        return (transformed.astype(object) @ self.matrix.astype(object)) // self.size

    def to_arrow(self, transformed: np.ndarray) -> pa.Array:
        flat = transformed.reshape(-1)
        values = pa.array(flat.astype(np.int32)) if self.narrow else pa.array([str(x) for x in flat], pa.string())
        step = self.parts * self.size
        return pa.ListArray.from_arrays(pa.array(np.arange(len(transformed) + 1, dtype=np.int32) * step), values)

    def from_arrow(self, column: pa.Array) -> np.ndarray:
        flat = column.flatten()
        values = flat.to_numpy().astype(np.int64) if self.narrow else np.array([int(x) for x in flat.to_pylist()], object)
        return values.reshape(len(column), self.parts, self.size)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lowest index) and its scaled squared distance, of transformed parts (n, size) among (m, size)."""
    n, size = parts.shape
    if not n:
        return np.zeros(0, np.int64), parts[:, 0]
    first = min(BLOCK, size)
    partial = ((parts[:, None, :first] - entries[None, :, :first]) ** 2).sum(2)
    leader = partial.argmin(1)
    bound = ((parts - entries[leader]) ** 2).sum(1)
    row, entry = np.nonzero((partial <= bound[:, None]).astype(bool))
    total = partial[row, entry]
    for low in range(first, size, BLOCK):
        total = total + ((parts[row, low:low + BLOCK] - entries[entry, low:low + BLOCK]) ** 2).sum(1)
        stay = (total <= bound[row]).astype(bool)
        row, entry, total = row[stay], entry[stay], total[stay]
    starts = np.flatnonzero(np.diff(row, prepend=-1))  # every row still has its leader
    least = np.minimum.reduceat(total, starts)
    hit = np.flatnonzero((total == least[row]).astype(bool))
    _, at = np.unique(row[hit], return_index=True)
    return entry[hit[at]], least


def _kept(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _transformed(df: DataFrame, shape: Shape) -> DataFrame:
    """vec_id, label, vector -> vec_id, label, coefficients; null coefficients for vectors of another length."""
    kinds = [df.schema[c].dataType.simpleString() for c in ("vec_id", "label")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 4096):
                piece = batch.slice(low, 4096)
                column = piece.column(2)
                fits = column.value_lengths().to_numpy() == shape.length
                values = column.filter(pa.array(fits)).flatten().to_numpy()
                if shape.narrow:
                    vectors = np.floor(values * SCALE).astype(np.int64)
                else:
                    vectors = np.array([whole(x) for x in values.tolist()], object)
                packed = shape.to_arrow(shape.transform(vectors.reshape(int(fits.sum()), shape.length)))
                place = np.where(fits, np.cumsum(fits) - 1, 0)
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), packed.take(pa.array(place, mask=~fits))], names=["vec_id", "label", "coefficients"])

    return df.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, coefficients {shape.stored}")


def _entry_sums(coded: DataFrame, shape: Shape, books: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> number of parts assigned to it and their transformed sum; one row per entry and task is shuffled."""
    known = coded.sparkSession.sparkContext.broadcast(books)  # parts * entries * size numbers

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = known.value
        count = [[0] * len(b) for b in books]
        total = [np.zeros(b.shape, shape.kind) for b in books]
        for batch in batches:
            for low in range(0, len(batch), 4096):
                parts = shape.from_arrow(batch.column(0).slice(low, 4096))
                for p, book in enumerate(books):
                    entry, _ = nearest(parts[:, p], book)
                    np.add.at(total[p], entry, parts[:, p])
                    for e, n in zip(*np.unique(entry, return_counts=True)):
                        count[p][e] += int(n)
        rows = [(p, e, n, [str(x) for x in total[p][e]]) for p in range(shape.parts) for e, n in enumerate(count[p]) if n]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "entry", "n", "total"), r)) for r in rows], schema=summed)

    def add(table: pa.Table) -> pa.Table:
        total = [str(sum(map(int, at))) for at in zip(*table.column("total").to_pylist())]
        n = sum(table.column("n").to_pylist())
        return pa.Table.from_pylist([{"part": table.column("part")[0].as_py(), "entry": table.column("entry")[0].as_py(), "n": n, "total": total}], schema=summed)

    summed = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.string()))])
    kind = "part int, entry int, n long, total array<string>"
    sums = coded.where("coefficients is not null").select("coefficients").mapInArrow(assign, kind).groupBy("part", "entry").applyInArrow(add, kind)
    return {(r["part"], r["entry"]): (r["n"], [int(x) for x in r["total"]]) for r in sums.collect()}


def _first_entries(coded: DataFrame, shape: Shape, entries: int) -> list[np.ndarray]:
    """For each part position, that part of the ``entries`` smallest ids; a null id comes last, equal ids go by their coefficients."""
    rows = coded.where("coefficients is not null").orderBy(F.col("vec_id").asc_nulls_last(), "coefficients").select("coefficients").limit(entries).collect()
    flat = np.array([[int(x) for x in r[0]] for r in rows], shape.kind).reshape(len(rows), shape.parts, shape.size)
    return [flat[:, p].copy() for p in range(shape.parts)]


def _refined(coded: DataFrame, shape: Shape, entries: int, rounds: int) -> list[np.ndarray]:
    """The transformed codebooks after all rounds."""
    books = _first_entries(coded, shape, entries)
    for _ in range(rounds if len(books[0]) else 0):
        for (p, e), (n, total) in _entry_sums(coded, shape, books).items():
            mean = shape.restore(np.array(total, object)) // n
            books[p][e] = (mean.astype(shape.kind) @ shape.matrix.astype(shape.kind).T)
    return books


def codebook_digest(books: list[np.ndarray], shape: Shape) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place, joined by commas (filled-up places too)."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in shape.restore(entry)[:shape.width]).encode()).hexdigest()


def _codes(coded: DataFrame, shape: Shape, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of every row."""
    known = coded.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 4096):
                piece = batch.slice(low, 4096)
                there = piece.column(2).is_valid().to_numpy(zero_copy_only=False)
                parts = shape.from_arrow(piece.column(2).filter(pa.array(there)))
                got = [nearest(parts[:, p], book) for p, book in enumerate(known.value)]
                code = bytearray(np.stack([e for e, _ in got], 1).astype(np.uint8).tobytes()).hex() if len(parts) else ""
                error = sum(d for _, d in got) // shape.size
                codes, errors, k, step = [], [], 0, 2 * shape.parts
                for ok in there:
                    codes.append(code[step * k:step * (k + 1)] if ok else None)
                    errors.append(int(error[k]) if ok and error[k] < 1 << 63 else None)
                    k += ok
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    kinds = [coded.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return coded.mapInArrow(assign, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def encode_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "vector", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """``vec_id``, ``label``, code, error, label_error, codebooks_sha256: one row for each vector that is whole and finite.

    Rows whose vector is null or holds null or non-finite components are dropped. The length of the vector with the
    smallest id counts (a null id comes last; of equal ids, the least vector); a row of another length keeps its
    place with null code and error and trains nothing. Fewer rows than ``entries`` make fewer entries. An error that passes
    64 bits is null. Repeated rows are all kept; an empty table, or one without a whole vector, gives no rows. Other columns are not
    carried; if an id or label column has one of the new names, the new one gets a number. At most 256 entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index is written as two hex digits: 1 to 256 entries")
    thin = df.select(df[f"`{vec_id}`"].alias("vec_id"), df[f"`{label}`"].alias("label"), df[f"`{vector}`"].cast("array<double>").alias("vector")).where(_kept(F.col("vector")))
    size_of_first = F.min_by(F.size("vector"), F.struct(F.col("vec_id").isNull(), "vec_id", "vector"))
    largest = F.max(F.aggregate("vector", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))
    length, largest = thin.agg(size_of_first, largest).first()
    shape = Shape(parts if length is None else length, parts, whole(largest or 0.0) + 1)
    coded = written(_transformed(thin, shape), "vector-coefficients")
    books = _refined(coded, shape, entries, rounds)
    rows = written(_codes(coded, shape, books), "vector-codes")
    per_label = written(rows.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")), "vector-labels")
    names = [fresh(df.select(f"`{vec_id}`", f"`{label}`"), n) for n in ("code", "error", "label_error", "codebooks_sha256")]
    joined = few_files(rows.join(per_label, F.col("label").eqNullSafe(F.col("of")), "left"))  # a very common label can be split here
    return joined.select(F.col("vec_id").alias(vec_id), F.col("label").alias(label), F.col("code").alias(names[0]), F.col("error").alias(names[1]),
                         F.col("label_error").alias(names[2]), F.lit(codebook_digest(books, shape)).alias(names[3]))


def _sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """DuckDB SQL for ``embeddings``: plain distances, one pair of views per round."""
    distance = "list_sum(list_transform(list_zip(v.part, b.entry), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"
    assigned = f"SELECT vec_id, label, p, part, e, d FROM (SELECT v.*, b.e, {distance} AS d, row_number() OVER (PARTITION BY v.r, v.p ORDER BY {distance}, b.e) AS k FROM v JOIN book{{n}} b USING (p)) WHERE k = 1"
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, vec_id, label, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] AS part FROM kept, generate_series(0, {parts - 1}) g(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, part AS entry FROM v WHERE r <= {entries})"""]
    for n in range(rounds):
        steps.append(f"""
got{n} AS ({assigned.format(n=n)}),
moved{n} AS (SELECT p, e, list(m ORDER BY i) AS entry FROM (
  SELECT p, e, i, CAST((sum(part[i]) - ((sum(part[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM got{n}, generate_series(1, 4096) g(i) WHERE i <= len(part) GROUP BY p, e, i) GROUP BY p, e),
book{n + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{n} b LEFT JOIN moved{n} m USING (p, e))""")
    return "WITH " + ",".join(steps) + f""",
last AS ({assigned.replace("SELECT vec_id, label, p", "SELECT r, vec_id, label, p").format(n=rounds)}),
code AS (SELECT r, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY r, vec_id, label),
digest AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM code, digest
"""


SQL = _sql()
