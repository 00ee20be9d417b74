"""Vector code compression: product codes found by slicing and intersecting bitmasks.

Each part of a vector gets the number of its nearest codebook entry. The entries of a part
are sorted once per dimension, and each place of that order carries the mask of all entries
before it. A cube around a point is one slice per dimension: the masks at its two ends differ
in the entries inside. ANDed over the dimensions they are the entries in the cube. A first
cube of a fixed radius gives a near entry; the cube whose half side is that entry's distance
holds all nearer ones, so the exact distances of its entries decide.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table
from tidemark.llm.vectors import integer_vectors, matrix_of
from tidemark.operators.joins import broadcast_within

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Components become integers of this many steps a unit.
SCALE = 1024
#: Largest integer: squared distances over 1,024 components fit 64 bits.
LARGEST = 1 << 25
#: Points looked up at a time; bounds the candidates held in memory.
POINTS = 1024

_FAR = np.int64(np.iinfo(np.int64).max)


class SliceIndex:
    """Nearest entry of one codebook, ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries = np.asarray(entries, np.int64)
        count, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(entries.T, order, axis=1)
        words = -(-count // 64)
        own = np.zeros((count, words), np.uint64)
        own[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (
            np.arange(count, dtype=np.uint64) % np.uint64(64)
        )
        #: before[d, i]: the i entries that come first in dimension d.
        self.before = np.zeros((dims, count + 1, words), np.uint64)
        for d in range(dims):
            self.before[d, 1:] = np.bitwise_or.accumulate(own[order[d]], axis=0)
        self.radius = self._radius()

    def _radius(self) -> int:
        """Radius of the first cube: how far entries mostly are from the next one."""
        if len(self.entries) < 2:
            return 1
        nearest = []
        for i, entry in enumerate(self.entries):
            reach = np.abs(self.entries - entry).max(axis=1)
            nearest.append(int(np.delete(reach, i).min()))
        return max(1, int(np.median(nearest)))

    def within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per point the mask of the entries in the cube of that half side around it."""
        mask = np.full((len(points), self.before.shape[2]), ~np.uint64(0))
        for d, values in enumerate(self.sorted):
            low = np.searchsorted(values, points[:, d] - radius, "left")
            high = np.searchsorted(values, points[:, d] + radius, "right")
            mask &= self.before[d, high] ^ self.before[d, low]
        return mask

    def _settle(self, points, mask, best, code) -> None:
        """Measure the entries of ``mask`` and keep the nearest so far, in place."""
        bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")
        point, entry = np.nonzero(bits)
        if not len(point):
            return
        apart = points[point] - self.entries[entry]
        distance = np.einsum("ij,ij->i", apart, apart)
        first = np.flatnonzero(np.r_[True, point[1:] != point[:-1]])
        least = np.full(len(points), _FAR)
        least[point[first]] = np.minimum.reduceat(distance, first)
        # Entries of a point come by rising index, so the first at the least distance counts.
        at = np.flatnonzero(distance == least[point])
        owner, position = np.unique(point[at], return_index=True)
        found = entry[at[position]]
        better = (least[owner] < best[owner]) | (
            (least[owner] == best[owner]) & (found < code[owner])
        )
        owner, found = owner[better], found[better]
        best[owner], code[owner] = least[owner], found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point."""
        codes, distances = [], []
        for begin in range(0, len(points), POINTS):
            part = np.asarray(points[begin : begin + POINTS], np.int64)
            best, code = np.full(len(part), _FAR), np.zeros(len(part), np.int64)
            radius = np.full(len(part), self.radius, np.int64)
            seen = self.within(part, radius)
            while not (held := seen.any(axis=1)).all():
                radius[~held] *= 2
                seen[~held] = self.within(part[~held], radius[~held])
            self._settle(part, seen, best, code)
            # Entries outside the first cube are farther than its radius.
            open_ = np.flatnonzero(best > radius * radius)
            if len(open_):
                reach = np.array([math.isqrt(b) for b in best[open_].tolist()], np.int64)
                rest = self.within(part[open_], reach) & ~seen[open_]
                near, own = best[open_], code[open_]
                self._settle(part[open_], rest, near, own)
                best[open_], code[open_] = near, own
            codes.append(code)
            distances.append(best)
        if not codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(codes), np.concatenate(distances)


def _split(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    if vectors.shape[1] % parts:
        raise ValueError(f"Vectors of {vectors.shape[1]} components have no {parts} equal parts")
    return np.split(vectors, parts, axis=1)


def _tallies(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``part, entry, n, total``: how many parts chose an entry, and their sum."""
    width = books[0].shape[1]

    def tally(batches):
        index = [SliceIndex(book) for book in books]
        counts = np.zeros((len(books), len(books[0])), np.int64)
        totals = np.zeros((*counts.shape, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                for p, points in enumerate(_split(matrix_of(batch.column("x")), len(books))):
                    code, _ = index[p].nearest(points)
                    np.add.at(counts[p], code, 1)
                    np.add.at(totals[p], code, points.astype(np.int64))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(counts[part, entry]),
                pa.array(list(totals[part, entry]), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "total"],
        )

    own = vectors.select("x").mapInArrow(tally, "part int, entry int, n long, total array<long>")
    sums = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]
    return (
        own.groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *sums)
        .select("part", "entry", "n", F.array(*(f"t{i}" for i in range(width))).alias("total"))
    )


def fit_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> list[np.ndarray]:
    """The codebooks after ``rounds`` rounds over all rows of ``row, vec_id, label, x``.

    They start as the parts of the ``entries`` smallest ids. A round moves each entry to the
    floored mean of the parts that are nearest to it; entries without parts stay. Only the
    codebooks come to the driver. Rows of one id are ordered by their vector, rows without
    id come last.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    if not first:
        return [np.zeros((0, 0), np.int64)] * parts
    books = _split(np.array([row["x"] for row in first], np.int64), parts)
    for _ in range(rounds):
        books = [book.copy() for book in books]
        for row in _tallies(vectors, books).collect():
            books[row["part"]][row["entry"]] = np.array(row["total"], np.int64) // row["n"]
    return books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    numbers = np.concatenate([book.ravel() for book in books])
    return hashlib.sha256(",".join(map(str, numbers.tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` per row: two hex digits a part, squared distances summed."""

    def assign(batches):
        index = [SliceIndex(book) for book in books] if len(books[0]) else []
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [
                index[p].nearest(points)
                for p, points in enumerate(_split(matrix_of(batch.column("x")), len(books)))
            ]
            codes = np.stack([code for code, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([code.tobytes().hex() for code in codes], pa.string()),
                    pa.array(sum(distance for _, distance in found), pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    kinds = [f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("vec_id", "label")]
    return vectors.select("vec_id", "label", "x").mapInArrow(
        assign, ", ".join([*kinds, "code string, error long"])
    )


def decode(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Adds ``vector``: the integers that the codes stand for."""
    parts = [
        F.get(
            F.array(*(F.array(*(F.lit(int(v)) for v in entry)) for entry in book)),
            F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int"),
        )
        for p, book in enumerate(books)
    ]
    return codes.withColumn("vector", F.concat(*parts))


def compressed(rows: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of all rows with a usable vector, and the codebooks.

    Reads ``vec_id``, ``label`` and ``embedding``; other columns are not looked at, whatever
    their names. Unusable vectors (see :func:`integer_vectors`) go. Null labels and ids are
    kept as they are, repeated rows are each coded, an empty table gives an empty result.
    Lengths must be a multiple of the number of parts.
    """
    vectors = integer_vectors(rows, SCALE, LARGEST, "label")
    books = fit_codebooks(vectors)
    return staged(encode(vectors, books), "codes"), books


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Code and error of every vector, and the error of its label."""
    codes, books = compressed(table(spark, sf_dir, "embeddings"))
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    by_label = broadcast_within(staged(by_label, "label_errors"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    steps = []
    for turn in range(ROUNDS + 1):
        steps.append(f"""apart{turn} AS (
  SELECT a.vec_id, a.p, b.e,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM parts a JOIN book{turn} b USING (p)
), chosen{turn} AS (
  SELECT vec_id, p, e, d FROM apart{turn}
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1
)""")
        if turn < ROUNDS:
            steps.append(f"""moved{turn} AS (
  SELECT p, e, list(m ORDER BY i) AS v FROM (
    SELECT p, e, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
      SELECT c.p, c.e, i, sum(a.v[i])::BIGINT AS s, count(*) AS n
      FROM chosen{turn} c JOIN parts a USING (vec_id, p), range(1, 1 + len(a.v)) t(i)
      GROUP BY c.p, c.e, i))
  GROUP BY p, e
), book{turn + 1} AS (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{turn} b LEFT JOIN moved{turn} m USING (p, e)
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, p, x[p * len(x) // {PARTS} + 1:(p + 1) * len(x) // {PARTS}] AS v
  FROM kept, range({PARTS}) t(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  QUALIFY e < {ENTRIES}
), {", ".join(steps)}, digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256
  FROM book{ROUNDS}
), coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', c.e), '' ORDER BY c.p) AS code,
         sum(c.d)::BIGINT AS error
  FROM kept k JOIN chosen{ROUNDS} c USING (vec_id) GROUP BY k.vec_id, k.label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, digest
"""


OP11_SQL = _sql()
