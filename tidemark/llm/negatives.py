"""Hard-negative mining by a vertical scan of columnar vectors.

For each anchor the dimensions of a block of rows are read one by one, those where the anchor
is largest first. What the dimensions not read yet can add lies between bounds that follow
from the block's least and greatest values; rows whose score can't reach the answer any more
leave the candidate bitmap, and the few that stay are scored to the end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table
from tidemark.llm.vectors import integer_vectors, matrix_of

SCALE = 256
#: Largest integer: 100 times a score over 4,096 components fits 64 bits.
LARGEST = 1 << 22
POSITIVES = 5
NEGATIVES = 10
#: A negative's score is at least and at most this many hundredths of its positive's.
LEAST, MOST = 30, 90
#: Numbers in one group of anchors: 16 MB are sent to the tasks at a time.
GROUP_NUMBERS = 1 << 22
#: Rows whose columns are scanned together.
BLOCK = 4096
#: Dimensions read between two looks at the bounds.
STRIDE = 4
#: So few candidates are scored to the end at once.
FEW = 24

_NONE = np.int64(-(1 << 62))
_FOUND = (
    "anchor long, anchor_id long, place long, positive_id long, positive_score long, "
    "negative_id long, negative_score long"
)


class Anchors:
    """A group of anchors: numbers of their rows, ids, labels, vectors and reading order."""

    def __init__(self, rows: list):
        self.row = np.array([r["row"] for r in rows], np.int64)
        self.vec_id = np.array([r["vec_id"] for r in rows], np.int64)
        self.label = np.array([r["label"] for r in rows], np.int64)
        self.x = np.array([r["x"] for r in rows], np.int64).reshape(len(rows), -1)
        self.order = np.argsort(-np.abs(self.x), axis=1, kind="stable")


class Block:
    """Rows by label, their vectors by column."""

    def __init__(self, row, vec_id, label, x):
        by = np.lexsort((vec_id, label))
        self.row, self.vec_id, self.label = row[by], vec_id[by], label[by]
        self.columns = np.ascontiguousarray(x[by].T, np.int64)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def same(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]))

    def rest(self, anchors: Anchors) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that the dimensions from the i-th of an anchor's order on can add."""
        bounds = []
        ends = anchors.x * self.least, anchors.x * self.most
        for pick in (np.minimum, np.maximum):
            share = np.take_along_axis(pick(*ends), anchors.order, axis=1)
            total = np.cumsum(share[:, ::-1], axis=1)[:, ::-1]
            bounds.append(np.concatenate([total, np.zeros((len(total), 1), np.int64)], axis=1))
        return bounds[0], bounds[1]


def _blocks(batches):
    for batch in batches:
        columns = [
            np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64)
            for c in ("row", "vec_id", "label")
        ]
        x = matrix_of(batch.column("x"))
        for begin in range(0, batch.num_rows, BLOCK):
            part = slice(begin, begin + BLOCK)
            yield Block(*(c[part] for c in columns), x[part])


def _scan(block: Block, at, vector, order, low, high, narrow):
    """Rows of ``at`` that ``narrow`` leaves, with their exact scores.

    ``narrow(scores, low, high)`` tells from the partial scores, and the least and most that
    is still to come, which rows stay.
    """
    alive, score = at, np.zeros(len(at), np.int64)
    for i in range(0, len(order), STRIDE):
        if len(alive) <= FEW:
            rest = order[i:]
            return alive, score + vector[rest] @ block.columns[rest[:, None], alive]
        for d in order[i : i + STRIDE]:
            score += vector[d] * block.columns[d, alive]
        done = min(i + STRIDE, len(order))
        kept = narrow(score, low[done], high[done])
        if not kept.all():
            alive, score = alive[kept], score[kept]
    return alive, score


def _ranked(score: np.ndarray, vec_id: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` by falling score, then rising id."""
    return np.lexsort((vec_id, -score))[:most]


def _nth(values: np.ndarray, n: int) -> np.int64:
    """The n-th greatest value, or less than any score if there are fewer."""
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else _NONE


def positives_in(batches, anchors: Anchors, most: int):
    """Per anchor its ``most`` best other rows of its label among these batches."""
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in anchors.row]
    for block in _blocks(batches):
        low, high = block.rest(anchors)
        for a, label in enumerate(anchors.label):
            own = block.same(label)
            at = np.arange(own.start, own.stop)
            at = at[block.row[at] != anchors.row[a]]
            if not len(at):
                continue
            scores, ids = held[a]
            floor = _nth(scores, most)

            def narrow(partial, least, best, floor=floor):
                return partial + best >= max(floor, _nth(partial, most) + least)

            found, score = _scan(block, at, anchors.x[a], anchors.order[a], low[a], high[a], narrow)
            scores = np.concatenate([scores, score])
            ids = np.concatenate([ids, block.vec_id[found]])
            top = _ranked(scores, ids, most)
            held[a] = scores[top], ids[top]
    return held


def negatives_in(batches, anchors: Anchors, windows: list[np.ndarray], most: int):
    """Per anchor and window the ``most`` best rows of another label with a score in it.

    ``windows[a]`` holds the least and the greatest score of each of its windows.
    """
    held = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own] for own in windows]
    for block in _blocks(batches):
        low, high = block.rest(anchors)
        for a, label in enumerate(anchors.label):
            wanted = [w for w, (least, greatest) in enumerate(windows[a]) if least <= greatest]
            if not wanted:
                continue
            own = block.same(label)
            at = np.r_[0 : own.start, own.stop : len(block.row)]
            bounds = windows[a][wanted]
            floors = [_nth(held[a][w][0], most) for w in wanted]

            def narrow(partial, least, best, bounds=bounds, floors=floors):
                lowest, highest = partial + least, partial + best
                kept = np.zeros(len(partial), bool)
                for (first, last), floor in zip(bounds, floors, strict=True):
                    # Rows that are in the window for sure push the others out of its top.
                    sure = lowest[(lowest >= first) & (highest <= last)]
                    floor = max(first, floor, _nth(sure, most))
                    kept |= (highest >= floor) & (lowest <= last)
                return kept

            found, score = _scan(block, at, anchors.x[a], anchors.order[a], low[a], high[a], narrow)
            for w in wanted:
                inside = (score >= windows[a][w][0]) & (score <= windows[a][w][1])
                scores = np.concatenate([held[a][w][0], score[inside]])
                ids = np.concatenate([held[a][w][1], block.vec_id[found[inside]]])
                top = _ranked(scores, ids, most)
                held[a][w] = scores[top], ids[top]
    return held


def _first(frame: DataFrame, by: list[str], score: str, vec_id: str, most: int) -> DataFrame:
    order = [F.col(score).desc(), F.col(vec_id)]
    ranked = frame.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= most)


def _positives(vectors: DataFrame, anchors: Anchors, most: int) -> list:
    def scan(batches):
        held = positives_in(batches, anchors, most)
        owner = np.repeat(np.arange(len(held)), [len(ids) for _, ids in held])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(owner, pa.int64()),
                pa.array(np.concatenate([scores for scores, _ in held]), pa.int64()),
                pa.array(np.concatenate([ids for _, ids in held]), pa.int64()),
            ],
            ["anchor", "score", "vec_id"],
        )

    found = vectors.mapInArrow(scan, "anchor long, score long, vec_id long")
    # At most `most` rows for each anchor of the group.
    return _first(found, ["anchor"], "score", "vec_id", most).collect()


def _negatives(vectors: DataFrame, anchors: Anchors, positives: list, most: int) -> DataFrame:
    chosen = [[] for _ in anchors.row]
    for row in sorted(positives, key=lambda r: (r["anchor"], r["rank"])):
        chosen[row["anchor"]].append((row["vec_id"], row["score"]))
    windows = [
        np.array([(-(-LEAST * s // 100), MOST * s // 100) for _, s in own], np.int64).reshape(-1, 2)
        for own in chosen
    ]

    def scan(batches):
        columns = [[] for _ in range(7)]
        for a, own in enumerate(negatives_in(batches, anchors, windows, most)):
            for w, (scores, ids) in enumerate(own):
                positive_id, positive_score = chosen[a][w]
                n = len(ids)
                values = (anchors.row[a], anchors.vec_id[a], w, positive_id, positive_score)
                for column, value in zip(columns, values, strict=False):
                    column.append(np.full(n, value, np.int64))
                columns[5].append(ids)
                columns[6].append(scores)
        if columns[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), pa.int64()) for c in columns],
                [part.split()[0] for part in _FOUND.split(", ")],
            )

    found = vectors.mapInArrow(scan, _FOUND)
    return _first(found, ["anchor", "place"], "negative_score", "negative_id", most)


def hard_negatives(
    rows: DataFrame,
    label: str = "label",
    anchors: str = "vec_id % 100 = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Reads ``vec_id``, ``label`` and ``embedding`` (other columns are not looked at, whatever
    their names); ``label`` and ``anchors`` are SQL expressions over them. Rows with a null id
    or label or an unusable vector (see :func:`integer_vectors`) take no part. Each row stands
    for itself: a repeated row is another row, and a repeated anchor has its results twice.
    Ties go to the smaller id. An empty table, or one without anchors, gives an empty result.

    Every task scans its rows once for the positives and once for the negatives of a group of
    anchors, and hands on its best few; anchors come in as many groups as they need.
    """
    whole = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    vectors = integer_vectors(whole, SCALE, LARGEST, f"cast({label} as long)").withColumn(
        "vec_id", F.col("vec_id").cast("long")
    )
    starts = vectors.filter(F.expr(anchors))
    n, size = starts.agg(F.count("*"), F.max(F.size("x"))).first()
    groups = max(1, math.ceil(n * (size or 1) / GROUP_NUMBERS))
    parts = []
    for group in range(groups):
        own = starts.filter(F.pmod(F.xxhash64("row"), F.lit(groups)) == group)
        own = own.orderBy("row").collect()  # about GROUP_NUMBERS numbers
        if own:
            held = Anchors(own)
            chosen = _positives(vectors, held, positives)
            parts.append(staged(_negatives(vectors, held, chosen, negatives), "negatives"))
    found = rows.sparkSession.createDataFrame([], f"{_FOUND}, rank int")
    for part in parts:
        found = found.union(part)
    return found.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        "positive_score",
        "negative_score",
    )


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every anchor."""
    moved = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return hard_negatives(table(spark, sf_dir, "embeddings"), moved)


OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                           ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s USING (anchor_id)
WHERE NOT s.same AND {LEAST} * p.positive_score <= 100 * s.score
  AND 100 * s.score <= {MOST} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
