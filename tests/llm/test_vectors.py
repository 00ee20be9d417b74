"""Vector codes and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import codes, negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row long, x string, code string, `_id` int"
EMPTY = [(1, None, 1), (2, [], 1), (3, [None] * 8, 1), (4, [1.0, math.nan] * 4, 2)]


def table(rows):
    """Rows with clashing extra columns, and all kinds of unusable vectors."""
    extra = [(10_000 + i, v, lab) for i, v, lab in EMPTY] + [(10_009, [math.inf] + [0.0] * 7, 1)]
    return [(i, v, lab, 7, "x", "c", 1) for i, v, lab in [*rows, *extra]]


def vectors(seed, n, dims=8, spread=1.0):
    rng = random.Random(seed)
    return [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(n)]


def brute_codes(rows, entries, rounds, parts=4):
    """Product codes by measuring every entry; rows are (id, vector, label)."""
    kept = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [math.floor(1024 * x) for x in r[1]]))
    whole = np.array([[math.floor(1024 * x) for x in r[1]] for r in kept], np.int64)
    pieces = np.split(whole, parts, axis=1)
    books = [p[:entries].copy() for p in pieces]

    def assign():
        apart = [((p[:, None, :] - b[None]) ** 2).sum(axis=2) for p, b in zip(pieces, books)]
        return [d.argmin(axis=1) for d in apart], [d.min(axis=1) for d in apart]

    for _ in range(rounds):
        chosen, _ = assign()
        for p, book in enumerate(books):
            for e in set(chosen[p].tolist()):
                own = pieces[p][chosen[p] == e]
                book[e] = own.sum(axis=0) // len(own)
    chosen, apart = assign()
    out = [
        (r[0], "".join(f"{c[i]:02x}" for c in chosen), int(sum(a[i] for a in apart)), r[2])
        for i, r in enumerate(kept)
    ]
    return out, books


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_slices_find_the_nearest_entry():
    rng = np.random.default_rng(5)
    for count, dims, size in [(1, 1, 3), (7, 2, 4), (64, 3, 50), (65, 16, 900), (256, 16, 900)]:
        entries = rng.integers(-size, size, (count, dims))
        entries[count // 2] = entries[0]  # equal entries: the lower index counts
        points = np.concatenate([rng.integers(-2 * size, 2 * size, (1500, dims)), entries, entries * 1000])
        found, apart = codes.SliceIndex(entries).nearest(points)
        exact = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (found == exact.argmin(axis=1)).all()
        assert (apart == exact.min(axis=1)).all()


def test_cubes_hold_exactly_their_entries():
    rng = np.random.default_rng(6)
    entries, points = rng.integers(-9, 9, (70, 3)), rng.integers(-9, 9, (40, 3))
    mask = codes.SliceIndex(entries).within(points, np.full(40, 4))
    bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :70].astype(bool)
    assert (bits == (np.abs(points[:, None] - entries[None]).max(axis=2) <= 4)).all()


def test_codes_equal_brute_force(spark, monkeypatch):
    rows = [(i, v, [0, 1, 2, None][i % 4]) for i, v in enumerate(vectors(1, 300))]
    rows += [rows[5], (7, rows[9][1], 1), (None, rows[11][1], 2), (400, rows[0][1], None)]
    frame = spark.createDataFrame(table(rows), SCHEMA).repartition(5)
    monkeypatch.setattr(codes, "table", lambda *_: frame)
    expected, books = brute_codes(rows, 256, 4)
    totals = {}
    for _, _, error, label in expected:
        totals[label] = totals.get(label, 0) + error
    flat = ",".join(str(v) for book in books for v in book.ravel())
    digest = hashlib.sha256(flat.encode()).hexdigest()
    want = [(i, code, error, totals[label], digest) for i, code, error, label in expected]
    got = [tuple(r) for r in codes.op11_vector_codes(spark, "").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_fewer_rows_than_entries_have_no_error(spark):
    rows = [(i, v, 1) for i, v in enumerate(vectors(2, 20))]
    found, books = codes.compressed(spark.createDataFrame(table(rows), SCHEMA))
    assert {r["error"] for r in found.collect()} == {0}
    restored = {r["vec_id"]: r["vector"] for r in codes.decode(found, books).collect()}
    assert restored == {i: [math.floor(1024 * x) for x in v] for i, v, _ in rows}


def test_codes_of_an_empty_table(spark, monkeypatch):
    monkeypatch.setattr(codes, "table", lambda *_: spark.createDataFrame([], SCHEMA))
    assert codes.op11_vector_codes(spark, "").collect() == []


def test_vectors_that_do_not_fit_are_refused(spark):
    for vectors_ in ([[1.0] * 8, [1.0] * 4], [[1e9] * 8]):
        rows = [(i, v, 1, 1, "", "", 1) for i, v in enumerate(vectors_)]
        with pytest.raises(Exception, match="one length|must lie within"):
            codes.compressed(spark.createDataFrame(rows, SCHEMA).coalesce(1))


def brute_negatives(rows, every, positives, negatives_):
    whole = [
        (n, i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * x) for x in v])
        for n, (i, v, lab) in enumerate(rows)
        if i is not None and lab is not None
    ]
    out = []
    for n, i, lab, x in whole:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), j, other) for m, j, other, y in whole if m != n]
        for score, pid, _ in sorted(s for s in scored if s[2] == lab)[:positives]:
            good = sorted(
                (s, j) for s, j, other in scored if other != lab and 30 * -score <= 100 * -s <= 90 * -score
            )
            out += [(i, pid, r + 1, j, -score, -s) for r, (s, j) in enumerate(good[:negatives_])]
    return sorted(out)


@pytest.mark.parametrize("block, few", [(4096, 24), (16, 2)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, few):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "FEW", few)
    monkeypatch.setattr(negatives, "GROUP_NUMBERS", 30)
    vecs = vectors(3, 400, 8, 0.3)
    vecs[50:90] = [vecs[50]] * 40  # many equal scores
    vecs[100] = [0.0] * 8
    vecs[200:300] = [[-abs(x) for x in v] for v in vecs[200:300]]
    rows = [(i, v, i % 4) for i, v in enumerate(vecs)]
    rows += [rows[100], rows[200], rows[33], (None, vecs[1], 1), (801, vecs[2], None)]
    rows += [(900 + i, v, 9) for i, v in enumerate(vectors(4, 3))]  # few of a label
    frame = spark.createDataFrame(table(rows), SCHEMA).repartition(6)
    monkeypatch.setattr(negatives, "table", lambda *_: frame)
    got = sorted(tuple(r) for r in negatives.op12_hard_negatives(spark, "").collect())
    assert got == brute_negatives(rows, 100, 5, 10)
    assert len(got) > 50


def test_negatives_of_tables_without_anchors(spark):
    rows = [(i, v, 1) for i, v in enumerate(vectors(8, 5), 1)]
    for own in ([], table(rows)):
        found = negatives.hard_negatives(spark.createDataFrame(own, SCHEMA))
        assert found.collect() == []
        assert found.columns[:3] == ["anchor_id", "positive_id", "rank"]
