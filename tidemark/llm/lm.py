"""Katz back-off language model over words, with Good-Turing discounts.

    p(w | h) = d(c(h, w)) c(h, w) / c(h)   if (h, w) was seen,
             = a(h) p(w)                   otherwise, with p(w) discounted the same way.

``a(h)`` is the mass that the discounts free, over the mass of the words not seen after h,
so that the probabilities after each h sum to 1. Where all pairs of h are too frequent to be
discounted, c(h) + 1 takes the place of c(h), so that some mass is free. Every word of the
training texts is in the vocabulary; p(w) of all words never seen is what the discounts leave.

Texts are held in blocks of packed columns. A block asks for the counts of its distinct words
by hash, and later for those of its distinct pairs; whoever has a share of the words or pairs
sums what the blocks sent and answers each of them. No table of words is ever in one place.

Words are numbered by falling count: a number tells its word's count, and with it p(w), from
a table with one entry per count that occurs (at most the root of twice the tokens). Pairs
are dealt by their first word, those of a common first word by both; a pair comes once per
block, however often it occurs there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, staged, table, word_hashes
from tidemark.llm.langid import fold

#: Counts up to this one are discounted.
DISCOUNTED = 5
#: First words with more than this share of all tokens always have mass left by the discounts.
FREQUENT = 1 / 512
#: Tokens per bucket of pairs, and distinct words of blocks per bucket of words.
BUCKET_TOKENS, BUCKET_WORDS = 1_000_000, 250_000
#: First words with more than this share of a bucket, or FREQUENT ones, are dealt by pair.
SPREAD = 1 / 4
END = np.uint64(0x5E17_B0DE_0FF1_CE01)


def _packed(values: np.ndarray) -> bytes:
    """An array of 64-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes, kind=np.int64) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    data = pa.decompress(raw[8:], size * 8, "zstd", asbytes=True)
    planes = np.frombuffer(data, np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _sorted_packed(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=values.dtype.type(0)))


def _sorted_unpacked(raw: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(_unpacked(raw, kind), dtype=kind)


def _tokens(column: pa.Array):
    """First row, token counts and token hashes of runs of texts; each text ends in END."""
    for first, counts, hashes in word_hashes(column):
        yield first, counts + 1, np.insert(hashes, np.cumsum(counts), END)


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """Good-Turing factors for counts 0 to DISCOUNTED (that of 0 is unused).

    ``counts_of_counts[r]`` is the number of types seen r times. Where the estimate is not
    between 0 and 1, half a count is taken off instead.
    """
    n = [float(x) for x in counts_of_counts]
    last = DISCOUNTED + 1
    factors = np.ones(last)
    common = last * n[last] / n[1] if n[1] else 1.0
    for r in range(1, last):
        factor = -1.0
        if n[r] and common < 1:
            factor = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        factors[r] = factor if 0 < factor < 1 else 1 - 0.5 / r
    return factors


_BLOCKS = (
    "block long, ids binary, flags binary, counts binary, words binary, trained binary, "
    "tokens binary, n_tokens long, n_words long"
)


def _blocks(docs: DataFrame) -> DataFrame:
    """Runs of documents: their distinct words with training counts, and tokens as places there."""

    def build(batches):
        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id")
            held = np.array(batch.column("held_out").to_pylist(), bool)
            for first, counts, hashes in _tokens(batch.column("text")):
                own = ids.slice(first, len(counts))
                out = held[first : first + len(counts)]
                words, index = np.unique(hashes, return_inverse=True)
                trained = np.bincount(index, np.repeat(~out, counts), len(words))
                row = {
                    "block": serial,
                    "ids": _packed(np.array(own.fill_null(0), np.int64)),
                    "flags": _packed(np.array(own.is_valid(), np.int64) * 2 + out),
                    "counts": _packed(counts.astype(np.int64)),
                    "words": _sorted_packed(words),
                    "trained": _packed(trained.astype(np.int64)),
                    "tokens": _packed(index.astype(np.int64)),
                    "n_tokens": len(hashes),
                    "n_words": len(words),
                }
                yield pa.RecordBatch.from_pydict({name: [row[name]] for name in row})
                serial += 1

    return docs.select("doc_id", "held_out", "text").mapInArrow(build, _BLOCKS)


_ROWS = "bucket long, kind string, block long, a binary, b binary, c binary, d binary"
_ROW_NAMES = ["bucket", "kind", "block", "a", "b", "c", "d"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[i]) for i in range(7)], _ROW_NAMES
    )


def _asked(blocks: DataFrame, buckets: int) -> DataFrame:
    """The distinct words of each block, by ranges of hashes."""

    def ask(batches):
        for batch in batches:
            for block, a, b in zip(
                *(batch.column(c).to_pylist() for c in ("block", "words", "trained")), strict=True
            ):
                words, trained = _sorted_unpacked(a, np.uint64), _unpacked(b)
                to = ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                rows = [
                    (int(to[begin]), "ask", block, _sorted_packed(words[begin:end]),
                     _packed(trained[begin:end]), None, None)
                    for begin, end in _runs(to)
                ]
                yield _rows(rows)

    return blocks.select("block", "words", "trained").mapInArrow(ask, _ROWS)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begins and ends of the runs of equal values."""
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    bounds = [0, *cut.tolist(), len(values)] if len(values) else [0]
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def _summed(rows: list[dict], kind=np.int64) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct values of all rows, their summed counts, and each row's places among them."""
    values = [_sorted_unpacked(row["a"], kind) for row in rows]
    distinct, where = np.unique(np.concatenate(values), return_inverse=True)
    n = np.bincount(where, np.concatenate([_unpacked(row["b"]) for row in rows]), len(distinct))
    return distinct, n.astype(np.int64), np.split(where, np.cumsum([len(v) for v in values])[:-1])


def _answered(asked: DataFrame) -> DataFrame:
    """Per block: count and rank of its words; per bucket: how many words have each count.

    The rank of a word is its place among the words of its bucket that have its count.
    """

    def answer(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        bucket = rows[0]["bucket"]
        words, n, parts = _summed(rows, np.uint64)
        order = np.argsort(n, kind="stable")
        counts, begins, types = np.unique(n[order], return_index=True, return_counts=True)
        rank = np.empty_like(n)
        rank[order] = np.arange(len(n)) - np.repeat(begins, types)
        ends = n[words == END]
        out = [(bucket, "level", 0, _packed(counts), _packed(types), _packed(ends), None)]
        for row, part in zip(rows, parts, strict=True):
            out.append(
                (bucket, "number", row["block"], _packed(n[part]), _packed(rank[part]), None, None)
            )
        return pa.Table.from_batches([_rows(out)])

    return asked.groupBy("bucket").applyInArrow(answer, _ROWS)


def unigrams(levels: DataFrame, buckets: int) -> dict:
    """What all tasks know of words: arrays with an entry for each count that occurs.

    Numbers of words with one count are a range, in which ranks and buckets take turns. After
    all words come the number of those never seen (``size``) and that of the start.
    """

    def spread(batches):
        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in "abc"), strict=True):
                counts, types, ends = _unpacked(a), _unpacked(b), _unpacked(c)
                n = np.concatenate([counts[counts > 0], np.zeros(len(ends), np.int64)])
                yield pa.RecordBatch.from_pydict(
                    {"n": n, "types": np.concatenate([types[counts > 0], ends])}
                )

    rows = levels.select("a", "b", "c").mapInArrow(spread, "n long, types long")
    frame = rows.groupBy("n").agg(F.sum("types").alias("types"), F.max("types").alias("most"))
    frame = frame.toPandas().sort_values("n", ascending=False)
    documents = int(frame["types"][frame["n"] == 0].sum())
    frame = frame[frame["n"] > 0]
    counts, types = frame["n"].to_numpy(np.int64), frame["types"].to_numpy(np.int64)
    spans = frame["most"].to_numpy(np.int64) * buckets
    size = int(spans.sum())
    if size + 2 > 3_000_000_000:
        raise ValueError(f"{int(types.sum())} words: pairs of their numbers exceed 63 bits")
    tokens, kinds = int((counts * types).sum()), int(types.sum())
    of_counts = [int(types[counts == r].sum()) for r in range(DISCOUNTED + 2)]
    factor = np.append(discounts(of_counts), 1.0)
    share = factor[np.minimum(counts, DISCOUNTED + 1)] * counts / max(tokens, 1)
    # Without any discount nothing would be left for words not seen.
    total = float((share * types).sum())
    if total > 1 - 0.5 / max(tokens, 1):
        share, total = share * (1 - 0.5 / tokens) / total, 1 - 0.5 / tokens
    history = np.concatenate([counts, [0, documents]])
    frequent = history > FREQUENT * max(tokens, 1)
    known = np.concatenate([counts, [0, 0]])
    return {
        "tokens": tokens,
        "word_buckets": buckets,
        "size": size,
        "starts": np.concatenate([[0], np.cumsum(spans), [size + 1]]),
        "history": history,
        "share": np.concatenate([share, [max(1 - total, 1e-300), 0.0]]),
        "base": np.log10((known + 0.5) / (tokens + 0.5 * (kinds + 1))),
        "frequent": frequent,
        "spread": frequent | (history > SPREAD * BUCKET_TOKENS),
        "buckets": max(1, -(-tokens // BUCKET_TOKENS)),
    }


def _level(known: dict, numbers: np.ndarray) -> np.ndarray:
    return np.searchsorted(known["starts"], numbers, "right") - 1


def _pairs_of(rows: list[dict], known: dict) -> dict:
    """A block's tokens, and its distinct pairs in the order of buckets and pairs."""
    info = next(row for row in rows if row["kind"] == "block")
    answers = sorted((r for r in rows if r["kind"] == "number"), key=lambda r: r["bucket"])
    n = [_unpacked(row["a"]) for row in answers]
    bucket = np.repeat([row["bucket"] for row in answers], [len(x) for x in n])
    n, rank = np.concatenate(n), np.concatenate([_unpacked(row["b"]) for row in answers])
    size, width = known["size"], known["size"] + 2
    at = np.searchsorted(-known["history"][:-2], -n)
    number = known["starts"][at] + rank * known["word_buckets"] + bucket
    number = np.where(n > 0, number, size)[_unpacked(info["c"])]
    counts, flags = _unpacked(info["a"]), _unpacked(info["b"])
    history = np.empty_like(number)
    history[1:] = number[:-1]
    history[np.cumsum(counts) - counts] = size + 1
    pairs, index = np.unique(history * width + number, return_inverse=True)
    first = pairs // width
    spread = known["spread"][_level(known, first)]
    key = np.where(spread, pairs, first).astype(np.uint64)
    to = (mix(key) % np.uint64(known["buckets"])).astype(np.int64)
    order = np.argsort(to, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return {
        "ids": _unpacked(info["d"]), "flags": flags, "counts": counts, "number": number,
        "pairs": pairs[order], "to": to[order], "index": place[index], "spread": spread[order],
    }


def _asked_pairs(numbered: DataFrame, shared) -> DataFrame:
    """The distinct pairs of each block with their training counts, by bucket."""

    def ask(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        held = _pairs_of(rows, shared.value)
        train = np.repeat(held["flags"] % 2 == 0, held["counts"])
        pairs, to = held["pairs"], held["to"]
        n = np.bincount(held["index"], train, len(pairs)).astype(np.int64)
        return pa.Table.from_batches(
            [
                _rows(
                    [
                        (int(to[begin]), "ask", rows[0]["block"], _sorted_packed(pairs[begin:end]),
                         _packed(n[begin:end]), None, None)
                        for begin, end in _runs(to)
                    ]
                )
            ]
        )

    return numbered.groupBy("block").applyInArrow(ask, _ROWS)


def _counted(asked: DataFrame, shared) -> DataFrame:
    """Per bucket: sums by spread first word and counts of counts; per block: its answers.

    An answer has twice the count of each pair, plus one where its first word gets one count
    more, and the sums of each first word that is not spread and has a pair not seen.
    """

    def count(group: pa.Table) -> pa.Table:
        known = shared.value
        width = known["size"] + 2
        rows = group.to_pylist()
        bucket = rows[0]["bucket"]
        pairs, n, parts = _summed(rows)
        first, where = np.unique(pairs // width, return_inverse=True)
        level = _level(known, first)
        seen, few = n > 0, np.where(n > DISCOUNTED, 0, n)
        sums = [np.bincount(where, few == r, len(first)) for r in range(1, DISCOUNTED + 1)]
        sums.append(np.bincount(where, np.where(few == 0, n, 0), len(first)))
        share = known["share"][_level(known, pairs % width)]
        sums.append(np.bincount(where, np.where(seen, share, 0.0), len(first)))
        sums = np.array(sums)
        spread = known["spread"][level]
        extra = _extra(sums, known["frequent"][level]) & ~spread
        levels = np.bincount(np.minimum(n, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
        out = [
            (bucket, "first", 0, _packed(first[spread]), _packed(sums[:, spread].reshape(-1)),
             _packed(levels[: DISCOUNTED + 2]), None)
        ]
        code = n * 2 + extra[where]
        for row, part in zip(rows, parts, strict=True):
            unseen = where[part][~seen[part] & ~spread[where[part]]]
            out.append(
                (bucket, "count", row["block"], _packed(code[part]),
                 _packed(sums[:, np.unique(unseen)].reshape(-1)), None, None)
            )
        return pa.Table.from_batches([_rows(out)])

    return asked.groupBy("bucket").applyInArrow(count, _ROWS)


def _extra(sums: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """First words that get one count more: none of their pairs is discounted."""
    return (sums[:DISCOUNTED].sum(axis=0) == 0) & (sums[DISCOUNTED] > 0) & ~frequent


def _weights(sums: np.ndarray, factor: np.ndarray, frequent: np.ndarray):
    """Counts of first words, and log10 of their back-off weights, from their sums.

    A word never seen with a successor backs off with weight 1. Some mass is left for words
    not seen at all, so no first word is followed by everything.
    """
    r = np.arange(1, DISCOUNTED + 1)
    total = r @ sums[:DISCOUNTED] + sums[DISCOUNTED] + _extra(sums, frequent)
    kept = (r * factor[1:]) @ sums[:DISCOUNTED] + sums[DISCOUNTED]
    unseen = np.maximum(1 - sums[DISCOUNTED + 1], 1e-300)
    weight = np.log10(np.maximum(1 - kept / np.maximum(total, 1), 1e-12) / unseen)
    return total, np.where(total > 0, weight, 0.0)


def spread_words(model: DataFrame, known: dict) -> tuple[np.ndarray, ...]:
    """Discounts of pairs; numbers of the spread first words, their counts and weights.

    ``model`` has the rows of kind ``first``. There are at most 4 spread words per bucket
    and 512 others, so that few rows come to the driver.
    """
    levels = np.zeros(DISCOUNTED + 2, np.int64)
    names = [f"s{i}" for i in range(DISCOUNTED + 2)]

    def spread(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                first = _unpacked(a)
                sums = _unpacked(b, np.float64).reshape(len(names), len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), *map(pa.array, sums)], ["first", *names]
                )

    def level(batches):
        for batch in batches:
            for c in batch.column("c").to_pylist():
                found = _unpacked(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(found))), pa.array(found)], ["r", "n"]
                )

    rows = model.select("c").mapInArrow(level, "r long, n long")
    for row in rows.groupBy("r").agg(F.sum("n").alias("n")).collect():
        levels[row["r"]] = row["n"]
    levels[0] = 0
    factor = discounts(levels.tolist())
    sums = model.select("a", "b").mapInArrow(
        spread, "first long, " + ", ".join(f"{n} double" for n in names)
    )
    frame = sums.groupBy("first").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    frame = frame.sort_values("first")
    first = frame["first"].to_numpy(np.int64)
    frequent = known["frequent"][_level(known, first)]
    return factor, first, *_weights(frame[names].to_numpy(np.float64).T, factor, frequent)


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Reads ``doc_id, held_out, text``; learns from rows not held out. Null text is empty: one
    token, the end. Repeated rows are scored alike and learned from as often as they occur.
    With nothing to learn from, no word is known. An empty table gives an empty result.
    """
    context = docs.sparkSession.sparkContext
    blocks = staged(_blocks(docs), "lm-blocks")
    entries = blocks.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, -(-entries // BUCKET_WORDS))
    answers = staged(_answered(_asked(blocks, buckets)), "lm-words")
    known = unigrams(answers.filter("kind = 'level'"), buckets)
    shared = context.broadcast(known)
    numbered = blocks.select(
        F.lit(-1).cast("long").alias("bucket"), F.lit("block").alias("kind"), "block",
        F.col("counts").alias("a"), F.col("flags").alias("b"), F.col("tokens").alias("c"),
        F.col("ids").alias("d"),
    ).union(answers.filter("kind = 'number'"))
    counted = staged(_counted(_asked_pairs(numbered, shared), shared), "lm-pairs")
    filled = context.broadcast(spread_words(counted.filter("kind = 'first'"), known))

    def finish(group: pa.Table) -> pa.Table:
        known = shared.value
        factor, spread_first, spread_total, spread_weight = filled.value
        rows = group.to_pylist()
        held = _pairs_of(rows, known)
        pairs, spread, width = held["pairs"], held["spread"], known["size"] + 2
        answers = sorted((r for r in rows if r["kind"] == "count"), key=lambda r: r["bucket"])
        code = np.concatenate([_unpacked(row["a"]) for row in answers])
        sums = np.concatenate(
            [_unpacked(row["b"], np.float64).reshape(DISCOUNTED + 2, -1) for row in answers], axis=1
        )
        n, first = code >> 1, pairs // width
        level = _level(known, first)
        total = (known["history"][level] + (code & 1)).astype(np.float64)
        weight = np.zeros(len(pairs))
        if spread.any():
            at = np.searchsorted(spread_first, first[spread])
            total[spread], weight[spread] = spread_total[at], spread_weight[at]
        rest = np.flatnonzero((n == 0) & ~spread)
        if len(rest):
            runs = _runs(first[rest])
            begins = rest[[begin for begin, _ in runs]]
            _, each = _weights(sums, factor, known["frequent"][level[begins]])
            weight[rest] = np.repeat(each, [end - begin for begin, end in runs])
        factors = np.append(factor, 1.0)[np.minimum(n, DISCOUNTED + 1)]
        score = np.where(
            n > 0,
            np.log10(factors * np.maximum(n, 1) / np.maximum(total, 1)),
            np.log10(known["share"][_level(known, pairs % width)]) + weight,
        )
        counts, number, flags = held["counts"], held["number"], held["flags"]
        doc = np.repeat(np.arange(len(counts)), counts)
        seen = np.bincount(doc, number < known["size"], len(counts)).astype(np.int64)
        return pa.table(
            {
                "doc_id": pa.array(held["ids"], mask=flags < 2),
                "held_out": pa.array(flags % 2 == 1),
                "n_tokens": pa.array(counts),
                "n_known": pa.array(seen),
                "train_tokens": pa.array(np.full(len(counts), known["tokens"])),
                "base_score": pa.array(
                    np.bincount(doc, known["base"][_level(known, number)], len(counts))
                ),
                "score": pa.array(np.bincount(doc, score[held["index"]], len(counts))),
            }
        )

    return (
        numbered.union(counted.filter("kind = 'count'"))
        .groupBy("block")
        .applyInArrow(
            finish,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def op8_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """The log10 probability of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(5) == 1)
    return scored(docs)
