"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of each text; a chunk ends where the hash is least among
its neighbours. Borders depend on nearby bytes alone, so an insertion moves the borders next
to it and no others, and a passage copied into another text falls into the same chunks
there. From each border a window runs over whole chunks until it has ``LEAST_RUN`` bytes;
windows are compared by a 128-bit digest. The first occurrence (smallest id, then position)
stays, and what a later one covers goes. So every cut byte lies in an exact repeat of
``LEAST_RUN`` bytes or more, and chunks that are common one by one cut nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    bitmap_of,
    byte_letters,
    fresh,
    frugal,
    in_bitmap,
    mix,
    staged,
    table,
    text_bytes,
)

#: A border has the least hash of the REACH places before and after it. A chunk without
#: such a place ends after MOST bytes.
REACH, MOST = 20, 256
#: A repeated passage counts from so many bytes on.
LEAST_RUN = 120

_U64 = np.uint64
_GEAR = np.random.default_rng(7).integers(0, 1 << 16, 256, dtype=np.uint16)
#: Bytes that the hash of one place depends on: each step shifts one of 16 bits out.
_ROLL = 16
_NEVER = np.uint16(0xFFFF)
#: Texts are taken together up to so many bytes; longer ones are searched in such parts.
_PART = 1 << 20
# Odd factors of the polynomial hashes, two lanes for bytes and two for chunks.
_BYTE_BASES = (_U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F))
_CHUNK_BASES = (_U64(0xD6E8FEB86659FD93), _U64(0xA0761D6478BD642F))
_POWERS = [np.cumprod(np.full(MOST + 1, base)) for base in _BYTE_BASES]


def _least_places(data: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Places where the rolling hash is least within REACH; ``open_`` tells the allowed ones."""
    roll = _GEAR[data]
    for width in (1, 2, 4, 8):  # h(i) = sum of gear(i - k) << k, by doubling
        older = np.zeros_like(roll)
        older[width:] = roll[:-width]
        roll = roll + (older << np.uint16(width))
    roll[~open_] = _NEVER
    edge = np.full(REACH, _NEVER)
    least = np.concatenate([edge, roll, edge])
    size = 1
    while 2 * size <= REACH:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(least) - (REACH - size)], least[REACH - size :])
    n = len(roll)
    return np.flatnonzero((roll < least[:n]) & (roll <= least[REACH + 1 : REACH + 1 + n]))


def _borders(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of adjacent texts, the texts' ends included."""
    n = len(data)
    open_ = np.ones(n, bool)
    open_[:-1] = (data[1:] & 0xC0) != 0x80  # never inside a character
    open_[bounds[1:][bounds[1:] > 0] - 1] = False
    pad = _ROLL + REACH
    found = [bounds[1:][np.diff(bounds) > 0]]
    if len(bounds) > 2 or n <= 2 * _PART:
        # Gaps between texts keep each one's hashes apart from its neighbours.
        place = np.arange(n) + np.repeat(np.arange(1, len(bounds)) * pad, np.diff(bounds))
        wide = np.zeros(n + pad * len(bounds), np.uint8)
        wide[place] = data
        allowed = np.zeros(len(wide), bool)
        allowed[place] = open_
        at = _least_places(wide, allowed)
        found.append(np.searchsorted(place, at) + 1)
    else:
        for begin in range(0, n, _PART):
            low, high = max(0, begin - pad), min(n, begin + _PART + REACH)
            part, allowed = data[low:high], open_[low:high]
            if not low:  # as behind the gap above
                part = np.concatenate([np.zeros(pad, np.uint8), part])
                allowed = np.concatenate([np.zeros(pad, bool), allowed])
                low = -pad
            at = _least_places(part, allowed) + low
            found.append(at[(at >= begin) & (at < begin + _PART)] + 1)
    ends = np.unique(np.concatenate(found))
    begins = np.concatenate([[0], ends[:-1]])
    forced = []
    for i in np.flatnonzero(ends - begins > MOST).tolist():
        last, end = int(begins[i]), int(ends[i])
        while end - last > MOST:
            cut = last + MOST
            while cut > last + 1 and (data[cut] & 0xC0) == 0x80:
                cut -= 1
            forced.append(cut)
            last = cut
    return np.union1d(ends, np.array(forced, np.int64)) if forced else ends


def _chunk_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two hashes of every chunk; chunks follow each other without gaps."""
    lanes: list[list[np.ndarray]] = [[], []]
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, begins[first] + _PART, "right")))
        low, size = begins[first], ends[first:last] - begins[first:last]
        letters = byte_letters(data[low : ends[last - 1]])
        within = np.arange(len(letters)) - np.repeat(begins[first:last] - low, size)
        for lane, powers in zip(lanes, _POWERS, strict=True):
            sums = np.add.reduceat(letters * powers[within], begins[first:last] - low)
            lane.append(mix(sums + size.astype(_U64)))
        first = last
    return [np.concatenate(lane) for lane in lanes]


def _windows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, begin, end and digest (two numbers) of the window at every border of every text."""
    data, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + _PART, "right")) - 1)
        part, own = data[bounds[row] : bounds[last]], bounds[row : last + 1] - bounds[row]
        if len(part) >= LEAST_RUN:
            ends = _borders(part, own)
            begins = np.concatenate([[0], ends[:-1]])
            text = np.searchsorted(own, begins, "right") - 1
            stop = np.searchsorted(ends, begins + LEAST_RUN)
            whole = np.flatnonzero(stop < len(ends))
            whole = whole[text[stop[whole]] == text[whole]]
            stop = stop[whole]
            digest = np.empty((len(whole), 2), _U64)
            for lane, (hashes, base) in enumerate(
                zip(_chunk_hashes(part, begins, ends), _CHUNK_BASES, strict=True)
            ):
                inverse = _U64(pow(int(base), -1, 1 << 64))
                power = np.cumprod(np.full(len(ends), base))
                total = np.concatenate([[_U64(0)], np.cumsum(hashes * power)])
                back = np.cumprod(np.full(len(ends), inverse))
                sums = (total[stop + 1] - total[whole]) * back[whole]
                digest[:, lane] = mix(sums + (stop - whole).astype(_U64))
            yield row + text[whole], begins[whole] - own[text[whole]], ends[stop] - own[text[whole]], digest
        row = last


def windowed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, begin, end, digest`` of all windows, in bytes."""

    @frugal
    def cut(batches):
        for batch in batches:
            for row, begin, end, digest in _windows(batch.column("text")):
                at = pa.array(row, pa.int64())
                borders = pa.array(np.arange(len(row) + 1, dtype=np.int32) * 16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at),
                        batch.column("text_key").take(at),
                        pa.array(begin, pa.int64()),
                        pa.array(end, pa.int64()),
                        pa.BinaryArray.from_buffers(
                            pa.binary(), len(row), [None, borders.buffers()[1], pa.py_buffer(digest.tobytes())]
                        ),
                    ],
                    ["doc_id", "text_key", "begin", "end", "digest"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        cut, f"doc_id {kind}, text_key long, begin long, end long, digest binary"
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans``: byte ranges of texts that repeat earlier windows.

    ``spans`` is a sorted array of ``begin, end``; texts with none have no row. Texts are
    hashed twice rather than their windows kept on disk; ``docs`` should be cheap to read.
    """
    rows = windowed(docs)
    place = F.struct("doc_id", "text_key", "begin")
    first = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    first = staged(first.filter("n > 1").select("digest", "first"), "repeated")
    key = F.xxhash64("digest").alias("key")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(first.select(key), "key"))

    @frugal
    def possible(batches):
        for batch in batches:
            kept = in_bitmap(bitmap.value, batch.column("key").to_numpy())
            yield batch.filter(pa.array(kept))

    # Most windows are unique and need no second shuffle.
    keyed = rows.select("*", key)
    some = keyed.mapInArrow(possible, keyed.schema).drop("key")
    later = some.join(first, "digest").filter(place != F.col("first"))
    # Hot digests are spread again: rows meet by text, not by digest.
    spans = later.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans")
    )
    return spans


def _joined(spans: list[dict]) -> list[tuple[int, int]]:
    """The spans without overlaps; those that meet are one run."""
    runs: list[list[int]] = []
    for span in spans:
        if runs and runs[-1][1] >= span["begin"]:
            runs[-1][1] = max(runs[-1][1], span["end"])
        else:
            runs.append([span["begin"], span["end"]])
    return [(a, b) for a, b in runs]


def _cut(raw: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without its runs, each narrowed to whole words where it has white space."""
    kept, last, cuts = [], 0, []
    for begin, end in runs:
        piece = raw[begin:end]
        if begin and not raw[begin - 1 : begin].isspace() and not piece[:1].isspace():
            words = piece.split(None, 1)
            begin = end - len(words[1]) if len(words) > 1 else begin
        if end < len(raw) and not raw[end : end + 1].isspace() and not raw[end - 1 : end].isspace():
            words = raw[begin:end].rsplit(None, 1)
            end = begin + len(words[0]) if len(words) > 1 else end
        kept.append(raw[last:begin])
        last = end
        cuts.append((begin, end))
    return b"".join([*kept, raw[last:]]), cuts


def deduplicated(docs: DataFrame, cuts: str = "cut_spans") -> DataFrame:
    """The rows of ``docs`` with repeated passages cut from ``text``, and ``cut_spans``.

    ``cut_spans`` (or the name ``cuts``, which replaces a column of that name) are the byte
    ranges taken out, an empty array for untouched texts. Null texts and those shorter than
    ``LEAST_RUN`` have no windows and stay as they are. Rows that repeat both id and text
    are one place, so they keep their text alike; exact copies under other ids lose theirs
    (an empty text). A text that repeats itself keeps the first occurrence up to where the
    second begins. Rows without id come first. Texts of any length are cut whole, searched
    in parts. Other columns are passed through, whatever their names. An empty table gives
    an empty result.
    """
    docs = docs.select(*(c for c in docs.columns if c.lower() != cuts.lower()))
    names = docs.columns
    own_id, own_key, key, found = fresh(docs, "_id", "_key", "_text_key", "_spans")
    spans = repeated_spans(docs).select(
        F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), F.col("spans").alias(found)
    )
    joined = docs.withColumn(key, F.xxhash64("text")).join(
        spans,
        F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)),
        "left",
    )
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    @frugal
    def clean(batches):
        for batch in batches:
            texts, taken = [], []
            for text, spans in zip(
                batch.column("text").to_pylist(), batch.column(found).to_pylist(), strict=True
            ):
                runs = _joined(spans) if spans else []
                if runs:
                    raw, runs = _cut(text.encode(), runs)
                    text = raw.decode()
                texts.append(text)
                taken.append([{"begin": a, "end": b} for a, b in runs])
            columns = [
                pa.array(texts, pa.string()) if name == "text" else batch.column(name)
                for name in names
            ]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(taken, span)], [*names, cuts])

    schema = docs.withColumn(
        cuts, F.lit(None).cast("array<struct<begin:bigint,end:bigint>>")
    ).schema
    return joined.select(*names, found).mapInArrow(clean, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` after :func:`deduplicated`, without texts that lost every word."""
    (cuts,) = fresh(docs, "_cuts")
    found = deduplicated(docs, cuts)
    emptied = (F.size(cuts) > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return found.filter(~emptied).select(*docs.columns)


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one holds."""
    found = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    size = F.aggregate("cut_spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["begin"])
    return found.select("doc_id", "text", "cut_spans", size.alias("cut_bytes"))
