"""What several corpus operators share: tables, staging, and word hashing on Arrow strings.

A *word* is a maximal run of characters other than blank and U+0009 to U+000D. Hashes are
64 bits wide, the same in every process, and computed with numpy over whole Arrow batches.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import prepare, scratch_path
from tidemark.sources.folders import remove

#: White space between words, as a character class for Java's and DuckDB's patterns.
BLANKS = r"[\x20\x09-\x0D]+"
#: Bytes hashed at a time; bounds the memory of a task whatever the length of its texts.
CHUNK_BYTES = 1 << 21

_U64 = np.uint64
_random = np.random.default_rng(20240611)
_LETTER = _random.integers(1, 1 << 63, 256, dtype=_U64) | _U64(1)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]
_CASED = _random.integers(1, 1 << 63, 256, dtype=_U64) | _U64(1)
_BASE = _U64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written below the shared scratch folder and read back.

    Cuts the lineage, survives lost executors, and gives Spark file sizes to plan joins by.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    read = frame.sparkSession.read.schema(frame.schema).parquet(path)
    read.staged_at = path
    return read


def forget(*frames: DataFrame | None) -> None:
    """Remove what :func:`staged` has written. No later plan may read these frames."""
    for frame in frames:
        if frame is not None:
            remove(frame.sparkSession, frame.staged_at)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the frame has such a column in any case."""
    taken = {column.lower() for column in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def spaced(text: Column) -> Column:
    """The text with every kind of white space as a blank; byte searches, no pattern."""
    text = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    return F.array_remove(F.split(spaced(text), " "), "")


def frugal(
    task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task; at its end the worker gives memory that it has freed back to the system.

    A worker waits for its next task, and what it keeps until then counts as its executor's.
    """

    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        give_back()

    return run


def give_back() -> None:
    """Return freed memory to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    values = values ^ (values >> _U64(32))
    values = values * _U64(0xD6E8FEB86659FD93)
    values = values ^ (values >> _U64(29))
    values = values * _U64(0xC2B2AE3D27D4EB4F)
    return values ^ (values >> _U64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty), and the n + 1 offsets of its texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    base, end = int(bounds[0]), int(bounds[-1])
    if data is None or end == base:
        return np.zeros(0, np.uint8), bounds - base
    return np.frombuffer(data, np.uint8, end - base, base), bounds - base


def _hashed(data: np.ndarray, starts: np.ndarray, cased: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words in ``data``; a word ends at each of ``starts``."""
    inside = ~_BLANK[data]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, _U64), at
    opens = np.ones(len(data), bool)
    opens[1:] = ~inside[:-1]
    opens[starts[starts < len(data)]] = True
    first = np.flatnonzero(opens[at])
    position = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
    power = np.cumprod(np.full(int(position.max()) + 1, _BASE))
    letters = (_CASED if cased else _LETTER)[data[at]] * power[position]
    return mix(np.add.reduceat(letters, first)), at[first]


def word_hashes(
    column: pa.Array, cased: bool = False
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per run of rows: its first row, its word counts by row, and its word hashes in order.

    Hashes ignore the case of A-Z unless ``cased``. A run holds about ``CHUNK_BYTES``; a
    longer text is hashed in parts cut at white space, and is a run of its own.
    """
    data, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, "right")) - 1)
        part, starts = data[bounds[row] : bounds[last]], bounds[row : last + 1] - bounds[row]
        if len(part) <= 2 * CHUNK_BYTES:
            hashes, first = _hashed(part, starts[:-1], cased)
            yield row, np.diff(np.searchsorted(first, starts)), hashes
        else:
            hashes = np.concatenate(
                [_hashed(piece, starts[:0], cased)[0] for piece in _pieces(part)]
            )
            yield row, np.array([len(hashes)]), hashes
        row = last


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts that end at white space, or where it has none, at its end."""
    begin = 0
    while begin < len(data):
        end = begin + CHUNK_BYTES
        while end < len(data) and not _BLANK[data[end]]:
            ahead = np.flatnonzero(_BLANK[data[end : end + CHUNK_BYTES]])
            end += int(ahead[0]) if len(ahead) else CHUNK_BYTES
        yield data[begin:end]
        begin = end


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, or of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    total = np.full(len(hashes) - size + 1, _U64(size))
    for i in range(size):
        total = mix(total) + hashes[i : len(hashes) - size + 1 + i]
    return mix(total)


#: Longest run that :func:`different_runs` compares by hash.
LONGEST_RUN = 256


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each run, ``count`` of them."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def different_runs(
    values: np.ndarray, letters: np.ndarray, start: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """One of each different run of ``values``, and for each run which that is.

    Runs follow each other without gaps and have 1 to ``LONGEST_RUN`` values; ``letters``
    holds a 64-bit hash of each value. Runs of one hash are compared value by value.
    """
    if not len(size):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    within = np.arange(len(values)) - np.repeat(start, size)
    salt = _BASE
    while True:
        power = np.cumprod(np.full(LONGEST_RUN + 1, salt))
        hashes = mix(np.add.reduceat(letters * power[within], start) + size.astype(_U64))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if (size[first[which]] == size).all():
            own = np.repeat(start[first[which]], size) + within
            if (values[own] == values).all():
                return first, which
        salt = mix(np.array([salt], _U64))[0] | _U64(1)


def byte_letters(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte."""
    return _CASED[data]


#: Bits of a membership bitmap: 4 MB, whatever the number of values.
BITMAP_BITS = 1 << 25


def bitmap_of(values: DataFrame, column: str) -> bytes:
    """A bitmap of fixed size with a bit set for each value's low bits.

    It only spares work: where it says no, the value is absent; every yes is checked by a
    join later. The values are folded into 1,024 rows by the executors.
    """
    bit = F.col(column).bitwiseAND(F.lit(BITMAP_BITS - 1))
    parts = (
        values.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 15).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
        .collect()
    )
    whole = bytearray(BITMAP_BITS // 8)
    for row in parts:
        whole[row["part"] << 12 : (row["part"] + 1) << 12] = row["bits"]
    return bytes(whole)


def in_bitmap(bitmap: bytes, values: np.ndarray) -> np.ndarray:
    bit = values.view(_U64) & _U64(BITMAP_BITS - 1)
    held = np.frombuffer(bitmap, np.uint8)[(bit >> _U64(3)).astype(np.int64)]
    return (held >> (bit & _U64(7)).astype(np.uint8)) & np.uint8(1) == 1


def star_step(edges: DataFrame) -> DataFrame:
    """Edges ``u > v`` with the same components, drawn nearer to the least nodes.

    A large-star and a small-star step. Minimums combine before they are shuffled, and
    joins on a hub are split by the skew join.
    """
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    edges = (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u > v")
        .distinct()
    )
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .filter("u > v")
        .distinct()
    )


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``): the least node reached.

    Repeats :func:`star_step` until the edges stand still.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v")
        .distinct(),
        label,
    )
    while True:
        before, edges = edges, staged(star_step(edges), label)
        forget(before)
        # Done when all edges lead to a node that leads nowhere itself, one from each node.
        chained = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        forked = edges.groupBy("u").count().filter("count > 1")
        if chained.isEmpty() and forked.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
