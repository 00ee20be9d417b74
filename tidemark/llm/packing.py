"""Packing by power-of-two decomposition.

A document of L tokens is cut into pieces of the lengths of the binary digits of L, after as
many pieces of the longest length as fit. Each piece is a sequence of its own: no sequence
crosses documents, and none is padded. Sequences are numbered longest first, so that a
block of numbers has one length and can be batched as it is.
"""

from __future__ import annotations

import os
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    LONGEST_RUN,
    byte_letters,
    different_runs,
    frugal,
    spread,
    staged,
    table,
    text_bytes,
)
from tidemark.operators.keys import number_ranges
from tidemark.session import arrow_batches, scratch_path

#: Longest sequence, a power of two.
SEQUENCE = 1024
#: Id that ends each document.
END_ID = 0
#: Bytes of text encoded at a time; with some 40 bytes for each, it bounds the memory of a task.
ENCODED_BYTES = 1 << 20
#: A worker remembers the ids of at most twice so many segments, none of them longer.
REMEMBERED, REMEMBERED_BYTES = 150_000, 64
#: Bytes of rows that Spark hands to a task at a time.
BATCH_BYTES = 1 << 23


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: White space beyond ASCII: the last and first three bytes of its characters, as numbers.
_WIDE = [chr(c).encode() for c in range(0x80, 0x3001) if chr(c).isspace()]
_WIDE_2 = np.array([int.from_bytes(c, "big") for c in _WIDE if len(c) == 2])
_WIDE_3 = np.array([int.from_bytes(c, "big") for c in _WIDE if len(c) == 3])
_NARROW = np.zeros(256, bool)
_NARROW[[i for i in range(128) if chr(i).isspace()]] = True
#: Kinds of ASCII bytes: 1 letter, 2 digit, 3 other sign, 4 apostrophe; 0 the rest.
_KIND = np.zeros(256, np.int8)
for _c in range(33, 127):
    _KIND[_c] = 1 if chr(_c).isalpha() else 2 if chr(_c).isdigit() else 4 if chr(_c) == "'" else 3
#: Segments that the tokenizer gets as one text.
TOGETHER = 64


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where a text may be cut without changing its ids, as one flag per byte.

    The tokenizer begins a new piece at each blank between two other characters, and where
    letters, digits and other signs meet.
    """
    cut = np.zeros(len(data), bool)
    if len(data) < 3:
        return cut
    spaces = _NARROW[data]
    cut[1:-1] = (data[1:-1] == 0x20) & ~spaces[:-2] & ~spaces[2:]
    # A blank beside white space beyond ASCII is part of a longer run.
    beside = np.flatnonzero(cut)
    beside = beside[(data[beside - 1] >= 0x80) | (data[beside + 1] >= 0x80)]
    if len(beside):
        near = np.concatenate([np.zeros(3, np.int64), data, np.zeros(3, np.int64)])
        near = near[beside[:, None] + np.arange(7)]  # three bytes, the blank, three bytes
        two = near << 8
        wide = np.isin((near[:, 1] << 8) + near[:, 2], _WIDE_2)
        wide |= np.isin((near[:, 4] << 8) + near[:, 5], _WIDE_2)
        wide |= np.isin((near[:, 0] << 16) + two[:, 1] + near[:, 2], _WIDE_3)
        wide |= np.isin((near[:, 4] << 16) + two[:, 5] + near[:, 6], _WIDE_3)
        cut[beside[wide]] = False
    kinds = _KIND[data]
    a, b = kinds[:-1], kinds[1:]
    # A piece ends between two kinds. An apostrophe may begin a contraction.
    cut[1:] |= (a != b) & (a > 0) & (a < 4) & (b > 0) & ~((a == 3) & (b == 4))
    return cut


class _Encoder:
    """Ids of texts. Different segments are encoded once, and frequent ones remembered.

    Ids are kept as the machine's 32-bit numbers, which are little-endian.
    """

    def __init__(self, path: str):
        # A task has one core; the library's threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Segments met of late, and those met before them.
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        names = self.tokenizer.get_vocab()
        # A byte-level tokenizer names an id by one character for each of its bytes.
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        self.bytes_of[list(names.values())] = [len(name) for name in names]

    def _encode(self, segments: list[bytes]) -> list[bytes]:
        """Little-endian ids of each segment."""
        found = [self.known.get(segment) or self.before.get(segment) for segment in segments]
        missing = [i for i, raw in enumerate(found) if raw is None]
        new = [segments[i] for i in missing]
        texts = [segment.decode() for segment in new]
        # Behind each other, words with a blank before them are cut as _cuts does.
        is_word = [
            len(t) > 1 and t[0] == " " and not t[1].isspace() and not t[-1].isspace() for t in texts
        ]
        words = [i for i, yes in enumerate(is_word) if yes]
        others = [i for i, yes in enumerate(is_word) if not yes]
        for chosen, together in ((words, TOGETHER), (others, 1)):
            for begin in range(0, len(chosen), 64 * TOGETHER):
                part = chosen[begin : begin + 64 * TOGETHER]
                joined = [
                    "".join([texts[i] for i in part[k : k + together]])
                    for k in range(0, len(part), together)
                ]
                ids = array("I")
                for text in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
                    ids.extend(text.ids)
                # The bytes that ids stand for tell where a segment ends.
                reached = np.cumsum(self.bytes_of[np.frombuffer(ids, np.uint32)])
                ends = np.cumsum([len(new[i]) for i in part])
                last = np.searchsorted(reached, ends) + 1
                if not (reached[last - 1] == ends).all():
                    raise ValueError("The tokenizer joins what should be apart")
                raw, stops = ids.tobytes(), (4 * last).tolist()
                for i, first, stop in zip(part, [0, *stops], stops, strict=False):
                    found[missing[i]] = raw[first:stop]
        self._remember(segments, found)
        return found

    def _remember(self, segments: list[bytes], found: list[bytes]) -> None:
        """Keep what was met now; what has not been met for long is forgotten."""
        for segment, raw in zip(segments, found, strict=True):
            if len(segment) <= REMEMBERED_BYTES:
                if len(self.known) >= REMEMBERED:
                    self.before, self.known = self.known, {}
                self.known[segment] = raw

    def __call__(self, column: pa.Array) -> list[bytes]:
        """Little-endian ids of each text of a string column (null: empty)."""
        data, bounds = text_bytes(column)
        parts, counts = [], np.zeros(len(column), np.int64)
        begin, window = 0, ENCODED_BYTES
        while begin < len(data):
            end = min(begin + window, len(data))
            flags = _cuts(data[begin : end + 3])[: end - begin]
            flags[bounds[(bounds >= begin) & (bounds < end)] - begin] = True
            flags[0] = True
            cut = np.flatnonzero(flags)
            if end < len(data):
                if len(cut) == 1:  # no end of the segment in sight
                    window *= 2
                    continue
                end, cut = begin + int(cut[-1]), cut[:-1]
            ids, count = self._run(data[begin:end], cut)
            parts.append(ids)
            np.add.at(counts, np.searchsorted(bounds, begin + cut, "right") - 1, count)
            begin, window = end, ENCODED_BYTES
        ids = np.concatenate(parts or [np.zeros(0, "<u4")])
        ends = np.cumsum(counts)
        return [ids[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)]

    def _run(self, data: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(cut, append=len(data))
        short = size <= LONGEST_RUN
        flat = data[np.repeat(short, size)]
        start = np.cumsum(size[short]) - size[short]
        first, which = different_runs(flat, byte_letters(flat), start, size[short])
        begins = np.concatenate([cut[short][first], cut[~short]])
        ends = begins + np.concatenate([size[short][first], size[~short]])
        raw = data.tobytes()
        found = self._encode([raw[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)])
        total = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        segment = np.zeros(len(cut), np.int64)
        segment[short], segment[~short] = which, len(first) + np.arange(int((~short).sum()))
        count = total[segment]
        return ids[spread((np.cumsum(total) - total)[segment], count)], count


def _encoder(path: str) -> _Encoder:
    """The worker's encoder; it outlives the task."""
    held = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))
    if getattr(held, "path", None) != path:
        held.path, held.encoder = path, _Encoder(path)
    return held.encoder


def pieces(size: int, longest: int) -> list[int]:
    """Lengths of the pieces of a document: whole ones, then powers of two, falling."""
    whole, rest = divmod(size, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut_documents(docs: DataFrame, path: str | None = None, longest: int = SEQUENCE) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids`` per piece; ``ids`` are 32-bit little-endian.

    Reads ``doc_id, text``. Null text is empty, and an empty text has the end id alone. A
    text longer than ``ENCODED_BYTES`` is encoded in parts; its pieces are the same. ``path``
    names a byte-level tokenizer that begins pieces where :func:`_cuts` says.
    """
    path = path or tokenizer_path()

    @frugal
    def cut(batches):
        encode = _encoder(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                row, start, length, total, ids = [], [], [], [], []
                for i, raw in enumerate(encode(part.column("text"))):
                    raw += END_ID.to_bytes(4, "little")
                    at = 0
                    for size in pieces(len(raw) // 4, longest):
                        row.append(i)
                        start.append(at)
                        length.append(size)
                        total.append(len(raw) // 4)
                        ids.append(raw[4 * at : 4 * (at + size)])
                        at += size
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(row, pa.int64())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(total, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary"
    )


def packed(docs: DataFrame, path: str | None = None, longest: int = SEQUENCE) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset`` per piece.

    The narrow plan of the packing: each piece is a sequence, at offset 0 and without
    padding, and ``ids_crc32`` tells which ids it holds. :func:`cut_documents` gives the
    ids themselves. Repeated rows get sequences of their own. Documents without id are
    packed like others. An empty table gives an empty result.
    """
    narrow = cut_documents(docs, path, longest).select(
        "doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32")
    )
    order = [F.col("length").desc(), F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    # Written first: range partitioning reads its input twice.
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        written = staged(narrow, "pieces")
    numbered = number_ranges(
        written, "sequence_id", order, scratch_path(docs.sparkSession, "packed"), 0
    )
    return numbered.withColumn("offset", F.lit(0).cast("bigint"))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of powers of two."""
    return packed(table(spark, sf_dir, "documents"))
