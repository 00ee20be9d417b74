"""Language identification by n-gram filters whose slots are language bitmasks.

Each language's frequent n-grams (four bytes of the lower-cased text, runs of everything
but letters read as one blank) go into one bit-sliced Bloom filter: a slot is a mask of 64
languages, and an n-gram sets its language's bit in ``PROBES`` slots. One look-up, the AND of
the slots, gives all languages that have an n-gram. A language's score is its count of
n-grams, corrected for the false positives expected from how full its bit is.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import CHUNK_BYTES, mix, table, text_bytes

#: Slots of the filter (8 MB for each 64 languages), and slots read per n-gram.
SLOTS, PROBES = 1 << 20, 3
#: An n-gram is learned if it makes up this share of its language's n-grams, and comes twice
#: where that share is more than one n-gram. A language always learns its most frequent ones.
LEAST_SHARE = 2e-5

# Letters and bytes of other scripts stay; all other ASCII is a blank.
_CLEAN = np.full(256, 0x20, np.uint8)
_CLEAN[0x80:] = np.arange(0x80, 0x100)
_CLEAN[0x61:0x7B] = np.arange(0x61, 0x7B)


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of every n-gram of the texts; a code is the four bytes themselves."""
    joined = pa.array([f"  {text.lower()}  " for text in texts], pa.large_string())
    data, bounds = text_bytes(joined)
    clean = _CLEAN[data]
    keep = np.ones(len(clean), bool)
    keep[1:] = (clean[1:] != 0x20) | (clean[:-1] != 0x20)
    keep[bounds[:-1]] = True
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))[keep]
    clean = clean[keep].astype(np.uint32)
    if len(clean) < 4:
        return row[:0], clean[:0]
    code = clean[:-3] << 24 | clean[1:-2] << 16 | clean[2:-1] << 8 | clean[3:]
    inside = row[:-3] == row[3:]
    # At most one blank in a row by now, so three letters or more are in each but "x y ".
    return row[:-3][inside], code[inside]


def _parts(texts: list[str]):
    """Rows in groups of bounded size."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held > CHUNK_BYTES:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """``lang, code, n`` over all rows of ``docs`` (``text, lang``), summed within tasks first."""

    def count(batches):
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            langs = np.array(batch.column("lang").to_pylist(), object)
            names, which = np.unique(langs.astype(str), return_inverse=True)
            for number, name in enumerate(names):
                mine = [texts[i] for i in np.flatnonzero(which == number)]
                for begin, end in _parts(mine):
                    code, n = np.unique(ngrams(mine[begin:end])[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(code), pa.string()),
                            pa.array(code.astype(np.int64)),
                            pa.array(n.astype(np.int64)),
                        ],
                        ["lang", "code", "n"],
                    )

    rows = docs.select("text", "lang").mapInArrow(count, "lang string, code long, n long")
    return rows.groupBy("lang", "code").agg(F.sum("n").alias("n"))


class LanguageFilter:
    """The filter, and what is needed to read it. Its size depends on the languages alone."""

    def __init__(self, languages: list[str], planes: np.ndarray | None = None):
        self.languages = languages
        if planes is None:
            planes = np.zeros((-(-len(languages) // 64) or 1, SLOTS), np.uint64)
        self.planes = planes

    @staticmethod
    def slots(codes: np.ndarray) -> list[np.ndarray]:
        hashed = mix(codes.astype(np.uint64) + np.uint64(1))
        return [(hashed >> np.uint64(20 * i)) & np.uint64(SLOTS - 1) for i in range(PROBES)]

    def add(self, language: int, codes: np.ndarray) -> None:
        plane, bit = self.planes[language // 64], np.uint64(1 << (language % 64))
        for slot in self.slots(codes):
            plane[slot] |= bit

    @cached_property
    def wrong(self) -> np.ndarray:
        """Share of foreign n-grams that each language is expected to accept."""
        full = [
            np.mean(self.planes[i // 64] >> np.uint64(i % 64) & np.uint64(1) == 1)
            for i in range(len(self.languages))
        ]
        return np.array(full) ** PROBES

    def counts(self, rows: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
        """N-grams of each row that each language accepts, corrected."""
        total = np.bincount(rows, minlength=size).astype(float)
        found = np.zeros((size, len(self.languages)))
        value, where = np.unique(codes, return_inverse=True)
        slots = self.slots(value)
        for i, plane in enumerate(self.planes):
            mask = plane[slots[0]]
            for slot in slots[1:]:
                mask = mask & plane[slot]
            for j in range(64 * i, min(64 * i + 64, len(self.languages))):
                has = (mask >> np.uint64(j % 64) & np.uint64(1)).astype(float)
                found[:, j] = np.bincount(rows, has[where], size)
        wrong = self.wrong
        fixed = (found - total[:, None] * wrong) / np.maximum(1 - wrong, 1e-9)
        return np.clip(fixed, 0, total[:, None])


def learn(docs: DataFrame) -> LanguageFilter:
    """The filter of all languages in ``docs`` (``text, lang``, rows without ``lang`` left out).

    Counts cover every row. The n-grams that come to the driver are those that make up
    ``LEAST_SHARE`` of a language, so at most ``1 / LEAST_SHARE`` of each; of a language that
    has none, those that come most. So every language with an n-gram is in the filter.
    """
    counts = count_ngrams(docs.filter(F.col("lang").isNotNull()))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.max("n").alias("most"))
    share = LEAST_SHARE * F.col("total")
    least = F.when(share > 1, F.greatest(F.lit(2), share)).otherwise(1)
    kept = (
        counts.join(totals, "lang")
        .filter(F.col("n") >= F.least(least, F.col("most")))
        .select("lang", "code")
        .toPandas()
    )
    model = LanguageFilter(sorted(kept["lang"].unique()))
    for i, name in enumerate(model.languages):
        model.add(i, kept["code"][kept["lang"] == name].to_numpy(np.uint32))
    return model


def predicted(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs`` (``doc_id, held_out, text``).

    ``score`` is the share of the winner among the corrected counts of all languages.
    Texts that are null or have no letter are ``und`` with score 0; so are all, if no
    language was learned. Ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.planes))

    def predict(batches):
        model = LanguageFilter(*shared.value)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            names, scores = [], []
            for begin, end in _parts(texts):
                part = texts[begin:end]
                if model.languages:
                    counts = model.counts(*ngrams(part), len(part))
                else:
                    counts = np.zeros((len(part), 1))
                best = counts.argmax(axis=1)
                total = counts.sum(axis=1)
                share = counts.max(axis=1) / np.where(total > 0, total, 1)
                for text, i, score in zip(part, best, share.tolist(), strict=True):
                    known = model.languages and any(map(str.isalpha, text))
                    names.append(model.languages[i] if known else "und")
                    scores.append(score if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def fold(parts: int) -> Column:
    """The fold of a document, from 0; documents without id are in fold 0."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.when(F.col("doc_id").isNull(), 0).otherwise(F.crc32(name.cast("binary")) % parts)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(4) == 2)
    model = learn(docs.filter("not held_out").select("text", "lang"))
    return predicted(docs, model)
