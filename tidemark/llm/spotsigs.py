"""SpotSigs fingerprints: chains of content words behind common-word anchors.

Wherever a text has an anchor (a common function word), the next ``CHAIN`` words that are no
anchors make a signature with it. The fingerprint is the sorted set of 32-bit signature
hashes, written in base64. Likeness is the Jaccard similarity of two sets. Set lengths fall
into geometric partitions: sets whose lengths differ by more than the threshold allows lie in
partitions that are never compared, and inside the rest a pair is dropped as soon as its
lengths rule it out.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, staged, table, windows, word_hashes
from tidemark.llm.lexicon import COMMON_WORDS

#: Content words of a signature.
CHAIN = 2
#: Bytes of text per bucket of neighbours, and most buckets.
BUCKET_BYTES, MOST_BUCKETS = 1 << 21, 20_000

_ANCHORS = np.sort(next(iter(word_hashes(pa.array([" ".join(COMMON_WORDS)]))))[2])


def signatures(hashes: np.ndarray) -> np.ndarray:
    """Sorted signature hashes of a text, given its word hashes.

    A text without any signature has its whole word sequence as one, and none if it has no
    words.
    """
    at = np.minimum(np.searchsorted(_ANCHORS, hashes), len(_ANCHORS) - 1)
    is_anchor = _ANCHORS[at] == hashes
    content = np.flatnonzero(~is_anchor)
    anchors = np.flatnonzero(is_anchor)
    next_word = np.searchsorted(content, anchors)
    whole = next_word + CHAIN <= len(content)
    anchors, next_word = anchors[whole], next_word[whole]
    if not len(anchors):
        found = windows(hashes, len(hashes))
    else:
        found = hashes[anchors]
        for i in range(CHAIN):
            found = mix(found) + hashes[content[next_word + i]]
        found = mix(found)
    return np.unique((found >> np.uint64(32)).astype(np.uint32))


def encoded(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity; two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def length_partition(size: int, threshold: float) -> int:
    """Partition of a set length; sets at least ``threshold`` alike are at most one apart."""
    return int(np.floor(np.log(size) / -np.log(threshold))) if size else -1


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    found = []
    for _, counts, hashes in word_hashes(pa.array(texts, pa.large_string())):
        ends = np.cumsum(counts)
        for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
            found.append(signatures(hashes[end - count : end]))
    return found


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as many characters from the start of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bounds(docs: DataFrame) -> np.ndarray:
    """Ids, falling, at which the buckets of a descending order begin."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = int(min(MOST_BUCKETS, max(1, -(-size // BUCKET_BYTES))))
    shares = [F.lit(i / buckets) for i in range(1, buckets + 1)]
    found = docs.agg(
        F.percentile_approx("doc_id", F.array(*shares), 10 * MOST_BUCKETS).alias("ids"),
        F.max("doc_id").alias("last"),
    ).first()
    if found["last"] is None:
        return np.zeros(0, np.int64)
    return np.unique([*(found["ids"] or []), found["last"]])[::-1].astype(np.int64)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` sorted in buckets by falling id, each followed by the row after it.

    The rows that begin a bucket also go to the bucket before it (the very first to the
    last one), marked ``ahead``. Null ids come last, equal ids by text.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = docs.sparkSession.sparkContext.broadcast(_bounds(docs))

    def deal(batches):
        tops = bounds.value
        count = max(1, len(tops))
        for batch in batches:
            ids = batch.column("doc_id")
            value = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            # The last bucket whose first id is not below this one.
            bucket = np.searchsorted(-tops, -value, "right") - 1
            bucket = np.where(known, np.maximum(bucket, 0), count - 1)
            first = known & (tops[bucket] == value) if len(tops) else np.zeros(len(value), bool)
            again = np.flatnonzero(first)
            row = pa.array(np.concatenate([np.arange(len(value)), again]))
            to = np.concatenate([bucket, (bucket[again] - 1) % count])
            ahead = np.concatenate([np.zeros(len(value), bool), np.ones(len(again), bool)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(to),
                    pa.array(ahead),
                    ids.take(row),
                    batch.column("text").take(row),
                ],
                ["bucket", "ahead", "doc_id", "text"],
            )

    buckets = max(1, len(bounds.value))
    return (
        docs.mapInArrow(deal, "bucket long, ahead boolean, doc_id long, text string")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "ahead", F.col("doc_id").desc_nulls_last(), "text")
    )


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
    texts = [row[1] for row in rows]
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    own, new = fingerprints(texts), fingerprints(changed)
    # The next text is mostly the next row's own.
    last = fingerprints(following[-1:])
    ahead = [
        own[i + 1] if i + 1 < len(rows) and following[i] == texts[i + 1] else None
        for i in range(len(rows))
    ]
    ahead[-1] = last[0]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row[0] for row in rows], pa.int64()),
            pa.array(map(len, texts), pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
            pa.array(map(encoded, own), pa.string()),
            pa.array(map(encoded, new), pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, new, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, ahead, strict=True)], pa.float64()),
        ],
        [part.split()[0] for part in _RESULT.split(", ")],
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Reads ``doc_id`` (integer) and ``text``. Null text is empty; an empty text has an empty
    fingerprint, which is like another empty one only. Repeated rows follow each other. A
    single row is its own next one. An empty table gives an empty result.
    """

    def compare(batches):
        bucket, held, first = None, [], None  # rows of this bucket not yet written
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "text")]
            for at, ahead, doc_id, text in zip(*columns, strict=True):
                if at != bucket:
                    if held:
                        yield _flush(held, first)
                    bucket, held, first = at, [], text
                if ahead:
                    if held:
                        yield _flush(held, text)
                        held = []
                    continue
                held.append((doc_id, text))
                if len(held) > 256:
                    yield _compared(held[:-1], [row[1] for row in held[1:]])
                    held = held[-1:]
        if held:
            yield _flush(held, first)

    def _flush(held, following):
        return _compared(held, [*(row[1] for row in held[1:]), following])

    return with_next(docs).mapInArrow(compare, _RESULT)


def similar_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``a, b, likeness``: pairs of distinct fingerprints that are at least ``threshold`` alike.

    ``a`` and ``b`` are the smallest ids of the texts that have the fingerprint. Sets meet
    on the signatures of their prefixes, and only within partitions of fitting length. Texts
    without signatures are in no pair.
    """

    def sign(batches):
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            sets = fingerprints(texts)
            sizes = [len(x) for x in sets]
            prefix = [x[: len(x) - int(np.ceil(threshold * len(x))) + 1] for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x.astype(np.int64).tolist() for x in sets], pa.list_(pa.int64())),
                    pa.array([x.astype(np.int64).tolist() for x in prefix], pa.list_(pa.int64())),
                    pa.array([length_partition(n, threshold) for n in sizes], pa.int64()),
                ],
                ["doc_id", "sigs", "prefix", "part"],
            )

    signed = docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, sigs array<long>, prefix array<long>, part long"
    )
    one = staged(
        signed.filter("part >= 0")
        .groupBy("sigs")
        .agg(F.min("doc_id").alias("id"), F.first("prefix").alias("prefix"), F.first("part").alias("part")),
        "spotsigs",
    )
    entries = one.select("id", "part", F.size("sigs").alias("n"), F.explode("prefix").alias("sig"))
    near = entries.withColumn("part", F.explode(F.array(F.col("part") - 1, "part", F.col("part") + 1)))
    a = entries.select("sig", "part", F.col("id").alias("a"), F.col("n").alias("n_a"))
    b = near.select("sig", "part", F.col("id").alias("b"), F.col("n").alias("n_b"))
    fits = F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    pairs = a.join(b, ["sig", "part"]).filter((F.col("a") < F.col("b")) & fits)
    pairs = pairs.select("a", "b").distinct()
    sets = one.select("id", "sigs")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("sigs").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("sigs").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    value = common / (F.size("x") + F.size("y") - common)
    return both.select("a", "b", value.alias("likeness")).filter(F.col("likeness") >= threshold)


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edit with the next document."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
