"""Mixing sources to target weights by capped water-filling.

Each source has a weight and may be repeated at most ``max_epochs`` times. The budget is
poured by weight; a source that would run over its cap is clamped to it, and what it can't
take is poured again over the others, until none runs over. The level only rises, so each
round is one aggregate over the per-source table and carries a single number.

A source with 2.3 epochs gives each document two whole repetitions, and a third one to
documents in the order of a seeded hash, up to the one that brings the source nearest to
its target. The cut is found by histograms of that hash, so no source is sorted whole.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, staged, table, words_of
from tidemark.operators.keys import number_ranges
from tidemark.session import scratch_path

#: Hash digits (hexadecimal) read by each of the two histograms that find the cut.
DIGITS = 3
SEED = "mix-1"


def default_weight(rank: Column) -> Column:
    """1, 2, 3, repeating, by the rank of the source from 0."""
    return rank % 3 + 1


def source_targets(sources: DataFrame, max_epochs: int = 3, budget: int | None = None) -> DataFrame:
    """Adds ``target`` to ``source, source_size, weight`` (one row per source).

    ``budget`` is the size of the mix; by default that of all sources. A source of size 0
    gets 0. A budget beyond all caps gives each source its cap.
    """
    sources = staged(sources, "mix-sources")
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    total = total if budget is None else budget
    level = 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(full, cap).otherwise(0)).alias("poured"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            level = None
            break
        higher = (total - row["poured"]) / row["weight"]
        if higher <= level:
            break
        level = higher
    if level is None:
        return sources.withColumn("target", cap.cast("double"))
    return sources.withColumn(
        "target", F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, key``: words and seeded hash of every row."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(
        "doc_id",
        "source",
        F.size(words_of(F.col("text"))).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(f"{SEED}:"), name).cast("binary")).alias("key"),
    )


def _shares(rows: DataFrame, columns: list[str], prefix: Column, path: str) -> DataFrame:
    """Words of each source by ``prefix`` of the hash, and those before it, from ``base`` on.

    At most 16 to the power of ``DIGITS`` rows per source.
    """
    bins = rows.groupBy(*columns, prefix.alias("bin")).agg(F.sum("size").alias("words"))
    before = W.partitionBy(*columns).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    return staged(
        bins.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))), path
    )


def repetitions(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``source_size, target, copies`` to ``doc_id, source, size, key``.

    ``copies`` is the number of times that the mix takes a row. Rows of one id have one
    hash and are taken alike.
    """
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    plan = staged(
        sources.withColumn("whole", whole.cast("bigint"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select(F.col("source").alias("of"), "source_size", "target", "whole", "rest"),
        "mix-plan",
    )
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    head, next_head = F.substring("key", 1, DIGITS), F.substring("key", DIGITS + 1, DIGITS)
    columns = ["source", "rest"]
    open_bin = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest"))

    def cut(shares: DataFrame, names: str) -> DataFrame:
        found = shares.filter(open_bin).groupBy("source").agg(
            F.min(F.struct("bin", "before")).alias("at")
        )
        return found.select(
            F.col("source").alias("of"),
            F.col("at.bin").alias(names),
            F.col("at.before").alias(f"{names}_before"),
        )

    def at(frame: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
        return frame.join(found, F.col("source").eqNullSafe(F.col("of")), how).drop("of")

    narrow = rows.select("source", "rest", "size", "key").filter("rest > 0")
    first = cut(_shares(narrow, columns, head, "mix-bins"), "bin1")
    inner = at(narrow, first).filter(head == F.col("bin1"))
    inner = inner.withColumn("rest", F.col("rest") - F.col("bin1_before"))
    second = cut(_shares(inner, columns, next_head, "mix-bins"), "bin2")
    # The rows of one bin of 16 ** (2 * DIGITS) of each source decide the cut itself.
    last = at(inner, second).filter(next_head == F.col("bin2")).groupBy("source", "rest", "key").agg(
        F.sum("size").alias("words"), F.first("bin2_before").alias("bin2_before")
    )
    before = W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("bin2_before") + F.coalesce(F.sum("words").over(before), F.lit(0))
    taken = last.withColumn("start", start).filter(2 * F.col("start") + F.col("words") < 2 * F.col("rest"))
    # The largest key taken; all keys of earlier bins are taken, so the bin is the least bound.
    bound = at(at(plan.filter("rest > 0").withColumnRenamed("of", "source"), first), second).select(
        "source", F.concat("bin1", "bin2").alias("least")
    )
    largest = taken.groupBy(F.col("source").alias("of")).agg(F.max("key").alias("most"))
    bound = at(bound, largest, "left").select(
        F.col("source").alias("of"), F.coalesce("most", "least").alias("bound")
    )
    bound = staged(bound, "mix-cut")
    extra = (F.col("rest") > 0) & (F.col("key") <= F.col("bound"))
    copies = F.col("whole") + F.when(extra, 1).otherwise(0)
    return at(rows, bound, "left").select(
        *["doc_id", "source", "size", "source_size", "target"], copies.alias("copies")
    )


def mix(docs: DataFrame, max_epochs: int = 3) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    Reads ``doc_id, source, text`` alone. Sources weigh 1, 2, 3, repeating, by code point,
    null last. Null and empty texts have size 0. An empty table gives an empty result.
    """
    rows = staged(sized(docs), "mix-sized")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_ranges(
        totals, "rank", [F.col("source").asc_nulls_last()], scratch_path(docs.sparkSession, "mix-rank"), 0
    )
    weighed = ranked.withColumn("weight", default_weight(F.col("rank")))
    return repetitions(rows, source_targets(weighed.drop("rank"), max_epochs))


def mixed_documents(docs: DataFrame, max_epochs: int = 3) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; its columns stay as they are."""
    own_id, own_source, copies, turn = fresh(docs, "_id", "_source", "_copies", "_turn")
    narrow = mix(docs, max_epochs).select(
        F.col("doc_id").alias(own_id),
        F.col("source").alias(own_source),
        F.col("copies").alias(copies),
    ).distinct()
    joined = docs.join(
        narrow,
        F.col("doc_id").eqNullSafe(F.col(own_id)) & F.col("source").eqNullSafe(F.col(own_source)),
    )
    again = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))
    return joined.filter(F.col(copies) > 0).withColumn(turn, again).select(*docs.columns)


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


OP1_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                         lambda x: x <> ''))::BIGINT AS size
  FROM documents
), weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM rows GROUP BY source
), pour(turn, level) AS (
  SELECT 0, 0::DOUBLE
  UNION ALL
  SELECT turn + 1, (
    SELECT ((SELECT sum(source_size) FROM weighed)
            - sum(CASE WHEN 3 * source_size <= weight * level THEN 3 * source_size ELSE 0 END))::DOUBLE
           / sum(CASE WHEN 3 * source_size <= weight * level THEN 0 ELSE weight END)
    FROM weighed)
  FROM pour WHERE turn < 64
), targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, weight * (SELECT max(level) FROM pour)) AS target
  FROM weighed
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM targets
), keys AS (
  SELECT source, key, sum(size) AS words FROM rows GROUP BY source, key
), placed AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY key) - words AS start FROM keys
)
SELECT r.doc_id, r.size, p.source_size, p.target,
       (r.size * (p.whole + CASE WHEN 2 * k.start + k.words
                                      < 2 * (p.target - p.whole * p.source_size)
                                 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rows r
JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
JOIN placed k ON r.source IS NOT DISTINCT FROM k.source AND r.key = k.key
"""
