"""Quality rules: base counts, and divergence from language references.

A document is compared with the reference of its language: the summed histograms of all
documents of that ``lang`` (null is a language of its own). Two histograms are compared by
Jensen-Shannon distance (base 2, from 0 to 1): character classes, and common words against
all others. A document goes if its characters are far off, or if characters and words both
are somewhat off. A histogram of few counts is far from any reference by chance alone, so
each rule has a least length below which it gives no verdict. Only DataFrame functions are
used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, spaced, staged, table
from tidemark.llm.lexicon import COMMON_WORDS

#: Rejected beyond this distance of character classes, in texts of so many characters.
CHAR_DISTANCE, LEAST_CHARS = 0.26, 200
#: Rejected beyond both of these, of character classes and common words, from so many words on.
ODD_CHAR_DISTANCE, WORD_DISTANCE, LEAST_WORDS = 0.15, 0.31, 100
#: Base rule: least number of words, and largest share of repeated ones in percent.
BASE_WORDS, BASE_REPEATED = 50, 50

#: Code points from here on stand for the common words; they stay below 127.
_CODE = 33
assert _CODE + len(COMMON_WORDS) < 127
_NO_BLANK = r"[^\x20\x09-\x0D]"
_PLACED = "array<struct<h:bigint,i:int>>"


def _count(text: Column, characters: str) -> Column:
    """Characters of a short text that are in a class."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def _distance(p: Column, p_sum: Column, q: Column, q_sum: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null if either is all zero.

    The sums come along: one formed here would be formed again for every count.
    """

    def share(counts: Column, total: Column) -> Column:
        return F.transform(counts, lambda x: x / F.when(total > 0, total))

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(
        share(p, p_sum), share(q, q_sum), lambda x, y: (part(x, y) + part(y, x)) / 2
    )
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, lang``, the base counts, and the two histograms of every row.

    ``chars_sum`` is the sum of ``chars``; that of ``common`` is ``n_words``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        "lang",
        F.xxhash64("text").alias("text_key"),
        text.alias("text"),
        spaced(F.col("text")).alias("spaced"),
    )
    rows = rows.select(
        "*",
        F.array_remove(F.split("spaced", " "), "").alias("w"),
        # ASCII without lower-case letters, blanks and controls: few, so cheap to classify.
        F.regexp_replace("text", "[^!-`{-~]+", "").alias("marks"),
        F.length(F.replace(F.col("spaced"), F.lit(" "), F.lit(""))).cast("bigint").alias("word_chars"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    rows = rows.select(
        "*",
        F.size("w").cast("bigint").alias("n_words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(_NO_BLANK)).alias("lines"),
        F.transform(
            F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)),
        ).alias("windows"),
        F.filter("w", lambda x: x.isin(*COMMON_WORDS)).alias("common"),
    )
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    # Without repeats no window is placed at all.
    rows = rows.withColumn(
        "placed", F.coalesce(F.when(again, F.sort_array(placed)), F.array().cast(_PLACED))
    )
    repeated = F.filter(
        "placed",
        lambda x, i: (F.get("placed", i - 1)["h"] == x["h"]).eqNullSafe(True)
        | (F.get("placed", i + 1)["h"] == x["h"]).eqNullSafe(True),
    )
    rows = rows.withColumn("at", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    # A window covers three words, or those up to the next repeated window.
    covered = F.aggregate(
        F.transform("at", lambda x, i: F.least(F.get("at", i + 1) - x, F.lit(3))),
        F.lit(0),
        lambda s, x: s + x,
    )
    blanks = F.col("n_chars") - F.col("word_chars")
    known = [
        _count(F.col("marks"), "A-Z"),
        _count(F.col("marks"), "0-9"),
        _count(F.col("marks"), r".,;:!?'\"()\-"),
        (F.octet_length("text") - F.length("text")),  # grows with letters beyond ASCII
        F.col("n_symbols").cast("int"),
        blanks.cast("int"),
    ]
    # One character per common word; counting it is a byte search.
    codes = F.array_join(
        F.transform(
            "common",
            lambda x: F.char(
                F.array_position(F.array(*map(F.lit, COMMON_WORDS)), x) + F.lit(_CODE - 1)
            ),
        ),
        "",
    )
    hits = [
        F.length("codes") - F.length(F.replace(F.col("codes"), F.lit(chr(_CODE + i)), F.lit("")))
        for i in range(len(COMMON_WORDS))
    ]
    rows = rows.select(
        "*",
        _count(F.col("marks"), "#*$%&|<>").cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
        codes.alias("codes"),
    ).select("*", F.array(*known).alias("known"), F.array(*hits).alias("hits"))
    known_sum = F.aggregate("known", F.lit(0), lambda s, x: s + x)
    lower = F.greatest(F.col("n_chars").cast("int") - known_sum, F.lit(0))
    other = F.size("w") - F.size("common")
    return rows.select(
        "doc_id",
        "lang",
        "text_key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_chars",
        (known_sum + lower).cast("bigint").alias("chars_sum"),
        F.concat("known", F.array(lower)).alias("chars"),
        F.concat("hits", F.array(other)).alias("common"),
    )


def references(rows: DataFrame) -> DataFrame:
    """The histograms of all documents of each language, and their sums.

    ``ref_lang, ref_chars, ref_common, ref_chars_sum, ref_words``.
    """

    def summed(name: str, size: int) -> Column:
        return F.array(*(F.sum(F.get(name, F.lit(i)).cast("bigint")) for i in range(size)))

    return rows.groupBy(F.col("lang").alias("ref_lang")).agg(
        summed("chars", 7).alias("ref_chars"),
        summed("common", len(COMMON_WORDS) + 1).alias("ref_common"),
        F.sum("chars_sum").alias("ref_chars_sum"),
        F.sum("n_words").alias("ref_words"),
    )


def judged(docs: DataFrame) -> DataFrame:
    """The base counts, ``base_failed``, both distances and ``kept`` for every row of ``docs``.

    Reads ``doc_id, lang, text``. Null text counts as empty; it and very short texts fail
    the base rule. Repeated rows are judged alike. An empty table gives an empty result.
    """
    rows = staged(features(docs), "quality")
    known = staged(references(rows), "references")
    rows = rows.join(known, F.col("lang").eqNullSafe(F.col("ref_lang")))
    base = (F.col("n_words") < BASE_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words")
    )

    rows = rows.select(
        "*",
        base.alias("base_failed"),
        _distance(
            F.col("chars"), F.col("chars_sum"), F.col("ref_chars"), F.col("ref_chars_sum")
        ).alias("char_distance"),
        _distance(
            F.col("common"), F.col("n_words"), F.col("ref_common"), F.col("ref_words")
        ).alias("word_distance"),
    )
    chars, words = F.col("char_distance"), F.col("word_distance")
    far = (F.col("n_chars") >= LEAST_CHARS) & (chars > CHAR_DISTANCE)
    odd = (chars > ODD_CHAR_DISTANCE) & (words > WORD_DISTANCE)
    strange = F.coalesce(far | ((F.col("n_words") >= LEAST_WORDS) & odd), F.lit(False))
    return rows.select(
        "text_key",
        *"doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split(),
        "char_distance",
        "word_distance",
        (~F.col("base_failed") & ~strange).alias("kept"),
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, in their own columns.

    Rows of one id and text are judged alike, so a row is found again by these two.
    """
    own_id, own_key, key = fresh(docs, "_id", "_key", "_text_key")
    kept = judged(docs).filter("kept")
    kept = kept.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct()
    return (
        docs.withColumn(key, F.xxhash64("text"))
        .join(
            kept,
            F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)),
            "left_semi",
        )
        .select(*docs.columns)
    )


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    rows = judged(table(spark, sf_dir, "documents"))
    return rows.drop("text_key", "char_distance", "word_distance")


OP4_SQL = r"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda x: x <> '') AS w,
         row_number() OVER () AS rid
  FROM documents
), counted AS (
  SELECT rid, doc_id, lang, w, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars, length(text)::BIGINT AS n_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(list_filter(string_split(text, chr(10)),
                          lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
          - len(list_distinct(list_filter(string_split(text, chr(10)),
                          lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
         len(regexp_extract_all(text, '[A-Z]')) AS c1, len(regexp_extract_all(text, '[0-9]')) AS c2,
         len(regexp_extract_all(text, '[.,;:!?''"()-]')) AS c3, strlen(text) - length(text) AS c4
  FROM texts
), classed AS (
  SELECT *, n_chars - word_chars AS c6,
         greatest(0, n_chars - (c1 + c2 + c3 + c4 + n_symbols + n_chars - word_chars)) AS c7
  FROM counted
), places AS (
  SELECT rid, i, w[i] || chr(32) || w[i + 1] || chr(32) || w[i + 2] AS trio
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM texts)
), repeated AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS later
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, trio) AS n FROM places) WHERE n > 1
), covered AS (
  SELECT rid, sum(CASE WHEN later - i < 3 THEN later - i ELSE 3 END)::BIGINT AS n
  FROM repeated GROUP BY rid
), chars AS (
  SELECT rid, lang, unnest([1, 2, 3, 4, 5, 6, 7]) AS bin,
         unnest([c1, c2, c3, c4, n_symbols, c6, c7]) AS n
  FROM classed
), words AS (
  SELECT t.rid, t.lang, b.word AS bin,
         count(v.word)::BIGINT AS n
  FROM (SELECT rid, lang FROM texts) t
  CROSS JOIN (SELECT unnest([@COMMON@, '']) AS word) b
  LEFT JOIN (SELECT rid, CASE WHEN list_contains([@COMMON@], x) THEN x ELSE '' END AS word
             FROM (SELECT rid, unnest(w) AS x FROM texts)) v
    ON v.rid = t.rid AND v.word = b.word
  GROUP BY ALL
), both_ AS (
  SELECT 1 AS kind, rid, lang, bin::VARCHAR AS bin, n FROM chars
  UNION ALL SELECT 2, rid, lang, bin, n FROM words
), shares AS (
  SELECT kind, rid, n / nullif(sum(n) OVER (PARTITION BY kind, rid), 0) AS p,
         sum(n) OVER (PARTITION BY kind, lang, bin)
           / nullif(sum(n) OVER (PARTITION BY kind, lang), 0) AS q
  FROM both_
), distances AS (
  SELECT kind, rid, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS d
  FROM shares GROUP BY kind, rid
), judged AS (
  SELECT c.*, coalesce(v.n, 0) AS n_repeat_words, a.d AS char_d, b.d AS word_d
  FROM classed c
  LEFT JOIN covered v ON v.rid = c.rid
  LEFT JOIN distances a ON a.rid = c.rid AND a.kind = 1
  LEFT JOIN distances b ON b.rid = c.rid AND b.kind = 2
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT ((n_chars >= 200 AND coalesce(char_d, 0) > 0.26)
                  OR (n_words >= 100 AND coalesce(char_d, 0) > 0.15 AND coalesce(word_d, 0) > 0.31)) AS kept
FROM judged
""".replace("@COMMON@", ", ".join(f"'{word}'" for word in COMMON_WORDS))
