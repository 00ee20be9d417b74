"""Similarity join on word shingles: adaptive prefixes that must match several times.

Texts with equal shingle sets are one *class*. Each class sorts its shingles from rare to
common and publishes a prefix. Two sets of Jaccard similarity t or more share at least m
shingles of the prefixes of ``n - ceil(t n) + m`` shingles, for every m. Each class picks
its own m from 1 to ``MOST_MATCHES`` by the cost its prefix is estimated to cause, so that
crowded prefixes grow longer and ask for more shared shingles before a pair is verified; a
pair must share the smaller m of its two sides.

A parity sketch gives a lower bound of how far two sets differ, which spares most pairs the
join with their sets. Results are exact. Three things keep the work linear in dense groups:

* A posting list whose classes are already one component yields no pair.
* Long lists are first linked through pivots, a few pairs per member and turn. Lists with the
  same members mostly choose the same pivots, so a member meets few of them. Pivots only
  unite components sooner; what stays apart is compared in full afterwards. Turns need no
  exact components: one step towards them is enough, as long as equal labels mean one
  component. The number of turns is the same for all inputs.
* In a list of several components only pairs across them are formed, each with a member
  outside the largest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    bitmap_of,
    components,
    forget,
    fresh,
    frugal,
    in_bitmap,
    staged,
    star_step,
    table,
    windows,
    word_hashes,
)

#: Most prefix matches a class may ask for.
MOST_MATCHES = 4
#: Cost of verifying a pair, in posting entries read.
VERIFY_COST = 8
#: Lists longer than this are first linked through so many pivots a turn, for so many turns.
PIVOT_LIST, PIVOTS, PIVOT_TURNS = 32, 8, 4
#: Bits of the parity sketch that rules out pairs before their sets are joined.
SKETCH_BITS = 1024
#: Texts, and shingles to count, that a task holds at a time.
SLICE_ROWS, BLOCK_SHINGLES = 1024, 1 << 21
#: The table of common shingles that orders the prefixes has at most so many rows.
COMMON_ROWS = 1 << 19


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingles of each text."""
    for first, counts, hashes in word_hashes(batch.column("text")):
        ends = np.cumsum(counts)
        for i, (count, end) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
            yield first + i, np.unique(windows(hashes[end - count : end], size))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(begin, SLICE_ROWS)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(shingles: np.ndarray) -> bytes:
    """One bit per slot: whether an odd number of the set's shingles falls into it.

    The sketches of two sets differ in at most as many bits as the sets do in shingles.
    """
    slots = (shingles >> np.uint64(40)).astype(np.int64) % SKETCH_BITS
    return np.packbits(np.bincount(slots, minlength=SKETCH_BITS) & 1).tobytes()


def _sketch_column(sketches: list[bytes]) -> pa.ListArray:
    words = SKETCH_BITS // 64
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(sketches) + 1) * words, pa.int32()),
        pa.array(np.frombuffer(b"".join(sketches), np.int64)),
    )


def _common_shingles(docs: DataFrame, size: int) -> DataFrame:
    """Shingles that come back within a block, with how many texts of such blocks have them.

    An estimate that only orders the prefixes. It counts each whole text, and a table of
    its ``COMMON_ROWS`` most common shingles is bounded by construction.
    """

    def repeated(held):
        value, times = np.unique(np.concatenate(held), return_counts=True)
        again = times > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(value[again].view(np.int64)), pa.array(times[again].astype(np.int64))],
            ["shingle", "texts"],
        )

    @frugal
    def count(batches):
        held, entries = [], 0
        for batch in _slices(batches):
            for _, shingles in _sets(batch, size):
                held.append(shingles)
                entries += len(shingles)
                if entries >= BLOCK_SHINGLES:
                    yield repeated(held)
                    held, entries = [], 0
        if held:
            yield repeated(held)

    counts = docs.select("text").mapInArrow(count, "shingle long, texts long")
    return counts.groupBy("shingle").agg(F.sum("texts").alias("texts"))


def _common_table(docs: DataFrame, size: int):
    counts = staged(_common_shingles(docs, size).filter("texts >= 4"), "common-shingles")
    # The least count of which at most COMMON_ROWS shingles have as many.
    histogram = counts.groupBy(F.floor(F.log2("texts") * 4).alias("level")).count().collect()
    kept, level = 0, 1 << 30
    for row in sorted(histogram, key=lambda r: -r["level"]):
        kept += row["count"]
        if kept > COMMON_ROWS:
            break
        level = row["level"]
    rows = counts.filter(F.floor(F.log2("texts") * 4) >= level).toPandas()
    rows["shingle"] = rows["shingle"].to_numpy().view(np.uint64)
    rows = rows.sort_values("shingle")
    return rows["shingle"].to_numpy(), rows["texts"].to_numpy()


def _rare_first(shingles: np.ndarray, common: np.ndarray, texts: np.ndarray) -> np.ndarray:
    if not len(common):
        return shingles
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    weight = np.where(common[at] == shingles, texts[at], 0)
    return shingles[np.lexsort((shingles, weight))]


def _signed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n, cls, prefix, sketch``: each text with its class and longest prefix."""
    common = docs.sparkSession.sparkContext.broadcast(_common_table(docs, size))

    @frugal
    def sign(batches):
        for batch in _slices(batches):
            n, cls, prefix, sketches = [], [], [], []
            for _, shingles in _sets(batch, size):
                n.append(len(shingles))
                sketches.append(_sketch(shingles))
                cls.append(_digest(shingles) if len(shingles) else None)
                most = len(shingles) - -(-percent * len(shingles) // 100) + MOST_MATCHES
                prefix.append(_rare_first(shingles, *common.value)[:most].view(np.int64))
            lengths = np.cumsum([0, *map(len, prefix)])
            values = np.concatenate([*prefix, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(n, pa.int64()),
                    pa.array(cls, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(values)),
                    _sketch_column(sketches),
                ],
                ["doc_id", "text_key", "n", "cls", "prefix", "sketch"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        sign,
        f"doc_id {id_type}, text_key long, n long, cls binary, prefix array<long>, sketch array<long>",
    )


def _postings(classes: DataFrame, percent: int) -> DataFrame:
    """``shingle, node, n, pos, needs``: the prefixes as chosen, of shingles of two or more classes."""
    counted = (
        classes.select(F.explode("prefix").alias("shingle"))
        .groupBy("shingle")
        .count()
        .filter("count > 1")
    )
    bitmap = classes.sparkSession.sparkContext.broadcast(bitmap_of(counted, "shingle"))

    @frugal
    def spread(batches):
        for batch in batches:
            lists = batch.column("prefix")
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy()[ends[0] : ends[-1]]
            owner = np.repeat(np.arange(len(lists)), np.diff(ends))
            pos = np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))
            kept = in_bitmap(bitmap.value, values)
            owner = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values[kept]),
                    batch.column("node").take(owner),
                    batch.column("n").take(owner),
                    pa.array(pos[kept]),
                ],
                ["shingle", "node", "n", "pos"],
            )

    spread_out = staged(
        classes.select("node", "n", "prefix").mapInArrow(
            spread, "shingle long, node long, n long, pos long"
        ),
        "postings",
    )
    shared = spread_out.groupBy("shingle").agg(F.count("*").alias("texts")).filter("texts > 1")
    rows = spread_out.join(shared, "shingle")
    least = F.ceil(F.col("n") * percent / 100)  # shingles that any partner shares
    cost = [
        F.sum(F.when(F.col("pos") < F.col("n") - least + m, F.col("texts") - 1).otherwise(0))
        for m in range(1, MOST_MATCHES + 1)
    ]
    choice = rows.groupBy("node", "n").agg(*(c.alias(f"c{m}") for m, c in enumerate(cost, 1)))
    weighed = [
        F.struct(
            (F.col(f"c{m}") * (1 + VERIFY_COST / m)).alias("cost"), F.lit(m).alias("needs")
        )
        for m in range(1, MOST_MATCHES + 1)
    ]
    allowed = F.filter(F.array(*weighed), lambda c: c["needs"] <= F.greatest(least, F.lit(1)))
    choice = choice.select("node", F.array_min(allowed)["needs"].alias("needs"))
    prefixes = staged(
        rows.join(choice, "node")
        .filter(F.col("pos") < F.col("n") - least + F.col("needs"))
        .select("shingle", "node", "n", "needs"),
        "prefixes",
    )
    forget(spread_out)
    return prefixes


class _Linker:
    """Edges with the components of the verified links, and labels of the nodes.

    Nodes of one label are in one component; after :meth:`finish` the reverse holds too.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.links: list[DataFrame] = []  # staged, with the columns u and v
        self.labels: DataFrame | None = None

    def labelled(self, postings: DataFrame) -> DataFrame:
        if self.labels is None:
            return postings.withColumn("component", F.col("node"))
        named = postings.join(self.labels, "node", "left")
        return named.withColumn("component", F.coalesce("component", "node"))

    def verify(self, pairs: DataFrame, sets: DataFrame) -> bool:
        """Add the pairs ``a, b`` that are similar enough; False if there are none."""
        light = [
            sets.select(
                F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")
            )
            for c in "ab"
        ]
        # At most this share of both sets together may be in one of them only.
        apart = F.aggregate(
            F.zip_with("sketch_a", "sketch_b", lambda a, b: F.bit_count(a.bitwiseXOR(b))),
            F.lit(0),
            lambda total, bits: total + bits,
        )
        pairs = (
            pairs.join(light[0], "a")
            .join(light[1], "b")
            .filter(apart * (100 + self.percent) <= (F.col("n_a") + F.col("n_b")) * (100 - self.percent))
            .select("a", "b")
        )
        side = [
            sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
            for c in "ab"
        ]
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        links = staged(
            pairs.join(side[0], "a")
            .join(side[1], "b")
            .filter(100 * common >= self.percent * union)
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")),
            "links",
        )
        self.links.append(links)
        return not links.isEmpty()

    def _edges(self) -> DataFrame:
        edges = self.links[0]
        for more in self.links[1:]:
            edges = edges.union(more)
        return edges

    def shorten(self) -> None:
        """Label the nodes after one step towards the components."""
        edges = staged(star_step(self._edges()), "edges")
        forget(*self.links)
        self.links = [edges]
        self.labels = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))

    def finish(self) -> None:
        """Label the nodes by their components."""
        if self.links:
            links = self._edges().select(F.col("u").alias("a"), F.col("v").alias("b"))
            self.labels = staged(components(links), "labels")
            forget(*self.links)


def _in_reach(percent: int):
    """Sizes that can still be similar enough."""
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _sized(rows: DataFrame) -> DataFrame:
    """Posting lists of several components, each row with its list's size and largest component."""
    groups = rows.groupBy("shingle", "component").agg(F.count("*").alias("held"))
    lists = groups.groupBy("shingle").agg(
        F.sum("held").alias("texts"),
        F.count("*").alias("groups"),
        F.max(F.struct("held", "component")).alias("largest"),
    )
    lists = lists.filter("groups > 1").select(
        "shingle", "texts", F.col("largest.component").alias("largest")
    )
    return rows.join(lists, "shingle")


def _pivot_pairs(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member outside a long list's largest component with that list's pivots of this turn.

    A member meets each of its lists once: the pivots of a list go along as one array. Its
    lists mostly have the same pivots, and only the different ones become rows.
    """
    long_lists = rows.filter(F.col("texts") > PIVOT_LIST)
    least = [
        F.min(F.struct(F.xxhash64("node", F.lit(PIVOTS * turn + k)), "node", "n"))
        for k in range(PIVOTS)
    ]
    chosen = F.transform(F.array(*least), lambda p: F.struct(p["node"].alias("b"), p["n"].alias("n_b")))
    pivots = (
        long_lists.filter("component = largest")
        .groupBy("shingle")
        .agg(F.array_sort(F.array_distinct(chosen)).alias("pivots"))
    )
    return (
        long_lists.filter("component != largest")
        .select("shingle", F.col("node").alias("a"), F.col("n").alias("n_a"))
        .join(pivots, "shingle")
        .groupBy("a", "n_a")
        .agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
        .select("a", "n_a", F.inline("pivots"))
        .filter(_in_reach(percent))
        .select("a", "b")
    )


def _folded(classes: DataFrame) -> DataFrame:
    """``node`` and its sketch in half as many bits, a column for each 64 of them."""
    half = SKETCH_BITS // 128
    return classes.select(
        "node",
        *(F.col("sketch")[k].bitwiseXOR(F.col("sketch")[k + half]).alias(f"s{k}") for k in range(half)),
    )


def _cross_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs across components that share as many prefix shingles as they must.

    The sketch columns are part of the join's condition: most pairs of a dense list are
    ruled out there and never become rows.
    """
    sketch = [c for c in rows.columns if c.startswith("s") and c[1:].isdigit()]
    apart = sum(
        (F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in sketch), F.lit(0)
    )
    columns = ["node", "n", "needs", "component", *sketch]
    a = rows.filter("component != largest").select(
        "shingle", *(F.col(c).alias(f"{c}_a") for c in columns)
    )
    b = rows.select("shingle", "largest", *(F.col(c).alias(f"{c}_b") for c in columns))
    met = a.join(b, "shingle").filter(
        (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("largest")) | (F.col("node_a") < F.col("node_b")))
        & _in_reach(percent)
        & (apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
    )
    smaller, larger = F.least("node_a", "node_b"), F.greatest("node_a", "node_b")
    return (
        met.groupBy(smaller.alias("a"), larger.alias("b"))
        .agg(F.count("*").alias("shared"), F.first(F.least("needs_a", "needs_b")).alias("needs"))
        .filter("shared >= needs")
        .select("a", "b")
    )


def _class_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, n, shingles, sketch`` of the classes in ``nodes``, one row each.

    A bitmap over text keys picks the texts to read again; one text stands for a class.
    """
    wanted = staged(
        nodes.distinct().join(classes.select("node", "text_key"), "node"),
        "wanted",
    )
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted, "text_key"))

    @frugal
    def sets(batches):
        for batch in _slices(batches):
            kept = in_bitmap(bitmap.value, batch.column("text_key").to_numpy())
            part = batch.filter(pa.array(kept))
            if not part.num_rows:
                continue
            shingles = [held.view(np.int64) for _, held in _sets(part, size)]
            lengths = np.cumsum([0, *map(len, shingles)])
            sketches = [_sketch(held.view(np.uint64)) for held in shingles]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("text_key"),
                    pa.array(map(_digest, shingles), pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(lengths, pa.int32()),
                        pa.array(np.concatenate([*shingles, np.zeros(0, np.int64)])),
                    ),
                    _sketch_column(sketches),
                ],
                ["text_key", "cls", "shingles", "sketch"],
            )

    read = docs.select(F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        sets, "text_key long, cls binary, shingles array<long>, sketch array<long>"
    )
    held = F.any_value(F.struct("shingles", "sketch"))
    one = read.groupBy("text_key", "cls").agg(held.alias("held"))
    found = staged(
        wanted.join(classes.select("node", "n", "cls"), "node")
        .join(one, ["text_key", "cls"])
        .select("node", "n", "held.shingles", "held.sketch"),
        "sets",
    )
    forget(wanted)
    return found


def similar_components(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id`` per row of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest id reachable over pairs of texts whose shingle sets
    have a Jaccard similarity of ``percent`` or more. Null and wordless texts have no
    shingles and stay alone; a text of fewer words than a shingle has its whole sequence as
    one. Repeated rows and equal texts share a component. A row without id takes the
    component of its text, and has none if no id is reached. Other columns are not read.
    An empty table gives an empty result.
    """
    signed = staged(_signed(docs, shingle_words, percent), "signed")
    classes = signed.filter("n > 0").groupBy("cls", "n").agg(
        F.any_value("prefix").alias("prefix"),
        F.any_value("sketch").alias("sketch"),
        F.min("text_key").alias("text_key"),
        F.min("doc_id").alias("least_id"),
    )
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = staged(signed.drop("prefix", "sketch"), "members")
    forget(signed)
    linker, sets = _Linker(percent), None
    before = postings = _postings(classes, percent)
    for turn in range(PIVOT_TURNS + 1):
        # Lists that have become one component are done with, so each turn reads fewer.
        apart = staged(_sized(linker.labelled(postings)), "apart")
        forget(before)
        before, postings = apart, apart.select("shingle", "node", "n", "needs")
        if turn == PIVOT_TURNS:
            break
        if sets is None:
            nodes = apart.filter(F.col("texts") > PIVOT_LIST).select("node")
            sets = _class_sets(docs, classes, nodes, shingle_words)
        pivots = staged(_pivot_pairs(apart, turn, percent), "pivots")
        if linker.verify(pivots, sets):
            linker.shorten()
        forget(pivots)
    forget(sets)
    sketched = staged(apart.join(_folded(classes), "node"), "sketched")
    forget(apart)
    pairs = staged(_cross_pairs(sketched, percent), "pairs")
    forget(sketched)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    sets = _class_sets(docs, classes, nodes, shingle_words)
    linker.verify(pairs, sets)
    forget(pairs, sets)
    linker.finish()
    named = linker.labelled(classes.select("node", "cls", "least_id"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_class = staged(named.join(least, "component").select("cls", "component_id"), "by-class")
    alone = members.filter("n = 0").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    grouped = members.filter("n > 0").select("doc_id", "text_key", "n", "cls")
    return (
        grouped.join(by_class, "cls")
        .select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id")
        .union(alone)
    )


def one_per_group(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one text of each group of similar texts, in their own columns.

    The text of the smallest id stays (of several under that id, the one of the smallest
    hash), once. Texts without words all stay.
    """
    members = similar_components(docs, shingle_words, percent)
    members = staged(members.filter("n_shingles > 0"), "members")
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("?"), "text_key"))
    keepers = members.groupBy(group.alias("grp")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("keep")
    )
    keep_id, keep_key, key = fresh(docs, "_keep_id", "_keep_key", "_key")
    keepers = keepers.select(
        F.col("keep.doc_id").alias(keep_id), F.col("keep.text_key").alias(keep_key)
    )
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.filter(worded).withColumn(key, F.xxhash64("text"))
    kept = keyed.join(
        keepers, F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(key) == F.col(keep_key))
    )
    once = kept.dropDuplicates([keep_id, keep_key]).select(*docs.columns)
    return once.union(docs.filter(~worded))


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Groups of documents that share 85 % of their four-word shingles."""
    found = similar_components(table(spark, sf_dir, "documents"), 4, 85)
    return found.select("doc_id", "n_shingles", "component_id")
