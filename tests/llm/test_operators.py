"""Corpus operators against brute force, and on rows that are easy to get wrong."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import (
    extraction,
    langid,
    lm,
    mixing,
    ngram_join,
    packing,
    quality,
    spotsigs,
    substrings,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"
WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrs"] + "the of and to in a".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus() -> list[tuple]:
    passage = prose(99, 60)
    texts = {
        1: prose(1, 120),
        2: prose(1, 120),
        3: prose(1, 119) + " changed",
        4: prose(4, 200) + "\n" + passage,
        5: passage + "\n" + prose(5, 150),
        6: None,
        7: "",
        8: " \t\n\x0b\x0c\r ",
        9: "one two",
        10: "x" * 5000,
        11: "Ünïcödé 漢字 😀 " * 40,
        12: prose(12, 4000),
        13: "### $$$ %%% ||| &&& *** " * 40,
        14: prose(14, 90).upper(),
    }
    rows = [
        (i, t, ["en", "fr", None][i % 3], ["a", "b", None, "c"][i % 4], i, -i, "clash")
        for i, t in texts.items()
    ]
    rows.append(rows[3])  # a repeated row
    rows.append((None, prose(4, 30), "en", "a", 1, 1, "clash"))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def test_components_equal_brute_force(docs):
    found = ngram_join.similar_components(docs, 4, 85).collect()
    rows = [(r[0], r[1]) for r in corpus()]
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    least = {
        g: min((rows[i][0] for i in range(len(rows)) if label[i] == g and rows[i][0] is not None), default=None)
        for g in set(label)
    }
    want = collections.Counter(
        (rows[i][0], len(sets[i]), least[label[i]]) for i in range(len(rows))
    )
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


def test_one_text_of_a_group_stays(docs):
    kept = ngram_join.one_per_group(docs, 4, 85)
    assert kept.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids == {i: 1 for i in (1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, None)}


def test_dense_groups_are_joined_in_full(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIVOT_LIST", 4)
    base = prose(7, 100).split()
    rows = []
    for i in range(60):
        w = list(base)
        w[(7 * i) % 100] = f"new{i}"
        rows.append((i, " ".join(w)))
    found = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    assert {r.component_id for r in found.collect()} == {0}


def test_loose_groups_are_united_before_all_pairs_are_formed(spark, monkeypatch):
    draw = random.Random(3)
    base = prose(7, 150).split()
    rows = []
    for i in range(300):
        w = list(base)
        for at in draw.sample(range(150), draw.choice([1, 2, 2, 2])):
            w[at] = f"new{i}"
        rows.append((i, " ".join(w)))
    formed = []

    def counted(*args, across=ngram_join._cross_pairs):
        pairs = across(*args)
        formed.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "_cross_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.similar_components(docs, 4, 85).count() == 300
    assert formed[0] < 300


def test_a_member_meets_each_list_once_before_its_pivots(spark):
    """80 texts in 50 lists of 130: a row for each text and list, not for each of their pivots."""
    rows = [
        (s, node, 100, 1, 0 if node < 50 else node, 130, 0) for s in range(50) for node in range(130)
    ]
    columns = "shingle long, node long, n long, needs int, component long, texts long, largest long"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = ngram_join._pivot_pairs(spark.createDataFrame(rows, columns), 0, 85)
        found = [(r.a, r.b) for r in pairs.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(set(found)) == len(found)
    by_member = collections.defaultdict(set)
    for a, b in found:
        by_member[a].add(b)
    assert sorted(by_member) == list(range(50, 130))
    # All lists have the same pivots, one for each of the hashes that differ in their least.
    assert len({frozenset(b) for b in by_member.values()}) == 1
    assert by_member[50] <= set(range(50)) and 1 < len(by_member[50]) <= ngram_join.PIVOTS

    def joined(plan):
        own = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() else 0
        return own + sum(joined(plan.children().apply(i)) for i in range(plan.children().size()))

    assert joined(pairs._jdf.queryExecution().executedPlan()) == 50 * 80


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(corpus())
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
        assert r["size"] == len(words(next(t for i, t, *_ in corpus() if i == r.doc_id)))
        assert 0 <= r.copies <= 3
    total = sum(r["size"] for r in rows)
    assert math.isclose(sum(v[0].target for v in by_source.values()), total)
    for group in by_source.values():
        taken = sum(r["size"] * r.copies for r in group)
        assert group[0].target <= 3 * group[0].source_size + 1e-6
        assert abs(taken - group[0].target) <= max(r["size"] for r in group)


def test_water_filling_clamps_and_reshares(spark):
    sources = spark.createDataFrame([("a", 10, 5), ("b", 100, 1), ("c", 90, 1), ("d", 0, 9)], "source string, source_size long, weight long")
    target = {r.source: r.target for r in mixing.source_targets(sources).collect()}
    assert target == {"a": 30.0, "b": 85.0, "c": 85.0, "d": 0.0}


def test_mixed_rows_keep_their_columns(docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.packed(docs).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_doc = collections.defaultdict(list)
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= 1024 and r.offset == 0
        by_doc[r.doc_id].append(r)
    for doc_id, text, *_ in corpus():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted({(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id]})
        assert sum(p[1] for p in pieces) == len(ids)
        for start, length, crc, total in pieces:
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc and total == len(ids)


def test_base_counts_equal_brute_force(docs):
    for r in quality.judged(docs).collect():
        text = next(t for i, t, *_ in corpus() if i == r.doc_id) or ""
        w = [x.decode() for x in text.encode().split()]
        trios = collections.Counter(zip(w, w[1:], w[2:]))
        at = {i + k for i in range(len(w) - 2) if trios[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(at)
        assert r.base_failed == (len(w) < 50 or 2 * len(at) > len(w))
        assert not (r.kept and r.base_failed)


def test_distances_form_no_sum_per_count(docs):
    rows = quality.features(docs).select("chars", "common", "chars_sum", "n_words").collect()
    assert all((sum(r.chars), sum(r.common)) == (r.chars_sum, r.n_words) for r in rows)
    plan = quality.judged(docs)._jdf.queryExecution().analyzed().toString()
    shares = plan.split("transform(")[1:]
    assert shares and not any("aggregate(" in share.split("lambdafunction(")[1] for share in shares)


def test_strange_characters_are_rejected(spark):
    rows = [(i, prose(i, 300), "en") for i in range(30)]
    noisy = " ".join(f"{w}%%#{i}" for i, w in enumerate(prose(77, 300).split()))
    rows.append((99, noisy, "en"))
    kept = {r.doc_id for r in quality.accepted(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == set(range(30))


def test_repeated_passages_are_cut_once(docs):
    texts = {r.doc_id: r.text for r in substrings.deduplicated(docs).collect()}
    middle = " ".join(prose(99, 60).split()[12:48])
    assert middle in texts[4] and middle not in texts[5]
    assert texts[5].endswith(prose(5, 150)[40:]) and texts[1] == prose(1, 120) and texts[2] == ""
    assert texts[6] is None and texts[7] == "" and texts[12] == prose(12, 4000)
    kept = substrings.without_repeats(docs)
    assert kept.columns == docs.columns and 2 not in {r.doc_id for r in kept.collect()}


def windows_of(texts):
    import pyarrow as pa

    return [
        (row, begin, end, tuple(digest))
        for part in substrings._windows(pa.array(texts, pa.string()))
        for row, begin, end, digest in zip(*(x.tolist() for x in part), strict=True)
    ]


def test_windows_are_shift_resistant():
    text = prose(3, 600)
    found = [{w[3] for w in windows_of([t])} for t in (text, "inserted " + text)]
    assert len(found[0] & found[1]) > 0.9 * len(found[0])


def test_windows_are_equal_where_their_bytes_are():
    words = [prose(i, 300) for i in range(30)]
    texts = [*words, "", None, words[3][7:900] + words[4], "x" * 5000, "日本語のテキスト" * 90, *words[:5]]
    by_digest, by_bytes = {}, {}
    for row, begin, end, digest in windows_of(texts):
        raw = texts[row].encode()[begin:end]
        raw.decode()  # borders lie between characters
        assert len(raw) >= substrings.LEAST_RUN
        by_digest.setdefault(digest, set()).add(raw)
        by_bytes.setdefault(raw, set()).add(digest)
    assert all(len(x) == 1 for x in [*by_digest.values(), *by_bytes.values()])
    # What a text's windows are does not depend on the texts beside it.
    alone = [w[1:] for w in windows_of([words[7]])]
    assert alone == [w[1:] for w in windows_of(texts) if w[0] == 7]


def test_long_texts_have_the_windows_of_short_ones(monkeypatch):
    text = prose(5, 30_000)
    whole = windows_of([text])
    monkeypatch.setattr(substrings, "_PART", 1 << 12)
    assert windows_of([text]) == whole


def test_passages_of_51_words_are_cut():
    """Of 1,000 random passages of six-letter words, at least 99 % lose half or more."""

    def longer(seed, n):
        words = iter(prose(seed, 2 * n).split())
        return " ".join(a + b for a, b in zip(words, words, strict=True))

    lost = []
    for i in range(1000):
        passage = longer(10_000 + i, 51)
        texts = [f"{longer(20_000 + 2 * i + k, 40)} {passage} {longer(50_000 + 2 * i + k, 40)}" for k in (0, 1)]
        first = {w[3] for w in windows_of(texts[:1])}
        spans = [{"begin": b, "end": e} for _, b, e, d in windows_of(texts[1:]) if d in first]
        cut = sum(e - b for b, e in substrings._joined(spans))
        lost.append(cut / len(passage.encode()))
    assert sum(share >= 0.5 for share in lost) >= 990 and max(lost) <= 1.1


def test_cuts_agree_with_brute_force(spark):
    """Every cut byte lies in an earlier exact repeat, and long repeats are found."""
    shared = [prose(900 + i, 70) for i in range(6)]
    rows = [(i, f"{prose(i, 60)} {shared[i % 6]} {prose(100 + i, 30 + i)}") for i in range(36)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts, least = dict(rows), substrings.LEAST_RUN
    for r in substrings.deduplicated(frame).collect():
        raw = texts[r.doc_id].encode()
        earlier = [texts[i].encode() for i in range(r.doc_id)]
        for begin, end in r.cut_spans:
            assert end - begin >= least - 40 and any(raw[begin:end] in e for e in earlier)
        assert bool(r.cut_spans) == (r.doc_id >= 6)


CLASHING = ["_id", "_key", "_text_key", "_source", "_copies", "_turn", "_spans", "_keep_id", "_cuts", "_KEEP_KEY", "cut_spans"]


@pytest.mark.parametrize(
    "stage",
    [quality.accepted, ngram_join.one_per_group, substrings.without_repeats, mixing.mixed_documents],
    ids=lambda f: f.__name__,
)
def test_stages_pass_clashing_columns_through(spark, stage):
    from pyspark.sql import functions as F

    rows = [(i, prose(i, 120), "en", "web") for i in range(6)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    wide = plain.select("*", *(F.concat(F.lit(f"{c}:"), "doc_id").alias(c) for c in CLASHING))
    found = stage(wide)
    assert found.columns == wide.columns
    kept = found.collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in stage(plain).collect()}
    assert all(r[c] == f"{c}:{r.doc_id}" for r in kept for c in CLASHING)


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "page-with-menu", "no-comments", "share-layout", "related"])
def test_names_around_the_article_do_not_drop_it(name):
    article = "<article><h1>Title</h1><p>One two.</p></article>"
    for page in (
        f"<body class='{name}'><nav>x</nav><main>{article}</main></body>",
        f"<body><div class='{name}'><div class='ad'>Buy</div>{article}</div></body>",
        f"<body><main class='{name}'>{article}</main><aside>{article}</aside></body>",
    ):
        assert extraction.main_text(page, None) == "Title One two."


def test_elements_that_are_never_closed_lose_nothing():
    for tag in ("button", "select", "object", "svg", "iframe", "noscript", "template"):
        text = extraction.main_text(f"<article><p>One.</p><{tag} a='>'>x<p>Two.</p></article>", None)
        assert text.startswith("One.") and text.endswith("Two.")
        closed = f"<article><p>One.</p><{tag}>x</{tag.upper()} ><p>Two.</p></article>"
        assert extraction.main_text(closed, None) == "One. Two."


def test_later_articles_under_boilerplate_names_stay_out():
    page = (
        "<body><article><p>The text itself.</p></article><div class='comments'>"
        "<article><p>Nice!</p></article></div></body>"
    )
    assert extraction.main_text(page, None) == "The text itself."


def test_boilerplate_needs_three_differing_pages(spark):
    def pages(n):
        html = "<body><div><p class='a'>{}</p><p class='b'>Always the same words.</p></div></body>"
        return [(i, "http://h.example/x", html.format(prose(i, 30)), "d", "h") for i in range(n)]

    for n, kept in ((2, True), (3, False)):
        found = extraction.extracted(spark.createDataFrame(pages(n), PAGES)).collect()
        assert all(("Always" in r.text) == kept for r in found)


PAGES = "page_id long, url string, html string, digest string, host string"


def page_rows():
    def page(title, body):
        return (
            f"<html><head><title>{title}</title><script>var a='</p>';</script></head><body>"
            f"<nav><ul><li>Home<li>About</ul></nav><div class='ad'>Buy</div><article><h1>{title}</h1>"
            f"{body}</article><div id=comments>Nice!</div><footer>&copy; me</footer></body></html>"
        )

    rows = [(i, "http://h.example/a b", page(f"T{i}", f"<p>One&amp;two <b>{i}</b><br>x<p>Y\n z"), "clash", "clash") for i in range(6)]
    rows += [(6, None, None, None, None), (7, "http://h.example/", "", "d", "h"), rows[1], (9, "http://h.example", rows[1][2], None, None)]
    rows.append((10, "http://alone.example", "<div><p>" + prose(1, 30) + "</p><p>" + prose(2, 30) + "</p></div><p", None, None))
    return rows


def test_article_text(spark):
    found = extraction.extracted(spark.createDataFrame(page_rows(), PAGES)).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(page_rows())
    assert text[3] == "T3 One&two 3 x Y z" and text[9] == text[1]
    assert text[6] == text[7] == "" and text[10] == f"{prose(1, 30)} {prose(2, 30)}"
    assert all(r.n_chars == len(r.text) for r in found)


def test_text_on_every_page_is_boilerplate(spark):
    rail = "<div class=rail><p>Our other writing</p><p>All offers of this week</p></div>"
    rows = [
        (i, f"http://site.example/{i}", f"<body><article><h1>T{i}</h1><p>{prose(i, 20)}</p>{rail}</article>", "", "")
        for i in range(8)
    ]
    # Copies of one page are no template, nor are two pages.
    rows += [(20 + i, f"http://copy.example/{i}", rows[1][2], "", "") for i in range(6)]
    rows += [(30 + i, f"http://two.example/{i}", rows[i][2], "", "") for i in range(2)]
    found = {r.page_id: r.text for r in extraction.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert [found[i] for i in range(8)] == [f"T{i} {prose(i, 20)}" for i in range(8)]
    whole = "T1 " + prose(1, 20) + " Our other writing All offers of this week"
    assert {found[i] for i in range(20, 26)} == {whole} and found[31] == whole


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), PAGES)
    first, final = str(tmp_path / "first"), str(tmp_path / "final")
    warc.write_captures(pages, first)
    warc.deduplicate_archives(spark, first, final)
    rows = warc.read_archives(spark, final, payloads=True).collect()
    assert len(rows) == len(page_rows())
    html = {i: h or "" for i, _, h, *_ in page_rows()}
    by_payload = collections.defaultdict(list)
    for r in rows:
        raw = html[r.page_id].encode()
        assert r.digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert r.payload_bytes == len(raw) and r.payload_ok is not False
        if r.record_type == "response":
            assert bytes(r.payload) == raw
        by_payload[raw].append(r)
    for group in by_payload.values():
        kept = [r for r in group if r.record_type == "response"]
        assert len(kept) == 1 and kept[0].page_id == min(r.page_id for r in group)
        assert {r.refers_to for r in group if r.record_type == "revisit"} <= {kept[0].record_id}


def test_scores_equal_brute_force_and_sum_to_one(spark):
    rows = [(i, prose(i, 60), i % 4 == 1) for i in range(40)]
    rows += [(100, "unheard words of", True), (101, None, True), (102, None, False)]
    end, begin = b"\0end", b"\0begin"
    tokens = {i: [*words(t), end] for i, t, _ in rows}
    train = [tokens[i] for i, _, held in rows if not held]
    count = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip([begin, *t], t))
    total = sum(count.values())

    def factors(values):
        found = collections.Counter(values)
        return lm.discounts([found.get(r, 0) if r else 0 for r in range(lm.DISCOUNTED + 2)])

    single, double = factors(count.values()), factors(pairs.values())

    def kept(n, factor):
        return n * (factor[n] if n <= lm.DISCOUNTED else 1)

    share = {w: kept(n, single) / total for w, n in count.items()}
    unknown = 1 - sum(share.values())
    after = collections.defaultdict(dict)
    for (h, w), n in pairs.items():
        after[h][w] = n

    def p(h, w):
        seen = after.get(h, {})
        of = sum(seen.values())
        often = h in after and min(seen.values()) > lm.DISCOUNTED
        of += often and of <= lm.FREQUENT * total
        if w in seen:
            return kept(seen[w], double) / of
        free = 1 - sum(kept(n, double) for n in seen.values()) / of if seen else 1
        free /= 1 - sum(share[x] for x in seen)
        return free * share.get(w, unknown)

    for h in list(after)[:20]:
        assert math.isclose(sum(p(h, w) for w in [*share, None]), 1, rel_tol=1e-9)
    frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    for r in lm.scored(frame).collect():
        t = tokens[r.doc_id]
        want = sum(math.log10(p(h, w)) for h, w in zip([begin, *t], t))
        assert math.isclose(r.score, want, rel_tol=1e-9)
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in t)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), total)


def test_every_word_is_in_the_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 20_000)
    monkeypatch.setattr(lm, "BUCKET_WORDS", 30_000)
    rng = random.Random(8)
    rare = [f"w{i}" for i in range(300_000)]
    texts = [rare[i : i + 1000] for i in range(0, 300_000, 1000)]
    texts += [rng.choices(rare[:20_000] + WORDS * 200, k=1000) for _ in range(60)]
    held = [rng.choices([*rare, *WORDS * 1000, "never"], k=50) for _ in range(40)]
    rows = [(i, " ".join(t), i >= len(texts)) for i, t in enumerate(texts + held)]
    texts, held = [[*t, "\0"] for t in texts], [[*t, "\0"] for t in held]
    count = collections.Counter(w for t in texts for w in t)
    pairs = collections.Counter(p for t in texts for p in zip(["", *t], t))
    total, of = sum(count.values()), collections.Counter()
    for (h, _), n in pairs.items():
        of[h] += n

    def factors(values):
        found = collections.Counter(values)
        return [*lm.discounts([0, *(found[r] for r in range(1, lm.DISCOUNTED + 2))]), 1.0]

    single, double = factors(count.values()), factors(pairs.values())
    share = {w: n * single[min(n, lm.DISCOUNTED + 1)] / total for w, n in count.items()}
    unknown = 1 - math.fsum(share.values())
    left, unseen, few = collections.Counter(of), collections.Counter(), set()
    for (h, w), n in pairs.items():
        left[h] -= n * double[min(n, lm.DISCOUNTED + 1)]
        unseen[h] += share[w]
        few |= {h} if n <= lm.DISCOUNTED else set()

    def p(h, w):
        more = h in of and h not in few and of[h] <= lm.FREQUENT * total
        n = pairs[h, w]
        if n:
            return n * double[min(n, lm.DISCOUNTED + 1)] / (of[h] + more)
        free = (left[h] + more) / (of[h] + more) if h in of else 1
        return free / (1 - unseen[h]) * share.get(w, unknown)

    frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    found = lm.scored(frame).collect()
    assert len(count) > 1 << 18 and len(found) == len(rows)
    for r in found:
        t = (texts + held)[r.doc_id]
        want = math.fsum(math.log10(p(h, w)) for h, w in zip(["", *t], t))
        assert math.isclose(r.score, want, rel_tol=1e-9)
        assert r.n_known == sum(w in count for w in t)


def test_a_repeated_pair_is_sent_once_per_block(spark, monkeypatch):
    asked, counted = [], lm._counted
    monkeypatch.setattr(lm, "_counted", lambda rows, shared: asked.append(rows) or counted(rows, shared))
    frame = spark.createDataFrame([(i, "round and " * 1000, False) for i in range(40)], "doc_id long, text string, held_out boolean").coalesce(1)
    assert lm.scored(frame).count() == 40
    sent = [(r.block, lm._sorted_unpacked(bytes(r.a)), lm._unpacked(bytes(r.b))) for r in asked[0].collect() if r.kind in ("ask", "pair")]
    assert sum(len(pairs) for _, pairs, _ in sent) == 4 * len({block for block, _, _ in sent})
    assert sum(n.sum() for _, _, n in sent) == 40 * 2001


def test_lm_edge_rows(docs, nothing):
    from pyspark.sql import functions as F

    rows = lm.scored(docs.withColumn("held_out", F.col("doc_id") % 3 == 1)).collect()
    assert len(rows) == len(corpus())
    for r in rows:
        assert math.isfinite(r.score) and r.score < 0 and r.n_known <= r.n_tokens
    assert {r.n_tokens for r in rows if r.doc_id in (6, 7, 8)} == {1}
    assert lm.scored(nothing.withColumn("held_out", F.lit(False))).count() == 0


def test_languages(docs, spark):
    from pyspark.sql import functions as F

    learned = spark.createDataFrame([("the of and to in that with", "en")] * 20 + [("les des une dans pour avec est", "fr")] * 20, "text string, lang string")
    model = langid.learn(learned)
    asked = [(1, "and that in the", True), (2, "dans une des", True), (3, None, True), (4, "123 !", True), (5, "", True)]
    found = {r.doc_id: r for r in langid.predicted(spark.createDataFrame(asked, "doc_id long, text string, held_out boolean"), model).collect()}
    assert [found[i].lang_pred for i in range(1, 6)] == ["en", "fr", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in found.values())
    none = langid.learn(learned.limit(0))
    everything = langid.predicted(docs.withColumn("held_out", F.lit(True)), none).collect()
    assert {r.lang_pred for r in everything} == {"und"} and len(everything) == len(corpus())


def test_a_language_of_one_short_text_is_learned(spark):
    learned = [("the of and to in that with", "en")] * 20 + [("quick brown vexing jumps", "xx")]
    model = langid.learn(spark.createDataFrame(learned, "text string, lang string"))
    asked = spark.createDataFrame([(1, "brown jumps", True), (2, "and that", True)], "doc_id long, text string, held_out boolean")
    assert model.languages == ["en", "xx"]
    assert {r.doc_id: r.lang_pred for r in langid.predicted(asked, model).collect()} == {1: "xx", 2: "en"}


def test_edited_fingerprints(docs):
    found = spotsigs.edited_fingerprints(docs).collect()
    rows = sorted(
        ((i, t or "") for i, t, *_ in corpus()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    want = collections.Counter()
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        changed = spotsigs.edited(text, following)
        own, new, other = spotsigs.fingerprints([text, changed, following])
        want[
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), spotsigs.encoded(own),
             round(spotsigs.likeness(own, new), 9), round(spotsigs.likeness(own, other), 9))
        ] += 1
    got = collections.Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
        for r in found
    )
    assert got == want


def test_similar_fingerprints(spark):
    text = prose(1, 300)
    rows = [(1, text), (2, text), (3, text + " bal"), (4, prose(2, 300)), (5, None)]
    found = spotsigs.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.a, r.b) for r in found] in ([(1, 3)], [])
    one, three = spotsigs.fingerprints([text, text + " bal"])
    assert bool(found) == (not np.array_equal(one, three))


def test_empty_tables(nothing, spark):
    pages = spark.createDataFrame([], PAGES)
    for frame in (
        mixing.mix(nothing), mixing.mixed_documents(nothing), packing.packed(nothing),
        ngram_join.similar_components(nothing), ngram_join.one_per_group(nothing),
        quality.judged(nothing), quality.accepted(nothing), substrings.deduplicated(nothing),
        extraction.extracted(pages), spotsigs.edited_fingerprints(nothing),
    ):
        assert frame.count() == 0


def test_pipeline_stages(docs, tmp_path):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(docs.sparkSession, docs, "").columns == docs.columns, name
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(docs.sparkSession, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= {r[0] for r in corpus()} and rows


def test_cutting_texts_changes_no_ids(monkeypatch):
    """Ids of segments against the tokenizer's for whole texts."""
    from tokenizers import Tokenizer

    import pyarrow as pa

    rng = random.Random(12)
    parts = ["a", "The", "ing", ".", " ", ",", "  ", "\n", "é", "漢", " ", "　", " ", " ", "😀", "12", "'s", "'",
             "!", "...", "\t", " a", " b.", "\x85", "’", "$", "x'll"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(6000)]
    texts += [None, "", "x" * 3000, "a b " * 900, " " * 2000, prose(3, 3000)]
    whole = Tokenizer.from_file(packing.tokenizer_path())
    want = [x.ids for x in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for held in (packing.ENCODED_BYTES, 700):  # a window that cuts most texts
        monkeypatch.setattr(packing, "ENCODED_BYTES", held)
        found = packing._Encoder(packing.tokenizer_path())(pa.array(texts, pa.string()))
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == want


def test_encoding_takes_bounded_memory(monkeypatch):
    """Neither a worker's memory of segments nor its arrays grow with the texts."""
    import tracemalloc

    from tokenizers import Tokenizer

    import pyarrow as pa

    whole = Tokenizer.from_file(packing.tokenizer_path())
    texts = [prose(seed, 40) + f" new{seed} " + "漢" * 300 for seed in range(200)]
    want = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    with monkeypatch.context() as m:
        m.setattr(packing, "REMEMBERED", 50)
        encode = packing._Encoder(packing.tokenizer_path())
        for _ in range(2):
            found = encode(pa.array(texts, pa.string()))
            assert [np.frombuffer(x, "<u4").tolist() for x in found] == want
            assert len(encode.known) + len(encode.before) <= 100
            assert max(map(len, [*encode.known, *encode.before])) <= 64
    column = pa.array([prose(seed, 400_000) for seed in (1, 2)], pa.string())
    assert column.nbytes > 3 << 20
    tracemalloc.start()
    encode(column)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 << 20


def test_tasks_give_back_freed_memory():
    """What a task has freed does not stay with the waiting worker."""
    import re
    from pathlib import Path

    import pyarrow as pa
    from tidemark.llm.common import frugal

    def held() -> int:
        found = re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
        return int(found[0]) >> 10

    last = []

    @frugal
    def task(batches):
        for batch in batches:
            parts = [np.ones(7_000) for _ in range(4_000)]
            last.append(np.ones(7_000))  # lies behind the freed ones
            yield batch
            del parts

    batch, before = pa.RecordBatch.from_pydict({"x": [1]}), held()
    reached = [held() for _ in task(iter([batch, batch]))]
    assert min(reached) > before + 150 and held() < before + 50
    for module, name in (
        (packing, "cut"), (ngram_join, "count"), (ngram_join, "sign"), (ngram_join, "spread"),
        (ngram_join, "sets"), (substrings, "cut"), (substrings, "possible"), (substrings, "clean"),
    ):
        assert f"@frugal\n    def {name}(batches)" in Path(module.__file__).read_text()
