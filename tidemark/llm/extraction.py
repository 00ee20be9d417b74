"""Main text of pages, by templates deduced per host.

A token is the path of a block element (names, classes, ids without digits); those on most
pages of a host are its template. The texts at one path of a page fill a slot. A slot that
most of the host's differing pages fill alike is template text, whatever its names, and is
boilerplate. So are slots under menus, adverts and the like, by the names on their path,
which tell boilerplate that varies. Of the others the template subtree that holds the article
is kept: one marked as article or main content, or else the deepest that has most of the
running text. Slots are judged whole: a sentence that comes on every page among varying
paragraphs of the same path belongs to the article.

Sums are formed within tasks, so that a host with a third of all pages costs no more shuffle
than others.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

#: A token is part of the template if it is on this share of its host's pages, and on two.
SUPPORT = 0.5
#: A slot is template text if so many differing pages, and SUPPORT of them, fill it alike.
LEAST_ALIKE = 3
#: A subtree without marks holds the article if it has this share of the running text.
DOMINANT = 0.6
#: Entries that a task sums before it writes them out.
HELD = 100_000

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(script|style|textarea|title)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*>(?:.*?</\1\s*>|.*\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
#: Elements that go with their content, if they are closed before the next one opens.
_DROPPED = {
    tag: re.compile(rf"<(/?){tag}\b[^>]*>", re.IGNORECASE)
    for tag in "noscript template svg iframe select button object".split()
}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track".split()
)
_CLOSED_BY_BLOCK = frozenset(["p"])
_CLOSED_BY_SAME = frozenset("li dt dd tr td th option".split())
_BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu head".split())
_BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments "
    "consent contentinfo cookie cookies disqus footer masthead menu modal nav navbar navigation "
    "newsletter notice popup promo related respond share sharing sidebar social sponsor "
    "sponsored subscribe widget".split()
)
#: Words of a name that say what a block has around it, or has not; it is no such block then.
_QUALIFIERS = frozenset("has no not with without layout".split())
_NEVER_BOILERPLATE = frozenset("html body main".split())
_MAIN = re.compile(r"(?:article|main)(?:[.#]|$)|.*[.#]main(?:[.#]|$)")
_NAME = re.compile(r"[a-z]+")


def _attributes(raw: str) -> dict[str, str]:
    return {
        name.lower(): value.strip("\"'").lower() for name, value in _ATTRIBUTE.findall(raw)
    }


def _names_boilerplate(name: str) -> bool:
    parts = set(_NAME.findall(name))
    return bool(parts & _BOILERPLATE_NAMES) and not parts & _QUALIFIERS


def _component(tag: str, raw: str) -> tuple[str, bool, bool]:
    """An element as written in paths; whether it is boilerplate by tag or state, and by name."""
    if not raw.strip(" /\n\t"):
        return tag, tag in _BOILERPLATE_TAGS, False
    found = _attributes(raw)
    names = [n for key in ("class", "id", "role") for n in found.get(key, "").split()]
    hidden = "hidden" in found or found.get("aria-hidden") == "true"
    hidden = hidden or "display:none" in found.get("style", "").replace(" ", "")
    named = tag not in _NEVER_BOILERPLATE and any(map(_names_boilerplate, names))
    label = ".".join([tag, *sorted(re.sub(r"\d+", "", name) for name in names)])
    return label, tag in _BOILERPLATE_TAGS or hidden, named


def blocks(html: str) -> Iterator[tuple[str, str | None, int, bool]]:
    """Opened elements and texts of a page in order.

    ``(path, None, 0, out)`` for each opened block element, ``(path, text, link characters,
    out)`` for each block of text; ``out`` tells boilerplate by tag, state or name. Names of
    blocks around it never make the main element or the page's first article boilerplate.
    Unfinished tags end the page; of dropped elements that are never closed, the tag goes.
    """
    # Tag, path, boilerplate, boilerplate by tag or state.
    stack: list[tuple[str, str, bool, bool]] = []
    articles = 0
    held: list[str] = []
    linked = links = 0

    def close() -> Iterator[tuple[str, str | None, int, bool]]:
        nonlocal linked
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            path, out = (stack[-1][1], stack[-1][2]) if stack else ("", False)
            yield path, text, min(linked, len(text)), out
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        held.append(text)
        if links:
            linked += len(text)

    def pop(index: int) -> None:
        del stack[index:]

    last = 0
    while match := _TOKEN.search(html, last):
        if match.start() > last:
            add(html[last : match.start()])
        last = match.end()
        tag = (match[3] or "").lower()
        if not tag:
            continue
        if tag in _DROPPED:
            end = None if match[2] else _DROPPED[tag].search(html, last)
            last = end.end() if end and end[1] else last
            held.append(" ")
            continue
        if tag == "br":
            held.append(" ")
        elif tag in _INLINE:
            if tag == "a":
                links = max(0, links + (-1 if match[2] else 1))
        elif match[2]:
            yield from close()
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if at is not None:
                pop(at)
        elif tag in _VOID:
            yield from close()
        else:
            yield from close()
            links = 0
            if stack and stack[-1][0] in _CLOSED_BY_BLOCK:
                pop(len(stack) - 1)
            if stack and tag in _CLOSED_BY_SAME and stack[-1][0] == tag:
                pop(len(stack) - 1)
            name, out, named = _component(tag, match[4])
            inner = any(x[0] in ("article", "main") for x in stack)
            if tag == "header" and not inner:
                out = True
            path, above, strictly = stack[-1][1:] if stack else ("", False, False)
            if not strictly and (tag == "main" or (tag == "article" and not articles)):
                above = False
            articles += tag == "article" and not (out or named or above)
            strictly = strictly or out
            stack.append((tag, f"{path}>{name}", strictly or named or above, strictly))
            yield stack[-1][1], None, 0, stack[-1][2]
    if last < len(html):
        rest = html[last:]
        cut = re.search(r"<(?:[a-zA-Z/!?]|\Z)", rest)
        add(rest[: cut.start()] if cut else rest)
    yield from close()


def host_of(url: Column) -> Column:
    """The host of an address, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1))


_SUMS = "host string, path string, pages long, chars long"


def _occurrences(pages: DataFrame) -> DataFrame:
    """Per host and path: its pages and running text."""

    def count(batches):
        sums: dict[tuple[str, str], list] = {}

        def written():
            keys = list(sums)
            columns = list(zip(*sums.values(), strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.string()),
                    *(pa.array(c, pa.int64()) for c in columns),
                ],
                [part.split()[0] for part in _SUMS.split(", ")],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("host", "html")]
            for host, html in zip(*columns, strict=True):
                seen: dict[str, int] = {"": 0}
                for path, text, linked, out in blocks(html):
                    running = len(text) - linked if text is not None and not out else 0
                    seen[path] = seen.get(path, 0) + running
                for path, chars in seen.items():
                    entry = sums.setdefault((host, path), [0, 0])
                    entry[0] += 1
                    entry[1] += chars
                if len(sums) >= HELD:
                    yield written()
                    sums.clear()
        if sums:
            yield written()

    rows = pages.select("host", "html").mapInArrow(count, _SUMS)
    return rows.groupBy("host", "path").agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars")
    )


def templates(pages: DataFrame) -> DataFrame:
    """``host, path, chars``: each host's template tokens. Reads ``host, page_id, html``."""
    counted = staged(_occurrences(pages), "occurrences")
    total = counted.filter("path = ''").select("host", F.col("pages").alias("all"))
    frequent = counted.filter("path != ''").join(total, "host").filter(
        (F.col("pages") >= 2) & (F.col("pages") >= SUPPORT * F.col("all"))
    )
    return frequent.select("host", "path", "chars")


def _number(*parts: str) -> int:
    raw = "\0".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def slots(found: list[tuple[str, str | None, int, bool]]) -> dict[str, int]:
    """A number for what fills each path of a page that has text."""
    held: dict[str, list[str]] = {}
    for path, text, _, _ in found:
        if text:
            held.setdefault(path, []).append(text)
    return {path: _number(path, *texts) for path, texts in held.items()}


def template_texts(pages: DataFrame) -> DataFrame:
    """``alike_host, alike``: the slots that most pages of a host fill alike, as numbers.

    Pages with the same texts count once, so that copies of an article do not make it a
    template. A host has at most twice as many such slots as its pages have on average.
    """

    def fill(batches):
        for batch in batches:
            filled = [
                slots(list(blocks(html))) for html in batch.column("html").to_pylist()
            ]
            whole = [_number(*map(str, sorted(page.values()))) for page in filled]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"),
                    pa.array(whole, pa.int64()),
                    pa.array([list(page.values()) for page in filled], pa.list_(pa.int64())),
                ],
                ["host", "whole", "slots"],
            )

    rows = pages.select("host", "html").mapInArrow(
        fill, "host string, whole long, slots array<long>"
    )
    rows = staged(rows.dropDuplicates(["host", "whole"]), "slots")
    total = rows.groupBy("host").agg(F.count("*").alias("all"))
    alike = rows.select("host", F.explode("slots").alias("slot")).groupBy("host", "slot").count()
    return (
        alike.filter(F.col("count") >= LEAST_ALIKE)
        .join(total, "host")
        .filter(F.col("count") >= SUPPORT * F.col("all"))
        .groupBy(F.col("host").alias("alike_host"))
        .agg(F.collect_list("slot").alias("alike"))
    )


def _covers(root: str, path: str) -> bool:
    return path == root or path.startswith(root + ">")


def article_root(weights: dict[str, int]) -> str | None:
    """The path that holds the article, given running text by path (boilerplate has none)."""
    marked = [p for p in weights if _MAIN.match(p.rpartition(">")[2])]
    if marked:
        def under(root):
            return sum(n for p, n in weights.items() if _covers(root, p))
        best = max(marked, key=lambda p: (under(p), -len(p), p))
        if under(best):
            return best
    total = sum(weights.values())
    roots = {p[: m.start()] for p in weights for m in re.finditer(r">|\Z", p) if m.start()}
    heavy = [
        root
        for root in roots
        if sum(n for p, n in weights.items() if _covers(root, p)) >= DOMINANT * total
    ]
    # Never one of the blocks that only hold text themselves: their container.
    heavy = [r for r in heavy if not re.fullmatch(r"(?:p|h[1-6]|li|td|pre|blockquote)\b.*", r.rpartition(">")[2])]
    return max(heavy, key=lambda p: (p.count(">"), p)) if total and heavy else None


def host_roots(pages: DataFrame) -> DataFrame:
    """``root_host, root``: the template subtree that holds the articles of a host."""

    def choose(group: pa.Table) -> pa.Table:
        rows = group.to_pydict()
        root = article_root(dict(zip(rows["path"], rows["chars"], strict=True)))
        return pa.table(
            {"root_host": pa.array(rows["host"][:1], pa.string()), "root": pa.array([root], pa.string())}
        )

    return (
        templates(pages)
        .select("host", "path", "chars")
        .groupBy("host")
        .applyInArrow(choose, "root_host string, root string")
    )


def main_text(html: str, root: str | None, alike: list[int] | None = None) -> str:
    """Text of the slots under ``root``, or of the page's own best subtree without one.

    ``alike`` are the numbers of the host's template texts.
    """
    found = list(blocks(html))
    fixed = set(alike or ())
    fixed = {path for path, number in slots(found).items() if number in fixed} if fixed else fixed
    kept = [
        (path, text, linked)
        for path, text, linked, out in found
        if text and not out and path not in fixed
    ]
    if root is None or not any(_covers(root, path) for path, _, _ in kept):
        weights: dict[str, int] = {}
        for path, text, linked in kept:
            weights[path] = weights.get(path, 0) + len(text) - linked
        for path, text, _, out in found:
            if text is None and not out:
                weights.setdefault(path, 0)
        root = article_root(weights)
    if root is not None:
        kept = [part for part in kept if _covers(root, part[0])]
    return " ".join(text for _, text, _ in kept)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    Null html is empty and has an empty text. Pages without host are one host. A host of one
    page has no template, and its page is judged alone, as are pages that lack their host's
    article subtree. Text that is equal on all pages of a host goes from ``LEAST_ALIKE``
    differing pages on; with fewer there is no telling, so it stays unless named as boilerplate. Repeated rows count as pages. An empty table gives an empty result.
    """
    rows = pages.select(
        "page_id",
        "url",
        host_of(F.col("url")).alias("host"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    roots = staged(host_roots(rows), "article-roots")
    alike = staged(template_texts(rows), "template-texts")
    joined = rows.join(roots, F.col("host") == F.col("root_host"), "left").join(
        alike, F.col("host") == F.col("alike_host"), "left"
    )

    def extract(batches):
        for batch in batches:
            texts = [
                main_text(html, root, alike)
                for html, root, alike in zip(
                    *(batch.column(c).to_pylist() for c in ("html", "root", "alike")), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "root", "alike").mapInArrow(
        extract, f"page_id {kind}, url string, text string, n_chars long"
    )


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))
