"""Main text of web pages by a site style tree.

All elements of a page are nodes, named by the chain of styles (tag, id, classes) above them; over the distinct pages of
a host the chains form the site's style tree.  A node that stands on m pages has a presentation importance (entropy, base
m, of its child sequences over those pages) and a content importance (one minus the mean entropy of the texts at and below
it).  With l different child sequences its importance is ``(1 - g ** l) * presentation + g ** l * content``, g = 0.9, so an
element that is always built alike is judged by what it says.  A branch none of whose nodes reaches the threshold is taken
out of every page of the host.  Elements that the markup itself declares to be something else than the article (nav,
footer, aside, form ..., roles, hidden parts, classes that are nothing but such words) go too: reader comments, for
instance, differ on every page, which no entropy can tell from an article.

Defined results: null and empty html gives empty text; pages without a host, and the only page of a host, have no
evidence and are cleaned by markup alone; equal pages count as one; an article that the host's pages all share is not
judged by its own repetition, nor is a site whose pages hold nothing else; repeated rows get the same text; an empty table
gives an empty result; blocks more than 256 deep are part of the node above them.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.llm.common import materialize

# A quote opens a quoted value only behind "="; elsewhere, and where it is never closed, it is a character like others.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is no text of the page; unclosed, the first two reach to the end and the others are empty.
RAW = frozenset("script style noscript template iframe textarea title svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Opening a key closes an open element of its values, up to the elements in SCOPE.
CLOSES = {
    **dict.fromkeys(BLOCK - {"html", "head", "body"}, ("p",)),
    "li": ("p", "li"),
    "dt": ("p", "dt", "dd"),
    "dd": ("p", "dt", "dd"),
    "option": ("option",),
    "tr": ("p", "tr", "td", "th"),
    "td": ("p", "td", "th"),
    "th": ("p", "td", "th"),
    "body": ("head",),
}
SCOPE = frozenset("article aside blockquote body div dl fieldset footer form header html main nav ol section table td th ul".split())
DROP_TAGS = frozenset("head nav footer aside form button select menu dialog audio video canvas search".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar comment".split())
#: A class (or the id of a plain container) says that an element is no article text where all of its words are in these
#: two sets and one is in the first: ``cookie-notice`` and ``comment-list-2``, but not ``related-work`` or ``side-effects``.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion promotions cookie cookies consent gdpr notice notices "
    "alert alerts popup popups modal newsletter newsletters subscribe subscription comment comments disqus respond replies reply sidebar sidebars widget widgets "
    "related recommended recommendations share sharing social menu menus navbar nav navigation breadcrumb breadcrumbs pagination pager footer masthead copyright "
    "login signup searchbox toolbar hidden banner banners".split()
)
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box button buttons column container content first form group header icons inline inner item items last left link links list main outer page panel "
    "post posts reader row section site skip slot sticky story stories text thread title top unit user wrap wrapper right side articles article".split()
)
#: An article of its own that is marked by one of these is a reader's.
READER_WORDS = frozenset("comment comments reply replies respond".split())
#: Classes of a site's header, which within an article go too; an article's own (``post-header``) stays there.
SITE_HEADERS = (frozenset(["header"]), frozenset(["site", "header"]))
#: Blocks nested deeper than this belong to the node of this depth, so that paths stay short.
DEEPEST = 256
CONTAINERS = frozenset("div aside ul ol dl table form span p center fieldset".split())


@dataclass
class Block:
    path: str
    main: bool
    text: str


@dataclass
class Element:
    tag: str
    path: str
    drop: bool
    main: bool
    judged: bool  # by the style tree
    depth: int = 0  # in blocks


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def _words(token: str) -> set[str]:
    return {w.lower() for w in re.split(r"[-_]+|\d+|(?<=[a-z])(?=[A-Z])", token) if w}


def _parts(word: str) -> set[str]:
    """A word of two known ones of four letters or more is these two: ``commentlist``."""
    known = OTHER_WORDS | LAYOUT_WORDS
    for k in range(4, len(word) - 3) if word not in known else ():
        if word[:k] in known and word[k:] in known:
            return {word[:k], word[k:]}
    return {word}


def _other(token: str, telling: frozenset = OTHER_WORDS) -> bool:
    words = {p for w in _words(token) for p in _parts(w)}
    return bool(words & telling) and words <= OTHER_WORDS | LAYOUT_WORDS


def _declared(tag: str, attributes: dict[str, str], in_main: bool) -> bool:
    """The markup says that this element is no part of the article."""
    if tag in DROP_TAGS or (tag == "header" and not in_main):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in DROP_ROLES or attributes.get("itemprop", "").lower() == "comment":
        return True
    classes = attributes.get("class", "").split()
    if tag == "article" and not in_main:
        return any(_other(c, READER_WORDS) for c in classes)
    names = classes + (attributes.get("id", "").split() if tag in CONTAINERS else [])
    if any(map(_other, names)):
        return True
    # A header of any other element than the tag of that name, which an article has for its title.
    return any("header" in (w := _words(n)) and (w in SITE_HEADERS or (not in_main and w <= LAYOUT_WORDS)) for n in names) and tag in CONTAINERS | {"section"}


def parse(page: str | None, low: frozenset = frozenset(), declared: bool = True) -> tuple[list[Block], dict[str, list[str]]]:
    """Blocks of a page in order, and the children's labels of each block element by its path.

    Left out are branches whose path is in ``low`` and, unless ``declared`` is false, what the markup declares.
    """
    page = page or ""
    stack = [Element("", "", False, False, True)]
    blocks: list[Block] = []
    styles: dict[str, list[str]] = {}
    held: list[str] = []

    def end_block() -> None:
        if held:
            # White space of any kind is one space; references were decoded in each text node before.
            text = " ".join("".join(held).split())
            held.clear()
            top = stack[-1]
            if text and not top.drop:
                blocks.append(Block(top.path, top.main, text))

    def pop_to(k: int) -> None:
        if any(e.tag in BLOCK for e in stack[k:]):
            end_block()
        elif any(e.drop for e in stack[k:]) and not stack[k - 1].drop:
            held[:] = held[: marks.pop(k, len(held))] + [" "]
        opened.subtract(e.tag for e in stack[k:])
        del stack[k:]

    opened: Counter[str] = Counter()  # open elements by tag
    marks: dict[int, int] = {}  # where the text of a dropped inline element begins, by its depth
    at = 0
    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            held.append(entities.unescape(page[at:]))
            break
        if m.start() > at:
            held.append(entities.unescape(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                held.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0) if opened[tag] else 0
            if k:
                pop_to(k)
            elif tag == "p":
                end_block()
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = close.end() if close else size if tag in ("script", "style") else at
            if tag not in ("title", "textarea"):
                held.append(" ")
            continue
        if tag in BLOCK:
            end_block()
        for other in CLOSES.get(tag, ()):
            for i in () if not opened[other] else range(len(stack) - 1, 0, -1):
                if stack[i].tag == other:
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        top = stack[-1]
        if tag in VOID:
            if tag == "br":
                held.append(" ")
            continue
        attributes = _attributes(m[3]) if m[3].strip(" /") else {}
        path, drop, judged, depth = top.path, top.drop, top.judged, top.depth
        if tag in BLOCK and depth < DEEPEST:
            depth += 1
            label = tag + "".join(f".{c}" for c in sorted(attributes.get("class", "").split())) + (f"#{attributes['id']}" if attributes.get("id") else "")
            label = re.sub(r"[0-9]+", "0", label).replace("/", "_")
            styles.setdefault(top.path, []).append(label)
            path = f"{top.path}/{label}"
            if judged and path in low:
                # An article that says the same on all pages of the host is not judged by that, nor is a whole page.
                judged = tag not in ("html", "body", "article", "main")
                drop = drop or judged
        if declared and not drop:
            drop = _declared(tag, attributes, top.main)
        if drop and not top.drop and tag not in BLOCK:
            marks[len(stack)] = len(held)
        stack.append(Element(tag, path, drop, top.main or tag in ("article", "main"), judged, depth))
        opened[tag] += 1
    if len(stack) > 1:
        pop_to(1)
    end_block()
    return blocks, styles


def main_text(page: str | None, low: frozenset = frozenset(), declared: bool = True) -> str:
    """The article's blocks; all blocks that are left where no element is marked as the article."""
    blocks, _ = parse(page, low, declared)
    return "\n".join(b.text for b in [b for b in blocks if b.main] or blocks)


def page_features(page: str | None) -> tuple[int, list[tuple[str, int, int]]]:
    """A digest of all that a page shows, and its nodes (kind 0), child sequences (1) and block texts (2) with their hashes."""
    blocks, styles = parse(page, declared=False)
    nodes = {b.path for b in blocks} | {p for p in styles if p}
    seen = {(p, 0, 0) for p in nodes}
    seen |= {(p, 1, xxhash.xxh64_intdigest(">".join(dict.fromkeys(styles[p])))) for p in nodes & styles.keys()}
    seen |= {(b.path, 2, xxhash.xxh64_intdigest(b.text)) for b in blocks}
    return xxhash.xxh64_intdigest("\n".join(f"{b.path}\t{b.text}" for b in blocks)), sorted(seen)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("path", pa.string()), ("kind", pa.int32()), ("mark", pa.int64())]))
    for b in batches:
        made = [page_features(p.as_py()) for p in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_signed(d) for d, _ in made], pa.int64()), pa.array([[{"path": p, "kind": k, "mark": _signed(h)} for p, k, h in rows] for _, rows in made], kind)],
            ["host", "page", "features"],
        )


def host_of(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def ancestors(path: Column) -> Column:
    """The paths of a node and of all nodes above it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def style_tree(pages: DataFrame, url: str = "url", html: str = "html", decay: float = 0.9) -> DataFrame:
    """Nodes of all hosts' style trees: host, path, pages, importance, and best (the highest importance in its branch)."""
    rows = pages.where(F.col(url).isNotNull()).select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).where("host is not null")
    seen = rows.mapInArrow(_features, "host string, page long, features array<struct<path string, kind int, mark long>>")
    each = seen.dropDuplicates(["host", "page"]).select("host", F.explode("features").alias("f")).select("host", "f.*")
    n = each.groupBy("host", "path", "kind", "mark").agg(F.count(F.lit(1)).cast("double").alias("n"))
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    facts = n.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
        of(1, F.col("n") * F.ln("n")).alias("shapes_ln"),
        F.count_if(F.col("kind") == 1).alias("shapes"),
        of(2, F.col("n")).alias("texts"),
        of(2, F.col("n") * F.ln("n")).alias("texts_ln"),
    )
    # Entropies to base m; all are 0 where there is one page.
    facts = materialize(
        facts.select(
            "host",
            "path",
            "m",
            "shapes",
            F.coalesce(F.try_divide(F.ln("m") - F.try_divide("shapes_ln", "m"), F.ln("m")), F.lit(1.0)).alias("presentation"),
            F.coalesce("texts", F.lit(0.0)).alias("texts"),
            F.coalesce(F.try_divide("texts_ln", F.ln("m")), F.lit(0.0)).alias("same"),
        ),
        "tree",
    )
    below = facts.where("texts > 0").select("host", F.explode(ancestors(F.col("path"))).alias("path"), "texts", "same").groupBy("host", "path").agg(F.sum("texts").alias("all"), F.sum("same").alias("same"))
    fade = F.pow(F.lit(decay), F.col("shapes"))
    scored = facts.select("host", "path", "m", "shapes", "presentation").join(below, ["host", "path"]).select(
        "host",
        "path",
        F.col("m").cast("long").alias("pages"),
        F.when(F.col("m") < 2, F.lit(1.0)).otherwise((1 - fade) * F.col("presentation") + fade * (1 - F.col("same") / F.col("all"))).alias("importance"),
    )
    best = scored.select("host", F.explode(ancestors(F.col("path"))).alias("path"), "importance").groupBy("host", "path").agg(F.max("importance").alias("best"))
    return scored.join(best, ["host", "path"])


def _extract(declared: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py(), frozenset(low.as_py() or ()), declared) for p, low in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["_key", "url", "text", "n_chars"])

    return run


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", threshold: float = 0.5, declared: bool = True
) -> DataFrame:
    """Per page: key, url, text, n_chars.  ``declared=False`` leaves all to the style tree."""
    lean = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("_html"))
    # One row per host that has such branches; written, so that its size is known when it is joined.
    low = materialize(style_tree(lean, "url", "_html").where(F.col("best") < threshold).groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("low")), "style")
    joined = lean.withColumn("_host", host_of(F.col("url"))).join(low.withColumnRenamed("host", "_host"), "_host", "left")
    schema = f"_key {dict(pages.dtypes)[key]}, url string, text string, n_chars long"
    return joined.select("_key", "url", "_html", "low").mapInArrow(_extract(declared), schema).withColumnRenamed("_key", key)
