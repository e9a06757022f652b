"""Main text of web pages by a site style tree.

The pages of a host are merged into one style tree: a node for each path of block elements with their
presentation (tag, class, id). Over all pages of the host a node has a presentation importance (entropy
of the ways its children are laid out) and a content importance (one less the mean entropy of its text
blocks over the pages: text that repeats everywhere counts 0, text of one page 1); the importance of a
text node is their mixture. Presentation that names its own role is a weight in the decision: menus, footers,
forms, adverts and reader comments count 0 whatever the tree says. A node without a declared role goes from
every page of the host if its importance is ``LOW`` on enough pages. A node of an article or main
element goes only below ``LOW_MAIN``, and only where another such node of the host is as important as
``HIGH``: on a host whose pages are all alike nothing tells the text from its frame. On a page with an
article, what is left outside counts only if it is ``MAIN_WEIGHT`` times as long as what is left
inside (a body beside a teaser); else the article alone is the text.

Text blocks end at block elements; character references are decoded, white space becomes one space,
and blocks are joined by an empty line. The tree's table is counted by two combinable aggregates, so a
host with a third of all pages is no hot group. Low nodes reach the pages by broadcast while there are
no more than ``BROADCAST_NODES`` of them, by a join on the host beyond.

Defined cases: null or empty html gives an empty text; a null url or one without host belongs to the
host ''; unclosed, misnested and unknown tags are tolerated; equal pages count each; texts are read whole
whatever their length; columns that are not asked for do not matter, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_module
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import store, utf8
from parcelflow.llm.urls import host_of

#: Pages of a host that a node needs before its importance can remove it.
LEAST_PAGES = 5
#: Share of the content importance in the mixture, and the importance below which a node goes.
CONTENT_SHARE, LOW = 0.9, 0.35
#: The importance below which a node of the declared main text goes, and the one that another has to have for that.
LOW_MAIN, HIGH = 0.15, 0.5
#: How many times longer than the declared main text the text outside has to be.
MAIN_WEIGHT = 2
#: Low nodes that go to all tasks as one small table (16 bytes each).
BROADCAST_NODES = 100_000

# Element names by role, and words of class, id and role attributes that declare boilerplate.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset(
    "head nav aside footer form script style noscript template iframe object svg canvas audio video button select "
    "textarea input label dialog menu search noembed noframes title".split()
)
DECLARED = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion "
    "banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments discussion disqus respond reply replies widget widgets toolbar "
    "pagination pager skip search searchbox contentinfo complementary".split()
)
#: Words that leave a role word beside them its meaning (``comment-list``, ``site-footer``).
PLACES = frozenset(
    "area article bar block body bottom box container entry form group header inner left link links list outer post "
    "right section site thread top user wrap wrapper".split()
)
#: Open elements that a start tag ends.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
_SCOPES = frozenset("ul ol dl table select article section div body html main td th".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
#: One attribute after the other, values whole, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s/>"'=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']\S*)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: What a text block is by its declared role.
NOISE, OPEN, MAIN = 0, 1, 2


class _Element:
    __slots__ = ("children", "label", "path", "role", "soft", "tag")

    def __init__(self, tag: str, label: str, path: str, role: int, soft: bool = False):
        self.tag, self.label, self.path, self.role, self.soft, self.children = tag, label, path, role, soft, []


def _declared(value: str) -> bool:
    """Whether one of the words of an attribute is made of role words, beside words of place and numbers only
    (``cookie-notice``, ``post-comments-2``, but not ``no-sidebar``)."""
    for word in value.split():
        parts = {p for p in _SPLIT.split(word) if p and not p.isdigit()} - PLACES
        if parts and parts <= DECLARED:
            return True
    return False


def _presentation(tag: str, rest: str) -> tuple[str, bool, bool]:
    """The element's label (tag, classes, id without digits), whether it declares boilerplate, and whether by class or id only."""
    noise, soft, label = tag in BOILERPLATE, False, tag
    if rest:
        for name, a, b, c in _ATTRIBUTE.findall(rest):
            name = name.lower()
            if name not in ("class", "id", "role", "hidden"):
                continue
            value = _CAMEL.sub("-", a or b or c).lower()
            if name == "hidden":
                noise = noise or not value or value == "hidden"
                continue
            if _declared(value):
                noise, soft = noise or name == "role", soft or name != "role"
            label += {"class": ".", "id": "#", "role": "@"}[name] + re.sub(r"\d+", "", value)
    return label, noise or soft, soft and not noise


def parse(text: str | None) -> tuple[list[tuple[str, int, str]], dict[str, tuple[int, tuple[str, ...]]]]:
    """The text blocks ``(path, role, text)`` of a page in order, and role and child labels of each path of blocks."""
    blocks: list[tuple[str, int, str]] = []
    styles: dict[str, tuple[int, list[str]]] = {}
    if not text:
        return blocks, {}
    root = _Element("", "", "", OPEN)
    stack, pieces = [root], []
    owner = root  # the innermost open block element
    quiet = 0  # open boilerplate elements that are not blocks

    def flush():
        if pieces:
            joined = "".join(pieces)
            pieces.clear()
            joined = " ".join((html_module.unescape(joined) if "&" in joined else joined).split())
            if joined:
                blocks.append((owner.path, owner.role, joined))

    def close(keep: int):
        nonlocal owner, quiet
        for e in stack[keep:]:
            if e.path is None:
                quiet -= e.role == NOISE
        del stack[keep:]
        owner = next(e for e in reversed(stack) if e.path is not None)

    at, end = 0, len(text)
    while at < end:
        tag = _TAG.search(text, at)
        if tag is None:
            if not quiet and owner.role:
                pieces.append(text[at:])
            break
        if tag.start() > at and not quiet and owner.role:
            pieces.append(text[at : tag.start()])
        at = tag.end()
        closing, name, rest = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
        if not name:
            continue  # comment or declaration
        name = name.lower()
        if closing:
            if name == "br":
                pieces.append(" ")
                continue
            if name in BLOCKS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    close(k)
                    break
                if stack[k].tag in _SCOPES and name not in BLOCKS:
                    break  # an inline end tag does not reach out of its container
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in RAW and not rest.endswith("/"):
            ending = _RAW_END[name].search(text, at)
            at = ending.end() if ending else end
            continue
        if name in BLOCKS:
            flush()
            if any(e.tag == "p" for e in stack):
                k = max(i for i, e in enumerate(stack) if e.tag == "p")
                if not any(e.tag in ("td", "th", "button", "caption") for e in stack[k + 1 :]):
                    close(k)
            ends = _ENDS.get(name)
            if ends:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in ends:
                        close(k)
                        if name not in ("tr", "tbody", "tfoot"):
                            break
                    elif stack[k].tag in _SCOPES and stack[k].tag not in ends:
                        break
        if name in VOID:
            continue
        label, noise, soft = _presentation(name, rest)
        if name in BLOCKS:
            main = name in ("article", "main") or "@main" in label
            if noise or (name == "header" and owner.role != MAIN) or (owner.role == NOISE and not (owner.soft and main)):
                role = NOISE
            elif main:
                role = MAIN
            else:
                role = owner.role
            # Noise outside the main text that only a class or id marks: an article or main inside opens it again.
            inherited = owner.role == NOISE
            soft = role == NOISE and (owner.soft and (soft or not noise) if inherited else soft and owner.role == OPEN)
            soft = soft and name != "header"
            new = _Element(name, label, f"{owner.path}/{label}", role, soft)
            if not owner.children or owner.children[-1] != label:
                owner.children.append(label)
            styles.setdefault(new.path, (role, new.children))
            if not rest.endswith("/") or name not in VOID:
                stack.append(new)
                owner = new
        elif not rest.endswith("/"):
            new = _Element(name, label, None, NOISE if noise else OPEN)
            quiet += noise
            stack.append(new)
    flush()
    return blocks, {p: (r, tuple(c)) for p, (r, c) in styles.items()}


def _code(text: str) -> int:
    return int(np.array(xxhash.xxh64_intdigest(text), np.uint64).astype(np.int64))


def style_rows(pages: DataFrame) -> DataFrame:
    """The nodes of each page: ``(host, path, role, content, value)``, one row per node layout and per distinct text in it."""
    names = ["host", "path", "role", "content", "value"]

    def run(batches):
        for batch in batches:
            rows = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks, styles = parse(None if page is None else page.decode("utf-8", "replace"))
                codes = {p: _code(p) for p in styles}
                rows += [(host, codes[p], r, False, _code(" ".join(c))) for p, (r, c) in styles.items()]
                rows += [(host, codes[p], r, True, _code(t)) for p, r, t in {b for b in blocks if b[0] in codes}]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int8(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    source = pages.select(host_of("url").alias("host"), utf8("html").alias("html"))
    return source.mapInArrow(run, "host string, path long, role byte, content boolean, value long")


def style_tree(pages: DataFrame) -> DataFrame:
    """``(host, path, role, pages, presentation, content, importance)`` of every node that holds text on some page."""
    k = F.col("k").cast("double")
    of = style_rows(pages).groupBy("host", "path", "content", "value").agg(F.count("*").alias("k"), F.max("role").alias("role"))
    nodes = of.groupBy("host", "path").agg(
        F.max("role").alias("role"),
        F.sum(F.when(~F.col("content"), F.col("k"))).alias("pages"),
        F.sum(F.when(~F.col("content"), k * F.log(k))).alias("layout_sum"),
        F.sum(F.when(F.col("content"), F.col("k"))).alias("texts"),
        F.sum(F.when(F.col("content"), k * F.log(k))).alias("text_sum"),
    )
    m = F.log(F.col("pages").cast("double"))
    one = F.lit(1.0)
    return (
        nodes.where("texts > 0 and pages > 0")
        .withColumn("presentation", F.when(m > 0, (m - F.col("layout_sum") / F.col("pages")) / m).otherwise(one))
        .withColumn("content", F.when(m > 0, one - F.col("text_sum") / F.col("texts") / m).otherwise(one))
        .withColumn("importance", (1 - CONTENT_SHARE) * F.col("presentation") + CONTENT_SHARE * F.col("content"))
        .select("host", "path", "role", "pages", "presentation", "content", "importance")
    )


def low_nodes(tree: DataFrame) -> DataFrame:
    """``(host, path)`` of the nodes of ``tree`` whose branch goes from all pages of the host."""
    best = tree.where(F.col("role") == MAIN).groupBy("host").agg(F.max("importance").alias("best"))
    known = tree.where(F.col("pages") >= LEAST_PAGES).join(best, "host", "left")
    repeated_inside = (F.col("role") == MAIN) & (F.col("importance") < LOW_MAIN) & (F.col("best") >= HIGH)
    return known.where(((F.col("role") == OPEN) & (F.col("importance") < LOW)) | repeated_inside).select("host", "path")


def _extract(blocks, low: set[int]) -> str:
    """The blocks that count, in page order; ``low`` has the codes of the host's unimportant paths."""
    kept = [(r, t) for p, r, t in blocks if r and not (low and _code(p) in low)]
    if any(r == MAIN for r, _ in kept):
        size = [sum(len(t) for r, t in kept if r == role) for role in (OPEN, MAIN)]
        if size[0] < MAIN_WEIGHT * size[1]:
            kept = [(r, t) for r, t in kept if r == MAIN]
    return "\n\n".join(t for _, t in kept)


def main_text(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``pages(url, html)`` with ``text``, the main text of each page."""
    spark = pages.sparkSession
    low = store(low_nodes(store(style_tree(pages), "tree")), "low")
    host, page, own = "__host", "__html", "__low"
    source = pages.select(*keep, host_of("url").alias(host), utf8("html").alias(page))
    by_host = None
    if low.count() <= BROADCAST_NODES:
        found: dict[str, set[int]] = {}
        for r in low.toLocalIterator():
            found.setdefault(r["host"], set()).add(r["path"])
        by_host = spark.sparkContext.broadcast(found)
    else:
        of_host = store(low.groupBy("host").agg(F.collect_set("path").alias(own)), "low_by_host")  # one site's style nodes
        source = source.join(of_host.withColumnRenamed("host", host), host, "left").select(*keep, host, page, own)
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    nothing: set[int] = set()

    def run(batches):
        for batch in batches:
            hosts = batch.column(len(keep)).to_pylist()
            if by_host is not None:
                lows = [by_host.value.get(h, nothing) for h in hosts]
            else:
                lows = [set(x or ()) for x in batch.column(len(keep) + 2).to_pylist()]
            texts = [
                _extract(parse(None if p is None else p.decode("utf-8", "replace"))[0], x)
                for p, x in zip(batch.column(len(keep) + 1).to_pylist(), lows, strict=True)
            ]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*keep, "text"])

    return source.mapInArrow(run, f"{kinds}, text string")


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page."""
    return main_text(pages, ["page_id", "url"]).withColumn("n_chars", F.char_length("text").cast("long"))
