"""Main text of web pages: article regions of every page by its labels, and the constant text tokens of its host against slots.

``expression``, ``align`` and ``merge`` make union-free regular expressions of pages; the extraction does not use them.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from tablewarden.llm.common import cut_lineage, spread_join

# Elements by what they do to the text, and what marks a region that is not the article.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes noscript script style svg template textarea title".split())
SPACE = {"br", "wbr", "img"}
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
# Sections begin anew: what is still open of a menu, list or paragraph ends there.
SECTIONS = set("article main footer aside nav header".split())
OPEN_ENDED = {"p", "li", "ul", "ol", "nav"}
SIDE_TAGS = set("nav header footer aside form head menu button select option dialog fieldset title iframe noscript script style svg template textarea".split())
SIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disqus footer gdpr header "
    "hidden legal login masthead menu modal nav navbar navigation newsletter notice notices outbrain overlay paywall popup promo promotion promoted reader-comments related "
    "replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription taboola tags toolbar widget widgets".split()
)
# Side words that mean what they say in a compound class too; the others in a compound may also name a layout around the article.
SURE_WORDS = set("ad ads advert adverts comment comments disqus outbrain promo promoted promotion related replies reply respond sponsor sponsored taboola".split())
LAYOUT_WORDS = set("has no not with without".split())
MAIN_WORDS = {"articlebody", "article-body", "article-content", "entry-content", "post-content", "post-body", "story-body"}

# Hosts whose wrappers are sent to every task; with more they are joined instead.
MOST_SENT = 20_000

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)


def _label(tag: str, attributes: str) -> str:
    """The tag and the words of its class, id, role and itemprop, digits left out; numbers in them tell pages apart, not kinds."""
    if not attributes.strip():
        return tag
    words: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "hidden" if name.lower() in ("hidden", "aria-hidden") and values != ["false", "", ""] else " ".join(values)
        words.update(w for w in re.sub(r"\d+", "", value.lower()).split() if w)
    return ".".join([tag, *sorted(words)])


def blocks(page: str) -> list[tuple[str, str]]:
    """(path, text) of every stretch of text without a block boundary, in page order, white space as one space.

    Comments, raw elements and markup are left out; inline elements do not bound a block. Elements that are not closed end
    with their parents or where the next one of their kind begins.
    """
    out: list[tuple[str, str]] = []
    stack: list[str] = []
    tags: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append(("/".join(stack), text))
        parts.clear()

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if found is None:
            parts.append(page[at:])
            break
        if found.start() > at:
            parts.append(page[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\s*(?:>|\Z)", re.IGNORECASE).search(page, at)
            # A title or text area without an end holds no article; other raw elements run to the end of the page.
            at = end.end() if end else len(page)
            continue
        if tag in SPACE:
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            if tag in tags:
                while tags.pop() != tag:
                    stack.pop()
                stack.pop()
            continue
        ends = OPEN_ENDED if tag in SECTIONS else CLOSES.get(tag, {"p"})
        while tags and tags[-1] in ends:
            tags.pop()
            stack.pop()
        if tag not in VOID:
            tags.append(tag)
            stack.append(_label(tag, found[3] or ""))
    flush()
    return out


@dataclass
class Node:
    """A part of an expression: a label with its own parts in order. ``often``: "", "?", "+" or "*". "#" is a text slot."""

    label: str
    often: str = ""
    parts: list[Node] = field(default_factory=list)

    def write(self) -> list:
        return [self.label, self.often, [p.write() for p in self.parts]]

    def paths(self, above: str = "") -> Iterator[str]:
        here = f"{above}/{self.label}" if above else self.label
        for part in self.parts:
            if part.label == "#":
                yield here
            else:
                yield from part.paths(here)


def read(written: list) -> Node:
    return Node(written[0], written[1], [read(p) for p in written[2]])


def _both(a: str, b: str) -> str:
    left_out, repeated = bool({a, b} & {"?", "*"}), bool({a, b} & {"+", "*"})
    return "*" if left_out and repeated else "?" if left_out else "+" if repeated else ""


def _optional(node: Node) -> Node:
    return Node(node.label, _both(node.often, "?"), node.parts)


def fold(parts: list[Node]) -> list[Node]:
    """Equal neighbours become one repeated part whose own parts are those of all."""
    out: list[Node] = []
    for part in parts:
        if out and out[-1].label == part.label:
            last = out[-1]
            out[-1] = Node(part.label, "" if part.label == "#" else _both(_both(last.often, part.often), "+"), align(last.parts, part.parts))
        else:
            out.append(part)
    return out


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """The expression of both sequences: equal labels in the longest common order are matched, the rest is optional."""
    if not a or not b:
        return [_optional(p) for p in (a or b)]
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in reversed(range(len(a))):
        for j in reversed(range(len(b))):
            length[i][j] = length[i + 1][j + 1] + 1 if a[i].label == b[j].label else max(length[i + 1][j], length[i][j + 1])
    out: list[Node] = []
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i].label == b[j].label:
            out.append(Node(a[i].label, _both(a[i].often, b[j].often), align(a[i].parts, b[j].parts) if a[i].parts or b[j].parts else []))
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return fold(out + [_optional(p) for p in a[i:]] + [_optional(p) for p in b[j:]])


def expression(paths: list[str]) -> Node:
    """The expression of one page: its blocks' paths as a tree, texts as slots, repeats folded."""
    root = Node("")
    open_nodes = [root]
    before: list[str] = []
    for path in paths:
        labels = path.split("/") if path else []
        same = 0
        while same < min(len(labels), len(before)) and labels[same] == before[same]:
            same += 1
        # Neighbours of one path are separate elements; only the innermost is certain to begin anew.
        same = min(same, len(labels) - 1) if labels == before and labels else same
        del open_nodes[same + 1 :]
        for label in labels[same:]:
            node = Node(label)
            open_nodes[-1].parts.append(node)
            open_nodes.append(node)
        open_nodes[-1].parts.append(Node("#"))
        before = labels

    def folded(node: Node) -> Node:
        return Node(node.label, node.often, fold([folded(p) for p in node.parts]))

    return folded(root)


def merge(written: list[str]) -> str:
    """One expression for many, aligned one after another in a fixed order."""
    nodes = [read(json.loads(w)) for w in sorted(set(written))]
    return json.dumps(reduce(lambda a, b: Node("", "", align(a.parts, b.parts)), nodes).write(), separators=(",", ":"))


def _words(label: str) -> set[str]:
    return set(label.split(".")[1:])


@lru_cache(maxsize=1 << 16)
def _aside(label: str) -> int:
    """How surely a label marks a side region: 2 by its tag or a class word, 1 by a part of one, 0 not at all.

    The page, its body and its main element never do. An article does not by a part of a word, and not surely by a whole one.
    """
    tag, words = label.partition(".")[0], _words(label)
    if tag in ("html", "body", "main"):
        return 0
    if tag in SIDE_TAGS and tag != "form":
        return 2
    if words & MAIN_WORDS:
        return 0
    if words & SIDE_WORDS:
        return 1 if tag == "article" else 2
    if tag == "article":
        return 0
    split = [set(re.split(r"[-_]", w)) for w in words]
    parts = {p for own in split if not own & LAYOUT_WORDS for p in own}
    return 2 if parts & SURE_WORDS else 1 if parts & SIDE_WORDS or tag == "form" else 0


def _article(label: str) -> bool:
    return label.partition(".")[0] == "article" or bool(_words(label) & MAIN_WORDS)


def _main(label: str) -> bool:
    return label.partition(".")[0] == "main" or "main" in _words(label)


@lru_cache(maxsize=1 << 14)
def _slot(path: str) -> tuple[int, bool, bool]:
    """(side, in an article, in a main element) of a path."""
    labels = path.split("/")
    return max(map(_aside, labels)), any(map(_article, labels)), any(map(_main, labels))


def identity(path: str, text: str) -> int:
    """63 bits of a text token at its slot."""
    return xxh64_intdigest(f"{path}\n{text}") >> 1


def main_blocks(found: list[tuple[str, str]], constant: set[int]) -> list[str]:
    """The texts of a page's blocks that are the article's.

    Slots in side regions are not. If the rest has article elements, those are the article, unless they hold less than half of a
    main element's text (then they are teasers in it); else its main element is. A region that may be a layout around the article is
    no side region if only it has such elements. Without any, the article is all of the rest but the constant tokens of the host.
    """
    chars: dict[str, int] = {}
    for path, text in found:
        chars[path] = chars.get(path, 0) + len(text)
    slots = {p: _slot(p) for p in chars}
    for most in (0, 1):
        article = {p for p, (side, inside, _) in slots.items() if side <= most and inside}
        main = {p for p, (side, _, inside) in slots.items() if side <= most and inside}
        teasers = article < main and 2 * sum(chars[p] for p in article) < sum(chars[p] for p in main)
        wanted = main if teasers else article or main
        if wanted:
            return [t for p, t in found if p in wanted]
    for most in (0, 1):
        rest = [(p, t) for p, t in found if slots[p][0] <= most]
        if rest:
            return [t for p, t in rest if identity(p, t) not in constant] or [t for _, t in rest]
    return []


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(_host, constant): the constant text tokens outside of articles of every host, as identities.

    A token is a text at its slot. It is constant if all distinct pages of the host that fill the slot have it, two at least, or
    half of them, three at least; so a host has no more of them than about twice the tokens of its pages. Pages with equal
    blocks are one page. Pages without a host have nothing in common.
    """

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple[str, int, int, int]] = set()
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = blocks(page.as_py() or "")
                own = {(p, t) for p, t in found if _slot(p)[0] < 2 and not any(_slot(p)[1:])}
                if own:
                    whole = xxh64_intdigest("\n".join(f"{p} {t}" for p, t in found)) >> 1
                    rows.update((host, xxh64_intdigest(p) >> 1, identity(p, t), whole) for p, t in own)
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.string(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_host", "slot", "token", "page"])

    given = pages.select(_host(F.col(url)).alias("_host"), F.col(html).cast("string").alias("_html")).filter("_host <> ''")
    facts = cut_lineage(given.mapInArrow(reduced, "_host STRING, slot BIGINT, token BIGINT, page BIGINT"))
    filled = facts.groupBy("_host", "slot").agg(F.countDistinct("page").alias("pages"))
    tokens = facts.groupBy("_host", "slot", "token").agg(F.countDistinct("page").alias("n")).filter("n > 1")
    constant = tokens.join(filled, ["_host", "slot"]).filter("n = pages OR (n > 2 AND 2 * n >= pages)")
    return constant.groupBy("_host").agg(F.collect_set("token").alias("constant"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, url, text, n_chars of every page: the text of the article's slots, decided for every page by itself.

    Null and empty pages have the empty text; pages without a host share nothing; null and repeated keys are extracted
    row by row; other columns are ignored; an empty table gives an empty result.
    """
    wrappers = cut_lineage(infer(pages, url, html))
    given = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), _host(F.col(url)).alias("_host"), F.col(html).cast("string").alias("_html"))
    kinds = {c: given.schema[c].dataType.simpleString() for c in ("_id", "_url")}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, constant in zip(batch.column(2), batch.column(3)):
                texts.append("\n".join(main_blocks(blocks(page.as_py() or ""), set(constant.as_py() or ()))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["_id", "_url", "text", "n_chars"])

    if wrappers.limit(MOST_SENT + 1).count() <= MOST_SENT:
        joined = given.join(F.broadcast(wrappers), "_host", "left")
    else:
        joined = spread_join(given, wrappers, ["_host"], ["_id"], "left")
    made = joined.select("_id", "_url", "_html", "constant").mapInArrow(apply, f"_id {kinds['_id']}, _url {kinds['_url']}, text STRING, n_chars BIGINT")
    return made.select(F.col("_id").alias(key), F.col("_url").alias(url), "text", "n_chars")
