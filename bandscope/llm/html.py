"""Main text of web pages by composite text density.

A page becomes a tree. A node's density is its characters for each tag below it, scaled by a logarithm
that falls with the share of characters and tags that are links, its base taken from the body. The densities of a node's children are summed, and the node with the largest sum is the
core of the content. The lowest density on the path from the core up to the body is the threshold that
the other branches along that path must reach to belong to the content; headlines need not reach it. Where
the path passes article or main elements, all of the innermost belongs to the content too. Elements that
are furniture by tag, role or name are cut beforehand. A name is a whole word of class or id, or several joined by hyphens
that all speak of furniture and its layout; it counts on containers, and inside the article not on
paragraphs, headlines and other elements that hold running text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split()
)
FURNITURE = frozenset(
    "head nav footer aside form script style textarea title noscript iframe template button select option input svg canvas audio video object menu dialog xmp noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar"
    " footer cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup login share sharing social related"
    " recommended teaser teasers widget widgets pager pagination".split()
)
# Words that say nothing beside a name of furniture.
LAYOUT = frozenset(
    "area bar block bottom box buttons card col column container form global group header inline inner item items left links list module"
    " outer page panel posts right row section side site slot small stories strip top unit user wrap wrapper".split()
)
# Elements of running text: names do not make furniture of them inside the article.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figure figcaption address details summary".split())
HEADS = frozenset("header masthead topbar banner".split())
STORY = frozenset("article post entry content story".split())
TALK = frozenset("comment comments respond replies discussion disqus".split())
# An element that starts in one of these ends it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
IN_PARAGRAPH = INLINE | {"br", "button", "input", "select", "option", "textarea", "svg", "canvas", "audio", "video", "object", "iframe", "script", "style", "noscript", "template", "embed", "map", "area", "param", "source", "track", "link", "meta", "ruby", "rt", "rp", "output", "progress", "meter", "picture"}

# A quote opens a value only where the value begins; one that is never closed opens none, so that the tag ends at its next >.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+)*+)>""")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s"'>][^\s>]*+)))?+""")
SPLIT = re.compile(r"[^a-z0-9]+")


class Page:
    """The tree of a page: lists with an entry for each element, parents before children, and its pieces of text."""

    def __init__(self, html: str):
        self.tag, self.parent, self.attributes = ["html"], [-1], [""]
        self.pieces: list[tuple[int, int, str]] = []  # element, block, text
        self.block = 0
        self.read(html)

    def open(self, tag: str, attributes: str, stack: list[int]) -> None:
        if tag not in IN_PARAGRAPH:
            self.close("p", stack)
        for other in CLOSES.get(tag, ()):
            self.close(other, stack, SCOPES[tag])
        if tag not in INLINE and tag != "br":
            self.block += 1
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.attributes.append(attributes)
        if tag == "br":
            self.pieces.append((stack[-1], self.block, " "))
        elif tag not in VOID:
            stack.append(len(self.tag) - 1)

    def close(self, tag: str, stack: list[int], scope: set[str] | frozenset[str] = frozenset()) -> None:
        """End the innermost open element of this tag, with what is open in it."""
        for depth in range(len(stack) - 1, 0, -1):
            found = self.tag[stack[depth]]
            if found == tag:
                if any(self.tag[e] not in INLINE for e in stack[depth:]):
                    self.block += 1
                del stack[depth:]
                return
            if found in scope or (tag in INLINE or tag == "p") and found not in INLINE:
                return

    def read(self, html: str) -> None:
        stack, at, n = [0], 0, len(html)
        while at < n:
            begin = html.find("<", at)
            text = html[at:] if begin < 0 else html[at:begin]
            if text:
                self.pieces.append((stack[-1], self.block, unescape(text)))
            if begin < 0:
                return
            ahead = html[begin + 1 : begin + 2]
            if ahead.isascii() and ahead.isalpha() or ahead == "/" and html[begin + 2 : begin + 3].isascii() and html[begin + 2 : begin + 3].isalpha():
                found = TAG.match(html, begin)
                if not found:
                    return  # the page ends inside a tag
                at, tag = found.end(), found[2].lower()
                if found[1]:
                    self.close(tag, stack)
                    continue
                self.open(tag, found[3], stack)
                if tag in RAW:
                    end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
                    if not end:
                        return
                    at = end.start()
            elif html.startswith("<!--", begin):
                end = begin + 5 if html.startswith("<!-->", begin) else html.find("-->", begin + 4) + 3
                if end < begin + 4:
                    return
                at = end
            elif ahead in ("!", "?", "/"):
                end = html.find(">", begin)
                if end < 0:
                    return
                at = end + 1
            else:
                self.pieces.append((stack[-1], self.block, "<"))
                at = begin + 1


def names(attributes: str) -> tuple[set[str], bool]:
    """Class tokens, id and roles of an element, and whether it is hidden."""
    words: set[str] = set()
    hidden = False
    if attributes:
        for key, a, b, c in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key in ("class", "id"):
                words.update(value.split())
            elif key == "role":
                words.update(f"role={x}" for x in value.split())
            elif key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
                hidden = True
    return words, hidden


def named(words: set[str], of: frozenset[str]) -> bool:
    """Whether a token is one of these names, alone or joined with further names and words of layout only."""
    for word in words:
        parts = {p.rstrip("0123456789") for p in SPLIT.split(word)} - {""}
        if parts & of and parts <= of | NAMES | HEADS | TALK | LAYOUT:
            return True
    return False


def furniture(page: Page) -> list[bool]:
    """For each element whether it or one around it is no content.

    A header is furniture outside the article only. Names count for nothing on an element that holds the article or,
    in a page without one, other names than those of headers on an element that holds a headline h1. If
    they leave no text at all, none of them counts.
    """
    n = len(page.tag)
    found = [names(a) for a in page.attributes]
    main = [t in ("article", "main") or "role=main" in found[i][0] for i, t in enumerate(page.tag)]
    headline = [t == "h1" and not any(main) for t in page.tag]
    holds, heads, within = [False] * n, [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        holds[page.parent[i]] |= holds[i] or main[i]
        heads[page.parent[i]] |= heads[i] or headline[i]
    sure, maybe = [False] * n, [False] * n
    for i in range(1, n):
        up = page.parent[i]
        within[i] = within[up] or main[up]
        words, hidden = found[i]
        sure[i] = sure[up] or page.tag[i] in FURNITURE or hidden or page.tag[i] == "header" and not within[i]
        maybe[i] = maybe[up]
        if words and not holds[i] and not main[i] and page.tag[i] != "body":
            sure[i] = sure[i] or any(f"role={r}" in words for r in ROLES)
            if not (within[i] and page.tag[i] in TEXT):
                story = any(STORY & set(SPLIT.split(w)) for w in words)
                maybe[i] |= not within[i] and not story and named(words, HEADS)
                maybe[i] |= not heads[i] and (named(words, TALK) or named(words, NAMES))
    out = [a or b for a, b in zip(sure, maybe, strict=True)]
    return out if any(not out[e] and not text.isspace() for e, _, text in page.pieces) else sure


def below(page: Page, own: list[int]) -> list[int]:
    total = own[:]
    for i in range(len(total) - 1, 0, -1):
        total[page.parent[i]] += total[i]
    return total


def densities(page: Page, cut: list[bool]) -> tuple[list[float], list[float], int]:
    """Density of each element, the sum of its children's, and the core: the element with the largest sum."""
    n = len(page.tag)
    own = [0] * n
    for element, _, text in page.pieces:
        own[element] += len("".join(text.split()))
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
    chars = below(page, [0 if c else k for k, c in zip(own, cut, strict=True)])
    tags = below(page, [0 if c else 1 for c in cut])
    link_chars = below(page, [k if a and not c else 0 for k, a, c in zip(own, linked, cut, strict=True)])
    link_tags = below(page, [1 if t == "a" and not c else 0 for t, c in zip(page.tag, cut, strict=True)])
    body = next((i for i, t in enumerate(page.tag) if t == "body"), 0)
    share = link_chars[body] / max(1, chars[body])
    density = [0.0] * n
    for i in range(n):
        if chars[i] and not cut[i]:
            c, t, lc, lt = chars[i], max(1, tags[i] - 1), max(1, link_chars[i]), max(1, link_tags[i])
            base = math.log(c / max(1, c - link_chars[i]) * link_chars[i] + share * c + math.e)
            density[i] = c / t * max(0.0, math.log(max(1.0, c / lc * t / lt), max(base, 1.0001)))
    total = [0.0] * n
    for i in range(1, n):
        total[page.parent[i]] += density[i]
    core = max(range(n), key=lambda i: (total[i], -i)) if n > 1 and max(total) > 0 else body
    return density, total, core


def content(page: Page) -> tuple[list[bool], list[bool]]:
    """For each element whether its own text is content, and whether it is furniture."""
    n, cut = len(page.tag), furniture(page)
    density, _, core = densities(page, cut)
    body = next((i for i, t in enumerate(page.tag) if t == "body"), 0)
    path = [core]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    whole = [False] * n
    steps = set(path[: path.index(body) + 1] if body in path else path)
    threshold = min(density[i] for i in steps)
    around = [i for i in path if page.tag[i] in ("article", "main") or "role=main" in names(page.attributes[i])[0]]
    whole[around[0] if around else core] = True
    for i in range(1, n):
        up = page.parent[i]
        if whole[up]:
            whole[i] = True
        elif up in steps and i not in steps:
            # A branch beside the path: dense enough, a headline, or a part of the path's own running text.
            whole[i] = density[i] >= threshold > 0 or page.tag[i] in ("h1", "h2") or page.tag[i] in INLINE
    return [w or i in steps for i, w in enumerate(whole)], cut


def main_text(html: str) -> str:
    """The blocks of the main content, joined by two line ends; empty if there are none."""
    page = Page(html)
    inside, cut = content(page)
    blocks: list[str] = []
    last = -1
    for element, block, text in page.pieces:
        if inside[element] and not cut[element]:
            if block != last:
                blocks.append("")
                last = block
            blocks[-1] += text
    cleaned = (" ".join(b.split()) for b in blocks)
    return "\n\n".join(b for b in cleaned if b)


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """`pages` without the html, with the main text and its code points; columns of these names before are replaced.

    Null, empty and furniture-only pages have the empty text. Rows are handled one by one, whole; repeated rows alike.
    """
    kept = [c for c in pages.columns if c not in (html, text, n_chars)]
    plain = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{html}`").cast("string"))
    # Columns are told by position on the way, so their names cannot clash.
    numbered = plain.toDF(*(f"c{i}" for i in range(len(kept))), "page")
    schema = numbered.drop("page").select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "page", 4 << 20):
                texts = [main_text(h or "") for h in part.column("page").to_pylist()]
                columns = [*(part.column(i) for i in range(len(kept))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return numbered.mapInArrow(W.tidy(read), schema).toDF(*kept, text, n_chars)
