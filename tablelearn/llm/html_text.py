"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags; scripts, styles, comments,
head and form controls are skipped while cutting.  Each block gets its word
count and link density (a link may span blocks), those of the block before and
after it, and marks of where it stands: inside a page-furniture element; inside
an element whose class or id names furniture (1, or 0.5 if an article begins
between that element and the block); inside an article; a heading; after the end
of an article.  A class or id is a name by its head word (``site-footer``,
``comments-list``, but not ``social-layout``).  A decision
tree, trained with MLlib on the small labelled table ``LABELLED``, tells main
text from the rest.  Blocks of main text are joined in page order by a line
feed, nothing is shortened.

Pages are independent: one narrow pass, with the tree's few nodes in the
closure.

Defined cases: null and empty pages, and pages without main text, give an
empty text; broken markup (unclosed tags, quotes or comments) is read to its
end as a browser would; of the skipped elements only those of raw text hide
what follows when their end tag is missing, of others just the tag is skipped;
character references are decoded once, white space
inside a block (also from line breaks) is one space; repeated rows are read
each; other columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: elements and words that mark page furniture in HTML
SKIPPED = "script style noscript template title head svg select textarea button iframe object canvas".split()
RAW = "script style title textarea iframe".split()     # without an end tag: up to the end of the page
ONE_AT_A_TIME = "button select noscript".split()       # a second start tag: the first one has no end tag
INLINE = """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small
span strike strong sub sup time tt u var wbr""".split()
FURNITURE = "nav header footer aside form menu dialog fieldset".split()
VOID = "br img hr input meta link wbr area base col embed source track param".split()
#: a start tag of these ends an open paragraph
ENDS_P = """address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul""".split()
NAMES = """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
commentlist consent cookie cookies copyright disclaimer discussion disqus feedback footer form gdpr header legal login
masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup
privacy promo promoted promotion recommended register related replies reply respond reviews search share sharing
sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar trending widget""".split()
#: the word before one of these at the end of a name is its head: "comments-list", "ad-slot"
HOLDERS = frozenset("area bar block body box btn button container content group holder inner items links list outer panel row "
                    "section slot unit wrap wrapper zone".split())
NOT_NAMED_BY = {"has", "with", "no", "without"}        # class="has-sidebar" is no sidebar

TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[/!?][^>]*>"
                 r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "furniture", "named", "article", "heading", "past_article")


def _marks(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Does the element open furniture, carry a furniture name, or open an
    article?"""
    article, named = tag in ("article", "main"), False
    for name, value in ATTRIBUTE.findall(attributes):
        tokens = [[p for p in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", t).lower()) if p]
                  for t in value.strip("\"'").split()]
        parts = [p for t in tokens for p in t]
        if name.lower() in ("role", "itemprop"):
            article |= parts in (["main"], ["article"], ["article", "body"])
            named |= parts in (["navigation"], ["banner"], ["contentinfo"], ["complementary"], ["search"], ["alert"])
        elif tag not in ("html", "body", "main") and not NOT_NAMED_BY & set(parts):
            named |= any(map(_names_furniture, tokens))
    return tag in _FURNITURE, named, article


def _names_furniture(parts: list[str]) -> bool:
    while len(parts) > 1 and parts[-1] in HOLDERS:
        parts = parts[:-1]
    return bool(parts) and parts[-1] in _NAMES


def _tags(page: str):
    """Tags in page order, as matches, or None for a comment that hides the
    rest, each with its end; the caller may send a place to go on from.
    A ``<`` behind the last ``>`` opens nothing, so it is not tried."""
    at, last = 0, page.rfind(">")
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = (yield start, end + 3 if end >= 0 else len(page), None) or (end + 3 if end >= 0 else len(page))
        elif start > last:
            return
        elif m := TAG.match(page, start):
            at = (yield start, m.end(), m) or m.end()
        else:
            at = start + 1


_NAMES, _FURNITURE = frozenset(NAMES), frozenset(FURNITURE)
_SKIPPED, _INLINE, _VOID, _ENDS_P = frozenset(SKIPPED), frozenset(INLINE), frozenset(VOID), frozenset(ENDS_P)


def blocks_of(page: str) -> list[tuple]:
    """``(text, words, link density, furniture, named, article, heading,
    past_article)`` of each text block, in page order."""
    blocks, text, linked = [], [], 0
    outside = (False, 0.0, False)
    stack: list[tuple] = []          # (tag, (furniture, named, article)) of open block elements
    state, past = outside, False
    #: of the open link: how many block elements were open, and whether a plain paragraph was
    link: tuple | None = None
    plain_p, heading, at = False, False, 0
    endless: set[str] = set()        # tags without an end tag in the rest of the page

    def end():
        nonlocal text, linked
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            size = max(1, sum(map(len, text)))
            blocks.append((joined, joined.count(" ") + 1, min(1.0, linked / size), *state, heading, past))
        text, linked = [], 0

    tags, jump = _tags(page), None
    while True:
        try:
            start, stop, m = tags.send(jump)
        except StopIteration:
            break
        if start > at:
            part = page[at:start]
            text.append(part)
            linked += len(part) if link else 0
        at, jump = stop, None
        tag = (m[2] or m[5] or "").lower() if m else ""
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in _SKIPPED and not closing:
            other = r"|<body\b" if tag == "head" else rf"|<{tag}\b" if tag in ONE_AT_A_TIME else ""
            if not attributes.rstrip().endswith("/") and tag not in endless:
                c = re.compile(rf"</{tag}\b[^>]*>{other}", re.I).search(page, at)
                if c is None:
                    if tag in RAW:
                        at = len(page)
                    endless.add(tag)            # the rest of the page is searched once for each tag
                elif c[0][1] == "/":
                    at = c.end()
                elif tag == "head":
                    at = c.start()
                jump = at
            continue
        if tag == "a":
            link = None if closing else (len(stack), plain_p)
            continue
        if tag in _INLINE:
            if tag == "br":
                text.append(" ")
            continue
        end()
        if tag[0] == "h" and tag[1:] in "123456":
            heading = not closing
        elif tag not in _VOID:
            heading = False
        if tag == "p" or not closing and tag in _ENDS_P:
            if link and link[1] and plain_p:        # a link without end tag ends with its paragraph
                link = None
            plain_p = tag == "p" and not closing
        # only paragraphs with attributes are on the stack
        if stack and stack[-1][0] == "p" and (tag == "p" if closing else tag in _ENDS_P):
            stack.pop()
            state = stack[-1][1] if stack else outside
        if tag in _VOID or tag == "p" and (closing or not attributes):
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    past = past or state[2] and not (stack and stack[-1][1][2])
                    break
            state = stack[-1][1] if stack else outside
            if link and len(stack) < link[0]:       # ... or with the element it is in
                link = None
        else:
            furniture, named, article = _marks(tag, attributes)
            around = stack[-1][1] if stack else outside
            inherited = 0.5 if article and around[1] else around[1]
            state = (around[0] or furniture, 1.0 if named else inherited, around[2] or article)
            stack.append((tag, state))
    if at < len(page):
        text.append(page[at:])
    end()
    return blocks


def features_of(blocks: list[tuple]) -> list[tuple]:
    """The columns FEATURES of each block."""
    edge = (0.0, 0.0)
    sizes = [edge] + [(float(b[1]), b[2]) for b in blocks] + [edge]
    return [(*sizes[i + 1], *sizes[i], *sizes[i + 2], *map(float, b[3:8])) for i, b in enumerate(blocks)]


# The labelled table: (markup before, words, linked words, markup after, is
# main text) of each block of some pages; blocks of one page follow each other.
LABELLED = [
    [("<nav><ul><li>", 1, 1, "</li>", 0), ("<li>", 2, 2, "</li>", 0), ("<li>", 1, 1, "</li></ul></nav>", 0),
     ("<div class=ad>", 8, 0, "</div>", 0), ("<article><h1>", 9, 0, "</h1>", 1), ("<p>", 80, 0, "</p>", 1),
     ("<p>", 4, 0, "</p>", 1), ("<p>", 60, 3, "</p>", 1), ("<p>", 1, 0, "</p></article>", 1),
     ("<footer>", 14, 2, "</footer>", 0)],
    [("<header><div>", 3, 3, "</div>", 0), ("<p>", 12, 0, "</p></header>", 0), ("<main><h1>", 6, 0, "</h1>", 1),
     ("<p>", 40, 0, "</p>", 1), ("<ul><li>", 7, 0, "</li>", 1), ("<li>", 5, 0, "</li></ul>", 1),
     ("<blockquote>", 22, 0, "</blockquote>", 1), ("<p>", 3, 0, "</p>", 1), ("<h2>", 4, 0, "</h2>", 1),
     ("<p>", 130, 4, "</p></main>", 1), ("<aside><p>", 45, 0, "</p>", 0), ("<p>", 6, 6, "</p></aside>", 0),
     ("<footer><p>", 30, 0, "</p></footer>", 0)],
    [("<div class=menu><a>", 2, 2, "</a></div>", 0), ("<div class='cookie-notice'><p>", 35, 2, "</p></div>", 0),
     ("<div><h1>", 7, 0, "</h1>", 1), ("<p>", 55, 0, "</p>", 1), ("<p>", 9, 0, "</p>", 1), ("<p>", 48, 5, "</p>", 1),
     ("<p>", 25, 0, "</p></div>", 1), ("<div id=comments><p>", 28, 0, "</p>", 0), ("<p>", 75, 0, "</p>", 0),
     ("<p>", 5, 0, "</p></div>", 0), ("<div>", 8, 0, "</div>", 0)],
    [("<div>", 2, 2, "</div>", 0), ("<div>", 3, 3, "</div>", 0), ("<div>", 4, 4, "</div>", 0),
     ("<p>", 90, 0, "</p>", 1), ("<p>", 70, 2, "</p>", 1), ("<p>", 15, 0, "</p>", 1), ("<p>", 64, 0, "</p>", 1),
     ("<div>", 6, 6, "</div>", 0), ("<div>", 5, 5, "</div>", 0), ("<div>", 3, 2, "</div>", 0)],
    [("<article><header><h1>", 8, 0, "</h1></header>", 1), ("<p>", 33, 0, "</p>", 1),
     ("<div class='share'>", 4, 4, "</div>", 0), ("<p>", 18, 18, "</p>", 0), ("<p>", 52, 0, "</p>", 1),
     ("<div class='related'><p>", 11, 11, "</p>", 0), ("<p>", 20, 0, "</p></div>", 0),
     ("<form><p>", 9, 0, "</p>", 0), ("<p>", 26, 0, "</p></form>", 0), ("<p>", 12, 0, "</p></article>", 1),
     ("<section class=comments><article><p>", 40, 0, "</p></article>", 0),
     ("<article><p>", 8, 0, "</p></article></section>", 0), ("<div>", 5, 0, "</div>", 0)],
    [("<div id=sidebar><p>", 30, 0, "</p>", 0), ("<h3>", 2, 0, "</h3>", 0), ("<p>", 10, 9, "</p></div>", 0),
     ("<article><p>", 2, 0, "</p>", 1), ("<p>", 3, 1, "</p>", 1), ("<p>", 6, 0, "</p>", 1), ("<p>", 2, 0, "</p>", 1),
     ("<p>", 11, 1, "</p></article>", 1), ("<div class=promo><h3>", 5, 0, "</h3>", 0),
     ("<p>", 24, 3, "</p></div>", 0), ("<p>", 7, 7, "</p>", 0), ("<footer>", 4, 0, "</footer>", 0)],
    [("<form>", 3, 0, "</form>", 0), ("<div>", 6, 0, "</div>", 0), ("<article><h1>", 4, 0, "</h1>", 1),
     ("<p>", 200, 0, "</p>", 1), ("<p>", 16, 0, "</p></article>", 1), ("<div>", 12, 0, "</div>", 0),
     ("<nav>", 20, 18, "</nav>", 0), ("<div class=newsletter>", 22, 0, "</div>", 0), ("<footer>", 60, 0, "", 0)],
    [("<p>", 45, 0, "</p>", 1), ("<p>", 38, 1, "</p>", 1), ("<h2>", 3, 0, "</h2>", 1), ("<p>", 66, 0, "</p>", 1),
     ("<p>", 21, 0, "</p>", 1), ("<div>", 3, 3, "</div>", 0), ("<p>", 2, 2, "</p>", 0)],
    [("<nav>", 9, 9, "</nav>", 0), ("<article><h1>", 5, 0, "</h1>", 1), ("<p>", 58, 0, "</p>", 1),
     ("<p>", 1, 0, "</p>", 1), ("<p>", 34, 0, "</p></article>", 1)],
    [("<div>", 7, 7, "</div>", 0), ("<article><p>", 17, 0, "</p>", 1), ("<p>", 3, 0, "</p></article>", 1)],
    [("<h1>", 5, 0, "</h1>", 1), ("<p>", 61, 0, "</p>", 1), ("<p>", 44, 0, "</p>", 1)],
    [("<article><h1>", 6, 0, "</h1></article>", 1)],
    [("<article><p>", 2, 0, "</p></article>", 1)],
    [("<header>", 5, 0, "</header>", 0), ("<div class=banner>", 18, 0, "</div>", 0),
     ("<div role=main><h1>", 10, 0, "</h1>", 1), ("<p>", 8, 0, "</p>", 1), ("<table><tr><td>", 2, 0, "</td>", 1),
     ("<td>", 3, 0, "</td></tr></table>", 1), ("<p>", 14, 2, "</p>", 1), ("<pre>", 30, 0, "</pre></div>", 1),
     ("<aside>", 15, 0, "</aside>", 0), ("<aside><article><p>", 50, 0, "</p></article></aside>", 0),
     ("<footer><p>", 9, 6, "</p></footer>", 0)],
    [("<article><nav>", 3, 3, "</nav>", 0), ("<header><h2>", 5, 0, "</h2>", 1), ("<div>", 3, 0, "</div>", 0),
     ("<p>", 6, 1, "</p></header>", 0), ("<p>", 95, 0, "</p>", 1), ("<p>", 14, 14, "</p>", 0),
     ("<p>", 31, 0, "</p>", 1), ("<aside>", 4, 0, "</aside>", 0), ("<p>", 5, 0, "</p>", 1),
     ("<aside><h3>", 2, 0, "</h3>", 0), ("<p>", 27, 0, "</p></aside>", 0), ("<footer>", 7, 0, "</footer>", 0),
     ("<form>", 4, 0, "</form></article>", 0), ("<footer>", 3, 0, "</footer>", 0)],
    [("<div class=topbar>", 5, 0, "</div>", 0), ("<article><header><h1>", 3, 0, "</h1></header>", 1),
     ("<p>", 4, 0, "</p>", 1), ("<footer>", 5, 0, "</footer></article>", 0),
     ("<aside><h2>", 3, 0, "</h2>", 0), ("<ul><li>", 4, 4, "</li></ul></aside>", 0),
     ("<div class=comments><h2>", 2, 0, "</h2>", 0), ("<p>", 33, 0, "</p></div>", 0),
     ("<form><h2>", 3, 0, "</h2></form>", 0), ("<footer><h2>", 2, 0, "</h2>", 0), ("<p>", 6, 0, "</p></footer>", 0)],
]


# wrappers with furniture words in their names, cards that are one link, and
# comments whose elements have no name
LABELLED += [
    [("<div class='page social-layout'><nav><a>", 3, 3, "</a></nav>", 0), ("<article><h1>", 6, 0, "</h1>", 1),
     ("<p>", 40, 0, "</p>", 1), ("<p>", 12, 1, "</p>", 1), ("<p>", 70, 0, "</p></article></div>", 1),
     ("<div><h3>", 2, 0, "</h3>", 0), ("<p>", 35, 0, "</p>", 0), ("<p>", 60, 0, "</p>", 0), ("<p>", 6, 0, "</p></div>", 0)],
    [("<div class=modal><div><article><h1>", 5, 0, "</h1>", 1), ("<p>", 30, 0, "</p>", 1),
     ("<p>", 4, 0, "</p></article></div></div>", 1), ("<div><p>", 26, 0, "</p></div>", 0),
     ("<div><a href=x><h3>", 7, 7, "</h3>", 0), ("<p>", 25, 25, "</p></a></div>", 0), ("<footer>", 8, 0, "</footer>", 0)],
    [("<div class=search><main><h1>", 8, 0, "</h1>", 1), ("<p>", 9, 0, "</p>", 1), ("<p>", 85, 2, "</p></main></div>", 1),
     ("<div class=comments><article><p>", 44, 0, "</p></article>", 0), ("<article><p>", 90, 0, "</p></article></div>", 0),
     ("<div><p>", 55, 0, "</p></div>", 0)],
    [("<article><h1>", 5, 0, "</h1>", 1), ("<p>", 50, 0, "</p>", 1), ("<div><a href=x><h3>", 6, 6, "</h3>", 0),
     ("<p>", 30, 30, "</p></a></div>", 0), ("<p>", 28, 0, "</p></article>", 1), ("<div><p>", 15, 0, "</p>", 0),
     ("<p>", 110, 0, "</p></div>", 0)],
    [("<div class=sidebar><article><p>", 20, 0, "</p></article></div>", 1), ("<div><p>", 18, 0, "</p></div>", 0)],
    [("<article><h2>", 4, 0, "</h2>", 1), ("<p>", 33, 0, "</p></article>", 1), ("<article><h2>", 6, 0, "</h2>", 1),
     ("<p>", 47, 0, "</p></article>", 1), ("<section class=replies><article><p>", 21, 0, "</p></article></section>", 0)],
]
# furniture of every length around articles of every length
LABELLED += [
    page for w, body in ((3, 30), (5, 64), (8, 12), (10, 102), (12, 64), (15, 20), (19, 45), (26, 7), (40, 80), (70, 150))
    for page in (
        [("<nav><a>", w, w, "</a></nav>", 0), ("<div class=ad>", w, 0, "</div>", 0), ("<article><h1>", 7, 0, "</h1>", 1),
         ("<p>", body, 0, "</p>", 1), ("<p>", w, 0, "</p></article>", 1), ("<footer>", w, 0, "</footer>", 0)],
        [("<header>", w, 0, "</header>", 0), ("<main><p>", body, 0, "</p>", 1), ("<p>", body, 1, "</p></main>", 1),
         ("<aside><p>", w, 0, "</p></aside>", 0), ("<div class=notice>", w, 0, "</div>", 0), ("<footer>", w, 1, "</footer>", 0)],
        [("<article><p>", body, 0, "</p>", 1), ("<div class=share>", w, 0, "</div>", 0), ("<p>", body, 0, "</p></article>", 1),
         ("<div><p>", w, 0, "</p></div>", 0), ("<form><p>", w, 0, "</p></form>", 0), ("<footer>", w + 4, 0, "</footer>", 0)],
    )
]


def labelled_rows() -> list[tuple]:
    """Features and label of every block of LABELLED."""
    out = []
    for page in LABELLED:
        html = "".join(f"{before}<a>{'word ' * linked}</a>{'text ' * (words - linked)}{after}"
                       for before, words, linked, after, _ in page)
        blocks = blocks_of(html)
        if len(blocks) != len(page):
            raise ValueError("a labelled page does not give one block a row")
        out += [(*f, float(row[4])) for f, row in zip(features_of(blocks), page)]
    return out


def fit_tree(spark: SparkSession, rows: list[tuple] | None = None, depth: int = 8) -> list[tuple]:
    """Nodes ``(feature, threshold, left, right, prediction)`` of a tree
    trained with MLlib; node 0 is the root, leaves have feature -1."""
    table = spark.createDataFrame([(Vectors.dense(r[:-1]), r[-1]) for r in rows or labelled_rows()],
                                  ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, seed=7).fit(table)
    nodes: list[tuple] = []

    def walk(node) -> int:
        place = len(nodes)
        nodes.append(())
        if "Leaf" in node.getClass().getSimpleName():
            nodes[place] = (-1, 0.0, -1, -1, node.prediction())
        else:
            split = node.split()
            nodes[place] = (split.featureIndex(), split.threshold(), walk(node.leftChild()),
                            walk(node.rightChild()), node.prediction())
        return place

    walk(model._java_obj.rootNode())
    return nodes


def is_main(nodes: list[tuple], features: tuple) -> bool:
    k = 0
    while nodes[k][0] >= 0:
        k = nodes[k][2] if features[nodes[k][0]] <= nodes[k][1] else nodes[k][3]
    return nodes[k][4] == 1.0


def main_text(page: str | None, nodes: list[tuple]) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b[0] for b, f in zip(blocks, features_of(blocks)) if is_main(nodes, f))


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    nodes = fit_tree(pages.sparkSession)

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py(), nodes) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
                        ).mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
