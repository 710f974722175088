"""Main text of web pages from flat text blocks and a decision tree.

A page is read once, tag by tag, into flat blocks: the text between two block
boundaries, its character references decoded and its white space turned into
single blanks.  A block has its word count and link density (words inside
links / words), those of its neighbours, and marks of where it stands: below
an article or main element, below an element whose name, role, class or id
says navigation, header, footer, side column, notice, advert, form or
comments, in a heading, on a page that has an article at all.  A decision tree
over these numbers tells main text from the rest.  It is trained on the
driver from a small labelled table, the blocks of pages that ``labelled_pages``
composes from labelled fragments; nothing of the judged pages is learned from.

Each page is one row and is judged inside its row: no shuffle.

Odd rows: a null or empty html, and one without main text, gives ``''`` and 0.
A page cut off anywhere is read up to the cut; a tag cut off is markup and
goes, a reference cut off stays as text.  Null ids and urls are passed on.
Repeated rows are judged each; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from random import Random
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import emit

# --- blocks --------------------------------------------------------------------

# Element names of HTML by what they mean here.
BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
            "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
            "option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes noscript xmp".split())
UNSEEN = set("template svg math object canvas audio video datalist".split())
MAIN = {"article", "main"}
CHROME = set("nav aside footer form menu dialog button select search fieldset".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CHROME_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                   "toolbar".split())
# Words and stems of class names and ids.
CHROME_WORDS = set("ad ads adv nav side aside foot menu meta modal pager popup promo reply respond share tags tool "
                   "login signup search hidden skip legal byline".split())
CHROME_STEMS = ("sidebar", "navbar", "navigation", "footer", "advert", "sponsor", "cookie", "consent", "notice",
                "notification", "newsletter", "subscri", "comment", "disqus", "social", "sharing", "related",
                "recommend", "breadcrumb", "paginat", "widget", "toolbar", "disclaimer", "copyright", "dropdown",
                "banner", "popup", "overlay")
MAIN_WORDS = {"content", "article", "post", "entry", "story", "main", "body", "text"}

# A start tag of the key ends an open element of the value.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "article", "main", "body"}

_ATTRIBUTES = r"(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+"
_MARKUP = re.compile(rf"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>"
                     r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


class Marks(NamedTuple):
    """Where a block stands; an element's marks hold for all below it."""
    article: bool = False   # below an article or main element
    named: bool = False     # below an element named like main text
    chrome: bool = False    # below navigation, a side column, a form, ...
    header: bool = False    # below a header
    unseen: bool = False    # never shown as text


class Block(NamedTuple):
    text: str
    words: int
    linked: int             # words inside links
    marks: Marks
    heading: bool


def _marks(tag: str, attributes: str, above: Marks) -> Marks:
    names, role, unseen = "", "", tag in UNSEEN
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            names += " " + value
        elif key == "role":
            role = value.strip()
        elif key == "style":
            unseen |= "display:none" in value.replace(" ", "")
    unseen |= bool(re.search(r"(?:^|\s)hidden(?=\s|=|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))
    if tag in ("html", "body"):
        return above
    words = set(re.findall(r"[a-z]+", names))
    chrome = tag in CHROME or role in CHROME_ROLES or bool(words & CHROME_WORDS) or any(s in names for s in CHROME_STEMS)
    return Marks(above.article or tag in MAIN or role in MAIN, above.named or bool(words & MAIN_WORDS),
                 above.chrome or chrome, above.header or tag == "header" or "header" in words or "masthead" in words,
                 above.unseen or unseen)


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order; those without a word are left out."""
    out: list[Block] = []
    stack: list[tuple[str, Marks]] = []
    pieces: list[tuple[str, bool]] = []      # text, and whether inside a link
    link = False

    def marks() -> Marks:
        return stack[-1][1] if stack else Marks()

    def close_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(t for t, _ in pieces)).split())
            if text and not marks().unseen:
                words = len(text.split())
                linked = len(html.unescape(" ".join(t for t, inside in pieces if inside)).split())
                heading = any(tag in HEADINGS for tag, _ in stack[-3:])
                out.append(Block(text, words, min(words, linked), marks(), heading))
            pieces.clear()

    def end(tags: set[str], within: set[str]) -> None:
        """Closes the innermost open element of ``tags``, and all inside it."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in within:
                return

    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        if not m:
            pieces.append((page[at:], link))
            break
        if m.start() > at:
            pieces.append((page[at:m.start()], link))
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                link = False
            elif tag in BLOCK or tag in UNSEEN:
                close_block()
                end({tag}, set())
                link = False
            continue
        if tag in RAW:
            done = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = done.end() if done else len(page)
        elif tag == "br":
            pieces.append((" ", link))
        elif tag == "a":
            link = True
        elif tag in BLOCK or tag in UNSEEN:
            close_block()
            end({"p"}, SCOPES - {"ul", "ol", "dl"} | {"td", "th", "li", "dd", "div", "section"})
            if tag in ENDS:
                end(ENDS[tag], SCOPES)
            if tag not in VOID:
                stack.append((tag, _marks(tag, m[3], marks())))
    close_block()
    return out


# --- features and tree -----------------------------------------------------------

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "article", "named", "chrome", "header", "heading", "page_has_article")


def features_of(blocks: list[Block]) -> list[tuple[float, ...]]:
    sizes = [(float(b.words), b.linked / b.words) for b in blocks]
    beside = [(0.0, 0.0), *sizes, (0.0, 0.0)]
    has = float(any(b.marks.article and not b.marks.chrome for b in blocks))
    return [(*sizes[i], *beside[i], *beside[i + 2], float(b.marks.article), float(b.marks.named),
             float(b.marks.chrome), float(b.marks.header), float(b.heading), has) for i, b in enumerate(blocks)]


class Leaf(NamedTuple):
    share: float            # of main text among the training blocks here


class Split(NamedTuple):
    feature: int
    cut: float
    low: Split | Leaf       # feature <= cut
    high: Split | Leaf


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 10) -> Split | Leaf:
    """A binary tree by least Gini impurity; cuts lie halfway between two
    values, the first feature and the lowest cut win ties."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return Leaf(share)
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, hits = x[order, f], np.cumsum(y[order])
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        n, k = cuts + 1.0, hits[cuts]
        rest, rest_k = len(y) - n, hits[-1] - k
        impurity = k * (n - k) / n + rest_k * (rest - rest_k) / rest
        i = int(np.argmin(impurity))
        if best is None or impurity[i] < best[0] - 1e-9:
            best = impurity[i], f, (v[cuts[i]] + v[cuts[i] + 1]) / 2
    if best is None:
        return Leaf(share)
    _, f, cut = best
    low = x[:, f] <= cut
    return Split(f, float(cut), fit_tree(x[low], y[low], depth - 1), fit_tree(x[~low], y[~low], depth - 1))


def predict(tree: Split | Leaf, row: tuple[float, ...]) -> float:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.cut else tree.high
    return tree.share


# --- the labelled table ----------------------------------------------------------
# Fragments of pages with their label: whether their blocks are main text.  {s}, {m} and {l} are
# short, middle and long runs of words.

INSIDE = [("<h1>{s}</h1>", True), ("<p>{l}</p>", True), ("<p>{s}</p>", True), ("<h2>{s}</h2>", True),
          ("<p>{m} <a href=x>{s}</a> {m}</p>", True), ("<ul><li>{m}</li><li>{s}</li></ul>", True),
          ("<p><a href=x>{s}</a></p>", True), ("<blockquote>{m}</blockquote>", True), ("<p>{l}</p>", True),
          ("<aside><p>{m}</p></aside>", False), ("<div class=ad>{l}</div>", False), ("<p>{m}</p>", True),
          ("<div class=share><a href=x>{s}</a></div>", False), ("<form><p>{m}</p></form>", False),
          ("<div class=newsletter><p>{l}</p></div>", False), ("<table><tr><td>{s}</td><td>{m}</td></tr></table>", True),
          ("<section class=comments><p>{l}</p><p>{m}</p></section>", False), ("<footer><p>{m}</p></footer>", False),
          ("<header><h1>{s}</h1><p>{m}</p></header>", None), ("<header><p>{l}</p></header>", False)]
ABOVE = [("<nav><ul><li><a href=x>{s}</a></li><li><a href=x>{s}</a></li></ul></nav>", False),
         ("<header><h1>{s}</h1><p>{m}</p></header>", False), ("<div class=ad>{m}</div>", False),
         ("<div class=ad>{l}</div>", False), ("<div id=cookie-notice><p>{l}</p></div>", False),
         ("<div class=banner>{m}</div>", False), ("<ul><li><a href=x>{s}</a></li><li><a href=x>{s}</a></li></ul>", False),
         ("<p>{s}</p>", False), ("<p><a href=x>{m}</a> <a href=x>{l}</a></p>", False)]
BELOW = [("<aside><h2>{s}</h2><p>{l}</p></aside>", False), ("<div id=comments><p>{l}</p><p>{s}</p></div>", False),
         ("<form><p>{m}</p></form>", False), ("<div class=related><a href=x>{m}</a></div>", False),
         ("<footer><p>{l}</p></footer>", False), ("<footer>{m}</footer>", False),
         ("<ul><li><a href=x>{s}</a></li><li><a href=x>{m}</a></li></ul>", False), ("<p>{s}</p>", False),
         ("<div><a href=x>{l}</a> <a href=x>{m}</a></div>", False)]
# Main text on pages without any container: told by lengths and links alone.
BARE = [("<h1>{s}</h1>", True), ("<p>{l}</p>", True), ("<p>{m}</p>", True), ("<p>{l}</p>", True), ("<p>{s}</p>", True),
        ("<p>{l}</p>", True), ("<p>{m} <a href=x>{s}</a> {m}</p>", True), ("<p>{l}</p>", True)]
# Beside an article, plain text without any mark is not main text either.
BESIDE = [("<p>{l}</p>", False), ("<div>{m}</div>", False), ("<h2>{s}</h2>", False), ("<div><p>{l}</p></div>", False)]
ARTICLES = [("<article>", "</article>"), ("<main>", "</main>"),
            ("<div class=wrap><article class=post>", "</article></div>")]
NAMED = [("<div id=content>", "</div>"), ("<div class='post entry-content'>", "</div>")]
LENGTHS = ((2, 14, 60), (1, 7, 16), (4, 18, 120), (3, 11, 28))  # words of {s}, {m}, {l}
PAGES_EACH = 8


def labelled_pages() -> Iterator[list[tuple[str, bool | None]]]:
    """Pages as lists of (fragment, label): every holder with every length,
    the fragments around and inside it in ``PAGES_EACH`` fixed orders."""
    for opens, closes in (*ARTICLES, *NAMED, ("", "")):
        inside, around = (INSIDE if opens else BARE), ((opens, closes) in ARTICLES) * BESIDE
        for s, m, l in LENGTHS:
            words = {"s": " ".join(["w"] * s), "m": " ".join(["w"] * m), "l": " ".join(["w"] * l)}
            for k in range(PAGES_EACH):
                deal = Random(k)
                above, below = (deal.sample(f + around, deal.randint(2, len(f))) for f in (ABOVE, BELOW))
                within = deal.sample(inside, len(inside)) if opens else inside
                page = [*above, (opens, None), *within, (closes, None), *below]
                yield [(f.format(**words), label) for f, label in page]


def training_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of the labelled pages.  An article's
    own header holds its title, which is main text, and other lines, which are not."""
    rows, labels = [], []
    for page in labelled_pages():
        blocks, kinds = blocks_of("".join(f for f, _ in page)), []
        for fragment, label in page:
            own = blocks_of(fragment)
            kinds += [b.heading if label is None else label for b in own]
        if len(blocks) != len(kinds):
            raise AssertionError("a labelled fragment changes the blocks beside it")
        rows += features_of(blocks)
        labels += kinds
    return np.array(rows), np.array(labels, float)


@lru_cache(maxsize=1)
def trained_tree() -> Split | Leaf:
    return fit_tree(*training_table())


# --- operators -------------------------------------------------------------------

BLOCKS = ("page_id long, position int, text string, main double, heading boolean, "
          + ", ".join(f"{f} double" for f in FEATURES if f != "heading"))
_BLOCKS = pa.schema([("page_id", pa.int64()), ("position", pa.int32()), ("text", pa.string()), ("main", pa.float64()),
                     ("heading", pa.bool_()), *((f, pa.float64()) for f in FEATURES if f != "heading")])
_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _judged(page: str | None, tree: Split | Leaf) -> list[tuple[Block, tuple[float, ...], float]]:
    blocks = blocks_of(page or "")
    return [(b, f, predict(tree, f)) for b, f in zip(blocks, features_of(blocks))]


def text_blocks(pages: DataFrame) -> DataFrame:
    """Every text block of every page (``page_id long, html string``) with its
    features and ``main``, the tree's share of main text."""
    tree = trained_tree()

    def rows(batches):
        for batch in batches:
            for page_id, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k, (b, f, share) in enumerate(_judged(page.as_py(), tree)):
                    own = [v for name, v in zip(FEATURES, f) if name != "heading"]
                    yield (page_id, k, b.text, share, b.heading, *own), 128 + len(b.text)

    return pages.select(F.col("page_id").cast("long"), "html").mapInArrow(
        lambda batches: emit(_BLOCKS, rows(batches)), BLOCKS)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main blocks of every page (``page_id
    long, url string, html string``), one a line."""
    tree = trained_tree()

    def rows(batches):
        for batch in batches:
            for page_id, url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = "\n".join(b.text for b, _, share in _judged(page.as_py(), tree) if share > 0.5)
                yield (page_id, url, text), 64 + 2 * len(text)

    texts = pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        lambda batches: emit(_TEXTS, rows(batches)), "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
