"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks at block-level tags. A block has the number of its
words, the share of them inside links, the same of its neighbours, whether it is
a heading, a paragraph or neither, and where it stands: in an article or main
part, and in containers whose tag or class names another part of the page. Such
a mark is plain (a footer, ``class="cookie-notice"``) or only a hint
(``class="alert"``, ``class="tabs-content"``), which a long text outweighs. A
decision tree decides block by block; it is grown on ``labelled_pages()``, the
layouts of ``LAYOUTS`` filled with texts of many lengths, some three thousand
blocks whatever the size of the input.

Rows are independent, so the work is one pass over the pages without a shuffle.

Cases: a null or empty page has the text ``""``; unclosed scripts, styles, text
areas, comments, quotes and character references end with the page, an unclosed
link with its block, and an unclosed button, selection, drawing or template ends
at once; repeated rows each keep their row; other columns are not read.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|["'][^>]*+(?:>|\Z)|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.DOTALL,
)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

#: Their content is not text. Without an end, the first ones reach to the end of the page, the others hold nothing.
RAW = {"script", "style", "title", "textarea", "iframe", "svg", "template"}
TO_THE_END = {"script", "style", "title", "textarea", "iframe"}
CLOSE = {name: re.compile(rf"</{name}[\s/>]|</{name}\Z", re.IGNORECASE) for name in RAW}
#: Parts of forms inside a text; they count only where their end comes before the next of their kind.
CONTROLS = {"button", "select"}
NEXT = {name: re.compile(rf"<(/?){name}(?:[\s/>]|\Z)", re.IGNORECASE) for name in {*CONTROLS, "a"}}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PARAGRAPHS = {"p", "li", "td", "th", "dd", "dt", "blockquote", "pre", "figcaption", "caption"}
BOILERPLATE = {"nav", "footer", "aside", "menu", "dialog", "search"}
FORM = {"form", "fieldset"}
MAIN = {"article", "main"}
#: Class, id and role names that mark a container as no part of the text.
MARKS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored "
    "nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar "
    "masthead topbar footer copyright colophon sidebar aside rail "
    "cookie cookies consent gdpr newsletter comment comments commentlist disqus reply replies respond "
    "related recommended".split()
)
#: Names that as often stand on a wrapper or a part of the text: a hint.
HINTS = set(
    "header menu tabs toc alert notice notices disclaimer paywall popup modal overlay banner promo promotion widget bottom "
    "discussion share sharing social subscribe subscription signup login search form".split()
)
#: Together with these, a name says what a container holds or goes with.
WRAPPERS = {"content", "page", "body", "wrapper", "wrap", "container", "layout", "inner", "outer", "text", "area"}
ABOUT = {"with", "has", "no", "without", "enabled", "open", "closed"}
#: Names of the part that holds the text.
TEXT_PART = {"main", "content", "article", "post", "entry", "story"}

FEATURES = ["words", "link_share", "words_before", "link_share_before", "words_after", "link_share_after", "in_main", "page_has_main", "mark", "kind"]


def _named(attributes: str) -> tuple[int, bool]:
    """How far class, id and role mark a container (0, 1 a hint, 3 plainly), and whether they name the text's part."""
    mark, main = 0, False
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = set(re.split(r"[^a-z0-9]+", name))
            if not words.isdisjoint(ABOUT):
                continue
            plain, hint = not words.isdisjoint(MARKS), not words.isdisjoint(HINTS)
            if plain:
                mark = 3
            elif hint:
                # "cookie-notice" is plain by its first word, "login-form" by two hints, "form-page" is a wrapper
                mark = max(mark, 3 if len(words & HINTS) > 1 else 0 if words & WRAPPERS else 1)
            elif words & TEXT_PART and words <= TEXT_PART | WRAPPERS:
                main = True
    return mark, main


def _closes(stack: list, name: str) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            del stack[i:]
            return


def blocks(page: str) -> list[tuple[str, int, int, bool, int, int]]:
    """Flat blocks in page order: text, words, words in links, in a main part, mark of its containers (2 a form), kind (2 heading, 1 paragraph)."""
    found: list[tuple[str, int, int, bool, int, int]] = []
    stack: list[tuple[str, bool, int, int]] = []  # name, main, mark, kind; of the containers around
    parts: list[str] = []
    linked: list[str] = []
    link = 0  # 1 up to the end tag, 2 up to the end of the block
    endless: set[str] = set()
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal link
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            links = len(html.unescape(" ".join(linked)).split())
            found.append((text, text.count(" ") + 1, links, *(stack[-1][1:] if stack else (False, 0, 0))))
        parts.clear()
        linked.clear()
        link = link if link == 1 else 0

    while at < end:
        tag = TAG.search(page, at)
        text = page[at : tag.start()] if tag else page[at:]
        if text:
            parts.append(text)
            if link:
                linked.append(text)
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name == "a":
            link = 0
            if not tag[1] and re.search(r"(?:^|\s)href\s*=", tag[3], re.IGNORECASE):
                following = NEXT["a"].search(page, at)
                link = 1 if following and following[1] else 2
        if tag[1]:
            if name in BLOCK or any(entry[0] == name for entry in stack):
                flush()
                _closes(stack, name)
            continue
        if name in RAW:
            if name not in endless and (not tag[3].endswith("/") or name not in ("svg", "iframe")):
                close = CLOSE[name].search(page, at)
                if not close:
                    endless.add(name)
                at = close.start() if close else end if name in TO_THE_END else at
            continue
        if name == "br":
            parts.append(" ")
            continue
        main, mark, kind = stack[-1][1:] if stack else (False, 0, 0)
        named, is_main = _named(tag[3])
        is_main = name in MAIN or is_main and name in ("div", "section", "td")
        if name in CONTROLS:
            following = NEXT[name].search(page, at)
            if not (following and following[1]):
                continue
            named = 3
        elif name in BOILERPLATE or name == "header" and not main:
            named = 3
        elif name in FORM:
            named = max(named, 2)
        if name in BLOCK:
            flush()
            while stack and stack[-1][0] == "p":
                stack.pop()
            if name in ("li", "td", "th", "dd", "dt", "tr") and stack and stack[-1][0] == name:
                stack.pop()
            main, mark, kind = stack[-1][1:] if stack else (False, 0, 0)
        elif named < 3:
            continue
        else:
            flush()
        if name in VOID or name in ("body", "html", "head"):
            continue
        if is_main and not main and mark < 3:
            mark = 0  # a wrapper, as it holds the text
        kind = 2 if name in HEADINGS else 1 if name in PARAGRAPHS else kind if name not in ("div", "section") else 0
        stack.append((name, main or is_main, max(mark, named), kind))
    flush()
    return found


def features(found: list[tuple[str, int, int, bool, int, int]]) -> np.ndarray:
    """One row of ``FEATURES`` per block."""
    rows = np.zeros((len(found), len(FEATURES)))
    if not found:
        return rows
    words = np.array([b[1] for b in found], float)
    share = np.array([b[2] for b in found], float) / words
    rows[:, 0], rows[:, 1] = words, share
    rows[1:, 2], rows[1:, 3] = words[:-1], share[:-1]
    rows[:-1, 4], rows[:-1, 5] = words[1:], share[1:]
    rows[:, 6] = [b[3] for b in found]
    rows[:, 7] = rows[:, 6].max()
    rows[:, 8] = [b[4] for b in found]
    rows[:, 9] = [b[5] for b in found]
    return rows


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 10) -> tuple:
    """A binary decision tree by Gini impurity: ``(label,)`` or ``(feature, limit, low, high)``."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (bool(share >= 0.5),)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= limit
            impurity = sum(part.sum() * labels[part].mean() * (1 - labels[part].mean()) for part in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, limit, low)
    if best is None:
        return (bool(share >= 0.5),)
    _, feature, limit, low = best
    return (feature, float(limit), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


def decide(tree: tuple, row: np.ndarray) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


#: Layouts of pages. ``{l}`` is a text of 15 to 90 words, ``{m}`` of 8 to 25, ``{s}`` of 1 to 12, ``{k}`` links, ``{a}`` one,
#: ``{t}`` a long one; blocks of the main text begin with "+".
LAYOUTS = [
    "<body><nav>{k}</nav><div class='ad'>{s}</div><article><h1>+ {s}</h1><p>+ {l}</p><p>+ {s}</p><p>+ {l}</p></article><footer>{s}</footer></body>",
    "<body><header>{s}</header><main><p>+ {l}</p><p>+ {s}</p><p>+ {a}</p><div class='comments'><p>{l}</p><p>{s}</p></div></main><aside>{l}</aside></body>",
    "<body><div id='menu'>{k}</div><h1>+ {s}</h1><p>+ {l}</p><p>+ {l} {a}</p><p>+ {a} {l}</p><div class='footer'>{s}</div></body>",
    "<body>{k}<div>+ {l}</div><div>+ {l}</div><div>{a}</div></body>",
    "<body><div class='cookie-notice'>{l}</div><article><p>+ {l}</p><ul><li>+ {s}</li><li>+ {s}</li></ul><form>{s}</form><p>+ {l}</p></article><div>{l}</div><p>{s}</p></body>",
    "<body><p>{a}</p><p>{a}</p><p>+ {l}</p><p>+ {l}</p><p>+ {l}</p><p>{a}</p></body>",
    "<body><article><header><h2>+ {s}</h2><p>+ {s}</p></header><blockquote>+ {l}</blockquote><div class='related'>{k}</div><p>+ {s}</p></article><section id='comments'><p>{l}</p></section></body>",
    "<body><div>{s}</div><p>+ {l}</p><p>+ {l}</p><div>{s}</div></body>",
    "<body><article><p>+ {l}</p><p>+ {s}</p>",
    "<body><div>{a}</div><p>+ {l}</p><h2>+ {s}</h2><p>+ {l}</p><h3>{s}</h3>{k}</body>",
    "<article><p>+ {a}</p><p>+ {l}</p><p>+ {a} {a}</p></article>",
    "<body><article><h1>+ {s}</h1><p>+ {s}</p><p>+ {s}</p></article><p>{s}</p></body>",
    "<body><p>{l}</p><article><p>+ {s}</p></article><p>{l}</p></body>",
    "<body><p>{s}</p><main><h1>+ {s}</h1><table><tr><td>+ {s}</td><td>+ {s}</td></tr></table><p>+ {l}</p></main></body>",
    "<body><p>+ {l}</p></body>",
    "<body><div>+ {l}</div></body>",
    "<body><div class='content'><p>+ {s}</p><p>+ {s}</p></div></body>",
    "<body><div id='header'>{s}</div><div class='post-content'><h2>+ {s}</h2><p>+ {l}</p><p>+ {s}</p></div><div class='sidebar'><h3>{s}</h3>{k}<p>{l}</p></div></body>",
    "<body><article><p>+ {l}</p><div class='alert'>+ {l}</div><div class='alert'>{s}</div><div class='menu'>{k}</div><div class='menu'>+ {l}</div><p>+ {l}</p></article></body>",
    "<body><div class='notice'>{s}</div><div class='banner'>{l}</div><div class='tabs-content'><p>+ {l}</p><p>+ {l}</p></div><div class='widget'>{l}</div></body>",
    "<body><form id='page'><div class='menu'>{k}</div><article><h1>+ {s}</h1><p>+ {l}</p></article><div class='login'>{s}</div></form></body>",
    "<body><article><p>+ {l}</p><div class='share'>{a}</div><div class='newsletter'>{l}</div><div class='social'>{s}</div></article><div class='popup'>{l}</div></body>",
    "<body><p>{t}</p><p>+ {l}</p><p>+ {l}</p><div>{t}</div></body>",
    "<body><p>+ {l}</p><p>+ {l}</p><div>{t} {s}</div></body>",
    "<body><h2>{a}</h2><div>{m}</div><div>{t}</div><div>{m}</div><h2>{a}</h2><div>{m}</div><div>{t}</div></body>",
    "<body><div>{t}</div><div>{t}</div><article><p>+ {l}</p><p>+ {m}</p><p>+ {t} {l}</p></article><div>{t}</div></body>",
    "<body><div class='content'><h1>+ {s}</h1><p>+ {m}</p><div class='promo'>{t}</div><p>+ {m}</p></div><div>{m}</div></body>",
    "<body><article><div>+ {s}</div><div>+ {m}</div><div>+ {l}</div><div>+ {s}</div></article><div>{s}</div><div>{m}</div></body>",
    "<body><main><div>+ {s}</div><form><p>{l}</p><p>{s}</p></form><div>+ {m}</div><p>+ {s}</p></main><div>{m}</div></body>",
    "<body><form><p>{l}</p><div>{m}</div></form><p>+ {l}</p></body>",
    "<body><p>{s}</p></body>",
    "<body><div>{s}</div></body>",
]
DRAWS = 16


def labelled_pages() -> list[str]:
    """The labelled table: every layout with ``DRAWS`` draws of texts, the same in every run."""
    rng = random.Random(6)
    text = lambda least, most: " ".join(["word"] * rng.randint(least, most))
    link = lambda: f"<a href='/'>{text(1, 6)}</a>"
    fill = {
        "{l}": lambda: text(15, 90),
        "{s}": lambda: text(1, 12),
        "{m}": lambda: text(8, 25),
        "{a}": link,
        "{t}": lambda: f"<a href='/'>{text(10, 40)}</a>",
        "{k}": lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 7))) + "</ul>",
    }
    return [re.sub(r"\{[lmsakt]\}", lambda m: fill[m[0]](), layout) for layout in LAYOUTS for _ in range(DRAWS)]


def train(pages: list[str] | None = None) -> tuple:
    rows, labels = [], []
    for page in labelled_pages() if pages is None else pages:
        found = blocks(page)
        labels += [b[0].startswith("+") for b in found]
        rows.append(features([(b[0], b[1] - b[0].startswith("+"), *b[2:]) for b in found]))
    return grow(np.round(np.vstack(rows), 1), np.array(labels, float))


def main_text(page: str | None, tree: tuple) -> str:
    found = blocks(page or "")
    return "\n\n".join(block[0] for block, row in zip(found, features(found), strict=True) if decide(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, tree) for page in batch.column(2).to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
