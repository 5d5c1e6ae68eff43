"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of tags and runs of text.  Words score positive, tags
negative, and the contiguous region with the largest sum, found in one scan, is
the content.  What markup declares to be something else (menus, footers,
sidebars, notices, adverts, forms, scripts, comments) is taken out beforehand
and scores nothing; an element whose class or id only hints at that costs once; a form is
taken out unless it holds most of the page's words, as a container does.  The weights
are log odds of words and of each tag, as shares of all words and tags of their side,
from labelled pages: pages with an ``article`` or ``main`` element, whose inside is
content, and whose menus, footers and the like are the other side.  Where such elements
hold most of a page's words, words outside score as strongly against as those inside
for, and tags inside cost next to nothing; on other pages the element counts for nothing.
Text without spaces between words (Chinese, Japanese) counts a word a character.

The region's text: character references decoded, white space within a block one
space, blocks trimmed and joined by an empty line, in page order.

Defined cases: null or empty html gives an empty text; a page without words too;
unclosed elements end with what holds them, and ``head``, ``p``, ``li``, ``td`` and
their kind also where HTML implies their end; repeated rows are done one by one;
an empty table gives an empty result; only id, url and html are read.
Each page is on its own: one scan, no shuffle, memory of one batch.
"""

from __future__ import annotations

import html as _html
import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludeme.llm.text import quoted, text_slices

TOKEN = re.compile(
    r"(?is)<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|template|textarea|title|iframe)(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*+)([^<>]*+)>")
#: A name, and its value if there is one: names are anything but spaces, quotes, / and =.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']\S*))?""")
#: Characters that are words of their own: ideographs and kana.
ALONE = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd "
                   "label mark q rp rt ruby s samp small span strike strong sub sup time tt u "
                   "var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are not the article's text.
APART = frozenset("nav footer aside head button select option dialog menu object audio video "
                  "canvas fieldset input datalist svg noscript annotation annotation-xml".split())
#: Words of class and id values that name something other than the article.
NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo "
                  "promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar aside "
                  "footer cookie cookies consent notice notices gdpr popup modal overlay banner "
                  "comment comments disqus replies respond share sharing social related newsletter "
                  "subscribe subscription signup login search widget toolbar pagination pager "
                  "copyright masthead".split())
HEADS = frozenset(("header", "masthead", "banner"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog "
                  "menu menubar form".split())
#: Formulas: their text counts, their tags do not.
MATH = frozenset("math semantics annotation annotation-xml maction menclose merror mfenced mfrac mi "
                 "mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt "
                 "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split())
#: Other parts of names that hold one of NAMES and still name such an element; a name
#: with any further part may be a container's or the text's own ("search-results").
FORMS = frozenset("area bar block box btn button buttons container form global icons inner item "
                  "items link links list menu main page panel posts section site slot text top "
                  "unit wrap wrapper".split())
#: "no-sidebar" and the like tell what the page has, not what the element is.
STATES = frozenset("no has with without is hide show not".split())
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd td figcaption".split())
LOOSE = "~"  # a loosely named element: it costs as much as LOOSE_WORDS words gain
LOOSE_WORDS = 10
FRAMED = -0.05  # what a tag costs within the frame of a page
BREAK = "|"  # stands for a set-apart element: ends a block, scores nothing
#: Of what a page has once, the frame is never taken out by its class.
FRAME = frozenset(("html", "body", "main"))


#: What may come in a head; anything else ends it.
IN_HEAD = frozenset("title meta link base script style noscript template".split())
#: Beginnings that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu "
                   "nav ol p pre search section summary table ul dd dt".split())
#: Beginnings that end another element of their list or table.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
        "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
        "tbody": {"td", "th", "tr", "tbody", "thead"}, "tfoot": {"td", "th", "tr", "tbody", "thead"}}


@dataclass(frozen=True)
class Training:
    pages: int = 2000          # labelled pages that the weights are fitted on, at most
    least: float = 0.05        # every tag costs, every word gains, this much at least
    most: float = 8.0


@dataclass(slots=True)
class Token:
    name: str                  # of a tag, "" for text
    text: str
    inside: bool               # within an article or main element
    apart: bool = False        # within what markup sets apart


def n_words(text: str) -> int:
    return len(text.split()) + (0 if text.isascii() else len(ALONE.findall(text)))


def _implied(stack: list, name: str) -> int:
    """How many open elements stay open when ``name`` begins."""
    keep = len(stack)
    if name not in IN_HEAD and any(e[0] == "head" for e in stack):
        keep = next(i for i, e in enumerate(stack) if e[0] == "head")
    for ended, known in ((("p",), name in ENDS_P), (ENDS.get(name, ()), name in ENDS)):
        for i in range(keep - 1 if known else -1, -1, -1):
            if stack[i][0] in ended:
                keep = i
            elif stack[i][0] not in INLINE and stack[i][0] != "p":
                break
    return keep


def parse(page: str) -> list[Token]:
    """The page's tags and texts; set-apart elements leave a block boundary before them."""
    out: list[Token] = []
    stack: list[tuple[str, bool, bool]] = []  # name, set apart, in an article
    forms: list[list[int]] = []               # first and last token of outermost forms
    apart = inside = False
    at = 0

    def opened(n: int) -> None:
        """Keeps the n outermost open elements."""
        nonlocal apart, inside
        if forms and len(forms[-1]) == 1 and not any(e[0] == "form" for e in stack[:n]):
            forms[-1].append(len(out))
        del stack[n:]
        apart, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def said(text: str) -> None:
        if stack and stack[-1][0] == "head" and not text.isspace():
            opened(len(stack) - 1)
        out.append(Token("", text, inside, apart))
    for m in TOKEN.finditer(page):
        if m.start() > at:
            said(page[at:m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            if m[1]:
                out.append(Token(m[1].lower(), "", inside, apart))
            continue
        if m[2] or m[5]:
            was = apart, inside
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    opened(i)
                    break
            if name not in MATH:
                out.append(Token(name, "", was[1] and inside, was[0]))
            continue
        n = _implied(stack, name)
        if n < len(stack):
            opened(n)
        far = 2 if apart else _set_apart(name, m[4] or m[7] or "", inside)
        if far == 2 and not apart and name not in MATH:
            out.append(Token(BREAK, "", inside))
        apart = apart or far == 2
        if name == "form" and not apart and not any(e[0] == "form" for e in stack):
            forms.append([len(out)])
        if name not in MATH:
            out.append(Token(name, "", inside, apart))
            if far == 1:
                out.append(Token(LOOSE, "", inside))
        if name in VOID or name in ("svg", "math") and (m[4] or m[7] or "").endswith("/"):
            apart = stack[-1][1] if stack else False
            continue
        inside = inside or name in ("article", "main")
        stack.append((name, apart, inside))
    if at < len(page):
        said(page[at:])
    opened(0)
    return _without_forms(out, forms)


def _without_forms(out: list[Token], forms: list[list[int]]) -> list[Token]:
    """Sets forms apart that hold half of the page's words at most."""
    if not forms:
        return out
    sizes = [0 if t.name or t.apart else n_words(t.text) for t in out]
    for a, z in forms:
        if 2 * sum(sizes[a:z]) <= sum(sizes):
            for t in out[a:z]:
                t.apart = True
            out[a] = Token(BREAK, "", out[a].inside)
    return out


def _named(value: str, name: str, inside: bool) -> int:
    """2: a class or id names something other than the article; 1: it may; 0: no."""
    most = 0
    for token in value.split():
        parts = [x for x in re.split("[^a-z0-9]+", token) if x]
        if not parts or parts[0] in STATES:
            continue
        words = NAMES.intersection(parts)
        if name == "article":
            words &= {"comment", "comments", "reply", "replies", "ad", "related", "promo"}
        elif "header" in parts and not inside:
            words |= {"header"}
        if words and not (inside and words <= HEADS):
            whole = all(x in words or x in NAMES or x in FORMS or x.isdigit() for x in parts)
            most = max(most, 2 if whole and not (inside and name in TEXTS) else 1)
    return most


def _set_apart(name: str, attributes: str, inside: bool) -> int:
    """2: the element is taken out; 1: it is loosely named, the scan decides; 0: neither."""
    if name in APART or (name == "header" and not inside):
        return 2
    if not attributes or name in FRAME:
        return 0
    loose = 0
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            loose = max(loose, _named(value, name, inside))
            if loose == 2:
                return 2
        elif key == "hidden" and value != "until-found":
            return 2
        elif key == "role" and value in ROLES or key == "aria-hidden" and value == "true":
            return 2
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 2
    return loose


def region(tokens: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """The token range with the largest sum (the first, then longest, of equals)."""
    sizes = [0 if t.name else n_words(t.text) for t in tokens]
    within = sum(n for n, t in zip(sizes, tokens, strict=True) if t.inside)
    framed = 2 * within > sum(sizes)
    word, other = weights["word"], weights["tag"]
    best = here = 0.0
    a = z = start = 0
    for i, t in enumerate(tokens):
        if t.name == LOOSE:
            here -= LOOSE_WORDS * word
        elif t.name == BREAK:
            pass
        elif t.name:
            here += FRAMED if framed and t.inside else weights.get(t.name, other)
        elif framed and not t.inside:
            here -= word * sizes[i]
        else:
            here += word * sizes[i]
        if here <= 0:
            here, start = 0.0, i + 1
        elif here > best:
            best, a, z = here, start, i + 1
    return a, z


def main_text(page: str | None, weights: dict[str, float]) -> str:
    tokens = [t for t in parse(page or "") if not t.apart]
    a, z = region(tokens, weights)
    blocks, now = [], []
    for t in tokens[a:z]:
        if not t.name:
            now.append(t.text)
        elif t.name == "br":
            now.append(" ")
        elif t.name not in INLINE:
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    clean = (" ".join(_html.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def count_classes(page: str) -> dict[tuple[str, bool], int]:
    """Tags and words of the labelled element, and of the rest of the page as it is: what
    markup sets apart, within the element too, is of the other side."""
    out: dict[tuple[str, bool], int] = {}
    for t in parse(page):
        if t.name in (BREAK, LOOSE):
            continue
        name = (t.name if t.name in KNOWN else "tag") if t.name else "word"
        key = (name, t.inside and not t.apart)
        out[key] = out.get(key, 0) + (1 if t.name else n_words(t.text))
    return out


def log_odds(counts: dict[str, tuple[int, int]], t: Training) -> dict[str, float]:
    """Per kind (``word``, tags) the log of its share of what is inside over its share of what
    is outside.  ``tag`` is that of all tags together, for those that were not seen."""
    tags = [x for k, x in counts.items() if k != "word"]
    pooled = (sum(i for i, _ in tags), sum(o for _, o in tags))
    inside = pooled[0] + counts.get("word", (0, 0))[0] + len(counts)
    outside = pooled[1] + counts.get("word", (0, 0))[1] + len(counts)
    out = {}
    for k, (i, o) in (counts | {"tag": pooled}).items():
        odds = math.log((i + 1) / inside) - math.log((o + 1) / outside)
        out[k] = min(max(odds, t.least), t.most) if k == "word" else max(min(odds, -t.least), -t.most)
    return out


def fit_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                t: Training = Training()) -> dict[str, float]:
    """Log odds of content per word and tag, from ``t.pages`` labelled pages
    drawn by a hash of their id.  Words are kept positive, tags negative.
    Without labelled pages, words gain 1 and tags cost 1."""
    page = pages.select(quoted(id_col).alias("_id"), quoted(html_col).alias("html"))
    labelled = page.filter(F.col("html").rlike("(?i)<(article|main)[ >]"))
    # Ids are drawn first: only the drawn pages' html moves.
    ids = labelled.select("_id").orderBy(F.xxhash64("_id"), "_id").limit(t.pages).distinct()
    drawn = labelled.join(F.broadcast(ids), "_id", "left_semi")

    def count(batches):
        total: dict[tuple[str, bool], int] = {}
        for b in batches:
            for html in b.column("html").to_pylist():
                for key, n in count_classes(html).items():
                    total[key] = total.get(key, 0) + n
        rows = [(k, i, n) for (k, i), n in total.items()]
        name, inside, n = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array(inside, pa.bool_()),
                                          pa.array(n, pa.int64())], names=["name", "inside", "n"])
    counts = drawn.select("html").mapInArrow(
        count, "name string, inside boolean, n long").groupBy("name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("o")).collect()
    if not counts:
        return {"word": 1.0, "tag": -1.0}
    return log_odds({r["name"]: (r["i"], r["o"]) for r in counts}, t)   # names of KNOWN at most


KNOWN = INLINE | VOID | APART | FRAME | frozenset(
    "address article blockquote center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li ol p pre section summary table tbody td tfoot th thead title tr ul "
    "script style template noscript iframe svg".split())


def extract(pages: DataFrame, weights: dict[str, float], id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]   # by name

    def run(batches):
        for batch in batches:
            for b in text_slices(batch, "html", 8 << 20):
                texts = [main_text(h, weights) for h in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])
    return pages.select(quoted(id_col).alias("page_id"), quoted(url_col).alias("url"),
                        quoted(html_col).alias("html")).mapInArrow(
        run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
