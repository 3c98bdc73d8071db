"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags; inline tags vanish, line breaks are white
space, character references are decoded.  Every block knows its words, the share of stop
words among them, the share of its characters inside links, and where it stands.

Pass 1 decides each block on its own:

* bad: inside menus, headers, footers, sidebars, notices, adverts or reader comments (by tag,
  role, class or id; inside an article only by names made of such words alone), short and
  inside a form, or outside an article with most characters inside links;
* good: inside ``article`` or ``main``; elsewhere if long with enough stop words;
* bad: elsewhere if long with hardly any stop word;
* good: elsewhere if long, on pages whose text as a whole (outside the bad parts) has too few stop
  words for one of the languages the list covers;
* undecided: the short rest.

Pass 2: an undecided block takes the label of its nearest decided neighbour (of two equally
near ones that differ: good if it has stop words); without decided blocks it is good.

The good blocks' white space becomes one space each; they are joined in page order.

Defined results: null or empty html gives an empty text; unclosed tags, comments and raw
elements reach to the end of their parent or of the page; repeated pages give repeated
results; an empty table gives an empty one; extra columns are ignored by the query.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, column_of, docs_table, slices, texts

MAX_LINK_SHARE = 0.5
LONG_WORDS = 12
STOP_HIGH, STOP_LOW = 0.25, 0.08
#: Least share of stop words of a page's text for the list to cover its language.
COVERED = 2 * STOP_LOW

# --- fixed values: element names, words that name page parts, frequent words -------------
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "select", "button", "object", "canvas")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
BAD_TAGS = frozenset("nav footer aside head menu dialog fieldset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BAD_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices alert popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer
comment comments disqus reply replies respond discussion newsletter subscribe subscription signup login share sharing social related
recommended recommendations widget widgets toolbar pagination pager copyright disclaimer""".split())
#: Words that may stand beside one of these in a name that is bad inside an article, too.
PLAIN_NAMES = frozenset("""area article bar bars block blog bottom box button buttons container content first footer form group guest header inner item items
last left link links list main outer page post reader readers right row section site slot small text top unit user users visitor wrap
wrapper""".split())
STOP_WORDS = frozenset("""the of and to in is that it for on with as was be by this are from at or an have not he his but they which you
der die und das ist von den des nicht mit dem ein eine sich auf für als im zu auch an es er sie so wie bei oder aus
le la les de des et est que qui dans en un une du pour par sur pas au avec ce il plus se ne sont
el los las del y por con para una su al lo como más pero sus sin ya se no son o""".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>|<[!?][^>]*>", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_LETTERS = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|[^\W\d_]+")  # scripts without spaces by the character


class _Block:
    __slots__ = ("parts", "linked", "bad", "main", "form")

    def __init__(self, bad: bool, main: bool, form: bool = False):
        self.parts, self.linked, self.bad, self.main, self.form = [], 0, bad, main, form


def _names_bad(attrs: str, inside: bool) -> bool:
    for m in _NAMES.finditer(attrs):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            if value.lower() in BAD_ROLES and not (inside and value.lower() == "banner"):
                return True
            continue
        if inside:
            # an article names its subjects, too: a name is bad only if it is made of such words alone
            if any((own := {p.lower() for p in _PART.findall(name)}) & BAD_NAMES and own <= BAD_NAMES | PLAIN_NAMES for name in value.split()):
                return True
            continue
        parts = {p.lower() for p in _PART.findall(value)}
        if parts & BAD_NAMES or "header" in parts or "masthead" in parts:
            return True
    return False


def blocks(page: str) -> list[_Block]:
    """Blocks with text, in page order."""
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, bad, main, form
    links = 0
    out: list[_Block] = []
    now = _Block(False, False)

    def text(piece: str) -> None:
        if piece:
            piece = html.unescape(piece)
            now.parts.append(piece)
            if links:
                now.linked += len(piece.strip())

    def begin() -> _Block:
        out.append(now)
        return _Block(*(stack[-1][1:] if stack else (False, False, False)))

    at = 0
    for m in _TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if m[1] or not name:
            continue
        closing, attrs = m[2] or m[5], m[4] or m[7] or ""
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            now.parts.append(" ")
        if name not in BLOCK:
            bad = not closing and name not in VOID and "=" in attrs and not attrs.endswith("/") and _names_bad(attrs, any(s[2] for s in stack))
            nested = not closing and name not in VOID and not attrs.endswith("/") and any(s[0] == name for s in stack[-8:])
            if bad:
                stack.append((name, True, bool(stack and stack[-1][2]), bool(stack and stack[-1][3])))
                now = begin()
            elif nested:  # its end tag isn't that of the outer one
                stack.append((name, *stack[-1][1:]))
            elif closing and any(s[0] == name for s in stack[-8:]):
                while stack and stack.pop()[0] != name:
                    pass
                now = begin()
            continue
        if closing:
            if any(s[0] == name for s in stack):
                while stack.pop()[0] != name:
                    pass
        elif name not in VOID and not attrs.endswith("/"):
            if stack and stack[-1][0] == "p":
                stack.pop()
            if name not in ("html", "head"):  # the first part of a body ends a head without an end tag
                stack = [s for s in stack if s[0] != "head"]
            up_bad, up_main, up_form = stack[-1][1:] if stack else (False, False, False)
            bad = name in BAD_TAGS or name == "header" and not up_main or bool(attrs) and name != "body" and _names_bad(attrs, up_main)
            opens = name in ("article", "main") or "role=\"main\"" in attrs
            # a form may wrap the whole page: an article inside it is no form
            stack.append((name, up_bad or bad, up_main or opens, (up_form or name == "form") and not opens))
        now = begin()
    rest = page[at:]
    text(rest if "<" not in rest else re.sub(r"<[a-zA-Z/!?][^>]*\Z", "", rest, flags=re.S))
    out.append(now)
    return [b for b in out if b.parts]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    read = []
    for b in blocks(page):
        line = " ".join("".join(b.parts).split())
        if not line:
            continue
        words = _LETTERS.findall(line.lower())
        stop = sum(w in STOP_WORDS for w in words)
        read.append((line, len(words), stop, b.bad or b.form and len(words) < LONG_WORDS or not b.main and b.linked > MAX_LINK_SHARE * len(line), b.main))
    covered = sum(r[2] for r in read if not r[3]) >= COVERED * sum(r[1] for r in read if not r[3])
    found, label = [], []
    for line, n, stop, bad, main in read:
        if bad:
            good = False
        elif main:
            good = True
        elif n >= LONG_WORDS and (stop >= STOP_HIGH * n or not covered):
            good = True
        elif n >= LONG_WORDS and stop < STOP_LOW * n:
            good = False
        else:
            good = None
        found.append((line, stop > 0))
        label.append(good)
    decided = [i for i, g in enumerate(label) if g is not None]
    out = []
    for i, (line, stop) in enumerate(found):
        good = label[i]
        if good is None:
            at = bisect_left(decided, i)
            near = sorted((abs(j - i), j) for j in decided[max(at - 1, 0):at + 1])
            if not near:
                good = True
            elif len(near) == 2 and near[0][0] == near[1][0] and label[near[0][1]] != label[near[1][1]]:
                good = stop
            else:
                good = label[near[0][1]]
        if good:
            out.append(line)
    return " ".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches):
            out = [main_text(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([column_of(batch, "page_id"), column_of(batch, "url"), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return arrow_map(rows, run, "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(docs_table(spark, sf_dir, "pages"))


SQL: dict[str, str] = {}
QUERIES = {"op7_html_extraction": op7_html_extraction}
