"""Main text of web pages by two passes of block rules.

A page is cut into blocks (paragraphs, headings, list items, table rows ...).
The first pass gives each block votes for what it holds: link density, length
and the density of stop words.  An ``article`` or ``main`` around a block is
one vote more, or one less for what is outside of it.  Blocks in menus,
headers, footers, sidebars and forms (by element or role) are bad, and so are
those in elements whose class or id consists of words for such parts, notices,
adverts or comments; a class that has other words too, or that is around the
only prose of the page, tells nothing.  What the votes leave open (headings,
short blocks, long ones without stop words) is ambiguous.

In the second pass ambiguous blocks inherit the label of the nearest decided
neighbours.  The distance counts blocks, and borders of containers more; the
ends of the page are bad neighbours, and labels don't cross the border of an
article.  A heading looks ahead only, to what it is the heading of.  Between a
good and a bad neighbour at the same distance the good one wins.  Where no
block is good, long ones count without stop words, and where there are none,
all are kept that aren't bad.

Character references are decoded, white space inside a block (line breaks
too) becomes one space, blocks are joined by a line feed.  Scripts, styles,
comments in the markup and other markup never reach a block.  Broken markup is
read as far as it goes: unclosed elements end with the one around them.

A null or empty page gives an empty text.  Repeated rows repeat; an empty
table stays empty; extra columns are ignored, whatever their names.  Pages are
read in one pass: time and memory grow with their length, however deep their
elements are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as tk
from .store import small_batches

#: Stop words of the languages that the rules know: English, French, German, Spanish.
STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can could for from had has have he her his i if in into is it its
    may more my no not of on one or our out she so such than that the their them then there these they this to up was we were
    what when which who will with would you your
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais même nous on ou où par pas plus
    pour que qui sa sans se ses son sont sur un une vous
    als am auch auf aus bei bis das dass dem den der des die doch durch ein eine einem einen einer er es für haben hat ich ihr
    im in ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war was wie wir wird zu zum zur
    al como con cuando del desde donde el ella ellos era es esta este esto fue ha hay la las lo los me muy nos o para pero
    por porque que se sin sobre son su sus también tiene todo una uno y ya
    """.split()
)
#: Characters from which a block counts as of middle length, and as long.
MIDDLE, LONG = 50, 140
#: Stop words per word that make a long block, and one of middle length, good.
DENSE_LONG, DENSE_MIDDLE = 0.1, 0.25
#: Characters in links, as a part of all, above which a block is a menu.
LINKED = 0.5
#: What a border of a container adds to the distance of blocks.
BORDER = 2
#: Characters of prose under a class mark that overrule it where there is none besides.
PROSE = 3 * LONG
#: Characters of text that go back to the JVM at once.
OUT_CHARS = 4_000_000

RAW = frozenset("script style noscript template svg iframe object canvas audio video textarea select button title noembed noframes xmp math datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ALWAYS_BAD = frozenset("nav aside footer form head dialog menu fieldset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
#: Words in a class or id that tell menus, headers, footers, sidebars, notices, adverts, forms and comments.
BAD_NAMES = frozenset(
    """
    ad ads adbox advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promos promotion
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    sidebar sidebars side rail widget widgets aside nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager topbar toolbar
    header masthead footer colophon copyright comment comments commentlist disqus reply replies respond reactions
    related recommended recommendations share sharing social form search skip hidden
    """.split()
)
#: Words that may stand beside these: parts, sides and kinds of boxes.
PLAIN_NAMES = frozenset(
    "area bar block bottom box col column container content float group holder inner item items js left links list module outer page primary right row secondary section site slot small sticky thread top unit user view wide wrap wrapper".split()
)
#: Words for the text itself: beside one of these no other word tells anything.
GOOD_NAMES = frozenset("article blog body entry main post prose story text".split())
UNMARKED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
#: The region of a header outside of articles.
HEADER = -(1 << 30)
#: Containers whose borders lie between blocks.
BORDERED = frozenset("article aside blockquote center dialog details div dl fieldset figure footer form header hgroup main menu nav ol section table ul".split())
ITEMS = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.IGNORECASE)
NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    tag: str
    region: int  # number of the article that it stands in, 0 outside
    at: int  # its place, borders of containers counted
    fixed: int  # 1: in a part that is never the text, 2: in a form
    mark: int  # number of the outermost element with a bad class or id around it, 0: none
    votes: int = 0
    label: int = 0  # 1 good, -1 bad, 0 open


#: What the attributes of an element say: nothing, a bad class or id, a part that is never the text.
NOTHING, NAMED, FIXED = 0, 1, 2


def _attributes_say(attributes: str) -> int:
    words, bad = set(), False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in BAD_ROLES:
            return FIXED
        if name in ("class", "id"):
            for token in value.split():
                found = {x.lower() for x in NAME_WORDS.findall(token)}
                words |= found
                bad = bad or not found.isdisjoint(BAD_NAMES) and found <= BAD_NAMES | PLAIN_NAMES
    return NAMED if bad and words.isdisjoint(GOOD_NAMES) else NOTHING


def _decoded(text: str) -> str:
    n = text.count("&")
    if not n:
        return text
    return text.replace("&amp;", "&") if n == text.count("&amp;") else html.unescape(text)


def blocks(page: str) -> list[Block]:
    """The blocks of a page in its order, marked by where they stand."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, int]] = []  # open containers: element, fixed, mark, article
    opened: dict[str, int] = {}  # how many of each element are open
    parts: list[str] = []
    links: list[str] = []
    tag, breaks, in_link, articles, marks, place, at, end = "", 0, 0, 0, 0, 0, 0, len(page)
    fixed, mark, region = 0, 0, 0

    def close() -> None:
        nonlocal parts, links, place
        if parts:
            if text := " ".join(_decoded("".join(parts)).split()):
                place += 1
                out.append(Block(text, len(" ".join(_decoded(" ".join(links)).split())), tag, region, place, fixed, mark))
            parts, links = [], []

    def pop() -> str:
        nonlocal place, fixed, mark, region
        name = stack.pop()[0]
        opened[name] -= 1
        place += BORDER if name in BORDERED else 0
        fixed, mark, region = stack[-1][1:] if stack else (0, 0, 0)
        return name

    while at < end:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            if breaks > 1 and text.strip():
                close()
            if text.strip():
                breaks = 0
            parts.append(text)
            if in_link:
                links.append(text)
        if not m:
            break
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA["):
                parts.append(html.escape(m[0][9:-3], quote=False))
            continue
        name = name.lower()
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else end
            continue
        if name == "a":
            in_link = 0 if closing else 1
        if name == "br":
            breaks += 1
            parts.append(" ")
            continue
        if name in ("td", "th"):
            parts.append(" ")
        if name in BLOCK:
            close()
            breaks = 0
            tag = "" if closing else name
        if closing:
            if opened.get(name):
                close()
                while pop() != name:
                    pass
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        # a marked paragraph or item ends where the next begins, closed or not
        if name in BLOCK and stack and stack[-1][0] in ITEMS and (stack[-1][0] != "li" or name == "li"):
            pop()
        said = _attributes_say(attributes) if attributes and name not in ("html", "body") else NOTHING
        if said == NAMED and name in UNMARKED and name != "article":
            said = NOTHING
        here = 1 if name in ALWAYS_BAD and name != "form" or said == FIXED else 2 if name == "form" else 0
        marked = said == NAMED
        inner = region
        if name in ("article", "main") and not (fixed or here or mark or marked or region):
            articles += 1
            inner = articles
        elif name == "header":
            inner = -abs(region) if region else HEADER  # only its headings count
        if name in BLOCK and name not in ITEMS or here or marked:
            if here or marked or inner != region:
                close()
            if marked and not mark:
                marks += 1
            stack.append((name, max(fixed, here) if 1 not in (fixed, here) else 1, mark or (marks if marked else 0), inner))
            opened[name] = opened.get(name, 0) + 1
            place += BORDER if name in BORDERED else 0
            fixed, mark, region = stack[-1][1:]
    close()
    return out


def _dense(text: str, least: float) -> bool:
    found = NOT_LETTERS.sub(" ", text.lower()).split()
    return bool(found) and sum(w in STOP_WORDS for w in found) >= least * len(found)


def _voted(b: Block, articles: bool) -> int:
    """The votes of a block that isn't a heading."""
    n = len(b.text)
    side = 0 if not articles else 1 if b.region > 0 else -1
    if b.linked > LINKED * n:
        return side - (2 if b.tag in ("li", "dd", "dt") or n < MIDDLE or b.region <= 0 else 1)
    if n < 2 * MIDDLE and "©" in b.text and b.region <= 0:
        return -2
    if n >= LONG:
        return side + (2 if _dense(b.text, DENSE_LONG) else 0)
    return side + (1 if n >= MIDDLE and _dense(b.text, DENSE_MIDDLE) else 0)


def _is_bad(b: Block, marks: bool, forms: bool) -> bool:
    return b.fixed == 1 or (b.region < 0 and b.tag not in HEADINGS) or marks and b.mark > 0 or forms and b.fixed == 2


def _decided(found: list[Block], articles: bool) -> None:
    """First pass."""
    for b in found:
        b.votes = 0 if b.tag in HEADINGS and b.linked <= LINKED * len(b.text) else _voted(b, articles)
    # classes, then forms, are believed unless the only prose of the page is in them
    prose = [(len(b.text), b) for b in found if b.votes > 0 and len(b.text) >= LONG and b.tag not in HEADINGS]
    amount = [sum(n for n, b in prose if not _is_bad(b, *level)) for level in ((True, True), (False, True), (False, False))]
    level = (True, True) if amount[0] or max(amount) < PROSE else (False, True) if amount[1] >= PROSE else (False, False)
    for b in found:
        b.label = -1 if _is_bad(b, *level) else 1 if b.votes > 0 else -1 if b.votes <= -2 else 0
    if not any(b.label > 0 for b in found):
        least = LONG if any(b.label == 0 and len(b.text) >= LONG and b.tag not in HEADINGS for b in found) else 0
        for b in found:
            if b.label == 0 and (len(b.text) >= least and (b.tag not in HEADINGS or not least)):
                b.label = 1


def classify(found: list[Block]) -> list[Block]:
    """Give every block its label; returns ``found``."""
    articles = any(b.region > 0 and not b.fixed and not b.mark for b in found)
    _decided(found, articles)
    # second pass: per block the nearest decided one on either side, of its article or of what is outside of all
    last = (found[-1].at if found else 0) + 1
    sides = []
    for rows, edge in ((found, 0), (reversed(found), last)):
        near: dict[int, tuple[int, int]] = {}
        seen = []
        for b in rows:
            area = 0 if b.region == HEADER else abs(b.region)
            label, place = near.get(area, (0 if area else -1, edge))
            seen.append((label, abs(b.at - place)))
            if b.label and b.region >= 0:  # a header is beside the text, not part of it
                near[area] = (b.label, b.at)
        sides.append(seen)
    for b, (before, back), (after, ahead) in zip(found, sides[0], reversed(sides[1]), strict=True):
        if b.label:
            continue
        inside = articles and b.region > 0
        if b.tag in HEADINGS:
            inherited = after or (1 if b.region and b.region != HEADER else -1)
        elif inside:
            inherited = -1 if before < 0 and after < 0 else 1
        else:
            inherited = max(before, after) if back == ahead else before if back < ahead else after
        b.label = 2 * (inherited or 1)  # inherited labels are not passed on
    return found


def main_text(page: str | None) -> str:
    """The text of the good blocks, joined by line feeds."""
    return "\n".join(b.text for b in classify(blocks(page)) if b.label > 0) if page else ""


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), page: str = "html") -> DataFrame:
    """The columns ``keep`` and ``text``, one row per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, texts, chars, last = 0, [], 0, batch.num_rows - 1
            for at, value in enumerate(batch.column(batch.num_columns - 1)):
                texts.append(main_text(value.as_py()))
                chars += len(texts[-1])
                if chars >= OUT_CHARS or at == last:
                    columns = [batch.column(i).slice(start, len(texts)) for i in range(batch.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names)
                    start, texts, chars = at + 1, [], 0

    small_batches(pages.sparkSession)
    rows = pages.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(page).alias("page"))
    names = [*rows.columns[:-1], "text"]
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())])
    out = rows.mapInArrow(tk.released(run), schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "text")
