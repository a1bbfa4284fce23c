"""HTML extraction by line-block distribution (operator 8).

Markup is stripped to lines: one line for each block of text.  A line's
length is its text outside links.  Lines inside elements that never hold the
article by element, role, or by being hidden (menus, headers, footers,
sidebars, forms) are no lines.

A class or id only raises a suspicion.  An element so named goes when the
text agrees: it is mostly links, or holds less than half of the text of the
article (of the page, when no article is marked), or of one or two lines
less than nine tenths, or lies outside a marked article.  An element that holds, or
is, a marked article or its heading never goes by its name, nor does a
paragraph, heading, list item, quote or cell inside a marked article, unless
the name says more than one word (``cookie-notice``).  Reader comments are
no part of an article however long they are: a name that says comments goes
without evidence.

Lengths are summed over sliding windows of ``WINDOW`` lines.  Text surges
at a line that begins a window of at least ``SURGE`` characters (or, on a
page with little text, half of its densest window), and dives where a window
has none left; all lines between are the main text, those of links alone too.

Where a page marks its article (``article``, ``main``, ``role=main``,
``itemprop=articleBody``), the mark is a weight: lines inside count at least
``SURGE``, lines outside count nothing, so that windows surge where the mark
begins and dive where it ends.  A mark has no weight when a run of lines
outside has more text than all lines inside, as on a page with teasers in
``article``.

Every tag costs the same on average, however many elements are open: open
elements are kept by name, and what encloses a word is a linked list.

Defined results: null, empty or text-free html gives an empty text; html
cut off anywhere is read to its end, unclosed elements end with their
parent; rows that repeat are extracted alike; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

WINDOW = 3
SURGE = 80
SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

# Comments, declarations, raw-text elements with their content, and tags.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|object|canvas|select|button)\b[^>]*"
    r"(?:/>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*+)/?>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][\w:-]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S | re.I)
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT = frozenset("nav footer aside form menu dialog head header".split())
OUT_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
# Whole class tokens or ids, with a few compounds; "content-sidebar-wrap" is none of them.
OUT_WORD = re.compile(
    r"(?:^|\s)(?:ads?|advert\w*|banners?|promo\w*|sponsor\w*|menu|nav|navbar|navigation|breadcrumbs?|sidebar|side|footer|header"
    r"|masthead|comments?|disqus|replies|reply|notice|notices|cookies?|consent|gdpr|newsletter|subscribe|signup|popup|modal"
    r"|overlay|share|sharing|social|related|recommended|widget|pagination|pager|login|toolbar|alert"
    r"|(?:site|page|main|global)[_-](?:header|footer|nav|navigation|menu|sidebar)|(?:top|left|right|side)[_-](?:nav|menu|bar|sidebar)"
    r"|nav[_-](?:bar|menu|links)|(?:left|right|primary|secondary)[_-]?sidebar|sidebar[_-](?:left|right|primary|secondary)"
    r"|(?:cookie|gdpr|consent)[_-](?:banner|notice|bar|consent|popup)|ad[_-](?:banner|box|container|slot|unit|wrapper)"
    r"|(?:banner|google)[_-]ads?|(?:social|share|sharing)[_-](?:links|share|buttons|icons|bar)|related[_-](?:posts|articles|links|stories)"
    r"|comments?[_-](?:list|area|section|form|body|wrapper)|newsletter[_-](?:signup|form|box)|skip[_-]link)(?=\s|$)", re.I)
COMMENT = re.compile(r"(?:^|\s)(?:comments?|comment[_-](?:body|content)|(?:div-)?comment-\d+)(?=\s|$)", re.I)
# Reader comments by any of these parts of a class or id, unless the element only says whether there are any.
COMMENTS = re.compile(r"(?:^|\s)(?!(?:no|has|with)[_-])(?:[\w-]*[_-])?(?:comments?(?:list)?|disqus|replies|respond)(?:[_-](?:list|thread|area|section"
                      r"|form|body|wrapper|container|content|box|embed))?(?=\s|$)", re.I)
COMPOUND = re.compile(r"[_-]")
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT = frozenset("p li dd dt blockquote pre td th figcaption".split()) | HEADING      # of an article, whatever their names
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
ATTR = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
# What a start tag ends if it is still open.
ENDED_BY = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
            "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}


def _kind(name: str, attrs: str, in_article: bool) -> str:
    """'out', 'main', 'comments', 'named' (suspected by its class or id) or
    '' for an element."""
    got = {}
    if attrs and ("=" in attrs or "hidden" in attrs):
        got = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTR.finditer(attrs)}
    role = got.get("role", "").lower()
    # A header inside the article holds its heading; a page's holds its name.
    if name in OUT and not (name == "header" and in_article) or role in OUT_ROLE:
        return "out"
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true" or HIDDEN.search(got.get("style", "")):
        return "out"
    names = f"{got.get('class', '')} {got.get('id', '')}"
    if name in ("article", "main") or role == "main" or got.get("itemprop", "").lower() == "articlebody":
        return "out" if COMMENT.search(names) else "main"
    if name in ("body", "html"):
        return ""
    if COMMENTS.search(names) and not (in_article and name in TEXT):
        return "comments"
    said = OUT_WORD.search(names)
    return "named" if said and not (in_article and name in TEXT and not COMPOUND.search(said[0])) else ""


class _Named:
    """An element that may go, in the list of those around it."""
    __slots__ = ("up", "comments", "inside", "keep", "text", "link", "blocks", "gone")

    def __init__(self, up: _Named | None, comments: bool, inside: bool) -> None:
        self.up, self.comments, self.inside = up, comments, inside
        self.keep, self.text, self.link, self.blocks, self.gone = False, 0, 0, 0, False


def _keep(at: _Named | None) -> None:
    """These elements don't go by name, nor do those around them."""
    while at is not None and not at.keep:
        at.keep = True
        at = at.up


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, length outside links, inside a marked article) of each block
    of text that may belong to the article.  An element that is suspected
    stays when it holds, or is, a marked article or its heading: the first
    h1 of the article or, without a marked one, of the page; else the heading
    with which the article begins."""
    held, words = [], []                                # words: (text, in a link, the innermost suspect around it)
    stack: list[tuple] = []                             # (name, kind, the innermost suspect outside it)
    where: dict[str, list[int]] = {}                    # places in the stack, by name
    blocks: list[int] = []                              # places of blocks in the stack
    headings: list[str] = []                            # open headings
    suspects: list[_Named] = []
    named: _Named | None = None
    first: dict[bool, _Named | None] = {}               # around the first h1, inside an article or not
    opening: list = []                                  # around the heading with which the article begins
    out = article = links = 0

    def flush() -> None:
        about = next((w for w in words if w[0].strip()), None)
        if about is not None:
            tag = headings[-1] if headings else ""
            if tag == "h1":
                first.setdefault(article > 0, about[2])
            if article and not opening:
                opening.append(about[2] if tag else None)
            held.append((words.copy(), article > 0))
        words.clear()

    def leave(k: int) -> None:
        nonlocal out, article, links, named
        while len(stack) > k:
            name, kind, named = stack.pop()
            where[name].pop()
            if name in BLOCKS:
                blocks.pop()
            if name in HEADING:
                headings.pop()
            out -= kind == "out"
            article -= kind == "main"
            links -= name == "a"

    def say(text: str) -> None:
        if text and not out:
            words.append((text, links > 0, named))

    at = 0
    for m in TOKEN.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            say(" ")
        if m["close"] or m["close2"]:
            if where.get(name):
                leave(where[name][-1])
            continue
        if name in VOID:
            continue
        while blocks and name in ENDED_BY.get(stack[blocks[-1]][0], ()):
            leave(blocks[-1])
        kind = _kind(name, m["attrs"] or m["attrs2"] or "", article > 0)
        if kind == "main" and not out:
            _keep(named)
        where.setdefault(name, []).append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        if name in HEADING:
            headings.append(name)
        stack.append((name, kind, named))
        if kind in ("named", "comments"):
            named = _Named(named, kind == "comments", article > 0)
            suspects.append(named)
        out += kind == "out"
        article += kind == "main"
        links += name == "a"
    say(page[at:])
    flush()
    _keep(first.get(any(a for _, a in held), opening[0] if opening else None))
    _judge(held, suspects)
    lines = []
    for ws, inside in held:
        ws = [w for w in ws if w[2] is None or not w[2].gone]
        text = " ".join(_html.unescape("".join(w[0] for w in ws)).split())
        if text:
            link = sum(len("".join(_html.unescape(w[0]).split())) for w in ws if w[1])
            lines.append((text, max(0, len(text) - text.count(" ") - link), inside))
    return lines


def _judge(held: list, suspects: list[_Named]) -> None:
    """Decide from the text which suspects go; what is inside goes along."""
    whole = {True: 0, False: 0}                          # text of the article, of the page
    for ws, inside in held:
        for text, link, at in ws:
            n = len(text) - text.count(" ")
            whole[False] += n
            whole[True] += n if inside else 0
            if at is not None:
                at.text += n
                at.link += n if link else 0
        if ws[-1][2] is not None:
            ws[-1][2].blocks += 1
    for e in reversed(suspects):                         # inner ones come later
        if e.up is not None:
            e.up.text += e.text
            e.up.link += e.link
            e.up.blocks += e.blocks
    for e in suspects:
        agrees = (e.comments or 2 * e.link > e.text or 2 * e.text < whole[e.inside] or e.blocks < WINDOW and 10 * e.text < 9 * whole[e.inside]
                  or whole[True] > 0 and not e.inside)
        e.gone = not e.keep and agrees or e.up is not None and e.up.gone


def runs(lengths: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """(start, end) of each surge and its dive; a page that is thin
    throughout surges at half its densest window."""
    sums = [sum(lengths[i:i + window]) for i in range(len(lengths))]
    least = max(1, min(surge, max(sums, default=0) // 2))
    out, i = [], 0
    while i < len(lengths):
        if sums[i] >= least and lengths[i]:
            end = i
            while end < len(lengths) and sums[end]:
                end += 1
            out.append((i, end))
            i = end
        else:
            i += 1
    return out


def main_lines(lines: list[tuple[str, int, bool]], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between each surge and its dive, in windows of lengths that
    a trusted mark weighs."""
    lengths = [n for _, n, _ in lines]
    outside = [[n for _, n, _ in part] for marked, part in groupby(lines, key=lambda x: x[2]) if not marked]
    rest = max((sum(part[a:z]) for part in outside for a, z in runs(part, window, surge)), default=0)
    marked = sum(len(t) for t, _, a in lines if a)
    if marked and marked >= rest:
        lengths = [max(n, surge) if a else 0 for _, n, a in lines]
    elif not any(lengths):                  # links alone: those of about a paragraph's length
        least = min(surge, max((len(t) for t, *_ in lines), default=0) // 2)
        return [t for t, *_ in lines if len(t) >= least and t.count(" ") >= 4]
    else:
        marked = 0
    return [t for a, z in runs(lengths, window, surge) for t, _, inside in lines[a:z] if inside or not marked]


def main_text(page: str | None) -> str:
    return "\n\n".join(main_lines(lines_of(page))) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`"))

    def run(b: pa.RecordBatch):
        texts = [main_text(h) for h in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"])
    return map_batches(rows, run, SCHEMA)
