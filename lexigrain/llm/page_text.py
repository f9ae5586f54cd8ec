"""Main text of page markup by block rules in two passes.

A page is cut into blocks at its block-level tags. The first pass classifies each block by its
place (menus, page headers and footers, sidebars, notices, adverts, forms and reader comments
are never main text), its link density, its length and the density of stop words. Blocks that
are too short, or middling, stay undecided; the second pass gives them the label of the
nearest decided neighbour. Only the stop words of languages that the page is in count; in a page
of any other language, length and links decide alone. Lists, tables, code, headings and what
reads as a sentence are undecided at worst, whatever words they have. Inside an element that the page itself marks as its article, place
and links decide, and stop words are not asked for: a list of names there is still main text.

A name or a form alone does not put all that it holds beside the text: many pages stand in one
form, or in a wrapper that is named after the sidebar it has. Such a wrapper counts only if the
page has its text elsewhere (see ``_besides``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 70
LONG = 200
STOP_LOW = 0.20
STOP_HIGH = 0.30
MOST_LINKS = 0.33
#: Share of links from which a block of a marked article is none of its text, such as a list of tags.
ONLY_LINKS = 0.9

#: The commonest function words of the languages read here; a parameter of ``main_text``.
STOP_WORDS = {
    "en": "the of and to in a is that it for was on are as with be by at this from or an not but have he you which they his we",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son elle aux",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este",
}

RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|select|canvas|video|audio|title"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|=\s*[^\s\"'>][^\s>]*|[^>])*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("nav aside footer menu dialog button head".split())
FORMS = frozenset("form fieldset".split())
#: Tags that a later one of the same kind, or the end of what holds them, closes.
LOOSE = frozenset("p li dt dd td th tr option".split())
#: Tags of text that need not be sentences.
LAID_OUT = frozenset("pre li dt dd td th caption figcaption".split())
#: Words of a class, id or role that name something beside the text.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar rail footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter"
    " subscribe subscription signup login comment comments reply replies respond disqus discussion share sharing social related"
    " recommended recommendations pagination pager paging widget toolbar copyright disclaimer search complementary contentinfo"
    " hidden".split()
)
TALK = frozenset("comment comments reply replies respond disqus discussion".split())
#: Those that hardly ever name what holds a page's text, unless it is called its content as well.
STRICT = TALK | frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice"
    " alert popup modal overlay newsletter related recommended recommendations copyright disclaimer".split()
)
CONTENT = frozenset("content main page post article entry story".split())
#: Words before a name that say what a page has or lacks, such as ``with-sidebar``.
MODIFIERS = frozenset("no not non with without has have had is can show shows hide hides".split())
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[^\W\d_]+")
#: A block that begins with a copyright mark, after a word at most.
RIGHTS = re.compile(r"\W*(?:\w+\W+)?©")
SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")

GOOD, BAD, SHORT_BLOCK, MIDDLING = "good", "bad", "short", "middling"


class Block:
    """A run of text between block-level tags."""

    __slots__ = ("text", "linked", "beside", "article", "heading", "label", "wrapper", "laid_out")

    def __init__(self, text: str, linked: int, beside: bool, article: int, heading: bool, wrapper: int = 0, laid_out: bool = False):
        self.text, self.linked, self.beside, self.article, self.heading = text, linked, beside, article, heading
        self.label, self.wrapper, self.laid_out = "", wrapper, laid_out


class Wrapper:
    """An element that may be beside the text by its name or as a form; the page itself is the first."""

    __slots__ = ("parent", "strict", "talk", "marked")

    def __init__(self, parent: int, strict: bool, talk: bool):
        self.parent, self.strict, self.talk = parent, strict, talk
        self.marked: list[tuple[str, int]] = []  # tag and number of articles right in it


def _names(rest: str) -> tuple[set[str], set[str]]:
    """The words of the names of an element, without what it only has or lacks, and the names of one word."""
    found: set[str] = set()
    alone: set[str] = set()
    for _, value in ATTRIBUTE.findall(rest):
        for name in value.strip("\"'").split():
            words = NAME.findall(CAMEL.sub(" ", name).lower())
            if len(words) > 1 and (cut := next((i for i, w in enumerate(words) if w in MODIFIERS), None)) is not None:
                words = words[:cut]
            found.update(words)
            if len(words) == 1:
                alone.update(words)
    return found, alone


def _besides(found: list[Block], wrappers: list[Wrapper]) -> list[bool]:
    """Which wrappers are beside the text, by what they hold and what the page has outside them.

    What stands in other wrappers beside one says nothing about it. One does not count as beside

    - if it holds the page's ``main``, or its only articles with at least as much text as is outside;
      what is named as talk may hold one article only, since comments are often marked as articles
    - or, if not named as talk, if it holds a long block of running text while outside there is none
      and less than half as much text; of a strict name, while outside there is next to nothing.
    """
    n = len(wrappers)
    own, longest, running, marked = [0] * n, [0] * n, [False] * n, [0] * n
    shown: set[int] = set()
    for b in found:
        if b.beside:
            continue
        size, w = len(b.text), b.wrapper
        own[w] += size
        longest[w] = max(longest[w], size)
        running[w] |= size >= LONG and b.linked <= MOST_LINKS * size
        if b.article:
            marked[w] += size
            shown.add(b.article)
    articles = [len({a for _, a in w.marked} & shown) for w in wrappers]
    mains = [any(t == "main" and a in shown for t, a in w.marked) for w in wrappers]
    outside, far, others = [0] * n, [0] * n, [0] * n  # what is right in the wrappers around one
    for i in range(1, n):
        p = wrappers[i].parent
        outside[i], far[i], others[i] = outside[p] + own[p], max(far[p], longest[p]), others[p] + articles[p]
    for i in range(n - 1, 0, -1):  # from here on with all that they hold
        p = wrappers[i].parent
        own[p] += own[i]
        marked[p] += marked[i]
        articles[p] += articles[i]
        running[p] |= running[i]
        mains[p] |= mains[i]
    out = [False] * n
    for i in range(1, n):
        w = wrappers[i]
        holds = articles[i] and not others[i] and marked[i] >= outside[i] and (articles[i] == 1 or not w.talk)
        most = not w.talk and running[i] and (outside[i] < SHORT if w.strict else far[i] < LONG and 2 * outside[i] < own[i])
        out[i] = out[w.parent] or not (mains[i] or holds or most)
    return out


def blocks(markup: str) -> list[Block]:
    """The blocks of a page in order, with the place each of them has."""
    out: list[Block] = []
    text: list[str] = []
    linked = links = articles = 0
    # (tag, beside, article number, header inside an article, wrapper)
    stack: list[tuple[str, bool, int, bool, int]] = [("", False, 0, False, 0)]
    wrappers = [Wrapper(0, False, False)]
    heading = False

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                tag, beside, article, header, wrapper = stack[-1]
                away = beside or header and not heading
                out.append(Block(joined, min(linked, len(joined)), away, article, heading, wrapper, heading or tag in LAID_OUT))
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = html.unescape(raw)
            text.append(raw)
            if links:
                linked += len(" ".join(raw.split()))

    at = 0
    for m in TOKEN.finditer(markup):
        say(markup[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = 0 if m["end"] else 1
            continue
        if tag == "br":
            text.append(" ")
            continue
        named = tag not in BLOCK and not m["end"] and tag in ("span", "button", "label") and m["rest"]
        if tag not in BLOCK and tag != "button" and not named and not (m["end"] and tag == stack[-1][0]):
            continue
        if m["end"]:
            if tag in BLOCK or tag == stack[-1][0]:
                if tag in BLOCK:
                    flush()
                if any(s[0] == tag for s in stack[1:]):
                    while stack[-1][0] != tag:
                        stack.pop()
                    stack.pop()
            if tag in HEADINGS:
                heading = False
            continue
        _, beside, article, header, wrapper = stack[-1]
        names, alone = _names(m["rest"]) if m["rest"] else (set(), set())
        away = tag in OUTSIDE or "hidden" in names and tag not in ("html", "body", "article", "main", "header")
        away = away or bool(m["rest"] and HIDDEN.search(m["rest"]))
        within = False
        if tag in ("article", "main"):
            away = away or bool(names & TALK)
            if not away and not article:
                articles += 1
                article = articles
                wrappers[wrapper].marked.append((tag, article))
        elif tag == "header":
            header, away = header or bool(article), away or not article
        elif tag not in ("html", "body"):
            within = not away and tag not in VOID and (tag in FORMS or bool(names & BESIDE))
        if tag not in BLOCK:
            if away or within:
                flush()
                stack.append((tag, True, article, header, wrapper))
            elif tag == stack[-1][0]:
                stack.append(stack[-1])
            continue
        flush()
        if tag in LOOSE:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    _, beside, article, header, wrapper = stack[-1]
                    break
                if stack[i][0] not in LOOSE:
                    break
        if tag in HEADINGS:
            heading = True
        elif tag not in VOID and tag != "header":
            heading = False
        links = 0
        if within:
            wrappers.append(Wrapper(wrapper, bool(names & STRICT) and not alone & CONTENT, bool(names & TALK)))
            wrapper = len(wrappers) - 1
        if tag not in VOID:
            stack.append((tag, beside or away, article, header, wrapper))
    say(markup[at:])
    flush()
    besides = _besides(out, wrappers)
    for b in out:
        b.beside = b.beside or besides[b.wrapper]
    return out


def _densities(found: list[Block], stop_words: Mapping[str, str]) -> list[float] | None:
    """Each block's density of stop words, in the best of the languages that the page's longer blocks are in; None without any.

    Blocks that are decided without it, in an article or beside the text, are not counted.
    """
    words = [[] if b.beside or b.article else WORD.findall(b.text.lower()) for b in found]
    running = [len(b.text) >= SHORT and b.linked <= MOST_LINKS * len(b.text) for b in found]
    total = sum(len(ws) for ws, r in zip(words, running, strict=True) if r)
    best = None
    for listed in stop_words.values():
        listed = frozenset(listed.split())
        held = [sum(w in listed for w in ws) for ws in words]
        if total and sum(h for h, r in zip(held, running, strict=True) if r) >= STOP_HIGH * total:
            own = [h / len(ws) if ws else 0.0 for h, ws in zip(held, words, strict=True)]
            best = own if best is None else [*map(max, best, own)]
    return best


def classify(found: list[Block], stop_words: Mapping[str, str] = STOP_WORDS) -> list[Block]:
    """Label every block ``good`` or ``bad``, in two passes."""
    marked, loose = (sum(len(b.text) for b in found if bool(b.article) == a and not b.beside) for a in (True, False))
    for b in found:  # a page whose marked article holds most of its text has nothing of it elsewhere
        b.beside = b.beside or marked >= loose and not b.article and marked > 0
    density = _densities(found, stop_words)
    for b, d in zip(found, density or [1.0] * len(found), strict=True):
        size = len(b.text)
        if b.article and b.linked > ONLY_LINKS * size and not b.heading:
            b.beside = True
        if b.beside or b.linked > MOST_LINKS * size and not b.article:
            b.label = BAD
        elif b.article:
            b.label = GOOD if size >= SHORT else SHORT_BLOCK
        elif "©" in b.text and (size < SHORT or RIGHTS.match(b.text)):
            b.label = BAD
        elif size < SHORT:
            b.label = BAD if b.linked else SHORT_BLOCK
        elif d >= STOP_HIGH:
            b.label = GOOD if size >= LONG or density is None else MIDDLING
        else:
            b.label = MIDDLING if d >= STOP_LOW or b.laid_out or SENTENCE.search(b.text) else BAD
    for undecided in (MIDDLING, SHORT_BLOCK):
        for i, (left, right) in enumerate(zip(_nearest(found), reversed(_nearest(found[::-1])), strict=True)):
            b = found[i]
            if b.label == undecided:
                b.label = _inherited(b, left, right)
    return found


def _nearest(found: list[Block]) -> list[tuple[int, str]]:
    """For each block the distance and label of the nearest decided block before it in the same article or outside any.

    Blocks decided by their place alone say nothing about the text around them.
    """
    out: list[tuple[int, str]] = []
    last: dict[int, tuple[int, str]] = {}
    for i, b in enumerate(found):
        at, label = last.get(b.article, (i, ""))
        out.append((i - at, label))
        if b.label in (GOOD, BAD) and not b.beside:
            last[b.article] = (i, b.label)
    return out


def _inherited(block: Block, left: tuple[int, str], right: tuple[int, str]) -> str:
    """The label of the nearest decided neighbour; with two at one distance, or none at all, nothing is dropped."""
    if block.heading and right[1] == GOOD:
        return GOOD
    near = sorted(x for x in (left, right) if x[1])
    return GOOD if not near or GOOD in (x[1] for x in near if x[0] == near[0][0]) else BAD


def page_text(markup: str | None, stop_words: Mapping[str, str] = STOP_WORDS) -> str:
    """The main blocks of a page, one per line."""
    return "\n".join(b.text for b in classify(blocks(markup or ""), stop_words) if b.label == GOOD)


def main_text(pages: DataFrame, key: str = "key", markup: str = "markup", stop_words: Mapping[str, str] = STOP_WORDS) -> DataFrame:
    """``key, text``: the main text of every page of a markup corpus.

    ``pages``       rows with a key and their whole markup; other columns are ignored
    ``stop_words``  the commonest function words, in lower case, of some languages; pages in others need none

    White space inside a block becomes one space, character references are decoded, blocks are
    joined by line ends in page order. NULL or empty markup gives an empty text; broken markup
    is read as far as it goes. Very long pages are read whole, one at a time. Rows are worked on one by one, so repeated rows, NULL keys and
    empty tables need no rule of their own. There is no shuffle.
    """
    picked = pages.select(F.col(key).alias("key"), F.col(markup).alias("markup"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = pa.array((page_text(m.as_py(), stop_words) for m in part.column("markup")), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("key"), texts], ["key", "text"])

    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(extract, f"key {kind}, text string")
