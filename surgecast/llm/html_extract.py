"""Main text of web pages by two-pass block rules.

Pass one classifies each block by its place in the page (menus, forms and the
like are never text), link density, length and density of stop words. Pass two
gives an ambiguous short block the label of its nearest decided neighbours. In
an article or main element the same rules hold: there a long block of few stop
words is undecided, only blocks in articles are neighbours, and a block whose
neighbours say nothing or disagree is text.

A container whose class or id has a word of a list (BAD_NAMES) is only suspected:
if it holds most of the page's text that pass one would call good, it is the
article's own and stays. The density rules know the stop words of English,
German, French and Spanish; in other languages length and links decide.

A page is read in one pass that never goes back, whatever its quotes and tags.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from surgecast.session import ship_package

MAX_LINK_DENSITY = 0.4
LENGTH_LOW, LENGTH_HIGH = 70, 200
STOPWORDS_LOW, STOPWORDS_HIGH = 0.15, 0.25

# Elements of HTML.
RAW = "script style noscript template textarea iframe svg math object select title head"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li legend main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul br".split()
)
BAD_TAGS = set("nav footer aside form menu button dialog search fieldset".split())
BAD_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status".split())
BAD_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments disqus respond replies share sharing social related recommended recommendations widget toolbar "
    "pagination pager copyright skip legal disclaimer paywall".split()
)
GOOD_TAGS = {"article", "main"}
#: An element of these ends where the next one begins.
SELF_ENDING = set("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
STOPWORDS = set(
    # en
    "the of and to in a is that was for it with as his on be at by i this had not are but from or have an they which one you were her all she "
    "there would their we him been has when who will more no if out so said what up its about into than them can only other new some "
    # de
    "der die das und ist von zu den mit sich des auf für im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um "
    "am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde "
    # fr
    "le la les de des et en un une du que est pour dans qui par sur pas plus au ne se ce il elle sont avec son sa ses aux ou comme mais nous vous "
    "leur été cette ces on je lui tout deux "
    # es
    "el los las y en del que por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos "
    "también fue había era muy hasta desde".split()
)

RAW_TAGS = set(RAW.split())
START = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW_TAGS} | {"head": re.compile(r"</head(?=[\s/>])[^>]*>|(?=<body[\s>])", re.I)}
STOP = re.compile(r"[>\"']")
ATTR = re.compile(r"([^\s\"'<>/=][^\s=>/]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAME = re.compile(r"[a-z]+", re.I)
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """Text of a block, its characters inside links, and where it stands."""

    text: str
    in_links: int
    place: str  # "bad", "good" (inside article or main) or "open"
    heading: bool
    boxes: tuple[int, ...] = ()  # suspected containers around it
    label: str = field(default="", compare=False)


def _suspect(tag: str, attr: str, in_good: bool) -> str:
    """"bad" for an element that is never text, "name" for one only its class or id speaks against, or ""."""
    if tag in BAD_TAGS or (tag == "header" and not in_good):
        return "bad"
    if not attr or tag in ("body", "html", "article", "main"):
        return ""
    found = ""
    for name, value in ATTR.findall(attr):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "bad"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "bad"
        if name == "role" and value in BAD_ROLES:
            return "bad"
        if name in ("class", "id") and not BAD_NAMES.isdisjoint(NAME.findall(value)):
            found = "name"
    return found


def _tag_end(page: str, at: int, lost: set[str]) -> int:
    """The place of the ``>`` that ends the tag whose attributes begin at ``at``; -1 if none.

    Only a quote behind ``=`` opens a value; one that is never closed (noted in
    ``lost``, so that it is looked for once) is an ordinary character."""
    while True:
        m = STOP.search(page, at)
        if m is None:
            return -1
        if m[0] == ">":
            return m.start()
        at = m.end()
        if m[0] not in lost and page[max(0, m.start() - 8) : m.start()].rstrip().endswith("="):
            close = page.find(m[0], at)
            if close < 0:
                lost.add(m[0])
            else:
                at = close + 1


def tags(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before it, tag, whether it closes, attributes) of every tag in order,
    at last the rest of the text. Comments, declarations and raw elements are passed over."""
    at, lost = 0, set()
    text: list[str] = []
    size = len(page)
    while at < size:
        i = page.find("<", at)
        if i < 0:
            break
        text.append(page[at:i])
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), i):
            end = page.find(">", i)
            at = size if end < 0 else end + 1
            continue
        m = START.match(page, i)
        if m is None:
            text.append("<")
            at = i + 1
            continue
        end = _tag_end(page, m.end(), lost)
        if end < 0:  # the page breaks off inside a tag
            at = size
            break
        tag, attr, closes = m[1].lower(), page[m.end() : end], page[i + 1] == "/"
        at = end + 1
        if tag in RAW_TAGS and not closes:
            if not attr.endswith("/"):
                stop = RAW_END[tag].search(page, at)
                at = stop.end() if stop else size
            text.append(" " if tag == "head" else "")
            continue
        yield "".join(text), tag, closes, attr
        text = []
    yield "".join([*text, page[at:]]), "", False, ""


@dataclass
class _Box:
    """An open container that isn't, or may not be, part of the text."""

    tag: str
    depth: int
    number: int  # 0: never text


def blocks(page: str) -> list[Block]:
    """Blocks of a page with text, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    boxes: list[_Box] = []
    link = ""  # the block in which the open link began
    link_depth = depth = good = count = 0
    heading, inside = False, "body"

    def end() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            in_links = len(" ".join(entities.unescape("".join(linked)).split()))
            never = any(not b.number for b in boxes)
            out.append(Block(text, min(in_links, len(text)), "bad" if never else "good" if good else "open", heading, tuple(b.number for b in boxes)))
        parts.clear()
        linked.clear()

    def close(tag: str) -> None:
        """An end tag: the innermost box of this tag gets less deep, or ends with those in it."""
        for k in range(len(boxes) - 1, -1, -1):
            if boxes[k].tag == tag:
                boxes[k].depth -= 1
                if not boxes[k].depth:
                    del boxes[k:]
                return

    for text, tag, closes, attr in tags(page):
        if text:
            parts.append(text)
            if link:
                linked.append(text)
        if not tag:
            break
        if tag == "a":
            link, link_depth = ("" if closes else inside), depth
            continue
        block = tag in BLOCKS or tag in BAD_TAGS
        opens = not closes and tag not in VOID and not (attr.endswith("/") and not block)
        kind = _suspect(tag, attr, bool(good)) if opens else ""
        if not block:
            if kind:
                end()
                count += kind == "name"
                boxes.append(_Box(tag, 1, count if kind == "name" else 0))
            elif opens and boxes and boxes[-1].tag == tag:
                boxes[-1].depth += 1
            elif closes and any(b.tag == tag for b in boxes):
                end()
                close(tag)
            continue
        end()
        if tag not in VOID:
            depth += -1 if closes else 1
            if link and (depth < link_depth or (not closes and tag == link and tag in SELF_ENDING)):  # the link's own block is over
                link = ""
            inside = tag
        if closes:
            if tag in ("body", "html"):
                boxes.clear()
            elif any(b.tag == tag for b in boxes):
                close(tag)
            if tag in GOOD_TAGS and not any(not b.number for b in boxes):
                good = max(0, good - 1)
        elif tag not in VOID:
            if tag in GOOD_TAGS:  # an unclosed menu ends where the article begins
                boxes = [b for b in boxes if b.tag == "aside" or b.number]
            if kind:
                count += kind == "name"
                boxes.append(_Box(tag, 1, count if kind == "name" else 0))
            elif boxes and boxes[-1].tag == tag:
                boxes[-1].depth += 1
            if tag in GOOD_TAGS and not any(not b.number for b in boxes):
                good += 1
        heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6") and not closes
    end()
    return out


def _first_label(b: Block) -> str:
    """Pass one: "good", "bad", "neargood" or "short"."""
    if b.place == "bad" or b.in_links / len(b.text) > MAX_LINK_DENSITY:
        return "bad"
    if b.text[0] == "©" or b.text.lower().startswith("copyright"):
        return "bad"
    size = len(b.text)
    if size < LENGTH_LOW:
        return "short"
    words = WORD.findall(b.text.lower())
    density = sum(w in STOPWORDS for w in words) / max(1, len(words))
    if density >= STOPWORDS_HIGH:
        return "good" if size > LENGTH_HIGH else "neargood"
    if density >= STOPWORDS_LOW:
        return "neargood"
    return "bad" if b.place == "open" else "neargood"


def _clear_boxes(found: list[Block]) -> None:
    """Blocks of suspected containers are bad, but where the container holds most of
    the page's good text."""
    good = [len(b.text) if b.place != "bad" and _first_label(b) == "good" else 0 for b in found]
    held: dict[int, int] = {}
    for b, n in zip(found, good):
        for box in b.boxes:
            held[box] = held.get(box, 0) + n
    total = sum(good)
    for b in found:
        if any(box and 2 * held[box] <= total for box in b.boxes):
            b.place = "bad"


def classify(found: list[Block]) -> None:
    """Label each block "good" or "bad"."""
    if any(b.boxes for b in found):
        _clear_boxes(found)
    for b in found:  # pass one
        b.label = _first_label(b)
    # pass two
    sure = [b.label if b.label in ("good", "bad") else "" for b in found]
    all_before, all_after = _nearest(found, sure)
    for i, b in enumerate(found):
        if b.label in ("good", "bad"):
            continue
        before, after = all_before[i], all_after[i]
        near = [x for x in (before, after) if x]
        prior = "good" if b.place == "good" else "bad"  # where the neighbours say nothing or disagree
        if b.label == "neargood":
            b.label = "good" if not near or any(x == "good" for _, x in near) else "bad"
        elif b.heading:
            b.label = after[1] if after else prior
        else:
            best = min(near, key=lambda x: x[0])[0] if near else 0
            labels = {x for d, x in near if d == best}
            b.label = labels.pop() if len(labels) == 1 else prior


def _nearest(found: list[Block], sure: list[str]) -> list[list[tuple[int, str] | None]]:
    """Distance and label of the last and of the next decided block of each block, at any distance.

    Blocks in an article only see blocks in an article.
    """
    out = []
    for step in (1, -1):
        last: dict[bool, int] = {}  # the last decided block: of all, of those in an article
        near: list[tuple[int, str] | None] = []
        for i in range(len(found))[::step]:
            j = last.get(found[i].place == "good")
            near.append(None if j is None else (abs(j - i), sure[j]))
            if sure[i]:
                last[False] = i
                if found[i].place == "good":
                    last[True] = i
        out.append(near[::step])
    return out


def main_text(page: str | None) -> str:
    """Main text of a page (null: empty)."""
    if not page:
        return ""
    found = blocks(page)
    classify(found)
    return " ".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add column ``text`` with the main text of every row of ``pages``.

    Null and empty pages, and pages without main text, give an empty text.
    Pages are taken whole, also where they break off inside a tag; repeated
    rows stay; other columns pass through, a column named ``text`` is replaced;
    an empty table stays empty.
    """
    ship_package(pages.sparkSession)
    out = pages.drop(text).schema.add(text, "string") if text != html else pages.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = pa.array([main_text(x) for x in b.column(b.schema.names.index(html)).to_pylist()], pa.string())
            cols = {**dict(zip(b.schema.names, b.columns)), text: got}
            yield pa.RecordBatch.from_arrays([cols[n] for n in out.names], names=out.names)

    return pages.mapInArrow(run, out)
