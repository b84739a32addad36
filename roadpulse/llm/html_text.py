"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass classifies each block by its length, its
share of stop words and its share of linked characters; the second gives undecided short blocks the
class of their nearest decided neighbours. Menus, footers, side bars, forms and the like that say so by
tag, role or class are left out before. Inside `article` and `main` a block is bad only by its links;
what stays undecided there is kept.

A null, empty or broken page gives the text that is found, or "". Of an element without an end only the tag goes,
but for scripts, styles, titles and text areas, which take the rest of the page. The time grows with the
length of the page, whatever is in it. Rows are judged one by one, so
repeated rows change nothing. Extra columns stay.
"""

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import slices
from roadpulse.session import ship_package

# Thresholds of the block rules: characters, share of stop words, share of characters in links.
SHORT, LONG = 70, 200
FEW_STOP_WORDS, MANY_STOP_WORDS = 0.2, 0.3
MOST_LINKS = 0.3

STOP_WORDS = frozenset(
    # English, German, French, Spanish
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which you were her all she there would their we him been has when who will no more if out so"
    " der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis"
    " le les et une est que dans qui par pour au du sur pas plus se ne ce sont avec il sa mais comme ou son nous vous elle aux ces"
    " el los las una por con para su lo del al como más pero sus este ya entre cuando muy sin sobre también me hasta hay donde".split())

#: Their content is not text of the page.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video title textarea select button map".split())
#: Regions that are never part of the article.
REGIONS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTAINERS = REGIONS | frozenset("div section header article main ul ol dl table td details figure blockquote center".split())
BLOCKS = CONTAINERS | frozenset("html head body p li dt dd tr th tbody thead tfoot caption h1 h2 h3 h4 h5 h6 pre hr address figcaption summary legend option hgroup".split())
#: Parts of class, id and role that mark boilerplate.
HINTS = frozenset("""ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored nav navbar navigation menu
    breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter
    subscribe subscription signup login comment comments reply replies disqus respond share sharing social related recommended widget toolbar pagination pager
    copyright disclaimer contentinfo complementary search form""".split())
IN_ARTICLE = HINTS - {"header", "banner"}
OF_ARTICLE = frozenset("comment comments reply replies ad advert sponsored promo related".split())

#: Of these the rest of the page is content if they are not closed.
_RAW = frozenset("script style title textarea".split())
_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_ENDS = {"<!--": "-->", "<![CDATA[": "]]>"}
#: What stands in a tag behind its name. Nothing is tried twice.
_REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NOT_A_MARK = re.compile(r"\b(?:has|no|with|without)[-_]\w+")
_WORDS = re.compile(r"[^\W\d_]+")


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    heading: bool
    article: int  # which article it is in; 0: none


def _marks(attributes: str) -> set[str]:
    found = " ".join(_MARK.findall(attributes)).lower()
    return set(re.split(r"[^a-z]+", _NOT_A_MARK.sub(" ", found))) if found else set()


def _tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, slash, name and attributes of each tag; for comments and declarations the name is "".

    Each part of the page is read a fixed number of times: after the first tag whose quotes do not end, a
    tag ends at the next ">".
    """
    at, quoted = 0, True
    while found := _OPEN.search(page, at):
        slash, tag = found.groups()
        if tag is None:
            mark = _ENDS.get(found.group(), ">")
            end = page.find(mark, found.end())
            at = end + len(mark) if end >= 0 else len(page)
            yield found.start(), at, "", "", ""
            continue
        rest = _REST.match(page, found.end()) if quoted else None
        if rest is None:
            quoted = False
            end = page.find(">", found.end())
            if end < 0:  # no tag is closed from here on
                return
            attributes, at = page[found.end() : end], end + 1
        else:
            attributes, at = rest.group(1), rest.end()
        skipped = yield found.start(), at, slash, tag.lower(), attributes
        if skipped is not None:
            at = skipped
            yield 0, 0, "", "", ""  # the answer to send()


def _blocks(page: str) -> list[Block]:
    blocks, parts, linked = [], [], 0
    stack: list[tuple[str, bool, int]] = []  # tag, left out, article
    out, article, articles, links, heading, breaks = False, 0, 0, 0, False, 0

    def close():
        nonlocal parts, linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            blocks.append(Block(text, min(linked, len(text)), heading, article))
        parts, linked = [], 0

    at, tags, endless = 0, _tags(page), set()

    def add(text):
        nonlocal linked, breaks
        if text and not out:
            parts.append(text)
            if links:
                linked += len(" ".join(entities.unescape(text).split()))
            if not text.isspace():
                breaks = 0

    for start, stop, slash, tag, attributes in tags:
        add(page[at:start])
        at = stop
        if not tag:
            continue
        if tag in SKIPPED:
            if not slash and not attributes.endswith("/") and tag not in endless:
                finish = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if finish or tag in _RAW:
                    at = finish.end() if finish else len(page)
                    tags.send(at)
                else:  # only the tag itself goes
                    endless.add(tag)
            parts.append(" ")
        elif tag == "a":
            links = 0 if slash else 1
        elif tag == "br":
            parts.append(" ")
            breaks += 1
            if breaks == 2:
                close()
        elif tag in BLOCKS:
            close()
            links, breaks = 0, 0
            heading = not slash and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            if tag not in CONTAINERS or attributes.endswith("/"):
                continue
            if slash:
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
                if depth is not None:
                    _, out, article = stack[depth]
                    del stack[depth:]
                continue
            stack.append((tag, out, article))
            marks = _marks(attributes)
            if tag in ("article", "main"):
                if marks & OF_ARTICLE:
                    out = True
                elif not any(t in REGIONS and t != "form" for t, *_ in stack) and not (out and article):
                    out = False  # what holds an article is not boilerplate
                    articles += not article
                    article = article or articles
            elif tag in REGIONS or tag == "header" and not article or marks & (IN_ARTICLE if article else HINTS):
                out = True
    add(page[at:])
    close()
    return blocks


def _first_pass(block: Block) -> str:
    """good, bad, or for the second pass: near (good if a neighbour is) or short."""
    length, words = len(block.text), _WORDS.findall(block.text.lower())
    stop_words = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if block.linked > MOST_LINKS * length:
        return "bad"
    if "\xa9" in block.text[:40] and not block.article:
        return "bad"
    if length < SHORT:
        return "short" if block.linked == 0 or block.article else "bad"
    if stop_words >= MANY_STOP_WORDS:
        return "good" if length > LONG or block.article else "near"
    if stop_words >= FEW_STOP_WORDS:
        return "good" if block.article else "near"
    return "short" if block.article else "bad"


def _second_pass(blocks: list[Block], classes: list[str]) -> list[bool]:
    """Whether each block is kept: near ones by their decided neighbours, then short ones by theirs."""
    n, classes = len(blocks), list(classes)

    def decided(order):
        out, last, where = [None] * n, None, None
        for k in order:
            if blocks[k].article != where:  # an article ends at its edges
                last, where = None, blocks[k].article
            out[k] = last
            if classes[k] in ("good", "bad"):
                last = classes[k]
        return out

    for kind in ("near", "short"):
        before, after = decided(range(n)), decided(range(n - 1, -1, -1))
        for k, block in enumerate(blocks):
            sides = {before[k], after[k]}
            if classes[k] != kind:
                continue
            if block.article:
                keep = sides != {"bad"}
            elif kind == "near":
                keep = "good" in sides or sides == {None}
            else:
                keep = sides == {"good"} or block.heading and after[k] == "good" or "good" in sides and "bad" not in sides
            classes[k] = "good" if keep else "bad"  # the neighbours were taken before
    return [c == "good" for c in classes]


def main_text(page: str | None) -> str:
    """The kept blocks of a page, one to a line."""
    blocks = _blocks(page or "")
    if any(b.article for b in blocks):  # what stands beside an article is not part of it
        blocks = [b for b in blocks if b.article]
    kept = _second_pass(blocks, [_first_pass(b) for b in blocks])
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """All rows and columns but the page itself, with its main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            texts = [main_text(page) for page in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], pa.array(texts, pa.string())],
                                             names=[*passed, text])

    ship_package(pages.sparkSession)
    passed = [c for c in pages.columns if c != html and c.lower() != text]
    return pages.mapInArrow(run, pages.select(*[pages[c] for c in passed]).schema.add(text, "string"))


def op10_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
