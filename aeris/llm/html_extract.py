"""Main text of web pages as a maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score positive and tags negative; the weights are log-odds of
standing inside or outside the article, counted on the pages that label theirs (an ``article`` element). One linear
scan finds the contiguous region with the greatest sum, which then grows to the whole element that holds most of it; its
blocks, without the subtrees that can't be article text (menus, forms, adverts, comments, scripts, ...), are the text.
"""

from __future__ import annotations

import html as html_codec
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import map_rows, table

# Element names of HTML by their part in a page.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
                   "tbody tfoot thead caption tr ul".split())
SPACES = frozenset("br td th wbr img option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
NEVER = frozenset("head nav footer aside form button select dialog menu".split()) | RAW
# What ends an element whose end tag may be left out. HEADS: what a head may hold; SCOPES: where the search for
# an open element stops; SPECIAL: what an inline end tag doesn't reach through; TEXTS: content that is never markup.
HEADS = frozenset("base basefont bgsound link meta title style script noscript noframes template".split())
TEXTS = frozenset("script style textarea title iframe".split())
CELLS = frozenset("td th".split())
TABLES = CELLS | frozenset("table caption tbody thead tfoot tr".split())
SCOPES = CELLS | frozenset("table caption html object template".split())
SPECIAL = BLOCKS | CELLS | frozenset("button select".split())
ITEM_STOPS = SPECIAL - frozenset("address div p".split())
ENDED_BY = {"li": (frozenset(["li"]), ITEM_STOPS), "dd": (frozenset(["dd", "dt"]), ITEM_STOPS),
            "dt": (frozenset(["dd", "dt"]), ITEM_STOPS), "option": (frozenset(["option"]), frozenset(["select"])),
            "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])), "td": (CELLS, frozenset(["table"])),
            "th": (CELLS, frozenset(["table"])), "tr": (CELLS | {"tr"}, frozenset(["table"])),
            **dict.fromkeys(("tbody", "thead", "tfoot"), (TABLES - {"table"}, frozenset(["table"])))}
SECTIONING = frozenset("html body main article".split())
CONTAINERS = frozenset("article main section div center td th".split())
# Words of class, id and role that name parts which are no article text.
PARTS = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
                  "navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr "
                  "notice notices alert popup modal overlay comment comments commentlist disqus reply replies discussion "
                  "share sharing social newsletter subscribe signup related recommended pagination pager search login "
                  "complementary contentinfo toolbar widget".split())
# Words of PARTS that are subjects of headings as well.
# Words that only tell how a part is laid out: beside a word of PARTS the label still names that part.
LAYOUT = frozenset("slot box list container wrapper wrap section item items link links post posts article articles button buttons bar block area "
                   "panel inner outer content body row col column group unit zone place holder placeholder form title icon icons count "
                   "counter feed top bottom left right label text teaser teasers card cards thread".split())
SUBJECTS = frozenset("advertising alert aside banner discussion header login masthead nav navigation notice notices overlay promotion "
                     "related reply replies search share sharing social sponsor sponsored subscribe toolbar widget".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p pre blockquote figure figcaption caption li dd dt td th".split())
PART_BEFORE = frozenset("with has no without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.DOTALL)
# A tag's name-value pairs one by one, so that a name is never looked for in another's name or value.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOLD_BY = frozenset("class id role style aria-hidden itemprop hidden".split())
_MAIN = re.compile(r"<(?:article|main)(?=[\s/>])", re.I)
_WORDS = re.compile(r"[^\W_]+")


def _is_part(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether the element's whole subtree is no article text, whatever its labels say."""
    return bool(name in NEVER or (name == "header" and not in_article) or "hidden" in attributes
                or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")))


def _is_labelled(name: str, attributes: dict[str, str], in_article: bool, in_main: bool, layout: frozenset = LAYOUT) -> bool:
    """Whether class, id or role tell a part. Any word of a label counts; but an article element and what stands in one is a
    part only if all words of a label say so or are words of layout, and likewise by the id of text or of what stands in main: ids are often made
    of a heading's words. Headings are no parts."""
    if name in ("html", "body", "main") or name in HEADINGS:
        return False
    for key in ("class", "id", "role"):
        whole = in_article or name == "article" or (key == "id" and (in_main or name in PROSE))
        for label in attributes.get(key, "").split():
            words = _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", label).lower())
            hits = [w in PARTS and not (i and words[i - 1] in PART_BEFORE) and not (in_article and w == "header")
                    and not (whole and key == "id" and w in SUBJECTS) for i, w in enumerate(words)]
            if any(hits) and (not whole or all(hit or w in layout or (layout and w.isdigit()) for hit, w in zip(hits, words))):
                return True
    return False


class _Open(list):
    """Names of the open elements, outermost first; ``number`` tells without a search how many there are of a name."""

    def __init__(self):
        super().__init__()
        self.number: Counter = Counter()

    def push(self, name: str) -> None:
        self.append(name)
        self.number[name] += 1

    def cut(self, keep: int) -> None:
        if keep < len(self):
            self.number.subtract(self[keep:])
            del self[keep:]


def _after_opening(stack: _Open, name: str) -> int:
    """How many of the open elements stay open when ``name`` starts: a start tag may end elements of its kind."""
    keep = len(stack)
    rules = [ENDED_BY[name]] if name in ENDED_BY else []
    if name in BLOCKS:
        rules.append((frozenset(["p"]), SCOPES | {"button"}))
    for ended, stops in rules:
        if not any(stack.number[e] for e in ended):
            continue
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in ended:
                keep = min(keep, i)
                if name in TABLES:  # a row also ends the row around the cell
                    continue
                break
            if stack[i] in stops:
                break
    return keep


def _after_closing(stack: _Open, name: str) -> int:
    """How many of the open elements stay open at the end tag of ``name``; all of them if it ends none."""
    if not stack.number[name]:
        return len(stack)
    if name in SECTIONING:
        stops = frozenset()
    elif name in TABLES:
        stops = frozenset(["table"])
    elif name == "li":
        stops = SCOPES | {"ul", "ol"}
    else:
        stops = SCOPES if name in SPECIAL else SPECIAL
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] == name:
            return i
        if stack[i] in stops:
            break
    return len(stack)


def _past_texts(page: str, at: int, name: str, unclosed: set[str]) -> int | None:
    """Where the end tag of the raw element ``name`` starts; None if it has none and its content counts as markup."""
    if name not in unclosed:
        close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
        if close:
            return close.start()
        unclosed.add(name)
    return len(page) if name in TEXTS else None


def _tag(m: re.Match) -> tuple[str, bool, str]:
    return ((m["name"] or m["name2"] or "").lower(), bool(m["close"] or m["close2"]), m["rest"] or m["rest2"] or "")


def _part_end(page: str, at: int, stack: _Open, unclosed: set[str]) -> int:
    """Where the subtree of the innermost open element ends, that is left out from ``at`` on: behind its end tag, or
    before the tag (or the text, after a head) that ends it without one. ``stack`` then ends at its parent."""
    base = len(stack) - 1
    part = stack[base]
    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if part == "head" and len(stack) == base + 1 and page[at:m.start() if m else n].strip():
            break
        if not m:
            at = n
            break
        name, closing, rest = _tag(m)
        if not name or (name in VOID and closing):
            at = m.end()
            continue
        if closing:
            keep = _after_closing(stack, name)
            if keep <= base:
                at = m.end() if keep == base else m.start()
                break
            at = m.end()
            stack.cut(keep)
            continue
        keep = _after_opening(stack, name)
        if keep <= base or (part == "head" and name not in HEADS):
            at = m.start()
            break
        at = m.end()
        stack.cut(keep)
        if name in RAW:
            past = _past_texts(page, at, name, unclosed)
            if past is not None:
                at = past
                stack.push(name)
                continue
        if name not in VOID and not rest.endswith("/"):
            stack.push(name)
    stack.cut(base)
    return at


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if rest:
        for name, value in _ATTRIBUTE.findall(rest):
            name = name.lower()
            if name in _TOLD_BY:  # of an attribute that is given twice the first counts
                found.setdefault(name, html_codec.unescape(value.strip("\"'")))
    return found


def _holders(page: str) -> frozenset[int]:
    """Where the labelled elements start that hold the page's main element or, without one, its article: of several the first
    inside of fewest elements that a whole label, then any word of one, tells as parts. A layout's wrapper may be named after the sidebar that it has beside the article."""
    stack, unclosed = _Open(), set()
    labelled: list[tuple[int, int, bool]] = []  # (depth, start, by a whole label) of the open elements that labels tell as parts
    best, held = (2, 0, 0), frozenset()
    at = 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        name, closing, rest = _tag(m)
        if not name:
            continue
        stack.cut(_after_closing(stack, name) if closing else _after_opening(stack, name))
        while labelled and labelled[-1][0] >= len(stack):
            labelled.pop()
        if closing or name in VOID:
            continue
        attributes = _attributes(rest)
        start, depth = m.start(), len(stack)
        stack.push(name)
        if _is_part(name, attributes, stack.number["article"] > 0):
            past = _past_texts(page, at, name, unclosed) if name in RAW else None
            at = _part_end(page, at if past is None else past, stack, unclosed)
        elif _is_labelled(name, attributes, False, False):
            labelled.append((depth, start, _is_labelled(name, attributes, True, True, frozenset())))
        elif name in ("article", "main"):
            rank = (name != "main", sum(whole for *_, whole in labelled), len(labelled))
            if rank < best:
                best, held = rank, frozenset(x for _, x, _ in labelled)
    return held


def tokens(page: str | None) -> Iterator[tuple[str, str, str]]:
    """(kind, class, text): ``word`` runs with the enclosing block's name, ``tag`` with its name and slash, and ``part``
    for a subtree that is left out. Characters of a run are decoded. The article element tells its own class."""
    page = page or ""
    at, n = 0, len(page)
    blocks: list[str] = []
    stack = _Open()
    unclosed: set[str] = set()
    known, holders = False, frozenset()
    while at < n:
        m = _TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            yield "word", blocks[-1] if blocks else "", html_codec.unescape(page[at:end])
        if not m:
            return
        at = m.end()
        if m["cdata"] is not None:
            yield "word", blocks[-1] if blocks else "", m["cdata"]
        name, closing, rest = _tag(m)
        if not name:
            continue
        if closing:
            stack.cut(_after_closing(stack, name))
        else:
            stack.cut(_after_opening(stack, name))
            attributes = _attributes(rest)
            inside, in_main = stack.number["article"] > 0, stack.number["main"] > 0
            told = name not in VOID and _is_part(name, attributes, inside)
            labelled = not told and name not in VOID and _is_labelled(name, attributes, inside, in_main)
            if told or (labelled and m.start() not in holders):
                stack.push(name)
                past = _past_texts(page, at, name, unclosed) if name in RAW else None
                past = _part_end(page, at if past is None else past, stack, unclosed)
                if labelled and not inside and not in_main and not known and _MAIN.search(page, at, past):
                    known, holders = True, _holders(page)
                if told or m.start() not in holders:
                    yield "part", name, ""
                    at = past
                    continue
            if name in VOID and ("hidden" in attributes):
                continue
            if name not in VOID:
                stack.push(name)
        if name in BLOCKS:
            if not closing:
                blocks.append(name)
            elif name in blocks:
                while blocks.pop() != name:
                    pass
        yield "tag", "/" + name if closing else name, ""


def labelled_counts(page: str | None) -> Counter:
    """Tokens in and out of the article of a page that labels one: {(inside, kind, class): number}."""
    found = list(tokens(page))
    names = [c for k, c, _ in found if k == "tag"]
    if names.count("article") != 1 or names.count("/article") != 1:
        return Counter()
    counts, inside = Counter(), False
    for kind, name, text in found:
        if (kind, name) == ("tag", "/article"):
            inside = False
        counts[inside, kind, name] += len(text.split()) if kind == "word" else 1
        if (kind, name) == ("tag", "article"):
            inside = True
    return counts


@dataclass
class RegionWeights:
    """Score of a word by its block and of a tag by its name; what was never seen gets the defaults."""

    words: dict[str, float]
    tags: dict[str, float]
    word: float = 0.5
    tag: float = -0.01

    @classmethod
    def from_counts(cls, counts: dict[tuple[bool, str, str], int]) -> RegionWeights:
        """Log-odds of inside against outside, words kept above zero and tags below: a word scores 0.05 to 1, a tag -0.01
        where articles have it more often than the rest."""
        weights = cls({}, {})
        keys = {(k, c) for _, k, c in counts if k != "part"}
        for kind, name in sorted(keys):
            inside, outside = counts.get((True, kind, name), 0), counts.get((False, kind, name), 0)
            odds = math.log((inside + 0.5) / (outside + 0.5))
            if kind == "word":
                weights.words[name] = min(1.0, max(0.05, odds))
            else:
                weights.tags[name] = min(-0.01, odds)
        return weights


def main_region(found: list[tuple[str, str, str]], weights: RegionWeights) -> tuple[int, int, float]:
    """(start, end, score) of the tokens with the greatest sum, by one linear scan; of equal sums the first and
    longest. No word: an empty region."""
    best, top, start, total = (0, 0), 0.0, 0, 0.0
    for i, (kind, name, text) in enumerate(found):
        if kind == "word":
            total += weights.words.get(name, weights.word) * len(text.split())
        elif kind == "tag":
            total += weights.tags.get(name, weights.tag)
        if total <= 0:
            start, total = i + 1, 0.0
        elif total >= top:
            best, top = (start, i + 1), total
    return *best, top


def whole_region(found: list[tuple[str, str, str]], start: int, end: int) -> tuple[int, int]:
    """The region grown to the whole element that holds most of its words: the innermost article or main, else the innermost
    container of whose words the region holds most. Where the page has one article (or main), as labelled pages do, the region
    is that element's content; else it keeps what it had besides."""
    before, n = [0], 0
    for kind, _, text in found:
        n += len(text.split()) if kind == "word" else 0
        before.append(n)

    spans: list[tuple[str, int, int]] = []
    stack: list[tuple[str, int]] = []
    number: Counter = Counter()

    def close(to: int) -> str:
        name, at = stack.pop()
        number[name] -= 1
        spans.append((name, at, to))
        return name

    for i, (kind, name, _) in enumerate(found):
        if kind == "tag" and name in CONTAINERS:
            stack.append((name, i + 1))
            number[name] += 1
        elif kind == "tag" and name.startswith("/") and number[name[1:]]:
            while close(i) != name[1:]:
                pass
    while stack:
        close(len(found))

    def words(a: int, b: int) -> int:
        return max(0, before[b] - before[a]) if b > a else 0

    held = words(start, end)
    most = [(name, a, b) for name, a, b in spans if 2 * words(max(a, start), min(b, end)) > held]  # nested, innermost first
    for name, a, b in most:
        if name in ("article", "main"):
            one = sum(other == name for other, _, _ in spans) == 1
            return (a, b) if one else (min(a, start), max(b, end))
    for _, a, b in most:
        if 2 * words(max(a, start), min(b, end)) > words(a, b):
            return min(a, start), max(b, end)
    return start, end


def block_texts(found: list[tuple[str, str, str]]) -> list[str]:
    """Text of each block: white space runs are one space, blocks without text are left out."""
    blocks, run = [], []

    def end():
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    for kind, name, text in found:
        if kind == "word":
            run.append(text)
        elif kind == "part":
            if name in BLOCKS:
                end()
        elif name.lstrip("/") in BLOCKS:
            end()
        elif name.lstrip("/") in SPACES:
            run.append(" ")
    end()
    return blocks


def extract(page: str | None, weights: RegionWeights) -> tuple[str, float]:
    found = list(tokens(page))
    start, end, score = main_region(found, weights)
    start, end = whole_region(found, start, end)
    return "\n\n".join(block_texts(found[start:end])), score


def fit(pages: DataFrame) -> RegionWeights:
    """Count over every page that labels its article. What reaches the driver is one row per token class seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total += labelled_counts(page.as_py())
        names = [(i, k, c) for i, k, c in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in names], pa.bool_()), pa.array([x[1] for x in names], pa.string()),
             pa.array([x[2] for x in names], pa.string()), pa.array([total[x] for x in names], pa.int64())],
            ["inside", "kind", "name", "n"])

    known = F.col("kind").isin("word", "tag") & F.ltrim("name", F.lit("/")).isin(sorted(KNOWN))
    rows = (pages.select("html").mapInArrow(count, "inside boolean, kind string, name string, n long").where(known)
            .groupBy("inside", "kind", "name").agg(F.sum("n").alias("n")).collect())
    return RegionWeights.from_counts({(r.inside, r.kind, r["name"]): r.n for r in rows})


#: Element names that get weights of their own; any other gets the default, so the weights are a bounded table.
KNOWN = BLOCKS | SPACES | VOID | frozenset("a abbr b big cite code del em font i ins kbd label mark q s small span strike "
                                           "strong sub sup time tt u var".split()) | {""}


def extract_pages(pages: DataFrame, weights: RegionWeights) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html; other columns are ignored): page_id, url, text, n_chars,
    region_score. Null or empty html and pages without words give the empty text; whole pages are read."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(c):
        got = [extract(h, weights) for h in c["html"]]
        return {"page_id": c["page_id"], "url": c["url"], "text": [t for t, _ in got], "n_chars": [len(t) for t, _ in got],
                "region_score": [s for _, s in got]}

    return map_rows(pages.select("page_id", "url", "html"), run,
                    f"page_id {kind}, url string, text string, n_chars long, region_score double", slice_rows=64)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_pages(pages, fit(pages))
