"""Main text of web pages by deducing the template of their host.

A page is read as a sequence of structure tokens (its tags with their path)
and text tokens (whole text blocks with their path).  Over the pages of one
host, tokens that occur equally often in the same pages have the same
occurrence vector and form an equivalence class.  Classes with enough tokens
and enough pages are valid: they are the parts that the host's template
writes.  Their structure tokens, nested by their paths, are the template; a
text token in a valid class is written by the template too.  What stands
between the template's tokens are its slots.

Extraction goes through a page block by block.  Left out are blocks that the
template itself writes, and blocks in menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments (by tag, role,
class or id).  Inside an article or main part the template's blocks go only
after its last slot; headings and lines between slots are the article's own,
however many pages have them.  The article or main part counts alone, unless
an element beside it is named as text (class or id "text", "story", ...);
then, and where there is none, all slots count.  No length decides.

Pages of a host with the same blocks (after the tag rules, so adverts and
menus don't matter) count as one page, and a valid class holds a structure
token: paragraphs of copies have no class with the template's tags.  The rule
is the same for hosts of every size; a host needs MIN_PAGES different pages to
show what repeats.  Near copies whose paragraphs are all that a host has, or
that share tags with an own path, can't be told from a template.

Occurrence vectors are compared by an order-free fingerprint (the exclusive
or of a hash of each page and count), so classes are found by two ordinary
aggregations however many pages a host has.  A template's tokens are in a
fair share of its host's pages, so there are not more than 1 / MIN_SHARE
times the tokens of one page.

Defined cases: null, empty and tagless html are read as plain text (null and
empty give ""); a url that is null or has no host belongs to the host "";
repeated rows and ids each give a row; broken markup is read leniently;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.llm.textbatch import saved, written

#: A valid class has so many tokens and is in so many different pages and this share of its host's.
MIN_TOKENS, MIN_PAGES = 3, 3
MIN_SHARE = 0.3
#: Templates are broadcast up to so many tokens (8 bytes each), else joined by host.
BROADCAST_TOKENS = 1 << 20

# Fixed values of HTML: elements without content, blocks, and raw text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe".split())
SKIP = RAW | frozenset("head nav header footer aside form button select option input menu dialog".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                     "ol p pre section table ul".split())
MAIN = frozenset(("article", "main"))

# Class names and ids are matched whole: every part of one is a name or an affix, so has-sidebar or entry-header tell nothing.
_NAME = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|newsletter|subscribe|popup|modal|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|footer|header|masthead|comments?|replies|respond|disqus|share|social|"
    r"related|widget|pagination|skip", re.I)
_COMMENT = re.compile(r"comments?|replies|respond|disqus", re.I)
_AFFIX = re.compile(
    r"\d+|site|global|top|bottom|left|right|main|primary|secondary|wrap|wrapper|container|inner|outer|area|section|block|box|bar|"
    r"list|items?|buttons?|links?|icons?|slot|unit|posts?|form|text|message|signup", re.I)
#: Names of an element that holds a page's text outside its main part.
_TEXT = re.compile(r"text|content|story|entry|articlebody", re.I)
_PARTS = re.compile(r"[_-]+")
#: The title block's own names, which a header of an article may have.
_TITLE = frozenset(("header", "masthead", "banner"))
#: Around a main part a form is layout: some servers put whole pages into one.
_AROUND = SKIP - {"form"}
_SKIP_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
#: Elements that a path names at most; deeper ones share their parent's path.
MAX_DEPTH = 256
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACES = re.compile(r"\s+")
TOKENS = pa.list_(pa.struct([("token", pa.int64()), ("tag", pa.bool_()), ("n", pa.int32())]))


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(text)}


class Markup:
    """Tags, comments and declarations of a page, one after another.

    Every character is looked at a bounded number of times, also in a page that
    is cut off or never closes its quotes: where no ">" is left nothing more is a
    tag, and a quote from which no end was found is remembered.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.dead: set[int] = set()  # quotes from which a tag has no end
        self.name_end = 0

    def tag_end(self, at: int) -> int:
        """The place of the ">" that ends a tag, quoted values skipped; -1 for none."""
        seen = []
        while at <= self.last:
            m = _STOP.search(self.page, at)
            if m[0] == ">":
                return m.start()
            seen.append(m.start())
            close = -1 if m.start() in self.dead else self.page.find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        self.dead.update(seen)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether it closes, name, attributes); no name for comments
        and declarations; None if there is no more."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, False, "", ""
            if start > self.last:
                if (start := page.find("<!--", start)) < 0:
                    return None
                return start, len(page), False, "", ""
            if page[start + 1:start + 2] in ("!", "?"):
                return start, page.find(">", start) + 1, False, "", ""
            first = start + 1 + page.startswith("/", start + 1)
            letter = page[first:first + 1]
            if letter.isascii() and letter.isalpha():
                if self.name_end <= first:  # names that begin inside another one end with it
                    self.name_end = _TAG.match(page, start).end()
                end = self.tag_end(self.name_end)
                if end >= 0:
                    return start, end + 1, first > start + 1, page[first:self.name_end], page[self.name_end:end]
            at = start + 1
        return None


def read(page: str) -> Iterator[tuple[str, str, str]]:
    """('tag', path, name), ('text', path, raw text) and ('end', path, name) in page order.

    A path is the open elements, each with its class and id; elements that
    the standard closes implicitly (paragraphs, list items, cells) are closed.
    """
    open_: list[tuple[str, str]] = []  # element and its path
    held: dict[str, int] = {}  # open elements by name
    markup = Markup(page)
    at = 0

    def path() -> str:
        return open_[-1][1] if open_ else ""

    def close(names: frozenset[str], stop: frozenset[str]) -> Iterator[tuple[str, str, str]]:
        if not any(held.get(n) for n in names):
            return
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in names:
                while len(open_) > k:
                    n, p = open_.pop()
                    held[n] -= 1
                    yield "end", p, n
                return
            if open_[k][0] in stop:
                return

    while at < len(page):
        m = markup.next(at)
        text = page[at:m[0] if m else len(page)]
        if text:
            yield "text", path(), text
        if not m:
            return
        _, at, closes, name, given = m
        name = name.lower()
        if not name:
            continue
        if closes:
            yield from close(frozenset((name,)), frozenset(("article", "main", "body")) if name in INLINE | {"p"} else frozenset())
            continue
        if name in CLOSES_P:
            yield from close(frozenset("p"), frozenset(("article", "main", "section", "div", "td", "li", "body")))
        if name in ("li", "option", "tr", "td", "th", "dt", "dd"):
            yield from close(frozenset((name,)), frozenset(("ul", "ol", "select", "table", "dl", "body")))
        step = name
        if given:
            attributes = _attributes(given)
            mark = " ".join(filter(None, (attributes.get("class"), attributes.get("id"), attributes.get("role"))))
            step = f"{name}.{mark.replace('/', ' ')}" if mark else name
        open_.append((name, path() if len(open_) >= MAX_DEPTH else f"{path()}/{step}" if open_ else step))
        held[name] = held.get(name, 0) + 1
        yield "tag", path(), name
        if name in VOID or given.endswith("/") and name not in INLINE:
            held[open_.pop()[0]] -= 1
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end:
                if end.start() > at:
                    yield "text", path(), page[at:end.start()]
                at = end.end()
            else:
                at = len(page)
            p = path()
            held[open_.pop()[0]] -= 1
            yield "end", p, name


def _hash(*parts: str) -> int:
    h = xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def tidy(raw: str) -> str:
    """References decoded, white space as one space, trimmed."""
    return _SPACES.sub(" ", html.unescape(raw)).strip()


def structure(path: str) -> int:
    return _hash("tag", path)


def text_token(path: str, text: str) -> int:
    """Of a block: its block elements by name (ids and classes may differ from page to page) and its text."""
    names = [step.partition(".")[0] for step in path.split("/")]
    while names and names[-1] in INLINE:
        names.pop()
    return _hash("text", "/".join(names), text)


#: Stands for the page itself in counts of tokens.
PAGE = structure("")


def occurrences(page: str) -> tuple[Counter, Counter]:
    """How often each structure token and each text token occurs in a page."""
    tags: Counter = Counter()
    texts: Counter = Counter()
    for kind, path, _, text in parts(page):
        if kind == "tag":
            tags[path] += 1
        else:
            texts[text_token(path, text)] += 1
    return Counter({structure(path): n for path, n in tags.items()}), texts


def _named(mark: str, names: re.Pattern) -> bool:
    """Whether one of the class names and ids says one of the names, with affixes at most."""
    for word in mark.split():
        said = [x for x in _PARTS.split(word) if x]
        if any(map(names.fullmatch, said)) and all(names.fullmatch(x) or _AFFIX.fullmatch(x) for x in said):
            return True
    return False


def _skipped(step: str, elements: frozenset[str] = SKIP) -> bool:
    name, _, mark = step.partition(".")
    return name in elements or bool(mark) and (mark.rpartition(" ")[2] in _SKIP_ROLE or _named(mark, _NAME))


def _title(step: str) -> bool:
    """Whether a step in the main part is a title block, which stays."""
    name, _, mark = step.partition(".")
    return name == "header" and not _skipped("header." + " ".join(w for w in mark.split() if w.lower() not in _TITLE), frozenset())


def place(path: str) -> tuple[bool, bool]:
    """Whether a path is in an article or main part, and whether it is left out.

    An article below a part that is left out, a teaser in a sidebar for
    instance, is no main part."""
    steps = [s for s in path.split("/") if s and s.partition(".")[0] not in ("html", "body")]
    first = next((i for i, s in enumerate(steps) if s.partition(".")[0] in MAIN), None)
    if first is None:
        return False, any(map(_skipped, steps))
    if any(_skipped(s, _AROUND) for s in steps[:first]):
        return False, True
    return True, _named(steps[first].partition(".")[2], _COMMENT) or any(_skipped(s) and not _title(s) for s in steps[first + 1:])


def parts(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """('tag', path, False, '') of every element, and ('text', path, in main
    part, text) of every block that the tag rules don't leave out, in page order."""
    held: list[str] = []
    now = ("", False)
    known: dict[str, tuple[bool, bool]] = {}

    def block() -> list[tuple[str, str, bool, str]]:
        text = tidy("".join(held))
        held.clear()
        return [("text", *now, text)] if text else []

    for kind, path, value in read(page):
        if kind == "text":
            if path not in known:
                known[path] = place(path)
            main, skip = known[path]
            if skip:
                continue
            if main != now[1]:
                yield from block()
            if not held:
                now = path, main
            held.append(value)
            continue
        if value in ("br", "wbr"):
            if held and value == "br":
                held.append(" ")
        elif value not in INLINE:
            yield from block()
        if kind == "tag":
            yield "tag", path, False, ""
    yield from block()


def _text_parts(paths: list[str], main_paths: list[str]) -> bool:
    """Whether one of the paths goes through an element that is named as text
    (by class or id) and that holds none of the main part's paths."""
    mains = sorted(f"{m}/" for m in main_paths)
    known: set[str] = {""}
    for path in set(paths):
        at = path
        while at not in known:
            known.add(at)
            if _named(at.rpartition("/")[2].partition(".")[2], _TEXT):
                here = bisect_left(mains, f"{at}/")
                if here == len(mains) or not mains[here].startswith(f"{at}/"):
                    return True
            at = at.rpartition("/")[0]
    return False


def slots(page: str, template: frozenset[int]) -> list[tuple[str, bool, str]]:
    """(path, in main part, text) of every block that neither the tag rules
    leave out nor the template writes, in page order.

    In the main part the template's blocks stay up to the page's last own one:
    a heading or line between the slots of an article belongs to it, what the
    template writes after the last slot closes it.  A main part without a block
    of its own stays whole."""
    blocks = [(path, main, text, text_token(path, text) not in template)
              for kind, path, main, text in parts(page) if kind == "text"]
    last = max((i for i, (_, main, _, own) in enumerate(blocks) if main and own), default=len(blocks))
    return [(path, main, text) for i, (path, main, text, own) in enumerate(blocks) if own or main and i <= last]


def extract(page: str, template: frozenset[int]) -> str:
    """Text of the main slots of a page, a line for each block."""
    blocks = slots(page, template)
    inside = [path for path, main, _ in blocks if main]
    main_only = bool(inside) and not _text_parts([path for path, main, _ in blocks if not main], inside)
    return "\n".join(text for _, main, text in blocks if main or not main_only)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, token, tag, pages, vector) over the different pages of each host;
    pages with equal blocks are one, that of the least tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            content, rows = [], []
            for page in b.column(1).to_pylist():
                tags, texts = occurrences(page or "")
                content.append(_hash(*(f"{t} {n}" for t, n in sorted(texts.items()))))
                rows.append([{"token": t, "tag": tag, "n": n} for tag, of in ((True, tags), (False, texts)) for t, n in sorted(of.items())]
                            + [{"token": PAGE, "tag": True, "n": 1}])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(content, pa.int64()), pa.array(rows, TOKENS)],
                                             names=["host", "content", "tokens"])

    return (pages.select("host", "html").mapInArrow(run, "host string, content long, tokens array<struct<token:long,tag:boolean,n:int>>")
            .groupBy("host", "content").agg(F.min("tokens").alias("tokens"))
            .select("host", "content", F.explode("tokens").alias("t"))
            .groupBy("host", "t.token", "t.tag")
            .agg(F.count(F.lit(1)).alias("pages"), F.bit_xor(F.xxhash64("content", "t.n")).alias("vector")))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, tokens): the tokens of the valid classes of each host that has any."""
    counts = written(page_tokens(pages))
    totals = counts.where(F.col("token") == PAGE).select("host", F.col("pages").alias("all_pages"))
    common = (counts.where(F.col("token") != PAGE).join(totals, "host")
              .where(F.col("pages") >= F.greatest(F.lit(min_pages), min_share * F.col("all_pages"))))
    valid = (common.groupBy("host", "vector", "pages").agg(F.collect_list("token").alias("class"), F.max("tag").alias("tag"))
             .where((F.size("class") >= MIN_TOKENS) & F.col("tag")))
    return saved(valid.groupBy("host").agg(F.flatten(F.collect_list("class")).alias("tokens")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"),
                        host(pages[url_col]).alias("host"))
    own = templates(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, frozenset[int]] = (None, frozenset())
        for b in batches:
            where, tokens = b.column(3), b.column(4)
            texts = []
            for i, page in enumerate(b.column(2).to_pylist()):
                name = where[i].as_py()
                if name != last[0]:
                    last = name, frozenset(tokens[i].as_py() or ())
                texts.append(extract(page, last[1]) if page else "")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    if (own.agg(F.sum(F.size("tokens"))).first()[0] or 0) <= BROADCAST_TOKENS:
        own = F.broadcast(own)
    kind = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    return (rows.join(own, "host", "left").select("page_id", "url", "html", "host", "tokens")
            .mapInArrow(run, f"page_id {kind[id_col]}, url {kind[url_col]}, text string, n_chars long")
            .withColumnsRenamed({"page_id": id_col, "url": url_col}))
