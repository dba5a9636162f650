"""Main text of web pages: a maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score positive and tags negative, by where they stand (in a
link, a menu, a heading, an element whose class, id or role is a certain word ...); the weights are log odds learnt from
pages that label their own content with <article> or <main>. End tags score nothing. A stretch of boilerplate counts
as one tag, and a stretch of links or tags without plain words costs a bounded amount, so that neither an advert nor a
list of sources nor a table cuts an article short. A linear scan finds the contiguous run of tokens with the highest
score; where the page labels its content, the run is then drawn out to the ends of the labelled elements that it touches.
Its blocks, without those of boilerplate elements inside it, are the text.

An element is boilerplate by its tag (<nav>, <form> ..), if it isn't shown, or by the learnt weights of its class words:
words that mostly stand on elements outside the labelled content weigh against it, those on elements that hold labelled
content weigh for it; BOILER_WORDS only start with a weight against. Whatever its words weigh, what holds most of a page's
plain words and an article, a heading or two paragraphs is a wrapper of the article.

Null or empty html, and pages without words, give the empty text. Unclosed and stray tags, broken
references, quotes that are never closed and `<` in text are taken as browsers take them, roughly, and pages of any
length and depth take linear time. Ties go to the run that ends first, the shortest of these. Repeated rows give repeated results.
Other columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced


# Elements by their role in HTML.
UNSEEN = {"script", "style", "head", "title", "noscript", "template", "svg", "math", "iframe", "object", "textarea", "select", "button", "canvas", "audio", "video", "map"}
BOILER = {"nav", "header", "footer", "aside"}
#: Boilerplate unless they wrap the article, as forms do on some sites.
FORMS = {"form", "fieldset", "label", "dialog", "menu"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose end is looked for; those of UNSEEN, BOILER, FORMS and the others that carry a class.
NESTED = UNSEEN | BOILER | FORMS | {"div", "section", "article", "main", "ul", "ol", "table", "figure", "details", "span", "p", "a", "body", "h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in a class, id or role that name what is not the article.
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu topbar breadcrumb breadcrumbs sidebar rail widget widgets footer"
    " header masthead cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments disqus replies reply"
    " respond related recommended pagination pager skip copyright disclaimer toolbar search contentinfo complementary".split()
)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: Attributes up to the tag's end: no `>` inside quotes ends it. Nothing is tried twice.
_ATTRIBUTES = re.compile(r"(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Elements that may stand in a head; any other ends it.
IN_HEAD = {"title", "meta", "link", "style", "script", "noscript", "base", "template"}
#: Words of readers' texts, which may be longer than the article; first and last words of names that tell what a page has.
READERS = {"comment", "comments", "disqus", "replies", "reply", "respond"}
HAS, IS = {"has", "with", "without", "no"}, {"open", "closed"}

#: What a stretch of boilerplate costs at most: an advert must not cut an article in two.
BRIDGE = 2.0
#: What a stretch of links and tags without plain words between them costs at most: a long list of sources must not cut off
#: the paragraphs behind it, though a menu keeps what little stands before it apart.
STRETCH = 40.0
#: Weight against an element of a class word in BOILER_WORDS, until pages say otherwise, and the most that a word weighs.
NAMED, MOST = -2.0, 4.0
#: Where a word or tag stands; the features that have weights.
PLACES = ("plain", "link", "boiler", "heading")
#: Weights without labelled pages: words for and tags against the article, boilerplate against it.
DEFAULT_WEIGHTS = {f"class {w}": NAMED for w in sorted(BOILER_WORDS)} | {"word plain": 1.0, "word link": -1.0, "word boiler": -3.0, "word heading": 0.5, "tag plain": -0.7, "tag link": -1.5, "tag boiler": -3.0, "tag heading": -0.5}


def class_weights(weights: dict[str, float]) -> dict[str, float]:
    """Of all weights those of class words, by the word."""
    return {k.removeprefix("class "): v for k, v in weights.items() if k.startswith("class ")}


def _boilerplate(tag: str, attrs: str, but: frozenset[str] = frozenset()) -> tuple[bool, set[str]]:
    """Whether an element is boilerplate by its tag or isn't shown, and the words of its class, id and role."""
    words: set[str] = set()
    if tag in BOILER and tag not in but:
        return True, words
    heading = tag[0] == "h" and tag[1:].isdigit()
    for name, *quoted in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), quoted[0] or quoted[1] or quoted[2]
        if name == "hidden":
            if not value.lower().startswith(("false", "until")):
                return True, words
        elif name == "aria-hidden":
            if value.strip().lower() == "true":
                return True, words
        elif name == "style":
            if _NO_DISPLAY.search(value):
                return True, words
        elif name in ("class", "role") and not heading or name == "id" and not heading and tag != "p":  # ids of headings and paragraphs are anchors
            for one in value.split():
                parts = _SPLIT.split(_CAMEL.sub(" ", one).lower())
                if parts[0] not in HAS and parts[-1] not in IS:
                    words.update(w for w in parts if w and w not in but)
    return False, words


@dataclass(slots=True)
class _Named:
    """An element whose class words weigh against it, and what it holds."""

    outer: int
    readers: bool
    form: bool = False
    plain: int = 0
    labelled: int = 0
    paragraphs: int = 0
    article: bool = False
    heading: bool = False
    top: bool = False
    dropped: bool = True


def _judge(named: list[_Named], plain: int, labelled: int) -> None:
    """Sets which named elements are boilerplate. `plain` and `labelled` count the page's words outside all of them.

    One that holds most of the plain words (those within <article> or <main> where a page has such) and an article,
    a heading or two paragraphs is a wrapper of the article; readers' texts are counted only if there is nothing else.
    Where names would take over nine tenths of the words, they tell nothing; then only forms without an article go.
    """
    for e in reversed(named):
        if e.outer >= 0:
            o = named[e.outer]
            o.paragraphs += e.paragraphs
            o.article |= e.article
            o.heading |= e.heading
            o.top |= e.top
    for e in named:  # what holds <main> or the page's first heading isn't readers' texts
        e.readers = e.readers and not e.top or e.outer >= 0 and named[e.outer].readers
    words = labelled + sum(e.labelled for e in named if not e.readers)
    of = (lambda e: e.labelled) if words else (lambda e: e.plain)
    rest = labelled if words else plain
    total = words or plain + sum(e.plain for e in named if not e.readers)
    readers = not total
    total = total or sum(e.plain for e in named)
    held = [of(e) if readers or not e.readers else 0 for e in named]
    own = list(held)
    for i in range(len(named) - 1, -1, -1):
        if named[i].outer >= 0:
            held[named[i].outer] += held[i]
    kept = rest
    for e, n, m in zip(named, held, own, strict=True):
        wrapper = 2 * n > total and (e.article or e.heading or e.paragraphs > 1)
        e.dropped = not wrapper or (e.outer >= 0 and named[e.outer].dropped)
        kept += 0 if e.dropped else m
    if 10 * kept < total:
        for e in named:
            e.dropped = e.readers and not readers or e.form and not (e.article or e.heading or e.paragraphs > 1) or e.outer >= 0 and named[e.outer].form and named[e.outer].dropped


class _Markup:
    """Finds the tags of a page one after the other, in linear time whatever is left open."""

    def __init__(self, page: str):
        self.page = page
        self.loose = False  # a quote was never closed: from there on any `>` ends a tag
        self.unclosed: set[str] = set()
        self.next: dict[str, int] = {}  # where the next start or end tag of a name is

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it is an end tag, name and attributes of the next tag, or of what hides text (no name)."""
        page, n = self.page, len(self.page)
        while (lt := page.find("<", at)) >= 0:
            if page.startswith("<!--", lt):
                to = page.find("-->", lt + 4)
                return lt, to + 3 if to >= 0 else n, False, "", ""
            if page.startswith("<![CDATA[", lt):
                to = page.find("]]>", lt)
                return lt, to + 3 if to >= 0 else n, False, "", ""
            to = page.find(">", lt)
            if to < 0:  # no tag ends any more
                return None
            m = _TAG.match(page, lt)
            if m:
                attributes = None if self.loose else _ATTRIBUTES.match(page, m.end())
                if attributes is None:
                    self.loose, to = True, page.find(">", m.end())
                    if to < 0:
                        return None
                    return lt, to + 1, bool(m[1]), m[2].lower(), page[m.end() : to]
                return lt, attributes.end(), bool(m[1]), m[2].lower(), page[m.end() : attributes.end() - 1]
            if page[lt + 1] in "!?/":
                return lt, to + 1, False, "", ""
            at = lt + 1
        return None

    def ends(self, tag: str, at: int, nests: bool = True) -> bool:
        """Whether an end tag of `tag` comes; of one that doesn't nest, before its next start tag."""
        end = self._next(f"</{tag}", at)
        return end < len(self.page) and (nests or end < self._next(f"<{tag}", at))

    def _next(self, mark: str, at: int) -> int:
        """Where the next tag that begins so is; each stretch of the page is looked at once."""
        if self.next.get(mark, -1) < at:
            found = re.compile(rf"{mark}(?![^\s/>])", re.I).search(self.page, at)
            self.next[mark] = found.start() if found else len(self.page)
        return self.next[mark]

    def closed(self, tag: str, at: int) -> int:
        """Where the element of a tag that holds no tags ends; -1 if it never does."""
        if tag in self.unclosed:
            return -1
        over = re.compile(rf"</{tag}\s*>", re.I).search(self.page, at)
        if over:
            return over.end()
        self.unclosed.add(tag)
        return -1


@dataclass(slots=True)
class _Watched:
    """The class words of an element, and how it stands to the labelled content."""

    words: set[str]
    inside: bool
    holds: bool = False


def tokens(page: str, named_words: dict[str, float] | None = None, watched: list[_Watched] | None = None) -> list[tuple[str, str, str, int]]:
    """(kind, value, place, labelled) of a page: kind is `text`, `break` or `tag` (a start tag that ends a block or doesn't)
    or `stop` (an end tag that ends a block).

    labelled: 2 inside <article>, 1 inside <main> alone; learning looks at it, and it tells wrappers from boilerplate.
    named_words: weights of class words. watched: gets the elements with class words.
    """
    if named_words is None:
        named_words = class_weights(DEFAULT_WEIGHTS)
    out: list[tuple[str, str, str, int]] = []
    within: list[int] = []  # the innermost named element of each token
    named: list[_Named] = []
    opened: list[int] = []  # those that are open
    stack: list[tuple[str, bool, int, bool]] = []  # name, whether boilerplate, named element, whether a link
    short: list[int] = []  # places of open elements that end at the next block, as no end tag of theirs comes
    seen: list[_Watched | None] = []  # of the stack's elements
    places: dict[str, list[int]] = {}  # of each tag's open elements in the stack
    boiler = links = headings = labels = articles = 0
    plain = labelled = 0
    at, n = 0, len(page)
    markup = _Markup(page)

    def add(kind: str, value: str) -> None:
        out.append((kind, value, "boiler" if boiler else "link" if links else "heading" if headings else "plain", 2 if articles else int(labels > 0)))
        within.append(opened[-1] if opened else -1)

    def close(i: int) -> None:
        """Closes all elements from place i of the stack on."""
        nonlocal boiler, links, headings, labels, articles
        while short and short[-1] >= i:
            short.pop()
        while len(stack) > i:
            name, bad, k, link = stack.pop()
            seen.pop()
            if not name:
                continue
            places[name].pop()
            boiler -= bad
            links -= link
            headings -= name[0] == "h" and name[1:].isdigit()
            labels -= name in ("article", "main")
            articles -= name == "article"
            if k >= 0:
                opened.remove(k) if opened[-1] != k else opened.pop()

    def push(name: str, bad: bool, words: set[str], link: bool = False, form: bool = False) -> None:
        nonlocal boiler, links, headings, labels, articles
        k = -1
        if form or words and sum(named_words.get(w, 0.0) for w in words) < -1:
            k = len(named)
            named.append(_Named(opened[-1] if opened else -1, bool(words & READERS), form))
            opened.append(k)
        if watched is not None:
            if name in ("article", "main"):
                for x in reversed(seen):
                    if x is not None:
                        if x.holds:
                            break  # so do those around it
                        x.holds = True
            seen.append(_Watched(words, labels > 0) if words else None)
            if words:
                watched.append(seen[-1])
        else:
            seen.append(None)
        places.setdefault(name, []).append(len(stack))
        stack.append((name, bad, k, link))
        boiler += bad
        links += link
        headings += name[0] == "h" and name[1:].isdigit()
        labels += name in ("article", "main")
        articles += name == "article"

    while at < n:
        found = markup.after(at)
        start = found[0] if found else n
        if start > at:
            text = page[at:start]
            if places.get("head") and not text.isspace() and stack[-1][0] == "head":
                close(places["head"][0])
            add("text", text)
            if not boiler and not links:
                words = len(text.split())
                if opened:
                    named[opened[-1]].plain += words
                    named[opened[-1]].labelled += words if labels else 0
                else:
                    plain += words
                    labelled += words if labels else 0
        if not found:
            break
        _, at, end, tag, attrs = found
        if not tag:
            continue
        if not end and tag not in IN_HEAD and places.get("head"):
            close(places["head"][0])
        if end:
            if places.get(tag):
                close(places[tag][-1])
            if tag in BLOCKS or tag == "br":
                add("stop", tag)
            continue
        if tag in BLOCKS and short:
            close(short[0])
        if tag in UNSEEN:
            if not attrs.rstrip().endswith("/"):
                if tag in ("script", "style", "textarea", "title", "noscript", "iframe"):
                    over = markup.closed(tag, at)
                    at = over if over >= 0 else n if tag in ("script", "style") else at
                else:
                    if tag != "head" and not markup.ends(tag, at, tag not in ("button", "select")):
                        short.append(len(stack))
                    push(tag, True, set())
        elif tag in NESTED and not attrs.rstrip().endswith("/"):
            while stack and not stack[-1][0]:
                close(len(stack) - 1)
            if stack and tag in BLOCKS and stack[-1][0] == "p":  # a block ends an open paragraph
                close(len(stack) - 1)
            bad, words, form = False, set(), tag in FORMS
            if tag not in ("html", "body", "article", "main"):
                bad, words = _boilerplate(tag, attrs, frozenset({"header"}) if tag == "header" and labels else frozenset())  # an article's own heading
            if tag in BOILER and bad and not markup.ends(tag, at):  # it would hold to the end
                bad, form = False, True
            if tag == "a" and places.get("a"):  # links don't nest
                i = places["a"].pop()
                _, was, k, link = stack[i]
                stack[i] = ("", False, -1, False)
                boiler -= was
                links -= link
                if k >= 0:
                    opened.remove(k)
            link = tag == "a" and _HREF.search(attrs) is not None
            if link and not markup.ends("a", at, False):
                short.append(len(stack))
            push(tag, bad, words, link, form and not bad)
            if opened and not boiler:
                e = named[opened[-1]]
                e.article |= tag in ("article", "main")
                e.heading |= tag[0] == "h" and tag[1:].isdigit()
                e.top |= tag in ("h1", "main")
                e.paragraphs += tag == "p"
        add("break" if tag in BLOCKS or tag == "br" else "tag", tag)
    if not named:
        return out
    _judge(named, plain, labelled)
    return [(kind, value, "boiler" if k >= 0 and named[k].dropped else place, inside) for (kind, value, place, inside), k in zip(out, within, strict=True)]


def _clean(raw: str) -> str:
    return " ".join((htmllib.unescape(raw) if "&" in raw else raw).split())


_LABEL = re.compile(r"<(?:article|main)\b", re.I)


def count_labels(page: str) -> Counter:
    """(feature, for) -> how often, from a page that has an <article> or <main>: words and tags inside it are for the
    content, others against it; so are class words of elements that hold it or stand outside it. Of those inside it,
    class words of BOILER_WORDS tell nothing, as adverts may stand there; others are for it."""
    out: Counter = Counter()
    if not _LABEL.search(page):
        return out
    watched: list[_Watched] = []
    for kind, value, place, labelled in tokens(page, None, watched):
        if kind == "text":
            if n := len(value.split()):
                out[f"word {place}", labelled > 0] += n
        elif kind != "stop":
            out[f"tag {place}", labelled > 0] += 1
    for x in watched:
        for w in x.words:
            if x.holds or not x.inside or w not in BOILER_WORDS:
                out[f"class {w}", x.holds or x.inside] += 1
    return out


def learn_weights(pages: DataFrame, sample: int = 4000) -> dict[str, float]:
    """Log odds of the features, from about `sample` pages (the bound) chosen by a hash of their id and text.

    Words are held positive and tags negative, as the method wants it, except where boilerplate elements and
    links tell otherwise; a feature that no labelled page shows keeps its default. Class words are as many as the
    sampled pages use, those used once or twice apart.
    """
    n = pages.count()
    every = max(1, n // sample)
    rows = pages.filter(F.pmod(F.xxhash64("page_id", F.substring("html", 1, 500)), F.lit(every)) == 0).select(F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in sliced(batches):
            for page in b.column(0).to_pylist():
                total.update(count_labels(page))
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.bool_()), pa.array(list(total.values()), pa.int64())], names=["feature", "labelled", "n"])

    counts = {(r.feature, r.labelled): r.n for r in rows.mapInArrow(count, "feature string, labelled boolean, n long").groupBy("feature", "labelled").agg(F.sum("n").alias("n")).filter("n > 2").collect()}
    return weights_from(counts)


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    out = dict(DEFAULT_WEIGHTS)
    inside, outside = (sum(v for k, v in counts.items() if k[1] is x and not k[0].startswith("class ")) for x in (True, False))
    if not inside or not outside:
        return out
    for f in sorted({k[0] for k in counts} | set(out)):
        a, b = counts.get((f, True), 0), counts.get((f, False), 0)
        if a + b < 20:
            continue
        if f.startswith("class "):
            out[f] = max(-MOST, min(MOST, math.log((a + 1) / (b + 1))))
            continue
        odds = max(-4.0, min(4.0, math.log((a + 1) / (inside + 8)) - math.log((b + 1) / (outside + 8))))
        kind, place = f.split()
        if place == "plain":
            out[f] = max(0.2, odds) if kind == "word" else min(-0.2, -abs(odds) / 4)
        elif place == "heading":
            out[f] = max(0.1, odds) if kind == "word" else min(-0.1, -abs(odds) / 4)
        else:
            out[f] = min(-0.2, odds)
    return out


def scored(toks: list[tuple[str, str, str, int]], weights: dict[str, float]) -> list[float]:
    """The score of each token."""
    out = []
    was, spent = "", 0.0
    for kind, value, place, _ in toks:
        if place == "boiler":
            # boilerplate never gets into the text, so a stretch of it is one tag, however long it is
            score = max(-BRIDGE, weights["tag boiler"]) if was != "boiler" else 0.0
        elif kind == "stop":
            score = 0.0
        else:
            score = weights["word " + place] * len(value.split()) if kind == "text" else weights["tag " + place]
            if score > 0:
                spent = 0.0
            else:
                score = -min(-score, STRETCH - spent)
                spent -= score
        was = place
        out.append(score)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the highest sum, by one scan; of equal sums that which ends first, the shortest of these. (0, 0) if none is over 0."""
    best = here = 0.0
    best_from = best_to = start = 0
    for i, score in enumerate(scores):
        if here <= 0:
            here, start = 0.0, i
        here += score
        if here > best:
            best, best_from, best_to = here, start, i + 1
    return best_from, best_to


def extract(page: str | None, weights: dict[str, float] = DEFAULT_WEIGHTS, named_words: dict[str, float] | None = None) -> str:
    """The main text of a page: blocks joined by an empty line. named_words: class_weights(weights), if they are at hand."""
    if not page:
        return ""
    toks = tokens(page, class_weights(weights) if named_words is None else named_words)
    first, last = best_run(scored(toks, weights))
    # a run that begins or ends inside an <article> takes in all of it
    while last and toks[first][3] == 2 and first and toks[first - 1][3] == 2:
        first -= 1
    while last and toks[last - 1][3] == 2 and last < len(toks) and toks[last][3] == 2:
        last += 1
    blocks: list[str] = []
    parts: list[str] = []
    for kind, value, place, _ in toks[first:last]:
        if kind in ("break", "stop"):
            if value == "br":
                parts.append(" ")
                continue
            if block := _clean("".join(parts)):
                blocks.append(block)
            parts = []
        elif kind == "text" and place != "boiler":
            parts.append(value)
    if block := _clean("".join(parts)):
        blocks.append(block)
    return "\n\n".join(blocks)


def extract_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    w = learn_weights(pages) if weights is None else weights
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = class_weights(w)
        for b in sliced(batches):
            texts = [extract(x, w, named) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
