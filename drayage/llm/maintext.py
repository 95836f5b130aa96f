"""Main text of pages by a tree-structured graphical model over the elements of the page.

Each element is content or not. What is seen of it (names in its attributes, its own text, how much of its text is links) bears
on its label, and so does the label of its parent, by a table for each tag and one for names of what stands around an
article: a list goes with its parent, a menu doesn't. The tables are learned by counting on labelled pages. Messages go
from the leaves up and from the root down, and give each element's marginal; text in elements that are likelier content
than not is the main text. Pages that mark their article with an element label themselves; a few pages labelled by hand,
with other layouts, are learned with them.
"""

import dataclasses
import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, table, utf8

SAMPLE_PAGES, SAMPLE_BYTES = 400, 65_536    # pages to learn from, and their greatest length
HAND_WEIGHT, PRIOR = 20, 1                  # a hand-labelled page counts as so many; counts of all pairs added to those of a kind

RAW = "script|style|title|textarea|noscript|iframe"
ATTRS = r"""(?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+"""     # a quote counts only after an equals sign
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b{ATTRS}(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{ATTRS})(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
BLOCKS = frozenset("""address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1
    h2 h3 h4 h5 h6 head header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr
    ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an opening tag of the first closes open elements of the second, up to the third
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
MARKED = frozenset(["article", "main"])
HIDDEN = frozenset(["svg", "object", "select", "button", "template"])
SCOPES = frozenset(["object", "button", "template"])     # an opening tag in one closes nothing outside of it
NEVER = HIDDEN | {"nav", "aside", "footer", "form", "head"}
AROUND = ("nav menu header footer sidebar aside ad ads advert advertisement banner promo sponsor cookie notice consent "
          "comment comments reply respond share social related newsletter subscribe login search breadcrumb breadcrumbs widget "
          "popup modal pagination pager toolbar masthead disqus "
          "kommentar kommentare werbung anzeige hinweis seitenleiste fusszeile kopfzeile "
          "commentaire commentaires publicite avis annonce barre pied "
          "comentario comentarios publicidad anuncio aviso lateral").split()
WITHIN = "article content main post entry story body text page".split()


class Page:
    """Elements in page order, each with its parent; runs of text with their element and block."""

    def __init__(self, source: str):
        self.tags, self.names, self.parents = ["#"], [""], [-1]
        self.runs, self.closed, block, stack = [], set(), 0, [0]
        self.open = Counter()       # open elements by tag: what isn't open needn't be looked for
        for token in TOKEN.finditer(source):
            text = token.group("text")
            if text is not None:
                self.runs.append((stack[-1], block, text))
                continue
            tag = token.group("tag")
            if tag is None:
                continue
            tag = tag.lower()
            if tag in BLOCKS:
                block += 1
            elif tag == "br":
                self.runs.append((stack[-1], block, " "))
            if token.group("end"):
                if self.open[tag]:
                    at = next(i for i in range(len(stack) - 1, 0, -1) if self.tags[stack[i]] == tag)
                    self.closed.add(stack[at])
                    self._leave(stack, at)
                continue
            attrs = token.group("attrs")
            if tag in BLOCKS and tag != "hr":
                self._close(stack, {"p"}, BLOCKS - {"p"})
            if tag in CLOSES:
                self._close(stack, *CLOSES[tag])
            if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
                continue
            self.parents.append(stack[-1])
            self.tags.append(tag)
            self.names.append(" ".join(a or b or c for a, b, c in NAMES.findall(attrs)).lower() if attrs else "")
            stack.append(len(self.tags) - 1)
            self.open[tag] += 1

    def _leave(self, stack, at):
        for element in stack[at:]:
            self.open[self.tags[element]] -= 1
        del stack[at:]

    def _close(self, stack, tags, limit):
        if not any(self.open[tag] for tag in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[i]]
            if tag in tags:
                self._leave(stack, i)
                return
            if tag in limit or tag in SCOPES:
                return

    def seen(self):
        """What the model sees of each element: a few values of few kinds."""
        n = len(self.tags)
        own, all_, linked = [0] * n, [0] * n, [0] * n
        for element, _, text in self.runs:
            own[element] += len(text.strip())
        for i in range(n - 1, -1, -1):
            all_[i] += own[i]
            if self.tags[i] == "a":
                linked[i] = all_[i]
            if i:
                all_[self.parents[i]] += all_[i]
                linked[self.parents[i]] += linked[i]
        return [(("name", _kind(names)), ("own", min(8, o.bit_length())),
                 ("links", 0 if not link else 1 + min(3, 4 * link // max(1, a))))
                for names, o, a, link in zip(self.names, own, all_, linked)]

    def pair_kinds(self):
        """Which table joins each element with its parent: that of its tag, or of what stands around an article."""
        return ["#around" if _kind(names) == "around" else tag for tag, names in zip(self.tags, self.names)]

    def labels(self, label_of=None):
        """1 inside a marked article, but for elements that never belong to one, by their tag or their names."""
        label_of = label_of or (lambda tag, names: 0 if tag in NEVER else 1 if tag in MARKED else 0 if _kind(names) == "around" else None)
        out = [0]
        for i in range(1, len(self.tags)):
            given = label_of(self.tags[i], self.names[i])
            out.append(out[self.parents[i]] if given is None else given)
        return out

    def hidden(self):
        """Whether each element is or lies in one that is never content. One that isn't closed ends at the next block."""
        out, open_ = [False], [False]
        for i in range(1, len(self.tags)):
            tag, up = self.tags[i], self.parents[i]
            within = out[up] and (not open_[up] or tag not in BLOCKS)
            here = tag in HIDDEN
            out.append(within or here)
            open_.append(open_[up] if within else here and i not in self.closed)
        return out

    def text(self, chosen) -> str:
        lines, block, parts = [], None, []
        for element, at, text in [*self.runs, (None, None, "")]:
            if at != block:
                line = " ".join(html.unescape("".join(parts)).split())
                if line:
                    lines.append(line)
                block, parts = at, []
            if element is not None and chosen[element]:
                parts.append(text)
        return "\n".join(lines)


def _kind(names: str) -> str:
    words = set(re.split(r"[^a-z]+", names)) if names else ()
    around, within = any(w in words for w in AROUND), any(w in words for w in WITHIN)
    return ("around" if around else "within" if within else "other" if names else "none")


# Pages labelled by hand: elements with data-label 1 or 0 start what has that label.
BY_HAND = ["""
<html><body><div class="header" data-label="0"><a href="/">Home</a><div class="menu"><ul><li><a href="/a">A</a></li><li><a
href="/b">B</a></li></ul></div></div><div class="content" data-label="1"><h1>A heading</h1><p>A paragraph of some length that
tells what the page is about.</p><p>And another, with <a href="/x">a link</a> in it, and <b>bold</b> text.</p><div class="ad"
data-label="0">Buy this now</div><blockquote>Quoted words of somebody.</blockquote><ul><li>An entry of a list in the
text</li></ul></div><div class="sidebar" data-label="0"><p>Related</p><a href="/y">More</a></div><div class="comments"
data-label="0"><h2>Comments</h2><p>A reader says that this is a fine page, at some length.</p></div><div class="cookie-notice"
data-label="0"><p>We use cookies.</p></div></body></html>""", """
<html><body><header data-label="0"><p>The Site</p><nav><a href="/">Start</a></nav></header><main data-label="1"><section><h2>A
title</h2><p>Text that belongs to the page.</p><div><p>More of the text in a plain division.</p></div><table><tr><td>A
cell</td><td>Another</td></tr></table></section><section class="comments" data-label="0"><div class="comment"><p>First! What a
long article this was.</p></div></section><aside data-label="0"><p>Aside from that.</p></aside><form data-label="0"><p>Your
mail</p></form></main><footer data-label="0"><p>All rights reserved</p></footer></body></html>""", """
<html><body><article data-label="1"><header data-label="1"><h1>Title in the article</h1></header><p>What it says.</p><div
class="share" data-label="0"><a href="/t">Share</a></div><figure><figcaption>A picture</figcaption></figure><div
class="newsletter" data-label="0"><p>Subscribe to our letter</p></div><div class="comments" data-label="0"><p>I disagree with
what is said here.</p></div><nav data-label="0"><a href="/n">Next</a></nav><aside data-label="0">By the way</aside><footer
data-label="0"><p>The site, its year and its address, and what else a footer says.</p></footer></article><div class="banner" data-label="0"><p>A notice</p></div></body></html>""", """
<html><body><ul class="menu" data-label="0"><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul><article
data-label="1"><h1>Shopping</h1><ul><li>milk</li><li>eggs and <a href="/b">bread</a></li></ul><ol><li><p>Go there.</p></li><li><a
href="/c">Come back.</a></li></ol><p><a href="/d">A paragraph that is one link</a></p><dl><dt>Term</dt><dd>What it means</dd></dl><table><tr><th>Head</th><td>7</td></tr></table><div
id="disqus_thread" data-label="0"><p>I disagree with this.</p></div><section id="comments" data-label="0"><ol><li><p>Me
too.</p></li></ol></section><div class="cookie-banner" data-label="0"><p>We use cookies.</p></div><nav data-label="0"><a href="/p">Previous</a></nav><aside data-label="0"><p>Aside.</p></aside><form
data-label="0"><label>Mail</label></form><footer data-label="0">All rights reserved</footer></article></body></html>""", """
<html><body><div id="nav" data-label="0"><ul><li><a href="/1">Eins</a></li></ul></div><div class="article" data-label="1"><h1>Titel</h1><p>Ein
Absatz.</p><ul><li>Ein Punkt</li></ul><div class="kommentare" data-label="0"><h2>Kommentare</h2><ul><li>Das sehe ich
anders.</li></ul></div></div><div class="footer" data-label="0"><ul><li><a href="/i">Impressum</a></li></ul></div></body></html>"""]


def _hand_labelled(source):
    """The page, and its labels read from data-label."""
    page = Page(re.sub(r'\s*data-label="([01])"', "", source))
    marks = []
    for token in TOKEN.finditer(source):
        if token.group("tag") and not token.group("end") and token.group("tag").lower() not in VOID:
            found = re.search(r'data-label="([01])"', token.group("attrs"))
            marks.append(int(found.group(1)) if found else None)
    labels = [0]
    for i, mark in enumerate(marks, 1):
        labels.append(labels[page.parents[i]] if mark is None else mark)
    return page, labels


@dataclasses.dataclass
class Model:
    """Logs: root[label], child[pair kind][parent label][label], any for other pair kinds, seen[(kind, value)] = (label 0, label 1)."""
    root: tuple
    child: dict
    any: tuple
    seen: dict
    unseen: dict

    def marginals(self, page: Page) -> list[float]:
        """Probability of each element to be content, by sum-product messages up and down the tree."""
        n, joins = len(page.tags), [self.child.get(kind, self.any) for kind in page.pair_kinds()]
        up0, up1 = [0.0] * n, [0.0] * n
        for i, values in enumerate(page.seen()):
            for value in values:
                a, b = self.seen.get(value) or self.unseen[value[0]]
                up0[i] += a
                up1[i] += b
        send0, send1 = [0.0] * n, [0.0] * n
        for i in range(n - 1, 0, -1):       # a parent stands before its children
            c0, c1 = joins[i]
            send0[i], send1[i] = _add(c0[0] + up0[i], c0[1] + up1[i]), _add(c1[0] + up0[i], c1[1] + up1[i])
            p = page.parents[i]
            up0[p] += send0[i]
            up1[p] += send1[i]
        down0, down1, out = [self.root[0]] * n, [self.root[1]] * n, []
        for i in range(n):
            if i:
                p, (c0, c1) = page.parents[i], joins[i]
                rest0, rest1 = down0[p] + up0[p] - send0[i], down1[p] + up1[p] - send1[i]
                down0[i], down1[i] = _add(rest0 + c0[0], rest1 + c1[0]), _add(rest0 + c0[1], rest1 + c1[1])
            x = down0[i] + up0[i] - down1[i] - up1[i]
            out.append(1 / (1 + math.exp(min(x, 700))))
        return out

    def main_text(self, source: str) -> str:
        page = Page(source)
        return page.text([m > 0.5 and not h for m, h in zip(self.marginals(page), page.hidden())])


def _add(a, b):
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def fit(pages) -> Model:
    """Tables by counting, one added to each, those of a pair kind on top of a few counts of all; ``pages`` are (page, labels, weight)."""
    labels, moves, by_kind, seen = Counter(), Counter(), Counter(), Counter()
    for page, given, weight in pages:
        for i, (values, kind) in enumerate(zip(page.seen(), page.pair_kinds())):
            labels[given[i]] += weight
            if i:
                moves[given[page.parents[i]], given[i]] += weight
                by_kind[kind, given[page.parents[i]], given[i]] += weight
            for value in values:
                seen[value, given[i]] += weight
    kinds = Counter(kind for kind, _ in {value for value, _ in seen})

    def log(n, of, kinds_):
        return math.log((n + 1) / (of + kinds_ + 1))
    table_ = {value: tuple(log(seen[value, y], labels[y], kinds[value[0]]) for y in (0, 1)) for value, _ in seen}
    rare = {kind: tuple(log(0, labels[y], n) for y in (0, 1)) for kind, n in kinds.items()}
    unseen = {kind: rare.get(kind, (0.0, 0.0)) for kind in ("name", "own", "links")}
    # a value never seen says nothing by itself: the classes differ in size only
    unseen = {kind: (max(v), max(v)) for kind, v in unseen.items()}
    share = [[(moves[x, y] + 1) / (moves[x, 0] + moves[x, 1] + 2) for y in (0, 1)] for x in (0, 1)]

    def table_of(kind):
        return tuple(tuple(math.log((by_kind[kind, x, y] + PRIOR * share[x][y]) / (by_kind[kind, x, 0] + by_kind[kind, x, 1] + PRIOR))
                           for y in (0, 1)) for x in (0, 1))
    child = {kind: table_of(kind) for kind in {k for k, _, _ in by_kind}}
    any_ = tuple(tuple(math.log(v) for v in row) for row in share)
    return Model((math.log(0.99), math.log(0.01)), child, any_, table_, unseen)


def learn(pages: DataFrame, sample: int = SAMPLE_PAGES, max_bytes: int = SAMPLE_BYTES) -> Model:
    """Learns from pages that mark their article: those with the smallest hashes, ``sample`` at most, and by hand."""
    marked = pages.select(utf8("html").alias("t")).where(
        (F.octet_length("t") <= max_bytes) & F.col("t").cast("string").rlike("(?i)<(article|main)\\b")).select(
        F.xxhash64("t").alias("h"), "t")
    # hashes first: a task that sorts whole pages would send its own ``sample`` of them to the driver
    chosen = [r["h"] for r in marked.select("h").distinct().orderBy("h").limit(sample).collect()]
    rows = marked.where(F.col("h") <= (chosen[-1] if chosen else 0)).groupBy("h").agg(F.min("t").alias("t")).orderBy(
        "h").limit(sample).collect()
    own = [Page(bytes(r["t"]).decode("utf-8", "replace")) for r in rows]
    return fit([(p, p.labels(), 1) for p in own] + [(*_hand_labelled(x), HAND_WEIGHT) for x in BY_HAND])


def main_texts(pages: DataFrame, model: Model = None) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(page_id, url, text, n_chars)``, one row per row of ``pages``.

    Null, empty and text-free pages have an empty text. Broken markup is read as far as it goes; an element that isn't
    closed ends with the page. An empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    model = model or learn(pages)

    @F.arrow_udf("string")
    def extract(batch: pa.Array) -> pa.Array:
        known = {}
        for source in batch.to_pylist():
            if source not in known:
                known[source] = model.main_text(source.decode("utf-8", "replace"))
        return pa.array([known[s] for s in batch.to_pylist()], pa.string())
    return pages.select("page_id", "url", extract(utf8("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def op8_main_text(spark, sf_dir):
    return main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
