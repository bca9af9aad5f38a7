"""Main text of web pages by a maximum-scoring subsequence of their words and tags.

A page is a sequence of words and tags. Words score positive and tags negative, and the contiguous region of the
largest sum, found by one linear scan, is the main text. How much a word or tag scores depends on the elements that
are open around it: names of elements and words of their classes, ids and roles. Those weights are learned from
labelled pages, which are pages that mark their main part themselves by an article or main element, as a logistic
model whose prior says what such names usually mean. A region that still holds foreign parts (a form or a notice
inside the article) loses them: what stands in a context that scores negative is never text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import small_batches, steps

#: Labelled pages that training reads at most, and the code points of the longest of them.
SAMPLE_PAGES, SAMPLE_CHARS = 1000, 1 << 18
#: Names of the model at most, those of most pages first, and how often the sample counts against the prior.
NAMES, EVIDENCE = 500, 1000.0
#: What any tag costs, and what a run of foreign words and tags costs at most.
LEAST_COST, BREAK = 0.001, 5.0

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody tfoot thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is no markup.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: An open element that a new one of these names ends, up to the nearest of the elements behind.
_ENDS = {name: (("p",), ("table", "td", "th", "caption", "button", "object")) for name in _BLOCKS - {"body", "head", "html"}}
_ENDS |= {
    "li": (("li", "p"), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd", "p"), ("dl",)),
    "dd": (("dt", "dd", "p"), ("dl",)),
    "tr": (("tr", "td", "th", "p"), ("table",)),
    "td": (("td", "th", "p"), ("tr", "table")),
    "th": (("td", "th", "p"), ("tr", "table")),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "body": (("head",), ("html",)),
}

_FOREIGN = (
    "t:nav t:aside t:footer t:header t:form t:button t:select t:menu t:dialog t:script t:style t:noscript t:template t:iframe "
    "t:svg t:object t:head t:title t:textarea t:label t:datalist t:noembed t:noframes "
    "w:nav w:navbar w:navigation w:menu w:menubar w:breadcrumb w:breadcrumbs w:footer w:header w:masthead w:banner w:sidebar w:aside "
    "w:complementary w:contentinfo w:notice w:alert w:cookie w:cookies w:consent w:gdpr w:popup w:modal w:overlay w:dialog "
    "w:ad w:ads w:advert w:adverts w:advertisement w:advertising w:adsense w:sponsor w:sponsored w:promo w:promotion w:promoted "
    "w:comment w:comments w:reply w:replies w:disqus w:respond w:discussion w:form w:search w:login w:signup w:newsletter "
    "w:subscribe w:subscription w:share w:sharing w:social w:related w:recommended w:recommendations w:widget w:widgets "
    "w:pagination w:pager w:toolbar w:tags w:copyright"
).split()
_OWN = "t:article t:main w:article w:articlebody w:main w:content w:story w:entry w:post w:body w:text".split()
#: Prior weights of names in the log odds of a word being main text; "outside" is a word beside a marked main part.
PRIOR = dict.fromkeys(_FOREIGN, -8.0) | dict.fromkeys(_OWN, 1.0) | {"outside": -4.0, "t:a": -1.0}
PRIOR_BIAS = 1.0
_STRONG = -2.0
#: Classes of articles that are no main part, and beginnings of classes that only say what a part comes with.
_NOT_MAIN = frozenset("w:comment w:comments w:reply w:related w:sidebar w:promo w:sponsored w:ad w:widget".split())
_WITH = ("has-", "with-", "no-", "without-", "is-")
#: Prior share of tags outside the main text.
_TEXT_TAGS = frozenset("p br b i em strong h1 h2 h3 h4 h5 h6 blockquote pre code q cite sub sup u s mark small span".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=]+)(?:\s*=\s*("|'|[^\s>"'][^\s>]*)?)?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_NAMING = frozenset(("class", "id", "role", "itemprop"))

TEXT, OPEN, CLOSE = 0, 1, 2


def _attributes(page: str, at: int, missing: set[str]) -> tuple[int, list[str]]:
    """Where a tag ends, and the values of its naming attributes. A quote that is never closed is no quote."""
    values = []
    while (found := _ATTRIBUTE.match(page, at)) and found.end() > at:
        name, value, at = found[1].lower(), found[2], found.end()
        if value in ('"', "'"):
            end = -1 if value in missing else page.find(value, at)
            if end < 0:
                missing.add(value)
                continue
            value, at = page[at:end], end + 1
        if value and name in _NAMING:
            values.append(value)
    end = page.find(">", at)
    return (len(page) if end < 0 else end + 1), values


def events(page: str) -> Iterator[tuple[int, str, int, int, list[str]]]:
    """(kind, name, start, end, values) of every text and tag; comments, declarations and raw insides are left out."""
    at, n, missing = 0, len(page), set()
    pending = 0
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            break
        after = page[lt + 1 : lt + 2]
        if after in ("!", "?") or after == "/" or (after.isascii() and after.isalpha()):
            if lt > pending:
                yield TEXT, "", pending, lt, []
        else:
            at = lt + 1
            continue
        if after in ("!", "?"):
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
        elif after == "/":
            name = _NAME.match(page, lt + 2)
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            if name:
                yield CLOSE, name[0].lower(), lt, at, []
        else:
            name = _NAME.match(page, lt + 1)
            at, values = _attributes(page, name.end(), missing)
            tag = name[0].lower()
            yield OPEN, tag, lt, at, values
            if tag in _RAW:
                end = re.compile(f"</{re.escape(tag)}(?![a-z0-9])", re.I).search(page, at)
                at = end.start() if end else n
        pending = at
    if pending < n:
        yield TEXT, "", pending, n, []


def _names(tag: str, values: list[str], within: bool) -> list[str]:
    """What the model sees of an element. The header of an article holds its title: that is no page header."""
    words: set[str] = set()
    # What a page as a whole is called, or what a part comes with, says nothing about its text.
    if values and tag not in ("html", "body"):
        words = {f"w:{w.lower()}" for v in values for one in v.split() if not one.startswith(_WITH) for w in _WORDS.findall(one)}
    if tag in ("article", "main"):
        words &= _NOT_MAIN
    return [f"t:{'inner-' if within and tag == 'header' else ''}{tag}", *sorted(words)]


def _marks_main(tag: str, names: list[str]) -> bool:
    """Whether an element marks the main part; reader comments and teasers are often articles too."""
    return tag in ("article", "main") and not any(PRIOR.get(n, 0) <= _STRONG for n in names)


@dataclass
class Weights:
    """Log odds of each name, and for each tag the share that stands outside of main text."""

    bias: float = PRIOR_BIAS
    names: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    tags: dict[str, float] = field(default_factory=dict)

    def outside(self, tag: str) -> float:
        return self.tags.get(tag, 0.1 if tag in _TEXT_TAGS else 0.5)


class Walk:
    """Goes through a page and keeps which names are open, and the log odds that they give a word."""

    def __init__(self, page: str, weights: Weights):
        self.page, self.weights = page, weights
        self.events = list(events(page))
        self.marked = any(kind == OPEN and _marks_main(name, _names(name, values, False)) for kind, name, _, _, values in self.events)
        self.stack: list[tuple[str, list[str], bool]] = []
        self.tags: Counter[str] = Counter()
        self.open: Counter[str] = Counter()
        self.logit, self.mains, self.foreign = weights.bias, 0, 0
        if self.marked:
            self._add("outside")

    def _add(self, name: str) -> None:
        self.open[name] += 1
        if self.open[name] == 1:
            self.logit += self.weights.names.get(name, 0.0)
            self.foreign += PRIOR.get(name, 0) <= _STRONG and name != "outside"

    def _remove(self, name: str) -> None:
        self.open[name] -= 1
        if not self.open[name]:
            del self.open[name]
            self.logit -= self.weights.names.get(name, 0.0)
            self.foreign -= PRIOR.get(name, 0) <= _STRONG and name != "outside"

    def _push(self, tag: str, values: list[str]) -> None:
        names = _names(tag, values, self.mains > 0)
        main = _marks_main(tag, names)
        self.stack.append((tag, names, main))
        self.tags[tag] += 1
        if main:
            self.mains += 1
            if self.mains == 1:
                self._remove("outside")
        for name in names:
            self._add(name)

    def _pop(self) -> str:
        tag, names, main = self.stack.pop()
        self.tags[tag] -= 1
        for name in names:
            self._remove(name)
        if main:
            self.mains -= 1
            if not self.mains:
                self._add("outside")
        return tag

    def _end_before(self, tag: str) -> None:
        """End what a new element ends without a tag of its own, as a paragraph before the next."""
        if tag not in _ENDS:
            return
        ended, scope = _ENDS[tag]
        if not any(self.tags[t] for t in ended):
            return
        last = None
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in scope:
                break
            if self.stack[k][0] in ended:
                last = k
        if last is not None:
            while len(self.stack) > last:
                self._pop()

    def _close(self, tag: str) -> None:
        """End an element and all inside it; a tag of text markup does not reach beyond its block."""
        if not self.tags[tag]:
            return
        if tag not in _BLOCKS:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == tag:
                    break
                if self.stack[k][0] in _BLOCKS:
                    return
        while self._pop() != tag:
            pass

    def __iter__(self) -> Iterator[tuple[int, str, int, int]]:
        """Every event, with the state as it is for that text or tag: a tag counts with the outer elements."""
        for kind, name, start, end, values in self.events:
            if kind == OPEN:
                self._end_before(name)
                yield kind, name, start, end
                if name not in _VOID:
                    self._push(name, values)
            elif kind == CLOSE:
                self._close(name)
                yield kind, name, start, end
            else:
                yield kind, name, start, end


def observe(page: str) -> tuple[Counter, Counter]:
    """Of a page that marks its main part: words by (names, inside), and tags by (tag, inside)."""
    words: Counter[tuple[str, bool]] = Counter()
    tags: Counter[tuple[str, bool]] = Counter()
    walk = Walk(page, Weights())
    if walk.marked:
        for kind, name, start, end in walk:
            inside = walk.mains > 0 and not walk.foreign
            if kind != TEXT:
                tags[name, inside] += 1
            elif n := len(page[start:end].split()):
                words["\n".join(sorted(walk.open)), inside] += n
    return words, tags


def _fit(contexts: list[tuple[list[str], float, float]]) -> tuple[float, dict[str, float]]:
    """The weights of names from (names, words inside, words outside), by Newton's method around the prior.

    Half of the evidence comes without the marks of the main part, so that the other names carry weight of their own
    where pages have no such marks.
    """
    marks = {"outside", "t:article", "t:main"}
    rows = [(frozenset(names), a, b) for names, a, b in contexts] + [(frozenset(names) - marks, a, b) for names, a, b in contexts]
    support: Counter[str] = Counter()
    for names, a, b in rows:
        support.update(dict.fromkeys(names, a + b))
    names = sorted({n for n, _ in sorted(support.items(), key=lambda x: (-x[1], x[0]))[:NAMES]} | (set(PRIOR) & set(support)))
    place = {n: k + 1 for k, n in enumerate(names)}
    prior = np.array([PRIOR_BIAS, *(PRIOR.get(n, 0.0) for n in names)])
    x = np.zeros((len(rows), len(prior)))
    x[:, 0] = 1
    for k, (own, _, _) in enumerate(rows):
        for n in own:
            if n in place:
                x[k, place[n]] = 1
    inside, total = np.array([a for _, a, _ in rows], float), np.array([a + b for _, a, b in rows], float)
    scale = EVIDENCE / max(total.sum(), 1)
    inside, total = inside * scale, total * scale
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (inside - total * p) - (w - prior)
        step = np.linalg.solve((x.T * (total * p * (1 - p))) @ x + np.eye(len(w)), gradient)
        # Long steps of the first rounds are shortened; the function is concave.
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-6:
            break
    learned = dict(PRIOR) | dict(zip(names, w[1:].tolist(), strict=True))
    return float(w[0]), learned


def train(pages: DataFrame) -> Weights:
    """Weights from a sample of the pages that mark their main part; the prior alone where there are none.

    The sample are the ``SAMPLE_PAGES`` different pages of the smallest hashes among those of ``SAMPLE_CHARS`` code
    points at most.
    """
    small_batches(pages.sparkSession)
    page = F.col("html").cast("string")
    marked = pages.select(page.alias("html")).where((F.length("html") <= SAMPLE_CHARS) & F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    marked = marked.withColumn("digest", F.xxhash64("html"))
    chosen = marked.select("digest").distinct().orderBy("digest").limit(SAMPLE_PAGES)
    sample = marked.join(F.broadcast(chosen), "digest").dropDuplicates(["digest"]).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[tuple[str, bool]] = Counter()
        tags: Counter[tuple[str, bool]] = Counter()
        for batch in batches:
            for one in batch.column("html"):
                own, others = observe(one.as_py())
                words.update(own)
                tags.update(others)
        rows = [("word", key, inside, n) for (key, inside), n in words.items()] + [("tag", key, inside, n) for (key, inside), n in tags.items()]
        kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64())
        columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "key", "inside", "n"])

    seen = sample.mapInArrow(run, "kind string, key string, inside boolean, n long").groupBy("kind", "key", "inside").agg(F.sum("n").alias("n"))
    found: dict[str, dict[str, list[float]]] = {"word": {}, "tag": {}}
    for row in seen.collect():
        found[row["kind"]].setdefault(row["key"], [0.0, 0.0])[not row["inside"]] += row["n"]
    weights = Weights()
    if found["word"]:
        contexts = [(key.split("\n") if key else [], a, b) for key, (a, b) in sorted(found["word"].items())]
        weights.bias, weights.names = _fit(contexts)
    weights.tags = {tag: (b + 2 * weights.outside(tag)) / (a + b + 2) for tag, (a, b) in found["tag"].items()}
    return weights


def best_region(scores: list[float]) -> tuple[int, int] | None:
    """The contiguous run of the largest positive sum, the first of equal ones, as [start, end)."""
    best, region, total, start = 0.0, None, 0.0, 0
    for k, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, region = total, (start, k + 1)
    return region


def main_text(page: str, weights: Weights) -> tuple[str, int | None, int | None]:
    """The main text, and where its region starts and ends in the page (code points)."""
    walk = Walk(page, weights)
    # Each part is text to keep, the end of a block, a blank, or nothing.
    scores: list[float] = []
    parts: list[tuple[int, int, str]] = []
    gap = 0.0
    for kind, name, start, end in walk:
        own = walk.logit > 0
        chance = 1 / (1 + math.exp(-max(-30.0, min(30.0, walk.logit))))
        if kind == TEXT:
            score = len(page[start:end].split()) * (2 * chance - 1)
            what = "text" if own else ""
        else:
            score = -(LEAST_COST + (1 - chance) * weights.outside(name))
            what = "block" if name in _BLOCKS else "blank" if name in ("br", "td", "th") else ""
        if own:
            gap = 0.0
        else:
            # A foreign part costs no more than BREAK, however long it is, and within a marked main part next to nothing.
            taken = max(score, min(0.0, (-LEAST_COST if walk.mains else -BREAK) - gap))
            gap, score = gap + taken, taken
        scores.append(score)
        parts.append((start, end, what))
    region = best_region(scores)
    if region is None:
        return "", None, None
    blocks, held = [], []

    def flush() -> None:
        block = " ".join("".join(held).split())
        if block:
            blocks.append(block)
        held.clear()

    for start, end, what in parts[region[0] : region[1]]:
        if what == "text":
            held.append(entities.unescape(page[start:end]))
        elif what == "block":
            flush()
        elif what == "blank":
            held.append(" ")
    flush()
    return "\n".join(blocks), parts[region[0]][0], parts[region[1] - 1][1]


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Every row: (page_id, url, text, n_chars, start, end), the main text and its region in the html.

    ``weights`` are learned from the pages themselves if not given. Character references are decoded, white space
    within a block is one blank, blocks are joined by line breaks. A null or empty page, or one without any word that
    scores positive, has an empty text and no region. Null ids and urls stay null; a repeated row gives its result
    again; an empty table gives no rows; other columns are ignored. Pages are read whole, whatever their length.
    """
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(train(pages) if weights is None else weights)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            found = [main_text(page.as_py(), shared.value) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array([t for t, _, _ in found], pa.string()),
                    pa.array([len(t) for t, _, _ in found], pa.int64()),
                    pa.array([a for _, a, _ in found], pa.int64()),
                    pa.array([b for _, _, b in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "start", "end"],
            )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, start long, end long")
