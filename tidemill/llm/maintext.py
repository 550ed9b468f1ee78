"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score 1 each, tags a negative weight by
name and first class word; one linear scan finds the contiguous region with the greatest
sum. The weights are learnt from pages that mark their own article: they begin with the
share of a tag's places outside of articles, and a structured perceptron makes the tags
dearer or cheaper on which the best region differs from the article.

Elements within a region may be clutter. What share of the words in elements of a name
(class, id and role words, or the tag if it has none) belongs to articles is learnt from the same
pages; names not seen there start from ``PRIOR``. Elements of a low share are cut: their words
score nothing and are no text. But a name is only evidence: where a cut element holds many
times the words of the best region without it, it is opened again, and the page is scanned
anew. Only what the language itself says is no text is left out for certain.

``SAMPLE`` and ``LARGEST`` bound the pages that all this is learnt from, at every size of the
table.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import append, schema_with, texts_of

SAMPLE, LARGEST, ROUNDS = 300, 256 << 10, 6
WORD, OFF, TAG, INLINE, LEAST, FIRST = 1.0, 0.0, -1.0, -0.25, -0.01, -3.0
# A word of a cut element weighs so much when the element is compared with the region: if its name
# says what it is, or if that is part of a longer name.
NAMED, PARTLY = 0.1, 0.5
LOW, SEEN = 0.1, 3  # share of words in articles below which names are cut; pages that tell it

# Elements by what the language says of their content.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template")
NO_TEXT = frozenset("head svg math object canvas audio video select datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open element that a new one of these names ends, up to the element that bounds it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
}
WHOLE = frozenset("html body main article".split())
# Where learning starts: tags and words of names that mostly stand for what is no article. A header is
# one only outside of an article.
PRIOR = frozenset(
    "nav footer header aside form menu dialog button ad ads adv advert adverts advertisement advertising sponsor "
    "sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices notification alert "
    "disclaimer popup modal overlay sidebar sidenav widget widgets navbar navigation breadcrumb breadcrumbs "
    "pagination pager toolbar masthead topbar comment comments commentlist disqus respond replies reply discussion "
    "related recommended share sharing social newsletter subscribe subscription signup login search complementary "
    "contentinfo".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/]?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|<[!?/]?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)|[^<]+|<",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_HINT = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s>=/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


@dataclass
class Model:
    """Weights of tags, and the share of words in articles by the names of elements."""

    weights: dict[str, float] = field(default_factory=dict)
    shares: dict[str, float] = field(default_factory=dict)

    def clutter(self, tag: str, names: tuple[str, ...], within: bool) -> float:
        """0 for what is taken for text, or how much a word of the element weighs."""
        found = 0.0
        for name in names or (tag,):
            parts = [x for x in _SPLIT.split(name) if x]
            if name in self.shares:
                suspect = self.shares[name] < LOW
            elif not names:
                suspect = tag in PRIOR and not (tag == "header" and within)
            else:
                suspect = not PRIOR.isdisjoint(parts)
            if suspect:
                found = max(found, NAMED if len(parts) < 2 or name in self.shares else PARTLY)
        if not names or found:
            return 0.0 if tag in WHOLE and found != NAMED else found
        # A tag that stands for clutter does so whatever it is called.
        return self.clutter(tag, (), within)


class Page:
    """The words and tags of a page in order.

    kinds: 0 a word, 1 a tag or word that is no text for certain, 2 and up a tag, by ``names``.
    at: the block of each. of: its element, by number; ``above`` has each element's parent.
    """

    def __init__(self, text: str) -> None:
        self.kinds: list[int] = []
        self.names: dict[str, int] = {}
        self.pieces: list[list[str]] = [[]]  # the text of each block
        self.at: list[int] = []
        self.of: list[int] = []
        self.inside: list[bool] = []  # within an article element
        self.articles = 0
        # Elements: the parent, tag, names, whether within an article or main.
        self.above, self.elements = [-1], [("", (), False)]
        stack: list[tuple[str, int, bool]] = []
        open_: Counter[str] = Counter()
        shut = 0
        raw_end: re.Pattern | None = None
        pos, n = 0, len(text)

        def pop() -> None:
            nonlocal shut
            tag, _, off = stack.pop()
            open_[tag] -= 1
            shut -= off

        def token_of(label: str) -> None:
            self.kinds.append(1 if shut else self.names.setdefault(label, len(self.names) + 2))
            self.at.append(len(self.pieces) - 1)
            self.of.append(stack[-1][1] if stack else 0)
            self.inside.append(open_["article"] > 0)

        while pos < n:
            if raw_end:
                found = raw_end.search(text, pos)
                pos, raw_end = (found.start() if found else n), None
                continue
            match = _TOKEN.match(text, pos)
            token, pos = match.group(), match.end()
            name = _NAME.match(token)
            if token[0] != "<" or token == "<":
                decoded = html_lib.unescape(token)
                if not shut:
                    self.pieces[-1].append(decoded)
                k = len(decoded.split())
                self.kinds += [int(shut > 0)] * k
                self.at += [len(self.pieces) - 1] * k
                self.of += [stack[-1][1] if stack else 0] * k
                self.inside += [open_["article"] > 0] * k
                continue
            if token.startswith("<![CDATA[") or not name:
                continue
            tag = name.group(1).lower()
            if tag in BLOCK:
                self.pieces.append([])
            if token[1] == "/":
                self._close(tag, stack, open_, pop)
                token_of(f"/{tag}")
                continue
            self._imply(tag, stack, open_, pop)
            names, hint = self._hints(token)
            token_of(f"{tag}.{hint}" if hint else tag)
            raw = tag in RAW
            if raw:
                raw_end = re.compile(f"</{tag}(?=[\\s/>])|</{tag}\\Z", re.I)
            if raw or tag not in VOID and not token.endswith("/>"):
                off = raw or tag in NO_TEXT or bool(_HIDDEN.search(token))
                self.articles += tag == "article" and not open_["article"]
                self.above.append(stack[-1][1] if stack else 0)
                self.elements.append((tag, names, open_["article"] + open_["main"] > 0))
                stack.append((tag, len(self.above) - 1, off))
                open_[tag] += 1
                shut += off

    @staticmethod
    def _close(tag: str, stack: list, open_: Counter, pop) -> None:
        """An end tag ends its element and what is open within; one of a phrase ends no block."""
        if open_[tag] <= 0:
            return
        if tag in BLOCK:
            while stack[-1][0] != tag:
                pop()
            pop()
            return
        depth = len(stack) - 1
        while stack[depth][0] != tag and stack[depth][0] not in BLOCK:
            depth -= 1
        if stack[depth][0] == tag:
            while len(stack) > depth:
                pop()
        else:
            open_[tag] = 0  # it stays open to the end of its block

    @staticmethod
    def _imply(tag: str, stack: list, open_: Counter, pop) -> None:
        """End tags that may be left out."""
        if tag in BLOCK and open_["p"] > 0:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] not in BLOCK:
                depth -= 1
            if depth >= 0 and stack[depth][0] == "p":
                while len(stack) > depth:
                    pop()
        if tag in ENDS:
            ended, bounds = ENDS[tag]
            while any(open_[x] > 0 for x in ended):
                depth = len(stack) - 1
                while stack[depth][0] not in ended and stack[depth][0] not in bounds and stack[depth][0] not in BLOCK:
                    depth -= 1
                if stack[depth][0] not in ended:
                    return
                while len(stack) > depth:
                    pop()

    @staticmethod
    def _hints(token: str) -> tuple[tuple[str, ...], str]:
        """Words of class, id and role, and the first of class."""
        names, first = [], ""
        for kind, *values in _HINT.findall(token):
            words = next((v for v in values if v), "").lower().split()
            if kind.lower() == "class" and words and not first:
                first = words[0]
            names += words
        return tuple(names), first

    def cuts(self, model: Model) -> np.ndarray:
        """How much a word weighs of each element that is cut, 0 for others."""
        return np.array([model.clutter(*e) for e in self.elements])

    def roots(self, cut: np.ndarray) -> np.ndarray:
        """The outermost cut element that each lies in, -1 for none."""
        root = [-1] * len(cut)
        for e in range(1, len(cut)):
            over = root[self.above[e]]
            root[e] = over if over >= 0 else e if cut[e] else -1
        return np.array(root)

    def scores(self, model: Model, off: np.ndarray) -> np.ndarray:
        """Unknown tags with a class count as those without, others as any of their kind."""
        table = np.empty(len(self.names) + 2)
        table[:2] = WORD, OFF
        for label, i in self.names.items():
            plain = label.partition(".")[0]
            table[i] = model.weights.get(label, model.weights.get(plain, TAG if plain.strip("/") in BLOCK else INLINE))
        scores = table[np.array(self.kinds, np.int64)]
        scores[off] = OFF
        return scores

    def region(self, model: Model) -> tuple[int, int, np.ndarray]:
        """The best region, and which of the tokens are cut."""
        cut, of, word = self.cuts(model), np.array(self.of, np.int64), np.array(self.kinds) == 0
        while True:
            root = self.roots(cut)
            off = root[of] >= 0 if len(of) else np.zeros(0, bool)
            scores = self.scores(model, off)
            low, high = best_region(scores)
            held = np.bincount(root[of][off & word], minlength=len(cut)) * cut if len(of) else np.zeros(1)
            largest = int(held.argmax())
            if held[largest] <= max(scores[low:high].sum(), 0):
                return low, high, off
            cut[largest] = 0.0

    def text(self, model: Model) -> str:
        """The blocks that hold a word of the best region, each whole."""
        low, high, off = self.region(model)
        blocks = dict.fromkeys(self.at[i] for i in range(low, high) if self.kinds[i] == 0 and not off[i])
        lines = (" ".join("".join(self.pieces[b]).split()) for b in blocks)
        return "\n".join(line for line in lines if line)


def best_region(scores: np.ndarray) -> tuple[int, int]:
    """The contiguous run with the greatest sum, of several the one that ends last; an
    empty one if no sum is positive."""
    if not len(scores):
        return 0, 0
    sums = np.r_[0.0, np.cumsum(scores)]
    gain = sums - np.minimum.accumulate(sums)
    high = len(gain) - 1 - int(np.argmax(gain[::-1]))
    if gain[high] <= 0:
        return 0, 0
    return int(np.argmin(sums[: high + 1])), high


def learn(pages: list[Page]) -> Model:
    """Shares of names and weights of tags from pages that mark one article; weights are
    averaged over all steps."""
    pages = [p for p in pages if p.articles == 1 and any(k == 0 and i for k, i in zip(p.kinds, p.inside))]
    model = Model()
    told: dict[str, list[int]] = {}  # name: pages, words, words in an article
    for page in pages:
        of = np.array(page.of)
        word, inside = np.array(page.kinds) == 0, np.array(page.inside)
        every = np.bincount(of[word], minlength=len(page.above))
        within = np.bincount(of[word & inside], minlength=len(page.above))
        for e in range(len(page.above) - 1, 0, -1):  # children come after their parents
            every[page.above[e]] += every[e]
            within[page.above[e]] += within[e]
        seen: dict[str, list[int]] = {}
        for e in range(1, len(page.above)):
            (tag, names, _), n, m = page.elements[e], every[e], within[e]
            # What holds the article and more tells nothing, nor does what lies in a menu.
            if n and tag not in WHOLE and (m == n or not m and within[page.above[e]]):
                for name in names or (tag,):
                    count = seen.setdefault(name, [0, 0])
                    count[0] += n
                    count[1] += m
        for name, (n, m) in seen.items():
            count = told.setdefault(name, [0, 0, 0])
            count[0], count[1], count[2] = count[0] + 1, count[1] + n, count[2] + m
    model.shares = {name: m / n for name, (k, n, m) in told.items() if k >= SEEN}

    at: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for page in pages:
        kinds, out = np.array(page.kinds), ~np.array(page.inside)
        open_ = page.roots(page.cuts(model))[np.array(page.of)] < 0  # tags of what is cut score nothing
        every = np.bincount(kinds[open_], minlength=len(page.names) + 2)
        away = np.bincount(kinds[out & open_], minlength=len(every))
        at.update({label: int(every[i]) for label, i in page.names.items() if every[i]})
        outside.update({label: int(away[i]) for label, i in page.names.items()})
    weights = model.weights
    weights.update({label: min(LEAST, FIRST * outside[label] / n) for label, n in at.items() if n})
    total: Counter[str] = Counter()
    steps = 0
    for _ in range(ROUNDS):
        for page in pages:
            low, high, off = page.region(model)
            got = np.zeros(len(page.kinds), bool)
            got[low:high] = True
            edge = np.flatnonzero(page.inside)
            true = np.zeros(len(got), bool)
            true[edge[0] : edge[-1] + 1] = True
            kinds = np.array(page.kinds)
            if ((kinds == 0) & ~off & (got != true)).any():
                sign = (true.astype(int) - got.astype(int)) * ~off
                moves = np.bincount(kinds, weights=sign, minlength=len(page.names) + 2)
                for label, i in page.names.items():
                    if moves[i]:
                        weights[label] = min(LEAST, weights.get(label, TAG) + float(np.sign(moves[i])))
            steps += 1
            total.update(weights)
    return Model({label: min(LEAST, value / steps) for label, value in total.items()}, model.shares)


def train(pages: DataFrame, key: str = "page_id", html: str = "html") -> Model:
    """A model from the pages of at most ``SAMPLE`` keys with an article element and up to
    ``LARGEST`` bytes, those with the smallest hashes (twice as many pages at most if keys
    repeat); an empty one if there are no such pages. Rows with a null key are not learnt from."""
    marked = pages.where(
        F.lower(html).contains("<article") & F.col(key).isNotNull() & (F.octet_length(html) <= LARGEST)
    )
    # The keys first: no task sends whole pages that are not chosen.
    chosen = marked.select(F.col(key).alias("_chosen")).orderBy(F.xxhash64("_chosen"), "_chosen").limit(SAMPLE)
    rows = marked.join(F.broadcast(chosen.distinct()), F.col(key) == F.col("_chosen")).select(html)
    return learn([Page(row[0]) for row in rows.limit(2 * SAMPLE).collect()])


def extract_main_text(
    df: DataFrame, model: Model, html: str = "html", out: str = "text"
) -> DataFrame:
    """``df`` with the main text of ``html``; empty for null and empty pages and those
    without text. A column already named ``out`` is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source in texts_of(batch.column(html)):
                texts.append(Page(source).text(model))
            yield append(batch, **{out: pa.array(texts, pa.string())})

    return df.mapInArrow(run, schema_with(df, (out, T.StringType())))
