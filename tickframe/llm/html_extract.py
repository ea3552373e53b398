"""Main text of web pages by a linear-chain conditional random field.

Pages are cut into the leaf blocks of their element tree.  Each block has
features of its ancestors (tags, the innermost landmark, words in class, id and
role) and of its text (length, links, punctuation, place on the page).  A chain
over a page's blocks with the labels boilerplate and main text scores blocks
and transitions; weights maximise the likelihood of labelled pages, with
gradients from the forward-backward recursions summed in each partition and
then over partitions; decoding is Viterbi.

Labels come with the pages or, for pages whose markup says it, from
``markup_labels``: pages with one ``article`` or ``main`` element tell their
main text; in a part of them (by hash) that landmark is hidden from the
features, so the chain also learns pages that lack it.  The fit takes at most
``MAX_TRAIN`` labelled pages (picked by hash of the id); every page is decoded
over its whole html.

Text: character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one space.  Scripts, styles and
comments are no text; inline elements do not part words, ``br`` does.

Cases: null, empty and textless pages give an empty text; broken or cut markup
is read as far as it goes, a tag cut off at the end is dropped; rows may
repeat; null ids and URLs are kept; without a labelled page the labels of
``markup_labels`` are used as they are; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import stored
from tickframe.llm.kernels import bounded, tree_sum

MAX_TRAIN = 4000
FEATURES = 1024
ROUNDS = 30
RATE = 0.5
DECAY = 1e-4

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul"
    .split())
# elements that a start tag of the same row closes
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
MAIN = frozenset(("article", "main"))
BOILER = frozenset("head title nav aside footer form button menu dialog".split())
# words in class, id and role that mark what is not main text
HINTS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer form header login masthead menu modal nav navbar "
    "navigation newsletter notice popup promo related replies reply share sidebar signup social "
    "sponsor sponsored subscribe toolbar widget".split())

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_LETTERS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: its text, and what its ancestors are."""

    text: str
    tags: tuple[str, ...]
    zone: str
    linked: int


@dataclass
class _Reader:
    stack: list[tuple[str, str]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    place: tuple[tuple[str, ...], str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            tags, zone = self.place
            self.blocks.append(Block(text, tags, zone, self.linked))
        self.parts, self.linked, self.place = [], 0, None

    def text(self, raw: str) -> None:
        value = html.unescape(raw) if "&" in raw else raw
        if self.place is None and value.strip():
            self.place = (tuple(t for t, _ in self.stack),
                          self.stack[-1][1] if self.stack else "none")
        if any(t == "a" for t, _ in self.stack):
            self.linked += len(value.strip())
        self.parts.append(value)

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            closes = CLOSES.get(tag, set()) | ({"p"} if tag not in ("html", "body") else set())
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in closes:
                    del self.stack[i:]
                    break
                if self.stack[i][0] in BLOCKS:
                    break
        elif tag == "br":
            self.parts.append(" ")
        if tag not in VOID:
            self.stack.append((tag, self._zone(tag, attributes)))

    def _zone(self, tag: str, attributes: str) -> str:
        inner = self.stack[-1][1] if self.stack else "none"
        if tag in BOILER or tag == "header" and inner != "main":
            return "boiler"
        if "=" in attributes:
            words = {w for m in _NAMED.findall(attributes)
                     for w in _LETTERS.findall("".join(m).lower())}
            if words & HINTS:
                return "boiler"
        return "main" if tag in MAIN and inner != "boiler" else inner

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order."""
    reader, at = _Reader(), 0
    while True:
        found = _MARKUP.search(page, at)
        if found is None:
            reader.text(page[at:])
            break
        if found.start() > at:
            reader.text(page[at:found.start()])
        at = found.end()
        close, tag, attributes, ended = found.groups()
        if tag is None:
            continue
        if not ended:
            break
        tag = tag.lower()
        if close:
            reader.end(tag)
            continue
        if tag in RAW:
            if tag in BLOCKS:
                reader.flush()
            over = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
            at = over.end() if over else len(page)
            continue
        reader.start(tag, attributes)
    reader.flush()
    return reader.blocks


def markup_labels(blocks: list[Block]) -> list[int] | None:
    """1 for blocks whose innermost landmark is the article; None if there is none."""
    labels = [int(b.zone == "main") for b in blocks]
    return labels if any(labels) else None


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


_KNOWN: dict[str, int] = {}


def features(blocks: list[Block], hide_main: bool = False) -> list[list[int]]:
    """Active features of every block."""
    out = []
    for i, b in enumerate(blocks):
        n = len(b.text)
        zone = "none" if hide_main and b.zone == "main" else b.zone
        names = {"bias", f"zone:{zone}", f"leaf:{b.tags[-1] if b.tags else ''}",
                 f"size:{min(8, int(math.log2(n + 1)))}",
                 f"links:{min(4, 4 * b.linked // max(1, n))}",
                 f"stop:{b.text[-1] in '.!?'}", f"sign:{'©' in b.text}", f"first:{i == 0}",
                 f"commas:{min(3, b.text.count(','))}"}
        names.update(f"in:{t}" for t in b.tags if t not in MAIN)
        at = []
        for name in names:
            if name not in _KNOWN:
                if len(_KNOWN) > 10_000:
                    _KNOWN.clear()
                _KNOWN[name] = _feature(name)
            at.append(_KNOWN[name])
        out.append(at)
    return out


@dataclass
class Chain:
    """Weights: features x 2, transitions 2 x 2, ends 2 x 2 (first, last)."""

    emit: np.ndarray
    step: np.ndarray
    ends: np.ndarray

    @classmethod
    def zeros(cls) -> Chain:
        return cls(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros((2, 2)))

    def _scores(self, active: list[list[int]]) -> np.ndarray:
        out = np.array([self.emit[a].sum(axis=0) for a in active])
        out[0] += self.ends[0]
        out[-1] += self.ends[1]
        return out

    def viterbi(self, active: list[list[int]]) -> list[int]:
        """The likeliest labels of a page's blocks."""
        if not active:
            return []
        scores = self._scores(active).tolist()
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = scores[0]
        back = []
        for x, y in scores[1:]:
            from_a, from_b = a + s00 >= b + s10, a + s01 > b + s11
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = (x + (a + s00 if from_a else b + s10), y + (a + s01 if from_b else b + s11))
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def gradient(self, pages: list[list[list[int]]], labels: list[list[int]]) -> tuple:
        """Observed minus expected counts of pages, summed, and their log likelihood.

        All pages take each step of the recursions together, longest first.
        """
        order = sorted(range(len(pages)), key=lambda k: -len(pages[k]))
        lens = np.array([len(pages[k]) for k in order])
        n, longest = len(pages), int(lens[0])
        alive = (lens[None, :] > np.arange(longest)[:, None]).sum(axis=1)
        sizes = np.array([len(a) for k in order for a in pages[k]])
        flat = np.array([f for k in order for a in pages[k] for f in a])
        ends = np.cumsum(lens)
        page = np.repeat(np.arange(n), lens)
        at = np.arange(len(sizes)) - np.repeat(ends - lens, lens)
        scores = np.zeros((longest, n, 2))
        scores[at, page] = np.add.reduceat(self.emit[flat], np.cumsum(sizes) - sizes)
        y = np.zeros((longest, n), dtype=int)
        y[at, page] = [label for k in order for label in labels[k]]
        last = (lens - 1, np.arange(n))
        scores[0] += self.ends[0]
        scores[last] += self.ends[1]
        forward, back = scores.copy(), np.zeros_like(scores)
        for t in range(1, longest):
            m = alive[t]
            forward[t, :m] += np.logaddexp(forward[t - 1, :m, :1] + self.step[0],
                                           forward[t - 1, :m, 1:] + self.step[1])
        for t in range(longest - 2, -1, -1):
            m = alive[t + 1]
            right = scores[t + 1, :m] + back[t + 1, :m]
            back[t, :m] = np.logaddexp(self.step[:, 0] + right[:, :1],
                                       self.step[:, 1] + right[:, 1:])
        total = np.logaddexp(forward[last][:, 0], forward[last][:, 1])
        left = np.eye(2)[y] - np.exp(forward + back - total[:, None])
        step, reached = np.zeros((2, 2)), 0.0
        for t in range(1, longest):
            m = alive[t]
            both = (forward[t - 1, :m, :, None] + self.step
                    + (scores[t, :m] + back[t, :m])[:, None, :] - total[:m, None, None])
            step -= np.exp(both).sum(axis=0)
            np.add.at(step, (y[t - 1, :m], y[t, :m]), 1)
            reached += self.step[y[t - 1, :m], y[t, :m]].sum()
        reached += np.take_along_axis(scores[at, page], y[at, page][:, None], 1).sum()
        emit = np.zeros_like(self.emit)
        for label in (0, 1):
            emit[:, label] = np.bincount(flat, np.repeat(left[at, page, label], sizes), FEATURES)
        return (emit, step, np.array([left[0].sum(axis=0), left[last].sum(axis=0)]),
                float(reached - total.sum()))


def train(rows: DataFrame, rounds: int = ROUNDS) -> Chain:
    """Fit on rows (active array<array<int>>, labels array<int>), one a page."""
    model, seen = Chain.zeros(), None
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def partial(batches: Iterator[pa.RecordBatch], model=shared) -> Iterator[pa.RecordBatch]:
            total, pages = Chain.zeros(), 0
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    part = batch.slice(i, 256)
                    emit, step, ends, _ = model.value.gradient(part.column(0).to_pylist(),
                                                               part.column(1).to_pylist())
                    total.emit += emit
                    total.step += step
                    total.ends += ends
                    pages += part.num_rows
            flat = np.concatenate([total.emit.ravel(), total.step.ravel(), total.ends.ravel(),
                                   [pages]])
            yield pa.record_batch([pa.array([flat.tobytes()], pa.binary())], ["sums"])

        flat = tree_sum(rows.select("active", "labels").mapInArrow(partial, "sums binary"), 4)
        weights = np.concatenate([model.emit.ravel(), model.step.ravel(), model.ends.ravel()])
        slope = flat[:-1] / max(1.0, flat[-1]) - DECAY * weights
        # per-weight step sizes (AdaGrad): rare features move as far as frequent ones
        seen = slope ** 2 if seen is None else seen + slope ** 2
        weights = weights + RATE * slope / np.sqrt(seen + 1e-8)
        cuts = [FEATURES * 2, FEATURES * 2 + 4]
        emit, step, ends = np.split(weights, cuts)
        model = Chain(emit.reshape(-1, 2), step.reshape(2, 2), ends.reshape(2, 2))
    return model


def labelled(pages: DataFrame) -> DataFrame:
    """Rows (active, labels) of the pages (page_id, html) whose markup labels them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
                blocks = leaf_blocks(page or "")
                labels = markup_labels(blocks)
                if labels:
                    out.append((features(blocks, zlib.crc32(str(i).encode()) % 4 == 0), labels))
            yield pa.record_batch([pa.array([a for a, _ in out], pa.list_(pa.list_(pa.int32()))),
                                   pa.array([y for _, y in out], pa.list_(pa.int32()))],
                                  ["active", "labels"])
    return pages.select("page_id", "html").mapInArrow(
        run, "active array<array<int>>, labels array<int>")


def count_labelled(pages: DataFrame) -> int:
    """The number of pages (html) whose markup labels them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(markup_labels(leaf_blocks(page or "")) is not None
                    for page in batch.column(0).to_pylist())
            yield pa.record_batch([pa.array([n], pa.int64())], ["n"])
    return pages.select("html").mapInArrow(run, "n long").agg(
        F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def extract(page: str | None, model: Chain | None) -> str:
    """Main text of one page."""
    blocks = leaf_blocks(page or "")
    if model is None:
        keep = markup_labels(blocks) or [0] * len(blocks)
    else:
        keep = model.viterbi(features(blocks))
    return " ".join(b.text for b, y in zip(blocks, keep, strict=True) if y)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", max_train: int = MAX_TRAIN,
               rounds: int = ROUNDS) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    # the bound is one of labelled pages, so those are counted before any is picked
    n = rows.count()
    n = count_labelled(rows) if n > max_train else n
    known = stored(labelled(bounded(rows, F.col("page_id"), max_train, n)), "labelled-pages")
    model = None if known.isEmpty() else train(known, rounds)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p, shared.value) for p in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"),
                                   pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())],
                                  ["page_id", "url", "text", "n_chars"])
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, "
                                "n_chars long")
