"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the page.

A page is cut into its leaf blocks: stretches of text between block tags.  Each block is described by its
ancestors (tags, class, id and role words) and by its text (length, links, punctuation, place).  The field
scores a label for every block, article or not, and for every pair of neighbours; Viterbi finds the best
labelling of the whole page.  It is trained here, by maximum likelihood, on ``FIT_PAGES`` labelled pages
that ``labelled_page`` builds from layouts of known parts.

Pages are decoded where they lie, one by one; nothing is shuffled.  Defined results: null, empty and
text-free pages have an empty text; equal pages have equal texts; malformed markup is read as far as it
goes (an unclosed comment or script ends with the page); character references are decoded, white space inside a block becomes one space, blocks are
joined by one line feed; nothing is cut off; other columns are not read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FIT_PAGES, STEPS, RIDGE = 700, 160, 2e-4
# fixed values: elements by their part in a page
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre search section select summary table tbody td textarea tfoot th thead tr ul""".split())
UNSEEN = frozenset("script style noscript template title svg canvas iframe object audio video math head datalist".split())
RAW = frozenset("script style noscript template title svg canvas iframe object audio video math textarea".split())
VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
SECTIONS = ("article", "main", "nav", "header", "footer", "aside", "form", "dialog", "figure")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select menu body html article section div td th".split())

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def _tag_end(page: str, at: int, gone: set[str]) -> int:
    """Place of the ``>`` that ends the tag at ``at``, outside of quotes; the page's end if there is none."""
    close = page.find(">", at)
    while close >= 0:
        part = page[at:close]
        one, two = part.find("'"), part.find('"')
        if one < 0 and two < 0:
            return close
        quote = '"' if one < 0 or 0 <= two < one else "'"
        at += part.index(quote) + 1
        if quote in gone:
            return close
        end = page.find(quote, at)
        if end < 0:
            gone.add(quote)
            return close
        at = end + 1
        close = close if at <= close else page.find(">", at)
    return len(page)


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks of visible text, in order, each with its ancestors (``tag`` or ``tag class id role``)."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    links = linked = 0
    gone: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple([d for _, d in stack]), min(linked, len(text))))
            parts.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        open_ = page.find("<", at)
        if open_ < 0:
            open_ = size
        if open_ > at:
            piece = page[at:open_]
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        if open_ == size:
            break
        if page.startswith("<!--", open_):
            end = page.find("-->", open_ + 4)
            at = size if end < 0 else end + 3
            continue
        found = _TAG.match(page, open_)
        if not found:
            if page.startswith(("<!", "<?", "</"), open_):
                end = page.find(">", open_)
                at = size if end < 0 else end + 1
            else:
                parts.append("<")
                at = open_ + 1
            continue
        end = _tag_end(page, found.end(), gone)
        tag, closing = found[1].lower(), page[open_ + 1] == "/"
        at = end + 1
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
        elif tag == "br":
            parts.append(" ")
        elif tag in RAW and not closing:
            if tag == "textarea":
                flush()
            stop = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(page, at) if not page[open_:end].endswith("/") or tag not in ("svg", "math") else None
            if stop:
                at = page.find(">", stop.end())
                at = size if at < 0 else at + 1
            elif not page[open_:end].endswith("/"):
                at = size
            parts.append(" ")
        elif tag in BLOCKS or tag == "head":
            flush()
            if not closing:
                if tag not in ("html", "body", "head"):
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == "p" and tag not in ("button", "label", "select", "option", "textarea") or stack[k][0] in CLOSES.get(tag, ()):
                            del stack[k:]
                            break
                        if stack[k][0] in SCOPES and not (tag in ("tr", "td", "th") and stack[k][0] in ("td", "th")):
                            break
                if tag not in VOID:
                    attributes = page[found.end():end]
                    named = " ".join([tag, *[f"{k.lower()}={a or b or c}" for k, a, b, c in _NAMED.findall(attributes)]]) if "=" in attributes else tag
                    if "hidden" in attributes or "none" in attributes:
                        named += " hidden=hidden" if _HIDDEN.search(attributes) else ""
                    stack.append((tag, named))
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
    flush()
    return [b for b in out if not any(d.startswith("head ") or d == "head" for d in b.path)]


@lru_cache(maxsize=20_000)
def _of_path(path: tuple[str, ...]) -> tuple[str, ...]:
    """What a block's ancestors say."""
    out: set[str] = set()
    tags = [d.split(" ", 1)[0] for d in path]
    out.update("in:" + t for t in tags)
    out.add("is:" + (tags[-1] if tags else "-"))
    inside = "article" in tags or "main" in tags
    near = next((t for t in reversed(tags) if t in SECTIONS), "-")
    out.update((f"near:{near}", f"near:{near}/{inside}", f"is:{tags[-1] if tags else '-'}/{near}"))
    for depth, described in enumerate(reversed(path)):
        for field in described.split(" ")[1:]:
            for word in _WORD.findall(field.split("=", 1)[-1]):
                word = word.lower()
                out.add("word:" + word)
                if depth < 2:
                    out.add("close:" + word)
    return tuple(sorted(out))


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of what holds for each block of a page."""
    out, n = [], len(blocks)
    for k, b in enumerate(blocks):
        text, size = b.text, len(b.text)
        words = text.count(" ") + 1
        share = b.linked / size
        out.append(["all", *_of_path(b.path), f"words:{min(7, int(math.log2(words)))}", f"linked:{0 if share == 0 else 1 if share < .4 else 2 if share < .9 else 3}",
                    f"end:{'s' if text[-1] in '.!?…:;' else 'o'}", f"rights:{'©' in text}", f"bar:{'|' in text or '·' in text}", f"first:{k == 0}", f"last:{k == n - 1}",
                    f"long:{words >= 12 and share < .3}"])
    return out


class Field:
    """A two-label linear-chain field: label 1 is the article."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, start: np.ndarray, step: np.ndarray):
        self.weight = {name: float(weights[k]) for name, k in index.items()}
        self.start, self.step = start.tolist(), step.tolist()

    def scores(self, rows: list[list[str]]) -> list[float]:
        """How much better label 1 fits each block than label 0, by itself."""
        get = self.weight.get
        return [sum([get(name, 0.0) for name in row]) for row in rows]

    def viterbi(self, scores: list[float]) -> list[int]:
        if not scores:
            return []
        (s00, s01), (s10, s11) = self.step
        zero, one = self.start[0], self.start[1] + scores[0]
        back = []
        for x in scores[1:]:
            from0, from1 = int(one + s10 > zero + s00), int(one + s11 > zero + s01)
            back.append((from0, from1))
            zero, one = (one + s10 if from0 else zero + s00), (one + s11 if from1 else zero + s01) + x
        label = int(one > zero)
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]

    def main_text(self, page: str) -> str:
        blocks = leaf_blocks(page)
        labels = self.viterbi(self.scores(features(blocks)))
        return "\n".join([b.text for b, label in zip(blocks, labels) if label])


def likelihood(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded rows of pages: log partition, chance of label 1, expected steps summed over pages."""
    pages, longest = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], 2)
    ahead, behind = np.zeros((longest, pages, 2)), np.zeros((longest, pages, 2))
    ahead[0] = start + emit[:, 0]
    for t in range(1, longest):
        ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, :, None] + step, 1) + emit[:, t]
    for t in range(longest - 2, -1, -1):
        inner = np.logaddexp.reduce(step + (emit[:, t + 1] + behind[t + 1])[:, None, :], 2)
        behind[t] = np.where((t + 1 < lengths)[:, None], inner, 0)
    total = np.logaddexp.reduce(ahead[lengths - 1, np.arange(pages)], 1)
    chance = np.exp(ahead + behind - total[None, :, None])[:, :, 1].T
    steps = np.zeros((2, 2))
    for t in range(longest - 1):
        pair = np.exp(ahead[t][:, :, None] + step + (emit[:, t + 1] + behind[t + 1])[:, None, :] - total[:, None, None])
        steps += pair[t + 1 < lengths].sum(0)
    return total, chance, steps


def fit_field(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, ridge: float = RIDGE) -> Field:
    """Maximum likelihood with a ridge, by Adam steps over all pages at once."""
    pages = [p for p in pages if p[0]]
    rows = [features(blocks) for blocks, _ in pages]
    index = {name: k for k, name in enumerate(sorted({n for page in rows for row in page for n in row}))}
    lengths = np.array([len(r) for r in rows])
    longest = int(lengths.max())
    width = max(len(row) for page in rows for row in page)
    which = np.full((len(rows), longest, width), len(index))
    gold, real = np.zeros((len(rows), longest)), np.arange(longest)[None, :] < lengths[:, None]
    for p, page in enumerate(rows):
        gold[p, :lengths[p]] = pages[p][1]
        for t, row in enumerate(page):
            which[p, t, :len(row)] = [index[n] for n in row]
    is0, is1 = (gold == 0) & real, (gold == 1) & real
    seen = np.array([[(a[:, :-1] & b[:, 1:]).sum() for b in (is0, is1)] for a in (is0, is1)], float)
    first = np.array([is0[:, 0].sum(), is1[:, 0].sum()], float)
    x = np.zeros(len(index) + 1 + 6)
    m, v, count = np.zeros_like(x), np.zeros_like(x), real.sum()
    for k in range(1, steps + 1):
        weights, start, step = x[:len(index) + 1], x[-6:-4], x[-4:].reshape(2, 2)
        scores = weights[which].sum(2)
        _, chance, expected = likelihood(scores, lengths, start, step)
        off = np.where(real, chance - gold, 0.0)
        slope = np.concatenate([np.bincount(which.ravel(), np.repeat(off.ravel(), width), len(index) + 1),
                                np.array([(1 - chance[:, 0]).sum(), chance[:, 0].sum()]) - first, (expected - seen).ravel()]) / count + ridge * x
        slope[len(index)] = 0
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        x = x - 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return Field(index, x[:len(index)], x[-6:-4], x[-4:].reshape(2, 2))


def main_texts(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text and n_chars of every page (page_id, url, html)."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [field.main_text(p.as_py() or "") for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
