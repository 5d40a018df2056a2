"""Benchmark decontamination: pigeonhole edit matching.

Texts are lower-cased with white space runs as one blank.  An item of n
characters may occur in a document with up to k = floor(rate * n) edits.  Cut
into k + 1 pieces, at least one piece must then occur unchanged, so one
Aho-Corasick pass over the document finds every place worth a look.  An edit
spoils at most one of the item's 5-grams that lie side by side, so a window
there that lacks more than k of them cannot match; the others are verified
with Myers' bit-parallel distance.
"""

from __future__ import annotations

import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.llm.common import staged

GRAM = 5
BLOCK_CHARS = 4_000_000      # item characters searched for in one pass over the documents


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def cut(item: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """The error budget k and the k + 1 (offset, piece)."""
    n, k = len(item), min(int(rate * len(item)), max(0, len(item) - 1))
    bounds = [n * j // (k + 1) for j in range(k + 2)]
    return k, [(s, item[s:e]) for s, e in zip(bounds, bounds[1:], strict=False)]


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any stretch of text, end of the
    first such stretch)."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    plus, minus, score = full, 0, m
    best, end = m, 0
    get = where.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        diag = eq | minus
        level = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(level | plus)), plus & level
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best, end = score, j
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(diag | up)), up & diag
    return best, end


class Finder:
    """Search for a bounded block of items [(item_id, text)]."""

    def __init__(self, items: list[tuple], rate: float):
        import ahocorasick
        self.ids = [i for i, _ in items]
        self.items = [normalise(t) for _, t in items]
        self.budget = [0] * len(items)
        self.grams = []
        pieces = defaultdict(list)
        for n, item in enumerate(self.items):
            self.budget[n], own = cut(item, rate)
            self.grams.append([item[j:j + GRAM] for j in range(0, len(item) - GRAM + 1, GRAM)])
            for at, piece in own if item else ():
                pieces[piece].append((n, at))
        self.machine = ahocorasick.Automaton()
        for piece, own in pieces.items():
            self.machine.add_word(piece, (len(piece), own))
        self.machine.make_automaton()
        self.any = bool(pieces)

    def _windows(self, text: str) -> dict[int, list[list[int]]]:
        """By item: [first, last] starts of the item that piece hits point to,
        with hits less than 64 characters apart taken together."""
        hits = defaultdict(list)
        for end, (size, own) in self.machine.iter(text):
            for n, at in own:
                hits[n].append(end + 1 - size - at)
        out = {}
        for n, starts in hits.items():
            starts.sort()
            runs = [[starts[0], starts[0]]]
            for s in starts:
                if s - runs[-1][1] < 64:
                    runs[-1][1] = s
                else:
                    runs.append([s, s])
            out[n] = runs
        return out

    def _lacks(self, n: int, window: str) -> bool:
        """Whether more of the item's grams than edits are not in the window."""
        left = self.budget[n]
        for gram in self.grams[n]:
            if gram not in window:
                left -= 1
                if left < 0:
                    return True
        return False

    def matches(self, text: str | None, first_only: bool = False) -> list[tuple]:
        """(item_id, distance, start, end) in the normalised text, one an item:
        the least distance, of equal ones the first end."""
        text, out = normalise(text), []
        if not self.any:
            return out
        for n, runs in self._windows(text).items():
            item, k, best = self.items[n], self.budget[n], None
            for low, high in runs:
                a, b = max(0, low - k), min(len(text), high + len(item) + k)
                window = text[a:b]
                if self._lacks(n, window):
                    continue
                distance, end = best_match(item, window)
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, a + end)
            if best:
                distance, end = best
                back = text[max(0, end - len(item) - k):end][::-1]
                _, size = best_match(item[::-1], back)
                out.append((self.ids[n], distance, end - size, end))
                if first_only:
                    break
        return out


class _Sent:
    """A block's items as they travel to the tasks; the Finder is built there,
    once a task."""

    def __init__(self, items: list[tuple], rate: float):
        self.items, self.rate, self._own = items, rate, None

    def __getstate__(self):
        return {"items": self.items, "rate": self.rate, "_own": None}

    @property
    def value(self) -> Finder:
        if self._own is None:
            self._own = Finder(self.items, self.rate)
        return self._own


def _numbered(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> tuple[DataFrame, int]:
    """(item_id, text, block) and the number of blocks of about block_chars."""
    own = items.select(F.col(id_col).cast("long").alias("item_id"),
                       F.col(text_col).alias("text")).where("text is not null")
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))
    return own.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), n


def _block(numbered: DataFrame, at: int, rate: float) -> _Sent:
    """One block of the items, a stated query set that meets all documents; the
    driver holds this block and no other."""
    rows = numbered.where(F.col("block") == at).select("item_id", "text").collect()
    return _Sent(sorted(((r["item_id"], r["text"]) for r in rows),
                        key=lambda x: (x[0] is None, x[0] or 0, x[1])), rate)


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", rate: float = 0.1,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, start, end): every item in every document row
    with at most floor(rate * n) edits; start and end are in the normalised text.

    Null and empty texts hold no item, null and empty items are in no text;
    null ids are kept; equal rows give equal rows; other columns are ignored; an
    empty table on either side gives no row.  A very long text is searched whole,
    in time proportional to its length.  A block of items is searched for at a
    time, in a pass over the documents; the hits of all but the last are staged.
    """
    kind = "doc_id long, item_id long, distance int, start int, end int"
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def search(finder):
        def run(batches):
            for b in batches:
                rows = [(i, *m) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                        for m in finder.value.matches(t)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], t) for c, t in enumerate(
                        (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                    names=["doc_id", "item_id", "distance", "start", "end"])
        return own.mapInArrow(run, kind)

    numbered, n = _numbered(items, item_id, item_text, block_chars)
    earlier = [staged(search(_block(numbered, i, rate)), "item-hits") for i in range(n - 1)]
    out = search(_block(numbered, n - 1, rate))
    for more in earlier:
        out = out.unionByName(more)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", rate: float = 0.1, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs without the rows whose text holds an item; all columns are kept.

    Null and empty texts hold no item and stay, as do all rows when there are no
    items; null and empty items are in no text; repeated rows go or stay together;
    a very long text is searched whole; columns may have any names; an empty table
    stays empty.  A block of items is searched for at a time: the hashes of texts
    that hold one of all but the last block's are staged and leave by a join.
    """
    at = docs.columns.index(text_col)
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text, key = F.col(f"c{at}"), F.sha2(f"c{at}", 256)
    numbered, n = _numbered(items, item_id, item_text, block_chars)

    def held(finder):
        def run(batches):
            for b in batches:
                hit = pa.array([bool(finder.value.matches(t, first_only=True)) for t in b.column(1).to_pylist()], pa.bool_())
                yield b.filter(hit).select(["key"])
        return run

    def keep(finder):
        def run(batches):
            for b in batches:
                yield b.filter(pa.array([not finder.value.matches(t, first_only=True)
                                         for t in b.column(at).to_pylist()], pa.bool_()))
        return run

    left = own
    for i in range(n - 1):
        gone = staged(own.select(key.alias("key"), text.alias("text"))
                      .mapInArrow(held(_block(numbered, i, rate)), "key string"), "item-holders")
        left = left.join(gone, key == gone["key"], "left_anti")
    return left.mapInArrow(keep(_block(numbered, n - 1, rate)), own.schema).toDF(*docs.columns)
