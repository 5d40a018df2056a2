"""Spelling variants of words by sorted permuterm rotations.

A word marked with a terminator is rotated so that one character comes last:
for the character at place p the rotation is w[p+1:] + end + w[:p] + w[p].  All
words that differ from it by another character there share the rotation but for
its last character, and the word that lacks the character has just that prefix
as a rotation of its own.  So each rotation goes in under its prefix (its last
character may be replaced or left out) and whole (a character may come after
it), rows are dealt out by ranges of that key and sorted, and a scan of equal
keys meets all words one edit apart.  A key has as many rows as there are
characters, at most one each, so no group grows with the corpus.

A word that lacks one of two equal neighbouring characters is met under each of
them; only the first counts.  So every pair is met once, and a scan reports for
each member of a key how many words it met and the best of them, never pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.llm.common import staged
from framecurate.session import discard

END = "\x00"
HELD = 500_000               # distinct words that a task holds before it reports them

#: Latin-1 bytes: A-Z to a-z; a-z and U+00C0 to U+00FF as they are; else a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _runs(text: bytes) -> Counter:
    """Runs of letters with their counts.  In Latin-1 a letter is one byte; other
    characters become question marks, which are no letters."""
    return Counter(text.decode("utf-8", "replace").encode("latin-1", "replace").translate(_LETTERS).split())


def _count_runs(slip: int, least: int):
    def run(batches):
        held: Counter = Counter()
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text is None:
                    continue
                before = zlib.crc32(b":" if i is None else b"%d:" % i)
                for w, n in _runs(text).items():
                    if slip:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), before)
                        if h % slip == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                    if len(w) >= least:
                        held[w] += n
                if len(held) >= HELD:
                    yield _counts(held)
                    held = Counter()
        if held:
            yield _counts(held)
    return run


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in held], pa.string()),
                                       "n": pa.array(list(held.values()), pa.int64())})


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int = 0,
                min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the runs of letters (A-Z, a-z, U+00C0 to U+00FF) of all texts,
    A-Z lower-cased, that have min_chars characters and occur min_count times.

    With slip, a run whose crc32 of `<id>:<run>` it divides first loses its
    character number crc32 mod length.  A null id counts as an empty one, a null
    or empty text has no run, repeated rows count each, invalid UTF-8 separates
    runs.  A task reports its counts whenever it holds HELD distinct words.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    each = own.mapInArrow(_count_runs(slip, min_chars), "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _rotations(words: DataFrame) -> DataFrame:
    """(key, last, n, first): last is the character that follows the key in the
    rotation, null for the whole rotation; first is false where it equals the
    character before it in the word."""
    w = f"concat(word, '{END}')"
    under = (f"transform(slice(sequence(1, length(word) + 1), 1, length(word)), p -> struct(concat(substring({w}, p + 1), substring(word, 1, p - 1)) AS key, "
             "substring(word, p, 1) AS last, p = 1 OR substring(word, p, 1) <> substring(word, p - 1, 1) AS first))")
    whole = (f"transform(sequence(0, length(word)), p -> struct(concat(substring({w}, p + 1), substring(word, 1, p)) AS key, "
             "cast(null AS string) AS last, true AS first))")
    return (words.select("n", F.explode(F.expr(f"concat({under}, {whole})")).alias("r"))
            .select("r.key", "r.last", "n", "r.first"))


_MET = "word string, met int, near string, near_n long"


def _word(key: str, last: str | None) -> str:
    tail, head = key.split(END, 1)
    return head + (last or "") + tail


def _group(key: str, rows: list) -> list:
    """(word, words met, best of them, its n) of the members of a key; rows of
    (last, n, first)."""
    ranked = sorted(((-n, _word(key, last), last, first) for last, n, first in rows))
    out = []
    for n, word, last, first in ranked:
        met = [(m, other) for m, other, c, f in ranked
               if other != word and (c is not None or first) and (last is not None or f)]
        if met:
            out.append((word, len(met), met[0][1], -met[0][0]))
    return out


def _scan(batches):
    """Groups of equal keys in rows sorted by key; the last one of a batch waits
    for the next batch."""
    waiting, rows = None, []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(0)
        start = np.concatenate([[0], 1 + np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))])
        size = np.diff(np.append(start, b.num_rows))
        out = []
        if waiting is not None:
            if keys[0].as_py() == waiting:
                rows += _rows(b, 0, int(size[0]))
                start, size = start[1:], size[1:]
            if len(start):
                out += _group(waiting, rows) if len(rows) > 1 else []
                waiting = None
        if len(start):
            for s, n in zip(start[:-1].tolist(), size[:-1].tolist(), strict=True):
                if n > 1:
                    out += _group(keys[s].as_py(), _rows(b, s, n))
            waiting, rows = keys[int(start[-1])].as_py(), _rows(b, int(start[-1]), int(size[-1]))
        if out:
            yield _batch(out)
    if len(rows) > 1:
        out = _group(waiting, rows)
        if out:
            yield _batch(out)


def _rows(b: pa.RecordBatch, start: int, n: int) -> list:
    return list(zip(*(c.slice(start, n).to_pylist() for c in b.columns[1:]), strict=True))


def _batch(out: list) -> pa.RecordBatch:
    cols = zip(*out, strict=True)
    kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=["word", "met", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) of the words one edit (a character inserted,
    deleted or replaced) from another; near is the most frequent such word, ties
    to the least in code-point order."""
    dealt = _rotations(words).repartitionByRange("key").sortWithinPartitions("key").select("key", "last", "n", "first")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    return (dealt.mapInArrow(_scan, _MET).groupBy("word")
            .agg(F.sum("met").cast("long").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.n")).alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, up), up being where a chain of (word, up) ends.  Counts grow along a
    chain, so it has no cycle; every round doubles the steps that are taken."""
    forms = staged(forms, "spelling-forms")
    while True:
        further = forms.select(F.col("word").alias("up"), F.col("up").alias("next"))
        now = staged(forms.join(further, "up", "left").select(
            "word", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "spelling-forms")
        discard(forms)
        forms = now.drop("moved")
        if not now.where("moved").limit(1).count():
            return forms


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table of distinct words with
    counts (word, n).

    A word's form is its most frequent near word, if that is `ratio` (2 at least)
    times as frequent as the word, else null; root is where the forms lead, the
    word itself if it has none; form_n is the form's count or null, n_near the
    number of near words.  Words of any characters but U+0000 and any length may
    come; null words and counts are left out.  Other columns are ignored; an
    empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, else forms may lead in a circle")
    words = staged(words.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL"), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    wins = F.col("near_n") >= ratio * F.col("n")
    told = staged(near.select("word", F.when(wins, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(wins, F.col("near_n")).alias("form_n")), "spelling-near")
    roots = _roots(told.where("form IS NOT NULL").select("word", F.col("form").alias("up")))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n")
