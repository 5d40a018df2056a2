"""Stupid-backoff language-model scores from n-gram count tables.

    S(w | h) = c(h w) / c(h)        if c(h w) >= min_count
             = backoff * S(w | h')  otherwise, h' being h without its first word
    S(w)     = c(w) / N

Counts are those of all documents.  Documents are packed into chunks of about
a million words.  A chunk sends each of its distinct n-grams (64-bit hashes)
with the count in the chunk to the table partition that owns the hash; the
partition adds the counts up and answers every chunk; chunks then look up
their exploded n-grams and sum the logarithms per document.  So an n-gram is
one row a chunk however often it occurs, hot n-grams need no care, and no
partition holds more than its hash range, which spark.sql.shuffle.partitions
sets the size of.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecurate.llm.common import shuffle_partitions, staged
from framecurate.llm.sketch import _mix, word_hashes

CHUNK_WORDS = 1_000_000
_STEP = 0xA24BAED4963EE407

_CHUNK = "chunk long, doc_ids binary, no_id binary, ends binary, vocab binary, words binary"
_ASK = "part int, chunk long, grams binary, counts binary"
_ANSWER = "chunk long, part int, totals binary"


def _small(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each that hold the largest; the first byte says how many."""
    top = int(counts.max()) if len(counts) else 0
    size = next(k for k in (1, 2, 4, 8) if top < 1 << 8 * k)
    return bytes([size]) + counts.astype(f"<u{size}").tobytes()


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def _split(values: np.ndarray) -> bytes:
    """Unsigned integers byte by byte: all first bytes, then all second ones.
    High bytes are mostly equal, which Spark's and Parquet's compression uses."""
    size = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes()


def _joined(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _ascending(values: np.ndarray) -> bytes:
    """Ascending uint64 values as their differences."""
    return _split(np.diff(values, prepend=np.uint64(0)))


def _summed(data: bytes) -> np.ndarray:
    return np.cumsum(_joined(data, np.uint64), dtype=np.uint64)


def _pack(chunk_words: int):
    """(doc_id, text) -> chunks: ids, ends of the documents in the words, the
    distinct word hashes and each word's number among them."""
    def out(held, seq):
        ids, hashes, ends = zip(*held, strict=True)
        words = np.concatenate(hashes)
        at, base = [], 0
        for h, e in zip(hashes, ends, strict=True):
            at.append(e + base)
            base += len(h)
        vocab, number = np.unique(words, return_inverse=True)
        flat = [i for own in ids for i in own]
        chunk = TaskContext.get().partitionId() << 32 | seq
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()),
             pa.array([np.array([i or 0 for i in flat], np.int64).tobytes()], pa.binary()),
             pa.array([np.array([i is None for i in flat], bool).tobytes()], pa.binary()),
             pa.array([np.concatenate(at).astype(np.int64).tobytes()], pa.binary()),
             pa.array([_ascending(vocab)], pa.binary()),
             pa.array([_split(number.astype(np.uint32))], pa.binary())],
            names=["chunk", "doc_ids", "no_id", "ends", "vocab", "words"])

    def run(batches):
        held, size, seq = [], 0, 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                if not part.num_rows:
                    continue
                words, bounds = word_hashes(part.column(1))
                held.append((part.column(0).to_pylist(), words, bounds[1:]))
                size += len(words)
                if size >= chunk_words:
                    yield out(held, seq)
                    held, size, seq = [], 0, seq + 1
        if held:
            yield out(held, seq)
    return run


def _grams(vocab: bytes, words: bytes, ends: bytes, order: int) -> list[np.ndarray]:
    """Hashes of the 1- to order-grams ending at each word; 0 where the
    document has not that many words before."""
    ids = _summed(vocab)[_joined(words, np.uint32)]
    last = np.frombuffer(ends, np.int64)
    place = np.arange(len(ids)) - np.repeat(np.concatenate([[0], last[:-1]]),
                                            np.diff(np.concatenate([[0], last])))
    out, now = [], np.zeros(len(ids), np.uint64)
    for n in range(order):
        now = now.copy()
        now[n:] += ids[:len(ids) - n] * np.uint64(pow(_STEP, n + 1, 1 << 64))
        h = _mix(now + np.uint64(n + 1))
        h[place < n] = 0
        out.append(h)
    return out


def _ask(order: int, parts: int):
    """Each chunk's distinct n-grams, ascending, cut at the partitions' bounds."""
    bounds = np.array([((1 << 64) * p // parts) for p in range(1, parts)], np.uint64)

    def run(batches):
        for b in batches:
            for chunk, _, _, ends, vocab, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                grams, counts = np.unique(np.concatenate(_grams(vocab, words, ends, order)), return_counts=True)
                cut = [0, *np.searchsorted(grams, bounds).tolist(), len(grams)]
                rows = [(p, chunk, _ascending(grams[s:e]), _small(counts[s:e]))
                        for p, (s, e) in enumerate(zip(cut, cut[1:], strict=False)) if e > s]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                    names=["part", "chunk", "grams", "counts"]) if rows else pa.RecordBatch.from_arrays(
                    [pa.array([], pa.int32()), pa.array([], pa.int64()), pa.array([], pa.binary()),
                     pa.array([], pa.binary())], names=["part", "chunk", "grams", "counts"])
    return run


def _answer(batches):
    """The partition's count table, looked up for every chunk that asked."""
    part, chunks, grams, counts = None, [], [], []
    for b in batches:
        for p, chunk, g, c in zip(*(col.to_pylist() for col in b.columns), strict=True):
            part = p
            chunks.append(chunk)
            grams.append(_summed(g))
            counts.append(_counts(c))
    if not chunks:
        return
    _, number = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(number, weights=np.concatenate(counts)).astype(np.uint64)[number]
    end = np.cumsum([len(g) for g in grams])
    for chunk, own in zip(chunks, np.split(total, end[:-1]), strict=True):
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), pa.array([_small(own)], pa.binary())],
            names=["chunk", "part", "totals"])


_SCORES = "doc_id long, n_tokens long, log_score double"


def _score(order: int, min_count: int, backoff: float, whole: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = chunk.to_pylist()[0]
        grams = _grams(own["vocab"], own["words"], own["ends"], order)
        distinct, number = np.unique(np.concatenate(grams), return_inverse=True)
        parts = sorted(answers.select(["part", "totals"]).to_pylist(), key=lambda r: r["part"])
        total = np.concatenate([_counts(r["totals"]).astype(np.uint64) for r in parts] or [np.zeros(0, np.uint64)])
        assert len(total) == len(distinct)
        n = len(grams[0])
        count = [np.where(g == 0, 0, c) for g, c in zip(
            grams, np.split(total[number].astype(np.float64), order), strict=True)]
        score = np.log(count[0] / whole) if n else np.zeros(0)
        for k in range(1, order):                 # longer contexts take the place of shorter ones
            before = np.concatenate([[0.0], count[k - 1][:-1]]) if n else count[k - 1]
            seen = count[k] >= max(1, min_count)
            with np.errstate(divide="ignore", invalid="ignore"):
                direct = np.log(count[k]) - np.log(before)
            there = grams[k] != 0                 # the document has the context
            score = np.where(seen, direct, np.where(there, score + np.log(backoff), score))
        ends = np.frombuffer(own["ends"], np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        each = np.array([score[s:e].sum() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        ids = np.frombuffer(own["doc_ids"], np.int64)
        return pa.table({"doc_id": pa.array(ids, mask=np.frombuffer(own["no_id"], bool)),
                         "n_tokens": pa.array(ends - starts, pa.int64()),
                         "log_score": pa.array(each, pa.float64())})
    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
                    min_count: int = 2, backoff: float = 0.4, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row a row of docs: (doc_id, n_tokens, log_score), the sum of the
    natural logarithms of the words' scores.

    Words are lower-cased and split at white space.  The first words of a
    document have as much context as there is.  n-grams of two or more words
    that occur less than min_count times in the corpus count as unseen, so a
    text does not vouch for itself.  Null and empty texts have 0 words and
    score 0; null ids and repeated rows are kept; other columns are ignored.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks = staged(own.mapInArrow(_pack(chunk_words), _CHUNK), "lm-chunks")
    whole = chunks.agg(F.sum(F.length("words") / 4)).first()[0] or 0
    asked = chunks.mapInArrow(_ask(order, parts), _ASK).repartitionById(parts, "part")
    answers = staged(asked.mapInArrow(_answer, _ANSWER), "lm-counts")
    return (chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_score(order, min_count, backoff, int(whole)), _SCORES))
