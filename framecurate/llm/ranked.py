"""Ranked lexical search by pipelined term partitioning.

Documents are read once into chunks of a bounded number of documents; of every
chunk and term there is one row of postings.  Queries (items) travel in bundles:
a bundle has a row for each chunk with a sparse accumulator, the scores so far of
(item, document of the chunk).  Terms belong to stages by their weight, rare
terms first.  Stage after stage the bundles meet the postings of the stage's
terms in a cogroup by bundle and chunk, add the terms' contributions and go on.

Between stages an accumulator drops what cannot matter any more: a document
whose score and all that the item's later terms can add stay below the score that
`k` documents of the chunk have already.  The last stage gives each item's first
`k` of a chunk, and of these the first `k` overall are the answer.

A chunk's rows come from one task, so texts are never shuffled, and no cogroup
holds more than a chunk's postings and a bundle's scores over it, however common
a term is.  The terms that items use reach the tasks as a bit map of fixed size;
other terms that share a bit go in the join of postings with weights.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framecurate.llm.common import staged
from framecurate.session import discard

MAP_BITS = 20
CHUNK_WORDS = 4_000_000      # a chunk also ends here
SHARE = 1_000_000            # above what a term of weight 1 can add to a score

#: A-Z to a-z; other ASCII letters, digits and all bytes of non-ASCII characters as they are; else a blank.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERMS).split()


def _item_terms(batches):
    for b in batches:
        rows = [(*key, w.decode("utf-8", "replace"), n) for *key, text in zip(*(c.to_pylist() for c in b.columns), strict=True)
                for w, n in Counter(_terms(text)).items()]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.int32(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["bundle", "slot", "term", "q"])


_PARTS = "chunk long, term string, docs binary, tfs binary, df long, ids array<long>, sizes binary, n_docs long, n_terms long"
_KINDS = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64())
_NAMES = [c.split()[0] for c in _PARTS.split(", ")]


def _index(wanted: np.ndarray, chunk_docs: int):
    """(doc_id, text) -> a row a chunk (ids, sizes) and a row a chunk and term (docs, tfs)."""
    full = (1 << MAP_BITS) - 1

    def out(chunk, ids, sizes, found):
        sizes = np.array(sizes, np.int64)
        rows = [(chunk, None, None, None, None, ids, sizes.tobytes(), int((sizes > 0).sum()), int(sizes.sum()))]
        for term, (docs, tfs) in found.items():
            tfs = np.array(tfs, np.int64)
            rows.append((chunk, term.decode("utf-8", "replace"), np.array(docs, np.uint16).tobytes(),
                         tfs.astype(np.uint8 if tfs.max() < 256 else np.int64).tobytes(), len(docs), None, None, None, None))
        for s in range(0, len(rows), 1024):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows[s:s + 1024], strict=True), _KINDS, strict=True)], names=_NAMES)

    def run(batches):
        known: dict[bytes, bool] = {}
        seq, words, ids, sizes, found = 0, 0, [], [], {}
        base = TaskContext.get().partitionId() << 32
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                terms = _terms(text)
                doc = len(ids)
                for w, n in Counter(terms).items():
                    use = known.get(w)
                    if use is None:
                        if len(known) > 1_000_000:
                            known.clear()
                        use = known[w] = bool(wanted[zlib.crc32(w) & full])
                    if use:
                        got = found.get(w)
                        if got is None:
                            found[w] = ([doc], [n])
                        else:
                            got[0].append(doc)
                            got[1].append(n)
                ids.append(i)
                sizes.append(len(terms))
                words += len(terms)
                if len(ids) >= chunk_docs or words >= CHUNK_WORDS:
                    yield from out(base | seq, ids, sizes, found)
                    seq, words, ids, sizes, found = seq + 1, 0, [], [], {}
        if ids:
            yield from out(base | seq, ids, sizes, found)
    return run


_CARRIED = ("bundle int, chunk long, ids array<long>, sizes binary, rest array<struct<slot:int,later:array<long>>>, "
            "slots binary, docs binary, scores binary")


def _accumulator(row: dict, n_slots: int, n_docs: int) -> np.ndarray:
    acc = np.zeros((n_slots, n_docs), np.int64)
    if row["scores"]:
        acc[np.frombuffer(row["slots"], np.uint16), np.frombuffer(row["docs"], np.uint16)] = np.frombuffer(row["scores"], np.int64)
    return acc


def _stage(stage: int, k: int, whole_docs: int, whole_terms: int, last: bool):
    """Adds the stage's terms to a bundle's scores over a chunk."""
    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundle.num_rows:
            return _final([]) if last else _SCHEMA.empty_table()
        own = bundle.select(["sizes", "rest", "slots", "docs", "scores"]).to_pylist()[0]
        size = np.frombuffer(own["sizes"], np.int64)
        m = 75 + 25 * size * whole_docs // max(1, whole_terms)
        later = {r["slot"]: r["later"][stage] for r in own["rest"]}
        acc = _accumulator(own, max(later, default=-1) + 1, len(size))
        for w, uses, docs, tfs in zip(*(postings[c].to_pylist() for c in ("w", "uses", "docs", "tfs")), strict=True):
            at = np.frombuffer(docs, np.uint16)
            tf = np.frombuffer(tfs, np.uint8 if len(tfs) == len(at) else np.int64).astype(np.int64)
            each = w * (1_000_000_000 * tf // (1000 * tf + 12 * m[at]))
            for use in uses:
                acc[use["slot"], at] += use["q"] * each
        slots, docs, scores = [], [], []
        for slot in later:
            at = np.flatnonzero(acc[slot])
            score = acc[slot, at]
            if len(at) > k:
                reached = np.partition(score, -k)[-k]
                stay = score + later[slot] >= reached
                at, score = at[stay], score[stay]
            slots.append(np.full(len(at), slot, np.uint16))
            docs.append(at.astype(np.uint16))
            scores.append(score)
        if last:
            ids = bundle["ids"].combine_chunks().flatten()
            number = ids.fill_null(0).to_numpy(zero_copy_only=False)
            none = ids.is_null().to_numpy(zero_copy_only=False)
            rows = []
            for slot, at, score in zip(later, docs, scores, strict=True):
                order = np.lexsort((number[at], none[at], -score))[:k]
                rows += [(bundle["bundle"][0].as_py(), slot, None if none[d] else int(number[d]), int(s))
                         for d, s in zip(at[order].tolist(), score[order].tolist(), strict=True)]
            return _final(rows)
        out = bundle.select(_SCHEMA.names[:5])
        for name, parts in (("slots", slots), ("docs", docs), ("scores", scores)):
            out = out.append_column(name, pa.array([np.concatenate(parts or [np.zeros(0)]).tobytes()], pa.binary()))
        return out.cast(_SCHEMA)
    return run


_REST = pa.list_(pa.struct([("slot", pa.int32()), ("later", pa.list_(pa.int64()))]))
_SCHEMA = pa.schema([("bundle", pa.int32()), ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()),
                     ("rest", _REST), ("slots", pa.binary()), ("docs", pa.binary()), ("scores", pa.binary())])
_FINAL = "bundle int, slot int, doc_id long, score long"


def _final(rows: list) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                    names=["bundle", "slot", "doc_id", "score"])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", stages: int = 4,
                   chunk_docs: int = 4096, bundle_items: int = 128) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k documents of the highest score
    above 0, equal scores by ascending doc_id (null ids last).

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased; a null or empty text has none.  With N documents that have
    terms, L terms in them, df documents that hold a term and n terms in the
    document, a term weighs w = floor(1000 ln((2N + 2) / (2df + 1))), m = 75 +
    (25 n N div L), and each occurrence of the term in the item adds
    w ((10^9 tf) div (1000 tf + 12 m)); integers have 64 bits.

    Every row of docs is a document, repeated rows and ids too.  Equal rows of
    items are one item; rows of one id and different texts are ranked apart.  An
    item without terms that occur has no row; empty tables give no rows.  Other
    columns of both tables are ignored.
    """
    distinct = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    n_bundles = max(1, -(-distinct.count() // bundle_items))
    slot = F.row_number().over(Window.partitionBy("bundle").orderBy("item_id", "text")) - 1
    numbered = staged(distinct.withColumn("bundle", F.expr(f"cast(pmod(xxhash64(item_id, text), {n_bundles}) as int)"))
                      .withColumn("slot", slot.cast("int")), "ranked-items")
    asked = staged(numbered.select("bundle", "slot", F.col("text").cast("binary").alias("text"))
                   .mapInArrow(_item_terms, "bundle int, slot int, term string, q long"), "ranked-terms")
    wanted = np.zeros(1 << MAP_BITS, bool)
    bit = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    wanted[[r["bit"] for r in asked.select(bit.cast("int").alias("bit")).distinct().collect()]] = True

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    parts = staged(own.mapInArrow(_index(wanted, min(chunk_docs, 1 << 16)), _PARTS), "ranked-index")
    chunks, postings = parts.where("term IS NULL"), parts.where("term IS NOT NULL")
    whole = chunks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = whole["n"] or 0, whole["l"] or 0

    df = postings.groupBy("term").agg(F.sum("df").alias("df"))
    top = F.log(F.lit((2 * n_docs + 2) / 3.0)) * 1000
    w = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    of_stage = F.least(F.greatest(F.floor((F.lit(1.0) - F.col("w") / top) * stages), F.lit(0)), F.lit(stages - 1))
    uses = staged(asked.join(df, "term").withColumn("w", w.cast("long"))
                  .withColumn("stage", F.coalesce(of_stage, F.lit(0)).cast("int")), "ranked-uses")
    owned = uses.groupBy("stage", "term", "bundle", "w").agg(F.collect_list(F.struct("slot", "q")).alias("uses"))

    later = F.array(*[F.sum(F.when(F.col("stage") > s, F.col("q") * F.col("w") * SHARE).otherwise(0)) for s in range(stages)])
    rest = (uses.groupBy("bundle", "slot").agg(later.alias("later"))
            .groupBy("bundle").agg(F.collect_list(F.struct("slot", "later")).alias("rest")))
    none = F.lit(None).cast("binary")
    bundles = (chunks.select("chunk", "ids", "sizes", F.explode(F.sequence(F.lit(0), F.lit(n_bundles - 1))).alias("bundle"))
               .join(rest, "bundle").select("bundle", "chunk", "ids", "sizes", "rest",
                                            none.alias("slots"), none.alias("docs"), none.alias("scores")))
    carried = None
    for s in range(stages):
        met = (postings.select("chunk", "term", "docs", "tfs").join(owned.where(F.col("stage") == s).drop("stage"), "term")
               .select(F.col("bundle").alias("of_bundle"), F.col("chunk").alias("of_chunk"), "w", "uses", "docs", "tfs"))
        last = s == stages - 1
        grown = bundles.groupBy("bundle", "chunk").cogroup(met.groupBy("of_bundle", "of_chunk")).applyInArrow(
            _stage(s, k, n_docs, n_terms, last), _FINAL if last else _CARRIED)
        if last:
            best = grown
        else:
            bundles = staged(grown, "ranked-bundles")
            if carried is not None:
                discard(carried)
            carried = bundles
    order = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("bundle", "slot", "item_id"), ["bundle", "slot"]).select("item_id", "rank", "doc_id", "score")
