"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint holds the k least distinct 48-bit hashes of a text's shingles
(five words unless told otherwise), ascending, 6 bytes each, in base64.  The
least k hashes of a union are the least k of the parts' fingerprints together,
so fingerprints of parts merge into that of the whole.  A fingerprint of fewer
than k hashes is the complete set, and its estimates are exact.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framecurate.llm.common import bucket_of, id_buckets, shuffle_partitions

K = 256
BITS = 48
_STEP = 0x9E3779B97F4A7C15        # odd multiplier that tells word places apart


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts in a row, and the
    texts' bounds in them (n + 1 values)."""
    from xxhash import xxh64_intdigest
    # trimmed first: the split is not dependable where a text ends in white space
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(pc.fill_null(
        texts.cast(pa.large_string()), ""))))
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    own = np.array([xxh64_intdigest(w) if w else 0 for w in names], np.uint64)
    blank = np.array([not w for w in names], bool)
    index = coded.indices.to_numpy()
    bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    if blank.any():                    # of texts without words
        full = ~blank[index]
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        index = index[full]
    return own[index] if len(own) else np.empty(0, np.uint64), bounds


def bottom_k(texts: pa.Array, k: int = K, shingle: int = 5) -> list[np.ndarray]:
    """The k least distinct shingle hashes of every text, ascending.  A text of
    fewer words than a shingle is one shingle; one without words has none."""
    words, bounds = word_hashes(texts)
    power = np.array([pow(_STEP, j + 1, 1 << 64) for j in range(shingle)], np.uint64)
    total = max(0, len(words) - shingle + 1)
    rolled = np.zeros(total, np.uint64)
    for j in range(shingle):
        rolled += words[j:j + total] * power[j]
    rolled = _mix(rolled) >> np.uint64(64 - BITS)
    out = []
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if e - s >= shingle:
            own = np.unique(rolled[s:e - shingle + 1])
        elif e > s:
            own = _mix((words[s:e] * power[:e - s]).sum(keepdims=True)) >> np.uint64(64 - BITS)
        else:
            own = rolled[:0]
        out.append(own[:k])
    return out


def to_string(hashes: np.ndarray) -> str:
    return base64.b64encode(hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_string(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard resemblance; two empty sketches are equal (1)."""
    if not len(a) and not len(b):
        return 1.0
    least = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(least, both, assume_unique=True).sum() / len(least))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) + 1) * float(1 << BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that are b's too (1 for an empty a)."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def fingerprint_documents(docs: DataFrame, text_col: str = "text", k: int = K, shingle: int = 5) -> DataFrame:
    """docs with `fingerprint` and `n_shingles` (estimate) behind its columns;
    columns of these names are replaced.  Null and empty texts have the empty
    fingerprint."""
    names = [c for c in docs.columns if c not in ("fingerprint", "n_shingles")]
    at = names.index(text_col)

    def run(batches):
        for b in batches:
            own = bottom_k(b.column(at), k, shingle)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(map(to_string, own), pa.string()),
                 pa.array([distinct(x, k) for x in own], pa.float64())],
                names=[*names, "fingerprint", "n_shingles"])

    schema = docs.select(*names, F.lit("").alias("fingerprint"), F.lit(0.0).alias("n_shingles")).schema
    return docs.select(*names).mapInArrow(run, schema)


def _batch(held: dict, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), kind), pa.array([to_string(x) for x in held.values()], pa.string())], names=["g", "f"])


def merge_fingerprints(df: DataFrame, by: str, fingerprint: str = "fingerprint", k: int = K) -> DataFrame:
    """(by, fingerprint) of each group.  Every partition merges its own rows
    first, so a group sends one row a partition however many rows it has."""
    def partial(batches):
        held: dict = {}
        for b in batches:
            for g, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if f is not None:
                    held[g] = merge(held.get(g, np.empty(0, np.uint64)), from_string(f), k)
            if len(held) >= 20_000:
                yield _batch(held, b.schema.field(0).type)
                held = {}
        if held:
            yield _batch(held, b.schema.field(0).type)

    kind = df.select(F.col(by).alias("g"), F.lit("").alias("f")).schema

    own = df.select(F.col(by).alias("g"), F.col(fingerprint).alias("f"))
    parts = own.mapInArrow(partial, kind)
    dealt = parts.repartition(shuffle_partitions(df.sparkSession), "g").sortWithinPartitions("g")

    def final(batches):
        last, held, begun = None, None, False
        for b in batches:
            for g, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if begun and g == last:
                    held = merge(held, from_string(f), k)
                    continue
                if begun:
                    yield _batch({last: held}, b.schema.field(0).type)
                last, held, begun = g, from_string(f), True
        if begun:
            yield _batch({last: held}, b.schema.field(0).type)

    return dealt.mapInArrow(final, kind).select(F.col("g").alias(by), F.col("f").alias("fingerprint"))


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_shingles double, in_edited double")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = K, shingle: int = 5) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third of the
    code points (rounded down) replaced by the first as many, or all, of the
    next document's.  The next document follows in descending id, the first
    follows the last; null ids come last, rows of equal ids by a text hash.

    near_edited and near_next estimate the resemblance to the edited text and
    to the next document; n_shingles the distinct shingles; in_edited the share
    of them that the edited text keeps.  A null text counts as empty, other
    columns are ignored, an empty table gives an empty result.

    Documents are dealt out by ranges of the id; the first row of each range is
    sent to the range before it too, so every row meets its next one.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = id_buckets(own.select("doc_id"), "doc_id", shuffle_partitions(spark))
    rows = own.select("*", bucket_of(F.col("doc_id"), cuts).alias("part"), F.xxhash64("text").alias("h"))
    top = rows.groupBy("part").agg(F.max("doc_id").alias("top"))
    heads = (rows.join(F.broadcast(top), "part").where(F.col("doc_id").eqNullSafe(F.col("top")))
             .groupBy("part", "top").agg(F.min("h").alias("top_h")))          # a row a range
    after = Window.orderBy("part")
    heads = heads.select("top", "top_h", F.col("part").alias("top_part"),
                         F.coalesce(F.lead("part").over(after), F.min("part").over(Window.partitionBy())).alias("to"))
    dealt = (rows.join(F.broadcast(heads), rows["doc_id"].eqNullSafe(heads["top"])
                       & (rows["h"] == heads["top_h"]) & (rows["part"] == heads["top_part"]), "left")
             .select("doc_id", "text", "h", F.explode(F.when(
                 F.col("to").isNull(), F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))))
                 .otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")),
                                    F.struct(F.col("to").alias("part"), F.lit(True).alias("guest"))))).alias("x"))
             .select("doc_id", "text", "h", "x.part", "x.guest"))
    placed = (dealt.repartitionById(len(cuts) + 1, "part")
              .sortWithinPartitions("guest", F.col("doc_id").desc_nulls_last(), "h")
              .select("doc_id", "text", "guest"))

    def chunk(held):
        """Rows but the last, each with the one behind it."""
        ids, texts, guests = zip(*held, strict=True)
        edited = [t[:len(t) - len(t) // 3] + u[:len(t) // 3] for t, u in zip(texts, texts[1:], strict=False)]
        fps, efps = bottom_k(pa.array(texts, pa.large_string()), k, shingle), \
            bottom_k(pa.array(edited, pa.large_string()), k, shingle)
        out = [(ids[i], len(texts[i]), hashlib.sha256(edited[i].encode()).hexdigest(), to_string(fps[i]),
                to_string(efps[i]), resemblance(fps[i], efps[i], k), resemblance(fps[i], fps[i + 1], k),
                distinct(fps[i], k), containment(fps[i], efps[i], k))
               for i in range(len(edited)) if not guests[i]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)]
            if out else [pa.array([], t) for t in _TYPES], names=[c.split()[0] for c in _OUT.split(", ")])

    def run(batches):
        held = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(row)
                if len(held) > 256:
                    yield chunk(held)
                    held = held[-1:]
        if len(held) > 1:
            yield chunk(held)

    return placed.mapInArrow(run, _OUT)


_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
