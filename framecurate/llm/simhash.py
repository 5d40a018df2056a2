"""SimHash near-duplicates with a bit-sliced distance comparison.

Fingerprints of w-word shingles are computed per document; equal fingerprints
are grouped first, so copies never meet each other.  Distinct fingerprints
that differ in at most `radius` of 64 bits agree wholly on at least
`pieces - radius` of `pieces` bit ranges, so every such choice of ranges is a
table whose rows are dealt out by the bits in those ranges.  Within a bucket
the fingerprints are stored as 64 vertical bit planes; one pass over the
planes updates the distances of a query to 64 lanes a machine word with
carry-save counters, and queries (and whole blocks) whose lanes all exceed the
radius are abandoned.  Buckets larger than a block are cut into blocks and the
block pairs are dealt out again as work units, so no task holds a hot bucket's
comparisons.  Of a block's links only a spanning forest leaves the task.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framecurate.llm.common import shuffle_partitions, staged
from framecurate.llm.components import connected_components

LANES = 512          # lanes of a block that small buckets are packed into
UNIT = 2048          # lanes of each half of a work unit cut from a large bucket


def simhash64(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of UTF-8 bytes: A-Z lower-cased, words split at ASCII
    white space, XXH64 (seed 42) of the space-joined shingles, a bit set if it
    is set in over half of them.  No words (or null): zero."""
    from xxhash import xxh64_intdigest
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: 1 - shingle].tolist()
    hashes = np.array([xxh64_intdigest(joined[s:e], 42)
                       for s, e in zip(starts, ends[shingle - 1:].tolist(), strict=True)],
                      dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at:at + 8192]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(on.view("<u8")[0])


def fingerprints(docs: DataFrame, text: str, shingle: int = 3) -> DataFrame:
    """docs with a column `_fp` (long, the 64 bits) put behind its columns."""
    names = docs.columns

    def run(batches):
        for b in batches:
            texts = b.column(names.index(text)).cast(pa.large_binary()).to_pylist()
            fp = np.array([simhash64(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], names=[*names, "_fp"])

    schema = docs.select("*", F.lit(0).cast("long").alias("_fp")).schema
    return docs.mapInArrow(run, schema)


# ---------------------------------------------------------------- bit slicing

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """uint64[n] -> uint64[64, ceil(n/64)]: plane b holds bit b of every lane."""
    n = len(fps)
    bits = np.zeros((-(-n // 64) * 64, 64), np.uint8)
    bits[:n] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near_lanes(queries: np.ndarray, planes: np.ndarray, lanes: int, radius: int):
    """Rows of `queries` that have a lane within the radius, and per such row
    the lanes as a bit set (uint64 words)."""
    width = planes.shape[1]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    pad = np.zeros(width, np.uint64)
    if lanes % 64:
        pad[-1] = full << np.uint64(lanes % 64)
    rows = np.arange(len(queries))
    flip = np.zeros((64, len(queries)), np.uint64)
    for b in range(64):
        flip[b] = (np.uint64(0) - ((queries >> np.uint64(b)) & np.uint64(1)))
    digits = max(1, radius.bit_length())
    counter = [np.zeros((len(queries), width), np.uint64) for _ in range(digits)]
    over = np.broadcast_to(pad, (len(queries), width)).copy()
    for b in range(0, 64, 2):
        x = planes[b] ^ flip[b][:, None]
        y = planes[b + 1] ^ flip[b + 1][:, None]
        low = counter[0]
        part = low ^ x                              # full adder: low + x + y
        carry = (low & x) | (part & y)
        counter[0] = part ^ y
        for k in range(1, digits):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry                               # beyond what the digits hold
        if b % 8 == 6:
            alive = ~(over == full).all(axis=1)
            if not alive.any():
                return rows[:0], over[:0]
            if alive.sum() < 0.8 * len(alive):
                rows, over, flip = rows[alive], over[alive], flip[:, alive]
                counter = [c[alive] for c in counter]
    if radius != (1 << digits) - 1:                 # count > radius, digit by digit
        more, same = np.zeros_like(over), np.full_like(over, full)
        for k in reversed(range(digits)):
            if radius >> k & 1:
                same &= counter[k]
            else:
                more |= same & counter[k]
                same &= ~counter[k]
        over |= more
    near = ~over
    hit = near.any(axis=1)
    return rows[hit], near[hit]


def spanning_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Index pairs of a spanning forest of the links within one block."""
    n = len(fps)
    if n < 2:
        return []
    planes, near = bit_planes(fps), {}
    for at in range(0, n, 512):
        rows, sets = near_lanes(fps[at:at + 512], planes, n, radius)
        for r, s in zip(rows.tolist(), sets, strict=True):
            near[at + r] = int.from_bytes(s.tobytes(), "little") & ~(1 << (at + r))
    out, left = [], sum(1 << i for i, s in near.items() if s)
    while left:
        start = (left & -left).bit_length() - 1
        left &= ~(1 << start)
        todo = [start]
        while todo:
            u = todo.pop()
            new = near.get(u, 0) & left
            left &= ~new
            while new:
                v = (new & -new).bit_length() - 1
                new &= new - 1
                out.append((u, v))
                todo.append(v)
    return out


def _ranges(pieces: int) -> list[tuple[int, int]]:
    cut = [64 * i // pieces for i in range(pieces + 1)]
    return list(zip(cut[:-1], cut[1:], strict=True))


def _masks(radius: int, pieces: int) -> list[int]:
    if pieces <= radius:
        raise ValueError("pieces must exceed the radius")
    own = [((1 << (b - a)) - 1) << a for a, b in _ranges(pieces)]
    return [sum(c) for c in combinations(own, pieces - radius)]


def _table_rows(fps: DataFrame, radius: int, pieces: int) -> DataFrame:
    """(t, key, fp): one row a fingerprint and table, key the bits compared."""
    signed = [m - (1 << 64) if m >> 63 else m for m in _masks(radius, pieces)]
    return fps.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "key")).select("t", "key", "fp")


LINKS = "a long, b long, left binary, right binary"


def _compare(radius: int):
    """Rows sorted by (t, key) -> links of the small buckets, and work units of
    the large ones (left, right: fingerprints of two blocks)."""
    def out(links=(), units=()):
        links, units = list(links), list(units)
        return pa.RecordBatch.from_arrays([
            pa.array([x for x, _ in links] + [None] * len(units), pa.int64()),
            pa.array([y for _, y in links] + [None] * len(units), pa.int64()),
            pa.array([None] * len(links) + [x.tobytes() for x, _ in units], pa.binary()),
            pa.array([None] * len(links) + [y.tobytes() for _, y in units], pa.binary()),
        ], names=["a", "b", "left", "right"])

    def block(fps):
        fps = np.unique(fps)
        ids = fps.view(np.int64).tolist()
        return [(ids[i], ids[j]) for i, j in spanning_links(fps, radius)]

    def run(batches):
        packed, lanes = [], 0              # small buckets waiting for a full block
        held, last = [], None              # the bucket still being read
        full, now = [], 0                  # its blocks that are full

        def close():
            nonlocal packed, lanes, held, full, now
            fps = np.concatenate(held) if held else np.empty(0, np.uint64)
            if full:                       # a large bucket: all pairs of blocks as units
                blocks = [*full, fps]
                for i in range(len(blocks)):
                    for j in range(i + 1, len(blocks)):
                        yield out(units=[(blocks[i], blocks[j])])
            elif len(fps) > 1:
                if lanes + len(fps) > LANES and packed:
                    yield out(links=block(np.concatenate(packed)))
                    packed, lanes = [], 0
                packed.append(fps)
                lanes += len(fps)
            held, full, now = [], [], 0

        for b in batches:
            if not b.num_rows:
                continue
            t, key = b.column(0).to_numpy(), b.column(1).to_numpy()
            fps = b.column(2).to_numpy().view(np.uint64)
            cut = np.concatenate([[0], np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1,
                                  [len(t)]])
            own = np.diff(cut) > 1         # single rows inside a batch have no partner
            own[0] = own[-1] = True        # but a bucket may go on in the next batch
            for s, e in zip(cut[:-1][own].tolist(), cut[1:][own].tolist(), strict=True):
                if (mine := (t[s], key[s])) != last:
                    yield from close()
                    last = mine
                held.append(fps[s:e])
                now += e - s
                while now > UNIT:
                    flat = np.concatenate(held)
                    full.append(flat[:UNIT])
                    held, now = [flat[UNIT:]], now - UNIT
        yield from close()
        if packed:
            yield out(links=block(np.concatenate(packed)))

    return run


def _units(radius: int):
    def run(batches):
        for b in batches:
            for left, right in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fps = np.unique(np.frombuffer(left + right, np.uint64))
                ids = fps.view(np.int64)
                pairs = np.array(spanning_links(fps, radius), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], names=["a", "b"])
    return run


def fingerprint_links(fps: DataFrame, radius: int = 3, pieces: int = 5) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) whose components equal
    those of all pairs at most `radius` bits apart."""
    spark = fps.sparkSession
    rows = _table_rows(fps, radius, pieces)
    dealt = rows.repartition(shuffle_partitions(spark), "t", "key").sortWithinPartitions("t", "key")
    first = staged(dealt.mapInArrow(_compare(radius), LINKS), "simhash-links")
    units = first.where("left is not null").select("left", "right")
    return first.where("a is not null").select("a", "b").unionByName(
        units.repartition(shuffle_partitions(spark)).mapInArrow(_units(radius), "a long, b long"))


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, pieces: int) -> DataFrame:
    """(doc_id, fp, root, component_id), one row a row of docs."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fps = staged(fingerprints(own, "text", shingle).select("doc_id", F.col("_fp").alias("fp")),
                 "simhash-fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comps = connected_components(fingerprint_links(nodes.select("fp"), radius, pieces), "simhash")
    rooted = nodes.join(comps, nodes.fp == comps.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return fps.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, radius: int = 3, pieces: int = 5) -> DataFrame:
    """One row a row of docs: (doc_id, fp long, component_id).

    Fingerprints at most `radius` bits apart link; component_id is the least
    non-null id in the connected component.  A null or empty text has the
    fingerprint zero and links like any other; a null id takes part but never
    names a component (null if all its ids are null).  Equal rows stay equal
    rows.  An empty table gives an empty result; other columns are ignored.
    """
    return _rooted(docs, id_col, text_col, shingle, radius, pieces).drop("root")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           shingle: int = 3, radius: int = 3, pieces: int = 5) -> DataFrame:
    """docs without near-duplicates: of each component the row of the least id
    stays (repeated rows of it: one; a component of null ids: one of its rows).
    All columns are kept, whatever their names."""
    named = _rooted(docs, id_col, text_col, shingle, radius, pieces)
    keep = (named.groupBy("root").agg(
        F.min("component_id").alias("_kid"),
        F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("fp"))).alias("_kfp"))
        .select("_kid", "_kfp"))
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    i, t = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    rows = fingerprints(own, t, shingle)
    got = rows.join(keep, rows[i].eqNullSafe(keep["_kid"]) & (rows["_fp"] == keep["_kfp"]), "left_semi")
    w = Window.partitionBy(i, "_fp").orderBy(F.xxhash64(t))
    return (got.withColumn("_nth", F.row_number().over(w)).where("_nth = 1")
            .select(*own.columns).toDF(*docs.columns))
