"""Exact top-k inner products by distributed histogram selection.

Every query is scored against every candidate, several times, and no score is
kept: tasks count the scores into bins, the counts are added up over all tasks,
and the bin that holds a query's kth score becomes its next, finer range.  Once
a range is one score wide, or holds as many scores as are still wanted, a last
pass keeps the scores from there on, and equal scores go to the smaller id.

Candidates and queries are packed into blocks of a bounded number of rows.
Candidate blocks are dealt out once, by their ids, so vectors that many rows share
weigh on no task, and stay where they are; a cell is one of them with a block of
queries.  Queries are broadcast, so they go in waves of a bounded number of bytes,
each through all rounds and past all candidates: the driver holds one wave,
whatever the number of queries or candidates.  A task adds up its cells' counts
and reports a query's bins from the top until they hold the scores still wanted,
for lower ones cannot hold the kth: that drops nothing and bounds what leaves a
task.  The last pass cuts ties per slice of candidates in the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framecurate.llm.common import scratch, shuffle_partitions, staged
from framecurate.session import discard

LIMIT = (1 << 62) - 1
BITS = 8                     # a round tells 2 ** BITS bins of a range apart
BINS = 1 << BITS
SLICE = 1024                 # candidates that are scored at once
WAVE_BYTES = 16 << 20        # of queries and their states that are broadcast at once
STATE_BYTES = 64             # that a query's state takes there

_BLOCK = "dim int, ids binary, data binary, norm double"
_QUERY = "qb int, dim int, ids binary, data binary, norms array<double>"


def _matrix(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.int32 if len(data) == 4 * rows * dim else np.int64
    return np.frombuffer(data, kind).reshape(rows, dim)


def _bytes(values: np.ndarray) -> bytes:
    low, high = (int(f(initial=0)) for f in (values.min, values.max))
    small = -(1 << 31) <= low and high < 1 << 31
    return values.astype(np.int32 if small else np.int64).tobytes()


def _norms(values: np.ndarray) -> np.ndarray:
    return np.sqrt((values.astype(np.float64) ** 2).sum(axis=1))


def _by_size(ids: pa.Array, vectors: pa.Array):
    """(dimension, ids, matrix) of the vectors of each dimension."""
    sizes = np.diff(vectors.offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        at = pa.array(np.flatnonzero(sizes == dim))
        flat = vectors.take(at).flatten().to_numpy(zero_copy_only=False)
        yield dim, ids.take(at).to_numpy(zero_copy_only=False), flat.astype(np.int64).reshape(len(at), dim)


def _pack(block_rows: int):
    def out(dim, held):
        ids, data = (np.concatenate(part) for part in zip(*held, strict=True))
        return pa.RecordBatch.from_pydict({
            "dim": pa.array([dim], pa.int32()), "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "data": pa.array([_bytes(data)], pa.binary()),
            "norm": pa.array([float(_norms(data).max(initial=0.0))])})

    def run(batches):
        open_blocks: dict[int, list] = {}
        for b in batches:
            for dim, ids, data in _by_size(b.column(0), b.column(1)):
                for s in range(0, len(ids), block_rows):
                    held = open_blocks.setdefault(dim, [])
                    held.append((ids[s:s + block_rows], data[s:s + block_rows]))
                    if sum(len(i) for i, _ in held) >= block_rows:
                        yield out(dim, open_blocks.pop(dim))
        for dim, held in open_blocks.items():
            yield out(dim, held)
    return run


def _pack_queries(rows: pa.Table) -> pa.Table:
    qb, got = rows["qb"][0].as_py(), []
    for dim, ids, data in _by_size(rows["id"].combine_chunks(), rows["v"].combine_chunks()):
        got.append((qb, dim, ids.astype(np.int64).tobytes(), _bytes(data), _norms(data).tolist()))
    cols = list(zip(*got, strict=True))
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                    names=["qb", "dim", "ids", "data", "norms"])


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products, set to LIMIT beyond it."""
    top = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in (q, c)]
    bound = top[0] * top[1] * q.shape[1]
    if bound < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if bound < LIMIT:
        return q.astype(np.int64) @ c.astype(np.int64).T
    return np.clip(q.astype(object) @ c.astype(object).T, -LIMIT, LIMIT).astype(np.int64)


def _slices(cell: dict):
    """Of a cell, slice by slice: the candidates' ids and each score's distance
    from the low end of its query's range, far below for a query's own rows."""
    q_ids = np.frombuffer(cell["q_ids"], np.int64)
    rows = np.array([s["row"] for s in cell["state"]])
    q = _matrix(cell["q_data"], len(q_ids), cell["dim"])[rows]
    q_ids = q_ids[rows]
    low = np.array([s["low"] for s in cell["state"]], np.int64)
    c_ids = np.frombuffer(cell["c_ids"], np.int64)
    c = _matrix(cell["c_data"], len(c_ids), cell["dim"])
    order = np.argsort(q_ids, kind="stable")
    for s in range(0, len(c_ids), SLICE):
        ids = c_ids[s:s + SLICE]
        far = _products(q, c[s:s + SLICE]) - low[:, None]
        first = np.searchsorted(q_ids[order], ids, "left")
        last = np.searchsorted(q_ids[order], ids, "right")
        for col in np.flatnonzero(first < last).tolist():
            far[order[first[col]:last[col]], col] = -1
        yield ids, far


def _state(cell: dict, name: str) -> np.ndarray:
    return np.array([s[name] for s in cell["state"]], np.int64)


_COUNTS = "qb int, dim int, row int, bin int, n long"


def _count(batches):
    """The tops of the task's histograms."""
    held: dict[tuple, list] = {}
    for b in batches:
        for cell in b.to_pylist():
            bits = _state(cell, "bits")
            mine = held.setdefault((cell["qb"], cell["dim"]), [
                _state(cell, "row"), _state(cell, "need"), np.zeros(len(bits) * (BINS + 1), np.int64)])
            shift = np.maximum(bits - BITS, 0)[:, None]
            base = (np.arange(len(bits)) * (BINS + 1))[:, None]
            for _, far in _slices(cell):
                within = (far >> bits[:, None]) == 0
                mine[2] += np.bincount((np.where(within, far >> shift, BINS) + base).ravel(), minlength=len(mine[2]))
            if len(held) > 16:
                yield from _tops(held)
                held = {}
    yield from _tops(held)


def _tops(held: dict):
    for (qb, dim), (rows, need, counts) in held.items():
        counts = counts.reshape(-1, BINS + 1)[:, :BINS]
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        r, b = np.nonzero((counts > 0) & (above < need[:, None]))
        yield pa.RecordBatch.from_pydict({
            "qb": pa.array(np.full(len(r), qb), pa.int32()), "dim": pa.array(np.full(len(r), dim), pa.int32()),
            "row": pa.array(rows[r], pa.int32()), "bin": pa.array(b, pa.int32()), "n": pa.array(counts[r, b])})


_KEPT = "query_id long, qb int, dim int, row int, vec_id long, score long"


def _keep(batches):
    """Scores from the low end of the located range on; of those inside it, the
    slice's first `need` by score and id."""
    for b in batches:
        for cell in b.to_pylist():
            rows, low, need, bits = (_state(cell, c) for c in ("row", "low", "need", "bits"))
            q_ids = np.frombuffer(cell["q_ids"], np.int64)[rows]
            for ids, far in _slices(cell):
                r, c = np.nonzero(far >= 0)
                if not len(r):
                    continue
                d = far[r, c]
                inside = d >> bits[r] == 0
                order = np.lexsort((ids[c], -d, ~inside, r))
                r, c, d, inside = r[order], c[order], d[order], inside[order]
                start = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
                place = np.arange(len(r)) - np.repeat(start, np.diff(np.append(start, len(r))))
                own = ~inside | (place < need[r])
                r, c, d = r[own], c[own], d[own]
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(q_ids[r]), "qb": pa.array(np.full(len(r), cell["qb"]), pa.int32()),
                    "dim": pa.array(np.full(len(r), cell["dim"]), pa.int32()),
                    "row": pa.array(rows[r], pa.int32()), "vec_id": pa.array(ids[c]), "score": pa.array(d + low[r])})


def _integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _asked(queries: DataFrame, state: DataFrame) -> DataFrame:
    """Each block of queries that have a state, once, with their states."""
    packed = state.groupBy("qb", "dim").agg(F.sort_array(F.collect_list(
        F.struct("row", "low", "bits", "need"))).alias("state"))
    return (queries.select("qb", "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
            .join(packed, ["qb", "dim"]))


def _cells(blocks: DataFrame, queries: DataFrame, state: DataFrame) -> DataFrame:
    """Each block of a wave's queries that have a state with each candidate block
    of its dimension, in the candidates' tasks."""
    return (blocks.select("dim", F.col("ids").alias("c_ids"), F.col("data").alias("c_data"))
            .join(F.broadcast(_asked(queries, state)), "dim")
            .select("qb", "dim", "q_ids", "q_data", "state", "c_ids", "c_data"))


def _narrowed(state: DataFrame, counts: DataFrame) -> DataFrame:
    """The state after a round: the bin that holds the last score still wanted."""
    each = counts.groupBy("qb", "dim", "row", "bin").agg(F.sum("n").alias("n"))
    tops = each.groupBy("qb", "dim", "row").agg(F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False).alias("tops"))
    hit = F.aggregate("tops", F.struct(F.lit(0).cast("long").alias("above"), F.lit(-1).alias("bin"), F.lit(0).cast("long").alias("n")),
                      lambda a, x: F.when(a["above"] + a["n"] >= F.col("need"), a).otherwise(
                          F.struct((a["above"] + a["n"]).alias("above"), x["bin"].alias("bin"), x["n"].alias("n"))))
    shift = F.greatest(F.col("bits") - BITS, F.lit(0))
    got = state.join(tops, ["qb", "dim", "row"], "left").withColumn("hit", hit).withColumn(
        "short", F.coalesce(F.col("hit.above") + F.col("hit.n") < F.col("need"), F.lit(True)))
    left = F.col("need") - F.col("hit.above")
    return got.select(
        "qb", "dim", "row",
        F.when(F.col("short"), F.col("low")).otherwise(
            F.expr(f"low + shiftleft(cast(hit.bin as bigint), greatest(bits - {BITS}, 0))")).alias("low"),
        F.when(F.col("short"), F.col("bits")).otherwise(shift).alias("bits"),
        F.when(F.col("short"), F.col("need")).otherwise(left).alias("need"),
        (F.col("short") | (shift == 0) | (F.col("hit.n") == left)).alias("located"))


def _top_of(blocks: DataFrame, queries: DataFrame, longest: float, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of one wave of queries; longest is the
    candidates' largest norm."""
    reach = F.least(F.ceil(F.col("norm") * longest * (1 + 1e-9) + 1.0), F.lit(LIMIT))
    state = (queries.select("qb", "dim", F.posexplode("norms").alias("row", "norm"))
             .select("qb", "dim", "row", reach.cast("long").alias("reach"))
             .select("qb", "dim", "row", (-F.col("reach")).alias("low"),
                     (F.length(F.bin("reach")) + 1).alias("bits"), F.lit(k).cast("long").alias("need")))
    open_rows = staged(state.withColumn("located", F.lit(False)), "topk-ranges")
    while open_rows.where("NOT located").limit(1).count():
        now = open_rows.where("NOT located").drop("located")
        counts = _cells(blocks, queries, now).mapInArrow(_count, _COUNTS)
        after = staged(_narrowed(now, counts).unionByName(open_rows.where("located")), "topk-ranges")
        discard(open_rows)
        open_rows = after
    kept = _cells(blocks, queries, open_rows.drop("located")).mapInArrow(_keep, _KEPT)
    order = Window.partitionBy("query_id", "qb", "dim", "row").orderBy(F.desc("score"), "vec_id")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256, block_rows: int = 4096, block_queries: int = 1024,
          wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row for which is_query holds,
    the k rows with the highest inner products, ties to the smaller id.

    Components are taken as floor(scale * x).  Rows of the query's own id are no
    candidates of it.  Rows with a null id, a null vector or a null, NaN or
    infinite component take no part; vectors meet only those of their own
    length (empty ones score 0).  Every other row is a candidate and, if chosen,
    a query of its own, repeated rows and ids too.  A query with fewer than k
    candidates returns all, one without any has no row, and an empty table
    gives no rows.  Products beyond 2^62 - 1 in size count as that number.
    Columns other than the id and the vector are ignored.
    """
    odd = F.exists("v0", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v0"),
                           F.coalesce(is_query, F.lit(False)).alias("is_query"))
            .where(F.col("id").isNotNull() & F.col("v0").isNotNull() & ~odd)
            .select("id", _integers(F.col("v0"), scale).alias("v"), "is_query"))
    spark = vectors.sparkSession
    # dealt out: however the rows lie in files, every task gets some of the candidates
    blocks = staged(rows.select("id", "v").mapInArrow(_pack(block_rows), _BLOCK)
                    .repartition(shuffle_partitions(spark), "ids"), "topk-candidates")
    n_queries = rows.where("is_query").count()
    n_blocks = max(1, -(-n_queries // block_queries))
    queries = staged(rows.where("is_query").select("id", "v", F.expr(f"cast(pmod(xxhash64(id), {n_blocks}) as int)").alias("qb"))
                     .groupBy("qb").applyInArrow(_pack_queries, _QUERY), "topk-queries")
    longest = blocks.agg(F.max("norm")).first()[0] or 0.0
    sent = queries.agg(F.sum(F.length("data") + F.length("ids") + F.size("norms") * STATE_BYTES)).first()[0] or 0
    waves = min(n_blocks, -(-sent // wave_bytes)) or 1
    if waves == 1:
        return _top_of(blocks, queries, longest, k)
    path = scratch(spark, "topk-found")
    for wave in range(waves):
        found = _top_of(blocks, queries.where(F.col("qb") % waves == wave), longest, k)
        found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path)
