"""Mixing sources to target weights, in DataFrame functions only.

Documents are counted into cells (one for each combination of the dimensions);
iterative proportional fitting rakes the cells' token weights until every
dimension's marginal has its target shares.  Only cells take part in the
sweeps, so a hot source is as many rows as it has languages and topics.
Documents are then sampled by calibrated probabilities: a cell's probability
is proportional to its raked over its own tokens, at most 1, with the factor
that makes the expected tokens meet the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framecurate.llm.common import staged

SWEEPS = 10


def token_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x09-\x0D\x20]+")), F.lit(0)).cast("long")


def form_topic(text: Column, tokens: Column) -> Column:
    """A topic by the text's form, for corpora without a topic column."""
    return (F.when(tokens == 0, "empty")
            .when(F.coalesce(text, F.lit("")).rlike("(AKIA|password|api_key|https?://|@)"), "technical")
            .when(tokens < 100, "note").when(tokens < 1000, "article").otherwise("book"))


def cells_of(docs: DataFrame, dims: list[str], tokens: str) -> DataFrame:
    """(dims, tokens, docs) of every combination that occurs; null is a value."""
    return docs.groupBy(*dims).agg(F.sum(tokens).cast("double").alias("_tokens"), F.count("*").alias("_docs"))


def tempered_targets(cells: DataFrame, powers: dict[str, float]) -> DataFrame:
    """(dim, value, share): a value's share of the tokens to a power below 1,
    scaled to sum to 1 within the dimension, which lifts small values."""
    out = None
    for dim, power in powers.items():
        one = cells.groupBy(F.col(dim).cast("string").alias("value")).agg(F.sum("_tokens").alias("t"))
        lifted = one.select("value", F.when(F.col("t") > 0, F.pow("t", F.lit(power))).otherwise(0.0).alias("p"))
        whole = lifted.agg(F.sum("p")).first()[0] or 1.0
        share = lifted.select(F.lit(dim).alias("dim"), "value", (F.col("p") / F.lit(whole)).alias("share"))
        out = share if out is None else out.unionByName(share)
    return out


def rake(cells: DataFrame, targets: DataFrame, dims: list[str], sweeps: int = SWEEPS) -> DataFrame:
    """cells with `_raked`: weights with the cells' total whose marginals have
    the target shares.

    A value without a target keeps its share of the tokens; the targets of a
    dimension are scaled to sum to 1 over the values that have tokens; a cell
    without tokens keeps weight 0.
    """
    whole = cells.agg(F.sum("_tokens")).first()[0] or 0.0
    out = cells.withColumn("_raked", F.col("_tokens"))
    for d in dims:
        goal = targets.where(F.col("dim") == d).select(F.col("value").alias("_v"), F.col("share").alias("_s"))
        one = cells.groupBy(d).agg(F.sum("_tokens").alias("_t")).where("_t > 0")
        one = one.join(goal, one[d].cast("string").eqNullSafe(goal["_v"]), "left").select(
            F.col(d).alias("_v"), F.coalesce("_s", F.col("_t") / F.lit(whole or 1.0)).alias("_s"))
        scale = one.agg(F.sum("_s")).first()[0] or 1.0
        one = one.select("_v", (F.col("_s") / F.lit(scale)).alias(f"_goal_{d}"))
        out = out.join(one, out[d].eqNullSafe(one["_v"]), "left").drop("_v")
    out = staged(out, "mix-cells")
    for n in range(sweeps):
        for d in dims:
            now = F.sum("_raked").over(Window.partitionBy(d))
            out = out.withColumn("_raked", F.when((F.col("_raked") > 0) & (now > 0), F.col("_raked")
                                                  * F.col(f"_goal_{d}") * F.lit(whole) / now).otherwise(0.0))
        if n % 2 or n == sweeps - 1:
            out = staged(out, "mix-sweep")
    return out.select(*cells.columns, "_raked")


def calibrate(raked: DataFrame, budget_tokens: float) -> DataFrame:
    """raked cells with `_probability` = min(1, f * raked / tokens), f being the
    factor whose expected tokens meet the budget (or all can be had: 1).  f is
    found in rounds: cells that are full leave the sums, and it rises."""
    factor = 0.0
    while True:
        full = F.col("_raked") * factor >= F.col("_tokens")
        got = raked.where("_tokens > 0 and _raked > 0").agg(
            F.sum(F.when(full, F.col("_tokens")).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_raked"))).alias("open")).first()
        if not got["open"] or got["full"] >= budget_tokens:
            break
        new = (budget_tokens - got["full"]) / got["open"]
        if new <= factor * (1 + 1e-12):
            break
        factor = new
    ratio = F.when(F.col("_tokens") > 0, F.col("_raked") / F.col("_tokens")).otherwise(0.0)
    return raked.withColumn("_probability", F.least(F.lit(1.0), F.lit(factor) * ratio))


def draw(id_col: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) that is fixed by the seed and the id (or, for a null
    id, the text)."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.concat(
        F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, dims: dict[str, Column], powers: dict[str, float] | None = None,
        targets: DataFrame | None = None, keep: float = 0.5, seed: int = 11, sweeps: int = SWEEPS,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with, behind their columns, one `_<dim>` a dimension, `_tokens`,
    `_weight` (raked over own tokens of the row's cell), `_probability` and
    `_selected`.

    dims: column by name.  Targets are a table (dim, value, share), or the own
    shares to the powers.  keep: budget as a share of all tokens.  A null in a
    dimension is a value of its own.  Texts without words have weight and
    probability 0 and are never drawn.  Rows of one id are drawn alike, an
    empty table stays empty.  Columns of docs may have any names that do not
    begin with an underscore.
    """
    own = docs.withColumn("_tokens", token_count(F.col(text_col)))
    own = own.select("*", *[c.alias(f"_{d}") for d, c in dims.items()])
    names = [f"_{d}" for d in dims]
    cells = staged(cells_of(own.select(*names, F.col("_tokens").alias("_n")), names, "_n"), "mix-cells")
    whole = cells.agg(F.sum("_tokens")).first()[0] or 0.0
    if targets is None:
        targets = tempered_targets(cells, {f"_{d}": (powers or {}).get(d, 1.0) for d in dims})
    else:
        targets = targets.select(F.concat(F.lit("_"), "dim").alias("dim"), "value", "share")
    done = calibrate(rake(cells, targets, names, sweeps), keep * whole)
    of = done.select(*[F.col(n).alias(f"_of{n}") for n in names],
                     F.when(F.col("_tokens") > 0, F.col("_raked") / F.col("_tokens")).otherwise(0.0).alias("_weight"),
                     "_probability")
    same = F.lit(True)
    for n in names:
        same = same & own[n].eqNullSafe(of[f"_of{n}"])
    out = own.join(of, same, "left").drop(*[f"_of{n}" for n in names])
    out = out.withColumns({c: F.when(F.col("_tokens") > 0, F.col(c)).otherwise(0.0)
                           for c in ("_weight", "_probability")})
    return out.withColumn("_selected", draw(F.col(id_col), F.col(text_col), seed) < F.col("_probability"))
