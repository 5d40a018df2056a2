"""Secret scans with multipart credential linking, in DataFrame functions only.

Base kinds are reported wherever they match.  Weak kinds (login names, bare
key strings, endpoints) are candidates: an interval join looks for a part of a
complementary role within the candidate's scope, `scope` code points to either
side in the same text, and only candidates that have one are reported.

Positions come from splitting a text at the matches: the pieces' and matches'
lengths, summed along the text, give each match's start and end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framecurate.llm.common import staged

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
#: kind, pattern, condition on the match; in the order of the report.  A run of
#: one class that is long enough is the same match with the length in the
#: pattern; the value of an assignment is measured afterwards, for a short one
#: still takes its place in the text.
KINDS: list[tuple[str, str, str]] = [
    ("assign", ASSIGN, "value"),
    ("access", r"AKIA[A-Z0-9]{16,}", ""),
    ("hex", r"[0-9a-f]{24,}", ""),
    ("login", r"""(?i:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", ""),
    ("key", r"[A-Za-z0-9+/]{40,}", "mixed"),
    ("endpoint", r"""https?://[^\x09-\x0D\x20"'<>]+""", ""),
]
BASE = 3                                    # kinds that need no link
#: What a weak kind is linked to: a login to any secret, a key to an access
#: identifier or login, an endpoint to any secret.
COMPLEMENTS = {"login": ("assign", "hex", "key"), "key": ("access", "login"),
               "endpoint": ("assign", "hex", "key")}
SCOPE = 200
BIN = 512                                   # code points of a join bin


def _sound(match: Column, rule: str) -> Column:
    if rule == "value":
        return F.length(F.regexp_extract(match, ASSIGN, 2)) >= 6
    if rule == "mixed":
        return match.rlike("[A-Z]") & match.rlike("[a-z]") & match.rlike("[0-9]")
    return F.lit(True)


def _hit(number: int, rule: str):
    def row(z: Column, nth: Column) -> Column:
        return F.struct(F.lit(number).alias("kind"), nth.alias("nth"), F.length(z["gap"]).alias("gap"),
                        F.length(z["hit"]).alias("size"), _sound(z["hit"], rule).alias("sound"))
    return row


def _found(text: Column) -> Column:
    """Array of (kind, nth, gap before the match, size, sound) over all kinds."""
    kinds = []
    for number, (_, pattern, rule) in enumerate(KINDS):
        both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
        kinds.append(F.when(text.rlike(pattern), F.transform(both, _hit(number, rule))))
    empty = F.array().cast("array<struct<kind:int,nth:int,gap:int,size:int,sound:boolean>>")
    return F.concat(*[F.coalesce(k, empty) for k in kinds])


_KEY = ["doc_id", "h", "n"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, n, text): rows of equal id and text share what is found."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"),
                       F.length(text).alias("n"), text.alias("text"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"]) & (a["n"] == b["n"])


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, n, kind, start, end) of every sound match, base and weak."""
    hits = (_keyed(docs, id_col, text_col).select(*_KEY, F.explode(_found(F.col("text"))).alias("m"))
            .select(*_KEY, "m.kind", "m.nth", "m.gap", "m.size", "m.sound")
            .where("size is not null").distinct())
    along = Window.partitionBy(*_KEY, "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("size")).over(along)
    return (hits.withColumn("end", end).where("sound")
            .select(*_KEY, "kind", (F.col("end") - F.col("size")).alias("start"), "end"))


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans that have a complementary part within the scope, neither
    overlapping the other: an interval join over bins of the text."""
    names = [k for k, _, _ in KINDS]
    pairs = [(names.index(w), names.index(p)) for w, parts in COMPLEMENTS.items() for p in parts]
    wanted = F.array(*[F.struct(F.lit(w).alias("weak"), F.lit(p).alias("part")) for w, p in pairs])
    weak = (spans.where(F.col("kind") >= BASE)
            .withColumn("bin", F.explode(F.sequence(
                F.floor((F.col("start") - scope) / BIN), F.floor((F.col("end") + scope) / BIN))))
            .withColumn("w", F.explode(wanted)).where("w.weak = kind")
            .withColumn("want", F.col("w.part")).drop("w"))
    parts = spans.select(F.col("doc_id").alias("p_doc"), F.col("h").alias("p_h"), F.col("n").alias("p_n"),
                         F.col("kind").alias("p_kind"), F.col("start").alias("p_start"), F.col("end").alias("p_end"),
                         F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor((F.col("end") - 1) / BIN)))
                         .alias("p_bin"))
    near = ((F.col("p_start") <= F.col("end") + scope) & (F.col("p_end") >= F.col("start") - scope)
            & ((F.col("p_start") >= F.col("end")) | (F.col("p_end") <= F.col("start"))))
    on = (weak["doc_id"].eqNullSafe(parts["p_doc"]) & (weak["h"] == parts["p_h"]) & (weak["n"] == parts["p_n"])
          & (weak["bin"] == parts["p_bin"]) & (weak["want"] == parts["p_kind"]) & near)
    return weak.join(parts, on, "left_semi").select(*spans.columns).distinct()


def _text(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k, _, _ in KINDS])
    one = F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row a row of docs: (doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_linked).  Spans are code points, the end exclusive.

    A null text counts as empty and has no spans; rows of equal id and text get
    the same spans; null ids are kept; other columns are ignored.
    """
    spans = staged(candidates(docs, id_col, text_col), "secret-spans")
    told = spans.where(F.col("kind") < BASE).unionByName(linked(spans, scope))
    order = F.struct("start", "kind", "end")
    number = {k: i for i, (k, _, _) in enumerate(KINDS)}
    each = told.groupBy(*_KEY).agg(
        *[F.count(F.when(F.col("kind") == number[k], 1)).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.count(F.when(F.col("kind") >= BASE, 1)).alias("n_linked"),
        F.collect_list(F.when(F.col("kind") < BASE, order)).alias("base"), F.collect_list(order).alias("every"))
    own = _keyed(docs, id_col, text_col).drop("text")
    return own.join(each, _same(own, each), "left").select(
        own["doc_id"], *[F.coalesce(F.col(f"n_{k}"), F.lit(0).cast("long")).alias(f"n_{k}")
                         for k in ("assign", "access", "hex")],
        F.sha2(F.coalesce(_text(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_text(F.col("every")), F.lit("")).alias("spans"),
        F.coalesce(F.col("n_linked"), F.lit(0).cast("long")).alias("n_linked"))
