"""Fuzzy line dedup, in DataFrame functions only.

Lines are normalised and given a 64-bit SimHash of their distinct words (repeats
would let the commonest words of a language decide).  Lines whose
fingerprints differ in at most `radius` bits agree on `pieces - radius` of
`pieces` bit blocks, so they meet in a join on some choice of blocks; a pair
is a link if the edit similarity of the normalised lines is high enough.  Of
each connected group the first occurrence stays.  So a link is two things, few
bits and few edits: lines that are alike but further apart in bits are none.

Fingerprints are made where a line is read: 64 counters a byte wide in eight
longs take the words in, CHUNK words at a time, and chunks add up in counters
of 32 bits.  No word becomes a row.

Equal lines are one node, whatever the number of their occurrences.  Blocks are
counted first, dealt out by block as they are (nearly all are of one fingerprint,
which partial counts only hold in memory), and only lines of blocks that are shared go on.  Pairs are verified in two rounds: every line with the
next one of its block in order of size, then only pairs that the first round has
left in different groups, and blocks that it has made one group meet no more.  So
a large group of near copies costs a link a line, not a pair for every two.
Sizes that differ too much for the similarity rule a pair out before its texts
are fetched.  Intermediate tables are removed once nothing reads them.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framecurate.llm.common import staged
from framecurate.llm.components import connected_components
from framecurate.session import discard

_SIGN = 1 << 64
FEW = 1_000_000          # keys that a broadcast may have
CHUNK = 127              # words that counters of a byte can take, as longs have a sign
SHORT = 126              # words of a line that are counted without lambdas


#: White space and ASCII signs: all but letters and digits there, one by one, as
#: Java looks them up in a table then and tries no ranges.
_SIGNS = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
_LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def normalise(line: Column) -> Column:
    """Lower case; runs of white space and ASCII signs are one blank."""
    return F.trim(F.regexp_replace(F.lower(line), _SIGNS, " "))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, h, pos, norm, l1, l2): h a hash of the whole
    text, l1 and l2 the normalised line's 128-bit id; lines without letters or
    digits are left out, which is told from the line as it is, so that lines
    are normalised once."""
    own = docs.select("doc_id", F.xxhash64("text").alias("h"),
                      F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return (own.where(F.col("line").rlike(_LETTER))
            .select("doc_id", "h", "pos", normalise(F.col("line")).alias("norm"))
            .select("*", F.xxhash64("norm").alias("l1"), F.xxhash64(F.lit(1), "norm").alias("l2"),
                    F.length("norm").alias("size")))


def _lid() -> Column:
    """The line's id as 16 bytes."""
    return F.unhex(F.concat(F.lpad(F.hex("l1"), 16, "0"), F.lpad(F.hex("l2"), 16, "0")))


def _counters(hashes: str) -> str:
    """SQL: 32 longs of two counters each, over an array of hashes: the low half of
    number 4 k + m counts bit 8 m + k, the high half bit 32 + 8 m + k."""
    ones = sum(1 << 8 * j for j in range(8))
    eight = ", ".join(f"aggregate(p, 0L, (a, h) -> a + (shiftrightunsigned(h, {k}) & {ones}L))" for k in range(8))
    chunks = (f"transform(sequence(0, (size({hashes}) - 1) div {CHUNK}), i -> transform(array(slice({hashes}, "
              f"cast(i * {CHUNK} + 1 as int), {CHUNK})), p -> array({eight}))[0])")
    wide = 0xFF << 32 | 0xFF
    return (f"transform(array({chunks}), c -> array(" + ", ".join(
        f"aggregate(c, 0L, (t, x) -> t + (shiftrightunsigned(x[{k}], {8 * m}) & {wide}L))"
        for k in range(8) for m in range(4)) + "))[0]")


def _simhash(counters: Column, n: Column) -> Column:
    """A bit is set if it is in over half of n hashes.  Both counters of a long are
    told at once: 2^30 + n / 2 less a counter keeps bit 30 if that is half or less.
    The JVM compiles no method of over 8000 bytes, which a branch a bit would be."""
    most = (F.shiftright(n, 1) + F.lit(1 << 30).cast("long")) * F.lit(1 << 32 | 1)
    rare = F.lit(0).cast("long")
    for k in range(8):
        for m in range(4):
            left = most - F.coalesce(F.get(counters, F.lit(4 * k + m)), F.lit(0).cast("long"))
            kept, up = left.bitwiseAND(F.lit(1 << 62 | 1 << 30)), 8 * m + k - 30
            rare = rare.bitwiseOR(F.shiftleft(kept, up) if up > 0 else F.shiftrightunsigned(kept, -up))
    return F.bitwise_not(rare)


def _added(weights: list[list[str]], at: str = "{}") -> list[list[tuple[str, str]]]:
    """One level of adders of bits: weights[i] names longs whose bits count 2^i each; three
    become a sum and a carry, as two do where no lower carry can come.  Gives SQL and a
    name for each.  The sum is SHORT at most, so that the last weight has no carry."""
    out: list[list[str]] = [[] for _ in range(SHORT.bit_length())]
    lowest = next(i for i, names in enumerate(weights) if len(names) > 1)
    for i, names in enumerate(weights):
        own = [at.format(x) for x in names]
        while len(own) > 2 or len(own) == 2 and i == lowest:
            a, b, *c = own[:3]
            out[i].append(" ^ ".join(f"({x})" for x in (a, b, *c)))
            if i + 1 < len(out):
                out[i + 1].append(f"({a} & {b}) | ({c[0]} & ({a} | {b}))" if c else f"{a} & {b}")
            own = own[3:]
        out[i] += own
    return [[(sql, f"p{i}_{n}") for n, sql in enumerate(w)] for i, w in enumerate(out) if w]


def _over_half(planes: list[str], n: Column) -> Column:
    """Bits whose counts, written in `planes` from the lowest digit on, are over n / 2."""
    over = F.lit(0).cast("long")
    for i, p in enumerate(planes):
        digit = F.shiftright(F.shiftleft(F.shiftright(n, 1).cast("long"), 63 - i), 63)
        over = F.col(p).bitwiseAND(F.bitwise_not(digit)).bitwiseOR(
            F.bitwise_not(F.col(p).bitwiseXOR(digit)).bitwiseAND(over))
    return over


def _fingerprints(lines: DataFrame, key: list[str]) -> DataFrame:
    """(*key, sim) from (*key, hashes).  Lambdas are interpreted, so that only lines of
    over SHORT hashes are counted by them, the others by bits of longs."""
    weights = _added([[str(i) for i in range(SHORT)]], "coalesce(get(hashes, {}), 0L)")
    counted = lines.select(*key, F.size("hashes").alias("n"),
                           F.expr(f"if(size(hashes) > {SHORT}, {_counters('hashes')}, null)").alias("c"),
                           *[F.expr(sql).alias(name) for w in weights for sql, name in w])
    level, told = 1, F.col("c")
    by_lambdas = F.transform(F.array("c"), lambda c: _simhash(c, F.col("n")))[0]
    while any(len(w) > 1 for w in weights):
        weights, level = _added([[name for _, name in w] for w in weights]), level + 1
        if level == 4:           # a lambda here parts the levels into two methods that the JVM compiles
            told = F.when(F.col("n") > SHORT, by_lambdas).alias("c")
        counted = counted.select(*key, "n", told, *[F.expr(sql).alias(name) for w in weights for sql, name in w])
        told = F.col("c")
    short = _over_half([w[0][1] for w in weights], F.col("n"))
    return counted.select(*key, F.when(F.col("n") > SHORT, F.col("c")).otherwise(short).alias("sim"))


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, h, pos, lid, size, sim) of every line: size in characters, sim the
    SimHash of its distinct words."""
    key = ["doc_id", "h", "pos", "l1", "l2", "size"]
    hashes = _lines(docs).select(*key, F.expr("transform(array_distinct(split(norm, ' ')), w -> xxhash64(w))").alias("hashes"))
    return _fingerprints(hashes, key).select("doc_id", "h", "pos", _lid().alias("lid"), "size", "sim")


def _within(df: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """df's rows whose keys are in `few`: broadcast when counted to be under
    FEW rows of a few dozen bytes, else left to Spark's own join."""
    few = F.broadcast(few) if few.count() <= FEW else few
    same = F.lit(True)
    for c in on:         # a block is one long and never null, which Spark looks up as it is
        same = same & (df[c] == few[f"_{c}"] if c == "block" else df[c].eqNullSafe(few[f"_{c}"]))
    return df.join(few, same, "left_semi")


def _blocks(radius: int, pieces: int) -> list[int]:
    cut = [64 * i // pieces for i in range(pieces + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(cut, cut[1:], strict=False)]
    masks = [sum(c) for c in combinations(own, pieces - radius)]
    return [m - _SIGN if m >> 63 else m for m in masks]


def _budget(a: str, b: str, similarity: float) -> str:
    """SQL: the most edits between texts of sizes a and b that are alike."""
    return f"cast(floor({1 - similarity:.12f} * greatest({a}, {b}) + 1e-9) as int)"


def _shared(a: str, b: str, part: str) -> str:
    """SQL: the number of characters of the longest common start (part 'left') or
    end ('right') of two texts, by halving steps."""
    return (f"aggregate(sequence(28, 0), 0, (p, k) -> if(p + shiftleft(1, k) <= least(length({a}), length({b})) "
            f"AND {part}({a}, p + shiftleft(1, k)) = {part}({b}, p + shiftleft(1, k)), p + shiftleft(1, k), p))")


def _alike(a: str, b: str, similarity: float) -> Column:
    """Edit similarity of two texts is at least `similarity`.

    A common start and end, which change no distance, are left out of the
    comparison, and a small distance is tried first: the cost grows with the
    square of the length.  Each `exists` over an array of one value names it, so
    that it is worked out once wherever the optimizer moves the condition."""
    most = _budget(f"length({a})", f"length({b})", similarity)
    return F.expr(
        f"exists(array({_shared(a, b, 'left')}), s -> "
        f"exists(array(struct(substring({a}, s + 1) AS x, substring({b}, s + 1) AS y, {most} AS most)), q -> "
        f"exists(array({_shared('q.x', 'q.y', 'right')}), e -> "
        "exists(array(struct(left(q.x, length(q.x) - e) AS x, left(q.y, length(q.y) - e) AS y, q.most AS most)), r -> "
        "(32 < r.most AND levenshtein(r.x, r.y, 32) >= 0) OR levenshtein(r.x, r.y, r.most) >= 0))))")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    one = texts.select(F.col("lid").alias("a"), F.col("norm").alias("one"))
    two = texts.select(F.col("lid").alias("b"), F.col("norm").alias("two"))
    return pairs.distinct().join(one, "a").join(two, "b").where(_alike("one", "two", similarity)).select("a", "b")


def _met(sims: DataFrame, radius: int, pieces: int) -> DataFrame:
    """(block, sim, lid, size) of the distinct lines that share a block with another."""
    keys = F.explode(F.array(*[F.xxhash64(F.lit(t), F.col("sim").bitwiseAND(F.lit(m)))
                               for t, m in enumerate(_blocks(radius, pieces))]))
    by_block = sims.select("sim").distinct().select("sim", keys.alias("block"))
    shared = staged(by_block.select("block").repartition("block").groupBy("block").agg(F.count("*").alias("c"))
                    .where("c > 1").select(F.col("block").alias("_block")), "line-shared")
    meet = _within(by_block, shared, ["block"])
    equal = sims.groupBy("sim").agg(F.count("*").alias("c")).where("c > 1").select(
        "sim", F.xxhash64(F.lit(-1), "sim").alias("block"))
    met = staged(meet.unionByName(equal).join(sims, "sim").select("block", "sim", "lid", "size"), "line-blocks")
    discard(shared)
    return met


def line_components(docs: DataFrame, lines: DataFrame, radius: int = 3, pieces: int = 5,
                    similarity: float = 0.8) -> DataFrame:
    """(node, root) of the distinct lines that link to another; docs (doc_id,
    text), lines their occurrences."""
    sims = staged(lines.groupBy("lid").agg(F.first("sim").alias("sim"), F.first("size").alias("size")), "line-sims")
    met = _met(sims, radius, pieces)

    def near(sim, size):
        edits = _budget("size", "z2", similarity)
        return (F.bit_count(sim.bitwiseXOR(F.col("s2"))) <= radius) & F.expr(f"abs(size - z2) <= {edits}")

    def other(df, *more):
        return df.select(F.col("block").alias("b2"), F.col("sim").alias("s2"), F.col("size").alias("z2"),
                         F.col("lid").alias("b"), *more)

    # first every line with the next one of its block by size ...
    order = Window.partitionBy("block").orderBy("size", "lid")
    following = met.select("sim", "size", F.col("lid").alias("a"), F.lead("lid").over(order).alias("b"),
                           F.lead("sim").over(order).alias("s2"), F.lead("size").over(order).alias("z2"))
    chain = staged(following.where(F.col("b").isNotNull() & near(F.col("sim"), F.col("size"))).select("a", "b").distinct(),
                   "line-chain")
    texts = _texts(docs, lines, chain)
    first = staged(_verified(chain, texts, similarity), "line-first")
    groups = connected_components(first, "line-chain")

    # ... then the pairs that are still apart, in blocks of more than one group
    named = met.join(groups, met["lid"] == groups["node"], "left").select(
        "block", "sim", "size", "lid", F.coalesce("root", "lid").alias("group"))
    labelled = staged(named, "line-groups")
    mixed = staged(labelled.groupBy("block").agg(F.min("group").alias("g"), F.max("group").alias("g2")).where("g <> g2")
                   .select(F.col("block").alias("_block")), "line-mixed")
    open_rows = _within(labelled, mixed, ["block"])
    right = other(open_rows, F.col("group").alias("g2"))
    rest = staged(open_rows.join(right, (open_rows["block"] == right["b2"]) & (open_rows["lid"] < right["b"])
                                 & (open_rows["group"] != right["g2"]) & near(open_rows["sim"], open_rows["size"]))
                  .select(F.col("lid").alias("a"), "b").distinct(), "line-rest")
    more = _texts(docs, lines, rest)
    found = connected_components(first.unionByName(_verified(rest, more, similarity)), "line-links")
    discard(sims, met, chain, texts, first, groups, labelled, mixed, rest, more)
    return found


def _texts(docs: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lid, norm) of the lines in pairs, each read in one document that holds it."""
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("_lid")).distinct(), "line-wanted")
    place = F.struct("doc_id", "h")
    homes = staged(_within(lines.select("lid", "doc_id", "h"), wanted, ["lid"]).groupBy("lid").agg(
        F.min(place).alias("p")).select("lid", "p.doc_id", "p.h"), "line-homes")
    hosts = homes.select(F.col("doc_id").alias("_doc_id"), F.col("h").alias("_h")).distinct()
    held = _within(docs.withColumn("h", F.xxhash64("text")), hosts, ["doc_id", "h"]).select("doc_id", "text")
    texts = staged(_within(_lines(held).select(_lid().alias("lid"), "norm"), wanted, ["lid"])
                   .groupBy("lid").agg(F.first("norm").alias("norm")), "line-texts")
    discard(wanted, homes)
    return texts


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3,
                  pieces: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, h, dropped): the line numbers (from 0, ascending) of the
    documents, known by id and text hash, that repeat an earlier line.

    Occurrences are in order of id (null ids last), text hash and line number.
    Rows of equal id and text are one document.  Lines without letters or
    digits always stay; null and empty texts have no such lines.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = staged(_occurrences(own), "lines")
    comps = line_components(own, lines, radius, pieces, similarity)
    placed = lines.select("doc_id", "h", "pos", "lid")
    placed = placed.join(comps, placed["lid"] == comps["node"], "left").select(
        "doc_id", "h", "pos", F.coalesce("root", "lid").alias("g"))
    where = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "pos")
    firsts = placed.groupBy("g").agg(F.min(where).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    again = (placed.join(firsts, "g").where(~where.eqNullSafe(F.col("first")))
             .groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("pos")).alias("dropped")))
    return again


def _joined(own: DataFrame, again: DataFrame, i: str, h: Column) -> DataFrame:
    gone = again.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "dropped")
    return own.join(gone, own[i].eqNullSafe(gone["_d"]) & (h == gone["_h"]), "left")


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3,
                pieces: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row a row of docs: (doc_id, n_lines, n_kept, dropped), dropped as
    comma-joined line numbers.  A null text has no line, an empty one has one;
    very long texts and lines are taken whole, rows of equal id and text are told
    alike, and an empty table gives an empty result."""
    again = dropped_lines(docs, id_col, text_col, radius, pieces, similarity)
    breaks = F.octet_length(text_col) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit("")))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"),
                      F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"))
    out = _joined(own, again, "doc_id", own["h"])
    return out.select("doc_id", "n_lines", (F.col("n_lines") - F.coalesce(F.size("dropped"), F.lit(0))).alias("n_kept"),
                      F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3,
                pieces: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with the repeated lines taken out of the text; all columns and rows
    stay, whatever the columns' names."""
    own = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    i, t = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    again = staged(dropped_lines(docs, id_col, text_col, radius, pieces, similarity), "line-drops")
    hit = _joined(own.select(i, t), again, i, F.xxhash64(own[t])).where("dropped is not null")
    lines = hit.select(F.col(i).alias("doc_id"), F.xxhash64(t).alias("h"),
                       F.posexplode(F.split(t, "\n")).alias("pos", "line")).distinct()
    gone = again.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.explode("dropped").alias("_p"))
    kept = (lines.join(gone, lines["doc_id"].eqNullSafe(gone["_d"]) & (lines["h"] == gone["_h"])
                       & (lines["pos"] == gone["_p"]), "left_anti")
            .groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("l")))
    told = (again.join(kept, again["doc_id"].eqNullSafe(kept["doc_id"]) & (again["h"] == kept["h"]), "left")
            .select(again["doc_id"].alias("_d"), again["h"].alias("_h"),
                    F.coalesce(F.array_join(F.col("l.line"), "\n"), F.lit("")).alias("_new")))
    out = own.join(told, own[i].eqNullSafe(told["_d"]) & (F.xxhash64(own[t]) == told["_h"]), "left")
    return out.withColumn(t, F.coalesce("_new", t)).select(*own.columns).toDF(*docs.columns)
