"""T3 background throttle by pointer jumping: one camera's history on many tasks.

Whether a background frame is saved depends on the last saved one alone, by time.
So every frame points to the first frame of its stretch that is an interval or
more later, and the saved frames are those on the chain that begins at the
stretch's first frame.  A stretch begins with a reset, or behind a manual save,
whose time then starts the chain.  Pointers double every round, so a chain of n
frames takes log n rounds of joins.

Pointers come from a sorted search inside an interval's length of one camera and,
where that is empty, from the next interval that holds frames: a row an interval
is searched in groups of SPAN, and a row a group behind that.  No task holds a
camera's frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framecurate.operators.state_machine import CONTROL_MANUAL, CONTROL_RESET, DEFAULT_BACKGROUND_US
from framecurate.session import discard, stage

SPAN = 1024          # intervals in a group
_ROW = ["cam", "us", "frame_id"]


def _before(df: DataFrame, value: str, group: str) -> DataFrame:
    """df with the sum of `value` over the camera's earlier rows: inside a group of
    rows first, then over the groups' sums."""
    inner = Window.partitionBy("cam", group).orderBy("us", "frame_id").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy("cam").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    base = df.groupBy("cam", group).agg(F.sum(value).alias("s")).withColumn("base", F.coalesce(F.sum("s").over(along), F.lit(0))).drop("s")
    return (df.withColumn("own", F.coalesce(F.sum(value).over(inner), F.lit(0))).join(base, ["cam", group])
            .withColumn("before", F.col("own") + F.col("base")).drop("own", "base"))


def _stretches(rows: DataFrame, interval_us: int) -> DataFrame:
    """rows with their stretch: the resets up to a row and the manual saves before it."""
    reset, manual = F.col("control").eqNullSafe(CONTROL_RESET), F.col("control").eqNullSafe(CONTROL_MANUAL)
    events = rows.withColumn("event", (reset | manual).cast("int")).withColumn("group", F.floor(F.col("us") / F.lit(interval_us * SPAN)))
    return _before(events, "event", "group").withColumn("stretch", F.col("before") + reset.cast("int")).drop("before", "event", "group")


def _next(frames: DataFrame, interval_us: int) -> DataFrame:
    """(cam, us, frame_id, to): `to` is the stretch's first frame an interval or more
    later, (us, frame_id), of the frames that have one."""
    place = F.struct("us", "frame_id")
    held = frames.select("cam", "stretch", F.floor(F.col("us") / interval_us).alias("slot"), F.col("us").alias("at"), F.lit(1).alias("kind"),
                         "us", "frame_id")
    asks = frames.select("cam", "stretch", (F.floor(F.col("us") / interval_us) + 1).alias("slot"), (F.col("us") + interval_us).alias("at"),
                         F.lit(0).alias("kind"), "us", "frame_id")
    both = held.unionByName(asks)
    down = Window.partitionBy("cam", "stretch", "slot").orderBy(F.desc("at"), F.desc("kind"), F.desc("frame_id"))
    found = (both.withColumn("to", F.last(F.when(F.col("kind") == 1, place), ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0)))
             .where("kind = 0").select("cam", "stretch", "slot", "us", "frame_id", "to"))
    # the first frame of the next slot that holds any
    firsts = both.groupBy("cam", "stretch", "slot").agg(F.min(F.when(F.col("kind") == 1, place)).alias("first")) \
        .withColumn("group", F.floor(F.col("slot") / SPAN))
    groups = firsts.groupBy("cam", "stretch", "group").agg(F.min("first").alias("first"))
    inside = Window.partitionBy("cam", "stretch", "group").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = Window.partitionBy("cam", "stretch").orderBy(F.desc("group")).rowsBetween(Window.unboundedPreceding, -1)
    far = groups.select("cam", "stretch", "group", F.last("first", ignorenulls=True).over(beyond).alias("beyond"))
    after = (firsts.withColumn("inside", F.last("first", ignorenulls=True).over(inside)).join(far, ["cam", "stretch", "group"])
             .select("cam", "stretch", "slot", F.coalesce("inside", "beyond").alias("after")))
    return (found.join(after, ["cam", "stretch", "slot"]).select("cam", "us", "frame_id", F.coalesce("to", "after").alias("to"))
            .where("to IS NOT NULL"))


def _roots(frames: DataFrame, rows: DataFrame, interval_us: int) -> DataFrame:
    """Each stretch's first saved frame."""
    starts = rows.where(F.col("control").eqNullSafe(CONTROL_MANUAL)).select(
        "cam", (F.col("stretch") + 1).alias("stretch"), (F.col("us") + interval_us).alias("not_before"))
    open_frames = frames.join(starts, ["cam", "stretch"], "left").where("not_before IS NULL OR us >= not_before")
    return (open_frames.groupBy("cam", "stretch").agg(F.min(F.struct("us", "frame_id")).alias("r"))
            .select("cam", "r.us", "r.frame_id"))


def background_throttle(rows: DataFrame, interval_us: int = DEFAULT_BACKGROUND_US) -> DataFrame:
    """(camera_id, frame_id, us, kept, manual_save) of rows (camera_id, frame_id, us,
    has_cats, control); kept is null for frames with cats or without a verdict.

    Equals the fold of ``route_frames``.  Frames are known by camera (null is one)
    and frame_id and ordered by (us, frame_id); an empty table gives no rows."""
    if interval_us < 1:
        raise ValueError("the interval must be a microsecond at least")
    own = rows.select("camera_id", F.coalesce(F.concat(F.lit("c"), "camera_id"), F.lit("")).alias("cam"),
                      "frame_id", "us", "has_cats", "control")
    placed = stage(_stretches(own, interval_us), "throttle-rows")
    frames = placed.where("NOT has_cats").select("cam", "stretch", "us", "frame_id")
    jump = stage(_next(frames, interval_us), "throttle-next")
    kept = stage(_roots(frames, placed, interval_us), "throttle-kept")
    while True:
        ahead = kept.join(jump, _ROW).select("cam", "to.us", "to.frame_id")
        more = stage(ahead, "throttle-ahead")
        if not more.limit(1).count():
            discard(more)
            break
        second = jump.select("cam", "us", "frame_id", F.col("to").alias("next"))
        far = stage(jump.select("cam", F.col("us").alias("from_us"), F.col("frame_id").alias("from_id"), "to.us", "to.frame_id")
                    .join(second, _ROW).select("cam", F.col("from_us").alias("us"), F.col("from_id").alias("frame_id"),
                                               F.col("next").alias("to")), "throttle-next")
        now = stage(kept.unionByName(more).distinct(), "throttle-kept")
        discard(kept, jump, more)
        kept, jump = now, far
    saved = kept.withColumn("saved", F.lit(True))
    return placed.join(saved, _ROW, "left").select(
        "camera_id", "frame_id", "us", F.when(~F.col("has_cats"), F.coalesce("saved", F.lit(False))).alias("kept"),
        F.col("control").eqNullSafe(CONTROL_MANUAL).alias("manual_save"))
