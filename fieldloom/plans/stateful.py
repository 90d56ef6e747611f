"""Folds and trackers over scans; folds have recursive SQL beside them, trackers hand-worked sequences in the tests."""

from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators import folds as O
from ..operators import scoring as S
from ..operators import tracking as K
from .tables import KEY, WITH_BOXES, WITH_SLICES, WITH_TRACKS, boxes, events, slices, tracks


def _marks(s, d):
    """Borders that alternate between a start and an end, ten frames apart."""
    frames = slices(s, d).select("scan_id", "frame").distinct()
    step = F.col("frame") % 20
    return frames.select("scan_id", "frame", F.when(step.between(2, 8), 900.0 - 60 * step).alias("start"), F.when(step.between(12, 18), 1500.0 - 60 * (step - 10)).alias("end"))


def _shifts(s, d):
    return tracks(s, d).groupBy("scan_id", "frame").agg((F.sum("x1") % 180).cast("double").alias("tx"), (F.sum("y1") % 50).cast("double").alias("ty"))


def _detections(s, d):
    return boxes(s, d).select("scan_id", "frame", "pos", "x1", "y1", "x2", "y2", "depth", "score", F.lit(25.0).alias("tx"), F.lit(0.0).alias("ty"))


def _drive(s, d):
    e = events(s, d)
    return e.select("user_id", "ts", (F.col("value") % 1.0).alias("depth"), (F.col("value") % 30.0 - 15).alias("turn"), (F.col("event_id") % 5 < 3).alias("in_inner"), F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 7 < 3).alias("in_entry"), F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 3 == 0).alias("in_heading"))


def _mot(s, d):
    """True boxes, and found ones that are moved a little, sometimes lost, and change their track every fifty frames."""
    rows = _detections(s, d).groupBy("scan_id", "frame", (F.col("pos") % 40).cast("double").alias("gt_id")).agg(F.min(F.struct("pos", "x1", "y1", "x2", "y2")).alias("b"))
    box = ("x1", "y1", "x2", "y2")
    side = lambda kind, key, moved: F.struct(F.lit(kind).alias("side"), key.alias("id"), "b.pos", *((F.col(f"b.{c}") + moved).cast("double").alias(c) for c in box))
    real, found = side(S.TRUE, F.col("gt_id"), F.lit(0)), side(S.FOUND, F.col("gt_id") + 40 * F.floor(F.col("frame") / 50), F.col("b.pos") % 9 - 4)
    both = rows.select("scan_id", "frame", F.explode(F.array_compact(F.array(real, F.when(F.expr("b.pos % 11 <> 0"), found)))).alias("s"))
    return S.sided_pairs(both.select("scan_id", "frame", "s.*"), ["scan_id", "frame"], 0.3)


def _cells(s, d):
    """True boxes, some of them crowds, and found ones that are moved a little, sometimes lost."""
    rows = boxes(s, d).select("scan_id", "frame", "class", "pos", "x1", "y1", "x2", "y2", "score")
    truth = rows.where("pos % 10 < 8").withColumn("crowd", (F.col("pos") % 37 == 0).cast("int"))
    found = rows.where("pos % 10 > 0").select("scan_id", "frame", "class", "pos", *((F.col(c) + F.col("pos") % 13 - 6).alias(c) for c in ("x1", "y1", "x2", "y2")), "score")
    return S.evaluated_cells(truth, found, ["scan_id", "frame"])


def _cuts(s, d):
    """Cut points of consecutive frames."""
    frames = slices(s, d).withColumn("frame", F.expr("frame div 5"))
    return frames.groupBy("scan_id", "frame").agg(F.slice(F.array_sort(F.filter(F.collect_set("start"), lambda x: x > 0)), 1, 2).alias("cuts"))


def _gapped_cuts(s, d):
    gone = F.expr("cast(array() as array<bigint>)")
    return _cuts(s, d).withColumn("cuts", F.when(F.col("frame") % 4 == 2, gone).otherwise(F.col("cuts")))


_SLICES = f"WITH RECURSIVE {WITH_SLICES}"
_CUTS = f"""{_SLICES}, cut AS (SELECT scan_id, frame // 5 AS frame, coalesce(list_sort(list_distinct(list("start") FILTER ("start" > 0)))[1:2], []::BIGINT[]) AS cuts FROM slices GROUP BY ALL)"""
_SHIFTS = f"""{WITH_TRACKS}, sums AS (SELECT scan_id, frame, CAST(sum(x1) % 180 AS DOUBLE) AS tx, CAST(sum(y1) % 50 AS DOUBLE) AS ty FROM tracks GROUP BY ALL),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM sums)"""


def _steps_sql(less, more):
    return f"""{_SHIFTS}, e AS (SELECT DISTINCT scan_id, CAST(-1 AS BIGINT) AS frame, CAST(0 AS BIGINT) AS n, 0 AS shift, 0 AS less, 0 AS more FROM o
    UNION ALL SELECT scan_id, frame, n, shift + CASE WHEN up > 5 THEN 1 WHEN down > 5 THEN -1 ELSE 0 END, CASE WHEN up > 5 OR down > 5 THEN 0 ELSE down END, CASE WHEN up > 5 OR down > 5 THEN 0 ELSE up END
    FROM (SELECT o.scan_id, o.frame, o.n, shift, {less} AS down, {more} AS up FROM e JOIN o ON o.scan_id = e.scan_id AND o.n = e.n + 1))
    SELECT scan_id, frame, CAST(shift AS BIGINT) AS zed_shift FROM e WHERE n > 0"""


_FOLD_SQL = {
    "slice_start_fold": f"""{_SHIFTS}, e AS (SELECT scan_id, frame, n, CAST(1535 AS BIGINT) AS at, CAST(1535 AS BIGINT) AS "start" FROM o WHERE n = 1
    UNION ALL SELECT scan_id, frame, n, CASE WHEN before = 1 THEN 1 ELSE moved END, CASE WHEN before = 1 THEN -1 ELSE moved END
    FROM (SELECT o.scan_id, o.frame, o.n, e.at AS before, CAST(trunc(greatest(1, least(e.at - o.tx, 1536))) AS BIGINT) AS moved FROM e JOIN o ON o.scan_id = e.scan_id AND o.n = e.n + 1))
    SELECT scan_id, frame, "start" FROM e""",
    "zed_shift": _steps_sql("CASE WHEN tx < 20 THEN less + 1 WHEN tx > 120 THEN less ELSE greatest(less - 1, 0) END", "CASE WHEN tx < 20 THEN more WHEN tx > 120 THEN more + 1 ELSE greatest(more - 1, 0) END"),
    "zed_shift_reset": _steps_sql("CASE WHEN tx < 20 THEN less + 1 ELSE 0 END", "CASE WHEN tx > 120 THEN more + 1 ELSE 0 END"),
    "valid_shifts": f"""{_SHIFTS}, e AS (SELECT DISTINCT scan_id, CAST(-1 AS BIGINT) AS frame, CAST(0 AS BIGINT) AS n, 0.0::DOUBLE AS vx, 0.0::DOUBLE AS vy, []::DOUBLE[] AS hx, []::DOUBLE[] AS hy FROM o
    UNION ALL SELECT scan_id, frame, n, CASE WHEN NOT fine AND len(hx) = 5 THEN list_avg(hx) ELSE tx END, CASE WHEN NOT fine AND len(hy) = 5 THEN list_avg(hy) ELSE ty END,
    CASE WHEN NOT fine THEN hx WHEN len(hx) = 5 THEN list_append(hx[2:], tx) ELSE list_append(hx, tx) END, CASE WHEN NOT fine THEN hy WHEN len(hy) = 5 THEN list_append(hy[2:], ty) ELSE list_append(hy, ty) END
    FROM (SELECT o.scan_id, o.frame, o.n, tx, ty, hx, hy, tx BETWEEN 30 AND 130 AS fine FROM e JOIN o ON o.scan_id = e.scan_id AND o.n = e.n + 1))
    SELECT scan_id, frame, round(vx, 6) AS tx, round(vy, 6) AS ty FROM e WHERE n > 0""",
    "row_fsm": """WITH RECURSIVE o AS (SELECT user_id, ts, value % 1.0::DOUBLE AS d, value % 30.0::DOUBLE - 15 AS t, event_id % 5 < 3 AS inner_, CASE WHEN event_id % 2 = 0 THEN event_id % 7 < 3 END AS entry, CASE WHEN event_id % 2 = 0 THEN event_id % 3 = 0 END AS heading,
    row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events),
    e AS (SELECT DISTINCT user_id, CAST(NULL AS TIMESTAMP) AS ts, CAST(0 AS BIGINT) AS n, 0.5::DOUBLE AS depth, 0.0::DOUBLE AS turn, 0 AS state, 0 AS num FROM o
    UNION ALL SELECT user_id, ts, n, depth, turn,
      CASE state WHEN 0 THEN CASE WHEN begins THEN 1 ELSE 0 END WHEN 1 THEN CASE WHEN inside THEN 2 ELSE 1 END WHEN 2 THEN CASE WHEN inside THEN 2 ELSE 3 END ELSE CASE WHEN inside THEN 2 WHEN abs(turn) >= 1.0 THEN 0 ELSE 3 END END,
      num + CASE WHEN state = 0 AND begins THEN 1 ELSE 0 END
    FROM (SELECT *, coalesce(NOT entry, inner_) AS inside, depth <= 0.55::DOUBLE AND CASE WHEN heading IS NOT NULL THEN heading ELSE abs(turn) < 1.0 AND inner_ END AS begins
      FROM (SELECT o.user_id, o.ts, o.n, 0.2::DOUBLE * d + (1 - 0.2::DOUBLE) * depth AS depth, 0.2::DOUBLE * t + (1 - 0.2::DOUBLE) * turn AS turn, state, num, inner_, entry, heading FROM e JOIN o ON o.user_id = e.user_id AND o.n = e.n + 1)))
    SELECT user_id, ts, state, num AS row_number FROM e WHERE n > 0""",
    "auto_slices": f"""{_CUTS}, o AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM cut),
    e AS (SELECT DISTINCT scan_id, CAST(-1 AS BIGINT) AS frame, CAST(0 AS BIGINT) AS n, []::BIGINT[] AS cuts, CAST(0 AS BIGINT) AS tree, CAST(0 AS BIGINT) AS last, false AS opened, true AS silent FROM o
    UNION ALL SELECT o.scan_id, o.frame, o.n, o.cuts, tree + CASE WHEN (len(o.cuts) = 0 AND last = 2) OR (len(o.cuts) = 2 AND last < 2) THEN 1 ELSE 0 END, len(o.cuts), opened OR len(o.cuts) > 0, len(o.cuts) = 0 AND last = 0 AND NOT opened
    FROM e JOIN o ON o.scan_id = e.scan_id AND o.n = e.n + 1)
    SELECT scan_id, frame, tree AS tree_id, CASE WHEN len(cuts) = 2 THEN cuts[1] ELSE -1 END AS "start", CASE WHEN len(cuts) = 2 THEN cuts[2] WHEN len(cuts) = 1 THEN cuts[1] ELSE -1 END AS "end" FROM e WHERE NOT silent
    UNION ALL SELECT scan_id, frame, tree + 1, cuts[1], -1 FROM e WHERE len(cuts) = 1""",
    "smooth_slices": f"""{_CUTS}, o AS (SELECT scan_id, frame, CASE WHEN frame % 4 = 2 THEN []::BIGINT[] ELSE cuts END AS cuts, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM cut),
    e AS (SELECT scan_id, frame, n, cuts AS now, CAST(-9 AS BIGINT) AS f1, []::BIGINT[] AS done, CAST(-9 AS BIGINT) AS f0 FROM o WHERE n = 1
    UNION ALL SELECT o.scan_id, o.frame, o.n, o.cuts, e.frame, CASE WHEN e.frame = o.frame - 1 AND e.f1 = o.frame - 2 AND len(e.now) < 2 THEN
      list_reduce(flatten(list_transform(o.cuts, lambda a: list_transform(e.done, lambda b: [a, b]))), lambda m, p: CASE WHEN len(m) < 2 AND abs(p[1] - p[2]) < 400 AND (len(m) = 0 OR abs(m[1] - (p[1] + p[2]) // 2) > 400) THEN list_sort(list_append(m, (p[1] + p[2]) // 2)) ELSE m END, e.now)
      ELSE e.now END, e.f1 FROM e JOIN o ON o.scan_id = e.scan_id AND o.n = e.n + 1)
    SELECT scan_id, f1 AS frame, done AS cuts FROM e WHERE n > 1 UNION ALL SELECT scan_id, frame, now FROM e WHERE (scan_id, n) IN (SELECT (scan_id, max(n)) FROM o GROUP BY scan_id)""",
    "slice_fsm": f"""{_SLICES}, b AS (SELECT scan_id, frame, CASE WHEN frame % 20 BETWEEN 2 AND 8 THEN 900 - 60 * (frame % 20) END AS a, CASE WHEN frame % 20 BETWEEN 12 AND 18 THEN 1500 - 60 * (frame % 20 - 10) END AS z, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n
      FROM (SELECT DISTINCT scan_id, frame FROM slices)),
    o AS (SELECT *, CASE WHEN a IS NULL AND z IS NULL THEN 0 WHEN z IS NULL THEN 1 WHEN a IS NULL THEN 2 WHEN abs(z - a) < 20 THEN CASE WHEN z > a THEN 3 ELSE 4 END WHEN z > a THEN 5 ELSE 6 END AS state FROM b),
    e AS (SELECT DISTINCT scan_id, CAST(-1 AS BIGINT) AS frame, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS z, 0 AS state, CAST(0 AS BIGINT) AS tree, CAST(0 AS BIGINT) AS following, CAST(-1 AS BIGINT) AS most, true AS silent FROM o
    UNION ALL SELECT scan_id, frame, n, a, z, state, own, own + CASE WHEN step = 36 THEN 1 ELSE 0 END, CASE WHEN hush THEN most ELSE greatest(most, own + CASE WHEN state IN (3, 4, 6) THEN 1 ELSE 0 END) END, hush
    FROM (SELECT *, tree + CASE WHEN step IN (1, 5, 21, 25, 30, 31, 35, 40, 41, 45, 51, 61) OR (step = 42 AND NOT newest) THEN 1 ELSE 0 END AS own, step IN (20, 50) OR (step IN (0, 22) AND NOT newest) AS hush
      FROM (SELECT o.*, e.following AS tree, e.most, e.state * 10 + o.state AS step, e.most >= 0 AND e.following = e.most AS newest FROM e JOIN o ON o.scan_id = e.scan_id AND o.n = e.n + 1)))
    SELECT scan_id, frame, tree AS tree_id, CASE WHEN state IN (1, 3, 5) THEN a ELSE -1 END AS "start", CASE WHEN state IN (2, 4, 5, 6) THEN z ELSE -1 END AS "end" FROM e WHERE NOT silent
    UNION ALL SELECT scan_id, frame, tree + 1, CASE WHEN state IN (4, 6) THEN a ELSE -1 END, CASE WHEN state = 3 THEN z ELSE -1 END FROM e WHERE NOT silent AND state IN (3, 4, 6)""",
    "greedy_clusters": f"""{WITH_BOXES}, near AS (SELECT a.scan_id, a.frame, a.pos, list(b.pos) AS around FROM boxes a JOIN boxes b ON a.scan_id = b.scan_id AND a.frame = b.frame
      AND sqrt(pow((a.x1 + a.x2) / 2.0::DOUBLE - (b.x1 + b.x2) / 2.0::DOUBLE, 2) + pow((a.y1 + a.y2) / 2.0::DOUBLE - (b.y1 + b.y2) / 2.0::DOUBLE, 2)) < 200 GROUP BY ALL),
    o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scan_id, frame ORDER BY pos) AS n, count(*) OVER (PARTITION BY scan_id, frame) AS size FROM near),
    e AS (SELECT scan_id, frame, n, size, [around] AS found FROM o WHERE n = 1
    UNION ALL SELECT scan_id, frame, n, size, CASE WHEN home IS NULL THEN list_append(found, around) ELSE list_transform(found, lambda c, i: CASE WHEN i = home THEN list_distinct(list_concat(c, around)) ELSE c END) END
    FROM (SELECT o.scan_id, o.frame, o.n, o.size, found, around, nullif(list_position(list_transform(found, lambda c: list_has_any(c, around)), true), 0) AS home FROM e JOIN o ON o.scan_id = e.scan_id AND o.frame = e.frame AND o.n = e.n + 1))
    SELECT scan_id, frame, pos, max(cluster) AS cluster FROM (SELECT scan_id, frame, cluster, unnest(members) AS pos FROM (SELECT scan_id, frame, generate_subscripts(found, 1) - 1 AS cluster, unnest(found) AS members FROM e WHERE n = size)) GROUP BY ALL""",
}

QUERIES = {
    "slice_fsm": (lambda s, d: O.cut_slices(_marks(s, d), KEY), _FOLD_SQL["slice_fsm"]),
    "auto_slices": (lambda s, d: O.automatic_slices(_cuts(s, d), KEY), _FOLD_SQL["auto_slices"]),
    "smooth_slices": (lambda s, d: O.smoothed_cuts(_gapped_cuts(s, d), KEY, near=400), _FOLD_SQL["smooth_slices"]),
    "slice_start_fold": (lambda s, d: O.clamped_starts(_shifts(s, d), KEY, 1535, 1536), _FOLD_SQL["slice_start_fold"]),
    "slice_ends": (
        lambda s, d: O.ends_from_next(slices(s, d), KEY),
        """WITH s AS (SELECT DISTINCT CAST(o_orderkey % 5 AS BIGINT) AS scan_id, CAST(o_orderkey % 200 AS BIGINT) AS frame, CAST((o_orderkey % 200) // 20 AS BIGINT) AS tree_id,
        CAST(CASE WHEN (o_orderkey % 200) % 20 = 0 THEN -1 ELSE ((o_orderkey % 200) % 20)*30 END AS BIGINT) AS a, CAST(CASE WHEN (o_orderkey % 200) % 20 = 19 THEN -1 ELSE 900 + ((o_orderkey % 200) % 20)*30 END AS BIGINT) AS b FROM orders)
        SELECT scan_id, frame, tree_id, a AS "start", coalesce(lead(a) OVER (PARTITION BY scan_id, frame ORDER BY tree_id) - 1, b) AS "end" FROM s""",
    ),
    "zed_shift": (lambda s, d: O.shift_steps(_shifts(s, d), KEY), _FOLD_SQL["zed_shift"]),
    "zed_shift_reset": (lambda s, d: O.shift_steps(_shifts(s, d), KEY, decay=False), _FOLD_SQL["zed_shift_reset"]),
    "valid_shifts": (lambda s, d: O.validated_shifts(_shifts(s, d), KEY, 160.0, margin=30.0).select("scan_id", "frame", F.round("tx", 6).alias("tx"), F.round("ty", 6).alias("ty")), _FOLD_SQL["valid_shifts"]),
    "row_fsm": (lambda s, d: O.row_states(_drive(s, d), ["user_id"], "ts", depth_most=0.55, turn_most=1.0, alpha=0.2), _FOLD_SQL["row_fsm"]),
    "greedy_clusters": (lambda s, d: O.greedy_clusters(_detections(s, d), ["scan_id", "frame"], 200.0), _FOLD_SQL["greedy_clusters"]),
    "window_tracker": (lambda s, d: K.window_tracks(_detections(s, d), KEY), None),
    "two_stage_tracker": (lambda s, d: K.two_stage_tracks(_detections(s, d), KEY), None),
    "gated_tracker": (lambda s, d: K.two_stage_tracks(_detections(s, d), KEY, K.TwoStageTracker(gated=True)), None),
    "mot_metrics": (lambda s, d: E.mot_summary(_mot(s, d), ["scan_id"], 0.3), None),
    "identity_metrics": (lambda s, d: S.identity_summary(_mot(s, d), ["scan_id"], 0.3), None),
    "area_cells": (lambda s, d: _cells(s, d).select("class", "area_class", "threshold", *(F.round(c, 9).alias(c) for c in ("ap", "recall_1", "recall_10", "recall_100"))), None),
    "area_summary": (lambda s, d: S.area_summary(_cells(s, d)), None),
}
