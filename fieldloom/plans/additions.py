"""Look-ups, filters, projections, regressions and box metrics that round off the inventory."""

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..operators import annotations as A
from ..operators import counting as C
from ..operators import evaluation as E
from ..operators import geometry as G
from ..operators import ledger as L
from ..operators import measuring as M
from ..operators import scans as P
from ..operators import spatial as N
from ..operators import timeseries as T
from .tables import KEY, PLOTS, WITH_BOXES, WITH_POINTS, WITH_SLICES, WITH_TRACKS, boxes, events, plots, points, read, slices, tracks

FRAME = ["scan_id", "frame"]
_SCORED = "WITH scored AS (SELECT quality AS label, CAST((doc_id * 37) % 100 AS DOUBLE) / 100 AS score, doc_id FROM labels)"


def _halves(s, d):
    rows = boxes(s, d).select(*FRAME, "pos", "x1", "y1", "x2", "y2", "score")
    return rows.where("pos % 2 = 0"), rows.where("pos % 2 = 1")


def _moves(s, d):
    return events(s, d).select("event_id", (F.col("event_id") % 700 - 100).alias("tx"), (F.col("event_id") % 900 - 60).alias("ty"))


_MOVES = "SELECT event_id, event_id % 700 - 100 AS tx, event_id % 900 - 60 AS ty FROM events"


def _hundredths(s, d):
    """Values in hundredths, whole numbers whose sums do not depend on their order."""
    return events(s, d).withColumn("value", F.round(F.col("value") * 100))


def _matrices(s, d):
    v, nan = F.col("value"), F.lit(float("nan"))
    shift = F.when(F.col("event_id") % 50 == 0, nan).otherwise((F.col("event_id") % 37).cast("double") / 2)
    return events(s, d).select("event_id", F.array(F.cos(v), F.sin(v), shift, -F.sin(v) * 2, F.cos(v) * 2, (F.col("event_id") % 11).cast("double")).alias("m"))


def _coloured(s, d):
    hue = (F.col("l_orderkey") % 60).cast("double")
    return read(s, d, "lineitem").select("l_orderkey", B.ripeness(F.when(hue < 58, hue), (F.col("l_partkey") % 20).cast("double"), (F.col("l_suppkey") % 20).cast("double")).alias("ripe")).groupBy("ripe").agg(F.count("*").alias("n"))


def _class_pred(s, d):
    return boxes(s, d).select(F.col("pos").alias("image_id"), "x1", "y1", "x2", "y2", F.col("class").cast("double").alias("class_pred"), F.col("score").alias("obj_conf"), F.lit(0.5).alias("class_conf"))


def _meta_rows(s, d):
    return read(s, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 7).cast("long").alias("k"))


def _meta_table(s, d):
    return read(s, d, "customer").select((F.col("c_custkey") % 6).cast("long").alias("k"), F.col("c_nationkey").cast("long").alias("f"), "c_custkey")


def _parts(s, d):
    return read(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("part_no"), (F.col("n_nationkey") * 3 + 2).cast("long").alias("rows"))


_REG = "WITH r AS (SELECT l_suppkey % 10 AS g, CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem)"


def _reg(s, d):
    return read(s, d, "lineitem").select((F.col("l_suppkey") % 10).alias("g"), F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))


def _log_line(s, d):
    out = E.regression(_reg(s, d), ["g"], ["x"], "y", log_target=True)
    return out.select("g", F.round(F.get("coefficients", F.lit(0)), 5).alias("intercept"), F.round(F.get("coefficients", F.lit(1)), 6).alias("slope"))


def _two_lines(s, d):
    """y over x and x * x: what each column's unit adds."""
    rows = _reg(s, d).withColumn("x2", F.col("x") * F.col("x"))
    k = lambda i: F.get("coefficients", F.lit(i))
    return E.regression(rows, ["g"], ["x", "x2"], "y").select("g", F.round(k(0), 2).alias("base"), F.round(k(1), 3).alias("linear"), F.round(k(2), 5).alias("square"))


def _hits(s, d):
    from pyspark.sql.window import Window

    rows = read(s, d, "labels").select(F.col("quality").alias("hit"), (F.pmod(F.col("doc_id") * 37, F.lit(100)).cast("double") / 100).alias("score"), "doc_id", (F.col("doc_id") % 4).alias("class"))
    return rows.withColumn("n_true", F.sum("hit").over(Window.partitionBy("class")))


_CONFS, _IOUS = [0.1, 0.3, 0.5, 0.7, 0.9], [0.1, 0.3, 0.5]
_COMMON = "greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)"
_OVER = f"CAST({_COMMON} AS DOUBLE) / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_COMMON})"


def _ring_sql(ring):
    """Ray casting in SQL: an odd number of edges to the right of the point."""
    n = len(ring)
    parts = []
    for (ax, ay), (bx, by) in ((ring[k], ring[(k + 1) % n]) for k in range(n)):
        if ay != by:
            parts.append(f"CASE WHEN ({ay}::DOUBLE > lat) <> ({by}::DOUBLE > lat) AND lon < ({bx}::DOUBLE - {ax}::DOUBLE) * (lat - {ay}::DOUBLE) / ({by}::DOUBLE - {ay}::DOUBLE) + {ax}::DOUBLE THEN 1 ELSE 0 END")
    return f"({' + '.join(parts)}) % 2 = 1"


def _in_any(s, d):
    return N.in_any(points(s, d), plots(s)).select("scan_id", "place", "inside")


def _tree_images(s, d):
    images, notes = A.from_tracks(boxes(s, d), KEY, 1536, 2048, ["frame", "pos"])
    return notes.select("scan_id", "id", "image_id", "category_id", F.element_at("bbox", 3).alias("w"), "area", F.round("score", 6).alias("score"))


def _cleaned_names(s, d):
    images = tracks(s, d).select("scan_id", F.col("frame").alias("id")).distinct().withColumn("file_name", F.concat_ws("_", F.lit("frame"), "id"))
    notes = tracks(s, d).select("scan_id", F.col("pos").alias("id"), F.col("frame").alias("image_id"))
    kept, linked = A.without_names(images, notes, ["7", "_1"], KEY)
    return linked.select("scan_id", F.col("new_id").alias("id"), F.col("new_image").alias("image_id"))


QUERIES = {
    "pr_grid_boxes": (
        lambda s, d: E.box_pr_grid(*_halves(s, d), FRAME, _CONFS, _IOUS).select("conf", "iou", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1"))),
        f"""{WITH_BOXES}, t AS (SELECT * FROM boxes WHERE pos % 2 = 0), f AS (SELECT * FROM boxes WHERE pos % 2 = 1),
        g(conf, iou) AS (SELECT c, o FROM (SELECT unnest({_CONFS})::DOUBLE AS c), (SELECT unnest({_IOUS})::DOUBLE AS o)),
        nt AS (SELECT scan_id, frame, count(*) AS n_true FROM t GROUP BY ALL), im AS (SELECT nt.* FROM nt SEMI JOIN f USING (scan_id, frame)),
        p AS (SELECT a.scan_id, a.frame, b.score, {_OVER} AS o FROM t a JOIN f b ON a.scan_id = b.scan_id AND a.frame = b.frame AND a.x1 <= b.x2 AND b.x1 <= a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2),
        hits AS (SELECT scan_id, frame, conf, iou, count(*) AS tp FROM p JOIN g ON score > conf AND o > iou GROUP BY ALL),
        made AS (SELECT scan_id, frame, conf, count(*) AS made FROM f JOIN (SELECT DISTINCT conf FROM g) ON score > conf GROUP BY ALL),
        r AS (SELECT conf, iou, n_true, coalesce(tp, 0) AS tp, coalesce(made, 0) AS made FROM im CROSS JOIN g LEFT JOIN hits USING (scan_id, frame, conf, iou) LEFT JOIN made USING (scan_id, frame, conf))
        SELECT conf, iou, round(avg(tp / greatest(made, 1)::DOUBLE), 6) AS precision, round(avg(tp / n_true::DOUBLE), 6) AS recall,
        round(avg(CASE WHEN 2 * tp + (n_true - tp) + (made - tp) = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (2 * tp + (n_true - tp) + (made - tp)) END), 6) AS f1 FROM r GROUP BY ALL""",
    ),
    "voc_ap_11_point": (
        lambda s, d: P.best_at_least(_hits(s, d), ["class"], [F.col("score").desc(), F.col("doc_id")]).select("class", F.round("ap", 6).alias("ap")),
        f"""{_SCORED}, m AS (SELECT doc_id % 4 AS class, label, score, doc_id, sum(label) OVER (PARTITION BY doc_id % 4) AS n_true FROM scored),
        a AS (SELECT class, sum(label) OVER w / n_true::DOUBLE AS r, sum(label) OVER w / (row_number() OVER w)::DOUBLE AS p FROM m WINDOW w AS (PARTITION BY class ORDER BY score DESC, doc_id ROWS UNBOUNDED PRECEDING)),
        b AS (SELECT class, k, max(CASE WHEN r >= k / 10.0::DOUBLE THEN p END) AS p FROM a, (SELECT unnest(range(11)) AS k) GROUP BY ALL) SELECT class, round(sum(coalesce(p, 0)) / 11, 6) AS ap FROM b GROUP BY ALL""",
    ),
    "tree_filter_counts": (
        lambda s, d: C.tree_filter_counts(tracks(s, d), slices(s, d), KEY, 3.0, 2),
        f"""{WITH_TRACKS}, {WITH_SLICES}, g AS (SELECT scan_id, tree_id, unnest(range(lo, hi + 1)) AS frame FROM (SELECT scan_id, tree_id, min(frame) AS lo, max(frame) AS hi FROM slices GROUP BY ALL)),
        c AS (SELECT g.*, CASE WHEN coalesce("start", -1) = -1 THEN 0 ELSE "start" END AS a, CASE WHEN coalesce("end", -1) = -1 THEN 1535 ELSE "end" END AS b FROM g LEFT JOIN slices USING (scan_id, tree_id, frame)),
        p AS (SELECT t.scan_id, tree_id, track_id, count(*) AS n, bool_or(depth < 3) AS near FROM tracks t JOIN c ON t.scan_id = c.scan_id AND t.frame = c.frame AND x1 > a AND x2 < b GROUP BY ALL)
        SELECT scan_id, tree_id, count(track_id) AS n_all, count(track_id) FILTER (near) AS n_depth, count(track_id) FILTER (n >= 2) AS n_seen, count(track_id) FILTER (near AND n >= 2) AS n_both
        FROM (SELECT DISTINCT scan_id, tree_id FROM slices) LEFT JOIN p USING (scan_id, tree_id) GROUP BY ALL""",
    ),
    "new_ids_interval": (
        lambda s, d: C.new_per_interval(tracks(s, d), KEY, 3),
        f"""{WITH_TRACKS}, f AS (SELECT scan_id, frame FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY frame) - 1 AS n FROM (SELECT DISTINCT scan_id, frame FROM tracks)) WHERE n % 3 = 0),
        k AS (SELECT t.scan_id, track_id, min(frame) AS frame FROM tracks t SEMI JOIN f USING (scan_id, frame) GROUP BY ALL) SELECT f.scan_id, f.frame, count(track_id) AS n_new FROM f LEFT JOIN k USING (scan_id, frame) GROUP BY ALL""",
    ),
    "appearance_ids": (
        lambda s, d: C.appearance_ids(tracks(s, d), KEY, "track_id", ["frame", "pos"]),
        f"{WITH_TRACKS}, q AS (SELECT scan_id, track_id, min((frame, pos)) AS first FROM tracks GROUP BY ALL) SELECT scan_id, track_id, row_number() OVER (PARTITION BY scan_id ORDER BY first, track_id) - 1 AS new_id FROM q",
    ),
    "frame_spans": (
        lambda s, d: C.frame_spans(slices(s, d), ["scan_id", "tree_id"]),
        f"WITH {WITH_SLICES} SELECT scan_id, tree_id, min(frame) AS first_frame, max(frame) AS last_frame FROM slices GROUP BY ALL",
    ),
    "every_kth_frame": (
        lambda s, d: C.every_kth(tracks(s, d).select(*FRAME).distinct(), KEY, "frame", 4),
        f"{WITH_TRACKS} SELECT scan_id, frame FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY frame) - 1 AS n FROM (SELECT DISTINCT scan_id, frame FROM tracks)) WHERE n % 4 = 0",
    ),
    "text_predicate": (
        lambda s, d: tracks(s, d).where("depth between 1.5 and 3 and class != 2 and x2 - x1 > 40").select("pos"),
        f"{WITH_TRACKS} SELECT pos FROM tracks WHERE depth BETWEEN 1.5 AND 3 AND class <> 2 AND x2 - x1 > 40",
    ),
    "time_range": (
        lambda s, d: T.between(events(s, d), "ts", "2024-01-05 06:00:00", "2024-01-11 18:30:00").select("event_id"),
        "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-11 18:30:00'",
    ),
    "fused_scores": (
        lambda s, d: _class_pred(s, d).withColumn("sure", B.fused_score()).where("sure >= 0.2").select("image_id", F.round("sure", 6).alias("sure")),
        f"{WITH_BOXES} SELECT pos AS image_id, round(score * 0.5, 6) AS sure FROM boxes WHERE score * 0.5 >= 0.2",
    ),
    "composite_keys": (
        lambda s, d: read(s, d, "orders").withColumn("idx", F.lpad(F.col("o_custkey").cast("string"), 8, "0")).select("o_orderkey", L.composite_key(["o_orderstatus", "o_custkey", "idx"], "idx").alias("key")),
        "SELECT o_orderkey, concat_ws('_', o_orderstatus, o_custkey, o_custkey) AS key FROM orders",
    ),
    "first_lookup": (
        lambda s, d: L.first_looked_up(_meta_rows(s, d), _meta_table(s, d), "k", "f", "c_custkey").select("s_suppkey", "k", "f"),
        "SELECT s_suppkey, k, f FROM (SELECT s_suppkey, s_suppkey % 7 AS k FROM supplier) JOIN (SELECT c_custkey % 6 AS k, arg_min(c_nationkey, c_custkey) AS f FROM customer GROUP BY ALL) USING (k)",
    ),
    "last_lookup": (
        lambda s, d: L.looked_up(_meta_rows(s, d), _meta_table(s, d), "k", "f", "c_custkey", -1).select("s_suppkey", "k", "f"),
        "SELECT s_suppkey, k, coalesce(f, -1) AS f FROM (SELECT s_suppkey, s_suppkey % 7 AS k FROM supplier) LEFT JOIN (SELECT c_custkey % 6 AS k, arg_max(c_nationkey, c_custkey) AS f FROM customer GROUP BY ALL) USING (k)",
    ),
    "frame_map_inverse": (
        lambda s, d: L.inverted(events(s, d).select("event_id", F.expr("event_id div 3").alias("zed")), "event_id", "zed"),
        "SELECT event_id // 3 AS zed, max(event_id) AS event_id FROM events GROUP BY ALL",
    ),
    "detection_tracks": (
        lambda s, d: L.looked_up(boxes(s, d).select(*FRAME, "pos"), boxes(s, d).where("score > 0.5").select("pos", "track_id"), "pos", "track_id", "track_id", -1),
        f"{WITH_BOXES} SELECT scan_id, frame, pos, CASE WHEN score > 0.5 THEN track_id ELSE -1 END AS track_id FROM boxes",
    ),
    "unmatched_sides": (
        lambda s, d: L.unmatched(*_sides(s, d))[0].withColumn("side", F.lit("a")).withColumnRenamed("a", "id").unionByName(L.unmatched(*_sides(s, d))[1].withColumn("side", F.lit("c")).withColumnRenamed("c", "id")),
        "SELECT o_orderkey AS id, 'a' AS side FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT c_custkey, 'c' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0)",
    ),
    "parts_offsets": (
        lambda s, d: L.located_in_parts(events(s, d).select("event_id").where("event_id >= 0"), _parts(s, d), "event_id", "rows", "part_no"),
        "WITH p AS (SELECT n_nationkey AS part, n_nationkey * 3 + 2 AS n FROM nation), o AS (SELECT part, sum(n) OVER (ORDER BY part) - n AS a, sum(n) OVER (ORDER BY part) AS b FROM p) SELECT event_id, part, CAST(event_id - a AS BIGINT) AS local FROM events JOIN o ON event_id >= a AND event_id < b",
    ),
    "union_all_sets": (
        lambda s, d: slices(s, d).where("frame % 2 = 0").unionByName(slices(s, d)).groupBy(*FRAME, "tree_id").agg(F.count("*").alias("n")),
        f"WITH {WITH_SLICES} SELECT scan_id, frame, tree_id, count(*) AS n FROM (SELECT * FROM slices WHERE frame % 2 = 0 UNION ALL SELECT * FROM slices) GROUP BY ALL",
    ),
    "set_minus_key": (
        lambda s, d: events(s, d).select("event_type").distinct().where("event_type <> 'view'"),
        "SELECT DISTINCT event_type FROM events WHERE event_type <> 'view'",
    ),
    "roi_window": (
        lambda s, d: _moves(s, d).select("event_id", *B.window_of(F.col("tx"), F.col("ty"), (400, 500), (0, 40, 640, 1000), (640, 960))),
        f"""WITH m AS ({_MOVES}), q AS (SELECT *, CASE WHEN ty < 0 THEN CASE WHEN 40 + ty < 0 THEN 40 ELSE 40 + ty END WHEN ty + 500 > 960 THEN 500 ELSE 40 + ty END AS y1 FROM m)
        SELECT event_id, CASE WHEN tx < 0 THEN 0 WHEN tx + 400 > 640 THEN 240 ELSE tx END AS x1, y1, CASE WHEN tx < 0 THEN 400 WHEN tx + 400 > 640 THEN 640 ELSE tx + 400 END AS x2, CASE WHEN ty >= 0 AND ty + 500 > 960 THEN 1000 ELSE y1 + 500 END AS y2 FROM q""",
    ),
    "affine_parts": (
        lambda s, d: _matrices(s, d).select("event_id", *B.affine_parts("m")).select("event_id", "tx", "ty", F.round("sx", 6).alias("sx"), F.round("sy", 6).alias("sy"), *B.placed_coordinates(F.col("tx"), F.col("ty"), F.round("sx", 6), F.round("sy", 6), 100, 200, (1080, 1920))),
        """WITH q AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN CAST(round_even((event_id % 37) / 2.0::DOUBLE, 0) AS BIGINT) END AS tx, CASE WHEN event_id % 50 <> 0 THEN CAST(event_id % 11 AS BIGINT) END AS ty,
        CASE WHEN event_id % 50 <> 0 THEN 1.0::DOUBLE END AS sx, CASE WHEN event_id % 50 <> 0 THEN 2.0::DOUBLE END AS sy FROM events)
        SELECT *, coalesce(tx, 0)::DOUBLE AS x1, coalesce(ty, 0)::DOUBLE AS y1, coalesce(tx + 100, 1079)::DOUBLE AS x2, coalesce(ty + 400, 1919)::DOUBLE AS y2 FROM q""",
    ),
    "affine_boxes": (
        lambda s, d: boxes(s, d).select("pos", *B.affine_boxes(0.5, 20, 40, 600, 800)).select("pos", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2"))),
        f"""{WITH_BOXES} SELECT pos, greatest(0, least(600, x1 * 0.5::DOUBLE + 20)) AS x1, greatest(0, least(800, y1 * 0.5::DOUBLE + 40)) AS y1, greatest(0, least(600, x2 * 0.5::DOUBLE + 20)) AS x2, greatest(0, least(800, y2 * 0.5::DOUBLE + 40)) AS y2 FROM boxes""",
    ),
    "zoomed_boxes": (
        lambda s, d: boxes(s, d).select("pos", *B.zoomed(2.0, 200, 300, 1536, 2048)).select("pos", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2"))).where("x2 > x1 and y2 > y1"),
        f"""{WITH_BOXES}, z AS (SELECT pos, greatest(0, least(1536, (x1 - 200) * 2.0::DOUBLE)) AS x1, greatest(0, least(2048, (y1 - 300) * 2.0::DOUBLE)) AS y1, greatest(0, least(1536, (x2 - 200) * 2.0::DOUBLE)) AS x2, greatest(0, least(2048, (y2 - 300) * 2.0::DOUBLE)) AS y2 FROM boxes)
        SELECT * FROM z WHERE x2 > x1 AND y2 > y1""",
    ),
    "corner_round_trip": (
        lambda s, d: boxes(s, d).select("pos", *B.centred()).select("pos", *B.centre_to_corners()).select("pos", *(F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2"))),
        f"{WITH_BOXES} SELECT pos, x1::DOUBLE AS x1, y1::DOUBLE AS y1, x2::DOUBLE AS x2, y2::DOUBLE AS y2 FROM boxes",
    ),
    "range_classes": (
        lambda s, d: M.nearest_mean(tracks(s, d), FRAME, "depth", 10).join(tracks(s, d), FRAME).select("pos", B.range_class((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")), F.col("nearest") <= 0.9, 800, 2000).alias("kind")),
        f"""{WITH_TRACKS}, r AS (SELECT scan_id, frame, avg(depth) <= 0.9 AS close FROM (SELECT *, row_number() OVER (PARTITION BY scan_id, frame ORDER BY depth) AS k FROM tracks) WHERE k <= 10 GROUP BY ALL)
        SELECT pos, CASE WHEN NOT close THEN 'mid' WHEN (x2 - x1) * (y2 - y1) < 800 THEN 'far' WHEN (x2 - x1) * (y2 - y1) < 2000 THEN 'mid' ELSE 'close' END AS kind FROM tracks JOIN r USING (scan_id, frame)""",
    ),
    "ripeness": (
        _coloured,
        """WITH q AS (SELECT CASE WHEN l_orderkey % 60 < 58 THEN l_orderkey % 60 END AS h, (l_partkey % 20)::DOUBLE AS md, (l_suppkey % 20)::DOUBLE AS mn FROM lineitem)
        SELECT CASE WHEN h IS NULL THEN 0 WHEN h < 10 THEN 1 WHEN h < 17.5 THEN 2 WHEN h < 45 THEN CASE WHEN md * 1.15::DOUBLE > mn THEN 4 ELSE 3 END ELSE 5 END AS ripe, count(*) AS n FROM q GROUP BY ALL""",
    ),
    "hue_mode_filter": (
        lambda s, d: M.near_mode(tracks(s, d).select("scan_id", "pos", "depth"), KEY, "depth", 0.0, 8.0, 16, 1.2).select("pos"),
        f"""{WITH_TRACKS}, h AS (SELECT scan_id, CAST(floor(depth * 2) AS INTEGER) AS bin, count(*) AS n FROM tracks GROUP BY ALL), m AS (SELECT scan_id, bin FROM h QUALIFY row_number() OVER (PARTITION BY scan_id ORDER BY n DESC, bin) = 1),
        v AS (SELECT scan_id, stddev_pop(depth) AS sd FROM tracks GROUP BY ALL) SELECT pos FROM tracks JOIN m USING (scan_id) JOIN v USING (scan_id) WHERE abs(depth - bin / 2.0::DOUBLE) <= 1.2 * sd""",
    ),
    "depth_of_crops": (
        lambda s, d: M.with_depth_of(read(s, d, "supplier").select(F.col("s_suppkey").alias("det")), read(s, d, "lineitem").select(F.col("l_suppkey").alias("det"), F.when(F.col("l_linenumber") % 3 == 0, F.lit(float("nan"))).otherwise((F.col("l_partkey") % 90).cast("double") / 10).alias("z")), ["det"], 4.4),
        "SELECT l_suppkey AS det, quantile_cont((l_partkey % 90) / 10.0::DOUBLE, 0.5) AS depth FROM lineitem WHERE l_linenumber % 3 <> 0 AND l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY ALL HAVING quantile_cont((l_partkey % 90) / 10.0::DOUBLE, 0.5) <= 4.4",
    ),
    "below_edge": (
        lambda s, d: M.below_edge(tracks(s, d).select(*FRAME, "pos", "y1"), tracks(s, d).select(*FRAME, (F.col("x1") % 900).alias("y")), FRAME, bias=100.0).select("pos"),
        f"{WITH_TRACKS}, e AS (SELECT scan_id, frame, avg(x1 % 900) + 100 AS lim FROM tracks WHERE x1 % 900 > 0 GROUP BY ALL) SELECT pos FROM tracks JOIN e USING (scan_id, frame) WHERE y1 > lim",
    ),
    "top_detections": (
        lambda s, d: M.top_of_group(boxes(s, d), FRAME, [F.col("score").desc(), F.col("pos")], 5).select(*FRAME, "pos"),
        f"{WITH_BOXES} SELECT scan_id, frame, pos FROM boxes QUALIFY row_number() OVER (PARTITION BY scan_id, frame ORDER BY score DESC, pos) <= 5",
    ),
    "valid_figures": (
        lambda s, d: E.valid_figures(tracks(s, d).withColumn("depth", F.when(F.col("pos") % 9 == 0, F.lit(float("nan"))).when(F.col("pos") % 9 == 1, F.lit(None)).otherwise(F.col("depth"))), KEY, "depth").select("scan_id", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "n"),
        f"{WITH_TRACKS} SELECT scan_id, round(avg(depth), 6) AS mean, round(quantile_cont(depth, 0.5), 6) AS median, count(*) AS n FROM tracks WHERE pos % 9 > 1 GROUP BY ALL",
    ),
    "cell_average": (
        lambda s, d: E.cell_average(tracks(s, d).withColumn("v", F.when(F.col("class") == 2, -1.0).otherwise(F.col("depth"))), ["class"], "v").select("class", F.round("v", 6).alias("v")),
        f"{WITH_TRACKS} SELECT class, round(coalesce(avg(CASE WHEN class <> 2 THEN depth END), -1), 6) AS v FROM tracks GROUP BY ALL",
    ),
    "error_figures": (
        lambda s, d: E.error_figures(_reg(s, d).withColumn("p", F.col("x") * 1500), ["g"], "y", "p").select("g", F.round("mean_error", 6).alias("mean_error"), F.round("std_error", 6).alias("std_error")),
        f"{_REG} SELECT g, round(avg((y - x * 1500) / y), 6) AS mean_error, round(stddev_pop((y - x * 1500) / y), 6) AS std_error FROM r GROUP BY ALL",
    ),
    "naive_error": (
        lambda s, d: E.naive_error(_reg(s, d), "g", "y").select(F.round("naive_error", 6).alias("naive_error")),
        f"{_REG} SELECT round(avg(abs(y - m) / y), 6) AS naive_error FROM (SELECT y, avg(y) OVER (PARTITION BY g) AS m FROM r)",
    ),
    "ols_log_line": (
        _log_line,
        f"{_REG} SELECT g, round(regr_intercept(ln(1 + y), x), 5) AS intercept, round(regr_slope(ln(1 + y), x), 6) AS slope FROM r GROUP BY ALL",
    ),
    "ols_two_columns": (
        _two_lines,
        f"""{_REG}, c AS (SELECT g, avg(x) AS mx, avg(x * x) AS mz, avg(y) AS my, covar_pop(x, x) AS xx, covar_pop(x, x * x) AS xz, covar_pop(x * x, x * x) AS zz, covar_pop(x, y) AS xy, covar_pop(x * x, y) AS zy FROM r GROUP BY ALL),
        k AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM c)
        SELECT g, round(my - b1 * mx - b2 * mz, 2) AS base, round(b1, 3) AS linear, round(b2, 5) AS square FROM k""",
    ),
    "saturated_batches": (
        lambda s, d: E.saturated_batches(tracks(s, d).withColumn("batch", F.expr("frame div 4")), ["scan_id", "batch"], "frame", "depth", 0.4, 3.0),
        f"{WITH_TRACKS}, f AS (SELECT scan_id, frame, quantile_cont(depth, 0.4) > 3 AS s FROM tracks GROUP BY ALL) SELECT scan_id, frame // 4 AS batch, bool_and(s) AS saturated FROM f GROUP BY ALL",
    ),
    "median_meter": (
        lambda s, d: E.median_meter(_hundredths(s, d), ["user_id"], "ts", "value", 5),
        "SELECT user_id, ts, quantile_cont(round(value * 100), 0.5) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS median FROM events",
    ),
    "ema_rows": (
        lambda s, d: T.smoothed_rows(events(s, d), ["user_id"], "ts", "value", 0.02, 0.5).select("user_id", "ts", "smooth"),
        """WITH RECURSIVE o AS (SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events),
        e AS (SELECT user_id, ts, n, 0.02::DOUBLE * value + (1 - 0.02::DOUBLE) * 0.5::DOUBLE AS v FROM o WHERE n = 1 UNION ALL SELECT o.user_id, o.ts, o.n, 0.02::DOUBLE * o.value + (1 - 0.02::DOUBLE) * e.v FROM e JOIN o ON o.user_id = e.user_id AND o.n = e.n + 1)
        SELECT user_id, ts, v AS smooth FROM e""",
    ),
    "any_plot": (_in_any, f"{WITH_POINTS} SELECT scan_id, place, {' OR '.join(_ring_sql(r) for _, _, r in PLOTS)} AS inside FROM points"),
    "destination": (
        lambda s, d: points(s, d).select("place", *G.destination(F.col("lat"), F.col("lon"), 75.0, 120.0)).select("place", F.round("to_lat", 7).alias("to_lat"), F.round("to_lon", 7).alias("to_lon")),
        f"""{WITH_POINTS}, q AS (SELECT place, radians(lat) AS p, radians(lon) AS l, 120.0::DOUBLE / 6371000 AS r, radians(75.0::DOUBLE) AS b FROM points), t AS (SELECT *, asin(sin(p) * cos(r) + cos(p) * sin(r) * cos(b)) AS u FROM q)
        SELECT place, round(degrees(u), 7) AS to_lat, round(degrees(l + atan2(sin(b) * sin(r) * cos(p), cos(r) - sin(p) * sin(u))), 7) AS to_lon FROM t""",
    ),
    "tracks_to_coco": (
        _tree_images,
        f"""{WITH_BOXES}, im AS (SELECT scan_id, frame, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS image_id FROM (SELECT DISTINCT scan_id, frame FROM boxes))
        SELECT scan_id, row_number() OVER (PARTITION BY scan_id ORDER BY frame, pos) - 1 AS id, image_id, 1 AS category_id, x2 - x1 AS w, (x2 - x1) * (y2 - y1) AS area, round(score, 6) AS score FROM boxes JOIN im USING (scan_id, frame)""",
    ),
    "coco_without_names": (
        _cleaned_names,
        f"""{WITH_TRACKS}, k AS (SELECT scan_id, frame, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS image_id FROM (SELECT DISTINCT scan_id, frame FROM tracks WHERE NOT contains('frame_' || frame, '7') AND NOT contains('frame_' || frame, '_1')))
        SELECT scan_id, row_number() OVER (PARTITION BY scan_id ORDER BY pos) AS id, image_id FROM tracks JOIN k USING (scan_id, frame)""",
    ),
    "coco_rows": (
        lambda s, d: A.coco_rows(_class_pred(s, d), 0.5).select("image_id", "category_id", F.element_at("bbox", 3).alias("w"), "area", F.round("score", 6).alias("score")),
        f"{WITH_BOXES} SELECT pos AS image_id, class + 1 AS category_id, (x2 - x1) * 0.5::DOUBLE AS w, (x2 - x1) * (y2 - y1) * 0.25::DOUBLE AS area, round(score * 0.5, 6) AS score FROM boxes",
    ),
}


def _sides(s, d):
    a = read(s, d, "orders").select(F.col("o_orderkey").alias("a"))
    c = read(s, d, "customer").select(F.col("c_custkey").alias("c"))
    return a, c, read(s, d, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("c"))
