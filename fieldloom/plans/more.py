"""Further projections, filters, look-ups and measures of the inventory."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import boxes as B
from ..operators import evaluation as E
from ..operators import ledger as L
from ..operators import measuring as M
from .tables import KEY, WITH_BOXES, WITH_SLICES, WITH_TRACKS, boxes, read, slices, tracks

FRAME = ["scan_id", "frame"]


def _frame_ids(s, d):
    e = read(s, d, "events").select("user_id", "event_id")
    w = Window.partitionBy("user_id").orderBy("event_id")
    out = e.select("user_id", "event_id", (F.col("event_id") - F.first("event_id").over(w)).alias("zed"), (F.row_number().over(w) - 1).cast("long").alias("jai"), F.lead("event_id").over(w).alias("__next"))
    return out.where("__next is not null").drop("__next")  # the last row of a recording goes


def _meta(s, d):
    """The variety of each supplier's block, the first that the table has for it."""
    nations = read(s, d, "nation").select(F.lower("n_name").alias("block"), F.col("n_regionkey").alias("variety"), "n_nationkey")
    blocks = read(s, d, "supplier").join(read(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.lower("n_name").alias("block"))
    return L.first_looked_up(blocks, nations, "block", "variety", "n_nationkey").select("s_suppkey", "block", "variety")


def _ap(s, d):
    both = boxes(s, d).select(*FRAME, "class", "pos", "x1", "y1", "x2", "y2", "score")
    truth, found = both.where("pos % 2 = 0"), both.where("pos % 2 = 1")
    return M.greedy_precision(truth, found, FRAME, [0.1, 0.3, 0.5])


def _points3(s, d):
    p = F.col("l_partkey") * 0.013
    q = F.col("l_suppkey") * 0.71 + F.col("l_linenumber")
    g = (F.col("l_orderkey") % 10).cast("double")
    return read(s, d, "lineitem").select((F.col("l_orderkey") % 10).alias("g"), (g + (3 + 0 * g) * F.sin(p) * F.cos(q)).alias("x"), (1 + 2 * F.sin(p) * F.sin(q)).alias("y"), (g / 2 + 1.5 * F.cos(p)).alias("z"))


def _keypoints(s, d):
    pair = lambda a, b: F.struct(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
    t = tracks(s, d).select("pos", F.array(pair("x1", "y1"), pair("x2", "y2")).alias("truth"), F.array(pair("x1", "y2"), pair("x2", "y2")).alias("found"), ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"))
    return M.keypoint_similarity(t, 0.5)


def _file_date(name):
    """ddMMyy; years from 69 on are of the century before."""
    date = F.to_date(name, "ddMMyy")
    return F.when(F.year(date) >= 2069, F.add_months(date, -1200)).otherwise(date)


QUERIES = {
    "slice_rescale": (
        lambda s, d: slices(s, d).select(*FRAME, "tree_id", F.round(B.rescaled_bound("start", 0.75), 6).alias("s"), B.rescaled_bound("end", 0.75, floor=True).cast("long").alias("e")),
        f"""WITH {WITH_SLICES} SELECT scan_id, frame, tree_id, round(CASE WHEN "start" = -1 THEN -1 ELSE "start" / 0.75::DOUBLE END, 6) AS s, CAST(CASE WHEN "end" = -1 THEN -1 ELSE floor("end" / 0.75::DOUBLE) END AS BIGINT) AS e FROM slices""",
    ),
    "sensor_remap": (
        lambda s, d: tracks(s, d).select("pos", F.round(B.to_other_sensor(F.col("x1"), F.lit(200), F.lit(1300), 1536), 6).alias("jai"), F.round((F.col("x1") + 37) / 1.6, 6).alias("zed")),
        f"{WITH_TRACKS} SELECT pos, round(CASE WHEN x1 <= 200 THEN 10.0::DOUBLE WHEN x1 >= 1300 THEN 1526.0::DOUBLE ELSE (x1 - 200) * 1536 / 1100.0::DOUBLE END, 6) AS jai, round((x1 + 37) / 1.6::DOUBLE, 6) AS zed FROM tracks",
    ),
    "shrunk_boxes": (
        lambda s, d: tracks(s, d).select("pos", *B.shrunk(0.5)),
        f"{WITH_TRACKS} SELECT pos, x1 + (x2 - x1) * 0.25::DOUBLE AS x1, y1 + (y2 - y1) * 0.25::DOUBLE AS y1, x2 - (x2 - x1) * 0.25::DOUBLE AS x2, y2 - (y2 - y1) * 0.25::DOUBLE AS y2 FROM tracks",
    ),
    "box_formats": (
        lambda s, d: tracks(s, d).select("pos", *B.xyxy_to_xywh()).select("pos", *B.xywh_to_xyxy()).select("pos", *B.centred()).select("pos", "cx", "cy", F.round("aspect", 6).alias("aspect"), "h"),
        f"{WITH_TRACKS} SELECT pos, x1 + (x2 - x1) / 2.0::DOUBLE AS cx, y1 + (y2 - y1) / 2.0::DOUBLE AS cy, round((x2 - x1) / (y2 - y1)::DOUBLE, 6) AS aspect, y2 - y1 AS h FROM tracks",
    ),
    "frame_normalise": (
        _frame_ids,
        """WITH q AS (SELECT user_id, event_id, event_id - first(event_id) OVER w AS zed, row_number() OVER w - 1 AS jai, lead(event_id) OVER w AS nx FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
        SELECT user_id, event_id, zed, jai FROM q WHERE nx IS NOT NULL""",
    ),
    "pinhole_size": (
        lambda s, d: M.real_size(tracks(s, d), 1065.0).select("pos", F.round("real_width", 6).alias("real_width"), F.round("real_height", 6).alias("real_height")),
        f"{WITH_TRACKS} SELECT pos, round((x2 - x1) * (depth / 1065), 6) AS real_width, round((y2 - y1) * (depth / 1065), 6) AS real_height FROM tracks",
    ),
    "outlier_clip": (
        lambda s, d: M.within_deviations(tracks(s, d).select("scan_id", "pos", "x1", "y1"), KEY, ["x1", "y1"], 1.3).select("pos"),
        f"""{WITH_TRACKS}, f AS (SELECT scan_id, quantile_cont(x1, 0.5) AS mx, stddev_pop(x1) AS sx, quantile_cont(y1, 0.5) AS my, stddev_pop(y1) AS sy FROM tracks GROUP BY ALL)
        SELECT pos FROM tracks t JOIN f USING (scan_id) WHERE abs(x1 - mx) <= 1.3 * sx AND abs(y1 - my) <= 1.3 * sy""",
    ),
    "kde_filter": (
        lambda s, d: M.distinct_densities(boxes(s, d), FRAME, 150.0, 6),
        f"""{WITH_BOXES} SELECT DISTINCT a.scan_id, a.frame, a.pos, round(avg(exp(-(pow((a.x1 + a.x2) / 2.0::DOUBLE - (b.x1 + b.x2) / 2.0::DOUBLE, 2) + pow((a.y1 + a.y2) / 2.0::DOUBLE - (b.y1 + b.y2) / 2.0::DOUBLE, 2)) / 45000)), 6) AS density
        FROM boxes a JOIN boxes b ON a.scan_id = b.scan_id AND a.frame = b.frame GROUP BY a.scan_id, a.frame, a.pos, a.x1, a.x2, a.y1, a.y2""",
    ),
    "meta_lookup": (
        _meta,
        "SELECT s_suppkey, lower(n_name) AS block, n_regionkey AS variety FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    ),
    "max_cut_frame": (
        lambda s, d: slices(s, d).where("end <> -1").groupBy("scan_id").agg(F.max("frame").alias("cut")).join(tracks(s, d).select("scan_id").distinct(), "scan_id", "right").select("scan_id", F.coalesce("cut", F.lit(2**31)).alias("cut")),
        f"""{WITH_TRACKS}, {WITH_SLICES}, m AS (SELECT scan_id, max(frame) AS cut FROM slices WHERE "end" <> -1 GROUP BY ALL) SELECT scan_id, coalesce(cut, 2147483648) AS cut FROM (SELECT DISTINCT scan_id FROM tracks) LEFT JOIN m USING (scan_id)""",
    ),
    "cdf_quantile": (
        lambda s, d: M.quantile_bin(E.histogram(tracks(s, d), KEY, "depth", 0.0, 8.0, 64), KEY, 0.9),
        f"""{WITH_TRACKS}, h AS (SELECT scan_id, CAST(floor(depth * 8) AS INTEGER) AS bin, count(*) AS n FROM tracks WHERE depth >= 0 AND depth < 8 GROUP BY ALL),
        c AS (SELECT scan_id, bin, sum(n) OVER (PARTITION BY scan_id ORDER BY bin) AS below, sum(n) OVER (PARTITION BY scan_id) AS whole FROM h) SELECT scan_id, min(bin) AS bin FROM c WHERE below >= 0.9 * whole GROUP BY ALL""",
    ),
    "close_scene": (
        lambda s, d: M.nearest_mean(tracks(s, d), FRAME, "depth", 10).select(*FRAME, F.round("nearest", 6).alias("nearest"), (F.col("nearest") <= 0.9).alias("close")),
        f"{WITH_TRACKS}, r AS (SELECT scan_id, frame, depth, row_number() OVER (PARTITION BY scan_id, frame ORDER BY depth) AS k FROM tracks) SELECT scan_id, frame, round(avg(depth), 6) AS nearest, avg(depth) <= 0.9 AS close FROM r WHERE k <= 10 GROUP BY ALL",
    ),
    "sample_frames": (
        lambda s, d: M.hashed_sample(tracks(s, d).select(*FRAME).distinct(), KEY, "frame", 5),
        f"{WITH_TRACKS}, f AS (SELECT DISTINCT scan_id, frame FROM tracks) SELECT scan_id, frame FROM f QUALIFY row_number() OVER (PARTITION BY scan_id ORDER BY md5('s:' || frame), frame) <= 5",
    ),
    "ratio_columns": (
        lambda s, d: read(s, d, "lineitem").groupBy("l_suppkey").agg(F.sum(F.expr("if(l_linenumber = 9, 1, 0)")).alias("zero"), F.count("*").alias("n")).select("l_suppkey", B.ratio(F.col("n"), F.col("zero")).alias("by_zero"), F.round(B.ratio(F.col("zero"), F.col("n")), 6).alias("share")),
        "SELECT l_suppkey, CAST(NULL AS DOUBLE) AS by_zero, round(sum(CASE WHEN l_linenumber = 9 THEN 1 ELSE 0 END) / count(*)::DOUBLE, 6) AS share FROM lineitem GROUP BY ALL",
    ),
    "fruit_sums": (
        lambda s, d: tracks(s, d).groupBy("class").agg(F.count("*").alias("n"), F.sum("x1").alias("total")),
        f"{WITH_TRACKS} SELECT class, count(*) AS n, CAST(sum(x1) AS BIGINT) AS total FROM tracks GROUP BY ALL",
    ),
    "letter_fold": (
        lambda s, d: read(s, d, "customer").select("c_custkey", F.lpad(F.regexp_replace(F.lower(F.concat(F.lit("O"), F.col("c_nationkey"))), "o", "0"), 4, "0").alias("code")),
        "SELECT c_custkey, lpad(replace(lower('O' || c_nationkey), 'o', '0'), 4, '0') AS code FROM customer",
    ),
    "latest_file": (
        lambda s, d: read(s, d, "orders").select("o_custkey", F.date_format("o_orderdate", "ddMMyy").alias("name")).groupBy("o_custkey").agg(F.max_by("name", _file_date("name")).alias("latest")),
        "SELECT o_custkey, strftime(max(o_orderdate), '%d%m%y') AS latest FROM orders GROUP BY ALL",
    ),
    "keypoint_similarity": (
        lambda s, d: _keypoints(s, d).select("pos", F.round("oks", 6).alias("oks")),
        f"{WITH_TRACKS} SELECT pos, round((exp(-pow(y2 - y1, 2) / (2.0::DOUBLE * (x2 - x1) * (y2 - y1))) + 1) / 2, 6) AS oks FROM tracks",
    ),
    "coco_eval": (lambda s, d: _ap(s, d).select("class", "threshold", F.round("ap", 6).alias("ap")), None),
    "ellipsoid_fit": (lambda s, d: M.ellipsoids(_points3(s, d), ["g"]), None),
}
