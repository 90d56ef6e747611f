"""Histograms, precision and recall, average precision, regression factors and cross-validation."""

from pyspark.sql import functions as F

from ..operators import annotations as A
from ..operators import evaluation as E
from ..operators import regression as R
from ..operators import scans as P
from .tables import KEY, WITH_TRACKS, read, tracks

_SCORED = "WITH scored AS (SELECT quality AS label, CAST((doc_id * 37) % 100 AS DOUBLE) / 100 AS score, doc_id FROM labels)"
_REGRESSION = "WITH r AS (SELECT l_suppkey % 10 AS g, CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem)"
_STEPS = [k / 10 for k in range(10)]


def _scored(s, d):
    return read(s, d, "labels").select(F.col("quality").alias("label"), (F.pmod(F.col("doc_id") * 37, F.lit(100)).cast("double") / 100).alias("score"), "doc_id")


def _regression(s, d):
    return read(s, d, "lineitem").select((F.col("l_suppkey") % 10).alias("g"), F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))


def _rows(s, d):
    return read(s, d, "lineitem").select((F.col("l_suppkey") % 10).alias("g"), (F.col("l_orderkey") % 12).alias("row"), F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))


_ROWS = "WITH r AS (SELECT l_suppkey % 10 AS g, l_orderkey % 12 AS row, CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem)"


def _hist(s, d):
    return E.histogram(tracks(s, d), KEY, "depth", 0.0, 8.0, 16)


_HIST = f"{WITH_TRACKS}, h AS (SELECT scan_id, CAST(floor(depth * 16 / 8) AS INTEGER) AS bin, count(*) AS n FROM tracks WHERE depth >= 0 AND depth < 8 GROUP BY ALL)"

QUERIES = {
    "pr_grid": (
        lambda s, d: E.pr_grid(_scored(s, d), _STEPS).select("threshold", "tp", "fp", "fn", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1"))),
        f"""{_SCORED}, t(threshold) AS (SELECT CAST(k AS DOUBLE) / 10 FROM range(10) r(k)),
        c AS (SELECT threshold, CAST(count(*) FILTER (label = 1 AND score >= threshold) AS BIGINT) AS tp, CAST(count(*) FILTER (label = 0 AND score >= threshold) AS BIGINT) AS fp, CAST(count(*) FILTER (label = 1 AND score < threshold) AS BIGINT) AS fn FROM t, scored GROUP BY ALL),
        q AS (SELECT *, tp / nullif(tp + fp, 0)::DOUBLE AS p, tp / nullif(tp + fn, 0)::DOUBLE AS r FROM c)
        SELECT threshold, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / nullif(p + r, 0), 6) AS f1 FROM q""",
    ),
    "voc_ap": (
        lambda s, d: P.average_precision(_with_truth(_scored(s, d)), ["class"], [F.col("score").desc(), F.col("doc_id")]).select("class", F.round("ap", 6).alias("ap")),
        f"""{_SCORED}, m AS (SELECT doc_id % 4 AS class, label AS hit, score, doc_id, sum(label) OVER (PARTITION BY doc_id % 4) AS n_true FROM scored),
        a AS (SELECT class, score, doc_id, n_true, sum(hit) OVER w AS tp, row_number() OVER w AS n FROM m WINDOW w AS (PARTITION BY class ORDER BY score DESC, doc_id ROWS UNBOUNDED PRECEDING)),
        b AS (SELECT class, score, doc_id, tp / n::DOUBLE AS precision, tp / n_true::DOUBLE AS recall FROM a),
        c AS (SELECT class, max(precision) OVER (PARTITION BY class ORDER BY score DESC, doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e, recall - coalesce(lag(recall) OVER (PARTITION BY class ORDER BY score DESC, doc_id), 0) AS g FROM b)
        SELECT class, round(sum(e * g), 6) AS ap FROM c GROUP BY ALL""",
    ),
    "percentile_saturation": (
        lambda s, d: E.saturated(tracks(s, d), ["scan_id", "frame"], "depth", 0.4, 3.0),
        f"{WITH_TRACKS} SELECT scan_id, frame, quantile_cont(depth, 0.4) > 3 AS saturated FROM tracks GROUP BY ALL",
    ),
    "depth_histogram": (_hist, f"{_HIST} SELECT * FROM h"),
    "hist_mode": (
        lambda s, d: E.mode_bin(_hist(s, d), KEY),
        f"{_HIST} SELECT scan_id, bin AS mode FROM h QUALIFY row_number() OVER (PARTITION BY scan_id ORDER BY n DESC, bin) = 1",
    ),
    "hist_moments": (
        lambda s, d: E.weighted_moments(_hist(s, d), KEY).select("scan_id", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")),
        f"{_HIST} SELECT scan_id, round(sum(bin * n) / sum(n)::DOUBLE, 6) AS mean, round(sqrt(sum(bin * bin * n) / sum(n)::DOUBLE - pow(sum(bin * n) / sum(n)::DOUBLE, 2)), 6) AS std FROM h GROUP BY ALL",
    ),
    "mape": (
        lambda s, d: E.mean_absolute_percentage_error(_regression(s, d).withColumn("p", F.col("x") * 1500), ["g"], "y", "p").select("g", F.round("mape", 4).alias("mape")),
        f"{_REGRESSION} SELECT g, round(100 * avg(abs(y - x * 1500) / abs(nullif(y, 0))), 4) AS mape FROM r GROUP BY ALL",
    ),
    "ols_factor": (
        lambda s, d: E.factor(_regression(s, d), ["g"], "x", "y").select("g", F.round("factor", 4).alias("factor")),
        f"{_REGRESSION} SELECT g, round(sum(x * y) / sum(x * x), 4) AS factor FROM r GROUP BY ALL",
    ),
    "ols_line": (
        lambda s, d: E.line(_regression(s, d), ["g"], "x", "y").select("g", F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept")),
        f"{_REGRESSION} SELECT g, round(regr_slope(y, x), 3) AS slope, round(regr_intercept(y, x), 2) AS intercept FROM r GROUP BY ALL",
    ),
    "leave_one_group_out": (
        lambda s, d: E.leave_one_group_out(_regression(s, d), "g", "x", "y").select("g", F.round("factor", 4).alias("factor"), F.round("error", 6).alias("error")),
        f"""{_REGRESSION}, s AS (SELECT g, sum(x * y) AS xy, sum(x * x) AS xx, sum(x) AS sx, sum(y) AS sy FROM r GROUP BY ALL),
        f AS (SELECT g, sx, sy, ((SELECT sum(xy) FROM s) - xy) / ((SELECT sum(xx) FROM s) - xx) AS factor FROM s) SELECT g, round(factor, 4) AS factor, round((factor * sx - sy) / sy, 6) AS error FROM f""",
    ),
    "leave_one_row_out": (
        lambda s, d: R.left_out_errors(_rows(s, d), ["g"], "row", ["x"], "y").select("g", "row", "n", F.round(F.get("coefficients", F.lit(0)), 4).alias("factor"), F.round("error", 6).alias("error"), F.round("row_error", 6).alias("row_error")),
        f"""{_ROWS}, f AS (SELECT g, row, (sum(xy) OVER (PARTITION BY g) - xy) / (sum(xx) OVER (PARTITION BY g) - xx) AS factor FROM (SELECT g, row, sum(x * y) AS xy, sum(x * x) AS xx FROM r GROUP BY ALL))
        SELECT g, row, count(*) AS n, round(any_value(factor), 4) AS factor, round(abs(sum(factor * x) - sum(y)) / sum(y), 6) AS error, round(avg(abs(factor * x - y) / y), 6) AS row_error FROM r JOIN f USING (g, row) GROUP BY ALL""",
    ),
    "leave_one_row_out_spread": (
        lambda s, d: R.error_spread(R.left_out_errors(_rows(s, d), ["g"], "row", [], "y", intercept=True), ["g"]).select("g", *(F.round(c, 6).alias(c) for c in ("mean_error", "std_error", "mean_row_error", "std_row_error"))),
        f"""{_ROWS}, f AS (SELECT g, row, (sum(sy) OVER (PARTITION BY g) - sy) / (sum(n) OVER (PARTITION BY g) - n) AS mean FROM (SELECT g, row, sum(y) AS sy, count(*) AS n FROM r GROUP BY ALL)),
        e AS (SELECT g, row, abs(sum(mean) - sum(y)) / sum(y) AS error, avg(abs(mean - y) / y) AS row_error FROM r JOIN f USING (g, row) GROUP BY ALL)
        SELECT g, round(avg(error), 6) AS mean_error, round(stddev_pop(error), 6) AS std_error, round(avg(row_error), 6) AS mean_row_error, round(stddev_pop(row_error), 6) AS std_row_error FROM e GROUP BY ALL""",
    ),
    "align_noise": (
        lambda s, d: E.shift_noise(tracks(s, d).groupBy("scan_id", "frame").agg(F.sum("x1").alias("v")).withColumn("v", F.col("v") % 260), KEY, "frame", "v").select("scan_id", *(F.round(c, 6).alias(c) for c in ("std", "mean_gap", "median_gap"))),
        f"""{WITH_TRACKS}, p AS (SELECT scan_id, frame, CAST(least(greatest(CAST(sum(x1) AS BIGINT) % 260, -50), 200) AS DOUBLE) AS v FROM tracks GROUP BY ALL),
        q AS (SELECT scan_id, v, abs(v - sum(v) OVER (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10) AS gap FROM p)
        SELECT scan_id, round(stddev_pop(v), 6) AS std, round(avg(gap), 6) AS mean_gap, round(quantile_cont(gap, 0.5), 6) AS median_gap FROM q GROUP BY ALL""",
    ),
    "rolling_meter": (
        lambda s, d: E.meter(read(s, d, "events").withColumn("value", F.round(F.col("value") * 100)), ["user_id"], "ts", "value", 20).select("user_id", "ts", "recent", "overall"),
        """SELECT user_id, ts, avg(round(value * 100)) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS recent,
        avg(round(value * 100)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS overall FROM events""",
    ),
    "coco_stats": (
        lambda s, d: A.class_stats(tracks(s, d).select(F.col("class").alias("category_id"), F.col("frame").alias("image_id"))),
        f"""{WITH_TRACKS}, p AS (SELECT class, frame, count(*) AS n FROM tracks GROUP BY ALL)
        SELECT class AS category_id, CAST(sum(n) AS BIGINT) AS boxes, count(*) AS images, CAST(round_even(avg(n), 0) AS BIGINT) AS avg_boxes, max(n) AS max_boxes FROM p GROUP BY ALL""",
    ),
    "func_times": (
        lambda s, d: read(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value")),
        "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL",
    ),
}


def _with_truth(scored):
    from pyspark.sql.window import Window

    return scored.select((F.col("doc_id") % 4).alias("class"), F.col("label").alias("hit"), "score", "doc_id", F.sum("label").over(Window.partitionBy(F.col("doc_id") % 4)).alias("n_true"))
