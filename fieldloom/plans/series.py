"""Time alignment, distances, headings, windows and islands."""

from pyspark.sql import functions as F

from ..operators import spatial as N
from ..operators import timeseries as T
from .tables import KEY, PLOTS, WITH_POINTS, WITH_TRACKS, events, frames_and_fixes, plots, points, read, tracks

_HAVERSINE = "2 * 6371000.0 * asin(sqrt(pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2)))"


def _haversine(a, b, c, d):
    return _HAVERSINE.format(a=a, b=b, c=c, d=d)


def _per_frame(s, d):
    return tracks(s, d).groupBy("scan_id", "frame").agg(F.sum("x1").alias("v"), F.count("*").alias("n"))


_PER_FRAME = f"{WITH_TRACKS}, per AS (SELECT scan_id, frame, CAST(sum(x1) AS BIGINT) AS v, count(*) AS n FROM tracks GROUP BY ALL)"
_FRAMES = "WITH f AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click'), x AS (SELECT user_id, ts, event_id AS fix FROM events WHERE event_type = 'view')"


def _asof(condition, order, tolerance=""):
    return f"""{_FRAMES}, j AS (SELECT f.user_id, f.ts, f.event_id, x.fix, x.ts AS fix_ts,
        row_number() OVER (PARTITION BY f.event_id ORDER BY {order}) AS r FROM f JOIN x ON x.user_id = f.user_id AND {condition} {tolerance})
        SELECT f.user_id, f.ts, f.event_id, j.fix, j.fix_ts FROM f LEFT JOIN j ON j.event_id = f.event_id AND j.r = 1"""


def _asof_query(**how):
    def run(s, d):
        frames, fixes = frames_and_fixes(s, d)
        return T.asof(frames, fixes, ["user_id"], "ts", "fix", **how)

    return run


def _intervals(s, d):
    e = events(s, d)
    spans = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("start"), F.expr("ts + interval 20 minutes").alias("end"))
    return T.inside_intervals(e.where("event_type = 'click'").select("user_id", "ts", "event_id"), spans, ["user_id"], "ts")


def _ring_sql(ring):
    tests = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if y1 != y2:
            tests.append(f"CASE WHEN ({y1}::DOUBLE > lat) <> ({y2}::DOUBLE > lat) AND lon < ({x2}::DOUBLE - {x1}::DOUBLE) * (lat - {y1}::DOUBLE) / ({y2}::DOUBLE - {y1}::DOUBLE) + {x1}::DOUBLE THEN 1 ELSE 0 END")
    return f"({' + '.join(tests)}) % 2 = 1"


_PIP = "CASE " + " ".join(f"WHEN {_ring_sql(ring)} THEN '{name}'" for name, _, ring in PLOTS) + " ELSE 'global' END"

QUERIES = {
    "haversine_origin": (
        lambda s, d: T.from_origin(points(s, d), KEY, "place").select("scan_id", "place", F.round("distance", 4).alias("distance")),
        f"{WITH_POINTS}, o AS (SELECT *, first(lat) OVER w AS lat0, first(lon) OVER w AS lon0 FROM points WINDOW w AS (PARTITION BY scan_id ORDER BY place)) SELECT scan_id, place, round({_haversine('lat0', 'lon0', 'lat', 'lon')}, 4) AS distance FROM o",
    ),
    "haversine_cum": (
        lambda s, d: T.along_path(points(s, d), KEY, "place").select("scan_id", "place", F.round("step", 4).alias("step"), F.round("travelled", 2).alias("travelled")),
        f"""{WITH_POINTS}, o AS (SELECT *, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0 FROM points WINDOW w AS (PARTITION BY scan_id ORDER BY place)),
        q AS (SELECT scan_id, place, coalesce({_haversine('lat0', 'lon0', 'lat', 'lon')}, 0) AS step FROM o)
        SELECT scan_id, place, round(step, 4) AS step, round(sum(step) OVER (PARTITION BY scan_id ORDER BY place ROWS UNBOUNDED PRECEDING), 2) AS travelled FROM q""",
    ),
    "heading": (
        lambda s, d: T.headings(points(s, d), KEY, "place").select("scan_id", "place", F.round("heading", 4).alias("heading"), T.in_heading_range(F.col("heading"), 300.0, 60.0).alias("in_row")),
        f"""{WITH_POINTS}, o AS (SELECT *, lat - lag(lat) OVER w AS dy, lon - lag(lon) OVER w AS dx FROM points WINDOW w AS (PARTITION BY scan_id ORDER BY place)),
        h AS (SELECT scan_id, place, CASE WHEN dy <> 0 OR dx <> 0 THEN fmod(fmod(degrees(atan2(dx, dy)), 360) + 360, 360) END AS h FROM o),
        k AS (SELECT scan_id, place, last_value(h IGNORE NULLS) OVER (PARTITION BY scan_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS heading FROM h)
        SELECT scan_id, place, round(heading, 4) AS heading, heading >= 300 OR heading <= 60 AS in_row FROM k""",
    ),
    "ema": (
        lambda s, d: T.smoothed(events(s, d), ["user_id"], "ts", "value", 0.02, 0.5).select("user_id", F.round("ema", 6).alias("ema")),
        """WITH e AS (SELECT user_id, value, count(*) OVER (PARTITION BY user_id) - row_number() OVER (PARTITION BY user_id ORDER BY ts) AS later, count(*) OVER (PARTITION BY user_id) AS n FROM events)
        SELECT user_id, round(sum(0.02 * value * pow(0.98, later)) + 0.5 * pow(0.98, max(n)), 6) AS ema FROM e GROUP BY ALL""",
    ),
    "plot_transitions": (
        lambda s, d: T.transitions(events(s, d).select("user_id", "ts", "event_type"), ["user_id"], "ts", "event_type"),
        "WITH l AS (SELECT user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events) SELECT * FROM l WHERE event_type IS DISTINCT FROM before",
    ),
    "islands": (
        lambda s, d: T.islands(events(s, d).select("user_id", "ts", "event_type"), ["user_id"], "ts", "event_type"),
        """WITH l AS (SELECT user_id, ts, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
        SELECT user_id, ts, event_type, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l""",
    ),
    "session_gap": (
        lambda s, d: T.along_sessions(events(s, d).select("user_id", "ts", "event_id"), ["user_id"], "ts", 30 * 60),
        """WITH l AS (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000 THEN 1 ELSE 0 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
        SELECT user_id, ts, event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM l""",
    ),
    "count_windows": (
        lambda s, d: T.count_windows(events(s, d), ["user_id"], "ts", 20).groupBy("user_id", "window").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")),
        """WITH r AS (SELECT user_id, ts, (row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1) // 20 AS w FROM events)
        SELECT user_id, w AS window, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM r GROUP BY ALL""",
    ),
    "bfill": (
        lambda s, d: T.filled_back(events(s, d).select("user_id", "ts", F.expr("case when event_type = 'view' then event_id end").alias("fix")), ["user_id"], "ts", "fix"),
        "SELECT user_id, ts, first_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fix FROM events",
    ),
    "moving_avg_zero_pad": (
        lambda s, d: T.moving_average(_per_frame(s, d).select("scan_id", "frame", "v"), KEY, "frame", "v").select("scan_id", "frame", F.round("average", 6).alias("average")),
        f"{_PER_FRAME} SELECT scan_id, frame, round(sum(v) OVER (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10.0, 6) AS average FROM per",
    ),
    "cumsum5_diff": (
        lambda s, d: T.every_nth_difference(_per_frame(s, d), KEY, "frame", "v"),
        f"""{_PER_FRAME}, q AS (SELECT scan_id, frame, CAST(sum(v) OVER w AS BIGINT) AS total, row_number() OVER w - 1 AS nth FROM per WINDOW w AS (PARTITION BY scan_id ORDER BY frame))
        SELECT scan_id, frame, total, total - lag(total) OVER (PARTITION BY scan_id ORDER BY frame) AS gain FROM q WHERE nth % 5 = 0""",
    ),
    "slice_ids": (
        lambda s, d: T.split_ids(_per_frame(s, d).select("scan_id", "frame", (F.col("v") % 100 / 10.0).alias("distance")), KEY, "frame", "distance", 3.0, 1.0).select("scan_id", "frame", "slice_id"),
        f"""{_PER_FRAME}, q AS (SELECT scan_id, frame, fmod(v % 100 / 10.0::DOUBLE, 3.0) < 1.0 AS hit FROM per),
        z AS (SELECT scan_id, frame, CASE WHEN hit AND NOT coalesce(lag(hit) OVER w, false) THEN 1 ELSE 0 END AS f FROM q WINDOW w AS (PARTITION BY scan_id ORDER BY frame))
        SELECT scan_id, frame, CAST(sum(f) OVER (PARTITION BY scan_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS BIGINT) AS slice_id FROM z""",
    ),
    "interp_distance": (
        lambda s, d: T.interpolated(_per_frame(s, d).select("scan_id", "frame", F.expr("frame div 7 * 10").cast("double").alias("distance")), KEY, "frame", "distance").select("scan_id", "frame", F.round("smooth", 6).alias("smooth")),
        f"""{_PER_FRAME}, q AS (SELECT scan_id, frame, CAST(frame // 7 * 10 AS DOUBLE) AS v, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM per),
        m AS (SELECT *, CASE WHEN lag(v) OVER w IS DISTINCT FROM v THEN n END AS cn, CASE WHEN lag(v) OVER w IS DISTINCT FROM v THEN v END AS cv FROM q WINDOW w AS (PARTITION BY scan_id ORDER BY frame)),
        z AS (SELECT scan_id, frame, n, last_value(cn IGNORE NULLS) OVER b AS an, last_value(cv IGNORE NULLS) OVER b AS av, first_value(cn IGNORE NULLS) OVER a AS bn, first_value(cv IGNORE NULLS) OVER a AS bv FROM m
          WINDOW b AS (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
        SELECT scan_id, frame, round(coalesce(av + (bv - av) * (n - an) / (bn - an), av), 6) AS smooth FROM z""",
    ),
    "row_length": (
        lambda s, d: T.path_length(points(s, d), KEY, "place").select("scan_id", F.round("length", 4).alias("length")),
        f"{WITH_POINTS}, e AS (SELECT scan_id, arg_min(lat, place) AS a, arg_min(lon, place) AS b, arg_max(lat, place) AS c, arg_max(lon, place) AS d FROM points GROUP BY ALL) SELECT scan_id, round({_haversine('a', 'b', 'c', 'd')}, 4) AS length FROM e",
    ),
    "change_points": (
        lambda s, d: T.change_points(_per_frame(s, d).select("scan_id", "frame", "n"), KEY, "frame", "n"),
        f"{_PER_FRAME}, q AS (SELECT scan_id, frame, n, lead(n) OVER (PARTITION BY scan_id ORDER BY frame) AS nx FROM per) SELECT scan_id, frame, n FROM q WHERE nx - n = 1",
    ),
    "lag_seconds": (
        lambda s, d: T.lag_seconds(events(s, d).select("user_id", "ts"), ["user_id"], "ts").select("user_id", "ts", F.round("gap", 6).alias("gap")),
        "SELECT user_id, ts, round((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1000000.0::DOUBLE, 6) AS gap FROM events",
    ),
    "pip_first_match": (
        lambda s, d: N.locate(points(s, d), plots(s)).select("scan_id", "place", "plot"),
        f"{WITH_POINTS} SELECT scan_id, place, {_PIP} AS plot FROM points",
    ),
    "zip_join": (
        lambda s, d: T.zipped(events(s, d).where("event_type = 'click'").select("user_id", "event_id"), events(s, d).where("event_type = 'view'").select("user_id", F.col("event_id").alias("fix")), ["user_id"], "event_id", "fix").select("user_id", F.col("place").cast("long").alias("place"), "event_id", "fix"),
        """WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'click'),
        b AS (SELECT user_id, event_id AS fix, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'view') SELECT user_id, place, event_id, fix FROM a JOIN b USING (user_id, place)""",
    ),
    "asof_backward": (_asof_query(direction="backward"), _asof("x.ts <= f.ts", "x.ts DESC")),
    "asof_forward_strict": (_asof_query(direction="forward", strict=True), _asof("x.ts > f.ts", "x.ts")),
    "asof_nearest_tol": (
        _asof_query(direction="nearest", tolerance_us=10_800_000_000),
        _asof("abs(epoch_us(x.ts) - epoch_us(f.ts)) <= 10800000000", "abs(epoch_us(x.ts) - epoch_us(f.ts)), x.ts"),
    ),
    "asof_nearest_tie_later": (_asof_query(direction="nearest", tie="later"), _asof("true", "abs(epoch_us(x.ts) - epoch_us(f.ts)), x.ts DESC")),
    "interval_flag": (
        _intervals,
        """WITH p AS (SELECT user_id, ts AS a, ts + INTERVAL 20 MINUTE AS b FROM events WHERE event_type = 'purchase')
        SELECT user_id, ts, event_id, EXISTS (SELECT 1 FROM p WHERE p.user_id = e.user_id AND e.ts BETWEEN a AND b) AS inside FROM events e WHERE event_type = 'click'""",
    ),
}
