"""Places among many plots, and their nearest neighbours."""

from pyspark.sql import functions as F

from ..operators import density as D
from ..operators import geometry as G
from ..operators import spatial as N
from .tables import PLOTS, WITH_BOXES, WITH_POINTS, boxes, plots, points, read

#: Corners of a notched plot, as shares of its width and height.
_CORNERS = [(0, 0), (6, 0), (6, 6), (3, 2), (0, 6)]
_X, _Y = "(p_partkey * 71) % 1000", "(p_partkey * 137) % 1000"
_W, _H = "(3 + p_partkey % 23)", "(2 + p_partkey % 17)"


def _many_plots(s, d):
    """A notched ring for each part; the smallest are 3 by 2, the largest 25 by 18 units of 1e-5 degrees."""
    corner = lambda i, j: f"struct(35 + cast({_X} + {_W} * {i} as double) / 100000 as lon, 32 + cast({_Y} + {_H} * {j} as double) / 100000 as lat)"
    ring = F.expr(f"array({', '.join(corner(i, j) for i, j in _CORNERS)})")
    parts = read(s, d, "part").select("p_partkey").distinct()
    return parts.select(F.concat(F.lit("part"), F.col("p_partkey")).alias("plot"), F.col("p_partkey").alias("place"), ring.alias("ring"))


def _crossings() -> str:
    xs = [f"(35 + CAST({_X} + {_W} * {i} AS DOUBLE) / 100000)" for i, _ in _CORNERS]
    ys = [f"(32 + CAST({_Y} + {_H} * {j} AS DOUBLE) / 100000)" for _, j in _CORNERS]
    n = len(xs)
    edge = lambda k, m: f"CASE WHEN ({ys[k]} > lat) <> ({ys[m]} > lat) AND lon < ({xs[m]} - {xs[k]}) * (lat - {ys[k]}) / ({ys[m]} - {ys[k]}) + {xs[k]} THEN 1 ELSE 0 END"
    return " + ".join(edge(k, (k + 1) % n) for k in range(n))


_OWN_PLACES = "SELECT DISTINCT scan_id, place, lat + CAST(place % 7 AS DOUBLE) / 1000000 AS lat, lon + CAST(place % 11 AS DOUBLE) / 1000000 AS lon FROM points"


def _centres(s, d):
    return boxes(s, d).select("scan_id", "frame", "pos", ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"))


def _places(s, d):
    """Points that are not all on corners."""
    return points(s, d).distinct().select("scan_id", "place", (F.col("lat") + (F.col("place") % 7).cast("double") / 1000000).alias("lat"), (F.col("lon") + (F.col("place") % 11).cast("double") / 1000000).alias("lon"))


#: About six metres in degrees.
_MARGIN = 6 / 111_000


def _inset(s, d):
    own = _places(s, d).crossJoin(F.broadcast(plots(s)).select("plot", "ring"))  # three plots
    return own.select("scan_id", "place", "plot", G.in_inset(F.col("lat"), F.col("lon"), F.col("ring"), _MARGIN).alias("inner"))


def _inset_sql() -> str:
    corners = ", ".join(f"('{name}', {k}, {x}::DOUBLE, {y}::DOUBLE)" for name, _, ring in PLOTS for k, (x, y) in enumerate(ring))
    return f"""{WITH_POINTS}, own AS ({_OWN_PLACES}), corners(plot, k, x, y) AS (VALUES {corners}),
    edges AS (SELECT plot, k, x AS ax, y AS ay, coalesce(lead(x) OVER w, first(x) OVER w) AS bx, coalesce(lead(y) OVER w, first(y) OVER w) AS "by" FROM corners WINDOW w AS (PARTITION BY plot ORDER BY k)),
    t AS (SELECT *, least(greatest(((lon - ax) * (bx - ax) + (lat - ay) * ("by" - ay)) / ((bx - ax) * (bx - ax) + ("by" - ay) * ("by" - ay)), 0), 1) AS t FROM own, edges),
    e AS (SELECT scan_id, place, plot, sqrt((lon - ax - t * (bx - ax)) * (lon - ax - t * (bx - ax)) + (lat - ay - t * ("by" - ay)) * (lat - ay - t * ("by" - ay))) AS far,
          CASE WHEN (ay > lat) <> ("by" > lat) AND lon < (bx - ax) * (lat - ay) / ("by" - ay) + ax THEN 1 ELSE 0 END AS crossed FROM t)
    SELECT scan_id, place, plot, sum(crossed) % 2 = 1 AND min(far) >= {_MARGIN!r}::DOUBLE AS "inner" FROM e GROUP BY ALL"""


QUERIES = {
    "inset_plots": (_inset, _inset_sql()),
    "pip_many_plots": (
        lambda s, d: N.locate(_places(s, d), _many_plots(s, d)).select("scan_id", "place", "plot"),
        f"""{WITH_POINTS}, own AS ({_OWN_PLACES}), first AS (SELECT o.place, min(p_partkey) AS best FROM own o JOIN (SELECT DISTINCT p_partkey FROM part) ON ({_crossings()}) % 2 = 1 GROUP BY o.place)
        SELECT scan_id, place, coalesce('part' || best, 'global') AS plot FROM own LEFT JOIN first USING (place)""",
    ),
    "any_of_many_plots": (
        lambda s, d: N.in_any(_places(s, d), _many_plots(s, d).where("place % 3 = 0")).select("scan_id", "place", "inside"),
        f"""{WITH_POINTS}, own AS ({_OWN_PLACES}), within AS (SELECT DISTINCT o.place FROM own o JOIN part ON p_partkey % 3 = 0 AND ({_crossings()}) % 2 = 1)
        SELECT scan_id, place, place IN (FROM within) AS inside FROM own""",
    ),
    "knn_places": (
        lambda s, d: N.nearest(_places(s, d).select(F.col("place").alias("pos"), (F.col("lon") * 100000).alias("cx"), (F.col("lat") * 100000).alias("cy")), [], 5).select(
            "pos", F.col("rank").cast("long").alias("rank"), "other", F.round("distance", 4).alias("distance")
        ),
        f"""{WITH_POINTS}, own AS ({_OWN_PLACES}), c AS (SELECT place AS pos, lon * 100000 AS cx, lat * 100000 AS cy FROM own),
        q AS (SELECT a.pos, b.pos AS other, sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)) AS distance FROM c a JOIN c b ON a.pos <> b.pos),
        r AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY distance, other) AS rank FROM q) SELECT pos, rank, other, round(distance, 4) AS distance FROM r WHERE rank <= 5""",
    ),
    "dense_boxes": (
        lambda s, d: D.dense_points(_centres(s, d), ["scan_id", "frame"], ["cx", "cy"]).select("pos", F.round(F.col("density") * 1000000, 6).alias("density")),
        f"""{WITH_BOXES}, c AS (SELECT scan_id, frame, pos, (x1 + x2) / 2.0::DOUBLE AS cx, (y1 + y2) / 2.0::DOUBLE AS cy FROM boxes),
        f AS (SELECT scan_id, frame, count(*) AS n, covar_samp(cx, cx) AS a, covar_samp(cx, cy) AS b, covar_samp(cy, cy) AS c, pow(count(*), 2.0::DOUBLE / -6) AS h2 FROM c GROUP BY ALL),
        g AS (SELECT *, a * c - b * b > 1e-12::DOUBLE * a * c AS wide FROM f),
        k AS (SELECT p.pos, p.scan_id, p.frame, n, CASE WHEN wide THEN avg(exp(-(c * pow(p.cx - q.cx, 2) - 2 * b * (p.cx - q.cx) * (p.cy - q.cy) + a * pow(p.cy - q.cy, 2)) / (a * c - b * b) / h2 / 2))
              / (2 * pi() * h2 * sqrt(a * c - b * b)) END AS density
              FROM c p JOIN c q ON p.scan_id = q.scan_id AND p.frame = q.frame JOIN g ON p.scan_id = g.scan_id AND p.frame = g.frame GROUP BY p.pos, p.scan_id, p.frame, n, a, b, c, h2, wide)
        SELECT pos, round(density * 1000000, 6) AS density FROM k QUALIFY density IS NULL OR density / sum(density) OVER (PARTITION BY scan_id, frame) >= 0.5::DOUBLE / n""",
    ),
}
