"""Box projections, overlaps, duplicates, neighbours and assignments within a frame."""

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..operators import geometry as G
from ..operators import spatial as N
from ..operators import matching as M
from .tables import WITH_BOXES, WITH_TRACKS, boxes, read, slices, tracks

FRAME = ["scan_id", "frame"]


def _all(s, d):
    return boxes(s, d).select("scan_id", "frame", "pos", "x1", "y1", "x2", "y2", "depth", "score")


_ALL = WITH_BOXES
_PAIRS = "boxes a JOIN boxes b ON a.scan_id = b.scan_id AND a.frame = b.frame AND a.pos < b.pos"


def _common(inclusive):
    m = "+ 1" if inclusive else ""
    return f"greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1) {m}, 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1) {m}, 0)"


def _iou(inclusive, inclusive_area):
    m = "+ 1" if inclusive_area else ""
    size = lambda t: f"(({t}.x2 - {t}.x1 {m}) * ({t}.y2 - {t}.y1 {m}))"
    return f"CAST({_common(inclusive)} AS DOUBLE) / ({size('a')} + {size('b')} - {_common(inclusive)})"


def _iou_query(inclusive, inclusive_area):
    def run(s, d):
        value = G.iou("a", "b", inclusive, inclusive_area)
        return G.frame_pairs(_all(s, d), FRAME, G.intersection("a", "b", inclusive) > 0).select(*FRAME, F.col("a.pos").alias("a"), F.col("b.pos").alias("b"), F.round(value, 6).alias("iou"))

    return run


def _iou_sql(inclusive, inclusive_area):
    # Boxes are cut into cells by their corners, so that only pairs whose closed boxes touch are looked at.
    touch = "AND a.x1 <= b.x2 AND b.x1 <= a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2"
    return f"{_ALL} SELECT a.scan_id, a.frame, a.pos AS a, b.pos AS b, round({_iou(inclusive, inclusive_area)}, 6) AS iou FROM {_PAIRS} {touch} WHERE {_common(inclusive)} > 0"


#: Boxes in order of score; each stays unless one of those kept before it overlaps it.
_NMS_SQL = f"""{_ALL}, r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scan_id, frame ORDER BY score DESC, pos) AS n FROM boxes),
over AS (SELECT b.pos, list(a.pos) AS rivals FROM r a JOIN r b ON a.scan_id = b.scan_id AND a.frame = b.frame AND a.n < b.n AND {_iou(False, False)} > 0.45 GROUP BY b.pos),
o AS MATERIALIZED (SELECT r.*, coalesce(rivals, []::BIGINT[]) AS rivals FROM r LEFT JOIN over USING (pos)),
e AS (SELECT scan_id, frame, class, n, pos, true AS stays, [pos] AS kept FROM o WHERE n = 1
UNION ALL SELECT scan_id, frame, class, n, pos, fine, CASE WHEN fine THEN list_append(kept, pos) ELSE kept END FROM (SELECT o.*, kept, NOT list_has_any(kept, rivals) AS fine FROM e JOIN o ON o.scan_id = e.scan_id AND o.frame = e.frame AND o.n = e.n + 1))
SELECT scan_id, frame, pos FROM e WHERE stays"""

QUERIES = {
    "box_transforms": (
        lambda s, d: B.transformed(tracks(s, d), det=(640, 480), frame=(2048, 1536)),
        f"""{WITH_TRACKS}, r AS (SELECT *, 1.0::DOUBLE / least(640.0::DOUBLE / 2048, 480.0::DOUBLE / 1536) AS k FROM tracks)
        SELECT pos, CAST(trunc(x1 * k) AS INTEGER) AS sx1, CAST(trunc(y1 * k) AS INTEGER) AS sy1, CAST(trunc(x2 * k) AS INTEGER) AS sx2, CAST(trunc(y2 * k) AS INTEGER) AS sy2,
        x2 - x1 AS w, y2 - y1 AS h, (x1 + x2) / 2.0::DOUBLE AS cx, (y1 + y2) / 2.0::DOUBLE AS cy, (x2 - x1) * (y2 - y1) AS area, round((x2 - x1) / (y2 - y1)::DOUBLE, 6) AS aspect,
        greatest(0, least(1400, x1 + 10)) AS cx1, greatest(0, least(1400, x2 + 10)) AS cx2 FROM r""",
    ),
    "box_filters": (
        lambda s, d: B.filtered(tracks(s, d), least_area=1500, least_score=0.3, low=20, high=70).select("pos"),
        f"{WITH_TRACKS} SELECT pos FROM tracks WHERE (x2 - x1) * (y2 - y1) > 1500 AND score >= 0.3 AND (x2 - x1) * (y2 - y1) > 400 AND (x2 - x1) * (y2 - y1) < 4900",
    ),
    "slice_boxes": (
        lambda s, d: B.slice_boxes(slices(s, d), 1536, 2048),
        """WITH s AS (SELECT DISTINCT CAST(o_orderkey % 5 AS BIGINT) AS scan_id, CAST(o_orderkey % 200 AS BIGINT) AS frame, CAST((o_orderkey % 200) // 20 AS BIGINT) AS tree_id,
        CASE WHEN (o_orderkey % 200) % 20 = 0 THEN 0 ELSE ((o_orderkey % 200) % 20)*30 END AS a, CASE WHEN (o_orderkey % 200) % 20 = 19 THEN 1535 ELSE 900 + ((o_orderkey % 200) % 20)*30 END AS b FROM orders)
        SELECT scan_id, frame, tree_id, CAST(a AS BIGINT) AS x, 0 AS y, CAST(b - a AS BIGINT) AS w, 2048 AS h FROM s WHERE NOT (tree_id = (SELECT max(tree_id) FROM s) AND a = 0)""",
    ),
    "iou_inclusive": (_iou_query(True, False), _iou_sql(True, False)),
    "iou_exclusive": (_iou_query(False, False), _iou_sql(False, False)),
    "iou_inclusive_area": (_iou_query(True, True), _iou_sql(True, True)),
    "score_terms": (
        lambda s, d: M.score_terms(G.frame_pairs(_all(s, d), FRAME, G.intersection("a", "b", False) > 0), 1536).select(*FRAME, "a", "b", "shape", "near", "alike"),
        f"""{_ALL} SELECT a.scan_id, a.frame, a.pos AS a, b.pos AS b,
        least(((a.x2 - a.x1) * (a.y2 - a.y1))::DOUBLE / ((b.x2 - b.x1) * (b.y2 - b.y1)), ((b.x2 - b.x1) * (b.y2 - b.y1))::DOUBLE / ((a.x2 - a.x1) * (a.y2 - a.y1))) AS shape,
        greatest(1 - sqrt(pow((a.x1 + a.x2) / 2.0::DOUBLE - (b.x1 + b.x2) / 2.0::DOUBLE, 2) + pow((a.y1 + a.y2) / 2.0::DOUBLE - (b.y1 + b.y2) / 2.0::DOUBLE, 2)) / 1536, 0) AS near,
        1 - abs(a.score - b.score) AS alike FROM {_PAIRS} WHERE {_common(False)} > 0""",
    ),
    "depth_z_score": (
        lambda s, d: M.depth_terms(_all(s, d).withColumn("depth", F.round(F.col("depth") * 100)), FRAME),
        f"{_ALL}, h AS (SELECT scan_id, frame, pos, round(depth * 100) AS depth FROM boxes) SELECT scan_id, frame, pos, CASE WHEN max(depth) OVER w = min(depth) OVER w THEN 0.5::DOUBLE ELSE 1 - abs(depth - avg(depth) OVER w) / (max(depth) OVER w - min(depth) OVER w) END AS depth_score FROM h WINDOW w AS (PARTITION BY scan_id, frame)",
    ),
    "dup_filter": (
        lambda s, d: G.without_duplicates(_all(s, d), FRAME, 0.5).select(*FRAME, "pos"),
        f"{_ALL} SELECT scan_id, frame, pos FROM boxes WHERE pos NOT IN (SELECT b.pos FROM {_PAIRS} AND {_iou(True, False)} > 0.5)",
    ),
    "containment_filter": (
        lambda s, d: G.without_covering(_all(s, d), FRAME, 0.8).select(*FRAME, "pos"),
        f"""{_ALL} SELECT scan_id, frame, pos FROM boxes WHERE pos NOT IN (
        SELECT a.pos FROM boxes a JOIN boxes b ON a.scan_id = b.scan_id AND a.frame = b.frame AND a.pos <> b.pos WHERE {_common(True)} > 0.8 * ((b.x2 - b.x1) * (b.y2 - b.y1)))""",
    ),
    "best_iou_nomatch": (
        lambda s, d: G.best_overlaps(_all(s, d).where("pos % 2 = 0"), _all(s, d).where("pos % 2 = 1"), FRAME).where("best < 0.2").select(*FRAME, "pos", F.round("best", 6).alias("best")),
        f"""{_ALL}, m AS (SELECT a.scan_id, a.frame, a.pos, max(coalesce({_iou(True, False)}, 0)) AS best FROM (SELECT * FROM boxes WHERE pos % 2 = 0) a LEFT JOIN (SELECT * FROM boxes WHERE pos % 2 = 1) b
        ON a.scan_id = b.scan_id AND a.frame = b.frame GROUP BY ALL) SELECT scan_id, frame, pos, round(best, 6) AS best FROM m WHERE best < 0.2""",
    ),
    "knn_boxes": (
        lambda s, d: N.nearest_boxes(_all(s, d), FRAME, 3).select(*FRAME, "pos", F.col("rank").cast("long").alias("rank"), "other", F.round("distance", 6).alias("distance")),
        f"""{_ALL}, q AS (SELECT a.scan_id, a.frame, a.pos, b.pos AS other, sqrt(pow((a.x1 + a.x2) / 2.0::DOUBLE - (b.x1 + b.x2) / 2.0::DOUBLE, 2) + pow((a.y1 + a.y2) / 2.0::DOUBLE - (b.y1 + b.y2) / 2.0::DOUBLE, 2)) AS distance
        FROM boxes a JOIN boxes b ON a.scan_id = b.scan_id AND a.frame = b.frame AND a.pos <> b.pos), r AS (SELECT *, row_number() OVER (PARTITION BY scan_id, frame, pos ORDER BY distance, other) AS rank FROM q)
        SELECT scan_id, frame, pos, rank, other, round(distance, 6) AS distance FROM r WHERE rank <= 3""",
    ),
    "cosine_pairs": (
        lambda s, d: M.cosine_distances(read(s, d, "embeddings"), F.col("vec_id") % 20 == 0, digits=6),
        """SELECT q.vec_id AS a, v.vec_id AS b, round(1 - list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS distance
        FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0""",
    ),
    "cosine_self_join": (
        lambda s, d: M.cosine_distances(read(s, d, "embeddings"), digits=6),
        """SELECT q.vec_id AS a, v.vec_id AS b, round(1 - list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS distance
        FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id <> v.vec_id""",
    ),
    "greedy_assign": (
        lambda s, d: G.greedy_assign(M.scored_pairs(_all(s, d).where("pos % 2 = 0"), _all(s, d).where("pos % 2 = 1"), FRAME), FRAME).select(*FRAME, "trk", "det", F.round("score", 6).alias("score")),
        f"""{_ALL}, p AS (SELECT a.scan_id, a.frame, a.pos AS trk, b.pos AS det, {_iou(False, False)} AS score FROM boxes a JOIN boxes b ON a.scan_id = b.scan_id AND a.frame = b.frame AND a.pos % 2 = 0 AND b.pos % 2 = 1 WHERE {_common(False)} > 0),
        o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scan_id, frame ORDER BY score DESC, trk, det) AS n FROM p),
        e AS (SELECT scan_id, frame, n, trk, det, score, true AS taken, [trk] AS ts, [det] AS ds FROM o WHERE n = 1
        UNION ALL SELECT scan_id, frame, n, trk, det, score, free, CASE WHEN free THEN list_append(ts, trk) ELSE ts END, CASE WHEN free THEN list_append(ds, det) ELSE ds END
        FROM (SELECT o.*, ts, ds, NOT list_contains(ts, o.trk) AND NOT list_contains(ds, o.det) AS free FROM e JOIN o ON o.scan_id = e.scan_id AND o.frame = e.frame AND o.n = e.n + 1))
        SELECT scan_id, frame, trk, det, round(score, 6) AS score FROM e WHERE taken""",
    ),
    "nms": (lambda s, d: G.non_maximum_suppression(_all(s, d), FRAME, 0.45).select(*FRAME, "pos"), _NMS_SQL),
    "nms_by_class": (
        lambda s, d: G.non_maximum_suppression(boxes(s, d), [*FRAME, "class"], 0.45).select(*FRAME, "class", "pos"),
        _NMS_SQL.replace("PARTITION BY scan_id, frame", "PARTITION BY scan_id, frame, class").replace("a.frame = b.frame", "a.frame = b.frame AND a.class = b.class").replace("o.frame = e.frame", "o.frame = e.frame AND o.class = e.class").replace("SELECT scan_id, frame, pos FROM e", "SELECT scan_id, frame, class, pos FROM e"),
    ),
}
