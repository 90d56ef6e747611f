"""Detection scores with difficult boxes, and tracking scores with boxes to be ignored."""

from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators import scoring as S
from ..operators import voc as V
from .tables import WITH_BOXES, boxes

FRAME = ["scan_id", "frame"]
_BOX = ["x1", "y1", "x2", "y2"]


def _sides(s, d):
    """True boxes, some of them difficult, and found ones that are moved a little, some lost, some doubled."""
    rows = boxes(s, d).select(*FRAME, "class", "pos", *_BOX, "score")
    truth = rows.where("pos % 10 < 8").withColumn("difficult", (F.col("pos") % 7 == 0).cast("int"))
    moved = lambda k: [(F.col(c) + F.col("pos") % k - 4).alias(c) for c in _BOX]
    found = rows.where("pos % 10 > 0").select(*FRAME, "class", "pos", *moved(9), "score")
    again = rows.where("pos % 6 = 0").select(*FRAME, "class", (-F.col("pos") - 1).alias("pos"), *moved(5), (1 - F.col("score")).alias("score"))
    return truth, found.unionByName(again)


def _voc(s, d, eleven=False):
    return V.precisions(*_sides(s, d), FRAME, eleven_points=eleven)


_MATCHED = f"""{WITH_BOXES}, t AS (SELECT *, CASE WHEN pos % 7 = 0 THEN 1 ELSE 0 END AS difficult FROM boxes WHERE pos % 10 < 8),
f AS (SELECT scan_id, frame, class, pos, {", ".join(f"{c} + pos % 9 - 4 AS {c}" for c in _BOX)}, score FROM boxes WHERE pos % 10 > 0
      UNION ALL SELECT scan_id, frame, class, -pos - 1, {", ".join(f"{c} + pos % 5 - 4 AS {c}" for c in _BOX)}, 1 - score FROM boxes WHERE pos % 6 = 0),
p AS (SELECT a.scan_id, a.frame, a.class, a.pos, b.pos AS gt, b.difficult, (least(a.x2, b.x2) - greatest(a.x1, b.x1) + 1) * (least(a.y2, b.y2) - greatest(a.y1, b.y1) + 1) AS common,
      (a.x2 - a.x1 + 1) * (a.y2 - a.y1 + 1) + (b.x2 - b.x1 + 1) * (b.y2 - b.y1 + 1) AS whole
      FROM f a JOIN t b ON a.scan_id = b.scan_id AND a.frame = b.frame AND a.class = b.class AND a.x1 <= b.x2 AND b.x1 <= a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2),
best AS (SELECT *, common::DOUBLE / (whole - common) AS o FROM p QUALIFY row_number() OVER (PARTITION BY scan_id, frame, class, pos ORDER BY common::DOUBLE / (whole - common) DESC, gt) = 1),
each AS (SELECT f.*, threshold, coalesce(o > threshold, false) AS claims, gt, coalesce(difficult, 0) AS difficult FROM f LEFT JOIN best USING (scan_id, frame, class, pos), (SELECT unnest({V.OVERLAPS})::DOUBLE AS threshold)),
m AS (SELECT *, CAST(claims AND row_number() OVER (PARTITION BY scan_id, frame, class, threshold, claims, gt ORDER BY score DESC, pos) = 1 AS INTEGER) AS hit FROM each WHERE NOT (claims AND difficult = 1)),
counts AS (SELECT class, count(*) AS n_true FROM t WHERE difficult = 0 GROUP BY class),
curve AS (SELECT class, threshold, n_true, hit, score, scan_id, frame, pos, sum(hit) OVER w AS tp, row_number() OVER w AS n FROM m JOIN counts USING (class) WINDOW w AS (PARTITION BY class, threshold ORDER BY score DESC, scan_id, frame, pos ROWS UNBOUNDED PRECEDING))"""
_CELLS = f"""{_MATCHED}, e AS (SELECT class, threshold, n_true, hit, max(tp::DOUBLE / n) OVER (PARTITION BY class, threshold ORDER BY score DESC, scan_id, frame, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS envelope FROM curve),
cells AS (SELECT class, threshold, n_true, sum(hit * envelope / n_true) AS ap FROM e GROUP BY ALL)"""


def _sided(s, d):
    """True boxes, boxes to be ignored, and found ones that change their track every fifty frames."""
    rows = boxes(s, d).groupBy(*FRAME, F.expr("cast((pos div 1000 + pos) % 40 as double)").alias("gt_id")).agg(F.min(F.struct("pos", *_BOX)).alias("b"))
    rows = rows.select(*FRAME, "gt_id", "b.pos", *((F.col(f"b.{c}") + F.col("gt_id") / 16).alias(c) for c in _BOX))  # no two boxes in one place
    side = lambda kind, key, corners: F.struct(kind.alias("side"), key.alias("id"), "pos", *corners)
    real = side(F.when(F.col("gt_id") < 32, S.TRUE).otherwise(S.IGNORED), F.col("gt_id"), _BOX)
    found = side(F.lit(S.FOUND), F.col("gt_id") + 40 * F.floor(F.col("frame") / 50), [(F.col(c) + F.col("pos") % 9 - 4).alias(c) for c in _BOX])
    return rows.select(*FRAME, F.explode(F.array_compact(F.array(real, F.when(F.expr("pos % 11 <> 0"), found)))).alias("b")).select(*FRAME, "b.*")


def _tracks(s, d):
    """The three sides apart."""
    sides = _sided(s, d)
    of = lambda side, name: sides.where(F.col("side") == side).drop("side").withColumnRenamed("id", name)
    return of(S.TRUE, "gt_id"), of(S.IGNORED, "gt_id"), of(S.FOUND, "trk_id")


def _pairs(s, d):
    return S.sided_pairs(_sided(s, d), FRAME, 0.5)


QUERIES = {
    "voc_eval": (lambda s, d: _voc(s, d).withColumn("ap", F.round("ap", 9)), f"{_CELLS} SELECT class, threshold, n_true, round(ap, 9) AS ap FROM cells"),
    "voc_eval_11_point": (
        lambda s, d: _voc(s, d, True).withColumn("ap", F.round("ap", 9)),
        f"""{_MATCHED}, b AS (SELECT class, threshold, n_true, k, max(CASE WHEN tp * 10 >= k * n_true THEN tp::DOUBLE / n END) AS p FROM curve, (SELECT unnest(range(11)) AS k) GROUP BY ALL)
        SELECT class, threshold, n_true, round(sum(coalesce(p, 0)) / 11, 9) AS ap FROM b GROUP BY ALL""",
    ),
    "voc_map": (
        lambda s, d: V.mean_precisions(_voc(s, d)).select(F.round("map_50", 9).alias("map_50"), F.round("map_5095", 9).alias("map_5095")),
        f"{_CELLS}, means AS (SELECT threshold, avg(ap) AS ap FROM cells GROUP BY ALL) SELECT round(min_by(ap, threshold), 9) AS map_50, round(avg(ap), 9) AS map_5095 FROM means",
    ),
    "mot_ignored": (lambda s, d: E.mot_summary(_pairs(s, d), ["scan_id"], 0.5, overall=True), None),
    "identity_ignored": (lambda s, d: S.identity_summary(_pairs(s, d), ["scan_id"], 0.5, overall=True), None),
}
