"""Sources and sinks: tables written in each format below the shared folder, read back and compared with the tables they came from."""

from pyspark.sql import functions as F

from .. import schemas as S
from ..sources import readers as R
from ..sources import writers as W
from ..shared import shared_folder
from .tables import WITH_BOXES, WITH_TRACKS, boxes, events, plots, points, read, tracks

_TRACK = S.make("scan_id long, frame long, track_id long, pos long, x1 long, x2 long, depth double")
_CODES = ["code", "name"]


def _folder(spark):
    return shared_folder(spark, "files")


def _tracks_csv(s, d):
    path = _folder(s)
    W.csv_overwrite(tracks(s, d).select(*_TRACK.fieldNames()), path)
    return R.csv(s, path, _TRACK)


def _text_csv(s, d):
    path = _folder(s)
    W.csv_overwrite(read(s, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"), F.col("c_name").alias("name")), path)
    return R.text_csv(s, path, _CODES)


def _headless_csv(s, d):
    path, shape = _folder(s), S.make("event_id long, user_id long, value double")
    events(s, d).select("event_id", "user_id", "value").write.csv(path)
    return R.csv(s, path, shape, header=False).withColumn("value", F.round("value", 6))


def _appended_csv(s, d):
    path = _folder(s)
    nothing = R.csv(s, path, _TRACK, missing_ok=True)
    both = tracks(s, d).select(*_TRACK.fieldNames())
    for part in (0, 1):
        W.csv_append(both.where(F.col("scan_id") % 2 == part), path)
    return R.csv(s, path, _TRACK).unionByName(nothing)


def _nav(s, d):
    """Fixes with and without a header, with and without a fraction of a second, and one that is no time."""
    path = _folder(s)
    rows = events(s, d).where("event_type = 'view'")
    time = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(F.lit("soon"))
    lines = rows.select(F.concat_ws(",", time, F.col("user_id"), F.col("event_id"), F.when(F.col("event_id") % 4 > 0, F.concat(F.lit("plot"), F.col("event_id") % 4)).otherwise(F.lit(""))).alias("value"))
    lines.unionByName(s.createDataFrame([("timestamp,latitude,longitude,plot",)], "value string")).write.text(path)
    return R.nav(s, path).select(F.col("timestamp").alias("ts"), F.col("latitude").cast("long").alias("user_id"), F.col("longitude").cast("long").alias("event_id"), "plot")


def _imu(s, d):
    path = _folder(s)
    value = lambda k: F.round(F.col("value") + k, 2).cast("string")
    record = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("\n"), F.concat_ws("  ", *(value(k) for k in range(3))), F.lit("\n"), F.concat_ws("\t", *(value(k) for k in range(3, 6))), F.lit("\n"))
    events(s, d).select(record.alias("value")).write.text(path)
    return R.imu_log(s, path)


def _drops(s, d):
    path = _folder(s)
    line = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("WARN FRAME DROP at "), F.expr("event_id div 2"))).otherwise(F.concat(F.lit("INFO frame "), F.col("event_id")))
    events(s, d).select(line.alias("value")).write.text(path)
    return R.dropped_frames(s, path)


def _json_map(s, d):
    path = _folder(s)
    pairs = F.sort_array(F.collect_list(F.concat(F.lit("'"), F.col("n_nationkey"), F.lit("': "), F.col("n_regionkey"))))
    read(s, d, "nation").agg(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")).alias("value")).coalesce(1).write.text(path)
    return R.json_map(s, path, "bigint")


def _coco(s, d):
    path = _folder(s)
    rows = boxes(s, d)
    images = rows.select("scan_id", F.col("frame").alias("id"), F.concat_ws("_", F.lit("f"), "frame").alias("file_name"), F.lit(2048).alias("height"), F.lit(1536).alias("width")).distinct()
    notes = rows.select("scan_id", F.col("pos").alias("id"), F.col("frame").alias("image_id"), F.col("class").alias("category_id"), F.array(*(F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2"))).alias("bbox"))
    kinds = s.createDataFrame([(k, f"class_{k}", "none") for k in range(3)], "id long, name string, supercategory string")
    W.annotation_document(images, notes, kinds, "scan_id", path)
    found = R.coco(s, f"{path}/scan_id=*")
    return found.selectExpr("inline(annotations)").select("id", "image_id", "category_id", *(F.element_at("bbox", k).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"), 1)))


def _mot(s, d):
    path = _folder(s)
    rows = boxes(s, d).select(F.col("scan_id").alias("frame"), F.when(F.col("class") == 2, -1).otherwise(F.col("track_id")).alias("track_id"), F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), "score")
    W.mot_text(rows, path)
    return R.mot(s, path).select("frame", "id", "x", "y", "w", "h")


def _mot_labels(s, d):
    """True boxes with labels: those to be counted, and those to be ignored."""
    path = _folder(s)
    boxes(s, d).select(F.col("frame"), F.col("track_id"), "x1", "y1", (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), F.col("class").alias("marked"), F.col("track_id") % 13, F.lit(1.0)).write.csv(path)
    real, ignored = R.mot_truth(s, path), R.mot_truth(s, path, ignored=True)
    count = lambda df, kind: df.groupBy("label").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
    return count(real, "counted").unionByName(count(ignored, "ignored"))


def _voc(s, d):
    """A document for each frame, many to a file."""
    path = _folder(s)
    objects = boxes(s, d).select("scan_id", "frame", F.concat(F.lit("c"), F.col("class")).alias("name"), F.lit("Unspecified").alias("pose"), (F.col("class") % 2).alias("truncated"), (F.col("pos") % 2).alias("difficult"), "x1", "y1", "x2", "y2")
    W.voc_documents(objects, ["scan_id", "frame"], path)
    return R.voc_objects(s, path)


def _voc_text(s, d):
    path = _folder(s)
    W.voc_text(boxes(s, d).select(F.concat(F.lit("i"), F.col("pos")).alias("image"), "class", "score", "x1", "y1", "x2", "y2"), path)
    return R.detection_text(s, f"{path}/class=*").groupBy("image").agg(F.max("conf").alias("conf"), F.max("x1").alias("x1"), F.max("y2").alias("y2"))


def _kml(s, d):
    """Placemarks of many files, in order of file and place."""
    path = _folder(s)
    rings = F.array_join(F.transform("ring", lambda p: F.concat_ws(",", p["lon"], p["lat"], F.lit("0"))), " ")
    mark = F.concat(F.lit("<Placemark><name>"), F.col("plot"), F.lit("</name><Polygon><outerBoundaryIs><LinearRing><coordinates>\n"), rings, F.lit("\n</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"))
    many = plots(s).join(read(s, d, "nation").select("n_nationkey")).withColumn("plot", F.concat_ws("_", F.lpad("n_nationkey", 2, "0"), "plot"))
    files = many.groupBy("n_nationkey").agg(F.concat(F.lit("<kml><Document>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", mark.alias("m")))), lambda x: x["m"]), "\n"), F.lit("</Document></kml>")).alias("value"), F.lpad("n_nationkey", 2, "0").alias("file"))
    files.select("file", "value").write.partitionBy("file").text(path)
    return R.kml_plots(s, f"{path}/file=*").select("plot", "place", F.size("ring").alias("corners"), F.round(F.element_at("ring", 1)["lat"], 4).alias("lat"))


def _scan_tree(s, d):
    root = _folder(s)
    rows = s.createDataFrame([("a\nb",)], "value string").coalesce(1)
    for customer, plot, row, index in [("c1", "p1", 1, 1), ("c1", "p1", 12, 2), ("c2", "p9", 3, 1)]:
        rows.write.text(f"{root}/{customer}/{plot}/010124/row_{row}/{index}")
    files = R.scan_files(s, root, "part-*")
    catalogue = R.scan_catalogue(files, "part-", side=1)
    return files.join(catalogue.select("path", F.lit(True).alias("chosen")), "path", "left").select("customer_code", "plot_code", "scan_date", F.col("row").cast("int").alias("row"), F.col("folder_index").cast("int").alias("folder_index"), F.coalesce("chosen", F.lit(False)).alias("chosen"))


def _tables(s, d):
    path = _folder(s)
    W.parquet_tables({"tracks": tracks(s, d), "points": points(s, d)}, path)
    W.state_json({"frame": 7, "lost": [1, 2]}, s, f"{path}/state")
    state = R.json_state(s, f"{path}/state", "frame bigint, lost array<bigint>")
    t, p = s.read.parquet(f"{path}/tracks"), s.read.parquet(f"{path}/points")
    return t.agg(F.count("*").alias("n_tracks"), F.sum("pos").alias("total")).join(p.agg(F.count("*").alias("n_points"))).join(state.select("frame", F.size("lost").alias("lost")))


def _typed_dump(s, d):
    path = _folder(s)
    W.typed_dump(tracks(s, d).withColumn("extra", F.lit(1)), S.make("pos long, x1 int, depth double, tx double"), path)
    return R.csv(s, path, S.make("pos long, x1 int, depth double, tx double"))


def _json_lines(s, d):
    path = _folder(s)
    W.json_lines(events(s, d).select("event_id", "user_id", "event_type"), path)
    return s.read.schema("event_id long, user_id long, event_type string").json(path)


def _upserts(s, d):
    old = read(s, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("old").alias("v"))
    new = read(s, d, "customer").where("c_custkey % 3 = 0").select((F.col("c_custkey") * 2).alias("k"), F.lit("new").alias("v"))
    return W.upserted(old, new, ["k"])


def _ledger_file(s, d):
    path, shape = _folder(s), S.make("o_custkey long, o_orderstatus string")
    rows = read(s, d, "orders").select("o_custkey", "o_orderstatus")
    first = W.append_ledger(s, path, rows.where("o_orderkey % 2 = 0"), shape)
    second = W.append_ledger(s, path, rows, shape)
    del first, second
    return R.csv(s, path, shape).select("o_custkey", "o_orderstatus")


def _segments(s, d):
    line = events(s, d).select("user_id", "event_id", F.col("event_id").cast("double").alias("lat"), F.col("value").alias("lon"), (F.col("event_id") % 3 > 0).alias("state"))
    return W.path_segments(line, ["user_id"], "event_id", "state").select("user_id", "event_id", "state", "to_lat")


def _uploads(s, d):
    sizes = read(s, d, "orders").select("o_custkey", (F.col("o_orderkey") % 1000).alias("length"))
    plan = W.upload_plan(sizes, ["o_custkey"], 100.0, 50.0)
    return W.upload_statuses(sizes.select("o_custkey").distinct(), plan, ["o_custkey"])


def _csv_coco(s, d):
    path = _folder(s)
    W.csv_overwrite(boxes(s, d).select("scan_id", "frame", "pos", "x1", "y1", "x2", "y2", "class"), path)
    rows = R.csv(s, path, S.make("scan_id long, frame long, pos long, x1 double, y1 double, x2 double, y2 double, class long"))
    return W.coco_of_csv(rows, ["scan_id"]).select("scan_id", F.size("images").alias("images"), F.size("annotations").alias("annotations"), F.round(F.aggregate(F.transform("annotations", lambda a: a["area"]), F.lit(0.0), lambda x, y: x + y), 2).alias("area"))


QUERIES = {
    "csv_round_trip": (_tracks_csv, f"{WITH_TRACKS} SELECT scan_id, frame, track_id, pos, x1, x2, depth FROM tracks"),
    "csv_text_codes": (_text_csv, "SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, c_name AS name FROM customer"),
    "csv_without_header": (_headless_csv, "SELECT event_id, user_id, round(value, 6) AS value FROM events"),
    "csv_append": (_appended_csv, f"{WITH_TRACKS} SELECT scan_id, frame, track_id, pos, x1, x2, depth FROM tracks"),
    "nav_files": (
        _nav,
        "SELECT CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts END AS ts, user_id, event_id, CASE WHEN event_id % 4 > 0 THEN 'plot' || (event_id % 4) ELSE 'global' END AS plot FROM events WHERE event_type = 'view'",
    ),
    "imu_log": (
        _imu,
        f"""SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS timestamp,
        {", ".join(f"round(value + {k}, 2) AS {kind}_{axis}" for k, (kind, axis) in enumerate((kind, axis) for kind in ("angular_velocity", "linear_acceleration") for axis in "xyz"))} FROM events""",
    ),
    "frame_drops": (_drops, "SELECT f - row_number() OVER (ORDER BY f) + 1 AS frame FROM (SELECT DISTINCT event_id // 2 AS f FROM events WHERE event_id % 7 = 0)"),
    "json_int_map": (_json_map, "SELECT CAST(n_nationkey AS BIGINT) AS key, CAST(n_regionkey AS BIGINT) AS value FROM nation"),
    "coco_files": (_coco, f"{WITH_BOXES} SELECT pos AS id, frame AS image_id, class AS category_id, x1::DOUBLE AS x1, y1::DOUBLE AS y1, x2::DOUBLE AS x2, y2::DOUBLE AS y2 FROM boxes"),
    "mot_files": (_mot, f"{WITH_BOXES} SELECT CAST(scan_id AS INTEGER) AS frame, CAST(track_id AS INTEGER) AS id, x1::DOUBLE AS x, y1::DOUBLE AS y, (x2 - x1)::DOUBLE AS w, (y2 - y1)::DOUBLE AS h FROM boxes WHERE class <> 2 AND scan_id >= 1"),
    "mot_truth_files": (
        _mot_labels,
        f"""{WITH_BOXES}, q AS (SELECT CAST(track_id % 13 AS INTEGER) AS label, class AS marked FROM boxes WHERE frame >= 1)
        SELECT label, count(*) AS n, 'counted' AS kind FROM q WHERE marked <> 0 AND label = 1 GROUP BY ALL UNION ALL SELECT label, count(*), 'ignored' FROM q WHERE label IN (2, 7, 8, 12) GROUP BY ALL""",
    ),
    "voc_files": (
        _voc,
        f"""{WITH_BOXES} SELECT scan_id || '_' || frame AS image, 'c' || class AS name, 'Unspecified' AS pose, CAST(class % 2 AS INTEGER) AS truncated, CAST(pos % 2 AS INTEGER) AS difficult,
        CAST(x1 AS INTEGER) AS x1, CAST(y1 AS INTEGER) AS y1, CAST(x2 AS INTEGER) AS x2, CAST(y2 AS INTEGER) AS y2 FROM boxes""",
    ),
    "voc_result_files": (_voc_text, f"{WITH_BOXES} SELECT 'i' || pos AS image, round(score, 3) AS conf, x1 + 1.0::DOUBLE AS x1, y2 + 1.0::DOUBLE AS y2 FROM boxes"),
    "kml_files": (
        _kml,
        """WITH p(plot, place, corners, lat) AS (VALUES ('north', 1, 4, 32.005), ('inner', 2, 4, 32.002), ('south', 3, 4, 32.0))
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '_' || plot AS plot, CAST(row_number() OVER (ORDER BY n_nationkey, place) AS INTEGER) AS place, corners, CAST(lat AS DOUBLE) AS lat FROM nation, p""",
    ),
    "scan_tree": (_scan_tree, "SELECT * FROM (VALUES ('c1', 'p1', '010124', 1, 1, true), ('c1', 'p1', '010124', 12, 2, false), ('c2', 'p9', '010124', 3, 1, true)) t(customer_code, plot_code, scan_date, row, folder_index, chosen)"),
    "result_tables": (_tables, f"{WITH_TRACKS} SELECT (SELECT count(*) FROM tracks) AS n_tracks, (SELECT CAST(sum(pos) AS BIGINT) FROM tracks) AS total, (SELECT count(*) FROM customer) AS n_points, CAST(7 AS BIGINT) AS frame, 2 AS lost"),
    "typed_dump": (_typed_dump, f"{WITH_TRACKS} SELECT pos, CAST(x1 AS INTEGER) AS x1, depth, CAST(NULL AS DOUBLE) AS tx FROM tracks"),
    "json_lines": (_json_lines, "SELECT event_id, user_id, event_type FROM events"),
    "upserted_log": (
        _upserts,
        "WITH n AS (SELECT c_custkey * 2 AS k FROM customer WHERE c_custkey % 3 = 0) SELECT k, 'new' AS v FROM n UNION ALL SELECT c_custkey, 'old' FROM customer WHERE c_custkey NOT IN (SELECT k FROM n)",
    ),
    "ledger_files": (_ledger_file, "SELECT DISTINCT o_custkey, o_orderstatus FROM orders"),
    "path_segments": (
        _segments,
        "SELECT user_id, event_id, state, to_lat FROM (SELECT user_id, event_id, event_id % 3 > 0 AS state, lead(event_id) OVER w::DOUBLE AS to_lat, lead(event_id % 3 > 0) OVER w AS nx FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE state = nx AND to_lat IS NOT NULL",
    ),
    "upload_statuses": (_uploads, "SELECT o_custkey, CASE WHEN sum(o_orderkey % 1000) < 5000 THEN 'success' ELSE 'waiting' END AS status FROM orders GROUP BY ALL"),
    "csv_to_coco": (_csv_coco, f"{WITH_BOXES} SELECT scan_id, CAST(count(DISTINCT frame) AS INTEGER) AS images, CAST(count(*) AS INTEGER) AS annotations, round(sum((x2 - x1) * (y2 - y1)), 2)::DOUBLE AS area FROM boxes GROUP BY ALL"),
}
