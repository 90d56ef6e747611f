"""Scans of the field's files with fixed schemas: CSV with and without headers, logs, JSON, XML and text."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.scans import in_ranges, running_sums
from ..schemas import COCO, MOT, NAV


def csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, missing_ok: bool = False) -> DataFrame:
    """Typed rows of a CSV file or folder. Columns are found by name, unnamed index columns are left out; a missing path is an empty table if `missing_ok`."""
    try:
        if not header:
            return spark.read.schema(schema).csv(path)
        found = spark.read.option("header", True).csv(path)
    except AnalysisException:
        if missing_ok:
            return spark.createDataFrame([], schema)
        raise
    return found.select(*((F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})") if f.name in found.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))


def text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text, so that codes keep their zeros."""
    return csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def reconciled(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Old column names replaced by new ones where they occur."""
    return reduce(lambda df, kv: df.withColumnRenamed(*kv) if kv[0] in df.columns and kv[1] not in df.columns else df, names.items(), rows)


def nav(spark: SparkSession, path: str) -> DataFrame:
    """Positions (timestamp, latitude, longitude, plot) of a file with or without a header; times may lack a fraction, others are null."""
    rows = spark.read.schema(NAV).csv(path).where(F.lower("timestamp") != "timestamp")
    time = F.coalesce(F.expr("try_to_timestamp(timestamp, 'yyyy-MM-dd HH:mm:ss[.SSSSSS]')"), F.expr("try_to_timestamp(timestamp, 'yyyy-MM-dd HH:mm:ss[.SSS]')"))
    return rows.select(time.cast("timestamp_ntz").alias("timestamp"), F.expr("try_cast(latitude as double)").alias("latitude"), F.expr("try_cast(longitude as double)").alias("longitude"), F.coalesce("plot", F.lit("global")).alias("plot"))


def imu_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of eight fields over several lines, parted by blank lines."""
    fields = ["date", "timestamp", "angular_velocity_x", "angular_velocity_y", "angular_velocity_z", "linear_acceleration_x", "linear_acceleration_y", "linear_acceleration_z"]
    parts = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    rows = spark.read.option("lineSep", "\n\n").text(path).where(F.trim("value") != "")
    return rows.select(*(F.get(parts, F.lit(k)).cast("double" if k > 1 else "string").alias(n) for k, n in enumerate(fields)))


def dropped_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames named in log lines about drops, once each, less the number of drops before them."""
    lines = spark.read.text(path).where(F.col("value").contains("FRAME DROP"))
    frames = lines.select(F.expr("try_cast(element_at(split(trim(value), ' '), -1) as long)").alias("frame")).where("frame is not null").distinct()
    counted = running_sums(in_ranges(frames, [], ["frame"]), [], ["frame"], {"n": F.lit(1)})
    return counted.select((F.col("frame") - F.col("n") + 1).alias("frame"))


def json_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key long, value) of a JSON object whose keys are numbers in quotes; `value` is the type of its values. Single quotes are mended."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json(F.regexp_replace("value", "'", '"'), f"map<string,{value}>").alias("m"))
    return whole.select(F.explode("m").alias("key", "value")).withColumn("key", F.col("key").cast("long"))


def coco(spark: SparkSession, path: str) -> DataFrame:
    """Annotation documents, one a file."""
    return spark.read.schema(COCO).option("multiLine", True).json(path)


def mot(spark: SparkSession, path: str, labels: list[int] | None = None) -> DataFrame:
    """Headerless tracking rows; frames before 1 go, and so do labels that are not named."""
    rows = spark.read.schema(MOT).csv(path).where("frame >= 1")
    return rows.where(F.col("label").isin(labels)) if labels else rows


#: Labels of true boxes: one is counted, some are ignored.
COUNTED, IGNORED = [1], [2, 7, 8, 12]


def mot_truth(spark: SparkSession, path: str, ignored: bool = False) -> DataFrame:
    """True boxes: the marked ones (conf not 0) of a counted label, or else those of a label to be ignored, marked or not."""
    rows = mot(spark, path, IGNORED if ignored else COUNTED)
    return rows if ignored else rows.where("conf <> 0")


def voc_objects(spark: SparkSession, path: str) -> DataFrame:
    """(image, name, pose, truncated, difficult, x1, y1, x2, y2) of the objects in XML files, each of which may hold many documents.

    Files are cut at the ends of documents, so that large ones can be split. `image` is the name of the document's file without its ending (null where it
    has none). An object that is not closed or has no box of whole numbers is an error, as no object may be lost.
    """
    end, opened, closed = "</annotation>", r"<object[\s>]", r"(?s)<object[\s>].*?</object>"
    found = spark.read.option("lineSep", end).text(path)
    objects = F.regexp_extract_all("value", F.lit(closed), F.lit(0))
    whole = F.when(F.size(objects) == F.size(F.regexp_extract_all("value", F.lit(opened), F.lit(0))), objects).otherwise(F.raise_error(F.lit("an object is not closed")))
    image = F.regexp_extract("value", r"(?s)<filename>\s*(.*?)\s*</filename>", 1)
    box = "bndbox struct<xmin:int,ymin:int,xmax:int,ymax:int>"
    parsed = F.from_xml("one", f"name string, pose string, truncated int, difficult int, {box}", {"rowTag": "object", "mode": "FAILFAST"})
    rows = found.select(F.nullif(F.regexp_replace(image, r"\.[^.]*$", ""), F.lit("")).alias("image"), F.explode(whole).alias("one")).select("image", parsed.alias("o"))
    sides = {b: F.col(f"o.bndbox.{a}") for a, b in (("xmin", "x1"), ("ymin", "y1"), ("xmax", "x2"), ("ymax", "y2"))}
    known = {b: F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit("an object has no box"))).alias(b) for b, c in sides.items()}
    return rows.select("image", "o.name", "o.pose", "o.truncated", "o.difficult", *known.values())


def detection_text(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated (image, conf, x1, y1, x2, y2)."""
    return spark.read.schema("image string, conf double, x1 double, y1 double, x2 double, y2 double").option("sep", " ").csv(path)


def kml_plots(spark: SparkSession, path: str) -> DataFrame:
    """(plot, place, ring) of the placemarks with a polygon, numbered from 1 in order of file and place; coordinates are `lon,lat[,height]` parted by white space.

    A file is read whole, so that its order is kept; the numbering sorts plots, not points.
    """
    schema = "name string, Polygon struct<outerBoundaryIs:struct<LinearRing:struct<coordinates:string>>>"
    files = spark.read.text(path, wholetext=True).select("_metadata.file_path", F.regexp_extract_all("value", F.lit(r"(?s)<Placemark\b.*?</Placemark>"), F.lit(0)).alias("marks"))
    marks = files.select("file_path", F.posexplode("marks").alias("at", "mark")).select("file_path", "at", F.from_xml("mark", schema, {"rowTag": "Placemark"}).alias("m")).where("m.Polygon is not null")
    text = F.trim(F.regexp_replace("m.Polygon.outerBoundaryIs.LinearRing.coordinates", r"\s+", " "))
    ring = F.transform(F.split(text, " "), lambda p: F.struct(F.split(p, ",")[0].cast("double").alias("lon"), F.split(p, ",")[1].cast("double").alias("lat")))
    return marks.select(F.col("m.name").alias("plot"), F.row_number().over(Window.orderBy("file_path", "at")).alias("place"), ring.alias("ring"))


def scan_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, customer, plot, scan_date, row, folder_index, length) of the files below customer/plot/date/row_<n>/<index>/ that match a name pattern; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length")
    part = lambda k: F.element_at(F.split("path", "/"), k)
    return files.select("path", part(-6).alias("customer_code"), part(-5).alias("plot_code"), part(-4).alias("scan_date"), F.regexp_extract(part(-3), r"(\d+)", 1).alias("row"), part(-2).alias("folder_index"), "length")


def scan_catalogue(files: DataFrame, name_part: str, side: int | None = None) -> DataFrame:
    """The files whose name holds a text, of rows on one side of a plot (the row number's remainder by 2), or on both."""
    rows = files.where(F.element_at(F.split("path", "/"), -1).contains(name_part))
    return rows if side is None else rows.where(F.col("row").cast("int") % 2 == side)


def json_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state document, one a file."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("s")).select("s.*")


def only_file(files: DataFrame, name_part: str) -> str:
    """The path of the one file whose name holds a text; none or several are an error."""
    found = [r.path for r in files.where(F.element_at(F.split("path", "/"), -1).contains(name_part)).limit(2).collect()]
    if len(found) != 1:
        raise FileNotFoundError(f"{'no file' if not found else 'several files'} with {name_part}")
    return found[0]


def triples(column: str):
    """A text `(x, y, z)` as a struct of doubles."""
    parts = F.split(F.regexp_replace(column, r"[()\s]", ""), ",")
    return F.struct(*(F.get(parts, F.lit(k)).cast("double").alias(n) for k, n in enumerate("xyz")))
