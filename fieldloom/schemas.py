"""Fixed schemas of the sources; nothing is inferred from files."""

from pyspark.sql import types as T


def make(text: str) -> T.StructType:
    """`name kind, ...` as a schema."""
    out = T.StructType()
    for part in text.split(","):
        name, kind = part.strip().split(" ", 1)
        out.add(name, T._parse_datatype_string(kind) if "<" in kind else {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "ts": T.TimestampNTZType()}[kind])
    return out


SCAN_KEY = ["customer_code", "plot_code", "scan_date", "row", "folder_index"]
DETECTIONS = make("x1 int, y1 int, x2 int, y2 int, obj_conf double, class_conf double, class_pred double, frame_id int")
TRACKS = make("x1 int, y1 int, x2 int, y2 int, score double, class double, track_id long, frame_id int, depth double")
ALIGNMENT = make("x1 double, y1 double, x2 double, y2 double, tx int, ty int, frame int, zed_shift int")
TRANSLATION = make("tx double, ty double, frame int")
SLICES = make("frame_id int, tree_id int, start int, end int")
NAV = make("timestamp string, latitude string, longitude string, plot string")
COLLECTED = make("customer_code string, plot_code string, scan_date string, row string, folder_index string, ext string")
UPLOADED = make("customer_code string, plot_code string, scan_date string, row string, folder_index string, status string")
MOT = make("frame int, id int, x double, y double, w double, h double, conf double, label int, vis double")
COCO = T.StructType(
    [
        T.StructField("images", T.ArrayType(make("id long, file_name string, height int, width int"))),
        T.StructField("annotations", T.ArrayType(T.StructType([*make("id long, image_id long, category_id long, area double, iscrowd int, score double, track_id long").fields, T.StructField("bbox", T.ArrayType(T.DoubleType()))]))),
        T.StructField("categories", T.ArrayType(make("id long, name string, supercategory string"))),
    ]
)
