"""Ordered analytics over one scan or track at a time: lags, fills, folds, islands, as-of and interval joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EARTH_M = 6_371_000.0


def ordered(by: list[str], *order):
    return Window.partitionBy(*by).orderBy(*order)


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Metres between two points in degrees."""
    a, b, c, d = (F.radians(x) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(h))


def from_origin(points: DataFrame, by: list[str], order: str) -> DataFrame:
    """`distance` of each point from its group's first."""
    w = ordered(by, order)
    return points.withColumn("distance", haversine(F.first("lat").over(w), F.first("lon").over(w), F.col("lat"), F.col("lon")))


def along_path(points: DataFrame, by: list[str], order: str) -> DataFrame:
    """`step` from the point before, and `travelled` so far."""
    w = ordered(by, order)
    step = F.coalesce(haversine(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")), F.lit(0.0))
    return points.withColumn("step", step).withColumn("travelled", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def headings(points: DataFrame, by: list[str], order: str) -> DataFrame:
    """`heading` in degrees, 0 to 360, from the point before; a point that stays holds the last one."""
    w = ordered(by, order)
    dy, dx = F.col("lat") - F.lag("lat").over(w), F.col("lon") - F.lag("lon").over(w)
    moved = F.when((dy != 0) | (dx != 0), F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0)))
    return points.withColumn("__h", moved).withColumn("heading", F.last("__h", True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__h")


def in_heading_range(heading: Column, low: float, high: float) -> Column:
    """Whether a heading lies from `low` on to `high`, which may wrap past 360."""
    return heading.between(low, high) if low <= high else (heading >= low) | (heading <= high)


def smoothed(rows: DataFrame, by: list[str], order: str, value: str, alpha: float, seed: float) -> DataFrame:
    """The exponential average after each group's last row: a fold over its values in order, as an expression."""
    values = F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])
    return rows.groupBy(*by).agg(F.aggregate(values, F.lit(float(seed)), lambda s, x: F.lit(alpha) * x + F.lit(1 - alpha) * s).alias("ema"))


def smoothed_rows(rows: DataFrame, by: list[str], order: str, value: str, alpha: float, seed: float) -> DataFrame:
    """`smooth`, the exponential average after each row: a fold over a group's values in order, whose steps are gathered; a group is one recording."""
    ordered_rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).cast("double").alias("v"))))
    start = F.struct(F.lit(float(seed)).alias("s"), F.expr("cast(array() as array<double>)").alias("out"))

    def step(state: Column, x: Column) -> Column:
        now = F.lit(alpha) * x["v"] + F.lit(1 - alpha) * state["s"]
        return F.struct(now.alias("s"), F.concat(state["out"], F.array(now)).alias("out"))

    folded = rows.groupBy(*by).agg(ordered_rows.alias("__r")).select(*by, F.expr("__r.o").alias("__o"), F.aggregate("__r", start, step)["out"].alias("__s"))
    return folded.select(*by, F.explode(F.arrays_zip("__o", "__s")).alias("z")).select(*by, F.col("z.__o").alias(order), F.col("z.__s").alias("smooth"))


def between(rows: DataFrame, time: str, first: str, last: str) -> DataFrame:
    """Rows from one time to another, both included."""
    return rows.where(F.col(time).between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))


def transitions(rows: DataFrame, by: list[str], order: str, state: str) -> DataFrame:
    """Rows at which the state differs from the one before, with that one; the first row of a group is a change from null."""
    before = F.lag(state).over(ordered(by, order))
    return rows.withColumn("before", before).where(~F.col(state).eqNullSafe(F.col("before")))


def islands(rows: DataFrame, by: list[str], order: str, state: str) -> DataFrame:
    """`island`: the number of the run of equal states that a row lies in, from 1."""
    w = ordered(by, order)
    changed = (~F.col(state).eqNullSafe(F.lag(state).over(w)) | (F.row_number().over(w) == 1)).cast("long")
    return rows.withColumn("__c", changed).withColumn("island", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")


def filled_back(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Nulls take the next value that is there."""
    backwards = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return rows.withColumn(value, F.last(value, True).over(backwards.rowsBetween(Window.unboundedPreceding, 0)))


def moving_average(rows: DataFrame, by: list[str], order: str, value: str, size: int = 10) -> DataFrame:
    """A centred sum of `size` values over `size`; beyond the ends, values count as zero."""
    return rows.withColumn("average", F.sum(value).over(ordered(by, order).rowsBetween(-(size // 2), size - size // 2 - 1)) / size)


def every_nth_difference(rows: DataFrame, by: list[str], order: str, value: str, n: int = 5) -> DataFrame:
    """Differences between running sums at every n-th row."""
    w = ordered(by, order)
    summed = rows.select(*by, order, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"), (F.row_number().over(w) - 1).alias("at"))
    return summed.where(F.col("at") % n == 0).select(*by, order, "total", (F.col("total") - F.lag("total").over(w)).alias("gain"))


def split_ids(rows: DataFrame, by: list[str], order: str, distance: str, every: float, margin: float) -> DataFrame:
    """`slice_id`: counts points whose distance is within `margin` above a multiple of `every`, only the first of adjacent ones."""
    w = ordered(by, order)
    rows = rows.withColumn("__at", F.col(distance) % every < margin)
    first = (F.col("__at") & ~F.coalesce(F.lag("__at").over(w), F.lit(False))).cast("long")
    return rows.withColumn("__f", first).withColumn("slice_id", F.sum("__f").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__at", "__f")


def interpolated(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Values between two changes lie on a straight line by row; after the last change they stay flat."""
    w = ordered(by, order)
    rows = rows.withColumn("__n", F.row_number().over(w).cast("double"))
    changed = F.lag(value).over(w).isNull() | (F.col(value) != F.lag(value).over(w))
    mark = F.when(changed, F.struct(F.col("__n").alias("n"), F.col(value).alias("v")))
    rows = rows.withColumn("__m", mark)
    rows = rows.withColumn("__a", F.last("__m", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    backwards = Window.partitionBy(*by).orderBy(F.col("__n").desc())
    rows = rows.withColumn("__b", F.last("__m", True).over(backwards.rowsBetween(Window.unboundedPreceding, -1)))
    line = F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * (F.col("__n") - F.col("__a.n")) / (F.col("__b.n") - F.col("__a.n"))
    return rows.withColumn("smooth", F.coalesce(line, F.col("__a.v"))).drop("__n", "__m", "__a", "__b")


def path_length(points: DataFrame, by: list[str], order: str) -> DataFrame:
    """Distance from a group's first to its last point."""
    ends = points.groupBy(*by).agg(F.min_by(F.struct("lat", "lon"), order).alias("a"), F.max_by(F.struct("lat", "lon"), order).alias("b"))
    return ends.select(*by, haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")).alias("length"))


def change_points(rows: DataFrame, by: list[str], order: str, value: str, step: int = 1) -> DataFrame:
    """Rows after which the value grows by exactly `step`."""
    return rows.withColumn("__n", F.lead(value).over(ordered(by, order))).where(F.col("__n") - F.col(value) == step).drop("__n")


def zipped(left: DataFrame, right: DataFrame, by: list[str], left_order: str, right_order: str) -> DataFrame:
    """The k-th row of one side beside the k-th of the other, up to the shorter."""
    a = left.withColumn("place", F.row_number().over(ordered(by, left_order)))
    b = right.withColumn("place", F.row_number().over(ordered(by, right_order)))
    return a.join(b, [*by, "place"])


def asof(left: DataFrame, right: DataFrame, by: list[str], time: str, value: str, direction: str = "backward", tolerance_us: int | None = None, tie: str = "earlier", strict: bool = False) -> DataFrame:
    """`left` with `<value>` and `<time>` of the right row that is nearest in time, within a tolerance that counts as inside.

    Both sides are stacked and each left row looks back and ahead in a window over its key, so that there is one shuffle
    and no pairing. Equal times match unless `strict`. A key's rows are streamed in order of time.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    sides = left.select(*by, time, micros.alias("__t"), F.lit(1).alias("__left"), F.struct(*(c for c in left.columns if c not in (*by, time))).alias("__row"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    others = right.select(*by, time, micros.alias("__t"), F.lit(0).alias("__left"), F.lit(None).cast(sides.schema["__row"].dataType).alias("__row"), F.col(value).alias("__v"))
    both = sides.unionByName(others).withColumn("__m", F.when(F.col("__left") == 0, F.struct(F.col("__t").alias("t"), F.col("__v").alias("v"))))
    # Right rows of the same time come before the left row in both directions; if strict, after it. Looking ahead reads the rows from their end, as
    # a frame that shrinks would be read anew for each row.
    side = F.col("__left").desc() if strict else F.col("__left").asc()
    back = Window.partitionBy(*by).orderBy("__t", side).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by).orderBy(F.col("__t").desc(), side).rowsBetween(Window.unboundedPreceding, 0)
    found = both.select("*", F.last("__m", True).over(back).alias("__b"), F.last("__m", True).over(ahead).alias("__a")).where("__left = 1")
    gap_b, gap_a = F.col("__t") - F.col("__b.t"), F.col("__a.t") - F.col("__t")
    backward = gap_a.isNull() | (gap_b <= gap_a if tie == "earlier" else gap_b < gap_a)
    chosen = {"backward": F.col("__b"), "forward": F.col("__a"), "nearest": F.when(gap_b.isNotNull() & backward, F.col("__b")).otherwise(F.col("__a"))}[direction]
    found = found.withColumn("__c", chosen)
    if tolerance_us is not None:
        found = found.withColumn("__c", F.when(F.abs(F.col("__c.t") - F.col("__t")) <= tolerance_us, F.col("__c")))
    return found.select(*by, time, "__row.*", F.col("__c.v").alias(value), F.timestamp_micros("__c.t").cast("timestamp_ntz").alias(f"{value}_{time}"))


def inside_intervals(rows: DataFrame, intervals: DataFrame, by: list[str], time: str, bucket_s: int = 3600) -> DataFrame:
    """`inside`: whether a row's time lies in any (start, end) of its key, ends included. Intervals are cut into buckets, so that the join has an equality."""
    size = bucket_s * 1_000_000
    spread = intervals.select(*(F.col(c).alias(f"__{c}") for c in by), "start", "end", F.explode(F.sequence(F.floor(_micros("start") / size), F.floor(_micros("end") / size))).alias("__bucket"))
    keyed = rows.select(*by, time).distinct().withColumn("__at", F.floor(_micros(time) / size))
    same = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"__{c}") for c in by), F.col("__at") == F.col("__bucket"))
    hits = keyed.join(spread, same & F.col(time).between(F.col("start"), F.col("end")), "left_semi").select(*(F.col(c).alias(f"__hit_{c}") for c in by), F.col(time).alias("__time"))
    found = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"__hit_{c}") for c in by), F.col(time) == F.col("__time"))
    marked = rows.join(hits, found, "left")
    return marked.select(*rows.columns, F.col("__time").isNotNull().alias("inside"))


def along_sessions(rows: DataFrame, by: list[str], time: str, gap_s: int) -> DataFrame:
    """`session`: counts the gaps of over `gap_s` seconds before a row."""
    w = ordered(by, time)
    rows = rows.withColumn("__g", F.coalesce(((_micros(time) - F.lag(_micros(time)).over(w)) > gap_s * 1_000_000).cast("long"), F.lit(0)))
    return rows.withColumn("session", F.sum("__g").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__g")


def count_windows(rows: DataFrame, by: list[str], order: str, size: int) -> DataFrame:
    """`window`: every `size` rows of a key share one, from 0."""
    return rows.withColumn("__n", F.row_number().over(ordered(by, order)) - 1).withColumn("window", F.expr(f"cast(__n div {size} as bigint)")).drop("__n")


def lag_seconds(rows: DataFrame, by: list[str], time: str) -> DataFrame:
    """`gap`: seconds since the row before."""
    return rows.withColumn("gap", (_micros(time) - F.lag(_micros(time)).over(ordered(by, time))) / 1_000_000)


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))
