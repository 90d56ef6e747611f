"""Leave-one-group-out regression: every group's model comes from the whole sums less the group's own block, and all are solved in one pass."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import written


def _equations(rows: DataFrame, by: list[str], terms: list[Column], target: Column) -> DataFrame:
    """(by, sums) of the products of the terms with each other, row by row, then with the target."""
    n = len(terms)
    products = [terms[i] * terms[j] for i in range(n) for j in range(n)] + [t * target for t in terms]
    return rows.groupBy(*by).agg(F.array(*(F.sum(p) for p in products)).alias("sums"))


def _solved(n: int, by: list[str]):
    def run(parts):
        for pdf in parts:
            out = []
            for sums in pdf["sums"]:
                sums = np.asarray(sums, float)
                out.append(np.linalg.lstsq(sums[: n * n].reshape(n, n), sums[n * n :], rcond=None)[0].tolist())
            yield pdf[by].assign(coefficients=out)

    return run


def left_out(rows: DataFrame, kind: list[str], group: str, xs: list[str], y: str, intercept: bool = False, log_target: bool = False) -> DataFrame:
    """(kind, group, coefficients): least squares over all rows of the kind but the group's; the intercept comes first. Without any `xs` and with an intercept it is the mean.

    Rows with a null or NaN in a column of the model are left out. `log_target` fits log(1 + y). A kind with one group has no model. Sums are
    formed where the rows are; a group's equations are the kind's sums less its own, so that rows are read once, however many groups there are.
    """
    whole = F.lit(True)
    for c in (*xs, y):
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    terms = ([F.lit(1.0)] if intercept else []) + [F.col(x).cast("double") for x in xs]
    target = F.log1p(F.col(y).cast("double")) if log_target else F.col(y).cast("double")
    n, by = len(terms), [*kind, group]
    own = written(_equations(rows.where(whole), by, terms, target), "equations")
    size = n * n + n
    totals = own.groupBy(*kind).agg(F.count("*").alias("groups"), F.array(*(F.sum(F.get("sums", F.lit(k))) for k in range(size))).alias("all"))
    names = {k: f"__{k}" for k in kind}
    totals = totals.select(*(F.col(k).alias(v) for k, v in names.items()), "groups", "all").where("groups > 1")
    same = F.lit(True)
    for k, v in names.items():
        same = same & F.col(k).eqNullSafe(F.col(v))
    less = own.join(totals, same).select(*by, F.zip_with("all", "sums", lambda a, b: a - b).alias("sums"))
    kinds = dict(rows.dtypes)
    return less.mapInPandas(_solved(n, by), ", ".join(f"{c} {kinds[c]}" for c in by) + ", coefficients array<double>")


def left_out_errors(rows: DataFrame, kind: list[str], group: str, xs: list[str], y: str, intercept: bool = False, log_target: bool = False, clipped: bool = False) -> DataFrame:
    """(kind, group, coefficients, n, true, predicted, error, row_error): the group's totals as its left-out model predicts them, the relative error of the total,
    and the mean relative error of its rows (whose true value is not 0). `clipped` lets no prediction fall below 0.
    """
    models = left_out(rows, kind, group, xs, y, intercept, log_target)
    by = [*kind, group]
    names = {c: f"__{c}" for c in by}
    models = models.select(*(F.col(c).alias(v) for c, v in names.items()), "coefficients")
    same = F.lit(True)
    for c, v in names.items():
        same = same & F.col(c).eqNullSafe(F.col(v))
    terms = ([F.lit(1.0)] if intercept else []) + [F.col(x).cast("double") for x in xs]
    value = F.lit(0.0)
    for k, t in enumerate(terms):
        value = value + F.get("coefficients", F.lit(k)) * t
    value = F.expm1(value) if log_target else value
    value = F.greatest(value, F.lit(0.0)) if clipped else value
    told = rows.join(models, same).withColumn("__p", F.when(~F.isnan(value), value)).where(F.col("__p").isNotNull() & F.col(y).isNotNull())
    true, told_sum = F.sum(F.col(y).cast("double")), F.sum("__p")
    out = told.groupBy(*by).agg(
        F.first("coefficients").alias("coefficients"), F.count("*").alias("n"), true.alias("true"), told_sum.alias("predicted"), F.avg(F.try_divide(F.abs(F.col("__p") - F.col(y)), F.col(y).cast("double"))).alias("row_error")
    )
    return out.withColumn("error", F.try_divide(F.abs(F.col("predicted") - F.col("true")), F.col("true"))).select(*by, "coefficients", "n", "true", "predicted", "error", "row_error")


def error_spread(errors: DataFrame, kind: list[str]) -> DataFrame:
    """(kind, mean_error, std_error, mean_row_error, std_row_error) over the groups; deviations of the population."""
    return errors.groupBy(*kind).agg(F.avg("error").alias("mean_error"), F.stddev_pop("error").alias("std_error"), F.avg("row_error").alias("mean_row_error"), F.stddev_pop("row_error").alias("std_row_error"))
