"""Left-out models against a fit for each group in numpy."""

import numpy as np
import pytest

from fieldloom.operators import regression

ROWS = "kind string, row int, a double, b double, c double, y double"


@pytest.mark.parametrize(("intercept", "log"), [(False, False), (True, False), (True, True)])
def test_three_regressors_equal_a_fit_for_each_group(spark, intercept, log):
    """Groups of very different size, one that holds a third of the rows, a kind without a name, missing values, a kind with one group."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(600):
        a, b, c = rng.uniform(0, 2, 3)
        y = 3 * a - b + 0.5 * c + 5 + rng.normal(0, 0.2)
        rows.append((["p", None][k % 2], int(0 if k % 3 == 0 else rng.integers(1, 7)), a, b, c, y))
    rows += [("p", 1, None, 1.0, 1.0, 4.0), ("p", 2, float("nan"), 1.0, 1.0, 4.0), ("alone", 1, 1.0, 2.0, 3.0, 4.0)]
    df = spark.createDataFrame([tuple(None if v is None else v if isinstance(v, (str, int)) else float(v) for v in r) for r in rows], ROWS)
    got = {(r["kind"], r["row"]): r for r in regression.left_out_errors(df, ["kind"], "row", ["a", "b", "c"], "y", intercept, log).collect()}
    good = [r for r in rows if r[2] is not None and not np.isnan(r[2]) and r[0] != "alone"]
    assert got.keys() == {r[:2] for r in good}
    errors = {"p": [], None: []}
    for key, r in got.items():
        x = lambda own: np.array([([1.0] if intercept else []) + list(v[2:5]) for v in own])
        train, test = [v for v in good if v[0] == key[0] and v[1] != key[1]], [v for v in good if v[:2] == key]
        y = np.array([v[5] for v in train])
        k = np.linalg.lstsq(x(train), np.log1p(y) if log else y, rcond=None)[0]
        p = x(test) @ k
        p = np.expm1(p) if log else p
        true = np.array([v[5] for v in test])
        assert np.allclose(r.coefficients, k) and r.n == len(test)
        assert np.isclose(r.error, abs(p.sum() - true.sum()) / true.sum()) and np.isclose(r.row_error, np.mean(np.abs(p - true) / true))
        errors[key[0]].append(abs(p.sum() - true.sum()) / true.sum())
    spread = {r["kind"]: r for r in regression.error_spread(regression.left_out_errors(df, ["kind"], "row", ["a", "b", "c"], "y", intercept, log), ["kind"]).collect()}
    assert all(np.isclose(spread[k].mean_error, np.mean(v)) and np.isclose(spread[k].std_error, np.std(v)) for k, v in errors.items())


def test_left_out_edges(spark):
    df = spark.createDataFrame([("p", 1, 1.0, 0.0, 0.0, 0.0), ("p", 2, 1.0, 0.0, 0.0, -4.0)], ROWS)
    assert regression.left_out(df.limit(0), ["kind"], "row", ["a"], "y").count() == 0
    got = {r["row"]: (r.predicted, r.error, r.row_error) for r in regression.left_out_errors(df, ["kind"], "row", ["a"], "y", clipped=True).collect()}
    assert got == {1: (0.0, None, None), 2: (0.0, -1.0, -1.0)}
