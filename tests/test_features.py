"""Feature scores against plain numpy on the same rows."""

import math

import numpy as np
import pandas as pd
import pytest

from quantloom.operators import features as X


def plain_scores(x, y, bins):
    rx, ry, n = pd.Series(x).rank().to_numpy(), pd.Series(y).rank().to_numpy(), len(x)
    rho = np.corrcoef(rx, ry)[0, 1] if len(set(x)) > 1 and len(set(y)) > 1 else None
    bx, by = (((2 * r - 1) * bins // (2 * n)).astype(int) for r in (rx, ry))
    mi = 0.0
    for a in set(bx):
        for b in set(by):
            p = np.mean((bx == a) & (by == b))
            if p:
                mi += p * math.log(p / (np.mean(bx == a) * np.mean(by == b)))
    return rho, mi


def data(n=700):
    rng = np.random.default_rng(4)
    a = rng.normal(size=n)
    f = pd.DataFrame({"a_1": a, "a_2": (a + rng.normal(size=n)).round(1), "b_1": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)), "b_2": 7.0, "y": (3 * a**2 + 2 * a + rng.normal(size=n)).round(1)})
    f.loc[0, "a_1"] = 1e12  # an outlier
    f.loc[5, "a_2"], f.loc[6, "a_2"], f.loc[7, "b_1"], f.loc[8, "y"] = np.inf, np.nan, -0.0, np.nan
    return f


FAMILIES = {"a_": ["a_1", "a_2"], "b_": ["b_1", "b_2"]}


def kept(f, own):
    return f[np.isfinite(f[[*own, "y"]].astype(float)).all(axis=1)]


@pytest.mark.parametrize("bands", [2, 7, 256])
def test_ranks_and_information(spark, bands):
    f = data()
    got = {(r.family, r.feature): r for r in X.rank_scores(spark.createDataFrame(f).repartition(3), FAMILIES, "y", 8, bands).collect()}
    assert len(got) == 4
    for family, own in FAMILIES.items():
        rows = kept(f, own)
        for c in own:
            r, (rho, mi) = got[family, c], plain_scores(rows[c], rows["y"], 8)
            assert r.n == len(rows) and r.mi == pytest.approx(mi) and (r.rho is None if rho is None else r.rho == pytest.approx(rho))
            assert r.mi_signed == pytest.approx(mi * np.sign(rho or 0))


@pytest.mark.parametrize("alpha", [0.05, 1.0])
def test_lasso_is_optimal(spark, alpha):
    f = data()
    f.loc[0, "a_1"] = 2.0
    families = FAMILIES | {"all": ["a_1", "a_2", "b_1", "b_2"]}
    got = X.lasso_families(spark.createDataFrame(f).repartition(3), families, "y", alpha).toPandas()
    for family, own in families.items():
        rows = kept(f, own)
        w = got[got.family == family].set_index("feature").weight[own].to_numpy()
        x, y = rows[own].to_numpy() - rows[own].to_numpy().mean(axis=0), rows["y"].to_numpy() - rows["y"].mean()
        slope = x.T @ (y - x @ w) / len(rows)  # no direction makes the loss less
        for s, v in zip(slope, w):
            assert abs(s) <= alpha + 1e-6 and (v == 0 or s == pytest.approx(alpha * np.sign(v), abs=1e-6))
    assert (got[got.feature == "b_2"].weight == 0).all()


def test_odd_tables(spark):
    one = spark.createDataFrame([(1.0, 2.0, "z")], "a_1 double, y double, k string")
    r = X.family_scores(one, {"a_": ["a_1"]}, "y").orderBy("family").collect()
    assert [(x.family, x.n, x.weight, x.rho, x.mi) for x in r] == [("a_", 1, 0.0, None, 0.0), ("all", 1, 0.0, None, None)]
    none = X.family_scores(one.where("y < 0"), {"a_": ["a_1"]}, "y").where("family = 'a_'").first()
    assert none.n == 0 and none.weight is None and none.rho is None and none.mi is None
    whole = X.rank_scores(one.union(one).selectExpr("cast(a_1 as int) a_1", "cast(y as decimal(9,2)) y"), {"a_": ["a_1"]}, "y").first()
    assert whole.n == 2
    assert X.families_of(["ab", "a", "c"], ["a", "x"]) == {"a": ["ab", "a"]}
