"""Ridge whose vectors stay in the cluster: the same weights as the tiles, and nothing as wide as the design on the driver."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions import joins
from tabwright.models import factors, tiles, wide
from tabwright.models.factors import FactorRidge
from tabwright.models.wide import WideFront
from tabwright.plans import wide as plans


@pytest.mark.parametrize("xs, cats, alpha", [(["x"], ["u", "v"], 20.0), ([], ["u"], 0.0)])
def test_the_same_predictions_as_the_tiles(spark, monkeypatch, xs, cats, alpha):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({"id": np.arange(n), "x": rng.normal(50, 9, n), "z": rng.lognormal(1, 1, n), "fold": rng.integers(0, 4, n),
                        "u": [f"u{i}" for i in rng.integers(0, 30, n)], "v": [f"v{i}" for i in rng.integers(0, 7, n)]})
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    pdf["y"] = 0.2 * pdf.x.fillna(40) + pdf.z + pdf.u.str[1:].astype(int) % 7 + rng.normal(size=n)
    for c in ("u", "v"):
        pdf.loc[rng.random(n) < 0.05, c] = None
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    df = spark.createDataFrame(rows, "id long, x double, z double, fold int, u string, v string, y double")
    df = df.withColumn("y", F.when(F.col("id") > 3, F.col("y")))
    front = WideFront(df, xs, cats, 3, "y", transform="none")
    asked = df.unionByName(spark.createDataFrame([(-1, None, 1.0, 0, "new", "new", None), (-2, 1.0, 1.0, 7, None, "v1", None)], df.schema))
    want = front.predict(asked, {"m": front.fit("ridge", {"alpha": alpha})}, ["id"]).toPandas().set_index("id")["m"]
    for most in (-1,) if xs else (joins.BROADCAST_BYTES,):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", most)
        got = FactorRidge(df, xs, cats, 3, "y", transform="none").fit(alpha).predict(asked, "m", ["id"]).toPandas().set_index("id")["m"]
        assert len(got) == n + 2
        assert np.allclose(got.sort_index(), want.sort_index(), rtol=1e-6, atol=1e-6, equal_nan=True)
    assert np.isnan(got[-2])


def test_the_query_brings_no_vector_to_the_driver(spark, sf, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("a vector as wide as the design on the driver")

    monkeypatch.setattr(tiles.TiledGram, "multiply", refuse)
    monkeypatch.setattr(wide.WideFront, "__init__", refuse)
    assert plans.model_ridge_wide(spark, sf).count() > 0


def test_refusals(spark):
    df = spark.createDataFrame([(1.0, "a", 0, 2.0), (2.0, None, 1, 3.0)], "x double, c string, fold int, y double")
    with pytest.raises(ValueError):
        FactorRidge(df, ["x"], ["c"], 2, "y", transform="none").fit(-1.0)
    assert factors.FactorRidge(df, ["x"], [], 2, "y", transform="none").fit(1.0).predict(df, "m", ["y"]).count() == 2
