import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabwright.models.front import collect_design
from tabwright.operators import clean as C
from tabwright.operators import learned as L
from tabwright.operators import metrics as M
from tabwright.operators import profile as P
from tabwright.operators import select as SEL
from tabwright.operators import shape as S
from tabwright.operators import split as SP
from tabwright.operators import stats as ST
from tabwright.plans import workbench as WB
from tabwright.session import new_path
from tabwright.sources import housing
from tabwright.sources import readers as R
from tabwright.sources import sinks as K


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_near_constant_variants(spark):
    df = frame(spark, [(1, "a"), (1, None), (1, None), (2, None)], "x int, s string")
    names = lambda r: {x["column"] for x in r.collect()}
    assert names(S.near_constant(df, 0.7)) == {"x", "s"}          # null is a value: 3 of 4
    assert names(S.near_constant(df, 0.75)) == set()               # strictly above
    assert names(S.near_constant(df, 0.7, null_is_value=False)) == {"x", "s"}
    assert names(S.near_constant(df, 0.7, False, True)) == {"x"}   # share of all rows


def test_outlier_flag_null_is_false(spark):
    df = frame(spark, [(1, None, 5.0), (2, 11.0, None), (3, None, None)], "row_id int, a double, b double")
    got = [r["row_id"] for r in S.outlier_keys(df, "row_id", {"a": 10, "b": 10, "gone": 1}).collect()]
    assert got == [2]
    assert df.filter(~S.outlier_flag(df, {"a": 10})).count() == 2


def test_sum_present_and_weighted_sum_treat_null_differently(spark):
    df = frame(spark, [(1.0, None), (None, None)], "a double, b double")
    out = df.select(C.sum_present(df, ["a", "b", "gone"]).alias("s"), C.weighted_sum({"a": 1.0, "b": 2.0}).alias("w")).collect()
    assert [(r["s"], r["w"]) for r in out] == [(1.0, None), (0.0, None)]


def test_registry_errors(spark):
    df = frame(spark, [(1, "a", 2.0)], "row_id int, s string, x double")
    reg = S.feature_groups(df, [], ["row_id"])
    reg.verify(df)
    with pytest.raises(ValueError, match="without a role"):
        reg.verify(df.withColumn("new", F.lit(1)))
    with pytest.raises(ValueError, match="not in the frame"):
        reg.verify(df.drop("x"))


def test_ordinal_null_only_with_null_key(spark):
    df = frame(spark, [("Gd", None), (None, "TA"), ("odd", "Ex")], "ExterQual string, PoolQC string")
    out = C.recode_ordinal(df, housing.ORDINAL).collect()
    assert [tuple(r) for r in out] == [(4, 0), (None, 2), (None, 4)]
    with pytest.raises(PySparkException):
        C.recode_ordinal(df, housing.ORDINAL, strict=True).collect()


def test_housing_columns_end_to_end(spark):
    df = frame(spark, [(1, 20, 5, "Ex", 2008, 2000, 2004, 100.0, None, 1, 1)],
               "Id int, MSSubClass int, MoSold int, PoolQC string, YrSold int, YearBuilt int, YearRemodAdd int, TotalBsmtSF double, `1stFlrSF` double, FullBath int, HalfBath int")
    df = C.recode_ordinal(C.recode_nominal(df, housing.RECODE), housing.ORDINAL)
    reg = S.feature_groups(df, housing.NUMERIC_ORDINAL + list(housing.ORDINAL), ["Id"])
    out, reg = C.engineer(df, reg, housing.SUMS, housing.WEIGHTED, housing.DIFFERENCES)
    row = out.first().asDict()
    assert (row["MSSubClass"], row["MoSold"], row["PoolQC"]) == ("SC20", "May", 4)
    assert (row["TotalSF"], row["HouseAge"], row["RemodAge"]) == (100.0, 8, 4)
    assert "YrSold" not in row and "HouseAge" in reg.continuous


def test_mode_ties_and_group_fallback(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", None), (None, None), ("a", None), ("new", None)]
    df = frame(spark, rows, "g string, x double")
    fit = df.filter("g is null or g <> 'new'")
    out = L.fill_by_group(df, "x", "g", L.fit_median(fit, ["x"], by=["g"]), L.fit_median(fit, ["x"]))
    assert sorted(r["x"] for r in out.collect()) == [1.0, 2.0, 2.0, 2.0, 2.0, 3.0]
    num = frame(spark, [(10,), (9,), (10,), (9,)], "v int")
    assert L.fit_mode(num, ["v"]).first()["value"] == "9"


def test_group_imputer_inactive_without_its_column(spark):
    df = frame(spark, [(1.0,)], "x double")
    assert L.impute_group_median(df, "x", None) is df
    assert L.impute_group_median(df, "x", "g") is df


def test_onehot_rows_sum_to_zero_or_one(spark):
    df = frame(spark, [("a",), ("b",), (None,), ("zzz",)], "c string")
    levels = L.collect_levels(df.filter("c <> 'zzz'"), ["c"])
    out = L.indicator_columns(df, levels).collect()
    assert [(r["c=a"], r["c=b"]) for r in out] == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_ordinal_codes_per_fold(spark):
    df = frame(spark, [(0, "a"), (0, "b"), (1, "b"), (1, "c")], "fold int, c string")
    codes = L.fit_ordinal(df, ["c"], "fold", 2)
    got = {(r["fold"], r["c"]): r["code"] for r in L.encode_ordinal(df, "c", codes, "code", "fold").collect()}
    assert got == {(0, "a"): -1, (0, "b"): 0, (1, "b"): 1, (1, "c"): -1}


def test_constant_and_null_columns_scale_safely(spark):
    df = frame(spark, [(3.0, None), (3.0, None)], "a double, b double").withColumn("b", F.col("b").cast("double"))
    for method in ("standard", "minmax", "robust"):
        out = L.apply_scaler(df, L.fit_scaler(df, ["a", "b"], method), ["a", "b"]).collect()
        assert [(r["a"], r["b"]) for r in out] == [(0.0, None), (0.0, None)]


def test_fold_sizes_differ_by_one(spark):
    df = spark.range(1003).withColumnRenamed("id", "key")
    for folds in (SP.kfold(df, "key", 5), SP.contiguous(df, "key", 5)):
        sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert SP.holdout(df, "key", 0.2).filter("part = 'val'").count() == 201


def test_pair_sums_agree_with_the_built_in_correlation(spark):
    rng = np.random.default_rng(0)
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in rng.normal(1e5, 1, 4)) for _ in range(500)]
    df = frame(spark, rows, "a double, b double, c double, d double").repartition(3)
    got = {(r["left"], r["right"]): (r["n"], r["r"]) for r in ST.correlation_pairs(df, list("abcd")).collect()}
    assert len(got) == 6
    for (x, y), (n, r) in got.items():
        both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        assert n == both.count() and r == pytest.approx(both.agg(F.corr(x, y)).first()[0], abs=1e-9)


def test_percentile_selection_keeps_ties_within_room(spark):
    scores = frame(spark, [(c, s) for c, s in zip("abcdefghij", [float(i) for i in range(1, 11)])], "column string, s double")
    assert [r["column"] for r in SEL.top_percent(scores, "s", 10).collect()] == ["j"]


def test_predictions_are_validated_and_clip_applies(spark):
    ok = frame(spark, [(1, 2.5), (2, 3.0)], "row_id int, pred double")
    path = K.write_predictions(ok, new_path(spark, "t"), "m", "log")
    assert path.endswith("m_results_log")
    assert R.read_csv(spark, path, "row_id int, pred double").count() == 2
    for bad in (0.0, -1.0, None, float("nan")):
        with pytest.raises(PySparkException):
            K.write_predictions(frame(spark, [(1, bad)], "row_id int, pred double"), new_path(spark, "t"), "m", "log")
    zero = frame(spark, [(0.0, 0.0, "m", 0)], "y double, pred double, model string, fold int")
    assert zero.select(M.rmsle()).first()[0] == pytest.approx(np.log(2))


def test_reader_errors(spark):
    with pytest.raises(FileNotFoundError, match="/no/such/file"):
        R.read_csv(spark, "/no/such/file.csv", "a int")
    df = frame(spark, [(1, 2.0), (1, 3.0)], "k int, y double")
    with pytest.raises(ValueError, match="not unique"):
        R.load_split(df, df.limit(0), "k", "y")


def test_duplicates_treat_null_as_equal(spark):
    df = frame(spark, [(1, None), (2, None), (3, "x")], "k int, s string")
    assert P.duplicate_rows(df, ["k"]).first()["duplicates"] == 1


def test_design_refuses_too_many_levels(spark):
    df = spark.range(2500).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("c"))
    with pytest.raises(ValueError, match="columns wide"):
        collect_design(df, [], ["c"], [])


def test_stored_model_scores_like_the_fitted_one(spark, sf):
    from tabwright.models import linear
    from tabwright.models.front import coefficient_table

    rows, fr = WB.prepared(spark, sf), WB.front(spark, sf)
    chosen = {"ridge": ("ridge", {"alpha": 1.0})}
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, chosen))
    path = new_path(spark, "model")
    K.LinearScorer(fr.design, coefs, "log", WB.K).save(path)
    loaded = K.LinearScorer.load(spark, path)
    test = rows.filter("part = 'test'")
    want = {r["row_id"]: r["pred"] for r in WB.base_predictions(test, fr, chosen).collect()}
    got = {r["row_id"]: r["pred"] for r in loaded.score(test, ["row_id"]).collect()}
    assert got == pytest.approx(want)


def test_prepare_exact_and_hashed(spark, sf):
    from tabwright.sources.tables import staged_order_frame

    raw = staged_order_frame(spark, sf)
    for exact in (True, False):
        rows = WB.prepare(raw, exact=exact)
        assert rows.select("row_id").distinct().count() == rows.count()
        n = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}
        assert set(n) == {"fit", "val", "test"}
        sizes = [r["count"] for r in rows.filter("part = 'fit'").groupBy("fold").count().collect()]
        assert len(sizes) == WB.K
        if exact:
            assert max(sizes) - min(sizes) <= 1
            train = raw.filter("split = 'train'").count()
            assert n["val"] == -(-train // 5)
        outliers = S.outlier_keys(raw, "row_id", WB.OUTLIERS)
        assert rows.filter("part = 'fit'").join(outliers, "row_id").count() == 0
