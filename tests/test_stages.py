"""One preparation for all models, as ML stages; ensembles as one stored artefact."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from tabwright.models import front, linear, trees
from tabwright.models.front import Design, FrontEnd, coefficient_table, predict_wide
from tabwright.models.stages import FrontStage, stage_of
from tabwright.plans import workbench as WB
from tabwright.session import new_path
from tabwright.sources import sinks as K


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    n = 600
    out = []
    for i in range(n):
        g = ["a", "b", "c", None][rng.integers(0, 4)]
        x = None if rng.random() < 0.15 else float(rng.normal(3 if g == "a" else 9, 2))
        out.append((i, x, float(rng.lognormal()), g, ["lo", "mid", "top", None][rng.integers(0, 4)], int(i % 3), float(5 + i % 7 + rng.random())))
    return spark.createDataFrame(out, "id int, x double, w double, g string, o string, fold int, target double")


OPTIONS = dict(continuous=["x", "w"], categorical=["g"], ordinal=["o"], groupOf='{"x": "g"}')


def _array(df):
    return {r["id"]: np.array(r["f"]) for r in df.select("id", vector_to_array("features").alias("f")).collect()}


def test_the_stage_learns_group_medians_modes_and_ranks(spark, rows):
    model = FrontStage(**OPTIONS, scaling="standard").fit(rows)
    got, pdf = _array(model.transform(rows)), rows.toPandas()
    assert model.names == ["x", "w", "g=a", "g=b", "g=c", "o"]
    medians = pdf.groupby("g").x.median()
    x = pdf.x.fillna(pdf.g.map(medians)).fillna(pdf.x.median())
    mode = pdf.g.value_counts().sort_index().idxmax()
    top = pdf.o.value_counts().sort_index().idxmax()
    want = np.c_[(x - x.mean()) / x.std(ddof=0), (pdf.w - pdf.w.mean()) / pdf.w.std(ddof=0),
                 *[(pdf.g.fillna(mode) == v).astype(float) for v in "abc"], pdf.o.fillna(top).map({"lo": 0, "mid": 1, "top": 2})]
    assert np.allclose(np.array([got[i] for i in pdf.id]), want, atol=1e-9)
    new = spark.createDataFrame([(1, None, 1.0, "never seen", "never seen", 0, None)], rows.schema)
    made = _array(model.transform(new))[1]
    assert np.allclose(made[2:], [0, 0, 0, -1]) and made[0] == pytest.approx((pdf.x.median() - x.mean()) / x.std(ddof=0))


@pytest.mark.parametrize("estimator", [lambda: LinearRegression(labelCol="target"), lambda: GBTRegressor(labelCol="target", maxIter=3, seed=1)])
def test_any_estimator_follows_and_the_pipeline_is_stored(spark, rows, estimator):
    pipeline = Pipeline(stages=[FrontStage(**OPTIONS, scaling="yeo-johnson"), estimator()])
    path = new_path(spark, "pipeline")
    pipeline.write().save(path + "-unfitted")
    model = Pipeline.load(path + "-unfitted").fit(rows)
    model.write().save(path)
    loaded = PipelineModel.load(path)
    before = {r["id"]: r["prediction"] for r in model.transform(rows).collect()}
    after = {r["id"]: r["prediction"] for r in loaded.transform(rows).collect()}
    assert before == after and loaded.stages[0].names == model.stages[0].names


def test_trees_and_linear_models_share_one_preparation(spark, rows):
    from tabwright.models.front import FrontEnd, collect_design

    design = collect_design(rows, ["x", "w"], ["g"], ["o"], {"x": "g"})
    fr = FrontEnd(rows, design, 3, "target", transform="none")
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {"ols": ("ols", {})}))
    wide, _ = predict_wide(rows, design, coefs, ["id"], "fold")
    want = {r["id"]: r["ols"] for r in wide.collect()}
    for f in (0, 2):
        stage = stage_of(fr, f)
        fitted = LinearRegression(labelCol="target", solver="normal").fit(stage.transform(rows.filter(F.col("fold") != f)))
        for r in fitted.transform(stage.transform(rows.filter(F.col("fold") == f))).collect():
            assert r["prediction"] == pytest.approx(want[r["id"]], abs=1e-4)  # the solver is iterative: all levels are coded
    t = trees.TreeTrainer(rows, ["x", "w"], ["g"], ["o"], "target", 3, group_of={"x": "g"})
    a = _array(t.stages[1].transform(rows))
    b = _array(stage_of(fr, 1).transform(rows))
    assert all(np.allclose(a[i], b[i]) for i in a)
    scored = t.predictions(trees.boosted("gbr", 3), "gbr", ["id"]).collect()
    assert len(scored) == 600 and all(r["pred"] is not None for r in scored)


def test_the_stored_workflow_predicts_what_the_workflow_predicts(spark, sf):
    scorer = WB.composite(spark, sf, "standard", ["ridge", "lasso"], 3)
    path = new_path(spark, "composite")
    scorer.save(path)
    loaded = K.EnsembleScorer.load(spark, path)
    assert loaded.parts == scorer.parts and loaded.best == scorer.best
    wide, names = WB.ensemble(spark, sf, "standard", ["ridge", "lasso"], 3)
    test = WB.prepared(spark, sf).filter(F.col("part") == "test")
    want = {r["row_id"]: r for r in wide.filter(F.col("part") == "test").collect()}
    got, mine = loaded.wide(test, ["row_id"])
    assert set(mine) == set(names)
    for r in got.collect():
        assert all(r[m] == pytest.approx(want[r["row_id"]][m], abs=1e-6) for m in names)
    best = loaded.score(test, ["row_id"]).collect()
    assert {r["model"] for r in best} == {loaded.best} and len(best) == len(want)


def test_parts_must_be_known(spark, rows):
    from tabwright.models.front import Design, FrontEnd

    fr = FrontEnd(rows, Design(["w"], [], [], {}), 3, "target", transform="none")
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {"a": ("ols", {})}))
    for parts, best in (({"v": {"kind": "vote", "weights": {"b": 1.0}}}, "a"), ({"a": {"kind": "vote", "weights": {"a": 1.0}}}, "a"), ({}, "b")):
        with pytest.raises(ValueError):
            K.EnsembleScorer(fr.design, coefs, "none", fr.k, parts, best)
    with pytest.raises(ValueError):
        K.EnsembleScorer(fr.design, coefs, "none", fr.k, {}, "a").score(rows, ["id"], ["nobody"])


def test_a_learned_target_transform_is_refitted_in_every_fold(spark):
    from tabwright.functions.scalar import inv_yeo_johnson, yeo_johnson
    from tabwright.models.front import Design, FrontEnd
    from tabwright.operators import learned as L

    rng = np.random.default_rng(9)
    x = rng.normal(size=300)
    y = np.exp(1 + x + rng.normal(size=300) / 4)
    df = spark.createDataFrame([(i, float(a), float(b), i % 3) for i, (a, b) in enumerate(zip(x, y))], "id int, x double, y double, fold int")
    fr = FrontEnd(df, Design(["x"], [], [], {}), 3, "y", transform="yeojohnson")
    coefs = coefficient_table(spark, fr, linear.fit_all(fr, {"m": ("ridge", {"alpha": 3.0})}))
    wide, _ = predict_wide(df, fr.design, coefs, ["id", "fold"], "fold")
    got = {r["id"]: r for r in wide.withColumn("pred", fr.inverse("m")).collect()}
    for f in range(3):
        train = df.filter(F.col("fold") != f)
        lam = L.fit_power(train, ["y"])[0, "y"]
        assert fr.y_lam[f] == pytest.approx(lam, abs=1e-9)
        mine = np.arange(300) % 3 != f
        z = np.array([r["z"] for r in train.orderBy("id").select(yeo_johnson(F.col("y"), lam).alias("z")).collect()])
        s = (x - x[mine].mean()) / x[mine].std()
        w = (s[mine] @ (z - z.mean())) / (mine.sum() + 3.0)
        want = z.mean() + w * s
        back = spark.createDataFrame([(float(v),) for v in want[~mine]], "z double").select(inv_yeo_johnson(F.col("z"), lam).alias("p")).collect()
        for i, b in zip(np.flatnonzero(~mine), back):
            assert got[i]["m"] == pytest.approx(want[i], abs=1e-6) and got[i]["pred"] == pytest.approx(b["p"], rel=1e-6)
    # another target in fold 1 changes nothing in the fit that leaves fold 1 out
    other = FrontEnd(df.withColumn("y", F.when(F.col("fold") == 1, F.col("y") * 9).otherwise(F.col("y"))), Design(["x"], [], [], {}), 3, "y", transform="yeojohnson")
    assert other.y_lam[1] == pytest.approx(fr.y_lam[1], abs=1e-6) and abs(other.y_lam[3] - fr.y_lam[3]) > 1e-4


def test_rows_of_a_tree_task_are_bounded(spark, monkeypatch):
    """A fit's tasks hold a bounded number of rows, and fewer fits run side by side when rows are many."""
    monkeypatch.setattr(trees, "TASK_ROWS", 100)
    monkeypatch.setattr(trees, "ROWS_AT_ONCE", 2500)
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.col("id").cast("double").alias("x"), (F.col("id") + 1.0).alias("target")).coalesce(1)
    t = trees.TreeTrainer(df, ["x"], [], [], "target", 3)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    with t.file_by_file():
        sizes = t.prepared(3).select("z").rdd.glom().map(len).collect()
    assert max(sizes) <= 100 and sum(sizes) == 1000 and t.at_once == 2
    assert t.prepared(3) is t.prepared(3)
    errors = trees.grid_errors(t, [trees.forest(2, 2), trees.forest(3, 5)])
    assert errors[0] > errors[1] > 0
    assert t.predictions(trees.forest(2, 2), "m", ["id"]).count() == 1000
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost


def test_shifted_values_travel_in_pieces(spark, monkeypatch):
    """Each column's values move on by its own shift, over block borders and past the end; rows are not shuffled once per column."""
    monkeypatch.setattr(trees, "ORDER_BLOCK", 7)
    df = spark.range(1, 61).select(F.col("id").alias("__pos"), (F.col("id") * 10).alias("a"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), "id")).alias("b")).repartition(5)
    moved = trees.moved_on(df, {"a": 1, "b": 45}, 60)
    assert moved._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 3
    got = {r["__pos"]: r for r in moved.collect()}
    assert len(got) == 60
    for p, r in got.items():
        q, t = (p - 2) % 60 + 1, (p - 46) % 60 + 1
        assert r["a"] == p * 10 and r["__new_a"] == q * 10
        assert r["__new_b"] == (f"s{t}" if t % 3 else None)


def test_rows_of_a_tree_task_stay_few_at_full_size(spark):
    """A task keeps about 270 bytes of a row: 250,000 rows of one split are already written in files."""
    df = spark.range(250_000).select("id", (F.col("id") % 2).cast("int").alias("fold"), (F.col("id") % 97).cast("double").alias("x"), (F.col("id") + 1.0).alias("target")).coalesce(1)
    t = trees.TreeTrainer(df, ["x"], [], [], "target", 2)
    with t.file_by_file():
        sizes = t.prepared(2).select("z").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert t.split and sum(sizes) == 250_000 and max(sizes) <= 200_000


def test_features_come_as_vectors_without_row_objects(spark):
    """Slots and vectors are made in Arrow batches: no expression per level and no conversion of each row; values are those of the map."""
    rows = [(0, 1.5, "a", "2", 0, 1.0), (1, None, "b", "10", 1, 2.0), (2, 4.5, "a", None, 0, 3.0), (3, 2.5, None, "2", 1, 4.0), (4, 7.0, "b", "10", 0, 5.0), (5, None, "a", "2", 1, 6.0)]
    df = spark.createDataFrame(rows, "id int, x double, g string, o string, fold int, target double")
    design = Design(["x"], ["g"], ["o"], {"g": ["a", "b"], "o": ["2", "10"]}, {"x": "g"})
    stage = stage_of(FrontEnd(df, design, 2, "target", transform="none"), 2)
    new = spark.createDataFrame([*rows, (6, 1.0, "new", "11", 0, 7.0), (7, None, "new", "2", 0, 8.0), (8, float("nan"), "a", None, 0, 9.0)], df.schema)
    out = stage.transform(new)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "array_position" not in plan and "UDF(" not in plan.replace("features(", "")
    T = np.zeros((len(stage.names), design.width))
    T[stage.entries[:, 0].astype(int), stage.entries[:, 1].astype(int)] = stage.entries[:, 2]
    slots = {r["id"]: [r[f"__s{i}"] for i in range(len(design.blocks))] for r in new.select("id", *design.slots()).collect()}
    for r in out.collect():
        base = np.zeros(design.width)
        base[0] = 1.0
        base[1] = 0.0 if r["x"] is None or np.isnan(r["x"]) else r["x"] - stage.shift[0]
        for (kind, c, _), s in zip(design.blocks, slots[r["id"]]):
            if s >= 0:
                base[design.start[(kind, c)] + s] = 1.0
        assert r["features"].toArray() == pytest.approx(T @ base, abs=1e-12)


def test_quartiles_copy_only_filled_cells(spark, monkeypatch):
    """The robust scaler counts values per fold; a row is not copied for every fit, only its empty cells are."""
    seen, real = [], front.long_quantiles
    monkeypatch.setattr(front, "long_quantiles", lambda long, *a, **b: seen.append(long.count()) or real(long, *a, **b))
    df = spark.range(60).select("id", F.when(F.col("id") % 10 > 0, F.col("id").cast("double")).alias("x"), (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") + 1.0).alias("target"))
    fr = FrontEnd(df, Design(["x"], [], [], {}), 3, "target", scaling="robust")
    assert seen[-1] == 54 + 6 * 3  # an empty cell is seen by the fits that do not leave it out
    for f in range(4):
        mine = [i for i in range(60) if i % 3 != f]
        known = [float(i) for i in mine if i % 10]
        filled = known + [float(np.median(known))] * (len(mine) - len(known))
        a, b, c = np.quantile(filled, [0.25, 0.5, 0.75])
        assert fr.quart[(f, "x")] == pytest.approx((b, c - a))
