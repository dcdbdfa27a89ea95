"""Queries: imputation, encoding, scaling and power transforms, fitted on training rows."""

from pyspark.sql import functions as F

from tabwright.functions import scalar as X
from tabwright.models.trees import one_hot_stages
from tabwright.operators import learned as L
from tabwright.operators import split as S
from tabwright.plans.registry import query, rnd, rnd_col, rounded
from tabwright.session import materialize
from tabwright.sources.tables import FOLD_SQL, ORDER_FRAME_SQL, staged_order_frame, table

OF = f"with {ORDER_FRAME_SQL}, tr as (select * from order_frame where split = 'train')"


def frames(spark, sf):
    frame = staged_order_frame(spark, sf)
    return frame, frame.filter(F.col("split") == "train")


# Imputation


@query("imp_group_median", f"""{OF}, g as (select nation, median(max_price) as v from tr group by 1)
    select row_id, {rnd('coalesce(max_price, g.v, (select median(max_price) from tr))')} as max_price
    from order_frame o left join g on o.nation = g.nation""")
def imp_group_median(spark, sf):
    frame, _ = frames(spark, sf)
    out = L.impute_group_median(frame.select("row_id", "split", "nation", "max_price"), "max_price", "nation", F.col("split") == "train")
    return rounded(out.select("row_id", "max_price"), {"max_price"})


@query("imp_group_median_fold", f"""{OF}, {FOLD_SQL}, t as (select tr.*, fold from tr join folds using (row_id)),
    g as (select f.fold, t.nation, median(t.max_price) as v from (select distinct fold from folds) f join t on t.fold <> f.fold group by 1, 2)
    select t.row_id, {rnd('coalesce(t.max_price, g.v)')} as max_price from t left join g on t.fold = g.fold and t.nation = g.nation""")
def imp_group_median_fold(spark, sf):
    _, train = frames(spark, sf)
    folds = materialize(S.kfold(train.select("row_id", "nation", "max_price"), "row_id", 5), "folds")
    params = L.fit_median(folds, ["max_price"], "fold", 5, by=["nation"])
    overall = L.fit_median(folds, ["max_price"], "fold", 5)
    out = L.fill_by_group(folds, "max_price", "nation", params, overall, "fold")
    return rounded(out.select("row_id", "max_price"), {"max_price"})


@query("imp_group_mean", f"""{OF}, g as (select segment, avg(max_price) as v from tr group by 1)
    select row_id, {rnd('coalesce(max_price, g.v)')} as max_price from order_frame o left join g on o.segment = g.segment""")
def imp_group_mean(spark, sf):
    frame, train = frames(spark, sf)
    out = L.fill_by_group(frame.select("row_id", "segment", "max_price"), "max_price", "segment", L.fit_mean(train, ["max_price"], by=["segment"]))
    return rounded(out.select("row_id", "max_price"), {"max_price"})


@query("imp_group_mode", f"""{OF}, c as (select nation, segment_gap as v, row_number() over (partition by nation order by count(*) desc, segment_gap) as r
      from tr where segment_gap is not null group by 1, 2)
    select row_id, coalesce(segment_gap, c.v) as segment_gap from order_frame o left join c on o.nation = c.nation and r = 1""")
def imp_group_mode(spark, sf):
    frame, train = frames(spark, sf)
    out = L.fill_by_group(frame.select("row_id", "nation", "segment_gap"), "segment_gap", "nation", L.fit_mode(train, ["segment_gap"], by=["nation"]))
    return out.select("row_id", "segment_gap")


def _fill(agg, cols):
    return ", ".join(f"{rnd(f'coalesce({c}, (select {agg}({c}) from tr))')} as {c}" for c in cols)


@query("imp_median", f"{OF} select row_id, {_fill('median', ['max_price', 'sum_qty'])} from order_frame")
def imp_median(spark, sf):
    frame, train = frames(spark, sf)
    cols = ["max_price", "sum_qty"]
    return rounded(L.fill_with(frame.select("row_id", *cols), L.fit_median(train, cols), cols), set(cols))


@query("imp_mean", f"{OF} select row_id, {_fill('avg', ['max_price', 'sum_qty'])} from order_frame")
def imp_mean(spark, sf):
    frame, train = frames(spark, sf)
    cols = ["max_price", "sum_qty"]
    return rounded(L.fill_with(frame.select("row_id", *cols), L.fit_mean(train, cols), cols), set(cols))


_MODE = "(select {c} from tr where {c} is not null group by 1 order by count(*) desc, 1 limit 1)"


@query("imp_mode", f"{OF} select row_id, " + ", ".join(
    f"coalesce({c}, {_MODE.format(c=c)}) as {c}" for c in ("segment_gap", "rating_absent")) + " from order_frame")
def imp_mode(spark, sf):
    frame, train = frames(spark, sf)
    cols = ["segment_gap", "rating_absent"]
    return L.fill_with(frame.select("row_id", *cols), L.fit_mode(train, cols), cols)


@query("imp_diag_copy", f"{OF} select row_id, {_fill('median', ['max_price'])}, coalesce(segment_gap, {_MODE.format(c='segment_gap')}) as segment_gap, "
       f"coalesce(n_lines, {_MODE.format(c='n_lines')})::double as n_lines from tr")
def imp_diag_copy(spark, sf):
    _, train = frames(spark, sf)
    rows = train.select("row_id", "max_price", "segment_gap", "n_lines")
    out = L.fill_with(rows, L.fit_median(train, ["max_price"]), ["max_price"])
    out = L.fill_with(out, L.fit_mode(train, ["segment_gap", "n_lines"]), ["segment_gap", "n_lines"])
    return rounded(out.withColumn("n_lines", F.col("n_lines").cast("double")), {"max_price"})


# Encoding


def _dummies(cols, levels):
    return ", ".join(f"case when {c} = '{v}' then 1 else 0 end as \"{c}={v}\"" for c, vs in zip(cols, levels) for v in vs)


SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUS = ["F", "O", "P"]


@query("enc_onehot", f"{OF} select row_id, {_dummies(['segment_gap'], [SEG])} from order_frame")
def enc_onehot(spark, sf):
    frame, train = frames(spark, sf)
    return L.indicator_columns(frame.select("row_id", "segment_gap"), L.collect_levels(train, ["segment_gap"])).drop("segment_gap")


@query("enc_onehot_vector")
def enc_onehot_vector(spark, sf):


    frame, train = frames(spark, sf)
    stages = one_hot_stages(["segment_gap", "status"])
    return stages.fit(train).transform(frame).select("row_id", "segment_gap_vec", "status_vec")


@query("enc_dummies", f"{OF} select row_id, {_dummies(['status', 'segment_gap'], [STATUS, SEG])} from order_frame")
def enc_dummies(spark, sf):
    frame, _ = frames(spark, sf)
    cols = ["status", "segment_gap"]
    return L.indicator_columns(frame.select("row_id", *cols), L.collect_levels(frame, cols)).drop(*cols)


@query("enc_reference_dummies", f"{OF} select row_id, {_dummies(['status', 'segment'], [STATUS, SEG[1:]])} from order_frame")
def enc_reference_dummies(spark, sf):
    frame, _ = frames(spark, sf)
    cols = ["status", "segment"]
    return L.indicator_columns(frame.select("row_id", *cols), L.collect_levels(frame, cols), drop_first=True).drop(*cols)


@query("enc_ordinal", f"""{OF}, lv as (select priority, dense_rank() over (order by priority) - 1 as code from (
      select distinct priority from tr where priority <> '3-MEDIUM'))
    select row_id, coalesce(code, -1) as code from order_frame o left join lv on o.priority = lv.priority""")
def enc_ordinal(spark, sf):
    frame, train = frames(spark, sf)
    codes = L.fit_ordinal(train.filter(F.col("priority") != "3-MEDIUM"), ["priority"])
    return L.encode_ordinal(frame.select("row_id", "priority"), "priority", codes, "code").select("row_id", F.col("code").cast("bigint").alias("code"))


@query("enc_label", "select p_partkey, dense_rank() over (order by p_name) - 1 as code from part")
def enc_label(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    codes = L.fit_ordinal(part, ["p_name"])
    return L.encode_ordinal(part, "p_name", codes, "code").select("p_partkey", F.col("code").cast("bigint").alias("code"))


# Scaling

SCALED = ["acctbal", "sum_qty"]


def _scale_sql(center, scale):
    return f"{OF} select row_id, " + ", ".join(
        rnd(f"({c} - (select {center.format(c=c)} from tr)) / (select {scale.format(c=c)} from tr)", 6) + f" as {c}" for c in SCALED) + " from order_frame"


def _scaled(spark, sf, method):
    frame, train = frames(spark, sf)
    out = L.apply_scaler(frame.select("row_id", *SCALED), L.fit_scaler(train, SCALED, method), SCALED)
    return rounded(out, set(SCALED), 6)


@query("scale_standard", _scale_sql("avg({c})", "stddev_pop({c})"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query("scale_minmax", _scale_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("scale_robust", _scale_sql("median({c})", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query("scale_standard_fold", f"""{OF}, {FOLD_SQL}, t as (select tr.*, fold from tr join folds using (row_id)),
    p as (select f.fold, avg(t.acctbal) as m, stddev_pop(t.acctbal) as s from (select distinct fold from folds) f join t on t.fold <> f.fold group by 1)
    select row_id, {rnd('(acctbal - m) / s', 6)} as acctbal from t join p on t.fold = p.fold""")
def scale_standard_fold(spark, sf):
    _, train = frames(spark, sf)
    folds = materialize(S.kfold(train.select("row_id", "acctbal"), "row_id", 5), "folds")
    params = L.fit_scaler(folds, ["acctbal"], "standard", "fold", 5)
    return rounded(L.apply_scaler(folds, params, ["acctbal"], "fold").drop("fold"), {"acctbal"}, 6)


def _yj(x, lam):
    return (f"case when {x} >= 0 then (power({x} + 1, {lam}) - 1) / {lam} "
            f"else -(power(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) end")


@query("scale_yeojohnson", f"""{OF}, z as (select row_id, split, {_yj('acctbal', 0.9)} as z from order_frame),
    p as (select avg(z) as m, stddev_pop(z) as s from z where split = 'train')
    select row_id, {rnd('(z - m) / s', 6)} as acctbal from z, p""")
def scale_yeojohnson(spark, sf):
    """Transform and standardise at a given lambda; `scale_yeojohnson_fit` estimates it."""
    frame, _ = frames(spark, sf)
    z = frame.select("row_id", "split", X.yeo_johnson(F.col("acctbal"), 0.9).alias("acctbal"))
    params = L.fit_scaler(z.filter(F.col("split") == "train"), ["acctbal"], "standard")
    return rounded(L.apply_scaler(z, params, ["acctbal"]).drop("split"), {"acctbal"}, 6)


@query("scale_yeojohnson_fit")
def scale_yeojohnson_fit(spark, sf):
    """Lambda per fit and column, then the standardised transform of every training row under its fold's fit."""
    _, train = frames(spark, sf)
    cols = ["acctbal", "sum_qty", "max_price"]
    folds = materialize(S.kfold(train.select("row_id", *cols), "row_id", 5), "folds")
    lam = L.power_table(spark, L.fit_power(folds, cols, "fold", 5))
    return L.apply_yeo_johnson(folds, lam, cols, "fold")


@query("tf_boxcox1p", f"select event_id, {rnd('(power(1 + value, 0.15) - 1) / 0.15', 6)} as z from events")
def tf_boxcox1p(spark, sf):
    return table(spark, sf, "events").select("event_id", rnd_col(X.boxcox1p(F.col("value"), X.BOXCOX_LAMBDA), 6).alias("z"))


@query("tf_boxcox1p_fit")
def tf_boxcox1p_fit(spark, sf):
    events = table(spark, sf, "events")
    lam = L.fit_power(events, ["value"], method="boxcox1p")[(0, "value")]
    return events.select("event_id", X.boxcox1p(F.col("value"), lam).alias("z"))




@query("tf_log_skewed", f"""with t as (select event_id, value, value * value as squared, cast(event_id as double) as id_copy from events),
    k as (select abs(skewness(value)) > 0.5 as a, abs(skewness(squared)) > 0.5 as b, abs(skewness(id_copy)) > 0.5 as c from t)
    select event_id, {rnd('case when a then ln(1 + value) else value end', 6)} as value, {rnd('case when b then ln(1 + squared) else squared end', 6)} as squared,
      {rnd('case when c then ln(1 + id_copy) else id_copy end', 6)} as id_copy from t, k""")
def tf_log_skewed(spark, sf):
    cols = ["value", "squared", "id_copy"]
    t = table(spark, sf, "events").select("event_id", "value", (F.col("value") * F.col("value")).alias("squared"), F.col("event_id").cast("double").alias("id_copy"))
    skewed = L.skewed_columns(t, cols, 0.5)
    return rounded(t.withColumns({c: F.log1p(c) for c in skewed}), set(cols), 6)


@query("tf_fix_skewness")
def tf_fix_skewness(spark, sf):
    """Same gate, fitted Box-Cox of 1 + x on the columns that pass it."""
    frame, _ = frames(spark, sf)
    cols = ["sum_qty", "max_price", "qty_outlier"]
    rows = frame.select("row_id", *cols)
    skewed = L.skewed_columns(rows, cols, 0.5)
    lam = L.fit_power(rows, skewed, method="boxcox1p") if skewed else {}
    return rows.withColumns({c: X.boxcox1p(F.col(c), lam[(0, c)]) for c in skewed})


@query("target_transform", f"""{OF} select row_id, {rnd('ln(1 + target)', 6)} as z_log, {rnd('(power(1 + target, 0.15) - 1) / 0.15', 6)} as z_boxcox,
    {rnd('target', 6)} as z_none, {rnd('target', 6)} as back_log, {rnd('target', 6)} as back_boxcox, {rnd(_yj('target', 0.2), 6)} as z_yeojohnson,
    {rnd('target', 6)} as back_yeojohnson from tr""")
def target_transform(spark, sf):
    _, train = frames(spark, sf)
    y = F.col("target")
    pairs = {m: X.target_pair(m) for m in ("log", "boxcox", "none")} | {"yeojohnson": X.target_pair("yeojohnson", 0.2)}
    out = train.select("row_id", *[rnd_col(f(y), 6).alias(f"z_{m}") for m, (f, _) in pairs.items()],
                       *[rnd_col(g(f(y)), 6).alias(f"back_{m}") for m, (f, g) in pairs.items() if m != "none"])
    return out


@query("target_transform_quantile", f"""{OF}, q as (select unnest(range(1000)) as i),
    v as (select i / 999.0 as p, (select list(target order by target) from tr where target is not null) as a, i from q),
    r as (select p, a[cast(floor(p * (len(a) - 1)) as bigint) + 1] + (p * (len(a) - 1) - floor(p * (len(a) - 1)))
        * (a[least(cast(floor(p * (len(a) - 1)) as bigint) + 2, len(a))] - a[cast(floor(p * (len(a) - 1)) as bigint) + 1]) as v from v)
    select count(*) as n_quantiles, {rnd('min(v)')} as lo, {rnd('max(v)')} as hi, {rnd('sum(v) / 1000')} as mean from r""")
def target_transform_quantile(spark, sf):
    _, train = frames(spark, sf)
    q = L.fit_target_quantiles(train, "target")
    out = q.agg(F.count("*").alias("n_quantiles"), F.min("value").alias("lo"), F.max("value").alias("hi"), (F.sum("value") / 1000).alias("mean"))
    return rounded(out, {"lo", "hi", "mean"})


@query("target_quantile_apply")
def target_quantile_apply(spark, sf):
    _, train = frames(spark, sf)
    table_ = L.fit_target_quantiles(train, "target")
    return L.quantile_transform(train.select("row_id", "target"), "target", table_, "z")
