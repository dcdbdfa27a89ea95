"""Queries: projections, filters, registry, alignment joins and unions."""

from pyspark.sql import functions as F

from tabwright.operators import shape as S
from tabwright.operators.profile import schema_report
from tabwright.operators.select import correlated_columns
from tabwright.plans.registry import query, rnd, rnd_col, rounded, union_sql
from tabwright.sources.tables import ORDER_FRAME_SQL, order_frame, staged_order_frame, table

OF = f"with {ORDER_FRAME_SQL}"
ASIDE = ["row_id", "split", "target"]
ORDINAL = ["priority", "rating_absent", "n_lines"]


@query("proj_drop", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def proj_drop(spark, sf):
    return table(spark, sf, "orders").drop("o_orderdate", "o_orderpriority", "not_a_column")


@query("proj_near_duplicate", f"{OF} select row_id, n_lines, sum_qty from order_frame")
def proj_near_duplicate(spark, sf):
    frame = staged_order_frame(spark, sf)
    named = frame.select("row_id", "n_lines", "sum_qty", (2 * F.col("sum_qty")).alias("qty_twice"))
    dup = correlated_columns(named, ["n_lines", "sum_qty", "qty_twice"], 0.95)
    return S.drop_listed(named, dup)


def _nc_sql(src, cols, share, null_value):
    def one(c):
        rows = f"select {c}, count(*) as n from {src} " + ("" if null_value else f"where {c} is not null ") + f"group by {c}"
        return f"select '{c}' as \"column\", max(n) / cast({share.format(c=c)} as double) as share from ({rows})"
    return union_sql(one(c) for c in cols)


_NC = ["row_id", "split", "status", "priority", "month_code", "order_year", "since_year", "segment", "nation", "acctbal", "n_lines",
       "sum_qty", "n_returned", "max_price", "segment_gap", "rating_absent", "near_const", "qty_outlier", "target"]


@query("proj_near_constant", f"""{OF} select "column", {rnd('share', 6)} as share from (
    {_nc_sql('order_frame', _NC, '(select count(*) from order_frame)', True)}) where share > 0.95""")
def proj_near_constant(spark, sf):
    return rounded(S.near_constant(order_frame(spark, sf).select(_NC), 0.95), {"share"}, 6)


@query("proj_near_constant_nonnull", f"""{OF} select "column", {rnd('share', 6)} as share from (
    {_nc_sql('order_frame', _NC, '(select count({c}) from order_frame)', False)}) where share > 0.2""")
def proj_near_constant_nonnull(spark, sf):
    return rounded(S.near_constant(order_frame(spark, sf).select(_NC), 0.2, null_is_value=False), {"share"}, 6)


@query("proj_near_constant_rows", f"""{OF} select "column", {rnd('share', 6)} as share from (
    {_nc_sql('order_frame', _NC, '(select count(*) from order_frame)', False)}) where share > 0.05""")
def proj_near_constant_rows(spark, sf):
    return rounded(S.near_constant(order_frame(spark, sf).select(_NC), 0.05, False, True), {"share"}, 6)


@query("proj_high_missing", f"""{OF} select row_id, max_price, sum_qty from order_frame where max_price is not null""")
def proj_high_missing(spark, sf):
    frame = staged_order_frame(spark, sf).select("row_id", "rating_absent", "max_price", "sum_qty")
    half = frame.count() // 2
    return S.drop_high_missing(frame, half, ["max_price"])


@query("proj_rare_dummy", f"""{OF}, u as (select 'near_const' as "column", near_const as value, split from order_frame
      union all select 'month_tag', case when month_code = 2 and split = 'train' then 'only_train' else 'm' || (month_code % 3) end, split from order_frame),
    p as (select "column", value, cast(sum(case when split = 'train' then 1 else 0 end) as bigint) as n_train,
      cast(sum(case when split = 'test' then 1 else 0 end) as bigint) as n_test from u group by 1, 2)
    select *, case when n_test = 0 then 'absent in test' when n_train = 0 then 'absent in train' else 'rare in train' end as reason
    from p where n_test = 0 or n_train = 0 or n_train < 1000""")
def proj_rare_dummy(spark, sf):
    tag = F.when((F.col("month_code") == 2) & (F.col("split") == "train"), "only_train").otherwise(
        F.concat(F.lit("m"), (F.col("month_code") % 3).cast("string")))
    frame = order_frame(spark, sf).withColumn("month_tag", tag)
    return S.rare_levels(frame, ["near_const", "month_tag"], "split", 1000)


@query("proj_select_dtype", "select l_quantity, l_extendedprice, l_discount, l_tax from lineitem")
def proj_select_dtype(spark, sf):
    return S.columns_by_class(table(spark, sf, "lineitem"), "fractional")


_GROUPS = {
    "continuous": ["month_code", "order_year", "since_year", "acctbal", "sum_qty", "n_returned", "max_price", "qty_outlier"],
    "categorical": ["status", "segment", "nation", "segment_gap", "near_const"],
    "ordinal": ["priority", "rating_absent", "n_lines"],
}


@query("feature_groups", f"{OF} " + union_sql(
    f"select '{g}' as feature_group, '{c}' as \"column\", count({c}) as non_null from order_frame"
    for g, cols in _GROUPS.items() for c in cols))
def feature_groups(spark, sf):
    frame = order_frame(spark, sf)
    groups = S.feature_groups(frame, ORDINAL, ASIDE).as_frame(spark)
    return groups.join(schema_report(frame).select("column", "non_null"), "column")


@query("registry_verify", f"""{OF} select count(*) as n_rows, cast(16 as integer) as n_registered from order_frame""")
def registry_verify(spark, sf):
    frame = order_frame(spark, sf)
    registry = S.feature_groups(frame, ORDINAL, ASIDE)
    registry.verify(frame)
    return frame.agg(F.count("*").alias("n_rows")).withColumn("n_registered", F.lit(len(registry.columns)))


@query("flt_predicate", "select * from lineitem where l_quantity < 3 and l_discount >= 0.05")
def flt_predicate(spark, sf):
    return table(spark, sf, "lineitem").filter((F.col("l_quantity") < 3) & (F.col("l_discount") >= 0.05))


_LIMITS = {"qty_outlier": 1000, "max_price": 95000, "no_such_column": 5}
_FLAG = "coalesce(qty_outlier > 1000, false) or coalesce(max_price > 95000, false)"


@query("flt_outlier_flag", f"{OF} select row_id from order_frame where {_FLAG}")
def flt_outlier_flag(spark, sf):
    return S.outlier_keys(order_frame(spark, sf), "row_id", _LIMITS)


@query("flt_outlier_train_only", f"{OF} select row_id, split from order_frame where not (split = 'train' and ({_FLAG}))")
def flt_outlier_train_only(spark, sf):
    frame = staged_order_frame(spark, sf)
    return S.drop_train_outliers(frame.select("row_id", "split"), frame, "row_id", _LIMITS)


@query("flt_drop_keys", "select c_custkey, c_acctbal from customer where c_custkey not in (30, 88, 462, 631, 1322)")
def flt_drop_keys(spark, sf):
    return S.drop_keys(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_custkey", [30, 88, 462, 631, 1322])


@query("clip_floor", "select c_custkey, greatest(c_acctbal, 1.0) as clipped from customer")
def clip_floor(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.clip_floor("c_acctbal").alias("clipped"))


@query("join_align", f"{OF} select row_id, sum_qty, {rnd('target')} as target from order_frame where target is not null")
def join_align(spark, sf):
    frame = staged_order_frame(spark, sf)
    target = frame.filter(F.col("target").isNotNull()).select("row_id", rnd_col("target", 4).alias("target"))
    return S.align(frame.select("row_id", "sum_qty"), target, "row_id")


@query("join_semi_split", "select c_custkey, c_mktsegment from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')")
def join_semi_split(spark, sf):
    done = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return S.rows_in(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), done, "c_custkey")


@query("join_anti_test", "select o_orderkey, o_totalprice from orders where o_orderkey not in (select l_orderkey from lineitem)")
def join_anti_test(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return S.rows_not_in(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), lines, "o_orderkey")


@query("join_lookup", f"""{OF}, m as (select segment_gap, avg(acctbal) as v from order_frame
      where split = 'train' and segment_gap <> 'MACHINERY' group by 1)
    select row_id, {rnd('coalesce(m.v, -1.0)')} as looked_up from order_frame o left join m on o.segment_gap = m.segment_gap""")
def join_lookup(spark, sf):
    frame = staged_order_frame(spark, sf)
    means = (frame.filter((F.col("split") == "train") & (F.col("segment_gap") != "MACHINERY"))
             .groupBy("segment_gap").agg(F.avg("acctbal").alias("v")))
    out = S.lookup(frame.select("row_id", "segment_gap"), means, "segment_gap", "v", F.lit(-1.0), "looked_up")
    return rounded(out.drop("segment_gap"), {"looked_up"})


@query("set_union", f"""{OF} select row_id, segment, {rnd('target')} as target, split from order_frame""")
def set_union(spark, sf):
    frame = staged_order_frame(spark, sf).select("row_id", "segment", "target", "split")
    train = frame.filter(F.col("split") == "train")
    test = frame.filter(F.col("split") == "test").select("split", "segment", "row_id")
    return rounded(S.stack(train, test), {"target"})


@query("join_submissions", f"""select o_orderkey as row_id, {rnd('0.5 * o_totalprice + 0.3 * (o_totalprice + 10) + 0.2 * (1.1 * o_totalprice)')} as pred from orders""")
def join_submissions(spark, sf):
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("pred"))
    second = base.withColumn("pred", F.col("pred") + 10)
    third = base.withColumn("pred", F.col("pred") * 1.1)
    return rounded(S.average_predictions([base, second, third], [0.5, 0.3, 0.2], "row_id", "pred"), {"pred"})
