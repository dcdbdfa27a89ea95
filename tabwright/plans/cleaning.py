"""Queries: recoding, filling, scalar functions and feature construction."""

from pyspark.sql import functions as F

from tabwright.functions import scalar as X
from tabwright.operators import clean as C
from tabwright.operators import shape as S
from tabwright.plans.registry import query, rnd, rnd_col, rounded
from tabwright.sources.tables import ORDER_FRAME_SQL, order_frame, staged_order_frame, table

OF = f"with {ORDER_FRAME_SQL}"
MONTHS = dict(enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov".split(), 1))  # December stays a number
PRIORITY = {"5-LOW": 1, "4-NOT SPECIFIED": 2, "3-MEDIUM": 3, "2-HIGH": 4, "1-URGENT": 5}


def _case(col, values):
    quote = lambda v: f"'{v}'" if isinstance(v, str) else v
    return f"case {col} " + " ".join(f"when {quote(k)} then {quote(v)}" for k, v in values.items())


@query("recode_nominal", f"{OF} select row_id, {_case('month_code', MONTHS)} else cast(month_code as varchar) end as month_code from order_frame")
def recode_nominal(spark, sf):
    return C.recode_nominal(order_frame(spark, sf).select("row_id", "month_code"), {"month_code": MONTHS})


@query("recode_ordinal", f"""{OF} select row_id, {_case('priority', PRIORITY)} end as priority,
    case when rating_absent is null then 0 else {_case('rating_absent', PRIORITY)} end end as rating_absent from order_frame""")
def recode_ordinal(spark, sf):
    frame = order_frame(spark, sf).select("row_id", "priority", "rating_absent")
    return C.recode_ordinal(frame, {"priority": PRIORITY, "rating_absent": {None: 0, **PRIORITY}}, strict=True)


@query("recode_map_strict", """select p_partkey, case p_type when 'ECONOMY' then 1 when 'PROMO' then 2 end as code from part""")
def recode_map_strict(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.recode_strict("p_type", {"ECONOMY": 1, "PROMO": 2}).alias("code"))


@query("recode_merge_levels", """select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'high'
    when o_orderpriority = '3-MEDIUM' then 'mid' else 'low' end as level from orders""")
def recode_merge_levels(spark, sf):
    merged = C.merge_levels("o_orderpriority", {"high": ["1-URGENT", "2-HIGH"], "mid": ["3-MEDIUM"]}, "low")
    return table(spark, sf, "orders").select("o_orderkey", merged.alias("level"))


@query("recode_by_target_order", f"""{OF}, m as (select nation, avg(target) as mean from order_frame where target is not null group by 1),
    r as (select nation, row_number() over (order by mean, nation) as code from m)
    select row_id, r.code from order_frame left join r using (nation)""")
def recode_by_target_order(spark, sf):
    frame = staged_order_frame(spark, sf)
    codes = C.order_by_target(frame.filter(F.col("split") == "train"), "nation", "target").select("nation", "code")
    return frame.select("row_id", "nation").join(codes, "nation", "left").select("row_id", F.col("code").cast("bigint").alias("code"))


@query("fill_absent", f"{OF} select row_id, coalesce(segment_gap, 'None') as segment_gap, coalesce(rating_absent, 'None') as rating_absent from order_frame")
def fill_absent(spark, sf):
    frame = order_frame(spark, sf).select("row_id", "segment_gap", "rating_absent")
    return C.fill_absent(frame, ["segment_gap", "rating_absent", "not_there"])


@query("fill_const", f"""{OF} select row_id, coalesce(sum_qty, 0) as sum_qty, coalesce(max_price, -1) as max_price,
    coalesce(segment_gap, 'No') as segment_gap from order_frame""")
def fill_const(spark, sf):
    frame = order_frame(spark, sf).select("row_id", "sum_qty", "max_price", "segment_gap")
    return C.fill_constants(frame, {"sum_qty": 0, "max_price": -1, "segment_gap": "No"})


@query("fill_const_by_type", f"""{OF} select row_id, coalesce(sum_qty, 0) as sum_qty, coalesce(n_lines, 0) as n_lines,
    coalesce(rating_absent, 'None') as rating_absent from order_frame""")
def fill_const_by_type(spark, sf):
    return C.fill_by_type(order_frame(spark, sf).select("row_id", "sum_qty", "n_lines", "rating_absent"))


@query("fill_from_column", f"{OF} select row_id, coalesce(max_price, acctbal) as max_price from order_frame")
def fill_from_column(spark, sf):
    return C.fill_from(order_frame(spark, sf), "max_price", "acctbal").select("row_id", "max_price")


@query("update_cells", """select c_custkey, case c_custkey when 7 then 100.5 when 12 then -3.0 else c_acctbal end as c_acctbal,
    case c_custkey when 7 then 'FIXED' else c_mktsegment end as c_mktsegment from customer""")
def update_cells(spark, sf):
    frame = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return C.update_cells(frame, "c_custkey", {7: {"c_acctbal": 100.5, "c_mktsegment": "FIXED"}, 12: {"c_acctbal": -3.0}})


@query("update_cells_table", """select o.o_orderkey, coalesce(case when l.late > 0 then 'LATE' end, o.o_orderstatus) as o_orderstatus
    from orders o left join (select l_orderkey, count(*) as late from lineitem where l_quantity > 49 group by 1) l
    on o.o_orderkey = l.l_orderkey""")
def update_cells_table(spark, sf):
    edits = (table(spark, sf, "lineitem").filter("l_quantity > 49")
             .select(F.col("l_orderkey").alias("o_orderkey"), F.lit("o_orderstatus").alias("column"), F.lit("LATE").alias("value")))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return C.update_cells_from(orders, "o_orderkey", edits, ["o_orderstatus"])


_MATH = {
    "f_log1p": ("ln(1 + v)", F.log1p), "f_log": ("ln(v)", F.log), "f_exp": ("exp(v / 100)", lambda v: F.exp(v / 100)),
    "f_expm1": ("exp(v / 100) - 1", lambda v: F.expm1(v / 100)), "f_sqrt": ("sqrt(v)", F.sqrt),
    "f_sq": ("v * v", lambda v: v * v), "f_cu": ("power(v, 3)", lambda v: F.pow(v, F.lit(3))),
    "f_abs": ("abs(v - 20)", lambda v: F.abs(v - 20)),
}


@query("fn_math", "select event_id, " + ", ".join(f"{rnd(s.replace('v', 'value'), 6)} as {n}" for n, (s, _) in _MATH.items())
       + ", cast(floor(value) as bigint) as f_floor, round(value, 1) as f_round from events")
def fn_math(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", *[rnd_col(f(v), 6).alias(n) for n, (_, f) in _MATH.items()],
        F.floor(v).alias("f_floor"), F.round(v, 1).alias("f_round"))


@query("fn_string", "select p_partkey, lower(p_type) as p_type, cast(p_size as varchar) as p_size from part")
def fn_string(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.lower("p_type").alias("p_type"), F.col("p_size").cast("string").alias("p_size"))


@query("fn_boolean_flag", f"""{OF} select row_id, case when n_returned > 0 then 1 else 0 end as has_return,
    case when order_year = 1997 then 1 else 0 end as is_1997,
    case when month_code in (5, 6, 7) then 1 else 0 end as season from order_frame""")
def fn_boolean_flag(spark, sf):
    return order_frame(spark, sf).select(
        "row_id", X.flag(F.col("n_returned") > 0).alias("has_return"), X.flag(F.col("order_year") == 1997).alias("is_1997"),
        X.flag(F.col("month_code").isin(5, 6, 7)).alias("season"))


@query("fn_cond_transform", f"{OF} select row_id, {rnd('case when sum_qty > 20 then ln(sum_qty) else sum_qty end', 6)} as qty from order_frame")
def fn_cond_transform(spark, sf):
    q = F.col("sum_qty")
    return order_frame(spark, sf).select("row_id", rnd_col(X.log_where(q, q > 20), 6).alias("qty"))


# Feature construction


@query("ft_sum_present", f"""{OF} select row_id, {rnd('coalesce(sum_qty, 0) + coalesce(n_lines, 0) + coalesce(max_price, 0)')} as total from order_frame""")
def ft_sum_present(spark, sf):
    frame = order_frame(spark, sf)
    return frame.select("row_id", rnd_col(C.sum_present(frame, ["sum_qty", "n_lines", "max_price", "gone"]), 4).alias("total"))


@query("ft_weighted_sum", f"""{OF} select row_id, {rnd('1.0 * n_lines + 0.5 * n_returned + 2.0 * max_price')} as total from order_frame""")
def ft_weighted_sum(spark, sf):
    return order_frame(spark, sf).select(
        "row_id", rnd_col(C.weighted_sum({"n_lines": 1.0, "n_returned": 0.5, "max_price": 2.0}), 4).alias("total"))


@query("ft_difference", f"{OF} select row_id, order_year - since_year as age from order_frame")
def ft_difference(spark, sf):
    return order_frame(spark, sf).select("row_id", C.difference("order_year", "since_year").alias("age"))


_SUMS = {"total_lines": ["n_lines", "n_returned"]}
_WEIGHTED = {"qty_mix": {"sum_qty": 1.0, "qty_outlier": 0.5}}
_DIFFS = {"age": ("order_year", "since_year")}


@query("ft_consume", f"""{OF} select row_id, split, segment, acctbal, max_price,
    cast(coalesce(n_lines, 0) + coalesce(n_returned, 0) as double) as total_lines,
    sum_qty + 0.5 * qty_outlier as qty_mix, order_year - since_year as age from order_frame""")
def ft_consume(spark, sf):
    frame = order_frame(spark, sf).select(
        "row_id", "split", "segment", "acctbal", "max_price", "n_lines", "n_returned", "sum_qty", "qty_outlier",
        "order_year", "since_year")
    registry = S.feature_groups(frame, [], ["row_id", "split"])
    return C.engineer(frame, registry, _SUMS, _WEIGHTED, _DIFFS)[0]


@query("ft_plain_sum", "select l_orderkey, l_linenumber, round(l_quantity + l_tax + l_discount, 4) as s from lineitem")
def ft_plain_sum(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_quantity") + F.col("l_tax") + F.col("l_discount"), 4).alias("s"))


@query("ft_product", f"""{OF} select row_id, n_lines * n_returned as score, {rnd('sum_qty * max_price')} as worth from order_frame""")
def ft_product(spark, sf):
    return order_frame(spark, sf).select(
        "row_id", (F.col("n_lines") * F.col("n_returned")).alias("score"), rnd_col(F.col("sum_qty") * F.col("max_price"), 4).alias("worth"))


@query("ft_polynomial", "select event_id, " + ", ".join([
    f"{rnd('value * value')} as value_sq", f"{rnd('value * value * value')} as value_cu", f"{rnd('sqrt(value)')} as value_rt"]) + " from events")
def ft_polynomial(spark, sf):
    out = C.polynomial(table(spark, sf, "events").select("event_id", "value"), ["value"]).drop("value")
    return rounded(out, {"value_sq", "value_cu", "value_rt"})


@query("ft_has", f"{OF} select row_id, case when max_price > 0 then 1 else 0 end as has_price, case when rating_absent is not null then 1 else 0 end as has_rating from order_frame")
def ft_has(spark, sf):
    return order_frame(spark, sf).select(
        "row_id", X.flag(F.col("max_price") > 0).alias("has_price"), X.flag(F.col("rating_absent").isNotNull()).alias("has_rating"))


_BIN = "case when mean < 20600 then 'poor' when mean < 21000 then 'mid' else 'rich' end"


@query("ft_bin_levels", f"""{OF}, m as (select nation, avg(target) as mean from order_frame where target is not null group by 1)
    select row_id, {_BIN} as bin from order_frame join m using (nation)""")
def ft_bin_levels(spark, sf):
    frame = staged_order_frame(spark, sf)
    bins = C.levels_by_target(frame, "nation", "target", [(20600, "poor"), (21000, "mid")], "rich")
    return S.lookup(frame.select("row_id", "nation"), bins, "nation", "bin", F.lit(None), "bin").select("row_id", "bin")
