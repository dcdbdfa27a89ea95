"""Queries: profiling and data quality."""

from pyspark.sql import functions as F

from tabwright.functions.order import value_counts
from tabwright.operators import profile as P
from tabwright.plans.registry import query, rnd, rounded, union_sql
from tabwright.sources.tables import DOC_FRAME_SQL, ORDER_FRAME_SQL, doc_frame, order_frame, staged_order_frame, table

OF = f"with {ORDER_FRAME_SQL}"
NUM = ["acctbal", "n_lines", "sum_qty", "max_price", "target"]
CAT = ["status", "priority", "segment_gap", "rating_absent", "near_const"]
LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("prof_shape", "select count(*) as n_rows, cast(11 as integer) as n_cols from lineitem")
def prof_shape(spark, sf):
    return P.shape(table(spark, sf, "lineitem"))


_SCHEMA = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
           "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@query("prof_schema", union_sql(
    f"select '{c}' as \"column\", count({c}) as non_null, '{t}' as type from orders" for c, t in _SCHEMA.items()))
def prof_schema(spark, sf):
    return P.schema_report(table(spark, sf, "orders"))


@query("prof_duplicates", """
    select cast(sum(c - 1) as bigint) as duplicates, count(*) as distinct_rows from (
      select count(*) as c from lineitem
      group by l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""")
def prof_duplicates(spark, sf):
    return P.duplicate_rows(table(spark, sf, "lineitem"), key=["l_orderkey"])


@query("prof_dup_keys", """
    select cast(sum(c) as bigint) as n_rows, count(*) as n_keys, cast(sum(c - 1) as bigint) as surplus
    from (select count(*) as c from lineitem group by l_orderkey, l_linenumber)""")
def prof_dup_keys(spark, sf):
    return P.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_OF_COLS = ["row_id", "split", "status", "priority", "month_code", "order_year", "since_year", "segment", "nation",
            "acctbal", "n_lines", "sum_qty", "n_returned", "max_price", "segment_gap", "rating_absent", "near_const",
            "qty_outlier", "target"]


@query("prof_missing", f"{OF} select * from (" + union_sql(
    f"select '{c}' as \"column\", count(*) - count({c}) as n_missing, "
    f"{rnd(f'100.0 * (count(*) - count({c})) / count(*)')} as pct from order_frame" for c in _OF_COLS)
    + ") where n_missing > 0")
def prof_missing(spark, sf):
    return P.missing(order_frame(spark, sf))


@query("prof_missing_pattern", f"""{OF}, m as (select
      case when sum_qty is null then '1' else '0' end || case when max_price is null then '1' else '0' end ||
      case when segment_gap is null then '1' else '0' end || case when rating_absent is null then '1' else '0' end as mask
    from order_frame)
    select mask, count(*) as n, case when mask = '0000' then 'none' when mask = '1111' then 'all' else 'some' end as kind
    from m group by mask""")
def prof_missing_pattern(spark, sf):
    return P.missing_pattern(order_frame(spark, sf), ["sum_qty", "max_price", "segment_gap", "rating_absent"])


_CONST = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
          "l_returnflag", "l_linestatus", "l_shipdate", "one", "none_col"]


@query("prof_constant", f"""with t as (select *, 'x' as one, cast(null as varchar) as none_col from lineitem)
    select * from ({union_sql(f"select '{c}' as \"column\", count(distinct {c}) as n_levels from t" for c in _CONST)})
    where n_levels <= 1""")
def prof_constant(spark, sf):
    lines = table(spark, sf, "lineitem")
    return P.constant_columns(lines.withColumn("one", F.lit("x")).withColumn("none_col", F.lit(None).cast("string")))


_MIXED = {"o_orderpriority": "orders", "key_or_status": "orders"}


@query("prof_mixed_types", f"""with t as (select o_orderpriority,
      case when o_orderstatus = 'F' then cast(o_orderkey as varchar) else o_orderstatus end as key_or_status from orders)
    {union_sql(f'''select '{c}' as "column", count(try_cast({c} as double)) as n_numeric,
      count({c}) - count(try_cast({c} as double)) as n_text,
      count(try_cast({c} as double)) > 0 and count(try_cast({c} as double)) < count({c}) as mixed from t''' for c in _MIXED)}""")
def prof_mixed_types(spark, sf):
    mixed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")).otherwise(F.col("o_orderstatus"))
    return P.mixed_types(table(spark, sf, "orders").select("o_orderpriority", mixed.alias("key_or_status")))


@query("prof_negative", """
    select 'c_acctbal' as "column", cast(sum(case when c_acctbal < 0 then 1 else 0 end) as bigint) as n_negative,
      min(c_acctbal) as lowest from customer having min(c_acctbal) < 0""")
def prof_negative(spark, sf):
    return P.negative_columns(table(spark, sf, "customer"))


@query("prof_levels", """with u as (
      select 'l_quantity' as "column", l_quantity as v from lineitem union all
      select 'l_discount', l_discount from lineitem union all select 'l_linenumber', l_linenumber from lineitem)
    select "column", cast(count(distinct v) as bigint) as n_levels, bool_or(v <> floor(v)) as fractional,
      min(v) as lowest, max(v) as highest from u group by "column" """)
def prof_levels(spark, sf):
    lv = P.levels(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_linenumber"])
    return lv.groupBy("column").agg(
        F.count("*").alias("n_levels"), F.max(~F.col("whole")).alias("fractional"),
        F.min("level").alias("lowest"), F.max("level").alias("highest"))


@query("prof_level_lists", """with u as (
      select 'l_linenumber' as "column", cast(l_linenumber as varchar) as v from lineitem union all
      select 'l_extendedprice', cast(l_extendedprice as varchar) from lineitem union all
      select 'l_shipdate', cast(l_shipdate as varchar) from lineitem union all
      select 'l_returnflag', l_returnflag from lineitem),
    d as (select distinct "column", v, try_cast(v as double) as x from u)
    select "column", row_number() over (partition by "column" order by x, v) as position, x as number,
      case when x is null then v end as level from d""")
def prof_level_lists(spark, sf):
    return P.level_rows(table(spark, sf, "lineitem"), ["l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"])


@query("prof_case", """with t as (select p_brand, case when p_size > 25 then upper(p_type) else lower(p_type) end as p_type from part),
    u as (select 'p_brand' as "column", p_brand as v from t union all select 'p_type', p_type from t)
    select "column", count(distinct v) as n_levels, count(distinct lower(v)) as n_lower,
      count(distinct v) > count(distinct lower(v)) as case_variants from u group by "column" """)
def prof_case(spark, sf):
    kind = F.when(F.col("p_size") > 25, F.upper("p_type")).otherwise(F.lower("p_type"))
    return P.case_variants(table(spark, sf, "part").select("p_brand", kind.alias("p_type")))


@query("prof_cross_col", f"""{OF}
    select 'price without lines' as rule, cast(sum(case when max_price is not null and n_lines is null then 1 else 0 end) as bigint) as n_rows from order_frame
    union all select 'lines without price', cast(sum(case when max_price is null and n_lines > 0 then 1 else 0 end) as bigint) from order_frame
    union all select 'more returned than lines', cast(sum(case when n_returned > n_lines then 1 else 0 end) as bigint) from order_frame
    union all select 'order before customer', cast(sum(case when order_year < since_year then 1 else 0 end) as bigint) from order_frame""")
def prof_cross_col(spark, sf):
    c = F.col
    return P.rule_violations(order_frame(spark, sf), {
        "price without lines": c("max_price").isNotNull() & c("n_lines").isNull(),
        "lines without price": c("max_price").isNull() & (c("n_lines") > 0),
        "more returned than lines": c("n_returned") > c("n_lines"),
        "order before customer": c("order_year") < c("since_year"),
    })


def _describe_sql(src, c):
    q = lambda p: rnd(f"quantile_cont({c}, {p})")
    return (f"select '{c}' as \"column\", count({c}) as n, {rnd(f'avg({c})')} as mean, {rnd(f'stddev_samp({c})')} as std, "
            f"{rnd(f'cast(min({c}) as double)')} as \"min\", {q(0.25)} as q25, {q(0.5)} as q50, {q(0.75)} as q75, "
            f"{rnd(f'cast(max({c}) as double)')} as \"max\" from {src}")


@query("prof_describe_num", f"{OF} " + union_sql(_describe_sql("order_frame", c) for c in NUM))
def prof_describe_num(spark, sf):
    return rounded(P.describe_numeric(staged_order_frame(spark, sf), NUM), {"mean", "std", "min", "q25", "q50", "q75", "max"})


@query("prof_describe_num_lines", union_sql(_describe_sql("lineitem", c) for c in LINE_NUM))
def prof_describe_num_lines(spark, sf):
    return rounded(P.describe_numeric(table(spark, sf, "lineitem"), LINE_NUM),
                    {"mean", "std", "min", "q25", "q50", "q75", "max"})


@query("prof_describe_cat", f"{OF} " + union_sql(
    f"""select * from (select '{c}' as "column", cast(sum(n) over () as bigint) as "count", count(*) over () as "unique",
        {c} as top, n as freq from (select {c}, count(*) as n from order_frame where {c} is not null group by {c})
        order by n desc, {c} limit 1)""" for c in CAT))
def prof_describe_cat(spark, sf):
    return P.describe_categorical(order_frame(spark, sf), CAT)


@query("prof_value_counts", f"""{OF}, u as ({union_sql(f"select '{c}' as \"column\", {c} as value from order_frame" for c in CAT)})
    select "column", value, count(*) as cnt, {rnd('count(*) / sum(count(*)) over (partition by "column")', 8)} as share
    from u group by "column", value""")
def prof_value_counts(spark, sf):
    return rounded(P.frequency(order_frame(spark, sf), CAT, nulls=True), {"share"}, 8)


@query("prof_value_counts_lines", """
    select l_returnflag as value, count(*) as cnt from lineitem group by 1""")
def prof_value_counts_lines(spark, sf):
    return value_counts(table(spark, sf, "lineitem"), ["l_returnflag"]).select("value", "cnt")


@query("prof_group_stat", f"""{OF} select nation, {rnd('avg(target)')} as mean, {rnd('median(target)')} as median,
    count(target) as n from order_frame group by nation""")
def prof_group_stat(spark, sf):
    return rounded(P.group_stat(staged_order_frame(spark, sf), "nation", "target"), {"mean", "median"})


@query("prof_extremes", f"""with z as (select o_orderkey, (o_totalprice - (select avg(o_totalprice) from orders))
      / (select stddev_pop(o_totalprice) from orders) as z, o_totalprice from orders)
    (select o_orderkey, 'low' as tail, {rnd('z', 6)} as z from z order by o_totalprice, o_orderkey limit 10) union all
    (select o_orderkey, 'high' as tail, {rnd('z', 6)} as z from z order by o_totalprice desc, o_orderkey limit 10)""")
def prof_extremes(spark, sf):
    return rounded(P.extremes(table(spark, sf, "orders"), "o_orderkey", "o_totalprice", 10), {"z"}, 6)


@query("prof_top_rows", """select o_orderkey, o_totalprice, o_orderstatus from orders
    order by o_totalprice desc, o_orderkey limit 20""")
def prof_top_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return P.top_rows(orders, "o_totalprice", "o_orderkey", 20)


@query("prof_row_lookup", "select * from customer where c_custkey in (3, 17, 99, 123456789)")
def prof_row_lookup(spark, sf):
    return P.lookup_rows(table(spark, sf, "customer"), "c_custkey", [3, 17, 99, 123456789])


@query("prof_missing_labels", f"""with {DOC_FRAME_SQL} select * from (
    {union_sql(f'''select '{c}' as "column", count(*) - count({c}) as n_missing,
      {rnd(f"100.0 * (count(*) - count({c})) / count(*)")} as pct from doc_frame''' for c in ("lang", "quality", "toxic"))})
    where n_missing > 0""")
def prof_missing_labels(spark, sf):
    return P.missing(doc_frame(spark, sf).select("lang", "quality", "toxic"))
