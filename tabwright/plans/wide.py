"""Queries: factors with very many levels."""

from pyspark.sql import functions as F

from tabwright.models.factors import FactorRidge
from tabwright.operators.codes import LevelCodes
from tabwright.plans.registry import query, rnd, rounded
from tabwright.sources.tables import table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("enc_onehot_wide", """with p as (select l_partkey, row_number() over (order by cast(l_partkey as varchar)) - 1 as i from (select distinct l_partkey from lineitem)),
  s as (select l_suppkey, row_number() over (order by cast(l_suppkey as varchar)) - 1 + (select count(*) from p) as i from (select distinct l_suppkey from lineitem))
  select l_orderkey, l_linenumber, l.l_partkey, l.l_suppkey, cast(p.i as bigint) as part_index, cast(s.i as bigint) as supp_index, cast(2 as int) as entries
  from lineitem l join p on p.l_partkey = l.l_partkey join s on s.l_suppkey = l.l_suppkey""")
def enc_onehot_wide(spark, sf):
    """One-hot codes of parts and suppliers as (index, value) entries: no column per level, no bound on levels."""
    lines = table(spark, sf, "lineitem").select(*KEYS)
    coded = LevelCodes.fit(lines, ["l_partkey", "l_suppkey"]).entries(lines)
    at = lambda i: F.get("codes", F.lit(i))["index"]
    return coded.select(*KEYS, at(0).alias("part_index"), at(1).alias("supp_index"), F.size("codes").alias("entries"))


@query("model_ridge_wide", f"""with t as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice as y, cast(l_orderkey % 2 as int) as fold from lineitem),
  g as (select f, l_partkey, count(*)::double as n, avg(y) as m from t, (values (0), (1)) fits(f) where fold <> f group by all),
  b as (select f, sum(n / (n + 10) * m) / sum(n / (n + 10)) as b from g group by f)
  select l_orderkey, l_linenumber, t.l_partkey, fold, {rnd('b + coalesce(n / (n + 10) * (m - b), 0)', 3)} as pred
  from t join b on b.f = fold left join g on g.f = fold and g.l_partkey = t.l_partkey""")
def model_ridge_wide(spark, sf):
    """Ridge on one indicator per part, out of fold: sums, weights and the solver's steps stay in rows of the cluster."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("double").alias("y"),
                                                (F.col("l_orderkey") % 2).cast("int").alias("fold"))
    weights = FactorRidge(lines, [], ["l_partkey"], 2, "y", transform="none").fit(10.0)
    out = weights.predict(lines, "pred", ["l_orderkey", "l_linenumber", "l_partkey", "fold"])
    return rounded(out, {"pred"}, 3)
