from pyspark.sql import functions as F

from tabwright.llm import mixing

SCHEMA = "doc_id long, text string, source string, mix_size string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _water(sizes, weights, cap=3):
    """Repeated resharing, as the definition says it."""
    total, capped = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left, w = total - sum(capped.values()), sum(weights[i] for i in free)
        goal = {i: left * weights[i] / w for i in free}
        over = [i for i in free if goal[i] > cap * sizes[i] + 1e-9]
        if not over:
            return [capped.get(i, goal.get(i)) for i in range(len(sizes))]
        capped |= {i: float(cap * sizes[i]) for i in over}


def test_budgets_are_used_exactly(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), ["a", "b", "c", None][0 if i % 3 else i % 4], "x") for i in range(400)]
    got = mixing.mix(_rows(spark, rows)).select("doc_id", "source", "text", F.col("mix_target").alias("t"), "mix_taken").collect()
    names = sorted({r["source"] for r in got if r["source"]}) + [None]
    sizes = [sum(len(r["text"].split()) for r in got if r["source"] == s) for s in names]
    goal = _water(sizes, [1, 2, 3, 1][: len(names)])
    for s, size, want in zip(names, sizes, goal):
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["t"] - want) < 1e-6 for r in mine)
        assert sum(r["mix_taken"] for r in mine) == min(int(want + 0.5), 3 * size)
        assert all(r["mix_taken"] <= 3 * len(r["text"].split()) for r in mine)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, "", "a", ""), (2, "a b", "a", ""), (2, "a b", "a", ""), (3, " \t\n", "b", ""), (4, "x " * 50_000, "b", "")]
    df = _rows(spark, rows).withColumn("key", F.lit(1)).drop("mix_size")
    got = mixing.mix(df).collect()
    assert len(got) == 6 and "key" in got[0].asDict()
    assert sorted(r["mix_size"] for r in got) == [0, 0, 0, 2, 2, 50_000]
    assert all(r["mix_taken"] == 0 for r in got if r["mix_size"] == 0)
    again = mixing.mix(df.repartition(5)).select("doc_id", "mix_taken")
    assert sorted(again.collect(), key=str) == sorted(mixing.mix(df).select("doc_id", "mix_taken").collect(), key=str)
    assert mixing.mix(_rows(spark, []).drop("mix_size")).count() == 0
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and {r["text"] for r in mixed.collect()} <= {r[1] for r in rows}


def test_clashing_names(spark):
    names = ["target", "epochs", "source_size", "cut_key", "cut_size", "cut_words", "key", "size", "span", "weight", "level", *mixing.RESULTS]
    df = _rows(spark, [(i, "w " * (1 + i % 5), "ab"[i % 2], "x") for i in range(60)])
    wide = df.select("doc_id", "text", "source", *[F.lit(n).alias(n) for n in names])
    plain = sorted(mixing.mix(df).select("doc_id", *mixing.RESULTS).collect())
    out = mixing.mix(wide)
    assert out.columns == ["doc_id", "text", "source", *names]
    assert sorted(out.select("doc_id", *mixing.RESULTS).collect()) == plain
    mixed = mixing.mixed_documents(wide)
    assert mixed.columns == wide.columns and {r["mix_taken"] for r in mixed.collect()} == {"mix_taken"}
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in mixing.mixed_documents(df).collect())
