import functools
import re
from collections import Counter

import corpus_pipeline as pipeline
import pytest
from tabwright.llm import bytenet, mixing, pieces

from tests.llm.test_jaccard import brute
from tests.llm.test_pii import base_spans

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")

    good = pipeline.quality(spark, docs, SF)
    assert good.columns == columns
    scores = {r["doc_id"]: r["quality_score"] for r in bytenet.score(docs, bytenet.train(docs, labels)).collect()}
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    assert set(kept) == {k for k, s in scores.items() if s >= 0.7}

    single = pipeline.near_duplicates(spark, good, SF)
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(k for k, _, c in brute(list(kept.items())) if k == c)

    clean = pipeline.private_data(spark, single, SF)
    assert clean.columns == columns and clean.count() == single.count()
    for r in clean.collect():
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])

    mixed = pipeline.mixture(spark, clean, SF)
    assert mixed.columns == columns
    taken = {r["doc_id"]: (r["mix_taken"], r["mix_size"]) for r in mixing.mix(clean).collect()}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert copies == Counter({k: int(t / s + 0.5) for k, (t, s) in taken.items() if s})

    coded = pipeline.encoded(spark, mixed, SF).collect()
    assert Counter(r["doc_id"] for r in coded) == copies
    model = pieces.load(pipeline.TOKENIZER)
    pattern = re.compile(model.word)
    best = functools.cache(lambda unit: pieces.n_best(model, unit, 1)[0][0])

    def text_of(ids):
        return b"".join(model.surface[i] for i in ids).decode()

    for r in coded:
        text = " " + r["text"].replace(pieces.SPACE, " ")
        assert r["piece_round_trip"] and text_of(r["piece_ids"]) == text
        assert r["piece_score"] == pytest.approx(sum(best(u) for u in pattern.findall(text.replace(" ", pieces.SPACE))))
        assert len(r["piece_nbest"]) == pieces.N_BEST - 1
        for other in r["piece_nbest"]:
            ids = list(r["piece_ids"])
            for e in sorted(other["edits"], key=lambda e: -e["start"]):
                ids[e["start"] : e["start"] + e["drop"]] = e["ids"]
            assert other["score"] <= r["piece_score"] and ids != r["piece_ids"] and text_of(ids) == text


def test_run_equals_the_stages_and_survives_odd_rows(spark, text_rows):
    rows = pipeline.run(spark, SF)
    assert rows.count() > 0 and {"doc_id", "text", "piece_ids", "piece_score"} <= set(rows.columns)
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(text_rows)] + [(None,) * 5],
                                "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (odd, odd.limit(0)):
        docs = frame
        for name, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name == "quality classifier":
                docs = frame  # the odd texts go on to the other stages whatever their quality
        assert docs.count() >= 0
