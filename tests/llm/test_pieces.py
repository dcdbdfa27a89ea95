import random

import public_tokenizers
import pytest
import sentencepiece

from tabwright.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


def _all(model, text, limit=4000):
    """Every segmentation with its score, by recursion."""
    if not text:
        return [(0.0, [])]
    out = []
    for j in range(1, min(len(text), model.longest) + 1):
        known = model.pieces.get(text[:j]) or ((-1, model.unknown) if j == 1 else None)
        if known:
            ids = [known[0]] if known[0] >= 0 else [model.byte_ids[b] for b in text[0].encode()]
            out += [(known[1] + s, ids + rest) for s, rest in _all(model, text[j:])]
    return out


def test_n_best_equals_enumeration(spark, model):
    rng = random.Random(2)
    texts = ["", "a", "the cat", "in on", " x", "é\n漢", "😀a", "aa  b"]
    texts += ["".join(rng.choice("the inorsa\né") for _ in range(rng.randrange(1, 11))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, piece_ids string")
    for r in pieces.encode(df, model, 4).collect():
        text = texts[r["doc_id"]]
        want = sorted((s for s, _ in _all(model, pieces.SPACE + text.replace(" ", pieces.SPACE))), reverse=True)[:4] if text else [0.0]
        got = [(r["piece_score"], r["piece_ids"])]
        for x in r["piece_nbest"]:
            ids = list(r["piece_ids"])
            for e in sorted(x["edits"], key=lambda e: -e["start"]):
                ids[e["start"] : e["start"] + e["drop"]] = e["ids"]
            got.append((x["score"], ids))
        assert [s for s, _ in got] == pytest.approx(want), text
        assert len({tuple(i) for _, i in got}) == len(got)
        for s, ids in got:
            assert b"".join(model.surface[i] for i in ids).decode() == (" " + text if text else "")
            assert (s, ids) in [(pytest.approx(a), b) for a, b in _all(model, pieces.SPACE + text.replace(" ", pieces.SPACE))] or not text


def test_round_trip_and_library_decoder(spark, sf, model, text_rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts = [*text_rows, "▁ mark", *docs]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pieces.decode(pieces.encode(df, model), model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = (texts[r["doc_id"]] or "").replace(pieces.SPACE, " ")
        assert r["decoded"] == text and sp.decode(list(r["piece_ids"])) == text
    assert all(r["round_trip"] for r in pieces.digest(df, model).collect())


def test_merges_give_no_better_score(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for word in ("▁the", "▁international", "▁xylophone", "▁über"):
        ids, score, _ = pieces.solve(model, [word])[0]
        assert score >= sum(sp.get_score(i) for i in sp.encode(word[1:]))
        assert pieces.n_best(model, word, 1)[0][0] == pytest.approx(score)


def test_empty_table(spark, model):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.digest(df, model).count() == 0
    assert pieces.digest(spark.createDataFrame([(None, None)], "doc_id long, text string"), model).collect()[0]["n_pieces"] == 0
