import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import fim


def brute(key, text):
    text = text or ""
    t = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'null' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(t) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(t), "plain", None, None, text
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if h[3] % 100 < 80:
        return len(t), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(text_rows):
    odd = ["<P>", "a <M> b", "<", "<P", "P>", "a<", "<S <M", "><", "<<P>>", "é<P", " \n a", "a \n", "\x0b\x1c x", "a b c", "漢字 かな " * 9]
    return [*text_rows, *odd]


def test_equals_brute_force(spark, sf, text_rows):
    real = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    rows = [(i, t) for i, t in enumerate([*texts(text_rows) * 8, *real])] + [(None, "a b c"), (7, "x y"), (7, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = fim.restore(fim.fill_in_middle(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["fim_n"], r["fim_form"], r["fim_prefix_chars"], r["fim_middle_chars"], r["fim_output"]) == brute(r["doc_id"], r["text"])
        assert r["fim_restored"] == (r["text"] or "")
    assert {r["fim_form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_scatter_and_gather_over_block_borders(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    rng = random.Random(4)
    rows = ["".join(rng.choice(["a", "é", " ", "\n", "<", ">", "P", "漢"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    parts = [t.encode() for t in rows]
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.r_[0, np.cumsum([len(p) for p in parts])]
    draws = np.array([[int(x, 16) for x in re.findall(".{8}", hashlib.sha256(f"42:{i}".encode()).hexdigest())[:4]] for i in range(len(rows))])
    n, form, prefix, middle, out, outs = fim.transformed(data, begins, draws)
    for i, t in enumerate(rows):
        want = brute(i, t)
        assert (n[i], fim.FORMS[form[i]], out[outs[i] : outs[i + 1]].tobytes().decode()) == (want[0], want[1], want[4])
        assert want[2] is None or (prefix[i], middle[i]) == want[2:4]
    back, at = fim.gather(out, outs, form)
    assert back.tobytes() == data.tobytes() and (at == begins).all()


def test_names_types_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "x", [1], None), (2, None, "y", None, 2.5)], "doc_id long, text string, fim_form string, __text array<int>, `odd name` double")
    out = fim.restore(fim.fill_in_middle(df))
    assert out.columns == ["doc_id", "text", "__text", "odd name", *fim.RESULTS, "fim_restored"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["__text"] == [1] and rows[2]["odd name"] == 2.5 and rows[2]["fim_output"] == "" and rows[2]["fim_n"] == 0
    assert fim.restore(fim.fill_in_middle(df.limit(0))).count() == 0


def test_restore_takes_output_and_form_only(spark):
    rows = [("<P>ab<S>cd<M>e", "psm"), ("<S><P><M>", "spm"), ("<S>x", "plain"), (None, "psm"), ("<P>x", None)]
    df = spark.createDataFrame(rows[:3] + [(None, "plain"), rows[4]], "fim_output string, fim_form string")
    assert [r["fim_restored"] for r in fim.restore(df).collect()] == ["abecd", "", "<S>x", None, "<P>x"]
    bad = spark.createDataFrame([("<P>x<S>y", "psm")], "fim_output string, fim_form string")
    with pytest.raises(Exception, match="each mark once"):
        fim.restore(bad).select(F.sum(F.length("fim_restored"))).collect()
