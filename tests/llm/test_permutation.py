import math

import numpy as np
import pytest

from tabwright.llm import permutation


def _brute(rows, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            found = sorted((-float((w * v).sum()), j) for j, w in good if j != i)
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    got = _found(permutation.query(spark, sf))
    want = _brute([(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in got)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.95
    exact = {q: dict(v) for q, v in want.items()}
    assert all(s == pytest.approx(exact[q][i], abs=1e-12) for q in got for i, s in got[q] if i in exact[q])


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(50)]
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0]), (260, [float("nan"), 1.0, 0.0, 0.0]), (280, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [rows[3], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = _found(permutation.search(df, df.filter("vec_id % 20 = 0"), share=1.0))
    distinct = list({(i, tuple(v) if v else None): (i, v) for i, v in rows}.values())
    want = _brute(distinct)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    few = df.filter("vec_id < 5 or vec_id = 20")
    assert {q: len(v) for q, v in _found(permutation.search(few, few.filter("vec_id % 20 = 0"))).items()} == {0: 5, 20: 5}
    assert permutation.search(df.limit(0), df.limit(0)).count() == 0
    other = [(400, [1.0, 2.0]), (401, [3.0, 1.0]), (402, [0.0, 2.0]), (420, [1.0, 2.0]), (440, [5.0])]
    wide = df.union(spark.createDataFrame(other, "vec_id long, embedding array<float>"))
    mixed = _found(permutation.search(wide, wide.filter("vec_id % 20 = 0"), share=1.0))
    assert [i for i, _ in mixed[400]] == [401, 420, 402] and [i for i, _ in mixed[420]] == [400, 401, 402]
    assert 440 not in mixed and all([i for i, _ in mixed[q]] == [i for i, _ in want[q]] for q in want)


def test_footrule_order():
    rng = np.random.default_rng(9)
    x, pivots = rng.normal(size=(200, 8)), rng.normal(size=(12, 8))
    index = permutation.Index(np.arange(200), x, pivots, 5, 3)
    near = permutation.Index.nearest(index.vectors, pivots, 5)
    place = np.full((200, 12), 5)
    np.put_along_axis(place, near, np.arange(5)[None], axis=1)
    q = near[7]
    foot = np.abs(place - place[7]).sum(axis=1)
    sums = np.minimum(index.postings[q], np.arange(5, 0, -1)[:, None]).sum(axis=0)
    assert (foot == foot[7] + 2 * (sums[7] - sums)).all()


def test_exact_scores_only_for_close_vectors():
    """Most of the share that the footrule leaves is dismissed by one product; results are those of scoring it all."""
    multiplied = []

    class Counted(np.ndarray):
        def __array_ufunc__(self, ufunc, method, *inputs, **kwargs):
            plain = [np.asarray(x) for x in inputs]
            if ufunc is np.multiply:
                multiplied.append(plain[0].size)
            return getattr(ufunc, method)(*plain, **kwargs)

    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(1500, 16)), 1)
    x[40:60] = x[20:40]
    x[:, 0] += (x == 0).all(axis=1)
    points = np.unique(x[200:264], axis=0)
    index = permutation.Index(np.arange(1500), x, points, 32, 20)
    index.vectors = index.vectors.view(Counted)
    near = permutation.Index.nearest(x[:50], points, 32)
    for i in range(50):
        ids, scores = index.search(i, x[i], near[i], 0.2, 256)
        weight = np.arange(32, 0, -1)[:, None]
        sums = np.minimum(index.postings[near[i]], weight).sum(axis=0)
        taken = np.lexsort((index.smallest, -sums))[:300]
        rows = [(-s, k) for v, s in zip(taken, (np.asarray(index.vectors)[taken] * x[i]).sum(axis=1))
                for k in index.ids[index.start[v] : index.start[v] + index.count[v]] if k != i]
        assert [(-s, k) for k, s in zip(ids, scores)] == sorted(rows)[:20]
    assert 0 < sum(multiplied) < 50 * 60 * 16
