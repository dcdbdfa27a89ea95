import hashlib
import random
import re

from pyspark.sql import functions as F

from tabwright.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and _luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), no, m.end(), kind))
    return sorted(out)


def _check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.digest(pii.find_spans(df)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = base_spans(text)
        line = [f"{k}:{s}:{e}" for s, _, e, k in want]
        spans = [x for x in got[i]["spans"].split(",") if x]
        assert [x for x in spans if x.split(":")[0] in BASE] == line, repr(text)[:300]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(line).encode()).hexdigest()
        for kind in BASE:
            assert got[i][f"n_{kind}"] == sum(k == kind for *_, k in want)
    return got


def test_base_spans_equal_python(spark, sf, text_rows):
    rng = random.Random(3)
    fixed = ["a@b.c_x@d.e", "a@b@c.d", "x 1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4", "😀 4111 1111-1111 1111 é", "+1 (279) 555-0216, +12", "1" * 5000,
             "a." * 9000, "a@" + "b." * 9000 + "c", "1.2.3.4 " * 3000, "+1+2+33 44 55 66 77 88", "00000000000000", "4" + "-1" * 15]
    fixed += ["".join(rng.choice("ab@.1234567890 -+()é_%") for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    _check(spark, [*text_rows, *fixed, *docs])


def test_method_adds_secrets_and_leaves_versions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = pii.digest(pii.find_spans(docs)).filter(F.col("spans").contains("secret")).count()
    want = docs.filter(F.col("text").rlike(r'(?i)token = "[0-9a-f]{40}"')).count()
    assert want > 0 and got == want
    assert not pii.digest(pii.find_spans(docs)).filter(F.col("spans").rlike("number")).count()


def test_redaction(spark, text_rows):
    rows = [(i, t, "k") for i, t in enumerate([*text_rows, "é mail a.1@b.com 1.2.3.4!", "4111111111111111 +1 279 555 0216 x"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = [r["text"] for r in pii.redacted(df).orderBy("doc_id").collect()]
    assert got[-2:] == ["é mail <EMAIL> <IP>!", "<CARD> <PHONE> x"] and got[:-2] == list(text_rows)
    assert pii.redacted(df.limit(0)).count() == 0


def test_running_sums(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 63, 64, 65, 300)], "a array<long>")
    for r in df.select("a", pii.running_sums(F.col("a")).alias("s")).collect():
        assert r["s"] == [sum(r["a"][: i + 1]) for i in range(len(r["a"]))]


def test_reliabilities_find_the_bad_voter():
    rng, rows = random.Random(2), {}
    for _ in range(4000):
        y = rng.choice((-1, 1))
        votes = tuple(y if rng.random() < p else -y for p in (0.95, 0.9, 0.85, 0.55, 0.9, 0.8))
        rows[votes] = rows.get(votes, 0) + 1
    rows = [{"kind": 0, "n": n} | {f"v_{k}": v for k, v in zip(pii.VOTES, votes)} for votes, n in rows.items()]
    _, table, _ = pii.reliabilities(rows)
    right = [(table[k][1][1] + table[k][-1][-1]) / 2 for k in pii.VOTES]
    assert all(abs(a - b) < 0.05 for a, b in zip(right, (0.95, 0.9, 0.85, 0.55, 0.9, 0.8)))


def test_long_tokens_and_digit_runs_are_whole_spans(spark):
    rng = random.Random(9)
    long = {n: "a1" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n - 2)) for n in (200, 201, 342, 5000)}
    digits = "-".join("123456789"[i % 9] * 3 for i in range(30))
    texts = [f'x token = "{t}" y' for t in long.values()] + [f"no {digits}, z"]
    df = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    proposed = {r["doc_id"]: [s["span"] for s in r["__spans"]] for r in pii._with_spans(df, "text").collect()}
    for i, t in enumerate([*long.values(), digits]):
        assert t in proposed[-1 - i]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(df)
    got = {r["doc_id"]: r["text"] for r in pii.redacted(docs).filter("doc_id < 0").collect()}
    assert all(got[-1 - i] == 'x token = "<SECRET>" y' for i in range(len(long)))


def _redacted(text, spans):
    """The text with merged spans replaced, span by span."""
    merged = []
    for start, end, kind in spans:
        if merged and merged[-1][1] > start:
            merged[-1] = (merged[-1][0], max(merged[-1][1], end), merged[-1][2])
        else:
            merged.append((start, end, kind))
    out, at = [], 0
    for start, end, kind in merged:
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def test_many_matches_in_one_text(spark):
    many = "".join(f"üser{i}@mail{i % 90}.com 😀 " for i in range(50_000))
    mixed = "".join(f"call +44 20 {i:04d} 7788, 10.{i % 300}.2.9, 123-45-{i:04d} key=aB3{i:05d}xYzKlMnOpQr4s5T6u7 " for i in range(1000, 3000))
    df = spark.createDataFrame([(1, many), (2, mixed), (3, "x" * 9000 + " a@b.co " + "y" * 9000)], "doc_id long, text string")
    texts = {1: many, 2: mixed, 3: df.collect()[2]["text"]}
    found = {r["doc_id"]: [(x["start"], x["end"], pii.KINDS[x["kind_no"]], x["base"]) for x in r["__pii"]] for r in pii.find_spans(df).collect()}
    assert len(found[1]) == 50_000 and len(found[3]) == 1
    for i, text in texts.items():
        assert {(a, b, k) for a, b, k, base in found[i] if base} == {(a, b, k) for a, _, b, k in base_spans(text)}
    got = {r["doc_id"]: r["text"] for r in pii.redacted(df).collect()}
    assert got == {i: _redacted(t, [x[:3] for x in found[i]]) for i, t in texts.items()}


def test_spans_clear_of_certain_ones(spark):
    rng = random.Random(4)

    def some(n):
        return [(a, a + rng.randrange(1, 9)) for a in (rng.randrange(120) for _ in range(n))]

    rows = [(i, some(rng.randrange(12)), some(rng.randrange(12))) for i in range(200)]
    span = "array<struct<start:bigint,end:bigint>>"
    df = spark.createDataFrame(rows, f"i int, added {span}, certain {span}")
    for r in df.select("i", pii._clear_of(F.col("added"), F.col("certain")).alias("kept")).collect():
        _, added, certain = rows[r["i"]]
        assert [tuple(x) for x in r["kept"]] == [(a, b) for a, b in added if not any(c < b and a < d for c, d in certain)]
