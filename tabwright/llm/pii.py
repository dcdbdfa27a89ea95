"""PII by weak supervision, in DataFrame expressions only.

Patterns propose spans; regex, gazetteer and context labelers vote on them; expectation-maximisation over
the counts of vote patterns estimates how reliable each labeler is; a naive Bayes span classifier is then
trained on the posteriors and decides about every span that is not certain by its form.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import text_or_empty
from tabwright.session import materialize

# Every pattern is linear in the text: possessive repeats, and a start that cannot lie inside an earlier try.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+(?![A-Za-z0-9+/_-])",
    "number": r"(?<![0-9A-Za-z.+])[0-9](?:[\x20.-]?[0-9]){6,}+",
}
KINDS = list(PATTERNS)
BASE = KINDS[:4]
LEFT, RIGHT = 32, 16  # code points of context that labelers see
STEPS = 30  # halving steps of a search: an array holds fewer than 2^30 spans
BLOCK = 4096  # code points of a text that are cut at a time

# Word lists of the labelers (our own choice).
DOMAINS = "com org net edu gov io info biz co de fr es it uk eu us".split()
CALLING = "1 33 34 39 44 49".split()
CUES = "token key secret password passwd api mail email e-mail phone tel telephone call mobile card visa account ip address contact".split()
PLAIN = "version license licensed section chapter page year figure table isbn v no nr by-nc".split()


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once: inside lambdas an expression would be computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, join, block: int = 64) -> Column:
    """Inclusive prefix results of `join` (associative, zero changes nothing) over an array of longs that are not
    negative; blocks keep the copying far from quadratic."""
    zero = F.lit(0).cast("long")

    def scan(items: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(items, first, lambda a, x: F.struct(
            join(a["at"], x).alias("at"), F.concat(a["out"], F.array(join(a["at"], x))).alias("out")))["out"]

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(v) - 1, F.lit(block))
        totals = F.transform(starts, lambda b: F.aggregate(F.slice(v, b + 1, block), zero, join))
        inside = let(scan(totals, zero), lambda ends: F.transform(starts, lambda b, i: scan(
            F.slice(v, b + 1, block), F.when(i > 0, F.element_at(ends, F.greatest(i, F.lit(1)))).otherwise(zero))))
        return F.when(F.size(v) > 0, F.flatten(inside)).otherwise(F.array().cast("array<long>"))

    return let(values, blocks)


def running_sums(values: Column, block: int = 64) -> Column:
    """Inclusive prefix sums of an array of longs."""
    return running(values, lambda a, x: a + x, block)


def _further(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return span.rlike(rf"\A{part}\.{part}\.{part}\.{part}\z")
    if kind == "card":
        n = F.length(_digits(span))
        return F.when((n >= 14) & (n <= 19), F.call_function("luhn_check", _digits(span))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(span)).between(10, 15)
    return F.lit(kind == "email")


def _found(kind: str) -> Column:
    """Array of (start, kind_no, end, base, span, left, right) of one pattern, from the gaps between its matches."""
    gaps, hits, ends = F.col(f"__gap_{kind}"), F.col(f"__hit_{kind}"), F.col(f"__end_{kind}")

    def one(span: Column, i: Column, gaps: Column, ends: Column) -> Column:
        end = F.element_at(ends, i + 1)
        return F.struct(
            (end - F.length(span)).cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), end.alias("end"),
            F.coalesce(_valid(kind, span), F.lit(False)).alias("base"), span.alias("span"),
            F.right(F.element_at(gaps, i + 1), F.lit(LEFT)).alias("left"), F.left(F.element_at(gaps, i + 2), F.lit(RIGHT)).alias("right"))

    return let(gaps, lambda g: let(ends, lambda e: F.transform(hits, lambda span, i: one(span, i, g, e))))


def _clear_of(spans: Column, certain: Column) -> Column:
    """The spans that overlap none of the certain ones, found by halving steps over these in order of their starts."""
    ordered = F.sort_array(F.transform(certain, lambda y: F.struct(y["start"].alias("start"), y["end"].alias("end"))))

    def search(known: Column, ends: Column) -> Column:  # ends: the furthest end so far
        def clear(x: Column) -> Column:
            before = F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(STEPS))]), F.lit(0), lambda at, step: F.when(
                (at + step <= F.size(known)) & (F.try_element_at(known, at + step)["start"] < x["end"]), at + step).otherwise(at))
            return let(before, lambda n: (n == 0) | (F.try_element_at(ends, F.greatest(n, F.lit(1))) <= x["start"]))

        return F.filter(spans, clear)

    return let(ordered, lambda known: let(running(F.transform(known, lambda y: y["end"]), _further), lambda ends: search(known, ends)))


def _with_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """`docs` with `__spans`: all proposed spans sorted by start, kind and end; spans of the added kinds that
    overlap a certain one are left out."""
    text = F.col("__text")
    out = docs.withColumn("__text", text_or_empty(text_col))
    out = out.withColumns({f"__hit_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in PATTERNS.items()})
    out = out.withColumns({f"__gap_{k}": F.when(F.size(f"__hit_{k}") > 0, F.split(text, p, -1)) for k, p in PATTERNS.items()})
    out = out.withColumns({f"__end_{k}": running_sums(F.zip_with(
        F.col(f"__hit_{k}"), F.coalesce(F.slice(F.col(f"__gap_{k}"), 1, F.size(f"__hit_{k}")), F.array().cast("array<string>")),
        lambda h, g: (F.length(h) + F.length(g)).cast("long"))) for k in KINDS})
    out = out.withColumns({f"__found_{k}": _found(k) for k in KINDS})
    certain = F.concat(*[F.filter(F.col(f"__found_{k}"), lambda x: x["base"]) for k in BASE])
    out = out.withColumn("__certain", certain)
    added = _clear_of(F.concat(F.col("__found_secret"), F.col("__found_number")), F.col("__certain"))
    out = out.withColumn("__spans", F.sort_array(F.concat(F.col("__certain"), added)))
    return out.drop("__text", "__certain", *[f"__{part}_{k}" for part in ("hit", "gap", "end", "found") for k in KINDS])


def _words(words: list[str]) -> str:
    return r"(?i)(?:\A|[^a-z])(?:" + "|".join(words) + r")[^a-z]{0,6}\z"


def labelers(x: Column) -> dict[str, Column]:
    """Votes on one span: 1 personal, -1 not, 0 no opinion."""
    span, left, kind = x["span"], x["left"], x["kind_no"]
    digits = _digits(span)
    n, kinds = F.length(digits), F.length(F.array_join(F.array_distinct(F.split(F.lower(span), "")), ""))
    is_kind = {k: kind == i for i, k in enumerate(KINDS)}
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    return {
        "form": F.when(is_kind["secret"], F.when(span.rlike(r"\A(?:[0-9a-f]{32,}|[0-9A-F]{32,}|[A-Za-z0-9]{24,})\z"), yes).otherwise(no))
        .when(is_kind["number"], F.when(span.rlike(r"\A[0-9]{3}-[0-9]{2}-[0-9]{4}\z"), yes).when(span.rlike(r"\A[0-9.]+\z"), no).otherwise(none))
        .otherwise(yes),
        "checksum": F.when(is_kind["card"] | is_kind["number"], F.when(n.between(14, 19) & F.call_function("luhn_check", digits), yes)
                           .when(n.between(13, 19), no).otherwise(none)).otherwise(none),
        "gazetteer": F.when(is_kind["email"], F.when(F.lower(F.substring_index(span, ".", -1)).isin(DOMAINS), yes).otherwise(none))
        .when(is_kind["phone"], F.when(F.regexp_extract(span, r"\A\+([0-9]+)", 1).isin(CALLING), yes).otherwise(none))
        .when(is_kind["ip"], F.when(span.rlike(r"\A(?:0+|127|255)\."), no).otherwise(yes))
        .when(is_kind["card"], F.when(digits.rlike(r"\A(?:4|5[1-5]|3[47]|6011|62)"), yes).otherwise(none)).otherwise(none),
        "cue": F.when(left.rlike(_words(CUES)), yes).when(left.rlike(_words(PLAIN)), no).otherwise(none),
        "assigned": F.when(left.rlike(r"[=:]\s*[\"']?\z"), yes).when(is_kind["secret"], no).otherwise(none),
        "variety": F.when(is_kind["secret"], F.when((n >= 6) & (kinds >= 10), yes).otherwise(no))
        .when(kinds <= 3, no).otherwise(none),
    }


def features(x: Column) -> dict[str, Column]:
    """What the span classifier sees; a handful of values each, so that their patterns stay few."""
    span, left, right = x["span"], x["left"], x["right"]
    size, n = F.length(span), F.length(_digits(span))
    return {
        "size": F.least(F.lit(7), F.floor(F.log2(size.cast("double")))).cast("string"),
        "digits": F.floor(n * 4.0 / F.greatest(size, F.lit(1))).cast("string"),
        "marks": F.least(F.lit(5), F.length(F.regexp_replace(span, "[A-Za-z0-9]", ""))).cast("string"),
        "case": F.when(span.rlike("[a-z]"), F.when(span.rlike("[A-Z]"), "mixed").otherwise("lower")).when(span.rlike("[A-Z]"), "upper").otherwise("none"),
        "before": F.when(left.rlike(r"[=:]\s*[\"']?\z"), "assigned").when(left.rlike(r"[\"'(<\[]\z"), "open").when(left.rlike(r"\s\z"), "space").otherwise("other"),
        "after": F.when(right.rlike(r"\A[\"')>\]]"), "close").when(right.rlike(r"\A\s"), "space").otherwise("other"),
    }


VOTES = ["form", "checksum", "gazetteer", "cue", "assigned", "variety"]
FEATURES = ["size", "digits", "marks", "case", "before", "after"]


def pattern_counts(spans: DataFrame) -> DataFrame:
    """(kind, votes..., features..., n): counts of equal patterns over all spans. The number of rows is bounded
    by the number of patterns, whatever the table's size."""
    one = spans.select(F.explode("__spans").alias("x")).select(
        F.col("x.kind_no").alias("kind"), *[v.alias(f"v_{k}") for k, v in labelers(F.col("x")).items()],
        *[v.alias(f"f_{k}") for k, v in features(F.col("x")).items()])
    return one.groupBy(*one.columns).agg(F.count("*").alias("n"))


def reliabilities(rows: list[dict], rounds: int = 60) -> tuple[list[float], dict, list[float]]:
    """Expectation-maximisation for independent voters: posteriors of the patterns, P(vote | class), P(class | kind).

    It starts from votes that are right eight times out of ten; pseudo counts keep every probability inside (0, 1).
    """
    table = {k: {y: {v: 0.8 if v == y else 0.1 if v == -y else 0.5 for v in (-1, 0, 1)} for y in (-1, 1)} for k in VOTES}
    prior = [0.5] * len(KINDS)
    post = [0.5] * len(rows)
    for _ in range(rounds):
        for i, r in enumerate(rows):
            score = math.log(prior[r["kind"]] / (1 - prior[r["kind"]]))
            for k in VOTES:
                if r[f"v_{k}"]:  # no opinion says nothing: labelers abstain by kind, not by class
                    score += math.log(table[k][1][r[f"v_{k}"]] / table[k][-1][r[f"v_{k}"]])
            post[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))
        for k in VOTES:
            for y in (-1, 1):
                sums = {v: 4.0 if v == y else 1.0 for v in (-1, 1)}
                for r, p in zip(rows, post):
                    if r[f"v_{k}"]:
                        sums[r[f"v_{k}"]] += r["n"] * (p if y == 1 else 1 - p)
                total = sum(sums.values())
                table[k][y] = {v: s / total for v, s in sums.items()} | {0: 1.0}
        for kind in range(len(KINDS)):
            n = sum(r["n"] for r in rows if r["kind"] == kind)
            prior[kind] = (1 + sum(r["n"] * p for r, p in zip(rows, post) if r["kind"] == kind)) / (2 + n)
    return post, table, prior


def classifier(rows: list[dict], post: list[float]) -> tuple[dict[str, float], dict[str, float]]:
    """Naive Bayes on the posteriors: log odds of each kind, and of each (feature, value)."""
    base, weights = {}, {}
    totals = [1 + sum(r["n"] * w for r, w in zip(rows, side)) for side in (post, [1 - p for p in post])]
    for kind in range(len(KINDS)):
        mine = [(r["n"], p) for r, p in zip(rows, post) if r["kind"] == kind]
        base[str(kind)] = math.log((1 + sum(n * p for n, p in mine)) / (1 + sum(n * (1 - p) for n, p in mine)))
    for f in FEATURES:
        values = sorted({r[f"f_{f}"] for r in rows})
        for v in values:
            up = 1 + sum(r["n"] * p for r, p in zip(rows, post) if r[f"f_{f}"] == v)
            down = 1 + sum(r["n"] * (1 - p) for r, p in zip(rows, post) if r[f"f_{f}"] == v)
            weights[f"{f}:{v}"] = math.log(up / (totals[0] + len(values))) - math.log(down / (totals[1] + len(values)))
    return base, weights


def _lookup(table: dict[str, float], key: Column) -> Column:
    if not table:
        return F.lit(0.0)
    literal = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
    return F.coalesce(F.try_element_at(literal, key), F.lit(0.0))


def _decided(base: dict[str, float], weights: dict[str, float]) -> Column:
    """The spans that stay: all certain ones, and those the classifier holds to be personal."""

    def personal(x: Column) -> Column:
        score = _lookup(base, x["kind_no"].cast("string"))
        for name, value in features(x).items():
            score = score + _lookup({k: w for k, w in weights.items() if k.startswith(f"{name}:")}, F.concat(F.lit(f"{name}:"), value))
        return x["base"] | (score > 0)

    return F.filter(F.col("__spans"), personal)


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with `__pii`: array of (start, kind_no, end, base, span, left, right), sorted by start, kind, end.

    Starts and ends count code points, the end is exclusive. A null text is empty and has no span; equal
    texts get equal spans; an empty table gives an empty result. The proposed spans are written once, the
    labelers' statistics are counts of patterns, and nothing is shuffled but those counts.
    """
    return classified(materialize(_with_spans(docs, text_col), "pii-spans"))


def classified(rows: DataFrame) -> DataFrame:
    """Learn from all proposed spans of `rows` (`__spans`) and keep the personal ones as `__pii`."""
    counted = [r.asDict() for r in pattern_counts(rows).collect()]
    counted.sort(key=lambda r: [str(r[c]) for c in sorted(r)])
    post, _, _ = reliabilities(counted)
    return rows.withColumn("__pii", _decided(*classifier(counted, post))).drop("__spans")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind_no"] + 1), x["start"], x["end"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    certain = F.filter(F.col("__pii"), lambda x: x["base"])
    kinds = F.transform(certain, lambda x: x["kind_no"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select(id_col, *counts, F.sha2(_joined(certain), 256).alias("base_sha256"), _joined(F.col("__pii")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with each span replaced by its kind in angle brackets, overlapping ones by the first kind.

    The columns are those of `docs`; a null text stays null.
    """
    found = find_spans(docs, text_col)
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def merged(spans: Column, ends: Column) -> Column:  # ends: the furthest end so far
        heads = F.filter(F.sequence(F.lit(1), F.size(spans)), lambda i: (i == 1) | (
            F.element_at(spans, i)["start"] >= F.element_at(ends, F.greatest(i - 1, F.lit(1)))))
        return let(heads, lambda h: F.transform(h, lambda i, j: F.struct(
            F.element_at(spans, i)["start"].alias("start"),
            F.element_at(ends, F.coalesce(F.try_element_at(h, j + 2) - 1, F.size(spans))).alias("end"),
            F.element_at(spans, i)["kind_no"].alias("kind_no"))))

    whole = F.when(F.size("__pii") > 0, let(F.col("__pii"), lambda spans: let(
        running(F.transform(spans, lambda x: x["end"]), _further), lambda ends: merged(spans, ends))))
    text, spans = F.col(text_col).cast("string"), F.col("__merged")

    def cut(blocks: Column, start: Column, end: Column) -> Column:
        at = F.floor(start / BLOCK).cast("int")
        near = F.array_join(F.slice(blocks, at + 1, F.floor(end / BLOCK).cast("int") - at + 1), "")
        return F.substring(near, (start % BLOCK + 1).cast("int"), (end - start).cast("int"))

    def rebuilt(spans: Column, blocks: Column) -> Column:
        parts = F.transform(spans, lambda x, i: F.concat(
            cut(blocks, F.when(i > 0, F.element_at(spans, F.greatest(i, F.lit(1)))["end"]).otherwise(F.lit(0).cast("long")), x["start"]),
            F.element_at(names, x["kind_no"] + 1)))
        return F.concat(F.array_join(parts, ""), cut(blocks, F.element_at(spans, -1)["end"], F.length(text).cast("long")))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))
    new = F.when(spans.isNotNull(), let(spans, lambda x: let(blocks, lambda y: rebuilt(x, y)))).otherwise(text)
    return found.withColumn("__merged", whole).withColumn(text_col, new).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = materialize(_with_spans(docs, "text").drop("text"), "pii-spans")
    return digest(classified(rows))
