"""Fill-in-middle: scanned cuts, difference arrays of output shifts, one scatter to build and one gather to restore."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import rolling
from tabwright.llm.common import bounded_batches, by_value, text_or_empty

by_value(__name__)

SEED = "42"
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ["plain", "psm", "spm"]
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
#: Segments in output order: 0 prefix, 1 middle, 2 suffix.
ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
LETTERS = "PMS"  # of the segments 0, 1, 2
BLOCK = 1 << 20
RESULTS = ["fim_n", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_output"]


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column without nulls, and where each text begins (one more entry at the end)."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _strings(data: np.ndarray, begins: np.ndarray):
    """An Arrow string column from bytes and begins."""
    import pyarrow as pa

    return pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def token_ends(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, first, n): where every word ends, the index of each text's first word end, each text's tokens.

    A token is a word with the white space before it; white space that ends a text is one more token.
    """
    space = rolling.SPACE[data]
    stop = np.ones(len(data), dtype=bool)
    stop[:-1] = space[1:]
    last = begins[1:][begins[1:] > begins[:-1]] - 1
    stop[last] = True
    ends = np.flatnonzero(stop & ~space) + 1
    first = np.searchsorted(ends, begins, side="right")
    tail = np.zeros(len(begins) - 1, dtype=np.int64)
    filled = begins[1:] > begins[:-1]
    tail[filled] = space[begins[1:][filled] - 1]
    return ends, first, np.diff(first) + tail


def marks_in(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, segment, text) of every mark that lies inside one text, in order."""
    at = np.flatnonzero(data[: max(0, len(data) - 2)] == ord("<"))
    at = at[data[at + 2] == ord(">")]
    segment = np.full(256, -1, dtype=np.int64)
    segment[[ord(x) for x in LETTERS]] = range(3)
    kind = segment[data[at + 1]]
    at, kind = at[kind >= 0], kind[kind >= 0]
    text = np.searchsorted(begins, at, side="right") - 1
    inside = at + 3 <= begins[text + 1]
    return at[inside], kind[inside], text[inside]


def _moves(starts: np.ndarray, shifts: np.ndarray, size: int):
    """Blocks (lo, hi, place of each byte after its shift).

    `shifts[i]` holds from byte `starts[i]` to the next start. They enter a difference array, whose running
    sum is the shift of every byte; empty segments start where the next one does and cancel out.
    """
    steps = np.diff(np.r_[0, shifts])
    carry = 0
    for lo in range(0, size, BLOCK):
        hi = min(size, lo + BLOCK)
        i, j = np.searchsorted(starts, [lo, hi])
        difference = np.zeros(hi - lo, dtype=np.int64)
        np.add.at(difference, starts[i:j] - lo, steps[i:j])
        shift = np.cumsum(difference) + carry
        carry = int(shift[-1])
        yield lo, hi, shift + np.arange(lo, hi)


def scatter(data: np.ndarray, begins: np.ndarray, cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes and begins: every byte of the batch goes to its place plus its segment's shift.

    `cuts` holds, per text, where its middle and its suffix begin; plain texts are one segment.
    """
    moved = form != PLAIN
    outs = np.zeros(len(begins), dtype=np.int64)
    np.cumsum(np.diff(begins) + 9 * moved, out=outs[1:])
    starts = np.stack([begins[:-1], cuts[:, 0], cuts[:, 1]], axis=1)
    sizes = np.stack([cuts[:, 0] - begins[:-1], cuts[:, 1] - cuts[:, 0], begins[1:] - cuts[:, 1]], axis=1)
    shifts = np.repeat((outs[:-1] - begins[:-1])[:, None], 3, axis=1)
    out = np.empty(outs[-1], dtype=np.uint8)
    for kind, order in ORDER.items():
        rows = np.flatnonzero(form == kind)
        at = outs[rows].copy()
        for segment in order:
            for k, byte in enumerate(MARKS[LETTERS[segment]]):
                out[at + k] = byte
            shifts[rows, segment] = at + 3 - starts[rows, segment]
            at += 3 + sizes[rows, segment]
    for lo, hi, place in _moves(starts.ravel(), shifts.ravel(), len(data)):
        out[place] = data[lo:hi]
    return out, outs


def gather(out: np.ndarray, outs: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts back from outputs and forms alone: the marks give the segments, one gather reads every byte."""
    moved = form != PLAIN
    begins = np.zeros(len(outs), dtype=np.int64)
    np.cumsum(np.diff(outs) - 9 * moved, out=begins[1:])
    at, kind, text = marks_in(out, outs)
    mine = moved[text]
    at, kind, text = at[mine], kind[mine], text[mine]
    if len(at) != 3 * moved.sum() or not (np.bincount(text, minlength=len(form))[moved] == 3).all():
        raise ValueError("an output that is not plain must hold each mark once")
    until = np.r_[at[1:], 0]  # a segment ends at the next mark or at the end of its output
    until[2::3] = outs[text[2::3] + 1]
    places = np.empty((len(form), 3), dtype=np.int64)
    sizes = np.zeros((len(form), 3), dtype=np.int64)
    places[:] = outs[:-1, None]
    sizes[:, 2] = np.diff(outs)
    places[text, kind], sizes[text, kind] = at + 3, until - at - 3
    starts = begins[:-1, None] + np.c_[np.zeros(len(form), dtype=np.int64), np.cumsum(sizes[:, :2], axis=1)]
    data = np.empty(begins[-1], dtype=np.uint8)
    for lo, hi, place in _moves(starts.ravel(), (places - starts).ravel(), len(data)):
        data[lo:hi] = out[place]
    return data, begins


def transformed(data: np.ndarray, begins: np.ndarray, draws: np.ndarray):
    """(n, form, prefix_chars, middle_chars, output bytes, output begins) of a batch; draws are h1 to h4 of each text."""
    ends, first, n = token_ends(data, begins)
    units = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    words = np.diff(first)
    # after k tokens: the text's begin, its k-th word end, or its end
    cuts = np.where(units == 0, begins[:-1, None], begins[1:, None])
    at_word = (units > 0) & (units <= words[:, None])
    cuts[at_word] = ends[(first[:-1, None] + units - 1)[at_word]]
    form = np.where(draws[:, 3] % 100 < 80, SPM, PSM)
    form[(n == 0) | (draws[:, 2] % 100 >= 50)] = PLAIN
    form[marks_in(data, begins)[2]] = PLAIN
    chars = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    prefix, middle = chars[cuts[:, 0]] - chars[begins[:-1]], chars[cuts[:, 1]] - chars[cuts[:, 0]]
    out, outs = scatter(data, begins, cuts, form)
    return n, form, prefix, middle, out, outs


def draw(id_col: str, seed: str, k: int) -> Column:
    """The k-th group of eight hex digits of the hash of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def _named(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _schema(df: DataFrame, kept: list[Column], more: str) -> T.StructType:
    return T.StructType([T.StructField("__row", df.select(*kept).schema), *T.StructType.fromDDL(more).fields])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """`docs` with fim_n, fim_form, fim_prefix_chars, fim_middle_chars and fim_output; columns of these names go.

    The text is cut after two of its tokens, drawn by a hash of seed and id: so repeated ids cut alike, reruns
    agree, and a null id draws as the word "null". A null text counts as empty; empty texts and texts that hold one of
    the marks stay plain, and so does half of the others. All work on texts is done on the bytes of a whole
    Arrow batch; nothing is shuffled. An empty table gives an empty result.
    """
    bounded_batches(docs)
    kept = _named([c for c in docs.columns if c not in RESULTS])
    draws = [draw(id_col, seed, k).alias(f"__h{k}") for k in (1, 2, 3, 4)]
    # other columns pass as one struct, whatever they are called
    rows = docs.select(F.struct(*kept).alias("__row"), text_or_empty(text_col).alias("__text"), *draws)

    def build(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            data, begins = _bytes_of(batch.column(1))
            n, form, prefix, middle, out, outs = transformed(data, begins, np.stack([c.to_numpy() for c in batch.columns[2:]], axis=1))
            plain = form == PLAIN
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(FORMS).take(pa.array(form)), pa.array(prefix, pa.int64(), mask=plain),
                 pa.array(middle, pa.int64(), mask=plain), _strings(out, outs)], names=["__row", *RESULTS])

    built = rows.mapInArrow(build, _schema(docs, kept, "fim_n long, fim_form string, fim_prefix_chars long, fim_middle_chars long, fim_output string"))
    return built.select("__row.*", *RESULTS)


def restore(rows: DataFrame, output_col: str = "fim_output", form_col: str = "fim_form", out: str = "fim_restored") -> DataFrame:
    """`rows` with the exact text that an output was built from, by output and form alone; a null output gives null.

    An output whose form is not plain must hold each mark once; any other ends the job with an error. A null form
    counts as plain.
    """
    bounded_batches(rows)
    kept = _named([c for c in rows.columns if c != out])
    code = F.coalesce(F.array_position(F.array(*[F.lit(f) for f in FORMS]), F.col(form_col)) - 1, F.lit(PLAIN))
    sent = rows.select(F.struct(*kept).alias("__row"), text_or_empty(output_col).alias("__text"), code.cast("int").alias("__form"))

    def back(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            texts = _strings(*gather(*_bytes_of(batch.column(1)), batch.column(2).to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["__row", "__restored"])

    restored = F.when(F.col(f"__row.`{output_col}`").isNotNull(), F.col("__restored"))
    return sent.mapInArrow(back, _schema(rows, kept, "__restored string")).select("__row.*", restored.alias(out))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    built = fill_in_middle(docs).drop("text")
    return restore(built).select(
        "doc_id", F.col("fim_n").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"), F.sha2("fim_output", 256).alias("output_sha256"),
        F.sha2("fim_restored", 256).alias("restored_sha256"))


SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), 'null')) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as t
  from documents),
k as (
  select *, cast(len(t) as bigint) as n,
         cast('0x' || substr(h, 1, 8) as bigint) % (len(t) + 1) as c1, cast('0x' || substr(h, 9, 8) as bigint) % (len(t) + 1) as c2,
         cast('0x' || substr(h, 17, 8) as bigint) % 100 as c3, cast('0x' || substr(h, 25, 8) as bigint) % 100 as c4
  from d),
s as (
  select doc_id, text, n, case when len(t) = 0 or regexp_matches(text, '<[PSM]>') or c3 >= 50 then 'plain'
                               when c4 < 80 then 'spm' else 'psm' end as form,
         coalesce(array_to_string(t[1:least(c1, c2)], ''), '') as p,
         coalesce(array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], ''), '') as m,
         coalesce(array_to_string(t[greatest(c1, c2) + 1:], ''), '') as u
  from k)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || u || '<M>' || m
              else '<S>' || u || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from s
"""
