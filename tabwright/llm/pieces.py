"""SentencePiece encoding and decoding: the N best segmentations over the piece lattice.

Forward Viterbi scores are exact heuristics for a backward A-star search. No piece crosses from one word into
the next, so a text's lattice is a chain of words: each distinct word of a slice is solved once, and a text's
N best segmentations differ from its best one in at most N - 1 words, those with the smallest loss.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabwright.llm.common import bounded_batches, by_value, slices, text_or_empty

by_value(__name__)

SPACE = "▁"
N_BEST = 3
MAX_CACHE = 100_000
SOLVED_AT_ONCE = 8_000  # words whose lattices lie side by side in memory
UNKNOWN_PENALTY = 10.0
SLICE = 500_000


@dataclass
class Model:
    """Pieces with their scores, as a dictionary and as a trie of sorted edges."""

    pieces: dict  # piece -> (id, score)
    surface: list  # id -> bytes
    byte_ids: list
    unknown: float
    word: str  # pattern of the units that no piece crosses
    chars: np.ndarray  # code point -> number of the character, 0 if no piece holds it
    n_chars: int
    edges: np.ndarray
    child: np.ndarray
    entry: np.ndarray  # number of a character -> node of the first level, 0 if no piece starts with it
    ending: np.ndarray  # node -> piece id or -1
    scores: np.ndarray
    longest: int


def load(path: str) -> Model:
    """Read a model file with byte fallback and no other normalisation than the leading space."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    scores = np.array([sp.get_score(i) for i in range(n)])
    normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    surface = [names[i].replace(SPACE, " ").encode() for i in range(n)]
    for b, i in enumerate(byte_ids):
        surface[i] = bytes([b])
    for i in range(n):
        if sp.is_control(i) or sp.is_unknown(i):
            surface[i] = b""
    if any(SPACE in names[i].lstrip(SPACE) for i in normal):
        raise ValueError("a piece crosses from one word into the next")
    joining = sorted({c for i in normal if len(names[i]) > 1 for c in names[i]} - {SPACE})
    inner = "".join(map(re.escape, joining))
    word = f"{SPACE}*[{inner}]+|{SPACE}+|[^{inner}{SPACE}]"
    letters = sorted({c for i in normal for c in names[i]})
    chars = np.zeros(0x110000, dtype=np.int32)
    chars[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    width = len(letters) + 1
    nodes: dict[tuple[int, int], int] = {}
    ending = [-1]
    for i in normal:
        at = 0
        for c in names[i]:
            key = (at, int(chars[ord(c)]))
            if key not in nodes:
                nodes[key] = len(ending)
                ending.append(-1)
            at = nodes[key]
        ending[at] = i
    edges = np.array([a * width + c for a, c in nodes], dtype=np.int64)
    order = np.argsort(edges)
    entry = np.zeros(width, dtype=np.int64)
    for (a, c), node in nodes.items():
        if a == 0:
            entry[c] = node
    usual = [scores[i] for i in normal if scores[i] > -1e8]
    return Model({names[i]: (i, float(scores[i])) for i in normal}, surface, byte_ids, float(min(usual)) - UNKNOWN_PENALTY, word, chars, width,
                 edges[order], np.array(list(nodes.values()), dtype=np.int64)[order], entry, np.array(ending), scores, max(len(names[i]) for i in normal))


def solve(model: Model, units: list[str]) -> list[tuple[list[int], float, float]]:
    """(piece ids, score, loss of the second best) of each unit."""
    ids, sizes, score, loss = lattices(model, units)
    ends = np.cumsum(sizes)
    return [(ids[b - n : b].tolist(), s, d) for b, n, s, d in zip(ends.tolist(), sizes.tolist(), score.tolist(), loss.tolist())]


def lattices(model: Model, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Piece ids of all units one after the other, number of ids, score and loss of the second best of each unit.

    All lattices lie side by side.

    Among equal scores the path whose last piece is longer wins, position by position from the end; a
    character without a piece costs a fixed score and becomes its bytes. Without a second path the loss is infinite.
    """
    lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    codes = model.chars[np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)].astype(np.int64)
    first = np.cumsum(lengths) - lengths
    unit = np.repeat(np.arange(len(units)), lengths)
    stop = (first + lengths)[unit]
    pos = np.arange(len(codes))
    node = np.zeros(len(codes), dtype=np.int64)
    starts, ends, ids, values = [], [], [], []
    for step in range(model.longest):
        if step == 0:
            reached = model.entry[codes]
            found = reached > 0
        else:
            key = node * model.n_chars + codes[pos + step]
            at = np.searchsorted(model.edges, key)
            at[at == len(model.edges)] = 0
            found = model.edges[at] == key
            reached = np.where(found, model.child[at], 0)
        piece = model.ending[reached]
        if step == 0:
            lost = piece < 0
            starts.append(pos[lost])
            ends.append(pos[lost] + 1)
            ids.append(np.full(lost.sum(), -1))
            values.append(np.full(lost.sum(), model.unknown))
        hit = piece >= 0
        starts.append(pos[hit])
        ends.append(pos[hit] + step + 1)
        ids.append(piece[hit])
        values.append(model.scores[piece[hit]])
        go = found & (pos + step + 1 < stop[pos])
        pos, node = pos[go], reached[go]
        if not len(pos):
            break
    # Longest arcs first: among the arcs into a node, a stable sort then keeps the sources in their order.
    start, end, piece, value = (np.concatenate(parts[::-1]) for parts in (starts, ends, ids, values))
    owner = unit[start]
    depth = end - first[owner]
    source, target = start + owner, end + owner  # one node more than characters in every unit
    order = np.argsort(depth * (len(codes) + len(units)) + target, kind="stable")
    source, target, piece, value, depth = source[order], target[order], piece[order], value[order], depth[order]
    n = len(codes) + len(units)
    best, second = np.full(n, -np.inf), np.full(n, -np.inf)
    best[first + np.arange(len(units))] = 0.0
    back = np.full(n, -1, dtype=np.int64)
    cuts = np.searchsorted(depth, np.arange(1, (lengths.max() if len(lengths) else 0) + 2))
    for lo, hi in zip(cuts, cuts[1:]):
        if lo == hi:
            continue
        goal = target[lo:hi]
        group = np.flatnonzero(np.r_[True, goal[1:] != goal[:-1]])
        one, two = best[source[lo:hi]] + value[lo:hi], second[source[lo:hi]] + value[lo:hi]
        top = np.maximum.reduceat(one, group)
        size = np.diff(np.r_[group, hi - lo])
        place = np.flatnonzero(one == np.repeat(top, size))
        place = place[np.r_[True, goal[place[1:]] != goal[place[:-1]]]]
        here = goal[group]
        best[here], back[here] = top, place + lo
        one[place] = -np.inf
        second[here] = np.maximum.reduceat(np.maximum(one, two), group)
    last = first + lengths + np.arange(len(units))
    score, loss = best[last], best[last] - second[last]
    at, live = last.copy(), np.arange(len(units))
    steps = []
    while len(live):
        arc = back[at[live]]
        steps.append((live, piece[arc], source[arc]))
        at[live] = source[arc]
        live = live[at[live] > first[live] + live]
    owners, found = np.concatenate([s[0] for s in steps[::-1]]), np.concatenate([s[1] for s in steps[::-1]])
    where = np.concatenate([s[2] for s in steps[::-1]])
    order = np.argsort(owners, kind="stable")
    owners, found, where = owners[order], found[order], where[order]
    lost = np.flatnonzero(found < 0)
    if len(lost):  # a character without a piece becomes the pieces of its bytes
        coded = [[model.byte_ids[b] for b in units[u][w].encode()] for u, w in
                 zip(owners[lost].tolist(), (where[lost] - first[owners[lost]] - owners[lost]).tolist())]
        width = np.ones(len(found), dtype=np.int64)
        width[lost] = [len(c) for c in coded]
        spread = np.repeat(found, width)
        spread[spread < 0] = [x for c in coded for x in c]
        owners, found = np.repeat(owners, width), spread
    return found.astype(np.int32), np.bincount(owners, minlength=len(units)), score, loss


@dataclass
class Solved:
    """Solved words in flat arrays, found by their number."""

    number: dict
    ids: np.ndarray
    start: np.ndarray
    size: np.ndarray
    score: np.ndarray
    loss: np.ndarray

    @staticmethod
    def empty() -> "Solved":
        return Solved({}, np.zeros(0, np.int32), *(np.zeros(0, np.int64) for _ in range(2)), *(np.zeros(0) for _ in range(2)))

    def add(self, model: Model, words: list[str]) -> None:
        parts = [lattices(model, words[i : i + SOLVED_AT_ONCE]) for i in range(0, len(words), SOLVED_AT_ONCE)]
        if parts:
            ids, size, score, loss = map(np.concatenate, zip(*parts))
            self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
            self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
            self.score, self.loss = np.concatenate([self.score, score]), np.concatenate([self.loss, loss])

    def own(self, number: int) -> list[int]:
        return self.ids[self.start[number] : self.start[number] + self.size[number]].tolist()


def n_best(model: Model, text: str, n: int) -> list[tuple[float, list[int]]]:
    """The n best segmentations of one unit: A-star from its end, with forward Viterbi scores as heuristic."""
    size = len(text)
    forward = [0.0] + [float("-inf")] * size
    into: list[list] = [[] for _ in range(size + 1)]
    for i in range(size):
        for j in range(i + 1, min(size, i + model.longest) + 1):
            known = model.pieces.get(text[i:j])
            if known is None and j == i + 1:
                known = (-1, model.unknown)
            if known is not None:
                into[j].append((i, *known))
                forward[j] = max(forward[j], forward[i] + known[1])
    heap, tie, out = [(-forward[size], size, 0, 0.0, None)], 0, []  # among equal scores the path nearest to its end goes on
    while heap and len(out) < n:
        f, at, _, done, path = heapq.heappop(heap)
        if at == 0:
            ids = []
            while path is not None:
                (i, p), path = path
                ids += [p] if p >= 0 else [model.byte_ids[b] for b in text[i].encode()]
            out.append((-f, ids))
            continue
        for i, p, s in into[at]:
            tie += 1
            heapq.heappush(heap, (-(forward[i] + done + s), i, tie, done + s, ((i, p), path)))
    return out


def smallest_losses(loss: np.ndarray, bounds: np.ndarray, n: int) -> list[list[int]]:
    """Per row (`bounds` in `loss`) the places of its n smallest finite losses, in their order, ties to the earlier place."""
    out: list[list[int]] = [[] for _ in range(len(bounds) - 1)]
    lengths = np.diff(bounds)
    rows = np.flatnonzero(lengths)
    owner, left = np.repeat(rows, lengths[rows]), loss.copy()
    for _ in range(n if len(rows) else 0):
        low = np.minimum.reduceat(left, bounds[rows])
        place = np.flatnonzero((left == np.repeat(low, lengths[rows])) & np.isfinite(left))
        place = place[np.r_[True, owner[place[1:]] != owner[place[:-1]]]] if len(place) else place
        for r, p in zip(owner[place].tolist(), place.tolist()):
            out[r].append(p)
        left[place] = np.inf
    return out


def alternatives(model: Model, words: list[tuple], total: float, n: int, cache: dict) -> list[tuple[float, list]]:
    """The second to n-th best segmentation of a text: (score, [(place of the word, ids), ...]).

    `words` are those of smallest loss: (place, word, its best ids, their score).
    """
    plans: list[tuple[float, list]] = [(0.0, [])]
    for place, word, best, score in words:
        if word not in cache:
            ranked = n_best(model, word, n)
            mine = next((k for k, r in enumerate(ranked) if r[1] == best), len(ranked) - 1)
            cache[word] = [(score - s, ids) for k, (s, ids) in enumerate(ranked) if k != mine]
        options = [(0.0, [])] + [(lost, [(place, ids)]) for lost, ids in cache[word]]
        plans = sorted(((a + b, x + y) for a, x in plans for b, y in options), key=lambda p: p[0])[:n]
    return [(total - loss, edits) for loss, edits in plans[1:]]


NBEST = "array<struct<score:double,edits:array<struct<start:int,drop:int,ids:array<int>>>>>"


def texts_of(surface: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """The texts of rows of ids that lie one after the other, without the leading space that encoding adds."""
    found, out, start = surface[ids].tolist(), [], 0
    for end in ends.tolist():
        data = b"".join(found[start:end])
        out.append((data[1:] if data[:1] == b" " else data).decode("utf-8", "replace"))
        start = end
    return out


def encode(docs: DataFrame, model: Model, n: int = N_BEST, text_col: str = "text", verify: bool = False) -> DataFrame:
    """`docs` with `piece_ids` (best segmentation), `piece_score` and `piece_nbest` (columns of these names are replaced).

    `piece_nbest` holds the following n - 1 segmentations, best first, fewer if there are no more: each with
    its score and its edits, which replace `drop` ids from `start` on (both counted in `piece_ids`). A null
    or empty text has no pieces, score 0 and no others. Equal texts get equal results. Memory is bounded by
    slices of a batch, a bounded cache of words and the longest text. With `verify` a further column,
    `piece_round_trip`, says whether decoding the ids gives the text back (a mark of a space decodes as a space).
    """
    bounded_batches(docs)
    new_names = ["piece_ids", "piece_score", "piece_nbest", *(["piece_round_trip"] if verify else [])]
    names = [c for c in docs.columns if c not in new_names]
    width = len(names)

    def run(batches):
        import pyarrow as pa

        pattern = re.compile(model.word)
        surface = np.array(model.surface, dtype=object)
        solved = Solved.empty()
        ranked: dict = {}

        def lists(sizes, values):
            return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes, dtype=np.int64)], pa.int32()), values)

        for batch in batches:
            texts = batch.column(width).to_pylist()
            for lo, hi in slices(texts, SLICE):
                rows = [pattern.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts[lo:hi]]
                units = list(chain.from_iterable(rows))
                wanted = set(units)
                new = wanted.difference(solved.number)
                if len(solved.number) + len(new) > MAX_CACHE:
                    solved, new = Solved.empty(), wanted
                if len(ranked) > MAX_CACHE // 10:
                    ranked.clear()
                solved.add(model, list(new))
                num = np.fromiter(map(solved.number.__getitem__, units), dtype=np.int64, count=len(units))
                bounds = np.r_[0, np.cumsum([len(r) for r in rows], dtype=np.int64)]
                size = solved.size[num]
                begin = np.r_[0, np.cumsum(size)]
                ids = solved.ids[np.arange(begin[-1]) + np.repeat(solved.start[num] - begin[:-1], size)]
                each, spans = solved.score[num].tolist(), bounds.tolist()
                scores = [sum(each[a:b]) for a, b in zip(spans, spans[1:])]
                few = smallest_losses(solved.loss[num], bounds, n - 1)
                more, drops, starts, edited = [], [], [], []  # flat: segmentations, their edits, the edits' ids
                per_row, per_plan = [], []
                for first, total, places in zip(begin[bounds[:-1]].tolist(), scores, few):
                    plans = alternatives(model, [(i, units[i], solved.own(num[i]), each[i]) for i in places], total, n, ranked)
                    per_row.append(len(plans))
                    for value, edits in plans:
                        more.append(value)
                        per_plan.append(len(edits))
                        for i, x in sorted(edits):
                            starts.append(int(begin[i]) - first)
                            drops.append(int(size[i]))
                            edited.append(x)
                edits = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(drops, pa.int32()), pa.array(edited, pa.list_(pa.int32()))], ["start", "drop", "ids"])
                others = pa.StructArray.from_arrays([pa.array(more, pa.float64()), lists(per_plan, edits)], ["score", "edits"])
                added = [lists(np.diff(begin[bounds]), pa.array(ids, pa.int32())), pa.array(scores, pa.float64()), lists(per_row, others)]
                if verify:
                    back = texts_of(surface, ids, begin[bounds[1:]])
                    added.append(pa.array([a == t.replace(SPACE, " ") for a, t in zip(back, texts[lo:hi])], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:width]), *added], names=[*names, *new_names])

    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema
    added = StructType.fromDDL(f"piece_ids array<int>, piece_score double, piece_nbest {NBEST}" + (", piece_round_trip boolean" if verify else ""))
    schema = StructType([*schema.fields, *added.fields])
    return docs.select(*[F.col(f"`{c}`") for c in names], text_or_empty(text_col).alias("__text")).mapInArrow(run, schema)


def decode(frame: DataFrame, model: Model, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """`frame` with `out_col`: the text of the ids, without the leading space that encoding adds. Null ids give null.

    Bytes that are not UTF-8 become replacement characters. The mark of a space decodes as a space.
    """
    bounded_batches(frame)
    names = [c for c in frame.columns if c != out_col]
    at = names.index(ids_col)

    def run(batches):
        import pyarrow as pa

        surface = np.array(model.surface, dtype=object)
        for batch in batches:
            column = batch.column(at)
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(), dtype=np.int64)
            found = texts_of(surface, column.flatten().to_numpy(zero_copy_only=False), ends)
            texts = [text if known else None for text, known in zip(found, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out_col])

    rows = frame.select(*[F.col(f"`{c}`") for c in names])
    return rows.mapInArrow(run, frame.select(*[F.col(f"`{c}`") for c in names]).schema.add(out_col, "string"))


def digest(docs: DataFrame, model: Model, n: int = N_BEST, text_col: str = "text") -> DataFrame:
    """Per row: pieces of the best segmentation, the n best scores, a hash of the ids, and whether decoding gives the text back."""
    keep = [c for c in docs.columns if c != text_col]
    coded = encode(docs, model, n, text_col, verify=True)
    return coded.select(*keep, F.size("piece_ids").cast("long").alias("n_pieces"), F.col("piece_score").alias("best_score"),
                        F.transform("piece_nbest", lambda x: x["score"]).alias("next_scores"), F.xxhash64("piece_ids").alias("ids_hash"),
                        F.col("piece_round_trip").alias("round_trip"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(docs, load(public_tokenizers.path("piece_bpe_32k.model")))
