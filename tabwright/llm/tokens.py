"""Token counts: pre-tokens as ragged arrays, merged rank by rank in all sequences at once."""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import bounded_batches, by_value, slices, text_or_empty

by_value(__name__)

MAX_CACHE = 200_000
LONG_TEXT = 2_000_000

# The byte alphabet of byte-level vocabularies (printable bytes stand for themselves).
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# Fixed value: the pattern that the vocabulary file states for its pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> dict[int, str]:
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """A word-end BPE vocabulary as arrays: symbols are ids, merges are sorted pair keys with rank and result."""

    def __init__(self, spec: dict):
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        letters = byte_symbols()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self.final = np.array([vocab[letters[b] + end] for b in range(256)], dtype=np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made
        # A merge whose product takes part in a merge of lower rank has to be applied one place at a time.
        lowest = np.full(self.size, len(pairs), dtype=np.int64)
        np.minimum.at(lowest, keys // self.size, np.arange(len(pairs)))
        np.minimum.at(lowest, keys % self.size, np.arange(len(pairs)))
        self.single = lowest[made] < np.arange(len(pairs))
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.none = len(pairs)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], self.none)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word, all words being merged together.

        In every step each word applies its merge of lowest rank, at all places from the left that do not
        overlap; words without a merge leave. Memory is a few arrays of the words' length.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        result = lengths.copy()
        live = np.flatnonzero(lengths > 1)
        if not len(live):
            return result
        raw = np.frombuffer(b"".join(words[i] for i in live), dtype=np.uint8)
        sizes = lengths[live]
        symbols, word = self.inner[raw], np.repeat(np.arange(len(live)), sizes)
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[raw[last]]
        rank = np.full(len(symbols), self.none, dtype=np.int64)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        rank[last] = self.none
        owner = live
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            done = best == self.none
            if done.any():
                result[owner[word[starts[done]]]] = sizes[done]
                keep = np.repeat(~done, sizes)
                symbols, word, rank = symbols[keep], word[keep], rank[keep]
                best, sizes = best[~done], sizes[~done]
                if not len(symbols):
                    break
            low = np.repeat(best, sizes)
            hit = np.flatnonzero(rank == low)
            # In a run of overlapping places every second one is taken; for a single merge only the first of its word.
            fresh = np.r_[True, hit[1:] != hit[:-1] + 1]
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            take = (np.arange(len(hit)) - run) % 2 == 0
            first = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            hit = hit[np.where(self.single[low[hit]], first, take)]
            symbols[hit] = self.made[low[hit]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            here = moved[hit]
            for place in (here, here[here > 0] - 1):  # only pairs beside a merged symbol have a new rank
                inside = place + 1 < len(symbols)
                same = np.zeros(len(place), dtype=bool)
                same[inside] = word[place[inside]] == word[place[inside] + 1]
                rank[place[~same]] = self.none
                good = place[same]
                rank[good] = self.ranks(symbols[good], symbols[good + 1])
        return result


def _lower(text: str) -> str:
    if "Σ" in text:  # one character at a time: no rule for word ends
        return "".join(c.lower() for c in text)
    return text.lower()


def pre_tokens(text: str, pattern, special) -> tuple[list[str], int]:
    """Pre-tokens of the text between special strings, and how many special strings it holds."""
    parts = special.split(text) if "<|" in text else [text]
    words: list[str] = []
    for part in parts:
        if not part.isascii() and not unicodedata.is_normalized("NFC", part):
            part = unicodedata.normalize("NFC", part)
        words += pattern.findall(_lower(part))
    return words, len(parts) - 1


def pieces(text: str, limit: int = LONG_TEXT) -> list[str]:
    """A very long text, cut before spaces, which never lie inside a pre-token or a special string."""
    cut, start = [], 0
    while len(text) - start > limit:
        at = text.find(" ", start + limit)
        if at < 0:
            break
        cut.append(text[start:at])
        start = at
    return [*cut, text[start:]]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """`id_col`, n_bytes, n_tokens, over_limit for every row, by the vocabulary file at `path`.

    No begin, end or added tokens; special strings inside a text count as one token each. A null text is
    empty; repeated rows are counted each; an empty table gives an empty result. Each task keeps a bounded
    cache of words, and works through slices of a batch, so that memory does not grow with the text. The
    file is read on the driver and travels with the tasks.
    """
    bounded_batches(docs)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def count(batches):
        import pyarrow as pa

        bpe = WordBpe(spec)
        pattern = regex.compile(PRE_TOKEN)
        special = regex.compile("|".join(regex.escape(s) for s in bpe.specials))
        cache: dict[str, int] = {}
        for batch in batches:
            texts = batch.column(2).to_pylist()
            totals = []
            for lo, hi in slices(texts):
                per_row = [0] * (hi - lo)
                for row, text in enumerate(texts[lo:hi]):
                    if len(text) > LONG_TEXT:
                        parts = pieces(text)
                    else:
                        parts = [text]
                    if len(parts) > 1:
                        for part in parts:
                            words, n = pre_tokens(part, pattern, special)
                            fill(bpe, cache, [words])
                            per_row[row] += n + sum(map(cache.__getitem__, words))
                    else:
                        per_row[row] = pre_tokens(parts[0], pattern, special)
                todo = [x[0] for x in per_row if isinstance(x, tuple)]
                fill(bpe, cache, todo)
                totals += [x if isinstance(x, int) else x[1] + sum(map(cache.__getitem__, x[0])) for x in per_row]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(totals, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    text = text_or_empty(text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("t"))
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def fill(bpe: WordBpe, cache: dict, lists: list[list[str]]) -> None:
    """The counts of all words of these lists are in the cache afterwards."""
    wanted = set().union(*lists)
    new = wanted.difference(cache)
    if len(cache) + len(new) > MAX_CACHE:
        cache.clear()
        new = wanted
    new = list(new)
    cache.update(zip(new, bpe.counts([w.encode("utf-8") for w in new]).tolist()))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
