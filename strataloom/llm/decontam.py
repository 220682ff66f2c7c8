"""Benchmark decontamination with one FM-index per shard of training text.

Benchmark windows are the query set. A shard is a run of whole documents; words that no window
of the block has become separators, and stretches of known words too short for any window are left out, which loses no
occurrence. The index over the rest is a Burrows-Wheeler transform whose ranks come from a
wavelet matrix; all windows are searched backwards at once, and occurrences are
located by walking to sampled suffix positions. Query windows come in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alnum_words

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of an int array in order (a shorter suffix first), by prefix doubling; only groups that are still tied are sorted again."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    k = 1
    head = np.flatnonzero(np.r_[True, np.diff(rank[order]) != 0]) if n else np.zeros(0, np.int64)
    if n:
        rank[order] = np.repeat(head, np.diff(np.r_[head, n]))
    while n:
        size = np.diff(np.r_[head, n])
        open_ = np.repeat(size > 1, size)
        slots = np.flatnonzero(open_)
        if not len(slots):
            return order
        at = order[slots]
        after = np.where(at + k < n, rank[np.minimum(at + k, n - 1)], -1)
        by = np.lexsort((after, rank[at]))
        at, after = at[by], after[by]
        order[slots] = at
        old = rank[at]
        fresh = np.r_[True, (np.diff(old) != 0) | (np.diff(after) != 0)]
        rank[at] = np.repeat(slots[fresh], np.diff(np.r_[np.flatnonzero(fresh), len(at)]))
        mark = np.zeros(n, bool)
        mark[head] = True
        mark[slots[fresh]] = True
        head = np.flatnonzero(mark)
        k *= 2
    return order


class WaveletMatrix:
    """rank(symbol, i): how often symbol is among the first i; access(i)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.bits = bits
        for b in reversed(range(bits)):
            bit = ((values >> b) & 1).astype(bool)
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = len(values) - int(ones[-1])
            self.levels.append((ones, zeros))
            values = np.concatenate((values[~bit], values[bit]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros_like(i), i
        for b, (ones, zeros) in zip(reversed(range(self.bits)), self.levels, strict=True):
            bit = (symbol >> b) & 1 == 1
            lo = np.where(bit, zeros + ones[lo], lo - ones[lo])
            hi = np.where(bit, zeros + ones[hi], hi - ones[hi])
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for ones, zeros in self.levels:
            bit = ones[i + 1] > ones[i]
            out = out << 1 | bit
            i = np.where(bit, zeros + ones[i], i - ones[i])
        return out


class FMIndex:
    """Over an int array (symbols >= 1; 0 separates), with every sample-th text position kept."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        text = np.concatenate((text, [0])).astype(np.int64)
        sa = suffix_array(text)
        self.n, self.top = len(text), int(text.max())
        last = text[sa - 1]
        last[sa == 0] = self.top + 1  # what precedes the text: a symbol of its own
        self.wave = WaveletMatrix(last, (self.top + 1).bit_length())
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.first[0] = 1  # row 0 is the closing separator, which no row leads to
        kept = sa % sample == 0
        self.kept, self.value = np.concatenate(([0], np.cumsum(kept))), sa[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of the patterns (rows of one length, the symbols >= 1)."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in reversed(range(patterns.shape[1])):
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            c = patterns[live, j]
            fits = c <= self.top
            lo[live[~fits]] = hi[live[~fits]] = 0
            live, c = live[fits], c[fits]
            lo[live], hi[live] = self.first[c] + self.wave.rank(c, lo[live]), self.first[c] + self.wave.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the rows, by steps back to a sampled position."""
        out, at, live, steps = np.zeros(len(rows), np.int64), rows.copy(), np.arange(len(rows)), 0
        while len(live):
            hit = self.kept[at + 1] > self.kept[at]
            out[live[hit]] = self.value[self.kept[at[hit]]] + steps
            live, at = live[~hit], at[~hit]
            c = self.wave.access(at)
            at = self.first[c] + self.wave.rank(c, at)
            steps += 1
        return out


class Block:
    """Windows of some benchmark items: the distinct ones by length, and the items that each comes from.

    Windows are rows of an int32 array of word numbers, which count from 1; the items of window k of a length are names[owners[first[k] : first[k + 1]]].
    """

    def __init__(self, items: Iterable[tuple[str, str | None]], width: int = 13):
        self.vocabulary: dict[bytes, int] = {}
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.names: list[str] = []
        made: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item, text in items:
            words = alnum_words(text)
            n = min(width, len(words))
            if n:
                ids = np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words), np.int32, len(words))
                windows = np.lib.stride_tricks.sliding_window_view(ids, n)
                made.setdefault(n, []).append((windows, np.full(len(windows), len(self.names), np.int32)))
                self.names.append(item)
        for n, parts in made.items():
            windows, owners = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((owners, *windows.T))
            windows, owners = windows[order], owners[order]
            fresh = np.r_[True, (windows[1:] != windows[:-1]).any(1)]
            once = fresh | np.r_[True, owners[1:] != owners[:-1]]
            first = np.flatnonzero(fresh[once])
            self.by_length[n] = windows[fresh], owners[once], np.r_[first, once.sum()]
        self.shortest = min(made, default=0)


def search_shard(block: Block, texts: list[str | None]) -> list[tuple[int, np.ndarray, np.ndarray, set[str]]]:
    """For each text: number of words, merged starts and ends of hit words, items."""
    get = block.vocabulary.get
    ids, origin, lengths, at = [], [], [], 0
    for text in texts:
        words = alnum_words(text)
        lengths.append(len(words))
        if block.shortest and len(words) >= block.shortest:
            w = np.fromiter((get(x, 0) for x in words), np.int64, len(words))
            edge = np.flatnonzero(np.diff(np.concatenate(([0], w != 0, [0])).astype(np.int8)))
            for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if e - s >= block.shortest:
                    ids += [w[s:e].copy(), [0]]  # a view would keep all words of the text
                    origin.append((at + s, e - s))
        at += len(words)
    found: list[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]] = []
    if ids:
        index = FMIndex(np.concatenate(ids).astype(np.int64))
        sizes = np.array([n for _, n in origin])
        place = np.cumsum(sizes + 1) - sizes - 1
        shift = np.array([o for o, _ in origin]) - place
        for n, (patterns, owners, first) in block.by_length.items():
            lo, hi = index.search(patterns)
            count = hi - lo
            which = np.repeat(np.arange(len(patterns)), count)
            rows = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            pos = index.locate(rows)
            found.append((pos + shift[np.searchsorted(place, pos, "right") - 1], n, which, owners, first))
    base = np.concatenate(([0], np.cumsum(lengths)))
    items: list[set[str]] = [set() for _ in texts]
    delta = np.zeros(base[-1] + 1, np.int32)
    for pos, n, which, owners, first in found:
        np.add.at(delta, pos, 1)
        np.add.at(delta, pos + n, -1)
        doc = np.searchsorted(base, pos, "right") - 1
        for d, w in np.unique(np.stack((doc, which), 1), axis=0).tolist() if len(pos) else ():
            items[d].update(block.names[o] for o in owners[first[w] : first[w + 1]].tolist())
    covered = np.cumsum(delta[:-1]) > 0
    out = []
    for d in range(len(texts)):
        if items[d]:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], covered[base[d] : base[d + 1]], [0])).astype(np.int8)))
            out.append((lengths[d], edge[::2], edge[1::2], items[d]))
        else:
            out.append((lengths[d], np.zeros(0, int), np.zeros(0, int), set()))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, max_bytes: int) -> Iterator[tuple[bool, list[Row]]]:
    """The benchmark's items in blocks of about max_bytes of text, told apart by a hash of the item; and whether a block is the last."""
    total = benchmark.agg(F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit("")))).alias("n")).first()["n"] or 0
    n = max(1, -(-2 * total // max_bytes)) if total > max_bytes else 1
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("item IS NOT NULL")
    for k in range(n):
        yield k == n - 1, items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k).collect()


def _shards(texts: pa.Array, most_words: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about most_words words, guessed from their lengths."""
    start, words = 0, 0
    for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
        words += (n or 0) // 6
        if words >= most_words or i == len(texts) - 1:
            yield start, i + 1
            start, words = i + 1, 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, width: int = 13, shard_words: int = 2_000_000, max_block_bytes: int = 16 << 20, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", cut: bool = False) -> DataFrame:
    """docs plus n_words (long), spans (merged word ranges [start, end) that windows cover) and items (array of item ids with an occurring window).

    Null or empty text has no words. Null benchmark text has no windows; a null item id is left out. An empty benchmark hits nothing.
    Repeated items and rows count as themselves. Extra columns pass through, but not ones named n_words, spans or items.
    A block takes 9 times its text in memory where words are of seven letters, some 26 times where they are of one.
    cut: texts lose the words of their spans and what stands between them, in the same pass, so that a task has one Python process; n_words and spans are of the whole text.
    """
    spark = docs.sparkSession
    out = docs.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")})
    schema = out.schema
    for last, rows in _blocks(benchmark, item_col, item_text, max_block_bytes):
        block = spark.sparkContext.broadcast(Block([(r["item"], r["text"]) for r in rows], width))  # at most about max_block_bytes of text

        def run(batches: Iterator[pa.RecordBatch], block=block, cutting=cut and last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, result = batch.column(text_col), []
                for start, stop in _shards(texts, shard_words):
                    result += search_shard(block.value, texts.slice(start, stop - start).to_pylist())
                old_spans, old_items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                columns = {
                    "n_words": [r[0] for r in result],
                    "spans": [merge(old, zip(r[1].tolist(), r[2].tolist(), strict=True)) for old, r in zip(old_spans, result, strict=True)],
                    "items": [sorted({*old, *r[3]}) for old, r in zip(old_items, result, strict=True)],
                }
                if cutting and any(columns["spans"]):
                    columns[text_col] = [without(t.as_py(), s) if s else t.as_py() for t, s in zip(texts, columns["spans"], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name) for f in batch.schema], schema=batch.schema)

        out = out.mapInArrow(run, schema)
    return out


def merge(old: list[dict], new: Iterable[tuple[int, int]]) -> list[dict]:
    """Union of word ranges."""
    out: list[list[int]] = []
    for s, e in sorted([(x["start"], x["end"]) for x in old] + list(new)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


def with_decision(found: DataFrame, min_share: int = 20) -> DataFrame:
    """Adds n_hit, n_items (long), items_sha256 and contaminated: at least 1/min_share of the words are hit."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("n_hit", hit).withColumns(
        {
            "n_items": F.size("items").cast("long"),
            "items_sha256": F.sha2(F.array_join(F.array_sort("items"), ","), 256),
            "contaminated": (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words")),
        }
    )


_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def without(text: str, spans: list[dict]) -> str:
    """text without the words of spans and what stands between them."""
    at = [m.span() for m in re.finditer(_WORDS, text)]
    keep, pos = [], 0
    for s in spans:
        keep.append(text[pos : at[s["start"]][0]])
        pos = at[s["end"] - 1][1]
    return "".join([*keep, text[pos:]])
