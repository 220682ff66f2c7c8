"""Language-model scores by a probabilistic suffix tree over words.

Contexts are nodes if their next-symbol distribution diverges from that of the suffix above them; next-symbol entries are the continuations that
occur `least` times, however large the corpus is. A context is tried where the suffix above it is open: where the model so far spends at least `gain` nats
on that suffix's entries. On a suffix that is not open no longer context could save as much, so nothing that passes the divergence test is left out, and runs
that always go on alike, as in copies, end by themselves. A text is scored by the longest suffix that is a node. Distributions are smoothed by discounting into
the suffix above, and at the root by adding one half to every word's count. Words, nodes and entries are rows of written tables, which grow with the corpus.

A token's score is that of the root, plus log(left) of each suffix that is a node, plus a correction where the token is an entry of that node.
All of these belong to runs of words, so texts meet the model once, in buckets of runs: packed arrays of texts' runs beside such arrays of the model. Runs above p_head of all tokens are carried to where texts are
read, which spares the join; a bitmap of the others leaves out of the join what the model lacks.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import arrow_rows, materialize, release
from .tokens import END, Lookup, mix, word_hashes

DISCOUNT = 0.75
TEXT_ROWS = 2000  # texts that are sent to Python at a time
_SPREAD = 0x9E3779B97F4A7C15
PIECE = 1_000_000  # tokens that are worked on at a time
REST_RUNS = 500_000  # runs of the model that are dealt at a time
_PACK, _UNPACK = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def packed(x: np.ndarray, rising: bool = False) -> bytes:
    """Numbers of 64 bits without loss, byte by byte of them, each kind of byte compressed where that helps. Whole ones count from the least, rising ones from the one before."""
    least = x.min() if len(x) and x.dtype.kind != "f" else x.dtype.type(0)
    if x.dtype.kind != "f":
        x = x - least
    if rising:
        x = np.diff(x, prepend=np.zeros(1, x.dtype))
    planes = [p.tobytes() for p in np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T)]
    planes = [min(p, _PACK(p), key=len) for p in planes]
    return np.array([len(x), *map(len, planes)], np.int32).tobytes() + least.tobytes() + b"".join(planes)


def unpacked(blob: bytes, kind: type, rising: bool = False) -> np.ndarray:
    """The numbers that packed was given; a byte's part as long as there are numbers is not compressed."""
    n, *lengths = np.frombuffer(blob, np.int32, 9).tolist()
    out, at = np.empty((n, 8), np.uint8), 44
    for k, size in enumerate(lengths):
        part = blob[at : at + size]
        out[:, k] = np.frombuffer(part if size == n else _UNPACK(part), np.uint8)
        at += size
    x = out.reshape(-1).view(kind)
    if rising:
        x = np.cumsum(x, dtype=kind)
    return x if x.dtype.kind == "f" else x + np.frombuffer(blob, kind, 1, 36)


def _order(x: np.ndarray, near: bool = False) -> np.ndarray:
    """As np.argsort of numbers without sign; near: by their highest bits alone. Places stand in for the lowest bits, as a sort is faster than an argsort."""
    x, bits = x.view(np.uint64), np.uint64(len(x).bit_length())
    order = (np.sort((x >> bits << bits) | np.arange(len(x), dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    if not near:
        ranked = x[order]
        if np.any(ranked[1:] < ranked[:-1]):  # two that differ in the lowest bits alone
            return np.argsort(x)
    return order


def _uniques(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value of x stands first in some order, and how often it occurs."""
    order = _order(x)
    ranked = x[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(x) else np.zeros(0, np.int64)
    return order[first], np.diff(np.concatenate([first, [len(x)]]))


def _pieces(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[np.ndarray]:
    """Word hashes of texts laid end to end, in pieces of about `most` tokens."""
    held, n = [], 0
    for batch in batches:
        tokens, _ = word_hashes(batch.column(column))
        held.append(tokens)
        n += len(tokens)
        if n >= most:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _held(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows of batches together, about `most` at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _words(docs: DataFrame, most: int = PIECE) -> DataFrame:
    """key and c: how often each word hash occurs; summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _pieces(batches, "text", most):
            first, c = _uniques(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(tokens[first]), pa.array(c.astype(np.int64))], names=["key", "c"])

    return docs.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))

def joined(ctx: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Key of the run of words whose words but the last are the run ctx, and whose words but the first are the run low."""
    return mix(ctx.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + low.view(np.uint64)).view(np.int64)


def runs(hashes: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 on: keys of the runs that end at each place of texts laid end to end, and whether the run lies within one text."""
    keys, inside = hashes, np.ones(len(hashes), bool)
    yield keys, inside
    for _ in range(1, longest):
        longer, ok = np.zeros_like(keys), np.zeros_like(inside)
        longer[1:] = joined(keys[:-1], keys[1:])
        ok[1:] = inside[:-1] & inside[1:] & (hashes[:-1] != END)
        keys, inside = longer, ok
        yield keys, inside


class Bitmap:
    """Which keys may be in a set: two of 12 to 24 bits a key, at most most_bits (128 MB). Beyond that more of the other keys pass; joins leave those out."""

    BLOCK = 1 << 20  # bits that are marked together

    def __init__(self, keys: DataFrame, most_bits: int = 1 << 30):
        bits = min(most_bits, max(1 << 20, 1 << (12 * keys.count()).bit_length()))
        slots, block = functools.partial(self._slots, last=bits - 1), self.BLOCK

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in _held(batches, REST_RUNS):
                at = np.sort(np.concatenate(slots(group["key"].to_numpy())))
                k = at // block
                edges = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
                yield pa.RecordBatch.from_arrays([pa.array(k[edges[:-1]]), pa.array([packed(at[a:b] % block, True) for a, b in itertools.pairwise(edges.tolist())], pa.binary())], names=["k", "at"])

        def marked(rows: pa.Table) -> pa.Table:
            out = np.zeros(block, bool)
            for x in rows["at"]:
                out[unpacked(x.as_py(), np.int64, True)] = True
            return pa.table([rows["k"][:1], pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())], names=["k", "bits"])

        self.last, self.bits = bits - 1, np.zeros(bits // 8, np.uint8)
        for r in keys.select("key").mapInArrow(run, "k long, at binary").groupBy("k").applyInArrow(marked, "k long, bits binary").toLocalIterator():
            self.bits[r["k"] * block // 8 : (r["k"] + 1) * block // 8] = np.frombuffer(r["bits"], np.uint8)

    @staticmethod
    def _slots(keys: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
        return keys & last, (keys.view(np.uint64) >> np.uint64(31)).view(np.int64) & last

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self._slots(keys, self.last):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def _sums(key: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key stands first in some order, and the sum of its c."""
    order = _order(key)
    ranked = key[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(key) else np.zeros(0, np.int64)
    return order[first], np.add.reduceat(c[order], first) if len(first) else c[:0]


def _dealt(ctx: np.ndarray, low: np.ndarray | None, c: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Runs as one row a bucket, whose columns are the bytes of arrays; a run's bucket is told by its key. Within a bucket equal contexts stand together, which compresses."""
    key = ctx if low is None else joined(ctx, low)
    bucket = ((key.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = _order((bucket << np.uint64(44)) | (ctx.view(np.uint64) >> np.uint64(20)), near=True)
    bucket = bucket[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)

    def cut(x: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x[order]))])

    lows = pa.nulls(len(edges) - 1, pa.binary()) if low is None else cut(low)
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]].astype(np.int32)), cut(ctx), lows, cut(c.astype(np.int32))], names=["bucket", "ctx", "low", "c"])


def _entries(docs: DataFrame, level: int, least: int, frequent: Bitmap | None, opened: Bitmap | None, buckets: int, most: int = PIECE) -> DataFrame:
    """ctx, low and c of the runs of level + 1 words that occur `least` times; with opened, also rows without low: the contexts tried and how often they occur.

    frequent: which runs of one word less may be part of such a run; opened: which suffixes of contexts are open. What pieces of the texts count is
    summed by buckets (at most 2**20), whose rows are arrays: a run is no row of its own before all of its counts are together.
    """
    sent = docs.sparkSession.sparkContext.broadcast((frequent, opened))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may, open_ = sent.value
        for h in _pieces(batches, "text", most):
            *shorter, (keys, inside) = runs(h, level)
            ok = inside[:-1] & inside[1:] & (h[:-1] != END)
            if open_ is not None:
                ok &= open_(shorter[-1][0][:-1])
                ctx = keys[:-1][ok]
                first, c = _uniques(ctx)
                yield _dealt(ctx[first], None, c, buckets)
            if may is not None:
                ok &= may(keys[1:])
                if open_ is None:
                    ok &= may(keys[:-1])
            ctx, low = keys[:-1][ok], keys[1:][ok]
            first, c = _uniques(joined(ctx, low))
            yield _dealt(ctx[first], low[first], c, buckets)

    def summed(rows: pa.Table) -> pa.Table:
        parts = []
        for part, whole in ((rows.filter(pc.is_valid(rows["low"])), True), (rows.filter(pc.is_null(rows["low"])), False)):
            ctx, low, c = (np.frombuffer(b"".join(x or b"" for x in part[n].to_pylist()), kind) for n, kind in (("ctx", np.int64), ("low", np.int64), ("c", np.int32)))
            first, c = _sums(joined(ctx, low) if whole else ctx, c.astype(np.int64))
            first, c = first[c >= least], c[c >= least]
            parts.append(pa.table([pa.array(ctx[first]), pa.array(low[first]) if whole else pa.nulls(len(first), pa.int64()), pa.array(c)], names=["ctx", "low", "c"]))
        return pa.concat_tables(parts)

    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        dealt = docs.mapInArrow(run, "bucket int, ctx binary, low binary, c binary")
        found = materialize(dealt.groupBy("bucket").applyInArrow(summed, "ctx long, low long, c long"), "entries")
    sent.destroy()  # each executor keeps it in a file
    return found


def _named(entries: DataFrame) -> DataFrame:
    """entries with key, that of the whole run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = joined(b.column("ctx").to_numpy(), b.column("low").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(key), *b.columns], names=["key", *b.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema.fields)
    return entries.mapInArrow(run, f"key long, {kinds}")


@dataclass
class Model:
    """rest: key, base, value and known of all runs of the model but those in head, some in several rows that add up; a text's sums over its runs, plus `unseen` a token, are its scores."""

    total: int
    unseen: float
    longest: int
    head: tuple[np.ndarray, ...]
    rest: DataFrame
    within: Bitmap


def fit(docs: DataFrame, *, depth: int | None = 3, least: int = 2, gain: float = 8.0, p_head: float = 2.5e-7, bucket_tokens: int = 500_000) -> Model:
    """The model of texts (column text, null as empty), with contexts of up to depth words; None: until a level has no node.

    All entries that occur `least` times count, and all contexts whose divergence from the suffix above, times their count, is `gain` nats.
    A level is written once: its entries meet the words or pairs below them in two joins, and what is asked of a context's entries together is a window over
    the second join's partitions (a context has as many rows as words follow it, however often).
    """
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        counts = materialize(_words(docs), "words")
    size = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(size["n"] or 0), int(size["v"])
    smoothed = total + 0.5 * (distinct + 1)
    unseen = float(np.log10(0.5 / smoothed))
    buckets = min(1 << 20, max(1, -(-total // bucket_tokens)))
    one, zero = (F.col("c") + 0.5) / smoothed, F.lit(0.0)
    gained = F.log10(one) - unseen
    parts = [counts.select("key", "c", gained.alias("base"), gained.alias("value"), F.lit(1).cast("long").alias("known"))]
    above, seen, longest = counts.select("key", one.alias("p")), counts.select(F.col("key").alias("ctx"), F.col("c").alias("seen")), 1
    levels: list[DataFrame] = []
    frequent, opened, pairs = Bitmap(counts.where(F.col("c") >= least)) if total else None, None, None
    of = Window.partitionBy("ctx")
    p, spared = F.col("p"), lambda x: F.least(F.greatest(1 - x, F.lit(1e-12)), F.lit(1.0))  # what the entries leave to all other words
    for level in (itertools.count(1) if depth is None else range(1, depth + 1)) if total else ():
        found = _entries(docs, level, least, frequent, opened, buckets)
        if opened is not None:
            seen = found.where("low IS NULL").select("ctx", F.col("c").alias("seen"))
        met = found.where("low IS NOT NULL").join(above.select(F.col("key").alias("low"), F.col("p").alias("above")), "low").join(seen, "ctx")
        spent = F.col("c") - DISCOUNT
        judged = (
            met.withColumn("left", 1 - F.sum(spent).over(of) / F.col("seen"))
            .withColumn("p", spent / F.col("seen") + F.col("left") * F.col("above"))
            .withColumns({
                "own": F.sum(p * F.log(p / F.col("above"))).over(of), "q": spared(F.sum("p").over(of)), "r": spared(F.sum("above").over(of)),
                "as_node": F.sum(-F.col("c") * F.log("p")).over(of), "as_suffix": F.sum(-F.col("c") * F.log("above")).over(of), "lead": F.col("low") == F.min("low").over(of),
            })
            .withColumn("node", F.col("seen") * (F.col("own") + F.col("q") * F.log(F.col("q") / F.col("r"))) >= gain)
            .withColumn("open", F.when(F.col("node"), F.col("as_node")).otherwise(F.col("as_suffix")) >= gain)
            .where("node OR open")
            .select("ctx", "low", "c", "open", "node", "lead", F.when(F.col("node") & F.col("lead"), F.col("seen")).alias("seen"), F.when(F.col("node"), F.log10("left")).alias("left"),
                    F.when(F.col("open"), F.when(F.col("node"), p).otherwise(F.col("above"))).alias("p"), F.when(F.col("node"), F.log10(p / F.col("above")) - F.log10("left")).alias("value"))
        )
        last = F.lit(level == depth)
        kept = _named(judged).withColumn("ctx", F.when(F.col("lead"), F.col("ctx"))).withColumn("p", F.when(~last, F.col("p"))).drop("low")
        written = materialize(kept.where(~last | F.col("node")), "level")
        levels.append(written)
        parts.append(written.where("node AND lead").select(F.col("ctx").alias("key"), F.col("seen").alias("c"), zero, "left", F.lit(0).cast("long")))
        parts.append(written.where("node").select("key", "c", zero, "value", F.lit(0).cast("long")))
        going_on, longest = written.where("open").select("key", "p"), level + 1
        stop = level == depth or written.where("node").isEmpty() or going_on.isEmpty()
        if level == 1 and not stop:  # all pairs are contexts of the second level
            pairs = materialize(_named(found).select(F.col("key").alias("ctx"), F.col("c").alias("seen")), "pairs")
            above, seen, frequent = going_on, pairs, Bitmap(pairs.select(F.col("ctx").alias("key")))
        elif not stop:
            above, frequent, opened = going_on, Bitmap(going_on.select("key")), Bitmap(written.where("open AND lead").select(F.col("ctx").alias("key")))
        release(found, *([pairs] if pairs is not None and (stop or level > 1) else []))
        if stop:
            break
    bound = max(1.0, p_head * total)
    every = functools.reduce(DataFrame.union, parts)
    names = ["key", "base", "value", "known"]
    head, rest = every.where(F.col("c") >= bound).select(*names), every.where(F.col("c") < bound).select(*names)
    got = head.groupBy("key").agg(F.sum("base").alias("base"), F.sum("value").alias("value"), F.max("known").alias("known")).orderBy("key").toArrow()  # at most 1/p_head of each length
    kept = materialize(rest, "rest")
    within = Bitmap(kept.select("key"))
    release(counts, *levels)
    return Model(total, unseen, longest, tuple(got.column(n).to_numpy() for n in names), kept, within)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", most: int = 500, bucket_tokens: int = 1_000_000) -> DataFrame:
    """docs without the text, plus n_tokens, n_known, train_tokens (long), base_score and score (log10 probabilities of the text).

    Null text is as empty text: its end alone. Without training texts every token is unknown. Extra columns pass through, but those with the names of results are replaced, and names that begin with two underscores are reserved.
    """
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    spark = docs.sparkSession
    carried = docs.select(*[c for c in docs.columns if c not in (text_col, *results)], F.monotonically_increasing_id().alias("__row"), F.col(text_col).alias("__text"))
    sent = spark.sparkContext.broadcast((model.longest, [packed(x, rising=k == 0) for k, x in enumerate(model.head)], [x.dtype for x in model.head], model.within))
    buckets = min(1 << 20, max(1, -(-model.total // bucket_tokens)))
    sums = ("__known", "__base", "__score")
    own = [f for f in carried.schema.fields if f.name != "__text"]
    blobs = ["__rows", "__keys", *(f"{x}s" for x in sums)]  # packed: of a bucket's runs the texts and keys, then of its texts the sums
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own), "n_tokens long, __known long, __base double, __score double, __bucket int", *(f"{x} binary" for x in blobs)])
    schema = T._parse_datatype_string(kinds)
    arrow = to_arrow_schema(schema)

    def made(n: int, **columns) -> pa.Table:
        """A table of n rows of the schema, null where no column is given."""
        got = {k: pa.array(x) if isinstance(x, np.ndarray) else x for k, x in columns.items()}
        return pa.table([(got[f.name] if got[f.name].type == f.type else got[f.name].cast(f.type)) if f.name in got else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def cut(x: np.ndarray, edges: np.ndarray, rising: bool = False) -> pa.Array:
        return pa.array([packed(x[a:b], rising) for a, b in itertools.pairwise(edges.tolist())], pa.binary())

    def array(column: pa.ChunkedArray, kind: type, rising: bool = False) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind), *(unpacked(x.as_py(), kind, rising) for x in column if x.is_valid)])

    def bucket_of(key: np.ndarray) -> np.ndarray:
        """Rises with the key, as a number without sign."""
        return (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)

    def edges_of(ranked: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(ranked) else np.zeros(1, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest, head, kinds_, within = sent.value
        keys, *values = (unpacked(x, kind, rising=k == 0) for k, (x, kind) in enumerate(zip(head, kinds_, strict=True)))
        find = Lookup(keys)
        for whole in batches:
            rows, rest, ids = [], [], whole.column("__row").to_numpy()
            for start in range(0, whole.num_rows, most):
                batch = whole.slice(start, most)
                tokens, lengths = word_hashes(batch.column("__text"))
                n, row = len(lengths), np.repeat(np.arange(len(lengths)), lengths)
                total = np.zeros((3, n))
                for length, (key, inside) in enumerate(runs(tokens, longest)):
                    key, at_row = key[inside], row[inside]
                    which, at = find.hits(key)
                    of = at_row[which]
                    for k, v in enumerate(values):
                        if length == 0 or k == 1:  # longer runs have values alone
                            total[k] += np.bincount(of, v[at], n)
                    open_ = within(key)
                    rows.append(at_row[open_] + start)
                    rest.append(key[open_])
                yield from made(
                    n, n_tokens=lengths.astype(np.int64), __known=total[2].astype(np.int64), __base=total[0], __score=total[1],
                    __bucket=((ids[start : start + n].view(np.uint64) * np.uint64(_SPREAD)) >> np.uint64(32)).astype(np.int64) % buckets, **{f.name: batch.column(f.name) for f in own},
                ).to_batches()
            row, key = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, rest))
            by = _order(key, near=True)
            row, key = ids[row[by]], key[by].view(np.uint64)
            bucket = bucket_of(key)
            edges = edges_of(bucket)
            yield from made(len(edges) - 1, __bucket=bucket[edges[:-1]], __rows=cut(row, edges), __keys=cut(key, edges, rising=True)).to_batches()

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of the model as one row a bucket for each REST_RUNS of them."""
        for group in _held(batches, REST_RUNS):
            key = group["key"].to_numpy().view(np.uint64)
            by = _order(key, near=True)
            bucket = bucket_of(key[by])
            edges = edges_of(bucket)
            columns = [cut(group[n].to_numpy()[by], edges) for n in ("base", "value", "known")]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]].astype(np.int32)), cut(key[by], edges, rising=True), *columns], names=["__bucket", "keys", "bases", "values", "knowns"])

    def met(asked: pa.Table, known: pa.Table) -> pa.Table:
        """The sums that a bucket of the model gives its runs' texts, dealt by text; rows of texts pass as they are."""
        whole = pc.is_valid(asked["n_tokens"])
        runs_ = asked.filter(pc.invert(whole))
        row, key = array(runs_["__rows"], np.int64), array(runs_["__keys"], np.uint64, rising=True).view(np.int64)
        have, at = np.unique(array(known["keys"], np.uint64, rising=True).view(np.int64), return_inverse=True)
        value = [np.bincount(at, array(known[n], np.float64), len(have)) for n in ("bases", "values")]
        is_known = np.zeros(len(have), bool)
        is_known[at[array(known["knowns"], np.int64) > 0]] = True
        find = Lookup(have)(key)
        hit = find >= 0
        ids, of = np.unique(row[hit], return_inverse=True)
        three = [np.bincount(of, v[find[hit]], len(ids)) for v in (is_known.astype(float), *value)]
        bucket = ((ids.view(np.uint64) * np.uint64(_SPREAD)) >> np.uint64(32)).astype(np.int64) % buckets
        by = np.argsort(bucket, kind="stable")
        edges = edges_of(bucket[by])
        sent_on = {f"{n}s": cut(v[by], edges) for n, v in zip(sums, three, strict=True)}
        return pa.concat_tables([asked.filter(whole).cast(arrow), made(len(edges) - 1, __bucket=bucket[by][edges[:-1]], __rows=cut(ids[by], edges, rising=True), **sent_on)])

    def added(parts: pa.Table) -> pa.Table:
        """The texts of a bucket with what buckets of the model have for them."""
        whole = pc.is_valid(parts["n_tokens"])
        texts, more = parts.filter(whole), parts.filter(pc.invert(whole))
        ids = texts["__row"].to_numpy()
        by = np.argsort(ids)
        at = by[np.searchsorted(ids[by], array(more["__rows"], np.int64, rising=True))] if len(ids) else np.zeros(0, np.int64)
        full = {n: texts[n].to_numpy() + np.bincount(at, array(more[f"{n}s"], np.float64), len(ids)) for n in sums}
        return made(len(ids), n_tokens=texts["n_tokens"].to_numpy(), __known=full["__known"].astype(np.int64), __base=full["__base"], __score=full["__score"], **{f.name: texts[f.name] for f in own})

    known = model.rest.select("key", "base", "value", "known").mapInArrow(told, "__bucket int, keys binary, bases binary, values binary, knowns binary")
    asked = carried.mapInArrow(run, schema).groupBy("__bucket").cogroup(known.groupBy("__bucket")).applyInArrow(met, schema)
    with arrow_rows(spark, TEXT_ROWS):
        out = materialize(asked.groupBy("__bucket").applyInArrow(added, schema).select(*[f"`{f.name}`" for f in own], "n_tokens", *sums), "scored")
    sent.destroy()
    whole = lambda x: F.col(x) + F.col("n_tokens") * F.lit(model.unseen)
    return out.withColumns({"n_known": F.col("__known"), "train_tokens": F.lit(model.total).cast("long"), "base_score": whole("__base"), "score": whole("__score")}).drop("__row", *sums)
