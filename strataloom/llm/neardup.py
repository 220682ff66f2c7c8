"""Near-duplicate documents by SetSketch registers, banded, estimated by joint likelihood, then verified on full sets.

Registers are truncated logarithms of minima of exponential hashes: the register of a union is the maximum of the registers, and equal
registers are likelier the more two sets share. Documents with one and the same set are one node. Nodes that agree on a band of registers
meet in a bucket; a bucket's nodes are first compared with its representative, and then, in blocks, only with nodes that are
still in another component, so that large groups of copies cost in proportion to their size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.graph import connected_components
from .common import arrow_rows, materialize, space_words

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

TEXT_ROWS = 500  # texts that are sent to Python, and worked on, at a time

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n of the hashed words h."""
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * _M1 + h[k : len(h) - n + 1 + k])
    return out


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Of each text: sorted distinct 64-bit hashes of its runs of width words; of the whole sequence, if it has fewer; empty without words."""
    words = [space_words(t) for t in texts]
    ends = np.cumsum([len(w) for w in words], dtype=np.int64).tolist()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, ends[-1] if ends else 0)
    runs = _runs(h, width) if len(h) >= width else h[:0]  # of all texts end to end; those across texts are not taken
    out, start = [], 0
    for end in ends:
        v = np.sort(runs[start : end - width + 1] if end - start >= width else _runs(h[start:end], end - start) if end > start else h[:0])
        fresh = np.ones(len(v), bool)
        np.not_equal(v[1:], v[:-1], out=fresh[1:])
        out.append(v[fresh])
        start = end
    return out


def shingles(text: str | None, width: int) -> np.ndarray:
    """shingle_sets of one text."""
    return shingle_sets([text], width)[0]


class Sketch:
    """Parameters: registers = bands * rows, of which the first `kept` serve for estimates; base and scale of the exponential spacing; registers lie in [0, limit]."""

    def __init__(self, bands: int = 80, rows: int = 8, base: float = 1.1, scale: float = 20.0, limit: int = 255, kept: int = 256, seed: int = 1):
        self.bands, self.rows, self.base, self.scale, self.limit, self.kept = bands, rows, base, scale, limit, kept
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
        self.c = mix(rng.integers(0, 2**63, bands * rows, dtype=np.uint64)) | np.uint64(1)

    def registers(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of registers per set; none may be empty."""
        out = np.zeros((len(sets), len(self.a)), np.uint8)
        sizes = np.array([len(s) for s in sets])
        start = 0
        while start < len(sets):  # pieces that stay in the processor's cache
            stop = max(start + 1, int(np.searchsorted(np.cumsum(sizes[start:]), 30_000)) + start)
            x = np.concatenate(sets[start:stop])
            at = np.concatenate(([0], np.cumsum(sizes[start:stop])[:-1]))
            top = np.empty((len(self.a), stop - start), np.uint64)
            y = np.empty_like(x)
            for j in range(len(self.a)):
                np.multiply(x, self.a[j], out=y)
                np.add(y, self.b[j], out=y)
                np.maximum.reduceat(y, at, out=top[j])
            least = -np.log1p(-((~top).astype(np.float64) + 0.5) / 2.0**64)  # the least of exponential hashes
            value = np.floor(1 - np.log(least * (1 / self.scale)) / np.log(self.base))
            out[start:stop] = np.clip(value, 0, self.limit).T
            start = stop
        return out

    def keys(self, registers: np.ndarray) -> np.ndarray:
        """One 64-bit key per band; the band is part of it."""
        x = mix(registers.astype(np.uint64) * self.c + self.b)
        return mix(x.reshape(len(x), self.bands, self.rows).sum(2, dtype=np.uint64)).view(np.int64)

    def jaccard(self, u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
        """Maximum-likelihood similarity from how many registers are greater, less and equal, the set sizes being known."""
        more, less = (u > v).sum(1)[:, None], (u < v).sum(1)[:, None]
        same = u.shape[1] - more - less
        pu, pv = (nu / (nu + nv))[:, None], (nv / (nu + nv))[:, None]
        grid = np.linspace(0, 1, 201)[None, :]
        grid = grid * np.minimum(pu / pv, pv / pu)  # no more can be shared
        b = self.base
        p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (b - 1) / b) / np.log(b)
        p1, p2 = p(pu - pv * grid), p(pv - pu * grid)
        tiny = 1e-12
        fit = more * np.log(p1 + tiny) + less * np.log(p2 + tiny) + same * np.log(np.maximum(1 - p1 - p2, 0) + tiny)
        return np.take_along_axis(grid, fit.argmax(1)[:, None], 1)[:, 0]


def _signatures(docs: DataFrame, sketch: Sketch, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, TEXT_ROWS):
                batch = whole.slice(i, TEXT_ROWS)
                sets = shingle_sets(batch.column("text").to_pylist(), width)
                has = [k for k, s in enumerate(sets) if len(s)]
                registers = sketch.registers([sets[k] for k in has])
                keys = sketch.keys(registers)
                place = {k: n for n, k in enumerate(has)}
                marks = [int.from_bytes(xxhash.xxh3_128_digest(s.tobytes()), "little") if len(s) else None for s in sets]
                half = lambda m, shift: None if m is None else ((m >> shift) & (2**64 - 1)) - 2**63
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([half(m, 0) for m in marks], pa.int64()), pa.array([half(m, 64) for m in marks], pa.int64()),
                        pa.array([registers[place[k], : sketch.kept].tobytes() if k in place else None for k in range(len(sets))], pa.binary()),
                        pa.array([keys[place[k]] if k in place else None for k in range(len(sets))], pa.list_(pa.int64())),
                    ],
                    names=["id", "n", "f1", "f2", "registers", "keys"],
                )

    return docs.mapInArrow(run, "id long, n long, f1 long, f2 long, registers binary, keys array<long>")


def _likely(pairs: DataFrame, sig: DataFrame, sketch: Sketch, least: float) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is at least `least`."""
    side = lambda x: sig.where("n > 0").select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                x = whole.slice(i, 1000)
                u, v = (np.frombuffer(b"".join(x.column(c).to_pylist()), np.uint8).reshape(x.num_rows, -1) for c in ("ra", "rb"))
                nu, nv = (x.column(c).to_numpy() for c in ("na", "nb"))
                yield x.select(["a", "b"]).filter(pa.array(sketch.jaccard(u, v, nu, nv) >= least))

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def _sets(ids: DataFrame, docs: DataFrame, width: int, most_bits: int = 1 << 30) -> DataFrame:
    """id and set of the documents in ids (and of some others), from their texts.

    A bitmap of hashed ids, 16 bits an id and at most most_bits (128 MB), is broadcast, so that texts are filtered where they are read and not shuffled.
    Beyond that bound more of the other documents pass it; joins on id leave those out.
    """
    bits = min(most_bits, max(1 << 20, 1 << (16 * ids.count()).bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    marked = ids.select(slot("id").alias("s")).groupBy(F.bitmap_bucket_number("s").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    bitmap = np.zeros(bits // 8 + 4096, np.uint8)
    for r in marked.toLocalIterator():
        at = r["k"] * 4096
        bitmap[at : at + 4096] = np.frombuffer(r["bits"], np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, TEXT_ROWS):
                batch = whole.slice(i, TEXT_ROWS)
                bucket, at = batch.column("bucket").to_numpy(), batch.column("at").to_numpy()
                place = bucket * 4096 + (at >> 3)
                inside = (sent.value[place] >> (at & 7).astype(np.uint8)) & 1 == 1
                batch = batch.filter(pa.array(inside))
                sets = [x.view(np.int64) for x in shingle_sets(batch.column("text").to_pylist(), width)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    found = docs.where("id IS NOT NULL").select("id", "text", F.bitmap_bucket_number(slot("id")).alias("bucket"), F.bitmap_bit_position(slot("id")).alias("at"))
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        return materialize(found.mapInArrow(run, "id long, set array<long>"), "sets", scan=True)


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union. Only documents of some pair are read again."""
    sets = _sets(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), docs, width)
    shared = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
        .where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared))
        .select("a", "b").distinct()
    )


def _block(row: pa.Array) -> tuple[np.ndarray, ...]:
    """Nodes, components, set sizes and all items of the block in a list array of one row."""
    node, comp, sets = row.flatten().flatten()
    return node.to_numpy(), comp.to_numpy(), sets.value_lengths().to_numpy(), sets.flatten().to_numpy()


def _block_links(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], percent: int, columns: int = 4096) -> list[tuple[int, int]]:
    """Links between two blocks of documents: one for each two components that have any. Intersections are products of 0/1 matrices."""
    (ux, cx, nx, vx), (uy, cy, ny, vy) = x, y
    ix, iy = (np.repeat(np.arange(len(n)), n) for n in (nx, ny))
    both = np.intersect1d(vx, vy)
    shared = np.zeros((len(nx), len(ny)), np.float32)
    for s in range(0, len(both), columns):
        part = both[s : s + columns]
        m = []
        for v, i, n in ((vx, ix, len(nx)), (vy, iy, len(ny))):
            at = np.minimum(np.searchsorted(part, v), len(part) - 1)
            hit = part[at] == v
            one = np.zeros((n, len(part)), np.float32)
            one[i[hit], at[hit]] = 1
            m.append(one)
        shared += m[0] @ m[1].T
    link = (100 * shared.astype(np.float64) >= percent * (nx[:, None] + ny[None, :] - shared)) & (cx[:, None] != cy[None, :])
    seen, out = set(), []
    for i, k in np.argwhere(link).tolist():
        two = (min(cx[i], cy[k]), max(cx[i], cy[k]))
        if two not in seen:
            seen.add(two)
            out.append((int(min(ux[i], uy[k])), int(max(ux[i], uy[k]))))
    return out


def _cluster_links(clusters: DataFrame, comps: DataFrame, sig: DataFrame, docs: DataFrame, width: int, percent: int, block_docs: int = 256, block_items: int = 1 << 18) -> DataFrame:
    """Links within clusters (node, cluster) between nodes of different components.

    A cluster's nodes outside its largest component are compared, block by block, with all of its nodes; a block holds about block_docs documents
    or block_items shingles. What is joined are blocks, so neither pairs nor groups become rows or tasks of their own.
    """
    sizes = sig.where("n > 0").groupBy(F.col("id").alias("node")).agg(F.max("n").alias("n"))
    placed = clusters.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    counted = placed.groupBy("cluster", "comp").agg(F.count("*").alias("c"))
    main = counted.groupBy("cluster").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("k")).where("k > 1").drop("k")
    open_ = materialize(placed.join(main, "cluster").join(sizes, "node").withColumn("inner", F.col("comp") == F.col("main")).drop("main"), "open")
    shape = open_.groupBy("cluster", "inner").agg(F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n") / block_items)).cast("long").alias("blocks"))
    sets = _sets(open_.select(F.col("node").alias("id")), docs, width)
    key = ["cluster", "inner", "block"]
    placed = open_.join(shape, ["cluster", "inner"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).select(*key, "node", "comp")
    blocks = materialize(placed.join(sets.withColumnRenamed("id", "node"), "node").groupBy(*key).agg(F.collect_list(F.struct("node", "comp", "set")).alias("rows")), "blocks")
    names = blocks.select(*key)
    pairs = names.where("NOT inner").select("cluster", F.col("inner").alias("i1"), F.col("block").alias("b1")).join(names.select("cluster", F.col("inner").alias("i2"), F.col("block").alias("b2")), "cluster").where("i2 OR b2 >= b1")
    side = lambda k: blocks.select("cluster", F.col("inner").alias(f"i{k}"), F.col("block").alias(f"b{k}"), F.col("rows").alias(f"r{k}"))
    full = pairs.join(side(1), ["cluster", "i1", "b1"]).join(side(2), ["cluster", "i2", "b2"]).select("r1", "r2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                one = whole.slice(i, 1)
                found = _block_links(_block(one.column("r1")), _block(one.column("r2")), percent)
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    with arrow_rows(docs.sparkSession, 4):  # a row holds two blocks
        return materialize(full.mapInArrow(run, "a long, b long"), "links")


def _bucket_links(rest: DataFrame, sig: DataFrame, sketch: Sketch, least: float, percent: int, block_docs: int = 256) -> DataFrame:
    """Pairs (a, b) of nodes of different components and clusters that meet in a bucket and are likely to be similar enough. Rest: key, node, comp, cluster.

    A bucket is cut into blocks of about block_docs nodes; blocks are what is joined, and only likely pairs leave a task as rows.
    """
    own = sig.where("n > 0").select(F.col("id").alias("node"), "n", "registers")
    counts = rest.groupBy("key").agg(F.ceil(F.count("*") / block_docs).cast("long").alias("blocks"))
    placed = rest.select("key", "node", "comp", "cluster").join(counts, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("blocks")
    blocks = materialize(placed.join(own, "node").groupBy("key", "block").agg(F.collect_list(F.struct("node", "comp", "cluster", "n", "registers")).alias("rows")), "blocks")
    side = lambda k: blocks.select("key", F.col("block").alias(f"b{k}"), F.col("rows").alias(f"r{k}"))
    full = side(1).join(side(2), "key").where("b1 <= b2").select((F.col("b1") == F.col("b2")).alias("same"), "r1", "r2")

    def arrays(row: pa.Array) -> tuple[np.ndarray, ...]:
        *numbers, registers = row.flatten().flatten()
        return *(x.to_numpy() for x in numbers), np.frombuffer(b"".join(registers.to_pylist()), np.uint8).reshape(len(registers), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                one = whole.slice(i, 1)
                (ux, cx, kx, nx, rx), (uy, cy, ky, ny, ry) = arrays(one.column("r1")), arrays(one.column("r2"))
                low, high = np.minimum(nx[:, None], ny), np.maximum(nx[:, None], ny)
                open_ = (cx[:, None] != cy) & (kx[:, None] != ky) & (100 * low >= percent * high)
                if one.column("same")[0].as_py():
                    open_ = np.triu(open_, 1)
                p, q = np.nonzero(open_)
                for j in range(0, len(p), 1000):
                    x, y = p[j : j + 1000], q[j : j + 1000]
                    hit = sketch.jaccard(rx[x], ry[y], nx[x], ny[y]) >= least
                    u, v = ux[x[hit]], uy[y[hit]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["a", "b"])

    with arrow_rows(rest.sparkSession, 16):
        return materialize(full.mapInArrow(run, "a long, b long"), "likely").distinct()


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, sketch: Sketch | None = None, margin: float = 0.15, heads_tested: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles (long), component_id (least id linked with it, directly or not), kept (it is that one).

    With 80 bands of 8 registers two sets of similarity 0.8 share a band with probability 1 - 4e-7. Estimates deviate by 0.03;
    pairs estimated more than `margin` below the threshold are not verified. Null or empty texts have no shingles and are linked with nothing.
    Rows that share an id are one document: what is linked with one is linked with the other. Rows without an id link nothing;
    such a row gets its copy's component, else null, and is kept only in the latter case. Extra columns are left out.
    """
    sketch = sketch or Sketch()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        sig = materialize(_signatures(texts, sketch, width), "signatures", scan=True)
    classes = materialize(sig.where("n > 0 AND id IS NOT NULL").groupBy("f1", "f2").agg(F.min("id").alias("id")), "classes")
    met = sig.select("id", "f1", "f2", "n", "keys").join(classes, ["f1", "f2", "id"], "left_semi").select(F.col("id").alias("node"), "n", F.explode("keys").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    buckets = materialize(met.join(shared, "key", "left_semi"), "buckets")
    heads = buckets.groupBy("key").agg(F.min(F.struct(F.xxhash64("node"), "node", "n")).alias("head"))  # one order for all: a group's buckets mostly agree on it
    similar = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)  # noqa: E731  of other sizes none are that similar
    star = buckets.join(heads, "key").where((F.col("node") != F.col("head.node")) & similar(F.col("n"), F.col("head.n")))
    # A node meets one head a band. The least few of them place it; what they leave undecided, the comparisons below settle exactly.
    few = star.select("node", F.struct(F.xxhash64("head.node").alias("h"), F.col("head.node").alias("head")).alias("x")).distinct().groupBy("node").agg(F.slice(F.array_sort(F.collect_list("x")), 1, heads_tested).alias("xs"))
    star = few.select("node", F.explode("xs").alias("x")).select("node", F.col("x.head").alias("head"))
    tested = materialize(star.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct(), "pairs")
    least = percent / 100 - margin
    likely = materialize(_likely(tested, sig, sketch, least), "likely")
    edges = materialize(_verified(likely, texts, width, percent), "links")
    comps = connected_components(edges, materialize)

    # Undecided are nodes of different components that meet in a bucket. Most of them resemble one representative: they are in one cluster.
    clusters = materialize(connected_components(likely, materialize).withColumnRenamed("component", "cluster"), "clusters")
    within = _cluster_links(clusters, comps, sig, texts, width, percent)
    # The rest of them are few: pairs that meet by chance, or beside a representative that resembles only one of the two.
    placed = buckets.join(comps, "node", "left").join(clusters, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("comp"), F.coalesce("cluster", "node").alias("cluster"))
    split = placed.groupBy("key").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).where("lo < hi").select("key")
    rest = materialize(placed.join(split, "key", "left_semi"), "rest")
    cross = _bucket_links(rest, sig, sketch, least, percent).join(tested, ["a", "b"], "left_anti")
    across = _verified(materialize(cross, "pairs"), texts, width, percent)
    more = materialize(within.unionByName(across).distinct(), "links")
    if not more.isEmpty():
        comps = connected_components(edges.unionByName(more), materialize)

    return (
        sig.select("id", "n", "f1", "f2").join(classes.withColumnRenamed("id", "node"), ["f1", "f2"], "left").join(comps, "node", "left")
        .select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "node", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component", "node", "id"), F.coalesce("component", "node").isNull()).alias("kept"),
        )
    )
