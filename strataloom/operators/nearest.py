"""Exact nearest records of many queries: blocks of queries against blocks of records, each pair of blocks a task of bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of a block's vectors, rows of a block, pairs that a task has at least, and rows and pairs that are worked at once. Fixed values.
ELEMENTS, ROWS, PAIRS, TILE, AT_ONCE = 2**21, 2**15, 4_000_000, (256, 4096), 2**15
_LEAST = -1e308  # below every key of finite vectors
_NULL = -np.finfo(np.float64).max


def nearest(queries: DataFrame, records: DataFrame, k: int, measure: str, max_queries: int = 16_384) -> DataFrame:
    """query_id, id and value for queries (query_id, vector) and records (id, vector) of other ids: a superset of each query's k records that come first by value, then id.

    measure: `cosine` (value: cosine similarity, greatest first, 0 with a zero or missing vector) or `squared` (squared distance, least first). Values are
    summed in the order of dimensions in double precision and rounded to six digits. Every pair is compared: a matrix product leaves out those that rounding
    cannot bring among a query's first k, the others are computed anew. A task holds one block of each side, and gives at most k rows a query.
    """
    spark = records.sparkSession
    q, r = queries.where("query_id IS NOT NULL"), records.where("id IS NOT NULL")
    n_q, wide_q = q.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    n_r, wide_r = r.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    rows = max(256, min(ROWS, ELEMENTS // max(1, wide_q, wide_r)))
    q_blocks = max(1, -(-n_q // min(rows, max_queries)))
    wanted = min(2 * spark.sparkContext.defaultParallelism, n_q * n_r // PAIRS)
    r_blocks = max(1, -(-n_r // rows), -(-wanted // q_blocks))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = q.select(F.col("query_id").alias("id"), "vector", F.lit(True).alias("asks"), block("query_id", q_blocks).alias("own"), every(r_blocks).alias("other"))
    b = r.select("id", "vector", F.lit(False).alias("asks"), block("id", r_blocks).alias("own"), every(q_blocks).alias("other"))
    a = a.select("id", "vector", "asks", (F.col("own") * r_blocks + F.col("other")).alias("cell"))
    b = b.select("id", "vector", "asks", (F.col("other") * r_blocks + F.col("own")).alias("cell"))
    dealt = a.unionByName(b).repartitionById(q_blocks * r_blocks, F.col("cell"))
    kind = dict(dealt.dtypes)["id"]
    met = dealt.mapInArrow(lambda batches: _cells(batches, k, measure), f"query_id {kind}, id {kind}, value double")
    return met.select(F.col("query_id").cast(dict(queries.dtypes)["query_id"]), F.col("id").cast(dict(records.dtypes)["id"]), "value")


def _cells(batches: Iterator[pa.RecordBatch], k: int, measure: str) -> Iterator[pa.RecordBatch]:
    cells: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        for cell in pc.unique(batch.column("cell")).to_pylist():
            cells.setdefault(cell, []).append(batch.filter(pc.equal(batch.column("cell"), cell)))
    for cell in list(cells):
        table = pa.Table.from_batches(cells.pop(cell))
        asks = table.column("asks")
        q, r = table.filter(asks), table.filter(pc.invert(asks))
        if len(q) and len(r):
            yield from _cell(q, r, k, measure)


class _Side:
    """Ids and vectors of a block as arrays; shorter vectors are padded with zeros. odd: what a matrix product does not bound; void: no vector, or one with nulls."""

    def __init__(self, table: pa.Table, wide: int, order: np.ndarray | None = None):
        lists = table.column("vector").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        if order is not None:
            lists = lists.take(pa.array(order))
        size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        flat = lists.flatten()
        at = np.repeat(np.arange(len(lists)), size)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.v = np.zeros((len(lists), wide))
        self.v[at, place] = np.asarray(pc.fill_null(flat, 0)).astype(np.float64)
        self.void = np.asarray(pc.is_null(lists)).copy()
        self.void[at[np.asarray(pc.is_null(flat))]] = True
        self.size = size
        self.square = _summed(self.v, self.v)
        self.norm = np.sqrt(self.square)
        usual = (self.square == 0) | ((self.norm > 1e-100) & (self.norm < 1e100))
        self.odd = self.void | ~usual | (size != wide)


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row the products' sum, one dimension after the other."""
    out = np.zeros(len(a))
    for x in np.ascontiguousarray((a * b).T):
        out += x
    return out


def _rounded(x: np.ndarray) -> np.ndarray:
    """To six digits, halves away from zero."""
    y = x * 1e6
    whole = np.trunc(y)
    whole += np.copysign(np.abs(y - whole) >= 0.5, y)
    return np.where(np.isfinite(y), whole / 1e6, x) + 0.0


def _keys(q: _Side, r: _Side, i: np.ndarray, j: np.ndarray, measure: str) -> np.ndarray:
    """Keys of pairs, greatest first: not-a-number and null keep the places that they have in a sort."""
    out = np.empty(len(i))
    for s in range(0, len(i), AT_ONCE):
        a, b = i[s : s + AT_ONCE], j[s : s + AT_ONCE]
        x, y = q.v[a], r.v[b]
        void, unlike = q.void[a] | r.void[b], q.size[a] != r.size[b]
        if measure == "cosine":
            norms = q.norm[a] * r.norm[b]
            met = ~(norms <= 0) & ~void
            key = _rounded(np.divide(_summed(x, y), norms, out=np.zeros(len(a)), where=met))
            key = np.where(np.isnan(key), np.inf, np.where(met & unlike, _NULL, key))
        else:
            gap = x - y
            key = -_rounded(_summed(gap, gap))
            key = np.where(np.isnan(key), -np.inf, np.maximum(key, _NULL / 2))
            key = np.where(void | unlike, np.inf, key)
        out[s : s + AT_ONCE] = key
    return out


def _values(key: np.ndarray, measure: str) -> pa.Array:
    if measure == "cosine":
        return pa.array(np.where(key == np.inf, np.nan, key), mask=key == _NULL)
    return pa.array(np.where(key == -np.inf, np.nan, np.where(key == _NULL / 2, np.inf, -key)) + 0.0, mask=key == np.inf)


def _cell(queries: pa.Table, records: pa.Table, k: int, measure: str) -> Iterator[pa.RecordBatch]:
    ids = pa.concat_arrays([*queries.column("id").chunks, *records.column("id").chunks])
    code = np.asarray(pc.rank(ids, sort_keys="ascending", tiebreaker="dense")).astype(np.int64)
    own, code = code[: len(queries)], code[len(queries) :]
    order = np.argsort(code, kind="stable")  # a later record loses against an equal one before it
    code = code[order]
    wide = max([pc.max(pc.list_value_length(t.column("vector"))).as_py() or 0 for t in (queries, records)])
    with np.errstate(all="ignore"):
        q, r = _Side(queries, wide), _Side(records, wide, order)
        if measure == "cosine":
            turned = lambda s: s.v * np.where(s.odd | (s.norm == 0), 0, 1 / s.norm)[:, None]
        else:
            turned = lambda s: np.where(s.odd[:, None], 0, s.v)
        a, b = turned(q), turned(r)
        square = lambda s: np.where(s.odd, 0, s.square)
        for s in range(0, len(own), TILE[0]):
            at = slice(s, s + TILE[0])
            n = len(own[at])
            best_key, best_at = np.full((n, k), -np.inf), np.full((n, k), -1)
            low, high = np.searchsorted(code, own[at]), np.searchsorted(code, own[at], side="right")
            for t in range(0, len(code), TILE[1]):
                near = a[at] @ b[t : t + TILE[1]].T
                slack = 1e-9
                if measure == "squared":
                    near = 2 * near - square(q)[at][:, None] - square(r)[t : t + TILE[1]][None, :]
                    slack += 1e-14 * (wide + 8) * (square(q)[at].max() + square(r)[t : t + TILE[1]].max())
                odd = r.odd[t : t + TILE[1]]
                if odd.any():
                    near[:, odd] = -np.inf
                if t:
                    least = best_key[:, -1] + 4e-7 - slack
                    least[best_at[:, -1] < 0] = _LEAST
                else:
                    own_out(near, low, high, t)
                    m = near.shape[1]
                    least = np.partition(near, m - k, axis=1)[:, m - k] - 1.1e-6 - 2 * slack if m >= k else np.full(n, _LEAST)
                least = np.maximum(least, _LEAST)
                least[q.odd[at]] = _LEAST
                near[:, odd] = np.inf
                near[q.odd[at]] = np.inf
                own_out(near, low, high, t)
                i, j = np.nonzero(near >= least[:, None])
                if len(i):
                    _kept(best_key, best_at, i, j + t, _keys(q, r, i + s, j + t, measure), k)
            i, j = np.nonzero(best_at >= 0)
            found = best_at[i, j]
            yield pa.record_batch([_taken(queries, i + s), _taken(records, order[found]), _values(best_key[i, j], measure)], names=["query_id", "id", "value"])


def own_out(near: np.ndarray, low: np.ndarray, high: np.ndarray, t: int) -> None:
    """A query's own id is none of its records."""
    for i in np.nonzero((high > low) & (low < t + near.shape[1]) & (high > t))[0]:
        near[i, max(low[i] - t, 0) : high[i] - t] = -np.inf


def _kept(best_key: np.ndarray, best_at: np.ndarray, i: np.ndarray, j: np.ndarray, key: np.ndarray, k: int) -> None:
    """Takes pairs (query, record, key) into the first k by falling key, then record."""
    rows = np.unique(i)
    x, y = np.nonzero(best_at[rows] >= 0)
    i, j, key = np.concatenate([rows[x], i]), np.concatenate([best_at[rows[x], y], j]), np.concatenate([best_key[rows[x], y], key])
    order = np.lexsort((j, -key, i))
    i, j, key = i[order], j[order], key[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    first = nth < k
    best_key[i[first], nth[first]], best_at[i[first], nth[first]] = key[first], j[first]


def _taken(table: pa.Table, at: np.ndarray) -> pa.Array:
    out = table.column("id").take(pa.array(at))
    return out.combine_chunks() if isinstance(out, pa.ChunkedArray) else out
