"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Every position of a text is labelled from the state of one network that has read up to it and one that has read back to it, within a
window of bytes; a document's probabilities are the mean over all its positions. Trained by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8


class Network:
    """Two gated recurrent layers (one per direction) with a table of input weights per byte, and a softmax over the labels at each position."""

    def __init__(self, labels: list[str], hidden: int = 8, window: int = 64, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden, self.window = labels, hidden, window
        f = np.float32
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(f)
            self.p[f"u{d}"] = (rng.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(f)
        self.p["v"] = (rng.normal(0, 1, (2 * hidden, len(labels))) / np.sqrt(2 * hidden)).astype(f)
        self.p["c"] = np.zeros(len(labels), f)

    def _states(self, x: np.ndarray, d: str, tape: list | None = None) -> np.ndarray:
        """States after each position; x is (time, batch). Direction b reads from the end."""
        n, table, u = self.hidden, self.p[f"x{d}"], self.p[f"u{d}"]
        steps, batch = x.shape
        out = np.empty((steps, batch, n), np.float32)
        h = np.zeros((batch, n), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a, r = table[x[t]], h @ u
            zr = a[:, : 2 * n] + r[:, : 2 * n]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            z, g = zr[:, :n], zr[:, n:]
            new = np.tanh(a[:, 2 * n :] + g * r[:, 2 * n :])
            if tape is not None:
                tape.append((t, h, z, g, new, r[:, 2 * n :]))
            h = new + z * (h - new)
            out[t] = h
        return out

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the labels at every position of x, (time, batch)."""
        both = np.concatenate((self._states(x, "f"), self._states(x, "b")), 2)
        y = both @ self.p["v"] + self.p["c"]
        y -= y.max(2, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(2, keepdims=True)
        return y

    def gradient(self, x: np.ndarray, target: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the positions of mask, and its gradient."""
        n = self.hidden
        tape = {"f": [], "b": []}
        both = np.concatenate([self._states(x, d, tape[d]) for d in "fb"], 2)
        y = both @ self.p["v"] + self.p["c"]
        y -= y.max(2, keepdims=True)
        y -= np.log(np.exp(y).sum(2, keepdims=True))
        total = mask.sum()
        loss = -float((np.take_along_axis(y, target[None, :, None].repeat(len(x), 0), 2)[:, :, 0] * mask).sum() / total)
        dy = np.exp(y)
        dy[:, np.arange(x.shape[1]), target] -= 1
        dy *= (mask / total)[:, :, None]
        g = {"v": np.einsum("tbi,tbj->ij", both, dy), "c": dy.sum((0, 1))}
        back = dy @ self.p["v"].T
        for d, part in (("f", back[:, :, :n]), ("b", back[:, :, n:])):
            u = self.p[f"u{d}"]
            gx, gu = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(u)
            dh = np.zeros(part.shape[1:], np.float32)
            for t, h, z, r, new, ru in reversed(tape[d]):
                dh = dh + part[t]
                dnew = dh * (1 - z) * (1 - new * new)
                da = np.concatenate((dh * (h - new) * z * (1 - z), dnew * ru * r * (1 - r), dnew), 1)
                du = da.copy()
                du[:, 2 * n :] *= r
                np.add.at(gx, x[t], da)
                gu += h.T @ du
                dh = dh * z + du @ u.T
            g[f"x{d}"], g[f"u{d}"] = gx, gu
        return loss, g

    def fit(self, texts: list[bytes], targets: list[int], *, steps: int = 600, batch: int = 128, rate: float = 0.02, seed: int = 11) -> float:
        """Adam over windows at random places; labels are drawn evenly. Gives the mean loss of the last steps."""
        rng = np.random.default_rng(seed)
        by = [[t for t, y in zip(texts, targets, strict=True) if y == k and t] for k in range(len(self.labels))]
        have = [k for k, ts in enumerate(by) if ts]
        if not have:
            return float("nan")
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in "mv")
        losses = []
        for step in range(1, steps + 1):
            y = rng.choice(have, batch)
            x, mask = np.zeros((self.window, batch), np.uint8), np.zeros((self.window, batch), np.float32)
            for j, k in enumerate(y):
                text = by[k][rng.integers(len(by[k]))]
                at = rng.integers(max(1, len(text) - self.window + 1))
                piece = text[at : at + self.window]
                x[: len(piece), j] = np.frombuffer(piece, np.uint8)
                mask[: len(piece), j] = 1
            loss, g = self.gradient(x, y, mask)
            losses.append(loss)
            now = rate * min(1, step / 20) * (1 - step / (steps + 1))
            norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
            for k, q in g.items():
                q = q * min(1.0, 1 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.99 * v[k] + 0.01 * q * q
                self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return float(np.mean(losses[-50:]))

    def pool(self, texts: list[bytes], batch: int = 2048) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for an empty one."""
        out = np.zeros((len(texts), len(self.labels)))
        w = self.window
        sizes = np.array([len(t) for t in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), -(-sizes // w))
        if not len(owner):
            return out
        flat = np.frombuffer(b"".join(t + bytes(-len(t) % w) for t in texts), np.uint8).reshape(-1, w)
        last = np.r_[owner[1:] != owner[:-1], True]
        used = np.where(last, (sizes[owner] - 1) % w + 1, w)
        for s in range(0, len(flat), batch):
            x = np.ascontiguousarray(flat[s : s + batch].T)
            y = self.positions(x)
            short = used[s : s + batch] < w
            y[:, short] *= (np.arange(w)[:, None] < used[s : s + batch][short])[:, :, None]
            np.add.at(out, owner[s : s + batch], y.sum(0))
        return out / np.maximum(sizes, 1)[:, None]


def sample(docs: DataFrame, *, per_label: int = 400, chars: int = 600, label_col: str = "lang", text_col: str = "text") -> list[tuple[str, str]]:
    """About per_label rows of each label (all, if there are fewer), one window of chars characters of each at a place drawn by a hash of the text."""
    rows = docs.where(F.col(label_col).isNotNull() & (F.length(F.coalesce(F.col(text_col), F.lit(""))) > 0))
    seen = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}  # one row per label
    if not seen:
        return []
    draw = F.pmod(F.xxhash64(F.lit(3), text_col), F.lit(1_000_000))
    share = None
    for k in sorted(seen):
        part = (F.col(label_col) == k) & (draw < int(min(1.0, 1.5 * per_label / seen[k]) * 1_000_000 + 1))
        share = part if share is None else share | part
    start = F.pmod(F.xxhash64(F.lit(5), text_col), F.greatest(F.lit(1), F.length(text_col) - chars)).cast("int") + 1
    got = rows.where(share).select(label_col, F.substr(F.col(text_col), start, F.lit(chars)).alias("piece"), draw.alias("draw")).collect()
    out, kept = [], dict.fromkeys(seen, 0)
    for r in sorted(got, key=lambda r: (r["draw"], r["piece"])):
        if kept[r[0]] < per_label:
            kept[r[0]] += 1
            out.append((r["piece"], r[0]))
    return out


def train(docs: DataFrame, *, per_label: int = 400, hidden: int = 8, window: int = 64, steps: int = 600, label_col: str = "lang", text_col: str = "text") -> Network:
    rows = sample(docs, per_label=per_label, label_col=label_col, text_col=text_col)
    labels = sorted({y for _, y in rows})
    net = Network(labels, hidden, window)
    net.fit([utf8(t) for t, _ in rows], [labels.index(y) for _, y in rows], steps=steps)
    return net


def identify(docs: DataFrame, net: Network, *, text_col: str = "text") -> DataFrame:
    """docs without the text, plus lang_pred and score (the label's mean probability).

    Null text, text without a letter, and a network without labels: `und` with score 0. Extra columns pass through, but those named lang_pred or score are replaced, and __text is reserved.
    """
    letters = F.coalesce(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.lit(False))
    carried = docs.select(*[c for c in docs.columns if c not in (text_col, "lang_pred", "score")], F.when(letters, F.col(text_col)).alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(net)  # some thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                batch = whole.slice(i, 1000)
                texts = batch.column("__text").to_pylist()
                labels = sent.value.labels
                p = sent.value.pool([utf8(t) for t in texts]) if labels else None
                best = p.argmax(1) if labels else None
                pred = [labels[best[k]] if labels and t is not None else "und" for k, t in enumerate(texts)]
                score = [min(1.0, float(p[k, best[k]])) if labels and t is not None else 0.0 for k, t in enumerate(texts)]
                kept = [f.name for f in batch.schema if f.name != "__text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*kept, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields if f.name != "__text"), "lang_pred string, score double"])
    return carried.mapInArrow(run, schema)
