"""Toxicity by compression distance.

Two dictionaries are trained by zstandard's own trainer on labelled text: one on windows of ordinary texts, one on the passages of toxic texts that are typical of
them (word beginnings whose document frequency differs most between the labels; on whole toxic windows the trainer picks the words that both have in common).
The toxic dictionary stands behind the ordinary one, so that what both know costs the same. A window of a text is compressed with the ordinary one and with both; the
bytes that the toxic one saves are its distance. How often windows pass each threshold of bytes, over a whole text, is calibrated to a probability on labelled
texts that took no part in the dictionaries.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, utf8

_SPACES = bytes(range(9, 14))
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _SPACES, bytes(range(97, 123)) + b" " * 5)
#: Window lengths in bytes; a window ends at a space if a word allows it.
WINDOWS = (24, 48)
_WINDOW = {n: re.compile(rb" [^\n]{0,%d}(?= |$)| [^ ]{%d}|[^\n]{1,%d}" % (n, n, n)) for n in WINDOWS}
THRESHOLDS = (2, 3, 4, 5, 6)


def normal(text: str | None) -> bytes:
    """Lower-cased (A-Z) UTF-8 with single spaces, one before each word."""
    words = utf8(text).translate(_FOLD).split()
    return b" " + b" ".join(words) if words else b""


def _stems(data: bytes) -> set[bytes]:
    """Beginnings of words, with the space before and, for whole words, after them."""
    return {(b" " + w + b" ")[:n] for w in data.split() for n in range(5, 13)}


class Compressor:
    """The two dictionaries and the calibration. Compressors are made anew where the object is used."""

    def __init__(self, ordinary: bytes, toxic: bytes, level: int):
        self.dictionaries, self.level = (ordinary, toxic), level
        self.mean = self.deviation = self.weight = None
        self._made = None

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def distances(self, data: bytes, n: int) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, window by window."""
        if self._made is None:
            self._made = []
            for content in self.dictionaries:
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=self.level)
                self._made.append(zstandard.ZstdCompressor(level=self.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        plain, toxic = self._made
        return np.fromiter((len(plain(w)) - len(toxic(w)) for w in _WINDOW[n].findall(data)), np.int32)

    def features(self, text: str | None) -> list[float]:
        data = normal(text)
        out: list[float] = []
        for n in WINDOWS:
            d = self.distances(data, n)
            if not len(d):
                out += [0.0] * (2 * len(THRESHOLDS) + 2)
                continue
            top = np.sort(d)[::-1]
            over = [int((d >= t).sum()) for t in THRESHOLDS]
            out += [k / len(d) for k in over] + [math.log1p(k) for k in over] + [max(0.0, float(top[0])), max(0.0, float(top[1])) if len(top) > 1 else 0.0]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray, ordinary: float = 1.0, ridge: float = 3.0) -> None:
        """Logistic weights, shifted so that 0.5 is where the harmonic mean of precision and recall is greatest, each ordinary text standing for `ordinary` ones."""
        self.mean, self.deviation = x.mean(0), x.std(0) + 1e-6
        z = np.c_[(x - self.mean) / self.deviation, np.ones(len(x))]
        w, penalty = np.zeros(z.shape[1]), ridge * np.r_[np.ones(z.shape[1] - 1), 1e-3]
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
        margin = z @ w
        by = np.argsort(-margin, kind="stable")
        hits = np.cumsum(y[by])
        f1 = 2 * hits / (hits + ordinary * (np.arange(1, len(y) + 1) - hits) + max(1, y.sum()))
        k = int(f1.argmax())
        low = margin[by[k + 1]] if k + 1 < len(by) else margin[by[k]] - 1
        w[-1] -= (margin[by[k]] + low) / 2
        self.weight = w

    def score(self, text: str | None) -> float:
        if self.weight is None:
            return 0.0
        z = (np.array(self.features(text)) - self.mean) / self.deviation
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(z @ self.weight[:-1] + self.weight[-1]))))))


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """What zstandard's trainer makes of the samples; where they are too few for it, their own last bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" "


def fit(rows: list[tuple[str, int]], *, ordinary_weight: float = 1.0, ordinary_bytes: int = 65536, toxic_bytes: int = 4096, samples: int = 40_000, least_z: float = 6.0, least_texts: int = 3, level: int = 3) -> Compressor:
    """From (text, label) in a fixed order: two of three texts make the dictionaries, the third calibrates. Without both labels: score 0.

    ordinary_bytes and toxic_bytes are the sizes of the dictionaries; the first is trained on at most `samples` windows of 64 bytes, dealt evenly over its texts.
    A word beginning is typical if it stands in least_texts toxic texts and its share of them exceeds that of ordinary texts by least_z standard deviations.
    """
    build, held = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if i % 3 == 0]
    seen, total, texts = [Counter(), Counter()], [0, 0], [[], []]
    for text, y in build:
        data = normal(text)
        total[y] += 1
        seen[y].update(_stems(data))
        texts[y].append(data)
    typical = set()
    for s, c1 in seen[1].items():
        if c1 >= least_texts:
            c0 = seen[0][s]
            q = (c0 + c1 + 1) / (sum(total) + 2)
            z = ((c1 + 0.5) / (total[1] + 1) - (c0 + 0.5) / (total[0] + 1)) / math.sqrt(q * (1 - q) * (1 / (total[0] + 0.5) + 1 / (total[1] + 0.5)))
            if z >= least_z:
                typical.add(s)
    windows = [data[i : i + 64] for data in texts[0] for i in range(0, len(data), 64)]
    step = max(1, -(-len(windows) // samples))
    ordinary = _dictionary(ordinary_bytes, windows[::step])
    toxic = b""
    if typical:
        find = re.compile(b"|".join(re.escape(s) for s in sorted(typical, key=lambda s: (-len(s), s))))
        toxic = _dictionary(toxic_bytes, [m[0] for data in texts[1] for m in find.finditer(data)])
    made = Compressor(ordinary, ordinary + toxic, level)
    y = np.array([label for _, label in held], float)
    if len(y) and 0 < y.sum() < len(y):
        made.calibrate(np.array([made.features(t) for t, _ in held]), y, ordinary_weight)
    return made


def sample(docs: DataFrame, labels: DataFrame, *, per_label: int = 4000, chars: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[tuple[str, int]], float]:
    """At most per_label distinct texts of each label, drawn by a hash of the text and in the order of that hash; of a text longer than chars, a stretch of chars from a
    place that the hash picks. And how many ordinary texts one of the sample stands for, as a multiple of the same for toxic ones.

    Labels meet ids and hashes only; repeats go before anything is drawn, on the executors; only drawn texts are fetched.
    """
    draw = F.pmod(F.xxhash64(F.lit(9), F.col(text_col)), F.lit(1_000_000_000_000))
    known = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), draw.alias("__draw"))
    marks = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    marked = materialize(known.join(marks, "__id").groupBy("__draw", "__y").agg(F.min("__id").alias("__id")), "labelled")
    seen = {r["__y"]: r["n"] for r in marked.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    if not seen:
        return [], 1.0
    bound = F.lit(0)
    for y, n in seen.items():
        bound = F.when(F.col("__y") == y, F.lit(int(min(1.0, 1.1 * per_label / n) * 1_000_000_000_000))).otherwise(bound)
    chosen = marked.where(F.col("__draw") < bound)  # some 1.1 * per_label of each label
    start = F.pmod("__draw", F.greatest(F.length(text_col) - chars + 1, F.lit(1))) + 1
    stretch = F.substring(F.col(text_col), start.cast("int"), F.lit(chars))
    keyed = docs.select(F.col(id_col).alias("__id"), draw.alias("__draw"), F.col(text_col)).join(F.broadcast(chosen), ["__id", "__draw"])
    got = keyed.select("__draw", "__y", stretch.alias("__text")).distinct().collect()
    out = []
    for y in sorted(seen):
        out += sorted((r["__draw"], r["__text"], y) for r in got if r["__y"] == y)[:per_label]
    drawn = Counter(y for _, _, y in out)
    weight = (seen[0] / drawn[0]) / (seen[1] / drawn[1]) if drawn[0] and drawn[1] else 1.0
    return [(t, y) for _, t, y in sorted(out)], weight


def toxicity(docs: DataFrame, model: Compressor, *, text_col: str = "text") -> DataFrame:
    """docs plus score (0 to 1) and predicted (1 if score >= 0.5). Null and empty texts have no windows and get the score of that. Extra columns pass through, but not ones of those names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most some 80 KB
    names = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 500) for whole in batches for i in range(0, whole.num_rows, 500)):
            scores = [sent.value.score(t) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=[*names, "score", "predicted"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names), "score double, predicted int"])
    return docs.mapInArrow(run, schema)
