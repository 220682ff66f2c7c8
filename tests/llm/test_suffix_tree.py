"""The suffix tree against one made with dictionaries in plain Python, and the hashing of words against bytes.split()."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strataloom.llm import pst, tokens
from strataloom.llm.common import space_words

END = None


class Plain:
    """The same model: every context, entry and distribution by its definition, without hashes, joins or bitmaps."""

    def __init__(self, texts, depth, gain, least=2, discount=pst.DISCOUNT):
        seqs = [[*space_words(t), END] for t in texts]
        self.words = Counter(w for s in seqs for w in s)
        self.total, self.distinct = sum(self.words.values()), len(self.words)
        self.nodes, open_, level = {}, {()}, 0
        while open_ and (depth is None or level < depth):
            level += 1
            runs = defaultdict(Counter)
            for s in seqs:
                for i in range(level, len(s)):
                    runs[tuple(s[i - level : i])][s[i]] += 1
            now, before = set(), len(self.nodes)
            for ctx, c in runs.items():
                seen, entries = sum(c.values()), {w: n for w, n in c.items() if n >= least}
                if ctx[1:] not in open_ or not entries:
                    continue
                above = {w: self.p(ctx[1:], w) for w in entries}
                left = 1 - sum(n - discount for n in entries.values()) / seen
                p = {w: (n - discount) / seen + left * above[w] for w, n in entries.items()}
                q, r = (min(1, max(1e-12, 1 - sum(x.values()))) for x in (p, above))
                node = seen * (sum(p[w] * math.log(p[w] / above[w]) for w in p) + q * math.log(q / r)) >= gain
                if node:
                    self.nodes[ctx] = (left, seen, entries)
                if sum(-n * math.log((p if node else above)[w]) for w, n in entries.items()) >= gain:
                    now.add(ctx)
            open_ = now if len(self.nodes) > before else set()
        self.discount = discount

    def root(self, w):
        return (self.words[w] + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def p(self, ctx, w, discount=pst.DISCOUNT):
        if not ctx:
            return self.root(w)
        lower = self.p(ctx[1:], w)
        if ctx not in self.nodes:
            return lower
        left, seen, entries = self.nodes[ctx]
        return (entries[w] - discount) / seen + left * lower if w in entries else left * lower

    def score(self, text):
        s = [*space_words(text), END]
        longest = max([len(c) for c in self.nodes], default=0)
        return sum(math.log10(self.root(w)) for w in s), sum(math.log10(self.p(tuple(s[max(0, i - longest) : i]), w)) for i, w in enumerate(s)), sum(self.words[w] > 0 for w in s)


def _texts():
    rng = random.Random(4)
    some = [" ".join(rng.choice("a b c d".split()) + (" x y z" if rng.random() < 0.2 else "") for _ in range(30)) for _ in range(40)]
    copies = [" ".join(rng.choice("e f g h i j k".split()) for _ in range(60))] * 7
    return [*some, *copies, None, "", "only once", "A\tb  C\n", "q r s p", "t r s u"] + ["q r s p", "t r s u"] * 9


@pytest.mark.parametrize(("depth", "gain", "p_head"), [(2, 8.0, 1e-9), (None, 0.5, 0.01), (None, 0.5, 1.0)])  # all carried, some, none
def test_model_is_the_plain_one(spark, depth, gain, p_head):
    texts = _texts()
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    plain = Plain(texts, depth, gain)
    assert plain.nodes and (depth is not None or max(map(len, plain.nodes)) >= 3)
    probes = [*texts, "x y z", "never seen", "a b zz c d", "q r s p q r s u"]
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(probes)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pst.score(asked, pst.fit(docs.select("text"), depth=depth, gain=gain, p_head=p_head)).collect()}
    assert len(got) == len(probes)
    for k, t in enumerate(probes):
        base, total, known = plain.score(t)
        assert (got[k]["n_tokens"], got[k]["n_known"], got[k]["train_tokens"]) == (len(space_words(t)) + 1, known, plain.total)
        assert got[k]["base_score"] == pytest.approx(base, abs=1e-7) and got[k]["score"] == pytest.approx(total, abs=1e-7)


def test_distributions_sum_to_one():
    plain = Plain(_texts(), None, 0.5)
    for ctx in [(), *plain.nodes]:
        rest = 1 - sum(plain.p(ctx, w) for w in plain.words)
        unseen = 0.5 / (plain.total + 0.5 * (plain.distinct + 1))
        for k in range(len(ctx)):
            unseen *= plain.nodes[ctx[k:]][0] if ctx[k:] in plain.nodes else 1
        assert rest == pytest.approx(unseen, abs=1e-9)


def test_copies_end_by_themselves(spark):
    """A text that many rows share is one path; contexts stop growing once they tell what comes next."""
    text = " ".join(f"w{k}" for k in range(300))
    docs = spark.createDataFrame([(text,)] * 50, "text string")
    assert pst.fit(docs, depth=None).longest <= 4


@pytest.mark.parametrize("piece", [7, 64, 1 << 16])
def test_word_hashes_are_of_the_words(monkeypatch, piece):
    monkeypatch.setattr(tokens, "_PIECE", piece)
    rng = random.Random(1)
    texts = [None, "", "   ", "a", "A  b\tc\n", "é à x\x00y z\x1cq " + "w" * 5000, *("".join(rng.choice("abCD \n\t") for _ in range(rng.randrange(60))) for _ in range(500)), "x" * 70_000 + " y"]
    for start in (0, 3):
        hashes, lengths = tokens.word_hashes(pa.array(texts).slice(start))
        seen, at = {}, 0
        for text, n in zip(texts[start:], lengths, strict=True):
            words = space_words(text)
            assert n == len(words) + 1 and hashes[at + n - 1] == tokens.END
            assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes[at : at + n - 1]))
            at += n
        assert at == len(hashes) and len(set(seen.values())) == len(seen)


@pytest.mark.parametrize(("buckets", "most"), [(1, 1 << 20), (7, 50), (1 << 20, 50)])
def test_runs_are_summed_in_buckets(spark, monkeypatch, buckets, most):
    plans = []
    monkeypatch.setattr(pst, "materialize", lambda df, label, plain=pst.materialize, **k: (plans.append(df._jdf.queryExecution().toString()), plain(df, label, **k))[1])
    texts = _texts()
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    opened = pst.Bitmap(docs.sparkSession.createDataFrame([(int(h),) for h in set(tokens.word_hashes(pa.array(texts))[0].tolist()) - {tokens.END}], "key long"))
    for level, open_ in ((1, None), (2, opened)):
        want, tried = Counter(), Counter()
        for t in texts:
            h = tokens.word_hashes(pa.array([t], pa.string()))[0]
            keys = [k for k, _ in pst.runs(h, level)][-1]
            for i in range(level, len(h)):
                want[int(keys[i - 1]), int(keys[i])] += 1
                tried[int(keys[i - 1]), None] += 1
        got = {(r["ctx"], r["low"]): r["c"] for r in pst._entries(docs, level, 2, None, open_, buckets, most).collect()}
        assert got == {k: c for k, c in (want + (tried if open_ else Counter())).items() if c >= 2}
    assert not [p for p in plans if "Aggregate" in p]  # counts of single runs are not rows of a shuffle


def test_texts_meet_the_model_in_buckets(spark, monkeypatch):
    """However many buckets, the scores are the plain model's; runs of texts are written nowhere, and other columns pass."""
    written = []
    monkeypatch.setattr(pst, "materialize", lambda df, label, plain=pst.materialize, **k: (written.append((label, df.columns)), plain(df, label, **k))[1])
    texts = [*_texts(), "x y z", "never seen", "a b zz c d"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    docs = docs.selectExpr("doc_id", "text", "array(doc_id, null) AS some", "timestamp_seconds(doc_id) AS at", "cast(null AS string) AS none")
    plain = Plain(texts, 3, 0.5)
    model = pst.fit(docs.select("text"), depth=3, gain=0.5, p_head=0.002, bucket_tokens=40)
    for size in (30, 10**9):
        got = pst.score(docs, model, most=7, bucket_tokens=size).selectExpr("*", "some = array(doc_id, null) AND size(some) = 2 AND at = timestamp_seconds(doc_id) AND none IS NULL AS same").collect()
        assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
        for r in got:
            base, total, known = plain.score(texts[r["doc_id"]])
            assert r["n_known"] == known and r["base_score"] == pytest.approx(base, abs=1e-7) and r["score"] == pytest.approx(total, abs=1e-7)
            assert r["some"] == [r["doc_id"], None] and r["none"] is None and r["at"].timestamp() == r["doc_id"]
    assert not [label for label, columns in written if "__keys" in columns]


@pytest.mark.parametrize("rising", [False, True])
def test_packed_numbers_come_back(rising):
    rng = np.random.default_rng(1)
    for kind in (np.int64, np.uint64, np.float64):
        ends = np.array([0, -0.0, 0.1, -1e300, math.inf, 5e-324] if kind is np.float64 else [np.iinfo(kind).max, 0, 7, np.iinfo(kind).min, 7], kind)
        some = rng.integers(np.iinfo(np.int64).min, np.iinfo(np.int64).max, 1000).view(kind)
        for x in (ends, ends[:0], ends[:1], np.sort(some[~np.isnan(some)]), np.arange(5, 300).astype(kind), some[~np.isnan(some)]):
            if not (rising and kind is np.float64):
                got = pst.unpacked(pst.packed(x, rising), kind, rising)
                assert got.dtype == x.dtype and got.tobytes() == x.tobytes()
    keys = np.sort(rng.integers(0, 1 << 57, 10_000, np.uint64))
    assert len(pst.packed(keys, True)) < 6 * len(keys) and len(pst.packed(np.zeros(10_000))) < 400


def test_scoring_shuffles_little(spark):
    """Runs of texts and of the model are sent packed: 23 bytes for each of the model here, where rows of the model beside plain arrays of the texts took 34."""
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(400)) for _ in range(250)] * 2
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model = pst.fit(docs, depth=3, gain=0.5, p_head=1.0)
    sc = spark.sparkContext._jsc.sc()

    def sent():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorSummary("driver").totalShuffleWrite()

    before, rest = sent(), model.rest.count()
    assert pst.score(docs, model).count() == len(texts) and rest > 300_000
    assert 10 * rest < sent() - before < 28 * rest


def test_orders_and_places():
    """Orders by sorts that carry places are exact where asked, also where numbers differ in their lowest bits alone; look-ups find what is there and nothing else."""
    rng = np.random.default_rng(3)
    for x in (rng.integers(-(2**63), 2**63 - 1, 5000), rng.integers(0, 9, 5000), np.arange(5000)[::-1].copy(), np.zeros(0, np.int64), np.array([-1])):
        ranked = x[pst._order(x)].view(np.uint64)
        assert (ranked[1:] >= ranked[:-1]).all() and sorted(pst._order(x, near=True).tolist()) == list(range(len(x)))
        keys = np.unique(x)
        for have in (keys, keys[::3], keys[:0]):
            places = {k: i for i, k in enumerate(have.tolist())}
            asked = np.concatenate([x, x + 1])
            which, at = tokens.Lookup(have).hits(asked)
            assert (np.diff(which) > 0).all() and tokens.Lookup(have)(asked).tolist() == [places.get(k, -1) for k in asked.tolist()]
            assert (have[at] == asked[which]).all() and len(which) == sum(k in places for k in asked.tolist())


@pytest.mark.parametrize("n", [0, 5, 300_000])
def test_bitmaps_have_their_keys(spark, n):
    """All keys pass and few others do, with one block and with several; keys are not sorted as rows to be marked."""
    rng = np.random.default_rng(n)
    keys, others = (rng.integers(-(2**63), 2**63 - 1, k) for k in (n, 50_000))
    found = pst.Bitmap(spark.createDataFrame(pa.table({"key": pa.array(keys, pa.int64())})).repartition(3))
    assert found(keys).all() and found(others).mean() < 0.03
    assert 8 * len(found.bits) == found.last + 1 == max(1 << 20, 1 << (12 * n).bit_length())
