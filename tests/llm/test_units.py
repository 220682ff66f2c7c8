"""Parts of the operators on their own."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataloom.llm import decontam, langid, media, neardup, packing, pst, secrets, toxicity, warc


@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_fm_index(text, pattern):
    index = decontam.FMIndex(np.array(text), sample=3)
    lo, hi = index.search(np.array([pattern]))
    found = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
    n = len(pattern)
    assert found == [i for i in range(len(text) - n + 1) if text[i : i + n] == pattern]


@given(st.binary(min_size=1, max_size=900))
@settings(max_examples=60, deadline=None)
def test_png_round_trip(data):
    data += bytes(-len(data) % 64)
    pixels = np.frombuffer(data, np.uint8).reshape(-1, 64)
    assert (media.decode_png(media.encode_png(pixels)) == pixels).all()


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    rng = np.random.default_rng(kind)
    pixels = rng.integers(0, 256, (9, 7), dtype=np.uint8)
    raw = np.zeros((9, 8), np.uint8)
    raw[:, 0] = kind
    for y in range(9):
        for x in range(7):
            a = int(pixels[y, x - 1]) if x else 0
            b = int(pixels[y - 1, x]) if y else 0
            c = int(pixels[y - 1, x - 1]) if x and y else 0
            near = min((a, b, c), key=lambda v: abs(a + b - c - v))
            raw[y, x + 1] = (int(pixels[y, x]) - (0, a, b, (a + b) // 2, near)[kind]) % 256
    assert (media.unfilter(raw) == pixels).all()


def test_png_checksum():
    m = bytearray(media.encode_png(np.zeros((2, 64), np.uint8)))
    m[45] ^= 1
    with pytest.raises(media.MediaError):
        media.decode_png(bytes(m))


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 3), st.integers(0, 5)), max_size=40))
@settings(max_examples=60, deadline=None)
def test_best_fit_is_tightest(pieces):
    packer, bins = packing.Packer(12, 2), []
    for size, source, cluster in pieces:
        fits = [(12 - sum(n for n, _, _ in b), i) for i, b in enumerate(bins) if 0 < 12 - sum(n for n, _, _ in b) >= size and cluster not in {c for _, _, c in b} and sum(s == source for _, s, _ in b) < 2]
        want = min(fits)[1] if fits else len(bins)
        b, slot, offset = packer.put(size, source, cluster)
        if want == len(bins):
            bins.append([])
        assert (b, slot, offset) == (want, len(bins[want]), sum(n for n, _, _ in bins[want]))
        bins[want].append((size, source, cluster))


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_trigram_queries_are_mandatory(rule):
    examples = {
        "assign": ["password=abcdefghijkl", "API_KEY: 'abcdefghijklmn'", 'Secret"="0123456789ab', "apikey=aaaaaaaaaaaaa", "passwd:xxxxxxxxxxxx", "tOKEN = 111111111111"],
        "access": ["AKIA" + "Z" * 16], "hex": ["deadbeef" * 3], "forge": ["ghp_" + "a" * 36, "ghs_" + "B" * 40], "chat": ["xoxb-0123456789a"], "maps": ["AIza" + "x" * 35],
        "jwt": ["eyJabcdefghi.eyJabcdefghi.abcdefghij"], "pem": ["-----BEGIN RSA PRIVATE KEY-----"],
    }[rule.kind]
    query = secrets.trigram_query(rule.pattern)
    assert (query is None) == (rule.kind == "hex")
    for text in examples:
        assert re.search(rule.pattern, text)
        have = {text.lower()[i : i + 3] for i in range(len(text))}
        assert query is None or any(q <= have for q in query)


def test_estimates():
    rng = random.Random(3)
    sketch = neardup.Sketch()
    for shared in (0, 300, 800, 1000):
        x = np.array([rng.getrandbits(64) for _ in range(2000 - shared)], np.uint64)
        a, b = np.unique(x[:1000]), np.unique(x[len(x) - 1000 :])
        r = sketch.registers([a, b])
        got = sketch.jaccard(r[:1], r[1:], np.array([1000]), np.array([1000]))[0]
        assert abs(got - shared / (2000 - shared)) < 0.15
        both = sketch.registers([np.union1d(a, b)])
        assert (both[0] == np.maximum(r[0], r[1])).all()  # registers merge


class _File:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def test_warc_splits():
    rng = random.Random(1)
    magic = b"\x1f\x8b\x08"
    payloads = [bytes(rng.getrandbits(8) for _ in range(rng.randrange(3000))) + magic * 3 for _ in range(60)]  # hard to compress: stored magic inside
    data = b"".join(warc.build_record(i, f"u{i}", p, None) for i, p in enumerate(payloads))
    for split in (137, 1000, len(data)):
        got = [warc.parse_record(c) for s in range(0, len(data), split) for _, _, c, _ in warc.members(_File(data), len(data), s, min(len(data), s + split)) if c]
        assert [(g["page_id"], g["payload"]) for g in got] == list(enumerate(payloads))


def test_warc_large_record_ends_in_zero():
    assert warc.build_record(1, "u", b"a" * (17 << 20), None)[-1] == 0


def test_entries_do_not_vanish_in_a_larger_corpus(spark, tmp_path):
    """What occurs twice counts beside a million other words too. 10,000 words a filler text; 3e-6 of all tokens would ask for three."""
    ids = [d for d in range(400) if zlib.crc32(str(d).encode()) % 5 != 1]
    rows = [(ids[0], "qq ww"), (ids[1], "qq ww"), *((d, "a b c d " * 2500) for d in ids[2:102])]
    probe = next(d for d in range(400) if zlib.crc32(str(d).encode()) % 5 == 1)
    spark.createDataFrame([*rows, (probe, "qq ww")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    from strataloom.llm import queries

    (got,) = queries.op9_suffix_tree(spark, str(tmp_path)).where("held_out").collect()
    assert got["train_tokens"] > 1_000_000 * 0.99
    assert got["score"] > got["base_score"] + 4


def test_contexts_grow_while_they_diverge(spark, tmp_path):
    """The last word of four follows from the first alone, which two words of context do not reach."""
    from strataloom.llm import queries

    ids = [d for d in range(800) if zlib.crc32(str(d).encode()) % 5 != 1][:400]
    probe = next(d for d in range(800) if zlib.crc32(str(d).encode()) % 5 == 1)
    texts = ["x b c p", "y b c q", "m n r", "o n s"]
    train = [(d, texts[k % 4]) for k, d in enumerate(ids)]
    spark.createDataFrame([*train, (probe, "x b c p")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    two = pst.score(docs.where(f"doc_id = {probe}"), pst.fit(docs.where(f"doc_id <> {probe}").select("text"), depth=2)).first()
    got = queries.op9_suffix_tree(spark, str(tmp_path)).where("held_out").first()
    assert got["score"] > two["score"] + 0.25


def test_gradient():
    net = langid.Network(["a", "b"], hidden=3, window=5, seed=1)
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    rng = np.random.default_rng(0)
    x, y, mask = rng.integers(0, 256, (5, 4)), np.array([0, 1, 1, 0]), np.ones((5, 4))
    mask[3:, 1] = 0
    _, g = net.gradient(x, y, mask)
    for name, at in (("uf", (1, 4)), ("ub", (2, 7)), ("v", (4, 1)), ("xf", (int(x[2, 0]), 8)), ("xb", (int(x[1, 2]), 1))):
        old, e = net.p[name][at], 1e-2
        net.p[name][at] = old + e
        up = net.gradient(x, y, mask)[0]
        net.p[name][at] = old - e
        down = net.gradient(x, y, mask)[0]
        net.p[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / (2 * e), abs=2e-4)


def test_toxicity_learns():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on", "re", "sh"]) for _ in range(rng.randrange(1, 4)))
    text = lambda y: " ".join(rng.choice(["worthless", "idiot", "scum"]) if y and rng.random() < 0.06 else word() for _ in range(120))
    model = toxicity.fit([(text(k % 5 == 0), int(k % 5 == 0)) for k in range(600)])
    fresh = [(k % 2, model.score(text(k % 2))) for k in range(100)]
    assert sum((s >= 0.5) == y for y, s in fresh) >= 93
    assert 0 <= model.score(None) == model.score("") < 0.5
    assert toxicity.fit([]).score("x") == 0.0


def test_crc_of_negative_ids(spark):
    from strataloom.llm.common import bucket

    df = spark.createDataFrame([(-5,), (None,), (17,)], "d long")
    assert [r[0] for r in df.select(bucket("d", 5)).collect()] == [zlib.crc32(b"-5") % 5, None, zlib.crc32(b"17") % 5]
