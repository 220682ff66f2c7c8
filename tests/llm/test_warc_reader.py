"""The splittable reader on archives with records inside records, and on damaged ones, at several split sizes."""

import random

import pytest

from strataloom.llm import warc


def _archive(tmp_path, records):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(records))
    return str(tmp_path)


@pytest.mark.parametrize("split", [61, 300, 4096, 1 << 20])
def test_record_inside_a_stored_record(spark, tmp_path, split):
    rng = random.Random(1)
    inner = warc.build_record(99, "inner", rng.randbytes(200), None)
    payloads = [b"a" * 300, rng.randbytes(900) + inner + inner + rng.randbytes(700), b"b" * 50, inner + rng.randbytes(400)]
    path = _archive(tmp_path, [warc.build_record(k, f"u{k}", p, None, level=0 if k % 2 else 3) for k, p in enumerate(payloads)])
    got = warc.read_warc(spark, path, split_bytes=split).orderBy("record_offset").collect()
    assert [(r["page_id"], bytes(r["payload"]), r["error"]) for r in got] == [(k, p, None) for k, p in enumerate(payloads)]


@pytest.mark.parametrize("split", [200, 1 << 20])
def test_damage_is_reported(spark, tmp_path, split):
    rng = random.Random(2)
    records = [warc.build_record(k, f"u{k}", rng.randbytes(500), None) for k in range(5)]
    broken = bytearray(records[1])
    broken[len(broken) // 2] ^= 0x55
    headless = b"\0\0\0" + records[3][3:]
    path = _archive(tmp_path, [records[0], bytes(broken), records[2], headless, records[4][: len(records[4]) - 40]])
    rows = warc.read_warc(spark, path, split_bytes=split).collect()
    assert sorted(r["page_id"] for r in rows if r["error"] is None) == [0, 2]
    assert {r["record_offset"] for r in rows if r["error"]} >= {len(records[0])}
    assert sum(r["error"] is not None for r in rows) >= 2


def test_wrong_digest_is_reported(spark, tmp_path):
    good = warc.build_record(1, "u", b"x" * 100, None)
    import zlib

    plain = zlib.decompress(good, 31).replace(b"x" * 100, b"x" * 99 + b"y")
    rows = warc.read_warc(spark, _archive(tmp_path, [warc._member(plain, 3), good])).collect()
    assert sorted((r["page_id"], r["error"] is None) for r in rows) == [(1, False), (1, True)]


def test_no_archives(spark, tmp_path):
    (tmp_path / "empty").write_bytes(b"")
    assert warc.read_warc(spark, str(tmp_path)).count() == 0
