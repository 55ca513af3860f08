import hashlib

import pytest
import zstandard

from pactframe.llm import warc
from pactframe.llm.common import staged_path

PAGES = "page_id long, url string, html string, n long, digest string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 0, "clash") for r in rows], PAGES)


ROWS = [
    (1, "http://a/1", "x" * 1000), (5, None, "x" * 1000), (3, "u\r\nv", "x" * 1000), (7, "http://b", "y" * 999),
    (8, "http://c", "y" * 999), (9, "http://d", None), (10, "http://e", ""), (11, "z", "é€" * 300_000),
    (None, "none", "x" * 1000), (12, "w", "w" * 2000), (12, "w", "w" * 2000), (-4, "neg", "WARC/1.1\r\n\r\nfake" * 100),
]


def brute(rows):
    last = {}
    for i, _, h in rows:
        last[h] = max((x for x in (last.get(h), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 1000 and i != last[h]
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last[h] if again else None))
    return sorted(out, key=repr)


def test_round_trip_and_seek(spark):
    pages = pages_of(spark, ROWS)
    folder = staged_path(spark, "warc-test")
    index = warc.write_bundles(pages, folder, bundle_bytes=200_000)
    got = warc.read_bundles(index, folder).collect()
    assert sorted(((r[0], r[3], r[4], r[2], r[5]) for r in got), key=repr) == brute(ROWS)
    texts = {(i, h) for i, _, h in ROWS}
    for r in got:
        if r.record_type == "response":
            assert (r.page_id, r.payload.decode()) in texts or r.page_id in (9, 10)
    picked = warc.read_records(index.filter("page_id IN (3, 11)"), folder).collect()
    assert {(r.page_id, r.record_type) for r in picked} == {(3, "revisit"), (11, "response")}
    assert warc.archive_round_trip(spark, pages).count() == len(ROWS)


def test_bundle_is_a_plain_zstd_stream_with_footer():
    bundle, records = warc.Bundle(), []
    for k in range(50):
        data = bytes([k]) * 20_000
        records.append(warc.build_record(k, f"http://x/{k}", data, hashlib.sha1(data).hexdigest(), False, None))
        assert bundle.add(records[-1])[1] < warc.FRAME_BYTES + len(records[-1])
    packed = bundle.finish()
    assert len(bundle.frames) > 2
    plain = zstandard.ZstdDecompressor().stream_reader(packed, read_across_frames=True).read()
    assert plain == b"".join(records)
    assert [r[0] for r in warc.parse_records(plain)] == list(range(50))


def test_damage_is_noticed():
    record = warc.build_record(1, None, b"abc", hashlib.sha1(b"abd").hexdigest(), False, None)
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse_records(record))


def test_empty(spark):
    assert warc.archive_round_trip(spark, pages_of(spark, [])).collect() == []


def test_reading_is_dealt_to_as_many_tasks_as_there_are_bundles(spark, tmp_path):
    """Names are few bytes: adaptive execution would put them all into one task."""
    pages = spark.createDataFrame([(k, f"http://h/{k}", "x" * 900 + str(k)) for k in range(60)], "page_id long, url string, html string")
    index = warc.write_bundles(pages.repartition(6), str(tmp_path), bundle_bytes=2_000)
    n = index.select("bundle").distinct().count()
    assert n >= 12
    for read in (warc.read_bundles, warc.read_records):
        found = read(index, str(tmp_path))
        assert found.rdd.getNumPartitions() == n
        assert sorted(r.page_id for r in found.select("page_id").collect()) == list(range(60))
