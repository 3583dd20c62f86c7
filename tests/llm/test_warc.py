"""Archives: what goes in comes back, copies become revisits, damage is noticed."""

import hashlib
import io

import pytest

from trawl.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def run(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, SCHEMA)
    arcs = warc.write_arcs(pages, str(tmp_path / "arc"))
    warcs = warc.convert(arcs, str(tmp_path / "warc"))
    return warc.resolve_revisits(warc.read_warcs(warcs))


def by_brute_force(rows):
    payload = {i: (h or "").encode() for i, _, h, _ in rows}
    owner = {}
    for i, p in payload.items():
        if len(p) >= 1000:
            owner[p] = max(owner.get(p, i), i)
    return sorted((i, len(p), hashlib.sha1(p).hexdigest(), *(("response", None) if owner.get(p, i) == i else ("revisit", owner[p]))) for i, p in payload.items())


def answer(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def test_same_as_brute_force(spark, tmp_path):
    large, edge = "<p>é</p>\r\n\r\n" * 200, "x" * 1000
    rows = [
        (1, "http://a/ b", large, ""), (2, None, large, None), (7, "", large, ""), (3, "http://b", edge, ""), (4, "http://b", edge, ""),
        (5, "http://c", "x" * 999, ""), (6, "http://c", "x" * 999, ""), (8, "http://d", None, ""), (9, "http://d", "", ""),
        (10, "http://e", "WARC/1.1\r\n\r\nfiledesc://\n" * 3, ""), (11, "u", "y" * 3_000_000, ""), (12, "u", "y" * 3_000_000, ""),
    ]
    assert answer(run(spark, rows, tmp_path)) == by_brute_force(rows)


def test_nulls_repeats_and_no_rows(spark, tmp_path):
    text = "z" * 1200
    got = answer(run(spark, [(1, "u", text, ""), (1, "u", text, ""), (None, "u", "small", "")], tmp_path) .where("page_id IS NOT NULL"))
    assert [g[3] for g in got] == ["response", "response"]
    assert run(spark, [], tmp_path / "none").collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_both_header_versions(version):
    data = warc.arc_version_block("f", version) + warc.arc_record(5, "http://a", b"one\n\ntwo", version, "f", 0) + warc.arc_record(6, None, b"", version, "f", 9)
    one, two = warc.parse_arc(io.BytesIO(data))
    assert one.http()[1] == b"one\n\ntwo" and one.fields["URL"] == "http://a" and two.fields["URL"] == "urn:page:6"
    assert ("Checksum" in one.fields) == (version == 2)
    record = warc.warc_record(one, None)
    headers, block = next(warc.parse_warc(io.BytesIO(record)))
    assert headers["warc-date"] == "2024-01-01T00:00:00Z" and headers["warc-record-id"].startswith("<urn:uuid:")
    assert headers["warc-payload-digest"] == warc.base32(hashlib.sha1(b"one\n\ntwo").digest()) and block == one.body


def test_damage_is_noticed():
    data = warc.arc_version_block("f", 1) + warc.arc_record(5, "http://a", b"payload", 1, "f", 0)
    with pytest.raises(ValueError):
        list(warc.parse_arc(io.BytesIO(data[:-5])))
    with pytest.raises(ValueError):
        list(warc.parse_arc(io.BytesIO(data.replace(b"1 0 trawl", b"9 0 trawl"))))
    record = warc.warc_record(next(warc.parse_arc(io.BytesIO(data))), None)
    with pytest.raises(ValueError):
        list(warc.parse_warc(io.BytesIO(record.replace(b"payload", b"Payload"))))
