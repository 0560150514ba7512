import base64
import hashlib

import pytest

from docsync.llm import warc
from docsync.llm.warc import archived, parsed, read_archives, write_archives


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i} é</p>\r\n\r\nWARC/1.0\r\n") for i in range(40)]
    rows += [(100 + i, f"http://copy/{i}", rows[3][2]) for i in range(20)]
    rows += [(200, None, None), (201, "http://e\r\nX: y", ""), (150, "u", "x" * 300000),
             (50, "v", "x" * 300000), (None, "n", "nobody"), (7000, "m", "nobody")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), rows


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        html = (html or "").encode()
        key = (i is None, i or 0)
        if html not in first or key < first[html]:
            first[html] = key
    out = {}
    for i, _, html in rows:
        html = (html or "").encode()
        again = len(html) >= least and first[html] != (i is None, i or 0)
        out[i] = (len(html), base64.b32encode(hashlib.sha1(html).digest()).decode(),
                  "revisit" if again else "response", first[html][1] if again else None)
    return out


@pytest.mark.parametrize("least", [0, 10, 10**9])
def test_round_trip(pages, least):
    frame, rows = pages
    assert {r.page_id: tuple(r)[1:] for r in archived(frame, least).collect()} == expected(rows, least)


def test_archives_hold_each_payload_once(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 7)
    frame, rows = pages
    write_archives(frame, str(tmp_path / "w"))
    records = [x for f in (tmp_path / "w").glob("part-*") for x in parsed(f.read_bytes())]
    assert len(records) == len(rows)
    for fields, block in records:
        assert int(fields["content-length"]) == len(block)
        revisit = fields["warc-type"] == "revisit"
        assert ("warc-refers-to" in fields) == ("warc-profile" in fields) == revisit
        assert block.startswith(b"HTTP/1.1 200 OK\r\n") and (block.endswith(b"\r\n\r\n") or not revisit)
    ids = {f["warc-record-id"] for f, _ in records if f["warc-type"] == "response"}
    assert all(f["warc-refers-to"] in ids for f, _ in records if f["warc-type"] == "revisit")
    payloads = [b.partition(b"\r\n\r\n")[2] for f, b in records if f["warc-type"] == "response"]
    assert len(set(payloads)) == len(payloads)
    back = read_archives(spark, str(tmp_path / "w")).filter("record_type = 'response'")
    assert sorted(r.payload.encode() for r in back.collect()) == sorted(payloads)


def test_damage_is_found(spark, pages, tmp_path):
    write_archives(pages[0].limit(1), str(tmp_path / "w"))
    file = max((tmp_path / "w").glob("part-*"), key=lambda f: f.stat().st_size)
    body = bytearray(file.read_bytes())
    body[-6] ^= 1
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "part-0").write_bytes(bytes(body))
    with pytest.raises(Exception, match="damaged record"):
        read_archives(spark, str(tmp_path / "x")).collect()


def test_repeated_rows_and_none(spark, pages):
    frame, rows = pages
    out = archived(frame.union(frame.filter("page_id < 5"))).collect()
    assert len(out) == len(rows) + 5
    assert archived(frame.limit(0)).collect() == []
    more = frame.selectExpr("*", "'a' AS digest", "'b' AS block", "1 AS bytes")
    assert archived(more).count() == len(rows)
