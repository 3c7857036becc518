"""Archives of the WARC query: compressed, read whole."""

import hashlib

from repolens.llm import queries, warc


def _query(spark, tmp_path, monkeypatch, name, rows, parts):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.repartition(parts).write.parquet(str(tmp_path / name / "pages.parquet"))
    path = tmp_path / name / "warc"
    monkeypatch.setattr(queries, "shared_scratch", lambda spark, name: str(path))
    return queries.op4_warc(spark, str(tmp_path / name)).collect(), path


def test_warc_query_writes_compressed_archives(spark, tmp_path, monkeypatch):
    inner = f"{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 3\r\n\r\nabc{warc.END}"
    rows = []
    for i in range(300):
        body = f"<html><p>page {i}, é</p>" + "<p>a line of the page</p>\n" * (20 + i)
        body = body + inner + "after" if i % 6 == 0 else body
        body = "same <p>" * 300 if i % 10 == 0 else "short" if i % 25 == 1 else None if i % 50 == 2 else "" if i % 50 == 3 else body
        rows.append((None if i in (4, 20) else i, None if i % 7 == 0 else f"http://x/{i}", body))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got, path = _query(spark, tmp_path, monkeypatch, "odd", rows, 3)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = []
    for i, _, body in rows:
        raw = (body or "").encode()
        revisit = body is not None and body.startswith("same") and i != 0
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 0 if revisit else None))
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(want, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long").collect()))
    files = [f for f in path.iterdir() if f.name.startswith("part-")]
    text = sum(len((b or "").encode()) for _, _, b in rows if not (b or "").startswith("same"))
    assert 0 < sum(f.stat().st_size for f in files) < text / 3


def test_warc_query_on_no_pages_and_on_empty_ones(spark, tmp_path, monkeypatch):
    assert _query(spark, tmp_path, monkeypatch, "none", [], 1)[0] == []
    got, _ = _query(spark, tmp_path, monkeypatch, "empty", [(1, None, None), (1, None, None), (None, None, "")], 2)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"]) for r in got) == [("1", 0, "response"), ("1", 0, "response"), ("None", 0, "response")]
