"""Archives with revisit records: what was written is what is read."""

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import warc
from gaugeworks.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import same_as_sql

LONG, TRAP = "<p>è</p>\r\n" * 200, "x" * 900 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5
ROWS = [
    (1, "http://a/1", LONG), (7, "http://a/7", LONG), (3, None, LONG), (None, "http://a/null", LONG), (7, "http://a/7", LONG),
    (2, "http://b/\r\nWARC-Type: x", TRAP), (4, "http://b/4", TRAP), (5, "http://c", None), (6, "http://c", ""), (8, "http://d", "short"), (9, "http://d", "short"),
    (10, "http://e", "y" * 999), (11, "http://e", "y" * 999), (12, "http://f", "y" * 1000), (13, "http://f", "y" * 1000),
    (None, None, "only null ids " * 100), (None, None, "only null ids " * 100), (-5, "http://g/ü?a=1&b=%20", "z" * 300_000), (2**62, "http://h", LONG + "!"),
]


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    from gaugeworks.llm.queries import ship

    ship(spark)
    path = str(tmp_path_factory.mktemp("warc") / "out")
    pages = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, digest string, row int").repartition(4)
    pages.write.parquet(f"{path}-pages")
    warc.write_archives(spark.read.parquet(f"{path}-pages"), path)
    return path


def test_one_response_for_each_long_payload(spark, archives):
    rows = warc.resolved(warc.read_archives(spark, archives)).collect()
    assert sorted(repr((r["page_id"], bytes(r["payload"]).decode())) for r in rows) == sorted(repr((i, h or "")) for i, _, h in ROWS)
    for payload in {h or "" for _, _, h in ROWS}:
        own = [r for r in rows if bytes(r["payload"]).decode() == payload]
        digest, size = hashlib.sha1(payload.encode()).hexdigest(), len(payload.encode())
        assert {(r["payload_digest"], r["payload_bytes"]) for r in own} == {(digest, size)}
        kept = [r for r in own if r["record_type"] == "response"]
        largest = max((r["page_id"] for r in own if r["page_id"] is not None), default=None)
        if size < 1000:
            assert len(kept) == len(own)
        else:
            assert [r["page_id"] for r in kept] == [largest]
            assert all(r["refers_to"] == largest and r["refers_to_id"] == kept[0]["record_id"] for r in own if r["record_type"] == "revisit")
    assert len({r["record_id"] for r in rows}) == len(rows)


def test_files_hold_every_long_payload_once(archives):
    text = "".join(gzip.open(f, "rt", encoding="utf-8", newline="").read() for f in Path(archives).glob("*.gz"))
    assert text.count(LONG) == 2 and text.count("z" * 300_000) == 1 and text.count("only null ids " * 100) == 1
    assert "\nWARC-Target-URI: http://b/%0D%0AWARC-Type: x\r\n" in text
    assert text.count(f"WARC-Profile: {warc.PROFILE}\r\n") == 4 + 1 + 1 + 1


def test_without_payloads(spark, archives):
    found = warc.read_archives(spark, archives, payloads=False)
    assert found.where(F.col("payload").isNotNull()).count() == 0 and found.count() == len(ROWS)


def test_many_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 7)
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("ab"), (F.col("id") % 3 * 400).cast("int")).alias("html"))
    warc.write_archives(pages, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.gz"))) >= 200 // 7
    rows = warc.resolved(warc.read_archives(spark, str(tmp_path / "out"))).collect()
    assert sorted(r["page_id"] for r in rows) == list(range(200))
    assert {(r["page_id"] % 3, r["refers_to"]) for r in rows if r["record_type"] == "revisit"} == {(2, 197)}


def test_damage_is_an_error(spark, archives, tmp_path):
    whole = gzip.open(next(Path(archives).glob("*.gz"))).read()
    for k, bad in enumerate((whole[:-3], whole.replace(b"Content-Length: ", b"Content-Length: 1", 1), whole.replace(b"</p>", b"<p/>").replace(b"yyy", b"xyz").replace(b"xx", b"ab"))):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "a.gz").write_bytes(gzip.compress(bad))
        if bad != whole:
            with pytest.raises(Exception, match="record|header|start"):
                warc.read_archives(spark, str(tmp_path / str(k))).collect()


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "none"))
    assert warc.resolved(warc.read_archives(spark, str(tmp_path / "none"))).count() == 0


def test_query_equals_sql(spark):
    same_as_sql(spark, QUERIES["op12_warc_revisits"], ORACLE["op12_warc_revisits"])
