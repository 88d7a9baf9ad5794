"""WARC archives: exact round trips and the SQL oracle."""

import gzip
import hashlib
import os
import tempfile

import duckdb
import pytest

from aeris.llm import warc
from tools.check_oracle import canon

SF = "/root/testdata/sf0.001"
BIG = "é" * 70001 + warc.VERSION * 3 + "WARC/1.1\r\n\r\nx" * 5 + "\r\n\r\nZ\r\n\r\n" * 4
ROWS = [(1, "u", None, "q"), (2, None, "", None), (3, "a b\r\nWARC/1.1\r\n", BIG, "z"), (4, "u", BIG, "z"),
        (3, "u", "é" * 60, "z"), (None, "u", "é" * 60, "z"), (9, "x", "\r\n" * 80, ""), (10, "x", "WARC/1.1\r\n", ""),
        (11, "x", "s" * 99, ""), (12, "x", "s" * 99, "")]


def test_archives_match_the_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    assert canon(warc.op8_warc(spark, SF).toPandas()) == canon(con.execute(warc.ORACLE_SQL).df())


@pytest.mark.parametrize("size", [1 << 16, 7])
def test_round_trip_of_odd_payloads(spark, size):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, record string")
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in warc.read_archive(spark, warc.archive(df, size=size)).collect()), key=str)
    first = {}
    for i, _, h, _ in ROWS:
        raw = (h or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    want = []
    for i, _, h, _ in ROWS:
        raw = (h or "").encode()
        again = raw in first and first[raw] != i
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None))
    assert got == sorted(want, key=str)


def test_files_are_plain_warc(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, record string")
    warc.archive(df, path, size=50000)
    seen = []
    for name in sorted(os.listdir(path)):
        if not name.endswith(".gz"):
            continue
        raw = gzip.open(os.path.join(path, name)).read()
        while raw:      # by Content-Length, as any reader would
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n:n + 4] == b"\r\n\r\n"
            assert fields["WARC-Record-ID"].startswith("<urn:uuid:") and "WARC-Date" in fields
            seen.append(fields["WARC-Type"])
            raw = rest[n + 4:]
    assert seen.count("response") + seen.count("revisit") == len(ROWS) and "continuation" in seen


def test_a_record_cut_short_is_told(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.archive(spark.createDataFrame([(1, "u", "x" * 500)], "page_id long, url string, html string"), path)
    name = max((n for n in os.listdir(path) if n.endswith(".gz")), key=lambda n: os.path.getsize(f"{path}/{n}"))
    raw = gzip.open(f"{path}/{name}").read()
    other = tempfile.mkdtemp(prefix="warc-")
    with gzip.open(f"{other}/cut.gz", "wb") as f:
        f.write(raw[:-50])
    with pytest.raises(Exception, match="cut short"):
        warc.read_archive(spark, other).collect()


def test_empty_archive(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, warc.archive(df)).count() == 0


def test_no_piece_holds_a_version_line():
    for size in (1, 5, 9, 10, 11, 1000):
        parts = list(warc.pieces(BIG[-200:] + warc.VERSION * 3, size))
        assert "".join(parts) == BIG[-200:] + warc.VERSION * 3
        assert not any(warc.VERSION in p for p in parts) and max(map(len, parts)) <= size
