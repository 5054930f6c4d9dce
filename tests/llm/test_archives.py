"""Archives: exact round trips, both ARC versions, and SQL."""

import hashlib
import io

import duckdb
import pytest

from batchloom.llm.archives import archive_pages, arc_header, convert, converted, file_groups, parse_arc, parse_warc, read_warc, version_block, write_arc
from batchloom.llm.oracles import ORACLES
from batchloom.llm.queries import QUERIES

CONTENTS = [b"", b"HTTP/1.1 200 OK\r\n\r\n", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody \n\n http://x 1 2 3 4\n", b"\x00\xff binary \r\n\r\n", b"plain"]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_to_warc_and_back(version):
    date = "20010203040506"
    raw = version_block(version, date)
    for i, c in enumerate(CONTENTS):
        raw += arc_header(version, f"http://h/{i} with space", date, "text/html", len(c)) + c + b"\n"
    records = list(parse_arc(io.BytesIO(raw)))
    assert [r.content for r in records] == CONTENTS
    assert [r.url for r in records] == [f"http://h/{i} with space" for i in range(len(CONTENTS))]
    written = b"".join(converted("f.arc", r, None) + b"\r\n\r\n" for r in records)
    back = list(parse_warc(io.BytesIO(written)))
    assert [b for _, b in back] == CONTENTS
    assert [h["warc-type"] for h, _ in back] == ["resource", "response", "response", "resource", "resource"]
    assert {h["warc-date"] for h, _ in back} == {"2001-02-03T04:05:06Z"}
    assert len({h["warc-record-id"] for h, _ in back}) == len(CONTENTS)


def test_broken_archives():
    with pytest.raises(ValueError):
        list(parse_arc(io.BytesIO(version_block(2, "2001") + b"http://x 1.1.1.1 2001 text/html 5\nabcde\n")))
    with pytest.raises(ValueError):
        list(parse_arc(io.BytesIO(version_block(1, "2001") + b"http://x 1.1.1.1 2001 text/html 50\nabcde\n")))


def test_edges(spark):
    long = "é<p>\r\n\r\n### WARC/1.1\r\n" * 400
    rows = [(3, "u", long), (1, None, long), (2, "a b\nc", "x" * 99), (4, "u", "x" * 99), (5, "u", None), (6, "u", ""), (None, "u", long), (7, "u", "y" * 100), (7, "u", "y" * 100)]
    pages = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows], "page_id long, url string, html string, path string").repartition(3)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archive_pages(pages).collect()), key=repr)
    kinds = {3: ("revisit", 1), None: ("revisit", 1)}
    expected = []
    seen = False
    for page, _, html in rows:
        data = (html or "").encode()
        kind = kinds.get(page, ("response", None))
        if page == 7 and seen:
            kind = ("revisit", 7)
        seen = seen or page == 7
        expected.append((page, len(data), hashlib.sha256(data).hexdigest(), *kind))
    assert got == sorted(expected, key=repr)
    assert archive_pages(pages.limit(0)).count() == 0


def test_file_groups():
    sizes = {"a": 3, "b": 3, "d": 9, "e": 1}
    assert file_groups(["e", "d", "c", "b", "a"], sizes, 6) == [["a", "b", "c"], ["d"], ["e"]]
    assert file_groups(["a", "b", "c"], {}, 0) == [["a", "b", "c"]]
    assert file_groups([], {}, 5) == [[]]


def test_groups_of_files_give_the_same_records(spark, tmp_path):
    """All lists at once, a group for every file, and lists too long to broadcast; a third of the pages share one payload."""
    rows = [(i, f"http://h/{i}", "hot " * 40 if i % 3 == 0 else f"page {i // 2} " * 20) for i in range(120)]
    write_arc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), f"{tmp_path}/arc")
    found = []
    for limit in (10**6, 12, 0):
        convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc{limit}", list_limit=limit)
        found.append(sorted(map(tuple, read_warc(spark, f"{tmp_path}/warc{limit}").collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 120
    assert sum(r[1] == "revisit" for r in found[0]) == 120 - len({html for _, _, html in rows})


def test_archives_of_other_writers(spark, tmp_path):
    """Plain and gzipped files of any name, both versions; a task's file limit of the session does not part written files."""
    import gzip

    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\nContent-Length: 200\r\n\r\n" + b"z" * 200
    for version, name in ((1, "crawl-1.arc"), (2, "IAH-2.arc.gz")):
        raw = version_block(version, "20010203040506")
        for i in range(3):
            content = body % (10 * version + i)
            raw += arc_header(version, "http://h/", "20010203040506", "text/html", len(content)) + content + b"\n"
        (tmp_path / "arc").mkdir(exist_ok=True)
        (tmp_path / "arc" / name).write_bytes(gzip.compress(raw) if name.endswith("gz") else raw)
    convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    rows = read_warc(spark, f"{tmp_path}/warc").collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(10, "response")] + [(i, "revisit") for i in (11, 12, 20, 21, 22)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        pages = spark.createDataFrame([(i, "http://h/", f"{i} " * 60) for i in range(20)], "page_id long, url string, html string").repartition(2)
        assert sorted(r.page_id for r in archive_pages(pages).collect()) == list(range(20))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    result = con.execute(ORACLES["op2_warc"])
    got = QUERIES["op2_warc"](spark, sf_dir)
    assert got.columns == [d[0] for d in result.description]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, result.fetchall()))
