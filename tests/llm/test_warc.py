import gzip
import random
from pathlib import Path
from urllib.request import url2pathname

import pytest

from tools.agree import bag, connect
from trackspark.llm.common import scratch
from trackspark.llm.warc import FIRST_SECOND, OP9_SQL, capture_index, merged_runs, op9_warc, parsed, read_archives, size_classes, write_archives


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(2)
    for count in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(40) for _ in range(rng.randrange(12))) for _ in range(count)]
        assert list(merged_runs(runs, lambda x: x)) == sorted(x for r in runs for x in r)


PAGES = [
    (5, "http://b.example/x", "same"),
    (2, "https://A.example:8080/y?z#f", "same"),
    (9, None, None),
    (4, "http://a.example/", ""),
    (7, "http://a.example/\r\nX: 1", "body\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\n é"),
    (8, "http://b.example/x", "x" * 300_000),
]


def indexed(spark, pages, **options):
    folder = scratch(spark, "warc")
    rows = write_archives(spark.createDataFrame(pages, "page_id long, url string, html string, captured string"), folder, **options)
    return capture_index(read_archives(spark, folder), rows)


def test_round_trip_revisits_and_order(spark):
    index = indexed(spark, [(*p, "clash") for p in PAGES], records_per_file=2)
    rows = [r for part in index.rdd.glom().collect() for r in part]
    assert [(r.url_key, r.captured, r.page_id) for r in rows] == sorted((r.url_key, r.captured, r.page_id) for r in rows)
    by = {r.page_id: r for r in rows}
    assert {i: (r.record_type, r.refers_to) for i, r in by.items()} == {
        2: ("response", None), 5: ("revisit", 2), 4: ("response", None), 9: ("revisit", 4),
        7: ("response", None), 8: ("response", None),
    }
    assert by[5].payload_bytes == 4 and by[9].payload_bytes == 0 and by[8].payload_bytes == 300_000
    assert by[2].url_key == "example,a)/y?z" and by[9].url_key == ")"
    assert by[2].payload_digest == by[5].payload_digest


def test_small_payloads_may_stay_unlinked_and_empty_tables_work(spark):
    index = indexed(spark, [(*p, None) for p in PAGES], min_bytes=1)
    assert {r.page_id for r in index.collect() if r.record_type == "revisit"} == {5}
    assert indexed(spark, [(1, "u", "h", None)][:0] or [(1, None, None, None)]).count() == 1
    folder = scratch(spark, "warc")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert read_archives(spark, folder).count() == 0


NO_ID = [
    (None, "http://c.example/", "alone"),
    (None, "http://c.example/", "alone"),
    (None, None, None),
    (None, "http://b.example/x", "same"),
    (3, None, "same"),
    (6, "http://c.example/", "own"),
]


def test_pages_without_id_agree_with_sql(spark, tmp_path):
    pages = spark.createDataFrame([*PAGES, *NO_ID], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    df = op9_warc(spark, str(tmp_path))
    spark.read.parquet(f"{tmp_path}/pages.parquet").coalesce(1).write.parquet(f"{tmp_path}/one/pages")
    file = next(Path(f"{tmp_path}/one/pages").glob("*.parquet"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE TEMP VIEW pages AS SELECT * FROM read_parquet('{file}')")
    result = con.execute(OP9_SQL)
    left = bag(df.columns, [tuple(r) for r in df.collect()])
    assert left == bag([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_payloads_of_pages_without_id_are_kept_and_null_times_read_back(spark, min_bytes):
    folder = scratch(spark, "warc")
    pages = spark.createDataFrame(NO_ID, "page_id long, url string, html string")
    assert write_archives(pages, folder, min_bytes) == len(NO_ID)
    found = []
    for file in Path(url2pathname(folder.removeprefix("file://").removeprefix("file:"))).glob("*.gz"):
        found += [(h.get("X-Page-Id"), h["WARC-Type"], body) for _, _, h, body in parsed(gzip.decompress(file.read_bytes()))]
    assert {b for _, _, b in found} >= {b"alone", b"same", b"own"}
    same = [(t, b) for i, t, b in found if i is None and b != b"alone" and t == ("response" if min_bytes else "revisit")]
    assert sorted(same) == ([("response", b""), ("response", b"same")] if min_bytes else [("revisit", b""), ("revisit", b"")])
    index = capture_index(read_archives(spark, folder), len(NO_ID))
    rows = [r for part in index.rdd.glom().collect() for r in part]
    assert sorted(str(r.captured) for r in rows) == [str(FIRST_SECOND + 3), str(FIRST_SECOND + 6), *["None"] * 4]
    key = lambda r: (r.url_key, *((x is not None, x or 0) for x in (r.captured, r.page_id)))
    assert [key(r) for r in rows] == sorted(map(key, rows)) and sum(r.page_id is None for r in rows) == 4


def test_files_are_bounded_by_bytes(spark):
    assert size_classes(32 << 20, 2000)[0] == (0, (32 << 20) // 2000 + 1, 2000)
    classes = size_classes(1000, 100)
    assert classes == [(0, 11, 100), (11, 161, 6), (161, 1 << 62, 1)]
    folder = scratch(spark, "warc")
    sizes = [5] * 250 + [100] * 20 + [700, 900, 5000]
    pages = spark.createDataFrame([(i, f"http://a.example/{i}", f"{i:05d}"[:5] + "x" * (n - 5)) for i, n in enumerate(sizes)], "page_id long, url string, html string")
    assert write_archives(pages.coalesce(1), folder, records_per_file=100, file_bytes=1000) == len(sizes)
    held = []
    for file in Path(url2pathname(folder.removeprefix("file://").removeprefix("file:"))).glob("*.gz"):
        held.append([len(body) for _, _, _, body in parsed(gzip.decompress(file.read_bytes()))])
    assert sorted(n for h in held for n in h) == sorted(sizes)
    assert all(sum(h) <= 1000 or len(h) == 1 for h in held)


def test_parts_follow_the_rows(spark, monkeypatch):
    from trackspark.llm import warc

    monkeypatch.setattr(warc, "PART_ROWS", 10)
    pages = spark.createDataFrame([(i, f"http://a.example/{i % 7}", f"p{i}") for i in range(200)], "page_id long, url string, html string")
    folder = scratch(spark, "warc")
    rows = write_archives(pages, folder)
    parts = capture_index(read_archives(spark, folder), rows).rdd.glom().collect()
    assert len(parts) == 20 and sum(map(len, parts)) == 200
