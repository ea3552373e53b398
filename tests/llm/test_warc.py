import glob
import gzip
import hashlib

from tickframe.llm import warc


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows],
                                 "page_id long, url string, html string, payload string, "
                                 "record_type string")


BIG = "<p>" + "long text " * 20
ROWS = [(1, "http://a/1", None), (2, "http://a/2", ""), (3, None, "short"), (4, "u", "short"),
        (5, "http://a/\r\n5", BIG), (7, "http://a/7", BIG), (6, "x", BIG), (None, "x", BIG),
        (8, "http://é/", "é" * 50 + "\r\n\r\nWARC/1.1\r\n"), (9, "z", "y" * 500_000), (5, "b", BIG)]


def _written(spark, tmp_path, rows=ROWS):
    path = str(tmp_path / "warc")
    warc.write(warc.mark_revisits(_pages(spark, rows)), path)
    return path


def test_round_trip(spark, tmp_path):
    path = _written(spark, tmp_path)
    got = warc.verified(spark, path).collect()
    want = []
    for i, _, h in ROWS:
        raw = (h or "").encode()
        again = h == BIG and i != 5
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(),
                     "revisit" if again else "response", 5 if again else None))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_archives_are_plain_gzip(spark, tmp_path):
    path = _written(spark, tmp_path)
    text = b"".join(gzip.open(f).read() for f in glob.glob(path + "/*.warc.gz"))
    assert text.count(b"WARC-Record-ID:") == len(ROWS)


def test_splits_and_foreign_archives_read_alike(spark, tmp_path):
    rows = ROWS + [(100 + k, "u", f"page {k} " * (k % 50)) for k in range(300)]
    path = _written(spark, tmp_path, rows)
    whole = sorted(map(str, warc.read(spark, path).collect()))
    assert sorted(map(str, warc.read(spark, path, splitBytes="700").collect())) == whole
    for kind, opened in (("gz", gzip.open), ("plain", open)):
        other = tmp_path / kind
        other.mkdir()
        for k, f in enumerate(sorted(glob.glob(path + "/*.warc.gz"))):
            with opened(other / f"{k}.warc{'.gz' if kind == 'gz' else ''}", "wb") as out:
                out.write(gzip.open(f).read())
        assert sorted(map(str, warc.read(spark, str(other)).collect())) == whole
        assert warc.read(spark, str(other), payload=False).where("payload IS NULL").count() == len(
            rows)


def test_predicates_skip_payloads(spark, tmp_path):
    path = _written(spark, tmp_path)
    reader = warc.WarcReader({"path": path})
    reader.wanted = [(warc.EqualTo, "record_type", "revisit")]
    rows = [r for s in reader.partitions() for b in reader.read(s) for r in b.to_pylist()]
    assert len(rows) == 3 and {r["refers_to"] for r in rows} == {5}
    df = warc.read(spark, path).where("record_type = 'revisit' AND page_id > 6")
    assert "Filter" not in df._jdf.queryExecution().executedPlan().toString().split("\n")[0]
    assert [r.page_id for r in df.collect()] == [7]


def test_empty_table(spark, tmp_path):
    assert warc.verified(spark, _written(spark, tmp_path, [])).count() == 0
