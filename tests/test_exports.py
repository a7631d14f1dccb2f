"""Writers and the readers of what they write."""

import csv
import json
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest

from pageloom.operators import search
from pageloom.operators.pages import parse_pages
from pageloom.plans.stages import with_row_index
from pageloom.schema import FETCH, PAGE_RECORD, RECORD_FIELDS, with_defaults
from pageloom.sinks import exports
from pageloom.sources import records as record_io
from pageloom.streaming.pages import append_records, stream_records

NS = "{http://www.sitemaps.org/schemas/sitemap/0.9}"
ROWS = [
    {
        "seq": 0, "url": "https://example.com/?a=1&b=2", "status_code": 200, "title": 'Home, "quoted"',
        "headings": {"h2": ["Zwei"], "h1": ["Welcome"]},
        "paragraphs": ["Spark reads pages.", "Spark writes\nthem – straße."],
        "links": ["https://example.com/about"], "internal_links": ["https://example.com/about"],
        "word_count": 9, "depth": 0, "fetched_at": "2026-01-01T00:00:00+00:00",
    },
    {
        "seq": 1, "url": "https://example.com/about", "status_code": 200, "title": "About",
        "headings": {"h1": ["About Us"]}, "paragraphs": ["The tools and the data."],
        "word_count": 8, "depth": 1, "fetched_at": "",
    },
    {"seq": 2, "url": "https://example.com/broken", "error": "404 Not Found", "depth": 1},
    {"seq": 3, "url": "https://example.com/silent", "error": "", "depth": 1},
]


@pytest.fixture(scope="module")
def records(spark):
    schema = "seq bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PAGE_RECORD)
    rows = [tuple(r.get(n) for n in ["seq", *RECORD_FIELDS]) for r in ROWS]
    return with_defaults(spark.createDataFrame(rows, schema).repartition(3, "url"), "seq")


def _text(folder, pattern="part-*"):
    return "".join(p.read_text(encoding="utf-8") for p in sorted(Path(folder).glob(pattern)))


def _plain(df):
    return [r.asDict() for r in df.orderBy("seq").collect()]


def test_one_document(spark, records, tmp_path):
    exports.write_crawl_json(records, str(tmp_path / "doc"), "r1")
    raw = _text(tmp_path / "doc")
    document = json.loads(raw)
    assert (document["run_id"], document["page_count"]) == ("r1", 4)
    assert [p["url"] for p in document["pages"]] == [r["url"] for r in ROWS]
    assert list(document["pages"][0]) == RECORD_FIELDS
    assert document["pages"][0]["error"] is None and "straße" in raw
    assert document["pages"][2]["status_code"] is None
    (tmp_path / "whole.json").write_text(raw, encoding="utf-8")
    back = record_io.read_crawl_json(spark, str(tmp_path / "whole.json"))
    assert _plain(back) == _plain(records)


def test_record_lines(spark, records, tmp_path):
    exports.write_record_lines(records, str(tmp_path / "lines"))
    assert _plain(record_io.read_record_lines(spark, str(tmp_path / "lines"))) == _plain(records)


def test_reading_documents_with_gaps(spark, tmp_path):
    def read(document):
        path = tmp_path / "gap.json"
        path.write_text(json.dumps(document))
        return record_io.read_crawl_json(spark, str(path)).collect()

    assert read({"run_id": "x"}) == []
    page = read({"pages": [{"url": "u", "extra": 1, "title": "t"}]})[0]
    assert (page["title"], page["paragraphs"], page["headings"], page["word_count"]) == ("t", [], {}, 0)
    assert page["error"] is None and page["seq"] == 0
    read({"pages": [{"url": "u", "headings": {"h2": ["a"], "h1": ["b"]}}]})
    back = record_io.read_crawl_json(spark, str(tmp_path / "gap.json"))
    assert back.selectExpr("map_keys(headings)").first()[0] == ["h2", "h1"]  # as written
    with pytest.raises(Exception, match="without url"):
        read({"pages": [{"title": "t"}]})


def test_csv(spark, records, tmp_path):
    exports.write_csv(records.coalesce(1), str(tmp_path / "csv"))
    rows = list(csv.DictReader(_text(tmp_path / "csv").splitlines(keepends=True)))
    rows = [r for r in rows if r["url"] != "url"]  # every part repeats the header
    assert list(rows[0]) == exports.CSV_COLUMNS
    assert [r["url"] for r in rows] == [r["url"] for r in ROWS]
    assert rows[0]["title"] == 'Home, "quoted"' and rows[0]["num_headings"] == "2"
    assert [r["error"] for r in rows] == ["", "", "404 Not Found", ""]
    assert [r["status_code"] for r in rows] == ["200", "200", "", ""]


def test_table_appends_and_replaces(spark, records, tmp_path):
    path = str(tmp_path / "pages")
    exports.append_table(records, path, "a")
    exports.append_table(records, path, "a")
    exports.append_table(records, path, "b")
    counts = lambda: {r["run_id"]: r["page_count"] for r in record_io.run_counts(spark, path).collect()}
    assert counts() == {"a": 8, "b": 4}
    exports.append_table(records, path, "a", replace_run=True)
    assert counts() == {"a": 4, "b": 4}
    stored = spark.read.parquet(path).filter("run_id = 'b' AND seq = 0").first()
    assert json.loads(stored["headings"]) == ROWS[0]["headings"]
    assert "internal_links" not in stored.asDict()
    back = record_io.read_run(spark, path, "b")
    want = _plain(records)
    for row in want:
        row["internal_links"] = row["external_links"] = []
    assert _plain(back) == want
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_attempts_that_broke_are_not_read(spark, records, tmp_path, monkeypatch):
    path = str(tmp_path / "pages")
    counts = lambda: {r["run_id"]: r["page_count"] for r in record_io.run_counts(spark, path).collect()}

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(exports.CommitLog, "publish", lost)
        with pytest.raises(OSError):
            exports.append_table(records, path, "007")
    assert counts() == {} and record_io.read_run(spark, path, "007").count() == 0
    assert exports.append_table(records, path, "007", once=True)
    assert not exports.append_table(records, path, "007", once=True)
    assert counts() == {"007": 4}  # a run id stays text
    with monkeypatch.context() as broken:
        broken.setattr(exports.CommitLog, "publish", lost)
        with pytest.raises(OSError):
            exports.append_table(records, path, "007", replace_run=True)
    assert counts() == {"007": 4}
    odd = "a/b=c %"
    exports.append_table(records.limit(0), path, odd)
    exports.append_table(records.filter("seq = 1"), path, odd)
    assert record_io.read_run(spark, path, odd).count() == 1


def test_an_export_that_broke_is_repeated(spark, records, tmp_path, monkeypatch):
    folder = str(tmp_path)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(exports, "write_csv", lost)
        with pytest.raises(OSError):
            exports.export(records, folder, run_id="r")
    assert not (tmp_path / "crawl_r.csv").exists()
    first = {p.name for p in (tmp_path / "crawl_r.json").iterdir()}
    paths = exports.export(records, folder, run_id="r")
    assert exports.export(records, folder, run_id="r") == paths
    assert {p.name for p in (tmp_path / "crawl_r.json").iterdir()} == first
    assert record_io.read_run(spark, paths["sqlite"], "r").count() == 4
    exports.export(records.filter("seq < 2"), folder, run_id="r", replace=True)
    assert record_io.read_run(spark, paths["sqlite"], "r").count() == 2
    assert record_io.read_record_lines(spark, paths["json"]).count() == 2
    assert spark.read.json(str(tmp_path / "crawl_r.manifest")).first()["page_count"] == 2


def test_sorted_exports_parse_once(spark, records):
    rows = exports.csv_rows(parse_pages(spark.createDataFrame([("https://h/", 200, "text/html", "<p>x", "", None, 0)], "url string, status_code int, content_type string, body string, fetched_at string, error string, seq bigint")))
    plan = rows._jdf.queryExecution().toString()
    assert "CollectMetrics" not in plan and "regexp" not in plan


def test_sitemap(spark, records, tmp_path):
    exports.write_sitemap(records, str(tmp_path / "map"))
    found = []
    for part in sorted((tmp_path / "map").glob("part-*")):
        root = ET.fromstring(part.read_text(encoding="utf-8"))
        assert root.tag == NS + "urlset"
        found += [(u.findtext(NS + "loc"), u.findtext(NS + "lastmod")) for u in root]
    assert found == [
        ("https://example.com/?a=1&b=2", "2026-01-01"),
        ("https://example.com/about", None),
    ]


def test_export(spark, records, tmp_path):
    paths = exports.export(records, str(tmp_path), ["csv", "json", "sqlite", "pdf"], run_id="r")
    assert set(paths) == {"csv", "json", "sqlite"}
    assert paths["json"].endswith("crawl_r.json") and paths["csv"].endswith("crawl_r.csv")
    assert record_io.read_record_lines(spark, paths["json"]).count() == 4
    manifest = spark.read.json(str(tmp_path / "crawl_r.manifest")).first()
    assert (manifest["run_id"], manifest["page_count"]) == ("r", 4)
    assert record_io.read_run(spark, paths["sqlite"], "r").count() == 4
    document = exports.export(records, str(tmp_path), ["json"], one_document=True)["json"]
    assert json.loads(_text(document))["page_count"] == 4


def test_searching_an_export(spark, records):
    found = search.keyword_search(records, "spark").collect()
    assert [(r["url"], r["score"]) for r in found] == [(ROWS[0]["url"], 2)]
    words = {r["word"] for r in search.keyword_frequency(records, 10).collect()}
    assert "the" not in words and "spark" in words


def test_row_index(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1000 AS k").repartition(7)
    indexed, n = with_row_index(df, "k")
    assert n == 1000 and indexed.filter("k <> idx").count() == 0
    assert with_row_index(df.filter("k < 0"), "k")[1] == 0


def test_stream(spark, tmp_path):
    rows = [("https://h/", 200, "text/html", "<p>x y</p>", "", None), ("https://h/f", 404, "text/html", "", "", None)]
    spark.createDataFrame(rows, FETCH).write.parquet(str(tmp_path / "in"))
    records = stream_records(spark, str(tmp_path / "in"))
    append_records(records, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    got = {r["url"]: (r["word_count"], r["error"] is None) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"https://h/": (2, True), "https://h/f": (0, False)}


def test_document_in_parts(spark, tmp_path):
    """Read part by part, in order; what is damaged or missing is an error."""
    import shutil

    rows = [(n, f"https://h/{n}", [f"a\n{n}", '"],["', "]}", '"pages": [']) for n in range(200)]
    df = spark.createDataFrame(rows, "seq bigint, url string, paragraphs array<string>")
    records = with_defaults(df, "seq")
    path = tmp_path / "document"
    exports.write_crawl_json(records, str(path), "run", parts=5)
    files = sorted(path.glob("part-*"))
    assert len(files) == 5
    back = record_io.read_crawl_json(spark, str(path))
    assert back.rdd.getNumPartitions() > 1
    got = [(r.seq, r.url, r.paragraphs) for r in back.orderBy("seq").collect()]
    assert got == rows
    whole = tmp_path / "whole.json"
    whole.write_bytes(b"".join(f.read_bytes() for f in files))
    assert record_io.read_crawl_json(spark, str(whole)).orderBy("seq").collect() == back.orderBy("seq").collect()
    assert json.loads(whole.read_text())["page_count"] == 200
    lost = tmp_path / "lost"
    shutil.copytree(path, lost, ignore=shutil.ignore_patterns(files[2].name, ".*"))
    with pytest.raises(ValueError, match="damaged export"):
        record_io.read_crawl_json(spark, str(lost))
    text = files[2].read_text().splitlines(keepends=True)
    broken = tmp_path / "broken"
    shutil.copytree(path, broken, ignore=shutil.ignore_patterns(".*"))
    (broken / files[2].name).write_text("".join([text[0][: len(text[0]) // 2] + "\n", *text[1:]]))
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        record_io.read_crawl_json(spark, str(broken)).collect()
