import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from quernstone.sources import readers, writers


def test_json_feeds(spark, tmp_path):
    for name, value in {"a.json": [{"id": "1", "n": 2}], "b.json": {"entries": [{"id": "2"}], "x": 1}, "c.json": {"data": []}}.items():
        (tmp_path / name).write_text(json.dumps(value))
    rows = readers.read_json_rows(spark, str(tmp_path), "id string, n int").orderBy("file").collect()
    assert [(r.file, r.pos, r.id, r.n) for r in rows] == [("a.json", 0, "1", 2), ("b.json", 0, "2", None)]
    for bad in ('{"entries": [{"id": "1"}], "data": [{"id": "2"}]}', "null", "{oops", '{"other": []}'):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(Exception, match="agreed row key"):
            readers.read_json_rows(spark, str(tmp_path / "bad.json"), "id string").collect()


def test_json_maps(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"_note": {"a": 0}, "k1": {"a": 1}, "k2": {"a": null}}')
    assert sorted(map(tuple, readers.read_json_map(spark, str(tmp_path / "m.json"), "a int").collect()), key=str) == [("k1", 1), ("k2", None)]


def test_json_maps_of_another_shape(spark, tmp_path):
    for bad in ('{"k1": {"a": 1', "[1]"):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(Exception, match="no JSON object"):
            readers.read_json_map(spark, str(tmp_path / "bad.json"), "a int").collect()


def test_members_that_do_not_fit(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "o.zip", "w") as z:
        z.writestr("big.json", "1" * 2000)
        z.writestr("small.json", "1")
    assert readers.read_archives(spark, str(tmp_path), "small").count() == 1
    with pytest.raises(Exception, match="more than the limit"):
        readers.read_archives(spark, str(tmp_path), largest_member=1000).collect()


def test_csv_headers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('Ref,,"Head Line"\n,Occurred,\n1,2020,"a, ""b"""\n2,,c\n')
    aliases = {"id": ["ref"], "date": ["occurred"], "title": ["head line"], "extra": ["none"]}
    rows = readers.read_csv_by_header(spark, str(tmp_path / "t.csv"), aliases, ["id", "title"], 2).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "2020", 'a, "b"'), ("2", None, "c")]
    with pytest.raises(readers.FeedShapeError, match="extra"):
        readers.read_csv_by_header(spark, str(tmp_path / "t.csv"), aliases, ["extra"], 2)


def test_archives(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep/r.json", '{"id": 7}')
    with zipfile.ZipFile(tmp_path / "o.zip", "w") as z:
        z.writestr("inner.zip", inner.getvalue())
        z.writestr("t.csv", "﻿id,name\n1,x\n")
        z.writestr("skip.txt", "no")
    with tarfile.open(tmp_path / "s.tar.bz2", "w:bz2") as t:
        data = b'{"id": 8}'
        info = tarfile.TarInfo("x/y.json")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    found = readers.read_archives(spark, str(tmp_path), r"\.(json|csv)$")
    assert {r.member for r in found.collect()} == {"deep/r.json", "t.csv", "x/y.json"}
    assert {r.id for r in readers.json_members(found.where("member LIKE '%json'"), "id int").collect()} == {7, 8}
    assert [tuple(r) for r in readers.csv_members(found.where("member LIKE '%csv'"), "id string, name string").collect()] == [("t.csv", "1", "x")]


def test_xml_pipes_and_pages(spark, tmp_path):
    (tmp_path / "p.xml").write_text("<r><record><id>a</id><n>1</n></record><record><id>b</id></record></r>")
    assert [tuple(r) for r in readers.read_xml_records(spark, str(tmp_path / "p.xml"), "record", "id string, n int").orderBy("id").collect()] == [("a", 1), ("b", None)]
    (tmp_path / "t.md").write_text("| a | b |\n|---|---|\n| x | [y](https://e.example/1) |\n| no | link |\ntext\n")
    assert [r.cells for r in readers.read_pipe_tables(spark, str(tmp_path / "t.md"), 2).collect()] == [["x", "[y](https://e.example/1)"]]
    pages = spark.createDataFrame([('<script id="s" type="x">{"a": 1}</script>',), ('<script id="s">oops{</script>',), ("none",)], "html string")
    assert [r[0] for r in pages.select(readers.embedded_state(F.col("html"), "s")).collect()] == ['{"a": 1}', None, None]


def test_ordered_union(spark):
    a, b = spark.createDataFrame([(1, "x")], "pos int, t string"), spark.createDataFrame([(0, 5)], "pos int, u int")
    assert sorted(map(tuple, readers.ordered_union([a, b], ["pos"]).collect())) == [(0, 1, "x", None), (1, 0, None, 5)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2020, ["a", "b"], 'q"x'), (2, 2021, None, None)], "id int, year int, tags array<string>, note string")
    writers.write_by(df, str(tmp_path / "by"), "year")
    assert spark.read.parquet(str(tmp_path / "by")).where("year = 2020").count() == 1
    writers.write_json_lines(df, str(tmp_path / "jl"))
    lines = [json.loads(line) for p in (tmp_path / "jl").glob("*.json") for line in p.read_text().splitlines()]
    assert sorted(map(len, lines)) == [2, 4] and all(list(x) == sorted(x) for x in lines)
    writers.write_csv(df, str(tmp_path / "csv"))
    body = "".join(p.read_bytes().decode() for p in (tmp_path / "csv/body").glob("*.txt"))
    assert '1,2020,a; b,"q""x"\r\n' in body and "2,2021,,\r\n" in body
    sums = writers.checksums(str(tmp_path / "jl"), spark).where("file LIKE '%.json'")
    assert writers.verify_checksums(sums, sums).count() == 0
    changed = sums.limit(1).select("file", "bytes", F.lit("x").alias("sha256")).unionByName(spark.createDataFrame([("new", 1, "y")], sums.schema))
    assert {r.finding for r in writers.verify_checksums(sums, changed).collect()} <= {"mismatch", "unlisted", "missing"}
    core, detail = writers.split_columns(df, "id", ["note"], "year")
    assert core.columns == ["id", "note"] and detail.columns == ["id", "year", "tags"]
