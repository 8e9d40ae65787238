import json

from pyspark.sql import functions as F

from quernstone.operators import graphs
from quernstone.operators.nested_records import shred_records
from quernstone.sources import adapters, readers


def test_cve_rows(spark):
    record = {
        "cveMetadata": {"cveId": "CVE-2025-1", "state": "PUBLISHED"},
        "containers": {
            "cna": {
                "title": " T ", "descriptions": [{"lang": "de", "value": "Deutsch"}, {"lang": "en-US", "value": "English"}, {"lang": "en", "value": "later"}],
                "affected": [{"vendor": "Acme", "product": "Tool", "cpes": ["cpe:2.3:a:acme:tool:1", "bad"], "collectionURL": "https://pypi.org/simple"}, {"vendor": "n/a", "product": "Solo"}, {"vendor": "acme", "product": "TOOL"}, {"vendor": "x", "product": "unspecified"}, {"vendor": "solo", "product": "Solo"}, {"packageName": "pk", "repo": "https://git.example/r"}, {"vendor": "a", "product": "fifth"}],
                "references": [{"url": "https://github.com/o/r/issues/1"}, {"url": "https://e.example"}, {"url": "https://e.example"}, None],
                "metrics": [{"other": {}}, {"cvssV4_0": {"baseScore": 5.5}, "cvssV3_1": {"baseScore": "high"}}, {"cvssV3_1": {"baseScore": 9}}],
                "problemTypes": [{"descriptions": [{"cweId": "CWE-79"}, {"cweId": "CWE-79"}, {"cweId": "NVD-CWE-Other"}, {"cweId": "CWE-20"}]}],
            },
            "adp": [{"affected": [{"vendor": "acme", "product": "Late"}], "metrics": [{"cvssV3_1": {"baseScore": 1.0}}]}],
        },
    }
    df = spark.createDataFrame([(1, json.dumps(record)), (2, json.dumps({"cveMetadata": {"cveId": "B", "state": "REJECTED"}})), (3, None)], "record_id bigint, payload string")
    a, b = adapters.cve_rows(shred_records(df)).orderBy("record_id").collect()
    assert (a.title, a.description, a.score, a.cwes, a.state) == ("T", "English", 5.5, ["CWE-20", "CWE-79"], "PUBLISHED")
    assert a.affected == "Acme/Tool, Solo, acme/TOOL, pk" and a.references == ["https://github.com/o/r/issues/1", "https://e.example"]
    assert a.products == ["Acme", "Tool", "simple", "n/a", "Solo", "x", "unspecified", "pk", "https://git.example/r", "a", "fifth", "Late", "o/r"]
    assert (b.cve_id, b.state, b.title, b.affected, b.cwes, b.products) == ("B", "REJECTED", None, "", [], [])


def test_osv_rows(spark, tmp_path):
    schema = "id string, aliases array<string>, summary string, details string, published string, modified string, references array<struct<type:string,url:string>>, affected array<struct<package:struct<name:string,ecosystem:string>>>"
    (tmp_path / "a.json").write_text(json.dumps([{"id": "GHSA-1", "aliases": ["cve-2024-1234", "PYSEC-1"], "summary": " S ", "details": "D\nE", "published": "2024-01-02T03:04:05Z", "references": [{"url": "https://x"}, {"url": "ftp://y"}], "affected": [{"package": {"name": "p", "ecosystem": "PyPI"}}]}, {"id": "OSV-2", "details": "first\nsecond", "modified": "2023-05-06"}, {"summary": "no id"}]))
    rows = adapters.osv_rows(readers.read_json_rows(spark, str(tmp_path), schema)).orderBy("source_id").collect()
    assert [tuple(r) for r in rows] == [("GHSA-1", "S", "D\nE", ["CVE-2024-1234"], "2024-01-02", "pypi/p", ["https://x"]), ("OSV-2", "first", "first\nsecond", [], "2023-05-06", None, None)]


def test_avid_rows(spark, tmp_path):
    value = {"metadata": {"vuln_id": "AVID-1"}, "affects": {"developer": ["D"], "deployer": ["D", "E"], "artifacts": [{"type": "m", "name": "M"}]}, "problemtype": {"description": {"lang": "eng", "value": " Title CVE-2023-11111 "}}, "references": [{"label": "cve-2023-22222", "url": f"https://r/{i}"} for i in range(8)], "description": {"value": "text"}, "reported_date": "2023-02-03"}
    schema = "metadata struct<vuln_id:string,report_id:string>, affects struct<developer:array<string>,deployer:array<string>,artifacts:array<struct<type:string,name:string>>>, problemtype struct<description:struct<lang:string,value:string>>, references array<struct<label:string,url:string>>, description struct<value:string>, published_date string, reported_date string"
    (tmp_path / "a.json").write_text(json.dumps([value, {"metadata": {}}, {"metadata": {"report_id": "R"}}]))
    a, r = adapters.avid_rows(readers.read_json_rows(spark, str(tmp_path), schema)).orderBy("source_id").collect()
    assert tuple(a)[:7] == ("AVID-1", "Title CVE-2023-11111", "text", ["CVE-2023-11111", "CVE-2023-22222"], "2023-02-03", ["D", "E"], ["M"]) and len(a.references) == 6
    assert (r.source_id, r.title, r.cve_ids, r.references) == ("R", None, [], [])


def test_incident_csv_rows(spark, tmp_path):
    (tmp_path / "i.csv").write_text('incident_id,date,reports,Alleged deployer of AI system,Alleged developer of AI system,description,title\n7,2020-01-02,"[1,2]","[""big-corp""]","[""big-corp"",""small_lab""]",D,T\n,2020,,,,x,y\n')
    aliases = {"incident_id": [], "date": [], "reports": [], "deployers": ["Alleged deployer of AI system"], "developers": ["Alleged developer of AI system"], "description": [], "title": []}
    rows = readers.read_csv_by_header(spark, str(tmp_path / "i.csv"), aliases, ["incident_id"])
    assert [tuple(r) for r in adapters.incident_csv_rows(rows).collect()] == [("AIID-7", "T", "D", "2020-01-02", 2020, ["Big Corp", "Small Lab"], 2)]


def test_paper_rows(spark, tmp_path):
    (tmp_path / "p.xml").write_text('<r><record><header><identifier>oai:arXiv.org:1</identifier></header><metadata><arXiv><created>2024-01-01</created><title>A\n  b</title><abstract> c </abstract><categories>cs.AI cs.CR</categories><authors><author><keyname>K</keyname><forenames>F</forenames></author><author><keyname>L</keyname></author></authors></arXiv></metadata></record><record><header status="deleted"><identifier>oai:arXiv.org:2</identifier></header></record></r>')
    schema = "header struct<_status:string,identifier:string>, metadata struct<arXiv:struct<created:string,title:string,abstract:string,categories:string,authors:struct<author:array<struct<keyname:string,forenames:string>>>>>"
    rows = [tuple(r) for r in adapters.paper_rows(readers.read_xml_records(spark, str(tmp_path / "p.xml"), "record", schema)).orderBy("source_id").collect()]
    assert rows[0] == ("arXiv:1", False, "A b", "c", "2024-01-01", ["F K", "L"], ["cs.AI", "cs.CR"]) and rows[1][:3] == ("arXiv:2", True, None)


def test_stix_objects(spark):
    df = spark.createDataFrame([("i1", "T", "2024-05", "2024-06-07", "High", ["a"], ["CVE-1", None, "CVE-1"], [("https://u",), (" ",)]), ("i2", None, None, None, None, None, None, None), (None, "x", None, None, None, None, None, None)], "id string, title string, added string, updated string, severity string, tags array<string>, cve_ids array<string>, references array<struct<url:string>>")
    rows = {r.type: r for r in graphs.stix_objects(df, 12).where("name IS NOT NULL").collect()}
    incident, flaw, tie = (json.loads(rows[t].body) for t in ("x-incident", "vulnerability", "relationship"))
    assert (incident["created"], incident["modified"], incident["external_references"]) == ("2024-05-01T00:00:00.000Z", "2024-06-07T00:00:00.012Z", [{"source_name": "reference", "url": "https://u"}])
    assert (tie["source_ref"], tie["target_ref"], flaw["name"]) == (incident["id"], flaw["id"], "CVE-1")
    assert graphs.stix_objects(df, 12).count() == 4 and graphs.stix_objects(df.limit(0), 12).count() == 0
    none = [r for r in graphs.stix_objects(df, 12).where(F.col("type") == "x-incident").collect() if r.name is None]
    assert [(r.created, r.modified) for r in none] == [("1970-01-01T00:00:00.000Z",) * 2]
