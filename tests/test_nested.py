import json
import random

from quernstone.functions.shredding import Column, rebuild
from pyspark.sql import functions as F

from quernstone.operators.nested_records import KINDS, element_table, read_records, shred_records, unreadable_records


def test_levels_round_trip():
    rng = random.Random(1)

    def value():
        return {"a": rng.choice([None, [], [rng.choice([None, {}, {"b": rng.choice([None, [], [rng.choice([None, {"c": rng.choice([None, 1, "x"])}]) for _ in range(rng.randint(0, 3))]])}]) for _ in range(rng.randint(0, 3))]])}

    records = [value() for _ in range(400)] + [None, {}, {"a": {"b": {"c": 1}}}, {"a": "other"}]
    column = Column([("a", True), ("b", True), ("c", False)])
    for r in records:
        column.add(r)
    table = rebuild([column], 1)
    got = sorted(zip(table.record.tolist(), table.positions[0].tolist(), table.positions[1].tolist(), map(repr, table.leaves[0])))
    want = []
    lists = lambda x: [x] if isinstance(x, dict) else x if isinstance(x, list) else []
    for i, r in enumerate(records):
        for j, a in enumerate(lists((r or {}).get("a"))):
            for k, b in enumerate(lists((a or {}).get("b"))):
                if b is not None:
                    want.append((i, j, k, repr(b.get("c"))))
    assert got == sorted(want)


RECORD = {
    "cveMetadata": {"cveId": "CVE-2026-1"},
    "containers": {
        "cna": {"title": "T", "descriptions": [{"lang": "en", "value": "d"}, None], "affected": [None, {"vendor": "v", "versions": [{"version": "1"}, None, {"version": "2"}]}], "problemTypes": [{"descriptions": [{"cweId": "CWE-1"}]}, {}], "references": None},
        "adp": [None, {"title": " ", "metrics": [{"format": "x"}], "references": []}, {"affected": {"vendor": "lone"}}],
    },
}


def rows(df):
    return sorted(tuple(r) for r in df.where(F.col("kind").isin(KINDS)).select("record_id", "container", "container_pos", "kind", "item_pos", "sub_pos").collect())


def test_positions_and_wrappings(spark):
    text = json.dumps(RECORD)
    payloads = [text, "﻿" + text, json.dumps(text), json.dumps([RECORD]), json.dumps({"data": RECORD, "fetched": "x"}), text[:-9], "", None, "null", "<html>", "[]", "3", json.dumps({"containers": []}), json.dumps({"cveMetadata": None}), "[" * 5000]
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(payloads)], "record_id bigint, payload string, kind string")
    one = [("adp", 1, "metric", 0, -1), ("adp", 2, "affected", 0, -1), ("cna", 0, "affected", 1, -1), ("cna", 0, "description", 0, -1), ("cna", 0, "problem", 0, 0), ("cna", 0, "title", -1, -1), ("cna", 0, "version", 1, 0), ("cna", 0, "version", 1, 2)]
    assert rows(shred_records(df)) == sorted((i, *r) for i in range(5) for r in one)
    versions = element_table(shred_records(df.where("record_id = 0")), "version").collect()
    assert [(r.cve_id, r.item_pos, r.version) for r in versions] == [("CVE-2026-1", 1, "1"), ("CVE-2026-1", 1, "2")]
    assert shred_records(df.limit(0)).count() == 0


def test_lone_adp_object(spark):
    df = spark.createDataFrame([(1, json.dumps({"containers": {"adp": {"title": "x"}}}))], "record_id bigint, payload string")
    assert rows(shred_records(df)) == [(1, "adp", 0, "title", -1, -1)]


def test_unreadable(spark):
    payloads = [None, "", " \n", "<html>", '{"a": ', "null", '"x"', '{"a": 1}', "[]", json.dumps(RECORD), "[" * 5000]
    df = spark.createDataFrame(list(enumerate(payloads)), "record_id bigint, payload string")
    got = {r.record_id: r.reason for r in unreadable_records(df).collect()}
    assert got == {0: "null", 1: "blank", 2: "blank", 3: "no JSON", 4: "no JSON", 5: "no record", 6: "no record", 7: "no record", 8: "no record", 10: "no JSON"}
    assert read_records(json.dumps(RECORD)) == ([RECORD], None)


def test_several_records_in_a_payload(spark):
    other = {"cveMetadata": {"cveId": "CVE-2026-2"}, "containers": {"cna": {"title": "U"}}}
    payloads = [json.dumps([RECORD, None, other]), json.dumps({"one": other, "two": json.dumps(RECORD), "n": 3})]
    df = spark.createDataFrame(list(enumerate(payloads)), "record_id bigint, payload string")
    titles = element_table(shred_records(df), "title").collect()
    assert sorted((r.record_id, r.record_pos, r.cve_id, r.title) for r in titles) == [(0, 0, "CVE-2026-1", "T"), (0, 1, "CVE-2026-2", "U"), (1, 0, "CVE-2026-2", "U"), (1, 1, "CVE-2026-1", "T")]


def test_no_leaf_is_lost(spark):
    record = {
        "dataVersion": "5.1", "cveMetadata": {"cveId": "C", "state": "REJECTED"}, "extra": [1, 2],
        "containers": {"cna": {"providerMetadata": {"orgId": "o", "deep": {"er": 1.5}}, "rejectedReasons": [{"lang": "en", "value": "no"}, None, "bare"], "source": {}, "metrics": [{"cvssV3_1": {"baseScore": 9.8}, "scenarios": [{"lang": "en"}]}], "references": [{"url": "u", "tags": ["a", "b"]}], "title": "t"}},
    }
    df = spark.createDataFrame([(1, json.dumps(record))], "record_id bigint, payload string")
    got = {(r.kind, r.item_pos): dict(r.attributes) for r in shred_records(df).collect()}
    assert got == {
        ("record", -1): {"dataVersion": "5.1", "cveMetadata.cveId": "C", "cveMetadata.state": "REJECTED", "extra": "[1, 2]"},
        ("container", -1): {"providerMetadata.orgId": "o", "providerMetadata.deep.er": "1.5", "source": "{}"},
        ("rejectedReasons", 0): {"lang": "en", "value": "no"}, ("rejectedReasons", 2): {"rejectedReasons": "bare"},
        ("metric", 0): {"cvssV3_1.baseScore": "9.8", "scenarios": '[{"lang": "en"}]'}, ("reference", 0): {"url": "u", "tags": '["a", "b"]'}, ("title", -1): {"title": "t"},
    }
