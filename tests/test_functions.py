import uuid

import pytest
from pyspark.sql import functions as F

from quernstone.functions import arrays, dates, rules, text, urls
from quernstone.operators import estimates, graphs, health
from quernstone.operators.search import QuerySpec, matches


def values(spark, make, items, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i,) for i in items], f"x {kind}").select(make(F.col("x"))).collect()]


def test_text(spark):
    assert values(spark, text.title_key, ["  The Ünder: Score_9!", "", None, "日本"]) == ["the nder score 9", "", None, ""]
    assert values(spark, lambda c: text.cut_words(c, 20), ["short", "a fairly long sentence here", "abcdefghijklmnopqrstuvwxyz", None]) == ["short", "a fairly long…", "abcdefghijklmnopqrs…", None]
    assert values(spark, lambda c: text.cut_plain(c, 6), ["abc", "abcde fgh"]) == ["abc", "abcde…"]
    assert values(spark, lambda c: text.first_sentences(c, 20), ["One. Two is. Three is long.", "A very long first sentence. B."]) == ["One. Two is.", "A very long first sentence."]
    assert values(spark, lambda c: text.one_of(c, ["High", "Low"], "Low"), [" HIGH ", "odd", None]) == ["High", "Low", "Low"]
    assert values(spark, text.safe_url, ["https://a.example/x?y=1", "javascript:x", "https://a b", 'https://a"b', None]) == ["https://a.example/x?y=1", "#", "#", "#", "#"]
    assert values(spark, text.escape_xml, ['<a & "b">']) == ["&lt;a &amp; &quot;b&quot;&gt;"]
    assert values(spark, text.package_url, ["npm/@s/n@1.2", "maven/g:a", "pip/Foo 1.0", "odd/x", "npm/", None]) == ["pkg:npm/%40s/n", "pkg:maven/g/a", "pkg:pypi/Foo", None, None, None]
    assert values(spark, lambda c: text.without_parameters(c, "X-Amz-[A-Za-z]+"), ["see https://h/x?a=1&X-Amz-Date=2&X-Amz-Sig=q&b=3 now", "https://h/x?X-Amz-Date=1"]) == ["see https://h/x?a=1&b=3 now", "https://h/x"]
    assert values(spark, text.cpe_products, [["cpe:2.3:a:ven:prod:1", "x"]], "array<string>") == [["ven/prod"]]
    assert values(spark, text.csv_cell, ['a"b', "a,b", None]) == ['"a""b"', '"a,b"', ""]


def test_urls(spark):
    cases = {
        "HTTPS://www.A.example/Path/?b=2&utm_source=x&a=Q#f": "a.example/path?a=Q&b=2", "http://a.example": "a.example", "a.example/x/": "a.example/x", "https://a.example/?fbclid=1": "a.example", "": None, "  ": None, None: None,
        "https://a.example/v.html?idxno=111": "a.example/v.html?idxno=111", "https://a.example/s?&web_view=true": "a.example/s", "https://a.example/s//#x": "a.example/s",
        "https://a.example/y.py?ref=main": "a.example/y.py?ref=main", "https://a.example/s?ref_src=t&referrer=f&msclkid=1&yclid=2&_ga=3&utm=4&utm_=5": "a.example/s?utm_=5",
        "https://a.example/x?TOKEN=AbC&ID=7": "a.example/x?id=7&token=AbC", "https://a.example/x?token=abc&b&a=1=2": "a.example/x?a=1=2&b&token=abc", "https://a.example/x?mc_eid=1&mc_2=2": "a.example/x?mc_2=2",
        "https://a.example/c?p_r_p_assetEntryId=12&_com_liferay_asset_X_redirect=https%3A%2F%2Fb": "a.example/c?p_r_p_assetentryid=12", "https://a.example/x?a=10&a=9": "a.example/x?a=10&a=9", "https://a.example/x?a-b=1&a=2": "a.example/x?a=2&a-b=1",
        "ftp://www.a.example/Z": "ftp://www.a.example/z", "https://a.example/x?edtsign=1&edtcode=2&scm=3&iref=4&dclid=5&spm=6&icid=7&_gl=8&s_cid=9&cmp=1&cmpid=2&igshid=3&gclid=4": "a.example/x",
    }
    assert values(spark, urls.normalize_url, list(cases)) == list(cases.values())


def test_rules(spark):
    table = [("(?i)alpha", "first"), ("beta", "second"), ("a", "third")]
    assert values(spark, lambda c: rules.first_match(c, table, "none"), ["beta ALPHA", "beta", "zzz", None]) == ["first", "second", "none", "none"]
    assert values(spark, lambda c: rules.all_matches(c, table), ["beta alpha", None]) == [["first", "second", "third"], []]
    assert values(spark, lambda c: rules.has_fragment(c, ["b-c"]), ["a/b_c", "ab-c", None]) == [True, False, False]
    assert values(spark, lambda c: rules.two_signals(c, ["alpha", "beta"], "gamma"), ["alpha beta", "alpha gamma", "alpha", "alphabet gamma"]) == [True, True, False, False]


def test_arrays(spark):
    df = spark.createDataFrame([(["b", None, "a"], ["c", "a"]), (None, []), (["x"], None)], "p array<string>, q array<string>")
    p, q = F.col("p"), F.col("q")
    got = df.select(arrays.sorted_union(p, q), arrays.overlap(p, q), arrays.disjoint(p, q), arrays.within(p, q), arrays.without(p, q), arrays.unanimous(p)).collect()
    assert [tuple(r) for r in got] == [(["a", "b", "c"], True, False, False, ["b"], None), ([], False, False, False, [], None), (["x"], False, False, False, ["x"], "x")]
    assert values(spark, arrays.by_number, [["C-10", "C-9", "C-9", None]], "array<string>") == [["C-9", "C-10"]]
    assert values(spark, lambda c: arrays.first_of_each(c, lambda x: F.lower(x)), [["A", "b", "a", "B"]], "array<string>") == [["A", "b"]]
    with pytest.raises(Exception, match="no new name"):
        values(spark, lambda c: arrays.renamed(c, {"a": "b"}, strict=True), [["q"]], "array<string>")


def test_dates(spark):
    assert values(spark, dates.precision, ["2024-01-02", "2024-01", "2024", "x", None]) == [3, 2, 1, 0, 0]
    df = spark.createDataFrame([("2024", "2024-05-01"), ("2024-05-01", "2023"), ("2099-01-01", "2020"), (None, "2020"), ("2024-01", "2099-01-01")], "a string, b string")
    assert [r[0] for r in df.select(dates.better_date(F.col("a"), F.col("b"), 2026)).collect()] == ["2024-05-01", "2024-05-01", "2020", "2020", "2024-01"]
    assert values(spark, dates.first_year, ["in 1999 or 2005", "x20201", "12345", None]) == [1999, None, None, None]


def test_cve_ids(spark):
    from quernstone.functions.identifiers import cve_ids

    df = spark.createDataFrame([([" cve-2024-1234", "CVE-2024-1234567890", "CVE-2024-123", "CVE-2024-1234", None],), (None,)], "x array<string>")
    assert [r[0] for r in df.select(cve_ids("x")).collect()] == [["CVE-2024-1234"], []]


def test_query_state():
    spec = QuerySpec(filters={"year": 2025, "severity": "High"}, has=["cve_ids"], text="a b&c", sort="title", page=3, size=100, standing_only=True)
    assert QuerySpec.from_url(spec.to_url()) == spec
    assert QuerySpec().to_url() == ""
    assert QuerySpec.from_url("?size=7&sort=odd&page=x&zzz=1") == QuerySpec()


def test_typed_filters(spark):
    df = spark.createDataFrame([(2026, "High", ["a"]), (None, None, None)], "year int, severity string, tags array<string>")
    count = lambda n, v: df.where(matches(df, n, v)).count()
    assert (count("year", 2026), count("year", "2026"), count("tags", "a"), count("severity", "High"), count("severity", 1)) == (1, 0, 1, 1, 0)
    assert count("year", True) == 0
    assert df.withColumns({"id": F.lit("1"), "title": F.lit("T"), "cve_ids": F.array(), "date": F.lit("2024")}).transform(lambda d: QuerySpec(page=9, size=50).paged(d)).count() == 2


def test_wilson_values(spark):
    df = spark.createDataFrame([(0.5, 10.0), (0.0, 10.0), (1.0, 10.0), (0.5, 0.0)], "p double, n double")
    got = [tuple(r) for r in df.select(*estimates.wilson(F.col("p"), F.col("n"))).collect()]
    assert [round(x, 4) for x in got[0]] == [0.2366, 0.7634] and got[1][0] == 0 and got[2][1] == pytest.approx(1) and got[3] == (None, None)


def test_unrepresented_strata_are_reported(spark):
    sample = spark.createDataFrame([("a", 1), ("a", 0), ("b", None)], "stratum string, y int")
    populations = spark.createDataFrame([("a", 10), ("b", 90)], "stratum string, size int")
    assert [r.stratum for r in estimates.unrepresented(sample, populations).collect()] == ["b"]
    assert estimates.stratified(sample, populations).first().population == 10


def test_uuid5(spark):
    names = ["pkg:npm/x", "", "日本"]
    assert values(spark, graphs.uuid5, names) == [str(uuid.uuid5(uuid.NAMESPACE_OID.__class__("6ba7b811-9dad-11d1-80b4-00c04fd430c8"), n)) for n in names]


def test_pause_states(spark):
    df = spark.createDataFrame([(None,), ("2026-05-01",), ("2026-01-01",), ("2027-05-01",), ("soon",)], "until string")
    assert [r[0] for r in df.select(health.pause_state("until", "2026-03-01")).collect()] == ["none", "active", "expired", "invalid", "invalid"]
