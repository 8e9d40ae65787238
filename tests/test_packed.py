"""Packed fields: fixed cases, and a character-by-character splitter to hold random ones against."""

import random
import re

import pyarrow as pa
import pytest

from quernstone.functions.packed import split_packed
from quernstone.operators.packed_fields import explode_packed

CASES = {
    "'Ruleth, Inc.' / Hulusta Trainer / Ulmova (server; worker) / \"Lamelle, LLC\"": ["Ruleth, Inc.", "Hulusta Trainer", "Ulmova (server; worker)", "Lamelle, LLC"],
    '["Corolin \\"Queue\\" Studio", "b"]': ['Corolin "Queue" Studio', "b"],
    "One, and One": ["One", "One"],
    "pkg:npm/@a/b-c<br>d/e<BR />f": ["pkg:npm/@a/b-c", "d/e", "f"],
    '"Yarelle ""Profile"" Gateway" / x': ['Yarelle "Profile" Gateway', "x"],
    "- a b\n• c/d\r\n* e": ["a b", "c/d", "e"],
    "“A, B”, , \"C\";": ["A, B", "C"],
    "A、B；C": ["A", "B", "C"],
    "users' tool; it's": ["users' tool", "it's"],
    '5" disk, foo': ['5" disk', "foo"],
    "(a, b": ["(a", "b"],
    "“A and B; C”；'A and B; C'、'D, E'": ["A and B; C", "A and B; C", "D, E"],
    "a<br/>'B, C'<br>d's": ["a", "B, C", "d's"],
    "Sand and brand and x": ["Sand", "brand", "x"],
    "and": [],
    " , ; ": [],
    '" ", ""': [],
    "•x, •": ["x"],
    "": [],
}


@pytest.mark.parametrize("text", CASES)
def test_case(text):
    assert split_packed(pa.array([text])).to_pylist() == [CASES[text]]


def test_rows_do_not_mix():
    texts = [*CASES, None, '"open', "(open", "“open", "x" * 100_000 + ", y"]
    alone = [split_packed(pa.array([t], pa.string())).to_pylist()[0] for t in texts]
    assert split_packed(pa.array(texts, pa.string())).to_pylist() == alone
    sliced = pa.array(["zzz", *texts, "yyy"], pa.string()).slice(1, len(texts))
    assert split_packed(sliced).to_pylist() == alone


def plainly(text):
    """The same rules, one character after another; quotes and brackets come in pairs here."""
    out, now, i, quoted, depth = [], "", 0, False, 0
    while i < len(text):
        c = text[i]
        if c == '"':
            quoted = not quoted
        elif not quoted and c in "()":
            depth += 1 if c == "(" else -1
        free = not quoted and not depth
        word = re.match(r"and(?![^\s,;|\n])", text[i:])
        if free and (c in ",;|\n" or c == "/" and (i == 0 or text[i - 1] in " ,;|\n" or i + 1 == len(text) or text[i + 1] in " ,;|\n")):
            out.append(now)
            now = ""
        elif free and word and (i == 0 or text[i - 1] in " ,;|\n/" and (text[i - 1] != "/" or now == "")):
            out.append(now)
            now, i = "", i + 2
        else:
            now += c
        i += 1
    out.append(now)
    clean = []
    for v in out:
        v = v.strip(" ")
        if len(v) > 1 and re.fullmatch(r'"(?:[^"]|"")*"', v):
            v = v[1:-1].replace('""', '"').strip(" ")
        if v:
            clean.append(v)
    return clean


def test_against_plain_splitter():
    rng = random.Random(5)
    pieces = ["a", "b c", '"d, e"', '"f ""g"" h"', "(i; j)", "k/l", "m&n", "sandy", ", ", "; ", " / ", "|", "\n", " and ", ", and ", " "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    texts = [t for t in texts if not re.search(r'""|"\(|\)"|[a-z)]"[a-z(]|"[^,;|\n /]*[a-z]"[a-z]', t.replace('"f ""g"" h"', "Q")) and not re.search(r'["a-z)]"', t.replace('"d, e"', "'").replace('"f ""g"" h"', "'"))]
    got = split_packed(pa.array(texts)).to_pylist()
    wrong = [(t, g, plainly(t)) for t, g in zip(texts, got) if g != plainly(t)]
    assert len(texts) > 1000 and not wrong, wrong[:5]


def test_operator(spark):
    rows = [("x", "a, b", 1, "no"), ("x", "a, b", 1, "no"), ("x", "c", 0, "no"), (None, "d, e", 1, ""), ("y", None, 1, ""), ("z", "", 1, ""), ("w", "p; p", None, "")]
    df = spark.createDataFrame(rows, "id string, affected string, received int, pos string")
    got = sorted(map(tuple, explode_packed(df, "id", "affected", "received").collect()))
    assert got == [("w", 1, "p", 2), ("w", 2, "p", 2), ("x", 1, "a", 2), ("x", 2, "b", 2)]
    assert explode_packed(df.limit(0), "id", "affected", "received").count() == 0
