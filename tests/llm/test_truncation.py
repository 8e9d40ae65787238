"""Truncation: the sentence scan against a plain one, the prefix join against all pairs, verdicts on planted cuts."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm import sentences
from quernstone.llm.truncation import _bare, _ends, goes_on, length_limits, longer_copies, truncated_texts, truncation_rates

SCHEMA = "doc_id bigint, text string, source string, key string, open string"


def ending(text):
    """(open, marked, starts its line, words)"""
    for bare, marked, is_open, first, _, words, *_ in _ends([text]):
        return bool(is_open[0]), bool(marked[0]), bool(first[0]), int(words[0])


@pytest.mark.parametrize("text, is_open, marked", [
    ("A full sentence. Another one.", False, False), ("A full sentence. Another o", True, False), ("It went on [...]", True, True), ("It went on (more)", True, True), ("It went…", True, True), ("It went..", True, True), ("It went" + " " * 300 + "[...]  ", True, True),
    ("Cut he\n-- \nSent by the digest", True, False), ("Done.\n\n-- \nDesk, Town", False, False), ("Cut he\n\n[Message clipped] View it", True, False), ("", False, False), ("   ", False, False), ("終わり。", False, False), ("終わり。まだ続", True, False),
    ("Text.\n```\ncode(a\n```", False, False), ("Text.\n```\ncode(a", True, False), ("He said \"no.\"", False, False), ("(See it.)", False, False), ("As follows:", False, False),
])
def test_endings(text, is_open, marked):
    assert ending(text)[:2] == (is_open, marked)


def test_marks_and_notes():
    assert _bare("It went on [...] (more) ...\n") == ("It went on [...] (more) ...", "It went on")
    assert _bare("a\n\n-- \nDesk\n[Message clipped] x")[1] == "a"
    assert _bare("x" * 100 + " " * 5000 + "Read more »")[1] == "x" * 100


STOP = re.compile(r"(?:[.!?][\"'”’»)\]]*(?=\s)|[。！？][」』”）]*)")
CLOSED = re.compile(r"[.!?。！？:][\"'”’»)\]」』）*_`]*$")


def plain_sentences(text):
    """(closed, starts its line, first word's letters) of each sentence, by regular expressions."""
    for line in sentences.SPEAKER.sub(lambda m: " " * len(m.group()), text).split("\n"):
        line, at = line.strip(), 0
        parts = []
        for m in STOP.finditer(line):
            if m.end() < len(line):
                parts.append((line[at : m.end()].strip(), True, at == 0))
                at = m.end()
        rest = line[at:].strip()
        if rest:
            parts.append((rest, bool(CLOSED.search(rest)), at == 0))
        yield from ((closed, first) for _, closed, first in parts)


def test_scan_against_a_plain_one():
    rng = random.Random(5)
    pieces = ["A word", "and 1.2.3", "ends. ", "Stop.\n", "「引用。」", "終わり。", "why? ", "\n", "\n\n- ", "# ", "note 3: ", "e.g. x", "\"so.\" ", "it’s", " (yes.) ", "...", "a.b ", "!", ":\n", "*end.*\n", "  ", "\t", "Ünï", "path/to_it ", "x"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(3000)] + ["", "\n", "   "]
    found = sentences.scan(texts)
    got = {}
    for t, closed, first in zip(found.text.tolist(), found.closed.tolist(), found.first.tolist()):
        got.setdefault(t, []).append((closed, first))
    for i, text in enumerate(texts):
        assert got.get(i, []) == list(plain_sentences(text)), text
    assert (np.diff(found.text) >= 0).all() and found.last.sum() == len(got)


def test_names_and_numbers_are_signs():
    same = sentences.scan(["The Velanthe Orrin group met 12 times at x_y.", "The Sovabar group met 7/8 times at load_it."])
    assert (same.prefixes[0] == same.prefixes[1]).all() and same.words[0] == same.words[1] and same.phrase[0] == same.phrase[1]
    other = sentences.scan(["The group met.", "Then groups met."])
    assert other.prefixes[0, 0] != other.prefixes[1, 0]
    one, two, three = (sentences.scan([t]) for t in ("note", "notes on it", "noteworthy"))
    assert one.part[0] in two.parts and one.part[0] in three.parts and three.part[0] not in two.parts


@pytest.mark.parametrize("width", [1, 9])
def test_longer_copies_against_all_pairs(spark, width):
    rng = random.Random(width)
    texts = {"".join(rng.choices(["ab", "a", "\n", " ", "b. "], k=rng.randint(1, 7))).rstrip() for _ in range(500)} - {""}
    texts |= {"a long beginning of its own" + x for x in ("", " x", "\ny", "z")}
    rows = [(t, k) for t in texts for k in range(rng.choice([1, 1, 3]))]
    df = spark.createDataFrame(rows, "value string, k int").withColumn("hash", F.xxhash64("value")).withColumn("salt", F.xxhash64("value", "k"))
    hashes = {r.value: r.hash for r in df.collect()}
    got = {r.hash: (r.runs, r.direct) for r in longer_copies(df, width).collect()}
    want = {}
    for t in texts:
        on = [goes_on(t, u) for u in texts if u != t and u.startswith(t)]
        if on:
            want[hashes[t]] = (any(r for r, _ in on), any(d for _, d in on))
    assert len(want) > 50 and got == want


def corpus():
    rows, n = [], 0
    kinds = ["The parser keeps reading past {} entries when the header is missing.", "A working proof shows how a guest can read {} records of other tenants.", "Nobody had checked the output by hand for {} weeks before that day."]
    def add(text, source, cut):
        nonlocal n
        n += 1
        rows.append((n, text, source, cut))
    for i in range(60):
        whole = "\n".join(k.format(i * 7 + j) for j, k in enumerate(kinds))
        add(whole, "full", False)
        add(whole + f"\n- bump queue to 1.{i}\n- closes AB-{i}", "full", False)
        add(f"Widget {i} allows path traversal", "full", False)
        add(f"ok from my side, CT-{i} can be closed", "full", False)
        add(whole + "\n\nMore to follow...", "press", False)
    for i in range(20):
        whole = " ".join(k.format(1000 + i * 7 + j) for j, k in enumerate(kinds))
        head = whole[: 100 + 3 * i]
        add(head, "cutter", not head.rstrip().endswith("."))
        add(whole[: whole.rfind(" ", 0, 85 + 5 * i)] + " [...]", "press", True)
    for i in range(12):
        text = (f"Case {i}: " + " ".join(k.format(5000 + i + j) for j, k in enumerate(kinds * 3)))[:300]
        add(text, "limit", not text.endswith("."))
        add(f"Notes of {i}.\n```\nload(a={i})\nstore(b={i})\n```", "full", False)
        add(f"Notes of {i}.\n```\nload(a={i})\nsto", "cutter", True)
    return rows


def verdicts(spark, rows):
    df = spark.createDataFrame([(i, t, s, "x", "x") for i, t, s, *_ in rows], SCHEMA)
    return truncated_texts(df, "doc_id", "text", "source")


def test_cut_texts_are_found(spark):
    rows = corpus()
    out = verdicts(spark, rows)
    got = {r.id: (r.truncated, r.why) for r in out.collect()}
    wrong = [(r, got[r[0]]) for r in rows if got[r[0]][0] != r[3]]
    assert len(got) == len(rows) and len(wrong) <= 2, wrong
    # Every verdict rests on a longer value elsewhere.
    assert {why for cut, why in got.values() if cut} <= {"copy", "sentence"}
    rates = {r.source: r.rate for r in truncation_rates(out).collect()}
    assert rates["full"] == 0 and rates["cutter"] > 0.8


def test_longer_copy_proves_a_cut(spark):
    long = "Unseen beginnings of a kind that no other text in this table shares, with a long way to go before it stops at last."
    rows = [
        (1, long[:80], "s"), (2, long, "s"), (3, "A note that ends its first line here without any stop, and is long enough\nand goes on", "s"), (4, "A note that ends its first line here without any stop, and is long enough", "s"),
        (5, "Brief cu", "s"), (6, "Brief cuts count.", "s"), (7, "Mended in version 7.", "s"), (8, "Mended in version 7.2 at last.", "s"), (9, "修正済み。", "s"), (10, "修正済み。次の版で公開。", "s"), (11, long[:80] + " [...]", "s"),
    ]
    got = {r.id: (r.truncated, r.why) for r in verdicts(spark, rows).collect()}
    assert {i for i, (cut, why) in got.items() if cut and why == "copy"} == {1, 5, 7, 11}
    assert not any(got[i][0] for i in (2, 3, 4, 6, 8, 9, 10))


def test_long_values_are_read_in_full(spark):
    # An unfinished sentence of 60,000 characters, and a beginning far longer than any fixed one.
    filler = " ".join(f"w{i}" for i in range(12_000))
    rows = [(1, f"Every relay forwards {filler} without loo", "s"), (2, "Every relay forwards nine frames.", "s"), (3, f"Every relay forwards {filler} without looking.", "s")]
    rows += [(4, f"Own start {filler} and", "s"), (5, f"Own start {filler} and so on.", "s")]
    got = {r.id: (r.truncated, r.why) for r in verdicts(spark, rows).collect()}
    assert got[1] == got[4] == (True, "copy") and not any(got[i][0] for i in (2, 3, 5))


def test_defined_cases(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "x", None), (4, "Done.", None), (4, "Done.", None), (None, "Done.", "s"), (5, "a " * 200_000, "s"), (6, "...", "s"), (7, "```\ncode", "s"), (8, "[...]", "s"), (9, "\n\n", "s")]
    out = verdicts(spark, rows).collect()
    assert len(out) == len(rows) and not [r.id for r in out if r.truncated]
    assert verdicts(spark, rows).limit(0).count() == 0
    assert truncated_texts(spark.createDataFrame([], SCHEMA), "doc_id", "text", "source").count() == 0
    assert truncation_rates(truncated_texts(spark.createDataFrame([], SCHEMA), "doc_id", "text", "source")).count() == 0


def test_length_limits(spark):
    rows = [(i, f"{i:03} " + "é" * 56, "short") for i in range(30)] + [(100 + i, "x" * i, "long") for i in range(1, 120)] + [(900, None, "short"), (901, "", None)]
    rows += [(300 + i, f"{0:03} " + "é" * 77, "copies") for i in range(30)]
    got = [tuple(r)[:4] for r in length_limits(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA), "text", "source").collect()]
    assert sorted(got) == [("short", "bytes", 116, 30), ("short", "characters", 60, 30)]


def test_copies_do_not_make_a_standing_phrase(spark):
    rows = corpus()
    cut = "The parser keeps reading past 9 entries when the header is missing. Nobody had checked the [...]"
    copies = [(10_000 + i, cut, "board", True) for i in range(12)]
    # Three texts end in a phrase that stands after a mark elsewhere too; a longer copy still proves a cut.
    start = "A long beginning of its own kind that brings together both of these two texts, number {}, and then"
    proven = [(20_000 + i, start.format(i) + "\nmore to follow on that [...]", "wire", True) for i in range(3)]
    longer = [(30_000 + i, start.format(i) + "\nmore to follow on that other page when it is ready.", "wire", False) for i in range(3)]
    got = {r.id: (r.truncated, r.why) for r in verdicts(spark, rows + copies + proven + longer).collect()}
    assert {got[i] for i, *_ in copies} == {(True, "sentence")}
    assert {got[i] for i, *_ in proven} == {(True, "copy")} and not any(got[i][0] for i, *_ in longer)
    assert not any(got[i][0] for i, text, *_ in rows if text.endswith("More to follow..."))


def test_copies_of_a_cut_text_are_no_evidence(spark):
    whole = [(i, f"Every relay forwards {i} frames without looking into them.", "full") for i in range(4)]
    cut = [(100 + i, "Every relay forwards 7 frames without loo", "board") for i in range(12)]
    pair = [(200 + i, f"Older bridges drop {i} packets when the table is full.", "full") for i in range(2)] + [(300 + i, "Older bridges drop 9 packets when the ta", "board") for i in range(2)]
    # As many different headings that begin alike stay what they are.
    heads = [(400 + i, f"Plain switches with {i} ports", "full") for i in range(12)] + [(500, "Plain switches with 7 ports are cheap.", "full")]
    got = {r.id: r.truncated for r in verdicts(spark, whole + cut + pair + heads).collect()}
    assert all(got[i] for i, text, _ in cut + pair if not text.endswith(".")) and not any(got[i] for i, *_ in whole + heads)
