"""Sentences of a batch of texts and their beginnings, on code-point arrays.

A batch is laid out as one array of code points.  Masks find lines, sentence ends and words; names and
numbers become signs; every sentence gets a hash for each of its first words taken together, and one for
each beginning of its first word.  No loop runs over characters, words or sentences.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

from quernstone.functions import textscan

#: Numbers of leading words under which a sentence is entered.
PREFIXES = 6
_NAME, _NUMBER = np.uint64(0x51ED270B), np.uint64(0x2545F491)
_PART = np.uint64(0x9E3779B97F4A7C15)
PUNCTUATION, WORD, IDEOGRAPH, SPACE, LINE = range(5)

# Sentence ends, what may close a quotation after them, joints inside words, marks of list items,
# headings and speakers at the start of a line.
STOPS, WIDE_STOPS = ".!?", "。！？"
CLOSERS, WIDE_CLOSERS = "\"'”’»)]", "」』”）"
LAST_CLOSERS = "\"'”’»)]」』）*_`"
JOINTS = "./'’_-"
SPEAKER = re.compile(r"^[ \t]*(?:#+ |Subject: |[-*•] |\[[0-9]+\] |[a-z]+ ?[0-9]*[>:] )", re.M)

_tables: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    if not _tables:
        points = [chr(i) for i in range(0x110000)]
        kind = np.zeros(0x110000, np.uint8)
        kind[textscan.word_table()] = WORD
        kind[ord("_")] = WORD
        kind[0x3040:0x3100] = kind[0x4E00:0xA000] = IDEOGRAPH
        kind[[i for i, c in enumerate(points) if c.isspace()]] = SPACE
        kind[10] = LINE
        _tables["kind"] = kind
        _tables["upper"] = np.fromiter((c.isupper() for c in points), bool, len(points))
        _tables["lower"] = np.fromiter((ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(points)), np.uint32, len(points))
        for key, chars in (("stop", STOPS), ("wide stop", WIDE_STOPS), ("end", STOPS + WIDE_STOPS + ":"), ("closer", CLOSERS), ("wide closer", WIDE_CLOSERS), ("last closer", LAST_CLOSERS), ("joint", JOINTS), ("code", "0123456789_/")):
            _tables[key] = np.zeros(0x110000, bool)
            _tables[key][[ord(c) for c in chars]] = True
    return _tables[name]


@dataclass
class Sentences:
    """One entry per sentence, in order; ``prefixes`` has a column for each number of words, 0 where there are fewer."""

    text: np.ndarray
    closed: np.ndarray
    first: np.ndarray
    last: np.ndarray
    words: np.ndarray
    prefixes: np.ndarray
    label: np.ndarray
    phrase: np.ndarray
    part: np.ndarray
    part_of: np.ndarray
    parts: np.ndarray


def _behind(member: np.ndarray, apart: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Whether, going back from each character over members without a gap, one arrives at a hit."""
    at = np.maximum.accumulate(np.where(member, -1, np.arange(len(member))))
    return (at >= 0) & hit[at] & (apart == apart[at])


def scan(texts: list[str]) -> Sentences | None:
    """The sentences of all texts of a chunk; None if there are none.

    A sentence ends at a full stop before a blank, at a wide full stop, or with its line; ``closed`` tells
    whether it ends in a stop, ``first`` whether it starts its line, ``last`` whether it ends its text.
    ``words`` counts words, punctuation marks and ideographs, runs of names or of numbers once; ``label`` is
    the place after the first colon among the first words; ``part`` hashes the first word, ``parts`` all its
    beginnings (of sentence ``part_of``); ``phrase`` hashes the whole sentence.
    """
    codes, starts = textscan.code_points(texts)
    kind = _table("kind")[codes]
    skipped = [m.span() for m in SPEAKER.finditer("\n".join(texts))]
    if skipped:
        edge = np.zeros(len(codes) + 1, np.int32)
        span = np.array(skipped)
        np.add.at(edge, span[:, 0], 1)
        np.add.at(edge, span[:, 1], -1)
        kind = np.where((np.cumsum(edge[:-1]) > 0) & (kind != LINE), SPACE, kind)
    joint = np.zeros(len(codes), bool)
    joint[1:-1] = _table("joint")[codes[1:-1]] & (kind[:-2] == WORD) & (kind[2:] == WORD)
    kind = np.where(joint, WORD, kind)
    at = np.flatnonzero(kind < SPACE)
    if not len(at):
        return None
    line = np.cumsum(kind == LINE)[at]
    code, kind = codes[at], kind[at]
    new_line = np.ones(len(at), bool)
    new_line[1:] = line[1:] != line[:-1]
    gap = new_line.copy()
    gap[1:] |= at[1:] > at[:-1] + 1
    apart = np.cumsum(gap)
    line_end, gap_after = np.append(new_line[1:], True), np.append(gap[1:], True)
    narrow = gap_after & _behind(_table("closer")[code], apart, _table("stop")[code])
    closer_next = np.append(_table("wide closer")[code[1:]] & ~gap[1:], False)
    wide = ~closer_next & _behind(_table("wide closer")[code], apart, _table("wide stop")[code])
    inner = ~line_end & (narrow | wide)
    end = line_end | inner
    closes = np.where(line_end, _behind(_table("last closer")[code], apart, _table("end")[code]), True)
    starts_sentence = np.append(True, end[:-1])
    sentence = np.cumsum(starts_sentence) - 1
    opening, ending = np.flatnonzero(starts_sentence), np.flatnonzero(end)
    text = np.searchsorted(starts, at[opening], side="right") - 1
    last = np.append(text[1:] != text[:-1], True)

    word = (kind == WORD) & ~gap
    begin = np.ones(len(at), bool)
    begin[1:] = ~(word[1:] & (kind[:-1] == WORD)) | starts_sentence[1:]
    token = np.flatnonzero(begin)
    stop = np.append(token[1:], len(at))
    of = sentence[token]
    opens = np.append(True, of[1:] != of[:-1])
    coded = np.append(0, np.cumsum(_table("code")[code]))
    coded = coded[stop] > coded[token]
    upper = _table("upper")[code[token]]
    follows = np.append(upper[1:] & ~opens[1:], False)
    # A sentence's first word has a capital anyway: it is a name if it is longer than an article and another follows.
    name = ~coded & upper & (stop - token > 1) & (~opens | ((stop - token > 3) & follows))
    lower = _table("lower")[codes]
    value = textscan.run_hashes(lower, at[token], at[stop - 1] + 1)
    value = np.where(coded, _NUMBER, np.where(name, _NAME, value))
    keep = np.ones(len(token), bool)
    keep[1:] = ~((value[1:] == value[:-1]) & (coded[1:] | name[1:]) & ~opens[1:])
    first_token = token[opens]
    first_stop = stop[opens]
    value, of, is_colon = value[keep], of[keep], (code[token] == ord(":"))[keep]
    words = np.bincount(of, minlength=len(opening))
    place = np.arange(len(of)) - np.repeat(np.cumsum(words) - words, words)
    prefixes = np.zeros((len(opening), PREFIXES), np.uint64)
    for p in range(PREFIXES):
        here = place == p
        before = prefixes[of[here], p - 1] if p else np.uint64(0)
        prefixes[of[here], p] = textscan.mix64(textscan.mix64(value[here]) + before)
    label = np.zeros(len(opening), np.int64)
    colon = np.flatnonzero(is_colon & (place < PREFIXES))
    labelled, where = np.unique(of[colon], return_index=True)
    label[labelled] = place[colon[where]] + 1
    whole = textscan.mix64(value + place.astype(np.uint64) * _PART)
    phrase = np.add.reduceat(whole, np.cumsum(words) - words)
    length = first_stop - first_token
    part_of = np.repeat(np.arange(len(opening)), length)
    ends = at[first_token][part_of] + 1 + np.arange(len(part_of)) - np.repeat(np.cumsum(length) - length, length)
    parts = textscan.mix64(textscan.run_hashes(lower, at[first_token][part_of], ends) + _PART)
    return Sentences(text, closes[ending], new_line[opening], last, words, prefixes, label, phrase, parts[np.cumsum(length) - 1], part_of, parts)


def beginnings(found: Sentences, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each beginning, and how many sentences with it are closed, open, and open within their line;
    ``weights`` for each text."""
    have = found.prefixes != 0
    keys = np.concatenate([found.prefixes[have], found.parts])
    of = np.concatenate([np.nonzero(have)[0], found.part_of])
    weight = weights[found.text[of]]
    keys, back = np.unique(keys, return_inverse=True)
    closed, inner = found.closed[of], ~found.first[of]
    count = lambda which: np.bincount(back[which], weight[which], len(keys)).astype(np.int64)
    return keys, count(closed), count(~closed), count(~closed & inner)
