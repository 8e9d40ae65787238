"""Splitting packed string fields on the Arrow buffers themselves.

The bytes of a whole batch are classified at once.  Quote parity and bracket depth come from running
sums, separators from a mask, the values' offsets from the mask's edges; a list array over one new
value buffer is the result.  No loop runs over rows or characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The marks that separate, enclose or introduce values.
SEPARATORS = ",;|[]{}!?\n\r\t\v\f" + "、；，｜。！？·…  \u0085"
BLANKS = " " + " 　    "
LIST_MARKS = "-*+" + "•‣◦–—▪"
PAIRED_QUOTES = ("“”", "‘’", "«»", "„‟")
BRACKETS = ("()", "（）")

_QUOTE, _APOSTROPHE, _SLASH, _ESCAPE = (ord(x) for x in "\"'/\\")
_PLAIN, _REST = 0x80, 0x81  # first byte of another character; later bytes of any character


def _codes(data: np.ndarray) -> np.ndarray:
    """A code for each byte: ASCII as it is, known marks as their code point, _PLAIN or _REST otherwise."""
    codes = data.astype(np.int32)
    high = data >= 0x80
    if high.any():
        codes[high] = np.where((data[high] & 0xC0) == 0x80, _REST, _PLAIN)
        lead = np.flatnonzero(codes == _PLAIN)
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        for mark in {x for x in SEPARATORS + BLANKS + LIST_MARKS + "".join(PAIRED_QUOTES + BRACKETS) if ord(x) >= 0x80}:
            raw = mark.encode()
            hit = lead[np.logical_and.reduce([padded[lead + k] == raw[k] for k in range(len(raw))])]
            codes[hit] = ord(mark)
    return codes


def _spread(mask: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The mask carried from a character's first byte to its later ones."""
    if (codes == _REST).any():
        mask = mask.copy()
        for _ in range(3):
            mask[1:] |= mask[:-1] & (codes[1:] == _REST)
    return mask


def _depth(up: np.ndarray, down: np.ndarray, row: np.ndarray, starts: np.ndarray, most: int | None) -> np.ndarray:
    """Nesting depth after each byte; 0 throughout the rows whose marks don't match up."""
    step = up.astype(np.int32) - down.astype(np.int32)
    total = np.concatenate([[0], np.cumsum(step)])
    depth = total[1:] - total[starts[row]]
    bad = np.zeros(len(starts), bool)
    bad[row[(depth < 0) | (depth > most if most else False)]] = True
    ends = np.append(starts[1:], len(step))
    bad |= total[ends] != total[starts]
    return np.where(bad[row], 0, depth)


def split_packed(values: pa.Array) -> pa.ListArray:
    """One list of values for each string; null and empty strings give empty lists.

    Separators are the marks in SEPARATORS, line-break tags, the word "and", and "/" next to a blank.
    What stands in quotes or round brackets is not separated; a quote or bracket without its partner
    counts as an ordinary character.  Values are trimmed, lose a list mark and enclosing quotes, and
    doubled or escaped quotes inside enclosing ones are undone.  Empty values are dropped, equal ones kept.
    """
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.fill_null(values.cast(pa.string()), "")
    n = len(values)
    # A line end between the rows keeps neighbours apart.
    text = pc.binary_join_element_wise(values, pa.scalar("\n"), pa.scalar(""))
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    if not n or not len(data):
        return pa.array([[]] * n, pa.list_(pa.string()))
    row = np.repeat(np.arange(n), np.diff(offsets))
    codes = _codes(data)
    is_in = lambda marks: np.isin(codes, [ord(x) for x in marks])
    blank, separator = is_in(BLANKS), is_in(SEPARATORS)
    low = codes | 0x20
    pad = np.concatenate([low, np.zeros(8, np.int32)])
    tag = np.zeros(len(codes), bool)  # line-break tags
    i = np.flatnonzero(codes == ord("<"))
    i = i[(pad[i + 1] == ord("b")) & (pad[i + 2] == ord("r"))]
    for tail in (">", "/>", " >", " />"):
        raw = [ord(x) | 0x20 for x in tail]
        hit = i[np.logical_and.reduce([pad[i + 3 + k] == raw[k] for k in range(len(raw))])] if len(i) else i
        for k in range(3 + len(tail)):
            tag[hit + k] = True
    before = np.concatenate([[10], codes[:-1]])
    before[starts] = 10
    after = np.concatenate([codes[1:], [10]])
    gap = blank | separator | tag
    # A mark of several bytes is a gap up to its last one.
    gap_before = np.concatenate([[True], _spread(gap, codes)[:-1]]) | (before == 10)
    gap_after = np.concatenate([gap[1:], [True]])

    escaped = before == _ESCAPE
    quote = (codes == _QUOTE) & ~escaped
    odd = np.bincount(row, weights=quote, minlength=n).astype(np.int64) % 2 == 1
    if odd.any():  # the last quote of such a row has no partner
        at = np.flatnonzero(quote)
        last = np.zeros(n, np.int64)
        np.maximum.at(last, row[at], at)
        quote[last[odd]] = False
    total = np.concatenate([[0], np.cumsum(quote)])
    protected = ((total[1:] - total[starts[row]]) % 2 == 1) | quote
    for opening, closing in PAIRED_QUOTES:
        up, down = (codes == ord(opening)) & ~protected, (codes == ord(closing)) & ~protected
        if up.any():
            protected |= _depth(up, down, row, starts, 1) > 0
    mark = (codes == _APOSTROPHE) & ~protected & ~escaped
    if mark.any():
        opens = mark & (gap_before | np.isin(before, [ord("("), ord("（")])) & ~gap_after
        closes = mark & (gap_after | np.isin(after, [ord(")"), ord("）")])) & ~gap_before
        protected |= _depth(opens, closes, row, starts, 1) > 0
    for opening, closing in BRACKETS:
        up, down = (codes == ord(opening)) & ~protected, (codes == ord(closing)) & ~protected
        if up.any():
            protected |= _depth(up, down, row, starts, None) > 0

    end = np.append(starts[1:], len(data))[row] - 1  # each row's closing line end
    i = np.flatnonzero((codes == ord("/")) & ((gap_before) | (gap_after)))
    separator[i] = True
    i = np.flatnonzero((low == ord("a")) & gap_before)
    i = i[(pad[i + 1] == ord("n")) & (pad[i + 2] == ord("d")) & (i + 2 < end[i])]
    i = i[gap_after[i + 2] | np.isin(after[i + 2], [_QUOTE, ord("“")])]
    for k in range(3):
        separator[i + k] = True
    separator |= tag
    separator &= ~protected
    separator[end[starts]] = True  # the line end after each row, whatever its quotes
    separator = _spread(separator, codes)
    blank = _spread(blank, codes)

    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~separator
    edge = np.diff(inside)
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    solid = np.flatnonzero(~blank)
    begin, stop = _trim(begin, stop, solid)
    marks = is_in(LIST_MARKS)
    for _ in range(2):
        long = np.flatnonzero(marks[begin])
        if not len(long):
            break
        # The mark's width, then blanks.
        width = np.where(codes[begin[long]] < 0x80, 1, 3)
        nothing = begin[long] + width >= stop[long]
        followed = nothing | (width == 3) | blank[np.minimum(begin[long] + width, len(data) - 1)]
        begin[long[followed]] += width[followed]
        begin, stop = _trim(begin, np.maximum(stop, begin), solid)
        if not len(begin):
            break
    return _lists(data, row[begin] if len(begin) else begin, begin, stop, n)


def _trim(begin: np.ndarray, stop: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs without blanks at their ends; runs of blanks alone are dropped."""
    if not len(solid) or not len(begin):
        return begin[:0], stop[:0]
    first = np.searchsorted(solid, begin)
    last = np.searchsorted(solid, stop) - 1
    keep = first <= last
    return solid[first[keep]], solid[last[keep]] + 1


def _lists(data: np.ndarray, row: np.ndarray, begin: np.ndarray, stop: np.ndarray, n: int) -> pa.ListArray:
    """Gathers the runs into one value buffer under list offsets, then undoes quoting."""
    size = stop - begin
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], size) + np.repeat(begin, size)
    items = pa.StringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[at].tobytes()))
    items = unquote(items)
    keep = pc.greater(pc.binary_length(items), 0).to_numpy(zero_copy_only=False)
    counts = np.bincount(row[keep], minlength=n) if len(row) else np.zeros(n, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), items.filter(pa.array(keep)))


def unquote(items: pa.Array) -> pa.Array:
    """Values without enclosing quotes; doubled or escaped quotes inside are undone."""
    for opening, closing in ('""', "''", *PAIRED_QUOTES):
        inner = f"[^{opening}\\\\]" if opening == closing else f"[^{opening}{closing}\\\\]"
        enclosed = pc.match_substring_regex(items, rf"(?s)^{opening}(?:{inner}|{opening}{opening}|{closing}{closing}|\\.)*{closing}$")
        if opening == "'":  # apostrophes may stand inside
            enclosed = pc.match_substring_regex(items, r"(?s)^'.*'$")
        enclosed = pc.and_(enclosed, pc.greater(pc.utf8_length(items), 1))
        if not pc.any(enclosed).as_py():
            continue
        bare = pc.utf8_slice_codeunits(items, 1, -1)
        bare = pc.replace_substring(bare, opening * 2, opening)
        if closing != opening:
            bare = pc.replace_substring(bare, closing * 2, closing)
        bare = pc.replace_substring_regex(bare, r"\\(.)", r"\1")
        items = pc.if_else(enclosed, pc.utf8_trim_whitespace(bare), items)
    return items
