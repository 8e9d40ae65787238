"""Texts that stop before their author did, found by prefix self-joins at two levels.

*Texts.*  All texts are sorted, and a text is followed by those it is a strict prefix of.  If a longer one
goes on in the same line, the shorter one was cut; if all go on with a new line, it wasn't.

*Sentences.*  Whole texts that occur once cut and once in full are rare, but sentences are told again and
again.  Every sentence of the corpus is entered by hash under its first one to six words and under the
beginnings of its first word, with names and numbers as signs, counted by whether it runs on to a full stop
(``sentences``).  A text's unfinished last sentence is looked up under the words that are certainly whole.
If most sentences elsewhere of which they are a strict prefix run on to a full stop, it was cut; if they
usually end without one (headings, lists, notes, links), it is complete.

Marks put after the cut, signatures and notes of mail programs are taken off first.  Verdicts belong to
texts, so copies of a text share theirs and count as one piece of evidence.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions import textscan
from quernstone.llm import sentences
from quernstone.plans.lineage import Cut, cut

#: Other sentences with the same beginning that make it known.
EVIDENCE = 1
#: Share of full stops among other sentences with the same beginning from which an open one counts as cut.
RUNS_ON = 0.5
#: Words that an ending at the start of its line must share with sentences that run on.
LINE_WORDS = 2
#: An ending after a mark is a standing phrase from this many words, this share of all marked endings and so many different texts on.
STANDING_WORDS, STANDING_SHARE, STANDING_TEXTS = 3, 0.02, 3
#: Rows that a task sorts.
TASK_ROWS = 100_000
#: First characters by which endings at the border of two tasks meet their longer copies.
BORDER = 16
#: A length is a limit if this many texts of a source have it, and this many times as many as lengths near it.
LIMIT_TEXTS, LIMIT_TIMES, NEAR = 5, 8.0, 40

# Marks after a cut and closing notes.
MARKS = re.compile(r"(?:\s*(?:\[(?:\.{2,}|…|more|continued|truncated|cut|snip)\]|\((?:\.{2,}|…|more|continued|truncated)\)|\.{2,}|…|(?i:\b(?:read more|continue reading|view more))\s*[»›>]*))\s*$")
NOTES = re.compile(r"\n(?:-- ?\n[^\n]*(?:\n[^\n]*){0,3}|\[Message clipped\][^\n]*|\[(?i:message|text|mail)[^\]\n]*(?i:clipped|truncated|shortened)[^\]\n]*\][^\n]*)\s*$")
#: Longest mark, blanks before it not counted.
MARK_LENGTH = 40
FENCE = "```"


def _bare(text: str) -> tuple[str, str]:
    """The text without closing notes, and also without marks put after a cut."""
    body = text.rstrip()
    for _ in range(3):
        starts = {body.rfind("\n--"), body.rfind("\n[")} - {-1}
        at = next((s for s in starts if NOTES.match(body, s)), None)
        if at is None:
            break
        body = body[:at].rstrip()
    bare = body
    while bare and (bare[-1] in "])….»›>" or bare[-4:].lower() == "more" or bare[-7:].lower() == "reading"):
        # Blanks before a mark may be many, the mark itself has a known length at most.
        tail = len(bare[: max(0, len(bare) - MARK_LENGTH)].rstrip())
        shorter = bare[:tail] + MARKS.sub("", bare[tail:])
        if shorter == bare:
            break
        bare = shorter.rstrip()
    return body, bare


def _one_line_blocks(text: str) -> str:
    """Each code block as one sentence, which has a stop if the block was closed."""
    if FENCE not in text:
        return text
    parts = text.split(FENCE)
    out = [parts[0]]
    for i, part in enumerate(parts[1:], 1):
        if i % 2:
            out.append("\n" + " ".join(part.split()).replace(". ", " ") + (" .\n" if i + 1 < len(parts) else ""))
        else:
            out.append(part)
    return "".join(out)


def _content(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


_ENDS = "id {id}, source string, content bigint, bare string, open boolean, marked boolean, first boolean, alone boolean, words int, phrase bigint, tried array<bigint>, beginning bigint, stops bigint, opens bigint, inner bigint"
_NAMES = [f.split()[0] for f in _ENDS.split(", ")]


def _ends(texts: list[str], bare: bool = False):
    """(bare texts, marked, and of each text whether its end is open, starts its line, is its only sentence, its words,
    its phrase and the hashes under which to look it up, the longest first), chunk by chunk with the found sentences; ``bare`` texts are taken as they are."""
    both = [(t, t) if bare else _bare(t) for t in texts]
    for start, part in textscan.chunks([_one_line_blocks(b) for _, b in both]):
        n = len(part)
        is_open, first, alone, words, phrase, tried = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.int32), np.zeros(n, np.int64), [[] for _ in range(n)]
        found = sentences.scan(part)
        if found is not None:
            at = np.flatnonzero(found.last & ~found.closed)
            who = found.text[at]
            is_open[who], first[who], words[who], phrase[who] = True, found.first[at], found.words[at], found.phrase[at].view(np.int64)
            alone[who] = np.bincount(found.text, minlength=n)[who] == 1
            # The last word may be cut; a label before a colon says nothing by itself.
            whole = np.minimum(found.words[at] - 1, sentences.PREFIXES)
            for s, t, n_words in zip(at.tolist(), who.tolist(), whole.tolist()):
                least = max(1, min(int(found.label[s]) + 1, n_words))
                row = found.prefixes[s].view(np.int64)
                tried[t] = [int(row[p - 1]) for p in range(n_words, least - 1, -1)] if n_words > 0 else [int(found.part[s : s + 1].view(np.int64)[0])]
        yield [b for _, b in both[start : start + n]], [a != b for a, b in both[start : start + n]], is_open, first, alone, words, phrase, tried, found


def _scan(batches):
    """Rows of the texts' endings and, of each task, rows of sentence beginnings."""
    for batch in batches:
        kind = batch.schema.field(0).type
        for first_row in range(0, batch.num_rows, 2_000):
            part = batch.slice(first_row, 2_000)
            texts = [t or "" for t in part.column(2).to_pylist()]
            at = 0
            for bare, marked, is_open, first, alone, words, phrase, tried, found in _ends(texts):
                n = len(bare)
                content = [_content(t) for t in texts[at : at + n]]
                none = pa.nulls(n, pa.int64())
                columns = [part.column(0).slice(at, n), part.column(1).slice(at, n), pa.array(content, pa.int64()), pa.array(bare, pa.string()), pa.array(is_open), pa.array(marked), pa.array(first), pa.array(alone), pa.array(words), pa.array(phrase), pa.array(tried, pa.list_(pa.int64())), none, none, none, none]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
                if found is not None:
                    yield _beginning_rows(kind, *sentences.beginnings(found, np.ones(n)))
                at += n


def _beginning_rows(kind: pa.DataType, keys: np.ndarray, *counts: np.ndarray) -> pa.RecordBatch:
    n = len(keys)
    kinds = [kind, pa.string(), pa.int64(), pa.string(), *[pa.bool_()] * 4, pa.int32(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([*(pa.nulls(n, k) for k in kinds), _signed(keys), *map(pa.array, counts)], names=_NAMES)


def _spare(batches):
    """(beginning, stops, opens, inner) to take off: of bare texts that occur several times, all but one.  Rows in: text, times."""
    for batch in batches:
        texts, times = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        at = 0
        for bare, *_, found in _ends(texts, bare=True):
            if found is not None:
                keys, *counts = sentences.beginnings(found, 1.0 - times[at : at + len(bare)])
                yield pa.RecordBatch.from_arrays([_signed(keys), *map(pa.array, counts)], names=_NAMES[-4:])
            at += len(bare)


def goes_on(text: str, longer: str) -> tuple[bool, bool]:
    """How ``longer`` goes on after its prefix ``text``: in the same line, and with no blank between."""
    rest = longer[len(text) :]
    blank = rest[: len(rest) - len(rest.lstrip())]
    return "\n" not in blank, not blank


def _neighbours(batches):
    """Rows in: value and its hash, sorted.  Rows (hash, runs, direct, value): of each value that begins the
    next ones, how these go on; those that may begin values of the next task have their text too."""
    stack: list[list] = []  # value, hash, found, runs, direct
    out: list[tuple] = []

    def flush():
        rows = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.bool_(), pa.bool_(), pa.string()))]
        out.clear()
        return pa.RecordBatch.from_arrays(rows, names=["hash", "runs", "direct", "value"])

    for batch in batches:
        for value, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if stack and stack[-1][1] == key and stack[-1][0] == value:
                continue
            while stack and not value.startswith(stack[-1][0]):
                done = stack.pop()
                if done[2]:
                    out.append((done[1], done[3], done[4], None))
            for entry in stack:
                if not (entry[3] and entry[4]):
                    runs, direct = goes_on(entry[0], value)
                    entry[2:] = [True, entry[3] or runs, entry[4] or direct]
            stack.append([value, key, False, False, False])
        if out:
            yield flush()
    for value, key, found, runs, direct in stack:
        if found:
            out.append((key, runs, direct, None))
        out.append((key, None, None, value))
    if out:
        yield flush()


def longer_copies(values: DataFrame, width: int) -> DataFrame:
    """(hash, runs, direct): of each value that is a strict prefix of others, whether one of them goes on in the
    same line, and whether one does so without a blank.  ``values`` has value (not null), hash and a salt.

    The values are sorted over all tasks, equal ones spread by their salt, so that neither a common
    beginning nor a common value gathers in one task.
    """
    ordered = values.select("value", "hash", "salt").repartitionByRange(width, "value", "salt").sortWithinPartitions("value").select("value", "hash")
    seen = cut(ordered.mapInArrow(_neighbours, "hash bigint, runs boolean, direct boolean, value string"), "neighbours")
    inside = seen.where("value IS NULL").select("hash", "runs", "direct")
    # The last values of each task, at most as many as tasks and the prefixes that begin each other there.
    edges = seen.where("value IS NOT NULL").select(F.col("value").alias("edge"), F.col("hash").alias("edge_hash")).distinct()
    near = values.select("value")
    longer = F.col("value").startswith(F.col("edge")) & (F.length("value") > F.length("edge"))
    long = edges.where(F.length("edge") >= BORDER).join(near, F.substring("value", 1, BORDER).eqNullSafe(F.substring("edge", 1, BORDER)) & longer)
    short = edges.where((F.length("edge") < BORDER) & (F.length("edge") > 0)).join(near, F.substring("value", 1, 1).eqNullSafe(F.substring("edge", 1, 1)) & longer)
    blank = F.regexp_extract(F.substr(F.col("value"), F.length("edge") + 1), r"(?U)^\s*", 0)
    across = long.unionByName(short).select(F.col("edge_hash").alias("hash"), (~F.contains(blank, F.lit("\n"))).alias("runs"), (blank == "").alias("direct"))
    return inside.unionByName(across).groupBy("hash").agg(F.max("runs").alias("runs"), F.max("direct").alias("direct"))


def _sentence_evidence(endings: DataFrame, beginnings: DataFrame) -> DataFrame:
    """(content, runs_on, usual_end): whether other sentences that begin like a text's open end usually run on, or end so.

    Of the beginnings tried, the longest that other sentences have decides.  An ending that starts its line
    must share LINE_WORDS words at least.
    """
    tried = endings.select("content", "first", "words", F.posexplode("tried").alias("place", "beginning"))
    # An ending within its line is set against such sentences only.  The text's own is among those counted.
    opens = F.when(F.col("first"), F.col("opens")).otherwise(F.col("inner")) - 1
    known = tried.join(beginnings, "beginning").withColumn("opens", opens).where(F.col("stops") + F.col("opens") >= EVIDENCE)
    # The longest one tried has this many words.
    most = F.least(F.col("words") - 1, F.lit(sentences.PREFIXES))
    best = known.groupBy("content").agg(F.min_by(F.struct("stops", "opens", "first", (most - F.col("place")).alias("length")), "place").alias("e"))
    runs_on = (F.col("e.stops") > RUNS_ON * (F.col("e.stops") + F.col("e.opens"))) & (~F.col("e.first") | (F.col("e.length") >= LINE_WORDS))
    usual_end = F.col("e.stops") <= RUNS_ON * (F.col("e.stops") + F.col("e.opens"))
    return best.select("content", runs_on.alias("runs_on"), usual_end.alias("usual_end"))


def truncated_texts(df: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """(id, source, truncated, why): every text with a verdict.

    ``why`` is copy or sentence for a truncated text, by the kind of longer value that it is a prefix of, else
    null.  Null and empty texts are complete; a null source is a source of its own; repeated rows each get
    their verdict; other columns are ignored, whatever their names.  Texts of any length are read in full.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scanned = Cut(rows.mapInArrow(_scan, _ENDS.format(id=kind)), "endings").read()
    ends = scanned.where("content IS NOT NULL")

    # A text that occurs several times is evidence once: its other copies' sentences are taken off again.
    hashed = ends.where("bare <> ''").select(F.col("bare").alias("text"), F.xxhash64("bare").alias("hash"))
    repeated = cut(hashed.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1"), "repeated")
    once = hashed.join(repeated.select("hash"), "hash", "left_semi").groupBy("hash").agg(F.any_value("text").alias("text"), F.count("*").alias("times"))
    spare = once.select("text", "times").mapInArrow(_spare, "beginning bigint, stops bigint, opens bigint, inner bigint")
    counted = scanned.where("beginning IS NOT NULL").select(*_NAMES[-4:]).unionByName(spare)
    beginnings = counted.groupBy("beginning").agg(*(F.sum(c).alias(c) for c in _NAMES[-3:]))

    endings = ends.where("open").select("content", "marked", "first", "words", "phrase", "tried").dropDuplicates(["content"])
    evidence = _sentence_evidence(endings, beginnings)

    marked = ends.where("open AND marked").where(F.col("words") >= STANDING_WORDS).select("phrase", "content").distinct()
    share = STANDING_SHARE * marked.agg(F.count("*")).scalar()
    standing = marked.groupBy("phrase").count().where((F.col("count") >= STANDING_TEXTS) & (F.col("count") >= share)).select("phrase", F.lit(True).alias("standing"))

    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(ends.count() / TASK_ROWS))
    values = ends.where("bare <> ''").select(F.col("bare").alias("value"), F.xxhash64("bare").alias("hash"), F.xxhash64("id").alias("salt"))
    copies = longer_copies(values, width)

    # Hashes only: one row for each different text that has a longer copy or an open end.
    # A text in a script without blanks is complete at its stop, though others go on at once.
    may_go_on = ~F.col("bare").rlike(f"[{sentences.WIDE_STOPS}][{sentences.WIDE_CLOSERS}]*$")
    of_text = ends.select("content", F.xxhash64("bare").alias("hash"), may_go_on.alias("may_go_on"), "open", "alone", "marked", "phrase").dropDuplicates(["content"])
    judged = of_text.join(copies, "hash", "left").join(evidence, "content", "left").join(standing, "phrase", "left")
    # A title of a usual kind is complete, though a sentence somewhere begins with the same words.
    title = F.col("alone") & F.coalesce("usual_end", F.lit(False))
    why = (
        F.when(F.when(F.col("open"), F.col("runs") & ~title).otherwise(F.col("direct") & F.col("may_go_on")), "copy")
        .when(~F.col("open") | F.col("runs").isNotNull(), F.lit(None))
        .when(F.col("standing") & F.col("marked"), F.lit(None))
        .when(F.col("runs_on"), "sentence")
    )
    verdicts = judged.select("content", why.alias("why")).where("why IS NOT NULL")
    return ends.select("id", "source", "content").join(verdicts, "content", "left").select("id", "source", F.col("why").isNotNull().alias("truncated"), "why")


def truncation_rates(verdicts: DataFrame) -> DataFrame:
    """(source, texts, truncated, rate): how often each source truncates."""
    return verdicts.groupBy("source").agg(F.count("*").alias("texts"), F.count_if("truncated").alias("truncated")).withColumn("rate", F.col("truncated") / F.col("texts"))


def length_limits(df: DataFrame, text_column: str, source_column: str) -> DataFrame:
    """(source, unit, size, texts, usual): lengths in characters or bytes at which a source's texts pile up.

    ``usual`` is the mean number of texts at the lengths near it.  Such a length hints at a field limit, but
    complete texts of one pattern pile up too, so it is no verdict on a text.  Copies of a text count once.
    """
    text = F.col(text_column).cast("string")
    units = F.array(F.struct(F.lit("characters").alias("unit"), F.length(text).alias("size")), F.struct(F.lit("bytes").alias("unit"), F.octet_length(text).alias("size")))
    rows = df.where(text != "").select(F.col(source_column).cast("string").alias("source"), F.xxhash64(text).alias("hash"), F.explode(units).alias("u")).select("source", "hash", "u.*").distinct()
    per = rows.groupBy("source", "unit", "size").agg(F.count("*").alias("texts")).withColumn("bin", F.expr(f"size div {NEAR}"))
    bins = per.select("source", "unit", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"), "texts").groupBy("source", "unit", "bin").agg(F.sum("texts").alias("around"))
    spikes = per.where(F.col("texts") >= LIMIT_TEXTS).alias("p").join(bins.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")) & (F.col("p.unit") == F.col("b.unit")) & (F.col("p.bin") == F.col("b.bin")))
    usual = (F.col("around") - F.col("texts")) / (3 * NEAR - 1)
    return spikes.select("p.source", "p.unit", "size", "texts", usual.alias("usual")).where(F.col("texts") >= LIMIT_TIMES * F.col("usual") + 1)
