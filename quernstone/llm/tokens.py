"""Sizes of texts in tokens of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A vocabulary file of ranks; another one may be given by path.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer cuts text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _count(path: str):
    def run(batches):
        encode = encoder(path).encode_ordinary
        for batch in batches:
            sizes = pa.array([len(encode(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], names=[*batch.schema.names[:-1], "tokens"])

    return run


def token_counts(df: DataFrame, keep: list, text, path: str = VOCABULARY) -> DataFrame:
    """The kept columns and the whole text's size in tokens; null and empty texts have none."""
    rows = df.select(*keep, F.col(text).cast("string").alias("_text") if isinstance(text, str) else text.alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_count(path), f"{schema}, tokens int")
