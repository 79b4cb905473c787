"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import importlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which byte-level BPE of 50k parts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def tokenizer(path: str):
    """The tokenizer of a file of ranks; loaded once in each Python worker."""
    tiktoken = importlib.import_module("tiktoken")
    with Path(path).open("rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(name: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(SparkFiles.get(name)).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], [*batch.schema.names[:-1], "n_tokens"])

    return count


def with_token_counts(df: DataFrame, keys: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """keys and n_tokens: the size of the whole text; null and empty texts have none.

    path: the file of ranks as the driver sees it; it is sent to the executors once.
    """
    df.sparkSession.sparkContext.addFile(path)
    kept = df.select(*keys, F.col(text).alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), "n_tokens long"])
    return kept.mapInArrow(_count(Path(path).name), schema)
