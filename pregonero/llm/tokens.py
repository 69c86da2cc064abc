"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: byte_bpe_50k: byte-level pair encoding with 50,256 tokens; 256 of them are the single bytes, so every text has a size.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def with_tokens(documents: DataFrame, text: str = "text", out: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """documents with the number of tokens of each whole text; null and empty texts have 0. The vocabulary file is read
    on the driver and sent to the workers once (its size is fixed), so executors need no copy of it."""
    with open(vocabulary, "rb") as f:
        lines = f.read()
    shared = documents.sparkSession.sparkContext.broadcast(lines)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in shared.value.splitlines() if x)}
        coder = tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int32")

    return documents.withColumn(out, count(F.col(text)))
