"""Sizes of texts in tokens of a public tokenizer, and pieces of texts by tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the tokenizers' files; each executor has it at the same place.
TOKENIZERS = "/opt/tokenizers"
#: Vocabulary used unless another is named: ranks of a byte-level BPE.
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that parts text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str):
    """Encoding of the vocabulary file at ``path``; special tokens' strings in a text are ordinary text."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, text: str, out: str = "n_tokens", path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """Add ``out`` INT: tokens of ``text``; 0 for an empty text, null for null. Texts are read whole."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for batch in batches:
            yield pd.Series([None if t is None else len(enc.encode_ordinary(t)) for t in batch], dtype="Int32")

    return df.withColumn(out, count(F.col(text)))
