"""Sizes in tokens of a public tokenizer, whose files stay where they are."""

from __future__ import annotations

import base64
import importlib.util
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the tokenizer files on every executor, and the vocabulary used.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_multi_50k.tiktoken"
#: Longer unbroken runs are encoded in pieces: merging is quadratic in a run.
PIECE = 100_000


def load(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """The encoding of a rank file and the split pattern that is published with it."""
    import tiktoken

    spec = importlib.util.spec_from_file_location("_public_tokenizers", Path(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    lines = Path(folder, vocabulary).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
    return tiktoken.Encoding("own", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of the whole text; null and "" have none."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = load(folder, vocabulary)
        for texts in batches:
            yield pd.Series([
                sum(len(encoding.encode_ordinary(t[i : i + PIECE])) for i in range(0, len(t), PIECE)) if t else 0 for t in texts
            ], dtype="int64")

    return count(text.cast("string"))
