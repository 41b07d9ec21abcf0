"""Sizes of texts in tokens of a public tokenizer, and the documents table in canonical form."""

from __future__ import annotations

import base64
import os
import sys
import types

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files are; a parameter of every operator that counts tokens.
VOCABULARY = os.environ.get("PAGEATLAS_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the split pattern of that byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _encoder(path: str):
    """One encoder per worker process and file."""
    kept = sys.modules.setdefault("_pageatlas_worker", types.ModuleType("_pageatlas_worker"))
    encoders = kept.__dict__.setdefault("encoders", {})
    if path not in encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoders[path] = tiktoken.Encoding("pageatlas", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoders[path]


def token_count(column: Column, vocabulary: str = VOCABULARY, piece: int = 100_000) -> Column:
    """Tokens of a text; null has none. Very long texts are counted in pieces cut at blanks, so that no
    text is held twice; where a stretch has no blank it is cut at ``piece`` characters."""

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        enc = _encoder(vocabulary)

        def size(t: str | None) -> int:
            if not t:
                return 0
            n, at = 0, 0
            while len(t) - at > piece:
                cut = t.rfind(" ", at + piece // 2, at + piece)
                cut = cut if cut > 0 else at + piece
                n += len(enc.encode_ordinary(t[at:cut]))
                at = cut
            return n + len(enc.encode_ordinary(t[at:]))

        return texts.map(size)

    return run(column)


def sized_documents(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens): each document once, its source in one spelling (lower case, blanks
    and underscores as hyphens, none at the ends; null is empty). Null and blank texts have the tokens
    they have: none, or those of their blanks."""
    source = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce("source", F.lit("")), r"(?U)[\s_-]+", "-"), "^-|-$", ""))
    return (
        documents.where(F.col("doc_id").isNotNull())
        .select("doc_id", source.alias("source"), "text")
        .groupBy("doc_id")
        .agg(F.min(F.struct("source", "text")).alias("d"))
        .select("doc_id", "d.source", token_count(F.col("d.text"), vocabulary).alias("n_tokens"))
    )
