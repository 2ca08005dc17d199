"""op10_packing: pieces of all documents packed into sequences of 2048 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import packing
from .common import table

NAME = "op10_packing"
SQL = None
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.tokenize_and_pack(table(spark, sf_dir, "documents"), tokenizer_path())
