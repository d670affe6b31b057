"""Token ids and token sizes of whole corpora."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.bpe_trie import encoder


def token_ids(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row ``(doc_id, ids)`` per row of ``documents``.

    ``ids`` are the token ids of the whole text without special tokens; a null
    and an empty text give an empty list, blank texts give the tokens of their
    blanks. Repeated rows stay repeated, a null id stays null, other columns are
    ignored. No shuffle: each task walks the trie of its own distinct words, and
    a worker keeps the words it met (bounded) for its next batches.
    Letters that Unicode added after the tokenizer was published may be split
    differently by different versions of the tokenizer libraries.
    """
    id_type = documents.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 500):
                part = words.encode_batch(texts.slice(at, 500).to_pylist())
                ends = np.cumsum([0, *(len(x) // 4 for x in part)], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(part), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 500), ids], names=["doc_id", "ids"])

    picked = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {id_type.simpleString()}, ids array<int>")


def token_sizes(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, source, n_tokens, text_key)`` per row; null and empty texts have 0 tokens and a null key.

    ``text_key`` is a 128-bit digest of the text, equal for equal texts only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for batch in batches:
            sizes, keys = [], []
            column = batch.column(2)
            for at in range(0, batch.num_rows, 500):
                texts = column.slice(at, 500).to_pylist()
                sizes += [len(x) // 4 for x in words.encode_batch(texts)]
                keys += [hashlib.blake2b(t.encode(), digest_size=16).digest() if t else None for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())],
                names=["doc_id", "source", "n_tokens", "text_key"],
            )

    picked = documents.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, source string, n_tokens bigint, text_key binary")
