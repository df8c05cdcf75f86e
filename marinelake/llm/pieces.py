"""Encoding to piece ids and decoding back, by a table of distinct chunks.

Pieces of such a model cannot cross a whitespace marker, so every distinct marked
word is segmented once per task and its ids are joined back by position.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from marinelake.llm.common import slices, text_rows, texts_of
from marinelake.llm.registry import query, table
from marinelake.llm.tokens import Pieces, public_tokenizer

MODEL = "piece_bpe_32k.model"


def encode_pieces(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row, equal to the library's ids of the whole text.

    A null text counts as empty and has no ids; null and repeated ids stay as they
    are, one row out for each row in. Other columns are not read."""

    def encoded(batches):
        pieces = Pieces(public_tokenizer(model))
        for batch in slices(batches, "text"):
            ids, offsets = pieces.encode(texts_of(batch, "text"))
            lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return text_rows(docs, doc_id, text).mapInArrow(encoded, "doc_id bigint, ids array<int>")


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, ids, text``: the library's text of each row's ids; null ids give an empty text."""

    def decoded(batches):
        pieces = Pieces(public_tokenizer(model))
        for batch in batches:
            lists = batch.column("ids")
            texts = pieces.model.decode([i or [] for i in lists.to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id bigint, ids array<int>, text string")


def piece_digests(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode and digest in one pass, so that ids never leave their task:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``. Rows as in :func:`encode_pieces`."""

    def digests(batches):
        pieces = Pieces(public_tokenizer(model))
        written = pa.array([str(i) for i in range(pieces.model.get_piece_size())])
        for batch in slices(batches, "text"):
            ids, offsets = pieces.encode(texts_of(batch, "text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), written.take(pa.array(ids)))
            joined = pc.binary_join(lists, ",").to_pylist()
            decoded = pieces.decode(ids, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_rows(docs, doc_id, text).mapInArrow(
        digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


@query("op8_sentencepiece")
def op8_sentencepiece(spark, sf_dir):
    return piece_digests(table(spark, sf_dir, "documents"))


__all__ = ["decode_pieces", "encode_pieces", "piece_digests"]
