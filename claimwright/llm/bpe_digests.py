"""Digests of encoded and decoded documents."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimwright.llm.bpe import Vocabulary, codec, each_row, encode_documents, _mapped


def round_trips(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    Every text is encoded, and its ids are decoded again. Null and empty texts have no ids.
    Repeated rows and null ids are kept; no rows give no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    numerals = [str(rank) for rank in range(max(vocabulary.ranks().values()) + 1)]

    def digests(lists: pa.ListArray) -> list[pa.Array]:
        _, decoder = codec(shared.value)
        counts, of_ids, of_texts = [], [], []
        for row in each_row(lists):
            ids = row.tolist()
            counts.append(len(ids))
            of_ids.append(sha256(" ".join(map(numerals.__getitem__, ids)).encode()).hexdigest())
            of_texts.append(sha256(decoder.decode(ids).encode()).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_texts)]

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    encoded = encode_documents(docs, vocabulary, ["doc_id"])
    return _mapped(encoded, ["doc_id"], "ids", fields, digests)
