"""Token counts of whole texts under a byte-level vocabulary."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from lakeops.llm.bpe import TextEncoder, WordEncoder
from lakeops.llm.common import map_batches, text_of


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_tokens and over_limit (more than ``limit`` tokens), in one pass without a shuffle.

    ``vocabulary`` is the path of a byte-level BPE file that every worker can open. NULL texts count as empty: no
    bytes, no tokens. Repeated rows are counted each; NULL keys stay; other columns are not read. Long texts are
    encoded whole; memory in a worker follows its longest text and a bounded table of remembered words.
    """

    def count(batch: pa.RecordBatch, encoder: TextEncoder) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        tokens = [len(ids) // 4 for ids in encoder.encode(texts)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
             pa.array([n > limit for n in tokens], pa.bool_())], ["key", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(docs[key].alias("key"), text_of(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    counted = map_batches(rows, count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean",
                          lambda: TextEncoder(WordEncoder(vocabulary)))
    return counted.withColumnRenamed("key", key)
