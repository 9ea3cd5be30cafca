"""Token counts (op 5): batch encoding in Arrow functions that return lengths only.

Each Arrow batch is cut into slices of about the same bytes, long texts are split at safe boundaries, and pieces met
before are not encoded again (`pieces`). There is no shuffle: a row's counts depend on that row alone.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from casemart.llm.common import blocks
from casemart.llm.pieces import encoder

LIMIT = 1024
#: Bytes of text encoded together.
BATCH_BYTES = 4 << 20


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, words: bool = False, limit: int = LIMIT, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs (doc_id, text).

    path: the tokenizer's file, which every executor has at that place. words: see `pieces.Encoder`.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, words)
        for block in blocks(batches, limit=batch_bytes):
            text = block.column("text").fill_null("")
            n = own.counts(text.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pc.binary_length(text).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
