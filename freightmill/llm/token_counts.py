"""Token counts by rank-synchronous array merging (see ``byte_bpe``)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.byte_bpe import arrow_texts, shared_tokenizer
from freightmill.llm.common import scratch_names, tokenizer_path


def token_counts(
    docs: DataFrame,
    text: str = "text",
    tokenizer: str | None = None,
    limit: int = 1024,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, default all) with n_bytes, n_tokens and over_limit.

    ``tokenizer``: path of a byte-level BPE file in the tokenizers JSON format, readable on
    every worker. Texts are read whole, without truncation; a special string inside a text is
    one token, as the library treats it. NULL and empty texts count 0 bytes and 0 tokens.
    Repeated rows are counted each. Columns of ``docs`` that are named like a result column
    are replaced. One narrow pass: no shuffle, so no key can be hot.
    """
    path = tokenizer or tokenizer_path()
    results = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in (keep or docs.columns) if c not in results]
    (hidden,) = scratch_names(docs, "text")
    source = docs.select(F.col(f"`{text}`").cast("string").alias(hidden), *[f"`{c}`" for c in kept])
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = shared_tokenizer(path)
        for batch in batches:
            data, bounds = arrow_texts(batch.column(0))
            tokens = np.zeros(len(bounds) - 1, np.int64)
            for rows, counts, _ in bpe.encode(data, bounds, want_ids=False):
                tokens[rows] += counts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.diff(bounds)), pa.array(tokens)]
                + [pa.array(tokens > limit)],
                names=[*kept, *results],
            )

    return source.mapInArrow(count, schema)
