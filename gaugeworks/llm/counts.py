"""Token counts of whole texts by the whole-token shortcut.

Which vocabulary entries encode alone as one token is proved once, before the job, and sent to
the workers; pre-tokens among them count as one without merging, only the rest is merged, and
counts are added up without making ids
(:class:`gaugeworks.llm.tokens.WordBpe`). One pass over the texts, no shuffle.

Defined results: a null text counts as empty (0 bytes, 0 tokens); rows with the same id
are counted one by one; a null id stays null; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.tables import rows_of
from gaugeworks.llm.tokens import shared_word_bpe


def token_counts(df: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, bytes in UTF-8, number of tokens, and whether that is over ``limit``."""
    source = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    schema = f"id {dict(source.dtypes)['id']}, n_bytes long, n_tokens long, over_limit boolean"

    encoder_here = shared_word_bpe(df.sparkSession, path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_here()
        for batch in rows_of(batches):
            texts = batch.column("text").to_pylist()
            n = encoder.counts_of(texts)
            size = [len(t.encode("utf-8")) for t in texts]
            columns = [batch.column("id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(count, schema).withColumnRenamed("id", id_column)
