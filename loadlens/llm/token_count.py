"""Token counts with a whole-token shortcut.

Offline, on the driver, every vocabulary string is encoded alone; those that give
one token form the shortcut set (never larger than the vocabulary). A task splits
a text into pre-tokens, counts one for each that the set holds, and lets the
library merge only the rest, all distinct ones of a batch at once, remembering results
of bounded size.

Cases: null and empty texts count 0 bytes and 0 tokens; white space alone gives 0
tokens; special strings in a text, and parts with characters outside the proved
alphabet, are counted by the library; rows are independent, so ties and repeated
rows give the same counts; an empty table gives no rows; columns named like the
outputs are not touched, because only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.pretokens import batch_counter, kept, whole_tokens
from loadlens.llm.texts import cut_by_bytes


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_bytes, n_tokens`` of every row, as the library for ``path`` counts."""
    whole = docs.sparkSession.sparkContext.broadcast(frozenset(whole_tokens(path)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = kept("count", path, lambda: batch_counter(path, whole.value))
        for batch in batches:
            for piece in cut_by_bytes(batch, 1, 8 << 20):
                sizes = pc.binary_length(piece.column(1)).cast(pa.int64())
                yield pa.record_batch([piece.column(0), sizes, pa.array(count(piece.column(1)))], ["id", "n_bytes", "n_tokens"])

    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
