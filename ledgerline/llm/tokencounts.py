"""Token counts of whole texts by a compiled transducer, without making the tokens.

Counts are those of the sentencepiece library for the model: no begin or end, special strings in a text as the text that they
are, nothing cut off. Each Python worker compiles the tokenizer as its texts ask for it and keeps the table for later tasks;
the table is begun anew at a fixed number of states, texts are read a few MB at a time and long ones in parts, so memory is
bounded. Rows are counted where they lie: nothing is shuffled, and a lost task is run again from its input.

Nulls: a null text is empty and has no tokens; a null doc_id stays. Repeated rows are counted each, an empty table gives no
rows, other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .base import per_worker, sized, tidied
from .tokens import public_path
from .transducer import STATES, Transducer, vocabulary

MODEL, LIMIT = "piece_bpe_32k.model", 4096


def counted(docs: DataFrame, path: str | None = None, states: int = STATES) -> DataFrame:
    """doc_id, n_bytes, n_tokens of each row of docs. path: a model file that all workers can open."""
    path = path or public_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = per_worker(("transducer", path, states), lambda: Transducer(vocabulary(path), states))
        for batch in sized(batches, 1):
            texts = pc.fill_null(batch.column(1), "")
            found = machine.count(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(np.asarray(found, np.int64))], ["doc_id", "n_bytes", "n_tokens"])

    schema = StructType([docs.schema["doc_id"], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), schema)


def token_counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: more than limit tokens."""
    return counted(docs, path).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
