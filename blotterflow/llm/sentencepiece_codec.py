"""SentencePiece encoding and decoding of text columns, exactly as the library does it.

``pieces`` holds the method. The model's tables are made once on the driver and sent to
executors; their size is the vocabulary's. Nothing is shuffled: each text is encoded
where it is read, and texts of any length are whole.

Cases: null is an empty text; an empty text has no ids and decodes to the empty text.
Characters the model doesn't know become bytes. Repeated rows get equal results. An
empty table gives no rows. Columns of the input with the names of the output are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from blotterflow.llm.batches import TEXT, append_columns, strings
from blotterflow.llm.pieces import Codec, Model

FIELDS = [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
_codecs: dict[int, Codec] = {}


def _codec(sent) -> Codec:
    """The codec of a sent model; a worker makes it once. What it remembers goes with the task."""
    model = sent.value
    key = id(model)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model)
    return _codecs[key]


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ids (without begin or end ids) and the text decoded from them."""
    sent = docs.sparkSession.sparkContext.broadcast(Model(model_path))

    def build():
        codec = _codec(sent)

        def work(piece: pa.RecordBatch):
            encoded = [codec.encode(t or "") for t in piece.column(TEXT).to_pylist()]
            places = np.concatenate([[0], np.cumsum([len(x) for x in encoded])]).astype(np.int32)
            ids = np.concatenate([np.zeros(0, np.int32), *encoded])
            return (
                pa.ListArray.from_arrays(pa.array(places), pa.array(ids)),
                strings([codec.decode(x) for x in encoded]),
            )

        work.close = codec.forget
        return work

    return append_columns(docs, text_col, FIELDS, build)
