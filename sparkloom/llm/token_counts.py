"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .encoding import balanced, default_vocabulary, encoder, safe_chunks

#: Bytes of a batch given to the encoder, and code points of a piece of a long text.
BATCH_BYTES, PIECE_CHARS = 16_000_000, 1_000_000


def _counter(path: str):
    if path.endswith(".model"):
        import numpy as np
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: np.array([len(x) for x in sp.encode(texts.to_pylist(), num_threads=1)], np.int64)
    return encoder(path).lengths


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text.

    Returns ``doc_id, n_bytes, n_tokens, over_limit``. Texts go to the encoder
    in batches of about ``BATCH_BYTES``; a text of over ``PIECE_CHARS`` code
    points is cut before white space that follows something else, where no
    token can cross, and the lengths of its pieces are added (a sentencepiece
    text, and one for a vocabulary that is not byte-level, stays whole). Only
    lengths leave the worker.

    Null or empty text: 0 bytes, 0 tokens. Null ids and repeated rows: one row
    each. Empty table: no rows. Other columns are ignored.
    """
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lengths = _counter(path)
        cuts = not path.endswith(".model") and encoder(path).by_parts
        for batch in batches:
            texts = batch.column(1)
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            totals = np.zeros(len(texts), np.int64)
            for a, b in balanced(size, BATCH_BYTES):
                if cuts and size[a:b].max() > PIECE_CHARS:
                    for i in range(a, b):
                        for piece in safe_chunks(texts[i].as_py(), PIECE_CHARS):
                            totals[i] += lengths(pa.array([piece]))[0]
                else:
                    totals[a:b] = lengths(texts.slice(a, b - a))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(totals), pa.array(totals > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
