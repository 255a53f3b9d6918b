"""Score a stream of reviews with a fitted model.

The reference has no streaming; its row-wise steps (tag stripping,
tokenizing, label coding) accept a streaming DataFrame unchanged. What a
stream needs on top is the per-review score, which sums over a review's
tokens. That sum is done per micro-batch with the batch scorer (a review
arrives whole in one row, so no state crosses batches). Each batch is
written to its own ``batch=<id>`` folder with overwrite, so a replayed batch
after a failure replaces its own output: exactly-once results with the
query checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from polarity.functions.text import decode_label, strip_tags, tokenize
from polarity.operators.model import NBModel, score_nb
from polarity.sources.tables import balance


def prepare_stream(stream: DataFrame, key: str = "id", text: str = "review",
                   strip: bool = True) -> DataFrame:
    """Row-wise cleaning and tokenizing; works on a streaming DataFrame."""
    t = strip_tags(text) if strip else F.col(text)
    return stream.select(key, tokenize(t).alias("tokens"))


def score_stream(stream: DataFrame, model: NBModel, out_path: str, checkpoint_path: str,
                 key: str = "id", text: str = "review", strip: bool = True,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start a query that writes (key, score, pred, sentiment, batch) Parquet
    under ``out_path``; ``checkpoint_path`` must be a shared folder."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # a micro-batch from a few files arrives in a few splits: spread it
        # over the cluster before the per-row tokenizing (large batches are
        # used as they come)
        prepared = prepare_stream(balance(batch, key), key, text, strip)
        scored = score_nb(prepared, model, key)
        (scored.withColumn("sentiment", decode_label(F.col("pred")))
         .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}"))

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation",
                                                           checkpoint_path)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
