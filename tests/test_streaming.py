"""Row-wise operators accept a streaming DataFrame and give the batch result."""
import tempfile

from pyspark.sql import functions as F

from helpers import SF001


def test_stream_labels_and_gate_match_batch(spark):
    from cytospark.operators import gating, labels, transform
    from cytospark.sources import fixtures as fx
    batch = fx.line_events(spark, SF001)
    d = tempfile.mkdtemp(prefix="cyto-stream-")
    batch.write.mode("overwrite").parquet(f"{d}/in")
    src = spark.readStream.schema(batch.schema).parquet(f"{d}/in")

    def pipeline(df):
        lab = labels.label_events(transform.arcsinh(df, b=None), fx.LINE_CUTOFFS)
        return gating.gate(lab, [("big", {"qty": "> 20", "compare": "&", "price": ">= 1000"})])

    q = pipeline(src).writeStream.format("memory").queryName("cyto_stream_out") \
        .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("cyto_stream_out")
    want = pipeline(batch)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_start_stream_helper(spark):
    from cytospark.sources import fixtures as fx
    from cytospark.streaming.rowwise import label_and_gate, start_stream
    batch = fx.line_events(spark, SF001)
    d = tempfile.mkdtemp(prefix="cyto-stream2-")
    batch.write.mode("overwrite").parquet(f"{d}/in")
    q = start_stream(spark, f"{d}/in", batch.schema, fx.LINE_CUTOFFS, f"{d}/ck", name="cyto_stream_helper")
    q.awaitTermination()
    assert spark.table("cyto_stream_helper").count() == label_and_gate(batch, fx.LINE_CUTOFFS).count()
