import os
import tempfile


def test_clean_stream_matches_batch(spark):
    from moodlens.plans import social
    from moodlens.streaming.clean_stream import clean_stream, read_documents_stream, start_clean_sink

    src = tempfile.mkdtemp(prefix="ml-stream-src-", dir="/tmp")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.write.mode("overwrite").parquet(os.path.join(src, "batch0"))
    out = tempfile.mkdtemp(prefix="ml-stream-out-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="ml-stream-ckpt-", dir="/tmp")
    q = start_clean_sink(clean_stream(read_documents_stream(spark, os.path.join(src, "batch0"))), out, ckpt, available_now=True)
    q.awaitTermination(300)
    got = {r["doc_id"]: r["tokens"] for r in spark.read.parquet(out).collect()}
    want = {r["doc_id"]: r["tokens"] for r in social.social_tokens_df(docs.select("doc_id", "text"), "text", "tokens", keep=["doc_id"]).collect()}
    assert got == want
