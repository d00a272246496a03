"""The batch operators applied to a streaming candidate source."""

import os
import tempfile


def test_stream_scoring_matches_batch(spark, signal, idf):
    from ordo.operators.matrix import feature_matrix
    from ordo.streaming.scoring import row_features, score_stream
    base = tempfile.mkdtemp(prefix="ordo-stream-")
    src = os.path.join(base, "src")
    signal.write.parquet(src)
    stream = spark.readStream.schema(signal.schema).parquet(src)
    assert row_features(stream).isStreaming
    q = score_stream(stream, idf, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(base, "out")).drop("batch_id")
    want = feature_matrix(signal, idf)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
