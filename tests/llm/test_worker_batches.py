"""Texts go to the near-duplicate workers in small Arrow batches; the session keeps its own setting."""

from ordo.llm import neardup
from ordo.session import Generations, arrow_batch_bytes

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_end_by_bytes_inside_only(spark):
    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    docs = spark.range(0, 400, 1, 1).selectExpr("repeat('abcdefgh', 1000) as text")
    before = spark.conf.get(KEY, None)
    with arrow_batch_bytes(spark, 1 << 16):
        inside = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(inside) == 400 and max(inside) <= 12
    assert spark.conf.get(KEY, None) == before
    assert [r.n for r in docs.mapInArrow(sizes, "n long").collect()] == [400]


def test_neardup_tables_of_texts_are_written_with_small_batches(spark, monkeypatch):
    seen, real = [], Generations.keep

    def keep(self, df):
        if set(df.columns) & {"keys", "shingles"} and "MapInArrow" in df._jdf.queryExecution().executedPlan().toString():
            seen.append(spark.conf.get(KEY, None))
        return real(self, df)
    monkeypatch.setattr(Generations, "keep", keep)
    a = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, a), (2, a + " tail"), (3, "other words here now"), (3, "and another text"), (None, a)], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in neardup.groups(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (None, None)}
    assert len(seen) >= 2 and set(seen) == {str(neardup.BATCH_BYTES)}


def test_quality_and_packing_run_with_small_batches(spark, monkeypatch, docs, sf):
    import public_tokenizers

    from ordo.llm import packing, quality
    seen, keep, materialize = [], Generations.keep, packing.materialize
    monkeypatch.setattr(Generations, "keep", lambda self, df: seen.append(("good", spark.conf.get(KEY, None))) or keep(self, df))
    monkeypatch.setattr(packing, "materialize", lambda df: seen.append(("pieces", spark.conf.get(KEY, None))) or materialize(df))
    before = spark.conf.get(KEY, None)
    some = docs.where("doc_id < 60")
    good = quality.keep_good(some, spark.read.parquet(f"{sf}/labels.parquet"))
    assert good.columns == docs.columns and 0 < good.count() <= some.count()
    assert packing.pack(some, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id").distinct().count() == some.count()
    assert ("good", str(quality.BATCH_BYTES)) in seen and ("pieces", str(packing.BATCH_BYTES)) in seen
    assert spark.conf.get(KEY, None) == before
