"""Tables of a loop: real sizes however long the loop, and no more disk than the tables in use."""

import os

from pyspark.sql import functions as F

from ordo.session import Generations


def test_estimates_stay_real_and_old_tables_go(spark):
    gens = Generations(spark, "loop")
    table = gens.keep(spark.range(1000).select("id", F.lit(1).cast("bigint").alias("x")))
    folder = gens.base.removeprefix("file://")
    for _ in range(30):
        other = table.select(F.col("id").alias("j"), F.col("x").alias("y"))
        new = gens.keep(table.join(other, F.col("id") == F.col("j")).select("id", (F.col("x") + F.col("y")).alias("x")))
        gens.drop(table)
        table = new
        assert len(os.listdir(folder)) == 1
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert size < 1_000_000
    assert table.agg(F.min("x"), F.max("x"), F.count("*")).first()[:] == (2 ** 30, 2 ** 30, 1000)
    gens.close()
    assert not os.path.exists(folder)
