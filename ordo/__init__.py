"""ordo — learning-to-rank analytics as composable Spark DataFrame operators.

Every public operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` expressions, joins, aggregates and windows, so Catalyst
plans the whole chain (pushdown, pruning, codegen) and AQE re-plans at runtime.
"""

__version__ = "0.1.0"
