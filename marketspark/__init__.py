"""Daily market data on Spark: land, validate, unify, measure, publish.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark's
own expressions, so the work is partitioned, shuffled and spilled by Spark.
"""
