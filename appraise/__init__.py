"""appraise — batch price-model data work on Spark.

Typed loading, column repair (fills, sentinels, donor draws, lookups), recoding and
scaling, fact-to-attribute joins, quantile trimming, repeatable splits / folds /
bootstrap, MLlib model training and selection, metrics and wide scoring output.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``pyspark.ml`` stage)
built from ``pyspark.sql.functions``; nothing large passes through the driver.
"""

__version__ = "0.1.0"
