"""Small frames for tests."""

from pyspark.sql import functions as F


def values(spark, data, column, kind="string"):
    """Results of a column function over literal values, in their order."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(column(F.col("v"))).collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
