"""Record layouts of the datasets. Every text scan uses one of these; nothing is inferred.

IDs are BIGINT: more rows than an INT can number are expected.
"""

from pyspark.sql import types as T

CUSTOMERS = T.StructType(
    [
        T.StructField("ID", T.LongType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("CountryCode", T.IntegerType()),
        T.StructField("Salary", T.DoubleType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("TransID", T.LongType()),
        T.StructField("CustID", T.LongType()),
        T.StructField("TransTotal", T.DoubleType()),
        T.StructField("TransNumItems", T.IntegerType()),
        T.StructField("TransDesc", T.StringType()),
    ]
)

POINTS = T.StructType(
    [
        T.StructField("x", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
    ]
)

RECTANGLES = T.StructType(
    [
        T.StructField("rectId", T.StringType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("w", T.IntegerType()),
        T.StructField("h", T.IntegerType()),
    ]
)

CENTRES = T.StructType(
    [
        T.StructField("idx", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
    ]
)
