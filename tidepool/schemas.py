"""Fixed table schemas of the pipeline."""

from pyspark.sql import types as T

DELIVERY_SCHEMA = T.StructType([
    T.StructField("delivery_id", T.StringType(), nullable=False),
    T.StructField("customer_id", T.StringType()),
    T.StructField("restaurant_name", T.StringType()),
    T.StructField("order_amount", T.DoubleType()),
    T.StructField("delivery_minutes", T.IntegerType()),
    T.StructField("city_zone", T.StringType()),
    T.StructField("delivery_status", T.StringType()),
])

INVALID_DELIVERY_SCHEMA = T.StructType(
    DELIVERY_SCHEMA.fields + [T.StructField("driver_rating", T.DoubleType())])

DATASET_SCHEMA = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("name", T.StringType()),
])

LINEAGE_SCHEMA = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("eventTime", T.StringType()),
    T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
    T.StructField("job", T.StructType([T.StructField("namespace", T.StringType()),
                                       T.StructField("name", T.StringType())])),
    T.StructField("producer", T.StringType()),
    T.StructField("inputs", T.ArrayType(DATASET_SCHEMA)),
    T.StructField("outputs", T.ArrayType(DATASET_SCHEMA)),
    T.StructField("detail", T.StringType()),
])

