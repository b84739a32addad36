"""Record schemas of the topics and tables."""

from pyspark.sql import types as T

# A topic row, in the shape the Kafka source yields with headers included.
TOPIC_ROW = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

DETECTIONS = T.ArrayType(T.StructType([
    T.StructField("class_id", T.IntegerType()),
    T.StructField("conf", T.DoubleType()),
]))

# `timestamp` is text on the wire; `detail` is optional and keeps the counts per class.
OBSERVATION = T.StructType([
    T.StructField("cam_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("traffic_volume", T.IntegerType()),
    T.StructField("detail", T.MapType(T.StringType(), T.IntegerType())),
])

AGGREGATE = T.StructType([
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("cam_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("avg_traffic_volume", T.DoubleType()),
])

FORECAST = T.StructType([
    T.StructField("prediction_timestamp", T.TimestampType()),
    T.StructField("base_time_t", T.TimestampType()),
    T.StructField("cam_id", T.StringType()),
    T.StructField("current_volume", T.DoubleType()),
    T.StructField("predicted_volume", T.DoubleType()),
    T.StructField("is_padded", T.BooleanType()),
])

# `time` is read as text and parsed by the reader, so that one bad cell cannot end a job.
SENSOR_HISTORY_CSV = T.StructType([
    T.StructField("dyna_id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("entity_id", T.IntegerType()),
    T.StructField("traffic_flow", T.DoubleType()),
])

TRAINING_ROW = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("t", "t1", "t2", "t3", "t4", "hour_sin", "hour_cos")]
    + [T.StructField("dayofweek", T.IntegerType()), T.StructField("target", T.DoubleType())]
)

REGISTRY = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("source", T.StringType()),
])
