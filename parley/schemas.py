"""Fixed schemas of landed and stored tables."""

from pyspark.sql import types as T

RECORDING = T.StructType([
    T.StructField("sid", T.StringType()),
    T.StructField("call_sid", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("date_created", T.TimestampType()),
    T.StructField("media_url", T.StringType()),
])

MANIFEST = T.StructType([T.StructField("recordings", T.ArrayType(RECORDING))])

SEGMENT = T.StructType([
    T.StructField("start", T.DoubleType()),
    T.StructField("end", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("no_speech_probability", T.DoubleType()),
])

CALL = T.StructType([
    T.StructField("recording_sid", T.StringType()),
    T.StructField("call_sid", T.StringType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("transcription", T.StringType()),
    T.StructField("redacted_transcription", T.StringType()),
    T.StructField("segmented_transcription", T.ArrayType(SEGMENT)),
])

RUN_LOG = T.StructType([
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("stage", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
])

SATISFACTION = T.StructType([
    T.StructField("Score", T.StringType()),
    T.StructField("Reason", T.StringType()),
])
