"""Fixed schemas: nothing in gridwave is inferred."""

from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampType)

from gridwave import constants as C

# FIXED: names and types of the decoded-recording contract (one row per cfg/dat pair).
DECODED_RECORDING = StructType([
    StructField(C.ANALOG, ArrayType(ArrayType(DoubleType()))),
    StructField(C.ANALOG_UNITS, ArrayType(StringType())),
    StructField(C.STATUS, ArrayType(ArrayType(DoubleType()))),
    StructField(C.ANALOG_CHANNEL_NAMES, ArrayType(StringType())),
    StructField(C.STATUS_CHANNEL_NAMES, ArrayType(StringType())),
    StructField(C.FREQUENCY, DoubleType()),
    StructField(C.REC_DEV_ID, StringType()),
    StructField(C.STATION_NAME, StringType()),
    StructField(C.MICROSECONDS, ArrayType(LongType())),
])

# FIXED: headerless raw text recording: time in seconds, three phase currents.
RAW_TEXT = StructType([
    StructField("time", DoubleType()),
    StructField("IA", DoubleType()),
    StructField("IB", DoubleType()),
    StructField("IC", DoubleType()),
])

# binaryFile source schema (fixed, so streams need no inference).
BINARY_FILE = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])
