"""Data model: frame header, frames, windows, result tables."""

from pyspark.sql import types as T

# Frame header: 17 fixed fields (field names and order are part of the wire
# format — the JSON header of every frame carries exactly these keys).
HEADER_FIELDS = [
    ("user_name", T.StringType()),
    ("session_id", T.StringType()),
    ("frame_number", T.IntegerType()),
    ("time_stamp", T.IntegerType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day", T.IntegerType()),
    ("hour", T.IntegerType()),
    ("minute", T.IntegerType()),
    ("second", T.IntegerType()),
    ("microsecond", T.IntegerType()),
    ("ML_model", T.StringType()),
    ("preprocessing", T.StringType()),
    ("sampling_rate", T.IntegerType()),
    ("num_samples", T.IntegerType()),
    ("num_channels", T.IntegerType()),
    ("channel_names", T.ArrayType(T.StringType())),
]
HEADER_NAMES = [n for n, _ in HEADER_FIELDS]
HEADER = T.StructType([T.StructField(n, t, True) for n, t in HEADER_FIELDS])

# Raw message table (queue / Kafka ``value`` compatible).
FRAME_BYTES = T.StructType(
    [
        T.StructField("value", T.BinaryType(), True),
        T.StructField("received_at", T.TimestampType(), True),
    ]
)

# Annotation label → class code; 0 means unlabelled.
LABEL_CODES = {
    "BCKG": 6,
    "FNSZ": 8,
    "GNSZ": 9,
    "SPSZ": 10,
    "CPSZ": 11,
    "ABSZ": 12,
    "TNSZ": 13,
    "CNSZ": 14,
    "TCSZ": 15,
    "ATSZ": 16,
    "MYSZ": 17,
}
UNLABELLED = 0
BACKGROUND_CODE = 6
