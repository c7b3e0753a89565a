"""Record types. Inputs are always read with one of these, never inferred."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


TRAFFIC_NUMBERS = ["session_num", "c2s_pkt_num", "s2c_pkt_num", "c2s_byte_num", "s2c_byte_num"]

TRAFFIC_JSON = _struct(
    ("client_ip", T.StringType()),
    *[(name, T.IntegerType()) for name in TRAFFIC_NUMBERS],
    ("recv_time", T.LongType()),
)
STUDENT = _struct(("name", T.StringType()), ("age", T.IntegerType()))
LINES = _struct(("value", T.StringType()), ("arrival_ts", T.TimestampType()))
WORD_COUNT = _struct(("word", T.StringType()), ("count", T.LongType()))
KEYED_VALUES = _struct(("seq", T.LongType()), ("key", T.StringType()), ("value", T.LongType()))
RANKED_HOSTS = _struct(
    ("rank", T.IntegerType()),
    ("client_ip", T.StringType()),
    ("session_num", T.LongType()),
    ("order_by", T.StringType()),
    ("c2s_pkt_num", T.LongType()),
    ("s2c_pkt_num", T.LongType()),
    ("c2s_byte_num", T.LongType()),
    ("s2c_byte_num", T.LongType()),
    ("window_end_ms", T.LongType()),
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
