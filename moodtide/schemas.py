"""Record schemas, topic names and the error catalogue: all fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Topic names.
CHAT_TOPIC = "chat-messages"
SCORE_TOPIC = "sentiment-scores"
ALERT_TOPIC = "warning-alerts"
# Where records go that a stage cannot use; a choice of this package.
REJECTED_TOPIC = "rejected-messages"

# Fixed value: the one text every alert carries.
ALERT_MESSAGE = "用户情绪持续低落"


def record(**fields: T.DataType) -> T.StructType:
    """A schema of nullable fields, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

# Wire schemas: one JSON object per record with these field names.
CHAT_MESSAGE = record(userId=_TEXT, timestamp=_LONG, message=_TEXT)
SENTIMENT_SCORE = record(userId=_TEXT, timestamp=_LONG, sentimentScore=_DOUBLE, sentimentLabel=_TEXT)
WARNING_ALERT = record(userId=_TEXT, windowEnd=_LONG, averageScore=_DOUBLE, alertMessage=_TEXT)

# The alert table. The average's scale is a choice of this package (six digits).
ALERT_RECORD = record(
    user_id=_TEXT,
    window_end_ts=_LONG,
    average_score=T.DecimalType(10, 6),
    alert_message=_TEXT,
    created_at=T.TimestampNTZType(),
)

# What a topic looks like once read, from Kafka or from files.
TOPIC_RECORD = record(
    key=T.BinaryType(),
    value=T.BinaryType(),
    partition=T.IntegerType(),
    offset=_LONG,
    timestamp=T.TimestampType(),
)

# Error codes, their family and message.
ERROR_CODES = [
    ("1000", "system", "系统内部错误"),
    ("1001", "system", "参数无效"),
    ("1002", "system", "资源未找到"),
    ("2000", "transport", "Kafka消息发送失败"),
    ("2001", "transport", "Kafka配置错误"),
    ("2002", "transport", "Kafka序列化失败"),
    ("3000", "business", "聊天消息无效"),
    ("3001", "business", "情感分析失败"),
    ("3002", "business", "预警生成失败"),
]

SYSTEM_ERROR = "1000"
PARAMETER_INVALID = "1001"
SERIALIZATION_ERROR = "2002"
CHAT_MESSAGE_INVALID = "3000"
SENTIMENT_ANALYSIS_ERROR = "3001"
ALERT_GENERATION_ERROR = "3002"


def error_catalogue(spark: SparkSession) -> DataFrame:
    """The nine error codes as a table ``code, family, message`` (V6)."""
    rows = ", ".join(str(row) for row in ERROR_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS catalogue(code, family, message)")
