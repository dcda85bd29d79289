"""Row validation as a table job: codes per row, valid rows, quarantine, summary (V6, V7)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions import checks
from moodtide.schemas import (
    ALERT_GENERATION_ERROR,
    CHAT_MESSAGE_INVALID,
    ERROR_CODES,
    PARAMETER_INVALID,
    SENTIMENT_ANALYSIS_ERROR,
    SYSTEM_ERROR,
    error_catalogue,
)


def chat_checks() -> list[Column]:
    """A chat message needs a text."""
    return [checks.not_empty_string(F.col("message"), CHAT_MESSAGE_INVALID)]


def score_checks() -> list[Column]:
    """A score lies in [-1, 1]."""
    return [checks.in_range(F.col("sentiment_score"), -1.0, 1.0, SENTIMENT_ANALYSIS_ERROR)]


def alert_checks() -> list[Column]:
    """An alert names its user and has an average."""
    return [
        checks.not_null(F.col("user_id"), ALERT_GENERATION_ERROR),
        checks.not_null(F.col("average_score"), ALERT_GENERATION_ERROR),
    ]


def with_errors(df: DataFrame, row_checks: Sequence[Column]) -> DataFrame:
    """Add ``errors``: the codes of the checks the row fails, in the order given."""
    return df.withColumn("errors", F.filter(F.array(*row_checks), lambda code: code.isNotNull()))


def valid_rows(df: DataFrame, row_checks: Sequence[Column]) -> DataFrame:
    """Rows that pass every check. A plain filter: it joins the scan's stage."""
    return df.filter(reduce(lambda a, b: a & b, [check.isNull() for check in row_checks]))


def quarantine(df: DataFrame, row_checks: Sequence[Column]) -> DataFrame:
    """Rows that fail a check, with their codes. With ``valid_rows`` it covers every row once."""
    return with_errors(df, row_checks).filter(F.size("errors") > 0)


def require_valid(df: DataFrame, row_checks: Sequence[Column]) -> DataFrame:
    """Strict mode: the job fails at the first bad row, naming its first code and message."""
    code = F.coalesce(*row_checks)
    failure = F.raise_error(F.concat_ws(" ", code, error_message(code))).cast("boolean")
    return df.filter(F.when(code.isNull(), F.lit(True)).otherwise(failure))


def error_message(code: Column) -> Column:
    """The catalogue's message for a code column: nine fixed entries, so no join."""
    messages = [F.lit(part) for known, _, message in ERROR_CODES for part in (known, message)]
    return F.try_element_at(F.create_map(*messages), code)


def classify(code: Column, illegal_argument: Column | None = None) -> Column:
    """The code a failure is reported under: its own if known, 1001 for an illegal argument,
    1000 for anything else."""
    known = code.isin([row[0] for row in ERROR_CODES])
    result = F.when(known, code)
    if illegal_argument is not None:
        result = result.when(illegal_argument, F.lit(PARAMETER_INVALID))
    return result.otherwise(F.lit(SYSTEM_ERROR))


def error_summary(spark: SparkSession, quarantined: DataFrame) -> DataFrame:
    """Failures per code with family and message. Counts fold map-side; the catalogue has nine
    rows, always, which is what makes its broadcast safe."""
    counts = (
        quarantined.select(F.explode("errors").alias("_code"))
        .groupBy(classify(F.col("_code")).alias("code"))
        .agg(F.count("*").alias("n"))
    )
    return counts.join(F.broadcast(error_catalogue(spark)), "code", "inner")
