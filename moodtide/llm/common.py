"""Helpers that the corpus operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these six characters.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses neither repeat the work
    nor hang on executors that made it, and the planner knows its true size."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text in order; none for a null or blank one."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner.isNull() | (inner == ""), F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, prefixed until none is among ``columns`` (names do not differ by case alone)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each worked out once per row.

    A plain projection may be folded into whatever reads it, and inside a higher-order function's
    lambda it would then be worked out again for every element. A generator is never folded.
    """
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row may be tested on and never learnt from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def learnable(rows: DataFrame, labels: DataFrame, label_col: str, limit: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``limit`` labelled rows that are not held out, by the lowest hashes of their ids, with
    their ``label`` and ``place`` (the hash). Labels that are null or name no id are not used."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    # Chosen on the narrow side, so that only chosen rows bring their texts along.
    chosen = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = chosen.select("_id", "label", F.xxhash64(F.col("_id").cast("string")).alias("place"))
    chosen = stored(chosen.orderBy("place", "_id").limit(limit), "learnable")
    # At most ``limit`` rows of three numbers, so that no text is shuffled to find the few chosen ones.
    return rows.join(F.broadcast(chosen), rows[id_col] == chosen["_id"]).drop("_id")
