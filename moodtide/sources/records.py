"""The alert table: change log, versioned snapshots upserted by key, JDBC options.

Parquet has no MERGE. The table is a row of versions: each is one small manifest that names, for every part of
the table (a date and a hash of the user), the folder that holds it. An upsert writes the parts it changes to a
new folder and publishes the next manifest by a rename that never replaces a file: that is the one
moment at which the table changes. No file is written twice, so a reader has one whole version, however long it
reads, and a writer that dies leaves files that no version names. A manifest remembers the last batch of
each writer: a repeated batch that is published changes nothing. Of two writers at once, the one that comes second merges
again, into what the first left. ``sweep`` deletes what no kept version needs.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide.schemas import ALERT_RECORD
from moodtide.sources import files

KEY = ["user_id", "window_end_ts"]
DAY_MS = 86_400_000
# So many parts of a date by a hash of the user.
PARTS = 16
# Versions that a sweep keeps.
KEPT = 10
_COMPACTED = "_compacted-"


def write_changes(records: DataFrame, path: str, batch_id: int) -> None:
    """Log a micro-batch's records under its number. A repeated batch overwrites its own folder."""
    records.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The log: what the last complete compaction left of the batches up to its own, and those after it."""
    schema = T.StructType([*ALERT_RECORD.fields, T.StructField("batch_id", T.LongType())])
    upto = _compacted(spark, path)
    if not upto:
        return spark.read.schema(schema).parquet(path)
    before = spark.read.schema(ALERT_RECORD).parquet(_aside(path, upto[-1])).withColumn("batch_id", F.lit(upto[-1]).cast("bigint"))
    if not any(name.startswith("batch_id=") for name in files.names(spark, path)):
        return before
    return before.unionByName(spark.read.schema(schema).parquet(path).filter(F.col("batch_id") > upto[-1]))


def latest_records(changes: DataFrame) -> DataFrame:
    """The last logged record per key (one a batch): the last batch of each key by a hash fold, then the
    rows of these."""
    last = changes.groupBy(*KEY).agg(F.max("batch_id").alias("batch_id"))
    return changes.join(last, [*KEY, "batch_id"], "left_semi").select(*ALERT_RECORD.names)


def _aside(path: str, upto: int) -> str:
    return f"{path}/{_COMPACTED}{upto:020d}"


def _compacted(spark: SparkSession, path: str) -> list[int]:
    """Up to which batches there are complete compactions, in order."""
    all_ = [int(name.removeprefix(_COMPACTED)) for name in files.names(spark, path) if name.startswith(_COMPACTED)]
    return [upto for upto in all_ if files.complete(spark, _aside(path, upto))]


def compact_changes(spark: SparkSession, path: str, upto: int) -> None:
    """Replace the log's batches up to ``upto`` by the last record of each key in them. Run it while no
    other compaction runs; batches behind ``upto`` may come meanwhile.

    The compaction counts once it is complete and is never written again, so a crash at any point loses nothing.
    What it stands for is deleted by the next one, so that readers have until then to finish.
    """
    done = _compacted(spark, path)
    if done and done[-1] >= upto:
        return
    for name in files.names(spark, path) if done else []:
        batch = name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= done[-1]
        if batch or name.startswith(_COMPACTED) and int(name.removeprefix(_COMPACTED)) < done[-1]:
            files.delete(spark, f"{path}/{name}")
    old = read_changes(spark, path).filter(F.col("batch_id") <= upto)
    latest_records(old).write.mode("overwrite").parquet(_aside(path, upto))


@dataclass(frozen=True)
class Version:
    """A version of the table: where each part, a date and a number, lies, and the last batch of each writer."""

    number: int = 0
    parts: dict[tuple[str, int], str] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)

    def folders(self, base: str, since: dt.date | None = None, until: dt.date | None = None) -> list[str]:
        inside = [
            (date, part) for date, part in self.parts
            if (since is None or date >= since.isoformat()) and (until is None or date <= until.isoformat())
        ]
        return [f"{base}/data/{self.parts[key]}/window_date={key[0]}/part={key[1]}" for key in inside]

    def text(self) -> str:
        by_folder: dict[str, list] = {}
        for (date, part), folder in self.parts.items():
            by_folder.setdefault(folder, []).append([date, part])
        return json.dumps({"number": self.number, "parts": by_folder, "writers": self.writers})

    @staticmethod
    def of(text: str) -> Version:
        held = json.loads(text)
        parts = {(date, part): folder for folder, keys in held["parts"].items() for date, part in keys}
        return Version(held["number"], parts, held["writers"])


def _manifest(base: str, number: int) -> str:
    return f"{base}/versions/{number:020d}.json"


def versions(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the versions that can be read, in order."""
    return [int(name.removesuffix(".json")) for name in files.names(spark, f"{base}/versions") if name.endswith(".json")]


def version(spark: SparkSession, base: str, number: int | None = None) -> Version:
    """A version, the last unless numbered; version 0 is the empty table."""
    if number is None:
        number = max(versions(spark, base), default=0)
    return Version.of(files.read_text(spark, _manifest(base, number))) if number else Version()


def read_records(
    spark: SparkSession, base: str, number: int | None = None, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """The alert table under ``base`` as it is now, or as that version had it; later upserts do not show. Of
    windows that end outside ``since`` to ``until`` (inclusive) no file is read."""
    return _read(spark, version(spark, base, number).folders(base, since, until))


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], ALERT_RECORD)
    return spark.read.schema(ALERT_RECORD).parquet(*folders)


def _placed(records: DataFrame) -> DataFrame:
    day = F.floor(F.col("window_end_ts") / DAY_MS).cast("int")
    part = F.pmod(F.xxhash64("user_id"), F.lit(PARTS)).cast("int")
    return records.withColumns({"window_date": F.date_from_unix_date(day), "part": part})


def upsert_records(spark: SparkSession, records: DataFrame, base: str, writer: str, batch_id: int) -> None:
    """Replace the table's rows that share a key with ``records`` (one row per key) and add the rest.

    Only the parts that ``records`` touches are read and written, once. ``writer`` tells apart jobs that
    count their batches separately, upwards: a stream's checkpoint folder, say.
    """
    current = version(spark, base)
    if current.writers.get(writer, -1) >= batch_id:
        return
    # Kept for the two jobs below; what an executor takes along when it is lost is worked out again.
    changes = _placed(records).persist()
    try:
        touched = {(row.window_date.isoformat(), row.part) for row in changes.select("window_date", "part").distinct().collect()}
        while touched and current.writers.get(writer, -1) < batch_id:
            before = Version(parts={key: folder for key, folder in current.parts.items() if key in touched})
            kept = _placed(_read(spark, before.folders(base)).join(changes.select(*KEY), KEY, "left_anti"))
            folder = f"{current.number + 1:020d}-{uuid.uuid4().hex}"
            # By what parts are made of: a task writes whole parts.
            merged = kept.unionByName(changes).repartition("window_date", "part")
            merged.write.partitionBy("window_date", "part").parquet(f"{base}/data/{folder}")
            made = Version(
                current.number + 1, {**current.parts, **dict.fromkeys(touched, folder)}, {**current.writers, writer: batch_id}
            )
            _publish(spark, base, made)
            # Another writer may have taken the number: then on from what it left.
            current = version(spark, base)
    finally:
        changes.unpersist()


def _publish(spark: SparkSession, base: str, made: Version) -> bool:
    return files.publish_text(spark, _manifest(base, made.number), made.text())


def sweep(spark: SparkSession, base: str, keep: int = KEPT) -> None:
    """Delete all but the last ``keep`` versions, and the parts that none of these names. Keep as many as are
    published while the slowest reader reads."""
    numbers = versions(spark, base)
    if not numbers:
        return
    named: dict[str, set[str]] = {}
    for number in numbers[-keep:]:
        for (date, part), folder in version(spark, base, number).parts.items():
            named.setdefault(folder, set()).add(f"window_date={date}/part={part}")
    for number in numbers[:-keep]:
        files.delete(spark, _manifest(base, number))
    for folder in files.names(spark, f"{base}/data"):
        # A later number may be a version that is just being written.
        if int(folder.partition("-")[0]) > numbers[-1]:
            continue
        if folder not in named:
            files.delete(spark, f"{base}/data/{folder}")
            continue
        for date in [name for name in files.names(spark, f"{base}/data/{folder}") if "=" in name]:
            for part in files.names(spark, f"{base}/data/{folder}/{date}"):
                if f"{date}/{part}" not in named[folder]:
                    files.delete(spark, f"{base}/data/{folder}/{date}/{part}")


def jdbc_options(url: str, user: str, password: str = "", **extra: str) -> dict[str, str]:
    """Options for ``write.format("jdbc")`` into the alert table. The driver's jar comes with the
    session; Spark's JDBC sink only inserts, so append finals (one row per key) there."""
    return {
        "url": url,
        "dbtable": "alert_record",
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "batchsize": "1000",
        **extra,
    }


def append_jdbc(records: DataFrame, **options: str) -> None:
    records.write.format("jdbc").mode("append").options(**jdbc_options(**options)).save()
