"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources have weights; their shares of a word budget are filled like basins that hold ``CAP`` times
what the source has, what does not fit going to the others by weight. A source first takes every
document as often as its share allows (complete epochs). The rest is a weighted sample: each
document draws an exponential key, scaled by its quality weight, and the lowest keys whose sizes
sum to the rest are taken; the document that the sum ends in gives only the words still missing.

The key is a fixed function of the row, so a rerun draws the same sample. A sample is then one number
per source, its last key, found without sorting the source: sizes are summed per range of keys,
then within the range that the budget ends in, twice, and only what is left of it is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import SPACE_RUN, stored, words, worked_out

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
KEY_BITS = 52
# Ranges of keys at each step: 2**8, then 2**8 of one of those, then single keys.
SHIFTS = (44, 36, 0)


def quality_weight(text: Column, word_list: Column) -> Column:
    """Between 0.05 and 1: less for symbols among the letters, less for few different words."""
    chars = F.length(F.regexp_replace(text, SPACE_RUN, ""))
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    varied = F.size(F.array_distinct(word_list)) / F.size(word_list)
    weight = (1 - 2 * symbols / chars) * (0.5 + 0.5 * varied)
    return F.when(F.size(word_list) == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.05), weight))


def draws(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` and ``_source, _size, _key``: words, and the exponential key as a whole number of
    the same order, ``2**52 * (1 - exp(-key))``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = worked_out(docs, _words=words(F.col(text_col)))
    # A uniform number from what the row is; rows alike in all three draw the same.
    drawn = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(source_col), text), 11) + F.lit(0.5)
    sized = worked_out(
        sized,
        _size=F.size("_words").cast("bigint"),
        _exponential=-F.log(drawn / F.lit(float(1 << 53))) / quality_weight(text, F.col("_words")),
    )
    key = (F.lit(float(1 << KEY_BITS)) * (1 - F.exp(-F.col("_exponential")))).cast("bigint")
    return sized.select(*docs.columns, F.col(source_col).alias("_source"), "_size", key.alias("_key"))


def targets(drawn: DataFrame) -> DataFrame:
    """``source, source_size, target``. One row per source: only this small table is ordered whole."""
    weight = f"element_at(array({', '.join(map(str, WEIGHTS))}), CAST((place - 1) % {len(WEIGHTS)} + 1 AS INT))"
    return drawn.sparkSession.sql(
        f"""
        WITH sizes AS (SELECT _source AS source, sum(_size) AS source_size FROM {{drawn}} GROUP BY _source),
        placed AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sizes),
        weighed AS (SELECT source, source_size, {weight} AS weight, sum(source_size) OVER () AS whole FROM placed),
        ranked AS (
          SELECT *, sum({CAP} * source_size) OVER full_before - {CAP} * source_size AS held,
                 sum(weight) OVER () - sum(weight) OVER full_before + weight AS open_weight
          FROM weighed
          WINDOW full_before AS (ORDER BY source_size / weight, source ASC NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        ),
        levels AS (
          SELECT max(CASE WHEN level * weight <= {CAP} * source_size THEN level END) AS level
          FROM (SELECT *, ({BUDGET} * whole - held) / open_weight AS level FROM ranked)
        )
        SELECT /*+ BROADCAST(levels) */ source, source_size,
               CAST(least({CAP}D * source_size, level * weight) AS DOUBLE) AS target
        FROM weighed JOIN levels ON true
        """,
        drawn=drawn,
    )


def cuts(drawn: DataFrame) -> DataFrame:
    """``source, source_size, target, epochs, cut, cut_share``: keys below ``cut`` are sampled, those
    equal to it take ``cut_share`` words each."""
    wanted = stored(targets(drawn), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    whole = wanted.withColumn("epochs", epochs.cast("bigint"))
    left = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + F.lit(0.5)).cast("bigint")
    found = whole.withColumn("left", left).withColumn("range", F.lit(0).cast("bigint"))
    above = KEY_BITS + 1
    rows = drawn.select("_source", "_size", "_key")
    for shift in SHIFTS:
        here = rows.join(
            found.select("source", "range", "left"),
            F.col("_source").eqNullSafe(F.col("source")) & (F.shiftright("_key", above) == F.col("range")),
        )
        sums = here.groupBy("source", "left", F.shiftright("_key", shift).alias("at")).agg(
            F.sum("_size").alias("n"), F.count("*").alias("rows")
        )
        # The range that the sum reaches ``left`` in; all is taken when it never does.
        spark = drawn.sparkSession
        ended = spark.sql(
            """
            SELECT source AS of, at, n, rows, upto - n AS below, left - (upto - n) AS rest FROM (
              SELECT *, sum(n) OVER (PARTITION BY source ORDER BY at) AS upto FROM {sums}
            ) WHERE upto > left AND upto - n <= left
            """,
            sums=sums,
        )
        joined = whole.join(stored(ended, "mix-ranges"), F.col("source").eqNullSafe(F.col("of")), "left")
        found = joined.select(*whole.columns, F.col("at").alias("range"), F.col("rest").alias("left"), "rows")
        found = stored(found, "mix-found")
        above = shift
    share = F.coalesce(F.expr("left div rows"), F.lit(0))
    cut = F.coalesce("range", F.lit(1 << (KEY_BITS + 1)))
    return found.select(*whole.columns, cut.cast("bigint").alias("cut"), share.cast("bigint").alias("cut_share"))


def _with_cuts(drawn: DataFrame, found: DataFrame) -> DataFrame:
    found = stored(found, "mix-cuts").withColumnRenamed("source", "_of")
    renamed = found.select("_of", *[F.col(c).alias(f"_{c}") for c in found.columns if c != "_of"])
    return drawn.join(renamed, F.col("_source").eqNullSafe(F.col("_of")), "left")


def mixed_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken``: one row per row of ``docs``.

    Null and blank texts have size 0 and are taken 0 words; a null source is one of its own and
    comes last. Rows alike in id, source and text share the place in the order, and evenly what
    is left there. An empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")
    )
    drawn = stored(draws(narrow).drop("text"), "mix-draws")
    sampled = F.expr("CASE WHEN _key < _cut THEN _size WHEN _key = _cut THEN least(_cut_share, _size) ELSE 0 END")
    return _with_cuts(drawn, cuts(drawn)).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_epochs") * F.col("_size") + sampled).alias("taken"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken. Documents are not cut here:
    the one that a source's sum ends in is taken if at least half of it fits. Rows without words
    fall out only when their key is not sampled in their source's last, incomplete epoch."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")
    )
    found = cuts(stored(draws(narrow).select("_source", "_size", "_key"), "mix-draws"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(whole).select(
        "_row",
        F.col(f"_row.`{id_col}`").alias("doc_id"),
        F.col(f"_row.`{text_col}`").alias("text"),
        F.col(f"_row.`{source_col}`").alias("source"),
    )
    once_more = F.expr("_key < _cut OR (_key = _cut AND 2 * _cut_share >= _size)").cast("bigint")
    joined = _with_cuts(draws(rows), found).withColumn("_times", F.col("_epochs") + once_more)
    times = F.expr("CASE WHEN _times > 0 THEN sequence(1L, _times) ELSE array() END")
    return joined.select("_row", F.explode(times).alias("_time")).select("_row.*")
