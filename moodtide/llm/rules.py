"""Quality rules with thresholds that follow the data: sketches per language and source.

Each document gets a few shares as integer bins. The sketch of a group is the number of its
documents per bin: sketches merge by adding counts, so a language's is the sum of its sources'
and the whole corpus's the sum of all, whatever the partitioning. A bin bounds the error of a
quantile's value.

A group's cutoffs are drawn to its language's by ``WEIGHT`` documents' worth, so that they move with
every document by its share, and there is no size at which they change at once. A language's own are drawn to the whole
corpus's in the same way, but not those of word length and upper case: by these a document is judged by its own
language, however rare.

Cutoffs come from the median and the lower tenth, which junk does not move until it is half of a
group: ``median + SPREAD * (median - lower tenth)``, and at least a margin above the median.

Only aggregates are shuffled: at most a row per task, group and bin. The thresholds are a small
written table, joined by size: Spark broadcasts it when it is under its limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import NOT_SPACES, SPACES, stored, words, worked_out

MIN_WORDS = 50
WEIGHT = 100
SPREAD = 6
# So many repeated windows of a text are looked up one by one.
FEW = 4
# Bins per unit of a share, and of a mean word length (whose sketch ends at 64 characters).
SHARE_BINS = 1024
LENGTH_BINS = 16
LAST_LENGTH_BIN = 64 * LENGTH_BINS
# In bins, what a cutoff stays away from the median at least.
MARGIN = {"symbol": 52, "upper": 154, "dup_line": 512, "length": 64}
# Cutoffs that a language has to itself.
BY_LANGUAGE = ("upper_hi", "length_hi", "length_lo")

# What grouping_id() gives the sketch of a group, of a language, of everything.
OWN, LANG, ALL = 0, 4, 12

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _share(part: str, whole: str) -> Column:
    return F.expr(f"coalesce(({part} * {SHARE_BINS}) div nullif({whole}, 0), 0)")


def cheap_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``_words`` and every measure but repeated windows; null texts have no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    out = worked_out(docs, _words=words(F.col(text_col)), _lines=lines)
    return worked_out(
        out,
        n_words=F.size("_words").cast("bigint"),
        word_chars=(F.length(text) - F.length(F.regexp_replace(text, NOT_SPACES, ""))).cast("bigint"),
        n_symbols=F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("bigint"),
        _n_upper=F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint"),
        _n_lines=F.size("_lines").cast("bigint"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
    ).drop("_lines")


def with_repeats(measured: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words that lie in a 3-word window found twice or more in the text.

    Windows are compared by a 64-bit hash made from their words' hashes. Sorting the hashes tells
    which come twice; few of them are looked up at every position, many are found by sorting all
    windows with their positions. Both ways give the same.
    """
    in_pairs = "zip_with(slice({0}, 1, size({0}) - 1), slice({0}, 2, size({0}) - 1), (a, b) -> {1})"
    hashed = F.expr("CASE WHEN size(_words) >= 4 THEN transform(_words, w -> xxhash64(w)) END")
    out = worked_out(measured, _hashes=hashed).drop("_words")
    out = worked_out(out, _pairs=F.expr(in_pairs.format("_hashes", "xxhash64(a, b)"))).drop("_hashes")
    out = worked_out(out, _windows=F.expr(in_pairs.format("_pairs", "xxhash64(a, b)"))).drop("_pairs")
    out = worked_out(out, _ordered=F.expr("sort_array(_windows)"))
    twice = F.array_distinct(F.array_compact(F.expr(in_pairs.format("_ordered", "if(a = b, a, NULL)"))))
    out = worked_out(out, _twice=twice).drop("_ordered")
    few = F.expr(
        f"CASE WHEN size(_twice) BETWEEN 1 AND {FEW} THEN "
        "array_compact(transform(_windows, (h, i) -> if(array_contains(_twice, h), i, NULL))) END"
    )
    many = F.expr(
        f"CASE WHEN size(_twice) > {FEW} THEN "
        "sort_array(transform(_windows, (h, i) -> struct(h AS h, i AS i))) END"
    )
    out = worked_out(out, _few=few, _many=many).drop("_windows", "_twice")
    found = F.expr(
        "CASE WHEN _many IS NULL THEN _few ELSE transform(filter(_many, (x, k) -> "
        "x.h = get(_many, k - 1).h OR x.h = get(_many, k + 1).h), x -> x.i) END"
    )
    out = worked_out(out, _found=found).drop("_few", "_many")
    covered = F.expr(
        "CASE WHEN _found IS NULL THEN 0L ELSE CAST(size(array_distinct(concat("
        "_found, transform(_found, i -> i + 1), transform(_found, i -> i + 2)))) AS BIGINT) END"
    )
    return worked_out(out, n_repeat_words=covered).drop("_found")


def bins() -> dict[str, Column]:
    """The bin of each adaptive measure."""
    length = F.expr(f"least(coalesce((word_chars * {LENGTH_BINS}) div nullif(n_words, 0), 0), {LAST_LENGTH_BIN})")
    return {
        "symbol": _share("n_symbols", "word_chars"),
        "upper": _share("_n_upper", "word_chars"),
        "dup_line": _share("n_dup_lines", "_n_lines"),
        "length": length,
    }


def sketches(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, measure, bin, n``: documents per bin, of those long enough to judge."""
    pairs = [F.struct(F.lit(name).alias("measure"), value.alias("bin")) for name, value in bins().items()]
    rows = measured.filter(F.col("n_words") >= MIN_WORDS).select(
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.inline(F.array(*pairs))
    )
    return rows.groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def _of_language(cutoff: str) -> str:
    if cutoff in BY_LANGUAGE:
        return f"l.{cutoff}"
    return f"((l.total * l.{cutoff} + {WEIGHT} * a.{cutoff}) div (l.total + {WEIGHT}))"


def thresholds(sketch: DataFrame) -> DataFrame:
    """``lang, source, symbol_hi, upper_hi, dup_line_hi, length_lo, length_hi`` (in bins) for
    every group of the sketch, from its own, its language's and the whole sketch."""
    spark = sketch.sparkSession
    cutoffs = ", ".join(
        [
            f"max(CASE WHEN measure = '{m}' THEN mid + greatest({MARGIN[m]}, {SPREAD} * (mid - low)) END) AS {m}_hi"
            for m in MARGIN
        ]
        + [
            f"max(CASE WHEN measure = 'length' THEN greatest(mid - greatest({MARGIN['length']}, {SPREAD} * (mid - low)), 0) END)"
            " AS length_lo"
        ]
    )
    return spark.sql(
        f"""
        WITH merged AS (
          SELECT grouping_id() AS level, lang, source, measure, bin, sum(n) AS n FROM {{sketch}}
          GROUP BY GROUPING SETS ((lang, source, measure, bin), (lang, measure, bin), (measure, bin))
        ), running AS (
          SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS upto,
                 sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM merged
        ), quantiles AS (
          SELECT level, lang, source, measure, max(total) AS total,
                 min(CASE WHEN upto * 10 >= total THEN bin END) AS low,
                 min(CASE WHEN upto * 2 >= total THEN bin END) AS mid
          FROM running GROUP BY level, lang, source, measure
        ), cutoffs AS (
          SELECT level, lang, source, max(total) AS total, {cutoffs} FROM quantiles GROUP BY level, lang, source
        )
        SELECT g.lang, g.source, {", ".join(
            f"(g.total * g.{c} + {WEIGHT} * {_of_language(c)}) div (g.total + {WEIGHT}) AS {c}"
            for c in [f"{m}_hi" for m in MARGIN] + ["length_lo"]
        )}
        FROM (SELECT * FROM cutoffs WHERE level = {OWN}) g
        JOIN (SELECT * FROM cutoffs WHERE level = {LANG}) l ON g.lang <=> l.lang
        JOIN (SELECT * FROM cutoffs WHERE level = {ALL}) a ON a.level = l.level + {ALL - LANG}
        """,
        sketch=sketch,
    )


def judged(measured: DataFrame, cutoffs: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Add ``base_failed`` and ``kept`` to measured rows by a join with their group's cutoffs."""
    limits = cutoffs.select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        *[F.col(c).alias(f"_{c}") for c in cutoffs.columns if c not in ("lang", "source")],
    )
    on = F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source"))
    value = bins()
    within = (value["length"] >= F.col("_length_lo")) & (value["length"] <= F.col("_length_hi"))
    for name in ("symbol", "upper", "dup_line"):
        within = within & (value[name] <= F.col(f"_{name}_hi"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    joined = measured.join(limits, on, "left").withColumn("base_failed", failed)
    # Every row of MIN_WORDS words or more is in the sketch, so only failed rows find no cutoffs.
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False))).drop(*limits.columns)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words`` and the base counts, ``base_failed``, ``kept``.

    Null and blank texts have no words and fail; null languages or sources are groups of their
    own; repeated rows count and are judged each; an empty table gives none. Columns of ``docs``
    other than id, text, ``lang`` and ``source`` play no part.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col("lang"), F.col("source")
    )
    measured = with_repeats(cheap_measures(narrow).drop("text"))
    measured = stored(measured, "rules-measured")
    verdicts = judged(measured, stored(thresholds(sketches(measured)), "rules-cutoffs"))
    return verdicts.select("doc_id", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, columns unchanged. Texts are read twice, the first time for the
    cheap measures only, so that no text is shuffled or written down."""
    judged_by = docs.select(F.col(text_col).alias("text"), "lang", "source")
    cutoffs = stored(thresholds(sketches(cheap_measures(judged_by))), "rules-cutoffs")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    narrow = docs.select(whole).select("_row", F.col(f"_row.`{text_col}`").alias("text"), "_row.lang", "_row.source")
    measured = with_repeats(cheap_measures(narrow).drop("text"))
    return judged(measured, cutoffs).filter("kept").select("_row.*")
