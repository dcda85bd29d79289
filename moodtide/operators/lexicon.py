"""First-hit scoring with lexicons of any size.

A chain of ``contains`` reads a text once per term. Here a term is looked for by what it is made of: it lies within a
run of characters that terms have, so texts are cut into such runs, and every different run is looked at once, however
many texts hold it. Each place of a run asks the index once per length of a term, so the work does not grow with the
number of terms that begin alike.

Runs are cut into pieces that overlap by the longest term, so that no expression works on more than a piece,
however long the text. Both lookups, of places among the terms and of a text's pieces among those that hold a term, first ask the
lowest ranks, as many as can be sent to every task. Whoever meets one there needs no other. Of the rest only that is shuffled which
a sieve lets through, a few bits of every key that is asked for, sent to every task too: what it holds back is nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.session import work_dir

# Lengths that a place is looked up by: those of all terms, or, of more than so many, some of them; a term is then looked
# up by its beginning, of the next shorter such length.
LEVELS = 48
# Characters of a piece, without what it overlaps.
BLOCK = 128
# Ranges of characters that a run is told by.
RANGES = 64
# A table of at most so many bytes of terms and ranks is sent to every task; so is a sieve, whose rows take SLOT bytes.
SMALL = 1 << 25
SLOT = 40
NEUTRAL = (0.0, "Neutral")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _levels(lengths: Sequence[int]) -> list[int]:
    lengths = sorted(lengths)
    if len(lengths) <= LEVELS:
        return lengths
    return sorted({lengths[i * len(lengths) // LEVELS] for i in range(LEVELS)})


def _character_class(chars: Sequence[str]) -> str:
    """A regular expression of one of the characters, or of some more where they make too many ranges."""
    ranges = [[code, code] for code in sorted(map(ord, chars))]
    gaps = sorted(((b[0] - a[1], i) for i, (a, b) in enumerate(zip(ranges, ranges[1:])) if b[0] - a[1] > 1), reverse=True)
    cuts = sorted(i for _, i in gaps[: RANGES - 1])
    edges = zip([0, *[i + 1 for i in cuts]], [*cuts, len(ranges) - 1])
    return "[" + "".join(f"\\x{{{ranges[a][0]:x}}}-\\x{{{ranges[b][1]:x}}}" for a, b in edges) + "]"


def term_index(terms: DataFrame) -> tuple[DataFrame, list[int], int, str]:
    """``key, term, rank`` of the terms in lower case, each once by its lowest rank, where ``key`` is its beginning; the
    lengths that beginnings have; the longest term; and a regular expression of the characters that terms have. Null and
    empty terms never hit."""
    low = terms.select(F.lower("term").alias("term"), "rank").filter("term IS NOT NULL AND term != '' AND rank IS NOT NULL")
    low = _stored(low.groupBy("term").agg(F.min("rank").alias("rank")), "terms")
    # As many rows as there are lengths, and as there are characters.
    lengths = [row[0] for row in low.select(F.char_length("term")).distinct().collect()]
    chars = [row[0] for row in low.select(F.explode(F.regexp_extract_all("term", F.lit("(?s)."), F.lit(0)))).distinct().collect()]
    levels = _levels(lengths) or [1]
    level = F.array_max(F.filter(F.array(*map(F.lit, levels)), lambda n: n <= F.char_length("term")))
    index = low.select(F.col("term").substr(F.lit(1), level).alias("key"), "term", "rank")
    return index, levels, max(lengths, default=1), _character_class(chars) if chars else "(?!)."


def _head(table: DataFrame, text_col: str) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of the lowest ranks, as many as are ``SMALL``, and those of higher ones; None for none."""
    size = F.octet_length(text_col) + 40
    whole = table.agg(F.sum(size)).first()[0] or 0
    if whole <= SMALL:
        return table, None
    # Ranks may be shared by many rows: what is below a quantile is measured.
    shares = [SMALL / whole / part for part in (1.1, 2, 4, 8)]
    edges = table.agg(F.percentile_approx("rank", shares, 10_000)).first()[0]
    sizes = table.agg(*[F.sum(F.when(F.col("rank") <= edge, size)) for edge in edges]).first()
    edge = next((edge for edge, held in zip(edges, sizes) if held and held <= SMALL), None)
    return (None, table) if edge is None else (table.filter(F.col("rank") <= edge), table.filter(F.col("rank") > edge))


def _slot_and_bits(cols: Sequence[str]) -> dict[str, Column]:
    """The row of a sieve that a key belongs to, and the two of its 64 bits that stand for it."""
    hashed = F.xxhash64(*cols)
    bit = lambda low: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(hashed, low).bitwiseAND(F.lit(63)).cast("int"))
    slot = F.pmod(F.shiftright(hashed, 12), F.lit(max(1, SMALL // SLOT)).cast("bigint"))
    return {"_slot": slot, "_bits": bit(0).bitwiseOR(bit(6))}


def _sifted(rows: DataFrame, keys: DataFrame, *cols: str) -> DataFrame:
    """The rows whose ``cols`` are among ``keys``, and a few others: the more, the more different keys there are."""
    sieve = keys.select(*[c.alias(name) for name, c in _slot_and_bits(cols).items()])
    sieve = sieve.groupBy("_slot").agg(F.bit_or("_bits").alias("_held"))
    met = rows.withColumns(_slot_and_bits(cols)).join(F.broadcast(sieve), "_slot")
    return met.filter(F.col("_held").bitwiseAND(F.col("_bits")) == F.col("_bits")).drop("_slot", "_bits", "_held")


def _best_pieces(pieces: DataFrame, index: DataFrame, levels: Sequence[int], block: int) -> DataFrame:
    """``piece, rank`` of the pieces that hold a term, with the lowest rank of one."""
    size = F.char_length("piece")
    last = F.least(F.lit(block), size - levels[0] + 1)

    def lowest(some: DataFrame, terms: DataFrame, sent: bool) -> DataFrame:
        places = some.select("piece", F.explode(F.sequence(F.lit(1), last)).alias("at"))
        left = size - F.col("at") + 1
        asked = places.select("piece", "at", F.explode(F.filter(F.array(*map(F.lit, levels)), lambda n: n <= left)).alias("n"))
        asked = asked.select("piece", "at", F.col("piece").substr(F.col("at"), F.col("n")).alias("key"))
        met = asked.join(F.broadcast(terms), "key") if sent else _sifted(asked, terms, "key").join(terms.hint("merge"), "key")
        hits = met.filter(F.col("piece").substr(F.col("at"), F.char_length("term")) == F.col("term"))
        return hits.groupBy("piece").agg(F.min("rank").alias("rank"))

    # A piece is at least as long as the shortest term.
    head, rest = _head(index, "term")
    if head is None:
        return lowest(pieces, rest, False)
    near = lowest(pieces, head, True)
    if rest is None:
        return near
    near = _stored(near, "near-pieces")
    return near.unionByName(lowest(pieces.join(near, "piece", "left_anti"), rest, False))


def score_by_lexicon(
    rows: DataFrame,
    keys: Sequence[str],
    terms: DataFrame,
    text_col: str = "message",
    neutral: tuple[float, str] = NEUTRAL,
) -> DataFrame:
    """``keys, sentiment_score, sentiment_label``: a row per row of ``rows``, by the term of the lowest rank that the
    lower-cased text holds.

    ``terms``: ``term, rank, score, label``; a rank is a number and has one score and label. A text with no term, an empty or a null one
    is ``neutral``. Rows that share their keys are told apart by their text, and repeated ones repeat. ``rows`` are read
    twice, and a third time for texts that none of the ranks that fit into ``SMALL`` bytes settles. Terms, different pieces and what
    they hold are kept in the shared folder.
    """
    index, levels, longest, char = term_index(terms)
    block = max(BLOCK, longest)
    # A piece reaches beyond its own characters, as far as a term may. Possessive, so that the matcher never goes back.
    run = f"(?=({char}{{{levels[0]},{block + longest - 1}}}+)){char}{{1,{block}}}+"

    text = F.coalesce(F.lower(F.col(text_col)), F.lit(""))
    low = rows.select(*keys, F.xxhash64(text_col).alias("_h1"), F.xxhash64(F.lit(2), text_col).alias("_h2"), text.alias("_text"))
    found = F.array_distinct(F.regexp_extract_all("_text", F.lit(run), F.lit(1)))
    pieces = _stored(low.select(F.explode(found).alias("piece")).distinct(), "pieces")
    best = _stored(_best_pieces(pieces, index, levels, block), "best-pieces")

    # An empty piece first, which every row has once.
    held = low.select(*keys, "_h1", "_h2", F.explode(F.concat(F.array(F.lit("")), found)).alias("piece"))
    head, rest = _head(best, "piece")
    met = held.join(F.broadcast(best.limit(0) if head is None else head), "piece", "left")
    times = F.count_if(F.col("piece") == "").cast("int")
    first = met.groupBy(*keys, "_h1", "_h2").agg(F.min("rank").alias("rank"), times.alias("_times"))
    if rest is not None:
        first = _stored(first, "near-texts")
        # Some settled texts among them do no harm: only the open ones take what is found.
        some = _sifted(low, first.filter("rank IS NULL"), "_h1", "_h2")
        asked = _sifted(some.select("_h1", "_h2", F.explode(found).alias("piece")), rest, "piece")
        far = asked.join(rest.hint("merge"), "piece").groupBy("_h1", "_h2").agg(F.min("rank").alias("_far"))
        later = first.filter("rank IS NULL").join(far, ["_h1", "_h2"], "left").withColumn("rank", F.col("_far")).drop("_far")
        first = first.filter("rank IS NOT NULL").unionByName(later)

    each = first.select(*keys, "rank", F.explode(F.sequence(F.lit(1), "_times")))
    ranks = terms.groupBy("rank").agg(F.first("score").alias("_score"), F.first("label").alias("_label"))
    scored = each.join(ranks, "rank", "left")
    return scored.select(
        *keys,
        F.coalesce(F.when(F.col("rank").isNotNull(), F.col("_score")), F.lit(neutral[0])).alias("sentiment_score"),
        F.coalesce(F.when(F.col("rank").isNotNull(), F.col("_label")), F.lit(neutral[1])).alias("sentiment_label"),
    )
