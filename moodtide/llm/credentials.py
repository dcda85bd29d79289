"""Secrets in texts, and credentials whose parts are told apart only by standing together.

Assignments, access keys and long hexadecimal strings are found by fixed rules and always stay. A user
name, a password-like value, a random-looking token or an address of a service says little alone:
such weak parts are reported only where a part that complements them lies within ``SCOPE`` code points.

The parts' positions, without texts, are shuffled by document; the join of each part with the
interval around it makes no pairs: near are those that begin by its end and ``SCOPE`` more, less those that
end over ``SCOPE`` before it, and both are running counts in range windows over the parts' ends, each part
standing there twice. A window's group is one document's parts, so its size is bounded by a text's, and rows alike are told once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm.common import stored, worked_out
from moodtide.llm.spans import counted, find, tagged, written

# What the exact spans are.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
BASE = ("assign", "access", "hex")
LEAST_ASSIGNED = 6

SCOPE = 200
WEAK = ("identifier", "credential", "token", "endpoint")
LOOSE = {
    "identifier": r"""(?<![A-Za-z0-9])(?i:user(?:_?name)?|login|client_?id|account_?(?:id|name)?|access_?key(?:_?id)?)["']?\x20?[:=]\x20?["']?"""
    r"[A-Za-z0-9._@-]{3,}+",
    "credential": r"""(?<![A-Za-z0-9])(?i:pwd|pass|passphrase|credential|private_?key|auth)["']?\x20?[:=]\x20?["']?[^\s"']{6,}+""",
    "token": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}+",
    "endpoint": r"(?i:https?|ftps?|ssh|jdbc:[a-z]{2,}|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]++",
}
# What each part is, and which of the others must be near a weak one: any of a group, of every group.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "identifier": "id", "credential": "secret", "token": "secret",
        "endpoint": "place"}
COMPLEMENT = {"id": (("secret",),), "secret": (("id", "place"),), "place": (("id",), ("secret",))}


def base_spans(text: Column) -> dict[str, Column]:
    """The exact spans of each kind."""
    values = F.filter(
        find(text, ASSIGN, text.rlike(r"(?i:passw|secret|token|api_?key)")),
        lambda x: F.length(F.regexp_extract(x["match"], f"^(?:{ASSIGN})", 1)) >= LEAST_ASSIGNED,
    )
    return {
        "assign": values,
        "access": find(text, ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": find(text, HEX, text.rlike("[0-9a-f]{24}")),
    }


def weak_spans(text: Column) -> dict[str, Column]:
    """The loose matches of each weak kind."""
    needs = {
        "identifier": text.rlike("(?i:user|login|client|account|access)[A-Za-z_]{0,8}[\"']?\\x20?[:=]"),
        "credential": text.rlike("(?i:pwd|pass|phrase|credential|key|auth)[\"']?\\x20?[:=]"),
        "token": text.rlike("[A-Za-z0-9+/_-]{20}"),
        "endpoint": F.contains(text, F.lit("://")),
    }
    return {kind: find(text, LOOSE[kind], needs[kind]) for kind in WEAK}


def detected(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` and ``_base``, all exact spans, and ``_weak``, all loose ones."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = worked_out(rows, **{f"_{kind}": found for kind, found in base_spans(text).items()})
    exact = F.concat(*[tagged(F.col(f"_{kind}"), kind, rank) for rank, kind in enumerate(BASE)])
    out = worked_out(out, _base=exact).drop(*[f"_{kind}" for kind in BASE])
    weak = F.concat(*[tagged(found, kind, rank + len(BASE)) for rank, (kind, found) in enumerate(weak_spans(text).items())])
    return worked_out(out, _weak=weak)


def clear(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Parts without the loose ones that share text with an exact one, by running bounds along the text: no part is
    compared with all others."""
    base = ~F.col("kind").isin(*WEAK)
    ordered = Window.partitionBy(*keys).orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, -1)
    turned = Window.partitionBy(*keys).orderBy(F.desc("start"), F.desc("rank"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max(F.when(base, F.col("end"))).over(ordered), F.col("start"))
    after = F.coalesce(F.min(F.when(base, F.col("start"))).over(turned), F.col("end"))
    bound = parts.withColumns({"_before": before, "_after": after})
    return bound.filter(base | (F.col("_before") <= F.col("start")) & (F.col("_after") >= F.col("end"))).select(*parts.columns)


def linked(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Weak parts with a complement at most ``SCOPE`` code points before or after them, from ``keys, start, rank, kind, end``.
    What shares text with a part is no complement of it."""
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[F.col("kind")]
    rows = clear(parts.distinct(), keys).withColumn("role", role)
    # Each part at its start (``_side`` 0) and at its end.
    sides = rows.select("*", F.posexplode(F.array("start", "end")).alias("_side", "_at"))
    place = Window.partitionBy(*keys).orderBy("_at")
    is_of = lambda r, side: ((F.col("role") == r) & (F.col("_side") == side)).cast("int")
    counts = {
        # What begins from the part's end on, and what has ended by its start.
        f"_near_{r}": F.when(F.col("_side") == 1, F.sum(is_of(r, 0)).over(place.rangeBetween(0, SCOPE)))
        .otherwise(F.sum(is_of(r, 1)).over(place.rangeBetween(-SCOPE, 0)))
        for r in COMPLEMENT
    }
    told = sides.withColumns(counts)
    rows = told.groupBy(*parts.columns, "role").agg(*[F.sum(name).alias(name) for name in counts])
    fits = F.lit(False)
    for r, groups in COMPLEMENT.items():
        every = F.col("role") == r
        for group in groups:
            some = F.lit(False)
            for other in group:
                some = some | (F.col(f"_near_{other}") > 0)
            every = every & some
        fits = fits | every
    return rows.filter(F.col("kind").isin(*WEAK) & fits).select(*parts.columns)


def secrets_found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``: one row per row of ``docs``.

    Null and empty texts have no spans. What is linked depends on a text alone, so rows may repeat and
    share an id, which may be null. Spans are in code points, the end exclusive. An empty table gives
    no rows; other columns are not read.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # By id and text: what a text holds is told for each document, and for rows alike once.
    hashed = narrow.withColumn("_key", F.md5(F.concat_ws(":", F.col("doc_id"), F.col("text")).cast("binary")))
    found = stored(detected(hashed, "text").select("doc_id", "_key", "_base", "_weak"), "secrets-found")
    some = found.filter(F.size("_weak") > 0)
    links = linked(some.select("_key", F.inline(F.concat("_base", "_weak"))), ["_key"])
    spans = links.groupBy(F.col("_key").alias("_of")).agg(
        F.collect_list(F.struct("start", "rank", "kind", "end")).alias("_linked")
    )
    joined = found.join(stored(spans, "secrets-linked"), F.col("_key") == F.col("_of"), "left")
    everything = F.when(F.col("_linked").isNull(), F.col("_base")).otherwise(F.concat("_base", "_linked"))
    counts = [counted("_base", kind).alias(f"n_{kind}") for kind in BASE]
    return joined.select(
        "doc_id", *counts, F.sha2(written(F.col("_base")), 256).alias("base_sha256"), written(everything).alias("spans")
    )
