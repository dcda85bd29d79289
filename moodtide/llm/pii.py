"""Personal data: exact patterns, and weakly supervised spans beside them.

E-mail, IP, card and phone spans are found by fixed rules and always stay. Looser candidates (numbers
in groups, written-out addresses, titles with names, account numbers) are voted on by labelers: a
strict pattern, a gazetteer, words before the span, its shape, and exact spans nearby. Votes are for,
against or none. Expectation-maximisation learns how reliable each labeler is from how they agree
over the whole corpus, and a logistic classifier over votes and shape is fitted to what it believes.

Both need only how often each pattern of votes and shape occurs: a table whose size the labelers
bound (``KINDS * 3**5 * SHAPES`` rows), whatever the corpus. All else is column expressions over a row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from moodtide.llm.common import stored, worked_out
from moodtide.llm.spans import counted, cut, digits, find, let, part, running, tagged, written

# What the exact spans are.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BASE = ("email", "ip", "card", "phone")
KINDS = ("number", "account", "address", "name")
LOOSE = {
    "number": r"(?<![0-9A-Za-z+.,-])\(?[0-9]{2,5}\)?(?:[\x20./-][0-9]{2,5}){1,4}+(?![0-9A-Za-z])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
    "address": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]++"
    r"\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z]{2,}+",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?",
}
STRICT = {
    "number": r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "account": r"^(?:DE[0-9]{20}|FR[0-9]{12}[A-Z0-9]{11}[0-9]{2}|ES[0-9]{22}|GB[0-9]{2}[A-Z]{4}[0-9]{14})$",
    "address": r"(?:\(at\)|\[at\]).*(?:\(dot\)|\[dot\])",
    "name": r"^\p{L}+\.?\x20\p{Lu}\p{Ll}+\x20\p{Lu}\p{Ll}+$",
}
# Gazetteers: toll-free and common area codes, countries of account numbers, top-level domains, given names.
GAZETTEER = {
    "number": r"^\(?(?:800|888|877|866|212|213|310|312|415|617|650|718)\)?(?![0-9])",
    "account": r"^(?:AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PL|PT)",
    "address": r"(?i)(?:com|org|net|edu|de|fr|es|info)$",
    "name": r"\x20(?:Anna|Carlos|David|Hans|Jean|John|José|Maria|Marie|Mary|Michael|Peter|Pierre|Robert)(?!\p{L})",
}
CUES = {
    "number": r"(?i)(?:tel|phone|call|mobile|fax|telefon|teléfono|téléphone|ssn|social security)[^0-9]{0,12}$",
    "account": r"(?i)(?:iban|account|konto|cuenta|compte)[^0-9]{0,12}$",
    "address": r"(?i)(?:mail|contact|write|schreib|escrib|courriel)\p{L}*[^\p{L}]{0,4}(?:me|us|to)?[^\p{L}]{0,4}$",
    "name": r"(?i)(?:signed|sincerely|dear|regards|contact|name|by)[^\p{L}]{0,4}$",
}
AGAINST = r"(?i)(?:version|page|isbn|issn|chapter|section|figure|table|price|order|[#$€£%=])[^\p{L}0-9]{0,3}$"
VOTES = ("strict", "gazetteer", "cue", "shape", "near")
NEAR = 100
# Beyond all places of a text.
FAR = 1 << 30
# Candidates have a length class of 0 to 3 and as many separators, 0 to 3.
SHAPES = 16
ROUNDS = 50
STEPS = 400
THRESHOLD = 0.5


def _valid_ip(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda part: part.cast("double") <= 255)


def _valid_card(match: Column) -> Column:
    def luhn(d: Column) -> Column:
        doubled = lambda i: F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
        folded = F.transform(
            F.sequence(F.lit(0), F.length(d) - 1), lambda i: let(doubled(i), lambda v: F.when(v > 9, v - 9).otherwise(v))
        )
        return F.aggregate(folded, F.lit(0), lambda a, x: a + x) % 10 == 0

    return let(digits(match), luhn)


def base_spans(text: Column) -> dict[str, Column]:
    """The exact spans of each kind."""
    numbers = text.rlike("[0-9]")
    return {
        "email": find(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(find(text, IP, numbers), lambda x: _valid_ip(x["match"])),
        "card": F.filter(find(text, CARD, numbers), lambda x: _valid_card(x["match"])),
        "phone": F.filter(
            find(text, PHONE, F.contains(text, F.lit("+"))), lambda x: F.length(digits(x["match"])).between(9, 15)
        ),
    }


def _vote(good: Column, bad: Column | None = None) -> Column:
    vote = F.when(good, F.lit(1))
    return (vote if bad is None else vote.when(bad, F.lit(-1))).otherwise(F.lit(0))


def loose_spans(text: Column) -> dict[str, Column]:
    """The loose matches of each kind."""
    needs = {"number": text.rlike("[0-9][\\x20./)-]+[0-9]"), "account": text.rlike("[A-Z]{2}[0-9]{2}")}
    needs["address"] = text.rlike(r"(?:\(at\)|\[at\]|\x20at\x20)")
    needs["name"] = text.rlike(r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.?\x20\p{Lu}")
    return {kind: find(text, LOOSE[kind], needs[kind]) for kind in KINDS}


def bounded(rows: DataFrame) -> DataFrame:
    """``rows`` and ``_placed``: ``x, before, after`` for every loose match, which are where the exact spans that start no
    later end at the latest, and where the first that starts no earlier starts. All are sorted together and the bounds
    carried along, so that no match is held against all exact spans of a text."""

    def marks(column: str, own: int) -> Column:
        told = (lambda x, name: x[name]) if own else (lambda x, name: F.lit(None).cast("string"))
        return F.transform(
            column,
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(own).alias("own"), x["end"].alias("end"),
                told(x, "match").alias("match"), told(x, "before").alias("before"),
            ),
        )

    # Of equal starts the exact span comes first.
    everything = F.concat(marks("_base", 0), *[marks(f"_{kind}", rank + 1) for rank, kind in enumerate(KINDS)])
    some = reduce(lambda a, b: a | b, [F.size(f"_{kind}") > 0 for kind in KINDS])
    order = worked_out(rows, _order=F.when(some, F.sort_array(everything)).otherwise(F.slice(everything, 1, 0)))
    order = worked_out(order, _turned=F.reverse("_order"))
    ends = lambda at, x: F.when(x["own"] == 0, F.greatest(at, x["end"])).otherwise(at)
    starts = lambda at, x: F.when(x["own"] == 0, F.least(at, x["start"])).otherwise(at)
    known = worked_out(
        order, _before=running(F.col("_order"), F.lit(-FAR), ends), _after=running(F.col("_turned"), F.lit(FAR), starts)
    )
    sides = F.zip_with("_before", F.reverse("_after"), lambda b, a: F.struct(b.alias("before"), a.alias("after")))
    both = F.zip_with("_order", sides, lambda x, s: F.struct(x.alias("x"), s["before"].alias("before"), s["after"].alias("after")))
    placed = worked_out(known, _placed=F.filter(both, lambda p: p["x"]["own"] > 0))
    return placed.drop("_order", "_turned", "_before", "_after", *[f"_{kind}" for kind in KINDS])


def _candidates(rank: int, kind: str) -> Column:
    """``kind, start, end``, the votes and the shape of a kind's loose matches clear of exact spans."""
    clear = F.filter(
        "_placed",
        lambda p: (p["x"]["own"] == rank + 1) & (p["before"] <= p["x"]["start"]) & (p["after"] >= p["x"]["end"]),
    )

    def voted(p: Column) -> Column:
        x = p["x"]
        match, before, n = x["match"], x["before"], F.length(digits(x["match"]))
        shape = _vote(n.between(9, 11), (n < 7) | (n > 15)) if kind == "number" else _vote(F.length(match) >= 8)
        near = (x["start"] - p["before"] < NEAR) | (p["after"] - x["end"] < NEAR)
        separators = F.length(match) - F.length(F.regexp_replace(match, "[\\x20./()\\[\\]-]", ""))
        return F.struct(
            F.lit(kind).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            _vote(match.rlike(STRICT[kind]), F.lit(kind == "account")).alias("strict"),
            _vote(match.rlike(GAZETTEER[kind]), F.lit(kind == "address")).alias("gazetteer"),
            _vote(before.rlike(CUES[kind]), before.rlike(AGAINST)).alias("cue"),
            shape.alias("shape"),
            _vote(near).alias("near"),
            F.least(F.floor(F.length(match) / 8).cast("int"), F.lit(3)).alias("long"),
            F.least(separators, F.lit(3)).alias("separators"),
        )

    return F.transform(clear, voted)


def detected(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` and ``_base``, all exact spans, and ``_loose``, the candidates with their votes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = worked_out(rows, **{f"_{kind}": found for kind, found in base_spans(text).items()})
    exact = F.concat(*[tagged(F.col(f"_{kind}"), kind, rank) for rank, kind in enumerate(BASE)])
    out = worked_out(out, _base=exact).drop(*[f"_{kind}" for kind in BASE])
    placed = bounded(worked_out(out, **{f"_{kind}": found for kind, found in loose_spans(text).items()}))
    return worked_out(placed, _loose=F.concat(*[_candidates(rank, kind) for rank, kind in enumerate(KINDS)])).drop("_placed")


def agreed(patterns: list[Row]) -> list[float]:
    """How likely each pattern of votes is a true span: two classes, labelers independent within
    one, a reliability per kind, labeler, class and vote."""
    share = {kind: 0.5 for kind in KINDS}
    # At first a vote is taken at its word three times out of four.
    rate = {
        (kind, name, truth, vote): 0.6 if vote == (1 if truth else -1) else 0.2
        for kind in KINDS for name in VOTES for truth in (0, 1) for vote in (-1, 0, 1)
    }
    belief = [0.5] * len(patterns)
    for _ in range(ROUNDS):
        for i, row in enumerate(patterns):
            odds = math.log(share[row.kind] / (1 - share[row.kind]))
            for name in VOTES:
                odds += math.log(rate[row.kind, name, 1, row[name]] / rate[row.kind, name, 0, row[name]])
            belief[i] = 1 / (1 + math.exp(-max(-500, min(500, odds))))
        for kind in KINDS:
            mine = [(row, b) for row, b in zip(patterns, belief, strict=True) if row.kind == kind]
            mass = {truth: sum(row.n * (b if truth else 1 - b) for row, b in mine) for truth in (0, 1)}
            share[kind] = (mass[1] + 1) / (mass[0] + mass[1] + 2)
            for name in VOTES:
                for truth in (0, 1):
                    for vote in (-1, 0, 1):
                        sure = sum(row.n * (b if truth else 1 - b) for row, b in mine if row[name] == vote)
                        prior = 3 if vote == (1 if truth else -1) else 1
                        rate[kind, name, truth, vote] = (sure + prior) / (mass[truth] + 5)
    return belief


def _inputs(row) -> dict[str, float | Column]:
    return {**{name: row[name] for name in VOTES}, "long": row["long"], "separators": row["separators"]}


def classifier(patterns: list[Row]) -> dict[str, float]:
    """Weights of a logistic classifier fitted to what the labelers agree on; empty without candidates."""
    if not patterns:
        return {}
    belief, total = agreed(patterns), sum(row.n for row in patterns)
    names = ["bias", *KINDS, *_inputs(patterns[0])]
    rows = [
        ([1.0, *[float(row.kind == kind) for kind in KINDS], *map(float, _inputs(row).values())], b, row.n / total)
        for row, b in zip(patterns, belief, strict=True)
    ]
    weights, slopes = [0.0] * len(names), [1e-6] * len(names)
    for _ in range(STEPS):
        slope = [1e-4 * w for w in weights]
        for x, b, n in rows:
            miss = n * (1 / (1 + math.exp(-max(-500, min(500, sum(w * v for w, v in zip(weights, x, strict=True)))))) - b)
            for i, v in enumerate(x):
                slope[i] += miss * v
        for i, s in enumerate(slope):
            slopes[i] += s * s
            weights[i] -= 0.5 * s / math.sqrt(slopes[i])
    return dict(zip(names, weights, strict=True))


def learnt(found: DataFrame) -> dict[str, float]:
    """The classifier from ``_loose`` candidates of the whole corpus: one count per pattern."""
    candidates = found.select(F.inline("_loose"))
    counted = candidates.groupBy("kind", *VOTES, "long", "separators").agg(F.count("*").alias("n"))
    return classifier(sorted(counted.collect()))


def accepted(loose: Column, weights: dict[str, float]) -> Column:
    """The candidates that the classifier takes, as tagged spans."""
    if not weights:
        return F.array().cast("array<struct<start: int, rank: int, kind: string, end: int>>")

    def taken(x: Column) -> Column:
        terms = [F.lit(weights[name]) * value for name, value in _inputs(x).items()]
        terms += [F.when(x["kind"] == kind, F.lit(weights[kind])).otherwise(F.lit(0.0)) for kind in KINDS]
        return reduce(lambda a, b: a + b, terms, F.lit(weights["bias"])) >= math.log(THRESHOLD / (1 - THRESHOLD))

    return F.transform(
        F.filter(loose, taken),
        lambda x: F.struct(
            x["start"].alias("start"),
            (F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).cast("int") + len(BASE) - 1).alias("rank"),
            x["kind"].alias("kind"),
            x["end"].alias("end"),
        ),
    )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``: one row per row of ``docs``.

    Null and empty texts have no spans. Rows may repeat; each is told. Spans are in code points, the
    end exclusive. An empty table gives no rows; other columns are not read. A text of any length takes time in
    proportion to it and its spans.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(detected(narrow, "text").select("doc_id", "_base", "_loose"), "pii-found")
    extra = accepted(F.col("_loose"), learnt(found))
    counts = [counted("_base", kind).alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(written(F.col("_base")), 256).alias("base_sha256"),
        written(F.concat("_base", extra)).alias("spans"),
    )


def masked(rows: DataFrame, text_col: str, spans: Column) -> DataFrame:
    """``rows`` and ``_clean``, the text with every span replaced by its kind in brackets; of overlapping ones the first
    names them. A text is cut into pieces first, so that its spans take no time but their own and the gaps'."""
    text = F.col(text_col)
    out = worked_out(rows, _spans=F.sort_array(spans))
    out = worked_out(
        out,
        _reached=running(F.col("_spans"), F.lit(0), lambda at, s: F.greatest(at, s["end"])),
        _pieces=F.when(F.size("_spans") > 0, cut(text)),
    )
    # Each span with where those before it end: what lies between stays, and a span that begins before that is not named.
    earlier = F.concat(F.array(F.lit(0)), F.slice("_reached", F.lit(1), F.size("_reached") - 1))
    both = F.zip_with("_spans", earlier, lambda s, at: F.struct(s.alias("s"), at.alias("at")))
    named = F.transform(
        F.filter(both, lambda e: e["s"]["start"] >= e["at"]),
        lambda e: F.concat(part(F.col("_pieces"), e["at"], e["s"]["start"]), F.lit("["), F.upper(e["s"]["kind"]), F.lit("]")),
    )
    whole = F.concat(F.array_join(named, ""), part(F.col("_pieces"), F.element_at("_reached", -1), F.length(text)))
    clean = F.when(F.size("_spans") > 0, whole).otherwise(text)
    return worked_out(out, _clean=clean).drop("_spans", "_reached", "_pieces")


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked and, if there is one, the length column brought up to date.
    The texts are read twice, as nothing but counts is kept of the first reading. A null text stays null. Rows may repeat; each
    is told. An empty table gives no rows; a text of any length takes time in proportion to it and its spans."""
    weights = learnt(detected(docs.select(F.col(text_col).alias("text")), "text"))
    # Columns go by their place meanwhile, whatever they are called.
    places = {name: f"c{place}" for place, name in enumerate(docs.columns)}
    text = places[text_col]
    found = detected(docs.toDF(*places.values()), text)
    clean = masked(found, text, F.concat("_base", accepted(F.col("_loose"), weights)))
    columns = []
    for name, place in places.items():
        value = F.col(place)
        if name == text_col:
            value = F.col("_clean")
        elif name == length_col:
            value = F.length("_clean").cast(dict(docs.dtypes)[name])
        columns.append(value.alias(name))
    return clean.select(*columns)
