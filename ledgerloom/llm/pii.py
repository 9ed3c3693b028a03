"""Personal data in whole texts: patterns propose, validators confirm, context scores.

All of it is built of SQL functions. A pattern yields its matches and, by splitting, the
gaps between them; running sums over both give positions in code points. Matches are
leftmost and do not overlap within a kind.

The patterns are written so that Java's matcher neither recurses per character nor starts
anew inside a run it has passed, so a text of one long run takes linear time. Where a rule
needs a repeated group, the run is proposed as a character class and taken apart after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# Patterns as the rules state them, in their order.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# The same matches without backtracking into runs and without repeated groups.
EMAIL_RUN = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
    r"[A-Za-z0-9.-]+?(?=\.\.|\.?(?![A-Za-z0-9.-]))"
)
IP_RUN = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD_RUN = r"(?<![0-9])[0-9][0-9\x20-]{14,}[0-9]"
CARD_BREAK = r"[\x20-]{2,}"
IP_PART = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Kinds that the method adds.
IBAN = r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])"
SSN = r"(?<![0-9A-Za-z_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z_-])"

#: Words within CONTEXT code points before a span that raise its score.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": "mail|contact|write to",
    "ip": "address|server|host|login",
    "card": "card|visa|master|payment|credit",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|transfer",
    "ssn": "ssn|social security|tax id|insurance number",
}
#: Score of a confirmed span without and with context words; spans below KEEP_FROM go,
#: save those of the first four kinds, which always stay.
SCORES = {
    "email": (0.9, 1.0),
    "ip": (0.6, 0.9),
    "card": (0.8, 1.0),
    "phone": (0.7, 1.0),
    "iban": (0.8, 1.0),
    "ssn": (0.3, 0.8),
}
KEEP_FROM = 0.5
BASE = ("email", "ip", "card", "phone")
SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,score:double>"


def _located(text: Column, pattern: str, start: Column) -> Column:
    """Array of (gap, gap_at, hit, hit_at): gaps and matches in turn; the last hit is null."""
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
    )
    kind = "struct<gap:string,gap_at:bigint,hit:string,hit_at:bigint>"
    empty = F.struct(start.cast("bigint").alias("at"), F.array().cast(f"array<{kind}>").alias("all"))

    def add(done: Column, pair: Column) -> Column:
        gap, hit = pair["gap"], pair["hit"]
        hit_at = done["at"] + F.length(gap)
        here = F.struct(
            gap.alias("gap"), done["at"].alias("gap_at"), hit.alias("hit"), hit_at.alias("hit_at")
        )
        after = hit_at + F.coalesce(F.length(hit), F.lit(0))
        return F.struct(
            after.cast("bigint").alias("at"), F.concat(done["all"], F.array(here)).alias("all")
        )

    return F.aggregate(pairs, empty, add, lambda done: done["all"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check sum of a string of digits is right."""

    def add(total: Column, pair: Column) -> Column:
        doubled = 2 * pair["d"]
        twice = F.when(doubled > 9, doubled - 9).otherwise(doubled)
        return total + F.when(pair["i"] % 2 == 1, twice).otherwise(pair["d"])

    figures = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")),
    )
    return F.aggregate(figures, F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """True if an account number, country code first, has the remainder 1."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise(
            (rest * 10 + code - 48) % 97
        )

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _confirmed(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike("^" + r"\.".join([IP_PART] * 4) + "$")
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return mod97(value) if kind == "iban" else F.lit(True)


def _spans(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind, in order, with their scores."""
    runs = {"email": EMAIL_RUN, "ip": IP_RUN, "card": CARD_RUN, "phone": PHONE}
    hits = F.filter(
        _located(text, runs.get(kind) or {"iban": IBAN, "ssn": SSN}[kind], F.lit(0)),
        lambda p: p["hit"].isNotNull(),
    )
    if kind == "card":  # a run holds several numbers if two separators meet in it
        parts = F.flatten(
            F.transform(hits, lambda p: _located(p["hit"], CARD_BREAK, p["hit_at"]))
        )
        found = F.transform(
            parts, lambda p: F.struct(p["gap"].alias("value"), p["gap_at"].alias("at"))
        )
    else:
        found = F.transform(
            hits, lambda p: F.struct(p["hit"].alias("value"), p["hit_at"].alias("at"))
        )
    alone, told = SCORES[kind]

    def span(p: Column) -> Column:
        near = F.lower(
            text.substr(
                F.greatest(p["at"] - CONTEXT, F.lit(0)).cast("int") + 1,
                F.least(p["at"], F.lit(CONTEXT)).cast("int"),
            )
        )
        score = F.when(near.rlike(CONTEXT_WORDS[kind]), F.lit(told)).otherwise(F.lit(alone))
        return F.struct(
            F.lit(kind).alias("kind"),
            p["at"].cast("bigint").alias("start"),
            (p["at"] + F.length(p["value"])).cast("bigint").alias("end"),
            p["value"].alias("value"),
            score.alias("score"),
        )

    return F.transform(F.filter(found, lambda p: _confirmed(kind, p["value"])), span)


#: What a text must hold for a kind to be looked for.
HINTS = {"email": "@", "phone": "+", "ssn": "-", "ip": "."}


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans``: array of (kind, start, end, value, score), by kind as listed, then start.

    start and end count code points from 0, the end is exclusive. A null or empty text has
    an empty array. Spans of different kinds may overlap. Other columns stay as they are;
    a column named ``spans`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    by_kind = {
        kind: F.when(
            F.contains(whole, F.lit(HINTS[kind])) if kind in HINTS else whole.rlike("[0-9]"),
            _spans(kind, whole),
        ).otherwise(none)
        for kind in SCORES
    }
    kept = {
        kind: spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= KEEP_FROM)
        for kind, spans in by_kind.items()
    }
    return df.withColumn("spans", F.concat(*kept.values()))


def mask(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlaps are one."""
    whole = F.coalesce(text, F.lit(""))
    ordered = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k"))
        )
    )
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def add(done: Column, s: Column) -> Column:
        at, out = done["at"], done["out"]
        before = whole.substr((at + 1).cast("int"), (s["s"] - at).cast("int"))
        longer = F.concat(out, before, F.lit("<"), F.upper(s["k"]), F.lit(">"))
        return F.struct(
            F.greatest(at, s["e"]).alias("at"),
            F.when(s["s"] >= at, longer).otherwise(out).alias("out"),
        )

    masked = F.aggregate(
        ordered,
        empty,
        add,
        lambda done: F.concat(
            done["out"], whole.substr((done["at"] + 1).cast("int"), F.length(whole))
        ),
    )
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def joined(spans: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans as kind:start:end, comma-joined."""
    told = F.transform(
        F.filter(spans, keep) if keep else spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(told, ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def is_base(span: Column) -> Column:
    return span["kind"].isin(*BASE)
