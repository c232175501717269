"""Personal data: patterns propose spans, checksums confirm them, context weighs them.

Everything is a SQL function. The patterns are written so that they find the
same leftmost matches as the plain ones in their comments, in time that grows
with the text: runs are taken possessively and a match starts only where a run
starts.

Base kinds (email, ip, card, phone) are reported whenever their check holds.
The other spans need their checksum or format and enough evidence around them:
an IBAN has its country's length and passes mod-97; a card of 13 to 15 digits passes Luhn and a social
security number has its format, and both need a context word.

Null text counts as empty, and empty text has no spans. Equal rows are judged
one by one. An empty table gives an empty result; columns other than the id
and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lodestar.llm.common import column
from lodestar.llm.spans import FEW, excerpt, located, matches, parts_of, written


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(backwards, place, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number passes the ISO 7064 check: letters count 10 to 35."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4))

    def add(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise(
            (rest * 100 + code - 55) % 97
        )

    places = F.sequence(F.lit(1), F.char_length(moved))
    return F.aggregate(places, F.lit(0), add) == 1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.char_length(digits).between(16, 19) & luhn(digits)


def _short_card(match: Column) -> Column:
    digits = _digits(match)
    return F.char_length(digits).between(13, 15) & luhn(digits)


# A number from 0 to 255, with any zeros before it.
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


#: Characters of an IBAN by country, of the registry and those in use beside it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """An IBAN as group 1, of which only the first four characters are taken.

    So a code before an IBAN cannot swallow it. Words in capitals may follow. An unknown
    country's number ends where the run of capitals and digits does.
    """
    known = [
        rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}"
        for length, codes in IBAN_LENGTHS.items()
    ]
    listed = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    other = rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+"
    whole = rf"((?:{'|'.join([*known, other])})(?![A-Za-z0-9]))"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?={whole})[A-Z]{{2}}[0-9]{{2}}"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data; ``base`` kinds need no evidence beyond their check.

    With ``taken`` a pattern takes that many characters, and the match is its group 1.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    needs: str | None = None
    base: bool = True
    score: float = 0.6
    context: str = ""
    taken: int | None = None


KINDS = [
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        needs="@",
        score=0.8,
        context="mail|contact|write|kontakt|correo",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: F.regexp_like(m, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        needs=".",
        context="address|host|server|login|ip",
    ),
    # [0-9]([\x20-]?[0-9])+ of 16 to 19 digits; shorter and longer runs would fail anyway
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
        _card,
        score=0.8,
        context="card|visa|credit|karte|carte|tarjeta",
    ),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.char_length(_digits(m)).between(8, 15),
        needs="+",
        context="phone|call|tel|mobile|fax",
    ),
]

#: Kinds of the method itself; a card of 13 to 15 digits is a card like the others.
MORE = [
    Kind(
        "iban",
        _iban(),
        lambda m: mod_97(F.replace(m, F.lit(" "), F.lit(""))),
        base=False,
        score=0.8,
        context="iban|account|konto|compte|cuenta",
        taken=4,
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
        _short_card,
        base=False,
        score=0.4,
        context="card|visa|amex|credit|karte|carte|tarjeta",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True),
        base=False,
        score=0.4,
        context="ssn|social",
    ),
]

#: Code points before and after a span in which context words count.
NEARBY = 40
#: What a context word adds, and what a span that is not of a base kind needs.
CONTEXT_SCORE, LEAST_SCORE = 0.2, 0.5


def _scored(text: Column, parts: Column, kind: Kind, spans: Column) -> Column:
    """Spans as structs of kind, start, end, score and whether they are base spans."""

    def weigh(span: Column) -> Column:
        begin = F.greatest(span["start"] - NEARBY, F.lit(0))
        before = excerpt(text, parts, begin, span["start"] - begin)
        after = excerpt(text, parts, span["end"], F.lit(NEARBY))
        words = F.lit(rf"(?i)(?:^|[^\p{{L}}])(?:{kind.context})")
        near = F.regexp_like(F.concat_ws(" ", before, after), words)
        score = F.lit(kind.score) + F.when(near, CONTEXT_SCORE).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            F.round(score, 2).alias("score"),
            F.lit(kind.base).alias("base"),
        )

    scored = F.transform(spans, weigh)
    return scored if kind.base else F.filter(scored, lambda s: s["score"] >= LEAST_SCORE)


def find_personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document with ``spans``: kind, start, end, score and base, in order.

    Spans are ordered by kind (base kinds first), then by start.
    """
    kinds = [*KINDS, *MORE]
    text = F.col("_text")
    rows = docs.select(
        column(docs, id_column).alias("_id"),
        F.coalesce(column(docs, text_column), F.lit("")).alias("_text"),
    )
    proposed = rows.select(
        "_id",
        "_text",
        *(
            matches(
                text,
                k.pattern,
                F.contains(text, F.lit(k.needs)) if k.needs else None,
                1 if k.taken else 0,
            ).alias(f"_found{i}")
            for i, k in enumerate(kinds)
        ),
    )
    confirmed = proposed.select(
        "_id",
        "_text",
        *(
            located(text, F.col(f"_found{i}"), k.pattern, k.valid, k.taken).alias(f"_spans{i}")
            for i, k in enumerate(kinds)
        ),
    )
    spans = [F.col(f"_spans{i}") for i in range(len(kinds))]
    many = reduce(lambda a, b: a + b, (F.size(s) for s in spans)) > FEW
    confirmed = confirmed.withColumn("_parts", parts_of(text, many))
    names = list(dict.fromkeys(k.name for k in kinds))
    by_kind = []
    for name in names:
        scored = [_scored(text, F.col("_parts"), k, spans[i]) for i, k in enumerate(kinds) if k.name == name]
        if len(scored) == 1:
            by_kind += scored
        else:
            merged = F.concat(*scored)
            by_kind.append(
                F.array_sort(merged, lambda a, b: a["start"] - b["start"])
            )
    return confirmed.select(F.col("_id").alias(id_column), F.concat(*by_kind).alias("spans"))


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts and a digest of the base spans, and all spans as text, per document."""
    found = find_personal_data(docs)
    base = F.filter("spans", lambda s: s["base"])

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == name))).cast("long")

    return found.select(
        "doc_id",
        *(count(k.name).alias(f"n_{k.name}") for k in KINDS),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"),
    )
