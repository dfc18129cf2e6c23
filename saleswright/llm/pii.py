"""Personal data: patterns propose, checksums confirm, context adjusts.

Built-in SQL functions only. Matches are found without positions: a pattern's
matches are fenced by a mark, the text is split at the marks, and running sums
of the piece lengths give each match its place in code points. Running sums go
by blocks, so a text with many matches costs about linear time. Patterns are
possessive and start only where a run of their characters does, so that no text
makes them backtrack without end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_or_empty

# Fixed values. U+FDD0 and U+FDD2 are noncharacters: the mark, and what stands in
# for a mark that was already in the text.
MARK, STAND_IN = "\ufdd0", "\ufdd2"

_LOCAL = "[A-Za-z0-9._%+-]"
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9]?)"

# What each kind looks like.
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = (
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"
    r"(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
NATIONAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# How sure a confirmed match is, and the words nearby that make it
# surer. Kinds that are not always personal data count from ACCEPT up only.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "short_card", "national_id")
SURE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "short_card": 0.5, "national_id": 0.5}
NEAR = {
    "email": "mail|contact|write to|kontakt|correo|courriel",
    "ip": "address|host|server|login|client|adresse",
    "card": "card|visa|mastercard|credit|debit|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|anruf|llam|appel",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "short_card": "card|visa|amex|american express|diners|credit|karte|tarjeta|carte",
    "national_id": "ssn|social security|taxpayer|national id|identity",
}
AGAINST = "order|invoice|version|isbn|serial|build|part no|model"
NEARBY = 40
BONUS, MALUS, ACCEPT = 0.2, 0.2, 0.7
_BLOCK = 512


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """SQL: the digits, taken from the right, pass Luhn."""
    value = f"cast(substr(reverse({digits}), i, 1) AS int)"
    term = f"CASE WHEN i % 2 = 1 THEN {value} ELSE {value} * 2 - CASE WHEN {value} > 4 THEN 9 ELSE 0 END END"
    return f"aggregate(transform(sequence(1, length({digits})), i -> {term}), 0, (a, x) -> a + x) % 10 = 0"


def _mod97(code: str) -> str:
    """SQL: the account number, first four characters moved to the end, leaves 1 modulo 97."""
    turned = f"concat(substr({code}, 5), substr({code}, 1, 4))"
    one = f"instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr({turned}, i, 1)) - 1"
    step = "(a, x) -> (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97"
    return f"aggregate(transform(sequence(1, length({code})), i -> {one}), 0, {step}) = 1"


_ONLY_DIGITS = "regexp_replace(m.value, '[^0-9]', '')"
_NO_BLANKS = "replace(m.value, ' ', '')"

VALID = {
    "email": "true",
    "ip": rf"m.value RLIKE {_quoted(rf'^{_BYTE}(?:\.{_BYTE}){{3}}$')}",
    "card": f"CASE WHEN length({_ONLY_DIGITS}) BETWEEN 16 AND 19 THEN {_luhn(_ONLY_DIGITS)} ELSE false END",
    "phone": f"length({_ONLY_DIGITS}) BETWEEN 8 AND 15",
    "iban": f"CASE WHEN length({_NO_BLANKS}) BETWEEN 15 AND 34 THEN {_mod97(_NO_BLANKS)} ELSE false END",
    "short_card": f"CASE WHEN length({_ONLY_DIGITS}) BETWEEN 13 AND 15 THEN {_luhn(_ONLY_DIGITS)} ELSE false END",
    "national_id": "m.value NOT RLIKE '^(?:000|666|9..)|-00-|-0000$'",
}
#: Kinds by the pattern that proposes them.
PATTERNS = {
    "email": (EMAIL, ("email",)),
    "ip": (IP, ("ip",)),
    "digits": (DIGITS, ("card", "short_card")),
    "phone": (PHONE, ("phone",)),
    "iban": (IBAN, ("iban",)),
    "national": (NATIONAL, ("national_id",)),
}
SPAN = "struct<kind:string,start:int,end:int,value:string,score:double>"


def _starts(lengths: str) -> str:
    """SQL: where each piece starts, from an array of lengths, by blocks."""
    blocks = f"transform(sequence(0, (size({lengths}) - 1) div {_BLOCK}), b -> slice({lengths}, b * {_BLOCK} + 1, {_BLOCK}))"
    running = "aggregate({0}, array(0), (a, x) -> array_append(a, element_at(a, -1) + x))"
    sums = "transform(s.blocks, b -> aggregate(b, 0, (a, x) -> a + x))"
    return f"""transform(array(struct({blocks} AS blocks)), s -> flatten(zip_with(
        s.blocks,
        slice({running.format(sums)}, 1, size(s.blocks)),
        (b, base) -> transform(slice({running.format("b")}, 1, size(b)), x -> x + base))))[0]"""


def _matches(p: str) -> str:
    """SQL: matches from the pieces of a pattern, every second of which is one."""
    n, at = f"{p}_n", f"{p}_at"
    near = f"concat(right({p}[2 * k - 2], {NEARBY}), ' ', left({p}[2 * k], {NEARBY}))"
    one = f"""struct({at}[2 * k - 1] AS start, {at}[2 * k - 1] + {n}[2 * k - 1] AS end,
                     {p}[2 * k - 1] AS value, lower({near}) AS near)"""
    return f"CASE WHEN size({p}) > 1 THEN transform(sequence(1, (size({p}) - 1) div 2), k -> {one}) END"


def _spans(p: str, kind: str) -> str:
    score = f"""{SURE[kind]}D + CASE WHEN m.near RLIKE '{NEAR[kind]}' THEN {BONUS}D ELSE 0D END
                - CASE WHEN m.near RLIKE '{AGAINST}' THEN {MALUS}D ELSE 0D END"""
    span = f"""struct('{kind}' AS kind, m.start AS start, m.end AS end, m.value AS value,
                      round(least(1D, greatest(0D, {score})), 2) AS score)"""
    found = f"transform(filter({p}_m, m -> {VALID[kind]}), m -> {span})"
    if kind in EXTRA_KINDS:
        found = f"filter({found}, s -> s.score >= {ACCEPT}D)"
    return f"coalesce({found}, cast(array() AS array<{SPAN}>))"


def find_pii(docs: DataFrame, text: str = "text", result: str = "pii") -> DataFrame:
    """``docs`` with an array of ``kind, start, end, value, score`` spans.

    Code points, end exclusive; sorted by kind as listed, then start. Email, ip,
    card and phone spans are all kept once confirmed; account numbers
    (modulo 97), cards of 13 to 15 digits and national ids need a score of
    ``ACCEPT``. A missing text counts as empty, a text without matches has no
    spans, repeated rows have equal spans, and other columns stay as they are
    (a column named like ``result`` is replaced). An empty table gives no rows.
    """
    prefix = fresh(docs, "_pii")
    scan, pieces = f"{prefix}_scan", {name: f"{prefix}_{name}" for name in PATTERNS}
    df = docs.withColumn(scan, F.translate(text_or_empty(F.col(text)), MARK, STAND_IN))
    steps: list[dict[str, Column]] = [{} for _ in range(5)]
    for name, p in pieces.items():
        fenced = F.regexp_replace(scan, PATTERNS[name][0], f"{MARK}$0{MARK}")
        steps[0][f"{p}_s"] = fenced
        steps[1][p] = F.when(F.contains(f"{p}_s", F.lit(MARK)), F.split(f"{p}_s", MARK, -1))
        steps[2][f"{p}_n"] = F.expr(f"transform({p}, x -> char_length(x))")
        steps[3][f"{p}_at"] = F.expr(f"CASE WHEN size({p}_n) > 1 THEN {_starts(f'{p}_n')} END")
        steps[4][f"{p}_m"] = F.expr(_matches(p))
    for step in steps:
        df = df.withColumns(step)
    home = {kind: pieces[name] for name, (_, kinds) in PATTERNS.items() for kind in kinds}
    spans = F.expr("concat(" + ", ".join(_spans(home[k], k) for k in (*BASE_KINDS, *EXTRA_KINDS)) + ")")
    return df.withColumn(result, spans).drop(scan, *[c for step in steps for c in step])
