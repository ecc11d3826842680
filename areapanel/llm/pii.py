"""Personal data in whole texts, with DataFrame functions only.

Regular expressions propose spans; validators (Luhn, mod-97, octet ranges, digit counts) confirm them; words in the text
just before a span raise its score. A base kind needs its validator alone. Other kinds need a score of ``LEAST``; two of
them look for cards and phones again with stricter expressions, where a base match ran on into digits next to it.

Positions are code points. Splitting a text at the matches of an expression gives what lies between them, so a match
starts after the lengths of all pieces and matches before it; sums run over blocks, in time linear in the matches.
Expressions use possessive quantifiers and look-behind, so long runs of letters or digits cost linear time too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before a span that are searched for context words; what they add to the score; the least score.
NEAR, CONTEXT, LEAST = 40, 0.4, 0.6
#: Lengths summed at a time.
_BLOCK = 128


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _mod97(iban: Column) -> Column:
    flat = F.replace(iban, F.lit(" "))
    turned = F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.ascii(c)
        return F.when(value <= 57, (rest * 10 + value - 48) % 97).otherwise((rest * 100 + value - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _octets(ip: Column) -> Column:
    def small(part: Column) -> Column:
        value = F.regexp_replace(part, "^0+", "")
        return F.when(F.length(value) <= 3, F.coalesce(value.try_cast("int"), F.lit(0)) <= 255).otherwise(False)

    return F.forall(F.split(ip, "\\."), small)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_card(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)


#: Lengths of account numbers by country, from the IBAN registry and the countries that use the format without an entry.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}
#: A country's own length ends the match, whatever follows. Codes not listed, and other lengths: the longest run that ends
#: with a word, up to what looks like the next number.
_IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:(?:"
         + "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in _IBAN_LENGTHS.items())
         + r")(?![A-Za-z0-9])|[A-Z]{2}[0-9]{2}(?:(?!\x20[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4})\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9]))")


@dataclass(frozen=True)
class Kind:
    """``gate``: cheap test that a text may hold one; ``score`` of a valid span without context words."""

    name: str
    pattern: str
    gate: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    words: str
    base: bool = True
    again: bool = False  # a stricter expression for a base kind: adds what the base one missed


def _has(part: str) -> Callable[[Column], Column]:
    return lambda text: F.contains(text, F.lit(part))


def _like(pattern: str) -> Callable[[Column], Column]:
    return lambda text: text.rlike(pattern)


#: Kinds in the order of spans that start together. Matches are leftmost and do not overlap within a kind.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _has("@"),
         lambda v: F.lit(True), 0.8, "mail|e-mail|email|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _like(r"[0-9]\.[0-9]"), _octets, 0.6,
         "ip|host|server|address|client"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _like(r"[0-9][\x20-]?[0-9]"), _is_card, 0.8,
         "card|visa|mastercard|amex|credit|debit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _has("+"), lambda v: F.length(_digits(v)).between(10, 15), 0.7,
         "tel|phone|call|fax|mobile|cell"),
    Kind("card", r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7})(?![0-9])", _like("[0-9]{4}[\\x20-]?[0-9]{4}"),
         _is_card, 0.8, "", base=False, again=True),
    Kind("card", r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{6}\1[0-9]{4,5}(?![0-9])", _like("[0-9]{4}[\\x20-][0-9]{6}[\\x20-]"),
         _is_card, 0.8, "", base=False, again=True),
    Kind("phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])", _has("+"),
         lambda v: F.length(_digits(v)).between(10, 15), 0.7, "", base=False, again=True),
    Kind("iban", _IBAN, _like("[A-Z]{2}[0-9]{2}"),
         _mod97, 0.9, "iban|account|bank|konto", base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", _like("[0-9]-[0-9]{2}-[0-9]"),
         lambda v: F.lit(True), 0.3, "ssn|social security|social|tax", base=False),
    Kind("local_phone", r"(?<![0-9+])(?<!\+[0-9]{1,3}[\x20(.-]{0,2})\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
         _like("[0-9]{3}[\\x20.-][0-9]{4}"), lambda v: F.lit(True), 0.3, "tel|phone|call|fax|mobile|cell", base=False),
)


def _running(lengths: Column) -> Column:
    """Running sums of an array of numbers, a block at a time."""
    zero = F.lit(0)

    def sums(values: Column, start: Column) -> Column:
        out = F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.get(acc, F.size(acc) - 1) + x)))
        return F.slice(out, F.lit(2), F.size(values))

    blocks = F.transform(F.sequence(zero, F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, _BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: a + x))
    before = F.concat(F.array(zero), sums(totals, zero))
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), before.alias("s")),
                                 lambda z: F.when(z["b"].isNotNull(), sums(z["b"], z["s"])).otherwise(
                                     F.array().cast("array<int>"))))


def _matches(df: DataFrame, kind: Kind, text: str) -> DataFrame:
    """Columns ``_m`` (matches) and ``_p`` (the pieces around them) of ``kind``; both empty where its gate is shut."""
    body = F.col(text)
    open_ = kind.gate(body)
    nothing = F.array().cast("array<string>")
    return df.withColumns({"_m": F.when(open_, F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))).otherwise(nothing),
                           "_p": F.when(open_, F.split(body, kind.pattern, -1)).otherwise(nothing)})


def _near(kind: Kind, i: Column) -> Column:
    """Whether a context word stands close before match ``i``."""
    return F.lower(F.right(F.get("_p", i), F.lit(NEAR))).rlike(rf"\b(?:{kind.words})\b")


def _span(kind: Kind, place: int) -> Callable[[Column, Column], Column]:
    def span(v: Column, i: Column) -> Column:
        score = F.lit(kind.score)
        if not kind.again:
            score = F.least(score + F.when(_near(kind, i), CONTEXT).otherwise(0.0), F.lit(1.0))
        return F.struct(F.get("_s", i).alias("start"), F.lit(place).alias("place"), F.lit(kind.name).alias("kind"),
                        (F.get("_s", i) + F.length(v)).alias("end"),
                        F.when(kind.valid(v), score).otherwise(F.lit(-1.0)).alias("score"))

    return span


def _as_found_by(kind: Kind, place: int) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind.name).alias("kind"),
                              s["end"].alias("end"), F.lit(kind.score).alias("score"))


def _scores(least: float) -> Callable[[Column], Column]:
    return lambda s: s["score"] >= least


def _marked(kind: Kind) -> Callable[[Column, Column], Column]:
    def mark(v: Column, i: Column) -> Column:
        sure = kind.valid(v) if kind.base or kind.score >= LEAST else kind.valid(v) & _near(kind, i)
        return F.concat(F.get("_p", i), F.when(sure, F.lit(f"[{kind.name.upper()}]")).otherwise(v))

    return mark


def with_spans(df: DataFrame, text: str, spans: str = "spans", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``df`` with ``spans``: array of (start, place of the kind, kind, end, score), sorted; null text counts as empty.
    A column of that name is replaced, all others stay."""
    out = _packed(df).withColumn("_t", F.coalesce(F.col(f"_row.{_quoted(text)}"), F.lit("")))
    found = []
    none = "array<struct<start:int,place:int,kind:string,end:int,score:double>>"
    for place, kind in enumerate(kinds):
        out = _matches(out, kind, "_t")
        steps = F.transform("_m", lambda v, i: F.length(F.get("_p", i)) + F.when(
            i > 0, F.length(F.get("_m", i - 1))).otherwise(0))
        out = out.withColumn("_s", F.when(F.size("_m") > 0, _running(steps)).otherwise(F.array().cast("array<int>")))

        scored = F.filter(F.transform("_m", _span(kind, place)), _scores(0.0 if kind.base else LEAST))
        if kind.again:  # not what the base kind of that name has found already
            first = next(i for i, k in enumerate(kinds) if k.name == kind.name)
            scored = F.array_except(scored, F.transform(f"_spans{first}", _as_found_by(kind, place)))
        found.append(f"_spans{place}")
        out = out.withColumn(found[-1], F.when(F.size("_m") > 0, scored).otherwise(F.array().cast(none)))
    joined = F.array_sort(F.concat(*found))
    return out.select(*[F.col(f"_row.{_quoted(c)}") for c in df.columns if c != spans], joined.alias(spans))


def redact(df: DataFrame, text: str, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``df`` with every confirmed span of ``text`` replaced by its kind in brackets, one kind after the other. A null
    text stays null; other columns stay as they are, whatever their names; rows that
    repeat give the same; an empty table stays empty."""
    out = _packed(df).withColumn("_t", F.col(f"_row.{_quoted(text)}"))
    for kind in kinds:
        out = _matches(out, kind, "_t")
        marked = F.concat(F.array_join(F.transform("_m", _marked(kind)), ""), F.get("_p", F.size("_m")))
        out = out.withColumn("_t", F.when(F.size("_m") > 0, marked).otherwise(F.col("_t")))
    return out.select(*[F.col("_t").alias(c) if c == text else F.col(f"_row.{_quoted(c)}") for c in df.columns])


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _packed(df: DataFrame) -> DataFrame:
    """All columns in one, so that no name clashes with those used here."""
    return df.select(F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias("_row"))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more, top_score.

    ``spans`` is ``kind:start:end`` of all spans by start, then kind, comma-joined; ``base_sha256`` digests those of the
    four base kinds. ``n_more`` counts the others, ``top_score`` is the highest score (null without spans). A null or empty
    text has no spans and the digest of an empty string. Rows that repeat give the same; an empty table gives an empty
    result; other columns are not read, so clashing names do no harm.
    """
    rows = with_spans(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", "_all").drop("_text")
    base = [k.name for k in KINDS if k.base]

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(place: int) -> Column:
        return F.size(F.filter("_all", lambda s: s["place"] == place)).cast("long")

    of_base = F.filter("_all", lambda s: s["place"] < len(base))
    return rows.select(F.col("_key").alias(key), *[count(i).alias(f"n_{n}") for i, n in enumerate(base)],
                       F.sha2(listed(of_base).cast("binary"), 256).alias("base_sha256"),
                       listed(F.col("_all")).alias("spans"),
                       F.size(F.filter("_all", lambda s: s["place"] >= len(base))).cast("long").alias("n_more"),
                       F.array_max(F.transform("_all", lambda s: s["score"])).alias("top_score"))
