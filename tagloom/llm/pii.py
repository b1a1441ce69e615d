"""Personal data in whole texts: regular expressions propose spans, checksums confirm them, context words adjust scores.

Column expressions only. Base kinds are email, ip, card (Luhn) and phone; they always stay. Added kinds are iban (mod-97),
tel (a national phone number) and ssn, the last two only where a context word before them lifts their score to the
threshold. An iban has the length of its country, so what follows it is no part of it. Positions count code points, end
exclusive. Null texts read as empty; an empty text has no span.

Patterns are written so that each is linear in the text: possessive repeats, and no match tried from the middle of a run
that its beginning has already ruled out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = r"[A-Za-z0-9._%+-]"
SPAN = "array<struct<start:int,kind:int,end:int,name:string,score:double>>"


@dataclass(frozen=True)
class Kind:
    """pattern: Java regular expression. hint: cheap test that every text with a match passes. score: of a span that
    passes its check. context: regular expression for words within ``NEAR`` characters before, each worth ``LIFT``. ahead:
    the span is group 1, which the match looks ahead at, so that a span that fails its check hides none that begins in it."""

    name: str
    pattern: str
    hint: str
    score: float = 1.0
    context: str | None = None
    ahead: bool = False


# Characters of an account code behind its first four, by country.
IBAN = {11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH HR LI LV",
        18: "BG BH CR DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM SO TL", 20: "AD CZ ES MD PK RO SA SE SK TN VG",
        21: "AO CV GW LY MZ PT ST", 22: "DZ IR IS TR", 23: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
        24: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 25: "BR EG PS QA UA", 26: "JO KW MU YE", 27: "MT SC",
        28: "LC", 29: "RU"}
CODE = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n}}}" for n, names in IBAN.items())

BASE = ("email", "ip", "card", "phone")
KINDS = (
    Kind("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])", r"[0-9][ -]?[0-9]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=((?:{CODE})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}", r"[A-Z]{2}[0-9]{2}", ahead=True),
    Kind("tel", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", r"[0-9]{3}[ .-][0-9]{4}", 0.3, r"phone|tel|call|mobile|fax"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]", 0.3, r"ssn|social security"),
)
NEAR, LIFT, THRESHOLD = 40, 0.4, 0.5


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(total: Column, i: Column) -> Column:
        d = number.substr(i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((F.length(number) - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code, spaces removed, leaves the remainder 1 when its first four characters go last."""
    turned = F.concat(code.substr(F.lit(5), F.length(code)), code.substr(F.lit(1), F.lit(4)))

    def step(rest: Column, x: Column) -> Column:
        digit = x.rlike("[0-9]")
        return F.when(digit, (rest * 10 + x.cast("int")) % 97).otherwise((rest * 100 + F.ascii(x) - 55) % 97)

    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    return F.lit(True)


def proposed(text: Column, number: int, kind: Kind) -> Column:
    """Confirmed spans of one kind, scored. Positions are running lengths of what the matches split the text into."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    lengths = F.zip_with(matches, gaps, lambda m, g: F.struct(m.alias("match"), F.length(g).alias("before"), F.length(m).alias("long")))
    lengths = F.filter(lengths, lambda x: x["match"].isNotNull())
    nothing = F.array().cast("array<struct<start:int,end:int,match:string>>")
    placed = F.aggregate(
        lengths, F.struct(F.lit(0).alias("at"), nothing.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["before"] + x["long"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["before"]).alias("start"), (acc["at"] + x["before"] + x["long"]).alias("end"), x["match"].alias("match")))).alias("out")),
        lambda acc: acc["out"])
    if kind.ahead:
        whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1))
        placed = F.zip_with(placed, whole, lambda x, m: F.struct(x["start"].alias("start"), (x["start"] + F.length(m)).alias("end"), m.alias("match")))
    good = F.filter(placed, lambda x: confirmed(kind.name, x["match"]))

    def scored(x: Column) -> Column:
        score = F.lit(kind.score)
        if kind.context:
            before = F.lower(text.substr(F.greatest(x["start"] - NEAR, F.lit(0)) + 1, F.least(x["start"], F.lit(NEAR))))
            score = score + F.when(before.rlike(kind.context), LIFT).otherwise(0.0)
        return F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"), F.lit(kind.name).alias("name"), score.alias("score"))

    spans = F.filter(F.transform(good, scored), lambda x: x["score"] >= THRESHOLD)
    return F.when(text.rlike(kind.hint), spans).otherwise(F.array().cast(SPAN))


def spans(text: Column) -> Column:
    """All spans of a text that is not null, by start and then kind: start, kind (its number), end, name, score."""
    return F.array_sort(F.concat(*(proposed(text, i, k) for i, k in enumerate(KINDS))))


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with the column ``out`` of spans."""
    return docs.withColumn(out, spans(F.coalesce(F.col(text), F.lit(""))))


def listed(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["name"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the whole."""
    step = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.when(x["start"] >= acc["at"], F.struct(
            x["end"].alias("at"), F.concat(acc["out"], F.array(text.substr(acc["at"] + 1, x["start"] - acc["at"]), F.concat(F.lit("["), F.upper(x["name"]), F.lit("]")))).alias("out"),
        )).otherwise(F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, step).otherwise(text)


# --- the same in the SQL of the correctness check: plain patterns, as that engine needs no guard against retries ------

def sql_spans(name: str, pattern: str, check: str, number: int) -> str:
    """List of {start, kind, end, name} of the matches in ``t`` for which ``check`` (of m, s and e) holds."""
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{pattern}')) + 1), lambda i: {{
      's': coalesce(list_sum(list_transform(string_split_regex(t, '{pattern}')[1:i], lambda g: length(g))), 0)::bigint
         + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i-1], lambda g: length(g))), 0)::bigint,
      'k': {number},
      'e': coalesce(list_sum(list_transform(string_split_regex(t, '{pattern}')[1:i], lambda g: length(g))), 0)::bigint
         + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i], lambda g: length(g))), 0)::bigint,
      'm': regexp_extract_all(t, '{pattern}')[i], 'n': '{name}'}}), lambda x: {check})"""


def sql_digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def sql_context(words: str) -> str:
    return f"regexp_matches(lower(substring(t, greatest(x.s - {NEAR}, 0)::bigint + 1, least(x.s, {NEAR})::bigint)), '{words}')"


def sql_edge(inside: str, before: str = "") -> str:
    """Neither neighbour of a match is one of these characters."""
    return (f"not regexp_matches(substring(t, x.s, case when x.s > 0 then 1 else 0 end), '[{inside}{before}]') "
            f"and not regexp_matches(substring(t, x.e + 1, 1), '[{inside}]')")


SQL_CHECKS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(x.m, '.'), lambda p: p::hugeint)) <= 255"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"""length({sql_digits('x.m')}) between 14 and 19 and list_sum(list_transform(
       range(1, length({sql_digits('x.m')}) + 1), lambda j: case when (length({sql_digits('x.m')}) - j) % 2 = 0 then substring({sql_digits('x.m')}, j, 1)::int
       else substring({sql_digits('x.m')}, j, 1)::int * 2 - case when substring({sql_digits('x.m')}, j, 1)::int > 4 then 9 else 0 end end)) % 10 = 0"""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({sql_digits('x.m')}) between 10 and 15"),
    ("tel", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", f"{sql_edge('0-9', '+')} and {sql_context('phone|tel|call|mobile|fax')}"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", f"{sql_edge('0-9-')} and {sql_context('ssn|social security')}"),
)
