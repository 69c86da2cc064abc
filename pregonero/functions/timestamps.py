"""Timestamps of many notations, precisions and clocks -> one instant in microseconds UTC.

Every notation is one branch of a single regular expression with named groups. One regexp_replace runs it and
rewrites a value to its components, so a value is matched once however many components are wanted. The calendar
ranges are then checked and the instant is assembled with integer day arithmetic; only a clock without a written
offset asks the time-zone rules. Everything stays in JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month names and short names in the languages of the sources.
MONTHS = {
    "jan": 1, "janeiro": 1, "january": 1, "fev": 2, "fevereiro": 2, "feb": 2, "february": 2, "mar": 3, "março": 3, "marco": 3, "march": 3,
    "abr": 4, "abril": 4, "apr": 4, "april": 4, "mai": 5, "maio": 5, "may": 5, "jun": 6, "junho": 6, "june": 6, "jul": 7, "julho": 7, "july": 7,
    "ago": 8, "agosto": 8, "aug": 8, "august": 8, "set": 9, "setembro": 9, "sep": 9, "sept": 9, "september": 9, "out": 10, "outubro": 10,
    "oct": 10, "october": 10, "nov": 11, "novembro": 11, "november": 11, "dez": 12, "dezembro": 12, "dec": 12, "december": 12,
}
# Zone abbreviations with one meaning here, in minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "BRT": -180, "BRST": -120, "AMT": -240, "AMST": -180, "ACT": -300, "FNT": -120, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "WET": 0, "WEST": 60, "CET": 60, "CEST": 120,
}

_ZONE = r"(?<z{i}>Z|\(?(?:UTC|GMT)?[+-]\d{{1,2}}(?::?\d{{2}})?\)?|\(?[A-Z]{{2,5}}\)?|\(?[A-Z]+(?:/[A-Z_+\-0-9]+)+\)?)"
_CLOCK = r"(?<h{i}>\d{{1,2}})(?:[:h](?<n{i}>\d{{2}})(?:min)?(?:[:m](?<s{i}>\d{{2}})s?(?:[.,](?<f{i}>\d{{1,9}}))?)?|h(?:s)?)(?:\s*(?<p{i}>[AP])\.?M\.?(?![^\W_]))?"
#: Branches in order; {i} numbers the groups of a branch, as a name may occur once in a pattern.
BRANCHES = (
    # 2018-01-06T04:28:01.5-02:00, 2018-01-06 09h16 (UTC-2), 2018-01-06
    r"(?<y{i}>\d{{4}})[-/.](?<m{i}>\d{{1,2}})[-/.](?<d{i}>\d{{1,2}})(?:(?:T|\s+|\s+-\s+|\s*,?\s+[àa]s\s+)" + _CLOCK + r")?(?:\s*" + _ZONE + r")?",
    # 20180108T035012Z, 20180107143053 America/Sao_Paulo
    r"(?<y{i}>\d{{4}})(?<m{i}>\d{{2}})(?<d{i}>\d{{2}})(?:T?(?<h{i}>\d{{2}})(?<n{i}>\d{{2}})(?:(?<s{i}>\d{{2}}))?(?:[.,](?<f{i}>\d{{1,9}}))?(?:\s*" + _ZONE + r")?)?",
    # 31/12/2018 - 15:09 BRST, 10.1.2018 03:58, 01/01/21 3:05:00 PM; which number is the day follows the source
    r"(?<a{i}>\d{{1,2}})(?<q{i}>[/.\-])(?<b{i}>\d{{1,2}})\k<q{i}>(?<y{i}>\d{{4}}|\d{{2}})(?:(?:\s+-\s+|\s*,\s*|\s*,?\s+[àa]s\s+|\s+)" + _CLOCK + r")?(?:\s*" + _ZONE + r")?",
    # [terça-feira, ]10 de abril de 2018[, | às ]22h30; Fri, 01 Feb 2019 07:19:20 -0500; 01-Apr-2018 14:18; 01/Apr/2018:21:55:33 -0300
    r"(?:[^\W\d_]+(?:-feira)?,?\s+)?(?<d{i}>\d{{1,2}})[ºo°]?(?:\s+de\s+|[\s\-/.]+)(?<w{i}>[^\W\d_]{{3,9}})\.?(?:\s+de\s+|[\s\-/.]+)(?<y{i}>\d{{4}}|\d{{2}})(?:(?:\s*,?\s*[àa]s\s+|\s*,\s*|:|\s+-\s+|\s+)" + _CLOCK + r")?(?:\s*" + _ZONE + r")?",
    # seconds, milliseconds, microseconds since 1970; /Date(milliseconds)/
    r"(?:/Date\()(?<e{i}>-?\d{{10,14}})(?:[+-]\d{{4}})?\)/",
    r"(?<e{i}>\d{{9,10}}|\d{{13}}|\d{{16}})",
)
PARTS = ("y", "m", "d", "a", "b", "w", "h", "n", "s", "f", "p", "z", "e")
_MARK = "\u0001"


def pattern() -> str:
    return r"(?iuU)^\s*(?:" + "|".join(b.format(i=i) for i, b in enumerate(BRANCHES)) + r")\s*$"


def _replacement() -> str:
    has = lambda p, i: f"(?<{p}{i}>" in BRANCHES[i].format(i=i)
    groups = ("".join(f"${{{p}{i}}}" for i in range(len(BRANCHES)) if has(p, i)) for p in PARTS)
    return _MARK + "|".join(groups)


def civil_days(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01 of a Gregorian date, in integers only (years from 1)."""
    y = year - F.when(month <= 2, 1).otherwise(0)
    div = lambda a, b: F.floor(a / F.lit(b)).cast("long")  # noqa: E731  exact: all numbers are far below 2^53
    era = div(y, 400)
    yoe = y - era * 400
    doy = div(F.lit(153) * (month + F.when(month > 2, -3).otherwise(9)) + 2, 5) + day - 1
    return era * 146097 + yoe * 365 + div(yoe, 4) - div(yoe, 100) + doy - 719468


def month_length(year: Column, month: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def known_zones(spark: SparkSession) -> list[str]:
    """Region zone names the JVM knows (a fixed list of the time-zone database)."""
    names = spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds().toString()
    return sorted(n for n in names.strip("[]").split(", ") if "/" in n or n in ("UTC", "GMT"))


def barrier(df: DataFrame, keep: list[str], new: dict[str, Column]) -> DataFrame:
    """df[keep] and the new columns, computed once: no projection or filter above is merged into them. Catalyst
    would otherwise substitute each step into the next and the expression would grow exponentially."""
    row = F.struct(*[c.alias(n) for n, c in new.items()])
    return df.select(*[F.col(f"`{k}`") for k in keep], F.inline(F.array(row)))


def with_utc_micros(df: DataFrame, text: str, zone: str, order: str, out: str = "utc_us") -> DataFrame:
    """Add `out`: the instant that df[text] denotes in microseconds since 1970 UTC, or null.

    zone: column with the IANA zone of the source's clock, for values without a zone of their own (null or
    unknown: such values give null). order: column with `dmy` or `mdy` for all-digit dates that don't begin with
    the year (null means dmy).
    Null for: null, empty and other text; impossible dates or times; wall-clock times that the zone skipped or
    showed twice, unless the text has an offset or an abbreviation. Missing parts are zero; digits beyond
    microseconds are cut.
    """
    names = known_zones(df.sparkSession)
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    offsets = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    keep = df.columns
    t = "__ts_"
    rewritten = F.regexp_replace(F.col(text), F.lit(pattern()), F.lit(_replacement()))
    step = barrier(df, keep, {f"{t}r": rewritten})
    # a value that matches no branch is left as it was: it doesn't begin with the mark
    parts = F.split(F.substring(F.col(f"{t}r"), 2, 1 << 20), r"\|", -1)
    step = barrier(step, keep, {f"{t}p": F.when(F.col(f"{t}r").startswith(_MARK), parts)})
    got = {p: F.nullif(F.col(f"{t}p")[i], F.lit("")) for i, p in enumerate(PARTS)}
    num = lambda p: got[p].try_cast("long")
    mdy = F.col(order) == "mdy"
    word = F.lower(got["w"])
    year = F.when(F.length(got["y"]) == 2, num("y") + 2000).otherwise(num("y"))
    month = F.coalesce(num("m"), F.when(mdy, num("a")).otherwise(num("b")), F.try_element_at(months, word).cast("long"))
    day = F.coalesce(num("d"), F.when(mdy, num("b")).otherwise(num("a")))
    half = F.upper(got["p"])
    hour = F.coalesce(num("h"), F.lit(0).cast("long"))
    hour24 = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "P", 12).otherwise(0))
    fraction = F.coalesce(F.rpad(F.substring(got["f"], 1, 6), 6, "0").try_cast("long"), F.lit(0).cast("long"))
    sign = F.regexp_replace(F.regexp_replace(got["z"], r"[()]", ""), r"^(?i:UTC|GMT)(?=[+-])", "")
    zero = F.lit(0).cast("long")
    step = barrier(step, keep, {
        f"{t}y": year, f"{t}m": month, f"{t}d": day, f"{t}h": hour24, f"{t}n": F.coalesce(num("n"), zero), f"{t}s": F.coalesce(num("s"), zero),
        f"{t}f": fraction, f"{t}z": sign, f"{t}e": num("e"), f"{t}l": F.length(F.regexp_replace(got["e"], "-", "")),
    })
    c = lambda p: F.col(t + p)
    valid = (
        c("y").between(1, 9999) & c("m").between(1, 12) & (c("d") >= 1) & (c("d") <= month_length(c("y"), c("m")))
        & c("h").between(0, 23) & c("n").between(0, 59) & c("s").between(0, 59)
    )
    wall = F.when(valid, (civil_days(c("y"), c("m"), c("d")) * 86_400 + c("h") * 3600 + c("n") * 60 + c("s")) * 1_000_000 + c("f"))
    digits = F.regexp_replace(c("z"), r"[^0-9]", "")
    short = F.length(digits) <= 2
    hh = F.when(short, digits).otherwise(F.substring(F.lpad(digits, 4, "0"), 1, 2)).try_cast("int")
    mm = F.when(short, F.lit("0")).otherwise(F.substring(F.lpad(digits, 4, "0"), 3, 2)).try_cast("int")
    written = F.when(hh.between(0, 18) & mm.between(0, 59), F.when(c("z").startswith("-"), -1).otherwise(1) * (hh * 60 + mm))
    named = F.coalesce(c("z"), F.col(zone))
    step = barrier(step, keep, {
        f"{t}wall": wall, f"{t}e": c("e"), f"{t}l": c("l"),
        f"{t}off": F.when(c("z").rlike(r"^[+-]"), written).otherwise(F.try_element_at(offsets, F.upper(c("z")))),
        f"{t}name": F.when(named.isin(names), named),
    })
    # The zone's clock: the first offset that gives this wall time, and the offset some hours later. The wall time
    # is good when the first is exact and the second isn't another instant that shows the same wall time.
    stamp = lambda us: F.timestamp_micros(us)
    micros = lambda x: F.unix_micros(x)
    ask = c("off").isNull() & c("name").isNotNull()
    rest = {f"{t}{p}": c(p) for p in ("wall", "e", "l", "off", "name")}
    step = barrier(step, keep, rest | {f"{t}u1": F.when(ask, micros(F.to_utc_timestamp(stamp(c("wall")), c("name"))))})
    back = lambda us: micros(F.from_utc_timestamp(stamp(us), c("name")))
    later = F.lit(4 * 3600 * 1_000_000)
    step = barrier(step, keep, rest | {f"{t}u1": c("u1"), f"{t}u2": c("wall") - (back(c("u1") + later) - (c("u1") + later))})
    single = (back(c("u1")) == c("wall")) & ((c("u2") == c("u1")) | (back(c("u2")) != c("wall")))
    epoch = (
        F.when(c("l") <= 10, c("e") * 1_000_000).when(c("l") <= 14, c("e") * 1000).otherwise(c("e"))
    )
    instant = F.coalesce(epoch, c("wall") - c("off").cast("long") * 60_000_000, F.when(single, c("u1")))
    return barrier(step, keep, {out: instant})
