"""Column parsers of scraped text: money, numbers, dates, names, registrations, urls, addresses, keys. Bad input gives null."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pregonero.functions.text import STATES, fold, unaccent, words


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def group(text: Column, regex: str, i: int) -> Column:
    """Group i of the first match, or null."""
    return F.nullif(F.regexp_extract(text, regex, i), F.lit(""))


def count_of(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign)))


def clean_money(text: Column) -> Column:
    """PRJ1: digits of a price; with both signs the comma is decimal, a lone comma is decimal, several points are
    thousands, one point is decimal."""
    t = F.regexp_replace(text, r"[^0-9,.\-]", "")
    dots, commas = count_of(t, "."), count_of(t, ",")
    number = (
        F.when((dots > 0) & (commas > 0), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(commas > 0, F.replace(t, F.lit(","), F.lit(".")))
        .when(dots > 1, F.replace(t, F.lit("."), F.lit(""))).otherwise(t)
    )
    return F.when(number.rlike(r"^-?\d+(\.\d+)?$"), number).try_cast("decimal(20,4)")


def brl_to_decimal(text: Column) -> Column:
    """PRJ2: every point is a thousands sign, the comma is decimal."""
    t = F.replace(F.replace(F.regexp_replace(text, r"[^0-9,.]", ""), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(t.rlike(r"^\d+(\.\d+)?$"), t).try_cast("decimal(20,4)")


def brl_suffixed(text: Column) -> Column:
    """PRJ3/PRJ4: an amount with a comma is Brazilian, else with a decimal point; nothing at or under zero."""
    t = F.regexp_replace(text, r"[^0-9,.]", "")
    t = F.when(count_of(t, ",") > 0, F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(t)
    v = F.when(t.rlike(r"^\d+(\.\d+)?$"), t).try_cast("decimal(20,4)")
    return F.when(v > 0, v)


def area(text: Column) -> Column:
    """PRJ5: like money, but a price or several points without a comma is no area."""
    t = F.regexp_replace(text, r"[^0-9,.\-]", "")
    bad = (F.instr(text, "R$") > 0) | ((count_of(t, ".") > 1) & (count_of(t, ",") == 0))
    return F.when(~bad, clean_money(text))


def loose_int(text: Column) -> Column:
    """PRJ6: the digits of a text as a whole number."""
    return F.regexp_replace(text, r"[^0-9\-]", "").try_cast("int")


def strict_decimal(text: Column) -> Column:
    """PRJ7: a plain decimal or null."""
    return F.when(F.trim(text).rlike(r"^-?\d+(\.\d+)?$"), F.trim(text)).try_cast("decimal(20,4)")


def br_date(text: Column) -> Column:
    """PRJ8/PRJ9: dd/mm/yyyy or dd/mm/yy anywhere in a text as a date; impossible days give null."""
    rx = r"(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})(?!\d)"
    y = group(text, rx, 3)
    iso = F.concat_ws("-", F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y), F.lpad(group(text, rx, 2), 2, "0"), F.lpad(group(text, rx, 1), 2, "0"))
    return F.when(y.isNotNull(), iso).try_cast("date")


def first_rule(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """PRJ12/13/17, TXT1: label of the first (label, regex) that the folded text matches."""
    t, out = fold(text), F.lit(default).cast("string")
    for label, regex in reversed(rules):
        out = F.when(t.rlike(regex), label).otherwise(out)
    return out


def all_rules(text: Column, rules: list[tuple[str, str]]) -> Column:
    """FN8: labels of all rules that match, in their order; no match and null give an empty array."""
    t = fold(text)
    return F.array_compact(F.array(*[F.when(t.rlike(r), label) for label, r in rules]))


def host(url: Column) -> Column:
    """PRJ21: lower-case host without one leading www."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")


def plain_name(text: Column) -> Column:
    """PRJ23: folded name without the office after it."""
    return words(F.regexp_replace(fold(text), r"\s*-?\s*(leiloes\b.*|leiloeiro oficial.*)$", ""))


def registration(text: Column) -> Column:
    """PRJ24: letters and digits of a registration in capitals, without the word before it and leading zeros. The signs
    of numbers (nº, n°) end that word: Java takes º for a letter."""
    t = F.regexp_replace(F.regexp_replace(F.translate(F.upper(unaccent(text)), "º°", "  "), r"^\s*(MATRICULA|MAT|N[O.]?)\b[.:]?", ""), r"[^A-Z0-9_]", "")
    return F.nullif(F.regexp_replace(t, r"^0+([0-9A-Z])", "$1"), F.lit(""))


def slug(text: Column, most: int = 80) -> Column:
    """PRJ33/FN18: words joined by hyphens."""
    return F.left(F.replace(words(text), F.lit(" "), F.lit("-")), F.lit(most))


def cep(text: Column) -> Column:
    """PRJ34: eight digits or null."""
    d = F.regexp_replace(text, r"\D", "")
    return F.when(F.length(d) == 8, d)


# Parts of urls that are page furniture.
NO_CONTENT = r"logo|favicon|icon|/styles/|placeholder"


def collect_urls(text: Column, most: int = 20) -> Column:
    """PRJ32: the first distinct urls of a text in their order, page furniture left out."""
    urls = F.regexp_extract_all(text, F.lit(r"(https?://[^\s\"'<>]+)"), 1)
    return F.slice(F.array_distinct(F.filter(urls, lambda u: ~F.lower(u).rlike(NO_CONTENT))), 1, most)


def uf_from_slug(url: Column) -> Column:
    """PRJ27: the last two-letter token of the path that is a state."""
    path = F.lower(F.try_parse_url(url, F.lit("PATH")))
    codes = F.filter(F.split(path, r"[^a-z0-9]+"), lambda t: F.upper(t).isin(list(STATES)))
    return F.upper(F.try_element_at(codes, F.lit(-1)))


def city_uf(text: Column) -> Column:
    """PRJ28/FN9: struct(city, uf) of the first `City/UF` of a text."""
    rx = r"([A-Z][A-Za-z ]{2,49})/([A-Z]{2})\b"
    t = unaccent(text)
    return F.struct(F.trim(group(t, rx, 1)).alias("city"), group(t, rx, 2).alias("uf"))


def address_blob(text: Column) -> Column:
    """FN4/PRJ29: struct(street, number, district, city, uf) of `street, number - district, city/UF`."""
    rx = r"^\s*([^,]+),\s*(\d+)[^-]*-\s*([^,]+),\s*([^/,-]+?)\s*[/-]\s*([A-Z]{2})\b"
    t = unaccent(text)
    return F.struct(*[F.trim(group(t, rx, i)).alias(n) for i, n in enumerate(("street", "number", "district", "city", "uf"), 1)])


def address_key(cep_: Column, street: Column, number: Column) -> Column:
    """FN15: folded cep|street|number; needs the code, or street and number."""
    c, s, n = (F.coalesce(blank_to_null(words(x)), F.lit("")) for x in (cep_, street, number))
    ok = (c != "") | ((s != "") & (n != ""))
    return F.when(ok, F.regexp_replace(F.concat_ws("|", c, s, n), r"^\|+|\|+$", ""))


def registry_key(text: Column) -> Column:
    """FN14: the number after `matricula` in a text, without points; the longest form of the number is taken."""
    return F.replace(group(fold(text), r"matricula\s*(?:n[o.º°]*\s*)?(\d{1,3}(?:\.\d{3})+|\d{1,8})", 1), F.lit("."), F.lit(""))


def redacted_label(name: Column, city: Column, uf: Column) -> Column:
    """FN3: initials of the words of more than two letters and the place; [anonimo] without any."""
    initials = F.array_join(F.transform(F.filter(F.split(F.coalesce(F.trim(name), F.lit("")), " +"), lambda w: F.length(w) > 2), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lit("."))), " ")
    return F.concat(F.when(initials == "", "[anonimo]").otherwise(initials), F.lit(", "), F.coalesce(city, F.lit("?")), F.lit("/"), F.coalesce(uf, F.lit("??")))


def hmac_sha256(text: Column, pepper: str) -> Column:
    """FN2: keyed hash in hex from built-in sha2; the pepper needs at least 32 characters and never becomes a column."""
    key = pepper.encode()
    if len(key) < 32:
        raise ValueError("the pepper needs at least 32 characters")
    if len(key) > 64:
        import hashlib

        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)
    lit = lambda b: F.unhex(F.lit(b.hex()))
    return F.sha2(F.concat(lit(outer), F.unhex(F.sha2(F.concat(lit(inner), F.encode(text, "UTF-8")), 256))), 256)


def trigrams(text: Column) -> Column:
    """FN6: distinct three-letter pieces of the padded words of a folded text."""
    of = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    ws = F.filter(F.split(words(text), " "), lambda w: w != "")
    return F.array_distinct(F.flatten(F.transform(ws, of)))


def similarity(a: Column, b: Column) -> Column:
    """FN6: shared trigrams by all trigrams."""
    x, y = trigrams(a), trigrams(b)
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """SF10: great-circle distance on a sphere of 6371.0088 km."""
    r = F.radians
    h = F.pow(F.sin((r(lat2) - r(lat1)) / 2), F.lit(2)) + F.cos(r(lat1)) * F.cos(r(lat2)) * F.pow(F.sin((r(lon2) - r(lon1)) / 2), F.lit(2))
    return F.lit(2 * 6371.0088) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def geocode_query(street: Column, number: Column, district: Column, city: Column, uf: Column) -> Column:
    """PRJ38: street[, number unless it stands for none], district, city, state, country."""
    none = fold(number).isin("s/n", "sn", "sem numero", "0", "")
    return F.concat_ws(", ", blank_to_null(street), F.when(~none, F.trim(number)), blank_to_null(district), blank_to_null(city), blank_to_null(uf), F.lit("Brasil"))


PEPPER_SETTING = "pregonero.cpf.pepper"


def session_pepper(spark: SparkSession) -> str:
    """SF12: the secret of the session's setting; it never becomes a column. Missing or short ones are an error."""
    pepper = spark.conf.get(PEPPER_SETTING, None) or ""
    if len(pepper) < 32:
        raise ValueError(f"{PEPPER_SETTING} needs at least 32 characters")
    return pepper


def hash_cpf(text: Column, pepper: str) -> Column:
    """FN2: keyed hash of the eleven digits of a person's number; another count of digits gives null, for quarantine."""
    digits = F.regexp_replace(text, r"\D", "")
    return F.when(F.length(digits) == 11, hmac_sha256(digits, pepper))


def geocode_confidence(importance: Column, has_number: Column, has_road: Column) -> Column:
    """FN19: importance, at least 0.85 with a house number and 0.55 with a road, from 0 to 1 with two decimals."""
    least = lambda c, v: F.when(c, v).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(importance, F.lit(0.0)), least(has_number, 0.85), least(has_road, 0.55))), 2)
