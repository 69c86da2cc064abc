"""Where something is, read from free text: states, cities, boards, address parts; and what it is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pregonero.functions.parsers import all_rules, blank_to_null, first_rule, group
from pregonero.functions.text import STATES, fold, normalise_uf, unaccent
from pregonero.rules import BOARD_OF_STATE, CEP_RANGES, CREDITORS, STATE_NAMES, UNIT_KINDS

#: City and state of a text, on unaccented text: `City / UF`, `City - UF` before a blank, a sign or the end.
CITY_STATE = r"([A-Z][A-Za-z\s.'-]{2,40})\s*[/-]\s*([A-Z]{2})(?:\s|[.]|$|,|\"|<)"
CITY_SLASH = r"\b([A-Z][A-Za-z\s.'-]{2,40}?)\s*/\s*([A-Z]{2})\b"
CITY_PAREN = r"([A-Z][A-Za-z\s.'-]{2,40}?)\s*\(([A-Z]{2})\)"
# Beginnings that are no city.
NO_CITY = r"^(as|em|de|da|do|no|na|para|por|com|sem|leil|r\$|\d|lote|tipo|valor)"
#: States of a text in order of trust: patterns and whether the match with the last place wins.
STATE_CLUES = (
    ([r"([A-Za-z][A-Za-z\s.'-]{2,40})\s*[/-]\s*([A-Z]{2})(?:\s|[.]|$|,|\"|<)"], True),
    ([r",\s*([A-Z]{2})\s*(?:,\s*CEP|$|\s*\||\s*[.])"], False),
    ([r"--([a-z]{2})--", r"-([a-z]{2})(?:-/|/$|$)", r"-([a-z]{2})-(?:na|no|em|de|do|da)-"], True),
    ([r"ESTADO\s*:?\s*([A-Z]{2})"], False),
)
#: Cities that a folded text names, in order.
CITY_CLUES = (r"municipio\s*(?:de\s+|:\s*)([a-z][a-z\s.']{2,40}?)(?:\s*,|\s*[.]|$|\s*\()", r"(?:^|\s)(?:em|na|no)\s+([a-z][a-z\s.']{2,40}?)\s*(?:,|[.]|$)", r"cidade\s*:\s*([a-z][a-z\s.']{2,40}?)(?:\s*/|\s*,|\s*$|\s*\|)")
LABELLED = r"(?i)^(.*?)(?:\s+-\s+([^-]+?))?\s*cidade\s*:\s*([^/]+?)\s*/\s*([a-z]{2})\s*(?:-\s*cep\s*:\s*(\d{5}-?\d{3}))?\s*$"
LABEL = r"(?i)^\s*(?:endere[çÇc]o|end[.]|logradouro)\s*:\s*"
BOARD_NAME = r"^junta comercial (?:industrial e servicos )?(?:d[eoa] estado )?d[eoa] (.+)$"


def unit_kind(text: Column) -> Column:
    """FN7: kind of unit by the ordered rules; blank or no hit is desconhecida."""
    t, out = fold(text), F.lit("desconhecida")
    for label, needed, never in reversed(UNIT_KINDS):
        hit = t.rlike(needed[0])
        for rx in needed[1:]:
            hit = hit & t.rlike(rx)
        out = F.when(hit & ~t.rlike(never) if never else hit, label).otherwise(out)
    return F.when(blank_to_null(text).isNull(), "desconhecida").otherwise(out)


def creditors(text: Column) -> Column:
    """FN8: all creditors that a text names, in the order of the list; null gives none."""
    return all_rules(F.coalesce(text, F.lit("")), CREDITORS)


def state_of_cep(cep: Column) -> Column:
    """FN12: state of the first two digits of a postal code of at least five characters."""
    n = F.when(F.length(F.trim(cep)) >= 5, F.left(F.regexp_replace(cep, r"\D", ""), F.lit(2)))
    n = F.when(F.length(n) == 2, n.try_cast("int"))
    return F.coalesce(*[F.when(n.between(a, b), state) for a, b, state in CEP_RANGES])


def state_named(text: Column) -> Column:
    """FN13: the first state of the list whose name a text holds."""
    return first_rule(text, STATE_NAMES)


def state_of_text(text: Column) -> Column:
    """FN10: the state that a text tells by the first kind of clue that gives one; of several of some kinds the one whose
    clue stands farthest to the right (of clues with a city, where that city stands first)."""
    t = unaccent(text)
    is_state = lambda s: F.upper(F.trim(s)).isin(list(STATES))

    def clue(patterns: list[str], last: bool) -> Column:
        found = []
        for rx in patterns:
            two = rx.count("(") - rx.count("(?:") == 2
            states = F.regexp_extract_all(t, F.lit(rx), 2 if two else 1)
            where = F.regexp_extract_all(t, F.lit(rx), 1)
            found.append(F.transform(F.arrays_zip(where.alias("at"), states.alias("s")), lambda z: F.struct(F.instr(t, z["at"]).alias("at"), z["s"].alias("s"))))
        good = F.filter(F.concat(*found), lambda z: is_state(z["s"]))
        pick = F.array_max(good) if last else F.get(good, F.lit(0))
        return F.upper(F.trim(pick["s"]))

    return F.coalesce(*[clue(*c) for c in STATE_CLUES])


def city_candidates(text: Column) -> Column:
    """FN11: cities that a text may name, in order: after `municipio de`, after em/na/no, after `cidade:`."""
    t = fold(text)
    return F.filter(F.transform(F.concat(*[F.regexp_extract_all(t, F.lit(rx), 1) for rx in CITY_CLUES]), lambda c: F.trim(c)), lambda c: F.length(c) >= 3)


def city_and_state(text: Column) -> Column:
    """FN9: struct(city, uf) of the first `City / UF`; both null without one, for short names and for words that begin no
    city. The state isn't checked."""
    t = unaccent(text)
    city, uf = F.trim(group(t, CITY_STATE, 1)), group(t, CITY_STATE, 2)
    good = (F.length(city) >= 3) & ~F.lower(city).rlike(NO_CITY)
    return F.struct(F.when(good, city).alias("city"), F.when(good, uf).alias("uf"))


def city_in_two_forms(text: Column) -> Column:
    """PRJ28: struct(city, uf) of `City/UF`, else of `City (UF)`; cities of 3 to 50 letters."""
    t = unaccent(text)
    one, two = F.trim(group(t, CITY_SLASH, 1)), F.trim(group(t, CITY_PAREN, 1))
    first, second = F.length(one).between(3, 50), F.length(two).between(3, 50)
    return F.struct(F.when(first, one).when(second, two).alias("city"), F.when(first, group(t, CITY_SLASH, 2)).when(second, group(t, CITY_PAREN, 2)).alias("uf"))


def labelled_address(text: Column) -> Column:
    """FN4: struct(street, number, district, city, uf, cep) of `Endereco: street, number - district Cidade: city / UF - CEP:
    n`; without a city all of it is the street."""
    s = F.trim(F.regexp_replace(F.regexp_replace(text, LABEL, ""), r"\s+", " "))
    there = s.rlike(LABELLED)
    part = lambda i: blank_to_null(F.regexp_extract(s, LABELLED, i))
    rest, digits = part(1), F.regexp_replace(part(5), r"\D", "")
    pair = r"^(.+?),\s*([0-9SsNn][0-9SsNn/.-]*)\s*$"
    both = rest.rlike(pair)
    street = F.when(both, F.trim(F.regexp_extract(rest, pair, 1))).otherwise(rest)
    return F.struct(
        F.when(there, street).otherwise(blank_to_null(s)).alias("street"), F.when(there & both, F.trim(F.regexp_extract(rest, pair, 2))).alias("number"), F.when(there, part(2)).alias("district"),
        F.when(there, part(3)).alias("city"), F.when(there, F.upper(part(4))).alias("uf"), F.when(there & (F.length(digits) == 8), digits).alias("cep"),
    )


def dashed_address(text: Column) -> Column:
    """PRJ29: struct(street, number, district, city, uf) of `street, number - district - city / UF`: the last but one part
    is the district, the city stands before the slash."""
    s = F.trim(F.regexp_replace(text, r"\s+", " "))
    parts = F.transform(F.split(s, " - "), lambda x: F.trim(x))
    head, pair = F.get(parts, F.lit(0)), r"^(.+?),\s*([\dSNs/-]+)\s*$"
    both = head.rlike(pair)
    return F.struct(
        F.when(both, F.trim(F.regexp_extract(head, pair, 1))).otherwise(head).alias("street"), F.when(both, F.trim(F.regexp_extract(head, pair, 2))).alias("number"),
        F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(-2))).alias("district"), F.trim(group(s, r"-\s*([^-/]+?)\s*/\s*[A-Z]{2}\s*$", 1)).alias("city"), group(s, r"/\s*([A-Z]{2})\s*$", 1).alias("uf"),
    )


def board(name: Column, uf: Column) -> Column:
    """PRJ25: code of a registration board from its long name, else from the state, else empty."""
    codes = F.create_map(*[F.lit(x) for kv in BOARD_OF_STATE.items() for x in kv])
    named = normalise_uf(F.regexp_extract(fold(F.trim(name)), BOARD_NAME, 1))
    return F.coalesce(F.try_element_at(codes, named), F.try_element_at(codes, F.upper(F.trim(uf))), F.lit(""))


def board_registration(text: Column) -> Column:
    """PRJ26: struct(uf, number) of `N/JUC..UF` or `JUC..UF [AARC] N`; another text is the number without a state. The
    number has at most ten characters."""
    t = F.trim(F.coalesce(text, F.lit("")))
    after, before = r"(?i)^([\w./-]+)\s*/\s*juc[a-z]*?([a-z]{2})\s*$", r"(?i)^juc[a-z]*?([a-z]{2})\s+(?:aarc\s+)?(.+)$"
    a, b = F.upper(F.regexp_extract(t, after, 2)), F.upper(F.regexp_extract(t, before, 1))
    one, two = a.isin(list(STATES)), b.isin(list(STATES))
    number = F.when(one, F.regexp_extract(t, after, 1)).when(two, F.trim(F.regexp_extract(t, before, 2))).otherwise(t)
    return F.struct(F.when(one, a).when(two, b).alias("uf"), F.nullif(F.left(number, F.lit(10)), F.lit("")).alias("number"))
