"""Text helpers shared by the operators: unaccenting, tokens, states of Brazil."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTS = "áàâãäåéèêëíìîïóòôõöúùûüçñýÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucnyAAAAAAEEEEIIIIOOOOOUUUUCNY"

# States of Brazil.
STATES = {
    "AC": "acre", "AL": "alagoas", "AP": "amapa", "AM": "amazonas", "BA": "bahia", "CE": "ceara", "DF": "distrito federal", "ES": "espirito santo",
    "GO": "goias", "MA": "maranhao", "MT": "mato grosso", "MS": "mato grosso do sul", "MG": "minas gerais", "PA": "para", "PB": "paraiba",
    "PR": "parana", "PE": "pernambuco", "PI": "piaui", "RJ": "rio de janeiro", "RN": "rio grande do norte", "RS": "rio grande do sul",
    "RO": "rondonia", "RR": "roraima", "SC": "santa catarina", "SP": "sao paulo", "SE": "sergipe", "TO": "tocantins",
}


def unaccent(text: Column) -> Column:
    """Without accents, case kept; combining marks of decomposed letters are dropped too."""
    return F.regexp_replace(F.translate(text, _ACCENTS, _PLAIN), "[̀-ͯ]", "")


def fold(text: Column) -> Column:
    """Lower case without accents."""
    return F.lower(unaccent(text))


def words(text: Column) -> Column:
    """Folded text with every run of other characters as one space, trimmed."""
    return F.trim(F.regexp_replace(fold(text), r"[^a-z0-9]+", " "))


def normalise_uf(text: Column) -> Column:
    """Two-letter state code of a code or full name in any case, spacing and dotting, or null."""
    by_name = F.create_map(*[F.lit(x) for code, name in STATES.items() for x in (name.replace(" ", ""), code)])
    key = F.regexp_replace(fold(text), "[^a-z]", "")
    return F.when(F.upper(key).isin(list(STATES)), F.upper(key)).otherwise(F.try_element_at(by_name, key))


def deletes(token: Column, most: int = 1) -> Column:
    """The token and every string with up to `most` (1 or 2) characters left out: two tokens within that edit
    distance (a swap of neighbours counts as one) share one of these."""
    cut = lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
    one = F.when(F.length(token) > 1, cut(token)).otherwise(F.array(token))
    if most == 1:
        return F.array_distinct(F.concat(F.array(token), one))
    two = F.when(F.length(token) > 3, F.flatten(F.transform(one, cut))).otherwise(one)
    return F.array_distinct(F.concat(F.array(token), one, two))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance, where one swap of neighbouring letters counts once."""
    d = F.levenshtein(a, b)
    swap = (d == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return F.when(swap, 1).otherwise(d)
