"""Amounts of money in mixed notations, units and scales -> centavos.

A value is read once into (number, unit written with it, currency mark). A unit written with the value wins, then a
unit that the record states for its figures. Where neither exists the unit is inferred: the logarithms of amounts
follow one mixture of normals, and each unit shifts it by its known conversion factor. The shifts are fixed; the
mixture is fitted to the amounts whose unit is stated and the weights of the units to the bare ones, both by
expectation-maximisation over a histogram of all rows (its size depends on the range of the logarithm, not on the
rows). Each bare value takes the unit of the largest posterior; a posterior under 0.95 is flagged.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pregonero.functions.timestamps import barrier

# Unit -> centavos.
UNITS = {"centavos": 1, "reais": 100, "mil": 100_000, "milhoes": 100_000_000}
# Portuguese number words without accents.
NUMBER_WORDS = {
    "um": 1, "uma": 1, "dois": 2, "duas": 2, "tres": 3, "quatro": 4, "cinco": 5, "seis": 6, "sete": 7, "oito": 8, "nove": 9, "dez": 10, "onze": 11,
    "doze": 12, "treze": 13, "quatorze": 14, "catorze": 14, "quinze": 15, "dezesseis": 16, "dezasseis": 16, "dezessete": 17, "dezassete": 17,
    "dezoito": 18, "dezenove": 19, "dezanove": 19, "vinte": 20, "trinta": 30, "quarenta": 40, "cinquenta": 50, "cincoenta": 50, "sessenta": 60,
    "setenta": 70, "oitenta": 80, "noventa": 90, "cem": 100, "cento": 100, "duzentos": 200, "duzentas": 200, "trezentos": 300, "trezentas": 300,
    "quatrocentos": 400, "quatrocentas": 400, "quinhentos": 500, "quinhentas": 500, "seiscentos": 600, "seiscentas": 600, "setecentos": 700,
    "setecentas": 700, "oitocentos": 800, "oitocentas": 800, "novecentos": 900, "novecentas": 900,
}
_ACCENTS, _PLAIN = "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"
_UNIT = r"(k|mil|mm|mi|milhao|milhoes|cent|cents|centavos?)"
#: currency, number, exponent, unit, currency word
NUMBER = r"^\s*(r\$|brl|rs)?\s*(\d+(?:[.,]\d+)*)(?:,-)?(?:e(\d{1,2}))?\s*" + _UNIT + r"?\.?\s*(?:de\s+)?(reais|real|brl)?\s*(?:\([^)]*\))?\s*$"
_FIGURES = r"(?:valor|valores|quantia|quantias|preco|precos|montante|montantes|importancia|importancias|cifra|cifras)\b[^.;)]*?\bem\s+"  # within a sentence, however long
STATED = {
    "centavos": _FIGURES + r"centavos",
    "milhoes": _FIGURES + r"(?:r\$\s*(?:x|em)?\s*)?(?:milhoes|1\.000\.000|mi\b|mm\b)",
    "mil": _FIGURES + r"(?:r\$\s*(?:x|em)?\s*)?(?:mil\b|milhares|1\.?000\b)",
}


def plain(text: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(text), _ACCENTS, _PLAIN)


def stated_unit(*texts: Column) -> Column:
    """The unit that a record states for its figures ("valores expressos em milhares de reais"), or null."""
    text = plain(F.concat_ws(" . ", *texts))
    has = text.rlike(_FIGURES)
    out = F.lit(None).cast("string")
    for unit, regex in reversed(STATED.items()):
        out = F.when(text.rlike(regex), unit).otherwise(out)
    return F.when(has, out)


def words_to_centavos(text: Column) -> Column:
    """Centavos of an amount in Portuguese number words, or null if another word occurs."""
    numbers = F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in kv])
    tokens = F.filter(F.split(F.trim(F.regexp_replace(plain(text), r"[^a-z]+", " ")), " "), lambda w: (w != "e") & (w != "de") & (w != ""))
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("done"), zero.alias("cur"), zero.alias("cents"), F.lit(True).alias("ok"))

    def step(s: Column, w: Column) -> Column:
        n = F.try_element_at(numbers, w)
        thousand, million = w == "mil", w.isin("milhao", "milhoes")
        reais, cents = w.isin("real", "reais"), w.isin("centavo", "centavos")
        return F.struct(
            F.when(thousand, s.done + F.greatest(s.cur, F.lit(1).cast("long")) * 1000).when(million, (s.done + s.cur) * 1_000_000)
            .when(reais, (s.done + s.cur)).otherwise(s.done).alias("done"),
            F.when(n.isNotNull(), s.cur + n).otherwise(zero).alias("cur"),
            F.when(reais, s.done * 100 + s.cur * 100).when(cents, s.cents + s.cur).otherwise(s.cents).alias("cents"),
            (s.ok & (n.isNotNull() | thousand | million | reais | cents)).alias("ok"),
        )

    end = F.aggregate(tokens, start, step)
    return F.when(text.rlike(r"^\s*\p{L}[\p{L}\s]*(?:reais|real|centavos?)\s*$"), F.when(end.ok & (end.cents > 0), end.cents))


def read_amounts(df: DataFrame, value: str, hint: Column) -> DataFrame:
    """Add am_number decimal, am_unit (written or stated, or null), am_bare (no unit and no currency), am_digits
    (decimals) and am_words (centavos of an amount in words). Everything is null for a text without an amount."""
    keep = df.columns
    low = plain(F.col(value))
    group = lambda i: F.nullif(F.regexp_extract(F.col("__low"), NUMBER, i), F.lit(""))
    step = barrier(df, keep, {"__low": low})
    numeric = step.columns
    # the second barrier holds the groups of the one pattern
    step = barrier(step, numeric, {"__cur": group(1), "__num": group(2), "__exp": group(3), "__unit": group(4), "__money": group(5)})
    unit = (
        F.when(F.col("__unit").isin("k", "mil"), "mil").when(F.col("__unit").isin("mm", "mi", "milhao", "milhoes"), "milhoes")
        .when(F.col("__unit").isNotNull(), "centavos")
    )
    bare = F.col("__num").isNotNull() & F.col("__unit").isNull() & F.col("__cur").isNull() & F.col("__money").isNull() & F.col("__exp").isNull()
    step = barrier(step, [*keep, "__num", "__exp", "__low"], {
        "__u": F.when(unit.isNotNull(), unit).when(F.col("__num").isNotNull() & ~bare, "reais").when(bare, hint),
        "__bare": bare, "__hinted": bare & hint.isNotNull(), "__word_unit": unit.isNotNull(),
    })
    n = F.col("__num")
    dots, commas = F.length(n) - F.length(F.replace(n, F.lit("."))), F.length(n) - F.length(F.replace(n, F.lit(",")))
    # one separator and three digits after it are thousands, but a comma before a unit, or any in figures whose unit the record states, is decimal
    three = n.rlike(r"[.,]\d{3}$")
    decimal_comma = F.regexp_replace(F.replace(n, F.lit(".")), ",", ".")
    decimal_point = F.replace(n, F.lit(","))
    no_separator = F.regexp_replace(n, "[.,]", "")
    text = (
        F.when((dots == 0) & (commas == 0), n)
        .when((dots > 0) & (commas > 0), F.when(F.instr(F.reverse(n), ",") < F.instr(F.reverse(n), "."), decimal_comma).otherwise(decimal_point))
        .when((dots > 1) | (commas > 1), no_separator)
        .when(three & ~F.col("__hinted") & ~(F.col("__word_unit") & (commas == 1)), no_separator)
        .when(commas == 1, decimal_comma)
        .otherwise(n)
    )
    step = barrier(step, [*keep, "__exp", "__u", "__bare", "__low"], {"__text": text})
    factor = F.coalesce(F.pow(F.lit(10.0), F.col("__exp").try_cast("int")).try_cast("decimal(13,0)"), F.lit(1).cast("decimal(13,0)"))
    return barrier(step, keep, {
        "am_number": (F.col("__text").try_cast("decimal(24,9)") * factor).try_cast("decimal(30,9)"),
        "am_unit": F.col("__u"), "am_bare": F.col("__bare") & F.col("__u").isNull(),
        "am_digits": F.when(F.instr(F.col("__text"), ".") > 0, F.length(F.substring_index(F.col("__text"), ".", -1))).otherwise(0),
        "am_words": F.when(F.col("__text").isNull(), words_to_centavos(F.col("__low"))),
    })


def _settled(before: float, now: float, count: float) -> bool:
    """Whether a log-likelihood has stopped to rise: by under 10^-7 a value."""
    return now - before < 1e-7 * count


def _fit_base(x: np.ndarray, n: np.ndarray, parts: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixture of normals over binned logarithms x with counts n, until the likelihood stops to rise."""
    order = np.argsort(x)
    x, n = x[order], n[order].astype(float)
    share = np.cumsum(n) / n.sum()
    mu = np.array([x[min(np.searchsorted(share, q), len(x) - 1)] for q in (0.3, 0.7, 0.995)[:parts]])
    sd = np.full(parts, max(1.0, math.sqrt(np.cov(x, fweights=n.astype(int)) if n.sum() > 2 else 1.0)))
    w, before = np.full(parts, 1 / parts), -math.inf
    while True:
        r = w * np.exp(-0.5 * ((x[:, None] - mu) / sd) ** 2) / sd + 1e-300
        now = float((np.log(r.sum(1)) * n).sum())
        if _settled(before, now, n.sum()):
            return w, mu, sd
        before = now
        r = r / r.sum(1, keepdims=True) * n[:, None]
        total = r.sum(0) + 1e-9
        mu = (r * x[:, None]).sum(0) / total
        sd = np.sqrt((r * (x[:, None] - mu) ** 2).sum(0) / total + 0.05)
        w = (total + 0.5) / (total + 0.5).sum()


class UnitModel:
    """Mixture over the logarithm of reais, shifted by the factor of each unit, with a normal for the logarithm of the
    ratio to another amount of the record (the anchor) where there is one."""

    def __init__(self, base, ratio: tuple[float, float], weights: dict[str, float]):
        self.base, self.ratio, self.weights = base, ratio, weights

    def density(self, x):
        w, mu, sd = self.base
        return (w * np.exp(-0.5 * ((np.asarray(x)[:, None] - mu) / sd) ** 2) / sd).sum(1) + 1e-12

    def ratio_density(self, r):
        m, s = self.ratio
        return np.where(np.isnan(r), 1.0, np.exp(-0.5 * ((r - m) / s) ** 2) / s + 1e-9)

    def column(self, log_reais: Column, log_anchor: Column, unit: str) -> Column:
        shift = math.log(UNITS[unit] / 100)
        w, mu, sd = self.base
        x = log_reais + shift
        g = F.lit(1e-12)
        for a, m, s in zip(w, mu, sd):
            g = g + F.exp(F.pow((x - float(m)) / float(s), F.lit(2.0)) * -0.5) * float(a / s)
        m, s = self.ratio
        r = F.exp(F.pow((x - log_anchor - float(m)) / float(s), F.lit(2.0)) * -0.5) / float(s) + 1e-9
        return g * F.coalesce(r, F.lit(1.0)) * float(self.weights[unit])


BIN = 0.1


def fit_units(read: DataFrame, anchor: Column) -> UnitModel:
    """Fit the model to all rows of read_amounts. Only a histogram comes to the driver: bins of 0.1 of the two
    logarithms by decimals and unit, a few thousand numbers however many the rows are."""
    value = F.ln(F.col("am_number").cast("double"))
    bins = lambda c: F.round(c / BIN).cast("int")
    usable = read.where((F.col("am_number") > 0) & (F.col("am_bare") | F.col("am_unit").isNotNull()))
    rows = (
        usable.groupBy(bins(value).alias("v"), bins(F.ln(F.when(anchor > 0, anchor).cast("double"))).alias("a"), F.least(F.col("am_digits"), F.lit(9)).alias("d"), "am_unit")
        .count().collect()
    )
    known = [(r.v * BIN + math.log(UNITS[r.am_unit] / 100), None if r.a is None else r.a * BIN, r["count"]) for r in rows if r.am_unit]
    open_ = [(r.v * BIN, math.nan if r.a is None else r.a * BIN, r.d, r["count"]) for r in rows if not r.am_unit]
    # bare values with two decimals are the usual notation for reais: they are the bulk, and the base is fitted to them and the stated ones
    base_rows = known + [(v, a, n) for v, a, d, n in open_ if d == 2]
    if not base_rows:
        base_rows = [(12.0, None, 1)]
    base = _fit_base(np.array([v for v, _, _ in base_rows]), np.array([n for _, _, n in base_rows]))
    ratios = [(v - a, n) for v, a, n in base_rows if a is not None and not math.isnan(a)]
    if ratios:
        r, n = np.array(ratios).T
        mean = float(np.average(r, weights=n))
        ratio = (mean, max(0.5, float(math.sqrt(np.average((r - mean) ** 2, weights=n)))))
    else:
        ratio = (0.0, 10.0)
    units = list(UNITS)
    model = UnitModel(base, ratio, dict.fromkeys(units, 1 / len(units)))
    if open_:
        v, a, d, n = (np.array(c, dtype=float) for c in zip(*open_))
        allowed = np.stack([d <= max(0, math.log10(UNITS[u])) for u in units], 1)
        like = np.stack([model.density(v + (s := math.log(UNITS[u] / 100))) * model.ratio_density(v + s - a) for u in units], 1) * allowed
        w, before = np.full(len(units), 1 / len(units)), -math.inf
        while True:
            r = like * w
            now = float((np.log(r.sum(1) + 1e-300) * n).sum())
            if _settled(before, now, n.sum()):
                break
            before = now
            r = r / (r.sum(1, keepdims=True) + 1e-300) * n[:, None]
            w = (r.sum(0) + 0.01) / (r.sum() + 0.04)
        model.weights = dict(zip(units, map(float, w)))
    return model


def with_centavos(read: DataFrame, model: UnitModel, anchor: Column) -> DataFrame:
    """Add centavos (long, rounded half up), unit, posterior and uncertain. centavos is null where no amount is stated
    and from 10^16 on."""
    keep = [c for c in read.columns if not c.startswith("am_")]
    log_reais = F.ln(F.when(F.col("am_number") > 0, F.col("am_number")).cast("double"))
    log_anchor = F.ln(F.when(anchor > 0, anchor).cast("double"))
    allowed = lambda u: F.col("am_digits") <= round(math.log10(UNITS[u]))
    rest = [c for c in read.columns if c.startswith("am_")]
    step = barrier(read, [*keep, *rest], {f"__p_{u}": F.when(F.col("am_bare") & allowed(u), model.column(log_reais, log_anchor, u)).otherwise(0.0) for u in UNITS})
    p = {u: F.col(f"__p_{u}") for u in UNITS}
    total, best = sum(p.values(), F.lit(0.0)), F.greatest(*p.values())
    guess = F.coalesce(*[F.when((v == best) & (best > 0), u) for u, v in p.items()], F.lit("reais"))
    step = barrier(step, [*keep, *rest], {
        "unit": F.when(F.col("am_words").isNotNull(), "reais").otherwise(F.coalesce(F.col("am_unit"), F.when(F.col("am_bare"), guess))),
        "posterior": F.when(F.col("am_bare"), F.try_divide(best, total)).otherwise(1.0),
    })
    factors = F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv])
    exact = F.col("am_number") * F.try_element_at(factors, F.col("unit")).cast("decimal(9,0)")
    cents = F.coalesce(F.col("am_words"), F.when(exact < 10**16, F.round(exact, 0).cast("long")))
    return barrier(step, keep, {"centavos": cents, "unit": F.col("unit"), "posterior": F.col("posterior"), "uncertain": F.col("posterior") < 0.95})
