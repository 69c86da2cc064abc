"""Problem 7: the surviving value of each field of a duplicate group.

A latent two-sided quality model: each value that some row of a group carries is true or false; a source asserts a
true value with its sensitivity and a false one with one minus its specificity, and denies a value that it doesn't
assert while it asserts another one. Several values of a field may be true (an old and a new appraisal), so one source
may assert several. A source here is a named source at a band of confidence_score, as the faults of the parsers go
with both. Expectation-maximisation infers both rates per source and the probability of every value; the rates of a
source are drawn to those of its band by a prior, so a source of few rows counts as its band does. Every value of
probability 0.5 and more is kept as true. A band is trusted if the values it asserts are true about as often as those
of the best band, and a source of a trusted band unless the model finds it worse than that beyond doubt.

Of the usable values the survivor comes from a trusted source, complete rather than cut, then the latest; where
no trusted source has one, the most probable value stands, and among equals the complete and the latest.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pregonero.session import cut, small

#: Bands of confidence_score by their lower ends; band 0 is the missing score.
CLASS_FROM = (0.0, 0.4, 0.6)
CLASS_MID = (0.3, 0.2, 0.5, 0.8)
CLASSES = len(CLASS_FROM) + 1
#: A band is trusted if its precision under the model is at most this much under the best band's.
TRUST_MARGIN = 0.07
PRIOR_ROWS = 50.0
#: The rates are fitted when none of them moves by more.
TOLERANCE = 0.005
#: Texts that stand for no description, and the page furniture that some parsers take for one.
VOID_TEXT = r"(?iu)^\W*(?:|n/?d|n/?a|null|none|erro \d+|vide edital|sem descrição|descrição não disponível|aguarde novas informações|clique para ver as fotos|<[^>]*>(?:\s*<[^>]*>)*)\W*$"
FURNITURE = r"(?isu)(?:este site utiliza cookies|carregando informações d|política de privacidade|todos os direitos reservados|atualize o navegador|mapa do site).*$"
CUT_END = r"(?isu)(?:…|\.\.\.|\[leia mais\]|[^.!?)\]\"'»”])\s*$"


def confidence_class(score: Column) -> Column:
    k = sum((F.when(score >= c, 1).otherwise(0) for c in CLASS_FROM), F.lit(0))
    return F.when(score.isNull(), 0).otherwise(F.greatest(k, F.lit(1)))


def _prior(k: int) -> tuple[float, float]:
    """Prior mean of sensitivity and false-positive rate of a band."""
    return 0.6, max(0.01, 0.5 * (1 - CLASS_MID[k]))


class QualityModel:
    """Rates per source, where source i is of the band i % CLASSES, and the log-odds of a value from who asserts and
    who denies it."""

    def __init__(self, sources: int):
        band = np.arange(sources * CLASSES) % CLASSES
        self.band = band
        self.band_sens, self.band_fpr = (np.array(x) for x in zip(*(_prior(k) for k in range(CLASSES))))
        self.band_precision = 1 - self.band_fpr
        self.sens, self.fpr, self.rate = self.band_sens[band], self.band_fpr[band], 0.5
        self.precision, self.asserted = self.band_precision[band], np.zeros(len(band))

    def step(self, sums: np.ndarray) -> float:
        """One M-step from sums (source x [true asserted, true denied, false asserted, false denied]); the largest change
        of a rate."""
        old = np.concatenate([self.sens, self.fpr])
        tp, fn, fp, tn = (np.bincount(self.band, sums[:, j], CLASSES) for j in range(4))
        s0, f0 = (np.array(x) for x in zip(*(_prior(k) for k in range(CLASSES))))
        self.band_sens = np.clip((tp + PRIOR_ROWS * s0) / (tp + fn + PRIOR_ROWS), 0.01, 0.99)
        self.band_fpr = np.clip((fp + PRIOR_ROWS * f0) / (fp + tn + PRIOR_ROWS), 0.002, 0.98)
        self.band_precision = (tp + PRIOR_ROWS * (1 - f0)) / (tp + fp + PRIOR_ROWS)
        tp, fn, fp, tn = sums.T
        self.sens = np.clip((tp + PRIOR_ROWS * self.band_sens[self.band]) / (tp + fn + PRIOR_ROWS), 0.01, 0.99)
        self.fpr = np.clip((fp + PRIOR_ROWS * self.band_fpr[self.band]) / (fp + tn + PRIOR_ROWS), 0.002, 0.98)
        self.asserted = tp + fp
        self.precision = (tp + PRIOR_ROWS * self.band_precision[self.band]) / (tp + fp + PRIOR_ROWS)
        return float(np.abs(np.concatenate([self.sens, self.fpr]) - old).max())

    def trusted(self) -> np.ndarray:
        """Whether a source is trusted: its band is, and its own precision isn't significantly (three standard errors)
        under what a band needs."""
        least = self.band_precision.max() - TRUST_MARGIN
        error = np.sqrt(np.maximum(self.precision * (1 - self.precision), 1e-4) / (self.asserted + PRIOR_ROWS))
        return (self.band_precision[self.band] >= least) & (self.precision + 3 * error >= least)

    def probability(self, said: str = "pos", denied: str = "neg") -> Column:
        pick = lambda w: (lambda s, i: s + F.element_at(F.lit([float(x) for x in w]), i + 1))
        odds = F.aggregate(said, F.lit(math.log(self.rate / (1 - self.rate))), pick(np.log(self.sens / self.fpr)))
        odds = odds + F.aggregate(denied, F.lit(0.0), pick(np.log((1 - self.sens) / (1 - self.fpr))))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), odds))))


def fit_quality(claims: DataFrame, sources: int, most_rounds: int = 500) -> QualityModel:
    """Expectation-maximisation over all claims (pos, neg: arrays of sources) until no rate moves by TOLERANCE. Claims with
    the same sources are folded first; each round is one aggregation to four numbers a source. Raises an error if the
    rates still move after most_rounds."""
    contested = claims.where(F.size("pos") + F.size("neg") > 1)
    shapes = cut(contested.groupBy("pos", "neg").agg(F.count("*").alias("w")))
    model = QualityModel(sources)
    for _ in range(most_rounds):
        who = lambda c, y: F.transform(c, lambda i: F.struct(i.alias("i"), F.lit(y).alias("y")))
        p = shapes.select("w", model.probability().alias("p"), F.explode(F.concat(who("pos", True), who("neg", False), F.array(F.struct(F.lit(-1).alias("i"), F.lit(True).alias("y"))))).alias("x"))
        share = F.col("p") * F.col("w")
        total = p.groupBy("x.i", "x.y").agg(F.sum(share).alias("t"), F.sum(F.col("w") - share).alias("f"))
        sums = np.zeros((sources * CLASSES, 4))
        rows = total.collect()  # two rows a source, and -1 for all claims
        if not rows:
            return model
        for r in rows:
            if r.i < 0:
                model.rate = min(0.95, max(0.05, r.t / (r.t + r.f)))
            else:
                sums[r.i, 0 if r.y else 1], sums[r.i, 2 if r.y else 3] = r.t, r.f
        if model.step(sums) < TOLERANCE:
            return model
    raise RuntimeError(f"the rates of the sources still move after {most_rounds} rounds")


def judge(records: DataFrame, keys: list[str], id_col: str, source: str, score: str, scraped_at: str, fields: dict[str, tuple[Column, Column]], sources: DataFrame | None = None) -> tuple[DataFrame, QualityModel]:
    """Every distinct usable value of every duplicate group and field: (the keys as __k0.., f, group_id, row_id, whole,
    pos, neg, ats, __p), __p its probability by the quality model, and that model. pos are the sources that assert the
    value, ats the latest time of each, neg those that assert another one.

    fields: name -> (usable value as a string or null, whether it is complete). Groups are two or more rows with
    equal, non-null keys; group_id is the smallest id, row_id the smallest id of the rows with exactly that value. A
    group of any size is only aggregated, never gathered: the arrays hold at most one entry a source. A missing source is
    a source of its own. sources: rows that hold all sources of the records, where they are cheaper to read.
    """
    spark = records.sparkSession
    key = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    ks = [f"__k{i}" for i in range(len(keys))]
    present = records.where(F.lit(True) if not keys else F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    named = F.coalesce(F.col(source).cast("string"), F.lit(""))
    names = sorted({""} | {r[0] for r in (records if sources is None else sources).select(named).distinct().collect()})  # one entry a source
    numbers = small(spark.createDataFrame(list(zip(names, range(len(names)))), "__name string, __i int"))
    told = present.select(
        *key, F.col(id_col).alias("__id"), named.alias("__name"), confidence_class(F.col(score)).alias("__c"), F.coalesce(F.unix_micros(F.col(scraped_at).cast("timestamp")), F.lit(-(1 << 62))).alias("__at"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("f"), v.alias("v"), c.alias("whole")) for n, (v, c) in fields.items()])).alias("__x"),
    ).join(numbers, "__name").select(*ks, "__id", (F.col("__i") * CLASSES + F.col("__c")).alias("i"), "__at", "__x.f", "__x.v", "__x.whole")
    by_source = told.groupBy(*ks, "f", "v", "i").agg(F.min("__id").alias("row_id"), F.count("*").alias("n"), F.max("whole").alias("whole"), F.max("__at").alias("at"))
    said = F.array_sort(F.collect_list(F.struct("i", "at")))
    values = by_source.groupBy(*ks, "f", "v").agg(F.min("row_id").alias("row_id"), F.sum("n").alias("n"), F.max("whole").alias("whole"), said.alias("said"))
    values = cut(values.select(*ks, "f", "row_id", "n", "whole", F.col("v").isNotNull().alias("usable"), F.transform("said", lambda x: x.i).alias("pos"), F.transform("said", lambda x: x.at).alias("ats")))
    each = values.select(*ks, "f", "row_id", "n", "usable", F.posexplode("pos").alias("at", "i"))
    totals = each.groupBy(*ks, "f").agg(
        F.min("row_id").alias("group_id"), F.sum(F.when(F.col("at") == 0, F.col("n")).otherwise(0)).alias("size"), F.collect_set(F.when(F.col("usable"), F.col("i"))).alias("all"),
    ).where(F.col("size") > 1)
    claims = values.where("usable").join(totals, [*ks, "f"]).select(*ks, "f", "group_id", "row_id", "whole", "pos", "ats", F.array_sort(F.array_except("all", "pos")).alias("neg"))
    claims = cut(claims)
    model = fit_quality(claims, len(names))
    return claims.withColumn("__p", model.probability()), model


def true_values(records: DataFrame, keys: list[str], id_col: str, source: str, score: str, scraped_at: str, fields: dict[str, tuple[Column, Column]], sources: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """(group_id, field_name, row_id, probability) of every value judged true, for fields of several values: those of at
    least that probability. The arguments are those of judge."""
    judged, model = judge(records, keys, id_col, source, score, scraped_at, fields, sources)
    out = judged.where(F.col("__p") >= least).select("group_id", F.col("f").alias("field_name"), "row_id", F.col("__p").alias("probability"))
    out.quality_model = model
    return out


def survivors(records: DataFrame, keys: list[str], id_col: str, source: str, score: str, scraped_at: str, fields: dict[str, tuple[Column, Column]], sources: DataFrame | None = None) -> DataFrame:
    """(group_id, field_name, row_id, probability, trusted): the one value per duplicate group and field, of those that
    judge gives (its arguments are the same).

    A field without a usable value gives no row. Ties go to the complete, the latest, the smallest id; missing
    scraped_at counts as the earliest.
    """
    judged, model = judge(records, keys, id_col, source, score, scraped_at, fields, sources)
    ks = [f"__k{i}" for i in range(len(keys))]
    good = F.lit([bool(x) for x in model.trusted()]) if len(model.band) else F.array().cast("array<boolean>")
    trusted_at = F.array_max(F.transform(F.filter(F.arrays_zip("pos", "ats"), lambda x: F.element_at(good, x.pos + 1)), lambda x: x.ats))
    judged = judged.withColumns({"__trusted_at": trusted_at, "__any_at": F.array_max("ats")})
    trusted = F.col("__trusted_at").isNotNull()
    rank = F.struct(
        trusted, F.when(trusted, 0.0).otherwise(F.round("__p", 1)), F.col("whole"), F.coalesce("__trusted_at", "__any_at"), -F.col("row_id"),
    )
    best = judged.groupBy(*ks, "f", "group_id").agg(F.max_by(F.struct("row_id", "__p", trusted.alias("t")), rank).alias("b"))
    out = best.select("group_id", F.col("f").alias("field_name"), F.col("b.row_id").alias("row_id"), F.col("b.__p").alias("probability"), F.col("b.t").alias("trusted"))
    out.quality_model = model
    return out


def spatial_unit_fields() -> dict[str, tuple[Column, Column]]:
    """Placeholders (areas of at most 0.01 or from 999,999; bedrooms under 0 or from 99) aren't usable."""
    area, rooms = F.col("useful_area"), F.col("bedrooms")
    return {
        "useful_area": (F.when((area > 0.01) & (area < 999_999), area.cast("decimal(12,2)").cast("string")), F.lit(True)),
        "bedrooms": (F.when((rooms >= 0) & (rooms < 99), rooms.cast("string")), F.lit(True)),
    }


def auction_lot_fields(cents: str = "centavos") -> dict[str, tuple[Column, Column]]:
    """For lots with the appraisal in centavos. A description without its page furniture is usable if it isn't void, and
    complete if it ends as a sentence and no furniture follows."""
    text = F.col("description")
    body = F.trim(F.regexp_replace(text, FURNITURE, ""))
    usable = text.isNotNull() & ~body.rlike(VOID_TEXT)
    whole = ~text.rlike(CUT_END) & ~text.rlike(FURNITURE)
    return {
        "appraisal_value": (F.when(F.col(cents) > 0, F.col(cents).cast("string")), F.lit(True)),
        "description": (F.when(usable, F.sha2(text, 256)), F.coalesce(whole, F.lit(False))),
    }


UNIT_COLUMNS = (["cri_office_id", "registry_number"], "id", "source_short_name", "confidence_score", "scraped_at")
LOT_COLUMNS = (["source_short_name", "source_lot_code"], "id", "source_short_name", "confidence_score", "scraped_at")


def spatial_unit_survivors(units: DataFrame) -> DataFrame:
    return survivors(units, *UNIT_COLUMNS, spatial_unit_fields())


def auction_lot_survivors(lots: DataFrame, cents: str = "centavos", sources: DataFrame | None = None) -> DataFrame:
    return survivors(lots, *LOT_COLUMNS, auction_lot_fields(cents), sources)
