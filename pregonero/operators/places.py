"""Jobs that fill places: cities to codes, states by a cascade of passes, addresses for lots without one, creditors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pregonero.functions import places as L
from pregonero.functions.parsers import blank_to_null
from pregonero.functions.text import fold, normalise_uf, words
from pregonero.operators.relational import trigram_match

# Fixed value: the one municipality of the Distrito Federal; places in it that match no name are of it.
DF_CODE = "5300108"
LEAST_SIMILARITY = 0.6


def municipality_codes(names: DataFrame, reference: DataFrame) -> DataFrame:
    """FN5: (name, uf, code) of distinct folded names in a state: equal name, else the most similar one of the state, else the
    one municipality of the DF, else null."""
    of = reference.select("ibge_code", "uf", words(F.col("name")).alias("of"))
    got = trigram_match(names, of, "name", "of", "uf", "ibge_code", LEAST_SIMILARITY)
    return names.join(got, ["name", "uf"], "left").select("name", "uf", F.coalesce("ibge_code", F.when(F.col("uf") == "DF", DF_CODE)).alias("code"))


def _unique_names(reference: DataFrame) -> DataFrame:
    """(city, of_city): folded names that exist once, with their state."""
    return reference.groupBy(fold(F.col("name")).alias("city")).agg(F.min("uf").alias("of_city"), F.count("*").alias("n")).where("n = 1").drop("n")


def state_of_named_city(rows: DataFrame, id_col: str, text: str, reference: DataFrame) -> DataFrame:
    """FN11: (id, uf): the state of the first city that a text names and that exists in one state only."""
    told = rows.select(id_col, F.posexplode(L.city_candidates(F.col(text))).alias("o", "city"))
    best = told.join(_unique_names(reference), "city").groupBy(id_col).agg(F.min_by("of_city", "o").alias("uf"))
    return rows.select(id_col).join(best, id_col, "left")


def fill_states(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """UPS20: (id, uf) by the first pass that gives a state: the column, the text, a city that the text names, the postal
    code, a city after the last dash, the name of a state, the code of the municipality."""
    text = F.coalesce("raw_text", F.lit(""))
    base = rows.select("id", "uf", "cep", "municipality_code", "raw_text", text.alias("t"))
    named = state_of_named_city(base, "id", "t", reference).withColumnRenamed("uf", "by_city")
    dash = _unique_names(reference).withColumnRenamed("of_city", "by_dash")
    code = reference.select(F.col("ibge_code").alias("code"), F.col("uf").alias("by_code"))
    digits = F.coalesce(F.when(F.col("raw_text").rlike(r"^\d{7}$"), F.col("raw_text")), F.col("municipality_code"))
    got = base.withColumns({"city": F.trim(F.regexp_extract(fold(F.col("t")), r" - ([a-z][a-z .]*)$", 1)), "code": digits}).join(named, "id", "left").join(dash, "city", "left").join(code, "code", "left")
    return got.select("id", F.coalesce(normalise_uf(F.col("uf")), L.state_of_text(F.col("t")), "by_city", L.state_of_cep(F.col("cep")), "by_dash", L.state_named(F.col("t")), "by_code").alias("uf"))


def bootstrap_addresses(lots: DataFrame, reference: DataFrame) -> DataFrame:
    """UPS18: (lot_id, uf, municipality_code, geocoding_source, raw_text, kind): a minimal address for each of the lots (those
    without one) whose text of at least ten letters names a city with its state."""
    told = lots.where(F.length(F.trim("text")) >= 10).select("lot_id", "text", L.city_and_state(F.col("text")).alias("x")).where("x.city is not null")
    told = told.select("lot_id", "text", words(F.col("x.city")).alias("name"), F.col("x.uf").alias("uf"))
    codes = municipality_codes(told.select("name", "uf").distinct(), reference).where("code is not null")
    return told.join(codes, ["name", "uf"]).select("lot_id", "uf", F.col("code").alias("municipality_code"), F.lit("municipality_centroid_bootstrap").alias("geocoding_source"), F.col("text").alias("raw_text"), F.lit("desconhecida").alias("kind"))


def normalise_pending(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """UPS19: addresses without a code, with the parts that their text (or else the joined parts) tells put before the old
    ones, and the code of the city; a found code also marks where the position comes from."""
    parts = F.concat_ws(" ", *[blank_to_null(F.col(c)) for c in ("street_name", "number", "district", "complement")])
    pending = rows.where("municipality_code is null").withColumn("__x", L.labelled_address(F.coalesce(F.nullif("raw_text", F.lit("")), parts)))
    pending = pending.withColumn("__w", words(F.col("__x.city")))
    names = pending.where("__w is not null and __x.uf is not null").select(F.col("__w").alias("name"), F.col("__x.uf").alias("uf")).distinct()
    codes = municipality_codes(names, reference).select(F.col("name").alias("__w"), F.col("uf").alias("__u"), "code")
    got = pending.withColumn("__u", F.col("__x.uf")).join(codes, ["__w", "__u"], "left")
    new = {"street_name": "street", "number": "number", "district": "district", "cep": "cep", "uf": "uf"}
    return got.select(
        "id", *[F.coalesce(F.col(f"__x.{n}"), F.col(c)).alias(c) for c, n in new.items()], F.col("code").alias("municipality_code"),
        F.coalesce("geocoding_source", F.when(F.col("code").isNotNull(), "municipality_centroid")).alias("geocoding_source"),
    )


def creditor_roles(lots: DataFrame, id_col: str, text: str, least: int = 20) -> DataFrame:
    """UPS17: distinct (display_name, lot_id, role) of the creditors that the text of a lot names; texts under `least` letters
    are left out. Run twice, it gives the same rows."""
    told = lots.where(F.length(text) >= least).select(F.explode(L.creditors(F.col(text))).alias("display_name"), F.col(id_col).alias("lot_id"))
    return told.withColumn("role", F.lit("fiduciario")).distinct()
