"""Queries of the operators of the survey over whole tables, each with DuckDB SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pregonero.functions import parsers as P
from pregonero.functions.text import fold, normalise_uf, words
from pregonero.operators import relational as R
from pregonero.rules import CLAUSE_RULES, PROPERTY_RULES
from pregonero.session import table
from pregonero.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, doubles: str = "", texts: str = ""):
    """Register a query. doubles, texts: columns that both sides give as double or text, as engines hand over decimals
    and dates in different types."""
    casts = {c: "DOUBLE" for c in doubles.split()} | {c: "VARCHAR" for c in texts.split()}

    def keep(f):
        def run(spark, d):
            return f(spark, d).withColumns({c: F.col(c).cast("double" if t == "DOUBLE" else "string") for c, t in casts.items()})

        QUERIES[f.__name__] = run if casts else f
        if sql:
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS {t}) AS {c}' for c, t in casts.items())}) FROM ({sql})" if casts else sql
        return f

    return keep


# SQL pieces that the oracles share
_MONEY = """CASE WHEN regexp_matches({n}, '^-?[0-9]+([.][0-9]+)?$') THEN try_cast({n} AS DECIMAL(20,4)) END"""
_FOLD = "lower(strip_accents({c}))"
_WORDS = "trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', ' ', 'g'))"


def fold_sql(c: str) -> str:
    return _FOLD.format(c=c)


def words_sql(c: str) -> str:
    return _WORDS.format(c=c)


def clean_money_sql(c: str) -> str:
    t = f"regexp_replace({c}, '[^0-9,.-]', '', 'g')"
    dots, commas = f"(length({t}) - length(replace({t}, '.', '')))", f"(length({t}) - length(replace({t}, ',', '')))"
    n = f"CASE WHEN {dots} > 0 AND {commas} > 0 THEN replace(replace({t}, '.', ''), ',', '.') WHEN {commas} > 0 THEN replace({t}, ',', '.') WHEN {dots} > 1 THEN replace({t}, '.', '') ELSE {t} END"
    return f"(SELECT {_MONEY.format(n='n')} FROM (SELECT {n} AS n))"


def rules_sql(c: str, rules: list[tuple[str, str]], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN regexp_matches({fold_sql(c)}, '{r}') THEN '{label}'" for label, r in rules)
    return f"CASE {whens} ELSE {default} END"


# ---- sources and sinks -------------------------------------------------------------------------------------------


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def src1_csv_scan(spark, d):
    return readers.read_csv(spark, readers.round_trip(table(spark, d, "nation"), "csv"))


@query("SELECT record_id, nome, matricula FROM auctioneers_unified WHERE nome IS NOT NULL")
def src2_jsonl_scan(spark, d):
    path = readers.round_trip(table(spark, d, "auctioneers_unified").select("record_id", "nome", "matricula"), "json")
    return readers.read_jsonl(spark, path, "record_id bigint, nome string, matricula string").where(F.col("nome").isNotNull()).drop("__source_file")


@query("SELECT id, source_short_name, http_status FROM fetch_event WHERE http_status >= 400")
def src3_parquet_scan(spark, d):
    return table(spark, d, "fetch_event").where(F.col("http_status") >= 400).select("id", "source_short_name", "http_status")


@query("SELECT item_id, address.cep AS cep, address.uf AS uf, CAST(len(rounds) AS BIGINT) AS n_rounds FROM pilot_item WHERE rounds IS NOT NULL")
def snk2_parquet_nested_as_json(spark, d):
    flat = readers.nested_as_json(table(spark, d, "pilot_item").where(F.col("rounds").isNotNull()).select("item_id", "address", "rounds"))
    back = spark.read.parquet(readers.round_trip(flat, "parquet"))
    return back.select("item_id", F.get_json_object("address", "$.cep").alias("cep"), F.get_json_object("address", "$.uf").alias("uf"), F.json_array_length("rounds").cast("long").alias("n_rounds"))


@query("""SELECT item_id, rounds[1].minimum_bid_brl AS first_bid,
 array_to_string(list_transform(list_filter(rounds[2:], lambda r: r.round_number IS NOT NULL), lambda r: concat(r.round_number, '@', coalesce(r.minimum_bid_brl, ''))), '; ') AS extras FROM pilot_item WHERE len(rounds) > 0""")
def src7_nested_flatten(spark, d):
    r = F.filter(F.slice("rounds", 2, F.size("rounds")), lambda x: x.round_number.isNotNull())
    extras = F.array_join(F.transform(r, lambda x: F.concat(x.round_number.cast("string"), F.lit("@"), F.coalesce(x.minimum_bid_brl, F.lit("")))), "; ")
    return table(spark, d, "pilot_item").where(F.size("rounds") > 0).select("item_id", F.try_element_at("rounds", F.lit(1)).getField("minimum_bid_brl").alias("first_bid"), extras.alias("extras"))


@query("""SELECT 'registry' AS origin, nome AS name, uf, NULL AS base_url FROM auctioneers_unified UNION ALL SELECT 'site', short_name, NULL, base_url FROM ref_source""")
def src8_registry_union(spark, d):
    a = table(spark, d, "auctioneers_unified").select(F.lit("registry").alias("origin"), F.col("nome").alias("name"), "uf")
    b = table(spark, d, "ref_source").select(F.lit("site").alias("origin"), F.col("short_name").alias("name"), "base_url")
    return a.unionByName(b, allowMissingColumns=True)


@query(f"""WITH s AS (SELECT id, trim(x.s) AS s, x.i AS i FROM auction_lot, (SELECT unnest(string_split(description, '. ')) AS s, generate_subscripts(string_split(description, '. '), 1) AS i) x WHERE description IS NOT NULL),
 p AS (SELECT id, i, s, lag(s) OVER (PARTITION BY id ORDER BY i) AS before FROM s)
 SELECT id, CAST(i - 1 AS INTEGER) AS line_no, before AS name, regexp_extract({fold_sql('s')}, 'matricula ([0-9]+)', 1) AS registration FROM p WHERE regexp_matches({fold_sql('s')}, 'matricula [0-9]+') AND before IS NOT NULL""")
def src9_previous_line_parse(spark, d):
    return readers.previous_line(table(spark, d, "auction_lot"), "id", "description", r"\. ", r"matricula ([0-9]+)")


@query("""SELECT m.ibge_code, m.name, CAST(coalesce(u.n, m.population_last) AS BIGINT) AS population_last FROM ref_municipality m LEFT JOIN (SELECT municipality_code AS ibge_code, count(*) AS n FROM address GROUP BY 1) u USING (ibge_code)""")
def src11_staging_update(spark, d):
    staged = table(spark, d, "address").groupBy(F.col("municipality_code").alias("ibge_code")).agg(F.count("*").alias("population_last"))
    return R.update_from(table(spark, d, "ref_municipality").select("ibge_code", "name", F.col("population_last").cast("long").alias("population_last")), staged, ["ibge_code"], ["population_last"])


# ---- projection and parsers --------------------------------------------------------------------------------------


@query(f"SELECT id, {clean_money_sql('bid_initial')} AS amount FROM probe2_imoveis_with_bid", doubles="amount")
def prj1_clean_money(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.clean_money(F.col("bid_initial")).alias("amount"))


_T2 = "replace(replace(regexp_replace(appraisal_value, '[^0-9,.]', '', 'g'), '.', ''), ',', '.')"


@query(f"SELECT id, CASE WHEN regexp_matches({_T2}, '^[0-9]+([.][0-9]+)?$') THEN try_cast({_T2} AS DECIMAL(20,4)) END AS amount FROM auction_lot", doubles="amount")
def prj2_brl_to_decimal(spark, d):
    return table(spark, d, "auction_lot").select("id", P.brl_to_decimal(F.col("appraisal_value")).alias("amount"))


_T3 = "(CASE WHEN contains(bid_actual, ',') THEN replace(replace(regexp_replace(bid_actual, '[^0-9,.]', '', 'g'), '.', ''), ',', '.') ELSE regexp_replace(bid_actual, '[^0-9,.]', '', 'g') END)"


@query(f"SELECT id, CASE WHEN v > 0 THEN v END AS amount FROM (SELECT id, CASE WHEN regexp_matches({_T3}, '^[0-9]+([.][0-9]+)?$') THEN try_cast({_T3} AS DECIMAL(20,4)) END AS v FROM probe2_imoveis_with_bid)", doubles="amount")
def prj4_to_brl_mixed(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.brl_suffixed(F.col("bid_actual")).alias("amount"))


@query(f"""SELECT id, CASE WHEN NOT (contains(lot_useful_area, 'R$') OR (length(regexp_replace(lot_useful_area, '[^.]', '', 'g')) > 1 AND NOT contains(lot_useful_area, ','))) THEN {clean_money_sql('lot_useful_area')} END AS area FROM probe2_imoveis_with_bid""", doubles="area")
def prj5_area(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.area(F.col("lot_useful_area")).alias("area"))


@query("SELECT id, try_cast(regexp_replace(lot_dormitories, '[^0-9-]', '', 'g') AS INTEGER) AS bedrooms FROM probe2_imoveis_with_bid")
def prj6_loose_int(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.loose_int(F.col("lot_dormitories")).alias("bedrooms"))


@query("SELECT id, CASE WHEN regexp_matches(trim(bid_initial), '^-?[0-9]+([.][0-9]+)?$') THEN try_cast(trim(bid_initial) AS DECIMAL(20,4)) END AS amount, NULLIF(trim(lot_number), '') AS lot_number FROM probe2_imoveis_with_bid", doubles="amount")
def prj7_strict_casts(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.strict_decimal(F.col("bid_initial")).alias("amount"), P.blank_to_null(F.col("lot_number")).alias("lot_number"))


_BR = "'([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})(?:[^0-9]|$)'"


@query(f"""SELECT id, try_cast(CASE WHEN regexp_matches(auction_date_init, {_BR}) THEN concat_ws('-', CASE WHEN length(regexp_extract(auction_date_init, {_BR}, 3)) = 2 THEN '20' || regexp_extract(auction_date_init, {_BR}, 3) ELSE regexp_extract(auction_date_init, {_BR}, 3) END,
 lpad(regexp_extract(auction_date_init, {_BR}, 2), 2, '0'), lpad(regexp_extract(auction_date_init, {_BR}, 1), 2, '0')) END AS DATE) AS day FROM probe2_imoveis_with_bid""", texts="day")
def prj8_br_date(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.br_date(F.col("auction_date_init")).alias("day"))


def _uf_sql(c: str) -> str:
    from pregonero.functions.text import STATES

    key = f"regexp_replace({fold_sql(c)}, '[^a-z]', '', 'g')"
    codes = ", ".join(f"'{s}'" for s in STATES)
    names = " ".join(f"WHEN '{n.replace(' ', '')}' THEN '{s}'" for s, n in STATES.items())
    return f"CASE WHEN upper({key}) IN ({codes}) THEN upper({key}) ELSE CASE {key} {names} END END"


@query(f"SELECT id, {_uf_sql('uf')} AS uf FROM address")
def prj11_normalize_uf(spark, d):
    return table(spark, d, "address").select("id", normalise_uf(F.col("uf")).alias("uf"))


@query(f"SELECT id, {rules_sql('lot_title', PROPERTY_RULES)} AS kind FROM probe2_imoveis_with_bid")
def prj12_property_type(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.first_rule(F.col("lot_title"), PROPERTY_RULES).alias("kind"))


@query(f"SELECT item_id, coalesce({rules_sql('property_type', PROPERTY_RULES)}, 'outro') AS kind FROM pilot_item")
def prj13_type_with_default(spark, d):
    return table(spark, d, "pilot_item").select("item_id", P.first_rule(F.col("property_type"), PROPERTY_RULES, "outro").alias("kind"))


@query()
def prj18_html_text(spark, d):
    return readers.html_text(table(spark, d, "auction_lot").select("id", "description"), "description").select("id", "text")


@query("SELECT id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www[.]', '') AS host FROM fetch_event WHERE url IS NOT NULL")
def prj21_host_canonical(spark, d):
    return table(spark, d, "fetch_event").where(F.col("url").isNotNull()).select("id", P.host(F.col("url")).alias("host"))


@query(f"""SELECT record_id, trim(regexp_replace(regexp_replace({fold_sql('nome')}, '\\s*-?\\s*(leiloes\\b.*|leiloeiro oficial.*)$', ''), '[^a-z0-9]+', ' ', 'g')) AS name FROM auctioneers_unified""")
def prj23_normalize_name(spark, d):
    return table(spark, d, "auctioneers_unified").select("record_id", P.plain_name(F.col("nome")).alias("name"))


@query("""SELECT record_id, NULLIF(regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(translate(matricula, 'º°', '  '))), '^\\s*(MATRICULA|MAT|N[O.]?)\\b[.:]?', ''), '[^A-Z0-9_]', '', 'g'), '^0+([0-9A-Z])', '\\1'), '') AS registration FROM auctioneers_unified""")
def prj24_normalize_matricula(spark, d):
    """Every row: the signs of numbers end the word before a registration on both sides."""
    return table(spark, d, "auctioneers_unified").select("record_id", P.registration(F.col("matricula")).alias("registration"))


@query("SELECT record_id, NULLIF(regexp_extract(matricula, '([0-9]+) ?[/-] ?([A-Z]{2})$', 1), '') AS number, NULLIF(regexp_extract(matricula, '([0-9]+) ?[/-] ?([A-Z]{2})$', 2), '') AS uf FROM auctioneers_unified")
def prj26_registration_parts(spark, d):
    rx = r"([0-9]+) ?[/-] ?([A-Z]{2})$"
    return table(spark, d, "auctioneers_unified").select("record_id", P.group(F.col("matricula"), rx, 1).alias("number"), P.group(F.col("matricula"), rx, 2).alias("uf"))


@query("""SELECT id, NULLIF(trim(regexp_extract(strip_accents(raw_text), '([A-Z][A-Za-z ]{2,49})/([A-Z]{2})\\b', 1)), '') AS city, NULLIF(regexp_extract(strip_accents(raw_text), '([A-Z][A-Za-z ]{2,49})/([A-Z]{2})\\b', 2), '') AS uf FROM address""")
def prj28_city_uf(spark, d):
    return table(spark, d, "address").select("id", P.city_uf(F.col("raw_text")).alias("x")).select("id", F.nullif("x.city", F.lit("")).alias("city"), "x.uf")


_BLOB = "'^\\s*([^,]+),\\s*([0-9]+)[^-]*-\\s*([^,]+),\\s*([^/,-]+?)\\s*[/-]\\s*([A-Z]{2})\\b'"


@query("SELECT id, " + ", ".join(f"trim(NULLIF(regexp_extract(strip_accents(raw_text), {_BLOB}, {i}), '')) AS {n}" for i, n in enumerate(("street", "number", "district", "city", "uf"), 1)) + " FROM address")
def fn4_parse_address_blob(spark, d):
    return table(spark, d, "address").select("id", P.address_blob(F.col("raw_text")).alias("x")).select("id", "x.*")


@query(f"SELECT id, left(replace({words_sql('lot_title')}, ' ', '-'), 80) AS slug FROM probe2_imoveis_with_bid")
def prj33_slug(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.slug(F.col("lot_title")).alias("slug"))


@query("""SELECT id, concat_ws(', ', NULLIF(trim(street_type), ''), NULLIF(trim(street_name), ''), NULLIF(trim(number), ''), NULLIF(trim(district), '')) AS raw_text, CASE WHEN length(regexp_replace(cep, '[^0-9]', '', 'g')) = 8 THEN regexp_replace(cep, '[^0-9]', '', 'g') END AS cep FROM address""")
def prj34_raw_text_and_cep(spark, d):
    parts = [P.blank_to_null(F.col(c)) for c in ("street_type", "street_name", "number", "district")]
    return table(spark, d, "address").select("id", F.concat_ws(", ", *parts).alias("raw_text"), P.cep(F.col("cep")).alias("cep"))


@query("SELECT " + ", ".join(f"CAST(round(avg(CASE WHEN {c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN ('', '[]', '{{}}') THEN 1.0 ELSE 0.0 END), 6) AS DECIMAL(9,6)) AS {c}" for c in ("raw_text", "street_name", "number", "complement", "district", "uf", "cep")) + " FROM address", doubles="raw_text street_name number complement district uf cep")
def prj35_fill_rate(spark, d):
    return R.fill_rates(table(spark, d, "address"), ["raw_text", "street_name", "number", "complement", "district", "uf", "cep"])


@query("SELECT id, coalesce(NULLIF(trim(lot_neighborhood), ''), NULLIF(trim(lot_city), ''), NULLIF(trim(lot_state), '')) AS place FROM probe2_imoveis_with_bid")
def prj37_take_first(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", F.coalesce(*[P.blank_to_null(F.col(c)) for c in ("lot_neighborhood", "lot_city", "lot_state")]).alias("place"))


@query(f"""SELECT id, concat_ws(', ', NULLIF(trim(street_name), ''), CASE WHEN {fold_sql('number')} NOT IN ('s/n', 'sn', 'sem numero', '0', '') THEN trim(number) END, NULLIF(trim(district), ''), NULLIF(trim(municipality_name), ''), NULLIF(trim(uf), ''), 'Brasil') AS q FROM address""")
def prj38_geocode_query(spark, d):
    return table(spark, d, "address").select("id", P.geocode_query(*[F.col(c) for c in ("street_name", "number", "district", "municipality_name", "uf")]).alias("q"))


# ---- scalar functions --------------------------------------------------------------------------------------------


@query(f"SELECT record_id, {fold_sql('nome')} AS name FROM auctioneers_unified")
def fn1_unaccent(spark, d):
    return table(spark, d, "auctioneers_unified").select("record_id", fold(F.col("nome")).alias("name"))


_PADS = ["".join(f"{b ^ x:02x}" for b in b"0123456789abcdef0123456789abcdef".ljust(64, b"\0")) for x in (0x5C, 0x36)]


@query(f"SELECT record_id, sha256(unhex('{_PADS[0]}') || unhex(sha256(unhex('{_PADS[1]}') || encode(coalesce(matricula, ''))))) AS hash FROM auctioneers_unified")
def fn2_keyed_hash(spark, d):
    return table(spark, d, "auctioneers_unified").select("record_id", P.hmac_sha256(F.coalesce(F.col("matricula"), F.lit("")), "0123456789abcdef0123456789abcdef").alias("hash"))


@query("""SELECT record_id, concat(CASE WHEN x = '' THEN '[anonimo]' ELSE x END, ', ', '?', '/', coalesce(uf, '??')) AS label FROM (SELECT record_id, uf, array_to_string(list_transform(list_filter(regexp_split_to_array(coalesce(trim(nome), ''), ' +'), lambda w: length(w) > 2), lambda w: upper(w[1]) || '.'), ' ') AS x FROM auctioneers_unified)""")
def fn3_redacted_label(spark, d):
    return table(spark, d, "auctioneers_unified").select("record_id", P.redacted_label(F.col("nome"), F.lit(None).cast("string"), F.col("uf")).alias("label"))


@query("SELECT id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({fold_sql('description')}, '{r}') THEN '{label}' END" for label, r in CLAUSE_RULES) + "], lambda x: x IS NOT NULL), ',') AS clauses FROM auction_lot")
def fn8_all_matches(spark, d):
    return table(spark, d, "auction_lot").select("id", F.array_join(P.all_rules(F.coalesce(F.col("description"), F.lit("")), CLAUSE_RULES), ",").alias("clauses"))


@query("SELECT id, CASE WHEN length(regexp_replace(cep, '[^0-9]', '', 'g')) = 8 THEN left(regexp_replace(cep, '[^0-9]', '', 'g'), 2) END AS prefix FROM address")
def fn12_cep_prefix(spark, d):
    return table(spark, d, "address").select("id", F.left(P.cep(F.col("cep")), F.lit(2)).alias("prefix"))


@query(f"SELECT id, replace(NULLIF(regexp_extract({fold_sql('description')}, 'matricula\\s*(?:n[o.º°]*\\s*)?([0-9]{{1,3}}(?:[.][0-9]{{3}})+|[0-9]{{1,8}})', 1), ''), '.', '') AS registry_key FROM auction_lot")
def fn14_registry_key(spark, d):
    return table(spark, d, "auction_lot").select("id", P.registry_key(F.col("description")).alias("registry_key"))


def _key_sql(c, s, n):
    a, b, e = (f"coalesce(NULLIF({words_sql(x)}, ''), '')" for x in (c, s, n))
    return f"CASE WHEN {a} <> '' OR ({b} <> '' AND {e} <> '') THEN regexp_replace({a} || '|' || {b} || '|' || {e}, '^[|]+|[|]+$', '', 'g') END"


@query(f"SELECT id, {_key_sql('cep', 'street_name', 'number')} AS address_key FROM address")
def fn15_address_key(spark, d):
    return table(spark, d, "address").select("id", P.address_key(F.col("cep"), F.col("street_name"), F.col("number")).alias("address_key"))


@query("SELECT id, sha256('geo::' || lower(trim(raw_text))) AS query_hash FROM address WHERE raw_text IS NOT NULL")
def fn20_query_hash(spark, d):
    return table(spark, d, "address").where(F.col("raw_text").isNotNull()).select("id", F.sha2(F.concat(F.lit("geo::"), F.lower(F.trim("raw_text"))), 256).alias("query_hash"))


@query("SELECT source_short_name, date_trunc('month', created_at) AS month, count(*) AS n FROM fetch_event GROUP BY 1, 2")
def sf3_date_trunc(spark, d):
    return table(spark, d, "fetch_event").groupBy("source_short_name", F.date_trunc("month", "created_at").alias("month")).agg(F.count("*").alias("n"))


@query("SELECT id, CASE WHEN minimum_bid > 0 THEN CAST(round(commission_pct, 0) AS INTEGER) END AS pct, sha256(source_short_name) AS h FROM auction_lot")
def sf9_hash_and_round(spark, d):
    return table(spark, d, "auction_lot").select("id", F.when(F.col("minimum_bid") > 0, F.round("commission_pct", 0).cast("int")).alias("pct"), F.sha2("source_short_name", 256).alias("h"))


# ---- filters -----------------------------------------------------------------------------------------------------


@query("""SELECT CASE WHEN trim(coalesce(source_lot_url, '')) = '' THEN 'no_url' WHEN trim(coalesce(auctioneer_slug, '')) = '' THEN 'no_auctioneer' ELSE 'kept' END AS outcome, count(*) AS n FROM pilot_item GROUP BY 1""")
def flt1_validation_drop(spark, d):
    why = R.first_failure([("no_url", P.blank_to_null(F.col("source_lot_url")).isNotNull()), ("no_auctioneer", P.blank_to_null(F.col("auctioneer_slug")).isNotNull())])
    return table(spark, d, "pilot_item").groupBy(F.coalesce(why, F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT source_short_name, count(*) AS n FROM fetch_event, (SELECT max(created_at) AS as_of FROM fetch_event) WHERE created_at > as_of - INTERVAL 30 DAY GROUP BY 1")
def flt4_rolling_window(spark, d):
    e = table(spark, d, "fetch_event").select("source_short_name", "created_at")
    as_of = e.agg(F.max("created_at").alias("as_of"))
    return e.crossJoin(F.broadcast(as_of)).where(F.col("created_at") > F.col("as_of") - F.expr("INTERVAL 30 DAYS")).groupBy("source_short_name").agg(F.count("*").alias("n"))


@query("SELECT id, current_status FROM auction_lot WHERE source_short_name IN ('martelo-vivo', 'lance-azul') AND source_lot_code LIKE '1%' AND current_status NOT IN ('cancelado')")
def flt5_membership(spark, d):
    c = F.col
    return table(spark, d, "auction_lot").where(c("source_short_name").isin("martelo-vivo", "lance-azul") & c("source_lot_code").like("1%") & ~c("current_status").isin("cancelado")).select("id", "current_status")


@query(f"SELECT id, CASE WHEN regexp_matches({fold_sql('lot_title')}, 'apartamento|casa|terreno') THEN true WHEN regexp_matches({fold_sql('lot_title')}, 'vaga|loja') THEN false END AS keep FROM probe2_imoveis_with_bid", texts="keep")
def flt6_three_valued(spark, d):
    t = fold(F.col("lot_title"))
    return table(spark, d, "probe2_imoveis_with_bid").select("id", F.when(t.rlike("apartamento|casa|terreno"), True).when(t.rlike("vaga|loja"), False).alias("keep"))


@query("""WITH f AS (SELECT id, source_short_name, coalesce(error_message IS NULL AND http_status = 200, false) AS good, error_message IS NULL AS fair FROM fetch_event), g AS (SELECT DISTINCT * FROM f), w AS (SELECT *, bool_or(good) OVER (PARTITION BY source_short_name) AS any_good FROM g) SELECT id FROM w WHERE CASE WHEN any_good THEN good ELSE fair END""")
def flt9_health_with_fallback(spark, d):
    f = table(spark, d, "fetch_event").select("id", "source_short_name", F.coalesce(F.col("error_message").isNull() & (F.col("http_status") == 200), F.lit(False)).alias("good"), F.col("error_message").isNull().alias("fair")).distinct()
    tier = f.groupBy("source_short_name").agg(F.bool_or("good").alias("any_good"))
    return f.join(tier, "source_short_name").where(F.when(F.col("any_good"), F.col("good")).otherwise(F.col("fair"))).select("id")


# ---- joins -------------------------------------------------------------------------------------------------------


@query("""SELECT l.id, l.lot_number, s.kind, s.useful_area, m.name AS municipality, r.source_kind FROM auction_lot l LEFT JOIN spatial_unit s ON s.id = l.spatial_unit_id LEFT JOIN address a ON a.id = s.address_id LEFT JOIN ref_municipality m ON m.ibge_code = a.municipality_code LEFT JOIN ref_source r ON r.short_name = l.source_short_name""", doubles="useful_area")
def j2_star_join(spark, d):
    t = lambda n: table(spark, d, n)
    units = t("spatial_unit").select(F.col("id").alias("spatial_unit_id"), "kind", "useful_area", "address_id")
    places = t("address").select(F.col("id").alias("address_id"), F.col("municipality_code").alias("ibge_code"))
    towns = t("ref_municipality").select("ibge_code", F.col("name").alias("municipality"))
    sites = t("ref_source").select(F.col("short_name").alias("source_short_name"), "source_kind")
    return R.left_chain(t("auction_lot").select("id", "lot_number", "spatial_unit_id", "source_short_name"), [(units, "spatial_unit_id"), (places, "address_id"), (towns, "ibge_code"), (sites, "source_short_name")]).select("id", "lot_number", "kind", "useful_area", "municipality", "source_kind")


@query("SELECT id FROM auction_lot l WHERE NOT EXISTS (SELECT 1 FROM lot_canonical_link k WHERE k.secondary_lot_id = l.id)")
def j3_hide_secondaries(spark, d):
    links = table(spark, d, "lot_canonical_link").select(F.col("secondary_lot_id").alias("id"))
    return table(spark, d, "auction_lot").select("id").join(links, "id", "left_anti")


@query("SELECT id FROM spatial_unit u WHERE EXISTS (SELECT 1 FROM auction_lot l WHERE l.spatial_unit_id = u.id AND l.minimum_bid > 100000)")
def j4_semi(spark, d):
    lots = table(spark, d, "auction_lot").where(F.col("minimum_bid") > 100000).select(F.col("spatial_unit_id").alias("id"))
    return table(spark, d, "spatial_unit").select("id").join(lots, "id", "left_semi")


@query("SELECT r.short_name, (SELECT max(created_at) FROM fetch_event f WHERE f.source_short_name = r.short_name) AS last_seen FROM ref_source r")
def j5_scalar_subquery(spark, d):
    last = table(spark, d, "fetch_event").groupBy(F.col("source_short_name").alias("short_name")).agg(F.max("created_at").alias("last_seen"))
    return table(spark, d, "ref_source").select("short_name").join(last, "short_name", "left")


@query("""SELECT u.id, coalesce((SELECT string_agg(l.lot_number || ':' || l.id, ',' ORDER BY l.id) FROM auction_lot l WHERE l.spatial_unit_id = u.id AND l.lot_number IS NOT NULL), '') AS lots FROM spatial_unit u""")
def j6_nested_collection(spark, d):
    lots = table(spark, d, "auction_lot").where(F.col("lot_number").isNotNull()).select(F.col("spatial_unit_id").alias("pid"), "id", "lot_number")
    kids = R.ordered_children(lots, ["pid"], ["id"], ["lot_number"]).select(F.col("pid").alias("id"), F.transform("children", lambda x: F.concat(x.lot_number, F.lit(":"), x.id.cast("string"))).alias("c"))
    return table(spark, d, "spatial_unit").select("id").join(kids, "id", "left").select("id", F.coalesce(F.array_join("c", ","), F.lit("")).alias("lots"))


_TRI = "list_distinct(flatten(list_transform(list_filter(string_split({w}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"


@query(f"""WITH a AS (SELECT DISTINCT {words_sql('municipality_name')} AS w, uf FROM address WHERE municipality_name IS NOT NULL AND uf IS NOT NULL AND trim(municipality_name) <> ''), m AS (SELECT ibge_code, uf, {words_sql('name')} AS w FROM ref_municipality),
 p AS (SELECT a.w, a.uf, m.ibge_code, a.w = m.w AS exact, {_TRI.format(w='a.w')} AS x, {_TRI.format(w='m.w')} AS y FROM a JOIN m USING (uf)),
 s AS (SELECT *, len(list_intersect(x, y)) / greatest(len(list_distinct(list_concat(x, y))), 1) AS sim FROM p)
 SELECT w AS name, uf, ibge_code FROM (SELECT *, row_number() OVER (PARTITION BY w, uf ORDER BY exact DESC, round(sim, 9) DESC, ibge_code) AS k FROM s WHERE exact OR sim >= 0.6) WHERE k = 1""")
def j8_fuzzy_blocked_match(spark, d):
    names = table(spark, d, "address").where(F.col("uf").isNotNull() & (F.trim("municipality_name") != "")).select(words(F.col("municipality_name")).alias("name"), "uf").distinct()
    return R.trigram_match(names, table(spark, d, "ref_municipality").select("ibge_code", "uf", words(F.col("name")).alias("of")), "name", "of", "uf", "ibge_code", 0.6)


_HAV = "2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(latitude + 23.5) / 2), 2) + cos(radians(-23.5)) * cos(radians(latitude)) * pow(sin(radians(longitude + 46.6) / 2), 2), 1.0)))"


@query(f"SELECT id, CAST(round({_HAV}, 2) AS DECIMAL(10,2)) AS km FROM address WHERE latitude IS NOT NULL AND {_HAV} <= 400", doubles="km")
def j10_radius(spark, d):
    return R.within_km(table(spark, d, "address").select("id", "latitude", "longitude"), -23.5, -46.6, 400.0, "latitude", "longitude").select("id", F.round("km", 2).cast("decimal(10,2)").alias("km"))


@query("""WITH r AS (SELECT source_kind, short_name FROM ref_source), t AS (SELECT source_short_name AS short_name, count(*) AS lots FROM auction_lot GROUP BY 1), u AS (SELECT source_short_name AS short_name, count(*) AS units FROM spatial_unit GROUP BY 1) SELECT short_name, source_kind, coalesce(lots, 0) AS lots, coalesce(units, 0) AS units FROM r LEFT JOIN t USING (short_name) LEFT JOIN u USING (short_name)""")
def j11_using_join(spark, d):
    n = lambda t, c: table(spark, d, t).groupBy(F.col("source_short_name").alias("short_name")).agg(F.count("*").alias(c))
    got = table(spark, d, "ref_source").select("short_name", "source_kind").join(n("auction_lot", "lots"), "short_name", "left").join(n("spatial_unit", "units"), "short_name", "left")
    return got.fillna(0, ["lots", "units"])


@query("""WITH keep AS (SELECT cri_office_id, registry_number, min(id) AS kept FROM spatial_unit GROUP BY 1, 2) SELECT l.id, k.kept AS spatial_unit_id FROM auction_lot l JOIN spatial_unit u ON u.id = l.spatial_unit_id JOIN keep k ON k.cri_office_id = u.cri_office_id AND k.registry_number = u.registry_number""")
def j12_repoint_keys(spark, d):
    u = table(spark, d, "spatial_unit").select("id", "cri_office_id", "registry_number")
    kept = u.groupBy("cri_office_id", "registry_number").agg(F.min("id").alias("kept"))
    to = u.join(kept, ["cri_office_id", "registry_number"]).select(F.col("id").alias("spatial_unit_id"), "kept")
    return table(spark, d, "auction_lot").select("id", "spatial_unit_id").join(to, "spatial_unit_id").select("id", F.col("kept").alias("spatial_unit_id"))


_N = "regexp_replace(matricula, '[^0-9]', '', 'g')"


@query("SELECT l.id FROM auction_lot l WHERE EXISTS (SELECT 1 FROM probe2_imoveis_with_bid p WHERE p.source_short_name = l.source_short_name AND p.lot_number = l.lot_number)")
def j15_tuple_semi(spark, d):
    p = table(spark, d, "probe2_imoveis_with_bid").select("source_short_name", "lot_number")
    return table(spark, d, "auction_lot").select("id", "source_short_name", "lot_number").join(p, ["source_short_name", "lot_number"], "left_semi").select("id")


@query("""WITH last AS (SELECT url, id, http_status FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY created_at DESC, id DESC) AS k FROM (SELECT DISTINCT id, url, created_at, http_status FROM fetch_event)) WHERE k = 1) SELECT l.id, f.http_status FROM auction_lot l LEFT JOIN last f ON f.url = l.source_url""")
def j16_lookup_last_wins(spark, d):
    f = table(spark, d, "fetch_event").select("id", "url", "created_at", "http_status").distinct()
    last = R.first_by(f, ["url"], [F.col("created_at").desc(), F.col("id").desc()]).select(F.col("url").alias("source_url"), "http_status")
    return table(spark, d, "auction_lot").select("id", "source_url").join(last, "source_url", "left").select("id", "http_status")


@query()
def j17_cache_lookup_geocoded(spark, d):
    """The cache holds the texts that have a position; j17_cache_lookup simulates one by even ids."""
    q = table(spark, d, "address").where(F.col("raw_text").isNotNull()).select("id", F.sha2(F.lower(F.trim("raw_text")), 256).alias("h"), (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias("known"))
    cached = q.where("known").select("h").distinct().withColumn("hit", F.lit(True))
    return q.join(cached, "h", "left").select("id", F.coalesce("hit", F.lit(False)).alias("hit"))


# ---- aggregates --------------------------------------------------------------------------------------------------


@query("""SELECT source_short_name, scraper_name, count(*) AS fetches, count(*) FILTER (WHERE fetch_status = 'success') AS good, CAST(round(100.0 * count(*) FILTER (WHERE fetch_status = 'success') / count(*), 2) AS DECIMAL(6,2)) AS pct FROM fetch_event GROUP BY 1, 2""", doubles="pct")
def agg1_health(spark, d):
    good = F.count_if(F.col("fetch_status") == "success")
    return table(spark, d, "fetch_event").groupBy("source_short_name", "scraper_name").agg(F.count("*").alias("fetches"), good.alias("good"), F.round(good * 100.0 / F.count("*"), 2).cast("decimal(6,2)").alias("pct"))


@query("SELECT r.short_name, count(l.id) AS lots, max(l.scraped_at) AS last_seen FROM ref_source r LEFT JOIN auction_lot l ON l.source_short_name = r.short_name GROUP BY 1")
def agg2_outer_counts(spark, d):
    lots = table(spark, d, "auction_lot").select(F.col("source_short_name").alias("short_name"), "id", "scraped_at")
    return table(spark, d, "ref_source").select("short_name").join(lots, "short_name", "left").groupBy("short_name").agg(F.count("id").alias("lots"), F.max("scraped_at").alias("last_seen"))


@query("""WITH b AS (SELECT a.uf, s.kind, l.id, l.minimum_bid FROM auction_lot l JOIN spatial_unit s ON s.id = l.spatial_unit_id JOIN address a ON a.id = s.address_id WHERE a.uf IS NOT NULL),
 k AS (SELECT uf, kind, count(*) AS n FROM b GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY uf ORDER BY n DESC, kind) AS i FROM k)
 SELECT t.uf, t.lots, t.priced, coalesce(string_agg(coalesce(r.kind, '?') || '=' || r.n, ',' ORDER BY r.i), '') AS top_kinds FROM (SELECT uf, count(*) AS lots, count(minimum_bid) AS priced FROM b GROUP BY uf) t LEFT JOIN r ON r.uf = t.uf AND r.i <= 5 GROUP BY 1, 2, 3""")
def agg3_region_stats(spark, d):
    b = _lots_by_place(spark, d).where(F.col("uf").isNotNull())
    top = R.top_k(b.groupBy("uf", "kind").agg(F.count("*").alias("n")), ["uf"], [F.col("n").desc(), F.col("kind").asc_nulls_last()], 5)
    lists = R.ordered_children(top, ["uf"], ["k"], ["kind", "n"]).select("uf", F.array_join(F.transform("children", lambda x: F.concat(F.coalesce(x.kind, F.lit("?")), F.lit("="), x.n.cast("string"))), ",").alias("top_kinds"))
    return b.groupBy("uf").agg(F.count("*").alias("lots"), F.count("minimum_bid").alias("priced")).join(lists, "uf", "left").withColumn("top_kinds", F.coalesce("top_kinds", F.lit("")))


def _lots_by_place(spark, d, *more: str) -> DataFrame:
    lots = table(spark, d, "auction_lot").select("id", "spatial_unit_id", "minimum_bid", *more)
    units = table(spark, d, "spatial_unit").select(F.col("id").alias("spatial_unit_id"), "kind", "address_id")
    places = table(spark, d, "address").select(F.col("id").alias("address_id"), "uf", "municipality_code", "district")
    return lots.join(units, "spatial_unit_id").join(places, "address_id")


@query("""WITH b AS (SELECT a.uf, a.municipality_code AS code, a.district FROM auction_lot l JOIN spatial_unit s ON s.id = l.spatial_unit_id JOIN address a ON a.id = s.address_id WHERE a.municipality_code IS NOT NULL AND trim(a.district) <> ''),
 k AS (SELECT code, district, count(*) AS n FROM b GROUP BY 1, 2) SELECT code, district, n, CAST(i AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, district) AS i FROM k) WHERE i <= 15""")
def agg4_top_districts(spark, d):
    b = _lots_by_place(spark, d).where(F.col("municipality_code").isNotNull() & (F.trim("district") != ""))
    n = b.groupBy(F.col("municipality_code").alias("code"), "district").agg(F.count("*").alias("n"))
    return R.top_k(n, ["code"], [F.col("n").desc(), F.col("district").asc()], 15, "place")


@query("SELECT source_short_name, array_to_string(list_sort(coalesce(list(DISTINCT kind) FILTER (WHERE useful_area > 50), [])), ',') AS kinds FROM spatial_unit GROUP BY 1")
def agg5_distinct_array_filtered(spark, d):
    return table(spark, d, "spatial_unit").groupBy("source_short_name").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("useful_area") > 50, F.col("kind")))), ",").alias("kinds"))


@query("SELECT name, min(uf) AS uf FROM ref_municipality GROUP BY name HAVING count(*) = 1")
def agg7_having(spark, d):
    return table(spark, d, "ref_municipality").groupBy("name").agg(F.min("uf").alias("uf"), F.count("*").alias("n")).where("n = 1").drop("n")


@query("""WITH g AS (SELECT source_short_name, count(*) AS n, count(*) FILTER (WHERE error_message IS NOT NULL) AS bad FROM fetch_event GROUP BY 1) SELECT source_short_name, n, bad, CAST(round(100.0 * bad / n, 2) AS DECIMAL(6,2)) AS pct FROM g WHERE 100 * bad > 5 * n""", doubles="pct")
def agg8_audit_ratio(spark, d):
    g = table(spark, d, "fetch_event").groupBy("source_short_name").agg(F.count("*").alias("n"), F.count_if(F.col("error_message").isNotNull()).alias("bad"))
    return g.where(F.col("bad") * 100 > F.col("n") * 5).withColumn("pct", F.round(F.col("bad") * 100.0 / F.col("n"), 2).cast("decimal(6,2)"))


@query("SELECT coalesce(lower(lang), '(none)') AS value, count(*) AS n, CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS DECIMAL(9,4)) AS pct FROM documents GROUP BY 1", doubles="pct")
def agg10_value_counts(spark, d):
    return R.value_counts(table(spark, d, "documents").select(F.lower("lang").alias("lang")), "lang")


@query("""SELECT CASE WHEN minimum_bid IS NULL THEN '(none)' WHEN minimum_bid < 50000 THEN '0-50k' WHEN minimum_bid < 100000 THEN '50-100k' WHEN minimum_bid < 250000 THEN '100-250k' WHEN minimum_bid < 1000000 THEN '250k-1M' ELSE '1M+' END AS bucket, count(*) AS n FROM auction_lot GROUP BY 1""")
def agg11_buckets(spark, d):
    return R.histogram(table(spark, d, "auction_lot"), "minimum_bid", [("0-50k", 50_000), ("50-100k", 100_000), ("100-250k", 250_000), ("250k-1M", 1_000_000)], "1M+")


@query("SELECT min(minimum_bid) AS low, CAST(round(CAST(median(CAST(minimum_bid AS DOUBLE)) AS DECIMAL(20,4)), 2) AS DECIMAL(18,2)) AS mid, CAST(round(sum(minimum_bid) / count(minimum_bid), 2) AS DECIMAL(18,2)) AS mean, max(minimum_bid) AS high FROM auction_lot", doubles="low mid mean high")
def agg12_describe(spark, d):
    m = F.col("minimum_bid")
    return table(spark, d, "auction_lot").agg(F.min(m).alias("low"), F.round(F.median(m.cast("double")).cast("decimal(20,4)"), 2).cast("decimal(18,2)").alias("mid"), F.round(F.sum(m) / F.count(m), 2).cast("decimal(18,2)").alias("mean"), F.max(m).alias("high"))


@query("""WITH f AS (SELECT * FROM (SELECT avg((street_name IS NOT NULL)::INT) AS street_name, avg((number IS NOT NULL)::INT) AS number, avg((complement IS NOT NULL)::INT) AS complement, avg((cep IS NOT NULL)::INT) AS cep FROM address) UNPIVOT (fill FOR field IN (street_name, number, complement, cep)))
 SELECT field, CAST(round((1 - fill) * CASE field WHEN 'cep' THEN 3 WHEN 'street_name' THEN 2 ELSE 1 END, 2) AS DECIMAL(9,2)) AS gap FROM f""", doubles="gap")
def agg13_gap_score(spark, d):
    return R.gap_scores(table(spark, d, "address"), {"street_name": 2, "number": 1, "complement": 1, "cep": 3})


@query("SELECT count(DISTINCT nome) AS names, count(DISTINCT regexp_replace(innlei_email, '^.*@', '')) AS hosts FROM auctioneers_unified")
def agg14_distinct(spark, d):
    return table(spark, d, "auctioneers_unified").agg(F.count_distinct("nome").alias("names"), F.count_distinct(F.regexp_replace("innlei_email", "^.*@", "")).alias("hosts"))


@query("""SELECT uf, count(*) FILTER (WHERE source_kind = 'both') AS both_n, count(*) FILTER (WHERE source_kind = 'innlei_only') AS innlei_n, count(*) FILTER (WHERE source_kind = 'junta_only') AS junta_n FROM auctioneers_unified GROUP BY uf""")
def agg15_pivot(spark, d):
    p = table(spark, d, "auctioneers_unified").groupBy("uf").pivot("source_kind", ["both", "innlei_only", "junta_only"]).count().fillna(0)
    return p.select("uf", F.col("both").alias("both_n"), F.col("innlei_only").alias("innlei_n"), F.col("junta_only").alias("junta_n"))


@query("""SELECT bucket, n, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT DISTINCT id FROM fetch_event f WHERE CASE WHEN f.error_message IS NOT NULL THEN 'error' WHEN f.http_status >= 400 THEN 'http' WHEN f.response_size_bytes IS NULL THEN 'empty' ELSE 'ok' END = bucket ORDER BY id LIMIT 3)) AS samples
 FROM (SELECT CASE WHEN error_message IS NOT NULL THEN 'error' WHEN http_status >= 400 THEN 'http' WHEN response_size_bytes IS NULL THEN 'empty' ELSE 'ok' END AS bucket, count(DISTINCT id) AS n FROM fetch_event GROUP BY 1)""")
def agg18_root_causes(spark, d):
    f = table(spark, d, "fetch_event")
    bucket = F.when(F.col("error_message").isNotNull(), "error").when(F.col("http_status") >= 400, "http").when(F.col("response_size_bytes").isNull(), "empty").otherwise("ok")
    rows = f.select("id", bucket.alias("bucket")).distinct()
    # three ids per bucket: the limit of the rank goes below the shuffle, so no task gathers a bucket
    few = R.ordered_children(R.top_k(rows, ["bucket"], [F.col("id").asc()], 3), ["bucket"], ["k"], ["id"])
    samples = few.select("bucket", F.array_join(F.transform("children", lambda x: x.id.cast("string")), ",").alias("samples"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n")).join(samples, "bucket")


# ---- windows, order, sets ----------------------------------------------------------------------------------------


@query("SELECT short_name, lots, CAST(k AS INTEGER) AS place FROM (SELECT source_short_name AS short_name, count(*) AS lots, row_number() OVER (ORDER BY count(*) DESC, source_short_name) AS k FROM auction_lot GROUP BY 1) WHERE k <= 10")
def win1_row_number_top(spark, d):
    n = table(spark, d, "auction_lot").groupBy(F.col("source_short_name").alias("short_name")).agg(F.count("*").alias("lots"))
    return R.top_k(n.withColumn("one", F.lit(1)), ["one"], [F.col("lots").desc(), F.col("short_name").asc()], 10, "place").drop("one")


@query("SELECT ibge_code, count(*) OVER (PARTITION BY name) AS namesakes FROM ref_municipality")
def win2_count_over(spark, d):
    return table(spark, d, "ref_municipality").select("ibge_code", F.count("*").over(Window.partitionBy("name")).alias("namesakes"))


@query("SELECT DISTINCT ON (source_short_name, source_lot_code) source_short_name, source_lot_code, id FROM auction_lot ORDER BY source_short_name, source_lot_code, scraped_at DESC, id")
def win3_distinct_on(spark, d):
    return R.first_by(table(spark, d, "auction_lot").select("source_short_name", "source_lot_code", "scraped_at", "id"), ["source_short_name", "source_lot_code"], [F.col("scraped_at").desc_nulls_first(), F.col("id").asc()]).drop("scraped_at")


@query("SELECT source_short_name, id, scraped_at, lag(scraped_at) OVER (PARTITION BY source_short_name, source_lot_code ORDER BY scraped_at, id) AS before FROM auction_lot")
def win7_previous_snapshot(spark, d):
    w = Window.partitionBy("source_short_name", "source_lot_code").orderBy(F.col("scraped_at").asc_nulls_last(), "id")
    return table(spark, d, "auction_lot").select("source_short_name", "id", "scraped_at", F.lag("scraped_at").over(w).alias("before"))


@query("SELECT id, minimum_bid FROM auction_lot ORDER BY (appraisal_value IS NOT NULL) DESC, minimum_bid DESC NULLS LAST, id LIMIT 50", doubles="minimum_bid")
def srt2_priority_limit(spark, d):
    return table(spark, d, "auction_lot").orderBy(F.col("appraisal_value").isNotNull().desc(), F.col("minimum_bid").desc_nulls_last(), "id").limit(50).select("id", "minimum_bid")


@query("SELECT 'auction_lot' AS t, count(*) AS n FROM auction_lot UNION ALL SELECT 'spatial_unit', count(*) FROM spatial_unit UNION ALL SELECT 'address', count(*) FROM address")
def set2_metrics_union(spark, d):
    return R.row_counts({t: table(spark, d, t) for t in ("auction_lot", "spatial_unit", "address")})


# ---- deduplication and upsert ------------------------------------------------------------------------------------


@query("SELECT DISTINCT ON (source_lot_url) source_lot_url, item_id FROM pilot_item WHERE source_lot_url IS NOT NULL ORDER BY source_lot_url, scraped_at, item_id")
def ups1_first_url(spark, d):
    p = table(spark, d, "pilot_item").where(F.col("source_lot_url").isNotNull()).select("source_lot_url", "item_id", "scraped_at")
    return R.first_by(p, ["source_lot_url"], [F.col("scraped_at").asc_nulls_last(), F.col("item_id").asc()]).drop("scraped_at")


@query("""WITH o AS (SELECT source_short_name, source_lot_code, id, scraped_at, current_status, minimum_bid, description, row_number() OVER (PARTITION BY source_short_name, source_lot_code ORDER BY scraped_at DESC NULLS LAST, id DESC) AS k FROM auction_lot)
 SELECT source_short_name, source_lot_code, max(current_status) FILTER (WHERE k = 1) AS current_status, arg_min(minimum_bid, k) FILTER (WHERE minimum_bid IS NOT NULL) AS minimum_bid, sha256(arg_min(description, k) FILTER (WHERE description IS NOT NULL)) AS description FROM o GROUP BY 1, 2""", doubles="minimum_bid")
def ups5_fold_observations(spark, d):
    got = R.upsert_fold(table(spark, d, "auction_lot").select("source_short_name", "source_lot_code", "id", "scraped_at", "current_status", "minimum_bid", "description"), ["source_short_name", "source_lot_code"], ["scraped_at", "id"], {"current_status": "overwrite", "minimum_bid": "coalesce", "description": "coalesce"})
    return got.withColumn("description", F.sha2("description", 256))


@query("""WITH o AS (SELECT id, current_status, last_seen_at FROM auction_lot), n AS (SELECT canonical_lot_id AS id, max(created_at) AS seen FROM lot_canonical_link WHERE canonical_lot_id IS NOT NULL GROUP BY 1) SELECT o.id, current_status, coalesce(n.seen, o.last_seen_at) AS last_seen_at FROM o LEFT JOIN n USING (id)""")
def ups6_status_only(spark, d):
    seen = table(spark, d, "lot_canonical_link").where(F.col("canonical_lot_id").isNotNull()).groupBy(F.col("canonical_lot_id").alias("id")).agg(F.max("created_at").alias("last_seen_at"))
    return R.update_from(table(spark, d, "auction_lot").select("id", "current_status", "last_seen_at"), seen, ["id"], ["last_seen_at"])


@query("""SELECT id, spatial_unit_id FROM auction_lot WHERE spatial_unit_id NOT IN (SELECT spatial_unit_id FROM auction_lot WHERE current_status = 'suspenso' AND spatial_unit_id IS NOT NULL) UNION ALL SELECT id, spatial_unit_id FROM auction_lot WHERE current_status = 'suspenso' AND spatial_unit_id IS NOT NULL""")
def ups9_replace_children(spark, d):
    old = table(spark, d, "auction_lot").where(F.col("spatial_unit_id").isNotNull()).select("id", "spatial_unit_id", "current_status")
    return R.replace_children(old.drop("current_status"), old.where("current_status = 'suspenso'").drop("current_status"), ["spatial_unit_id"])


@query("""SELECT DISTINCT ON (secondary_lot_id) secondary_lot_id, canonical_lot_id FROM lot_canonical_link WHERE secondary_lot_id IS NOT NULL AND canonical_lot_id IS NOT NULL AND canonical_lot_id <> secondary_lot_id ORDER BY secondary_lot_id, confidence DESC NULLS LAST, canonical_lot_id, id""")
def ups12_canonical_link(spark, d):
    k = table(spark, d, "lot_canonical_link").where(F.col("canonical_lot_id") != F.col("secondary_lot_id")).select("secondary_lot_id", "canonical_lot_id", "confidence", "id")
    return R.first_by(k, ["secondary_lot_id"], [F.col("confidence").desc_nulls_last(), F.col("canonical_lot_id").asc(), F.col("id").asc()]).select("secondary_lot_id", "canonical_lot_id")


@query("""WITH m AS (SELECT id, min(id) OVER (PARTITION BY cri_office_id, registry_number) AS kept FROM spatial_unit) SELECT kept AS id, count(*) AS merged FROM m GROUP BY 1""")
def ups14_historical_dedup(spark, d):
    u = table(spark, d, "spatial_unit")
    return u.groupBy("cri_office_id", "registry_number").agg(F.min("id").alias("id"), F.count("*").alias("merged")).select("id", "merged")


@query("SELECT id, CASE WHEN created_at >= as_of - INTERVAL 6 MONTH THEN url_hash END AS url_hash FROM (SELECT DISTINCT id, created_at, url_hash FROM fetch_event), (SELECT max(created_at) AS as_of FROM fetch_event)")
def ups16_expire(spark, d):
    f = table(spark, d, "fetch_event").select("id", "created_at", "url_hash").distinct()
    as_of = table(spark, d, "fetch_event").agg(F.max("created_at").alias("as_of"))
    return f.crossJoin(F.broadcast(as_of)).select("id", F.when(F.col("created_at") >= F.col("as_of") - F.expr("INTERVAL 6 MONTHS"), F.col("url_hash")).alias("url_hash"))


@query(f"""SELECT a.id, coalesce({_uf_sql('a.uf')}, m.uf, u.uf) AS uf FROM address a LEFT JOIN ref_municipality m ON m.ibge_code = a.municipality_code LEFT JOIN (SELECT name, min(uf) AS uf FROM ref_municipality GROUP BY name HAVING count(*) = 1) u ON u.name = a.municipality_name""")
def ups20_cascade(spark, d):
    ref = table(spark, d, "ref_municipality")
    by_code = ref.select(F.col("ibge_code").alias("municipality_code"), F.col("uf").alias("u1"))
    by_name = ref.groupBy(F.col("name").alias("municipality_name")).agg(F.min("uf").alias("u2"), F.count("*").alias("n")).where("n = 1").drop("n")
    a = table(spark, d, "address").select("id", "uf", "municipality_code", "municipality_name").join(by_code, "municipality_code", "left").join(by_name, "municipality_name", "left")
    return a.select("id", F.coalesce(normalise_uf(F.col("uf")), "u1", "u2").alias("uf"))


# ---- text rules, validation --------------------------------------------------------------------------------------


@query(f"SELECT id, CAST(least(3, {' + '.join(f'(regexp_matches({fold_sql(chr(100) + chr(101) + chr(115) + chr(99) + chr(114) + chr(105) + chr(112) + chr(116) + chr(105) + chr(111) + chr(110))}, {chr(39)}{r}{chr(39)}))::INT' for _, r in CLAUSE_RULES)}) AS INTEGER) AS score FROM auction_lot WHERE description IS NOT NULL")
def agg19_keyword_score(spark, d):
    return table(spark, d, "auction_lot").where(F.col("description").isNotNull()).select("id", F.least(F.lit(3), F.size(P.all_rules(F.col("description"), CLAUSE_RULES))).alias("score"))


@query("""SELECT 'uf' AS field, count(*) AS violations FROM address WHERE uf IS NOT NULL AND NOT regexp_matches(uf, '^[A-Z]{2}$') UNION ALL SELECT 'municipality_code', count(*) FROM address WHERE municipality_code IS NOT NULL AND NOT regexp_matches(municipality_code, '^[0-9]{7}$') UNION ALL SELECT 'cep', count(*) FROM address WHERE cep IS NOT NULL AND NOT regexp_matches(cep, '^[0-9]{8}$')""")
def dq1_domain_checks(spark, d):
    rules = {"uf": "^[A-Z]{2}$", "municipality_code": "^[0-9]{7}$", "cep": "^[0-9]{8}$"}
    return R.domain_violations(table(spark, d, "address"), rules)


@query("SELECT id, 'self_link' AS failed FROM lot_canonical_link WHERE canonical_lot_id = secondary_lot_id UNION ALL SELECT id, 'confidence' FROM lot_canonical_link WHERE NOT (confidence BETWEEN 0 AND 100)")
def dq2_row_checks(spark, d):
    return R.failed_checks(table(spark, d, "lot_canonical_link"), "id", {"self_link": F.col("canonical_lot_id") != F.col("secondary_lot_id"), "confidence": F.col("confidence").between(0, 100)})


@query("SELECT 'duplicate_id' AS failed, id FROM fetch_event GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'orphan_lot', id FROM auction_lot WHERE spatial_unit_id IS NOT NULL AND spatial_unit_id NOT IN (SELECT id FROM spatial_unit)")
def dq3_keys(spark, d):
    twice = R.duplicate_keys(table(spark, d, "fetch_event"), ["id"]).select(F.lit("duplicate_id").alias("failed"), "id")
    lots = table(spark, d, "auction_lot").where(F.col("spatial_unit_id").isNotNull()).select("id", "spatial_unit_id")
    orphans = lots.join(table(spark, d, "spatial_unit").select(F.col("id").alias("spatial_unit_id")), "spatial_unit_id", "left_anti")
    return twice.unionByName(orphans.select(F.lit("orphan_lot").alias("failed"), "id"))


@query("""SELECT item_id, array_to_string(list_filter([CASE WHEN title IS NULL OR trim(title) = '' THEN 'title' END, CASE WHEN address.raw_text IS NULL OR trim(address.raw_text) = '' THEN 'raw_text' END, CASE WHEN auction_status IS NULL OR trim(auction_status) = '' THEN 'status' END, CASE WHEN coalesce(len(list_filter(rounds, lambda r: r.minimum_bid_brl IS NOT NULL)), 0) = 0 THEN 'round' END], lambda x: x IS NOT NULL), ',') AS failures FROM pilot_item""")
def dq5_hard_rules(spark, d):
    checks = {"title": P.blank_to_null(F.col("title")).isNotNull(), "raw_text": P.blank_to_null(F.col("address.raw_text")).isNotNull(), "status": P.blank_to_null(F.col("auction_status")).isNotNull(), "round": F.coalesce(F.exists("rounds", lambda r: r.minimum_bid_brl.isNotNull()), F.lit(False))}
    return table(spark, d, "pilot_item").select("item_id", F.array_join(R.failure_list(checks), ",").alias("failures"))


@query("""WITH f AS (SELECT DISTINCT id, source_short_name, created_at FROM fetch_event), m AS (SELECT max(created_at) AS as_of FROM f) SELECT source_short_name, count(*) AS total, count(*) FILTER (WHERE created_at > as_of - INTERVAL 24 HOUR) AS last_24h FROM f, m GROUP BY 1""")
def dq10_degradation(spark, d):
    f = table(spark, d, "fetch_event").select("id", "source_short_name", "created_at").distinct()
    as_of = table(spark, d, "fetch_event").agg(F.max("created_at").alias("as_of"))
    return f.crossJoin(F.broadcast(as_of)).groupBy("source_short_name").agg(F.count("*").alias("total"), F.count_if(F.col("created_at") > F.col("as_of") - F.expr("INTERVAL 24 HOURS")).alias("last_24h"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(round(sum(CAST(value AS DECIMAL(18,4))), 2) AS DECIMAL(20,2)) AS total FROM events GROUP BY 1", doubles="total")
def stream_event_totals(spark, d):
    from pregonero.streaming.jobs import event_totals

    return event_totals(spark, d)
