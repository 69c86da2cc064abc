"""More survey operators over whole tables: sources and sinks, joins, aggregates, windows, upsert jobs, validation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pregonero.functions import parsers as P
from pregonero.functions.text import fold, normalise_uf, words
from pregonero.operators import jobs as J
from pregonero.operators import relational as R
from pregonero.plans.reference_queries import _lots_by_place, _uf_sql, fold_sql, query, rules_sql, words_sql
from pregonero.rules import CLAUSE_RULES, PROPERTY_RULES
from pregonero.session import table
from pregonero.sources import readers

# ---- sources and sinks -------------------------------------------------------------------------------------------


@query("SELECT CAST(id AS BIGINT) AS id, lot_title AS title FROM probe2_imoveis_with_bid WHERE lot_title IS NOT NULL")
def src6_paged_json(spark, d):
    t = table(spark, d, "probe2_imoveis_with_bid").where(F.col("lot_title").isNotNull()).select("id", F.col("lot_title").alias("title"))
    pages = t.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(F.collect_list(F.struct("id", "title")).alias("data"))
    got = spark.read.schema("page bigint, data array<struct<id: bigint, title: string>>").json(readers.round_trip(pages, "json"))
    return readers.flatten_pages(got, "data")


@query("SELECT id, bid_initial AS price FROM probe2_imoveis_with_bid WHERE bid_initial IS NOT NULL")
def src14_inline_json(spark, d):
    t = table(spark, d, "probe2_imoveis_with_bid").where(F.col("bid_initial").isNotNull())
    page = F.concat(F.lit("<script>var loadData="), F.to_json(F.struct("id", F.col("bid_initial").alias("price"))), F.lit(";</script><p>x</p>"))
    return readers.inline_json(t.select(page.alias("html")), "html", r"var loadData=(\{.*?\});", "id bigint, price string")


@query("SELECT short_name, source_kind FROM ref_source")
def src13_xml_elements(spark, d):
    path = readers.round_trip_xml(table(spark, d, "ref_source").select("short_name", "source_kind"), "listing")
    return readers.read_xml(spark, path, "listing", "short_name string, source_kind string")


@query("SELECT id, CAST(minimum_bid AS VARCHAR) AS minimum_bid FROM auction_lot WHERE minimum_bid IS NOT NULL")
def snk1_jsonl_decimals_as_text(spark, d):
    rows = table(spark, d, "auction_lot").where(F.col("minimum_bid").isNotNull()).select("id", F.col("minimum_bid").cast("string").alias("minimum_bid"))
    return spark.read.schema("id bigint, minimum_bid string").json(readers.round_trip(rows, "json"))


@query("SELECT kind, count(u.id) AS n FROM (VALUES ('static'), ('casa'), ('apartamento'), ('galpao')) k(kind) LEFT JOIN spatial_unit u USING (kind) GROUP BY 1")
def snk5_fixed_domain_counts(spark, d):
    return R.fixed_domain_counts(table(spark, d, "spatial_unit"), "kind", ["static", "casa", "apartamento", "galpao"])


@query("SELECT CASE WHEN title IS NULL OR source_lot_url IS NULL THEN 'quarantine' ELSE 'loaded' END AS outcome, count(*) AS n FROM pilot_item GROUP BY 1")
def snk6_quarantine(spark, d):
    good, bad = J.quarantine(table(spark, d, "pilot_item"), F.col("title").isNotNull() & F.col("source_lot_url").isNotNull())
    n = lambda x, t: x.select(F.lit(t).alias("outcome"))
    return n(good, "loaded").unionByName(n(bad, "quarantine")).groupBy("outcome").agg(F.count("*").alias("n"))


# ---- parsers -----------------------------------------------------------------------------------------------------


@query("SELECT item_id, NULLIF(regexp_extract(description, 'Referência interna ([A-Z]?[0-9]+)', 1), '') AS ref, NULLIF(regexp_extract(description, 'com área de ([0-9.,]+) m²', 1), '') AS area FROM pilot_item")
def labelled_fields_of_items(spark, d):
    t = F.col("description")
    return table(spark, d, "pilot_item").select("item_id", P.group(t, r"Referência interna ([A-Z]?[0-9]+)", 1).alias("ref"), P.group(t, r"com área de ([0-9.,]+) m²", 1).alias("area"))


@query("SELECT id, coalesce(NULLIF(trim(bid_actual), ''), NULLIF(trim(bid_initial), '')) AS price FROM probe2_imoveis_with_bid")
def prj30_price_precedence(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").select("id", F.coalesce(P.blank_to_null(F.col("bid_actual")), P.blank_to_null(F.col("bid_initial"))).alias("price"))


@query("SELECT id, CASE WHEN NOT list_contains(others, minimum_bid) THEN minimum_bid END AS minimum_bid FROM (SELECT l.id, l.minimum_bid, coalesce(list(o.minimum_bid) FILTER (WHERE o.id IS NOT NULL AND o.minimum_bid IS NOT NULL), []) AS others FROM auction_lot l LEFT JOIN auction_lot o ON o.auction_id = l.auction_id AND o.id <> l.id GROUP BY l.id, l.minimum_bid)", doubles="minimum_bid")
def prj31_contamination_guard(spark, d):
    # a price that another lot of the auction shows too: counted per (auction, price), no pairs within an auction
    lots = table(spark, d, "auction_lot").select("id", "auction_id", "minimum_bid")
    times = lots.groupBy(F.col("auction_id").alias("a"), F.col("minimum_bid").alias("m")).agg(F.count("*").alias("times"))
    joined = lots.join(times, (F.col("auction_id") == F.col("a")) & (F.col("minimum_bid") == F.col("m")), "left")
    return joined.select("id", F.when(F.coalesce(F.col("times"), F.lit(1)) == 1, F.col("minimum_bid")).alias("minimum_bid"))


@query(f"SELECT id, concat_ws('-', coalesce(NULLIF(replace({words_sql('kind')}, ' ', '-'), ''), 'imovel'), CAST(id AS VARCHAR)) AS slug FROM spatial_unit")
def fn18_slug(spark, d):
    return table(spark, d, "spatial_unit").select("id", F.concat_ws("-", F.coalesce(F.nullif(P.slug(F.col("kind")), F.lit("")), F.lit("imovel")), F.col("id").cast("string")).alias("slug"))


@query("SELECT id, CAST(round(least(1.0, greatest(coalesce(CAST(confidence_score AS DOUBLE), 0.0), CASE WHEN useful_area IS NOT NULL THEN 0.55 ELSE 0.0 END)), 2) AS DOUBLE) AS confidence FROM spatial_unit")
def fn19_confidence(spark, d):
    floor = F.when(F.col("useful_area").isNotNull(), 0.55).otherwise(0.0)
    return table(spark, d, "spatial_unit").select("id", F.round(F.least(F.lit(1.0), F.greatest(F.coalesce(F.col("confidence_score").cast("double"), F.lit(0.0)), floor)), 2).alias("confidence"))


@query("SELECT name AS name, CAST(len(list_intersect(x, y)) * 1.0 / greatest(len(list_distinct(list_concat(x, y))), 1) AS DOUBLE) AS sim FROM (SELECT name, " + "list_distinct(flatten(list_transform(list_filter(string_split({a}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))".replace("{a}", words_sql("name")) + " AS x, " + "list_distinct(flatten(list_transform(list_filter(string_split({a}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))".replace("{a}", words_sql("alt_name")) + " AS y FROM ref_municipality WHERE alt_name IS NOT NULL)")
def fn6_trigram_similarity(spark, d):
    return table(spark, d, "ref_municipality").where(F.col("alt_name").isNotNull()).select("name", P.similarity(F.col("name"), F.col("alt_name")).alias("sim"))


# ---- joins and filters -------------------------------------------------------------------------------------------


@query("SELECT l.id, s.kind FROM auction_lot l JOIN spatial_unit s ON s.id = l.spatial_unit_id WHERE l.current_status <> 'cancelado'")
def j1_inner_active(spark, d):
    units = table(spark, d, "spatial_unit").select(F.col("id").alias("spatial_unit_id"), "kind")
    return table(spark, d, "auction_lot").where("current_status <> 'cancelado'").select("id", "spatial_unit_id").join(units, "spatial_unit_id").select("id", "kind")


@query("SELECT item_id, r.round_number, r.status_raw FROM pilot_item LEFT JOIN LATERAL (SELECT unnest(rounds) AS r) x ON true")
def j7_lateral(spark, d):
    return table(spark, d, "pilot_item").select("item_id", F.explode_outer("rounds").alias("r")).select("item_id", "r.round_number", "r.status_raw")


@query("SELECT short_name, base_url, 'known' AS origin FROM ref_source UNION ALL SELECT DISTINCT auctioneer_slug, NULL, 'new' FROM pilot_item WHERE auctioneer_slug NOT IN (SELECT short_name FROM ref_source)")
def j18_append_unknown(spark, d):
    known = table(spark, d, "ref_source").select("short_name", "base_url", F.lit("known").alias("origin"))
    new = table(spark, d, "pilot_item").where(F.col("auctioneer_slug").isNotNull()).select(F.col("auctioneer_slug").alias("short_name")).distinct()
    return R.insert_ignore(known, new.select("short_name", F.lit(None).cast("string").alias("base_url"), F.lit("new").alias("origin")), ["short_name"])


@query(f"SELECT id FROM probe2_imoveis_with_bid WHERE regexp_matches({fold_sql('lot_title')}, 'casa|apartamento') AND NOT regexp_matches({fold_sql('lot_title')}, 'vaga')")
def flt7_strict_filter(spark, d):
    t = fold(F.col("lot_title"))
    return table(spark, d, "probe2_imoveis_with_bid").where(t.rlike("casa|apartamento") & ~t.rlike("vaga")).select("id")


@query("SELECT id FROM address, (SELECT max(updated_at) AS as_of FROM address) WHERE updated_at IS NULL OR updated_at < as_of - INTERVAL 1 HOUR")
def flt10_not_tried_recently(spark, d):
    a = table(spark, d, "address").select("id", "updated_at")
    as_of = a.agg(F.max("updated_at").alias("as_of"))
    return a.crossJoin(F.broadcast(as_of)).where(F.col("updated_at").isNull() | (F.col("updated_at") < F.col("as_of") - F.expr("INTERVAL 1 HOUR"))).select("id")


# ---- aggregates, windows, order, sets ----------------------------------------------------------------------------


@query("SELECT auction_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS lots, CAST(count(*) AS BIGINT) AS n FROM auction_lot WHERE auction_id IS NOT NULL GROUP BY 1")
def agg6_ordered_list(spark, d):
    kids = R.ordered_children(table(spark, d, "auction_lot").where(F.col("auction_id").isNotNull()), ["auction_id"], ["id"], [])
    return kids.select("auction_id", F.array_join(F.transform("children", lambda x: x.id.cast("string")), ",").alias("lots"), F.size("children").cast("long").alias("n"))


@query("SELECT item_id, CAST(round(fill / 4.0, 2) AS DOUBLE) AS mean_fill FROM (SELECT item_id, (title IS NOT NULL)::INT + (description IS NOT NULL)::INT + (area_sqm IS NOT NULL)::INT + (market_value_brl IS NOT NULL)::INT AS fill FROM pilot_item)")
def agg16_mean_of_map(spark, d):
    cols = ["title", "description", "area_sqm", "market_value_brl"]
    fills = F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).isNotNull().cast("double"))])
    mean = F.aggregate(F.map_values(fills), F.lit(0.0), lambda s, v: s + v) / F.size(F.map_values(fills))
    return table(spark, d, "pilot_item").select("item_id", F.round(mean, 2).alias("mean_fill"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE uf IS NULL OR trim(uf) = '') AS no_uf, count(*) FILTER (WHERE municipality_code IS NULL OR trim(municipality_code) = '') AS no_code, count(latitude) AS located FROM address")
def agg17_coverage(spark, d):
    empty = lambda c: F.count_if(P.blank_to_null(F.col(c)).isNull())
    return table(spark, d, "address").agg(F.count("*").alias("n"), empty("uf").alias("no_uf"), empty("municipality_code").alias("no_code"), F.count("latitude").alias("located"))


@query("""WITH l AS (SELECT auction_id, source_url, id, row_number() OVER (PARTITION BY auction_id, source_url ORDER BY created_at, id) AS k FROM auction_lot WHERE auction_id IS NOT NULL) SELECT auction_id, count(*) AS urls, min(id) AS first_id FROM l WHERE k = 1 GROUP BY 1""")
def win4_distinct_within_parent(spark, d):
    one = R.first_by(table(spark, d, "auction_lot").where(F.col("auction_id").isNotNull()).select("auction_id", "source_url", "created_at", "id"), ["auction_id", "source_url"], [F.col("created_at").asc_nulls_last(), F.col("id").asc()])
    return one.groupBy("auction_id").agg(F.count("*").alias("urls"), F.min("id").alias("first_id"))


@query("""SELECT source_short_name, id FROM (SELECT *, row_number() OVER (PARTITION BY source_short_name ORDER BY confidence_score DESC NULLS LAST, CASE WHEN description IS NULL THEN 1 ELSE 0 END, id) AS k FROM auction_lot) WHERE k <= 5""")
def win6_representatives(spark, d):
    rank = F.when(F.col("description").isNull(), 1).otherwise(0)
    return R.top_k(table(spark, d, "auction_lot").select("source_short_name", "confidence_score", "description", "id"), ["source_short_name"], [F.col("confidence_score").desc_nulls_last(), rank.asc(), F.col("id").asc()], 5).select("source_short_name", "id")


@query("SELECT id, CAST(round(2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(latitude + 15.8) / 2), 2) + cos(radians(-15.8)) * cos(radians(latitude)) * pow(sin(radians(longitude + 47.9) / 2), 2), 1.0))), 2) AS DOUBLE) AS km FROM address WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY 2, 1 LIMIT 20")
def srt1_nearest(spark, d):
    a = table(spark, d, "address").where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return a.select("id", F.round(P.haversine_km(F.lit(-15.8), F.lit(-47.9), F.col("latitude"), F.col("longitude")), 2).alias("km")).orderBy("km", "id").limit(20)


@query("SELECT kind, count(*) AS n FROM spatial_unit GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def srt7_most_common(spark, d):
    return table(spark, d, "spatial_unit").groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("kind").asc_nulls_last()).limit(5)


@query("SELECT id, min(ord) AS ord, arg_min(uf, ord) AS uf FROM (SELECT id, 1 AS ord, uf FROM address WHERE length(uf) = 2 UNION ALL SELECT id, 2, NULLIF(regexp_extract(raw_text, '/([A-Z]{2})\\b', 1), '') FROM address WHERE regexp_matches(raw_text, '/[A-Z]{2}\\b')) GROUP BY id")
def set1_ordered_candidates(spark, d):
    a = table(spark, d, "address")
    one = a.where(F.length("uf") == 2).select("id", F.lit(1).alias("ord"), "uf")
    two = a.where(F.col("raw_text").rlike(r"/[A-Z]{2}\b")).select("id", F.lit(2).alias("ord"), P.group(F.col("raw_text"), r"/([A-Z]{2})\b", 1).alias("uf"))
    return one.unionByName(two).groupBy("id").agg(F.min("ord").alias("ord"), F.min_by("uf", "ord").alias("uf"))


@query("SELECT id, uf, 'ok' AS origin FROM address WHERE uf IS NOT NULL UNION ALL SELECT id, NULL, 'missing' FROM address WHERE uf IS NULL")
def set4_row_concat(spark, d):
    a = table(spark, d, "address").select("id", "uf")
    return a.where("uf is not null").withColumn("origin", F.lit("ok")).unionByName(a.where("uf is null").withColumn("origin", F.lit("missing")))


# ---- jobs --------------------------------------------------------------------------------------------------------


@query("SELECT r.short_name, coalesce(p.url, r.base_url) AS base_url, r.source_kind FROM ref_source r LEFT JOIN (SELECT source_short_name AS short_name, max(regexp_extract(source_url, '^https?://[^/]+', 0)) AS url FROM auction_lot WHERE source_url LIKE 'http%' GROUP BY 1) p USING (short_name)")
def ups2_source_upsert(spark, d):
    new = table(spark, d, "auction_lot").where(F.col("source_url").like("http%")).groupBy(F.col("source_short_name").alias("short_name")).agg(F.max(F.regexp_extract("source_url", "^https?://[^/]+", 0)).alias("base_url"))
    return R.update_from(table(spark, d, "ref_source").select("short_name", "base_url", "source_kind"), new, ["short_name"], ["base_url"])


@query("""SELECT spatial_unit_id, coalesce(arg_max(k, o) FILTER (WHERE k <> 'desconhecida'), 'desconhecida') AS kind FROM (SELECT id AS spatial_unit_id, 1 AS o, coalesce(kind, 'desconhecida') AS k FROM spatial_unit UNION ALL SELECT spatial_unit_id, 0, coalesce(""" + rules_sql("description", PROPERTY_RULES) + """, 'desconhecida') FROM (SELECT spatial_unit_id, max(description) AS description FROM auction_lot WHERE spatial_unit_id IS NOT NULL GROUP BY 1)) GROUP BY 1""")
def ups7_replace_unless_known(spark, d):
    kinds = table(spark, d, "spatial_unit").select(F.col("id").alias("spatial_unit_id"), F.lit(1).alias("o"), F.coalesce("kind", F.lit("desconhecida")).alias("k"))
    told = table(spark, d, "auction_lot").where(F.col("spatial_unit_id").isNotNull()).groupBy("spatial_unit_id").agg(F.max("description").alias("t"))
    guess = told.select("spatial_unit_id", F.lit(0).alias("o"), F.coalesce(P.first_rule(F.col("t"), PROPERTY_RULES), F.lit("desconhecida")).alias("k"))
    both = kinds.unionByName(guess)
    return both.groupBy("spatial_unit_id").agg(F.coalesce(F.max_by("k", F.when(F.col("k") != "desconhecida", F.col("o"))), F.lit("desconhecida")).alias("kind"))


@query("SELECT item_id, CAST(r.round_number AS INTEGER) AS round_number, max(r.minimum_bid_brl) AS minimum_bid_brl FROM (SELECT item_id, unnest(rounds) AS r FROM pilot_item) WHERE r.scheduled_at IS NOT NULL AND r.minimum_bid_brl IS NOT NULL GROUP BY 1, 2")
def ups8_rounds(spark, d):
    r = table(spark, d, "pilot_item").select("item_id", F.explode("rounds").alias("r")).where(F.col("r.scheduled_at").isNotNull() & F.col("r.minimum_bid_brl").isNotNull())
    return r.groupBy("item_id", F.col("r.round_number").cast("int").alias("round_number")).agg(F.max("r.minimum_bid_brl").alias("minimum_bid_brl"))


@query("SELECT item_id, rounds[-1].minimum_bid_brl AS last_bid FROM pilot_item WHERE len(rounds) > 0")
def ups10_last_of_list(spark, d):
    return table(spark, d, "pilot_item").where(F.size("rounds") > 0).select("item_id", F.try_element_at("rounds", F.lit(-1)).getField("minimum_bid_brl").alias("last_bid"))


@query("SELECT DISTINCT source_short_name, CAST(date_trunc('day', created_at) AS VARCHAR)[1:10] AS day, count(*) OVER (PARTITION BY source_short_name, date_trunc('day', created_at)) AS n FROM (SELECT DISTINCT id, source_short_name, created_at FROM fetch_event)")
def ups13_daily_snapshot(spark, d):
    rows = table(spark, d, "fetch_event").select("id", "source_short_name", "created_at").distinct()
    day = rows.groupBy("source_short_name", F.date_format("created_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    day = day.withColumn("month", F.left("day", F.lit(7)))
    base = readers.new_folder(spark, "snapshot")
    J.overwrite_partitions(day, base, "month")
    J.overwrite_partitions(day, base, "month")  # a second run of the same days changes nothing
    return spark.read.schema(day.schema).parquet(base).select("source_short_name", "day", "n")


_CL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({fold_sql('description')}, '{r}') THEN '{label}' END" for label, r in CLAUSE_RULES) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT DISTINCT spatial_unit_id, clause FROM (SELECT spatial_unit_id, unnest({_CL}) AS clause FROM auction_lot WHERE spatial_unit_id IS NOT NULL)")
def ups17_parties_from_text(spark, d):
    lots = table(spark, d, "auction_lot").where(F.col("spatial_unit_id").isNotNull())
    return lots.select("spatial_unit_id", F.explode(P.all_rules(F.col("description"), CLAUSE_RULES)).alias("clause")).distinct()


@query(f"""SELECT a.id, coalesce(CASE WHEN regexp_matches(a.municipality_code, '^[0-9]{{7}}$') THEN a.municipality_code END, m.ibge_code) AS code FROM address a LEFT JOIN (SELECT {words_sql('name')} AS w, uf, min(ibge_code) AS ibge_code FROM ref_municipality GROUP BY 1, 2) m ON m.w = {words_sql('a.municipality_name')} AND m.uf = {_uf_sql('a.uf')}""")
def ups21_resolve_code(spark, d):
    ref = table(spark, d, "ref_municipality").groupBy(words(F.col("name")).alias("w"), F.col("uf").alias("u")).agg(F.min("ibge_code").alias("ibge_code"))
    a = table(spark, d, "address").select("id", "municipality_code", words(F.col("municipality_name")).alias("w"), normalise_uf(F.col("uf")).alias("u"))
    code = F.when(F.col("municipality_code").rlike(r"^\d{7}$"), F.col("municipality_code"))
    return a.join(ref, ["w", "u"], "left").select("id", F.coalesce(code, "ibge_code").alias("code"))


# ---- rules and validation ----------------------------------------------------------------------------------------


@query(f"SELECT coalesce({rules_sql('text', PROPERTY_RULES)}, 'desconhecido') AS label, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1")
def kinds_of_documents(spark, d):
    return table(spark, d, "documents").where(F.col("text").isNotNull()).groupBy(P.first_rule(F.col("text"), PROPERTY_RULES, "desconhecido").alias("label")).agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, array_to_string(({_CL.replace('description', 'text')})[1:3], ',') AS signals FROM documents WHERE text IS NOT NULL")
def clauses_of_documents(spark, d):
    return table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.array_join(F.slice(P.all_rules(F.col("text"), CLAUSE_RULES), 1, 3), ",").alias("signals"))


@query("SELECT item_id, array_to_string(list_filter([CASE WHEN description IS NULL THEN 'description' END, CASE WHEN area_sqm IS NULL THEN 'area_sqm' END, CASE WHEN address.cep IS NULL THEN 'cep' END], lambda x: x IS NOT NULL), ',') AS warnings FROM pilot_item")
def dq6_soft_rules(spark, d):
    checks = {"description": F.col("description").isNotNull(), "area_sqm": F.col("area_sqm").isNotNull(), "cep": F.col("address.cep").isNotNull()}
    return table(spark, d, "pilot_item").select("item_id", F.array_join(R.failure_list(checks), ",").alias("warnings"))


@query("SELECT item_id, (title IS NOT NULL)::INT + (description IS NOT NULL)::INT + (len(coalesce(rounds, [])) > 0)::INT + (address.uf IS NOT NULL)::INT AS filled FROM pilot_item")
def dq7_item_fill(spark, d):
    parts = [F.col("title").isNotNull(), F.col("description").isNotNull(), F.coalesce(F.size("rounds") > 0, F.lit(False)), F.col("address.uf").isNotNull()]
    return table(spark, d, "pilot_item").select("item_id", sum((p.cast("int") for p in parts), F.lit(0)).alias("filled"))


@query("SELECT scraper_run_id, count(*) AS fetches, count(*) FILTER (WHERE fetch_status <> 'success') AS failed, CAST(sum(response_size_bytes) AS BIGINT) AS bytes, max(duration_ms) AS slowest FROM (SELECT DISTINCT id, scraper_run_id, fetch_status, response_size_bytes, duration_ms FROM fetch_event) GROUP BY 1")
def dq11_run_metrics(spark, d):
    f = table(spark, d, "fetch_event").select("id", "scraper_run_id", "fetch_status", "response_size_bytes", "duration_ms").distinct()
    return f.groupBy("scraper_run_id").agg(F.count("*").alias("fetches"), F.count_if(F.col("fetch_status") != "success").alias("failed"), F.sum("response_size_bytes").alias("bytes"), F.max("duration_ms").alias("slowest"))


@query("""WITH b AS (SELECT l.id, l.minimum_bid, l.current_status, s.kind, a.uf, a.municipality_code FROM auction_lot l LEFT JOIN spatial_unit s ON s.id = l.spatial_unit_id LEFT JOIN address a ON a.id = s.address_id WHERE NOT EXISTS (SELECT 1 FROM lot_canonical_link k WHERE k.secondary_lot_id = l.id)) SELECT uf, count(*) AS lots, count(DISTINCT municipality_code) AS towns, CAST(min(minimum_bid) AS DOUBLE) AS lowest FROM b GROUP BY uf""")
def gold_lot_search_stats(spark, d):
    return J.lot_search(table(spark, d, "auction_lot"), table(spark, d, "spatial_unit"), table(spark, d, "address"), table(spark, d, "lot_canonical_link")).groupBy("uf").agg(F.count("*").alias("lots"), F.count_distinct("municipality_code").alias("towns"), F.min("minimum_bid").cast("double").alias("lowest"))


@query("SELECT user_id, date_trunc('day', ts) AS start, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark, d):
    """A real stream with a watermark, run until the input is used up; its last windows are flushed by a row after them."""
    from pregonero.streaming.jobs import daily_counts

    return daily_counts(spark, d)


@query("SELECT source_short_name, source_lot_code, max(CASE WHEN n > 1 THEN 'seen again' ELSE 'new' END) AS outcome, max(n) AS n FROM (SELECT source_short_name, source_lot_code, count(*) OVER (PARTITION BY source_short_name, source_lot_code) AS n FROM auction_lot WHERE source_lot_code IS NOT NULL AND source_short_name IS NOT NULL) GROUP BY 1, 2")
def stream_known_lots(spark, d):
    """Incremental crawl: what a batch brings for known keys only touches them, new keys are added."""
    from pregonero.streaming.jobs import known_lots

    return known_lots(spark, d)
