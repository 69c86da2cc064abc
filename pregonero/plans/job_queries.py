"""Queries of jobs: upserts, links between registries and lots, sinks, orders, statistics, functions and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from pregonero.functions import parsers as P
from pregonero.functions import places as L
from pregonero.functions.text import fold, normalise_uf, words
from pregonero.operators import checks as C
from pregonero.operators import jobs as J
from pregonero.operators import relational as R
from pregonero.plans.place_queries import _clue_sql, _pick, _pick_sql
from pregonero.plans.reference_queries import _key_sql, _lots_by_place, _uf_sql, fold_sql, query, words_sql
from pregonero import rules
from pregonero.session import table
from pregonero.sources import readers

# ---- upserts -----------------------------------------------------------------------------------------------------


def _last_sql(c: str, order: str, where: str | None = None) -> str:
    return f"arg_max({c}, {order}) FILTER (WHERE {where or f'{c} IS NOT NULL'})"


_O = "row(coalesce(scraped_at, TIMESTAMPTZ '1970-01-01'), id)"


@query("SELECT full_name, " + ", ".join(f"arg_max({c}, o) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("uf", "matricula")) + " FROM (SELECT nome AS full_name, uf, matricula, row(scraped_at, record_id) AS o FROM auctioneers_unified WHERE nome IS NOT NULL) GROUP BY 1")
def ups3_auctioneers(spark, d):
    a = table(spark, d, "auctioneers_unified").where(F.col("nome").isNotNull()).select(F.col("nome").alias("full_name"), "uf", "matricula", "scraped_at", "record_id")
    return R.upsert_fold(a, ["full_name"], ["scraped_at", "record_id"], {"uf": "coalesce", "matricula": "coalesce"})


@query(f"""SELECT source_short_name, code, (arg_max({{'v': source_url}}, {_O})).v AS source_url, arg_max(auction_id, {_O}) FILTER (WHERE auction_id IS NOT NULL) AS auctioneer_id, max(last_seen_at) AS last_seen_at, 'judicial_cpc' AS modality FROM (SELECT *, coalesce(source_url, 'lot/' || source_lot_code) AS code FROM auction_lot) GROUP BY 1, 2""")
def ups4_auctions(spark, d):
    lots = table(spark, d, "auction_lot").select("source_short_name", F.coalesce("source_url", F.concat(F.lit("lot/"), F.col("source_lot_code"))).alias("code"), "source_url", F.col("auction_id").alias("auctioneer_id"), "scraped_at", "last_seen_at", "id")
    keys = ["source_short_name", "code"]
    got = R.upsert_fold(lots, keys, ["scraped_at", "id"], {"source_url": "overwrite", "auctioneer_id": "coalesce"})
    return got.join(lots.groupBy(*keys).agg(F.max("last_seen_at").alias("last_seen_at")), keys).withColumn("modality", F.lit("judicial_cpc"))


_MODE = "CASE id % 4 WHEN 0 THEN 'venda_direta' WHEN 1 THEN 'leilao' END"
_FOLD5 = {"current_status": "overwrite", "source_url": "overwrite", "parser_version": "overwrite", "minimum_bid": "coalesce", "appraisal_value": "coalesce", "lot_number": "coalesce", "registry_key": "coalesce", "auction_id": "keep"}
_PICK5 = {"overwrite": "(arg_max({{'v': {c}}}, o)).v", "coalesce": "arg_max({c}, o) FILTER (WHERE {c} IS NOT NULL)", "keep": "(arg_min({{'v': {c}}}, o)).v"}
_REG_KEY = f"replace(NULLIF(regexp_extract({fold_sql('description')}, 'matricula\\s*(?:n[o.º°]*\\s*)?([0-9]{{1,3}}(?:[.][0-9]{{3}})+|[0-9]{{1,8}})', 1), ''), '.', '')"


@query("SELECT source_short_name, source_lot_code, " + ", ".join(f"{_PICK5[p].format(c=c)} AS {c}" for c, p in _FOLD5.items()) + f", coalesce(arg_max(sale_mode, o) FILTER (WHERE sale_mode <> 'leilao'), 'leilao') AS sale_mode FROM (SELECT *, {_MODE} AS sale_mode, {_REG_KEY} AS registry_key, {_O} AS o FROM auction_lot) GROUP BY 1, 2", doubles="minimum_bid")
def ups5_all_columns(spark, d):
    mode = F.when(F.col("id") % 4 == 0, "venda_direta").when(F.col("id") % 4 == 1, "leilao")
    lots = table(spark, d, "auction_lot").withColumns({"sale_mode": mode, "registry_key": P.registry_key(F.col("description"))})
    return R.upsert_fold(lots.drop("description"), ["source_short_name", "source_lot_code"], ["scraped_at", "id"], _FOLD5 | {"sale_mode": ("last_not", "leilao")})


@query("""WITH n AS (SELECT id, arg_max(status, o) FILTER (WHERE status IS NOT NULL) AS status, max(seen) AS seen FROM (SELECT canonical_lot_id AS id, CASE WHEN confidence >= 70 THEN 'encerrado' END AS status, created_at AS seen, row(created_at, id) AS o FROM lot_canonical_link WHERE canonical_lot_id IS NOT NULL) GROUP BY 1)
 SELECT o.id, coalesce(n.status, o.current_status) AS current_status, coalesce(n.seen, o.last_seen_at) AS last_seen_at FROM auction_lot o LEFT JOIN n USING (id)""")
def ups6_status_and_seen(spark, d):
    said = table(spark, d, "lot_canonical_link").where(F.col("canonical_lot_id").isNotNull()).select(F.col("canonical_lot_id").alias("lot"), F.when(F.col("confidence") >= 70, "encerrado").alias("current_status"), F.col("created_at").alias("last_seen_at"), "created_at", "id")
    new = R.upsert_fold(said, ["lot"], ["created_at", "id"], {"current_status": "coalesce", "last_seen_at": "overwrite"}).withColumnRenamed("lot", "id")
    return R.update_from(table(spark, d, "auction_lot").select("id", "current_status", "last_seen_at"), new, ["id"], ["current_status", "last_seen_at"])


@query(f"SELECT cri_office_id, registry_number, coalesce(arg_min(kind, {_O}) FILTER (WHERE kind <> 'desconhecida'), 'desconhecida') AS kind, " + ", ".join(f"arg_max({c}, {_O}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("useful_area", "bedrooms", "bathrooms", "address_id")) + " FROM spatial_unit GROUP BY 1, 2", doubles="useful_area")
def ups7_units(spark, d):
    u = table(spark, d, "spatial_unit").select("cri_office_id", "registry_number", "kind", "useful_area", "bedrooms", "bathrooms", "address_id", "scraped_at", "id")
    return R.upsert_fold(u, ["cri_office_id", "registry_number"], ["scraped_at", "id"], {"kind": ("first_not", "desconhecida")} | dict.fromkeys(("useful_area", "bedrooms", "bathrooms", "address_id"), "coalesce"))


@query("""SELECT item_id, CASE WHEN s IS NOT NULL THEN 2 ELSE 1 END AS round_number, coalesce(s, f) AS scheduled_at, bid FROM (SELECT item_id, list_filter(rounds, lambda r: r.round_number = 1)[1].scheduled_at AS f, list_filter(rounds, lambda r: r.round_number = 2)[1].scheduled_at AS s, rounds[-1].minimum_bid_brl AS bid FROM pilot_item) WHERE coalesce(s, f) IS NOT NULL AND bid IS NOT NULL""")
def ups8_round_of_item(spark, d):
    of = lambda n: F.get(F.filter("rounds", lambda r: r["round_number"] == n), F.lit(0))["scheduled_at"]
    t = table(spark, d, "pilot_item").select("item_id", of(1).alias("f"), of(2).alias("s"), F.try_element_at("rounds", F.lit(-1))["minimum_bid_brl"].alias("bid"))
    return t.where(F.coalesce("s", "f").isNotNull() & F.col("bid").isNotNull()).select("item_id", F.when(F.col("s").isNotNull(), 2).otherwise(1).alias("round_number"), F.coalesce("s", "f").alias("scheduled_at"), "bid")


@query("SELECT item_id, rounds[-1].minimum_bid_brl AS final_price FROM pilot_item WHERE auction_status = 'arrematado' AND len(rounds) > 0")
def ups10_winner(spark, d):
    return table(spark, d, "pilot_item").where((F.col("auction_status") == "arrematado") & (F.size("rounds") > 0)).select("item_id", F.try_element_at("rounds", F.lit(-1))["minimum_bid_brl"].alias("final_price"))


@query("SELECT id AS spatial_unit_id, CASE WHEN appraisal_date IS NOT NULL THEN 'known' ELSE 'new' END AS origin FROM spatial_unit")
def ups11_ensure_units(spark, d):
    u = table(spark, d, "spatial_unit")
    known = u.where(F.col("appraisal_date").isNotNull()).select(F.col("id").alias("spatial_unit_id"), F.lit("known").alias("origin"))
    return R.insert_ignore(known, u.select(F.col("id").alias("spatial_unit_id"), F.lit("new").alias("origin")), ["spatial_unit_id"])


_LOTS12 = f"(SELECT l.id, coalesce(r.source_kind, 'unknown') AS kind, {_key_sql('a.cep', 'a.street_name', 'a.number')} AS ak, {_REG_KEY.replace('(description)', '(l.description)')} AS rk FROM auction_lot l LEFT JOIN ref_source r ON r.short_name = l.source_short_name LEFT JOIN spatial_unit s ON s.id = l.spatial_unit_id LEFT JOIN address a ON a.id = s.address_id)"


@query(f"""WITH l AS {_LOTS12}, m AS (SELECT b.id, min(o.id) AS canonical FROM l b JOIN l o ON o.kind <> 'bank' AND o.ak = b.ak WHERE b.kind = 'bank' GROUP BY 1 UNION ALL SELECT b.id, min(o.id) FROM l b JOIN l o ON o.kind <> 'bank' AND o.rk = b.rk WHERE b.kind = 'bank' GROUP BY 1)
 SELECT l.id AS secondary, min(m.canonical) AS canonical, CASE WHEN any_value(ak) IS NOT NULL AND any_value(rk) IS NOT NULL THEN 'address+registry' WHEN any_value(rk) IS NOT NULL THEN 'registry' ELSE 'address' END AS match_kind, CASE WHEN any_value(ak) IS NOT NULL AND any_value(rk) IS NOT NULL THEN 90 WHEN any_value(rk) IS NOT NULL THEN 70 ELSE 55 END AS confidence FROM l JOIN m USING (id) GROUP BY 1""")
def ups12_bank_links(spark, d):
    t = lambda n: table(spark, d, n)
    places = t("address").select(F.col("id").alias("address_id"), P.address_key(F.col("cep"), F.col("street_name"), F.col("number")).alias("address_key"))
    units = t("spatial_unit").select(F.col("id").alias("spatial_unit_id"), "address_id")
    kinds = t("ref_source").select(F.col("short_name").alias("source_short_name"), "source_kind")
    lots = t("auction_lot").select("id", "source_short_name", "spatial_unit_id", P.registry_key(F.col("description")).alias("registry_key"))
    lots = R.left_chain(lots, [(kinds, "source_short_name"), (units, "spatial_unit_id"), (places, "address_id")])
    return R.bank_links(lots.select("id", F.coalesce("source_kind", F.lit("unknown")).alias("kind"), "address_key", "registry_key"))


_KEEP = "(SELECT id, min(id) OVER (PARTITION BY cri_office_id, registry_number) AS kept FROM spatial_unit)"


@query(f"SELECT k.kept AS id, CAST(count(DISTINCT k.id) AS BIGINT) AS merged, CAST(count(l.id) AS BIGINT) AS lots, count(l.id) = 0 AS orphan FROM {_KEEP} k LEFT JOIN auction_lot l ON l.spatial_unit_id = k.id GROUP BY 1", texts="orphan")
def ups14_repointed_units(spark, d):
    u = table(spark, d, "spatial_unit").select("id", "cri_office_id", "registry_number")
    keys = ["cri_office_id", "registry_number"]
    kept = u.groupBy(*keys).agg(F.min("id").alias("kept"), F.count("*").alias("merged"))
    to = u.join(kept, (u[keys[0]].eqNullSafe(kept[keys[0]])) & (u[keys[1]].eqNullSafe(kept[keys[1]]))).select(u["id"].alias("spatial_unit_id"), "kept")
    lots = table(spark, d, "auction_lot").where(F.col("spatial_unit_id").isNotNull()).select("spatial_unit_id").join(to, "spatial_unit_id").groupBy("kept").agg(F.count("*").alias("lots"))
    n = F.coalesce(F.col("lots"), F.lit(0).cast("long"))
    return kept.select("kept", "merged").join(lots, "kept", "left").select(F.col("kept").alias("id"), "merged", n.alias("lots"), (n == 0).alias("orphan"))


@query("""WITH c AS (SELECT canonical_lot_id AS lot_id, lower(trim(match_kind)) AS kind, CASE WHEN confidence < 70 THEN 'declarado' WHEN confidence < 85 THEN 'quitado' ELSE 'sub_rogado' END AS status, id FROM lot_canonical_link WHERE canonical_lot_id IS NOT NULL AND match_kind IS NOT NULL)
 SELECT lot_id, kind, coalesce(CASE WHEN arg_min(status, id) <> 'declarado' THEN arg_min(status, id) END, arg_min(status, id) FILTER (WHERE status <> 'declarado'), 'declarado') AS status FROM c GROUP BY 1, 2""")
def ups15_clause_rows(spark, d):
    status = F.when(F.col("confidence") < 70, "declarado").when(F.col("confidence") < 85, "quitado").otherwise("sub_rogado")
    c = table(spark, d, "lot_canonical_link").where(F.col("canonical_lot_id").isNotNull() & F.col("match_kind").isNotNull()).select(F.col("canonical_lot_id").alias("lot_id"), F.lower(F.trim("match_kind")).alias("kind"), status.alias("status"), "id")
    return R.upsert_fold(c, ["lot_id", "kind"], ["id"], {"status": ("first_not", "declarado")})


# ---- joins -------------------------------------------------------------------------------------------------------

_K9 = "(SELECT id, NULLIF(regexp_replace(cep, '[^0-9]', '', 'g'), '') || '|' || number AS k1, NULLIF(trim(raw_text), '') AS k2 FROM address)"


@query(f"SELECT id, match, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY match) AS place FROM (SELECT DISTINCT a.id AS id, b.id AS match FROM {_K9} a JOIN {_K9} b ON a.id <> b.id AND (a.k1 = b.k1 OR a.k2 = b.k2))) WHERE place <= 5")
def j9_five_matches(spark, d):
    a = table(spark, d, "address").select("id", F.concat(F.nullif(F.regexp_replace("cep", r"\D", ""), F.lit("")), F.lit("|"), F.col("number")).alias("k1"), P.blank_to_null(F.col("raw_text")).alias("k2"))
    return R.matches_by_any_key(a, "id", ["k1", "k2"])


_H10 = "2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(latitude + 23.5) / 2), 2) + cos(radians(-23.5)) * cos(radians(latitude)) * pow(sin(radians(longitude + 46.6) / 2), 2), 1.0)))"


@query(f"SELECT id, CAST(round({_H10}, 2) AS DECIMAL(10,2)) AS km FROM address WHERE latitude IS NOT NULL AND {_H10} <= 900 ORDER BY round(pow(latitude + 23.5, 2) + pow(longitude + 46.6, 2), 9), id LIMIT 25", doubles="km")
def j10_nearest_within(spark, d):
    """Filtered on the sphere, ordered on the plane, as the reference does."""
    near = R.within_km(table(spark, d, "address").select("id", "latitude", "longitude"), -23.5, -46.6, 900.0, "latitude", "longitude")
    plane = F.round(F.pow(F.col("latitude") + 23.5, F.lit(2.0)) + F.pow(F.col("longitude") + 46.6, F.lit(2.0)), 9)
    return near.orderBy(plane, "id").limit(25).select("id", F.round("km", 2).cast("decimal(10,2)").alias("km"))


_NUM = "NULLIF(regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(translate(matricula, 'º°', '  '))), '^\\s*(MATRICULA|MAT|N[O.]?)\\b[.:]?', ''), '[^A-Z0-9_]', '', 'g'), '^0+([0-9A-Z])', '\\1'), '')"
_SIDE = f"SELECT record_id AS id, source_kind, {_NUM} AS number, NULLIF(regexp_replace(upper(strip_accents(coalesce(junta_sigla, ''))), '[^A-Z]', '', 'g'), '') AS board, {words_sql('coalesce(nome, ' + chr(39) * 2 + ')')} AS name FROM (SELECT DISTINCT * FROM auctioneers_unified)"


@query(f"""WITH s AS ({_SIDE}), a AS (SELECT * FROM s WHERE source_kind <> 'junta_only'), b AS (SELECT * FROM s WHERE source_kind = 'junta_only'), n AS (SELECT number, board, max(id) AS r FROM b WHERE number IS NOT NULL AND board IS NOT NULL GROUP BY 1, 2),
 e AS (SELECT a.id AS left_id, n.r FROM a JOIN n ON n.number = a.number AND n.board = 'JUCERJA'), sm AS (SELECT name, board, min(id) AS r FROM b WHERE name <> '' AND board IS NOT NULL GROUP BY 1, 2), o AS (SELECT name, min(id) AS r FROM b WHERE name <> '' GROUP BY 1 HAVING count(*) = 1),
 m AS (SELECT a.id AS left_id, coalesce(n.r, (SELECT max(r) FROM e WHERE e.left_id = a.id), sm.r, o.r) AS right_id FROM a LEFT JOIN n ON n.number = a.number AND n.board = a.board LEFT JOIN sm ON sm.name = a.name AND sm.board = a.board LEFT JOIN o ON o.name = a.name)
 SELECT CASE WHEN right_id IS NOT NULL THEN 'both' ELSE 'left_only' END AS source_kind, left_id, right_id FROM m UNION ALL SELECT 'right_only', NULL, id FROM b WHERE id NOT IN (SELECT right_id FROM m WHERE right_id IS NOT NULL UNION ALL SELECT r FROM e)""")
def j13_merged_registries(spark, d):
    t = table(spark, d, "auctioneers_unified").distinct()
    board = F.nullif(F.regexp_replace(F.upper(fold(F.coalesce("junta_sigla", F.lit("")))), "[^A-Z]", ""), F.lit(""))
    s = t.select(F.col("record_id").alias("id"), "source_kind", P.registration(F.col("matricula")).alias("number"), board.alias("board"), words(F.coalesce("nome", F.lit(""))).alias("name"))
    a = s.where("source_kind <> 'junta_only'").withColumn("extras", F.array(F.struct("number", F.lit("JUCERJA").alias("board"))))
    return R.merge_registries(a, s.where("source_kind = 'junta_only'"))


@query(f"WITH s AS ({_SIDE}), a AS (SELECT * FROM s WHERE source_kind <> 'junta_only') SELECT b.id FROM s b WHERE b.source_kind = 'junta_only' AND NOT EXISTS (SELECT 1 FROM a WHERE a.number = b.number AND a.board = b.board)")
def set5_leftovers(spark, d):
    t = table(spark, d, "auctioneers_unified").distinct()
    board = F.nullif(F.regexp_replace(F.upper(fold(F.coalesce("junta_sigla", F.lit("")))), "[^A-Z]", ""), F.lit(""))
    s = t.select(F.col("record_id").alias("id"), "source_kind", P.registration(F.col("matricula")).alias("number"), board.alias("board"))
    return s.where("source_kind = 'junta_only'").join(s.where("source_kind <> 'junta_only'").select("number", "board"), ["number", "board"], "left_anti").select("id")


@query("SELECT p.item_id, p.auction_status, b.lot_visits FROM pilot_item p LEFT JOIN probe2_imoveis_with_bid b ON b.id = p.item_id")
def j14_left_merge(spark, d):
    b = table(spark, d, "probe2_imoveis_with_bid").select(F.col("id").alias("item_id"), "lot_visits")
    return table(spark, d, "pilot_item").select("item_id", "auction_status").join(b, "item_id", "left")


@query("""WITH q AS (SELECT id, sha256('geo::' || lower(trim(raw_text))) AS h FROM address WHERE raw_text IS NOT NULL), c AS (SELECT h, arg_max(found, o) AS found, max(seen_at) AS seen_at FROM (SELECT sha256('geo::' || lower(trim(raw_text))) AS h, latitude IS NOT NULL AS found, updated_at AS seen_at, row(updated_at, latitude IS NOT NULL) AS o FROM address WHERE raw_text IS NOT NULL AND length(raw_text) % 2 = 0) GROUP BY 1), m AS (SELECT max(updated_at) AS as_of FROM address)
 SELECT q.id, CASE WHEN c.seen_at IS NULL THEN 'miss' WHEN c.seen_at < m.as_of - INTERVAL 1500 DAY THEN 'expired' WHEN c.found THEN 'hit' ELSE 'negative' END AS outcome FROM q LEFT JOIN c USING (h), m""")
def j17_negative_cache(spark, d):
    """The cache holds the texts of even length, as if the others had not been asked yet; all texts are looked up."""
    a = table(spark, d, "address")
    h = F.sha2(F.concat(F.lit("geo::"), F.lower(F.trim("raw_text"))), 256).alias("h")
    asked = a.where(F.col("raw_text").isNotNull()).select("id", h)
    cache = a.where(F.col("raw_text").isNotNull() & (F.length("raw_text") % 2 == 0)).groupBy(h, F.col("updated_at").alias("at")).agg(F.bool_or(F.col("latitude").isNotNull()).alias("found"))
    as_of = a.agg(F.max("updated_at").alias("as_of"))
    return R.cached_lookup(asked.crossJoin(F.broadcast(as_of)), cache, "h", F.col("as_of"), 1500).select("id", "outcome")


@query(f"SELECT id, coalesce({_clue_sql(*L.STATE_CLUES[0])}, {_clue_sql(*L.STATE_CLUES[1])}, {_uf_sql('uf')}) AS uf FROM (SELECT id, uf, strip_accents(coalesce(raw_text, '')) AS t FROM address)")
def j7_lateral_cascade(spark, d):
    """Table functions of one row or none with a coalesce over them are expressions here."""
    return table(spark, d, "address").select("id", F.coalesce(L.state_of_text(F.coalesce("raw_text", F.lit(""))), normalise_uf(F.col("uf"))).alias("uf"))


# ---- aggregates and orders ---------------------------------------------------------------------------------------

_B3 = "(SELECT a.uf, s.kind, a.municipality_code AS code, a.district, l.id, l.minimum_bid, l.current_status AS st FROM auction_lot l JOIN spatial_unit s ON s.id = l.spatial_unit_id JOIN address a ON a.id = s.address_id)"


def _top_sql(by: str, what: str, most: int, where: str) -> str:
    return f"(SELECT {by}, string_agg(v || '=' || n, ',' ORDER BY n DESC, v) AS t FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY n DESC, v) AS i FROM (SELECT {by}, coalesce({what}, '?') AS v, count(*) AS n FROM b WHERE {where} GROUP BY ALL)) WHERE i <= {most} GROUP BY ALL)"


_COUNTS = "count(*) AS lots, count(*) FILTER (WHERE st = 'aberto') AS open, count(*) FILTER (WHERE st = 'arrematado') AS sold, count(*) FILTER (WHERE st = 'suspenso') AS suspended, CAST(round(avg(CAST(minimum_bid AS DOUBLE)), 1) AS DECIMAL(18,1)) AS mean_bid"


def _counts(df, *by):
    st = lambda s: F.count_if(F.col("current_status") == s)
    return df.groupBy(*by).agg(F.count("*").alias("lots"), st("aberto").alias("open"), st("arrematado").alias("sold"), st("suspenso").alias("suspended"), F.round(F.avg(F.col("minimum_bid").cast("double")), 1).cast("decimal(18,1)").alias("mean_bid"))


def _top(df, by, what, most):
    n = df.select(*by, F.coalesce(F.col(what), F.lit("?")).alias("v")).groupBy(*by, "v").agg(F.count("*").alias("n"))
    top = R.top_k(n, by, [F.col("n").desc(), F.col("v").asc()], most)
    return R.ordered_children(top, by, ["k"], ["v", "n"]).select(*by, F.array_join(F.transform("children", lambda x: F.concat(x.v, F.lit("="), x.n.cast("string"))), ",").alias("t"))


@query(f"WITH b AS (SELECT * FROM {_B3} WHERE uf IS NOT NULL) SELECT g.*, k.t AS top_kinds, m.t AS top_towns FROM (SELECT uf, {_COUNTS} FROM b GROUP BY 1) g LEFT JOIN {_top_sql('uf', 'kind', 5, 'true')} k USING (uf) LEFT JOIN {_top_sql('uf', 'code', 10, 'code IS NOT NULL')} m USING (uf)", doubles="mean_bid")
def agg3_state_stats(spark, d):
    b = _lots_by_place(spark, d, "current_status").where(F.col("uf").isNotNull())
    tops = [(_top(b, ["uf"], "kind", 5).withColumnRenamed("t", "top_kinds"), "uf"), (_top(b.where("municipality_code is not null"), ["uf"], "municipality_code", 10).withColumnRenamed("t", "top_towns"), "uf")]
    return R.left_chain(_counts(b, "uf"), tops)


@query(f"WITH b AS (SELECT * FROM {_B3} WHERE uf IS NOT NULL AND code IS NOT NULL) SELECT g.*, m.name, t.t AS top_districts FROM (SELECT uf, code, {_COUNTS} FROM b GROUP BY 1, 2) g LEFT JOIN (SELECT ibge_code AS code, max(name) AS name FROM ref_municipality GROUP BY 1) m USING (code) LEFT JOIN {_top_sql('uf, code', 'district', 15, chr(39) * 2 + ' <> trim(district)')} t USING (uf, code)", doubles="mean_bid")
def agg4_town_stats(spark, d):
    b = _lots_by_place(spark, d, "current_status").where("uf is not null and municipality_code is not null").withColumnRenamed("municipality_code", "code")
    names = table(spark, d, "ref_municipality").groupBy(F.col("ibge_code").alias("code")).agg(F.max("name").alias("name"))
    return _counts(b, "uf", "code").join(names, "code", "left").join(_top(b.where("trim(district) <> ''"), ["uf", "code"], "district", 15).withColumnRenamed("t", "top_districts"), ["uf", "code"], "left")


@query("SELECT source_kind, string_agg(DISTINCT uf, '/' ORDER BY uf) AS states FROM auctioneers_unified WHERE uf IS NOT NULL GROUP BY 1")
def agg9_string_agg(spark, d):
    return table(spark, d, "auctioneers_unified").where("uf is not null").groupBy("source_kind").agg(F.array_join(F.array_sort(F.collect_set("uf")), "/").alias("states"))


_GAPS = {"raw_text": 3, "street_name": 5, "number": 2, "complement": 1, "district": 2, "municipality_name": 3, "municipality_code": 4, "uf": 4, "cep": 3, "latitude": 2, "longitude": 2, "geocoding_source": 1, "id": 5}


@query("SELECT field, gap FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, CAST(round((1 - avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END)) * {w}, 2) AS DECIMAL(9,2)) AS gap FROM address" for c, w in _GAPS.items()) + ") WHERE gap > 0 ORDER BY gap DESC, field LIMIT 10", doubles="gap")
def agg13_ten_gaps(spark, d):
    return R.gap_scores(table(spark, d, "address"), _GAPS).where("gap > 0").orderBy(F.col("gap").desc(), "field").limit(10)


_FILLS = {"title": "title", "description": "description", "area_sqm": "area_sqm", "market_value_brl": "market_value_brl", "property_type": "property_type", "cep": "address.cep", "number": "address.number", "town": "address.municipality_name"}


@query("SELECT field, fill FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS field, CAST(round(avg(f), 4) AS DECIMAL(6,4)) AS fill FROM (SELECT auctioneer_slug, avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END) AS f FROM pilot_item GROUP BY 1)" for n, c in _FILLS.items()) + ") ORDER BY fill, field LIMIT 5", doubles="fill")
def agg16_worst_fields(spark, d):
    fills = F.create_map(*[x for n, c in _FILLS.items() for x in (F.lit(n), F.col(c).isNotNull().cast("double"))])
    per = table(spark, d, "pilot_item").select("auctioneer_slug", F.explode(fills).alias("field", "v")).groupBy("auctioneer_slug", "field").agg(F.avg("v").alias("f"))
    return per.groupBy("field").agg(F.round(F.avg("f"), 4).cast("decimal(6,4)").alias("fill")).orderBy("fill", "field").limit(5)


@query("SELECT spatial_unit_id, id FROM (SELECT *, row_number() OVER (PARTITION BY spatial_unit_id ORDER BY created_at DESC NULLS LAST, id) AS k FROM auction_lot WHERE spatial_unit_id IS NOT NULL) WHERE k = 1")
def win5_explicit_survivor(spark, d):
    lots = table(spark, d, "auction_lot").where("spatial_unit_id is not null").select("spatial_unit_id", "id", "created_at")
    return R.first_by(lots, ["spatial_unit_id"], [F.col("created_at").desc_nulls_last(), F.col("id").asc()]).drop("created_at")


@query("SELECT id FROM address WHERE municipality_code IS NULL")
def srt4_whole_batch(spark, d):
    """A batch with an unordered limit is all pending rows here."""
    return table(spark, d, "address").where("municipality_code is null").select("id")


@query("SELECT id, lot_visits FROM probe2_imoveis_with_bid WHERE lot_visits IS NOT NULL ORDER BY lot_visits DESC, id LIMIT 10")
def srt5_ten_largest(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").where("lot_visits is not null").select("id", "lot_visits").orderBy(F.col("lot_visits").desc(), "id").limit(10)


_RANK = {"ativo": 0, "suspenso": 1, "encerrado": 2}


@query("SELECT item_id, auction_status, CAST(k AS INTEGER) AS place FROM (SELECT item_id, auction_status, r, row_number() OVER (PARTITION BY r ORDER BY area_sqm DESC NULLS LAST, item_id) AS k FROM (SELECT *, CASE auction_status WHEN 'ativo' THEN 0 WHEN 'suspenso' THEN 1 WHEN 'encerrado' THEN 2 ELSE 9 END AS r FROM pilot_item)) WHERE k <= CASE WHEN r = 0 THEN 20 ELSE 10 END")
def srt6_heads_by_rank(spark, d):
    r = F.coalesce(*[F.when(F.col("auction_status") == s, n) for s, n in _RANK.items()], F.lit(9))
    rows = table(spark, d, "pilot_item").select("item_id", "auction_status", "area_sqm", r.alias("r"))
    top = R.top_k(rows, ["r"], [F.col("area_sqm").desc_nulls_last(), F.col("item_id").asc()], 20, "place")
    return top.where(F.col("place") <= F.when(F.col("r") == 0, 20).otherwise(10)).select("item_id", "auction_status", "place")


@query("SELECT source_short_name, count(*) AS n FROM fetch_event GROUP BY 1 ORDER BY 2 DESC, 1")
def srt8_report_order(spark, d):
    return table(spark, d, "fetch_event").groupBy("source_short_name").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("source_short_name").asc_nulls_last())


@query("SELECT 'with text' AS predicate, count(*) AS n FROM auction_lot WHERE description IS NOT NULL UNION ALL SELECT 'not open', count(*) FROM auction_lot WHERE current_status <> 'aberto' UNION ALL SELECT 'seen', count(*) FROM auction_lot WHERE last_seen_at IS NOT NULL")
def flt3_index_predicates(spark, d):
    checks = {"with text": F.col("description").isNotNull(), "not open": F.col("current_status") != "aberto", "seen": F.col("last_seen_at").isNotNull()}
    one = table(spark, d, "auction_lot").agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("predicate"), F.col(n).alias("n")) for n in checks])))


# ---- sinks -------------------------------------------------------------------------------------------------------


@query("SELECT CAST(id AS VARCHAR) AS id, lot_number, NULL AS extra FROM auction_lot", texts="extra")
def snk3_fixed_csv(spark, d):
    path = readers.new_folder(spark, "csv")
    J.write_csv(table(spark, d, "auction_lot").select("lot_number", "id", "auction_id"), ["id", "lot_number", "extra"], path)
    return readers.read_csv(spark, path)


@query("SELECT '| kind | n |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || coalesce(kind, '') || ' | ' || n || ' |', chr(10) ORDER BY n DESC, kind) AS report FROM (SELECT kind, count(*) AS n FROM spatial_unit GROUP BY 1)")
def snk4_markdown_report(spark, d):
    n = table(spark, d, "spatial_unit").groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("kind").asc_nulls_last())
    return spark.createDataFrame([(J.markdown_table(n, ["kind", "n"]),)], "report string")


@query("SELECT CASE WHEN title IS NULL THEN 'no_title' WHEN source_lot_url IS NULL THEN 'no_url' WHEN description IS NULL THEN 'no_text' ELSE 'persisted' END AS outcome, count(*) AS n FROM pilot_item GROUP BY 1")
def snk6_counters(spark, d):
    why = R.first_failure([("no_title", F.col("title").isNotNull()), ("no_url", F.col("source_lot_url").isNotNull()), ("no_text", F.col("description").isNotNull())])
    good, bad = J.quarantine(table(spark, d, "pilot_item").withColumn("why", why), F.col("why").isNull())
    one = lambda x: x.select(F.coalesce("why", F.lit("persisted")).alias("outcome"))
    return one(good).unionByName(one(bad)).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT scraper_run_id, count(*) AS items, count(*) FILTER (WHERE fetch_status <> 'success') AS failed, CAST(sum(duration_ms) AS BIGINT) AS elapsed FROM fetch_event GROUP BY 1")
def snk7_run_log(spark, d):
    runs = table(spark, d, "fetch_event").groupBy("scraper_run_id").agg(F.count("*").alias("items"), F.count_if(F.col("fetch_status") != "success").alias("failed"), F.sum("duration_ms").cast("long").alias("elapsed"))
    return spark.read.schema(runs.schema).json(readers.round_trip(runs, "json"))


@query("SELECT CAST(id AS VARCHAR) AS id, CASE WHEN id % 10 = 0 AND http_status IS NULL THEN '599' ELSE CAST(http_status AS VARCHAR) END AS http_status FROM (SELECT DISTINCT id, http_status FROM fetch_event)")
def snk9_patched_csv(spark, d):
    rows = table(spark, d, "fetch_event").select("id", "http_status").distinct()
    old, new = readers.round_trip(rows, "csv"), readers.new_folder(spark, "csv")
    J.patch_csv(spark, old, new, rows.where((F.col("id") % 10 == 0) & F.col("http_status").isNull()).select(F.col("id").cast("string").alias("id"), F.lit(599).alias("http_status")), "id")
    return readers.read_csv(spark, new)


@query("SELECT source_short_name, id FROM spatial_unit")
def snk8_whole_version(spark, d):
    base = readers.new_folder(spark, "gold")
    rows = table(spark, d, "spatial_unit").select("source_short_name", "id")
    first = J.publish(rows.where("id < 0"), base, ["id"], partition="source_short_name")
    J.publish(rows, base, ["id"], partition="source_short_name")
    if not spark.read.schema(rows.schema).parquet(first).isEmpty():
        raise AssertionError("the old version must stay as it was")
    return J.current(spark, base).select("source_short_name", "id")


# ---- functions ---------------------------------------------------------------------------------------------------


@query("SELECT id, CASE WHEN v > 0 THEN v END AS amount FROM (SELECT id, try_cast(CASE WHEN contains(t, ',') THEN replace(replace(t, '.', ''), ',', '.') ELSE t END AS DECIMAL(20,4)) AS v FROM (SELECT id, regexp_replace(minimum_bid || ' BRL', '[^0-9,.]', '', 'g') AS t FROM auction_lot))", doubles="amount")
def prj3_amount_with_suffix(spark, d):
    return table(spark, d, "auction_lot").select("id", P.brl_suffixed(F.concat(F.col("minimum_bid").cast("string"), F.lit(" BRL"))).alias("amount"))


@query("SELECT id, try_cast(NULLIF(trim(lot_dormitories), '') AS INTEGER) AS bedrooms, try_cast(CASE WHEN regexp_matches(trim(auction_date_init), '^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$') THEN replace(replace(trim(auction_date_init), 'T', ' '), 'Z', '') END AS TIMESTAMP) AS starts FROM probe2_imoveis_with_bid")
def prj7_strict_int_and_time(spark, d):
    t = F.trim("auction_date_init")
    at = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), t).try_cast("timestamp")
    return table(spark, d, "probe2_imoveis_with_bid").select("id", P.blank_to_null(F.col("lot_dormitories")).try_cast("int").alias("bedrooms"), at.alias("starts"))


_PEPPER = "0123456789abcdef0123456789abcdef"
_PADS = ["".join(f"{b ^ x:02x}" for b in _PEPPER.encode().ljust(64, b"\0")) for x in (0x5C, 0x36)]


@query(f"SELECT record_id, CASE WHEN length(n) = 11 THEN sha256(unhex('{_PADS[0]}') || unhex(sha256(unhex('{_PADS[1]}') || encode(n)))) END AS hash FROM (SELECT record_id, regexp_replace(CASE WHEN record_id % 3 = 0 THEN '123.456.789-' || lpad(CAST(record_id % 90 AS VARCHAR), 2, '0') ELSE coalesce(matricula, '') END, '[^0-9]', '', 'g') AS n FROM auctioneers_unified)")
def fn2_hashed_person_numbers(spark, d):
    spark.conf.set(P.PEPPER_SETTING, _PEPPER)
    text = F.when(F.col("record_id") % 3 == 0, F.concat(F.lit("123.456.789-"), F.lpad((F.col("record_id") % 90).cast("string"), 2, "0"))).otherwise(F.coalesce("matricula", F.lit("")))
    return table(spark, d, "auctioneers_unified").select("record_id", P.hash_cpf(text, P.session_pepper(spark)).alias("hash"))


@query(f"SELECT s.id, concat_ws('-', coalesce(NULLIF(replace({words_sql('s.kind')}, ' ', '-'), ''), 'imovel'), NULLIF(replace({words_sql('a.municipality_name')}, ' ', '-'), ''), coalesce(NULLIF(replace({words_sql('s.lot_number')}, ' ', '-'), ''), left(CAST(s.id AS VARCHAR), 8))) AS slug FROM (SELECT l.id, l.lot_number, u.kind, u.address_id FROM auction_lot l LEFT JOIN spatial_unit u ON u.id = l.spatial_unit_id) s LEFT JOIN address a ON a.id = s.address_id")
def fn18_lot_slug(spark, d):
    t = lambda n: table(spark, d, n)
    lots = t("auction_lot").select("id", "lot_number", "spatial_unit_id")
    lots = R.left_chain(lots, [(t("spatial_unit").select(F.col("id").alias("spatial_unit_id"), "kind", "address_id"), "spatial_unit_id"), (t("address").select(F.col("id").alias("address_id"), "municipality_name"), "address_id")])
    s = lambda c: F.nullif(P.slug(F.col(c), 1000), F.lit(""))
    return lots.select("id", F.concat_ws("-", F.coalesce(s("kind"), F.lit("imovel")), s("municipality_name"), F.coalesce(s("lot_number"), F.left(F.col("id").cast("string"), F.lit(8)))).alias("slug"))


@query("SELECT id, CAST(round(least(1.0, greatest(0.0, coalesce(abs(latitude) / 90, 0.0), CASE WHEN number IS NOT NULL THEN 0.85 ELSE 0.0 END, CASE WHEN street_name IS NOT NULL THEN 0.55 ELSE 0.0 END)), 2) AS DOUBLE) AS confidence FROM address")
def fn19_geocode_confidence(spark, d):
    return table(spark, d, "address").select("id", P.geocode_confidence(F.abs("latitude") / 90, F.col("number").isNotNull(), F.col("street_name").isNotNull()).alias("confidence"))


@query("""WITH n AS (SELECT municipality_code AS ibge_code, CASE WHEN count(*) > 1 THEN max(district) END AS alt_name FROM address WHERE municipality_code IS NOT NULL GROUP BY 1), m AS (SELECT max(updated_at) AS at FROM address)
 SELECT r.ibge_code, coalesce(n.alt_name, r.alt_name) AS alt_name, CASE WHEN n.alt_name IS NOT NULL AND n.alt_name IS DISTINCT FROM r.alt_name THEN m.at END AS updated_at FROM ref_municipality r LEFT JOIN n USING (ibge_code), m""")
def fn21_updated_at(spark, d):
    a = table(spark, d, "address")
    new = a.where("municipality_code is not null").groupBy(F.col("municipality_code").alias("ibge_code")).agg(F.when(F.count("*") > 1, F.max("district")).alias("alt_name"))
    at = a.agg(F.max("updated_at").alias("at"))
    old = table(spark, d, "ref_municipality").select("ibge_code", "alt_name", F.lit(None).cast("timestamp").alias("updated_at")).crossJoin(F.broadcast(at))
    return J.stamp_changes(old, new, "ibge_code", ["alt_name"], F.col("at")).drop("at")


@query("SELECT item_id, CAST(len(rounds) AS INTEGER) AS n, list_contains(list_transform(rounds, lambda r: r.round_number), 2) AS second, CAST(coalesce(len(list_distinct(list_transform(rounds, lambda r: r.status_raw))), 0) AS INTEGER) AS kinds FROM pilot_item WHERE rounds IS NOT NULL", texts="second")
def sf6_arrays(spark, d):
    r = F.transform("rounds", lambda x: x["round_number"])
    kinds = F.size(F.array_compact(F.array_distinct(F.transform("rounds", lambda x: x["status_raw"]))))
    return table(spark, d, "pilot_item").where("rounds is not null").select("item_id", F.size("rounds").alias("n"), F.array_contains(r, 2).alias("second"), kinds.alias("kinds"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}' AS doc FROM events")
def sf8_json(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("doc"))


@query("SELECT id, try_cast(cep AS BIGINT) AS n, CAST(latitude AS VARCHAR) IS NOT NULL AS placed, left(CAST(created_at AS VARCHAR), 10) AS day FROM address", texts="placed")
def sf11_casts(spark, d):
    return table(spark, d, "address").select("id", F.col("cep").try_cast("bigint").alias("n"), F.col("latitude").cast("string").isNotNull().alias("placed"), F.left(F.col("created_at").cast("string"), F.lit(10)).alias("day"))


# ---- validation --------------------------------------------------------------------------------------------------


@query("""SELECT id, 'self_link' AS failed FROM lot_canonical_link WHERE canonical_lot_id = secondary_lot_id UNION ALL SELECT id, 'confidence' FROM lot_canonical_link WHERE NOT (confidence BETWEEN 0 AND 100) UNION ALL SELECT record_id, 'email' FROM auctioneers_unified WHERE NOT regexp_matches(innlei_email, '^[^@ ]+@[^@ ]+[.][^@ ]+$') UNION ALL SELECT id, 'area' FROM spatial_unit WHERE NOT (useful_area > 0 AND useful_area < 1000000)
 UNION ALL SELECT id, 'position' FROM address WHERE (latitude IS NULL) <> (longitude IS NULL) UNION ALL SELECT id, 'owner' FROM auction_lot WHERE source_url IS NULL AND source_lot_code IS NULL UNION ALL SELECT id, 'bid' FROM auction_lot WHERE NOT (minimum_bid >= 0)""")
def dq2_all_row_checks(spark, d):
    t = lambda n: table(spark, d, n)
    c = F.col
    parts = [
        R.failed_checks(t("lot_canonical_link"), "id", {"self_link": c("canonical_lot_id") != c("secondary_lot_id"), "confidence": c("confidence").between(0, 100)}),
        R.failed_checks(t("auctioneers_unified").withColumnRenamed("record_id", "id"), "id", {"email": c("innlei_email").rlike("^[^@ ]+@[^@ ]+[.][^@ ]+$")}), R.failed_checks(t("spatial_unit"), "id", {"area": (c("useful_area") > 0) & (c("useful_area") < 1_000_000)}),
        R.failed_checks(t("address"), "id", {"position": c("latitude").isNull() == c("longitude").isNull()}), R.failed_checks(t("auction_lot"), "id", {"owner": c("source_url").isNotNull() | c("source_lot_code").isNotNull(), "bid": c("minimum_bid") >= 0}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_FKS = [("auction_lot", "spatial_unit_id", "spatial_unit", "id"), ("spatial_unit", "address_id", "address", "id"), ("lot_canonical_link", "secondary_lot_id", "auction_lot", "id"), ("documents", "lot_id", "auction_lot", "id"), ("pilot_item", "auctioneer_slug", "ref_source", "short_name"), ("address", "municipality_code", "ref_municipality", "ibge_code")]
_UNIQUE = [("fetch_event", "id"), ("auction_lot", "id"), ("auctioneers_unified", "record_id"), ("pilot_item", "source_lot_url"), ("ref_municipality", "name"), ("documents", "doc_id")]


@query(" UNION ALL ".join([f"SELECT '{t}.{c}' AS rule, count(*) AS violations FROM {t} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {o} y WHERE y.{k} = x.{c})" for t, c, o, k in _FKS] + [f"SELECT 'unique {t}.{c}', count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)" for t, c in _UNIQUE]))
def dq3_all_keys(spark, d):
    return C.key_violations({n: table(spark, d, n) for n in {x for f in _FKS for x in (f[0], f[2])} | {t for t, _ in _UNIQUE}}, _FKS, _UNIQUE)


_BAD_ITEM = "CASE item_id % 7 WHEN 0 THEN '{\"title\": \"\", \"extra\": 1}' WHEN 1 THEN '{\"title\": \"x\", \"uf\": \"sp\", \"cep\": \"123\", \"auction_status\": \"ativo\", \"scraped_at\": \"2026-01-01T10:00:00\"}' WHEN 2 THEN '{broken' ELSE '{\"title\": \"x\", \"uf\": \"SP\", \"cep\": \"01310-100\", \"auction_status\": \"' || coalesce(auction_status, '') || '\", \"scraped_at\": \"2026-01-01T10:00:00-03:00\"}' END"


@query(f"SELECT item_id, CASE item_id % 7 WHEN 0 THEN 'auction_status,scraped_at,title,unknown:extra' WHEN 1 THEN 'cep,scraped_at,uf' WHEN 2 THEN 'json' ELSE CASE WHEN auction_status IN ({', '.join(repr(s) for s in rules.ITEM_STATUS)}) THEN '' ELSE 'auction_status' END END AS failures FROM pilot_item")
def dq4_item_schema(spark, d):
    k, st = F.col("item_id") % 7, F.coalesce("auction_status", F.lit(""))
    good = F.concat(F.lit('{"title": "x", "uf": "SP", "cep": "01310-100", "auction_status": "'), st, F.lit('", "scraped_at": "2026-01-01T10:00:00-03:00"}'))
    doc = F.when(k == 0, '{"title": "", "extra": 1}').when(k == 1, '{"title": "x", "uf": "sp", "cep": "123", "auction_status": "ativo", "scraped_at": "2026-01-01T10:00:00"}').when(k == 2, "{broken").otherwise(good)
    return table(spark, d, "pilot_item").select("item_id", F.array_join(C.item_schema_failures(doc), ",").alias("failures"))


_SQL_FILLED = lambda c: f"({c} IS NOT NULL AND trim({c}) <> '')"
_HARD = {"title": _SQL_FILLED("title"), "raw_text": _SQL_FILLED("address.raw_text"), "status": _SQL_FILLED("auction_status"), "url": _SQL_FILLED("source_lot_url"), "round": "coalesce(len(list_filter(rounds, lambda r: r.minimum_bid_brl IS NOT NULL)) > 0, false)", "provenance": "coalesce(item_id % 3 > 0 AND source_lot_url IS NOT NULL, false)"}


@query("SELECT item_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN NOT {t} THEN '{n}' END" for n, t in _HARD.items()) + "], lambda x: x IS NOT NULL), ',') AS failures FROM pilot_item")
def dq5_with_provenance(spark, d):
    """The page of every third item doesn't hold the address of its lot."""
    t = table(spark, d, "pilot_item")
    pages = t.select("item_id", F.concat(F.lit("<a href='"), F.when(F.col("item_id") % 3 > 0, F.col("source_lot_url")).otherwise("https://x.example"), F.lit("'>")).alias("html"))
    return C.hard_failures(t, pages, "item_id").select("item_id", F.array_join("failures", ",").alias("failures"))


_SOFT = [f"CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN '{c}' END" for c in rules.SOFT_FIELDS] + ["'images'", "'documents'"]


@query(f"SELECT item_id, array_to_string(list_filter([{', '.join(_SOFT)}], lambda x: x IS NOT NULL), ',') AS warnings FROM pilot_item")
def dq6_all_warnings(spark, d):
    return table(spark, d, "pilot_item").select("item_id", F.array_join(C.soft_warnings(table(spark, d, "pilot_item")), ",").alias("warnings"))


_HAS = ["auctioneer_slug", "source_listing_url", "source_lot_url", "title", "description", "property_type", "area_sqm", "market_value_brl", "auction_status", "scraped_at", "address.raw_text", "address.street_name", "address.number", "address.municipality_name", "address.uf", "address.cep"]


@query("SELECT item_id, " + " + ".join(f"CASE WHEN {c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> '' THEN 1 ELSE 0 END" for c in _HAS) + " + CASE WHEN coalesce(len(rounds), 0) > 0 THEN 1 ELSE 0 END AS filled, 25 AS fields FROM pilot_item")
def dq7_all_fields(spark, d):
    t = table(spark, d, "pilot_item")
    fills = C.item_fill(t)
    return t.select("item_id", F.aggregate(F.map_values(fills), F.lit(0), lambda s, v: s + v.cast("int")).alias("filled"), F.size(fills).alias("fields"))


_SPECS = [
    '{"auctioneer_slug": "a", "listing_active": {"url_pattern": "u", "card_selector": "c", "card_kind": "css", "pagination": {"kind": "path"}}, "listing_closed": null, "detail": {"url_pattern": "u", "field_selectors": {"title": {"selector": "h1", "kind": "css"}, "price_minimum": null, "price_market": null, "address_block": null, "images": null, "documents": null}}}',
    '{"auctioneer_slug": " ", "listing_active": null, "detail": {"url_pattern": 5}}', '{"auctioneer_slug": "b", "listing_active": {"card_kind": "regex", "pagination": {"kind": "next"}}, "listing_closed": null, "detail": {"url_pattern": "u", "field_selectors": {"title": {"kind": "css"}}}}', "[1]",
]


@query(f"SELECT short_name, ({['0', '5', '10', '1']!r})[1 + length(short_name) % 4] AS errors FROM ref_source")
def dq8_selector_lint(spark, d):
    """Files of selectors are a few and are read on the driver; here one of four is linted per source."""
    found = [len(C.lint_selectors(C.parse_spec(s))) for s in _SPECS]
    return table(spark, d, "ref_source").select("short_name", F.element_at(F.lit([str(n) for n in found]), (F.length("short_name") % 4 + 1).cast("int")).alias("errors"))


@query("""WITH f AS (SELECT DISTINCT id, source_short_name, created_at FROM fetch_event), m AS (SELECT max(created_at) AS as_of FROM f) SELECT source_short_name FROM f, m GROUP BY 1 HAVING count(*) > 10 AND count(*) FILTER (WHERE created_at > as_of - INTERVAL 24 HOUR) = 0""")
def dq10_alerts(spark, d):
    f = table(spark, d, "fetch_event").select("id", "source_short_name", "created_at").distinct()
    as_of = f.agg(F.max("created_at").alias("as_of"))
    n = f.crossJoin(F.broadcast(as_of)).groupBy("source_short_name").agg(F.count("*").alias("total"), F.count_if(F.col("created_at") > F.col("as_of") - F.expr("INTERVAL 24 HOURS")).alias("recent"))
    return n.where("total > 10 and recent = 0").select("source_short_name")


@query("SELECT DISTINCT auctioneer_slug AS short_name FROM pilot_item WHERE auctioneer_slug NOT IN (SELECT source_short_name FROM probe2_imoveis_with_bid WHERE source_short_name IS NOT NULL AND lot_visits > 1500)")
def set3_not_much_visited(spark, d):
    seen = table(spark, d, "probe2_imoveis_with_bid").where("lot_visits > 1500").select(F.col("source_short_name").alias("short_name"))
    return table(spark, d, "pilot_item").where("auctioneer_slug is not null").select(F.col("auctioneer_slug").alias("short_name")).distinct().join(seen, "short_name", "left_anti")


@query("SELECT 'site-' || short_name AS folder, CASE WHEN length(short_name) % 3 = 0 THEN NULL ELSE length(short_name) END AS n, length(short_name) % 3 = 0 AS corrupt FROM ref_source", texts="corrupt")
def src4_json_folder(spark, d):
    import_ = table(spark, d, "ref_source").select("short_name", F.length("short_name").alias("n"))
    docs = import_.select(F.when(F.col("n") % 3 == 0, F.concat(F.lit("{broken "), F.col("short_name"))).otherwise(F.to_json(F.struct("n"))).alias("value"), F.concat(F.lit("site-"), F.col("short_name")).alias("folder"))
    path = readers.new_folder(spark, "json")
    docs.repartition("folder").write.partitionBy("folder").text(path)
    return readers.read_json_folder(spark, path, "n int").select("folder", "n", "corrupt")
