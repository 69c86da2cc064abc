"""Queries of what and where: kinds, creditors, boards, states, cities and the jobs that fill addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from pregonero.functions import parsers as P
from pregonero.functions import places as L
from pregonero.functions.text import STATES, fold, normalise_uf, words
from pregonero.operators import places as O
from pregonero.plans.reference_queries import _TRI, _uf_sql, fold_sql, query, words_sql
from pregonero.rules import BOARD_OF_STATE, CEP_RANGES, CREDITORS, STATE_NAMES, UNIT_KINDS
from pregonero.session import table

# Texts that reach every rule of the kinds of units; even lots are described by one of them, odd ones by their own text.
KIND_TEXTS = [
    "Vaga de garagem coberta", "Kitnet mobiliada", "Studio residencial", "Flat residencial", "Sobrado em vila", "Galpão", "Salas 12 do prédio", "Loja de rua", "Loja de lojista", "Prédio inteiro", "Unidade autônoma", "Casa de fazenda", "Sítio", "Chácara",
    "Fração ideal do lote", "Fração de imóvel", "Cota do imóvel", "Imóvel rural", "Terreno com 12,5 hectares", "10 ha de terreno", "Lote urbano", "Gleba", "Casa térrea", "Uma casa", "Residência residencial", "Imóvel comercial", "Casa grande", "Casa", "Um imóvel", "Trator", "",
]
BANK_TEXTS = ["Caixa Economica Federal", "CEF", "Banco do Brasil", "BB S.A.", "Bradesco", "Santander", "Itaú Unibanco", "BNB", "Banrisul", "BRB", "Votorantim", "Banco Inter", "Safra e Sicoob", "Sicredi", "Daycoval", "BTG Pactual", "Nubank", "C6 Bank", "Banco Original", "HSBC", "Banco Fibra e CEF", "ninguém"]
STATE_TEXTS = ["Rua A, Centro, {c}, {u}, CEP 1", "imovel--{l}--centro", "https://x.example/casa-{l}-em-oferta", "ESTADO: {u} bairro", "Casa em Um/SP e outra em {c} / {u}.", "lote-{l}", "sem estado"]
CITY_TEXTS = ["Imóvel no município de {c}, lote.", "Casa em {c}.", "CIDADE: {c} / X", "Nada aqui"]
BOARD_TEXTS = ["Junta Comercial do Estado de {s}", "Junta Comercial do {s}", "Junta Comercial Industrial e Serviços do {s}", "Outra"]


def _list_sql(texts: list[str]) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"


def _pick(texts: list[str], number):
    return F.element_at(F.lit(texts), (number % len(texts) + 1).cast("int"))


def _pick_sql(texts: list[str], number: str) -> str:
    return f"({_list_sql(texts)})[1 + {number} % {len(texts)}]"


def _filled(texts, number, **by):
    out = _pick(texts, number)
    for k, v in by.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v, F.lit("")))
    return out


def _filled_sql(texts, number, **by) -> str:
    out = _pick_sql(texts, number)
    for k, v in by.items():
        out = f"replace({out}, '{{{k}}}', coalesce({v}, ''))"
    return out


def _case_sql(c: str, rules, default="NULL") -> str:
    return "CASE " + " ".join(f"WHEN {' AND '.join(f'regexp_matches({c}, {chr(39)}{r}{chr(39)})' for r in needed)}" + (f" AND NOT regexp_matches({c}, '{never}')" if never else "") + f" THEN '{label}'" for label, needed, never in rules) + f" ELSE {default} END"


_KIND_TEXT = f"CASE WHEN id % 2 = 0 THEN {_pick_sql(KIND_TEXTS, '(id // 2)')} ELSE description END"


@query(f"SELECT id, CASE WHEN t IS NULL OR trim(t) = '' THEN 'desconhecida' ELSE {_case_sql('f', UNIT_KINDS, chr(39) + 'desconhecida' + chr(39))} END AS kind FROM (SELECT id, {_KIND_TEXT} AS t, {fold_sql(_KIND_TEXT)} AS f FROM auction_lot)")
def fn7_unit_kinds(spark, d):
    lots = table(spark, d, "auction_lot")
    text = F.when(F.col("id") % 2 == 0, _pick(KIND_TEXTS, F.floor(F.col("id") / 2))).otherwise(F.col("description"))
    return lots.select("id", L.unit_kind(text).alias("kind"))


_CRED = f"coalesce(description, '') || ' Credor: ' || {_pick_sql(BANK_TEXTS, 'id')}"
_CRED_LIST = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(f, '{r}') THEN '{n}' END" for n, r in CREDITORS) + "], lambda x: x IS NOT NULL)"


def _with_creditors(spark, d):
    text = F.concat(F.coalesce("description", F.lit("")), F.lit(" Credor: "), _pick(BANK_TEXTS, F.col("id")))
    return table(spark, d, "auction_lot").select("id", text.alias("t"))


@query(f"SELECT id, array_to_string({_CRED_LIST}, ',') AS creditors FROM (SELECT id, {fold_sql(_CRED)} AS f FROM auction_lot)")
def fn8_creditors(spark, d):
    return _with_creditors(spark, d).select("id", F.array_join(L.creditors(F.col("t")), ",").alias("creditors"))


@query(f"SELECT DISTINCT c AS display_name, id AS lot_id, 'fiduciario' AS role FROM (SELECT id, unnest({_CRED_LIST}) AS c FROM (SELECT id, {fold_sql(_CRED)} AS f, length({_CRED}) AS n FROM auction_lot) WHERE n >= 20)")
def ups17_creditor_roles(spark, d):
    return O.creditor_roles(_with_creditors(spark, d), "id", "t")


_FN9 = r"'([A-Z][A-Za-z\s.''-]{2,40})\s*[/-]\s*([A-Z]{2})(?:\s|[.]|$|,|\"|<)'"


@query(f"""SELECT id, CASE WHEN good THEN city END AS city, CASE WHEN good THEN uf END AS uf FROM (SELECT *, length(city) >= 3 AND NOT regexp_matches(lower(city), '{L.NO_CITY}') AS good FROM
 (SELECT id, trim(NULLIF(regexp_extract(strip_accents(raw_text), {_FN9}, 1), '')) AS city, NULLIF(regexp_extract(strip_accents(raw_text), {_FN9}, 2), '') AS uf FROM address))""")
def fn9_city_and_state(spark, d):
    return table(spark, d, "address").select("id", L.city_and_state(F.col("raw_text")).alias("x")).select("id", "x.*")


_STATE_SQL_TEXT = _filled_sql(STATE_TEXTS, "id", c="municipality_name", u="u", l="lower(u)")
_IN = "(" + ", ".join(f"'{s}'" for s in STATES) + ")"


def _clue_sql(patterns, last) -> str:
    parts = []
    for rx in patterns:
        g = 2 if rx.count("(") - rx.count("(?:") == 2 else 1
        q = rx.replace("'", "''")
        parts.append(f"list_zip(regexp_extract_all(t, '{q}', 1), regexp_extract_all(t, '{q}', {g}))")
    keys = "list_transform(list_filter(" + (parts[0] if len(parts) == 1 else "flatten([" + ", ".join(parts) + "])") + f", lambda z: upper(trim(z[2])) IN {_IN}), lambda z: printf('%09d', instr(t, z[1])) || upper(trim(z[2])))"
    return f"right({'list_max' if last else 'list_first'}({keys}), 2)"


@query(f"SELECT id, coalesce({', '.join(_clue_sql(*c) for c in L.STATE_CLUES)}) AS uf FROM (SELECT id, strip_accents({_STATE_SQL_TEXT}) AS t FROM (SELECT *, coalesce({_uf_sql('uf')}, 'XX') AS u FROM address))")
def fn10_state_of_text(spark, d):
    u = F.coalesce(normalise_uf(F.col("uf")), F.lit("XX"))
    text = _filled(STATE_TEXTS, F.col("id"), c=F.col("municipality_name"), u=u, l=F.lower(u))
    return table(spark, d, "address").select("id", L.state_of_text(text).alias("uf"))


_CITY_SQL_TEXT = _filled_sql(CITY_TEXTS, "id", c="municipality_name")
_CANDIDATES = "list_filter(list_transform(flatten([" + ", ".join("regexp_extract_all(f, '" + rx.replace("'", "''") + "', 1)" for rx in L.CITY_CLUES) + "]), lambda c: trim(c)), lambda c: length(c) >= 3)"


@query(f"""WITH t AS (SELECT id, {fold_sql(_CITY_SQL_TEXT)} AS f FROM address), c AS (SELECT id, unnest(k) AS city, generate_subscripts(k, 1) AS o FROM (SELECT id, {_CANDIDATES} AS k FROM t)),
 u AS (SELECT {fold_sql('name')} AS n, min(uf) AS uf FROM ref_municipality GROUP BY 1 HAVING count(*) = 1) SELECT t.id, (SELECT arg_min(u.uf, c.o) FROM c JOIN u ON u.n = c.city WHERE c.id = t.id) AS uf FROM t""")
def fn11_state_of_city(spark, d):
    text = _filled(CITY_TEXTS, F.col("id"), c=F.col("municipality_name"))
    return O.state_of_named_city(table(spark, d, "address").select("id", text.alias("t")), "id", "t", table(spark, d, "ref_municipality"))


_CEP2 = "CASE WHEN length(trim(cep)) >= 5 AND length(regexp_replace(cep, '[^0-9]', '', 'g')) >= 2 THEN CAST(left(regexp_replace(cep, '[^0-9]', '', 'g'), 2) AS INTEGER) END"


@query(f"SELECT id, CASE {' '.join(f'WHEN n BETWEEN {a} AND {b} THEN {chr(39)}{s}{chr(39)}' for a, b, s in CEP_RANGES)} END AS uf FROM (SELECT id, {_CEP2} AS n FROM address)")
def fn12_state_of_cep(spark, d):
    return table(spark, d, "address").select("id", L.state_of_cep(F.col("cep")).alias("uf"))


@query(f"SELECT id, {_case_sql(fold_sql('raw_text'), [(s, [r], None) for s, r in STATE_NAMES])} AS uf FROM address")
def fn13_state_named(spark, d):
    return table(spark, d, "address").select("id", L.state_named(F.col("raw_text")).alias("uf"))


_STATE_NAME = "CASE uf " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in STATES.items()) + " END"
_BOARD = "CASE {c} " + " ".join(f"WHEN '{s}' THEN '{b}'" for s, b in BOARD_OF_STATE.items()) + " END"


@query(f"SELECT record_id, coalesce({_BOARD.format(c='s')}, {_BOARD.format(c='upper(trim(uf))')}, '') AS board FROM (SELECT record_id, uf, {_uf_sql('n')} AS s FROM (SELECT record_id, uf, NULLIF(regexp_extract({fold_sql('trim(long)')}, '{L.BOARD_NAME}', 1), '') AS n FROM (SELECT record_id, uf, {_filled_sql(BOARD_TEXTS, 'record_id', s=_STATE_NAME)} AS long FROM auctioneers_unified)))")
def prj25_board(spark, d):
    names = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])
    long = _filled(BOARD_TEXTS, F.col("record_id"), s=F.try_element_at(names, F.col("uf")))
    return table(spark, d, "auctioneers_unified").select("record_id", L.board(long, F.col("uf")).alias("board"))


_REG_TEXT = "CASE record_id % 3 WHEN 0 THEN coalesce(matricula, '') || '/' || coalesce(junta_sigla, '') WHEN 1 THEN coalesce(junta_sigla, '') || ' AARC ' || coalesce(matricula, '') ELSE matricula END"


@query(f"""SELECT record_id, CASE WHEN a IN {_IN} THEN a WHEN b IN {_IN} THEN b END AS uf, NULLIF(left(CASE WHEN a IN {_IN} THEN an WHEN b IN {_IN} THEN trim(bn) ELSE t END, 10), '') AS number FROM (SELECT *, upper(regexp_extract(t, '(?i)^([\\w./-]+)\\s*/\\s*juc[a-z]*?([a-z]{{2}})\\s*$', 2)) AS a, regexp_extract(t, '(?i)^([\\w./-]+)\\s*/\\s*juc[a-z]*?([a-z]{{2}})\\s*$', 1) AS an,
 upper(regexp_extract(t, '(?i)^juc[a-z]*?([a-z]{{2}})\\s+(?:aarc\\s+)?(.+)$', 1)) AS b, regexp_extract(t, '(?i)^juc[a-z]*?([a-z]{{2}})\\s+(?:aarc\\s+)?(.+)$', 2) AS bn FROM (SELECT record_id, trim(coalesce({_REG_TEXT}, '')) AS t FROM auctioneers_unified))""")
def prj26_board_registration(spark, d):
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    k = F.col("record_id") % 3
    text = F.when(k == 0, F.concat(c("matricula"), F.lit("/"), c("junta_sigla"))).when(k == 1, F.concat(c("junta_sigla"), F.lit(" AARC "), c("matricula"))).otherwise(F.col("matricula"))
    return table(spark, d, "auctioneers_unified").select("record_id", L.board_registration(text).alias("x")).select("record_id", "x.*")


_A, _B = L.CITY_SLASH.replace("'", "''"), L.CITY_PAREN.replace("'", "''")


@query(f"""SELECT id, CASE WHEN length(a) BETWEEN 3 AND 50 THEN a WHEN length(b) BETWEEN 3 AND 50 THEN b END AS city, CASE WHEN length(a) BETWEEN 3 AND 50 THEN au WHEN length(b) BETWEEN 3 AND 50 THEN bu END AS uf FROM (SELECT id, trim(NULLIF(regexp_extract(t, '{_A}', 1), '')) AS a, NULLIF(regexp_extract(t, '{_A}', 2), '') AS au,
 trim(NULLIF(regexp_extract(t, '{_B}', 1), '')) AS b, NULLIF(regexp_extract(t, '{_B}', 2), '') AS bu FROM (SELECT id, strip_accents(raw_text) AS t FROM address))""")
def prj28_two_forms(spark, d):
    return table(spark, d, "address").select("id", L.city_in_two_forms(F.col("raw_text")).alias("x")).select("id", "x.*")


_LAB = L.LABELLED.replace("'", "''")
_PAIR = r"^(.+?),\s*([0-9SsNn][0-9SsNn/.-]*)\s*$"
# two of three texts get the label and the city that the form asks for
_BLOB = "CASE WHEN id % 3 > 0 THEN 'Endereço: ' || coalesce(street_name, 'Rua A') || ', ' || coalesce(number, 'S/N') || CASE WHEN id % 3 = 1 THEN ' - ' || coalesce(district, 'Centro') ELSE '' END || ' Cidade: ' || coalesce(municipality_name, 'X') || ' / ' || lower(left(coalesce(uf, 'sp'), 2)) || CASE WHEN length(cep) = 9 THEN ' - CEP: ' || cep ELSE '' END ELSE raw_text END"


@query(f"""SELECT id, CASE WHEN m THEN CASE WHEN p THEN trim(regexp_extract(rest, '{_PAIR}', 1)) ELSE rest END ELSE NULLIF(s, '') END AS street, CASE WHEN m AND p THEN trim(regexp_extract(rest, '{_PAIR}', 2)) END AS number, CASE WHEN m THEN g2 END AS district, CASE WHEN m THEN g3 END AS city, CASE WHEN m THEN upper(g4) END AS uf, CASE WHEN m AND length(g5) = 8 THEN g5 END AS cep
 FROM (SELECT *, coalesce(regexp_matches(rest, '{_PAIR}'), false) AS p FROM (SELECT id, s, regexp_matches(s, '{_LAB}') AS m, NULLIF(trim(regexp_extract(s, '{_LAB}', 1)), '') AS rest, NULLIF(trim(regexp_extract(s, '{_LAB}', 2)), '') AS g2, NULLIF(trim(regexp_extract(s, '{_LAB}', 3)), '') AS g3, NULLIF(trim(regexp_extract(s, '{_LAB}', 4)), '') AS g4, regexp_replace(regexp_extract(s, '{_LAB}', 5), '[^0-9]', '', 'g') AS g5
 FROM (SELECT id, trim(regexp_replace(regexp_replace({_BLOB}, '{L.LABEL}', ''), '\\s+', ' ', 'g')) AS s FROM address)))""")
def fn4_labelled_blob(spark, d):
    c = lambda n, v: F.coalesce(F.col(n), F.lit(v))
    k = F.col("id") % 3
    built = F.concat(
        F.lit("Endereço: "), c("street_name", "Rua A"), F.lit(", "), c("number", "S/N"), F.when(k == 1, F.concat(F.lit(" - "), c("district", "Centro"))).otherwise(""), F.lit(" Cidade: "), c("municipality_name", "X"),
        F.lit(" / "), F.lower(F.left(c("uf", "sp"), F.lit(2))), F.when(F.length("cep") == 9, F.concat(F.lit(" - CEP: "), F.col("cep"))).otherwise(""),
    )
    return table(spark, d, "address").select("id", L.labelled_address(F.when(k > 0, built).otherwise(F.col("raw_text"))).alias("x")).select("id", "x.*")


_DASH = "coalesce(street_name, 'Rua A') || ', ' || coalesce(number, 'S/N') || ' - ' || coalesce(district || ' - ', '') || coalesce(municipality_name, '') || ' / ' || upper(left(coalesce(uf, 'sp'), 2))"
_P = r"^(.+?),\s*([\dSNs/-]+)\s*$"


@query(f"""SELECT id, CASE WHEN regexp_matches(h, '{_P}') THEN trim(regexp_extract(h, '{_P}', 1)) ELSE h END AS street, CASE WHEN regexp_matches(h, '{_P}') THEN trim(regexp_extract(h, '{_P}', 2)) END AS number, CASE WHEN len(parts) >= 3 THEN parts[-2] END AS district, trim(NULLIF(regexp_extract(s, '-\\s*([^-/]+?)\\s*/\\s*[A-Z]{{2}}\\s*$', 1), '')) AS city, NULLIF(regexp_extract(s, '/\\s*([A-Z]{{2}})\\s*$', 1), '') AS uf
 FROM (SELECT *, parts[1] AS h FROM (SELECT id, s, list_transform(string_split(s, ' - '), lambda x: trim(x)) AS parts FROM (SELECT id, trim(regexp_replace({_DASH}, '\\s+', ' ', 'g')) AS s FROM address)))""")
def prj29_dashed_address(spark, d):
    c = lambda n, v: F.coalesce(F.col(n), F.lit(v))
    text = F.concat(c("street_name", "Rua A"), F.lit(", "), c("number", "S/N"), F.lit(" - "), F.coalesce(F.concat(F.col("district"), F.lit(" - ")), F.lit("")), c("municipality_name", ""), F.lit(" / "), F.upper(F.left(c("uf", "sp"), F.lit(2))))
    return table(spark, d, "address").select("id", L.dashed_address(text).alias("x")).select("id", "x.*")


# ---- matching and jobs -------------------------------------------------------------------------------------------

_FUZZY = """{p} AS (SELECT a.w, a.uf, m.ibge_code, a.w = m.w AS exact, """ + _TRI.format(w="a.w") + """ AS x, """ + _TRI.format(w="m.w") + """ AS y FROM {names} a JOIN (SELECT ibge_code, uf, """ + words_sql("name") + """ AS w FROM ref_municipality) m USING (uf)),
 {p}_best AS (SELECT w, uf, ibge_code FROM (SELECT *, row_number() OVER (PARTITION BY w, uf ORDER BY exact DESC, round(sim, 9) DESC, ibge_code) AS k FROM (SELECT *, len(list_intersect(x, y)) / greatest(len(list_distinct(list_concat(x, y))), 1) AS sim FROM {p}) WHERE exact OR sim >= 0.6) WHERE k = 1)"""


@query(f"""WITH a AS (SELECT DISTINCT {words_sql('municipality_name')} AS w, {_uf_sql('uf')} AS uf FROM address WHERE trim(municipality_name) <> '' AND {_uf_sql('uf')} IS NOT NULL), {_FUZZY.format(p='p', names='a')}
 SELECT a.w AS name, a.uf, coalesce(b.ibge_code, CASE WHEN a.uf = 'DF' THEN '{O.DF_CODE}' END) AS code FROM a LEFT JOIN p_best b ON a.w = b.w AND a.uf = b.uf""")
def fn5_match_municipality(spark, d):
    names = table(spark, d, "address").where(F.trim("municipality_name") != "").select(words(F.col("municipality_name")).alias("name"), normalise_uf(F.col("uf")).alias("uf")).where("uf is not null").distinct()
    return O.municipality_codes(names, table(spark, d, "ref_municipality"))


_RAW9 = _FN9


@query(f"""WITH t AS (SELECT item_id, trim(NULLIF(regexp_extract(strip_accents(address.raw_text), {_RAW9}, 1), '')) AS city, NULLIF(regexp_extract(strip_accents(address.raw_text), {_RAW9}, 2), '') AS uf, address.raw_text AS raw_text FROM pilot_item WHERE address.cep IS NULL AND length(trim(address.raw_text)) >= 10),
 g AS (SELECT * FROM t WHERE length(city) >= 3 AND NOT regexp_matches(lower(city), '{L.NO_CITY}')), n AS (SELECT DISTINCT {words_sql('city')} AS w, uf FROM g), {_FUZZY.format(p='p', names='n')}
 SELECT g.item_id AS lot_id, g.uf, coalesce(b.ibge_code, CASE WHEN g.uf = 'DF' THEN '{O.DF_CODE}' END) AS municipality_code, 'municipality_centroid_bootstrap' AS geocoding_source, g.raw_text, 'desconhecida' AS kind FROM g LEFT JOIN p_best b ON {words_sql('g.city')} = b.w AND g.uf = b.uf WHERE coalesce(b.ibge_code, CASE WHEN g.uf = 'DF' THEN '{O.DF_CODE}' END) IS NOT NULL""")
def ups18_bootstrap_addresses(spark, d):
    lots = table(spark, d, "pilot_item").where(F.col("address.cep").isNull()).select(F.col("item_id").alias("lot_id"), F.col("address.raw_text").alias("text"))
    return O.bootstrap_addresses(lots, table(spark, d, "ref_municipality"))


_CASCADE_TEXT = "coalesce(raw_text, '')"


@query(f"""WITH t AS (SELECT id, uf, cep, municipality_code, strip_accents({_CASCADE_TEXT}) AS t, {fold_sql(_CASCADE_TEXT)} AS f, raw_text FROM address),
 c AS (SELECT id, unnest(k) AS city, generate_subscripts(k, 1) AS o FROM (SELECT id, {_CANDIDATES} AS k FROM t)), u AS (SELECT {fold_sql('name')} AS n, min(uf) AS uf FROM ref_municipality GROUP BY 1 HAVING count(*) = 1),
 l AS (SELECT c.id, arg_min(u.uf, c.o) AS uf FROM c JOIN u ON u.n = c.city GROUP BY 1)
 SELECT t.id, coalesce({_uf_sql('t.uf')}, {', '.join(_clue_sql(*c).replace('(t,', '(t.t,') for c in L.STATE_CLUES)}, l.uf, CASE {' '.join(f'WHEN t.n BETWEEN {a} AND {b} THEN {chr(39)}{s}{chr(39)}' for a, b, s in CEP_RANGES)} END, dash.uf, {_case_sql('t.f', [(s, [r], None) for s, r in STATE_NAMES])}, m.uf) AS uf
 FROM (SELECT *, {_CEP2} AS n FROM t) t LEFT JOIN l USING (id) LEFT JOIN u dash ON dash.n = trim(regexp_extract(t.f, ' - ([a-z][a-z .]*)$', 1)) LEFT JOIN ref_municipality m ON m.ibge_code = coalesce(CASE WHEN regexp_matches(t.raw_text, '^[0-9]{{7}}$') THEN t.raw_text END, t.municipality_code)""")
def ups20_seven_passes(spark, d):
    return O.fill_states(table(spark, d, "address").select("id", "uf", "cep", "municipality_code", "raw_text"), table(spark, d, "ref_municipality"))


@query(f"""WITH a AS (SELECT *, {_BLOB} AS blob FROM address WHERE municipality_code IS NULL), s AS (SELECT id, trim(regexp_replace(regexp_replace(blob, '{L.LABEL}', ''), '\\s+', ' ', 'g')) AS s, district, cep, uf, geocoding_source FROM a),
 g AS (SELECT id, uf, district, cep, geocoding_source, regexp_matches(s, '{_LAB}') AS m, NULLIF(trim(regexp_extract(s, '{_LAB}', 3)), '') AS city, upper(NULLIF(trim(regexp_extract(s, '{_LAB}', 4)), '')) AS puf, NULLIF(trim(regexp_extract(s, '{_LAB}', 2)), '') AS pdistrict FROM s),
 n AS (SELECT DISTINCT {words_sql('city')} AS w, puf AS uf FROM g WHERE m), {_FUZZY.format(p='p', names='n')}
 SELECT g.id, coalesce(CASE WHEN m THEN pdistrict END, district) AS district, coalesce(CASE WHEN m THEN puf END, g.uf) AS uf, coalesce(b.ibge_code, CASE WHEN m AND puf = 'DF' THEN '{O.DF_CODE}' END) AS code, coalesce(g.geocoding_source, CASE WHEN coalesce(b.ibge_code, CASE WHEN m AND puf = 'DF' THEN '{O.DF_CODE}' END) IS NOT NULL THEN 'municipality_centroid' END) AS source FROM g LEFT JOIN p_best b ON m AND {words_sql('g.city')} = b.w AND g.puf = b.uf""")
def ups19_normalise_addresses(spark, d):
    c = lambda n, v: F.coalesce(F.col(n), F.lit(v))
    k = F.col("id") % 3
    built = F.concat(
        F.lit("Endereço: "), c("street_name", "Rua A"), F.lit(", "), c("number", "S/N"), F.when(k == 1, F.concat(F.lit(" - "), c("district", "Centro"))).otherwise(""), F.lit(" Cidade: "), c("municipality_name", "X"),
        F.lit(" / "), F.lower(F.left(c("uf", "sp"), F.lit(2))), F.when(F.length("cep") == 9, F.concat(F.lit(" - CEP: "), F.col("cep"))).otherwise(""),
    )
    rows = table(spark, d, "address").withColumn("raw_text", F.when(k > 0, built).otherwise(F.col("raw_text")))
    return O.normalise_pending(rows, table(spark, d, "ref_municipality")).select("id", "district", "uf", F.col("municipality_code").alias("code"), F.col("geocoding_source").alias("source"))
