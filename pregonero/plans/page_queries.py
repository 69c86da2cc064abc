"""Queries over pages and texts of sites. The tables hold no HTML, so a page is written from every row of pilot_item, by turns
with the marks of one platform, and read again; the SQL writes the same page."""

from __future__ import annotations

from pyspark.sql import functions as F

from pregonero.functions import parsers as P
from pregonero.functions import sites as S
from pregonero.functions.text import fold
from pregonero import rules as R
from pregonero.operators import relational as Rel
from pregonero.plans.place_queries import _pick, _pick_sql
from pregonero.plans.reference_queries import fold_sql, query, rules_sql
from pregonero.rules import providers as V
from pregonero.session import table
from pregonero.sources import readers
from pregonero.sources import registries as G

# Marks of pages by turns: (host, html, signals, generator, server); every rule of the platforms has one.
SITES = [
    ("a.example", '<meta name="author" content="SOLEON">', "", "", "nginx"), ("b.example", "Tecnologia SOLEON", "", "", ""), ("c.example", "soleon.com.br", "", "", "Apache/2"), ("x.leilao.br", "", "", "", "cloudflare"), ("d.example", "veja leilao.br", "leilao.br", "", ""),
    ("x.suporteleiloes.com.br", "", "", "", ""), ("e.example", "cdn.suporteleiloes.com.br", "", "", ""), ("f.example", "suporteleiloes.com.br", "", "", ""), ("g.example", "/sishp/lote/1", "", "", ""), ("h.example", "lancetotal.com.br", "", "", ""), ("i.example", "o sishp, aqui", "", "", ""),
    ("j.example", '<meta name="author" content="Leilão Pro">', "", "", ""), ("k.example", "https://www.leilao.pro", "", "", ""), ("l.example", "leilotech.workers.dev", "", "", ""), ("m.example", "plataformaleiloar.com.br", "", "", ""), ("n.example", "cesvibrasil.com.br", "", "", ""), ("o.example", "bomvalor.com.br", "", "", ""),
    ("palaciodosleiloes.example", "", "", "", ""), ("p.example", "s4bdigital.net", "", "", ""), ("ww17.example", "", "", "", ""), ("q.example", "softgt.com.br", "", "", ""), ("r.example", "SoftGT Informatica", "", "", ""),
    ("s.example", '<title inertia>x</title><div data-page="{&quot;component&quot;:1}"></div>/build/assets/a.js', "", "", ""), ("www.portalzuk.com.br", "", "", "", ""), ("t.example", '<i class="card-property property-prices">', "", "", ""), ("u.example", "leiloesbr.com.br/peca.asp", "", "", ""), ("v.example", "leiloesbr.com.br", "", "", ""),
    ("w.example", "leiloesweb.com.br", "", "", ""), ("y.example", "wixstatic.com", "", "Wix.com Website Builder", ""), ("z.example", "/dg-temas/", "", "", ""), ("superbid.example", "superbid", "", "", ""), ("aa.example", "megaleiloes.com.br", "", "", ""), ("sodresantoro.example", "sodresantoro", "", "", ""), ("ab.example", "", "leilovip", "", ""),
    ("ac.example", "biddo", "biddo", "", ""), ("ad.example", "E-LEILÕES _nuxt /_nuxt/", "", "", ""), ("ae.example", "/wp-content/ jQuery", "", "WordPress 6.1", ""), ("af.example", "jquery bootstrap", "", "", ""), ("ag.example", "__NEXT_DATA__ data-reactroot v-cloak ng-app", "", "Joomla! 3", ""), ("ah.example", "leilo.com nada", "", "", ""),
]
_COLS = {c: [s[i] for s in SITES] for i, c in enumerate(("host", "mark", "signals", "generator", "server"))}
META_FORMS = ['<meta name="description" content="{d}">', '<meta property="og:description" content="{d}">', '<META NAME="Description" CONTENT="{d}">', ""]
LINKS = '<a href="/imoveis-disponiveis">Imóveis</a> <a href="/destaques">Lotes em destaque</a> <a href="/lotes?categoria=imovel"><b>Veja</b></a> <a href="/sobre-nos">Sobre</a> <a href="mailto:a@b.example">Mail</a> <a href="#topo">Topo</a>'


def _pages(spark, d):
    """(item_id, url, host, signals, server, static, html) of every item: html has more links than static."""
    t, k = table(spark, d, "pilot_item"), F.col("item_id")
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    meta = F.replace(_pick(META_FORMS, k), F.lit("{d}"), F.left(c("description"), F.lit(150)))
    static = F.concat(
        F.lit("<html><head><title> "), c("title"), F.lit("\n</title>"), meta, F.when(_pick(_COLS["generator"], k) != "", F.concat(F.lit('<meta name="generator" content="'), _pick(_COLS["generator"], k), F.lit('">'))).otherwise(""),
        F.lit("</head><body>"), _pick(_COLS["mark"], k), F.when(k % 3 == 0, "").otherwise(LINKS), F.lit("<dl><dt>Tipo:</dt><dd>"), c("property_type"), F.lit("</dd> <dt>Tipo</dt><dd>outro</dd><dt>Anúncio</dt><dd><b>"), k.cast("string"),
        F.lit('</b></dd></dl><script>var loadData = {"id": '), k.cast("string"), F.lit(', "lote": {"tipo": "'), c("property_type"), F.lit('", "nota": "}{"}}; x = {};</script><script type="application/ld+json">{"@type": "'), F.when(k % 2 == 0, "Product").otherwise("BreadcrumbList"), F.lit('", "name": "n'), k.cast("string"),
        F.lit('"}</script><p>R$ 1.000,00 '), c("description"), F.lit("</p></body></html>"),
    )
    more = F.array_join(F.transform(F.sequence(F.lit(0), (k % 7).cast("int")), lambda i: F.concat(F.lit('<a href="/lote/'), i.cast("string"), F.lit('">Lote</a>'))), "")
    host = _pick(_COLS["host"], k)
    return t.select("item_id", F.concat(F.lit("https://"), host, F.lit("/item/"), k.cast("string")).alias("url"), host.alias("host"), _pick(_COLS["signals"], k).alias("signals"), _pick(_COLS["server"], k).alias("server"), static.alias("static"), F.concat(static, more).alias("html"))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_G = _pick_sql(_COLS["generator"], "item_id")
_STATIC = (
    f"'<html><head><title> ' || coalesce(title, '') || chr(10) || '</title>' || replace({_pick_sql(META_FORMS, 'item_id')}, '{{d}}', left(coalesce(description, ''), 150)) || CASE WHEN {_G} <> '' THEN '<meta name=\"generator\" content=\"' || {_G} || '\">' ELSE '' END || '</head><body>' || {_pick_sql(_COLS['mark'], 'item_id')} || CASE WHEN item_id % 3 = 0 THEN '' ELSE {_q(LINKS)} END"
    " || '<dl><dt>Tipo:</dt><dd>' || coalesce(property_type, '') || '</dd> <dt>Tipo</dt><dd>outro</dd><dt>Anúncio</dt><dd><b>' || item_id || '</b></dd></dl><script>var loadData = {\"id\": ' || item_id || ', \"lote\": {\"tipo\": \"' || coalesce(property_type, '') || '\", \"nota\": \"}{\"}}; x = {};</script><script type=\"application/ld+json\">{\"@type\": \"' || CASE WHEN item_id % 2 = 0 THEN 'Product' ELSE 'BreadcrumbList' END || '\", \"name\": \"n' || item_id || '\"}</script><p>R$ 1.000,00 ' || coalesce(description, '') || '</p></body></html>'"
)
_PAGES = f"(SELECT item_id, host, 'https://' || host || '/item/' || item_id AS url, signals, server, static, static || array_to_string(list_transform(range(0, item_id % 7 + 1), lambda i: '<a href=\"/lote/' || i || '\">Lote</a>'), '') AS html FROM (SELECT item_id, {_pick_sql(_COLS['host'], 'item_id')} AS host, {_pick_sql(_COLS['signals'], 'item_id')} AS signals, {_pick_sql(_COLS['server'], 'item_id')} AS server, {_STATIC} AS static FROM pilot_item))"


# ---- head, links, lists ------------------------------------------------------------------------------------------


def _group_sql(c: str, rx: str, i: int = 1) -> str:
    return f"NULLIF(regexp_extract({c}, {_q(rx)}, {i}), '')"


_LINE = "trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


@query(f"SELECT item_id, left(coalesce({_LINE.format(c=_group_sql('html', S.TITLE))}, ''), 200) AS title, left(coalesce(trim({_group_sql('html', S.GENERATOR)}), ''), 120) AS generator FROM {_PAGES}")
def prj20_title_and_generator(spark, d):
    return _pages(spark, d).select("item_id", S.title_and_generator(F.col("html")).alias("x")).select("item_id", "x.*")


@query(f"SELECT item_id, coalesce({_LINE.format(c=_group_sql('html', S.TITLE))}, '') AS title, coalesce(trim({_group_sql('html', S.META.format(n='description'))}), '') AS description, coalesce(trim({_group_sql('html', S.META.format(n='keywords'))}), '') AS keywords FROM {_PAGES}")
def prj19_head_fields(spark, d):
    return _pages(spark, d).select("item_id", S.head_fields(F.col("html")).alias("x")).select("item_id", "x.*")


@query()
def prj19_body_excerpt(spark, d):
    """The first 4,000 letters of the visible text, as the reference shows them."""
    return readers.html_text(_pages(spark, d).select("item_id", "html"), "html").select("item_id", F.left("text", F.lit(4000)).alias("excerpt"))


@query("SELECT item_id, 'Anúncio=' || item_id || '|Tipo=' || coalesce(property_type, '') AS pairs FROM pilot_item")
def prj36_labelled_pairs(spark, d):
    pairs = F.array_sort(F.transform(F.map_entries(S.labelled_pairs(F.col("html"))), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return _pages(spark, d).select("item_id", F.array_join(pairs, "|").alias("pairs"))


@query(f"SELECT item_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www[.]', '') AS domain FROM {_PAGES}")
def prj22_short_domain(spark, d):
    return _pages(spark, d).select("item_id", P.host(F.col("url")).alias("domain"))


_LINKS_SQL = "(SELECT item_id, trim(h) AS href, trim(regexp_replace(regexp_replace(t, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS txt FROM (SELECT item_id, unnest(regexp_extract_all({c}, {a}, 1)) AS h, unnest(regexp_extract_all({c}, {a}, 2)) AS t FROM {p}) WHERE trim(h) <> '' AND NOT regexp_matches(lower(trim(h)), '{n}'))"
_L = lambda c: _LINKS_SQL.format(c=c, a=_q(S.ANCHOR), p=_PAGES, n=S.NO_LINK)
_USEFUL = "|".join(R.USEFUL_PATHS)


@query(f"SELECT p.item_id, CAST(count(l.href) AS INTEGER) AS total, CAST(count(l.href) FILTER (WHERE regexp_matches(lower(l.href), '{_USEFUL}')) AS INTEGER) AS useful FROM pilot_item p LEFT JOIN {_L('html')} l USING (item_id) GROUP BY 1")
def agg20_link_counts(spark, d):
    return _pages(spark, d).select("item_id", S.link_counts(F.col("html")).alias("x")).select("item_id", "x.*")


def _first_word_sql(c: str, groups, name: str) -> tuple[str, str]:
    whens = [(f"contains({c}, '{w}')", points, f"{name}{sign}{w}") for sign, points, words in groups for w in words]
    return "CASE " + " ".join(f"WHEN {t} THEN {p}" for t, p, _ in whens) + " ELSE 0 END", "CASE " + " ".join(f"WHEN {t} THEN '{r}'" for t, _, r in whens) + " END"


_TS, _TR = _first_word_sql(f"trim({fold_sql('txt')})", R.LINK_TEXTS, "text")
_PS, _PR = _first_word_sql("lower(href)", R.LINK_PATHS, "path")


@query(f"""SELECT item_id, url, CAST(score AS INTEGER) AS score, reasons, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, url) AS place FROM (SELECT item_id, href AS url, max(score) AS score, arg_max(reasons, score) AS reasons FROM (SELECT item_id, href, {_TS} + {_PS} AS score, concat_ws(',', {_TR}, {_PR}) AS reasons FROM {_L('html')}) WHERE score > 0 GROUP BY 1, 2)) WHERE place <= 5""")
def agg20_listing_candidates(spark, d):
    told = _pages(spark, d).select("item_id", F.explode(S.links(F.col("html"))).alias("l")).select("item_id", F.col("l.href").alias("url"), S.link_score(F.col("l.text"), F.col("l.href")).alias("x"))
    best = told.where("x.score > 0").groupBy("item_id", "url").agg(F.max("x.score").alias("score"), F.max_by(F.array_join("x.reasons", ","), "x.score").alias("reasons"))
    return Rel.top_k(best, ["item_id"], [F.col("score").desc(), F.col("url").asc()], 5, "place")


_CNT = lambda c, n: f"(SELECT p.item_id, count(l.href) FILTER (WHERE regexp_matches(lower(l.href), '{_USEFUL}')) AS {n} FROM pilot_item p LEFT JOIN {_L(c)} l USING (item_id) GROUP BY 1)"


@query(f"""SELECT item_id, CASE WHEN y = 0 AND x = 0 THEN 'unknown' WHEN y <= x THEN 'static' WHEN y >= 1.5 * greatest(x, 1) AND y - x >= 3 THEN 'dynamic' WHEN y >= 1.1 * greatest(x, 1) OR y - x >= 2 THEN 'hybrid' ELSE 'static' END AS rendering, y > 0 AND (x = 0 OR (y >= 5 AND x * 10 < y * 3)) AS needs_scripts FROM {_CNT('static', 'x')} JOIN {_CNT('html', 'y')} USING (item_id)""")
def agg21_rendering(spark, d):
    p = _pages(spark, d).select("item_id", S.link_counts(F.col("static"))["useful"].alias("x"), S.link_counts(F.col("html"))["useful"].alias("y"))
    return p.select("item_id", S.rendering(F.col("x"), F.col("y")).alias("rendering"), S.needs_scripts(F.col("x"), F.col("y")).alias("needs_scripts"))


# ---- platforms ---------------------------------------------------------------------------------------------------


def _test_sql(field: str, how: str, needle: str) -> str:
    n = _q(needle)
    return {"has": f"contains({field}, {n})", "ends": f"ends_with({field}, {n})", "starts": f"starts_with({field}, {n})", "is": f"{field} = {n}", "like": f"regexp_matches({field}, {n})", "under": f"length({field}) < {needle}"}[how]


_PROVIDER = [(p, c, {V.HOST_SIGNAL: "'host=' || host", V.STACK_SIGNAL: "'stack=' || stack"}.get(s, _q(s)), " OR ".join("(" + " AND ".join(_test_sql(*t) for t in a) + ")" for a in alt)) for p, c, s, alt in V.PROVIDERS]
_WHEN = lambda i: "CASE " + " ".join(f"WHEN {r[3]} THEN {_q(r[i]) if i < 2 else r[2]}" for r in _PROVIDER) + f" ELSE {_q(V.NO_RULE[i])} END"
_STACK = "CASE WHEN contains(lower(html), 'jquery') THEN 'jquery' ELSE '' END"


@query(f"SELECT item_id, {_WHEN(0)} AS provider, {_WHEN(1)} AS confidence, {_WHEN(2)} AS signal FROM (SELECT item_id, lower(html) AS html, host, signals, {_STACK} AS stack, lower(coalesce({_group_sql('html', S.GENERATOR)}, '')) AS generator FROM {_PAGES})")
def txt1_provider(spark, d):
    stack = F.when(F.lower("html").contains("jquery"), "jquery").otherwise("")
    p = _pages(spark, d)
    return p.select("item_id", V.detect_provider(F.col("html"), F.col("host"), F.col("signals"), stack, P.group(F.col("html"), S.GENERATOR, 1)).alias("x")).select("item_id", "x.*")


_TECH = [(f"CASE WHEN {' OR '.join(f'contains(html, {_q(n)})' for n in needles)}" + (f" OR contains(url, {_q(needles[0])})" if label == "leilao.br platform" else ""), label, signal) for label, signal, needles in V.TECHNOLOGIES]
_NAMED = "CASE " + " ".join(f"WHEN contains(lower(gen), '{n}') THEN '{label}'" for label, n in V.GENERATORS) + " END"
_TECHS = f"[{_NAMED}, " + ", ".join(f"{c} THEN {_q(label)} END" for c, label, _ in _TECH) + "]"
_SIGNS = f"[CASE WHEN gen <> '' THEN 'generator=' || left(gen, 60) END, CASE WHEN {_NAMED} IS NOT NULL THEN 'generator=' || left(gen, 40) END, " + ", ".join(f"{c} THEN {_q(s)} END" for c, _, s in _TECH) + f", CASE WHEN {' OR '.join(f'contains(html, {_q(n)})' for n in V.MENTION[1])} THEN {_q(V.MENTION[0])} END, " + ", ".join(f"CASE WHEN contains(lower(server), '{s}') THEN 'server:{s}' END" for s in V.SERVERS) + "]"


@query(f"""WITH t AS (SELECT item_id, list_filter({_TECHS}, lambda x: x IS NOT NULL) AS a, list_filter({_SIGNS}, lambda x: x IS NOT NULL)[1:12] AS s FROM (SELECT item_id, lower(html) AS html, lower(url) AS url, server, coalesce({_group_sql('html', S.GENERATOR)}, '') AS gen FROM {_PAGES}))
 SELECT item_id, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') AS technologies, array_to_string(s, ',') AS signals FROM t""")
def txt2_technologies(spark, d):
    p = _pages(spark, d)
    techs, signals = V.detect_technologies(F.col("html"), P.group(F.col("html"), S.GENERATOR, 1), F.col("url"), F.col("server"))
    return p.select("item_id", F.array_join(techs, ",").alias("technologies"), F.array_join(signals, ",").alias("signals"))


# ---- embedded data, caches, registries ---------------------------------------------------------------------------


@query("SELECT item_id, item_id AS id, coalesce(property_type, '') AS kind FROM pilot_item")
def src14_balanced_json(spark, d):
    got = G.embedded_json(_pages(spark, d).select("item_id", "html"), "html", "var loadData =", "j").select("item_id", F.from_json("j", "id bigint, lote struct<tipo: string, nota: string>").alias("x"))
    return got.select("item_id", "x.id", F.col("x.lote.tipo").alias("kind"))


@query("SELECT item_id, 'n' || item_id AS name FROM pilot_item WHERE item_id % 2 = 0")
def src14_linked_data(spark, d):
    return G.linked_data(_pages(spark, d).select("item_id", "html"), "html", "Product", "name string").select("item_id", "x.name")


_CACHED = "CASE WHEN item_id % 3 = 0 THEN 'dynamic' WHEN item_id % 3 = 1 THEN 'static' END"


@query(f"SELECT DISTINCT url, {_CACHED} AS kind, sha256(CASE WHEN item_id % 3 = 0 THEN html WHEN item_id % 3 = 1 THEN static END) AS hash FROM {_PAGES}")
def src5_cached_html(spark, d):
    p = _pages(spark, d)
    key = F.sha1("url").alias("key")
    static = p.where(F.col("item_id") % 3 != 2).select(key, F.lit("static").alias("kind"), F.when(F.col("item_id") % 3 == 1, F.col("static")).alias("html"))
    cache = static.unionByName(p.where(F.col("item_id") % 3 == 0).select(key, F.lit("dynamic").alias("kind"), "html"))
    return G.cached_html(p.select("url").distinct(), cache, "static").select("url", "kind", F.sha2("html", 256).alias("hash"))


_NAME = "trim(regexp_replace(regexp_replace(upper(strip_accents(nome)), '[^A-Z ]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _registry_rows(spark, d):
    name = F.trim(F.regexp_replace(F.regexp_replace(F.upper(fold(F.col("nome"))), "[^A-Z ]", " "), r"\s+", " "))
    return table(spark, d, "auctioneers_unified").where(F.col("nome").isNotNull()).select("record_id", name.alias("name"), F.concat(F.lit("M"), F.col("record_id").cast("string")).alias("m")).distinct()


_TWO_WORDS = f"nome IS NOT NULL AND contains({_NAME}, ' ')"


@query(f"SELECT DISTINCT record_id, {_NAME} AS name, 'M' || record_id AS registration FROM auctioneers_unified WHERE {_TWO_WORDS}")
def src9_names_before(spark, d):
    text = F.concat(F.lit("A a Z\nMatrícula: 0\n"), F.col("name"), F.lit(" (SUPLEMENTAR)\n\nMatrícula: "), F.col("m"), F.lit("\nUma\nMatrícula - 9"))
    return G.names_before(_registry_rows(spark, d).withColumn("t", text), "record_id", "t")


@query(f"SELECT DISTINCT record_id, {_NAME} AS name, 'M' || record_id AS registration FROM auctioneers_unified WHERE {_TWO_WORDS} OR (nome IS NOT NULL AND record_id % 3 = 2 AND {_NAME} <> '')")
def src15_names_after(spark, d):
    k, m, n = F.col("record_id") % 3, F.col("m"), F.col("name")
    text = F.when(k == 2, F.concat(F.lit("Matrícula: "), m, F.lit("\nTelefone\nRua\nNome: "), n)).otherwise(F.concat(F.lit("Contato\nMatrícula - "), m, F.when(k == 0, "\n01/02/2020").otherwise(""), F.lit("\n"), n, F.lit("\nContato")))
    return G.names_after(_registry_rows(spark, d).withColumn("t", text), "record_id", "t")


@query(f"SELECT DISTINCT record_id, {_NAME} AS name, 'M' || record_id || '/90' AS registration, CASE WHEN record_id % 2 = 0 THEN 'cancelada' ELSE 'regular' END AS status FROM auctioneers_unified WHERE {_TWO_WORDS}")
def src16_names_in_blocks(spark, d):
    one = F.concat(F.col("name"), F.lit(" (Matrícula: "), F.col("m"), F.lit("/90 de 29/08/1990)"), F.when(F.col("record_id") % 2 == 0, "\nSituação: CANCELADA").otherwise(""))
    return G.names_in_blocks(_registry_rows(spark, d).withColumn("t", F.concat(one, F.lit("\n; "), one)), "record_id", "t")


@query("SELECT 'boards' AS registry, 'success' AS outcome, count(*) AS \"rows\" FROM auctioneers_unified WHERE source_kind = 'junta_only' UNION ALL SELECT 'sites', 'success', count(*) FROM ref_source UNION ALL SELECT 'planned', 'stub', 0 UNION ALL SELECT 'broken', 'failure', 0")
def src8_registry_outcomes(spark, d):
    def planned(_):
        raise NotImplementedError

    return G.union_registries(spark, {
        "boards": lambda s: table(s, d, "auctioneers_unified").where("source_kind = 'junta_only'").select(F.col("nome").alias("name"), "uf"),
        "sites": lambda s: table(s, d, "ref_source").select(F.col("short_name").alias("name"), "base_url"), "planned": planned, "broken": lambda s: table(s, d, "auctioneers_unified").select("no_such_column"),
    })[1]


@query("SELECT count(*) AS total, count(*) AS collected, true AS complete FROM probe2_imoveis_with_bid", texts="complete")
def src6_page_totals(spark, d):
    t = table(spark, d, "probe2_imoveis_with_bid").select("id", "lot_title")
    pages = t.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(F.collect_list(F.struct("id", "lot_title")).alias("data")).crossJoin(F.broadcast(t.agg(F.count("*").alias("total"))))
    got = spark.read.schema("page bigint, total bigint, data array<struct<id: bigint, lot_title: string>>").json(readers.round_trip(pages, "json"))
    return G.collected_pages(got, "data", "total")


@query("SELECT item_id, address.uf AS state, address.municipality_name AS city, CAST(len(rounds) AS INTEGER) AS prices FROM pilot_item")
def src13_nested_listing(spark, d):
    t = table(spark, d, "pilot_item").select("item_id", F.struct(F.col("address.uf").alias("state"), F.col("address.municipality_name").alias("city")).alias("address"), F.transform("rounds", lambda r: r["minimum_bid_brl"]).alias("price"), F.size("rounds").alias("n"))
    got = readers.read_xml(spark, readers.round_trip_xml(t, "listing"), "listing", "item_id bigint, address struct<state: string, city: string>, price array<string>, n int")
    return got.select("item_id", "address.state", "address.city", F.when(F.col("n") >= 0, F.col("n")).alias("prices"))


# ---- texts of sales ----------------------------------------------------------------------------------------------

_DOC = "Edital Complementar|Edital de leilão|Matrícula 12|Laudo|Certidão de IPTU|Certidão do condomínio|Certidão de ônus|Certidão|Auto de arrematação|Ficha|Planta baixa|Foto".split("|")
_DOC_CASE = "CASE " + " ".join(f"WHEN {' AND '.join(f'contains(f, {_q(n)})' for n in needles)} THEN '{kind}'" for needles, kind in R.DOCUMENT_KINDS) + " ELSE 'outro' END"


@query(f"SELECT item_id, {_DOC_CASE} AS kind FROM (SELECT item_id, {fold_sql(_pick_sql(_DOC, 'item_id'))} AS f FROM pilot_item)")
def prj17_document_kind(spark, d):
    return table(spark, d, "pilot_item").select("item_id", S.document_kind(_pick(_DOC, F.col("item_id"))).alias("kind"))


@query("SELECT item_id, CASE item_id % 3 WHEN 0 THEN source_lot_url || '/e.pdf' WHEN 1 THEN source_lot_url || '/edital-1.PDF' END AS url FROM pilot_item")
def txt6_edital_url(spark, d):
    k, u = F.col("item_id") % 3, F.col("source_lot_url")
    doc = lambda n, x: F.struct(F.lit(n).alias("name"), F.concat(u, F.lit(x)).alias("url"))
    docs = F.when(k == 0, F.array(doc("Edital complementar", "/c.pdf"), doc("Edital", "/e.pdf"))).when(k == 1, F.array(doc("Anexo", "/a.pdf"), doc("Anexo", "/edital-1.PDF"))).otherwise(F.array(doc("Matrícula", "/m.pdf")))
    return table(spark, d, "pilot_item").select("item_id", S.edital_url(docs).alias("url"))


_PAY = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(f, {_q(rx)}) THEN '{k}'" + (f" || ':' || coalesce(CAST(try_cast(regexp_extract(f, {_q(R.INSTALLMENTS)}, 1) AS INTEGER) AS VARCHAR), '') || ':' || coalesce(CAST(try_cast(regexp_extract(f, {_q(R.DOWN_PAYMENT)}, 1) AS INTEGER) AS VARCHAR), '')" if k == "parcelado" else "") + " END" for k, rx in R.PAYMENTS) + "], lambda x: x IS NOT NULL)"
_STATUS = f"CASE WHEN regexp_matches(f, {_q(R.PASSED_ON)}) THEN 'sub_rogado_no_lance' WHEN regexp_matches(f, {_q(R.BUYER_PAYS)}) THEN 'quitado_pelo_arrematante' ELSE 'declarado' END"
_ENC_OF = dict(R.ENCUMBRANCES)
_ENC = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(f, {_q(rx)}) THEN '{k}:' || {_STATUS} END" for k, rx in R.ENCUMBRANCES) + ", " + ", ".join(f"CASE WHEN regexp_matches(f, {_q(R.TAXES_PASS_ON)}) AND NOT regexp_matches(f, {_q(_ENC_OF[k])}) THEN '{k}:sub_rogado_no_lance' END" for k in ("iptu_em_aberto", "condominio_em_aberto")) + "], lambda x: x IS NOT NULL)"
_LAW = " Nos termos do art. 130 do CTN os créditos se sub-rogam."


_TEXT_AND_LAW = f"coalesce(text, '') || CASE WHEN doc_id % 5 = 0 THEN {_q(_LAW)} ELSE '' END"


@query(f"SELECT doc_id, array_to_string({_PAY}, ',') AS payments, array_to_string({_ENC}, ',') AS encumbrances FROM (SELECT doc_id, {fold_sql(_TEXT_AND_LAW)} AS f FROM documents)")
def txt3_clauses(spark, d):
    t = table(spark, d, "documents")
    text = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 5 == 0, _LAW).otherwise(""))
    n = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    pay = F.transform(S.payments(text), lambda x: F.when(x["kind"] == "parcelado", F.concat(x["kind"], F.lit(":"), n(x["installments"]), F.lit(":"), n(x["down_payment_pct"]))).otherwise(x["kind"]))
    enc = F.transform(S.encumbrances(text), lambda x: F.concat(x["kind"], F.lit(":"), x["status"]))
    return t.select("doc_id", F.array_join(pay, ",").alias("payments"), F.array_join(enc, ",").alias("encumbrances"))


@query("""WITH a AS (SELECT item_id, unnest([{'k': 'iptu', 's': CASE WHEN item_id % 2 = 0 THEN 'declarado' ELSE 'quitado' END}, {'k': 'penhora', 's': 'declarado'}, {'k': CASE WHEN item_id % 3 = 0 THEN 'iptu' ELSE 'usufruto' END, 's': 'sub_rogado'}, {'k': 'penhora', 's': 'declarado'}]) AS x, generate_subscripts([1, 2, 3, 4], 1) AS i FROM pilot_item),
 g AS (SELECT item_id, x.k AS k, min(i) AS i, coalesce(CASE WHEN arg_min(x.s, i) <> 'declarado' THEN arg_min(x.s, i) END, arg_min(x.s, i) FILTER (WHERE x.s <> 'declarado'), 'declarado') AS s FROM a GROUP BY 1, 2)
 SELECT item_id, string_agg(k || ':' || s, ',' ORDER BY i) AS clauses FROM g GROUP BY 1""")
def txt4_merged_clauses(spark, d):
    k = F.col("item_id")
    c = lambda a, b: F.struct(a.alias("kind"), b.alias("status"))
    page = F.array(c(F.lit("iptu"), F.when(k % 2 == 0, "declarado").otherwise("quitado")), c(F.lit("penhora"), F.lit("declarado")))
    doc = F.array(c(F.when(k % 3 == 0, "iptu").otherwise("usufruto"), F.lit("sub_rogado")), c(F.lit("penhora"), F.lit("declarado")))
    merged = F.transform(S.merge_clauses(page, doc), lambda x: F.concat(x["kind"], F.lit(":"), x["status"]))
    return table(spark, d, "pilot_item").select("item_id", F.array_join(merged, ",").alias("clauses"))


DATE_TEXTS = ["15/03/2025", "em 15/03/2025 às 14h00", "01/12/2024 14h", "01/12/24 09:30", "15 de março de 2025", "3 de jan de 2026, 8h05", "10/04/2026 às 11h30min", "", "data inválida", "32/13/2025", "00/00/0000", "29/02/2023 10h", "sexta, 7/6/2025 | 22:15:00"]
DATES = ["2025-03-15T00:00", "2025-03-15T14:00", "2024-12-01T14:00", "2024-12-01T09:30", "2025-03-15T00:00", "2026-01-03T08:05", "2026-04-10T11:30", "", "", "", "", "", "2025-06-07T22:15"]


@query(f"SELECT item_id, CASE WHEN x <> '' THEN x || ':00-03:00' END AS at FROM (SELECT item_id, {_pick_sql(DATES, 'item_id')} AS x FROM pilot_item)")
def prj8_date_and_clock(spark, d):
    return table(spark, d, "pilot_item").select("item_id", S.br_datetime(_pick(DATE_TEXTS, F.col("item_id"))).alias("at"))


_DAY = "lpad(CAST(1 + item_id % 28 AS VARCHAR), 2, '0')"


@query(f"SELECT item_id, {_DAY} || '/05/2026 10:00' AS first, CASE WHEN item_id % 2 = 0 THEN '30/05/2026 ' || CASE WHEN item_id % 4 = 0 THEN '09:15' ELSE '00:00' END END AS second FROM pilot_item")
def prj10_two_round_dates(spark, d):
    k = F.col("item_id")
    day = F.lpad((1 + k % 28).cast("string"), 2, "0")
    text = F.concat(F.lit("1º Leilão: "), day, F.lit("/05/2026 (quarta-feira) Pregão do primeiro lote a partir das: 10:00. 1º Leilão: 01/01/2020"), F.when(k % 2 == 0, F.concat(F.lit(" 2° Leilao: 30/05/2026"), F.when(k % 4 == 0, " às 09:15").otherwise(" sem hora"))).otherwise(""))
    return table(spark, d, "pilot_item").select("item_id", S.two_round_dates(text).alias("x")).select("item_id", "x.*")


_SITE_TEXTS = {"name": "auctioneer_slug", "title": "title", "desc": "description", "keywords": "property_type", "body": "description"}


def _hits_sql(c: str, words: list[str], tag: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN contains({fold_sql(f'coalesce({c}, {chr(39) * 2})')}, '{w}') THEN '{tag}{w}' END" for w in words) + "], lambda x: x IS NOT NULL)"


_HITS = [(_hits_sql(c, words, n + sign), w) for n, c in _SITE_TEXTS.items() for words, sign, w in ((R.STRONG_WORDS, "+", R.FIELD_WEIGHTS[n][0]), (R.MEDIUM_WORDS, "~", R.FIELD_WEIGHTS[n][1]))]
_SCORE = " + ".join(f"least(len({h}), 3) * {w}" for h, w in _HITS)


@query(f"SELECT item_id, score, signals, CASE WHEN contains(signals, '+') AND score >= {R.HIGH_SCORE} THEN 'high' WHEN score >= {R.MEDIUM_SCORE} THEN 'medium' ELSE 'unknown' END AS confidence FROM (SELECT item_id, CAST(round(CAST({_SCORE} AS DOUBLE), 2) AS DOUBLE) AS score, array_to_string(flatten([{', '.join(f'({h})[1:3]' for h, _ in _HITS)}]), '|') AS signals FROM pilot_item)")
def agg19_site_score(spark, d):
    x = S.site_score({n: F.col(c) for n, c in _SITE_TEXTS.items()})
    return table(spark, d, "pilot_item").select("item_id", x.alias("x")).select("item_id", "x.score", F.array_join("x.signals", "|").alias("signals"), "x.confidence")


VEHICLES = ["", "Veículo Gol, placa: ABC", "Caminhão e imóvel", "Lote de cadeiras", "Sobrado", "leilão: 10/05/2026 às 10h, trator", "Fração de fazenda", "Matrícula nº 12"]


_VEHICLE_OR_TITLE = f"CASE WHEN id % 2 = 0 THEN {_pick_sql(VEHICLES, '(id // 2)')} ELSE lot_title END"


@query(f"SELECT id, CASE WHEN regexp_matches(f, {_q(R.PROPERTY_SIGNS)}) THEN true WHEN regexp_matches(f, {_q(R.VEHICLE_SIGNS)}) THEN false END AS keep FROM (SELECT id, {fold_sql(_VEHICLE_OR_TITLE)} AS f FROM probe2_imoveis_with_bid)", texts="keep")
def flt6_listing_filter(spark, d):
    text = F.when(F.col("id") % 2 == 0, _pick(VEHICLES, F.floor(F.col("id") / 2))).otherwise(F.col("lot_title"))
    return table(spark, d, "probe2_imoveis_with_bid").select("id", S.listing_is_property(text).alias("keep"))


_PAGE_TEXT = f"concat_ws(' ', {_pick_sql(VEHICLES, 'id')}, CASE WHEN id % 3 = 0 THEN coalesce(lot_description, '') ELSE '' END)"


@query(f"SELECT id FROM probe2_imoveis_with_bid WHERE regexp_matches(regexp_replace({fold_sql(_PAGE_TEXT)}, {_q(R.DATE_PREFIX)}, ' ', 'g'), {_q(R.PROPERTY_STRICT)})")
def flt7_page_filter(spark, d):
    return table(spark, d, "probe2_imoveis_with_bid").where(S.page_is_property(_pick(VEHICLES, F.col("id")), F.when(F.col("id") % 3 == 0, F.col("lot_description")).otherwise(""))).select("id")


URLS = ["/lote/1", "/Login", "/lotes/12?p=2", "/lotes/casa", "/portal/", "/cadastro", "/texto.aspx?i=1", "/imovel/3"]


@query(f"SELECT id, coalesce(regexp_matches({fold_sql('lot_title')}, {_q(R.PROPERTY_LOOSE)}), false) AS property, NOT regexp_matches(lower('https://a.example' || {_pick_sql(URLS, 'id')}), {_q(R.NOT_A_LOT)}) AS lot FROM probe2_imoveis_with_bid", texts="property lot")
def flt8_loose_filters(spark, d):
    url = F.concat(F.lit("https://a.example"), _pick(URLS, F.col("id")))
    return table(spark, d, "probe2_imoveis_with_bid").select("id", S.title_is_property(F.col("lot_title")).alias("property"), S.is_lot_url(url).alias("lot"))


@query(f"SELECT item_id, coalesce({rules_sql('property_type', R.PROPERTY_RULES)}, {rules_sql('title', R.PROPERTY_RULES)}, {rules_sql('description', R.PROPERTY_RULES)}) AS kind FROM pilot_item")
def prj12_first_of_three(spark, d):
    return table(spark, d, "pilot_item").select("item_id", S.property_kind(F.col("property_type"), F.col("title"), F.col("description")).alias("kind"))


@query("SELECT id, 'https://a.example/' || id || '.pdf?x=1|https://b.example/e.PDF|' || source_url AS urls FROM auction_lot WHERE source_url IS NOT NULL")
def prj32_urls_and_documents(spark, d):
    k = F.col("id").cast("string")
    text = F.concat(F.lit("<img src='https://c.example/logo.png'> https://a.example/"), k, F.lit(".pdf?x=1 e https://b.example/e.PDF https://d.example/styles/x.css "), F.col("source_url"), F.lit(" https://a.example/"), k, F.lit(".pdf?x=1"))
    return table(spark, d, "auction_lot").where(F.col("source_url").isNotNull()).select("id", F.array_join(P.collect_urls(text), "|").alias("urls"))


_SLUGS = ["-sp/casa", "-rj-centro-mg", "-lote", "/ap-go/", "-xx-ba/1"]


@query(f"SELECT id, (['SP', 'MG', NULL, 'GO', 'BA'])[1 + id % 5] AS uf FROM fetch_event GROUP BY id")
def prj27_uf_of_slug(spark, d):
    url = F.concat(F.lit("https://x-ce.example/imovel"), _pick(_SLUGS, F.col("id")))
    return table(spark, d, "fetch_event").select("id").distinct().select("id", P.uf_from_slug(url).alias("uf"))
