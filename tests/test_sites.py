"""Golden rows of pages, places, registries and checks that the shared tables don't reach."""

import pytest
from pyspark.sql import functions as F

from pregonero.functions import parsers as P
from pregonero.functions import places as L
from pregonero.functions import sites as S
from pregonero.functions.text import normalise_uf
from pregonero.operators import checks as C
from pregonero.operators import relational as R
from pregonero.rules import providers as V
from pregonero.sources import registries as G


def column(spark, texts, f):
    return [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(f(F.col("t"))).collect()]


def test_kinds_of_property(spark):
    kinds = {
        "apartamento": ["Apartamento 2 dormitórios", "Cobertura duplex", "KITNET no centro", "Apartamento na casa nova"], "casa": ["Casa em condomínio", "Sobrado em vila", "Casa em terreno de 200m²"], "terreno": ["Terreno com 500m²", "Lote 12"],
        "comercial": ["Galpão industrial", "Sala comercial centro", "Loja em shopping", "Galpão industrial em Casamentópolis"], "rural": ["Sítio em Atibaia", "Fazenda 100ha"], None: ["oportunidade incrível", "", None],
    }
    for kind, texts in kinds.items():
        assert column(spark, texts, S.property_kind) == [kind] * len(texts)


def test_dates(spark):
    cases = {
        "15/03/2025": "2025-03-15T00:00:00-03:00", "15/03/2025 às 14h00": "2025-03-15T14:00:00-03:00", "01/12/2024 14h": "2024-12-01T14:00:00-03:00", "01/12/2024 09:30": "2024-12-01T09:30:00-03:00", "15 de março de 2025": "2025-03-15T00:00:00-03:00",
        "3 de jan de 2026": "2026-01-03T00:00:00-03:00", "10/04/2026 às 11h30": "2026-04-10T11:30:00-03:00", "": None, "data inválida": None, "32/13/2025": None, "00/00/0000": None, "5 de foo de 2025": None,
    }
    assert column(spark, [*cases, None], S.br_datetime) == [*cases.values(), None]


def test_states(spark):
    texts = ["São Paulo", "sao paulo", "SP", "sp", "Distrito Federal", "RIO DE JANEIRO", "Mato Grosso do Sul", "Espírito Santo", "Goiás", None, "", "XX", "Lisboa", "ZZ"]
    assert column(spark, texts, normalise_uf) == ["SP"] * 4 + ["DF", "RJ", "MS", "ES", "GO"] + [None] * 5
    assert column(spark, ["29010-000", "69900-000", "00000-000", "123", None], L.state_of_cep) == ["ES", "AM", None, None, None]
    assert column(spark, ["em Mato Grosso do Sul", "Mato Grosso", "Paraná", "para o Pará", "nada"], L.state_named) == ["MS", "MT", "PR", "PA", None]
    assert column(spark, ["Casa em Um/SP e outra em Belém - PA.", "Rua A, Centro, GO, CEP 1", "imovel-sp-em-x--rj--y", "ESTADO: BA x", "nada", None], L.state_of_text) == ["PA", "GO", "RJ", "BA", None, None]


def test_kinds_of_units_and_creditors(spark):
    texts = ["Vaga de garagem", "Casa de fazenda", "Sobrado", "10 ha de terreno", "um imóvel", None, " ", "Terreno de 3 hectares", "casa grande", "Loja de lojista", "x" * 50_000]
    assert column(spark, texts, L.unit_kind) == ["vaga_garagem", "fazenda", "sobrado", "terreno_urbano", "outro", "desconhecida", "desconhecida", "terreno_rural", "desconhecida", "desconhecida", "desconhecida"]
    assert column(spark, ["Credor: Banco Bradesco e CEF", None, "BB S.A e Banco Itaú"], L.creditors) == [["Caixa Econômica Federal", "Banco Bradesco"], [], ["Banco do Brasil", "Banco Itaú"]]


def test_addresses(spark):
    got = column(spark, ["Endereço: Rua X, 14 - Centro Cidade: Alto Jequitibá / MG - CEP: 36976-000", "Endereço: Cidade: X / sp", "Rua sem cidade", None, ""], L.labelled_address)
    assert [tuple(r) for r in got] == [("Rua X", "14", "Centro", "Alto Jequitibá", "MG", "36976000"), (None, None, None, "X", "SP", None), ("Rua sem cidade",) + (None,) * 5, (None,) * 6, (None,) * 6]
    assert [tuple(r) for r in column(spark, ["Florianópolis/SC", "às 14:00 - SP", "Lote X/SP"], L.city_and_state)] == [("Florianopolis", "SC"), (None, None), (None, None)]
    assert [tuple(r) for r in column(spark, ["25/JUCEPI", "JUCESC AARC N370", "AARC 0028/1.999", "JUCEXX 12"], L.board_registration)] == [("PI", "25"), ("SC", "N370"), (None, "AARC 0028/"), (None, "JUCEXX 12")]


def test_links_and_rendering(spark):
    rows = [("Imóveis", "/imoveis-disponiveis", 16), ("Lotes em destaque", "/destaques", 5), ("Veja", "/lotes?categoria=imovel", 3), ("Sobre", "/sobre-nos", 0)]
    got = spark.createDataFrame(rows, "t string, h string, want int").select(S.link_score(F.col("t"), F.col("h"))["score"].alias("s"), "want").collect()
    assert all(r.s == r.want for r in got)
    assert tuple(column(spark, ["<a href='/lote/1'>a</a><a href='mailto:x'>b</a><a HREF=\"/x\">c</a>"], S.link_counts)[0]) == (2, 1) and tuple(column(spark, [""], S.link_counts)[0]) == (0, 0)
    pairs = {(10, 10): "static", (20, 15): "static", (2, 10): "dynamic", (0, 12): "dynamic", (10, 12): "hybrid", (0, 0): "unknown"}
    df = spark.createDataFrame([(a, b) for a, b in pairs], "a int, b int")
    assert [r[0] for r in df.select(S.rendering(F.col("a"), F.col("b"))).collect()] == list(pairs.values())
    js = spark.createDataFrame([(0, 5), (1, 20), (10, 12), (5, 0)], "a int, b int").select(S.needs_scripts(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in js] == [True, True, False, False]


def test_site_score(spark):
    rows = [("Fulano", "Leilão de imóveis", "Casas e apartamentos", "imóvel", "terreno"), ("Fulano", "Leilões de veículos", None, None, None), (None, None, None, None, "imovel " * 100), (None,) * 5]
    got = [r[0] for r in spark.createDataFrame(rows, "name string, title string, desc string, keywords string, body string").select(S.site_score({c: F.col(c) for c in ("name", "title", "desc", "keywords", "body")})).collect()]
    assert [r.confidence for r in got] == ["high", "medium", "unknown", "unknown"] and got[2].score <= 3.5 and got[3].score == 0


def test_platforms(spark):
    df = spark.createDataFrame([("", "a.example"), ("<p>ApiEngine/GetBusca</p>", "a.example"), ("x", "www.portalzuk.com.br"), (None, None)], "html string, host string")
    none = F.lit(None).cast("string")
    assert [r[0].provider for r in df.select(V.detect_provider(F.col("html"), F.col("host"), none, none, none)).collect()] == ["cache_missing", "desconhecido", "portal_zuk", "cache_missing"]


def test_clauses(spark):
    text = "Débitos de IPTU a cargo do arrematante. Aceita parcelamento em até 30 parcelas com 25% de entrada. FGTS."
    pay, enc = column(spark, [text], S.payments)[0], column(spark, [text], S.encumbrances)[0]
    assert [(p.kind, p.installments, p.down_payment_pct) for p in pay] == [("fgts", None, None), ("parcelado", 30, 25)] and [(e.kind, e.status) for e in enc] == [("iptu_em_aberto", "quitado_pelo_arrematante")]
    law = column(spark, ["Nos termos do art. 130 do CTN.", None, ""], S.encumbrances)
    assert [(e.kind, e.status) for e in law[0]] == [("iptu_em_aberto", "sub_rogado_no_lance"), ("condominio_em_aberto", "sub_rogado_no_lance")] and law[1] == law[2] == []


def test_registries_and_json(spark, tmp_path):
    df = spark.createDataFrame([(1, "Leiloeiros\nANA DE SOUZA (SUPLEMENTAR)\nMatrícula: 12\nUma\nMatrícula: 9"), (2, None)], "id int, t string")
    assert [tuple(r) for r in G.names_before(df, "id", "t").collect()] == [(1, "ANA DE SOUZA", "12")]
    assert G.balanced_object('x = {"a": "}{\\"", "b": {}}; y', "x =") == '{"a": "}{\\"", "b": {}}' and G.balanced_object("x = {", "x =") is None and G.balanced_object(None, "x") is None
    (tmp_path / "k1.static.html").write_text("<p>\na</p>")
    assert [tuple(r) for r in G.read_html_files(spark, f"{tmp_path}/*.html").collect()] == [("k1", "static", "<p>\na</p>")]


def test_secret_of_the_session(spark):
    spark.conf.unset(P.PEPPER_SETTING)
    with pytest.raises(ValueError):
        P.session_pepper(spark)
    assert column(spark, ["123.456.789-0", None], lambda c: P.hash_cpf(c, "0" * 32)) == [None, None]


def test_hot_key_of_any_key_matches(spark):
    rows = spark.range(4000).select("id", F.lit("same").alias("k1"), F.lit(None).cast("string").alias("k2"))
    got = R.matches_by_any_key(rows, "id", ["k1", "k2"])
    assert got.count() == 20_000 and [r.match for r in got.where("id = 2").orderBy("place").collect()] == [0, 1, 3, 4, 5]


def test_item_schema(spark):
    good = '{"title": "x", "auction_status": "ativo", "scraped_at": "2026-01-01T10:00:00Z"}'
    assert column(spark, [good, "[1]", "", None, '{"title": null, "auction_status": "ativo", "scraped_at": "2026-01-01"}'], C.item_schema_failures) == [[], ["json"], ["json"], ["json"], ["scraped_at", "title"]]
