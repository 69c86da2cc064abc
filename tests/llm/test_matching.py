"""Names, places and addresses: planted variants against what they stand for."""

import random

from pyspark.sql import functions as F

from pregonero.llm import addresses, canonical_list, entities

REF = [("1111111", "Santa Rita do Norte", "SP", "Passo Velho", 10), ("2222222", "Santa Rita", "SP", None, 20), ("3333333", "Campo Verde", "RJ", None, 5), ("4444444", "Campo Verde", "GO", None, 9), ("5555555", "Porto Zimife das Flores", "MG", None, 7), ("6666666", "Vila Aurora do Norte", "BA", None, 7)]


def reference(spark):
    return spark.createDataFrame(REF, "ibge_code string, name string, uf string, alt_name string, population_last int")


def test_free_names(spark):
    cases = [
        ("Sta. Rita do N.", "SP", "1111111"), ("SANTA RITTA", "S.P.", "2222222"), ("passo velho", None, "1111111"), ("Cpo Verde / RJ", None, "3333333"), ("campo verde", "Goiás", "4444444"), ("campo verde", None, "4444444"),
        ("Flores, Porto Zimiffe", "MG", "5555555"), ("Município de Porto Simife das Flores", "RJ", "5555555"), ("Mount Velmonte", None, "none"), ("0", "SP", "none"), ("?" * 20_000, None, "none"),
    ]
    rows = [(i, n, None, u, None) for i, (n, u, _) in enumerate(cases)] + [(90, "Santa Rita", "2222222", "SP", None), (91, " ", None, "SP", None), (92, None, None, None, None), (0, cases[0][0], None, "SP", None)]
    df = spark.createDataFrame(rows, "id long, municipality_name string, municipality_code string, uf string, raw_text string").selectExpr("*", "1 as text", "2 as want", "3 as score", "4 as code")
    got = {r.address_id: r.municipality_code for r in canonical_list.municipalities(df, reference(spark)).select("address_id", "municipality_code").distinct().collect()}
    assert got == {i: c for i, (_, _, c) in enumerate(cases)}
    assert canonical_list.municipalities(df.limit(0), reference(spark)).count() == 0


ADDRESS = "id long, street_type string, street_name string, number string, complement string, district string, municipality_name string, municipality_code string, uf string, cep string, raw_text string"


def test_addresses(spark):
    row = lambda i, t, s, n, c=None, d="Centro", code="2222222", cep=None, raw=None: (i, t, s, n, c, d, "Santa Rita", code, "SP", cep, raw)
    data = [
        row(1, "Rua", "Coronel Marcos Pinzedio Feltumes", "0175", "Apto 32 Bl A", cep="10004-121"), row(2, None, "R. Cel. Marcos P. Feltumes, 175", None, "BL.A APT.32", cep="10004121"),
        row(3, None, None, None, raw="apartamento 32, bloco A, Rua Coronel Marcos Pinzédio Feltummes nº 175 - Centro Santa Rita/SP"), row(4, "Rua", "Coronel Marcos Pinzedio Feltumes", "175", "32B", cep="10004121"),
        row(5, "Travessa", "Coronel Marcos Pinzedio Feltumes", "175", "AP. 32-A", cep="10004999"), row(6, "Rua", "Coronel Marcos Pinzedio Feltumes", "#176", cep="10004121"),
        row(7, "Rua", "Marcos Feltumes", "176"), row(8, None, None, None, raw=None), row(9, "Rua", None, None, raw="x" * 30_000),
    ]
    df = spark.createDataFrame(data, ADDRESS).selectExpr("*", "1 as city", "2 as a_cep", "3 as norm", "4 as location")
    got = addresses.same_location_pairs(addresses.locate(addresses.parse_addresses(addresses.with_city(df, reference(spark)))))
    assert {(r.address_id_a, r.address_id_b) for r in got.collect()} == {(1, 2), (1, 3), (2, 3), (6, 7)}
    assert addresses.locate(addresses.parse_addresses(addresses.with_city(df.limit(0), reference(spark)))).count() == 0


PEOPLE = "record_id long, nome string, matricula string, junta_sigla string, uf string, innlei_email string"


def test_entities(spark):
    data = [
        (1, "Adriano Bristardo Prundeiral Permância", "nº 493", "JC SP", "SP", None), (2, "ADRIANO B. P. PERMANNCIA", "493/SP", None, None, None), (3, "Prundeiral Permância, Adriano", None, "JUCESP", "SP", None),
        (4, "Adriano Bristardo Prundeiral Permância", "493", "JUCERJA", "RJ", None), (5, "Adriano Bristardo Prundeiral Permância Filho", "493", "JUCESP", "SP", None), (6, "Quixape Cavrédio Leilões Ltda", "77", "JUCEC", "CE", "a@office.example"),
        (7, "Leil. Quixape Cavredio", "077", "jucec", "CE", "a@office.example"), (8, "Rosa Lima Prado", "88", "JUCEC", "CE", "a@office.example"), (9, None, None, None, None, None), (10, "", "", "", "", ""), (11, "x" * 5_000, None, "JUCESP", "SP", None),
    ]
    df = spark.createDataFrame(data + data[:1], PEOPLE).selectExpr("*", "1 as pid", "2 as names", "3 as state", "4 as entity")
    got = {(r.record_id_a, r.record_id_b) for r in entities.same_entity_pairs(entities.resolve(df)).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (6, 7)}
    assert entities.same_entity_pairs(entities.resolve(df.limit(0))).count() == 0


def test_profiles_keep_all_spellings(spark):
    data = [
        (1, "Zé Carlos Pereira", "123", "JUCESP", "SP", None), (2, "Zé Carlos Pereira", "123", "JUCESP", "SP", "zp@mail.example"), (3, "José Carlos Almeida Pereira", "123", "JUCESP", "SP", None), (4, "Zé Carlos Pereira", None, "JUCESP", "SP", None),
        (5, "Rui Telles Moura", "2000", "JUCESP", "SP", None), (6, "Rui Telles Moura", "90000", "JUCESP", "SP", None), (7, "Rui Telles Moura", None, "JUCESP", "SP", None),
    ]
    got = {(r.record_id_a, r.record_id_b) for r in entities.same_entity_pairs(entities.resolve(spark.createDataFrame(data, PEOPLE))).collect()}
    assert got == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)}


def test_merging_goes_on_until_nothing_matches(spark, monkeypatch):
    matches = entities._matches
    monkeypatch.setattr(entities, "_matches", lambda profiles: matches(profiles).orderBy("a", "b").limit(1))
    data = [(i, "Rosa Lima Prado", "88", "JUCEC", "CE", f"rosa{i}@mail.example") for i in range(11)]
    member = entities.resolve(spark.createDataFrame(data, PEOPLE)).collect()
    assert len(member) == 11 and len({r.entity for r in member}) == 1


def test_rewriting_goes_on_until_nothing_is_new(spark, monkeypatch):
    def mined(of):
        def one(now):
            text = now.first().street
            return spark.createDataFrame([(text, of[text], 9, 99.0)] if text in of else [], "bad string, good string, support long, g2 double").withColumn("bad", F.concat(F.lit("^"), "bad")).withColumn("good", F.concat(F.lit("^"), "good"))

        return one

    rows = spark.createDataFrame([("p", "w0")], "place string, street string")
    monkeypatch.setattr(addresses, "mine_rewrites", mined({f"w{i}": f"w{i + 1}" for i in range(9)}))
    norm, used = addresses.normalise_streets(rows, "place", "street")
    assert norm.first().norm == "w9" and used.count() == 9
    monkeypatch.setattr(addresses, "mine_rewrites", mined({"w0": "w1", "w1": "w0"}))
    norm, used = addresses.normalise_streets(rows, "place", "street")
    assert norm.first().norm == "w0" and used.count() == 2


def test_shuffled_input_gives_the_same(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/auctioneers_unified.parquet")
    pairs = lambda x: {tuple(r) for r in entities.same_entity_pairs(entities.resolve(x)).collect()}
    rows = df.collect()
    random.Random(1).shuffle(rows)
    assert pairs(df) == pairs(spark.createDataFrame(rows, df.schema))


def test_spellings_of_a_merged_profile_match_together(spark):
    """Only the union of the spellings of A and B is like C: A has the first name, B the second surname."""
    cols = "record_id long, nome string, matricula string, junta_sigla string, uf string, innlei_email string"
    rows = [
        (1, "Rubervaldo Tinzumes Pralvardo", "1234", "JUCESP", "SP", None), (2, "R. Tinzumes Pralvardo Gorquvas", "1234", "JUCESP", "SP", "rt@casa.example"),
        (3, "Tinzumes Pralvardo Gorquvas", None, "JUCESP", "SP", "rt@casa.example"), (4, "Rubervaldo Tinzumes Pralvardo", None, "JUCESP", "SP", None), (5, "Rubervaldo Tinzumes Pralvardo", "9999999", "JUCESP", "SP", None),
    ]
    got = {r.record_id: r.entity_id for r in entities.named_by_smallest(entities.resolve(spark.createDataFrame(rows[:4], cols))).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1}
    # the same name under another registration far away is another person, and then the free record is open between both
    more = {r.record_id: r.entity_id for r in entities.named_by_smallest(entities.resolve(spark.createDataFrame(rows, cols))).collect()}
    assert more[1] == more[2] == more[3] == 1 and more[5] == 5


def test_unlocated_addresses_have_a_reason(spark):
    cols = "id long, street_type string, street_name string, number string, complement string, district string, municipality_name string, municipality_code string, uf string, cep string, raw_text string"
    rows = [
        (1, None, None, None, None, None, "Campo Verde", None, "RJ", None, None), (2, "Rua", "das Acacias", None, None, None, "Campo Verde", None, "RJ", None, None), (3, "Rua", "das Acacias", "12", None, None, None, None, None, None, None),
        (4, "Rua", "das Acacias", "1234567", "apto 12345", None, "Campo Verde", None, "RJ", "20000-001", None), (5, "Rua", "das Acacias", "1234567", "ap 12345", None, "Campo Verde", None, "RJ", "20000001", None),
    ]
    got = addresses.parse_addresses(addresses.with_city(spark.createDataFrame(rows, cols), reference(spark)))
    assert {r.id: r.reason for r in addresses.unlocated(got).collect()} == {1: addresses.NO_STREET, 2: addresses.NO_STREET, 3: addresses.NO_PLACE}
    at = {r.id: r.location for r in addresses.locate(got).collect()}
    assert at[4] == at[5] and set(at) == {4, 5}


def test_streets_share_a_block(spark):
    cases = [("joao silva", "joao da silva", True), ("j silva", "joao silva", True), ("ninzuvvsa cesar f", "x y", False), ("cesar f ninzuvvsa", "cesar feltumes ninzuvas", True), ("silva", "joao silva", True), ("maria silva", "pedro silva", False), ("ioao silva", "joao silva", True)]
    for a, b, same in cases:
        df = spark.createDataFrame([("c", 1, a.split()), ("c", 2, b.split())], "city string, id long, names array<string>")
        pairs = addresses._candidates(addresses._blocks(df.where("id = 1"), "id", "a"), addresses._blocks(df.where("id = 2"), "id", "b")).count()
        assert (pairs == 1) == same, (a, b)
