from pyspark.sql import functions as F

from pregonero.functions.amounts import stated_unit
from pregonero.operators.money import convert_amounts, found_amounts

CASES = [
    ("100000.00", None, 10_000_000), ("R$100000,00", None, 10_000_000), ("R$ 98.396,78", None, 9_839_678), ("10014934 centavos", None, 10_014_934), ("1.165.000 cent.", None, 1_165_000),
    ("BRL 1,001,787.53", None, 100_178_753), ("100,645.45", None, 10_064_545), ("R$ 101.152,23 (mínimo)", None, 10_115_223), (" R$  101.400,00 ", None, 10_140_000), ("R$ 100.700", None, 10_070_000),
    ("101.000,- reais", None, 10_100_000), ("101k", None, 10_100_000), ("R$ 1056 mil", None, 105_600_000), ("R$ 100,6 mil", None, 10_060_000), ("105e3", None, 10_500_000), ("R$ 1,0266 milhões", None, 102_660_000),
    ("R$ 1,039 mi", None, 103_900_000), ("1,1208 MM", None, 112_080_000), ("cento e quarenta e um mil reais", None, 14_100_000), ("um milhão e duzentos mil reais e cinquenta centavos", None, 120_000_050),
    ("154,06687", "Valores expressos em milhares de reais.", 15_406_687), ("82", "Quantias informadas em mil reais.", 8_200_000), ("16082982", "(quantias em centavos de real) casa", 16_082_982),
    ("1.55831923", "Valores expressos em milhões de reais.", 155_831_923), ("355", "Os preços desta ficha estão em R$ x 1.000.", 35_500_000), ("85500", "Terreno de 6 mil m² em condomínio.", 8_550_000),
    ("a consultar", None, None), ("R$", None, None), ("-", None, None), ("", None, None), (None, None, None), ("9" * 40_000, None, None), ("dez casas", None, None),
]


def values(spark, rows):
    df = spark.createDataFrame([(i, v, h) for i, (v, h, *_) in enumerate(rows)], "row_id long, value string, text1 string")
    return df.select(F.lit("t").alias("table_name"), "row_id", F.lit("f").alias("field_name"), F.lit(0).cast("long").alias("item_no"), "value", "text1", F.lit(None).cast("string").alias("text2"), F.lit(None).cast("double").alias("anchor"))


def test_notations(spark):
    # the bulk that the model is fitted to
    bulk = [(f"{100_000 + 37 * i}.00", None) for i in range(400)]
    got = {r.row_id: r.centavos for r in convert_amounts(values(spark, CASES + bulk)).collect()}
    for i, (v, h, want) in enumerate(CASES):
        assert got[i] == want, (v and v[:60], h)


def test_missing_unit_takes_the_anchor(spark):
    bulk = [(f"{100_000 + 370 * i}.00", None) for i in range(400)]
    df = values(spark, [("120", None), ("12000000", None), *bulk]).withColumn("anchor", F.when(F.col("row_id") < 2, 100_000.0).otherwise(F.lit(100_000.0)))
    got = {r.row_id: (r.centavos, r.unit) for r in convert_amounts(df).collect()}
    assert got[0] == (12_000_000, "mil") and got[1] == (12_000_000, "centavos")


def test_canonical_and_repeated_rows(spark):
    df = values(spark, [("100.00", None), ("100,00", None)])
    df = df.unionByName(df)
    assert [(r.row_id, r.centavos) for r in found_amounts({"f": df}).collect()] == [(1, 10_000)]
    assert found_amounts({"f": df.limit(0)}).count() == 0


def test_stated_unit(spark):
    texts = ["valores em R$ mil", "Os preços estão em centavos", "sem nada", "mil metros e valores altos", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(stated_unit(F.col("t"))).collect()] == ["mil", "centavos", None, None, None]
