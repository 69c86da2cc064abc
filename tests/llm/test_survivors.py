from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pregonero.llm.survivors import auction_lot_survivors, spatial_unit_survivors, true_values

SCHEMA = "id long, cri_office_id int, registry_number string, useful_area decimal(12,2), bedrooms int, scraped_at timestamp, confidence_score decimal(3,2), source_short_name string"


def day(n):
    return datetime(2020, 1, 1 + n)


def rows(spark, data):
    from decimal import Decimal

    dec = lambda x: None if x is None else Decimal(str(x))
    return spark.createDataFrame([(i, o, r, dec(a), b, t, dec(c), s) for i, o, r, a, b, t, c, s in ((*x, "s")[:8] for x in data)], SCHEMA)


def found(df):
    return {(r.group_id, r.field_name): r.row_id for r in df.collect()}


def bulk(start):
    out = []
    for g in range(40):
        area = 50 + g
        out += [(start + 4 * g, 9, f"b{g}", area, 2, day(0), 0.8), (start + 4 * g + 1, 9, f"b{g}", area, 2, day(1), 0.9), (start + 4 * g + 2, 9, f"b{g}", area * 10, 22, day(2), 0.2), (start + 4 * g + 3, 9, f"b{g}", area * 100, 33, day(3), None)]
    return out


def test_trusted_latest_and_carriers(spark):
    data = [
        (1, 1, "a", 80, -1, day(0), 0.9), (2, 1, "a", 90, None, day(2), 0.7), (3, 1, "a", 900, 4, day(5), 0.1), (4, 1, "a", 90, 99, day(3), None),
        (5, 1, "solo", 70, 1, day(0), 0.9), (6, None, "a", 70, 1, day(0), 0.9), (7, None, "a", 71, 1, day(0), 0.9),
        (8, 2, "void", 0, -1, day(0), 0.9), (9, 2, "void", 999999.99, 99, day(1), 0.9), (10, 3, "tie", 60, 3, day(0), 0.9), (11, 3, "tie", 61, 3, day(0), 0.9),
    ]
    got = found(spatial_unit_survivors(rows(spark, data + bulk(100))))
    assert got[(1, "useful_area")] == 2 and got[(1, "bedrooms")] == 3
    assert (5, "useful_area") not in got and (6, "useful_area") not in got and (8, "useful_area") not in got
    assert got[(10, "useful_area")] == 10 and got[(10, "bedrooms")] == 10
    assert all(got[(100 + 4 * g, "useful_area")] == 100 + 4 * g for g in range(40))


def test_all_values_judged_true(spark):
    data = [(1, 1, "two", 0, 2, day(0), 0.9), (2, 1, "two", 0, 2, day(1), 0.8), (3, 1, "two", 0, 3, day(2), 0.9), (4, 1, "two", 0, 3, day(3), 0.8), (5, 1, "two", 0, 44, day(4), 0.1)]
    df = rows(spark, data + bulk(100))
    got = true_values(df, ["cri_office_id", "registry_number"], "id", "source_short_name", "confidence_score", "scraped_at", {"bedrooms": (F.col("bedrooms").cast("string"), F.lit(True))})
    assert sorted(r.row_id for r in got.collect() if r.group_id == 1) == [1, 3]


def test_a_source_that_is_wrong_in_spite_of_its_confidence(spark):
    """The plain rule (confident, then latest) takes the value of source `bad` in every group; the model finds it out."""
    data = []
    for g in range(150):
        for k, source in enumerate(("a", "b", "c")):
            data.append((1000 + 4 * g + k, 7, f"g{g}", 60 + g, 2, day(k), 0.9, source))
        data.append((1003 + 4 * g, 7, f"g{g}", 300 + 3 * g, 5, day(9), 0.9, "bad"))
    data += [(1, 8, "alone", 70, 1, day(0), 0.9, "bad"), (2, 8, "alone", 70, 1, day(1), 0.9, "bad"), (3, 8, None, 1, 1, day(1), 0.9, None)]
    got = found(spatial_unit_survivors(rows(spark, data)))
    assert all(got[(1000 + 4 * g, "useful_area")] == 1000 + 4 * g and got[(1000 + 4 * g, "bedrooms")] == 1000 + 4 * g for g in range(150))
    assert got[(1, "useful_area")] == 1


def test_rates_are_those_of_plain_expectation_maximisation(spark):
    """The rates against the same steps over lists."""
    import math

    from pregonero.llm import survivors as S

    data = [([3], [7], 5), ([3, 7], [1], 9), ([1], [3, 7], 9), ([7], [], 4), ([1, 5], [], 3)]
    claims = spark.createDataFrame([(a, b) for a, b, n in data for _ in range(n)], "pos array<int>, neg array<int>")
    got, want = S.fit_quality(claims, 2), S.QualityModel(2)
    for _ in range(500):
        import numpy as np

        sums, t, n_all = np.zeros((8, 4)), 0.0, 0
        for a, b, n in data:
            if len(a) + len(b) > 1:
                odds = math.log(want.rate / (1 - want.rate)) + sum(math.log(want.sens[i] / want.fpr[i]) for i in a) + sum(math.log((1 - want.sens[i]) / (1 - want.fpr[i])) for i in b)
                p = 1 / (1 + math.exp(-odds))
                for i in a:
                    sums[i] += [p * n, 0, (1 - p) * n, 0]
                for i in b:
                    sums[i] += [0, p * n, 0, (1 - p) * n]
                t, n_all = t + p * n, n_all + n
        want.rate = min(0.95, max(0.05, t / n_all))
        if want.step(sums) < S.TOLERANCE:
            break
    assert abs(got.sens - want.sens).max() < 1e-9 and abs(got.fpr - want.fpr).max() < 1e-9


def test_hot_group_and_repeats(spark):
    many = [(1000 + i, 5, "hot", 100, 2, day(0), 0.9) for i in range(3000)]
    assert found(spatial_unit_survivors(rows(spark, many + many[:10] + bulk(10))))[(1000, "useful_area")] == 1000


def test_agrees_with_plain_sql(spark, sf_dir, duck):
    got = {(r.group_id, r.field_name, r.row_id) for r in spatial_unit_survivors(spark.read.parquet(f"{sf_dir}/spatial_unit.parquet").selectExpr("*", "1 as v", "2 as f", "3 as n")).collect()}
    want = set()
    for field, usable in (("useful_area", "useful_area > 0.01 AND useful_area < 999999"), ("bedrooms", "bedrooms >= 0 AND bedrooms < 99")):
        sql = f"""WITH u AS (SELECT *, min(id) OVER w AS g, count(*) OVER w AS n FROM spatial_unit WINDOW w AS (PARTITION BY cri_office_id, registry_number)),
         s AS (SELECT g, arg_max({field}, (coalesce(confidence_score, 0) >= 0.6, scraped_at)) AS v FROM u WHERE n > 1 AND {usable} GROUP BY g)
         SELECT u.g, min(id) FROM u JOIN s ON u.g = s.g AND u.{field} = s.v GROUP BY 1"""
        want |= {(g, field, i) for g, i in duck.execute(sql).fetchall()}
    assert got == want


def test_empty(spark):
    assert spatial_unit_survivors(rows(spark, [])).count() == 0


@pytest.fixture
def lots(spark):
    text = "Casa com área de 50 m², duas frentes. Não constam ônus. Imóvel ocupado."
    data = [
        (1, "s", "x", "vide edital", day(0), 0.9), (2, "s", "x", text[:30] + "…", day(3), 0.9), (3, "s", "x", text, day(1), 0.9), (4, "s", "x", "Este site utiliza cookies para melhorar a navegação.", day(4), 0.2),
        (5, "s", "y", None, day(0), 0.9), (6, "s", "y", " ", day(0), 0.9), (7, "s", "y", "Erro 500", day(0), 0.9),
    ]
    return spark.createDataFrame([(*r, 100 * r[0]) for r in data], "id long, source_short_name string, source_lot_code string, description string, scraped_at timestamp, confidence_score double, centavos long")


def test_descriptions(lots):
    got = found(auction_lot_survivors(lots))
    assert got[(1, "description")] == 3 and (5, "description") not in got and got[(5, "appraisal_value")] in (5, 6, 7)
