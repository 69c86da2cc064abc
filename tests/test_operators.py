"""Reference behaviours that the shared tables don't reach: golden rows, idempotence, order."""

import hashlib
import hmac

from pyspark.sql import functions as F

from pregonero.functions import parsers as P
from pregonero.operators import relational as R
from pregonero.plans.reference_queries import QUERIES
from pregonero.sources import readers


def column(spark, texts, f):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(f(F.col("t"))).collect()]


def test_money_golden(spark):
    got = column(spark, ["R$ 1.234,56", "1234,5", "1.234", "1.234.567", "abc", "", "-", None, "-12,50"], P.clean_money)
    assert [None if v is None else float(v) for v in got] == [1234.56, 1234.5, 1.234, 1234567.0, None, None, None, None, -12.5]


def test_longest_registry_number(spark):
    assert column(spark, ["matrícula 12345", "Matrícula nº 12.345 do CRI", "sem"], P.registry_key) == ["12345", "12345", None]


def test_registration_after_the_sign_of_numbers(spark):
    texts = ["nº 493", "Nº00493", "n° 10.012", "N.º 77", "no 493", "º 12", "493/SP", "JUCESP 1135", "000", "", None]
    assert column(spark, texts, P.registration) == ["493", "493", "10012", "77", "493", "12", "493SP", "JUCESP1135", "0", None, None]


def test_collected_urls(spark):
    text = "ver https://a.example/2.jpg e <img src='https://a.example/Logo.png'> https://a.example/1.pdf?x=1 https://a.example/2.jpg http://b.example"
    assert column(spark, [text, "sem", None], P.collect_urls) == [["https://a.example/2.jpg", "https://a.example/1.pdf?x=1", "http://b.example"], [], None]
    many = " ".join(f"https://a.example/{i}" for i in range(30))
    assert column(spark, [many], P.collect_urls) == [[f"https://a.example/{i}" for i in range(20)]]


def test_cache_of_geocoded_texts(spark, tmp_path):
    rows = [(1, "Rua A, 1", -23.5, -46.6), (2, " rua a, 1", None, None), (3, "Rua B, 2", None, None), (4, None, -23.5, -46.6)]
    spark.createDataFrame(rows, "id long, raw_text string, latitude double, longitude double").write.parquet(f"{tmp_path}/address.parquet")
    assert sorted(tuple(r) for r in QUERIES["j17_cache_lookup_geocoded"](spark, str(tmp_path)).collect()) == [(1, True), (2, True), (3, False)]


def test_hmac_equals_standard_library(spark):
    pepper = "0123456789abcdef0123456789abcdefX"
    want = [hmac.new(pepper.encode(), t.encode(), hashlib.sha256).hexdigest() for t in ("", "é", "123")]
    assert column(spark, ["", "é", "123"], lambda c: P.hmac_sha256(c, pepper)) == want


def test_trigram_similarity(spark):
    df = spark.createDataFrame([("sao paulo", "sao paolo")], "a string, b string")
    assert abs(df.select(P.similarity(F.col("a"), F.col("b"))).first()[0] - 7 / 13) < 1e-9


def test_html_text():
    assert readers.strip_html("<p>Olá&nbsp;<b>mundo</b></p><script>x()</script>") == "Olá mundo"
    assert readers.strip_html(None) is None and readers.strip_html("  ") == ""


def test_upsert_is_idempotent_and_order_free(spark):
    rows = [("a", 1, "x", None), ("a", 2, None, 5), ("b", 1, "y", 1)]
    df = spark.createDataFrame(rows, "k string, at int, s string, n int")
    policy = {"s": "overwrite", "n": "coalesce"}
    once = R.upsert_fold(df, ["k"], ["at"], policy)
    again = R.upsert_fold(df.unionByName(df).orderBy(F.rand(3)), ["k"], ["at"], policy)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == [("a", None, 5), ("b", "y", 1)]


def test_insert_ignore_and_replace(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, R.insert_ignore(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    assert sorted(map(tuple, R.replace_children(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_json_folder_and_xml(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1,\n "y": "b"}')
    (tmp_path / "b.json").write_text("{broken")
    rows = {(r.x, r.corrupt) for r in readers.read_json_folder(spark, str(tmp_path / "*.json"), "x int, y string").collect()}
    assert rows == {(1, False), (None, True)}
    (tmp_path / "l.xml").write_text("<f><listing><id>1</id></listing><listing><id>2</id></listing></f>")
    assert readers.read_xml(spark, str(tmp_path / "l.xml"), "listing", "id int").count() == 2


def test_publish_keeps_the_old_version_on_a_bad_key(spark, tmp_path):
    import pytest

    from pregonero.operators.jobs import current, publish

    base = f"file://{tmp_path}/gold"
    publish(spark.createDataFrame([(1, "a")], "k int, v string"), base, ["k"])
    with pytest.raises(ValueError):
        publish(spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string"), base, ["k"])
    assert [tuple(r) for r in current(spark, base).collect()] == [(1, "a")]
    publish(spark.createDataFrame([(3, "c")], "k int, v string"), base, ["k"])
    assert [tuple(r) for r in current(spark, base).collect()] == [(3, "c")]


def test_a_restarted_stream_goes_on(spark, tmp_path):
    """The second run of a job with its folder counts only what came after the first."""
    from pregonero.streaming.jobs import known_lots

    cols = "id long, source_short_name string, source_lot_code string"
    lots, base = tmp_path / "in", f"file://{tmp_path}/job"
    spark.createDataFrame([(1, "a", "1"), (2, "a", "2"), (3, None, "2")], cols).write.parquet(f"{lots}/auction_lot.parquet")
    one = {tuple(r) for r in known_lots(spark, str(lots), base).collect()}
    assert one == {("a", "1", "new", 1), ("a", "2", "new", 1)}
    spark.createDataFrame([(4, "a", "2"), (5, "b", "9")], cols).write.mode("append").parquet(f"{lots}/auction_lot.parquet")
    assert {tuple(r) for r in known_lots(spark, str(lots), base).collect()} == {("a", "1", "new", 1), ("a", "2", "seen again", 2), ("b", "9", "new", 1)}


def test_a_stream_with_a_watermark(spark, tmp_path):
    from pregonero.streaming.jobs import daily_counts, first_seen

    e = spark.createDataFrame([(1, "2024-01-01 00:10:00"), (1, "2024-01-01 23:20:00"), (2, "2024-01-02 00:00:00")], "user_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    e.write.parquet(f"{tmp_path}/events.parquet")
    assert sorted((r.user_id, str(r.start)[:10], r.n) for r in daily_counts(spark, str(tmp_path)).collect()) == [(1, "2024-01-01", 2), (2, "2024-01-02", 1)]
    stream = first_seen(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/events.parquet*"), ["user_id"], "ts")
    assert stream.isStreaming
    got = stream.writeStream.format("memory").queryName("firsts").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    got.awaitTermination()
    assert sorted(r.user_id for r in spark.table("firsts").collect()) == [1, 2]


def test_shared_folder_or_error():
    from pregonero.session import _local_folder

    with __import__("pytest").raises(RuntimeError):
        _local_folder("spark://host:7077")
    assert _local_folder("local[4]") == _local_folder("local[4]")
