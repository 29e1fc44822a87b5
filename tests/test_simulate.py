from pyspark.sql import functions as F

from vigilake.config import SimulatorSettings
from vigilake.functions import text
from vigilake.plans import simulate

S = SimulatorSettings(customers=2000, merchants=240)


def test_customers(spark):
    c = simulate.customers(spark, S).cache()
    assert c.count() == 2000 == c.select("card_number").distinct().count()
    assert c.filter(~text.is_luhn(F.col("card_number")) | (F.length("card_number") != 16)).count() == 0
    assert c.filter("country <> 'India'").count() == 200
    assert c.filter("age NOT BETWEEN 18 AND 75 OR risk_score NOT BETWEEN 5 AND 100 OR preferred_spending_min > preferred_spending_max").count() == 0
    share = c.filter("customer_segment = 'Regular'").count() / 2000
    assert 0.55 < share < 0.65
    assert c.exceptAll(simulate.customers(spark, S)).count() == 0


def test_merchants(spark):
    m = simulate.merchants(spark, S).cache()
    assert m.filter("is_blacklisted").count() == 12 and m.filter("country <> 'India'").count() == 16
    assert m.filter("merchant_id = 'MER0001'").first().merchant_category == "Fuel"
    assert m.select("merchant_category").distinct().count() == 12


def test_transactions(spark):
    t = simulate.transactions(spark, 5000, S).cache()
    assert t.count() == 5000 == t.select("transaction_id").distinct().count()
    both = t.join(simulate.customers(spark, S).select("customer_id", "customer_segment", "preferred_country", "trusted_device_id"), "customer_id")
    for segment, own in simulate.PREFERRED.items():
        assert both.filter((F.col("customer_segment") == segment) & ~F.col("merchant_category").isin(own)).count() == 0
    assert both.filter("is_international <> (country <> preferred_country)").count() == 0
    assert both.filter("currency <> 'INR' AND NOT is_international").count() == 0
    other = both.filter("device_id <> trusted_device_id").count() / 5000
    assert 0.12 < other < 0.18
    forced = t.filter(simulate.forced(S)).count() / 5000
    assert 0.06 < forced < 0.10
    assert simulate.high_value_feed(t).filter("amount < 100001 OR transaction_id NOT LIKE 'TXF%'").count() == 0
    assert simulate.listed_card_feed(t, "4").select("card_number").distinct().count() == 1
    assert simulate.normal_feed(t).filter("amount NOT BETWEEN 1 AND 99999.99").count() == 0


def test_csv(spark, tmp_path):
    for _ in range(2):
        simulate.write_csv(simulate.merchants(spark, S), str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).count() == 240
