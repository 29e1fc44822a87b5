"""Synthetic customers, merchants and transactions as DataFrames: each row depends on the seed and its number alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.config import SimulatorSettings
from vigilake.functions import text

# Domains of the simulated entities.
CATEGORIES = ["Grocery", "Fuel", "Restaurant", "Hotel", "Electronics", "Jewellery", "ATM", "Pharmacy", "Shopping", "Airline", "Entertainment", "Travel"]
INDIAN_PLACES = [("Delhi", "Delhi"), ("Mumbai", "Maharashtra"), ("Bengaluru", "Karnataka"), ("Hyderabad", "Telangana"), ("Chennai", "Tamil Nadu"), ("Kolkata", "West Bengal"), ("Pune", "Maharashtra"), ("Ahmedabad", "Gujarat")]
MERCHANT_CITIES = ["Delhi", "Mumbai", "Bengaluru", "Hyderabad", "Chennai", "Kolkata", "Pune", "Ahmedabad", "Jaipur", "Lucknow"]
FOREIGN = [("London", "England", "United Kingdom"), ("Dubai", "Dubai", "UAE"), ("Singapore", "Singapore", "Singapore"), ("New York", "New York", "United States")]
SEGMENTS = [("Regular", 0.60), ("Gold", 0.20), ("Platinum", 0.10), ("Corporate", 0.10)]
INCOME = {"Regular": (250_000, 900_000), "Gold": (900_000, 2_500_000), "Platinum": (2_500_000, 8_000_000), "Corporate": (1_500_000, 5_000_000)}
SPENDING = {"Regular": (0.02, 0.08), "Gold": (0.05, 0.15), "Platinum": (0.08, 0.22), "Corporate": (0.10, 0.30)}
PREFERRED = {"Regular": ["Grocery", "Restaurant", "Pharmacy", "Shopping"], "Gold": ["Restaurant", "Shopping", "Entertainment", "Travel"], "Platinum": ["Hotel", "Airline", "Jewellery", "Electronics"], "Corporate": ["Fuel", "Travel", "Restaurant", "Hotel"]}
CARD_TYPES, GENDERS = ["Visa", "Mastercard", "RuPay", "Amex"], ["Male", "Female", "Other"]
TRAVEL, SHOPPING = ["Hotel", "Airline", "Travel"], ["Electronics", "Jewellery", "Shopping"]
ONLINE = ["Shopping", "Electronics", "Grocery", "Pharmacy", "Restaurant"]
CHANNELS = ["POS", "MOBILE_APP", "INTERNET_BANKING"]
# Invented names: of people, and of merchants by category.
FIRST_NAMES, LAST_NAMES = ["Asha", "Ravi", "Meera", "Kiran", "Noor", "Tara", "Vik", "Lena"], ["Rao", "Shah", "Iyer", "Das", "Khan", "Bose", "Pillai", "Grey"]
SHOPS = {
    "Grocery": ["Green Basket", "Corner Larder", "Harvest Shelf"], "Fuel": ["Mile Pump", "Blue Tank", "Road Energy"], "Restaurant": ["Copper Spoon", "Banyan Kitchen", "Night Thali"],
    "Hotel": ["Lake Rooms", "Palm Residency", "Station House"], "Electronics": ["Volt Store", "Circuit Bazaar", "Pixel Point"], "Jewellery": ["Lotus Jewels", "Silver Anklet", "Moon Pearl"],
    "ATM": ["Cash Window", "Teller Box", "Note Point"], "Pharmacy": ["Tulsi Chemist", "Red Cross Road Medicines", "Remedy Shelf"], "Shopping": ["Arcade Nine", "Weekend Bazaar", "Cotton Street"],
    "Airline": ["Monsoon Air", "Kite Airways", "Delta Wing"], "Entertainment": ["Star Screen", "Laugh Club", "Arcade Park"], "Travel": ["Compass Tours", "Long Road Travels", "Coral Trips"],
}
EPOCH = "2024-01-01 00:00:00"


def _by(segment: Column, values: dict[str, tuple[float, float]], i: int) -> Column:
    return F.coalesce(*[F.when(segment == k, F.lit(float(v[i]))) for k, v in values.items()])


def _between(u: Column, low: Column | float, high: Column | float) -> Column:
    low = F.lit(low) if not isinstance(low, Column) else low
    return low + u * ((F.lit(high) if not isinstance(high, Column) else high) - low)


def _normal(a: Column, b: Column) -> Column:
    """A standard normal number from two uniform ones."""
    return F.sqrt(-2 * F.log(1 - a)) * F.cos(2 * math.pi * b)


def _partitions(n: int) -> int:
    return max(1, min(4096, n // 250_000))


def customers(spark: SparkSession, settings: SimulatorSettings = SimulatorSettings()) -> DataFrame:
    """customer_id CUST000001 and on. Every tenth lives abroad; cards begin with 4 or 5 and pass the Luhn check."""
    u = lambda tag: text.uniform(settings.seed, tag, F.col("id"))
    seg = F.col("customer_segment")
    places = lambda found: F.array(*[F.struct(*map(F.lit, p)) for p in found])
    home = F.get(places([(c, s, "India") for c, s in INDIAN_PLACES]), F.floor(u("home") * len(INDIAN_PLACES)).cast("int"))
    away = F.get(places(FOREIGN), F.floor(u("abroad") * len(FOREIGN)).cast("int"))
    d = spark.range(1, settings.customers + 1, numPartitions=_partitions(settings.customers)).withColumn("customer_segment", text.weighted_choice(u("segment"), SEGMENTS))
    d = d.withColumn("place", F.when(F.col("id") % 10 == 0, away).otherwise(home)).withColumns({"city": F.col("place.col1"), "state": F.col("place.col2"), "country": F.col("place.col3")})
    d = d.withColumn("annual_income", text.cents(_between(u("income"), _by(seg, INCOME, 0), _by(seg, INCOME, 1))))
    body = F.concat(text.pick(u("brand"), ["4", "5"]), F.lpad(F.floor(u("card") * 10**14).cast("string"), 14, "0"))
    return d.select(
        text.numbered("CUST", F.col("id"), 6).alias("customer_id"),
        text.pick(u("first"), FIRST_NAMES).alias("first_name"),
        text.pick(u("last"), LAST_NAMES).alias("last_name"),
        text.pick(u("gender"), GENDERS).alias("gender"),
        (18 + F.floor(u("age") * 58)).cast("int").alias("age"),
        "city",
        "state",
        "country",
        "annual_income",
        "customer_segment",
        F.date_format(F.date_sub(F.lit(EPOCH).cast("date"), F.floor(u("opened") * 8 * 365).cast("int")), "yyyy-MM-dd").alias("account_open_date"),
        text.clamp((F.lit(35) + 18 * _normal(u("risk1"), u("risk2"))).cast("int"), F.lit(5), F.lit(100)).cast("double").alias("risk_score"),
        text.cents(F.col("annual_income") * _by(seg, SPENDING, 0) / 12).alias("preferred_spending_min"),
        text.cents(F.col("annual_income") * _by(seg, SPENDING, 1) / 12).alias("preferred_spending_max"),
        F.col("city").alias("preferred_city"),
        F.col("country").alias("preferred_country"),
        text.numbered("DEV", F.col("id"), 4).alias("trusted_device_id"),
        F.concat(body, text.luhn_digit(body)).alias("card_number"),
        text.pick(u("type"), CARD_TYPES).alias("card_type"),
        F.concat(F.lit("customer"), F.col("id").cast("string"), F.lit("@example.com")).alias("email"),
        text.cents(F.col("annual_income") * _by(seg, SPENDING, 1)).alias("transaction_limit"),
    )


def merchants(spark: SparkSession, settings: SimulatorSettings = SimulatorSettings()) -> DataFrame:
    """merchant_id MER0001 and on. Categories go round; every 15th is abroad, every 20th is blacklisted."""
    u = lambda tag: text.uniform(settings.seed, f"m-{tag}", F.col("id"))
    d = spark.range(1, settings.merchants + 1, numPartitions=_partitions(settings.merchants))
    category = F.get(F.array(*map(F.lit, CATEGORIES)), (F.col("id") % len(CATEGORIES)).cast("int"))
    away = F.floor(u("abroad") * len(FOREIGN)).cast("int")
    foreign = F.col("id") % 15 == 0
    name = F.coalesce(*[F.when(category == c, text.pick(u("name"), own)) for c, own in SHOPS.items()])
    return d.select(
        text.numbered("MER", F.col("id"), 4).alias("merchant_id"),
        F.concat_ws(" ", name, F.col("id").cast("string")).alias("merchant_name"),
        category.alias("merchant_category"),
        F.when(foreign, F.get(F.array(*[F.lit(p[0]) for p in FOREIGN]), away)).otherwise(text.pick(u("home"), MERCHANT_CITIES)).alias("city"),
        F.when(foreign, F.get(F.array(*[F.lit(p[2]) for p in FOREIGN]), away)).otherwise("India").alias("country"),
        text.weighted_choice(u("risk"), [("LOW", 0.65), ("MEDIUM", 0.25), ("HIGH", 0.10)]).alias("merchant_risk"),
        (F.col("id") % 20 == 0).alias("is_blacklisted"),
    )


def transactions(spark: SparkSession, n: int | DataFrame, settings: SimulatorSettings = SimulatorSettings(), people: DataFrame | None = None, shops: DataFrame | None = None) -> DataFrame:
    """n transactions, at the settings' rate: a random customer at a random merchant of the categories the segment prefers.

    n: how many, or a table of their numbers (column seq).

    Columns of the transaction message and seq. A merchant is found by category and rank, in an equi-join."""
    people = people if people is not None else customers(spark, settings)
    shops = shops if shops is not None else merchants(spark, settings)
    u = lambda tag: text.uniform(settings.seed, f"t-{tag}", F.col("seq"))
    ranked = shops.withColumn("no", F.substring("merchant_id", 4, 19).cast("long"))
    ranked = ranked.withColumn("rank", F.floor((F.col("no") - 1) / len(CATEGORIES)))
    sizes = ranked.groupBy("merchant_category").agg(F.max("rank").alias("top"), F.min("rank").alias("low"))
    t = n.select("seq") if isinstance(n, DataFrame) else spark.range(n, numPartitions=_partitions(n)).withColumnRenamed("id", "seq")
    t = t.withColumn("customer_id", text.numbered("CUST", 1 + F.floor(u("customer") * settings.customers).cast("long"), 6))
    c = people.select("customer_id", "card_number", "customer_segment", "preferred_country", "trusted_device_id", "preferred_spending_min", "preferred_spending_max")
    t = t.join(c, "customer_id")
    wanted = F.coalesce(*[F.when(F.col("customer_segment") == s, text.pick(u("category"), own)) for s, own in PREFERRED.items()], F.lit("Shopping"))
    t = t.withColumn("merchant_category", wanted).join(sizes, "merchant_category")
    t = t.withColumn("rank", F.col("low") + F.floor(u("merchant") * (F.col("top") - F.col("low") + 1)).cast("long"))
    t = t.join(ranked.select("merchant_category", "rank", "merchant_id", "merchant_name", "city", "country"), ["merchant_category", "rank"])
    low, high, kind = F.col("preferred_spending_min"), F.col("preferred_spending_max"), F.col("merchant_category")
    ordinary = text.clamp((low + high) / 2 + _normal(u("n1"), u("n2")) * (high - low) / 5, F.lit(50.0), 2 * high)
    amount = F.when(kind.isin(TRAVEL), _between(u("amount"), 0.6, 1.8) * high).when(kind.isin(SHOPPING), _between(u("amount"), 0.8 * low, 1.2 * high)).when(kind == "ATM", _between(u("amount"), 500.0, 5000.0)).otherwise(ordinary)
    foreign = ~F.col("country").eqNullSafe(F.col("preferred_country"))
    return t.select(
        "seq",
        text.numbered("TXN", F.col("seq"), 7).alias("transaction_id"),
        "customer_id",
        "card_number",
        "merchant_id",
        "merchant_name",
        "merchant_category",
        text.cents(amount).alias("amount"),
        F.when(foreign & (u("foreign") < 0.5), text.pick(u("currency"), ["USD", "EUR"])).otherwise("INR").alias("currency"),
        F.when(kind == "ATM", "ATM").when(kind.isin(ONLINE), text.pick(u("kind"), ["PURCHASE", "ONLINE"])).otherwise("PURCHASE").alias("transaction_type"),
        F.when(kind == "ATM", "ATM").otherwise(text.pick(u("channel"), CHANNELS)).alias("payment_channel"),
        F.when(u("device") < 0.15, text.numbered("DEV", (1000 + F.floor(u("other") * 9000)).cast("long"), 4)).otherwise(F.col("trusted_device_id")).alias("device_id"),
        "city",
        "country",
        F.timestamp_micros(F.unix_micros(F.lit(EPOCH).cast("timestamp")) + (F.col("seq") * (1_000_000 / settings.transactions_per_second)).cast("long")).alias("transaction_timestamp"),
        foreign.alias("is_international"),
        F.lit("APPROVED").alias("status"),
    )


def forced(settings: SimulatorSettings, key: str = "seq") -> Column:
    """Whether a transaction is to be a fraud, at the settings' rate."""
    return text.uniform(settings.seed, "forced", F.col(key)) < settings.fraud_percentage


def normal_feed(t: DataFrame, seed: int = 42) -> DataFrame:
    """Transactions as the ordinary producer sends them: amounts from 1 to 99,999.99, whatever was assembled."""
    return t.withColumn("amount", text.cents(1 + text.uniform(seed, "feed", F.col("seq")) * 99_998.99))


def high_value_feed(t: DataFrame) -> DataFrame:
    """Ids TXF…, amounts of at least 100,001."""
    return t.withColumn("transaction_id", F.concat(F.lit("TXF"), F.substring("transaction_id", 4, 19))).withColumn("amount", F.greatest("amount", F.lit(100_001.0)))


def listed_card_feed(t: DataFrame, card: str, seed: int = 42) -> DataFrame:
    """Ordinary amounts, all on one card."""
    return normal_feed(t, seed).withColumn("transaction_id", F.concat(F.lit("TXF"), F.substring("transaction_id", 4, 19))).withColumn("card_number", F.lit(card))


def as_messages(t: DataFrame) -> DataFrame:
    """key and value as a Kafka sink takes them; the message has the 16 fields and nothing else, with times in ISO-8601 to the second."""
    from vigilake import schemas
    from vigilake.functions.times import iso_seconds

    fields = [iso_seconds(F.col(n)).alias(n) if n == "transaction_timestamp" else F.col(n) for n in schemas.TRANSACTION.names]
    return t.select(F.col("transaction_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line, written anew."""
    df.write.mode("overwrite").option("header", True).csv(path)
