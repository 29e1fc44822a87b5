"""Schemas of messages, files and tables."""

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "d": T.DoubleType(), "b": T.BooleanType(), "t": T.TimestampType(), "i": T.IntegerType(), "l": T.LongType(), "y": T.BinaryType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in spec.split())])


#: A transaction message: all fields may be missing.
TRANSACTION = _struct("transaction_id:s customer_id:s card_number:s merchant_id:s merchant_name:s merchant_category:s amount:d currency:s transaction_type:s payment_channel:s device_id:s city:s country:s transaction_timestamp:t is_international:b status:s")
#: What a Kafka source gives.
ENVELOPE = _struct("key:y value:y topic:s partition:i offset:l timestamp:t timestampType:i")
#: One watchlist file; effective_from is text of the form dd-MMM-yyyy HH:mm:ss.
WATCHLIST = _struct("watchlist_id:s watch_type:s entity_id:s risk_level:s action:s reason_code:s reason_description:s status:s effective_from:s reported_by:s reported_source:s country:s city:s")
CUSTOMER = _struct("customer_id:s first_name:s last_name:s gender:s age:i city:s state:s country:s annual_income:d customer_segment:s account_open_date:s risk_score:d preferred_spending_min:d preferred_spending_max:d preferred_city:s preferred_country:s trusted_device_id:s card_number:s card_type:s email:s transaction_limit:d")
MERCHANT = _struct("merchant_id:s merchant_name:s merchant_category:s city:s country:s merchant_risk:s is_blacklisted:b")
