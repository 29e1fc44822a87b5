"""Mail subjects and bodies as columns. All values are escaped for HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.text import escape_html, mask_card, money, or_default, yes_no


def _cell(value: Column) -> Column:
    return escape_html(F.coalesce(value.cast("string"), F.lit("")))


def digest_row(currency: str = "currency") -> Column:
    """A table row of one high-value alert."""
    amount = F.concat_ws(" ", currency, money(F.col("transaction_amount")))
    limit = F.concat_ws(" ", currency, money(F.col("transaction_limit")))
    cells = [F.col("alert_id"), F.col("customer_name"), F.col("customer_email"), amount, limit, F.col("merchant_name"), F.concat_ws(", ", "city", "country"), F.col("transaction_timestamp")]
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), _cell(c), F.lit("</td>")) for c in cells], F.lit("</tr>"))


DIGEST_HEAD = "<tr>" + "".join(f"<th>{h}</th>" for h in ("Alert", "Customer", "E-mail", "Amount", "Limit", "Merchant", "Place", "Time")) + "</tr>"


def digest_subject(count: int) -> str:
    return f"{count} high-value transaction alert{'' if count == 1 else 's'}"


def fraud_mail(alerts: DataFrame) -> DataFrame:
    """alerts (of fraud_card_alerts) with mail_to, mail_subject and mail_body."""
    card = mask_card(F.col("card_number"))
    fields = [
        ("Alert", F.col("alert_id")), ("Type", F.col("alert_type")), ("Raised", F.col("alert_timestamp")), ("Customer", F.col("customer_name")),
        ("Transaction", F.col("transaction_id")), ("Card", F.concat(F.lit("****"), card)), ("Amount", F.concat_ws(" ", money(F.col("amount")), "currency")),
        ("Merchant", F.col("merchant_name")), ("Category", F.col("merchant_category")), ("Kind", F.col("transaction_type")), ("Channel", F.col("payment_channel")),
        ("Place", F.concat_ws(", ", "transaction_city", "transaction_country")), ("International", yes_no(F.col("is_international"))), ("Time", F.col("transaction_timestamp")), ("Status", F.col("transaction_status")),
        ("Listing", F.col("watchlist_id")), ("Listed as", F.col("watch_type")), ("Risk", F.col("risk_level")), ("Action", F.col("action")), ("Reason", F.col("reason_description")),
        ("Reported by", F.col("reported_by")), ("Source", F.col("reported_source")), ("Listed place", F.concat_ws(", ", or_default(F.col("watchlist_city")), or_default(F.col("watchlist_country")))), ("Effective from", F.col("watchlist_effective_from")),
    ]
    rows = [F.concat(F.lit(f"<tr><th>{name}</th><td>"), _cell(value), F.lit("</td></tr>")) for name, value in fields]
    subject = F.concat_ws(" ", F.lit("Card alert:"), F.concat(F.coalesce("risk_level", F.lit("unknown")), F.lit(" risk,")), "alert_id")
    return alerts.withColumns({"mail_to": F.col("customer_email"), "mail_subject": subject, "mail_body": F.concat(F.lit("<table>"), *rows, F.lit("</table>"))})
