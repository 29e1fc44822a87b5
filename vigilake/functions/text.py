"""Text: names, masks, numbers, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tagged(*parts: Column | str) -> Column:
    """Parts joined by dashes; nulls are skipped."""
    return F.concat_ws("-", *parts)


def full_name(first: Column, last: Column) -> Column:
    """Both names with a space between; nulls are skipped, so no name at all gives ''."""
    return F.concat_ws(" ", first, last)


def mask_card(card: Column) -> Column:
    """The last four characters, or **** where there is no number."""
    return F.when(card.isNull() | (card == ""), "****").otherwise(F.right(card, F.lit(4)))


def or_default(value: Column, default: str = "N/A") -> Column:
    """The value, or the default where it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def money(amount: Column) -> Column:
    """Two decimals, with thousands set off by commas."""
    return F.format_number(amount, 2)


def cents(amount: Column) -> Column:
    """To two decimals, halves up, in double arithmetic alone, so that any engine gives the same."""
    return F.floor(amount * 100 + 0.5) / 100.0


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").otherwise("No")


def numbered(prefix: str, number: Column, width: int) -> Column:
    """Prefix and the number with leading zeros; wider numbers stay whole."""
    return F.format_string(f"{prefix}%0{width}d", number)


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(value, high))


def escape_html(value: Column) -> Column:
    out = value
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(plain), F.lit(safe))
    return out


def number_suffix(value: Column, prefix: str) -> Column:
    """The number after a prefix as long; null where the value has another form."""
    return F.regexp_extract(F.when(value.rlike(f"^{prefix}[0-9]+$"), value), "([0-9]+)$", 1).try_cast("long")


def is_luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def luhn_digit(body: Column) -> Column:
    """The check digit, as text, that makes body followed by it valid: from the right of body, every other digit is doubled, the first one included."""
    reversed_digits = F.split(F.reverse(body), "")
    values = F.transform(reversed_digits, lambda d, i: F.when(i % 2 == 0, F.get(F.array(*[F.lit(sum(divmod(2 * k, 10))) for k in range(10)]), d.cast("int"))).otherwise(d.cast("int")))
    total = F.aggregate(values, F.lit(0), lambda a, v: a + v)
    return ((10 - total % 10) % 10).cast("string")


def uniform(seed: int, tag: str, *key: Column) -> Column:
    """A number in [0, 1) that depends on seed, tag and key alone: 52 bits of an MD5, which any SQL engine gives alike."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *[k.cast("string") for k in key]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / float(1 << 52)


def weighted_choice(u: Column, choices: list[tuple[object, float]]) -> Column:
    """The choice at which cumulated weights pass u (from 0 to 1); weights needn't sum to 1."""
    total, at, out = sum(w for _, w in choices), 0.0, None
    for value, weight in choices[:-1]:
        at += weight
        out = (F if out is None else out).when(u < at / total, value)
    return F.lit(choices[-1][0]) if out is None else out.otherwise(choices[-1][0])


def pick(u: Column, values: list[object]) -> Column:
    """One of the values, each as likely."""
    return F.get(F.array(*map(F.lit, values)), F.floor(u * len(values)).cast("int"))


def sorted_json(columns: list[str]) -> Column:
    """Compact JSON of the columns, in the order of their names."""
    return F.to_json(F.struct(*sorted(columns)))


def is_json(value: Column) -> Column:
    """Whether the text is JSON of any kind; null is not."""
    return F.try_parse_json(value).isNotNull()
