"""Column helpers for text, addresses and personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.values import col

# What counts as personal data, what replaces it, and a pattern that every match holds.
PII_RULES = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]", "@"),
    (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "[IP]", r"[0-9]\."),
    (r"(\+[0-9]{1,3}[-. ]?)?(\([0-9]{2,4}\) ?|\b[0-9]{2,4}[-. ])[0-9]{3,4}[-. ][0-9]{4}\b", "[PHONE]", r"[-. ][0-9]{4}"),
)

# Spellings accepted as true and as false.
TRUE_WORDS = ["true", "True", "1", "yes", "Y"]
FALSE_WORDS = ["false", "False", "0", "no", "N"]


def email_domain(email: Column | str) -> Column:
    return F.regexp_extract(col(email), "@(.+)", 1)


def to_boolean(text: Column | str) -> Column:
    return F.when(col(text).isin(TRUE_WORDS), True).when(col(text).isin(FALSE_WORDS), False)


def mask_ip(ip: Column | str) -> Column:
    """Hide the last octet; text that is no dotted quad becomes ``anonymized``."""
    octets = F.split(col(ip), r"\.")
    hidden = F.array_join(F.concat(F.slice(octets, 1, 3), F.array(F.lit("xxx"))), ".")
    return F.when(col(ip) != "", F.when(F.size(octets) == 4, hidden).otherwise("anonymized"))


def ip_number(ip: Column | str) -> Column:
    """Dotted quad to a number; null when an octet is missing, no number or above 255."""
    octets = F.transform(F.split(col(ip), r"\."), lambda o: o.try_cast("bigint"))
    valid = (F.size(octets) == 4) & F.forall(octets, lambda o: o.between(0, 255))
    return F.when(valid, F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, o: acc * 256 + o))


def mask_personal_data(text: Column | str) -> Column:
    """Replace e-mail addresses, IP addresses and phone numbers.

    A text without the sign of a rule skips its pattern, which saves most of the work.
    """
    out = col(text)
    for pattern, replacement, sign in PII_RULES:
        masked = F.regexp_replace(out, pattern, replacement)
        out = F.when(out.rlike(sign), masked).otherwise(out)
    return out
