"""Splitting, cutting and rewriting text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Provider of each known e-mail domain.
EMAIL_PROVIDER = {
    "gmail": "google", "att.net": "att", "twc.com": "spectrum", "scranton.edu": "other",
    "optonline.net": "other", "hotmail.co.uk": "microsoft", "comcast.net": "other",
    "yahoo.com.mx": "yahoo", "yahoo.fr": "yahoo", "yahoo.es": "yahoo", "charter.net": "spectrum",
    "live.com": "microsoft", "aim.com": "aol", "hotmail.de": "microsoft",
    "centurylink.net": "centurylink", "gmail.com": "google", "me.com": "apple",
    "earthlink.net": "other", "gmx.de": "other", "web.de": "other", "cfl.rr.com": "other",
    "hotmail.com": "microsoft", "protonmail.com": "other", "hotmail.fr": "microsoft",
    "windstream.net": "other", "outlook.es": "microsoft", "yahoo.co.jp": "yahoo",
    "yahoo.de": "yahoo", "servicios-ta.com": "other", "netzero.net": "other",
    "suddenlink.net": "other", "roadrunner.com": "other", "sc.rr.com": "other",
    "live.fr": "microsoft", "verizon.net": "yahoo", "msn.com": "microsoft",
    "q.com": "centurylink", "prodigy.net.mx": "att", "frontier.com": "yahoo",
    "anonymous.com": "other", "rocketmail.com": "yahoo", "sbcglobal.net": "att",
    "frontiernet.net": "yahoo", "ymail.com": "yahoo", "outlook.com": "microsoft",
    "mail.com": "other", "bellsouth.net": "other", "embarqmail.com": "centurylink",
    "cableone.net": "other", "hotmail.es": "microsoft", "mac.com": "apple",
    "yahoo.co.uk": "yahoo", "netzero.com": "other", "yahoo.com": "yahoo",
    "live.com.mx": "microsoft", "ptd.net": "other", "cox.net": "other", "aol.com": "aol",
    "juno.com": "other", "icloud.com": "apple",
}

# Last domain pieces that count as "us".
US_SUFFIXES = ["gmail", "net", "edu"]

# Device name patterns in order of application, with the maker they mean.
DEVICE_MAKERS = [
    ("SM", "Samsung"), ("SAMSUNG", "Samsung"), ("GT-", "Samsung"),
    ("Moto G", "Motorola"), ("Moto", "Motorola"), ("moto", "Motorola"),
    ("LG-", "LG"), ("rv:", "RV"), ("HUAWEI", "Huawei"), ("ALE-", "Huawei"), ("-L", "Huawei"),
    ("Blade", "ZTE"), ("BLADE", "ZTE"), ("Linux", "Linux"), ("XT", "Sony"),
    ("HTC", "HTC"), ("ASUS", "Asus"),
]


def piece(column: str | Column, separator: str, index: int) -> Column:
    """Piece ``index`` (from 0) of a text cut at a literal separator; null when missing."""
    return F.get(F.split(column, re.escape(separator)), F.lit(index))


def last_piece(column: str | Column, separator: str) -> Column:
    """Last piece of a text cut at a literal separator."""
    return F.element_at(F.split(column, re.escape(separator)), -1)


def first_match(column: Column, rules: list[tuple[str, str]]) -> Column:
    """Replace a text by the value of the first rule whose pattern it contains.

    Matching is case-sensitive; a text no rule matches is kept.
    """
    (pattern, value), *rest = rules
    result = F.when(column.contains(pattern), value)
    for pattern, value in rest:
        result = result.when(column.contains(pattern), value)
    return result.otherwise(column)


def lookup(column: Column, mapping: dict[str, str]) -> Column:
    """Value of ``mapping`` for the column, null for a text it does not hold."""
    pairs = [F.lit(text) for item in mapping.items() for text in item]
    return F.try_element_at(F.create_map(*pairs), column)


def email_provider(column: Column) -> Column:
    """Provider of an e-mail domain; null when unknown or null."""
    return lookup(column, EMAIL_PROVIDER)


def email_suffix(column: Column) -> Column:
    """Last piece of an e-mail domain, with the US endings folded into ``us``."""
    suffix = last_piece(column, ".")
    return F.when(suffix.isin(US_SUFFIXES), "us").otherwise(suffix)
