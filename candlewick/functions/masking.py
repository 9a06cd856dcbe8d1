"""Masking of personal data as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.functions.scalar import as_column, bands

HIDDEN = "****"


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _words(text: Column) -> Column:
    """Words between any white space, also beyond ASCII."""
    return F.split(_stripped(text), r"(?U)\s+")


def valid_email(email: Column | str) -> Column:
    """Exactly one ``@`` with something before it."""
    parts = F.split(as_column(email), "@", -1)
    return (F.size(parts) == 2) & (F.length(parts[0]) > 0)


def mask_email(email: Column | str) -> Column:
    """Keeps the domain and the ends of the local part; null where there is no valid address."""
    parts = F.split(as_column(email), "@", -1)
    local, domain = parts[0], parts[1]
    tail = F.when(F.length(local) > 2, F.right(local, F.lit(1))).otherwise(F.lit(""))
    hidden = F.concat(F.left(local, F.lit(1)), F.lit(HIDDEN), tail, F.lit("@"), domain)
    return F.when(valid_email(email), hidden)


def mask_name(name: Column | str) -> Column:
    """First word and the initial of the last; a single word stays as it is."""
    c = as_column(name)
    words = _words(c)
    initial = F.left(F.element_at(words, -1), F.lit(1))
    return F.when(F.size(words) > 1, F.concat(words[0], F.lit(" "), initial, F.lit("***"))).otherwise(c)


def mask_phone(phone: Column | str) -> Column:
    c = as_column(phone)
    return F.concat(F.left(c, F.lit(3)), F.lit(HIDDEN), F.right(c, F.lit(3)))


def mask_address(address: Column | str) -> Column:
    """Hides the middle of the street; what follows the first comma is kept with its spaces."""
    parts = F.split(as_column(address), ",", -1)
    street = _stripped(parts[0])
    words = _words(street)
    hidden = F.when(
        F.size(words) >= 2, F.concat(words[0], F.lit(" ***** "), F.element_at(words, -1))
    ).otherwise(street)
    rest = F.array_join(F.slice(parts, F.lit(2), F.size(parts)), ", ")
    return F.when(F.size(parts) > 1, F.concat(hidden, F.lit(", "), rest)).otherwise(hidden)


def generalize(amount: Column | str, steps: Iterable[tuple[float, str]], below: str) -> Column:
    """Amount to a band label."""
    return bands(amount, steps, below)


def hash_pii(value: Column | str, salt: str) -> Column:
    """Salted SHA-256 in hex: equal inputs stay joinable, the input cannot be read back."""
    return F.sha2(F.concat(F.lit(salt), as_column(value).cast("string")), 256)
