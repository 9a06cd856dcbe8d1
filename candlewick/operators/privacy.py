"""Masking of a whole table, driven by a policy."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import masking
from candlewick.schemas import AMOUNT_BANDS, AMOUNT_BELOW


@dataclass(frozen=True)
class Rule:
    """``apply`` computes the masked value; ``rename`` stores it under a new name and drops the raw one.

    ``method`` names the rule in the record of a run."""

    apply: Callable[[str], Column]
    rename: str | None = None
    method: str = "mask"


def banded(column_name: str, steps=AMOUNT_BANDS, below: str = AMOUNT_BELOW) -> Rule:
    return Rule(lambda c: masking.generalize(c, steps, below), column_name, "bands")


def hashed(salt: str) -> Rule:
    return Rule(lambda c: masking.hash_pii(c, salt), method="salted hash")


TRADER_POLICY: Mapping[str, Rule] = {
    "email": Rule(masking.mask_email, method="partial mask"),
    "nama_lengkap": Rule(masking.mask_name, method="partial mask"),
    "no_telepon": Rule(masking.mask_phone, method="partial mask"),
    "alamat": Rule(masking.mask_address, method="generalized"),
    "saldo_investasi": banded("saldo_investasi_kategori"),
}


def mask_table(df: DataFrame, policy: Mapping[str, Rule] = TRADER_POLICY) -> DataFrame:
    """Applies every rule in one projection. A column the policy names must exist."""
    missing = [c for c in policy if c not in df.columns]
    if missing:
        raise ValueError(f"columns to mask are missing: {', '.join(missing)}")
    out = []
    for c in df.columns:
        rule = policy.get(c)
        out.append(df[c] if rule is None else rule.apply(c).alias(rule.rename or c))
    return df.select(*out)


def masking_record(
    df: DataFrame, policy: Mapping[str, Rule] = TRADER_POLICY, original_file: str = "", masked_file: str = ""
) -> DataFrame:
    """One document on a masking run: files, rows, and for each field its method, what it became, how many
    values it had, and how many of them the rule changed. Counted in one pass."""
    def field(name: str, rule: Rule) -> Column:
        raw, masked = F.col(name), rule.apply(name)
        changed = raw.isNotNull() & ~raw.cast("string").eqNullSafe(masked.cast("string"))
        return F.struct(
            F.lit(name).alias("field"), F.lit(rule.method).alias("method"), F.lit(rule.rename or name).alias("stored_as"),
            F.count(raw).alias("n_values"), F.count_if(changed).alias("n_changed"),
        )

    return df.agg(
        F.lit(original_file).alias("original_file"), F.lit(masked_file).alias("masked_file"),
        F.count(F.lit(1)).alias("n_rows"), F.array(*[field(n, r) for n, r in policy.items()]).alias("fields_masked"),
    )
