"""Quality rules: every rule is evaluated once into a ledger of failure bits and measurements.

Policies are then sets of rules, applied to the ledger with bit operations; changing a policy or
asking what a rule alone removes never reads a text again.

Null and empty texts have no words: all measurements are 0 and ``few_words`` fails. Repeated rows
and ties are measured one by one. An empty table gives an empty ledger. Other columns of the table
are untouched; ``with_ledger`` replaces a column that has the ledger's name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import gram_hashes, split_words, word_hashes

#: The words of a repeated window. Letters and capitals are counted in A-Z and a-z.
REPEAT_WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_echo_words",
    "n_exclaims", "n_letters", "n_upper",
)

_STRUCT = "struct<" + ",".join(f"{name}:bigint" for name in MEASURES) + ">"
_WHITE = " \t\n\r\x0b\x0c"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule by its SQL condition over the measurements; the condition is true where the rule fails."""

    name: str
    fails: str


#: The rules by bit. Bits are never reused: a stored ledger keeps its meaning.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines"),
    Rule("echoed_words", "4 * n_echo_words > n_words"),
    Rule("many_exclamations", "5 * n_exclaims > n_words"),
    Rule("mostly_capitals", "n_letters >= 40 AND 10 * n_upper > 6 * n_letters"),
    Rule("short_words", "10 * word_chars < 20 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
)

#: Policies by version: the names of the rules that reject. A version never changes once it was used.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(rule.name for rule in RULES),
}


def bits_of(names: tuple[str, ...] | list[str]) -> int:
    known = {rule.name: 1 << bit for bit, rule in enumerate(RULES)}
    return sum(known[name] for name in set(names))


def _repeated(hashes: np.ndarray, n: int) -> int:
    """Words that lie in a window of ``n`` words found twice or more in the same text."""
    grams = gram_hashes(hashes, n)
    if len(grams) < 2:
        return 0
    _, which, counts = np.unique(grams, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    words = split_words(text)
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    hashes = word_hashes(words)
    raw = np.frombuffer(text.encode(), np.uint8)
    upper = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
    lower = int(np.count_nonzero((raw >= 97) & (raw <= 122)))
    return (
        len(words),
        len(text) - sum(map(text.count, _WHITE)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        len(lines),
        _repeated(hashes, REPEAT_WINDOW),
        int(np.count_nonzero(hashes[1:] == hashes[:-1])),
        text.count("!"),
        upper + lower,
        upper,
    )


def measurements(text: Column) -> Column:
    """A struct of all measurements of each text."""

    @F.arrow_udf(_STRUCT)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [measure_text(x) for x in texts.to_pylist()]
            columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(len(MEASURES))]
            yield pa.StructArray.from_arrays(columns, list(MEASURES))

    return measure(text)


def with_ledger(docs: DataFrame, text: str = "text", ledger: str = "ledger") -> DataFrame:
    """All rows with a struct: ``failed`` (bit i for rule i of ``RULES``) and the measurements."""
    measured = docs.withColumn(ledger, measurements(F.col(text)))
    names = {name: f"`{ledger}`.{name}" for name in MEASURES}
    failed = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES):
        condition = " ".join(names.get(word, word) for word in rule.fails.split())
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    fields = [F.col(f"`{ledger}`.{name}").alias(name) for name in MEASURES]
    return measured.withColumn(ledger, F.struct(failed.alias("failed"), *fields))


def passes(policy: str, failed: Column) -> Column:
    """True where no rule of the policy failed."""
    return failed.bitwiseAND(F.lit(bits_of(POLICIES[policy])).cast("long")) == 0


def apply_policy(ledger_rows: DataFrame, policy: str, failed: str = "ledger.failed") -> DataFrame:
    """The rows that a policy keeps."""
    return ledger_rows.where(passes(policy, F.col(failed)))


def ablations(ledger_rows: DataFrame, policy: str, failed: str = "ledger.failed") -> DataFrame:
    """For each rule of a policy: rows failing it, rows that it alone rejects, rows kept without it.

    One pass of conditional counts over the failure bits.
    """
    active = bits_of(POLICIES[policy])
    hit = F.col(failed).bitwiseAND(F.lit(active).cast("long"))
    sums = [F.count(F.lit(1)).alias("n"), F.count_if(hit == 0).alias("kept")]
    chosen = [(bit, rule) for bit, rule in enumerate(RULES) if rule.name in POLICIES[policy]]
    for bit, rule in chosen:
        one = F.lit(1 << bit).cast("long")
        sums += [
            F.count_if(hit.bitwiseAND(one) != 0).alias(f"fails_{rule.name}"),
            F.count_if(hit == one).alias(f"only_{rule.name}"),
        ]
    counted = ledger_rows.agg(*sums)
    rows = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"fails_{rule.name}").alias("n_failed"),
            F.col(f"only_{rule.name}").alias("n_failed_alone"),
            (F.col("kept") + F.col(f"only_{rule.name}")).alias("n_kept_without"),
        )
        for _, rule in chosen
    ])
    return counted.select(F.inline(rows))
