"""Quality rules kept as a ledger of failure bits, and versioned policies over the ledger.

Every rule is evaluated once a document and stored as one bit beside its measurements. A
policy is a mask over the bits, so a new version, or leaving a rule out, needs no text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, which characters are symbols, the window in words.
SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_adjacent_repeats",
    "n_capitals",
)

# Tests over the measurements that are true of a failing document, in the order of their bits.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
    "stuttering": "10 * n_adjacent_repeats > 3 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}
BIT = {rule: 1 << k for k, rule in enumerate(RULES)}


def mask(*rules: str) -> int:
    return sum(BIT[rule] for rule in rules)


BASE = mask("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """Documents failing more than ``allowed`` rules of the mask go; the base rules always hold."""

    version: int
    rules: int
    allowed: int = 0

    def keeps(self, bits: Column) -> Column:
        failed = F.bit_count(bits.bitwiseAND(F.lit(self.rules)))
        return (bits.bitwiseAND(F.lit(BASE)) == 0) & (failed <= self.allowed)

    def without(self, rule: str) -> Policy:
        return Policy(self.version, self.rules & ~BIT[rule], self.allowed)


POLICIES = {
    1: Policy(1, mask("few_words", "repeated_windows", "symbols", "repeated_lines")),
    2: Policy(2, mask(*RULES)),
}
CURRENT = 2


def _without(text: Column, characters: str) -> Column:
    """Bytes the text loses without these ASCII characters."""
    lost = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in characters)
    return reduce(Column.__add__, lost)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the measurements of every whole text; null counts as empty.

    Windows are compared by 64-bit hashes within one text. ``keep`` must not hold the name
    of a measurement.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words, lines = F.col("cw_words"), F.col("cw_lines")
    split = docs.select(
        *(F.col(f"`{name}`") for name in keep),
        text.alias("cw_text"),
        F.array_remove(F.split(text, f"[{SPACES}]+"), "").alias("cw_words"),
        F.filter(
            F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != F.lit("")
        ).alias("cw_lines"),
    )
    n = F.size(words)
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda k: F.xxhash64(F.slice(words, k, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        *(F.col(f"`{name}`") for name in keep),
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _without(F.col("cw_text"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(words, lambda w, k: (k > 0) & (w == F.get(words, k - 1))))
        .cast("long")
        .alias("n_adjacent_repeats"),
        F.char_length(F.regexp_replace(F.col("cw_text"), "[^A-Z]+", ""))
        .cast("long")
        .alias("n_capitals"),
        windows.alias("cw_windows"),
    )
    # Windows sorted by hash, only where some repeat: equal ones then stand side by side.
    hashed, sorted_windows, starts = F.col("cw_windows"), F.col("cw_sorted"), F.col("cw_starts")
    nothing = F.array().cast("array<struct<h:bigint,k:int>>")
    in_order = counted.withColumn(
        "cw_sorted",
        F.when(
            F.size(F.array_distinct(hashed)) < F.size(hashed),
            F.array_sort(F.transform(hashed, lambda h, k: F.struct(h.alias("h"), k.alias("k")))),
        ).otherwise(nothing),
    ).drop("cw_windows")
    same = F.transform(
        sorted_windows,
        lambda x, k: F.when(
            ((k > 0) & (F.get(sorted_windows, k - 1)["h"] == x["h"]))
            | (F.coalesce(F.get(sorted_windows, k + 1)["h"] == x["h"], F.lit(False))),
            x["k"],
        ),
    )
    found = in_order.withColumn("cw_starts", F.array_sort(F.array_compact(same))).drop("cw_sorted")
    # The words covered by windows that start at these places, in ascending order.
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")),
        lambda at, k: F.struct(
            (at["sum"] + k + WINDOW - F.greatest(k, at["end"])).alias("sum"),
            (k + WINDOW).alias("end"),
        ),
        lambda at: at["sum"].cast("long"),
    )
    return found.withColumn("n_repeat_words", covered).select(
        *(F.col(f"`{name}`") for name in keep), *MEASURES
    )


def ledger(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Measurements and ``fail_bits``, one bit a rule, of every document."""
    bits = reduce(
        Column.bitwiseOR,
        (F.when(F.expr(test), F.lit(BIT[rule])).otherwise(0) for rule, test in RULES.items()),
    )
    return measured(docs, keep).withColumn("fail_bits", bits.cast("long"))


def with_verdict(ledger: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """Add ``base_failed`` and ``kept`` under a policy."""
    bits = F.col("fail_bits")
    return ledger.withColumn("base_failed", bits.bitwiseAND(F.lit(BASE)) != 0).withColumn(
        "kept", policy.keeps(bits)
    )


def ablations(ledger: DataFrame, policies: list[Policy]) -> DataFrame:
    """What every policy keeps, whole and with each of its rules left out.

    ``version, rule, kept_docs, kept_words``; the rule is null for the whole policy. The
    ledger is first reduced to one row for each pattern of bits.
    """
    patterns = ledger.groupBy("fail_bits").agg(
        F.count("*").alias("docs"), F.sum("n_words").alias("words")
    )
    tried = []
    for policy in policies:
        tried.append((policy, None))
        tried += [(policy.without(rule), rule) for rule in RULES if policy.rules & BIT[rule]]
    trial = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(policy.version).alias("version"),
                    F.lit(rule).cast("string").alias("rule"),
                    (
                        policy.keeps(F.col("fail_bits"))
                        if rule is None or not BIT[rule] & BASE
                        else _failing_at_most(policy, rule)
                    ).alias("keeps"),
                )
                for policy, rule in tried
            )
        )
    )
    kept = F.col("trial.keeps")
    return (
        patterns.select("docs", "words", trial.alias("trial"))
        .groupBy("trial.version", "trial.rule")
        .agg(
            F.coalesce(F.sum(F.when(kept, F.col("docs"))), F.lit(0)).alias("kept_docs"),
            F.coalesce(F.sum(F.when(kept, F.col("words"))), F.lit(0)).alias("kept_words"),
        )
    )


def _failing_at_most(policy: Policy, rule: str) -> Column:
    """The test of a policy with one of the base rules left out."""
    bits = F.col("fail_bits")
    base = bits.bitwiseAND(F.lit(BASE & ~BIT[rule])) == 0
    return base & (F.bit_count(bits.bitwiseAND(F.lit(policy.rules))) <= policy.allowed)


def rule_ledger(docs: DataFrame) -> DataFrame:
    """Measurements, failure bits and the verdict of the current policy for every row.

    Null and empty texts have no words and fail. Repeated rows are judged alike; a null id
    is kept; no rows give no rows. Other columns are ignored.
    """
    return with_verdict(ledger(docs, ["doc_id"])).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_adjacent_repeats",
        "n_capitals",
        "fail_bits",
    )
