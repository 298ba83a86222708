"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger stores the measurements and one
failure bit per rule; policies are versioned masks over those bits, so a changed policy or an
ablation reads the ledger and never the texts again. Only DataFrame functions are used.

Defined results: a null text has no words; an empty table gives an empty ledger; repeated rows
each get their own ledger row; other columns of the input are ignored (:func:`kept` passes them through).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, numbered, pick, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: (name, SQL condition under which a document fails); the position is the bit.
#: Integer arithmetic only, so every engine decides alike.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("shouting", "10 * n_exclaims > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a document is kept if it fails none of ``rules``."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
        return sum(bits[r] for r in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
CURRENT = Policy("2", tuple(name for name, _ in RULES))


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _measured(table: DataFrame, text: str, carried: list[str]) -> DataFrame:
    """The carried columns and the measurements; every step is a projection of one row."""
    base = table.select(*carried, F.coalesce(F.col(text), F.lit("")).alias("t"))
    split = base.select(*carried, "t", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("hw"))
    hw = F.col("hw")
    grams = split.select(
        *carried,
        F.size("hw").cast("long").alias("n_words"),
        _count_of(F.col("t"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("t"), "!").alias("n_exclaims"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.when(
            F.size("hw") >= WINDOW,
            F.transform(
                F.slice("hw", F.lit(1), F.greatest(F.size("hw") - (WINDOW - 1), F.lit(0))),
                lambda h, i: F.xxhash64(h, *(F.get(hw, i + k) for k in range(1, WINDOW))),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("grams"),
    )
    counted = grams.select(
        *carried,
        "n_words",
        "n_symbols",
        "n_exclaims",
        "word_chars",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # equal windows side by side; texts without a repeated window, most of them, skip the sort
        F.when(
            F.size(F.array_distinct("grams")) < F.size("grams"),
            F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
        ).alias("pairs"),
    )
    numbers = [c for c in counted.columns if c != "pairs"]
    pairs = F.col("pairs")
    repeated = F.transform(
        pairs,
        lambda p, k: F.when((p["g"] == F.get(pairs, k - 1)["g"]) | (p["g"] == F.get(pairs, k + 1)["g"]), p["i"]),
    )
    # a column of its own at each step: an expression inside a lambda is evaluated for every element
    found = counted.select(*numbers, F.array_sort(F.filter(repeated, lambda i: i.isNotNull())).alias("at"))
    # in order, each position covers WINDOW words less the overlap with the next
    covered = F.aggregate(
        F.transform(
            "at",
            lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - x, F.lit(WINDOW))),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return found.select(
        *carried,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        "n_exclaims",
        "n_lines",
    )


def _fail_bits() -> Column:
    none = F.lit(0).cast("long")
    return sum((F.when(F.expr(sql), F.lit(1 << i).cast("long")).otherwise(none) for i, (_, sql) in enumerate(RULES)), none)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements the rules read, one row per document.

    Window digests are 64-bit hashes of five word hashes, compared within one text only.
    """
    return _measured(pick(docs, "doc_id", "text"), "text", ["doc_id"])


def ledger(docs: DataFrame) -> DataFrame:
    """:func:`measure` with ``fail_bits``: bit i is set if rule i of ``RULES`` fails."""
    return measure(docs).withColumn("fail_bits", _fail_bits())


def kept(docs: DataFrame, policy: Policy) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns and without a shuffle."""
    table, name = numbered(docs)
    entries = _measured(table, name["text"], list(table.columns)).withColumn("fail_bits", _fail_bits())
    # a filter would be pushed below the measurements and copy their expressions into itself; one
    # on the output of a generator stays where it is
    held = entries.select(*table.columns, F.explode_outer(F.array(passes(policy))).alias("keep"))
    return held.filter("keep").select(*table.columns).toDF(*docs.columns)


def passes(policy: Policy, bits: Column | None = None) -> Column:
    """Whether a document is kept under a policy; reads ``fail_bits``."""
    return (F.col("fail_bits") if bits is None else bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = (BASE, CURRENT)) -> DataFrame:
    """What each rule does under each policy, by bitwise aggregation over ``fail_bits``.

    Documents are first counted by their bits (at most 2^rules groups, combined before the
    shuffle); everything else runs on those few rows. Columns: policy, rule, n_failed (fail the
    rule), n_only (rejected by it alone: what dropping the rule would give back), n_rejected
    (by the policy).
    """
    spectrum = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rows = F.explode(
        F.array(*(
            F.struct(F.lit(p.version).alias("policy"), F.lit(p.mask).cast("long").alias("mask"), F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
            for p in policies
            for i, (name, _) in enumerate(RULES)
            if name in p.rules
        ))
    ).alias("r")
    failed = F.col("fail_bits").bitwiseAND(F.col("r.mask"))
    n = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0).cast("long")))
    return (
        spectrum.select("fail_bits", "n", rows)
        .groupBy(F.col("r.policy").alias("policy"), F.col("r.rule").alias("rule"))
        .agg(
            n(failed.bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
            n(failed == F.col("r.bit")).alias("n_only"),
            n(failed != 0).alias("n_rejected"),
        )
    )
