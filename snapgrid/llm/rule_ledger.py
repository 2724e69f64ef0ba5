"""Quality rules: every rule is evaluated once per document and kept as one bit beside what it was measured on.

The ledger is a table of documents with their measurements and a long whose bit i says that rule i failed. A
policy is a name, a version and a mask of rules: applying one, changing one or comparing several reads the
narrow ledger, never the texts. Ablations count distinct bit patterns first, at most two to the number of
rules, so what follows is bitwise arithmetic on a handful of rows.

Only DataFrame functions, and no shuffle but the count of patterns. A document is worked on within its row:
word windows that occur twice are neighbours after one sort of their hashes, so very long texts cost
n log n, and texts without repeats are not sorted at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapgrid.llm.frames import fresh_name

#: White space between words: these six characters only.
SPACE = " \t\n\x0b\x0c\r"
BETWEEN = r"[\x20\x09-\x0D]+"
#: Words in a window that counts as repeated.
WINDOW = 5

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_letter_words", "n_letters", "n_capitals",
]

#: Rules in the order of their bits, and the condition under which a document fails. Bits are stored: append only.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "few_letter_words": "100 * n_letter_words < 80 * n_words",
    "capitals": "n_letters >= 40 AND 100 * n_capitals > 50 * n_letters",
}


def mask_of(rules: Sequence[str]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


@dataclass(frozen=True)
class Policy:
    """Documents go that fail more than ``allowed`` of the rules in ``mask``."""

    name: str
    version: int
    mask: int
    allowed: int = 0

    @property
    def label(self) -> str:
        return f"{self.name}-v{self.version}"

    def keeps(self, bits: Column) -> Column:
        return F.bit_count(bits.bitwiseAND(F.lit(self.mask).cast("long"))) <= self.allowed


BASE = Policy("base", 1, mask_of(["few_words", "repeated_windows"]))
POLICIES = [
    BASE,
    Policy("web", 1, mask_of(["few_words", "repeated_windows", "symbols", "repeated_lines"])),
    Policy("web", 2, mask_of(list(RULES))),
    Policy("lenient", 1, mask_of(list(RULES)), allowed=1),
]


def latest(name: str, policies: Sequence[Policy] = tuple(POLICIES)) -> Policy:
    """The newest version of a policy."""
    return max((p for p in policies if p.name == name), key=lambda p: p.version)


def _window_hash(hashed) -> Column:
    """One hash of each window's words, in order; fewer words than a window give none."""
    places = F.sequence(F.lit(0), F.size("_words") - WINDOW)
    hashes = F.transform(places, lambda i: hashed(*[F.get("_words", i + k) for k in range(WINDOW)]))
    return F.when(F.size("_words") >= WINDOW, hashes)


def _measured(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the measurements. What several expressions read is a column of its own first."""
    held = [F.col(f"`{c}`") for c in keep]
    stripped = F.btrim("_text", F.lit(SPACE))
    words = F.when(F.length(stripped) > 0, F.split(stripped, BETWEEN)).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0)

    def only(kind: str) -> Column:
        """How many characters remain when all others are taken away."""
        return F.length(F.regexp_replace("_text", f"[^{kind}]+", "")).cast("long")

    spread = rows.select(*held, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    spread = spread.select(
        *held,
        words.alias("_words"),
        lines.alias("_lines"),
        only("#*$%&|<>").alias("n_symbols"),
        only(r"\p{L}").alias("n_letters"),
        only(r"\p{Lu}").alias("n_capitals"),
    )
    counts = spread.select(
        *held, "_words", "n_symbols", "n_letters", "n_capitals",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        _window_hash(F.xxhash64).alias("_hashes"),
    )
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    # A second hash beside the first: 96 bits, and the place of the window.
    second = F.transform(
        "_hashes", lambda h, i: F.struct(h.alias("h"), F.hash(*[F.get("_words", i + k) for k in range(WINDOW)]).alias("g"), i.alias("i"))
    )
    names = [c for c in counts.columns if c not in ("_words", "_hashes", *keep)]
    ordered = counts.select(*held, *names, F.when(some, F.sort_array(second)).alias("_sorted"))

    def same(p: Column, at: Column) -> Column:
        other = F.get("_sorted", at)
        return F.coalesce((p["h"] == other["h"]) & (p["g"] == other["g"]), F.lit(False))

    twice = F.filter("_sorted", lambda p, k: same(p, k - 1) | same(p, k + 1))
    starts = F.sort_array(F.transform(twice, lambda p: p["i"].cast("long")))
    nothing = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).cast("long").alias("end"))

    def cover(done: Column, start: Column) -> Column:
        fresh = WINDOW - F.greatest(F.lit(0).cast("long"), done["end"] - start)
        return F.struct((done["covered"] + fresh).alias("covered"), (start + WINDOW).alias("end"))

    repeated = F.coalesce(F.aggregate(starts, nothing, cover, lambda done: done["covered"]), F.lit(0).cast("long"))
    return ordered.select(*held, *names, repeated.alias("n_repeat_words")).select(*held, *MEASURES)


def ledger(documents: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of the documents and a struct: the measurements and ``bits``, the rules that failed.

    Returns the rows and the struct's name, ``ledger``, with underscores appended if a column has it. Null texts
    are empty: no words, so ``few_words`` fails; white space alone too. Every row is measured by itself, so repeated
    rows and ids, ties and nulls elsewhere change nothing, and an empty table gives an empty one. Texts may be of
    any length; lines compare with all their white space; a repeated window is told by two hashes, 96 bits.
    """
    name = fresh_name("ledger", documents.columns)
    kept = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    # The generator keeps a reader's filter on the ledger above it: pushed below, Spark would replace every column
    # by its definition and measure a text again for each place that reads it.
    once = F.explode(F.array(F.struct(*MEASURES, bits.alias("bits")))).alias("_ledger")
    return _measured(kept, "_text", ["_row"]).select("_row", once).select("_row.*", F.col("_ledger").alias(name)), name


def verdicts(rows: DataFrame, bits: Column, policies: Sequence[Policy]) -> DataFrame:
    """The rows with one boolean for each policy, named by its label: whether it keeps the row."""
    return rows.select("*", *[policy.keeps(bits).alias(policy.label) for policy in policies])


def ablation(rows: DataFrame, bits: Column, policies: Sequence[Policy]) -> DataFrame:
    """What each rule of each policy does: one row (policy, rule) with counts of documents.

    ``documents``, ``rejected`` by the policy, ``failed`` the rule, ``sole``: rejected, and the rule is the only one
    of the policy that failed, ``kept_without``: rejected now, kept if the rule were taken out. Bit patterns are
    counted first. No documents give no rows.
    """
    patterns = rows.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    cells = [
        F.struct(
            F.lit(p.label).alias("policy"), F.lit(rule).alias("rule"), F.lit(i).alias("i"), F.lit(p.mask).cast("long").alias("mask"),
            F.lit(1 << i).cast("long").alias("bit"), F.lit(p.allowed).alias("allowed"),
        )
        for p in policies for i, rule in enumerate(RULES) if p.mask >> i & 1
    ]
    each = patterns.select("bits", "n", F.inline(F.array(*cells)))
    failed = F.col("bits").bitwiseAND(F.col("mask"))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    rejected = F.bit_count(failed) > F.col("allowed")

    def total(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(column)

    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("documents"),
        total(rejected, "rejected"),
        total(hit, "failed"),
        total(rejected & (failed == F.col("bit")), "sole"),
        total(rejected & hit & (F.bit_count(failed) - 1 <= F.col("allowed")), "kept_without"),
    )


def group_patterns(rows: DataFrame, bits: Column, by: str) -> DataFrame:
    """For each group: its documents, the rules any of them fails and those all of them fail, as masks.

    A null group is a group. Combines on the map side, so a hot group is no hot task.
    """
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("documents"), F.bit_or(bits).alias("any_failed"), F.bit_and(bits).alias("all_failed")
    )
