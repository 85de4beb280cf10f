"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements and one failure bit per rule. Policies are
sets of rules; ``apply_policy`` and ``ablations`` only do bit arithmetic on the stored ledger, so a new policy version or
an ablation never reads a text again. All of it is built-in column functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import let, steps, text_of, words_of

MEASURES = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper".split()
#: Rules by bit: name and SQL condition over the measurements under which a document fails.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "100 * n_symbols > 10 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("short_words", "word_chars < 3 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_upper > 30 * word_chars"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of the rules that reject."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
FULL = Policy("full", tuple(BIT))


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def repeated_words(words: Column) -> Column:
    """Words that stand in a 3-word window found twice or more in the text.

    Windows are told apart by 64-bit hashes within one text. They are sorted, equal neighbours are repeated windows,
    and the words they cover are counted from the gaps between their sorted starts.
    """
    windows = F.transform(
        steps(F.size(words) - 2),
        lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")),
    )

    def starts(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        twice = F.filter(
            steps(last + 1),
            lambda k: ((k > 0) & (F.get(ordered, k - 1)["h"] == ordered[k]["h"]))
            | ((k < last) & (F.get(ordered, k + 1)["h"] == ordered[k]["h"])),
        )
        return F.sort_array(F.transform(twice, lambda k: ordered[k]["i"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(steps(F.size(at)), lambda k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), at[k] - F.get(at, k - 1))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    return let(let(F.sort_array(windows), starts), covered)


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: ``keep``, the measurements (long) and ``failed`` (long, one bit per rule of ``RULES``).

    A null or empty text has no words and fails ``few_words``. Every row gets its own entry, repeated ones too; columns
    of ``docs`` other than ``keep`` and ``text`` are not looked at.
    """
    text = text_of()
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    rows = docs.select(*(F.col(k) for k in keep), text.alias("__text"))
    text = F.col("__text")
    solid = _without(text, " \t\n\x0b\x0c\r")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    by_words = let(
        words_of(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")),
    )
    by_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    rows = rows.select(
        *keep,
        by_words.alias("__words"),
        by_lines.alias("__lines"),
        F.char_length(solid).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(_without(text, "#*$%&|<>"))).cast("long").alias("n_symbols"),
        (F.char_length(text) - F.char_length(_without(text, capitals))).cast("long").alias("n_upper"),
    )
    rows = rows.select(*keep, "__words.*", "__lines.*", "word_chars", "n_symbols", "n_upper").select(*keep, *MEASURES)
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)]
    return rows.withColumn("failed", sum(bits[1:], bits[0]).cast("long"))


def apply_policy(entries: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    """``entries`` with ``name``: whether no rule of the policy failed."""
    return entries.withColumn(name, F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents it fails, that fail it alone, and that pass if the rule is left out.

    Entries collapse to one row per pattern of failed bits (at most 2 ** rules) before rules are looked at. An empty
    ledger gives no rows.
    """
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in policy.rules)))
    per = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    left = F.col("bits").bitwiseAND(F.lit(policy.mask).bitwiseXOR(F.col("bit")))
    return per.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(left == 0, F.col("n")).otherwise(0)).alias("kept_without"),
    )


def keep_good(docs: DataFrame, policy: Policy = FULL) -> DataFrame:
    """The rows of ``docs`` that pass the policy, with their columns."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    entries = ledger(docs.select(whole.alias("__row"), F.col("text")), ("__row",))
    return apply_policy(entries, policy, "__kept").filter("__kept").select("__row.*")
