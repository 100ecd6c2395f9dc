"""A ledger of quality rules: each rule is evaluated once, its failure kept as a bit beside the measurements.

The ledger is written to the shared folder, and policies are applied to what is stored. Policies are versioned masks over the bits, so that a changed policy needs no new pass over texts, and ablations (what a policy
would keep without one of its rules) come from counts of the few distinct bit patterns. Only DataFrame functions are used, all of
them within a row: nothing is shuffled, whatever the sources' or copies' sizes.

Repeated windows are found by 64-bit hashes of their words, so a count may be wrong where two windows of one text collide (about n * n / 4e19).
Very long texts are whole; a text's windows are sorted within its row.

Words are stretches without ASCII white space. A null text has none. Empty texts fail the first rule. Equal rows give equal rows;
columns beside doc_id and text are ignored unless keep asks for them; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, whole_text

WORD_SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """A condition, in SQL over the measurements, under which a document fails."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """The rules, by name, whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("upper_case", "2 * n_upper > word_chars"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("long_words", "word_chars > 40 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
)
BASE = Policy("base", ("few_words", "repeated_words"))
POLICIES = {
    p.version: p
    for p in (
        BASE,
        Policy("v1", (*BASE.rules, "symbols", "upper_case", "long_words", "short_words")),
        Policy("strict", tuple(r.name for r in RULES)),
    )
}
CURRENT = "v1"


def _repeat_words() -> Column:
    """Words within three-word windows that are found twice or more, from the windows' hashes in grams.

    Only texts with a repeated window come here. Their (hash, place) pairs are sorted; equal neighbours mark both places; the
    union of the marked windows is the sum of min(3, step to the next place).
    """
    return F.expr("""
        aggregate(zip_with(marked, slice(marked, 2, size(marked)), (p, q) -> least(3, coalesce(q - p, 3))), 0, (a, x) -> a + x)
    """)


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep and n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words (long)."""
    named = {f"keep_{i}": c for i, c in enumerate(keep)}  # columns of docs may have the names of measurements
    df = docs.select(*(F.col(c).alias(n) for n, c in named.items()), whole_text().alias("text"))
    df = df.select(
        *named,
        F.array_remove(F.split("text", WORD_SPLIT), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    df = df.select(
        *named,
        F.size("words").alias("n"),
        F.array_join("words", "").alias("joined"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("lines")).alias("n_distinct_lines"),
    )
    df = df.select(
        *named, "n", "n_lines", "n_distinct_lines",
        F.char_length("joined").alias("word_chars"),
        F.char_length(F.regexp_replace("joined", SYMBOLS, "")).alias("plain_chars"),
        F.char_length(F.regexp_replace("joined", "[A-Z]+", "")).alias("lower_chars"),
        F.expr("""
            if(n < 3, cast(array() as array<bigint>), zip_with(
                zip_with(slice(hashes, 1, n - 2), slice(hashes, 2, n - 2), (a, b) -> xxhash64(a, b)),
                slice(hashes, 3, n - 2), (ab, c) -> xxhash64(ab, c)))
        """).alias("grams"),
    )
    kept = [c for c in df.columns if c != "grams"]
    df = df.select(
        *kept,
        F.expr("if(size(array_distinct(grams)) = size(grams), null, sort_array(transform(grams, (g, i) -> struct(g, i))))").alias("pairs"),
    )
    df = df.select(
        *kept,
        F.expr("""
            if(pairs is null, null, sort_array(array_distinct(flatten(filter(
                zip_with(pairs, slice(pairs, 2, size(pairs)), (a, b) -> if(a.g = b.g, array(a.i, b.i), null)), x -> x is not null)))))
        """).alias("marked"),
    )
    count = lambda c: c.cast("long")
    return df.select(
        *(F.col(n).alias(c) for n, c in named.items()),
        count(F.col("n")).alias("n_words"),
        count(F.col("word_chars")).alias("word_chars"),
        count(F.col("word_chars") - F.col("plain_chars")).alias("n_symbols"),
        count(F.col("word_chars") - F.col("lower_chars")).alias("n_upper"),
        count(F.col("n_lines")).alias("n_lines"),
        count(F.col("n_lines") - F.col("n_distinct_lines")).alias("n_dup_lines"),
        count(F.when(F.col("marked").isNull(), F.lit(0)).otherwise(_repeat_words())).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """measure's columns and failed (long): bit i is 1 if rule i fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs, keep).withColumn("failed", total)


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    places = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << places[name] for name in policy.rules)


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether the row of a ledger passes."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: failing (documents that fail it), alone (that no other rule of the policy rejects), kept_without
    (what the policy would keep without it). Patterns of bits are counted first; at most 2 ** rules rows go on.
    """
    whole = mask(policy, rules)
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    listed = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(rules) if r.name in policy.rules))
    each = patterns.select("bits", "n", F.explode(listed).alias("r"))
    bit, n = F.col("r.bit"), F.col("n")
    without = F.col("bits").bitwiseAND(F.lit(whole).cast("long").bitwiseXOR(bit))
    total = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("bits").bitwiseAND(bit) != 0).alias("failing"),
        total(F.col("bits") == bit).alias("alone"),
        total(without == 0).alias("kept_without"),
    )


def write_ledger(docs: DataFrame) -> DataFrame:
    """The ledger as a stored table: measurements and failure bits, from which any policy's verdicts follow."""
    return materialize(ledger(docs), "ledger")


def sole_rule(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """The rule without which the policy would keep the row; null if there is none."""
    bits = F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("long"))
    out = F.lit(None).cast("string")
    for i, r in enumerate(rules):
        if r.name in policy.rules:
            out = F.when(bits == (1 << i), r.name).otherwise(out)
    return out


def verdicts(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Measurements, bits and verdicts of every document, from a stored ledger: kept by the policy and by the strict one; sole_rule, and of how
    many documents (sole_rule_docs) that rule is the only one against, by the policy's ablation.
    """
    entries = write_ledger(docs)
    base, chosen = passes(BASE), POLICIES[policy]
    lost = F.broadcast(ablations(entries, chosen).select(F.col("rule").alias("_rule"), F.col("alone").alias("sole_rule_docs")))  # a row per rule
    judged = entries.withColumn("sole_rule", sole_rule(chosen))
    return judged.join(lost, F.col("sole_rule") == F.col("_rule"), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), (base & passes(chosen)).alias("kept"), "failed", (base & passes(POLICIES["strict"])).alias("kept_strict"),
        "sole_rule", F.coalesce("sole_rule_docs", F.lit(0)).alias("sole_rule_docs"),
    )


def keep_passing(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that the policy keeps, with all their columns. Null and empty texts go, as they have too few words; rows that repeat stay or go
    alike; an empty table gives an empty table."""
    # the rows travel as one struct, as their columns may have the names of measurements
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    # a column of numbers keeps the filter above the measurements; pushed below, it would repeat them in each of its terms
    entries = ledger(whole, keep=("row",)).select("row", "failed", F.monotonically_increasing_id().alias("number"))
    return entries.where(passes(POLICIES[policy]) & (F.col("number") >= 0)).select("row.*")
