"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements
and one bit per failed rule.  A policy is a named, versioned set of rules: it is
applied, and its ablations are computed, with bitwise operations on the stored
bits, without touching a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, quoted, text_of

# Rules in bit order: name -> SQL condition over the measurements that marks a failure.
# Bits are never reused; a changed rule gets a new name and bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines",
    "short_words": "2 * word_chars < 3 * n_words",
    "long_words": "word_chars > 25 * n_words",
}

# Versioned policies: a document is kept when it fails none of the rules.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "web-1": tuple(RULES),
}

# Words in a window; a window found twice marks all its words as repeated
WINDOW = 8

_JAVA_SPACES = SPACES.replace("\\", "\\\\")

# Positions (of words) whose window occurs more than once, by sorting (hash, position)
# and comparing neighbours; then the length of the union of those windows.
_COVERED = f"""
transform(array(sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i)))), s ->
  aggregate(
    sort_array(transform(
      filter(s, (e, k) -> (k > 0 AND s[k - 1].x = e.x) OR (k < size(s) - 1 AND s[k + 1].x = e.x)),
      e -> e.i)),
    named_struct('n', 0, 'seen', 0),
    (a, p) -> named_struct('n', a.n + p + {WINDOW} - greatest(p, a.seen), 'seen', p + {WINDOW}),
    a -> a.n))[0]
"""

# Each array is bound to a lambda variable, so that it is built once for a text.
_MEASURE = f"""
transform(array(array_remove(split(_t, '{_JAVA_SPACES}', -1), '')), w -> named_struct(
  'n_words', CAST(size(w) AS BIGINT),
  'word_chars', CAST(char_length(array_join(w, '')) AS BIGINT),
  'n_repeat_words', CAST(transform(
      array(CASE WHEN size(w) < {WINDOW} THEN array()
                 ELSE transform(sequence(1, size(w) - {WINDOW} + 1), i -> xxhash64(slice(w, i, {WINDOW}))) END),
      h -> CASE WHEN size(array_distinct(h)) = size(h) THEN 0 ELSE {_COVERED} END)[0] AS BIGINT)))[0]
"""

_LINES = r"""
transform(array(filter(split(_t, '\n', -1), l -> l RLIKE '[^\\x20\\x09-\\x0D]')), l -> named_struct(
  'n_lines', CAST(size(l) AS BIGINT),
  'n_dup_lines', CAST(size(l) - size(array_distinct(l)) AS BIGINT)))[0]
"""

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(r) for r in POLICIES[policy])


def rule_ledger(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                carry: list[str] | None = None) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits``, one row per input row.

    Words are runs of non-space characters (space, tab to carriage return).
    8-word windows are told apart by a 64-bit hash within one document.
    ``carry`` keeps the named input columns beside them, by number (for a filter).

    Defined cases: a null text has no word and no line; repeated rows are
    measured each; an empty table gives an empty result; other input columns
    are ignored, whatever their names.
    """
    kept = [F.col(quoted(c)).alias(f"_in_{k}") for k, c in enumerate(carry or [])]
    base = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"), *kept)
    names = [c for c in base.columns if c.startswith("_in_")]
    measured = base.select(
        "_id", *names, F.expr(_MEASURE).alias("_m"), F.expr(_LINES).alias("_l"),
        F.char_length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    flat = measured.select(F.col("_id").alias("doc_id"), *names, F.col("_m.n_words"), F.col("_m.word_chars"),
                           "n_symbols", F.col("_l.n_lines"), F.col("_l.n_dup_lines"), F.col("_m.n_repeat_words"))
    bits = " | ".join(f"CASE WHEN {cond} THEN {bit(rule)}L ELSE 0L END" for rule, cond in RULES.items())
    return flat.withColumn("fail_bits", F.expr(bits))


def passes(policy: str, bits: Column | str = "fail_bits") -> Column:
    """Verdict of a policy on stored failure bits."""
    b = F.col(bits) if isinstance(bits, str) else bits
    return b.bitwiseAND(F.lit(mask(policy))) == 0


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does: ``rule, failed, only_failed, kept_without``.

    ``failed``: documents that fail the rule; ``only_failed``: that fail no other
    rule of the policy; ``kept_without``: documents kept if the rule were left out.
    One pass groups the ledger by the policy's bits (at most 2^rules groups).
    """
    groups = (ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("_b"))
              .agg(F.count(F.lit(1)).alias("_n")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    one = groups.select("_b", "_n", F.explode(rules).alias("_r"))
    hit, n = F.col("_b").bitwiseAND(F.col("_r.bit")) != 0, F.col("_n")
    return (one.groupBy(F.col("_r.rule").alias("rule"))
            .agg(F.coalesce(F.sum(F.when(hit, n)), F.lit(0)).alias("failed"),
                 F.coalesce(F.sum(F.when(F.col("_b") == F.col("_r.bit"), n)), F.lit(0)).alias("only_failed"),
                 F.coalesce(F.sum(F.when((F.col("_b") == 0) | (F.col("_b") == F.col("_r.bit")), n)), F.lit(0))
                 .alias("kept_without")))


def filter_quality(docs: DataFrame, policy: str = "web-1", *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with their columns unchanged.

    Defined cases: a null or empty text has no word and fails every policy with
    ``few_words``; a very long text is measured whole; rows that repeat are kept or
    dropped alike; an empty table gives an empty result; columns may have any
    names, with dots too.
    """
    ledger = rule_ledger(docs, id_col=id_col, text_col=text_col, carry=docs.columns)
    return ledger.filter(passes(policy)).select(*[F.col(f"_in_{k}").alias(c) for k, c in enumerate(docs.columns)])
