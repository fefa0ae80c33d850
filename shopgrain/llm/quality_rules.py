"""Quality rules as a bitmask ledger.

`ledger` evaluates every rule once for each document and keeps the measurements and
one failure bit per rule. A policy is a versioned mask over these bits: `verdicts`
applies one, `ablations` tells from the same ledger what each rule of a policy costs.
Built-in expressions only; each document is measured by itself, so nothing is shuffled.

Defined cases: null text counts as empty; a text without words has zero in every
measurement and fails `short` alone; repeated rows get the same verdict each; an empty
table gives an empty ledger; further columns of the input, whatever their names, pass
through `filtered` untouched and are not read by `ledger`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARACTERS, whole

#: name -> condition under which a document fails, over the measurements; the place
#: in this list is the bit. Append only: stored ledgers keep their meaning.
RULES = (
    ("short", "n_words < 50"),
    ("repeats", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("dup_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
)
BITS = {name: 1 << place for place, (name, _) in enumerate(RULES)}
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails any of these rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[name] for name in set(self.rules))


BASE = Policy("base-1", ("short", "repeats"))
STANDARD = Policy("standard-1", tuple(BITS))


def measured(docs: DataFrame, text: Column) -> DataFrame:
    """docs with the measurements of `text` in columns of these names.

    Words of three-word windows that occur twice or more are found in two steps: the
    windows' hashes are all different in most texts, and then no window repeats. Other
    texts sort their windows themselves, so that equal ones are neighbours.
    """
    own = {name: f"_quality_{name}" for name in ("text", "words", "lines", "hashes", "windows")}
    text_, words, lines, hashes, windows = own.values()
    space = SPACE_CHARACTERS
    trimmed = F.btrim(F.col(text_), F.lit(space))
    n_words = F.size(words).cast("long")

    df = docs.withColumn(text_, text)
    df = df.withColumns(
        {
            words: F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
                F.split(trimmed, SPACE + "+")
            ),
            lines: F.filter(F.split(text_, "\n"), lambda x: F.btrim(x, F.lit(space)) != ""),
            "n_symbols": F.regexp_count(text_, F.lit(r"[#*$%&|<>]")).cast("long"),
        }
    ).drop(text_)
    df = df.withColumns(
        {
            "n_words": n_words,
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            hashes: F.expr(
                f"""case when size({words}) < 4 then array() else
                transform(sequence(0, size({words}) - 3),
                  i -> xxhash64(get({words}, i), get({words}, i + 1), get({words}, i + 2))) end"""
            ),
        }
    ).drop(lines)
    df = df.withColumn(
        windows,
        F.expr(
            f"""case when size(array_distinct({hashes})) < size({hashes}) then array_sort(
            transform(sequence(0, size({words}) - 3), i -> struct(
              concat_ws(' ', get({words}, i), get({words}, i + 1), get({words}, i + 2)) as w, i as i)))
            end"""
        ),
    ).drop(words, hashes)
    repeated = f"""array_sort(filter(transform({windows}, (x, j) ->
        case when x.w = get({windows}, j - 1).w or x.w = get({windows}, j + 1).w
        then x.i end), p -> p is not null))"""
    covered = f"""aggregate({repeated}, struct(-3 as at, 0 as n),
        (s, p) -> struct(p as at, s.n + least(3, p - s.at) as n), s -> s.n)"""
    df = df.withColumn(
        "n_repeat_words", F.coalesce(F.expr(covered), F.lit(0)).cast("long")
    ).drop(windows)
    # A filter on a measurement must not move below: it would repeat the work of all
    # steps for every element. It cannot pass the explosion of an array of one row.
    one = F.explode(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    return df.select(one.alias("_quality_all")).select("_quality_all.*")


def failure_bits() -> Column:
    """One long with the bits of all rules that the measurements fail."""
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BITS[name])).otherwise(0).cast("long"))
    return bits


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, measurements, `failed` (bits)."""
    df = docs.select(F.col(id_column).alias("_quality_id"), F.col(text_column).alias("_quality_in"))
    df = measured(df, whole("_quality_in")).withColumn("failed", failure_bits())
    return df.select(F.col("_quality_id").alias(id_column), *MEASUREMENTS, "failed")


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) == 0


def verdicts(ledger_: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with `kept` and the policy's version."""
    return ledger_.withColumn("kept", passes(policy)).withColumn(
        "policy", F.lit(policy.version)
    )


def ablations(ledger_: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those it alone rejects.

    `only` is how many documents more would stay without the rule. Documents are first
    counted by their failure bits, so the rules meet at most 2 ** len(RULES) rows.
    """
    by_bits = (
        ledger_.select(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits"))
        .groupBy("bits")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rules = F.array(
        *(F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in policy.rules)
    )
    n_if = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    bit = F.col("r.bit")
    return (
        by_bits.withColumn("r", F.explode(rules))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            n_if(F.col("bits").bitwiseAND(bit) != 0).alias("failed"),
            n_if(F.col("bits") == bit).alias("only"),
            F.sum("n").alias("documents"),
        )
        .withColumn("policy", F.lit(policy.version))
    )


def filtered(docs: DataFrame, policy: Policy = STANDARD, text_column: str = "text") -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_quality_row"))
    df = measured(df, whole(F.col("_quality_row").getField(text_column)))
    return (
        df.withColumn("failed", failure_bits()).where(passes(policy)).select("_quality_row.*")
    )


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op3: base measurements, base verdict, verdict of the policy."""
    df = verdicts(ledger(docs), STANDARD)
    return df.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        "kept",
        "n_lines",
        F.col("failed").alias("failed_bits"),
    )
