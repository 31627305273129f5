"""Guards before and after a model, deny lists and chains of checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safety
from tidemark.functions.text import stripped

Check = Callable[[Column], tuple[Column, Column]]


def guard_input(
    df: DataFrame, max_chars: int = 4000, block_injection: bool = True, block_on_pii: bool = False, text: str = "text"
) -> DataFrame:
    """Add `guard`: struct<allowed, text, user_message, actions>."""
    raw = F.coalesce(stripped(F.col(text)), F.lit(""))
    fits = (F.col("_raw") != "") & (F.length("_raw") <= max_chars)
    clean = fits & (F.size("_hits") == 0) if block_injection else fits
    staged = (
        df.withColumn("_raw", raw)
        .withColumn("_hits", F.when(fits, safety.detect_injection(F.col("_raw"))))
        .withColumn("_pii", F.when(clean, safety.redact_pii(F.col("_raw"))))
    )

    def result(allowed: bool, out: Column, message: Column, actions: Column) -> Column:
        return F.struct(
            F.lit(allowed).alias("allowed"), out.alias("text"), message.alias("user_message"), actions.alias("actions"))

    none = F.array().cast("array<string>")
    source, masked, found = F.col("_raw"), F.col("_pii.text"), F.col("_pii.actions")
    too_long = F.concat(
        F.lit("Mensagem muito longa ("), F.length(source), F.lit(f" caracteres). Limite: {max_chars}. Resuma a pergunta."))
    guard = F.when(source == "", result(False, F.lit(""), F.lit(safety.EMPTY_MESSAGE), none)).when(
        F.length(source) > max_chars, result(False, source, too_long, F.array(F.lit("blocked_length"))))
    if block_injection:
        guard = guard.when(
            F.size("_hits") > 0,
            result(False, source, F.lit(safety.INJECTION_MESSAGE), F.concat(F.array(F.lit("blocked_injection")), "_hits")))
    if block_on_pii:
        guard = guard.when(
            F.size(found) > 0,
            result(False, masked, F.lit(safety.PII_MESSAGE), F.concat(F.array(F.lit("blocked_pii")), found)))
    passed = F.when(masked != source, F.concat(found, F.array(F.lit("input_redacted")))).otherwise(found)
    return staged.withColumn("guard", guard.otherwise(result(True, masked, F.lit(""), passed))).drop("_raw", "_pii", "_hits")


def guard_output(
    df: DataFrame, allowlist: Sequence[str] | None = None, append_disclaimer: bool = True, text: str = "text"
) -> DataFrame:
    """Mask personal data, strip links outside the list, add the disclaimer once."""
    staged = df.withColumn("_raw", F.coalesce(stripped(F.col(text)), F.lit(""))).withColumn(
        "_pii", safety.redact_pii(F.col("_raw")))
    out, actions = F.col("_pii.text"), F.col("_pii.actions")
    if allowlist is not None:
        staged = staged.withColumn("_links", safety.sanitize_links(out, allowlist))
        out, actions = F.col("_links.text"), F.concat(actions, F.col("_links.actions"))
    if append_disclaimer:
        missing = ~out.contains(safety.DISCLAIMER.strip())
        actions = F.when(missing, F.concat(actions, F.array(F.lit("disclaimer_appended")))).otherwise(actions)
        out = F.when(missing, F.concat(out, F.lit(safety.DISCLAIMER))).otherwise(out)
    empty = F.col("_raw") == ""
    guard = F.struct(
        F.lit(True).alias("allowed"),
        F.when(empty, F.lit("")).otherwise(out).alias("text"),
        F.lit("").alias("user_message"),
        F.when(empty, F.array().cast("array<string>")).otherwise(actions).alias("actions"),
    )
    return staged.withColumn("guard", guard).drop("_raw", "_pii", "_links")


def deny_list(df: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """Add `violation`: whether the text contains a denied term."""
    return df.withColumn("violation", safety.holds_any(F.col(text), terms))


def deny_check(terms: Sequence[str], message: str) -> Check:
    return lambda text: (text, F.when(safety.holds_any(text, terms), F.lit(message)))


def redact_check() -> Check:
    return lambda text: (safety.redact_pii(text)["text"], F.lit(None).cast("string"))


def moderation_chain(df: DataFrame, checks: Sequence[Check], text: str = "text") -> DataFrame:
    """Run checks in order; each may rewrite the text, the first violation stops the chain."""
    staged = df.withColumns({"checked_text": F.col(text), "violation": F.lit(None).cast("string")})
    for check in checks:
        rewritten, violation = check(F.col("checked_text"))
        open_row = F.col("violation").isNull()
        staged = staged.withColumns({
            "violation": F.when(open_row, violation).otherwise(F.col("violation")),
            "checked_text": F.when(open_row & violation.isNull(), rewritten).otherwise(F.col("checked_text")),
        })
    return staged
