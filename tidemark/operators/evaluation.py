"""Rule evaluators, rollups, token cost and regression against a baseline.

Outputs: run_id, output, error (empty or null when fine), metrics (JSON object).
Rules: id, name, type (text, json, numeric), measure, operator, value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import jsons, text
from tidemark.operators.joins import price_lookup
from tidemark.operators.ordering import number_rows
from tidemark.sources.files import CSV

RULES_AT_ONCE = 500  # expressions of one projection; more rules read the outputs once more for each such block
_RULE = ("id", "name", "type", "measure", "operator", "value")


# ---- rules -----------------------------------------------------------------------------------

def _rules(rules: DataFrame | Sequence[dict]) -> list[dict]:
    """Rules become column expressions, so a rule table is read to the driver."""
    if isinstance(rules, DataFrame):
        rules = [row.asDict() for row in rules.collect()]
    return [{name: rule.get(name) for name in _RULE} for rule in rules]


def _verdict(passed: Column) -> Column:
    return F.when(F.coalesce(passed, F.lit(False)), "Pass").otherwise("Fail")


def _text_rule(answer: Column, rule: dict, fixed: bool) -> Column:
    if rule["value"] is None:
        return F.lit("Error")
    value = rule["value"].lower().strip()
    held = [answer.contains(part.strip()) for part in value.split(",")]
    some, every = held[0], held[0]
    for one in held[1:]:
        some, every = some | one, every & one
    rules = {
        "StartsWith": answer.startswith(value),
        "NotStartsWith": ~answer.startswith(value),
        "ContainsAny": some,
        "ContainsAll": every,
        # as found: the first passes when something is contained, the second only when nothing is
        "DoesNotContainAny": ~some if fixed else some,
        "DoesNotContainAll": ~every if fixed else ~some,
    }
    return _verdict(rules[rule["operator"]]) if rule["operator"] in rules else F.lit(None).cast("string")


def _json_rule(answer: Column, rule: dict) -> Column:
    valid = (answer != "") & F.try_parse_json(answer).isNotNull()
    if rule["operator"] == "IsValidJSON":
        return _verdict(valid)
    return _verdict(~valid if rule["operator"] == "IsNotValidJSON" else F.lit(False))


def _numeric_rule(answer: Column, rule: dict) -> Column:
    """The expected value is the leading integer of its text; equality is strict, so text never equals."""
    wanted = F.try_to_number(F.lit("x"), F.lit("9"))
    if rule["value"] is not None:
        wanted = F.regexp_extract(F.lit(str(rule["value"])), r"^\s*([+-]?\d+)", 1).try_cast("double")
    if rule["measure"] == "responseLength":
        number, is_number = text.utf16_length(answer).cast("double"), F.lit(True)
    else:
        raw = F.try_variant_get(F.try_parse_json("metrics"), jsons.spark_path([rule["measure"] or ""]), "variant")
        as_json = F.to_json(raw)
        number = F.try_variant_get(raw, "$", "string").try_cast("double")
        is_number = F.coalesce(as_json.rlike(r"^[-\d]"), F.lit(False))
    equal = is_number & F.coalesce(number == wanted, F.lit(False))
    tests = {
        "equals": equal,
        "notEquals": ~equal,
        "greaterThan": number > wanted,
        "lessThan": number < wanted,
        "greaterThanOrEquals": number >= wanted,
        "lessThanOrEquals": number <= wanted,
    }
    return _verdict(tests.get(rule["operator"], F.lit(False)))


def _evaluate(outputs: DataFrame, rules: DataFrame | Sequence[dict], kinds: set[str], mode: str = "reference") -> DataFrame:
    """Every output beside every rule, as one expression per rule and no join."""
    if mode not in ("reference", "fixed"):
        raise ValueError("mode is reference or fixed")
    listed = [r for r in _rules(rules) if r["type"] in kinds]
    if not listed:
        raise ValueError(f"no rule of type {', '.join(sorted(kinds))}")
    answer = text.stripped(F.lower(F.coalesce("output", F.lit(""))))
    staged = outputs.withColumns({
        "_answer": answer,
        **({} if "metrics" in outputs.columns else {"metrics": F.lit(None).cast("string")}),
    })
    failed = F.coalesce(F.col("error") != "", F.lit(False))
    results = []
    for rule in listed:
        made = {
            "text": lambda r: _text_rule(F.col("_answer"), r, mode == "fixed"),
            "json": lambda r: _json_rule(F.col("_answer"), r),
            "numeric": lambda r: _numeric_rule(F.col("_answer"), r),
        }[rule["type"]](rule)
        named = [F.lit(rule[n]).cast("string").alias(f"rule_{n}") for n in _RULE]
        results.append(F.struct(*named, F.when(failed, F.lit("Error")).otherwise(made).alias("result")))
    kept = [c for c in outputs.columns if c not in ("output", "metrics")]
    blocks = [results[lo:lo + RULES_AT_ONCE] for lo in range(0, len(results), RULES_AT_ONCE)]
    made = [staged.select(*kept, F.inline(F.array(*block))) for block in blocks]
    return reduce(DataFrame.unionByName, made).where(F.col("result").isNotNull())


def evaluate_text_rules(outputs: DataFrame, rules: DataFrame | Sequence[dict], mode: str = "reference") -> DataFrame:
    return _evaluate(outputs, rules, {"text"}, mode)


def evaluate_json_rules(outputs: DataFrame, rules: DataFrame | Sequence[dict]) -> DataFrame:
    return _evaluate(outputs, rules, {"json"})


def evaluate_numeric_rules(outputs: DataFrame, rules: DataFrame | Sequence[dict]) -> DataFrame:
    return _evaluate(outputs, rules, {"numeric"})


def evaluate_rules(outputs: DataFrame, rules: DataFrame | Sequence[dict], mode: str = "reference") -> DataFrame:
    """Rules of all types in one pass."""
    return _evaluate(outputs, rules, {"text", "json", "numeric"}, mode)


def _fixed(value: Column, digits: int) -> Column:
    """Decimal text with a fixed number of digits."""
    return F.round(value.cast("decimal(24, 8)"), digits).cast(f"decimal(24, {digits})").cast("string")


def evaluation_rollup(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Counts and pass rate per evaluation, with mean latency over the dataset rows and a status.

    Results: evaluation_id, result.  Runs: evaluation_id, row_id, latency, error.
    """
    def count(name: str) -> Column:
        return F.count(F.when(F.col("result") == name, 1))

    marks = results.groupBy("evaluation_id").agg(
        count("Pass").alias("pass_count"), count("Fail").alias("fail_count"), count("Error").alias("error_count"))
    failed = F.coalesce(F.col("error") != "", F.lit(False))
    per_row = runs.groupBy("evaluation_id", "row_id").agg(
        F.sum(F.col("latency").cast("decimal(18, 6)")).alias("_time"), F.bool_or(failed).alias("_failed"))
    times = per_row.groupBy("evaluation_id").agg(
        F.sum("_time").alias("_time"), F.count(F.lit(1)).alias("total_runs"), F.bool_or("_failed").alias("_failed"))
    joined = times.join(marks, "evaluation_id", "left").na.fill(0, ["pass_count", "fail_count", "error_count"])
    every = F.col("pass_count") + F.col("fail_count") + F.col("error_count")
    return joined.select(
        "evaluation_id", "total_runs", "pass_count", "fail_count", "error_count",
        _fixed(F.when(every > 0, F.col("pass_count") * 100.0 / every).otherwise(F.lit(-1.0)), 2).alias("pass_pcnt"),
        _fixed(F.col("_time") / F.col("total_runs"), 3).alias("average_latency"),
        F.when(F.col("_failed"), "error").otherwise("completed").alias("status"),
    )


# ---- cost ------------------------------------------------------------------------------------

_MONEY = "decimal(18, 6)"


def cost_text(cost: Column) -> Column:
    """`$ 0`, `$ <0.01` or two digits."""
    return F.when(cost == 0, "$ 0").when(cost < 0.01, "$ <0.01").otherwise(
        F.concat(F.lit("$ "), F.round(cost, 2).cast("decimal(18, 2)").cast("string")))


def token_cost(df: DataFrame, prices: DataFrame | tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Cost of the tokens of each row as decimals and as text.

    Rows: provider, model, prompt_tokens, completion_tokens, total_tokens, and the price columns
    unless `prices` is given.  Rows without a model are left alone.
    """
    if prices is not None:
        chat, completion = prices if isinstance(prices, tuple) else (prices, prices.limit(0))
        df = price_lookup(df, chat, completion)
    known = F.coalesce("input_cost", "output_cost", "total_price", "total_cost").isNotNull()

    def part(price: str, tokens: str) -> Column:
        return (F.coalesce(F.col(price), F.lit(0.0)) * F.coalesce(F.col(tokens), F.lit(0)) / 1000).cast(_MONEY)

    flat = F.coalesce(F.col("total_price") > 0, F.lit(False))
    zero = F.lit(0).cast(_MONEY)
    prompt, completion_part = part("input_cost", "prompt_tokens"), part("output_cost", "completion_tokens")
    staged = df.withColumns({
        "prompt_cost": F.when(known & ~flat, prompt).otherwise(zero),
        "completion_cost": F.when(known & ~flat, completion_part).otherwise(zero),
        "cost": F.when(known & flat, part("total_cost", "total_tokens"))
        .when(known, (prompt + completion_part).cast(_MONEY)).otherwise(zero),
    })

    def shown(cost: str, tokens: str | None) -> Column:
        counted = F.lit(True) if tokens is None else (~flat & F.coalesce(F.col(tokens) != 0, F.lit(False)))
        return F.when(known & counted, cost_text(F.col(cost))).otherwise(F.lit("0"))

    named = F.coalesce(F.col("model") != "", F.lit(False))
    texts = {"total_cost_text": ("cost", None), "prompt_cost_text": ("prompt_cost", "prompt_tokens"),
             "completion_cost_text": ("completion_cost", "completion_tokens")}
    return staged.withColumns({
        **{name: F.when(named, shown(*source)) for name, source in texts.items()},
        **{c: F.when(named, F.col(c)) for c in ("prompt_cost", "completion_cost", "cost")},
    })


_SUMS = ("prompt_tokens", "completion_tokens", "total_tokens", "input_cost", "output_cost", "total_cost")


def nested_metric_sum(df: DataFrame, metrics: Column) -> DataFrame:
    """Sum the nested metrics of a row that name a model and have prompt tokens, inside the row.

    Also keeps as `nested` those with a model and a provider.
    """
    named = F.filter(metrics, lambda m: (F.coalesce(m["model"], F.lit("")) != "") & (m["prompt_tokens"] > 0))
    def added(name: str) -> Column:
        kind = "bigint" if name.endswith("tokens") else _MONEY
        zero = F.lit(0).cast("decimal(28, 6)")
        total = F.aggregate(
            named, zero, lambda acc, m: (acc + F.coalesce(m[name].cast(_MONEY), F.lit(0).cast(_MONEY))).cast("decimal(28, 6)"))
        return total.cast(kind)

    both = F.filter(
        metrics,
        lambda m: (F.coalesce(m["model"], F.lit("")) != "") & (F.coalesce(m["provider"], F.lit("")) != ""))
    return df.withColumns({
        **{name: added(name) for name in _SUMS},
        "nested": both,
    })


def merge_metrics(df: DataFrame, metrics: Column) -> DataFrame:
    """Fold an array of maps into one, later keys winning."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return df.withColumn(
        "merged", F.aggregate(metrics, empty, lambda acc, m: F.when(m.isNull(), acc).otherwise(jsons.override(acc, m))))


def usage_from_trace(df: DataFrame, steps: Column, prices: tuple[DataFrame, DataFrame]) -> DataFrame:
    """One row per step with tokens, cost and latency.

    Steps: provider, model, input_tokens, output_tokens, total_tokens, start_ms, end_ms.
    """
    zero = F.lit(0).cast("bigint")
    given = df.withColumn("_s", F.explode(steps)).select(*df.columns, "_s.*")
    counted = given.withColumns({
        "input_tokens": F.coalesce("input_tokens", zero), "output_tokens": F.coalesce("output_tokens", zero)})
    total = F.coalesce("total_tokens", zero)
    counted = counted.withColumns({
        "total_tokens": F.when(total != 0, total).otherwise(F.col("input_tokens") + F.col("output_tokens")),
        "latency": F.when(F.col("end_ms").isNull(), F.lit("")).otherwise(_fixed(F.col("end_ms") - F.col("start_ms"), 2)),
    })
    priced = price_lookup(counted, *prices)
    known = F.col("input_cost").isNotNull() | F.col("output_cost").isNotNull()

    def part(price: str, tokens: str) -> Column:
        return F.when(known, (F.coalesce(price, F.lit(0.0)) * F.col(tokens) / 1000).cast(_MONEY))

    costs = priced.withColumns({"_in": part("input_cost", "input_tokens"), "_out": part("output_cost", "output_tokens")})
    return costs.drop("input_cost", "output_cost", "total_price", "total_cost").withColumns({
        "input_cost": F.col("_in"), "output_cost": F.col("_out"), "total_cost": (F.col("_in") + F.col("_out")).cast(_MONEY),
    }).drop("_in", "_out")


def last_model_of_run(metrics: DataFrame) -> DataFrame:
    """Last non-empty model and provider by position: run_id, pos, model, provider."""
    def last(name: str) -> Column:
        filled = F.col(name).isNotNull() & (F.col(name) != "")
        return F.max_by(F.when(filled, F.col(name)), F.when(filled, F.col("pos"))).alias(name)

    return metrics.groupBy("run_id").agg(last("model"), last("provider"))


# ---- freshness and datasets ------------------------------------------------------------------

def outdated_evaluations(evals: DataFrame, datasets: DataFrame, flows: DataFrame, assistants: DataFrame) -> DataFrame:
    """Whether the dataset or a flow changed after the run or is gone, with the errors in order.

    Evaluations: id, run_date, dataset_id, dataset_name, flow_ids, flow_names, flow_types (arrays);
    the other tables: id, updated.  Custom assistants have a table of their own.
    """
    data = evals.join(
        datasets.select(F.col("id").alias("dataset_id"), F.col("updated").alias("_data")), "dataset_id", "left")
    data_errors = data.select(
        "id",
        F.coalesce(F.col("_data") > F.col("run_date"), F.lit(True)).alias("_old"),
        F.when(F.col("_data").isNull(), F.concat(F.lit("Dataset "), "dataset_name", F.lit(" not found"))).alias("_e"),
        F.lit(-1).alias("_at"),
    )
    items = evals.select(
        "id", "run_date",
        F.posexplode(F.arrays_zip(F.col("flow_ids").alias("fid"), F.col("flow_names").alias("fname"),
                                  F.col("flow_types").alias("ftype"))).alias("_at", "_f"),
    ).select("id", "run_date", "_at", "_f.*")
    custom = F.coalesce(F.col("ftype") == "Custom Assistant", F.lit(False))

    def checked(rows: DataFrame, table: DataFrame, label: str, shift: int) -> DataFrame:
        found = rows.join(table.select(F.col("id").alias("fid"), F.col("updated").alias("_upd")), "fid", "left")
        return found.select(
            "id",
            F.coalesce(F.col("_upd") > F.col("run_date"), F.lit(True)).alias("_old"),
            F.when(F.col("_upd").isNull(), F.concat(F.lit(f"{label} "), "fname", F.lit(" not found"))).alias("_e"),
            (F.col("_at") + shift).alias("_at"),
        )

    every = (
        data_errors
        .unionByName(checked(items.where(~custom), flows, "Chatflow", 0))
        .unionByName(checked(items.where(custom), assistants, "Custom Assistant", 1_000_000))
    )
    # a group holds the flows of one evaluation
    return every.groupBy("id").agg(
        F.bool_or("_old").alias("outdated"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("_e").isNotNull(), F.struct("_at", "_e")))), lambda s: s["_e"])
        .alias("errors"),
    )


def csv_to_dataset(
    spark: SparkSession, paths: Sequence[str], dataset_id: str, first_row_headers: bool = False, start_seq: int = 1
) -> DataFrame:
    """First two columns of CSV files as numbered dataset rows; only the very first row can be a header."""
    rows: DataFrame | None = None
    for i, path in enumerate(paths):
        read = spark.read.csv(path, header=False, **CSV)
        one = read.select(
            F.col("_c0").alias("input"), (F.col("_c1") if "_c1" in read.columns else F.lit(None).cast("string")).alias("output"),
            F.lit(i).alias("_file"), F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"),
        )
        rows = one if rows is None else rows.unionByName(one)
    numbered = number_rows(rows, [], ["_file", "_path", "_block", "_at"], "_rn")
    skipped = 1 if first_row_headers else 0
    return numbered.where(F.col("_rn") > skipped).select(
        F.lit(dataset_id).alias("dataset_id"), "input", "output",
        (F.col("_rn") - skipped + (start_seq - 1)).alias("sequence_no"),
    )


# ---- regression ------------------------------------------------------------------------------

SCORE_DROP = 0.08
MIN_GOLDEN = 31


def check_golden(golden: DataFrame, minimum: int = MIN_GOLDEN) -> DataFrame:
    """The golden cases, or an error when there are too few."""
    n = golden.limit(minimum).count()
    if n < minimum:
        raise ValueError(f"the golden set has {n} cases, at least {minimum} are needed")
    return golden


def regression_compare(current: DataFrame, baseline: DataFrame, score_drop: float = SCORE_DROP) -> DataFrame:
    """Cases (golden_id, input, score, passed, reason) that lost more than `score_drop` or stopped passing."""
    before = baseline.select(
        "golden_id", F.col("score").alias("baseline_score"), F.col("passed").alias("baseline_passed"))
    delta = F.round(F.col("score") - F.col("baseline_score"), 4)
    return (
        current.join(before, "golden_id").withColumn("score_delta", delta)
        .where((F.col("score_delta") < -score_drop) | (F.col("baseline_passed") & ~F.col("passed")))
        .select(
            "golden_id", F.substring("input", 1, 120).alias("input_preview"), "baseline_score",
            F.col("score").alias("current_score"), "score_delta", "baseline_passed",
            F.col("passed").alias("current_passed"), "reason",
        )
    )


def regression_summary(cases: DataFrame) -> DataFrame:
    passed = F.count(F.when(F.col("passed"), 1))
    total = F.count(F.lit(1))
    return cases.agg(
        total.alias("total_cases"),
        passed.alias("passed_cases"),
        (total - passed).alias("failed_cases"),
        F.coalesce(F.round(F.try_divide(passed, total), 4), F.lit(0.0)).alias("pass_rate"),
        F.coalesce(F.round(F.avg("score"), 4), F.lit(0.0)).alias("mean_score"),
    )


def failed_cases(cases: DataFrame) -> DataFrame:
    return cases.where(~F.col("passed"))


def model_graded(df: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType) -> DataFrame:
    """Grade question, actual and expected with a user model; rows with an error say so instead.

    `scorer` gets a batch and returns one row per input with the columns of `schema`.
    """
    names = [f.name for f in schema]
    out = StructType(df.schema.fields + schema.fields).add("grade_error", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            skipped = batch["error"].fillna("") != ""
            grades = pd.DataFrame(None, index=batch.index, columns=names, dtype=object)
            problem = pd.Series([None] * len(batch), dtype=object)
            problem[skipped] = "Not Graded!"
            todo = batch[~skipped]
            if len(todo):
                try:
                    grades.loc[todo.index] = scorer(todo.reset_index(drop=True))[names].to_numpy()
                except Exception:
                    problem[~skipped] = "error"
            yield pd.concat([batch, grades.astype(object).where(grades.notna(), None)], axis=1).assign(grade_error=problem)

    return df.mapInPandas(run, out)
