"""Cleaning a table by its plan, and the whole run around it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row

from tidyspark.functions import names
from tidyspark.operators import clean as c
from tidyspark.operators import features, models, profile, quality
from tidyspark.plans.audit import AuditTrail
from tidyspark.plans.planner import Snapshot, Step, build_plan, plan_frame, plan_summary, snapshot
from tidyspark.session import keep_table, scratch_path
from tidyspark.sources import writers


# ---- fixed values ---------------------------------------------------------
# The steps of the short cleaning.
SHORT_CLEANING = ("remove_duplicates", "fill_missing", "normalize_strings", "validate")
# ---------------------------------------------------------------------------


@dataclass
class Cleaned:
    table: DataFrame
    steps: list[Step]
    seen: Snapshot
    target: str | None
    outcomes: dict[str, str]


def _kept_for(df: DataFrame, later: set[str]) -> DataFrame:
    """Keep the rows left by duplicate removal when filling is going to scan them
    several times: finding duplicates reads all columns, those scans need a few."""
    return keep_table(df) if "fill_missing" in later else df


def clean(
    df: DataFrame,
    model: str | None = None,
    target: str | None = None,
    order_by: list[str] | None = None,
    seen: Snapshot | None = None,
    only: tuple[str, ...] | None = None,
) -> Cleaned:
    """Run the steps the data calls for, in plan order; ``only`` keeps some of them.

    The facts the plan was built from also settle which columns are numbers,
    boolean words or dates: dropping empty and repeated rows takes no value away,
    so the raw scan's answer still holds and no step scans again for it. Only
    filling has to look at the rows left (median and most frequent value).

    ``order_by`` gives the row order for ordinal codes; by default the table's
    columns, so that equal tables get equal codes.
    """
    seen = seen or snapshot(df)
    steps = [s for s in build_plan(seen, model) if only is None or s.operation in only]
    outcomes: dict[str, str] = {}
    negative_cells = None
    order = order_by or df.columns
    pending = {s.operation for s in steps}
    for step in steps:
        operation = step.operation
        pending.discard(operation)
        if operation == "remove_empty_rows":
            df = c.remove_empty_rows(df)
            outcomes[operation] = f"removed {seen.empty_rows} rows"
        elif operation == "remove_empty_columns":
            df = c.remove_empty_columns(df, seen.known)
            outcomes[operation] = f"removed {len(seen.empty_columns)} columns"
        elif operation == "remove_duplicates":
            df = _kept_for(c.remove_duplicates(df, seen.rows), pending)
            # empty rows repeat each other; they do not count when they are gone by now
            gone = max(seen.empty_rows - 1, 0) if "remove_empty_rows" in outcomes else 0
            outcomes[operation] = f"removed {seen.duplicates - gone} rows"
        elif operation == "coerce_numeric_columns":
            df = c.coerce_numeric(df, seen.known)
            outcomes[operation] = ", ".join(f"{n} {t}" for n, t in df.dtypes)
        elif operation == "normalize_boolean_columns":
            df = c.normalise_booleans(df, seen.known)
            outcomes[operation] = f"rewrote {len(seen.boolean_like)} columns"
        elif operation == "fill_missing":
            # one scan for the gaps and, on the way, the negatives
            counts = c.known_facts(df, ["nulls", "negatives"])
            values = c.fill_values(df, counts)
            df = c.fill_missing(df, values)
            outcomes[operation] = f"filled {len(values)} columns"
            negative_cells = sum(row["negatives"] or 0 for row in counts.values())
            negative_cells += sum(
                counts[name]["nulls"] for name, value in values.items() if isinstance(value, float) and value < 0
            )
        elif operation == "correct_negative_values":
            if negative_cells is None:
                counts = c.known_facts(df, ["negatives"], names.numeric_columns(df))
                negative_cells = sum(row["negatives"] for row in counts.values())
            outcomes[operation] = f"corrected {negative_cells} values"
            df = c.correct_negatives(df)
        elif operation == "normalize_strings":
            df = c.normalise_strings(df)
        elif operation == "standardize_dates":
            df = c.standardise_dates(df, seen.known)
        elif operation == "standardize_column_names":
            renamed = dict(zip(df.columns, names.unique_snake_case(df.columns)))
            df = df.toDF(*renamed.values())
            order = [renamed[name] for name in order if name in renamed]
            # the target keeps its role under its new name
            target = renamed.get(target, target)
        elif operation == "clip_outliers":
            df = features.clip_outliers(df, target=target)
        elif operation == "scale_features":
            df = features.scale(df, step.method, target)
        elif operation == "encode_categoricals" and step.method == "onehot":
            df = features.encode_onehot(df, target)
        elif operation == "encode_categoricals":
            df = features.encode_ordinal(df, [name for name in order if name in df.columns], target)
    return Cleaned(df, steps, seen, target, outcomes)


@dataclass
class RunResult:
    """What a run leaves behind, all as (lazy) DataFrames."""

    table: DataFrame
    path: str
    profile: DataFrame
    plan: DataFrame
    quality: DataFrame
    validation: Row
    audit: DataFrame
    benchmark: DataFrame | None
    run_id: str
    summary: str


def run_table(
    df: DataFrame,
    dataset_id: str,
    model: str = "generic",
    target: str | None = None,
    order_by: list[str] | None = None,
    path: str | None = None,
    audit_path: str | None = None,
) -> RunResult:
    """Profile, plan, clean, validate, store and, for a model, benchmark a table.

    The cleaned table is written once and read back: the checks after it and the
    benchmark neither repeat the cleaning nor depend on its executors.
    """
    spark = df.sparkSession
    if model != "generic":
        # Once, on the table as it came: encoding and scaling would change what the columns look like.
        target = names.infer_target(df, target)
    trail = AuditTrail(dataset_id)
    seen = snapshot(df)
    trail.log("Source Analyzer", "Inspected source", f"{seen.rows} rows, {len(seen.columns)} columns", "read_table")
    trail.stage("Source Analyzer", f"{len(seen.columns)} columns")
    found = f"{seen.missing} missing values, {seen.duplicates} duplicate rows"
    trail.log("Profiler", "Profiled table", found, "table_profile")
    trail.stage("Profiler", found)

    cleaned = clean(df, model, target, order_by, seen)
    summary = plan_summary(seen, model, target)
    trail.log("Planner", "Built plan", f"{len(cleaned.steps)} steps", "build_plan", output=summary)
    trail.stage("Planner", f"{len(cleaned.steps)} steps")

    path = writers.store(cleaned.table, path or scratch_path(spark, dataset_id))
    table = spark.read.parquet(path)
    report = quality.validate(table).first()
    for step in cleaned.steps:
        if step.operation == "validate":
            status = "SUCCESS" if report["validated"] else "WARNING"
            trail.log("Validation", step.operation, step.reason, "validate", status, ", ".join(report["issues"]))
        elif step.operation == "store":
            trail.log("Storage", step.operation, step.reason, "store", output=path)
        else:
            trail.log("Cleaning", step.operation, step.reason, step.operation, output=cleaned.outcomes.get(step.operation, ""))
    rewrites = [s.operation for s in cleaned.steps if s.operation not in ("validate", "store")]
    trail.stage("Cleaning", "; ".join(rewrites) or "nothing to clean")
    trail.stage("Validation", ", ".join(report["issues"]) or "all checks passed", "SUCCESS" if report["validated"] else "WARNING")
    trail.stage("Storage", path)

    benchmark = None
    chosen = cleaned.target
    if model != "generic" and chosen:
        benchmark = models.benchmark(_plainly_cleaned(df, seen), chosen, model)
        trail.log("Benchmark", "Scored model", f"{model} on {chosen}", "benchmark")
        trail.stage("Benchmark", f"{model} on {chosen}")
    else:
        trail.log("Benchmark", "Skipped benchmark", "no model or no target column", "benchmark")
        trail.stage("Benchmark", "no model or no target column", "PENDING")

    audit = trail.frame(spark)
    if audit_path:
        trail.append_to(spark, audit_path)
    return RunResult(
        table=table,
        path=path,
        profile=profile.column_profile(df),
        plan=plan_frame(spark, cleaned.steps),
        quality=quality.quality_lift(df, table),
        validation=report,
        audit=audit,
        benchmark=benchmark,
        run_id=trail.run_id,
        summary=summary,
    )


def _plainly_cleaned(df: DataFrame, seen: Snapshot) -> DataFrame:
    """The table cleaned without the model's own steps, for the benchmark to split
    before it prepares features, so that nothing leaks from test to training rows."""
    return keep_table(clean(df, seen=seen).table)
