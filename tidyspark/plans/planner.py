"""From what a table looks like to the ordered list of cleaning steps."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from tidyspark.functions import names
from tidyspark.operators import facts
from tidyspark.operators.duplicates import duplicate_total

# ---- fixed values ---------------------------------------------------------
# Scaling each model family asks for; families listed here are also clipped and
# one-hot encoded.
SCALING = {"logistic_regression": "standard", "linear_regression": "standard", "knn": "minmax"}
# Families that only need ordinal codes.
ORDINAL = ("random_forest", "xgboost")
FILL_METHOD = "median/mode"
# ---------------------------------------------------------------------------

_FACTS = ["nulls", "low", "text_low", "all_numbers", "all_integers", "all_booleans", "all_dates"]
PLAN_SCHEMA = "step int, operation string, method string, reason string"


@dataclass(frozen=True)
class Step:
    operation: str
    reason: str
    method: str | None = None


@dataclass
class Snapshot:
    """Column facts and table totals: one small row per column, held by the driver."""

    columns: list[Row]
    duplicates: int
    known: dict[str, Row] = field(init=False)

    def __post_init__(self) -> None:
        self.known = {row["name"]: row for row in self.columns}

    @property
    def rows(self) -> int:
        return self.columns[0]["rows"]

    @property
    def empty_rows(self) -> int:
        return next(row["empty_rows"] for row in self.columns if row["empty_rows"] is not None)

    @property
    def missing(self) -> int:
        return sum(row["nulls"] for row in self.columns)

    @property
    def empty_columns(self) -> list[str]:
        return [row["name"] for row in self.columns if row["nulls"] == row["rows"]]

    @property
    def boolean_like(self) -> list[str]:
        return [row["name"] for row in self.columns if row["all_booleans"]]

    @property
    def numeric_like(self) -> list[str]:
        return [row["name"] for row in self.columns if row["all_numbers"] and not row["all_booleans"]]

    @property
    def negative(self) -> list[str]:
        """Columns whose smallest number is negative, numbers held as text included."""
        lowest = {row["name"]: row["low"] for row in self.columns}
        lowest.update({row["name"]: row["text_low"] for row in self.columns if row["name"] in self.numeric_like})
        return [name for name, low in lowest.items() if low is not None and low < 0]

    @property
    def text(self) -> list[str]:
        return [row["name"] for row in self.columns if row["kind"] == facts.TEXT]

    @property
    def dated(self) -> list[str]:
        return [row["name"] for row in self.columns if names.is_date_name(row["name"])]


def snapshot(df: DataFrame) -> Snapshot:
    """Gather everything the planner asks for: one scan and one duplicate count."""
    rows = df.count()
    refuted = facts.first_look(df, _FACTS, total=rows)
    per_column = facts.column_facts(df, _FACTS, empty_rows=True, disproved=refuted)
    # one job: the scan for facts and the duplicate count run side by side
    found = per_column.unionByName(duplicate_total(df, rows=rows), allowMissingColumns=True).collect()
    columns = sorted((row for row in found if row["ordinal"] is not None), key=lambda row: row["ordinal"])
    return Snapshot(columns, next(row["duplicates"] for row in found if row["ordinal"] is None))


def _listed(columns: Iterable[str]) -> str:
    return ", ".join(columns)


def cleaning_steps(seen: Snapshot) -> list[Step]:
    every = [row["name"] for row in seen.columns]
    renamed = [names.snake_case(name) for name in every]
    candidates = [
        (seen.empty_rows > 0, Step("remove_empty_rows", f"{seen.empty_rows} rows hold no value")),
        (
            0 < len(seen.empty_columns) < len(every),
            Step("remove_empty_columns", f"no values in {_listed(seen.empty_columns)}"),
        ),
        (seen.duplicates > 0, Step("remove_duplicates", f"{seen.duplicates} rows repeat another row")),
        (bool(seen.numeric_like), Step("coerce_numeric_columns", f"numbers held as text in {_listed(seen.numeric_like)}")),
        (bool(seen.boolean_like), Step("normalize_boolean_columns", f"boolean words in {_listed(seen.boolean_like)}")),
        (seen.missing > 0, Step("fill_missing", f"{seen.missing} cells hold no value", FILL_METHOD)),
        (bool(seen.negative), Step("correct_negative_values", f"negative numbers in {_listed(seen.negative)}")),
        (bool(seen.text), Step("normalize_strings", "padding and letter case may differ in text columns")),
        (bool(seen.dated), Step("standardize_dates", f"dates in {_listed(seen.dated)}")),
        (
            every != renamed or len(set(renamed)) < len(renamed),
            Step("standardize_column_names", "names are not unique snake_case"),
        ),
    ]
    return [step for needed, step in candidates if needed]


def model_steps(model: str | None) -> list[Step]:
    family = (model or "generic").lower()
    if family in SCALING:
        return [
            Step("clip_outliers", f"extreme values distort {family}"),
            Step("scale_features", f"{family} compares columns by size", SCALING[family]),
            Step("encode_categoricals", f"{family} needs numbers without an order", "onehot"),
        ]
    if family in ORDINAL:
        return [Step("encode_categoricals", f"{family} splits on codes", "ordinal")]
    return []


def build_plan(seen: Snapshot, model: str | None = None) -> list[Step]:
    """Cleaning steps the data calls for, the model's steps, then check and store."""
    closing = [Step("validate", "check the result"), Step("store", "keep the result")]
    return [*cleaning_steps(seen), *model_steps(model), *closing]


def plan_frame(spark: SparkSession, steps: list[Step]) -> DataFrame:
    rows = [(i, s.operation, s.method, s.reason) for i, s in enumerate(steps, start=1)]
    return spark.createDataFrame(rows, PLAN_SCHEMA)


def plan_summary(seen: Snapshot, model: str | None = None, target: str | None = None) -> str:
    """The counts behind a plan as one sentence."""
    family = (model or "generic").replace("_", " ")
    return (
        f"{len(seen.columns)} columns, {seen.missing} missing values, {seen.duplicates} duplicate rows, "
        f"{len(seen.numeric_like)} numeric-like, {len(seen.boolean_like)} boolean-like and "
        f"{len(seen.dated)} date-like columns; model {family}, target {target or 'inferred'}"
    )
