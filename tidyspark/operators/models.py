"""Scoring a downstream model with and without model-aware preparation."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidyspark.functions import names
from tidyspark.functions.numbers import round_even
from tidyspark.operators import facts, features, forest, knn
from tidyspark.operators.keyed import BROADCAST_ROWS, look_up, number_rows
from tidyspark.operators.quantiles import quantiles
from tidyspark.session import cut_lineage, scratch_path

# ---- fixed values ---------------------------------------------------------
FOREST_TREES = 40
SEED = 42
LINEAR_ITERATIONS = 300
NEIGHBOURS = 3
# A numeric target with at most this many values is a classification target.
CLASS_LIMIT = 8
FAMILIES = ("random_forest", "xgboost", "logistic_regression", "knn")
FALLBACK = "random_forest"
# ---------------------------------------------------------------------------
TRAIN_SHARE = 80  # percent of rows
# Forests grow as deep as MLlib allows.
FOREST_DEPTH = 30
FOREST_MEMORY_MB = 512
# From so many training rows on, a forest is grown and asked without being held.
FOREST_ROWS = 10_000
BOOST_ROUNDS = 100
# Boosted trees cut a column into this many ranges (MLlib's default).
RANGES = 32
# From so many training rows on, rows that boosted trees cannot tell apart are counted.
MERGE_ROWS = 1_000_000

CLASSIFICATION, REGRESSION = "classification", "regression"


def macro_f1(df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """One row ``macro_f1``: the plain mean of the F1 scores of all classes seen
    as label or prediction. The table is reduced to a confusion count first."""
    times = F.sum(weight) if weight else F.count("*")
    confusion = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(times.alias("n"))
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("l").alias("class"), hit.alias("hits"), F.col("n").alias("total")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("hits"), F.col("n").alias("total")),
    )
    per_class = confusion.select(F.inline(sides)).groupBy("class").agg(
        (2.0 * F.sum("hits") / F.sum("total")).alias("f1")
    )
    return per_class.agg(F.avg("f1").alias("macro_f1"))


def r2(df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """One row ``r2``: 1 - squared error / squared deviation; for a constant label
    1 when it is met exactly, else 0."""
    times = F.col(weight) if weight else F.lit(1)
    y, error = F.col(label).cast("double"), (F.col(label) - F.col(prediction)).cast("double")
    if weight:
        mean = df.agg((F.sum(y * times) / F.sum(times)).alias("m")).first()["m"]
        spread = F.sum((y - F.lit(mean)) * (y - F.lit(mean)) * times)
    else:
        spread = F.var_pop(y) * F.count(y)
    sums = df.agg(F.sum(error * error * times).alias("lost"), spread.alias("spread"))
    constant = F.when(F.col("lost") == 0, 1.0).otherwise(0.0)
    return sums.select(
        F.when(F.col("spread") == 0, constant).otherwise(1.0 - F.col("lost") / F.col("spread")).alias("r2")
    )


def model_task(df: DataFrame, target: str) -> str:
    """Classification for a text, boolean or few-valued target, else regression."""
    field = df.schema[target]
    if not names.is_numeric(field):
        return CLASSIFICATION
    few = df.select(target).filter(F.col(f"`{target}`").isNotNull()).distinct().limit(CLASS_LIMIT + 1).count()
    return CLASSIFICATION if few <= CLASS_LIMIT else REGRESSION


@dataclass
class Problem:
    """A table split for training: numeric columns, categories, label."""

    data: DataFrame  # features as they are, ``label`` as double, ``training`` flag
    numeric: list[str]
    textual: list[str]
    task: str
    classes: int
    train_rows: int
    test_rows: int


def pose(df: DataFrame, target: str, split: str | None = None) -> Problem:
    """Choose features, turn the target into a label, split by row hash. A column ``split`` is no feature and is
    kept for a caller who splits otherwise.

    The split depends on the row alone: it repeats exactly, and copies of a row
    fall on the same side. Class labels are places in a dictionary table of the
    target's values, however many there are.
    """
    task = model_task(df, target)
    chosen = names.model_features([c for c in df.columns if c != split], target)
    numeric = [c for c in chosen if names.is_numeric(df.schema[c]) or names.is_boolean(df.schema[c])]
    textual = [c for c in chosen if names.is_text(df.schema[c])]
    value = F.col(f"`{target}`")
    classes, labelled = 0, df
    if task == CLASSIFICATION:
        word = F.coalesce(value.cast("string"), F.lit("missing"))
        dictionary = number_rows(df.select(word.alias("__class")).distinct(), [F.col("__class")], "__code")
        classes = dictionary.count()
        labelled = look_up(df.withColumn("__class", word), dictionary, "__class", [f"`{c}`" for c in df.columns])
        label = F.col("__code").cast("double")
    else:
        label = F.coalesce(value.cast("double"), F.lit(0.0))
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(100))
    data = labelled.select(
        *[F.col(f"`{c}`").cast("int").cast("double").alias(c) if names.is_boolean(df.schema[c])
          else facts.value_of(df.schema[c]).cast("double").alias(c) for c in numeric],
        *[F.col(f"`{c}`") for c in textual],
        label.alias("label"),
        (bucket < TRAIN_SHARE).alias("training"),
        *([F.col(f"`{split}`")] if split else []),
    )
    data = cut_lineage(data)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if data.rdd.getNumPartitions() < cores:
        # few input splits would leave most cores idle in every training pass
        data = cut_lineage(data.repartition(cores))
    counts = {r["training"]: r["count"] for r in data.groupBy("training").count().collect()}
    return Problem(data, numeric, textual, task, classes, counts.get(True, 0), counts.get(False, 0))


def prepare(problem: Problem, family: str, aware: bool, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``numbers`` (array), ``slots`` (ascending places of ones after the numbers) and ``width`` (length of the
    whole vector). Statistics and dictionaries come from the training rows only.

    Plainly: missing numbers to the median, one-hot categories (the first one implied, as are values not trained on).
    Model-aware on top of that: clipping and scaling for linear and distance models, ordinal codes instead of one-hot
    for trees. Categories become codes by a join with a dictionary table, so a column may have any number of
    them: no value passes through the driver and a row holds one slot per text column.
    """
    train = problem.data.filter("training")
    trees = family in ("random_forest", "xgboost")
    data, encoded, slots, ones = problem.data, [], [], 0
    if problem.textual:
        codes, sizes = features.value_codes(train, problem.textual, limit)
        coded = {c: f"__code{i}" for i, c in enumerate(problem.textual)}
        data = features.with_codes(data, codes, coded, ["label", *[f"`{c}`" for c in problem.data.columns]], limit)
        if aware and trees:
            encoded = [F.col(c).cast("double") for c in coded.values()]
        else:
            for column, code in coded.items():
                slots.append(F.when(F.col(code) > 0, F.col(code) - 1 + len(problem.numeric) + ones))
                ones += max(sizes[column] - 1, 0)

    points = [0.01, 0.5, 0.99] if aware and not trees else [0.5]
    stats = quantiles(train, {c: points for c in problem.numeric})
    numbers = {}
    for column in problem.numeric:
        levels = stats[column]
        middle = levels[len(levels) // 2]
        value = F.coalesce(F.col(f"`{column}`"), F.lit(middle if middle is not None else 0.0))
        if len(levels) == 3 and middle is not None:
            value = F.when(value < levels[0], levels[0]).when(value > levels[2], levels[2]).otherwise(value)
        numbers[column] = value
    if aware and not trees and numbers:
        ranges = train.agg(
            *[F.struct(F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"),
                       F.stddev_samp(v).alias("deviation")).alias(f"n{i}") for i, v in enumerate(numbers.values())]
        ).first()
        for i, (column, value) in enumerate(numbers.items()):
            r = ranges[i]
            shift, width = (r["low"], r["high"] - r["low"]) if family == "knn" else (r["mean"], r["deviation"])
            numbers[column] = (value - shift) / width if width else F.lit(0.0)
    places = F.array_compact(F.array(*slots)) if slots else F.array()
    return data.select(
        F.array(*numbers.values(), *encoded).cast("array<double>").alias("numbers"),
        places.cast("array<int>").alias("slots"),
        F.lit(len(numbers) + len(encoded) + ones).alias("width"),
        "label", "training",
    )


def dense(prepared: DataFrame) -> DataFrame:
    """Prepared rows with all their features in one array ``vector``, as the neighbour search takes them; its length
    is the number of features, categories included."""
    ones = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("width")), lambda i: (i >= F.size("numbers")) & (i < F.col("width"))),
        lambda i: F.array_contains("slots", i).cast("double"),
    )
    return prepared.select(F.concat("numbers", ones).alias("vector"), "label", "training")


def _cuts(train: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """Between which values trees may cut each column: all of few values, else exact quantiles of the training rows."""
    cuts, many = {}, []
    for column in columns:
        values = sorted(r[0] for r in train.select(column).distinct().limit(RANGES + 1).collect())
        if len(values) > RANGES:
            many.append(column)
        else:
            cuts[column] = [(low + high) / 2.0 for low, high in zip(values, values[1:])]
    points = [i / RANGES for i in range(1, RANGES)]
    for column, levels in quantiles(train, {c: points for c in many}).items():
        cuts[column] = sorted(set(levels))
    return cuts


def merged(prepared: DataFrame) -> DataFrame:
    """Prepared rows with each number replaced by its range and equal rows counted in ``times``.

    Trees only ever see the range of a value, so weighted rows grow the same trees. Their number is bounded
    by the ranges and categories, not by the table.
    """
    prepared = cut_lineage(prepared)
    first = prepared.select(F.size("numbers")).first()
    columns = [f"n{i}" for i in range(first[0])] if first else []
    flat = prepared.select(*[F.col("numbers")[i].alias(c) for i, c in enumerate(columns)], "slots", "width", "label", "training")
    cuts = _cuts(flat.filter("training"), columns)

    def place(column: str):
        return F.size(F.filter(F.lit(cuts[column]).cast("array<double>"), lambda cut: cut < F.col(column))).cast("double")

    ranges = [place(c) for c in columns]
    keys = ["numbers", "slots", "width", "label", "training"]
    placed = flat.select(F.array(*ranges).cast("array<double>").alias("numbers"), *keys[1:])
    return placed.groupBy(*keys).agg(F.count("*").alias("times"))


def assembled(prepared: DataFrame) -> DataFrame:
    """Prepared rows with a sparse vector ``features``, written once below the shared folder; ``times`` is kept.

    Learners pass over their rows many times. The fields of a vector are written as plain columns and read
    back under the vector type, so a row costs what it holds, not the number of categories.
    """
    places = F.concat(F.sequence(F.lit(0), F.size("numbers")), F.array(F.lit(0)))
    places = F.slice(places, F.lit(1), F.size("numbers"))
    ones = F.transform("slots", lambda _: F.lit(1.0))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.col("width").alias("size"),
        F.concat(places, "slots").alias("indices"), F.concat("numbers", ones).alias("values"),
    )
    path = scratch_path(prepared.sparkSession, "features")
    times = ["times"] if "times" in prepared.columns else []
    prepared.select(vector.alias("features"), "label", "training", *times).write.parquet(path)
    schema = StructType().add("features", VectorUDT()).add("label", "double").add("training", "boolean")
    for column in times:
        schema = schema.add(column, "long")
    return prepared.sparkSession.read.schema(schema).parquet(path)


def _learner(family: str, task: str, classes: int, rows: int, rounds: int, depth: int):
    penalty = 1.0 / max(rows, 1)
    if family == "logistic_regression":
        if task == CLASSIFICATION:
            return LogisticRegression(maxIter=LINEAR_ITERATIONS, regParam=penalty, standardization=False)
        return LinearRegression(maxIter=LINEAR_ITERATIONS, regParam=penalty, elasticNetParam=0.0, standardization=False)
    if family == "xgboost":
        if task == REGRESSION:
            return GBTRegressor(maxIter=rounds, seed=SEED)
        boosted = GBTClassifier(maxIter=rounds, seed=SEED)
        return boosted if classes <= 2 else OneVsRest(classifier=boosted, parallelism=min(classes, 4))
    forest = RandomForestClassifier if task == CLASSIFICATION else RandomForestRegressor
    # Rows keep the nodes they have reached, so tasks need not be sent the trees; groups of nodes are as large as memory allows.
    return forest(
        numTrees=FOREST_TREES, seed=SEED, maxDepth=depth, cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=FOREST_MEMORY_MB
    )


def _predict_with_learner(problem: Problem, prepared: DataFrame, family: str, rounds: int, depth: int) -> DataFrame:
    if family == FALLBACK and problem.train_rows >= FOREST_ROWS:
        return forest.predict(merged(prepared), problem.classes, FOREST_TREES, depth, SEED)
    learner = _learner(family, problem.task, problem.classes, problem.train_rows, rounds, depth)
    times = F.lit(1)
    if family == "xgboost" and problem.train_rows >= MERGE_ROWS:
        prepared, times = merged(prepared), F.col("times")
        learner.setWeightCol("times")
    rows = assembled(prepared)
    model = learner.fit(rows.filter("training"))
    return model.transform(rows.filter("NOT training")).select("label", "prediction", times.alias("times"))


def _predict_with_neighbours(problem: Problem, prepared: DataFrame) -> DataFrame:
    prepared = dense(prepared)
    # equal test rows are looked up once and counted
    test = prepared.filter("NOT training").groupBy("vector", "label").agg(F.count("*").alias("times"))
    test = cut_lineage(test.withColumn("query", F.monotonically_increasing_id()))
    k = min(NEIGHBOURS, max(1, problem.train_rows - 1))
    found = knn.nearest(prepared.filter("training").select("vector", "label"), test.select("query", "vector"), k)
    answer: Callable[[DataFrame], DataFrame] = knn.vote if problem.task == CLASSIFICATION else knn.average
    return test.select("query", "label", "times").join(answer(found), "query").select("label", "prediction", "times")


def score(problem: Problem, family: str, aware: bool, rounds: int = BOOST_ROUNDS, depth: int = FOREST_DEPTH) -> float:
    """Macro F1 or R², in percent, on the rows held out."""
    prepared = prepare(problem, family, aware)
    if family == "knn":
        predictions = _predict_with_neighbours(problem, prepared)
    else:
        predictions = _predict_with_learner(problem, prepared, family, rounds, depth)
    if problem.task == CLASSIFICATION:
        return macro_f1(predictions, weight="times").select(round_even(F.col("macro_f1") * 100.0, 1)).first()[0]
    bounded = F.greatest(F.lit(0.0), F.col("r2"))
    return r2(predictions, weight="times").select(round_even(bounded * 100.0, 1)).first()[0]


BENCHMARK_SCHEMA = (
    "model_type string, target_column string, task string, metric_name string, baseline_score double, "
    "model_aware_score double, lift double, train_rows bigint, test_rows bigint, features array<string>, note string"
)


def benchmark(
    df: DataFrame, target: str, family: str = FALLBACK, rounds: int = BOOST_ROUNDS, depth: int = FOREST_DEPTH
) -> DataFrame:
    """One row: scores of the model on plainly and on model-aware prepared features.

    Both are measured on held-out rows. A target with one class has nothing to
    learn: it scores 100 either way. Where the split leaves no rows to train on or
    to test on, the scores are NULL and ``note`` says why. ``rounds`` bounds
    boosting, ``depth`` the trees of a forest.
    """
    family = family if family in FAMILIES else FALLBACK
    column = names.resolve_target(df.columns, target)
    problem = pose(df, column)
    plain = aware = note = None
    if problem.task == CLASSIFICATION and problem.classes == 1:
        plain = aware = 100.0
    elif not problem.train_rows or not problem.test_rows:
        note = f"not scored: {problem.train_rows} rows to train on, {problem.test_rows} to test on"
    else:
        # Boosting and gradient descent are hundreds of short jobs, one after the other: both ways share the executors.
        # Forests that are held fill them, and their memory, alone.
        one = inheritable_thread_target(df.sparkSession)(lambda way: score(problem, family, way, rounds, depth))
        alone = family == FALLBACK and problem.train_rows < FOREST_ROWS
        with ThreadPoolExecutor(1 if alone else 2) as pool:
            plain, aware = pool.map(one, (False, True))
    metric = "F1-Score (Macro)" if problem.task == CLASSIFICATION else "R² Score"
    row = (
        family, column, problem.task, metric, plain, aware, None if plain is None else round(aware - plain, 1),
        problem.train_rows, problem.test_rows, [*problem.numeric, *problem.textual], note,
    )
    return df.sparkSession.createDataFrame([row], BENCHMARK_SCHEMA)
