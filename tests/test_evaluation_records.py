"""Cross-validation, the closed-form learner, and records with broken lines."""

import csv
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyspark.operators import evaluation
from tidyspark.sources import readers, records


def test_folds_hold_every_class(spark):
    rows = [(i, None if i % 10 == 9 else "abc"[i % 3 if i % 7 else 0]) for i in range(103)]
    df = spark.createDataFrame(rows, "k int, label string")
    got = evaluation.deal_folds(df, "label", ["k"], folds=4).collect()
    assert {tuple(r[:2]) for r in got} == set(rows)
    for label in ("a", "b", "c", None):
        folds = [r["fold"] for r in sorted(r for r in got if r["label"] == label)] if label else [
            r["fold"] for r in sorted((r for r in got if r["label"] is None), key=lambda r: r["k"])
        ]
        assert folds == [i % 4 for i in range(len(folds))]
    assert evaluation.deal_folds(df.limit(0), "label", ["k"]).columns == ["k", "label", "fold"]
    with pytest.raises(ValueError):
        evaluation.deal_folds(df, "label", ["k"], folds=1)


def test_cross_validation_scores_every_row_once(spark):
    rows = [(i, float(i % 7), float((i * 13) % 11), "yes" if i % 7 > 3 else "no") for i in range(140)]
    df = spark.createDataFrame(rows, "k int, x double, y double, label string")
    scores = evaluation.cross_validate(df, "label", ["k"], "logistic_regression", folds=3)
    rows = scores.collect()
    assert [r["fold"] for r in rows] == [0, 1, 2] and sum(r["test_rows"] for r in rows) == 140
    assert all(r["train_rows"] + r["test_rows"] == 140 for r in rows)
    assert all(r["model_aware_score"] > 90 for r in rows)  # the label follows from x
    told = evaluation.summary(scores).first()
    assert told["folds"] == 3 and abs(told["model_aware_score_mean"] - np.mean([r["model_aware_score"] for r in rows])) < 0.06


def test_ridge_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3)) * [1, 10, 0.1] + [5, -3, 0]
    y = x @ [2.0, -0.5, 7.0] + 4 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, row), float(v)) for row, v in zip(x, y)] + [(None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double")
    got = {r["term"]: r["coefficient"] for r in evaluation.ridge(df, ["a", "b", "c"], "y", penalty=2.0).collect()}
    centred, target = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(centred.T @ centred + 2 * np.eye(3), centred.T @ target)
    assert np.allclose([got["a"], got["b"], got["c"]], want) and np.isclose(got["intercept"], y.mean() - want @ x.mean(0))
    assert {r["coefficient"] for r in evaluation.ridge(df.limit(0), ["a", "b"], "y").collect()} == {0.0}


def broken_file(path, rows, end="\n"):
    with open(path, "w", newline="") as out:
        csv.writer(out, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_broken_lines_in_many_blocks(spark, tmp_path, end):
    rnd = random.Random(5)
    pieces = ["a", '"', ",", "\n", "\n\n", "é", " ", '""', "x" * 30]
    rows = [[str(i), "".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 8))) + "z", str(i % 5)] for i in range(400)]
    for name in ("one", "two"):
        broken_file(tmp_path / f"{name}.csv", [["k", "note", "m"], *rows], end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = records.read_broken_csv(spark, str(tmp_path))
        assert records.lines_in_order(spark, str(tmp_path)).select("file", "block").distinct().count() > 10
        got = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = spark.read.options(header="true", escape='"', multiLine="true").csv(str(tmp_path))
    assert found.columns == whole.columns == ["k", "note", "m"]
    assert got == sorted(map(tuple, rows * 2)) == sorted(map(tuple, whole.collect()))


def test_reader_takes_blocks_for_broken_lines(spark, tmp_path):
    broken_file(tmp_path / "t.csv", [["k", "note"], ["1", "a\nb"], ["2", "NA"], ["3", "c"]])
    got = readers.read_csv(spark, str(tmp_path / "t.csv"))
    assert sorted(map(tuple, got.collect())) == [(1, "a\nb"), (2, None), (3, "c")]
    assert got.filter(F.col("note").contains("\n")).count() == 1


@pytest.mark.parametrize("indent", [None, 1])
def test_json_arrays_in_many_blocks(spark, tmp_path, indent):
    rnd = random.Random(8)
    pieces = ["}", "{", "[", "]", '"', "\\", "\n", "é", ",", "}{", '\\"', "x" * 20, "\\}"]
    note = lambda: "".join(rnd.choice(pieces) for _ in range(rnd.randrange(8)))
    rows = [{"k": i, "note": note(), "in": {"a": [{"b": note()}] * (i % 3)}, **({"e": {}} if i == 7 else {})} for i in range(300)]
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in rows[:50]), encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ \n] ")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        assert records.pieces_in_order(spark, str(tmp_path / "one.json")).select("block").distinct().count() > 10
        got = readers.read_json(spark, str(tmp_path)).select("k", "note", F.to_json("in").alias("in")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plain = [(r["k"], r["note"], json.dumps(r["in"], ensure_ascii=False, separators=(",", ":"))) for r in rows * 2 + rows[:50]]
    assert sorted(map(tuple, got)) == sorted(plain)


@pytest.mark.parametrize("text", ['[{"a": 1}, 2, {"a": 3}]', '[{"a": 1}, {"a": 2', '[{"a": 1}] x', '[{"a": 1} {"a": 2}]', "[1, 2]"])
def test_broken_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "t.json").write_text(text)
    with pytest.raises(Exception):
        readers.read_json(spark, str(tmp_path / "t.json")).collect()


def test_blocks_are_counted_in_chunks(spark, tmp_path, monkeypatch):
    """One block of many chunks: records and arrays run over their ends, and no window takes a block whole."""
    monkeypatch.setattr(records, "CHUNK_BITS", 2)
    rows = [[str(i), "a\n\"b\",\n\n" * (i % 5) + "z"] for i in range(200)]
    broken_file(tmp_path / "t.csv", [["k", "note"], *rows])
    found = records.read_broken_csv(spark, str(tmp_path / "t.csv"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "chunk" in plan and not [w for w in plan.splitlines() if w.strip(" :+-").startswith("Window") and "line#" in w and "chunk" not in w]
    made = [{"k": i, "note": '}{"[' * (i % 3), "in": [{"b": "}\\"}] * (i % 4)} for i in range(200)]
    (tmp_path / "t.json").write_text(json.dumps(made))
    got = readers.read_json(spark, str(tmp_path / "t.json")).select("k", "note", F.to_json("in").alias("in")).collect()
    assert sorted(map(tuple, got)) == [(r["k"], r["note"], json.dumps(r["in"], separators=(",", ":"))) for r in made]
