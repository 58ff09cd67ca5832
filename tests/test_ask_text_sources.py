"""Table questions, retrieval, readers and writers on small tables."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tidyspark.functions.stopwords import ENGLISH
from tidyspark.operators import ask, retrieval
from tidyspark.plans import audit
from tidyspark.sources import readers, writers

QUESTIONS = {
    "search for hp in company column": "value_lookup",
    "where company is 'Dell' limit 5": "value_lookup",
    "filter by company Dell": "value_lookup",
    "find column in company": "first_rows",
    "Which company had the highest revenue?": "group_total",
    "revenue per company": "group_total",
    "what is the maximum revenue": "extreme_rows",
    "last 7 entries": "tail_rows",
    "show 10 rows": "head_rows",
    "preview": "head_rows",
    "average revenue": "average",
    "how many are there": "table_size",
    "list the schema": "schema_report",
    "explain the pipeline": "lineage_report",
    "hello": "first_rows",
}


def test_intents(spark):
    about = spark.createDataFrame([("HP", 1)], "company string, revenue int")
    asked = spark.createDataFrame([(q,) for q in QUESTIONS], "q string")
    got = {r["q"]: r["intent"] for r in ask.question_intents(asked, "q", about).collect()}
    # "find column in company" names no value but still says neither by nor per … and "column"
    assert got.pop("find column in company") == "schema_report"
    assert got == {q: i for q, i in QUESTIONS.items() if q != "find column in company"}
    words_only = ask.question_intents(asked, "q", about.select("company"))
    assert {r["q"]: r["intent"] for r in words_only.collect()}["average revenue"] == "first_rows"


def test_lookups(spark):
    rows = [(i, c) for i, c in enumerate([" hp ", "HP", "hpe", "Dell", "50% off", "50 off", None])]
    df = spark.createDataFrame(rows, "k int, company string")
    exact = ask.lookup_exact(df, "company", "Hp", ["k"]).collect()
    assert [(r["k"], r["total_matches"]) for r in exact] == [(0, 2), (1, 2)]
    assert [r["k"] for r in ask.lookup_exact(df, "company", "ELL", ["k"]).collect()] == [3]
    assert [r["k"] for r in ask.lookup_contains(df, "company", "0% O", ["k"]).collect()] == [4]
    many = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("company"))
    found = ask.lookup_exact(many, "company", "X", ["k"]).collect()
    assert len(found) == 10 and found[0]["total_matches"] == 500


def test_group_totals_keep_missing_totals(spark):
    df = spark.createDataFrame([("us", 120), ("us", 80), ("eu", 250), (None, 5), ("x", None)], "region string, revenue int")
    assert [tuple(r) for r in ask.group_total(df).collect()] == [("eu", 250), ("us", 200), (None, 5), ("x", None)]
    assert ask.group_total(df, lowest=True).first()["region"] == "x"


def test_rows_and_summary(spark):
    df = spark.createDataFrame([(i, float(i), None) for i in range(8)], "k int, v double, e double")
    assert [r["k"] for r in ask.tail_rows(df, ["k"], 3).collect()] == [5, 6, 7]
    assert ask.head_rows(df, ["k"], 0).count() == 1
    summary = {r["metric_column"]: r for r in ask.numeric_summary(df).collect()}
    assert set(summary) == {"k", "v"} and summary["v"]["median_value"] == 3.5
    assert [r["null_count"] for r in ask.schema_report(df).orderBy("ordinal").collect()] == [0, 0, 8]


def test_passages(spark):
    long = "x" * 450
    docs = [(1, f"short\n\n  {long}  \n\n{'y' * 31}"), (2, "tiny\n\nbits"), (3, "  \n "), (4, None), (5, "z" * 30)]
    df = spark.createDataFrame(docs, "id int, text string")
    got = {(r["id"], r["passage_no"]): r for r in retrieval.passages(df, "id", "text").collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0), (5, 0)}
    assert got[1, 0]["full_text"] == long and got[1, 0]["snippet"] == "x" * 400 + "..."
    assert got[2, 0]["full_text"] == "tiny\n\nbits"


CORPUS = [(1, "apple banana apple"), (2, "banana cherry"), (3, "the of and"), (4, "durian_7 apple"), (5, "")]


def expected_weights():
    words = {i: [w for w in t.split() if w not in ENGLISH] for i, t in CORPUS}
    terms = {w for ws in words.values() for w in ws}
    idf = {t: math.log((1 + len(CORPUS)) / (1 + sum(t in ws for ws in words.values()))) + 1 for t in terms}
    weights = {}
    for i, ws in words.items():
        raw = {t: ws.count(t) * idf[t] for t in ws}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        weights.update({(i, t): v / norm for t, v in raw.items()})
    return weights


def test_tfidf(spark):
    docs = spark.createDataFrame(CORPUS, "id int, text string")
    got = {(r["id"], r["term"]): r["weight"] for r in retrieval.tfidf(docs, "id", "text").collect()}
    assert got == pytest.approx(expected_weights())


def test_retrieval(spark, monkeypatch):
    docs = spark.createDataFrame(CORPUS, "id int, text string")
    queries = spark.createDataFrame([(1, "Cherry BANANA"), (2, "unknown words"), (3, "apple")], "q int, text string")

    def found():
        rows = retrieval.retrieve(docs, "id", "text", queries, "q", "text", 3).orderBy("q", "rank").collect()
        return [(r["q"], r["id"], r["relevance"]) for r in rows]

    broadcast = found()
    assert [b[:2] for b in broadcast] == [(1, 2), (1, 1), (1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 4), (3, 2)]
    assert broadcast[0][2] == 100 and broadcast[3][2] == 0
    monkeypatch.setattr(retrieval, "fits_broadcast", lambda *_: False)
    assert found() == broadcast
    assert retrieval.retrieve(docs.limit(0), "id", "text", queries, "q", "text").count() == 0


def test_knowledge_sources(spark):
    rows = [("Laptop", 1200.0, "tech"), ("Phone", 800.0, "tech"), ("Desk", 300.5, None), ("Chair", 150.0, "home")]
    df = spark.createDataFrame(rows, "product string, price double, category string")
    known = {r["title"]: r for r in retrieval.knowledge_rows(df, "shop").collect()}
    assert len(known) == 6
    assert "minimum 150.0, maximum 1,200.0, mean 612.62 over 4 values" in known["Column Statistics: price"]["snippet"]
    assert "'tech' (2), 'home' (1)" in known["Categorical Distribution: category"]["snippet"]
    asked = spark.createDataFrame([(1, "price statistics"), (2, "outlier clipping policy")], "q int, text string")
    best = {r["q"]: r["title"] for r in retrieval.sources(df, "shop", asked, "q", "text").filter("rank = 1").collect()}
    assert "STATISTICS · " in best[1] and "price" in best[1]
    assert best[2].startswith("[POLICY · ")


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,code,flag,price,note,day\n1,007,True,1.5,NA,2024-01-02\n2,N/A,FALSE,,"a ""q"", b",2024-01-03\n3,9,,2,<NA>,\n')
    df = readers.read_table(spark, str(path))
    assert df.dtypes == [("id", "bigint"), ("code", "bigint"), ("flag", "boolean"), ("price", "double"), ("note", "string"), ("day", "string")]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 7, True, 1.5, None, "2024-01-02"), (2, None, False, None, 'a "q", b', "2024-01-03"), (3, 9, None, 2.0, None, None),
    ]


def test_csv_keeps_long_identifiers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n9223372036854775807,9223372036854775808, 5\n1,2,7 \n")
    df = readers.read_csv(spark, str(path))
    assert df.dtypes == [("a", "bigint"), ("b", "string"), ("c", "bigint")]
    assert {r["a"] for r in df.collect()} == {9223372036854775807, 1}


def test_csv_with_line_breaks_in_values(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,note\n1,"two\nlines"\n2,x\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(path)).orderBy("id").collect()] == [(1, "two\nlines"), (2, "x")]


def test_json_lines_and_arrays(spark, tmp_path):
    records = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    for name in ("lines.json", "array.json"):
        rows = readers.read_table(spark, str(tmp_path / name)).orderBy("a").collect()
        assert [(r["a"], r["b"]) for r in rows] == [(1, "x"), (2, None)]


def test_guards(spark):
    with pytest.raises(ValueError, match="no data rows"):
        readers.require_rows(spark.createDataFrame([], "a int"))
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, "x.xlsx")
    with pytest.raises(ValueError, match="unsupported"):
        writers.store(spark.range(1), "x", "xml")


def test_csv_round_trip_keeps_padding(spark, tmp_path):
    df = spark.createDataFrame([(1, " a "), (2, None)], "k long, t string")
    path = writers.store(df, str(tmp_path / "out.csv"), "csv")
    assert readers.read_table(spark, path).orderBy("k").collect() == df.collect()


def test_json_safe(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (1.5, 3)], "v double, k int").withColumn("d", F.lit("2024-01-02").cast("date"))
    assert [tuple(r) for r in writers.json_safe(df).orderBy("k").collect()] == [
        (None, 1, "2024-01-02"), (None, 2, "2024-01-02"), (1.5, 3, "2024-01-02"),
    ]


def test_audit_over_runs(spark, tmp_path):
    path = str(tmp_path / "audit")
    for run in range(2):
        trail = audit.AuditTrail(f"data{run}", run_id=f"run{run}")
        trail.log("Planner", "Built plan", "why", "build_plan")
        trail.stage("Planner", "done")
        trail.log("Cleaning", "fill_missing", "gaps", "fill_missing", output="3")
        trail.append_to(spark, path)
    stored = spark.read.parquet(path)
    assert [r["action"] for r in audit.run_log(stored, "run1").collect()] == ["Built plan", "fill_missing"]
    assert [r["run_id"] for r in audit.newest_first(stored).collect()] == ["run1", "run1", "run0", "run0"]


def test_summary_without_runs(spark):
    empty = spark.createDataFrame([], "run_id string, dataset_id string, status string, rows long, quality double, finished_at timestamp")
    row = audit.run_summary(empty).first()
    assert (row["total_datasets"], row["successful_runs"], row["average_quality"], row["recent_runs"]) == (0, 0, 0.0, [])


def test_texts_without_long_pieces_are_cut_whole(spark):
    body = "\n\n".join(["x" * 30] * 100)
    got = retrieval.passages(spark.createDataFrame([(1, body)], "id int, text string"), "id", "text").orderBy("passage_no").collect()
    assert "".join(r["full_text"] for r in got) == body and len(got) == 6


def test_json_folders_of_both_kinds(spark, tmp_path):
    (tmp_path / "a b.json").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "b.json").write_text('[{"a": 3},\n {"a": 4, "b": "x"}]\n')
    got = readers.read_json(spark, str(tmp_path))
    assert sorted((r["a"], r["b"]) for r in got.select("a", F.coalesce("b", F.lit("")).alias("b")).collect()) == [(1, ""), (2, ""), (3, ""), (4, "x")]
    assert sorted(got.columns) == ["a", "b"]


def test_head_and_tail_have_no_cap(spark):
    df = spark.range(300).toDF("k")
    assert ask.head_rows(df, ["k"], 200).count() == 200 and ask.tail_rows(df, ["k"], 200).count() == 200


def test_schema_row_searches_every_column(spark):
    df = spark.range(1).selectExpr(*[f"id AS c{i}" for i in range(14)])
    row = retrieval.schema_row(df, "wide").first()
    assert "c13 (bigint)" in row["full_text"] and "+4 more" in row["snippet"]


@pytest.mark.parametrize("limit", [0, 1, 3, 100])
def test_weights_of_a_long_dictionary(spark, monkeypatch, limit):
    """Frequent, rare and single terms weigh the same wherever their idf comes from; ids repeat or are null."""
    words = [[f"w{j}" for j in range(40) if i % (j + 1) == 0] + [f"only{i}", "w0", "the"] for i in range(30)]
    rows = [(None if i % 13 == 5 else i % 25, " ".join(ws)) for i, ws in enumerate(words)] + [(90, None), (91, "")]
    docs = spark.createDataFrame(rows, "id int, text string")
    n, counts = len(rows), {}
    for i, text in rows:
        for w in (text or "").split():
            if w not in ENGLISH:
                counts.setdefault(i, {}).setdefault(w, 0)
                counts[i][w] += 1
    df = {w: sum(w in (t or "").split() for _, t in rows) for ws in counts.values() for w in ws}
    raw = {i: {w: k * (math.log((1 + n) / (1 + df[w])) + 1) for w, k in ws.items()} for i, ws in counts.items()}
    want = {(i, w): v / math.sqrt(sum(x * x for x in ws.values())) for i, ws in raw.items() for w, v in ws.items()}
    monkeypatch.setattr(retrieval, "TASK_CHARACTERS", 100)
    weights, idf = retrieval._weighted(docs, "id", "text", ENGLISH, limit)
    got = weights.collect()
    assert len(got) == len(want) and {(r["id"], r["term"]): r["weight"] for r in got} == pytest.approx(want)
    assert idf.count() == len(df)
    # no dictionary is copied for salted joins, counts are never shuffled by term
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "__salt" not in plan and "SortMergeJoin" not in plan
