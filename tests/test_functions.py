"""Text, date and name rules."""

import datetime

from pyspark.sql import functions as F

from tidyspark.functions import names, text


def applied(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_strip_removes_all_white_space(spark):
    assert applied(spark, ["\t x　", "\xa0y\n", "z", "", None], text.strip) == ["x", "y", "z", "", None]
    assert applied(spark, [" x", "x\t", "x", "", " ", None], text.is_padded) == [True, True, False, False, True, None]


def test_numbers(spark):
    values = ["$4,250.00", " $ 5 ", "-$4", "5d", "nan", "inf", "1e5", "-.5", "5.", "", "$", "- 5", "0x10", ".", None]
    expected = [4250.0, 5.0, -4.0, None, None, None, 1e5, -0.5, 5.0, None, None, None, None, None, None]
    assert applied(spark, values, text.to_number) == expected
    assert applied(spark, values, text.is_number) == [None if v is None else e is not None for v, e in zip(values, expected)]


def test_raw_patterns_agree_with_rewritten_values(spark):
    values = ["1,2,3", "$1,000", "$1,000.5", "5 $", "+7", "1" * 18, "1" * 19, "1_000", "1e", "$-4.00", "\t8 "]
    rewritten = applied(spark, values, lambda v: F.rlike(text.plain_number(v), F.lit(text.NUMBER_PATTERN)))
    assert applied(spark, values, text.is_number) == rewritten
    integers = applied(spark, values, lambda v: F.rlike(text.plain_number(v), F.lit(text.INTEGER_PATTERN)))
    assert applied(spark, values, text.is_integer) == integers


def test_boolean_words(spark):
    values = [" YES ", "n", "1", "0", "True", "maybe", "", None]
    assert applied(spark, values, text.is_boolean_word) == [True, True, True, True, True, False, False, None]
    assert applied(spark, values, text.to_yes_no) == ["Yes", "No", "Yes", "No", "Yes", "maybe", "", None]


def test_dates(spark):
    day = datetime.date
    cases = {
        "2024-03-14": day(2024, 3, 14), "2024/1/2": day(2024, 1, 2), "14-03-2024": day(2024, 3, 14),
        "01/02/2024": day(2024, 1, 2), "13/13/2024": None, "March 2 2025": day(2025, 3, 2),
        "mar 2, 2025": day(2025, 3, 2), "2 March 2025": day(2025, 3, 2), "Mary 2 2025": None,
        "20240101": day(2024, 1, 1), "2024-02-30": None, "2024-01-02T10:00:00Z": day(2024, 1, 2),
        "2024-01-02 25:00": None, " 2024-03-14\t": day(2024, 3, 14), "hello": None, "2024": None, "2024-03": None,
        "1/2-2024": None, "": None, "01/05/2025 14:30": day(2025, 1, 5), "5 Mar 2025 09:00": day(2025, 3, 5),
        "01/05/25": day(2025, 1, 5), "13/05/99": day(1999, 5, 13), "05.01.2025": day(2025, 5, 1),
        "Mar 2, 2025 9:05 PM": day(2025, 3, 2), "01/05/2025 14:30 PM": None, "05-Mar-2025": day(2025, 3, 5),
        "2024-01-02 10:00:00.5+02:00": day(2024, 1, 2), "10:30": None, "1.2.3": None,
    }
    assert applied(spark, list(cases), text.to_date) == list(cases.values())


def test_title_case_is_pythons(spark):
    values = [
        "o'neil abc12def D'ÉTÉ ORD-1001", "geß ßa", "hello  world\nnew\tline", "ab c", "3RD-b",
        "don't. stop,now", "x_y  z", "", "ÄÖ-ü", "1a2b3c",
    ]
    assert applied(spark, values, text.title_case) == [v.title() for v in values]


def test_region_codes(spark):
    def region(value):
        return text.normalise_text(value, region=True)

    assert applied(spark, [" us ", "india", "u2", "é", ""], region) == ["US", "India", "U2", "É", ""]


def test_snake_case():
    assert names.unique_snake_case(["Order ID #", " order id", "??", "!!", "Unit Price ($)", "a", "A", "a_2"]) == [
        "order_id", "order_id_2", "column", "column_2", "unit_price", "a", "a_2", "a_2_2",
    ]


def test_target_rules(spark):
    frame = spark.createDataFrame([("a", 1, 2.0)], "status string, amount int, total double")
    assert names.infer_target(frame) == "status"
    assert names.infer_target(frame, "total") == "total"
    assert names.infer_target(frame.select("amount", "total")) == "total"
    assert names.infer_target(frame.select(F.lit("x").alias("word"))) is None
    assert names.resolve_target(["Is Return?", "is_return", "b"], "IS-RETURN") == "is_return"
    assert names.resolve_target(["my_label_x", "b"], "label") == "my_label_x"
    assert names.resolve_target(["a", "b"], "zzz") == "b"
    assert names.model_features(["id", "name", "x", "y"], "y") == ["x"]
    assert names.model_features(["id", "y"], "y") == ["id"]
    assert names.find_column(frame, "what is the total amount") == "amount"
    assert names.default_group(frame) == "status"
    assert names.default_metric(frame) == "amount"
