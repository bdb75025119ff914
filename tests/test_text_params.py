"""Definition text parsing and runtime parameters (driver-side helpers)."""

import pytest

from parity.functions.params import bind, parse_parameter_text, placeholders, report
from parity.functions.text import output_name, parse_join_key, split_list, unique


def test_split_list_respects_parentheses_and_quotes():
    assert split_list("a, COALESCE(b, c), 'x,y', SUM(a + b)") == ["a", "COALESCE(b, c)", "'x,y'", "SUM(a + b)"]
    assert split_list("") == [] and split_list(None) == []
    assert split_list(" a ,, b ") == ["a", "b"]


def test_output_name_rule():
    assert output_name("points") == "points"
    assert output_name("SUM(points)") == "SUM_points"
    assert output_name("sum(closing_balance)") == "sum_closing_balance"
    assert output_name("COUNT(*)") == "COUNT__"
    assert output_name("COUNT(1) - 1") == "COUNT_1_1"
    assert output_name("COUNT(DISTINCT o_custkey)") == "COUNT_DISTINCTo_custkey"


def test_parse_join_key():
    assert parse_join_key("a = b") == [("a", "b")]
    assert parse_join_key("a = b AND c=d") == [("a", "b"), ("c", "d")]
    assert parse_join_key("brand = brand and x = y") == [("brand", "brand"), ("x", "y")]
    assert parse_join_key("1 = 1") == [] and parse_join_key("") == [] and parse_join_key(None) == []
    with pytest.raises(ValueError):
        parse_join_key("a and b = c")


def test_unique_keeps_first():
    assert unique(["c", "k", "c"]) == ["c", "k"]


def test_bind_rewrites_placeholders_case_insensitively():
    b = bind("REF_DATE = ? and view_code=?", {"ref_date": "2025-12-31", "VIEW_CODE": 3})
    assert b.text == "REF_DATE = :ref_date and view_code = :view_code"
    assert b.args == {"ref_date": "2025-12-31", "view_code": 3}
    assert b.missing == []
    assert bind("a = ? and b = ?", {"a": 1}).missing == ["b"]
    assert bind("x >= ?", {"x": 1}).text == "x >= ?"   # only equality placeholders bind
    assert placeholders("a=? OR A = ?") == ["a"]


def test_report_lists_applied_parameters_in_caller_order():
    params = {"unused": 1, "b": "x'y", "a": 2}
    b1, b2 = bind("a = ?", params), bind("b = ? and a = ?", params)
    assert report(params, b1, b2) == "b='x''y' | a=2"
    assert report(params, bind("1 = 1", params)) == "N/A"


def test_parse_parameter_text():
    got = parse_parameter_text("ref_date='2025-12-31', view_code=3, rate=0.5, flag=true, code=(A,B)")
    assert got == {"ref_date": "2025-12-31", "view_code": 3, "rate": 0.5, "flag": True, "code": "(A,B)"}


def test_parse_parameter_text_in_parentheses():
    want = {"REF_DATE": "2025-12-31", "PART_DATE": "2025-11-30"}
    assert parse_parameter_text("(REF_DATE='2025-12-31'),(PART_DATE='2025-11-30')") == want
    assert parse_parameter_text("((REF_DATE='2025-12-31'), (PART_DATE='2025-11-30'))") == want
    assert parse_parameter_text("") == {}
    with pytest.raises(ValueError):
        parse_parameter_text("REF_DATE='2025-12-31', oops")


def test_bound_filter_runs_with_typed_values(spark):
    from parity.sources.relation import where
    df = spark.createDataFrame([(1, "a"), (2, "b'c")], "k int, s string")
    out, b = where(spark, df, "s = ? AND k = ?", {"s": "b'c", "k": 2})
    assert [r.k for r in out.collect()] == [2]
    with pytest.raises(ValueError):
        where(spark, df, "s = ?", {})


def test_columns_of(spark):
    from parity.sources import columns_of
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert columns_of(df) == ["a", "b", "c", "d"]
    assert columns_of(df, exclude=["b"], stop_before="d") == ["a", "c"]
    assert columns_of(df, stop_before="zz") == ["a", "b", "c", "d"]


def test_key_text_quotes_nulls_and_separators(spark):
    from pyspark.sql import functions as F
    from parity.functions import columns as C
    df = spark.createDataFrame([("O'Brien", None, 3)], "a string, b string, c int")
    row = df.select(C.key_text(["a", "b", "c"]).alias("x"),
                    C.key_text(["a", "c"], sep=C.KEY_SEP_GROUPED).alias("y")).first()
    assert row.x == "a='O''Brien' , b IS NULL , c='3'"
    assert row.y == "a='O''Brien', c='3'"
    assert C.null_key_text(["a", "b"]) == "a IS NULL , b IS NULL"
    # the text is a usable predicate
    assert df.where(row.x.replace(" , ", " AND ")).count() == 1
    assert df.where(F.expr(row.y.replace(", ", " AND "))).count() == 1


def test_output_names_are_unique():
    from parity.functions.text import output_names
    assert output_names(["k", "v + 1", "v - 1"]) == ["k", "v_1", "v_1_2"]
    assert output_names(["k", "v", "V", "v"]) == ["k", "v", "V_2", "v_3"]
    assert output_names(["v + 1", "v_1"]) == ["v_1_2", "v_1"]            # a column keeps its own name
    assert output_names(["v + 1"], reserved=["v_1"]) == ["v_1_2"]
    assert output_names(["v_1", "v + 1", "v - 1", "v_1_2"]) == ["v_1", "v_1_3", "v_1_4", "v_1_2"]


def test_placeholders_inside_quotes_or_comments_are_none():
    from parity.functions.params import bound_text
    text = """n <> 'x = ?' AND s <> "y = ?" AND `z = ?` = 1 AND k = ? -- w = ?
              AND t <> 'it''s u = ?' /* v = ? */ AND e <> 'a\\'b = ?'"""
    assert placeholders(text) == ["k"]
    b = bind(text, {"k": 3})
    assert b.missing == [] and b.text == text.replace("k = ?", "k = :k") and b.args == {"k": 3}
    assert bound_text(text, {"k": 3}) == text.replace("k = ?", "k = 3")
    assert bind("n <> 'x = ?'", {}).missing == []
