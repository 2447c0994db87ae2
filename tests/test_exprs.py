"""EXP-1..16 on literal rows."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions import exprs as X


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr(F.col("v")).alias("r")).first()["r"]


def test_text_norm_strings(spark):
    df = spark.createDataFrame([(None,), ("  a b  ",), (" x　",), ("\t\n",)], "v string")
    got = [r["r"] for r in df.select(X.text_norm("v").alias("r")).collect()]
    assert got == ["", "a b", "x", ""]


def test_text_norm_numeric_zero_and_false_are_blank(spark):
    df = spark.createDataFrame([(0, False), (7, True), (None, None)], "n long, b boolean")
    got = [(r["n"], r["b"]) for r in df.select(
        X.text_norm(F.col("n"), df.schema["n"].dataType).alias("n"),
        X.text_norm(F.col("b"), df.schema["b"].dataType).alias("b")).collect()]
    assert got == [("", ""), ("7", "True"), ("", "")]


def same_identifier(a, b):
    """The identifier rule written out directly (ASCII digits)."""
    left, right = (a or "").strip(), (b or "").strip()
    if left == right:
        return True
    digits = set("0123456789")
    if left and right and set(left) <= digits and set(right) <= digits:
        return (left.lstrip("0") or "0") == (right.lstrip("0") or "0")
    return False


ids = st.one_of(st.none(), st.text(alphabet="0 1a", max_size=5))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(ids, ids), min_size=1, max_size=20))
def test_canon_id_equality_is_same_identifier(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r["eq"] for r in df.select((X.canon_id("a") == X.canon_id("b")).alias("eq")).collect()]
    assert got == [same_identifier(a, b) for a, b in pairs]


def test_canon_id_examples(spark):
    df = spark.createDataFrame([("00120",), ("0000",), (" 42 ",), ("8.41E+08",), (None,)], "v string")
    assert [r["c"] for r in df.select(X.canon_id("v").alias("c")).collect()] == ["120", "0", "42", "8.41E+08", ""]


def test_prefix_and_file_name(spark):
    df = spark.createDataFrame([(" /a/b ",), ("a/b/",), ("",), ("/",)], "v string")
    assert [r["p"] for r in df.select(X.normalise_prefix("v").alias("p")).collect()] == ["a/b/", "a/b/", "", ""]
    assert one(spark, X.file_name, "x/y/z.csv") == "z.csv"
    assert one(spark, X.file_name, "z.csv") == "z.csv"


def test_process_uuid(spark):
    assert one(spark, X.process_uuid, "p_12345678-aaaa-bbbb-cccc-0123456789ab_part1.csv") == \
        "12345678-aaaa-bbbb-cccc-0123456789ab"
    assert one(spark, X.process_uuid, "practice_batch.csv") is None


def test_json_normalise(spark):
    df = spark.createDataFrame([(' {"b": 1, "a": [1, 2]}',), ("{oops",), ("plain text",), ("[1, 2]",)], "v string")
    got = [r["j"] for r in df.select(X.json_normalise("v").alias("j")).collect()]
    assert got == ['{"a":[1,2],"b":1}', "{oops", "plain text", "[1,2]"]


def test_first_lines_and_percent(spark):
    text = "\n".join(f"l{i}" for i in range(30))
    assert one(spark, lambda c: X.first_lines(c, 20), text) == "\n".join(f"l{i}" for i in range(20))
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 5)], "n long, d long")
    got = [r["t"] for r in df.select(X.pct_text(X.pct_tenths("n", "d")).alias("t")).collect()]
    assert got == ["33.3%", "66.7%", "0.0%"]


def test_casefold_sharp_s(spark):
    assert one(spark, X.casefold, "Straße") == one(spark, X.casefold, "STRASSE")


def test_rule_aliases(spark):
    df = spark.createDataFrame([(15,)], "r int")
    got = df.select(X.rule_aliases("r").alias("a")).first()["a"]
    assert got == ["15", "rule-15", "rule_15", "prac-15", "practice-15", "facility-15"]


def test_in_values_rejects_empty():
    import pytest

    with pytest.raises(ValueError):
        X.in_values("v", [])
