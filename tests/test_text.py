import pytest
from pyspark.sql import functions as F

from budgetloom.functions.ora import bare, cat, instr_last, nz, substr, to_whole


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, pos, n, want",
    [
        ("abc", 1, 2, "ab"),
        ("abc", 0, 2, "ab"),
        ("abc", -2, None, "bc"),
        ("abc", -2, 1, "b"),
        ("abc", -5, 4, None),
        ("abc", 4, 1, None),
        ("abc", 1, -1, None),
        ("abc", 1, 0, None),
        (None, 1, 1, None),
    ],
)
def test_substr(spark, text, pos, n, want):
    s = F.lit(text).cast("string")
    assert value(spark, nz(substr(s, pos, n))) == want
    assert value(spark, nz(substr(s, F.lit(pos), None if n is None else F.lit(n)))) == want


@pytest.mark.parametrize("text, nth, want", [("a_b_c", 1, 4), ("a_b_c", 2, 2), ("a_b_c", 3, 0), ("abc", 1, 0), ("_", 1, 1), (None, 1, None)])
def test_instr_last(spark, text, nth, want):
    assert value(spark, instr_last(F.lit(text).cast("string"), "_", nth)) == want


def test_concatenation_treats_null_as_empty(spark):
    null = F.lit(None).cast("string")
    assert value(spark, cat(F.lit("a"), null, F.lit("b"))) == "ab"
    assert value(spark, cat(null, null)) is None


def test_bare_drops_quotes_then_spaces(spark):
    assert value(spark, bare(F.lit("' 12 '"))) == "12"
    assert value(spark, nz(bare(F.lit("''")))) is None


@pytest.mark.parametrize("text, want", [("12", 12), ("12.5", 13), ("-12.5", -13), (" 7 ", 7), (".4", 0)])
def test_to_whole_rounds_half_away_from_zero(spark, text, want):
    assert value(spark, to_whole(F.lit(text))) == want


def test_to_whole_raises_on_other_text(spark):
    with pytest.raises(Exception, match="not a number"):
        value(spark, to_whole(F.lit("12a")))


def test_decimal_cast_rounds_half_away_from_zero(spark):
    rows = spark.sql("select cast(v as decimal(38,2)) as v from values (2.345), (-2.345), (2.344) as t(v)").collect()
    assert [str(r["v"]) for r in rows] == ["2.35", "-2.35", "2.34"]
