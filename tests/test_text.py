import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.functions.text import blank_comma, flag, has_tags, java_split, place_label, tag_list, words


def java_parts(text, separator):
    """What splitting with trailing empty parts dropped gives."""
    if not text:
        return [""]
    parts = text.split(separator)
    while parts and not parts[-1]:
        parts.pop()
    return parts


@pytest.mark.parametrize("separator", [" ", ",", "|", ".", "\t", "::", "||"])
@settings(max_examples=3, deadline=None)
@given(data=st.data())
def test_java_split(spark, separator, data):
    letter = st.sampled_from(["a", "é", "\n", *separator, separator])
    texts = data.draw(st.lists(st.lists(letter, max_size=8).map("".join), min_size=5, max_size=20))
    texts += ["", separator, separator * 3, f"a{separator}", f"{separator}a", f"a{separator}{separator}b", f"a{separator}\n"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = df.select("value", java_split(F.col("value"), separator).alias("parts")).collect()
    for row in got:
        assert row.parts == java_parts(row.value, separator), (row.value, separator)


def test_split_of_null_is_null(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert df.select(words(F.col("value")).alias("w")).first().w is None


def test_line_edge_cases(spark):
    df = spark.createDataFrame([("",), ("   ",), ("a  b",), ("a b  ",), ("ñandú über",)], "value string")
    found = {r.value: r.w for r in df.select("value", words(F.col("value")).alias("w")).collect()}
    assert found == {
        "": [""], "   ": [], "a  b": ["a", "", "b"], "a b  ": ["a", "b"], "ñandú über": ["ñandú", "über"],
    }


def test_tags(spark):
    raw = ["a,,b,,", "", ",", "x+y,caf%C3%A9", "one%2Ctwo", "a"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    tags = tag_list(F.col("raw"))
    found = {r.raw: (r.tags, r.has) for r in df.select("raw", tags.alias("tags"), has_tags(tags).alias("has")).collect()}
    assert found == {
        "a,,b,,": (["a", "", "b"], True),
        "": ([""], False),
        ",": ([], False),
        "x+y,caf%C3%A9": (["x y", "café"], True),
        "one%2Ctwo": (["one", "two"], True),
        "a": (["a"], True),
    }


def test_bad_encoding(spark):
    df = spark.createDataFrame([("%zz",)], "raw string")
    with pytest.raises(Exception):
        df.select(tag_list(F.col("raw"))).collect()
    assert df.select(tag_list(F.col("raw"), strict=False).alias("t")).first().t is None


def test_labels_titles_flags(spark):
    df = spark.createDataFrame([("FR", ["a", "b"])], "c string, tags array<string>")
    assert df.select(place_label(F.col("c"), F.col("tags")).alias("l")).first().l == "(FR, a, b)"
    df = spark.createDataFrame([('"Game, The"',), ("20,000 Leagues",)], "t string")
    assert [r.t for r in df.select(blank_comma(F.col("t")).alias("t")).collect()] == ["Game The", "20,000 Leagues"]
    df = spark.createDataFrame([("1",), ("0",), ("true",), ("",), ("maybe",), (None,)], "f string")
    assert [r.f for r in df.select(flag(F.col("f")).alias("f")).collect()] == [True, False, True, None, None, None]
