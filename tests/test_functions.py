"""Scalar functions on hand-made rows (FIXTURES 5: edge rows)."""

from pyspark.sql import functions as F

from quarry import functions as qf


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def col_values(df, name):
    return [r[name] for r in df.collect()]


def test_tokens_follow_jvm_split(spark):
    df = one_col(spark, ["a,b,,", ",,,", "", ",a", "a,,b", None])
    got = col_values(df.select(qf.tokens("v", ",").alias("t")), "t")
    assert got == [["a", "b"], [], [""], ["", "a"], ["a", "", "b"], None]


def test_tokens_space_before_final_newline(spark):
    # JVM: "abc \n".split(" ") -> ["abc", "\n"]; a '$' anchor would strip the space
    got = col_values(one_col(spark, ["abc \n"]).select(qf.tokens("v", " ").alias("t")), "t")
    assert got == [["abc", "\n"]]


def test_field_out_of_range_is_null(spark):
    df = one_col(spark, ["a,b,c", "a"])
    assert col_values(df.select(qf.field("v", ",", 2).alias("f")), "f") == ["c", None]


def test_replace_is_literal(spark):
    df = one_col(spark, ["a.b.c"])
    assert col_values(df.select(qf.replace_all("v", ".", "\t").alias("r")), "r") == ["a\tb\tc"]


def test_cleanse_doors_full_match(spark):
    df = one_col(spark, ["two", "four", "twofold", None])
    got = col_values(df.select(qf.recode_full_match("v", "two", "2", "4").alias("d")), "d")
    assert got == ["2", "4", "4", None]


def test_recode_contains(spark):
    df = one_col(spark, ["two", "four", "sedan", "hatchback"])
    got = col_values(df.select(qf.recode_contains("v", "two").alias("d")), "d")
    assert got == [0.0, 1.0, 1.0, 1.0]


def test_recode_map_falls_through_to_cast(spark):
    df = one_col(spark, ["M", "F", "2", "x"])
    got = col_values(df.select(qf.recode_map("v", {"M": 1.0, "F": 2.0}).alias("s")), "s")
    assert got == [1.0, 2.0, 2.0, None]  # 'x' is no code and no number: null, not a failure


def test_indicators(spark):
    df = one_col(spark, ["married", "single", "divorced"])
    out = df.select(*qf.indicators("v", ["single", "married"], prefix="is_")).collect()
    assert [tuple(r) for r in out] == [(0.0, 1.0), (1.0, 0.0), (0.0, 0.0)]


def test_parse_int_or_zero(spark):
    df = spark.createDataFrame([("12", None), ("", None), ("x", "7"), ("x", "y"), ("3a", "-1")],
                               "v string, f string")
    got = col_values(df.select(qf.parse_int_or_zero("v", F.col("f")).alias("n")), "n")
    assert got == [12, 0, 7, 0, 0]


def test_parse_float_full_match(spark):
    df = one_col(spark, ["5.1", "-0.5", "1,5", "01.5", "5.1x", "", "Sepal.Length"])
    got = col_values(df.select(qf.parse_float("v").alias("x")), "x")
    assert got == [5.1, -0.5, 1.5, None, None, None, None]
    got0 = col_values(df.select(qf.parse_float_or_zero("v").alias("x")), "x")
    assert got0[-1] == 0.0


def test_round_half_up_matches_jvm(spark):
    df = one_col(spark, [-25.0, -15.0, 15.0, 24.9, 25.0], "double")
    got = col_values(df.select(qf.round_half_up("v", 10).alias("r")), "r")
    assert got == [-20.0, -10.0, 20.0, 20.0, 30.0]
    # F.round rounds half away from zero instead
    assert col_values(df.select(F.round(F.col("v") / 10).alias("r")), "r")[0] == -3.0


def test_cap_mean_ratio(spark):
    df = spark.createDataFrame([(150.0, -3.0, -3.0)], "a double, b double, c double")
    r = df.select(qf.cap("a", 100.0).alias("cap"), qf.row_mean_abs(["b", "c"]).alias("m"),
                  qf.ratio_pct("a", "b").alias("p"), qf.rounded_pct(F.lit(1), F.lit(3)).alias("q")).first()
    assert (r.cap, r.m, r.p, r.q) == (100.0, 3.0, 150.0 / -2.0 * 100, 33.0)


def test_impute_sentinel(spark):
    df = one_col(spark, ["?", "130", "12?"])
    assert col_values(df.select(qf.impute_sentinel("v").alias("x")), "x") == [80.0, 130.0, 80.0]


def test_label_threshold(spark):
    df = one_col(spark, ["5.9", "5.0", "Sepal"])
    v = qf.parse_float("v")
    got = col_values(df.select(qf.label_threshold(v, 5.8433).alias("l")), "l")
    assert got == ["high", "low", "Error"]


def test_number_and_pattern_tests_cover_the_whole_value(spark):
    from quarry import functions as qf
    df = spark.createDataFrame([("two\n",), ("two",), ("12\n",), ("12000000.0",), ("0.0004",)], "v string")
    got = [tuple(r) for r in df.select(qf.recode_full_match("v", "two", "2", "4"), qf.parse_int_or_zero("v"), qf.parse_float_or_zero("v")).collect()]
    assert got == [("4", 0, 0.0), ("2", 0, 0.0), ("4", 0, 0.0), ("4", 0, 12000000.0), ("4", 0, 0.0004)]
    big = spark.createDataFrame([(12_000_000.0,), (4e-4,), (None,)], "x double")
    assert [r[0] for r in big.select(qf.label_threshold(F.col("x"), F.lit(1.0))).collect()] == ["high", "low", "Error"]
