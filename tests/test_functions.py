import datetime
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.functions import arrays, draws, flags, similarity, text
from lakeops.models import synth


def values(df):
    return [r[0] for r in df.collect()]


def test_strip_removes_matches_anywhere(spark):
    df = spark.createDataFrame([("z_No",), ("jazz_z_x",), ("<High",), ("",), (None,)], "t string")
    assert values(df.select(text.strip_pattern(F.col("t")))) == ["No", "jazx", "<High", "", None]
    assert values(df.select(text.strip_pattern(F.col("t"), text.PREFIX_OR_LESS_THAN)))[2] == "High"


def test_money(spark):
    df = spark.createDataFrame([("$1,234.50",), ("12",), ("",), ("n/a",), (None,), ("$-3",)], "t string")
    assert values(df.select(text.money_to_double(F.col("t")))) == [1234.5, 12.0, None, None, None, -3.0]


def test_clean_columns_moves_cleaned_last_and_checks_names(spark):
    df = spark.createDataFrame([("z_a", "$1", 7)], "a string, m string, k int")
    cleaned = text.clean_columns(df, {"a": "z_"}, ["m"])
    assert cleaned.columns == ["k", "a", "m"] and cleaned.first() == (7, "a", 1.0)
    for strip, money in (({"x": "z_"}, []), ({"a": "z_"}, ["a"])):
        with pytest.raises(ValueError):
            text.clean_columns(df, strip, money)


def test_three_flag_forms_agree(spark):
    df = spark.createDataFrame([(1, "PhD"), (2, "O'x"), (3, None), (4, "a\\b")], "k int, e string")
    df.createOrReplaceTempView("flag_rows")
    for chosen in (["PhD"], ["PhD", "O'x"], ["a\\b"]):
        by_column = values(df.orderBy("k").select(flags.flag_in(F.col("e"), chosen)))
        by_sql = values(flags.flag_in_sql(spark, "flag_rows", {"f": ("e", chosen)}, ("k",)).orderBy("k").select("f"))
        by_text = values(df.orderBy("k").selectExpr(flags.flag_in_expr("e", chosen, "f")))
        assert by_column == by_sql == by_text == [int(e in chosen) for e in ("PhD", "O'x", None, "a\\b")]


@pytest.mark.parametrize("size", [-1, 0, 1, 4])
def test_int_range_both_forms(spark, size):
    row = spark.range(1).select(arrays.int_range(size), arrays.int_range_udf(F.lit(size))).first()
    assert row[0] == row[1] == list(range(size))


def test_padded_names(spark):
    df = spark.createDataFrame([(1,), (42,), (123,)], "n int")
    assert values(df.select(text.padded_name("group_", F.col("n")))) == ["group_01", "group_42", "group_123"]
    assert text.padded_names("g_", 2) == ["g_01", "g_02"]


def test_time_text_and_elapsed(spark):
    a, b = datetime.datetime(2024, 3, 5, 13, 7, 59, 123456), datetime.datetime(2024, 3, 5, 13, 8, 1, 500000)
    row = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz").select(
        text.format_time(F.col("a")), text.elapsed_seconds(F.col("a"), F.col("b"))).first()
    assert row == (a.strftime("%d-%b-%Y (%H:%M:%S.%f)"), 2.4)


def test_scale_keeps_null(spark):
    assert values(spark.createDataFrame([(1.5,), (None,)], "x double").select(text.scale(F.col("x"), 2))) == [3.0, None]


def lcs_by_table(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            best[i][j] = best[i - 1][j - 1] + 1 if x == y else max(best[i - 1][j], best[i][j - 1])
    return best[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcé ", max_size=90), st.text("abcé ", max_size=90))
def test_common_subsequence_against_table(a, b):
    assert similarity.longest_common_subsequence(a, b) == lcs_by_table(a, b)


def score_by_definition(a, b):
    """The definition written out: three full strings, three ratios."""
    sets = [set(re.sub(r"\W", " ", s).lower().split()) for s in (a, b)]
    if not sets[0] or not sets[1]:
        return 0
    common = " ".join(sorted(sets[0] & sets[1]))
    full = [(common + " " + " ".join(sorted(own - other))).strip() for own, other in (sets, sets[::-1])]
    return max(round(200 * lcs_by_table(x, y) / (len(x) + len(y))) if x and y else 0
               for x, y in ((common, full[0]), (common, full[1]), (full[0], full[1])))


@settings(max_examples=300, deadline=None)
@given(st.text("abAB c_-", max_size=30), st.text("abAB c_-", max_size=30))
def test_score_against_its_definition(a, b):
    score = similarity.token_set_score(a, b)
    assert score == score_by_definition(a, b) == similarity.token_set_score(b, a)


def test_similarity_column(spark):
    rows = [("fuzzy wuzzy was a bear", "wuzzy fuzzy was a big bear", 100), ("this is a test", "this is a test!", 100),
            ("New York Giants", "San Franciso Giants", 57), ("", "x", 0), ("!!", "!!", 0), (None, "x", None),
            ("Tokyo", "tokyo TOKYO", 100)]
    df = spark.createDataFrame([r[:2] for r in rows], "a string, b string")
    assert values(df.select(similarity.token_similarity("a", "b"))) == [r[2] for r in rows]


def test_similarity_of_whole_long_texts(spark):
    one, two = "ab " * 3000 + "tail", "ab " * 10 + "other"
    long_one = " ".join(f"w{i}" for i in range(300))
    long_two = " ".join(f"w{i}" for i in range(0, 600, 2))
    pairs = [(one, two), (long_one, long_two)]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert values(df.select(similarity.token_similarity("a", "b"))) == [score_by_definition(*p) for p in pairs]


def test_draws_are_uniform_and_repeatable(spark):
    df = spark.range(20000).select(draws.uniform(F.col("id"), "u").alias("u"), draws.as_normal(
        draws.bits(F.col("id"), "n")).alias("n"), draws.percent_bucket(F.col("id")).alias("p"))
    low, high, mean, normal_mean, normal_sd, share = df.agg(
        F.min("u"), F.max("u"), F.mean("u"), F.mean("n"), F.stddev("n"), F.mean((F.col("p") < 33).cast("int"))).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.01
    assert abs(normal_mean) < 0.03 and abs(normal_sd - 1) < 0.03 and abs(share - 0.33) < 0.015
    again = spark.range(20000).repartition(7).select(draws.uniform(F.col("id"), "u").alias("u"))
    assert abs(again.agg(F.sum("u")).first()[0] - df.agg(F.sum("u")).first()[0]) < 1e-6


def test_cleaning_of_many_random_texts(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("$,.-0123456789") for _ in range(rng.randint(0, 9))) for _ in range(600)]
    names = ["".join(rng.choice("z_<ab") for _ in range(rng.randint(0, 8))) for _ in range(600)]
    df = spark.createDataFrame(list(zip(range(600), texts, names)), "k int, m string, n string").orderBy("k")

    def number(value):
        try:
            return float(re.sub(r"[$,]", "", value))
        except ValueError:
            return None

    assert values(df.select(text.money_to_double(F.col("m")))) == [number(t) for t in texts]
    assert values(df.select(text.strip_pattern(F.col("n")))) == [n.replace("z_", "") for n in names]
    assert values(df.select(text.strip_pattern(F.col("n"), text.PREFIX_OR_LESS_THAN))) == [
        re.sub("z_|<", "", n) for n in names]


def test_many_draws_at_once_are_the_single_ones(spark):
    names = ["one", "bl\u00e4nk two", ""]
    rows = spark.createDataFrame([(7, "a"), (None, None), (-1, "\u00e9|"), (2**62, ""), (7, "a")], "k bigint, t string")
    for key in ("k", "t"):
        single = F.array(*[draws.bits(F.col(key), n, 3) for n in names])
        found = rows.select(draws.many_bits(F.col(key), names, 3).alias("many"), single.alias("single")).collect()
        assert [r.many for r in found] == [r.single for r in found] and len(found) == 5
    assert rows.limit(0).select(draws.many_bits(F.col("k"), names)).collect() == []


def test_synthetic_rows_draw_their_features_in_batches(spark):
    keys = spark.range(20)
    rows = synth.inject_missing(synth.synth_rows(keys, "id"), "id", synth.feature_names())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("draw(") == 2 and plan.count("conv(") <= 6


def test_draws_of_many_keys_need_no_digest_of_their_own(monkeypatch):
    names = ["", "one", "bl\u00e4nk two", *[f"blank numeric_feature_{i:02d}" for i in range(9)]]
    keys = [None, "", "a|b", "\u00e9", *[str(i ** 3) for i in range(-700, 700)], "x" * 22, "x" * 90]
    texts = [[("" if k is None else f"{k}|") + f"{n}|4" for n in names] for k in keys]
    want = [[int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in row] for row in texts]
    assert draws.draw_bits(pa.array(["left out", *keys])[1:], names, 4).tolist() == want
    monkeypatch.setattr(draws, "TOGETHER", 3)
    assert draws.draw_bits(pa.array(keys), names, 4).tolist() == want
    monkeypatch.setattr(draws.hashlib, "md5", None)  # only long texts are digested one by one
    assert draws.draw_bits(pa.array(keys[:-2]), names, 4).tolist() == want[:-2]
    assert draws.draw_bits(pa.array([], pa.string()), names).shape == (0, len(names))


def test_rounding_as_spark_does(spark):
    numbers = [0.125, -0.125, 2.675, 1.005, -0.004, 0.0, 12345678.125, 1e15 + 0.5, 5e-324, -7.0]
    frame = spark.createDataFrame([(x,) for x in numbers], "x double").select(F.round("x", 2))
    assert draws.round_half_up(np.array(numbers), 2).tolist() == values(frame)


def test_synthetic_rows_in_batches_are_the_ones_drawn_one_by_one(spark):
    keys = spark.createDataFrame([(i * i,) for i in range(300)] + [(None,), (4,)], "k bigint")
    options = {"features": 5, "seed": 2, "separation": 0.7, "decimals": 3}
    rows, single = (synth.synth_rows(keys, "k", batches=batches, **options) for batches in (True, False))
    assert rows.dtypes == single.dtypes
    assert sorted(map(str, rows.collect())) == sorted(map(str, single.collect()))
