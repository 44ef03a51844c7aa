"""The time split against a plain sort, with few and many keys at once."""

import datetime as dt
import random

import pytest

from airspark.operators.split import _key_of_rank, time_split

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "city string, timestamp timestamp_ntz, v int"


def want(rows, fraction):
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    return set(order[:int(len(rows) * fraction)])


@pytest.mark.parametrize("fraction", [0.05, 0.5, 0.8, 0.999])
@pytest.mark.parametrize("at_once", [3, 100_000])
def test_split_equals_a_plain_sort(spark, fraction, at_once):
    r = random.Random(int(fraction * 100))
    cities = ["a", "ab", "abc", "b", "é", "éa", "zz", "", "𝛼", "z", *(f"s{i}" for i in range(60))]
    rows = [(c, T0 + dt.timedelta(hours=h), h) for h in range(6) for c in cities if r.random() < 0.9]
    got = time_split(spark.createDataFrame(rows, SCHEMA), fraction, at_once=at_once).collect()
    train = want(rows, fraction)
    assert len(got) == len(rows)
    assert {(x.city, x.timestamp, x.v) for x in got if x.split == "train"} == train


def test_every_rank_is_found(spark):
    words = ["", "a", "a", "aa", "ab", "abc", "abc", "abcd", "b", "ba"]
    df = spark.createDataFrame([(w,) for w in words], "k string").cache()
    for at_once in (1, 2, 50):
        for rank in range(1, len(words) + 1):
            key, below, n = _key_of_rank(df, "k", rank, at_once)
            assert (key, below, n) == (words[rank - 1], words.index(words[rank - 1]), words.count(words[rank - 1]))


def test_repeated_keys_and_too_few_rows(spark):
    rows = [("a", T0, i) for i in range(10)]
    got = time_split(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(x.v for x in got if x.split == "train") == list(range(8))
    with pytest.raises(ValueError, match="Need more"):
        time_split(spark.createDataFrame(rows[:1], SCHEMA))


def test_the_split_is_a_projection(spark):
    df = spark.range(5000).selectExpr("concat('c', id % 100) AS city", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,int(id div 100)) AS timestamp")
    plan = time_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Union" not in plan
