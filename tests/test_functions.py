"""Column functions against plain Python twins and literal cases."""

import datetime as dt
import re
import statistics
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, example, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tallyforge.functions import registry, scores, text, tiers, times, validation

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, kind, make):
    """The function applied to each value, in order."""
    data = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in data.orderBy("i").select(make("v").alias("out")).collect()]


@few
@given(st.lists(st.one_of(st.none(), st.integers(0, 100)), min_size=1, max_size=30))
def test_generation(spark, ages):
    def twin(age):
        if age is None:
            return "Unknown"
        return next((name for limit, name in ((25, "Gen Z"), (40, "Millennial"), (55, "Gen X")) if age < limit), "Boomer")

    assert column(spark, ages, "INT", tiers.generation) == [twin(a) for a in ages]


@few
@given(st.lists(st.one_of(st.none(), st.floats(0, 2000)), min_size=1, max_size=30))
def test_amount_class_equals_a_python_function(spark, amounts):
    """A built-in expression and a registered Python function give the same column."""

    def twin(amount):
        if amount is None:
            return "unknown"
        return "high" if amount > 1000 else "medium" if amount > 100 else "low"

    as_python = registry.register_python(spark, "amount_class_py", twin, "string")
    assert column(spark, amounts, "DOUBLE", tiers.amount_class) == column(spark, amounts, "DOUBLE", lambda v: as_python(F.col(v)))


def test_sizes_and_payment(spark):
    assert column(spark, [19.9, 20.0, 50.0, 50.1], "DOUBLE", tiers.transaction_size) == ["Small", "Medium", "Medium", "Large"]
    assert column(spark, ["VISA", "cash", None], "STRING", tiers.payment_category) == ["Credit Card", "Other", "Other"]


def test_email_classes(spark):
    cases = {
        "a@Gmail.com": "Consumer", "a@bigcorp.io": "Business", "a@company.com": "Business", "a@x.edu": "Educational",
        "a@education.gov": "Educational", "a@tax.gov": "Government", "a@b.org": "Other", "nobody": "Unknown", None: "Unknown",
    }
    assert column(spark, list(cases), "STRING", tiers.email_class) == list(cases.values())


def test_shares_add_up(spark):
    tagged = spark.range(1000).select(tiers.shares(F.col("id"), tiers.TRAFFIC_SOURCES).alias("s")).groupBy("s").count()
    assert {r["s"]: r["count"] for r in tagged.collect()} == {name: p * 10 for p, name in tiers.TRAFFIC_SOURCES}


def test_risk_category(spark):
    cases = [
        ((20, 5000.0, 2, "CA"), "High"),  # 5 + 4 + 6 + 2 = 17
        ((20, 30.0, 2, "TX"), "Medium"),  # 5 + 6 = 11
        ((40, 300.0, 10, "TX"), "Low"),
        ((70, 300.0, 60, "NV"), "Medium"),  # 3 + 4 + 2 + 2 = 11
        ((None, 300.0, 10, "TX"), "Unknown"),
        ((40, None, None, "TX"), "Unknown"),
        ((40, 0.0, 0, None), "Medium"),  # 4 + 6 = 10
    ]
    data = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i INT, age INT, total DOUBLE, n INT, state STRING")
    got = data.orderBy("i").select(scores.risk_category("age", "total", "n", "state")).collect()
    assert [r[0] for r in got] == [c[1] for c in cases]


def test_anomaly(spark):
    cases = [((160.0, 100.0, 20.0), True), ((130.0, 100.0, 20.0), False), ((151.0, 100.0, 0.0), True),
             ((149.0, 100.0, 0.0), False), ((1.0, None, 1.0), False), ((1.0, 1.0, None), False)]
    data = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i INT, x DOUBLE, m DOUBLE, s DOUBLE")
    assert [r[0] for r in data.orderBy("i").select(scores.is_anomaly("x", "m", "s")).collect()] == [c[1] for c in cases]


@few
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.floats(0, 9000))] * 4), min_size=1, max_size=20))
def test_loyalty_score(spark, records):
    def twin(n, total, days, mean):
        n, total, days, mean = (x or 0.0 for x in (n, total, days, mean))
        steady = (1 - abs(mean - 100) / 100) * 10 if mean > 0 else 0
        return max(0.0, min(n / 10, 1) * 30 + min(total / 5000, 1) * 40 + min(days / 365, 1) * 20 + steady)

    data = spark.createDataFrame([(i, *r) for i, r in enumerate(records)], "i INT, n DOUBLE, t DOUBLE, d DOUBLE, m DOUBLE")
    got = data.orderBy("i").select(scores.loyalty_score("n", "t", "d", "m")).collect()
    assert [r[0] for r in got] == pytest.approx([twin(*r) for r in records])


def test_sql_functions(spark):
    registry.register_sql_functions(spark)
    row = spark.sql(
        "SELECT categorize_age(34), categorize_age(50), calculate_discount(100), calculate_discount(250), loyalty_points(3, 150, 50)"
    ).first()
    assert tuple(row) == ("Adult", "Senior", 10.0, 37.5, 50)


def test_rfm_scores_do_not_depend_on_partitions(spark, rows):
    data = spark.range(100).select("id", F.col("id").cast("int").alias("d"), (F.col("id") % 10).alias("f"), (F.col("id") * 3.0).alias("m"))
    one = scores.rfm_scores(data.coalesce(1), "d", "f", "m")
    many = scores.rfm_scores(data.repartition(7), "d", "f", "m")
    assert rows(one) == rows(many)
    best = {r["id"]: r for r in one.collect()}
    assert (best[0]["recency_score"], best[0]["monetary_score"]) == (5, 1)
    assert (best[99]["recency_score"], best[99]["monetary_score"], best[99]["frequency_score"]) == (1, 5, 5)


@pytest.mark.parametrize(
    "value, expected",
    [("Mon Apr 06 22:19:45 PDT 2009", dt.datetime(2009, 4, 7, 5, 19, 45)), ("Tue Jan 01 00:00:00 UTC 2019", dt.datetime(2019, 1, 1)),
     ("no date", None), (None, None)],
)
def test_feed_time(spark, value, expected):
    assert column(spark, [value], "STRING", times.parse_feed_time) == [expected]


def test_time_features_and_metrics(spark):
    data = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 6, 17, 5), dt.datetime(2024, 1, 6, 17, 35), 10.0), (2, None, None, 1.0),
         (3, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), 5.0)], "i INT, a TIMESTAMP, b TIMESTAMP, d DOUBLE",
    ).orderBy("i")
    assert [tuple(r[0]) for r in data.select(times.time_features("a")).collect()] == [(17, 5, 1), (0, 0, 0), (0, 0, 0)]
    assert [tuple(r[0]) for r in data.select(times.trip_metrics("a", "b", "d")).collect()] == [(30.0, 20.0), (None, 0.0), (0.0, 0.0)]


def test_day_number(spark):
    assert column(spark, ["Monday", "Sunday", "Noday", None], "STRING", lambda v: times.day_number(F.col(v))) == [1, 7, 0, 0]


words = st.text(alphabet=st.sampled_from(list("ab@_é1 .!\n")), max_size=25)


@few
@given(st.lists(st.one_of(st.none(), words), min_size=1, max_size=30))
def test_mentions_like_python(spark, texts):
    twin = [[] if t is None else re.findall(r"@[\w]+", t) for t in texts]
    assert column(spark, texts, "STRING", text.mentions) == twin


def test_text_features(spark):
    got = column(spark, ["Good times, bad Times", "", None, "Élan vital greatest"], "STRING", text.text_features)
    assert tuple(got[0]) == (0.0, 2, pytest.approx(4.5 / 10))
    assert tuple(got[1]) == tuple(got[2]) == (0.0, 0, 0.0)
    assert tuple(got[3]) == (pytest.approx(1 / 3), 1, pytest.approx((4 + 5 + 8) / 3 / 10))


def test_null_safe_arithmetic(spark):
    data = spark.createDataFrame([(10, 2), (15, 0), (None, 5), (20, None)], "n INT, d INT")
    assert [r[0] for r in data.select(F.try_divide("n", "d")).collect()] == [5.0, None, None, None]
    assert [r[0] for r in data.select(validation.doubled("n", 0)).collect()] == [20, 30, 0, 40]


@pytest.mark.parametrize(
    "value, kind, expected",
    [
        ("john@example.com", "email", (True, "", "john@example.com")),
        (" John@Example.com ", "email", (True, "", "john@example.com")),
        ("invalid-email", "email", (False, "Invalid email format", "invalid-email")),
        ("a@b", "email", (False, "Invalid email pattern", "a@b")),
        ("(555) 123-4567", "phone", (True, "", "(555) 123-4567")),
        ("5551234567", "phone", (True, "", "(555) 123-4567")),
        ("1-555-123-4567", "phone", (True, "", "(555) 123-4567")),
        ("12", "phone", (False, "Invalid phone number length", "12")),
        (None, "phone", (False, "Missing phone number", "")),
        ("$123.45", "currency", (True, "", "$123.45")),
        ("-$50.00", "currency", (True, "Negative currency value", "$-50.00")),
        ("free", "currency", (False, "Invalid currency format", "free")),
        ("2023-12-25", "date", (True, "", "2023-12-25")),
        ("12/25/2023", "date", (True, "", "2023-12-25")),
        ("25-12-2023", "date", (True, "", "2023-12-25")),
        ("invalid-date", "date", (False, "Invalid date format", "invalid-date")),
        ("x", "other", (True, "", "x")),
    ],
)
def test_validated(spark, value, kind, expected):
    data = spark.createDataFrame([(value, kind)], "v STRING, k STRING")
    assert tuple(data.select(validation.validated("v", "k")).first()[0]) == expected


def test_rules(spark):
    records = [
        ("C1", "age=25|amount=500|state=CA|balance=1000"), ("C2", "age=16|amount=200|state=NY|balance=500"),
        ("C3", "age=30|amount=15000|state=XX|balance=-100"), ("C4", "age=45|amount=750|state=TX|balance=2000"), ("C5", None),
    ]
    data = spark.createDataFrame(records, "id STRING, record STRING")
    got = validation.apply_rules(data, "record", validation.CUSTOMER_RULES).orderBy("id").collect()
    assert [(r["passed"], r["failed"], r["failed_rules"], r["status"]) for r in got] == [
        (4, 0, "", "APPROVED"), (3, 1, "min_age", "REVIEW"),
        (1, 3, "max_transaction|valid_state|positive_balance", "REJECTED"), (4, 0, "", "APPROVED"),
        (2, 2, "min_age|valid_state", "REVIEW"),
    ]


@few
@example([[164, 21, 500, 245, 27], [1, 6, 11], [100, 94, 88]])
@given(st.lists(st.lists(st.integers(1, 500), max_size=8), min_size=1, max_size=10))
def test_series_shape(spark, series):
    def twin(points):
        if len(points) < 3:
            return 0.0, "stable"
        n, centre = len(points), statistics.mean(points)
        rise = n * sum(i * p for i, p in enumerate(points)) - sum(range(n)) * sum(points)
        slope = Fraction(rise, n * sum(i * i for i in range(n)) - sum(range(n)) ** 2)
        trend = "increasing" if slope > 5 else "decreasing" if slope < -5 else "stable"
        return statistics.pstdev(points) / centre, trend

    data = spark.createDataFrame([(i, ",".join(map(str, s))) for i, s in enumerate(series)], "i INT, s STRING")
    got = validation.series_shape(data, "i", "s").orderBy("i").collect()
    for row, points in zip(got, series):
        shape, trend = twin(points)
        assert row["seasonality_index"] == pytest.approx(shape, abs=1e-9)
        assert row["trend_direction"] == trend


def test_series_with_a_broken_number(spark):
    data = spark.createDataFrame([("a", "100,150,120,180,200,190,210"), ("b", "1,x,3,4"), ("c", None)], "k STRING, s STRING")
    got = {r["k"]: r for r in validation.series_shape(data, "k", "s").collect()}
    assert got["a"]["trend_direction"] == "increasing"
    assert (got["b"]["seasonality_index"], got["b"]["trend_direction"]) == (0.0, "stable")
    assert got["c"]["volatility_score"] == 0.0
