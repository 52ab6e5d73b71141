"""Column functions against listed values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.functions import calendar, identity, measures, visits
from carelake.session import tune_visits

PHONES = [
    ("0412 345 678", "0412345678"),
    ("0412345678", "0412345678"),
    ("(04) 1234 5678", "0412345678"),
    ("04-1234-5678", "0412345678"),
    ("+61 412 345 678", "0412345678"),
    ("+61412345678", "0412345678"),
    ("61412345678", "0412345678"),
    ("0061412345678", "0412345678"),
    ("412345678", "0412345678"),
    (None, None),
    ("", None),
    ("   ", None),
    ("12345", None),
    ("not a phone", None),
    ("0", None),
    ("1" * 80, None),
]
EMAILS = [
    ("  Sarah.Mitchell@Gmail.COM ", "sarah.mitchell@gmail.com"),
    ("\tsam@x.com\n", "sam@x.com"),
    (" sam@x.com ", "sam@x.com"),
    (None, None),
    ("", None),
    ("notanemail", None),
    ("@nope.com", None),
    ("nope@", None),
    (" nope@ ", None),
]
STATUSES = [
    ("Completed", "completed"),
    ("attended", "completed"),
    ("DNA", "dna"),
    ("no show", "dna"),
    ("No_Show", "dna"),
    ("Did Not Attend", "dna"),
    ("canceled", "cancelled"),
    ("cancelled", "cancelled"),
    ("arrived", "arrived"),
    ("confirmed", "booked"),
    (" Rescheduled\n", "rescheduled"),
    ("wibble", "unknown"),
    ("", "unknown"),
    (None, "unknown"),
]


def apply(spark, fn, values, ddl="i int, v string"):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(values)], ddl)
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "fn, values",
    [
        (identity.normalise_phone, PHONES),
        (identity.normalise_email, EMAILS),
        (identity.canonical_status, STATUSES),
    ],
)
def test_listed_values(spark, fn, values):
    assert apply(spark, fn, values) == [want for _, want in values]


def test_name_key(spark):
    cases = [
        ("Sarah-Jane", "O'Mitchell", "SARAHJANEOMITCHELL"),
        ("Sarah", None, "SARAH"),
        (None, "Lee", "LEE"),
        (None, None, None),
        ("", "", None),
        ("42", "-", None),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "f string, l string")
    got = df.select(identity.name_key(F.col("f"), F.col("l"))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]


def test_surrogate_key(spark):
    import hashlib

    df = spark.createDataFrame([(4471, "4471"), (None, None)], "n bigint, t string")
    got = df.select(
        identity.surrogate_key("a", F.col("n")).alias("n"),
        identity.surrogate_key("a", F.col("t")).alias("t"),
        identity.surrogate_key("b", F.col("t")).alias("other"),
    ).collect()
    assert got[0]["n"] == hashlib.sha256(b"a||4471").hexdigest()[:32] == got[0]["t"]
    assert got[0]["n"] != got[0]["other"]
    assert got[1]["n"] is None and got[1]["t"] is None


FIELDS = ["email_norm", "phone_norm", "name_key", "date_of_birth", "postcode"]


@pytest.mark.parametrize(
    "a, b, want, linked",
    [
        (dict(email_norm="s@x", date_of_birth="1984-03-12"), dict(email_norm="s@x", date_of_birth="1984-03-12"), 0.99, True),
        (dict(email_norm="s@x", date_of_birth="1984-03-12"), dict(email_norm="s@x"), 0.95, True),
        (dict(phone_norm="04", name_key="AB"), dict(phone_norm="04", name_key="AB"), 0.93, True),
        (dict(name_key="AB", date_of_birth="1990-01-01", postcode="2000"), dict(name_key="AB", date_of_birth="1990-01-01", postcode="2000"), 0.88, False),
        (dict(email_norm="a@x", phone_norm="04", name_key="AB"), dict(email_norm="b@x", phone_norm="05", name_key="CD"), None, False),
        (dict(phone_norm="04"), dict(phone_norm="04"), None, False),
        (dict(email_norm="", postcode=""), dict(email_norm="", postcode=""), None, False),
        (dict(), dict(), None, False),
    ],
)
def test_match_confidence(spark, a, b, want, linked):
    ddl = ", ".join(f"{s}_{f} {'date' if f == 'date_of_birth' else 'string'}" for s in "ab" for f in FIELDS)
    value = lambda d, f: dt.date.fromisoformat(d[f]) if f == "date_of_birth" and f in d else d.get(f)
    df = spark.createDataFrame([tuple(value(d, f) for d in (a, b) for f in FIELDS)], ddl)
    side = lambda s: {f: F.col(f"{s}_{f}") for f in FIELDS}
    score = identity.match_confidence(side("a"), side("b"))
    got = df.select(score.alias("c"), identity.auto_link(score).alias("l")).first()
    assert (got["c"], got["l"]) == (want, linked)


def test_compose_timestamp_and_duration(spark):
    cases = [
        ("2024-03-01", "08:15", "09:00", "2024-03-01 08:15:00", 45),
        ("2024-03-01", "23:45", "00:15", "2024-03-01 23:45:00", -1410),
        ("2024-03-01", None, "09:00", None, None),
        (None, "08:15", "09:00", None, None),
        ("2024-02-30", "08:15", "09:00", None, None),
        ("2024-03-01", "25:99", "09:00", None, None),
        ("2024-03-01", "08:15", None, "2024-03-01 08:15:00", None),
        ("", "", "", None, None),
        ("\t", "08:15", "09:00", None, None),
        ("2024-03-01", "\t", "\n", None, None),
        ("\n2024-03-01\t", "08:15\r\n", "\u00a009:00", "2024-03-01 08:15:00", 45),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "d string, s string, e string")
    start = visits.compose_timestamp(F.col("d"), F.col("s"))
    end = visits.compose_timestamp(F.col("d"), F.col("e"))
    got = df.select(start.cast("string"), visits.duration_minutes(start, end)).collect()
    assert [tuple(r) for r in got] == [c[3:] for c in cases]


def test_status_from_flags(spark):
    cases = [("1", "1", "1", "cancelled"), ("0", "1", "1", "dna"), ("0", "0", "1", "completed"),
             ("0", "0", "0", "booked"), (None, None, "1", "completed"), (None, None, None, "booked")]
    df = spark.createDataFrame([c[:3] for c in cases], "c string, d string, a string")
    got = df.select(visits.status_from_flags(F.col("c"), F.col("d"), F.col("a"))).collect()
    assert [r[0] for r in got] == [c[3] for c in cases]


def test_money(spark):
    cases = [
        ("completed", "DVA", 88.0, 95.0, 45, 88.0, 71.25),
        ("dna", "Private", 95.0, 95.0, 30, 47.5, 47.5),
        ("dna", "NDIS", 193.99, 82.0, 17, 0.0, 23.23),
        ("cancelled", "Private", 95.0, 95.0, 30, 0.0, 0.0),
        ("booked", "Private", 95.0, 95.0, 30, 0.0, 0.0),
        ("completed", None, None, 88.0, None, None, 44.0),
    ]
    df = spark.createDataFrame([c[:5] for c in cases], "s string, p string, fee double, h double, m int")
    got = df.select(
        measures.revenue(F.col("s"), F.col("p"), F.col("fee")),
        measures.direct_cost(F.col("s"), F.col("h"), F.col("m")),
    ).collect()
    assert [tuple(r) for r in got] == [c[5:] for c in cases]


def test_safe_div_and_exact_sum(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 4)], "n int, d int")
    got = df.select(measures.safe_div(F.col("n"), F.col("d"))).collect()
    assert [r[0] for r in got] == [None, None, 0.75]
    many = spark.range(100_000).select(F.lit(0.1).alias("x"))
    assert many.agg(measures.exact_sum(F.col("x"))).first()[0] == 10000.0
    assert many.filter("x > 1").agg(measures.exact_sum(F.col("x"))).first()[0] is None


def test_calendar_fields(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 30),), (dt.date(2024, 7, 1),)], "d date")
    got = df.select(*[c.alias(n) for n, c in calendar.calendar_fields(F.col("d")).items()]).collect()
    assert got[0].asDict() == {
        "year": 2024, "month": 6, "month_start": dt.date(2024, 6, 1), "month_label": "2024-06",
        "quarter": "2024-Q2", "day_of_week": "Sunday", "is_weekend": True, "fin_year": "2023-2024",
    }
    assert (got[1]["fin_year"], got[1]["is_weekend"], got[1]["quarter"]) == ("2024-2025", False, "2024-Q3")


def test_utc_now_iso(spark):
    got = dt.datetime.fromisoformat(spark.range(1).select(calendar.utc_now_iso()).first()[0])
    assert abs(dt.datetime.now(dt.timezone.utc) - got) < dt.timedelta(minutes=5)


def test_local_date_is_ahead_of_utc(spark):
    df = spark.sql("select timestamp '2024-03-01 19:00:00' as t")
    assert df.select(visits.local_date(F.col("t"), "Australia/Sydney")).first()[0] == dt.date(2024, 3, 2)


def test_blank_dates_and_times_are_no_timestamp(spark):
    parts = [("", "10:00"), ("2024-01-02", ""), ("2024-01-02", " "), (" ", " "), (" 2024-01-02 ", " 10:00 ")]
    df = spark.createDataFrame(parts, "d string, t string")
    got = [r[0] for r in df.select(visits.compose_timestamp(F.col("d"), F.col("t")).cast("string")).collect()]
    assert got == [None, None, None, None, "2024-01-02 10:00:00"]


def test_strip_takes_white_space_of_any_kind_and_leaves_the_rest(spark):
    texts = [None, "", " ", "a", "a b", "\ta", "a\r\n", "\u00a0a\u00a0", "\x1ca\x1f", "\u3000", "\u00e9", "a\u00e9", "\u00e9 ", "!~", "~\u2003"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", identity.strip(F.col("t")).alias("s"))
    assert [r["s"] for r in got.collect()] == [None if t is None else t.strip() for t in texts]
    # The pattern is for texts that do not begin and end visibly.
    assert "CASE WHEN" in got._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_read_less_of_an_exchange_unless_the_session_says(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        for before, after in (("64MB", "16MB"), ("8m", "8m")):
            spark.conf.set(name, before)
            assert _bytes(tune_visits(spark).conf.get(name)) == _bytes(after)
    finally:
        spark.conf.unset(name)


def _bytes(text):
    return int(text.lower().rstrip("mb")) * (1 << 20 if "m" in text.lower() else 1)
