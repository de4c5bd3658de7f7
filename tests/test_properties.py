"""Property tests: operators against brute force in plain Python."""

from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgeflow.functions import percent, strip_special, title_text
from lodgeflow.operators import quality
from lodgeflow.operators.dedup import dedup_by_key
from lodgeflow.operators.profile import null_profile

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text(alphabet=st.sampled_from(list("aBc xY!.,()#\t-'é")), max_size=12)


def py_percent(p, t):
    if t == 0:
        return None
    q = Fraction(100 * p, t)
    return float(round(q * 100)) / 100  # a fraction's round is exact, ties to even


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=40))
def test_percent_matches_exact_rounding(spark, pairs):
    pairs = [(min(p, t), t) for p, t in pairs]
    df = spark.createDataFrame(pairs, "p long, t long")
    got = [r[0] for r in df.select(percent("p", "t")).collect()]
    assert got == [py_percent(p, t) for p, t in pairs]


def py_title(s):
    return " ".join(w[:1].upper() + w[1:] for w in s.lower().split(" "))


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_strip_and_title_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(strip_special("s").alias("a"), title_text("s").alias("b")).collect()
    table = str.maketrans("", "", "!@#$%^&*().,")
    assert [r["a"] for r in got] == [t.translate(table).strip(" ") for t in texts]
    assert [r["b"] for r in got] == [py_title(t) for t in texts]


ROWS = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", None]), st.one_of(st.none(), st.integers(0, 5)),
                          st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), min_size=0, max_size=40)


@SETTINGS
@given(ROWS)
def test_dedup_is_first_row_in_total_order(spark, rows):
    df = spark.createDataFrame(rows, "k string, x int, y string")
    nulls_first = lambda v: (v is not None, v if v is not None else 0)
    order = lambda t: ((t[0] is not None, t[0] or ""), nulls_first(t[1]), (t[2] is not None, t[2] or ""))
    got = sorted((tuple(r) for r in dedup_by_key(df, "k").collect()), key=order)
    best = {}
    for k, x, y in rows:
        key = (nulls_first(x), (y is not None, y or ""))
        if k not in best or key < best[k][0]:
            best[k] = (key, (k, x, y))
    want = sorted((v[1] for v in best.values()), key=order)
    assert got == want


@SETTINGS
@given(ROWS)
def test_quality_counts_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "booking_id string, star_rating int, hotel_id string")
    ev = quality.evaluate(df, [quality.unique("booking_id"), quality.not_null("hotel_id"),
                               quality.in_range("star_rating", 1, 5)])
    fails = {r["name"]: r["fail_count"] for r in ev["results"]}
    assert fails["Unique Booking ID"] == len(rows) - len({r[0] for r in rows})
    assert fails["NotNull Hotel ID"] == sum(r[2] is None for r in rows)
    assert fails["Star Rating Range (1-5)"] == sum(r[1] is not None and not 1 <= r[1] <= 5 for r in rows)
    assert ev["evaluation_parameters"]["total_records"] == len(rows)


@SETTINGS
@given(ROWS)
def test_profile_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, x int, y string")
    got = {r["Column_Name"]: (r["Null_Count"], r["Missing_Percentage"]) for r in null_profile(df).collect()}
    for i, c in enumerate(["k", "x", "y"]):
        n = sum(r[i] is None for r in rows)
        assert got[c] == (n, py_percent(n, len(rows)) if rows else 0.0)


BATCHES = st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), st.integers(0, 9)),
                            min_size=0, max_size=6), min_size=1, max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(BATCHES, st.lists(st.booleans(), min_size=4, max_size=4))
def test_upsert_matches_model(spark, batches, retry):
    import tempfile
    from lodgeflow.streaming.upsert import LOAD_COL, insert_new_rows
    target = tempfile.mkdtemp(prefix="lodgeflow-prop-") + "/t"
    model: dict = {}
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k string, v int")
        for _ in range(2 if retry[i] else 1):  # a retried batch must not change anything
            insert_new_rows(df, target, "k", f"s-{i:04d}", order_by=[F.col("v")])
        for k in sorted({k for k, _ in rows}):
            if k not in model:
                model[k] = min(v for kk, v in rows if kk == k)
    try:
        got = {r["k"]: r["v"] for r in spark.read.parquet(target).drop(LOAD_COL).collect()}
    except Exception:  # nothing was ever written
        got = {}
    assert got == model
