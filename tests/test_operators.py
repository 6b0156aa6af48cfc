"""Operators on small hand-made rows, and properties checked against brute force."""

import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import concat0, mask_phone, safe_div
from martloom.operators.aggregates import approx_distinct, partition_total
from martloom.operators.calendar import calendar_spine, date_spine
from martloom.operators.dedup import argmax_latest, latest_per_key, row_sequence
from martloom.operators.intervals import (
    anti_within_days,
    change_intervals,
    valid_at_join,
    within_days_flag,
    within_days_join,
)
from martloom.operators.joins import DimJoin, assert_unique, enrich, spine_join
from martloom.operators.ordered import sort_by_known
from martloom.operators.pivots import transpose_sum
from martloom.operators.rolling import rolling_distinct, rolling_users
from martloom.operators.series import nearest_fill, neighbour_values, period_delta
from martloom.sources import event_day, month_range, read_remote, trailing_days, write_table

D = dt.date


def days(n):
    return D(2024, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_scalars(frame):
    df = frame("a int, b int, cc string, tel string", (6, 0, "7", "9161234567"), (6, 4, None, None))
    out = df.select(
        safe_div(F.col("a"), F.col("b")),
        mask_phone(F.col("cc"), F.col("tel")),
        concat0(F.col("cc"), F.lit("-"), F.col("a")),
    ).collect()
    assert [tuple(r) for r in out] == [(None, "+7(***)1234567", "7-6"), (1.5, None, "-6")]


def test_slices(frame):
    df = frame("d date, y int, m int", *[(days(i), 2023 + (i > 3), i % 12 + 1) for i in range(8)])
    kept = [r.d for r in trailing_days(df, "d", days(6), 6, 4).collect()]
    assert kept == [days(1), days(2)]
    assert event_day(df, "d", days(5)).count() == 1
    got = month_range(df, "y", "m", (2023, 3), (2024, 6))
    assert sorted((r.y, r.m) for r in got.collect()) == [(2023, 3), (2023, 4), (2024, 5), (2024, 6)]


def test_latest_needs_a_tie_break(frame):
    df = frame("k int, ts int, v string", (1, 5, "b"), (1, 5, "a"), (1, None, "z"), (2, None, "n"))
    assert rows(latest_per_key(df, ["k"], ["ts"], ["v"])) == [(1, 5, "a"), (2, None, "n")]
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], ["ts"], [])
    with pytest.raises(ValueError):
        argmax_latest(df, ["k"], ["v"], "ts", [])


def test_argmax_skips_nulls_per_value(frame):
    df = frame(
        "k int, ts int, id int, a string, b string",
        (1, 1, 1, "old", "x"), (1, 2, 2, None, "y"), (1, 2, 3, None, "z"), (1, None, 4, "q", "q"),
    )
    assert rows(argmax_latest(df, ["k"], ["a", "b"], "ts", ["id"])) == [(1, "old", "z")]
    kept = argmax_latest(df, ["k"], ["a", "b"], "ts", ["id"], skip_nulls=False)
    assert rows(kept) == [(1, None, "z")]


@pytest.fixture(scope="module")
def noisy():
    """Keys with one third of all rows on one of them."""
    rnd = random.Random(7)
    return [
        (1 if rnd.random() < 0.33 else rnd.randrange(2, 12), days(rnd.randrange(400)), i)
        for i in range(600)
    ]


def test_chunked_order_equals_plain(frame, noisy):
    df = frame("k int, d date, id int", *noisy, (1, None, 9001), (3, None, 9002))
    month = F.trunc("d", "MM")
    plain = row_sequence(df, ["k"], ["d", "id"])
    assert rows(plain) == rows(row_sequence(df, ["k"], ["d", "id"], chunk=month))
    whole = change_intervals(df, "k", "d", ["id"])
    assert rows(whole) == rows(change_intervals(df, "k", "d", ["id"], chunk=month))
    delta = period_delta(df, ["k"], ["d", "id"], "id", changed_only=False)
    split = period_delta(df, ["k"], ["d", "id"], "id", changed_only=False, chunk=month)
    assert rows(delta) == rows(split)


def test_change_intervals_cover_time_once(frame):
    df = frame("k int, d date", (1, days(5)), (1, days(9)), (1, None), (2, None))
    got = rows(change_intervals(df, "k", "d"))
    assert got == rows(
        frame(
            "k int, d date, s date",
            (1, days(5), None), (1, days(9), days(6)), (1, None, days(10)), (2, None, None),
        )
    )


def test_within_days_matches_brute_force(frame, noisy):
    rnd = random.Random(3)
    records = [(rnd.randrange(1, 12), days(rnd.randrange(-40, 440))) for _ in range(80)]
    ev = frame("k int, d date, id int", *noisy, (None, days(3), 9000), (1, None, 9001))
    rec = frame("k int, r date", *records, (1, None), (None, days(3)))
    for span in (0, 7, 30):
        want = {
            i: any(k == kk and 0 <= (r - d).days <= span for kk, r in records) for k, d, i in noisy
        } | {9000: False, 9001: False}
        got = {r.id: r.matched for r in within_days_flag(ev, rec, ["k"], "d", "r", span).collect()}
        assert got == want
        pairs = within_days_join(ev, rec, ["k"], "d", "r", span)
        brute = sorted(
            (i, r) for k, d, i in noisy for kk, r in records if k == kk and 0 <= (r - d).days <= span
        )
        assert sorted((p.id, p.r) for p in pairs.collect()) == brute
        semi = within_days_join(ev, rec, ["k"], "d", "r", span, how="semi").count()
        anti = within_days_join(ev, rec, ["k"], "d", "r", span, how="anti").count()
        assert semi == sum(want.values()) and semi + anti == len(want)
        left = within_days_join(ev, rec, ["k"], "d", "r", span, how="left")
        assert left.count() == len(brute) + anti


def test_anti_within_days_follows_not_in(frame):
    args = (["k"], "d", "r", 30, "ref")
    ev = frame(
        "k int, d date, ref string",
        (1, days(0), "a"), (1, days(100), "a"), (2, days(0), "b"), (2, days(0), None),
    )
    rec = frame("k int, r date", (1, days(30)))
    got = rows(anti_within_days(ev, ev, rec, *args).select("ref"))
    assert got == [("b",), (None,)]  # "a" is matched through its other event
    strict = anti_within_days(ev, ev, rec, *args, null_aware=True)
    assert rows(strict.select("ref")) == [("b",)]
    nothing = frame("k int, r date", (9, days(30)))
    assert anti_within_days(ev, ev, nothing, *args, null_aware=True).count() == 4
    null_matched = frame("k int, r date", (2, days(5)))
    assert anti_within_days(ev, ev, null_matched, *args, null_aware=True).count() == 0


def test_valid_at_join_buckets_equal_plain(frame, noisy):
    rnd = random.Random(5)
    spans = []
    for i in range(150):
        lo = rnd.randrange(-50, 420)
        spans.append((rnd.choice([1, 1, 2, 3]), days(lo), days(lo + rnd.randrange(0, 90)), i))
    spans += [(4, D(1900, 1, 1), D(2999, 12, 31), 900), (5, None, days(5), 901)]
    facts = frame("k int, d date, id int", *noisy, (1, None, 9001))
    dim = frame("k int, f date, t date, v int", *spans)
    plain = valid_at_join(facts, dim, {"k": "k"}, "d", "f", "t", {"v": "v"})
    for width in (1, 31, 366):
        split = valid_at_join(facts, dim, {"k": "k"}, "d", "f", "t", {"v": "v"}, bucket_days=width)
        assert rows(split) == rows(plain)
    one = facts.filter(F.col("d") == days(50))
    sliced = valid_at_join(
        one, dim, {"k": "k"}, "d", "f", "t", {"v": "v"}, date_range=(days(50), days(50))
    )
    assert rows(sliced) == rows(plain.filter(F.col("d") == days(50)))


def test_enrich_keeps_fan_out_and_checks_keys(frame):
    facts = frame("id int, k int", (1, 1), (2, 2), (3, None))
    dim = frame("k int, v string, ok int", (1, "a", 1), (1, "b", 1), (2, "c", 0))
    joined = enrich(facts, [DimJoin(dim, {"k": "k"}, {"v": "v"}, where=F.col("ok") == 1)])
    assert rows(joined) == [(1, 1, "a"), (1, 1, "b"), (2, 2, None), (3, None, None)]
    assert enrich(facts, [DimJoin(dim, {"k": "k"})]).count() == 4
    with pytest.raises(ValueError):
        enrich(facts, [DimJoin(dim, {"k": "k"}, unique=True)])
    assert assert_unique(dim, ["v"]).count() == 3


def test_spine(frame):
    parts = frame("asin string", ("a",), ("a",), ("b",))
    spine = calendar_spine(parts, "asin", [2023, 2024])
    assert spine.count() == 2 * 24
    sold = frame("asin string, year_ int, month_ int, q int", ("a", 2023, 5, 7), ("x", 2023, 5, 9))
    fees = frame("asin string, year_ int, month_ int, fee int", ("a", 2023, 5, 1), ("b", 2024, 1, 2))
    wide = spine_join(spine, {"sold": sold, "fees": fees}, ["asin", "year_", "month_"])
    assert wide.count() == 48
    assert rows(wide.filter("q > 0 or fee > 0")) == [("a", 2023, 5, 7, 1), ("b", 2024, 1, 0, 2)]
    with pytest.raises(ValueError):
        spine_join(spine, {"a": sold, "b": sold}, ["asin", "year_", "month_"])


def test_transpose_is_exact_and_null_without_rows(frame):
    df = frame(
        "k int, t string, a decimal(18,2)",
        (1, "x", Decimal("0.10")), (1, "x", Decimal("0.20")), (1, "y", Decimal("-0.30")),
        (2, "z", Decimal("9999999999999999.99")), (2, "y", None),
    )
    got = rows(transpose_sum(df, ["k"], "t", "a", ["x", "y"]))
    assert got == [(1, Decimal("0.30"), Decimal("-0.30")), (2, None, None)]
    big = transpose_sum(df, ["k"], "t", "a", {"zz": "z"}).filter("k = 2").collect()[0]
    assert big.zz == Decimal("9999999999999999.99")


def test_transpose_of_wide_decimals(spark, frame):
    """Types without room for units stay decimal; the schema is the same with and without ANSI."""
    wide = frame("k int, t string, a decimal(38,18)", (1, "x", Decimal("123456789012.000000000000000001")), (1, "x", Decimal(10)))
    assert transpose_sum(wide, ["k"], "t", "a", ["x"]).first().x == Decimal("123456789022.000000000000000001")
    before = spark.conf.get("spark.sql.ansi.enabled")
    for kind in ("decimal(18,2)", "decimal(38,18)", "decimal(12,8)"):
        df = frame(f"k int, t string, a {kind}", (1, "x", Decimal("0.25")), (1, "x", None))
        seen = set()
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            out = transpose_sum(df, ["k"], "t", "a", ["x"])
            seen.add(out.schema.simpleString())
            assert out.first().x == Decimal("0.25")
        spark.conf.set("spark.sql.ansi.enabled", before)
        assert len(seen) == 1


def test_a_stray_date_does_not_stretch_the_spine(frame):
    df = frame("d date, u int", (dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2), (dt.date(5555, 1, 1), 3))
    span = {"start": dt.date(2024, 1, 2), "end": dt.date(2024, 1, 5)}
    users = rolling_users(df, "d", "u", 2, **span)
    assert rows(users) == [(dt.date(2024, 1, 2), 2), (dt.date(2024, 1, 3), 1)]
    pairs = rolling_distinct(df, "d", ["u"], 2, method="spine", **span)
    assert rows(pairs) == [(dt.date(2024, 1, 2), 2), (dt.date(2024, 1, 3), 1)]
    assert "5555" not in str(date_spine(df.filter("d < '2025-01-01'"), "d").collect())


def test_partition_total_groups_nulls(frame):
    df = frame("k string, v int", ("a", 1), ("a", 2), (None, 5), (None, 6))
    got = rows(partition_total(df, ["k"], "v", "s"))
    assert got == rows(
        frame("k string, v int, s long", ("a", 1, 3), ("a", 2, 3), (None, 5, 11), (None, 6, 11))
    )


def test_rolling_methods_agree_with_brute_force(frame):
    rnd = random.Random(11)
    data = [(rnd.choice([0, 1, 2, 9, 10, 25, 26]), rnd.randrange(6), rnd.choice("xyz")) for _ in range(60)]
    df = frame("d date, u int, c string", *[(days(d), u, c) for d, u, c in data], (days(40), None, "x"))
    args = dict(categories={"n_x": "x"}, category_col="c")
    want = []
    for w in range(0, 60):
        inside = [(d, u, c) for d, u, c in data if w - 6 <= d <= w]
        if inside or 40 <= w <= 46:
            pairs = {(d, u) for d, u, _ in inside}
            marked = {(d, u) for d, u, c in inside if c == "x"}
            want.append((days(w), len(pairs), len(marked)))
    for method in ("daily", "spine", "explode"):
        got = rolling_distinct(df, "d", ["u"], 7, method=method, **args)
        assert [tuple(r) for r in got.orderBy("d").collect()] == want
    users = [
        (days(w), len({u for d, u, _ in data if w - 6 <= d <= w}))
        for w in range(60)
        if any(w - 6 <= d <= w for d, _, _ in data)
    ]
    exact = rolling_users(df, "d", "u", 7).orderBy("d").collect()
    assert [tuple(r) for r in exact] == users
    sketch = rolling_users(df, "d", "u", 7, method="hll").orderBy("d").collect()
    assert [tuple(r) for r in sketch] == users  # tiny sets are counted exactly
    cut = rolling_distinct(df, "d", ["u"], 7, start=days(5), end=days(8)).orderBy("d").collect()
    assert [r.d for r in cut] == [days(5), days(6), days(7)]


def test_sketch_error_is_small(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 50_000).alias("u"), F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("d")
    )
    est = {r.d: r.users for r in rolling_users(df, "d", "u", 3, method="hll").collect()}
    exact = {r.d: r.users for r in rolling_users(df, "d", "u", 3).collect()}
    assert est.keys() == exact.keys()
    assert all(abs(est[d] / exact[d] - 1) < 0.03 for d in exact)
    approx = approx_distinct(df, ["d"], "u", "n").collect()
    assert all(abs(r.n / 50_000 - 1) < 0.03 for r in approx)


def test_nearest_fill(frame):
    df = frame(
        "sku string, y int, m int, v int",
        ("a", 2023, 12, 99), ("a", 2024, 1, None), ("a", 2024, 2, 10), ("a", 2024, 3, 0),
        ("a", 2024, 4, None), ("a", 2024, 5, None), ("a", 2024, 6, 30), ("b", 2024, 1, None),
    )
    got = rows(nearest_fill(df, ["sku"], "m", "v", bound=["y"]).select("sku", "m", "pk", "fill_pk", "fill_v"))
    assert got == rows(
        frame(
            "sku string, m int, pk int, fill_pk long, fill_v int",
            ("a", 1, 2, 2, 10), ("a", 3, 4, 2, 10), ("a", 4, 5, 2, 10), ("a", 4, 5, 3, 30),
            ("a", 5, 6, 3, 30), ("b", 1, 1, None, None),
        )
    )
    first = nearest_fill(df, ["sku"], "m", "v", bound=["y"], ties="earlier")
    assert rows(first.filter("m = 4").select("fill_v")) == [(10,)]
    around = neighbour_values(df, ["sku", "y"], "m", "v").filter("m = 5")
    assert rows(around.select("prev_v", "prev_m", "next_v", "next_m")) == [(10, 2, 30, 6)]


def test_write_table_replaces_touched_partitions_only(spark, frame, tmp_path):
    path = str(tmp_path / "feed")
    df = frame("d int, v string", (1, "a"), (1, "b"), (2, "c"))
    write_table(df, path, ["d"], as_path=True)
    write_table(frame("d int, v string", (2, "new")), path, ["d"], touched_only=True, as_path=True)
    assert rows(spark.read.parquet(path).select("d", "v")) == [(1, "a"), (1, "b"), (2, "new")]
    write_table(frame("d int, v string", (3, "only")), path, ["d"], as_path=True)
    assert rows(spark.read.parquet(path).select("d", "v")) == [(3, "only")]


def test_write_table_by_name(spark, frame):
    name = f"feed_{uuid.uuid4().hex}"
    try:
        write_table(frame("d int, v string", (1, "a"), (2, "c")), name, ["d"])
        write_table(frame("d int, v string", (2, "new")), name, ["d"], touched_only=True)
        assert rows(spark.table(name).select("d", "v")) == [(1, "a"), (2, "new")]
        write_table(frame("d int, v string", (5, "all")), name, ["d"])
        assert rows(spark.table(name).select("d", "v")) == [(5, "all")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_read_remote_asks_for_parallel_ranges():
    class Reader:
        def jdbc(self, *args, **kwargs):
            return args, kwargs

    class Session:
        read = Reader()

    args, kwargs = read_remote(Session(), "jdbc:x", "t", "id", 0, 100)
    assert args == ("jdbc:x", "t")
    assert kwargs == {
        "column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4, "properties": {},
    }


def test_sort_by_known_keys(spark):
    rng = random.Random(12)
    data = [(rng.choice([None, "zz", *[f"k{i}" for i in range(40)]]), rng.choice([None, *range(9)])) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, n int")
    known = spark.createDataFrame([(f"k{i}",) for i in range(40)] + [(None,)], "k string")
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0))
    for partitions, sample in ((1, 10), (7, 10), (7, 1000), (100, 1000)):
        assert [tuple(r) for r in sort_by_known(df, ["k", "n"], known, partitions, sample).collect()] == want
    assert [tuple(r) for r in sort_by_known(df, ["k", "n"], known.limit(0)).collect()] == want
    assert sort_by_known(df.limit(0), ["k", "n"], known, 3).collect() == []
