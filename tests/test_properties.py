"""Rules that hold for any input, each example batched into one Spark job."""

import datetime as dt
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater import schemas
from tidewater.operators import dau, orders, wide
from tidewater.operators.skew import HotKeys

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

order_lines = st.lists(
    st.tuples(
        st.integers(0, 10**7),
        st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 9)), min_size=1, max_size=6),
    ),
    min_size=1,
    max_size=40,
)


@few
@given(order_lines)
def test_shares_add_up(spark, facts):
    data = []
    for order_id, (final, lines) in enumerate(facts):
        original = sum(p * n for p, n in lines)
        for line, (price, number) in enumerate(lines):
            data.append((order_id, line, D(price) / 100, number, D(original) / 100, D(final) / 100, D(0)))
    money = "decimal(18,2)"
    df = spark.createDataFrame(
        data,
        f"order_id bigint, order_detail_id bigint, sku_price {money}, sku_num bigint, original_total_amount {money}, "
        f"final_total_amount {money}, final_detail_amount {money}",
    )
    sums = {}
    for r in wide.allocate_amount(df, HotKeys("order_id")).collect():
        sums[r.order_id] = sums.get(r.order_id, 0) + r.final_detail_amount
    assert sums == {i: D(final) / 100 for i, (final, _) in enumerate(facts)}


@few
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(0, 9)), min_size=1, max_size=40))
def test_one_first_order_per_user(spark, batch):
    data = [(i, user, f"2024-01-01 10:00:0{s}") for i, (user, s) in enumerate(batch)]
    df = spark.createDataFrame(data, "id bigint, user_id bigint, create_time string")
    flagged = orders.flag_first_order(df, spark.createDataFrame([], schemas.USER_STATE)).collect()
    assert len(flagged) == len(batch)
    first = {r.user_id: r.id for r in flagged if r.if_first_order == "1"}
    assert first == {u: min((t, i) for i, v, t in data if v == u)[1] for u in {u for u, _ in batch}}
    assert sum(r.if_first_order == "1" for r in flagged) == len(first)


@few
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 72)), min_size=1, max_size=40))
def test_daily_dedup_is_idempotent(spark, visits):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    data = [((f"m{m}", "u", "a", "c", "v"), int((start + dt.timedelta(hours=h)).timestamp() * 1000)) for m, h in visits]
    once = dau.dedup_daily(dau.to_dau_info(spark.createDataFrame(data, schemas.START_LOG)))
    first = {(r.mid, r.dt): r.ts for r in once.collect()}
    expected = {}
    for (mid, *_), ts in data:
        day = dt.datetime.fromtimestamp(ts / 1000, dt.timezone.utc).strftime("%Y-%m-%d")
        expected[mid, day] = min(ts, expected.get((mid, day), ts))
    assert first == expected
    assert sorted(map(tuple, dau.dedup_daily(once).collect())) == sorted(map(tuple, once.collect()))
