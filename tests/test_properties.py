"""Property tests for the merges, on random change feeds."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.merge import apply_changes, scd2_merge, upsert
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
FEED = "k string, v string, cdc_operation string, updated_at timestamp_ntz"
SCD = "k string, v string, w string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
CHG = "k string, v string, w string, updated_at timestamp_ntz"

change = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.sampled_from(["x", "y", None]),
    st.sampled_from(["I", "U", "D"]),
    st.integers(min_value=0, max_value=6),
)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCD_SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _feed(spark, items):
    return spark.createDataFrame(
        [(k, v, op, T0 + dt.timedelta(hours=h)) for k, v, op, h in items], FEED
    )


def _model(items):
    """Last operation per key wins; at equal times a delete wins, then the
    smallest other values (the fixed tiebreak)."""
    best = {}
    for k, v, op, h in items:
        rank = (-h, 0 if op == "D" else 1, (v is not None, v or ""), op)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, v, op, h)
    return sorted(
        ((k, v, T0 + dt.timedelta(hours=h)) for k, (_, v, op, h) in best.items() if op != "D"),
        key=lambda r: r[0],
    )


@SETTINGS
@given(items=st.lists(change, max_size=12), cut=st.integers(min_value=0, max_value=6))
def test_cdc_batches_equal_one_batch_and_model(spark, items, cut):
    empty = spark.createDataFrame([], "k string, v string, updated_at timestamp_ntz")
    feed = _feed(spark, items)
    whole = apply_changes(empty, feed, ["k"])
    first = feed.filter(feed.updated_at <= T0 + dt.timedelta(hours=cut))
    second = feed.filter(feed.updated_at > T0 + dt.timedelta(hours=cut))
    stepped = apply_changes(apply_changes(empty, first, ["k"]), second, ["k"])
    assert rows(whole) == rows(stepped)
    assert rows(apply_changes(whole, feed, ["k"])) == rows(whole)  # replay is harmless
    assert sorted(tuple(r) for r in whole.collect()) == _model(items)


@SETTINGS
@given(items=st.lists(change, max_size=10))
def test_upsert_is_idempotent(spark, items):
    empty = spark.createDataFrame([], "k string, v string, updated_at timestamp_ntz")
    feed = _feed(spark, items).drop("cdc_operation")
    once = upsert(empty, feed, ["k"])
    assert rows(upsert(once, feed, ["k"])) == rows(once)
    assert once.count() == len({k for k, *_ in items})


version = st.tuples(
    st.sampled_from(["a", "b"]),
    st.sampled_from(["x", "y", None]),
    st.sampled_from(["p", "q"]),
    st.integers(min_value=0, max_value=8),
)


def _scd_changes(spark, items):
    # One change per key and instant, as the incremental transform delivers.
    seen = {}
    for k, v, w, h in items:
        seen.setdefault((k, h), (k, v, w, T0 + dt.timedelta(hours=h)))
    return spark.createDataFrame(list(seen.values()), CHG)


@SCD_SETTINGS
@given(items=st.lists(version, max_size=10), cut=st.integers(min_value=0, max_value=8))
def test_scd2_batches_equal_one_batch_and_keep_invariants(spark, items, cut):
    empty = spark.createDataFrame([], SCD)
    changes = _scd_changes(spark, items)

    def merge(target, batch):
        return scd2_merge(target, batch, ["k"], ["v"])

    whole = merge(empty, changes)
    first = changes.filter(changes.updated_at <= T0 + dt.timedelta(hours=cut))
    second = changes.filter(changes.updated_at > T0 + dt.timedelta(hours=cut))
    stepped = merge(merge(empty, first), second)
    got = rows(whole)
    assert got == rows(stepped)
    assert rows(merge(whole, changes)) == got  # re-running a batch is a no-op
    by_key = {}
    for r in whole.collect():
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.valid_from)
        assert sum(r.is_current for r in versions) == 1
        assert versions[-1].is_current and versions[-1].valid_to is None
        assert all(a.valid_to == b.valid_from for a, b in zip(versions, versions[1:]))
        assert all(a.v != b.v for a, b in zip(versions, versions[1:]))  # only tracked changes open versions
