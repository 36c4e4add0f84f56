import datetime as dt

from pyspark.sql import functions as F

from strata.operators import merge
from strata.operators.keyset import split
from strata.operators.merge import apply_changes, delete_keys, live_rows, scd2_merge, upsert
from tests.conftest import rows

T = [dt.datetime(2024, 1, d) for d in range(1, 10)]
KV = "k string, v string, updated_at timestamp_ntz"
FEED = "k string, v string, cdc_operation string, updated_at timestamp_ntz"


def test_upsert_new_changed_unchanged_and_repeated(spark):
    target = spark.createDataFrame([("a", "1", T[0]), ("b", "1", T[0])], KV)
    changes = spark.createDataFrame(
        [("b", "2", T[1]), ("c", "1", T[1]), ("c", "3", T[2]), ("a", "1", T[1])], KV
    )
    out = upsert(target, changes, ["k"])
    assert rows(out) == [("a", "1", T[1]), ("b", "2", T[1]), ("c", "3", T[2])]
    # Merging the same batch again changes nothing.
    assert rows(upsert(out, changes, ["k"])) == rows(out)


def test_apply_changes_last_operation_wins(spark):
    target = spark.createDataFrame([("a", "1", "I", T[0]), ("b", "1", "I", T[0]), ("d", "1", "I", T[0])], FEED)
    target = target.drop("cdc_operation")
    feed = spark.createDataFrame(
        [
            ("a", "2", "U", T[1]),
            ("a", None, "D", T[2]),  # update then delete: deleted
            ("b", None, "D", T[1]),
            ("b", "9", "I", T[2]),  # delete then re-insert: present
            ("x", None, "D", T[1]),  # delete of an absent key: nothing
            ("d", "5", "U", T[3]),
            ("d", None, "D", T[3]),  # same instant: the delete wins
            ("n", "1", "I", T[1]),
        ],
        FEED,
    )
    out = apply_changes(target, feed, ["k"])
    assert rows(out) == [("b", "9", T[2]), ("n", "1", T[1])]
    assert rows(apply_changes(out, feed, ["k"])) == rows(out)
    empty = spark.createDataFrame([], FEED)
    assert rows(apply_changes(out, empty, ["k"])) == rows(out)


SCD = "customer_id string, email string, city string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
CHG = "customer_id string, email string, city string, name string, updated_at timestamp_ntz"


def _scd2(target, changes):
    return scd2_merge(target, changes, ["customer_id"], ["email", "city"])


def test_scd2_reference_example_and_rules(spark):
    target = spark.createDataFrame(
        [
            ("CUST_001", "old@email.com", "Oslo", "A", T[0], None, True),
            ("CUST_002", None, "Rome", "B", T[0], None, True),
            ("CUST_003", "c@x.io", "Bonn", "C", T[0], None, True),
        ],
        SCD,
    )
    changes = spark.createDataFrame(
        [
            ("CUST_001", "new@email.com", "Oslo", "A", T[4]),  # tracked change
            ("CUST_002", "b@x.io", "Rome", "B", T[4]),  # NULL -> value is a change
            ("CUST_003", "c@x.io", "Bonn", "C2", T[4]),  # untracked change only
            ("CUST_004", "d@x.io", "Lyon", "D", T[4]),  # new key
        ],
        CHG,
    )
    out = _scd2(target, changes)
    got = rows(out, "customer_id", "email", "valid_from", "valid_to", "is_current")
    assert got == [
        ("CUST_001", "new@email.com", T[4], None, True),
        ("CUST_001", "old@email.com", T[0], T[4], False),
        ("CUST_002", None, T[0], T[4], False),
        ("CUST_002", "b@x.io", T[4], None, True),
        ("CUST_003", "c@x.io", T[0], None, True),
        ("CUST_004", "d@x.io", T[4], None, True),
    ]
    # A second run with the same input is a no-op.
    assert rows(_scd2(out, changes)) == rows(out)


def test_scd2_chains_changes_in_one_batch_and_ignores_late_ones(spark):
    target = spark.createDataFrame([("CUST_1", "a", "X", "n", T[2], None, True)], SCD)
    changes = spark.createDataFrame(
        [
            ("CUST_1", "zzz", "X", "n", T[1]),  # older than the live version: ignored
            ("CUST_1", "b", "X", "n", T[4]),
            ("CUST_1", "b", "X", "n2", T[5]),  # no tracked change
            ("CUST_1", "c", "Y", "n", T[6]),
        ],
        CHG,
    )
    out = _scd2(target, changes)
    got = rows(out, "email", "valid_from", "valid_to", "is_current")
    assert got == [("a", T[2], T[4], False), ("b", T[4], T[6], False), ("c", T[6], None, True)]
    # Invariants: one current row per key, validity intervals are contiguous.
    assert out.filter("is_current").groupBy("customer_id").count().filter("count > 1").count() == 0
    ordered = sorted(out.collect(), key=lambda r: r.valid_from)
    assert all(a.valid_to == b.valid_from for a, b in zip(ordered, ordered[1:]))


def test_scd2_from_empty_target(spark):
    empty = spark.createDataFrame([], SCD)
    changes = spark.createDataFrame([("CUST_1", "a", "X", "n", T[1]), ("CUST_2", "b", "Y", "m", T[1])], CHG)
    out = _scd2(empty, changes)
    assert out.filter(F.col("is_current")).count() == 2 and out.count() == 2


def test_delete_keys(spark):
    target = spark.createDataFrame([("a", "1", T[0]), ("b", "1", T[0])], KV)
    doomed = spark.createDataFrame([("b",), ("zz",)], "k string")
    assert rows(delete_keys(target, doomed, ["k"])) == [("a", "1", T[0])]


def test_late_changes_do_not_win(spark):
    target = spark.createDataFrame([("a", "new", T[5]), ("b", "1", T[1])], KV)
    late = spark.createDataFrame([("a", "old", T[2]), ("b", "2", T[3])], KV)
    assert rows(upsert(target, late, ["k"])) == [("a", "new", T[5]), ("b", "2", T[3])]
    kept = target.withColumn("is_deleted", F.lit(False))
    gone = apply_changes(kept, spark.createDataFrame([("a", "x", "D", T[6])], FEED), ["k"])
    assert rows(live_rows(gone)) == [("b", "1", T[1])]
    again = apply_changes(gone, spark.createDataFrame([("a", "y", "I", T[5])], FEED), ["k"])
    assert rows(live_rows(again)) == [("b", "1", T[1])]  # the insert is older than the delete
    back = apply_changes(again, spark.createDataFrame([("a", "z", "I", T[7])], FEED), ["k"])
    assert rows(live_rows(back), "k", "v") == [("a", "z"), ("b", "1")]


# --- the cost follows the batch ---------------------------------------------------


def _tree(df):
    """(depth, line) of every node of the physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        text = line.lstrip(" :+-|")
        out.append((len(line) - len(text), text))
    return out


def _moved_whole(df, mark):
    """Exchanges and sorts that see a scan of ``mark`` which no key filter stands over."""
    found, tree = [], _tree(df)
    for i, (depth, text) in enumerate(tree):
        if mark not in text:
            continue
        above, low = [], depth
        for d, line in reversed(tree[:i]):
            if d < low:
                above.append(line)
                low = d
        for line in above:  # from the scan up
            if "_bits" in line and line.startswith(("Filter", "*", "(")) and "Filter" in line:
                break
            if "Exchange" in line or line.split(") ")[-1].startswith("Sort"):
                found.append(line)
    return found


def _big(spark, tmp_path, n=200_000):
    path = str(tmp_path / "target")
    spark.range(n).selectExpr(
        "concat('k', id) AS k", "'old' AS v", "TIMESTAMP_NTZ'2024-01-01' AS updated_at", "false AS is_deleted"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_split_finds_every_key_and_little_else(spark):
    target = spark.range(50_000).selectExpr("CASE WHEN id % 1000 = 7 THEN NULL ELSE concat('k', id) END AS a", "id % 3 AS b", "id")
    for n in (0, 1, 500, 20_000):
        batch = target.filter(f"id % 50 = 7 OR a IS NULL OR id < {n}").limit(n + 60).select("a", "b") if n else target.limit(0).select("a", "b")
        touched, rest = split(target, batch, ["a", "b"])
        keys = {tuple(r) for r in batch.collect()}
        got, others = touched.collect(), rest.collect()
        assert len(got) + len(others) == 50_000
        assert not [r for r in others if (r.a, r.b) in keys]
        assert sum((r.a, r.b) not in keys for r in got) <= 10
    # Keys of another type are the target's keys.
    touched, _ = split(target, spark.createDataFrame([(5,), (9,)], "id int"), ["id"])
    assert {5, 9} <= {r.id for r in touched.collect()}


def test_a_small_batch_moves_no_target_row_but_its_own(spark, tmp_path):
    target = _big(spark, tmp_path)
    batch = spark.createDataFrame([(f"k{i * 19_000}", "new", T[5]) for i in range(10)], KV)
    out = upsert(target.drop("is_deleted"), batch, ["k"])
    assert _moved_whole(out, "target") == []
    assert out.count() == 200_000 and out.filter("v = 'new'").count() == 10
    touched, rest = split(target, batch, ["k"])
    assert touched.count() <= 12
    assert _moved_whole(rest, "target") == [] and rest.count() >= 200_000 - 12
    feed = spark.createDataFrame([("k19", None, "D", T[5]), ("k38", "x", "U", T[5]), ("n", "y", "I", T[5]), ("k57", "late", "U", dt.datetime(2023, 1, 1))], FEED)
    out = apply_changes(target, feed, ["k"])
    assert _moved_whole(out, "target") == []
    assert out.count() == 200_001 and out.filter("is_deleted").count() == 1
    assert {r.v for r in out.filter("k IN ('k38', 'k57')").collect()} == {"x", "old"}
    out = delete_keys(target, feed.select("k"), ["k"])
    assert _moved_whole(out, "target") == [] and out.count() == 199_997
    # The helper does see a whole table that moves.
    assert _moved_whole(target.groupBy("v").count(), "target") and _moved_whole(target.orderBy("k"), "target")


def test_scd2_passes_see_versions_of_batch_keys_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "target")
    spark.range(60_000).selectExpr(
        "concat('CUST_', id) AS customer_id", "'e' AS email", "'X' AS city", "'n' AS name",
        "TIMESTAMP_NTZ'2024-01-01' AS valid_from", "CAST(NULL AS timestamp_ntz) AS valid_to", "true AS is_current",
    ).write.parquet(path)
    closed = spark.createDataFrame([("CUST_7", "a", "X", "n", dt.datetime(2023, 1, 1), T[0], False)], SCD)
    target = spark.read.parquet(path).unionByName(closed)
    changes = spark.createDataFrame([("CUST_7", "b", "X", "n", T[3]), ("CUST_7", "c", "X", "n", T[4]), ("CUST_99999", "d", "Y", "n", T[3])], CHG)
    seen = []
    plain = merge.with_neighbor

    def counted(df, *args, **kwargs):
        seen.append(df.count())
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(merge, "with_neighbor", counted)
    out = _scd2(target, changes)
    assert len(seen) == 2 and max(seen) <= 6  # one current version and three changes, hardly any others
    assert _moved_whole(out, "target") == []
    got = rows(out.filter("customer_id IN ('CUST_7', 'CUST_99999')"), "email", "valid_from", "valid_to", "is_current")
    assert got == [
        ("a", dt.datetime(2023, 1, 1), T[0], False),
        ("b", T[3], T[4], False),
        ("c", T[4], None, True),
        ("d", T[3], None, True),
        ("e", T[0], T[3], False),
    ]
    assert out.count() == 60_004
