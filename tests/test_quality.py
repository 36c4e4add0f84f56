from pyspark.sql import functions as F

from strata.functions import quality as q
from strata.plans.silver import ORDER_TS_FORMATS


def test_email_rules(spark):
    df = spark.createDataFrame(
        [(" A.b@Example.COM ",), ("x@y.io",), ("noatsign.com",), ("a@b.c",), (None,), ("\ta@b.co",)],
        "email string",
    )
    got = df.select("email", q.normalized_email("email").alias("n"), q.valid_email("email").alias("ok")).collect()
    res = {r.email: (r.n, r.ok) for r in got}
    assert res[" A.b@Example.COM "] == ("a.b@example.com", True)  # padded, upper case: valid
    assert res["x@y.io"][1] is True
    assert res["noatsign.com"][1] is False
    assert res["a@b.c"][1] is False  # one-letter domain suffix
    assert res[None] == (None, False)  # NULL is never NULL-flagged
    assert res["\ta@b.co"][1] is False  # trim strips spaces only


def test_customer_id_pattern(spark):
    df = spark.createDataFrame([("CUST_1",), (" CUST_2",), ("X_3",), (None,), ("CUST_",)], "id string")
    ok = [r.id for r in df.filter(q.valid_customer_id("id")).collect()]
    assert ok == ["CUST_1"]


def test_clamps_keep_type_and_null(spark):
    df = spark.createDataFrame([(-5, -1.5), (0, 0.0), (None, None), (3, 2.5)], "qty int, price double")
    out = df.withColumns(q.clamped(df, ["qty", "price"]))
    assert dict(out.dtypes) == {"qty": "int", "price": "double"}
    assert sorted(out.collect(), key=lambda r: (r.qty is None, r.qty)) == [
        (0, 0.0),
        (0, 0.0),
        (3, 2.5),
        (None, None),
    ]


def test_discount_clamp_and_line_checks(spark):
    data = [
        ("a", 2, 10.0, -0.1, 20.00, False),  # negative -> 0
        ("b", 2, 10.0, 0.0, 20.00, None),  # NULL return flag -> not returned
        ("c", 2, 10.0, 0.5, 10.00, True),
        ("d", 2, 10.0, 1.0, 0.00, False),
        ("e", 2, 10.0, 1.5, 0.00, False),  # above 1 -> 1
        ("f", 2, 10.0, None, 20.00, False),  # NULL discount counts as none
        ("g", 1, 10.0, 0.0, 10.009, False),  # off by 0.009: valid
        ("h", 1, 10.0, 0.0, 10.011, False),  # off by 0.011: invalid
    ]
    df = spark.createDataFrame(
        data, "id string, quantity int, unit_price double, discount_pct double, line_total double, return_flag boolean"
    )
    out = {r.id: r for r in q.line_checks(df).collect()}
    assert out["a"].discount_pct == 0.0 and out["a"].is_valid_line_total and not out["a"].has_discount
    assert out["b"].is_returned is False
    assert out["c"].calculated_line_total == 10.0 and out["c"].has_discount and out["c"].is_returned
    assert out["e"].discount_pct == 1.0 and out["e"].calculated_line_total == 0.0
    assert out["f"].discount_pct is None and out["f"].calculated_line_total == 20.0
    assert out["f"].has_discount is False
    assert out["g"].is_valid_line_total is True
    assert out["h"].is_valid_line_total is False


def test_percent_discount_unit(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 10, 90.0, False), (1, 100.0, 150, 0.0, False)],
        "quantity int, unit_price double, discount_pct int, line_total double, return_flag boolean",
    )
    out = q.line_checks(df, unit=q.PERCENT).collect()
    assert [r.calculated_line_total for r in out] == [90.0, 0.0]
    assert all(r.is_valid_line_total for r in out)


def test_timestamp_layouts(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("01/31/2024",), ("N/A",), (None,)], "s string")
    out = df.select(F.col("s"), q.parsed_timestamp("s", ORDER_TS_FORMATS).alias("t")).collect()
    got = {r.s: r.t for r in out}
    assert str(got["2024-01-02 03:04:05"]) == "2024-01-02 03:04:05"
    assert str(got["01/31/2024"]) == "2024-01-31 00:00:00"
    assert got["N/A"] is None and got[None] is None


def test_safe_ratio_divide_by_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert [r.x for r in df.select(q.safe_ratio(F.col("a"), F.col("b"), 100.0).alias("x")).collect()] == [
        None,
        25.0,
    ]
