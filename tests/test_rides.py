from decimal import Decimal

from strata.plans.rides import SILVER_RIDES, gold_rides, silver_rides

BRONZE = "ride_id string, start_time string, end_time string, start_station_id string, end_station_id string, bike_id string, user_type string"


def test_silver_rides_durations_prices_and_bad_rows(spark):
    data = [
        ("r0", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "s", "e", "b", "member"),  # 0 s
        ("r1", "2024-01-01 10:00:00", "2024-01-01 10:00:59", "s", "e", "b", "member"),  # 59 s -> 0 min
        ("r2", "2024-01-01 10:00:00", "2024-01-01 10:01:00", "s", "e", "b", "member"),  # 60 s -> 1 min
        ("r3", "2024-01-01 10:00:00", "2024-01-01 09:00:00", "s", "e", "b", "member"),  # negative
        ("r4", "2024-01-01 10:00:00", "2024-01-01 10:07:00", "s", "e", "b", None),  # NULL type pays 15/h
        ("r5", "bad-time", "2024-01-01 10:07:00", "s", "e", "b", "casual"),  # malformed
    ]
    out = silver_rides(spark, spark.createDataFrame(data, BRONZE))
    got = {r.ride_id: r.ride_revenue for r in out.collect()}
    assert got == {"r2": Decimal("0.1667"), "r4": Decimal("1.7500")}
    assert dict(out.dtypes)["ride_revenue"] == "decimal(19,4)"
    assert out.schema["ride_revenue"].metadata["comment"] == {c.name: c.comment for c in SILVER_RIDES}["ride_revenue"]


def test_gold_rides_first_and_last_station(spark):
    data = [
        ("1", "2024-01-01 08:00:00", "2024-01-01 08:30:00", None, "x", "b1", "member"),  # NULL at earliest
        ("2", "2024-01-01 09:00:00", "2024-01-01 09:30:00", "a", "y", "b1", "member"),
        ("3", "2024-01-01 09:00:00", "2024-01-01 09:30:00", "c", "z", "b1", "casual"),  # same times as 2
        ("4", "2024-01-02 09:00:00", "2024-01-02 10:00:00", "d", "w", "b1", "member"),
    ]
    out = gold_rides(spark, silver_rides(spark, spark.createDataFrame(data, BRONZE)))
    got = {str(r.ride_date): r for r in out.collect()}
    d1 = got["2024-01-01"]
    assert d1.total_rides == 3 and d1.total_revenue == Decimal("17.5000")
    assert d1.first_start_station_id is None  # the value at the minimum, even NULL
    assert d1.last_end_station_id == "z"  # equal end times: larger ride_id
    assert got["2024-01-02"].first_start_station_id == "d"


def test_rides_from_a_csv_folder(spark, tmp_path):
    from strata.plans.rides import bronze_rides_from_csv

    d = tmp_path / "rides"
    d.mkdir()
    header = "ride_id,start_time,end_time,start_station_id,end_station_id,bike_id,user_type\n"
    (d / "part-1.csv").write_text(header + "r1,2024-01-01 10:00:00,2024-01-01 10:30:00,a,b,k1,member\n")
    (d / "part-2.csv").write_text(header + "r2,2024-01-01 11:00:00,2024-01-01 12:00:00,b,c,k1,casual\n")
    gold = gold_rides(spark, silver_rides(spark, bronze_rides_from_csv(spark, str(d)))).first()
    assert (gold.total_rides, gold.total_revenue) == (2, Decimal("20.0000"))
    assert (gold.first_start_station_id, gold.last_end_station_id) == ("a", "c")
