"""Raw files and named tables of the session catalog."""

import datetime as dt
import os

import pytest

from strata.functions.schema import Column
from strata.plans import incremental as inc
from strata.plans import rides
from strata.plans.bronze import ingest_retail
from strata.sources.lake import Partition, scratch_lake, settled
from strata.sources.raw_files import file_audit, file_audits, profile, read_csv, read_text_csv
from strata.sources.tables import TABLE_NAMES, DriverTables
from tests.conftest import rows


def files_of(lake, table):
    """Path of each data file below the table's folder."""
    return set(lake.read(table).inputFiles())


def test_overwrite_replaces_rows_and_schema(spark):
    lake = scratch_lake(spark, "t")
    with pytest.raises(KeyError):
        lake.read("t")
    assert lake.read_or_empty("t", [Column("id", "bigint")]).count() == 0
    lake.overwrite("t", spark.range(3))
    lake.overwrite("t", spark.range(2).selectExpr("id AS other", "'x' AS more"))
    assert lake.read("t").columns == ["other", "more"] and rows(lake.read("t")) == [(0, "x"), (1, "x")]
    # A table can be read by its name alone, and is Spark's own parquet table.
    assert spark.table(f"{lake.database}.t").count() == 2
    kind = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {lake.name('t')}").collect()}
    assert kind["Provider"] == "parquet"


def test_create_if_absent_keeps_types_comments_and_rows(spark):
    lake = scratch_lake(spark, "t")
    columns = [Column("id", "bigint", "the owner's key"), Column("price", "decimal(18,2)"), Column("at", "timestamp_ntz", "wall \\ clock")]
    assert lake.create("t", columns) is True
    lake.append("t", spark.range(2).selectExpr("CAST('2024-01-01' AS timestamp_ntz) AS at", "id", "CAST(id AS decimal(18,2)) AS price"))
    assert lake.create("t", [Column("id", "string")]) is False
    assert lake.read("t").count() == 2
    found = rows(lake.columns(["t"]), "position", "column_name", "data_type", "comment")
    assert found == [(1, "id", "bigint", "the owner's key"), (2, "price", "decimal(18,2)", None), (3, "at", "timestamp_ntz", "wall \\ clock")]
    # Replacing all rows keeps the declared columns.
    lake.replace("t", spark.range(7).selectExpr("id", "1.5BD AS price", "CAST(NULL AS timestamp_ntz) AS at"))
    assert lake.read("t").count() == 7
    assert rows(lake.columns(["t"]), "position", "column_name", "data_type", "comment") == found


def test_append_writes_only_the_new_rows(spark):
    lake = scratch_lake(spark, "t")
    lake.overwrite("t", spark.range(100))
    first = files_of(lake, "t")
    lake.append("t", spark.range(100, 103))
    new = files_of(lake, "t") - first
    assert first < files_of(lake, "t") and spark.read.parquet(*new).count() == 3
    assert lake.read("t").count() == 103


DAY = Partition("part", "int", "id % 4")


def test_only_the_partitions_of_the_rows_are_replaced(spark):
    lake = scratch_lake(spark, "t")
    lake.create("t", [Column("id", "bigint"), Column("v", "string")], DAY)
    made = lambda n, v: spark.range(n).selectExpr("id", f"'{v}' AS v").withColumn("part", DAY.of())
    lake.replace_partitions("t", made(8, "old"))
    before = files_of(lake, "t")
    # The result may depend on the table: it is settled first.
    own = lake.read("t").filter("part = 1").selectExpr("id", "'new' AS v", "part")
    lake.replace_partitions("t", settled(own))
    after = files_of(lake, "t")
    assert {f for f in before if "/part=1/" not in f} == {f for f in after if "/part=1/" not in f}
    assert not {f for f in before if "/part=1/" in f} & after
    assert rows(lake.read("t").filter("v = 'new'"), "id") == [(1,), (5,)] and lake.read("t").count() == 8
    lake.drop_partitions("t", "part", [3])
    assert rows(lake.read("t").selectExpr("id % 4 AS p").distinct()) == [(0,), (1,), (2,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_properties_stay_with_the_table(spark):
    lake = scratch_lake(spark, "t")
    lake.create("t", [Column("id", "bigint")])
    assert lake.property("t", "strata.epoch.x") is None
    lake.set_property("t", "strata.epoch.x", "12")
    lake.replace("t", spark.range(3))
    assert lake.property("t", "strata.epoch.x") == "12"


def test_declared_tables_are_created_and_seeded_once(spark):
    lake = scratch_lake(spark, "t")
    at, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    assert sorted(inc.create_tables(lake)) == sorted(inc.DECLARED) and inc.create_tables(lake) == []
    inc.seed_control(lake, ["a", "b"], at)
    inc.seed_control(lake, ["a", "b", "c"], later)
    assert rows(lake.read(inc.CHECKPOINT_TABLE), "table_name", "records_processed", "updated_at") == [("a", 0, at), ("b", 0, at), ("c", 0, later)]
    for table, declared in inc.DECLARED.items():
        kinds = {c.column_name: c.data_type for c in lake.columns([table]).collect()}
        assert {c.name: kinds[c.name] for c in declared} == {c.name: c.type for c in declared}


def test_stored_views_keep_comments_and_follow_a_refresh(spark):
    lake = scratch_lake(spark, "t")
    ride = ("r", "2024-01-01 10:00:00", "2024-01-01 10:30:00", "s", "e", "b", "member")
    kinds = "ride_id string, start_time string, end_time string, start_station_id string, end_station_id string, bike_id string, user_type string"
    rides.refresh_views(lake, spark.createDataFrame([ride], kinds))
    rides.refresh_views(lake, spark.createDataFrame([("q", *ride[1:]), ("r2", *ride[1:])], kinds))
    assert rows(lake.read(rides.SILVER_VIEW), "ride_id") == [("q",), ("r2",)]
    assert rows(lake.read(rides.GOLD_VIEW), "bike_id", "total_rides") == [("b", 2)]
    for view, columns in rides.VIEWS.items():
        stored = [(c.column_name, c.data_type, c.comment) for c in lake.columns([view]).orderBy("position").collect()]
        assert stored == [(c.name, c.type, c.comment) for c in columns]


def test_given_files_have_their_sizes_in_the_audit(spark):
    root = "/root/testdata/sf0.001"
    tables = DriverTables(spark, root)
    found = {r.table_name: r.file_size for r in file_audits({n: tables.table(n) for n in TABLE_NAMES}).collect()}
    assert found == {n: os.path.getsize(f"{root}/{n}.parquet") for n in TABLE_NAMES}


def test_csv_multiline_quotes_empty_and_missing(spark, tmp_path):
    p = tmp_path / "customers.csv"
    p.write_text(
        'customer_id,first_name,address,age\n'
        'CUST_1,Ann,"12 ""Old"" Road\nFlat 2",31\n'
        'CUST_2,,"plain",\n'
        'CUST_3,Cy\n'
    )
    df = read_csv(spark, str(p), multiline=True)
    got = {r.customer_id: r for r in df.collect()}
    assert got["CUST_1"].address == '12 "Old" Road\nFlat 2'
    assert got["CUST_1"].age == 31  # inferred integer
    assert got["CUST_2"].first_name is None and got["CUST_2"].age is None
    assert got["CUST_3"].address is None  # missing trailing columns read as NULL


def test_folder_read_audit_and_profile(spark, tmp_path):
    d = tmp_path / "rides"
    d.mkdir()
    (d / "a.csv").write_text("ride_id,start_time\n1,2024-01-01 00:00:00\n2,x\n")
    (d / "b.csv").write_text("ride_id,start_time\n3,2024-01-02 00:00:00\n")
    df = read_text_csv(spark, str(d))
    assert dict(df.dtypes) == {"ride_id": "string", "start_time": "string"}
    audit = {os.path.basename(r.file_path): r.row_count for r in file_audit(df).collect()}
    assert audit == {"a.csv": 2, "b.csv": 1}
    sizes = {os.path.basename(r.file_path): r.file_size for r in file_audit(df).collect()}
    assert sizes == {n: os.path.getsize(d / n) for n in ("a.csv", "b.csv")}
    prof = profile("rides", df).first()
    assert (prof.table_name, prof.row_count, prof.column_count) == ("rides", 3, 2)


def test_ingest_retail_writes_four_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "customers.csv").write_text('customer_id,first_name\nCUST_1,"A\nB"\n')
    (raw / "orders_part-0000.csv").write_text("order_id,quantity\nO1,2\n")
    (raw / "orders_part-0001.csv").write_text("order_id,quantity\nO2,3\n")
    (raw / "products.csv").write_text("product_id,unit_price\nP1,9.5\n")
    (raw / "transactions.csv").write_text("transaction_id,order_id\nT1,O1\n")
    lake = scratch_lake(spark, "bronze")
    names = ["bronze_customers", "bronze_orders", "bronze_products", "bronze_transactions"]
    assert sorted(ingest_retail(spark, str(raw), lake)) == names
    assert sorted(t.name for t in spark.catalog.listTables(lake.database)) == names
    assert lake.read("bronze_customers").first().first_name == "A\nB"
    assert lake.read("bronze_products").first().unit_price == 9.5
    # Ingesting again overwrites.
    ingest_retail(spark, str(raw), lake)
    assert lake.read("bronze_orders").count() == 2


def test_stored_medallion_run(spark, tmp_path):
    from strata.plans.medallion import build_gold, build_silver, dashboard, preview

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "customers.csv").write_text(
        'customer_id,first_name,last_name,email,address,city,state,country,gender,loyalty_tier\n'
        'CUST_1,Ann,"Lee\nJr",ann@x.io,"1 ""A"" St",Oslo,OS,NO,f,Gold\n'
        'CUST_1,Ann,Lee,ann@x.io,x,Oslo,OS,NO,f,Gold\n'
        'BAD_2,Bo,Z,bo@x.io,x,Rome,RM,IT,m,Silver\n'
    )
    (raw / "products.csv").write_text(
        "product_id,product_name,category,sub_category,brand,sku,unit_price,cost_price,stock_qty\n"
        "P1,Lamp,Home,Light,B,S1,10.0,6.0,3\nP2,Desk,Home,Office,B,S2,50.0,,0\n"
    )
    (raw / "orders_part-0000.csv").write_text(
        "order_id,customer_id,status,payment_method,quantity,unit_price,discount_pct,shipping_cost,line_total,return_flag,order_ts\n"
        "O1,CUST_1, paid ,card,1,60.0,0.0,5.0,60.0,false,2024-01-02 10:00:00\n"
    )
    (raw / "transactions.csv").write_text(
        "transaction_id,order_id,product_id,quantity,unit_price,discount_pct,line_total,transaction_date,return_flag\n"
        "T1,O1,P1,1,10.0,0.0,10.0,2024-01-02,false\nT2,O1,P2,1,50.0,0.0,50.0,2024-01-02,false\n"
        "T3,O9,P1,2,10.0,0.5,10.0,2024-01-03,false\n"
    )
    lake = scratch_lake(spark, "medallion")
    ingest_retail(spark, str(raw), lake)
    counts = build_silver(lake)
    assert counts == {"silver_customers": 1, "silver_products": 2, "silver_orders": 1, "silver_transactions": 3}
    gold_counts = build_gold(lake)
    assert gold_counts["gold_total_revenue"] == 1 and gold_counts["gold_top_products"] == 2
    boards = dashboard(lake)
    assert [tuple(r) for r in boards["revenue_summary"].collect()][0][1:] == (1, 2)
    assert [r.product_name for r in boards["top_products"].collect()] == ["Desk", "Lamp"]
    assert preview(lake, "silver_customers", 5).count() == 1


def test_writes_of_a_layer_overlap_and_their_errors_are_raised(spark):
    import threading

    from strata.plans import medallion
    from strata.sources.lake import together

    lake = scratch_lake(spark, "t")
    real, met = lake.overwrite, threading.Barrier(2, timeout=60)

    def overwrite(name, df):
        met.wait()  # both writes are under way
        real(name, df)

    lake.overwrite = overwrite
    assert medallion._write_counted(lake, {"a": spark.range(3), "b": spark.range(5)}) == {"a": 3, "b": 5}
    assert rows(lake.read("a")) == [(0,), (1,), (2,)] and lake.read("b").count() == 5
    with pytest.raises(ZeroDivisionError):
        together([lambda: 1, lambda: 1 // 0])
