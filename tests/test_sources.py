from __future__ import annotations

import pytest
from helpers import at, raw_rows, rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from ordermill.schemas import RAW
from ordermill.session import fresh_path, shared_folder
from ordermill.sources import catalog, csv, lake, rates, versions


def test_csv_text_and_leading_zeros_survive(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'review_id,order_id,review_score,review_comment_title,review_comment_message,'
        'review_creation_date,review_answer_timestamp\n'
        '1,o,5,NA,"first ""quoted"" line\nsecond, line",2018-01-02 03:04:05,\n'
    )
    row = csv.read_csv(spark, str(tmp_path / "r.csv"), "reviews").first()
    assert row.review_comment_message == 'first "quoted" line\nsecond, line'
    assert row.review_comment_title == "NA"
    assert (row.review_creation_date, row.review_answer_timestamp) == (at("2018-01-02T03:04:05"), None)
    (tmp_path / "c.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc,u,01409,sp,SP\n"
    )
    assert csv.read_csv(spark, str(tmp_path / "c.csv"), "customers").first().customer_zip_code_prefix == "01409"


def test_bad_value_fails_the_load_of_its_table_only(spark, layer, tmp_path):
    good = tmp_path / "sellers.csv"
    good.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,1,a,b\n")
    bad = tmp_path / "payments.csv"
    bad.write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\no,1,x,one,2.00\n"
    )
    paths = {"payments": str(bad), "sellers": str(good), "orders": str(tmp_path / "none.csv")}
    report = csv.load_tables(spark, paths, layer)
    assert rows(report, "table_name", "rows", "outcome") == [
        ("orders", None, "skipped"), ("payments", None, "failed"), ("sellers", 1, "loaded")
    ]
    assert "loaded_at" in spark.table(f"{layer}.sellers").columns


def test_load_replaces_what_was_there(spark, layer, tmp_path):
    path = tmp_path / "sellers.csv"
    head = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    path.write_text(head + "s1,1,a,b\ns2,1,a,b\n")
    assert csv.load_table(spark, str(path), "sellers", layer) == 2
    path.write_text(head + "s3,1,a,b\n")
    assert csv.load_table(spark, str(path), "sellers", layer) == 1
    assert rows(catalog.source(spark, "sellers", layer), "seller_id") == [("s3",)]


def test_a_failed_load_keeps_the_old_rows(spark, layer, tmp_path):
    path = tmp_path / "payments.csv"
    head = ",".join(RAW["payments"].names) + "\n"
    path.write_text(head + "o,1,x,1,2.00\n")
    csv.load_table(spark, str(path), "payments", layer)
    path.write_text(head + "o,1,x,one,2.00\n")
    with pytest.raises(Exception, match="one"):
        csv.load_table(spark, str(path), "payments", layer)
    assert rows(catalog.source(spark, "payments", layer), "order_id", "payment_installments") == [("o", 1)]


def test_tables_with_free_text_are_an_argument(spark, layer, tmp_path):
    path = tmp_path / "geolocation.csv"
    path.write_text(",".join(RAW["geolocation"].names) + '\n1,2.0,3.0,"first\nsecond",SP\n')
    csv.load_table(spark, str(path), "geolocation", layer, free_text=frozenset({"geolocation"}))
    assert catalog.source(spark, "geolocation", layer).first().geolocation_city == "first\nsecond"


def test_csv_append(spark, tmp_path):
    path = str(tmp_path / "sellers")
    one = raw_rows(spark, "sellers", {"seller_id": "s"})
    csv.append_csv(one, path)
    csv.append_csv(one, path)
    assert csv.read_csv(spark, path, "sellers").count() == 2


def test_layers_and_tables(spark, layer):
    assert catalog.layer_for(" staging ", "x") == "staging"
    assert catalog.layer_for(None, "x") == "x"
    catalog.create_if_absent(spark, f"{layer}.streaming", RAW["sellers"])
    raw_rows(spark, "sellers", {"seller_id": "s"}).write.insertInto(f"{layer}.streaming")
    catalog.create_if_absent(spark, f"{layer}.streaming", RAW["sellers"])
    assert spark.table(f"{layer}.streaming").count() == 1
    catalog.recreate_raw_tables(spark, layer)
    for name, schema in RAW.items():
        assert [(f.name, f.dataType) for f in catalog.source(spark, name, layer).schema] == [
            (f.name, f.dataType) for f in schema
        ]
    with pytest.raises(LookupError, match="streaming_orders"):
        catalog.require_tables(spark, layer=layer)
    catalog.require_tables(spark, tuple(RAW), layer)
    with pytest.raises(KeyError):
        catalog.source(spark, "unknown", layer)


def test_create_layers_and_empty_table(spark, tmp_path):
    catalog.create_layers(spark, "layer_a", "layer_b", location=str(tmp_path))
    catalog.create_layers(spark, "layer_a", location=str(tmp_path))
    assert {"layer_a", "layer_b"} <= {d.name for d in spark.catalog.listDatabases()}
    assert catalog.empty_like(spark, RAW["orders"]).count() == 0
    spark.sql("DROP DATABASE layer_a CASCADE")
    spark.sql("DROP DATABASE layer_b CASCADE")


def test_statistics_are_refreshed(spark, layer):
    catalog.publish_table(raw_rows(spark, "sellers", {"seller_id": "s"}), f"{layer}.s", ["seller_id"])
    described = spark.sql(f"DESCRIBE EXTENDED {versions.named(f'{layer}.s', 1)}").where("col_name = 'Statistics'").first()
    assert "1 rows" in described.data_type


def test_partitioned_lake_is_pruned(spark, tmp_path):
    path = str(tmp_path / "lake")
    df = spark.createDataFrame([(1, at("2024-01-02T03:00")), (2, at("2024-02-03T00:00"))], "n INT, t TIMESTAMP_NTZ")
    lake.write_by_day(df, F.col("t"), path)
    found = lake.read_lake(spark, path).where("year = 2024 AND month = 2")
    assert rows(found, "n", "day") == [(2, 3)]
    assert "PartitionFilters: [isnotnull(year" in found._jdf.queryExecution().executedPlan().toString()


def test_database_reads_are_split():
    options = lake.jdbc_options("jdbc:x", "t", "id", 0, 1000, 16)
    assert (options["numPartitions"], options["partitionColumn"], options["upperBound"]) == ("16", "id", "1000")


def test_rates_are_inverted(spark):
    body = '{"result": "success", "rates": {"USD": 1, "BRL": 5.0, "VND": 25000}}'
    parsed = rates.parse_rates(spark.createDataFrame([(body,)], "body STRING"))
    row = parsed.first()
    assert (row.base_currency, row.brl_to_usd, row.vnd_to_usd) == ("USD", 0.2, 1 / 25000)
    assert rates.latest_rate(parsed) == 0.2


def test_strict_cast_fails_on_bad_text(spark):
    with pytest.raises(PySparkException):
        spark.createDataFrame([("no time",)], "t STRING").select(F.col("t").cast("timestamp_ntz")).collect()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_missing_path_is_an_error_for_a_single_table(spark, layer):
    with pytest.raises(AnalysisException):
        csv.load_table(spark, "/nowhere/at/all.csv", "sellers", layer)


HEAD = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_columns_are_found_by_their_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("seller_state,seller_city,more,seller_zip_code_prefix,seller_id\nRJ,Rio,x,01409,s1\n")
    assert rows(csv.read_csv(spark, str(tmp_path / "s.csv"), "sellers")) == [("s1", "01409", "Rio", "RJ")]
    (tmp_path / "t.csv").write_text("seller_id,seller_city\ns1,Rio\n")
    with pytest.raises(ValueError, match="seller_zip_code_prefix, seller_state"):
        csv.read_csv(spark, str(tmp_path / "t.csv"), "sellers")
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text(HEAD + "s1,1,a,b\n")
    (folder / "2.csv").write_text("seller_zip_code_prefix,seller_id,seller_city,seller_state\n1,s2,a,b\n")
    with pytest.raises(Exception, match="header does not conform"):
        csv.read_csv(spark, str(folder), "sellers").collect()


def test_report_has_the_cause_and_a_failure_stops_no_other_table(spark, layer, tmp_path):
    for table in RAW:
        (tmp_path / f"{table}.csv").write_text(",".join(RAW[table].names) + "\n")
    (tmp_path / "sellers.csv").write_text("seller_id\ns\n")
    (tmp_path / "payments.csv").write_text(",".join(RAW["payments"].names) + "\no,1,x,one,2.00\n")
    (tmp_path / "reviews.csv").unlink()
    report = {r.table_name: r for r in csv.load_tables(spark, csv.paths_below(str(tmp_path)), layer).collect()}
    assert len(report) == 9
    assert {t: r.outcome for t, r in report.items() if r.outcome != "loaded"} == {
        "sellers": "failed", "payments": "failed", "reviews": "skipped"
    }
    assert "no column" in report["sellers"].error and "one" in report["payments"].error


def test_newest_rate_is_by_the_time_of_the_response(spark):
    old, new = ('{"time_last_update_unix": %d, "rates": {"BRL": %s, "VND": 2}}' % x for x in ((1000, "4.0"), (2000, "5.0")))
    frame = spark.createDataFrame([(new,), (old,), ('{"time_last_update_unix": 9000, "rates": {}}',)], "body STRING")
    assert rates.latest_rate(rates.parse_rates(frame)) == 0.2
    stamped = spark.createDataFrame(
        [('{"rates": {"BRL": 8.0}}', at("2020-01-01T00:00")), ('{"rates": {"BRL": 4.0}}', at("2021-01-01T00:00"))],
        "body STRING, seen TIMESTAMP",
    )
    assert rates.latest_rate(rates.parse_rates(stamped, fetched_at="seen")) == 0.25
