import pytest
from pyspark.sql import functions as F

from clickmill.operators.enrich import enrich
from clickmill.plans.funnel import funnel_conversion
from clickmill.plans.product_sales import product_sales, top_products
from clickmill.plans.profile import customer_profile
from clickmill.plans.rfm import rfm_segments
from clickmill.plans.session_performance import session_performance
from frames import rows_of, silver

T = "2024-01-01 10:00:00"


def test_profile_of_unknown_user_mode_tie_and_null_platforms(spark):
    df = silver(spark, [("1", T, "PURCHASE", "WEB", 1, None, 1, 1.0), ("2", T, "SEARCH", "IOS", 1, None, 1, 1.0),
                        ("3", T, "SEARCH", None, 1, None, 1, 1.0), ("4", T, "SEARCH", None, 1, None, 1, 1.0),
                        ("5", "2024-01-01 10:30:00", "SEARCH", None, 2, "Ann", 1, 1.0)])
    got = rows_of(customer_profile(df), "customer_id", "fullname", "email", "total_transactions", "primary_device")
    assert got == [(1, None, None, 1, "IOS"), (2, "Ann", "Ann@x", 0, None)]


def test_profile_mode_counts_a_platform_over_differing_names(spark):
    df = silver(spark, [("1", T, "SEARCH", "WEB", 1, "B", 1, 1.0), ("2", T, "SEARCH", "WEB", 1, "A", 1, 1.0),
                        ("3", T, "SEARCH", "WEB", 1, None, 1, 1.0), ("4", T, "SEARCH", "IOS", 1, "A", 1, 1.0),
                        ("5", T, "SEARCH", "IOS", 1, "A", 1, 1.0)])
    assert rows_of(customer_profile(df), "fullname", "primary_device") == [("A", "WEB")]


def test_profile_keeps_the_null_user_and_splits_hours(spark):
    df = silver(spark, [("1", T, "PURCHASE", "WEB", None, None, 1, 1.0),
                        ("2", "2024-01-01 11:00:00", "PURCHASE", "WEB", None, None, 1, 1.0)])
    assert rows_of(customer_profile(df), "customer_id", "hour") == [(None, "10"), (None, "11")]
    assert rows_of(customer_profile(df, grain=()), "customer_id", "total_transactions") == [(None, 2)]


def test_funnel_without_first_step_unknown_types_and_null_users(spark):
    df = silver(spark, [("1", T, "PURCHASE", "WEB", 1, None, 1, 1.0), ("2", T, "ERROR", "IOS", 1, None, 1, 1.0),
                        ("3", T, "SEARCH", "ANDROID", None, None, 1, 1.0),
                        ("4", T, "SEARCH", "TV", 1, None, 1, 1.0), ("5", T, "SEARCH", "TV", 1, None, 1, 1.0),
                        ("6", T, "PURCHASE", "TV", 1, None, 1, 1.0), ("7", T, "PURCHASE", "TV", 2, None, 1, 1.0)])
    steps = ["device_type", "step_1_visit", "step_2_view_product", "step_3_initiate_checkout",
             "step_4_purchase_success", "conversion_rate_overall"]
    assert rows_of(funnel_conversion(df), *steps) == [
        ("ANDROID", 0, 0, 0, 0, 0.0), ("IOS", 0, 0, 0, 0, 0.0), ("TV", 1, 0, 0, 2, 2.0), ("WEB", 0, 0, 0, 1, 0.0)]
    assert "Expand" not in funnel_conversion(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most_rows", [3, 20_000])
def test_rfm_values_scores_and_segments(spark, most_rows):
    rows = [("1", "2024-01-01 10:59:00", "PURCHASE", "WEB", 1, None, 1, 5.0),
            ("2", "2024-01-01 10:58:59", "PURCHASE", "WEB", 1, None, 1, 5.0),
            ("3", "2024-01-01 10:00:00", "PURCHASE", "WEB", 2, None, 9, None),
            ("4", T, "SEARCH", "WEB", 3, None, 1, 7.0), ("5", T, "SEARCH", "WEB", 4, None, 1, 7.0),
            ("6", "2024-01-01 10:30:00", "PURCHASE", "WEB", 5, None, 1, 3.0)]
    got = rows_of(rfm_segments(silver(spark, rows), most_rows=most_rows), "customer_id", "recency_value",
                  "frequency_value", "monetary_value", "r_score", "f_score", "m_score", "rfm_cell", "segment_name")
    assert got == [
        (1, 0, 2, 10.0, 5, 5, 5, "555", "Hourly Champions"),
        (2, 59, 1, None, 3, 3, 1, "331", "Hourly Active Users"),
        (3, 9999, 0, 0.0, 1, 1, 2, "112", "Hourly Low Active"),
        (4, 9999, 0, 0.0, 2, 2, 3, "223", "Hourly Low Active"),
        (5, 29, 1, 3.0, 4, 4, 4, "444", "Hourly Champions")]


def test_rfm_paths_agree_per_hour_and_overall(spark):
    rows = [(str(i), f"2024-01-0{1 + i % 2} 1{i % 3}:{i % 60:02d}:00", "PURCHASE" if i % 4 == 0 else "SEARCH", "WEB",
             i % 23, None, 1, float(i % 5)) for i in range(300)]
    df = silver(spark, rows)
    for grain in (("date", "hour"), ("date",), ()):
        assert rows_of(rfm_segments(df, grain)) == rows_of(rfm_segments(df, grain, most_rows=3))


def test_session_performance_counts_null_users_in_the_average_only(spark):
    df = silver(spark, [("1", T, "SEARCH", "WEB", 1, None, 1, 1.0), ("2", T, "SEARCH", "WEB", None, None, 1, 1.0),
                        ("3", T, "SEARCH", "WEB", None, None, 1, 1.0), ("4", T, "SEARCH", "IOS", None, None, 1, 1.0)])
    columns = ["operating_system", "total_sessions", "total_users", "bounce_sessions", "bounce_rate",
               "avg_events_per_session"]
    expected = [("IOS", 0, 0, 1, 0.0, 1.0), ("WEB", 1, 1, 1, 1.0, 1.5)]
    assert rows_of(session_performance(df), *columns) == expected
    assert rows_of(session_performance(df, approximate_users=True), *columns) == expected


def test_product_sales_counts_every_event_and_drops_unknown_products(spark):
    df = silver(spark, [("1", T, "SEARCH", "WEB", 1, None, 1, None), ("2", T, "PURCHASE", "WEB", 1, None, 1, None),
                        (None, T, "PURCHASE", "WEB", 1, None, 2, None), ("4", T, "SEARCH", "WEB", 1, None, 99, None),
                        ("5", T, "SEARCH", "WEB", 1, None, None, None), ("6", T, "SEARCH", "WEB", 1, None, 3, None)])
    products = spark.createDataFrame([(1, "a", 2.5), (2, "a", 1.0), (3, "b", None)],
                                     "product_id int, name string, price double")
    assert rows_of(product_sales(df, products)) == [("a", 6.0, 2), ("b", None, 1)]
    assert rows_of(product_sales(df, products, ["PURCHASE"])) == [("a", 3.5, 1)]
    assert [r.name for r in top_products(product_sales(df, products), 1).collect()] == ["a"]


def dims(spark):
    users = spark.createDataFrame([(1, "ann", "Ann", "a@x")], "user_id bigint, username string, full_name string, "
                                  "email string").withColumn("created_at", F.lit("2020-01-01").cast("timestamp"))
    products = spark.createDataFrame([(1, 1, 1, "p", 2.0), (2, 77, 77, "q", 3.0)], "product_id bigint, "
                                     "store_id bigint, category_id bigint, name string, price double")
    categories = spark.createDataFrame([(1.0, "c")], "category_id double, name string")
    stores = spark.createDataFrame([(1, "s")], "store_id bigint, store_name string")
    return {"users": users, "products": products, "categories": categories, "stores": stores}


@pytest.mark.parametrize("limit", [0, 10**8])
def test_enrichment_keeps_every_event_and_nulls_what_is_unknown(spark, limit):
    bronze = spark.createDataFrame(
        [("1", 1, 1, 0), ("2", 9, 1, 0), ("3", 1, 9, 0), ("4", None, None, 0), ("5", 1, 2, 0)],
        "event_id string, user_id bigint, product_id bigint, occurred_at bigint").selectExpr(
        "*", "'SEARCH' AS event_type", "'WEB' AS platform", "'1970-01-01' AS date", "'00' AS hour")
    got = rows_of(enrich(bronze, **dims(spark), broadcast_bytes=limit), "event_id", "full_name", "product_name",
                  "product_price", "category_name", "store_name")
    assert got == [("1", "Ann", "p", 2.0, "c", "s"), ("2", None, "p", 2.0, "c", "s"), ("3", "Ann", None, None, None, None),
                   ("4", None, None, None, None, None), ("5", "Ann", "q", 3.0, None, None)]
    narrow = enrich(bronze, **dims(spark), dims=("products",), broadcast_bytes=limit)
    assert rows_of(narrow, "full_name").count((None,)) == 5
    assert narrow.columns == enrich(bronze, **dims(spark)).columns
