"""Small literal frames."""

from pyspark.sql import functions as F

SILVER_LITERAL = ("event_id string, occurred_at string, event_type string, platform string, user_id bigint, "
                  "full_name string, email string, product_id bigint, product_price double")


def silver(spark, rows):
    """Rows of (id, time, type, platform, user, name, product, price); date and hour follow from the time."""
    data = [(i, t, k, p, u, n, None if n is None else f"{n}@x", prod, price)
            for i, t, k, p, u, n, prod, price in rows]
    return (spark.createDataFrame(data, SILVER_LITERAL)
            .withColumn("occurred_at", F.col("occurred_at").cast("timestamp"))
            .withColumn("user_created_at", F.lit("2020-01-01").cast("timestamp"))
            .withColumn("date", F.date_format("occurred_at", "yyyy-MM-dd"))
            .withColumn("hour", F.date_format("occurred_at", "HH")))


def events(spark, rows):
    """Rows of (user, time) or (user, time, platform) as silver-like events with running ids."""
    full = [(str(i), r[1], "SEARCH", r[2] if len(r) > 2 else "WEB", r[0], None, 1, 1.0) for i, r in enumerate(rows)]
    return silver(spark, full)


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
