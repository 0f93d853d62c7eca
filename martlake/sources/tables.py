"""Scans of the driver tables and the logical tables built from them.

The reference works on a retail transaction table, daily session / hit drops
and a vehicle listing table.  The test data is a TPC-H-like star schema plus an
``events`` stream, so each logical table is a projection/join of those tables
(mapping in FIXTURES.md §3).  Every builder only joins the dimension tables
whose columns are asked for: the dimension joins are LEFT joins on unique keys,
so leaving one out never changes the row set, and Catalyst then prunes the
scan down to the needed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

RETAIL_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity",
                  "InvoiceDate", "UnitPrice", "CustomerID", "Country")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def half_up_cents(x: Column) -> Column:
    """Round a positive double to cents, half up, using only IEEE operations
    (floor of x*100+0.5) so every engine computes the same double."""
    return F.floor(x * 100 + 0.5) / 100


def retail(spark: SparkSession, sf_dir: str, columns=RETAIL_COLUMNS) -> DataFrame:
    """Retail transactions (InvoiceNo, StockCode, Description, Quantity,
    InvoiceDate, UnitPrice, CustomerID, Country) from lineitem.

    Quantity is negative for the first line of returned orders (returns);
    CustomerID is missing for every tenth customer key, as guest checkouts.
    """
    columns = tuple(columns)
    li = read_table(spark, sf_dir, "lineitem")
    df = li.select(
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1),
               -F.col("l_quantity")).otherwise(F.col("l_quantity"))
        .cast("bigint").alias("Quantity"),
        F.col("l_shipdate").alias("InvoiceDate"),
        half_up_cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
        F.col("l_orderkey").alias("_ok"),
        F.col("l_partkey").alias("_pk"),
    )
    if "Description" in columns:
        part = read_table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("_pk"), F.col("p_name").alias("Description"))
        df = df.join(part, "_pk", "left")
    if "CustomerID" in columns or "Country" in columns:
        orders = read_table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("_ok"), F.col("o_custkey").alias("_ck"))
        # the customer's country joins the orders, so the lines are shuffled once for both
        if "Country" in columns:
            cust = read_table(spark, sf_dir, "customer").select(
                F.col("c_custkey").alias("_ck"), F.col("c_nationkey").alias("_nk"))
            # nation is a fixed 25-row dimension: broadcast is size-bounded
            nation = read_table(spark, sf_dir, "nation").select(
                F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("Country"))
            orders = orders.join(cust, "_ck", "left").join(F.broadcast(nation), "_nk", "left").drop("_nk")
        df = df.join(orders, "_ok", "left").withColumn(
            "CustomerID", F.when(F.col("_ck") % 10 == 0, F.lit(None)).otherwise(F.col("_ck")))
    # the joins carry the keys; their texts are made last
    texts = {"InvoiceNo": F.col("_ok").cast("string"), "StockCode": F.col("_pk").cast("string")}
    return df.select(*[texts[c].alias(c) if c in texts else c for c in columns])


def item_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """StockCode and Description, each pair once: for retail rows that come without descriptions."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("StockCode"), F.col("p_name").alias("Description")).distinct()


def _event_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def drop_file_name(ts: Column) -> Column:
    """Hourly drop file a record arrives in: 'yyyy-MM-dd_HH.json'."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd_HH"), F.lit(".json"))


def hits_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hit records as they arrive in the daily drops (FIXTURES.md §1).

    One record per event; ``source_file`` is the hourly drop the record
    arrives in and ``src_pos`` its position (event order), which is the file
    order the ranked dedup (W7b) needs for ties.
    """
    ev = read_table(spark, sf_dir, "events")
    day = _event_day(F.col("ts"))
    return ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), day).alias("session_id"),
        day.alias("hit_date"),
        F.date_format("ts", "HH:mm:ss").alias("hit_time"),
        F.hour("ts").alias("hit_number"),
        F.lit("event").alias("hit_type"),
        F.when(F.col("event_type") == "error", F.lit(None))
        .otherwise(F.col("event_type")).alias("hit_referer"),
        F.concat(F.lit("/"), F.col("event_type")).alias("hit_page_path"),
        F.col("event_type").alias("event_category"),
        F.col("event_type").alias("event_action"),
        F.get_json_object("props", "$.k").alias("event_label"),
        F.col("value").alias("event_value"),
        day.alias("src_day"),
        drop_file_name(F.col("ts")).alias("source_file"),
        F.col("event_id").alias("src_pos"),
        F.col("user_id").alias("_user_id"),
    )


def sessions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw session records: one per (user, day) of ``events``.

    The visit attributes are derived from the session's own events so that
    the cleaning rules meet real NULLs.  ``visit_time`` arrives unpadded
    ('7:8:9'); a session that starts and ends with an error event carries a
    corrupt time (hour 25), which cleaning turns into NULL and the load
    rejects (NOT NULL), leaving its hits without a parent.  ``visit_number`` counts a user's
    sessions by day; its window partition holds one row per active day of a
    user, so it is bounded by the calendar, not by the event volume.
    """
    ev = read_table(spark, sf_dir, "events")
    day = _event_day(F.col("ts"))
    first = F.min_by(F.struct("event_type", "props", "ts"), F.struct("ts", "event_id"))
    last = F.max_by(F.struct("event_type", "props"), F.struct("ts", "event_id"))
    s = (ev.groupBy(F.col("user_id"), day.alias("visit_date"))
         .agg(first.alias("f"), last.alias("l"),
              F.count(F.lit(1)).alias("n"),
              F.count_if(F.col("event_type") == "purchase").alias("n_purchase"),
              F.count_if(F.col("event_type") == "error").alias("n_error")))
    w = Window.partitionBy("user_id").orderBy("visit_date")
    return s.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.col("visit_date")).alias("session_id"),
        F.col("user_id").cast("string").alias("client_id"),
        F.col("visit_date"),
        F.when((F.col("f.event_type") == "error") & (F.col("l.event_type") == "error"),
               F.concat(F.lit("25:"), F.date_format("f.ts", "m:s")))
        .otherwise(F.date_format("f.ts", "H:m:s")).alias("visit_time"),
        F.row_number().over(w).alias("visit_number"),
        F.nullif(F.col("f.event_type"), F.lit("error")).alias("utm_source"),
        F.nullif(F.col("l.event_type"), F.lit("error")).alias("utm_medium"),
        F.get_json_object("f.props", "$.k").alias("utm_campaign"),
        F.when(F.col("n_purchase") > 0,
               F.concat(F.lit("purchase_"), F.col("n_purchase").cast("string"))).alias("utm_adcontent"),
        F.when(F.col("n_error") > 0,
               F.concat(F.lit("error_"), F.col("n_error").cast("string"))).alias("utm_keyword"),
        F.when(F.col("n") >= 3, F.lit("desktop")).otherwise(F.lit("mobile")).alias("device_category"),
        F.nullif(F.col("f.event_type"), F.lit("signup")).alias("device_os"),
        F.nullif(F.col("l.event_type"), F.lit("view")).alias("device_brand"),
        F.concat(F.lit("model_"), F.col("f.event_type")).alias("device_model"),
        F.concat(F.col("n").cast("string"), F.lit("x"), F.col("n_purchase").cast("string"))
        .alias("device_screen_resolution"),
        F.col("l.event_type").alias("device_browser"),
        F.col("f.event_type").alias("geo_country"),
        F.get_json_object("l.props", "$.k").alias("geo_city"),
        F.col("visit_date").alias("src_day"),
        drop_file_name(F.col("f.ts")).alias("source_file"),
        F.col("user_id").alias("_user_id"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle listings with a price-category label (FIXTURES.md §3).

    The label cut points are the 1/3 and 2/3 percentiles of the price: a
    one-row aggregate joined back by broadcast (its size is one row).
    """
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    v = li.join(part, li.l_partkey == part.p_partkey, "left").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("u/"), F.col("l_orderkey").cast("string")).alias("url"),
        F.col("p_brand").alias("region"),
        F.col("p_type").alias("region_url"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit(None).cast("double"))
        .when(F.col("p_partkey") % 50 == 0, F.lit(1900.0))
        .otherwise((1990 + F.col("p_size") % 30).cast("double")).alias("year"),
        F.split(F.col("p_name"), " ").getItem(0).alias("manufacturer"),
        F.col("p_name").alias("model"),
        F.when(F.col("l_suppkey") % 13 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("fuel"),
        (F.col("l_quantity") * 1000).alias("odometer"),
        F.col("l_returnflag").alias("title_status"),
        F.col("l_linestatus").alias("transmission"),
        F.lit("img").alias("image_url"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("state"),
        F.col("l_discount").alias("lat"),
        F.col("l_tax").alias("long"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("posting_date"),
    )
    from martlake.operators.clean import quantiles
    # of the scan alone: the join is on a unique key, so the prices are the same
    cuts = quantiles(li.select(F.col("l_extendedprice").alias("price")), ["price"], [1 / 3, 2 / 3], copy=False)
    return (v.crossJoin(F.broadcast(cuts))
            .withColumn("price_category",
                        F.when(F.col("price") <= F.col("price_q0"), F.lit("low"))
                        .when(F.col("price") <= F.col("price_q1"), F.lit("medium"))
                        .otherwise(F.lit("high")))
            .drop("price_q0", "price_q1"))
