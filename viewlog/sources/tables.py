"""Parquet scans of the given tables and the session views derived from them.

The session-log pipeline expects viewing events; the test tables hold generic
``events`` and ``orders``. ``sessions_ev`` and ``sessions_or`` map those rows
onto the ``logs_clean`` columns (both are whole-table projections: every
source row yields one session row). Both are plain projections, so Catalyst
prunes the scan to the few source columns they read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.schema import FACT_COLUMNS, FACT_SCHEMA, KEEP_FIELDS, LOGS_CLEAN_SCHEMA


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_logs_clean(spark: SparkSession, path: str) -> DataFrame:
    """Read written ``logs_clean`` Parquet with its fixed schema (no inference).

    A fixed schema keeps partition values such as ``"02"`` as strings; an empty
    AppName was written as the default partition and reads back NULL.
    """
    return spark.read.schema(LOGS_CLEAN_SCHEMA).parquet(path).select(
        *KEEP_FIELDS, "session_timestamp")


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Read a written fact table (maybe AppName-partitioned) with its fixed schema."""
    return spark.read.schema(FACT_SCHEMA).parquet(path).select(*FACT_COLUMNS)


def _mac(id_col: Column) -> Column:
    return F.lpad(id_col.cast("string"), 12, "0")


def sessions_ev(events: DataFrame) -> DataFrame:
    """Hour-level, deliberately dirty sessions over ``events``.

    Mixed case and stray spaces in AppName/Event, NULL Mac and watch time on a
    fixed share of rows, zero durations, completion above 1.
    """
    k = F.get_json_object("props", "$.k")
    etype = F.col("event_type")
    return events.select(
        F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string"))
         .otherwise(_mac(F.col("user_id"))).alias("Mac"),
        F.col("user_id").cast("string").alias("CustomerID"),
        F.concat(F.lit("C"), (F.col("user_id") % 10).cast("string")).alias("Contract"),
        F.date_trunc("SECOND", "ts").cast("timestamp_ntz").alias("session_timestamp"),
        F.when(etype == "view", " vod ").when(etype == "purchase", "VOD")
         .otherwise("iptv").alias("AppName"),
        F.when(etype == "view", "PlayVOD").when(etype == "purchase", "StopVOD ")
         .when(etype == "click", "StartChannel").when(etype == "error", "StopChannel")
         .otherwise("EnterIPTV").alias("Event"),
        k.alias("ItemId"),
        F.concat(F.lit("Item "), k).alias("ItemName"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("float"))
         .otherwise((F.col("value") * 10).cast("float")).alias("RealTimePlaying"),
        F.floor("value").cast("bigint").alias("ElapsedTimePlaying"),
        (k.cast("bigint") * 60).alias("Duration"),
        F.when(F.col("event_id") % 2 == 0, "PlayingFromSearch")
         .otherwise("PlayingFromHome").alias("Screen"),
        F.concat(F.lit("1."), (F.col("event_id") % 3).cast("string")).alias("Firmware"),
        F.when(F.col("user_id") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("VN")).alias("PublishCountry"),
    )


def sessions_ev_dup(events: DataFrame) -> DataFrame:
    """``sessions_ev`` plus a near copy of every row.

    The copy has the same dedup keys, one second more of watch time and the
    other entry screen, so the surviving values depend on the dedup tie-break.
    """
    base = sessions_ev(events)
    copy = base.withColumn(
        "RealTimePlaying", (F.col("RealTimePlaying") + F.lit(1.0).cast("float")).cast("float")
    ).withColumn(
        "Screen", F.when(F.col("Screen") == "PlayingFromHome", "PlayingFromSearch")
                   .otherwise("PlayingFromHome"))
    return base.unionByName(copy)


def sessions_or(orders: DataFrame) -> DataFrame:
    """Multi-year, clean sessions over ``orders`` (one per order, 80 months)."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    finished = F.col("o_orderstatus") == "F"
    item = (F.col("o_orderkey") % 200).cast("string")
    hour = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return orders.select(
        _mac(F.col("o_custkey")).alias("Mac"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.concat(F.lit("C"), (F.col("o_custkey") % 10).cast("string")).alias("Contract"),
        (F.col("o_orderdate") + hour).cast("timestamp_ntz").alias("session_timestamp"),
        F.when(urgent, "VOD").otherwise("IPTV").alias("AppName"),
        F.when(urgent, F.when(finished, "STOPVOD").otherwise("PLAYVOD"))
         .otherwise(F.when(finished, "STOPCHANNEL").otherwise("STARTCHANNEL")).alias("Event"),
        item.alias("ItemId"),
        F.concat(F.lit("Item "), item).alias("ItemName"),
        (F.col("o_totalprice") / 100).cast("float").alias("RealTimePlaying"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("ElapsedTimePlaying"),
        ((F.col("o_orderkey") % 50) * 120).cast("bigint").alias("Duration"),
        F.when(F.col("o_orderkey") % 2 == 0, "PlayingFromSearch")
         .otherwise("PlayingFromHome").alias("Screen"),
        F.concat(F.lit("1."), (F.col("o_orderkey") % 3).cast("string")).alias("Firmware"),
        F.lit("VN").alias("PublishCountry"),
    )


def load_sessions_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_ev(read_table(spark, sf_dir, "events"))


def load_sessions_ev_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_ev_dup(read_table(spark, sf_dir, "events"))


def load_sessions_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_or(read_table(spark, sf_dir, "orders"))


def raw_lines(events: DataFrame) -> DataFrame:
    """Render ``events`` as dict-literal log lines (column ``value``).

    Every event becomes one line; the event id only picks spelling variants
    (``MAC``, ``event``, ``itemId``, ``appname``), a None watch time, an
    unparseable elapsed time, or an impossible month. Every 50th id also
    emits one extra line that ingest must reject or keep with a NULL Mac:
    not a literal, a list, an empty line, only a ``mac`` key, ``'Mac': None``.
    """
    eid = F.col("event_id")
    mac = _mac(F.col("user_id"))
    k = F.get_json_object("props", "$.k")

    def key(cond: Column, variant: str, canonical: str) -> Column:
        return F.when(cond, F.lit(variant)).otherwise(F.lit(canonical))

    fmt = F.when(eid % 23 == 0, F.date_format("ts", "yyyy:'13':dd:HH:mm:ss")) \
           .otherwise(F.date_format("ts", "yyyy:MM:dd:HH:mm:ss"))
    app = F.when(F.col("event_type").isin("view", "purchase"), "VOD").otherwise("IPTV")
    watch = F.when(eid % 17 == 0, F.lit("None")).otherwise(F.col("value").cast("string"))
    elapsed = F.when(eid % 19 == 0, F.lit("'1e3'")) \
               .otherwise(F.concat(F.lit("'"), F.col("value").cast("string"), F.lit("'")))

    def pair(name: Column, val: Column, quoted: bool = True) -> Column:
        v = F.concat(F.lit("'"), val, F.lit("'")) if quoted else val
        return F.concat(F.lit("'"), name, F.lit("': "), v)

    line = F.concat(
        F.lit("{"),
        F.concat_ws(", ",
                    pair(key(eid % 7 == 3, "MAC", "Mac"), mac),
                    pair(F.lit("CustomerID"), F.col("user_id").cast("string")),
                    pair(F.lit("SessionMainMenu"), F.concat(mac, F.lit(":"), fmt, F.lit(":000"))),
                    pair(key(eid % 5 == 1, "appname", "AppName"), app),
                    pair(key(eid % 11 == 5, "event", "Event"), F.col("event_type")),
                    pair(key(eid % 11 == 5, "itemId", "ItemId"), k),
                    pair(F.lit("RealTimePlaying"), watch, quoted=False),
                    pair(F.lit("ElapsedTimePlaying"), elapsed, quoted=False),
                    pair(F.lit("Duration"), (k.cast("bigint") * 60).cast("string"))),
        F.lit("}"))
    kind = F.floor(eid / 50) % 8
    extra = (F.when(kind == 0, F.lit("not a literal"))
              .when(kind == 1, F.lit("[1, 2]"))
              .when(kind == 2, F.lit(""))
              .when(kind == 3, F.concat(F.lit("{'mac': '"), mac, F.lit("', 'Event': 'STOPVOD'}")))
              .when(kind == 4, F.lit("{'Mac': None, 'Event': 'STOPVOD'}"))
              # Values without a text form, and a character no literal may hold.
              .when(kind == 5, F.concat(F.lit("{'Mac': 'm', 'Duration': "), F.repeat(F.lit("9"), 5000), F.lit("}")))
              .when(kind == 6, F.concat(F.lit("{'Mac': 'm', 'Duration': 0x"), F.repeat(F.lit("f"), 6000), F.lit("}")))
              .otherwise(F.lit("{'Mac': 'm\0', 'Event': 'STOPVOD'}")))
    lines = F.when(eid % 50 == 0, F.array(line, extra)).otherwise(F.array(line))
    return events.select(F.explode(lines).alias("value"))


def load_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered lines, dealt over the session's shuffle partitions.

    Real logs are read as many text splits, the Parquet file of a test table
    as one; the round robin stands for the splits.
    """
    lines = raw_lines(read_table(spark, sf_dir, "events"))
    return lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
