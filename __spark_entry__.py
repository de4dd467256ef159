"""Queries over the driver's tables and the same results in SQL.

Trips come from `events` through `tripflow.sources.events`. Time stamps are returned without
zone, calendar parts and counts as 64-bit integers, z-scores and deviations rounded to 6 places.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, TimestampType

from tripflow.functions.identity import content_id, source_row_id, with_file_ids
from tripflow.operators.anomaly import detect, hour_stats, score
from tripflow.operators.clean import clean
from tripflow.operators.hourly import HOUR_KEYS, hour_stats_from, hourly
from tripflow.operators.hourly_state import merged_states
from tripflow.operators.quantile import exact_quantile
from tripflow.operators.rules import RULES, detect_rules
from tripflow.plans import jobs
from tripflow.schemas import HOURLY, TABLES
from tripflow.session import configure, scratch
from tripflow.sources.events import raw_trips, topic_records
from tripflow.sources.mixed import read_mixed
from tripflow.sources.raw import read_raw, stream_raw
from tripflow.sources.topics import file_topics, parse_values, stamped_file_topics
from tripflow.streaming.detect import detect_stream, freeze_stats
from tripflow.streaming.intake import ingest_new_files
from tripflow.streaming.live import detect_live
from tripflow.streaming.sink import BUCKETS, INGESTION_TIME, time_partitioned_sink
from tripflow.streaming.topic_sink import Topic, topic_sink
from tripflow.tables.audit import layout
from tripflow.tables.binpack import FILL, SIZE_RANGE, file_groups
from tripflow.tables.catalog import create_tables, describe, list_tables, location, read_table
from tripflow.tables.compact import compact, list_files
from tripflow.tables.expiry import expire, register
from tripflow.tables.files import Files
from tripflow.tables.purge import purge
from tripflow.tables.write import append, overwrite_partitions, replace

# Operators on texts and the pipeline over them can be left out of the repository, and need
# libraries that the others do without; whatever is missing, the other queries are there.
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_SQL: dict[str, str] = {}
try:
    from tripflow.llm.queries import QUERIES as LLM_QUERIES
    from tripflow.llm.queries import SQL as LLM_SQL
except ImportError as missing:
    warnings.warn(f"queries on texts left out: {missing}", stacklevel=1)
try:
    import corpus_pipeline

    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
except ImportError as missing:
    warnings.warn(f"the pipeline left out: {missing}", stacklevel=1)

SMOKE_DIR = "/root/testdata/sf0.001"
PURGE_BEFORE = date(2024, 1, 15)
HOUR_COLUMNS = [
    "total_trips",
    "total_passengers",
    "avg_trip_distance",
    "avg_fare_amount",
    "avg_tip_amount",
    "total_revenue",
    "p95_fare",
]
DAY_KEYS = ["pickup_year", "pickup_month", "pickup_day"]


# Inputs


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream of files; the pattern also fits a folder of that name."""
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_trips(events(spark, sf_dir)), F.col("event_id"))


def log_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares above 0 are bounded below within 3 deviations; their logarithms are not."""
    return trips(spark, sf_dir).withColumn("fare_amount", F.ln("fare_amount"))


def fresh_tables(spark: SparkSession) -> str:
    """A new namespace with empty tables in the shared folder."""
    namespace = f"tripflow_{uuid.uuid4().hex[:12]}"
    create_tables(configure(spark), namespace, scratch(spark, "tables"))
    return namespace


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw trips as several Parquet files, as they would arrive."""
    folder = scratch(spark, "raw")
    raw_trips(events(spark, sf_dir)).drop("event_id").repartition(4).write.parquet(folder)
    return folder


# Output forms


def plain(df: DataFrame) -> DataFrame:
    kinds = {IntegerType: "BIGINT", FloatType: "DOUBLE", TimestampType: "TIMESTAMP_NTZ"}
    columns = []
    for field in df.schema.fields:
        kind = kinds.get(type(field.dataType))
        columns.append(f"CAST({field.name} AS {kind}) AS {field.name}" if kind else field.name)
    return df.selectExpr(*columns)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def per_day(df: DataFrame) -> DataFrame:
    return plain(df.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias("trips")))


def anomaly_rows(df: DataFrame) -> DataFrame:
    rows = df.drop("event_id", "detected_at")
    return plain(rounded(rows, "fare_amount", "reference_avg", "z_score"))


def stat_rows(df: DataFrame) -> DataFrame:
    return plain(rounded(df, "mean_fare", "std_fare"))


# Queries: sources, cleaning, aggregates


def raw_scan_count(spark, sf_dir):
    return jobs.row_counts({"raw": read_raw(spark, raw_files(spark, sf_dir))})


def mixed_schemas(spark, sf_dir):
    """Trips of three months' files, whose columns differ in type, order, case and number."""
    folder = scratch(spark, "mixed")
    raw = raw_trips(events(spark, sf_dir))
    usual = raw.where("event_id % 3 = 0")
    wide = raw.where("event_id % 3 = 1").select(
        F.col("passenger_count").cast("double"), F.col("VendorID").cast("bigint"), "*"
    ).toDF("passengers", "vendor", *raw.columns)
    wide = wide.drop("passenger_count", "VendorID").withColumnsRenamed(
        {"passengers": "passenger_count", "vendor": "vendorid"}
    )
    text = raw.where("event_id % 3 = 2").withColumns(
        {"RatecodeID": F.col("RatecodeID").cast("string"), "fare_amount": F.col("fare_amount").cast("string")}
    ).drop("tolls_amount")
    for part in (usual, wide, text):
        part.withColumn("airport_fee", F.lit(0.0)).drop("event_id").write.mode("append").parquet(folder)
    found = clean(read_mixed(spark, folder), F.lit(0).cast("bigint"))
    return plain(
        found.groupBy("pickup_day", "vendor_id", "rate_code").agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("passenger_count").alias("passengers"),
            F.round(F.sum("fare_amount"), 4).alias("fares"),
            F.count("tolls_amount").alias("tolls"),
        )
    )


def layout_audit(spark, sf_dir):
    """Files, rows, codec and sizes of each partition of a freshly written table."""
    table = f"{fresh_tables(spark)}.taxi_trips"
    append(trips(spark, sf_dir), table)
    found = layout(spark, table)
    columns = ("partition", "files", "rows", "row_groups", "codecs", "well_sized", "share_well_sized")
    return found.select(*columns, (F.col("bytes") > 0).alias("has_bytes"))


def trips_clean(spark, sf_dir):
    return plain(trips(spark, sf_dir))


def surrogate_ids(spark, sf_dir):
    """Trips and different ids, for each way to number them."""
    raw = raw_trips(events(spark, sf_dir))
    ways = {"task": None, "source": source_row_id(), "content": content_id("event_id")}
    counts = [
        clean(raw, way).agg(
            F.lit(name).alias("way"),
            F.count(F.lit(1)).alias("trips"),
            F.countDistinct("trip_id").alias("ids"),
        )
        for name, way in ways.items()
    ]
    # The same files numbered twice, as two appends would.
    files = read_raw(spark, raw_files(spark, sf_dir))
    first, second = (
        clean(with_file_ids(files, "trip_id", n), F.col("trip_id")) for n in (0, 1000)
    )
    counts.append(
        first.unionByName(second).agg(
            F.lit("file").alias("way"),
            F.count(F.lit(1)).alias("trips"),
            F.countDistinct("trip_id").alias("ids"),
        )
    )
    return reduce(DataFrame.unionByName, counts)


def trips_by_partition(spark, sf_dir):
    return per_day(trips(spark, sf_dir))


def hourly_agg(spark, sf_dir):
    return plain(hourly(trips(spark, sf_dir)).drop("computed_at"))


def hourly_p95_exact(spark, sf_dir):
    exact = hourly(trips(spark, sf_dir), p95="exact")
    return plain(exact.select(*HOUR_KEYS, "total_trips", "p95_fare"))


def large_group_quantile(spark, sf_dir):
    lines = configure(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = lines.withColumn("price", F.col("l_extendedprice").cast("double"))
    return exact_quantile(lines, ["l_returnflag"], "price", "0.95", "p95_price")


def hour_stats_query(spark, sf_dir):
    return stat_rows(hour_stats(trips(spark, sf_dir)))


def hour_stats_from_hourly(spark, sf_dir):
    return stat_rows(hour_stats_from(hourly(trips(spark, sf_dir), moments=True)))


# Queries: anomalies


def trips_with_stats(spark, sf_dir):
    scored = score(trips(spark, sf_dir))
    kept = scored.select("trip_id", "pickup_hour", "fare_amount", "mean_fare", "std_fare", "z_score")
    return plain(rounded(kept, "mean_fare", "std_fare", "z_score"))


def zero_deviation(spark, sf_dir):
    """Fares equal to their hour: every deviation is 0 and no z-score is defined."""
    flat = trips(spark, sf_dir).withColumn("fare_amount", F.col("pickup_hour").cast("double"))
    counts = score(flat).groupBy("pickup_hour")
    return plain(
        counts.agg(F.count(F.lit(1)).alias("trips"), F.count("z_score").alias("scored"))
    )


def nan_fares(spark, sf_dir, nan="keep"):
    """Fares above 200 taken as not a number; kept, they reach every trip of their hour."""
    fare = F.when(F.col("value") > 200, F.lit(float("nan"))).otherwise(F.col("value"))
    raw = raw_trips(events(spark, sf_dir).withColumn("value", fare))
    found = detect(clean(raw, F.col("event_id"), nan))
    hours = found.groupBy(F.hour("pickup_datetime").alias("pickup_hour"), "severity")
    return plain(hours.agg(F.count(F.lit(1)).alias("events")))


def nan_fares_dropped(spark, sf_dir):
    return nan_fares(spark, sf_dir, nan="drop")


def anomalies_surge(spark, sf_dir):
    return anomaly_rows(detect(trips(spark, sf_dir)))


def anomalies_low(spark, sf_dir):
    return anomaly_rows(detect(log_fares(spark, sf_dir)))


def anomaly_severity_counts(spark, sf_dir):
    found = detect(trips(spark, sf_dir)).unionByName(detect(log_fares(spark, sf_dir)))
    return found.groupBy("anomaly_type", "severity").agg(F.count(F.lit(1)).alias("events"))


def event_stamps(spark, sf_dir):
    found = detect(trips(spark, sf_dir))
    return found.agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("event_id").alias("ids"),
        F.count("detected_at").alias("stamps"),
    )


def event_hash_ids(spark, sf_dir):
    found = detect(trips(spark, sf_dir), event_id="hash")
    return found.select("event_id", "anomaly_type")


def rule_low_tip(spark, sf_dir):
    tips = trips(spark, sf_dir).withColumn("tip_amount", F.ln("tip_amount"))
    return anomaly_rows(detect_rules(tips, ["low_tip"]))


def rule_outlier_distance(spark, sf_dir):
    far = trips(spark, sf_dir).withColumn("trip_distance", F.pow("trip_distance", F.lit(6)))
    found = detect_rules(far, ["outlier_distance"]).withColumn(
        "reference_avg", F.round(F.col("reference_avg") / 1e9, 3)
    )
    return anomaly_rows(found)


def rule_long_idle(spark, sf_dir):
    return anomaly_rows(detect_rules(trips(spark, sf_dir), ["long_idle"]))


def rules_in_job(spark, sf_dir):
    """Events by type after the job has run twice with all rules, the second run in place of the first."""
    namespace = fresh_tables(spark)
    jobs.ingest(spark, raw_trips(events(spark, sf_dir)), namespace, F.col("event_id"))
    for mode in ("append", "overwrite_partitions"):
        jobs.aggregate(spark, namespace, mode=mode, rules=list(RULES))
    found = spark.table(f"{namespace}.anomaly_events").groupBy("anomaly_type")
    return found.agg(F.count(F.lit(1)).alias("events"))


# Queries: tables


def table_listing(spark, sf_dir):
    """The tables after a full run, with their columns and rows."""
    namespace = fresh_tables(spark)
    jobs.ingest(spark, raw_trips(events(spark, sf_dir)), namespace, F.col("event_id"))
    jobs.aggregate(spark, namespace)
    sizes = {}
    columns = {}
    for row in list_tables(spark, namespace).filter(~F.col("isTemporary")).collect():
        name = row["tableName"]
        sizes[name] = spark.table(f"{namespace}.{name}")
        columns[name] = describe(spark, f"{namespace}.{name}")
    columns = {n: d.filter(~F.col("col_name").startswith("#")).distinct() for n, d in columns.items()}
    counted = jobs.row_counts(sizes).withColumnRenamed("stage", "table_name")
    described = jobs.row_counts(columns).select(
        F.col("stage").alias("table_name"), F.col("rows").alias("columns")
    )
    return counted.join(described, "table_name")


def append_roundtrip(spark, sf_dir):
    """Appended in another column order, read back by SQL."""
    namespace = fresh_tables(spark)
    rows = trips(spark, sf_dir)
    append(rows.select(*sorted(rows.columns)), f"{namespace}.taxi_trips")
    return plain(spark.sql(f"SELECT * FROM {namespace}.taxi_trips"))


def overwrite_roundtrip(spark, sf_dir):
    """Two deliveries that share a day; the second, written twice, leaves the first's rows there."""
    table = f"{fresh_tables(spark)}.taxi_trips"
    rows = trips(spark, sf_dir)
    early = (F.col("pickup_day") < 15) | ((F.col("pickup_day") == 15) & (F.col("trip_id") % 2 == 0))
    for delivery in (rows.where(early), rows.where(~early), rows.where(~early)):
        overwrite_partitions(delivery, table, "trip_id")
    return per_day(spark.table(table))


def replace_roundtrip(spark, sf_dir):
    """The hourly table replaced twice, the second time by rows read from the table itself."""
    table = f"{fresh_tables(spark)}.taxi_hourly_agg"
    replace(hourly(trips(spark, sf_dir)), table)
    replace(spark.table(table), table)
    return plain(spark.table(table).drop("computed_at"))


def sql_access(spark, sf_dir):
    """Daily totals asked of the hourly table in SQL."""
    namespace = fresh_tables(spark)
    replace(hourly(trips(spark, sf_dir)), f"{namespace}.taxi_hourly_agg")
    return plain(
        spark.sql(f"""
            SELECT pickup_year, pickup_month, pickup_day, count(*) AS hours,
                   sum(total_trips) AS trips, sum(total_passengers) AS passengers,
                   max(p95_fare) AS highest_p95
            FROM {namespace}.taxi_hourly_agg
            GROUP BY ALL
        """)
    )


def compact_roundtrip(spark, sf_dir):
    """Trips written as many small files, then compacted."""
    table = f"{fresh_tables(spark)}.taxi_trips"
    rows = trips(spark, sf_dir).repartition(6)
    spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=rows)
    compact(spark, table)
    return plain(spark.table(table))


#: Orders stand for files: a folder per month, sizes by price, and one in fifty far too large.
FILE_TARGET = 40_000_000


def compaction_groups(spark, sf_dir):
    """Which files go together, and into how many pieces the large ones are cut."""
    orders = configure(spark).read.parquet(f"{sf_dir}/orders.parquet")
    files = orders.selectExpr(
        "date_format(o_orderdate, 'yyyy-MM') AS partition",
        "concat('part-', lpad(o_orderkey, 12, '0')) AS file",
        "CAST(o_totalprice * 100 AS BIGINT) * IF(o_orderkey % 50 = 0, 5, 1) AS length",
    )
    return file_groups(files, FILE_TARGET, 3).select("partition", "file", "length", "bin", "pieces")


def compact_split(spark, sf_dir):
    """A lone file per day, each far too large for the target, is split; others are not read."""
    table = f"{fresh_tables(spark)}.taxi_trips"
    append(trips(spark, sf_dir).where("pickup_day < 6"), table)
    total = list_files(spark, location(spark, table)).agg(F.sum("length"), F.count("*")).first()
    report = compact(spark, table, target_file_size_bytes=total[0] // total[1] // 3)
    rows = spark.table(table).groupBy("pickup_day").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_id").alias("ids")
    )
    split = report.agg(F.min(F.col("added_files") > F.col("rewritten_files")).alias("all_split"))
    return plain(rows.join(split))


def purge_roundtrip(spark, sf_dir):
    table = f"{fresh_tables(spark)}.taxi_trips"
    append(trips(spark, sf_dir), table)
    purge(spark, table, PURGE_BEFORE)
    return per_day(spark.table(table))


def expiry_register(spark, sf_dir):
    """What stays after an expiry eight days on: versions of the hourly table, one for each day.

    Replaced once for each of the first days, the table keeps the last version of all; the older
    ones, and intermediate results, are too old by then.
    """
    namespace = fresh_tables(spark)
    table = f"{namespace}.taxi_hourly_agg"
    for day in (5, 10, 31):
        replace(hourly(trips(spark, sf_dir).where(F.col("pickup_day") <= day)), table)
    left = scratch(spark, "left-behind")
    trips(spark, sf_dir).write.parquet(f"{left}/one")
    names = [f"{namespace}.{t.name}" for t in TABLES]
    later = datetime.now(timezone.utc) + timedelta(days=8)
    soon = expire(spark, names, left)
    told = expire(spark, names, left, at=later)
    kinds = told.groupBy("kind").agg(
        F.count(F.lit(1)).alias("folders"), F.count_if("removed").alias("removed")
    )
    early = soon.groupBy("kind").agg(F.count_if("removed").alias("removed_at_once"))
    still = spark.table(table).agg(F.sum("total_trips").alias("trips"))
    again = register(spark, names, left).agg(F.count(F.lit(1)).alias("stay"))
    return kinds.join(early, "kind").join(still).join(again)


def metrics_report(spark, sf_dir):
    """All jobs in order; rows per stage."""
    namespace = fresh_tables(spark)
    raw = raw_trips(events(spark, sf_dir))
    ingested = jobs.ingest(spark, raw, namespace, F.col("event_id"))
    counted = jobs.aggregate(spark, namespace)
    jobs.maintain(spark, namespace)
    return ingested.filter("stage = 'raw'").unionByName(counted)


# Queries: streams


def _sunk(spark, records):
    path, log = scratch(spark, "topics"), scratch(spark, "topics-log")
    time_partitioned_sink(records, path, log, every=None).awaitTermination()
    return spark.read.parquet(path), path


def _bucket_counts(rows):
    counts = rows.groupBy("topic", "year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("records"), F.sum("key").alias("keys")
    )
    return plain(counts)


def stream_time_buckets(spark, sf_dir):
    rows, _ = _sunk(spark, topic_records(events_stream(spark, sf_dir)))
    return _bucket_counts(rows)


def stream_paths(spark, sf_dir):
    """The folders of the sink, as text."""
    rows, path = _sunk(spark, topic_records(events_stream(spark, sf_dir)))
    # Read file by file, for the folders are wanted as they are spelled.
    folder = F.regexp_extract("_metadata.file_path", "(topic=.*)/[^/]+$", 1)
    return rows.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("records"))


def stream_json_topics(spark, sf_dir):
    """The topics as JSON lines, parsed strictly and sunk."""
    folder = scratch(spark, "json")
    records = topic_records(events(spark, sf_dir))
    values = F.to_json(F.struct("timestamp", "key", "value", "props"))
    records.select("topic", values.alias("value")).write.partitionBy("topic").text(folder)
    schema = "timestamp timestamp, key bigint, value double, props string"
    rows, _ = _sunk(spark, parse_values(file_topics(spark, folder), schema))
    return _bucket_counts(rows)


def ingestion_time_present(spark, sf_dir):
    rows, _ = _sunk(spark, topic_records(events_stream(spark, sf_dir)))
    return rows.agg(F.count(INGESTION_TIME).alias("stamped"))


def stream_incremental(spark, sf_dir):
    """Two deliveries, the second of files dated ten days earlier; a third run finds nothing new."""
    namespace, folder, log = fresh_tables(spark), scratch(spark, "raw"), scratch(spark, "intake-log")
    raw = raw_trips(events(spark, sf_dir))
    seen = set()
    for delivery in (raw.where("event_id % 3 = 0"), raw.where("event_id % 3 != 0"), None):
        if delivery is not None:
            delivery.drop("event_id").repartition(2).write.mode("append").parquet(folder)
            files = Files(spark, folder)
            new = set(files.walk(folder)) - seen
            if seen:
                for path in new:
                    files.date_back(path, 10)
            seen |= new
        ingest_new_files(spark, folder, log, namespace).awaitTermination()
    return per_day(spark.table(f"{namespace}.taxi_trips"))


def stream_anomalies(spark, sf_dir):
    namespace = fresh_tables(spark)
    stats = freeze_stats(trips(spark, sf_dir))
    stream = clean(raw_trips(events_stream(spark, sf_dir)), F.col("event_id"))
    log = scratch(spark, "detect-log")
    detect_stream(stream, stats, log, namespace).awaitTermination()
    return anomaly_rows(spark.table(f"{namespace}.anomaly_events"))


def _deliveries(spark, sf_dir):
    """The raw trips in three parts, with the number of each."""
    raw = raw_trips(events(spark, sf_dir))
    return [(n, raw.where(F.col("event_id") % 3 == n)) for n in range(3)]


def stream_live_anomalies(spark, sf_dir):
    """Three deliveries, each scored against those before it."""
    namespace, folder, log = fresh_tables(spark), scratch(spark, "live"), scratch(spark, "live-log")
    for _, delivery in _deliveries(spark, sf_dir):
        delivery.write.mode("append").parquet(folder)
        stream = clean(stream_raw(spark, folder, delivery.schema), F.col("event_id"))
        detect_live(stream, log, namespace).awaitTermination()
    return anomaly_rows(spark.table(f"{namespace}.anomaly_events"))


def hourly_by_delivery(spark, sf_dir):
    """The hourly table after three deliveries, the last of them made twice.

    Sums come from the states behind it: an average on an exact half depends on the order of
    summation, so the table's are only held against these, to half a cent.
    """
    namespace = fresh_tables(spark)
    parts = _deliveries(spark, sf_dir)
    for number, delivery in [*parts, parts[-1]]:
        jobs.deliver(spark, delivery, number + 1, namespace, F.col("event_id"))
    states = merged_states(jobs.hour_states(spark, namespace).read())
    sums = ("distance_sum", "fare_sum", "tip_sum", "revenue")
    held = read_table(spark, HOURLY, namespace).join(states.select(*HOUR_KEYS, *sums), list(HOUR_KEYS))
    trips = F.col("total_trips")
    pairs = (
        ("avg_trip_distance", F.col("distance_sum") / trips),
        ("avg_fare_amount", F.col("fare_sum") / trips),
        ("avg_tip_amount", F.col("tip_sum") / trips),
        ("total_revenue", F.col("revenue")),
    )
    close = reduce(lambda a, b: a & b, [F.abs(F.col(n) - exact) < 0.005001 for n, exact in pairs])
    columns = [*HOUR_KEYS, "total_trips", "total_passengers", "p95_fare", *sums]
    return plain(rounded(held.select(*columns, close.alias("rounded")), *sums))


# The topics with columns of their own. Event times run 24 times as fast, 30 days in 30 hours, so
# that five minutes hold several records.
TOPIC_COLUMNS = {
    "sensor_data": "timestamp timestamp, sensor bigint, reading double",
    "market_data": "timestamp timestamp, symbol string, price double, volume int",
    "weather_data": "timestamp timestamp, station struct<id: bigint>, wind double",
}


def _own_topics(spark, sf_dir, spoilt=False):
    """The records as JSON lines, a folder per topic; `spoilt`: some that cannot be written."""
    fast = "timestamp_millis(1704067200000 + (unix_millis(timestamp) - 1704067200000) div 24)"
    stamp = f"date_format({fast}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
    bodies = {
        "sensor_data": "named_struct('timestamp', t, 'sensor', key, 'reading', value)",
        "market_data": "named_struct('timestamp', t, 'symbol', concat('S', key % 50), 'price', value,"
        " 'volume', CAST(get_json_object(props, '$.k') AS INT))",
        "weather_data": "named_struct('timestamp', t, 'station', named_struct('id', key),"
        " 'wind', value)",
    }
    records = topic_records(events(spark, sf_dir)).withColumn("t", F.expr(stamp))
    value = "CASE topic " + " ".join(f"WHEN '{t}' THEN to_json({b})" for t, b in bodies.items()) + " END"
    if spoilt:
        value = (
            f"CASE WHEN key % 97 = 0 THEN 'no JSON' WHEN key % 89 = 0 AND topic = 'sensor_data' "
            f"THEN to_json(named_struct('timestamp', t, 'sensor', 'x')) "
            f"WHEN key % 83 = 0 THEN '{{}}' ELSE {value} END"
        )
    folder = scratch(spark, "own-topics")
    lines = records.select("topic", F.expr(value).alias("value"))
    lines.write.partitionBy("topic").text(folder)
    return folder


def _sink_topics(spark, folder, path, log, **options):
    topics = [Topic(name, columns) for name, columns in TOPIC_COLUMNS.items()]
    records = stamped_file_topics(spark, folder)
    topic_sink(records, topics, path, log, every=None, **options).awaitTermination()


def stream_event_roll(spark, sf_dir):
    """The files of the sink: first and last event time and records of each."""
    path, log = scratch(spark, "rolled"), scratch(spark, "rolled-log")
    _sink_topics(spark, _own_topics(spark, sf_dir), path, log)
    files = spark.read.schema("timestamp timestamp, topic string").parquet(path)
    ms = F.unix_millis("timestamp")
    spans = files.groupBy("topic", F.col("_metadata.file_path").alias("file")).agg(
        F.min(ms).alias("first"), F.max(ms).alias("last"), F.count(F.lit(1)).alias("records")
    )
    return spans.drop("file")


def stream_topic_schemas(spark, sf_dir):
    """Three topics of different columns in one run: each folder's columns, records and sums."""
    path, log = scratch(spark, "own"), scratch(spark, "own-log")
    _sink_topics(spark, _own_topics(spark, sf_dir), path, log, roll_seconds=3600)
    sums = {
        "sensor_data": ("sensor", "reading"),
        "market_data": ("volume", "price"),
        "weather_data": ("station.id", "wind"),
    }
    found = []
    for topic, (whole, real) in sums.items():
        rows = spark.read.parquet(f"{path}/topic={topic}")
        found.append(
            rows.agg(
                F.lit(topic).alias("topic"),
                F.lit(",".join(c for c in rows.columns if c not in BUCKETS)).alias("columns"),
                F.count(F.lit(1)).alias("records"),
                F.sum(F.col(whole).cast("bigint")).alias("whole"),
                F.round(F.sum(real), 3).alias("real"),
                F.count(INGESTION_TIME).alias("stamped"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def stream_bad_records(spark, sf_dir):
    """What the error folder holds after the sink has failed, and that nothing was written."""
    path, log = scratch(spark, "bad"), scratch(spark, "bad-log")
    folder = _own_topics(spark, sf_dir, spoilt=True)
    failed = False
    try:
        _sink_topics(spark, folder, path, log)
    except StreamingQueryException as stopped:
        failed = "all bad records are in" in str(stopped)
    written = any(f.endswith(".parquet") for f in Files(spark, path).walk(path))
    bad = spark.read.parquet(f"{log}/errors").groupBy("topic", "message").agg(
        F.count(F.lit(1)).alias("records"), F.count("position").alias("placed")
    )
    return bad.withColumns({"failed": F.lit(failed), "written": F.lit(written)})


def stream_killed_and_rerun(spark, sf_dir):
    """A sink that stops between writing and committing, then runs again.

    Its records and their times of arrival are those of a run that did not stop.
    """
    folder = _own_topics(spark, sf_dir)
    found = {}
    for name in ("whole", "killed"):
        path, log = scratch(spark, name), scratch(spark, f"{name}-log")
        if name == "killed":
            try:
                _sink_topics(
                    spark, folder, path, log, roll_seconds=3600, before_commit=_stop
                )
            except StreamingQueryException:
                pass
        _sink_topics(spark, folder, path, log, roll_seconds=3600)
        found[name] = spark.read.schema(
            f"timestamp timestamp, {INGESTION_TIME} timestamp, topic string"
        ).parquet(path)
    both = [F.col("topic"), F.col("timestamp"), F.col(INGESTION_TIME)]
    counts = [
        rows.groupBy(*both).agg(F.count(F.lit(1)).alias(name)) for name, rows in found.items()
    ]
    met = counts[0].join(counts[1], ["topic", "timestamp", INGESTION_TIME], "full")
    return met.groupBy("topic").agg(
        F.sum("whole").alias("records"),
        F.count_if(~F.col("whole").eqNullSafe(F.col("killed"))).alias("different"),
    )


def _stop(number: int) -> None:
    raise RuntimeError("killed")


def entry(spark: SparkSession) -> DataFrame:
    """Hourly aggregates of the cleaned trips."""
    return hourly(trips(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "raw_scan_count": raw_scan_count,
        "mixed_schemas": mixed_schemas,
        "layout_audit": layout_audit,
        "expiry_register": expiry_register,
        "trips_clean": trips_clean,
        "surrogate_ids": surrogate_ids,
        "trips_by_partition": trips_by_partition,
        "hourly_agg": hourly_agg,
        "hourly_p95_exact": hourly_p95_exact,
        "large_group_quantile": large_group_quantile,
        "hour_stats": hour_stats_query,
        "hour_stats_from_hourly": hour_stats_from_hourly,
        "trips_with_stats": trips_with_stats,
        "zero_deviation": zero_deviation,
        "nan_fares": nan_fares,
        "nan_fares_dropped": nan_fares_dropped,
        "anomalies_surge": anomalies_surge,
        "anomalies_low": anomalies_low,
        "anomaly_severity_counts": anomaly_severity_counts,
        "event_stamps": event_stamps,
        "event_hash_ids": event_hash_ids,
        "rule_low_tip": rule_low_tip,
        "rule_outlier_distance": rule_outlier_distance,
        "rule_long_idle": rule_long_idle,
        "rules_in_job": rules_in_job,
        "table_listing": table_listing,
        "append_roundtrip": append_roundtrip,
        "overwrite_roundtrip": overwrite_roundtrip,
        "replace_roundtrip": replace_roundtrip,
        "sql_access": sql_access,
        "compact_roundtrip": compact_roundtrip,
        "compaction_groups": compaction_groups,
        "compact_split": compact_split,
        "purge_roundtrip": purge_roundtrip,
        "metrics_report": metrics_report,
        "stream_time_buckets": stream_time_buckets,
        "stream_paths": stream_paths,
        "stream_json_topics": stream_json_topics,
        "ingestion_time_present": ingestion_time_present,
        "stream_incremental": stream_incremental,
        "stream_anomalies": stream_anomalies,
        "stream_live_anomalies": stream_live_anomalies,
        "hourly_by_delivery": hourly_by_delivery,
        "stream_event_roll": stream_event_roll,
        "stream_topic_schemas": stream_topic_schemas,
        "stream_bad_records": stream_bad_records,
        "stream_killed_and_rerun": stream_killed_and_rerun,
        **LLM_QUERIES,
    }


# SQL

RAW = """
raw AS (
  SELECT event_id,
         CAST(1 + user_id % 2 AS BIGINT) AS vendor_id,
         ts AS pickup_datetime,
         ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS dropoff_datetime,
         CAST(user_id % 10 AS BIGINT) AS passenger_count,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS trip_distance,
         CAST(1 + user_id % 6 AS BIGINT) AS rate_code,
         CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2
                              WHEN 'view' THEN 3 WHEN 'error' THEN 4 END AS BIGINT) AS payment_type,
         value AS fare_amount,
         CAST(0 AS DOUBLE) AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax,
         value * CAST(0.125 AS DOUBLE) AS tip_amount,
         CAST(0 AS DOUBLE) AS tolls_amount,
         value + CAST(0 AS DOUBLE) + CAST(0.5 AS DOUBLE) + value * CAST(0.125 AS DOUBLE)
           + CAST(0 AS DOUBLE) AS total_amount
  FROM events
)"""

TRIPS = f"""{RAW},
trips AS (
  SELECT event_id AS trip_id, vendor_id, pickup_datetime, dropoff_datetime, passenger_count,
         trip_distance,
         CAST(NULL AS DOUBLE) AS pickup_longitude, CAST(NULL AS DOUBLE) AS pickup_latitude,
         CAST(NULL AS DOUBLE) AS dropoff_longitude, CAST(NULL AS DOUBLE) AS dropoff_latitude,
         rate_code, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
         total_amount,
         CAST(year(pickup_datetime) AS BIGINT) AS pickup_year,
         CAST(month(pickup_datetime) AS BIGINT) AS pickup_month,
         CAST(day(pickup_datetime) AS BIGINT) AS pickup_day,
         CAST(hour(pickup_datetime) AS BIGINT) AS pickup_hour
  FROM raw
  WHERE fare_amount > 0 AND trip_distance > 0 AND passenger_count BETWEEN 1 AND 8
    AND pickup_datetime IS NOT NULL
)"""


def _half_up(value: str, places: int) -> str:
    """Rounding of the printed decimal, half up, instead of the scaled binary value."""
    return (
        f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 15)), {places}) AS DOUBLE)"
    )


HOURS = f"""{TRIPS},
hours AS (
  SELECT pickup_year, pickup_month, pickup_day, pickup_hour,
         count(*) AS total_trips,
         CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
         {_half_up("avg(trip_distance)", 3)} AS avg_trip_distance,
         {_half_up("avg(fare_amount)", 2)} AS avg_fare_amount,
         {_half_up("avg(tip_amount)", 2)} AS avg_tip_amount,
         {_half_up("sum(total_amount)", 2)} AS total_revenue,
         round(quantile_disc(fare_amount, 0.95), 2) AS p95_fare
  FROM trips
  GROUP BY pickup_year, pickup_month, pickup_day, pickup_hour
)"""


def _scored(measure: str, base: str = "trips", name: str = "scored") -> str:
    """Trips with mean, deviation and z-score of `measure` per hour of day."""
    return f"""
{name}_input AS (SELECT *, {measure} AS measure FROM {base}),
{name}_stats AS (
  SELECT pickup_hour, avg(measure) AS mean, stddev_samp(measure) AS deviation
  FROM {name}_input GROUP BY pickup_hour
),
{name} AS (
  SELECT t.*, s.mean, s.deviation, (t.measure - s.mean) / nullif(s.deviation, 0) AS z
  FROM {name}_input t LEFT JOIN {name}_stats s ON t.pickup_hour = s.pickup_hour
)"""


SEVERITY = "CASE WHEN abs(z) > 6 THEN 'HIGH' WHEN abs(z) > 4 THEN 'MEDIUM' ELSE 'LOW' END"
FARE_TYPE = "CASE WHEN z > 3 THEN 'surge_fare' WHEN z < -3 THEN 'low_fare' END"


def _events(
    test: str, kind: str, fare: str = "measure", mean: str = "mean", source: str = "scored"
) -> str:
    return f"""
SELECT {kind} AS anomaly_type, {SEVERITY} AS severity, pickup_datetime,
       round({fare}, 6) AS fare_amount, round({mean}, 6) AS reference_avg, round(z, 6) AS z_score,
       pickup_year AS event_year, pickup_month AS event_month
FROM {source} WHERE {test}"""


TOPICS = """
topics AS (
  SELECT CASE WHEN event_type IN ('click', 'view') THEN 'sensor_data'
              WHEN event_type = 'purchase' THEN 'market_data'
              ELSE 'weather_data' END AS topic,
         ts, user_id
  FROM events
)"""

FAST_TOPICS = f"""{TOPICS},
fast AS (
  SELECT topic, ms, ms // 3600000 AS hour
  FROM (SELECT topic, 1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 24 AS ms FROM topics)
)"""

BUCKET_COUNTS = f"""
WITH {TOPICS}
SELECT topic, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
       CAST(day(ts) AS BIGINT) AS day, CAST(hour(ts) AS BIGINT) AS hour,
       count(*) AS records, CAST(sum(user_id) AS BIGINT) AS keys
FROM topics GROUP BY ALL"""

PER_DAY = f"""
WITH {TRIPS}
SELECT pickup_year, pickup_month, pickup_day, count(*) AS trips FROM trips GROUP BY ALL"""

HOUR_STATS = f"""
WITH {TRIPS}
SELECT pickup_hour, round(avg(fare_amount), 6) AS mean_fare,
       round(stddev_samp(fare_amount), 6) AS std_fare
FROM trips GROUP BY pickup_hour"""

SURGE = f"WITH {TRIPS}, {_scored('fare_amount')} {_events('abs(z) > 3', FARE_TYPE)}"


def oracle_sql() -> dict[str, str]:
    low = f"{TRIPS}, {_scored('ln(fare_amount)', name='low')}"
    both = f"{low}, {_scored('fare_amount', name='surge')}"
    idle = (
        "gaps AS (SELECT *, CAST(epoch_us(pickup_datetime) - epoch_us(lag(dropoff_datetime) OVER "
        "(PARTITION BY vendor_id ORDER BY pickup_datetime, trip_id)) AS DOUBLE) / 1e6 AS gap "
        "FROM trips)"
    )
    all_trips = f"WITH {TRIPS} SELECT * FROM trips"
    all_hours = f"WITH {HOURS} SELECT * FROM hours"
    return {
        "raw_scan_count": "SELECT 'raw' AS stage, count(*) AS rows FROM events",
        "mixed_schemas": f"""
            WITH {TRIPS}
            SELECT pickup_day, vendor_id, rate_code, count(*) AS trips,
                   CAST(sum(passenger_count) AS BIGINT) AS passengers,
                   round(sum(fare_amount), 4) AS fares,
                   count(*) FILTER (WHERE trip_id % 3 < 2) AS tolls
            FROM trips GROUP BY ALL""",
        "layout_audit": f"""
            WITH {TRIPS}
            SELECT 'pickup_year=' || pickup_year || '/pickup_month=' || pickup_month
                     || '/pickup_day=' || pickup_day AS partition,
                   CAST(1 AS BIGINT) AS files, count(*) AS rows, CAST(1 AS BIGINT) AS row_groups,
                   'SNAPPY' AS codecs, CAST(0 AS BIGINT) AS well_sized,
                   CAST(0 AS DOUBLE) AS share_well_sized, true AS has_bytes
            FROM trips GROUP BY pickup_year, pickup_month, pickup_day""",
        "expiry_register": f"""
            WITH {TRIPS}, kinds AS (SELECT unnest(['version', 'scratch']) AS kind,
              unnest([3, 1]) AS folders, unnest([2, 1]) AS removed)
            SELECT kind, CAST(folders AS BIGINT) AS folders, CAST(removed AS BIGINT) AS removed,
                   CAST(0 AS BIGINT) AS removed_at_once,
                   (SELECT count(*) FROM trips) AS trips, CAST(1 AS BIGINT) AS stay
            FROM kinds""",
        "trips_clean": all_trips,
        "surrogate_ids": f"""
            WITH {TRIPS}
            SELECT unnest(['task', 'source', 'content', 'file']) AS way,
                   n * unnest([1, 1, 1, 2]) AS trips, n * unnest([1, 1, 1, 2]) AS ids
            FROM (SELECT count(*) AS n FROM trips)""",
        "trips_by_partition": PER_DAY,
        "hourly_agg": all_hours,
        "hourly_p95_exact": f"""
            WITH {HOURS}
            SELECT pickup_year, pickup_month, pickup_day, pickup_hour, total_trips, p95_fare
            FROM hours""",
        "large_group_quantile": """
            SELECT l_returnflag, quantile_disc(CAST(l_extendedprice AS DOUBLE), 0.95) AS p95_price
            FROM lineitem GROUP BY l_returnflag""",
        "hour_stats": HOUR_STATS,
        "hour_stats_from_hourly": HOUR_STATS,
        "trips_with_stats": f"""
            WITH {TRIPS}, {_scored('fare_amount')}
            SELECT trip_id, pickup_hour, fare_amount, round(mean, 6) AS mean_fare,
                   round(deviation, 6) AS std_fare, round(z, 6) AS z_score
            FROM scored""",
        "zero_deviation": f"""
            WITH {TRIPS}, {_scored('CAST(pickup_hour AS DOUBLE)')}
            SELECT pickup_hour, count(*) AS trips, count(z) AS scored
            FROM scored GROUP BY pickup_hour""",
        "nan_fares": f"""
            WITH {TRIPS},
            tainted AS (SELECT DISTINCT pickup_hour FROM trips WHERE fare_amount > 200),
            whole AS (SELECT * FROM trips WHERE pickup_hour NOT IN (FROM tainted)),
            {_scored('fare_amount', base='whole')}
            SELECT pickup_hour, {SEVERITY} AS severity, count(*) AS events
            FROM scored WHERE abs(z) > 3 GROUP BY ALL
            UNION ALL
            SELECT pickup_hour, 'HIGH', count(*) FROM trips
            WHERE pickup_hour IN (FROM tainted) GROUP BY ALL""",
        "nan_fares_dropped": f"""
            WITH {TRIPS}, usual AS (SELECT * FROM trips WHERE fare_amount <= 200),
            {_scored('fare_amount', base='usual')}
            SELECT pickup_hour, {SEVERITY} AS severity, count(*) AS events
            FROM scored WHERE abs(z) > 3 GROUP BY ALL""",
        "anomalies_surge": SURGE,
        "anomalies_low": f"WITH {low} {_events('abs(z) > 3', FARE_TYPE, source='low')}",
        "anomaly_severity_counts": f"""
            WITH {both}, found AS (
              SELECT {FARE_TYPE} AS anomaly_type, {SEVERITY} AS severity FROM low WHERE abs(z) > 3
              UNION ALL
              SELECT {FARE_TYPE} AS anomaly_type, {SEVERITY} AS severity FROM surge
              WHERE abs(z) > 3)
            SELECT anomaly_type, severity, count(*) AS events FROM found GROUP BY ALL""",
        "event_stamps": f"""
            WITH {TRIPS}, {_scored('fare_amount')}
            SELECT count(*) AS events, count(DISTINCT trip_id) AS ids, count(*) AS stamps
            FROM scored WHERE abs(z) > 3""",
        "event_hash_ids": f"""
            WITH {TRIPS}, {_scored('fare_amount')}
            SELECT sha256(CAST(trip_id AS VARCHAR) || '|' || {FARE_TYPE}) AS event_id,
                   {FARE_TYPE} AS anomaly_type
            FROM scored WHERE abs(z) > 3""",
        "rule_low_tip": f"""
            WITH {TRIPS}, {_scored('ln(tip_amount)')}
            {_events('z < -3', "'low_tip'", fare='fare_amount')}""",
        "rule_outlier_distance": f"""
            WITH {TRIPS}, {_scored('pow(trip_distance, 6)')}
            {_events('abs(z) > 3', "'outlier_distance'", 'fare_amount', 'round(mean / 1e9, 3)')}""",
        "rule_long_idle": f"""
            WITH {TRIPS}, {idle}, {_scored('gap', base='gaps')}
            {_events('z > 3', "'long_idle'", fare='fare_amount')}""",
        "rules_in_job": " UNION ALL ".join(
            f"""SELECT * FROM (WITH {TRIPS}{more}, {_scored(measure, base=base)}
                SELECT {kind} AS anomaly_type, count(*) AS events FROM scored WHERE {limit}
                GROUP BY ALL HAVING count(*) > 0)"""
            for measure, base, more, kind, limit in (
                ("fare_amount", "trips", "", FARE_TYPE, "abs(z) > 3"),
                ("tip_amount", "trips", "", "'low_tip'", "z < -3"),
                ("trip_distance", "trips", "", "'outlier_distance'", "abs(z) > 3"),
                ("gap", "gaps", f", {idle}", "'long_idle'", "z > 3"),
            )
        ),
        "table_listing": f"""
            WITH {TRIPS}, {_scored('fare_amount')}
            SELECT 'taxi_trips' AS table_name, (SELECT count(*) FROM trips) AS rows,
                   CAST(22 AS BIGINT) AS columns
            UNION ALL
            SELECT 'taxi_hourly_agg', (SELECT count(*) FROM (
              SELECT DISTINCT pickup_year, pickup_month, pickup_day, pickup_hour FROM trips)), 12
            UNION ALL
            SELECT 'anomaly_events', (SELECT count(*) FROM scored WHERE abs(z) > 3), 10""",
        "append_roundtrip": all_trips,
        "overwrite_roundtrip": PER_DAY,
        "replace_roundtrip": all_hours,
        "sql_access": f"""
            WITH {HOURS}
            SELECT pickup_year, pickup_month, pickup_day, count(*) AS hours,
                   CAST(sum(total_trips) AS BIGINT) AS trips,
                   CAST(sum(total_passengers) AS BIGINT) AS passengers,
                   max(p95_fare) AS highest_p95
            FROM hours GROUP BY ALL""",
        "compact_roundtrip": all_trips,
        "compaction_groups": f"""
            WITH RECURSIVE
            files AS (SELECT strftime(o_orderdate, '%Y-%m') AS partition,
                             'part-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS file,
                             CAST(trunc(o_totalprice * 100) AS BIGINT)
                               * CASE WHEN o_orderkey % 50 = 0 THEN 5 ELSE 1 END AS length
                      FROM orders),
            bad AS (SELECT *, length > {SIZE_RANGE[1] * FILE_TARGET} AS large,
                           count(*) OVER (PARTITION BY partition) AS among
                    FROM files WHERE length NOT BETWEEN {SIZE_RANGE[0] * FILE_TARGET}
                                                    AND {SIZE_RANGE[1] * FILE_TARGET}),
            f AS (SELECT *, row_number() OVER (PARTITION BY partition ORDER BY length DESC, file) AS i
                  FROM bad WHERE NOT large AND among >= 3),
            step AS (
              SELECT DISTINCT partition, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS loads,
                     CAST(0 AS BIGINT) AS bin FROM f
              UNION ALL
              SELECT partition, i,
                     CASE WHEN b IS NULL THEN list_append(loads, length)
                          ELSE list_transform(loads, lambda x, k: CASE WHEN k = b THEN x + length
                                                                       ELSE x END) END,
                     coalesce(b, len(loads) + 1)
              FROM (SELECT f.partition, f.i, length, loads,
                           list_min(list_filter(list_transform(loads, lambda x, k:
                             CASE WHEN x + length <= {int(FILL * FILE_TARGET)} THEN k END),
                             lambda k: k IS NOT NULL)) AS b
                    FROM step JOIN f ON f.partition = step.partition AND f.i = step.i + 1)),
            small AS (SELECT f.partition, file, length, bin - 1 AS bin, CAST(1 AS BIGINT) AS pieces,
                             count(*) OVER (PARTITION BY f.partition, bin) AS mates
                      FROM f JOIN step USING (partition, i)),
            last AS (SELECT partition, max(bin) AS bin FROM small GROUP BY partition)
            SELECT partition, file, length, bin, pieces FROM small WHERE mates > 1
            UNION ALL
            SELECT partition, file, length,
                   coalesce(last.bin, -1)
                     + row_number() OVER (PARTITION BY partition ORDER BY length DESC, file),
                   CAST(round(length / {FILE_TARGET}) AS BIGINT)
            FROM bad LEFT JOIN last USING (partition) WHERE large""",
        "compact_split": f"""
            WITH {TRIPS}
            SELECT pickup_day, count(*) AS trips, CAST(sum(trip_id) AS BIGINT) AS ids,
                   true AS all_split
            FROM trips WHERE pickup_day < 6 GROUP BY pickup_day""",
        "purge_roundtrip": f"""
            WITH {TRIPS}
            SELECT pickup_year, pickup_month, pickup_day, count(*) AS trips FROM trips
            WHERE pickup_datetime >= TIMESTAMP '{PURGE_BEFORE}' GROUP BY ALL""",
        "metrics_report": f"""
            WITH {HOURS}, {_scored('fare_amount')}
            SELECT 'raw' AS stage, (SELECT count(*) FROM raw) AS rows
            UNION ALL SELECT 'trips', (SELECT count(*) FROM trips)
            UNION ALL SELECT 'hourly', (SELECT count(*) FROM hours)
            UNION ALL SELECT 'anomalies', (SELECT count(*) FROM scored WHERE abs(z) > 3)""",
        "stream_time_buckets": BUCKET_COUNTS,
        "stream_paths": f"""
            WITH {TOPICS}
            SELECT 'topic=' || topic || strftime(ts, '/year=%Y/month=%m/day=%d/hour=%H') AS folder,
                   count(*) AS records
            FROM topics GROUP BY ALL""",
        "stream_json_topics": BUCKET_COUNTS,
        "ingestion_time_present": "SELECT count(*) AS stamped FROM events",
        "stream_incremental": PER_DAY,
        "stream_anomalies": SURGE,
        "stream_live_anomalies": " UNION ALL ".join(
            f"""SELECT * FROM (WITH {TRIPS},
                now AS (SELECT * FROM trips WHERE trip_id % 3 = {n}),
                before AS (SELECT pickup_hour, avg(fare_amount) AS mean,
                                  stddev_samp(fare_amount) AS deviation
                           FROM trips WHERE trip_id % 3 < {n} GROUP BY pickup_hour),
                scored AS (SELECT t.*, mean, fare_amount AS measure,
                                  (fare_amount - mean) / nullif(deviation, 0) AS z
                           FROM now t JOIN before USING (pickup_hour))
                {_events('abs(z) > 3', FARE_TYPE)})"""
            for n in (1, 2)
        ),
        "stream_event_roll": f"""
            WITH RECURSIVE {FAST_TOPICS},
            starts AS (
              SELECT topic, hour, min(ms) AS start FROM fast GROUP BY topic, hour
              UNION ALL
              SELECT fast.topic, fast.hour, min(ms) FROM starts JOIN fast
                ON fast.topic = starts.topic AND fast.hour = starts.hour AND ms >= start + 300000
              GROUP BY fast.topic, fast.hour),
            placed AS (SELECT f.topic, ms, start FROM fast f ASOF JOIN starts s
                         ON f.topic = s.topic AND f.hour = s.hour AND f.ms >= s.start)
            SELECT topic, min(ms) AS first, max(ms) AS last, count(*) AS records
            FROM placed GROUP BY topic, start""",
        "stream_topic_schemas": f"""
            WITH {TOPICS}, t AS (
              SELECT CASE WHEN event_type IN ('click', 'view') THEN 'sensor_data'
                          WHEN event_type = 'purchase' THEN 'market_data'
                          ELSE 'weather_data' END AS topic, user_id, value,
                     CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
            SELECT topic, CASE topic WHEN 'sensor_data' THEN 'timestamp,sensor,reading'
                            WHEN 'market_data' THEN 'timestamp,symbol,price,volume'
                            ELSE 'timestamp,station,wind' END || ',{INGESTION_TIME}' AS columns,
                   count(*) AS records,
                   CAST(sum(CASE WHEN topic = 'market_data' THEN k ELSE user_id END) AS BIGINT)
                     AS whole,
                   round(sum(value), 3) AS real, count(*) AS stamped
            FROM t GROUP BY topic""",
        "stream_bad_records": f"""
            WITH {TOPICS}, bad AS (
              SELECT topic, CASE WHEN user_id % 97 = 0 THEN 'record does not parse'
                                 WHEN user_id % 89 = 0 AND topic = 'sensor_data'
                                   THEN 'sensor is no bigint'
                                 WHEN user_id % 83 = 0 THEN 'record without event time' END
                       AS message FROM topics)
            SELECT topic, message, count(*) AS records, count(*) AS placed, true AS failed,
                   false AS written
            FROM bad WHERE message IS NOT NULL GROUP BY topic, message""",
        "stream_killed_and_rerun": f"""
            WITH {TOPICS} SELECT topic, count(*) AS records, CAST(0 AS BIGINT) AS different
            FROM topics GROUP BY topic""",
        "hourly_by_delivery": f"""
            WITH {TRIPS}
            SELECT pickup_year, pickup_month, pickup_day, pickup_hour, count(*) AS total_trips,
                   CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
                   round(quantile_disc(fare_amount, 0.95), 2) AS p95_fare,
                   round(sum(trip_distance), 6) AS distance_sum,
                   round(sum(fare_amount), 6) AS fare_sum, round(sum(tip_amount), 6) AS tip_sum,
                   round(sum(total_amount), 6) AS revenue, true AS rounded
            FROM trips GROUP BY ALL""",
        **LLM_SQL,
    }
