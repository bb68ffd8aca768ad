"""Every operator as a named query over the given tables.

Queries whose name starts with `stream_` or `sink_` run a stream to its end and
return the table it wrote; all others return a lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.columns import line_revenue
from tillstream.operators import aggregates, column_tests, decode, keys, quality, reports, selection
from tillstream.operators.compaction import compact_days
from tillstream.operators.lateness import late_rows
from tillstream.operators.merge import expire_days, merged, upsert_days, write_days
from tillstream.operators.partials import stored_report
from tillstream.operators.reconcile import reconcile_hourly
from tillstream.plans.fact import build_fact, refresh_fact, with_revenue
from tillstream.sources import views
from tillstream.sources.readers import read_days, read_events, register_tables
from tillstream.sources.schemas import (
    AGG_SCHEMA,
    AGG_TABLE,
    AGG_WITHIN,
    FACT_SCHEMA,
    FACT_TABLE,
    PAYMENT_TYPES,
    RAW_SCHEMA,
    RAW_TABLE,
    SALE_COLUMNS,
    wire_schema,
)
from tillstream.sources.settings import fresh_folder
from tillstream.streaming.dedup import deduplicate
from tillstream.streaming.jobs import SalesJob, start
from tillstream.streaming.late import with_lateness
from tillstream.streaming.progress import StoredMetrics, listening, stored_metrics, totals
from tillstream.streaming.reconcile import reconcile_batches
from tillstream.streaming.sinks import append_to, replace_batch, upsert_to, with_partials

Query = Callable[[SparkSession, str], DataFrame]

# Times the checks are asked for: quiet end of the data, and inside its last day.
AS_OF = "2024-01-31 00:00:00"
AS_OF_BUSY = "2024-01-30 12:00:00"
AS_OF_UNALIGNED = "2024-01-30 12:30:00"
FACT_UP_TO = "2024-01-20 00:00:00"
LOOKBACK = "1 hour"
SLOT_SECONDS = 3600
SLICE_SECONDS = 8 * 86400
REVENUE_BANDS = [("low", 50.0), ("mid", 150.0)]
AVAILABLE_NOW = {"availableNow": True}


def plain_times(frame: DataFrame) -> DataFrame:
    """UTC wall-clock times without a zone, as other engines show them."""
    return frame.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in frame.schema
        ]
    )


def rounded(frame: DataFrame, scale: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, scale) for c in columns})


def _on(view: Callable[[DataFrame], DataFrame], build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(view(views.events(spark, sf_dir)))


def on_sales(build) -> Query:
    return _on(views.sales, build)


def on_dirty(build) -> Query:
    return _on(views.sales_dirty, build)


def on_wire(build) -> Query:
    return _on(views.wire, build)


# --- fact table -------------------------------------------------------------


def _loaded(events: DataFrame) -> DataFrame:
    return build_fact(views.sales(events).where(F.col("transaction_ts") < F.lit(FACT_UP_TO).cast("timestamp")))


def _incremental(lookback: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = views.events(spark, sf_dir)
        return selection.newer_than(views.sales_dirty(events), _loaded(events), lookback)

    return query


def fact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.events(spark, sf_dir)
    return rounded(build_fact(views.sales_dirty(events), _loaded(events), LOOKBACK), 2, "revenue")


def fact_merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.events(spark, sf_dir)
    target = _loaded(events)
    updates = with_revenue(selection.newer_than(views.sales_dirty(events), target, LOOKBACK))
    return rounded(merged(merged(target, updates), updates), 2, "revenue")


def fact_table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table: full build, incremental run, and the same run again."""
    events = views.events(spark, sf_dir)
    path = f"{fresh_folder(spark, 'fact')}/table"
    refresh_fact(spark, views.sales(events).where(F.col("transaction_ts") < F.lit(FACT_UP_TO).cast("timestamp")), path)
    for _ in range(2):
        refresh_fact(spark, views.sales_dirty(events), path, LOOKBACK)
    return rounded(read_days(spark, path, FACT_SCHEMA).select(*FACT_SCHEMA.names), 2, "revenue")


def new_keys_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.events(spark, sf_dir)
    return keys.new_keys(views.sales_dirty(events), _loaded(events)).select(*SALE_COLUMNS)


def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.events(spark, sf_dir)
    fact = build_fact(views.sales_dirty(events))
    return column_tests.orphans(fact, _loaded(events), "transaction_id").select("transaction_id", "transaction_ts")


def table_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables as the writers of this package store them, looked at by name."""
    sales = _sale_columns(views.sales(views.events(spark, sf_dir)))
    folder = fresh_folder(spark, "status")
    replace_batch(f"{folder}/raw")(sales, 0)
    raw = read_days(spark, f"{folder}/raw", RAW_SCHEMA)
    upsert_days(
        spark, f"{folder}/agg", aggregates.store_windows(raw), AGG_SCHEMA, ("store_id", "window_start"), "window_start", True, AGG_WITHIN
    )
    refresh_fact(spark, raw, f"{folder}/fact")
    register_tables(spark, **{name: f"{folder}/{name}" for name in ("raw", "agg", "fact")})
    times = {RAW_TABLE: "transaction_ts", AGG_TABLE: "window_start", FACT_TABLE: "transaction_ts"}
    return reports.table_status({name: (spark.table(name), time) for name, time in times.items()})


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.events(spark, sf_dir)
    stored = decode.accepted(decode.with_reject_reason(views.wire(events)))
    return rounded(reconcile_hourly(views.sales(events), stored), 4, "completeness")


# --- decoding ---------------------------------------------------------------


def _parse_timestamp(events: DataFrame) -> DataFrame:
    damaged = F.concat(F.lit("garbage "), F.col("event_id"))
    text = F.when(F.col("event_id") % 37 == 0, damaged).otherwise(F.date_format("ts", views.TIME_PATTERN))
    return events.select("event_id", F.try_to_timestamp(text).alias("parsed_ts"))


def _decoded(messages: DataFrame) -> DataFrame:
    return decode.unpack(messages, keep=("event_id",)).select(
        "event_id",
        "transaction_id",
        F.col("quantity").cast("double").alias("quantity"),
        F.col("price").cast("double").alias("price"),
        "transaction_ts",
    )


def _double_price(frame: DataFrame) -> DataFrame:
    return frame.withColumn("price", F.col("price").cast("double"))


# --- streams ----------------------------------------------------------------


def _state_partitions(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def drain(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """Run a streaming frame over all available input and read what it wrote."""
    folder = fresh_folder(spark, label)
    query = start(
        frame, append_to(f"{folder}/table"), f"{folder}/checkpoint", AVAILABLE_NOW, partitions=_state_partitions(spark)
    )
    query.awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{folder}/table")


def drain_in_slices(
    spark: SparkSession, arrivals: DataFrame, build: Callable[[DataFrame], DataFrame], label: str
) -> DataFrame:
    """Run a stream over rows that arrive in slices of eight days.

    Each slice is added to the source folder and taken up by a restarted query,
    so a slice is one micro-batch and the next one starts with its watermark.
    """
    folder = fresh_folder(spark, label)
    number = F.floor(F.unix_seconds("arrived_at") / SLICE_SECONDS)
    arrivals.withColumn("slice", number).write.partitionBy("slice").parquet(f"{folder}/arrivals")
    dated = T.StructType([*arrivals.schema.fields, T.StructField("slice", T.LongType())])
    slices = spark.read.schema(dated).parquet(f"{folder}/arrivals")
    stream = None
    for row in slices.select("slice").distinct().orderBy("slice").collect():
        arrived = slices.where(F.col("slice") == row["slice"]).drop("slice")
        arrived.write.mode("append").parquet(f"{folder}/source")
        stream = build(read_events(spark, "parquet", path=f"{folder}/source", schema=arrivals.schema))
        start(
            stream,
            append_to(f"{folder}/table"),
            f"{folder}/checkpoint",
            AVAILABLE_NOW,
            partitions=_state_partitions(spark),
        ).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


def on_stream(view: Callable[[DataFrame], DataFrame], build: Callable[[DataFrame], DataFrame], label: str) -> Query:
    return lambda spark, sf_dir: drain(spark, build(view(views.events_stream(spark, sf_dir))), label)


def stream_implausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some have damaged clocks, in slices; then the fact from what was stored, in two runs."""
    arrivals = views.wire_misdated(views.events(spark, sf_dir)).select("value", "arrived_at")

    def build(stream: DataFrame) -> DataFrame:
        return SalesJob(stream.withColumnRenamed("arrived_at", "timestamp"), checkpoint="", write_raw=None, write_agg=None).raw()

    raw = drain_in_slices(spark, arrivals, build, "implausible")
    path = f"{fresh_folder(spark, 'implausible-fact')}/table"
    refresh_fact(spark, raw.where(F.col("transaction_ts") < F.lit(FACT_UP_TO).cast("timestamp")), path)
    refresh_fact(spark, raw, path)
    return read_days(spark, path, FACT_SCHEMA).select(*SALE_COLUMNS)


def stream_late_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted rows, those behind the watermark marked instead of dropped."""
    arrivals = views.sales_delayed(views.events(spark, sf_dir)).select("transaction_id", "transaction_ts", "arrived_at")
    kept = drain_in_slices(spark, arrivals, with_lateness, "late-output")
    return kept.select("transaction_id", "transaction_ts", "is_late")


# The writer schemas of the messages in `wire_versions`.
SECOND_WRITER = [(c, T.StringType()) for c in ("transaction_id", "store_id", "product_id", "unit_price", "transaction_ts")] + [("quantity", T.IntegerType())]
VERSIONS = {
    1: decode.Writer(wire_schema()),
    2: decode.Writer(T.StructType([T.StructField(*f) for f in SECOND_WRITER]), {"price": "unit_price"}, {"payment_type": "online"}),
}


def decode_versions(messages: DataFrame) -> DataFrame:
    rows = decode.with_reject_reason(messages, keep=("event_id",), versions=VERSIONS)
    return _double_price(rows).withColumn("quantity", F.col("quantity").cast("double")).select("event_id", "reject_reason", *SALE_COLUMNS)


def _in_slices(view, mode: str, label: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        arrivals = view(views.events(spark, sf_dir)).select("transaction_id", "transaction_ts", "arrived_at")
        kept = drain_in_slices(spark, arrivals, lambda stream: deduplicate(stream, mode=mode), label)
        return kept.select("transaction_id", "transaction_ts")

    return query


def stream_raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, three queries over the wire; returns the raw table."""
    folder = fresh_folder(spark, "job")
    SalesJob(
        messages=views.wire(views.events_stream(spark, sf_dir)).select("value"),
        checkpoint=f"{folder}/checkpoint",
        write_raw=replace_batch(f"{folder}/raw"),
        write_agg=replace_batch(f"{folder}/agg", "window_start"),
        write_rejects=replace_batch(f"{folder}/rejects"),
        trigger=AVAILABLE_NOW,
        partitions=_state_partitions(spark),
    ).run()
    return spark.read.schema(RAW_SCHEMA).parquet(f"{folder}/raw").select(*SALE_COLUMNS)


def stream_job_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.wire(views.events_stream(spark, sf_dir)).select("value")
    job = SalesJob(messages, checkpoint="", write_raw=None, write_agg=None)
    return drain(spark, job.windows(), "job-windows")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.wire(views.events_stream(spark, sf_dir))
    kept = drain(spark, decode.rejected(decode.with_reject_reason(messages, keep=("event_id",))), "rejects")
    return kept.select("event_id", "reject_reason")


def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through the job's reject sink, then the check over the stored table."""
    folder = fresh_folder(spark, "rejects-table")
    messages = views.wire(views.events_stream(spark, sf_dir)).select("value")
    job = SalesJob(messages, checkpoint="", write_raw=None, write_agg=None)
    start(job.rejects(), replace_batch(f"{folder}/t"), f"{folder}/checkpoint", AVAILABLE_NOW).awaitTermination()
    return quality.reject_check(spark.read.schema("reject_reason string, value binary").parquet(f"{folder}/t"))


def retention_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales streamed into the raw layout, old days dropped from it, and read back."""
    folder = fresh_folder(spark, "retention")
    sales = _sale_columns(views.sales(views.events_stream(spark, sf_dir)))
    start(sales, replace_batch(f"{folder}/raw"), f"{folder}/checkpoint", AVAILABLE_NOW).awaitTermination()
    expire_days(spark, f"{folder}/raw", AS_OF, 20)
    return read_days(spark, f"{folder}/raw", RAW_SCHEMA).select(*SALE_COLUMNS)


def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in batches, the last one twice, checked from its stored partials."""
    sales = _sale_columns(views.sales_dirty(views.events(spark, sf_dir)))
    folder = fresh_folder(spark, "partials")
    write, part = with_partials(replace_batch(f"{folder}/raw"), f"{folder}/partials"), F.pmod(F.xxhash64("transaction_ts"), F.lit(PARTS))
    for number in (*range(PARTS), PARTS - 1):
        write(sales.where(part == number), number)
    return stored_report(spark, read_days(spark, f"{folder}/raw", RAW_SCHEMA), f"{folder}/partials", AS_OF_BUSY)


def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own counts of messages and of stored rows, hour by hour."""
    folder = fresh_folder(spark, "reconcile")
    messages = views.wire_timed(views.events_stream(spark, sf_dir)).select("value", "timestamp")
    job = SalesJob(
        messages=messages,
        checkpoint=f"{folder}/checkpoint",
        write_raw=with_partials(replace_batch(f"{folder}/raw"), f"{folder}/partials"),
        write_agg=replace_batch(f"{folder}/agg", "window_start"),
        write_rejects=replace_batch(f"{folder}/rejects"),
        source_counts=f"{folder}/source",
        trigger=AVAILABLE_NOW,
        partitions=_state_partitions(spark),
    )
    job.run()
    return rounded(reconcile_batches(spark, f"{folder}/source", f"{folder}/partials"), 4, "completeness")


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stored records tell of a deduplication that was restarted for every slice of its input."""
    arrivals = views.sales_delayed(views.events(spark, sf_dir)).select("transaction_id", "transaction_ts", "arrived_at")
    path = fresh_folder(spark, "metrics")
    listener = StoredMetrics(spark, path)
    with listening(spark, listener):
        drain_in_slices(spark, arrivals, deduplicate, "metrics-table")
    found = totals(stored_metrics(spark, path))
    return found.select("input_rows", "late_rows", "errors")


PARTS = 4


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layout as several batches leave it, its closed days packed, and read back."""
    sales = _sale_columns(views.sales(views.events(spark, sf_dir)))
    path = f"{fresh_folder(spark, 'compacted')}/raw"
    write, part = replace_batch(path), F.pmod(F.xxhash64("transaction_id"), F.lit(PARTS))
    for number in range(PARTS):
        write(sales.where(part == number), number)
    compact_days(spark, path, RAW_SCHEMA, AS_OF)
    return read_days(spark, path, RAW_SCHEMA).select(*SALE_COLUMNS)


def _upsert_twice(
    view, build, schema: T.StructType, by: tuple[str, ...], time: str, fixed: bool, label: str, within: tuple[str, ...] = ()
) -> Query:
    """Fill a table through the upsert sink, then replay all input into it from
    an empty checkpoint."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = fresh_folder(spark, label)
        for attempt in ("first", "replay"):
            start(
                build(view(views.events_stream(spark, sf_dir))),
                upsert_to(spark, f"{folder}/table", schema, by, time, fixed, within),
                f"{folder}/{attempt}",
                AVAILABLE_NOW,
                partitions=_state_partitions(spark),
            ).awaitTermination()
        return read_days(spark, f"{folder}/table", schema).select(*schema.names)

    return query


def _stream_windows(sales: DataFrame) -> DataFrame:
    return aggregates.store_windows(deduplicate(sales))


def _sale_columns(frame: DataFrame) -> DataFrame:
    return frame.select(*SALE_COLUMNS)


# --- registry ---------------------------------------------------------------


def kept_table(frame: DataFrame, schema: T.StructType, label: str, time: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame as a day-partitioned table and scan that."""
    spark = frame.sparkSession
    path = f"{fresh_folder(spark, label)}/table"
    write_days(frame, path, time, within=within)
    return read_days(spark, path, schema).select(*schema.names)


def stored_windows(sales: DataFrame) -> DataFrame:
    return kept_table(aggregates.store_windows(sales), AGG_SCHEMA, "agg-table", "window_start", AGG_WITHIN)


def stored_fact(sales: DataFrame) -> DataFrame:
    return kept_table(with_revenue(sales), FACT_SCHEMA, "fact-table", "transaction_ts")


def _definitions() -> dict[str, Query]:
    history = lambda sales: selection.history(sales, AS_OF_UNALIGNED)
    window_money = lambda frame: rounded(frame, 2, "total_revenue")
    return {
        # scans, projections and filters
        "scan_sales": on_sales(_sale_columns),
        "sales_revenue": on_sales(lambda s: s.select("transaction_id", F.round(line_revenue(), 2).alias("revenue"))),
        "filter_history_range": on_sales(lambda s: _sale_columns(history(s))),
        "recent_rows": on_sales(
            lambda s: selection.recent(s, AS_OF_BUSY).agg(
                F.count("*").alias("row_count"), F.round(F.sum(line_revenue()), 2).alias("revenue")
            )
        ),
        "null_rows": on_dirty(lambda s: _sale_columns(selection.rows_with_nulls(s))),
        "incremental_rows": _incremental(None),
        "incremental_lookback": _incremental(LOOKBACK),
        "retention_filter": on_sales(lambda s: _sale_columns(selection.keep_last(s, AS_OF, 20))),
        "staging_sales": on_dirty(lambda s: reports.staging(s)),
        # aggregates
        "agg_store_5min": on_sales(lambda s: window_money(aggregates.store_windows(s))),
        "hourly_volume": on_sales(aggregates.hourly_volume),
        "hourly_revenue": on_sales(lambda s: rounded(aggregates.hourly_revenue(s), 2, "revenue")),
        "hourly_stats": on_sales(
            lambda s: rounded(
                aggregates.hourly_stats(history(s)),
                4,
                "mean_volume",
                "stddev_volume",
                "mean_revenue",
                "stddev_revenue",
            )
        ),
        "hourly_volume_recent": on_sales(lambda s: aggregates.recent_hourly_volume(s, AS_OF)),
        "duplicate_ids": on_dirty(keys.duplicate_keys),
        "duplicate_sample": on_dirty(keys.duplicate_sample),
        # reports
        "hourly_revenue_by_store": on_sales(lambda s: rounded(reports.hourly_revenue_by_store(s), 2, "revenue")),
        "top_products": on_sales(lambda s: rounded(reports.top_products(s), 2, "revenue")),
        "payment_split": on_sales(
            lambda s: rounded(
                rounded(reports.payment_split(s), 2, "revenue"), 6, "transaction_share", "revenue_share"
            )
        ),
        "table_status": table_status,
        "agg_table_status": on_sales(
            lambda s: reports.table_status({AGG_TABLE: (stored_windows(s), "window_start")})
        ),
        "revenue_bands": on_sales(
            lambda s: rounded(
                reports.with_ingested_at(reports.with_revenue_band(with_revenue(s), REVENUE_BANDS, "high"), AS_OF),
                2,
                "revenue",
            )
        ),
        # decoding
        "decode_envelope": on_wire(lambda w: w.select("event_id", decode.payload().cast("string").alias("payload"))),
        "envelope_header": on_wire(
            lambda w: w.select(
                "event_id",
                decode.is_framed().alias("is_framed"),
                F.coalesce(decode.schema_id(), F.lit(-1)).alias("schema_id"),
            )
        ),
        "decode_payload": on_wire(_decoded),
        "decode_filter_bad": on_wire(
            lambda w: decode.drop_undecodable(decode.unpack(w, keep=("event_id",))).select("event_id")
        ),
        "parse_timestamp": _on(lambda events: events, _parse_timestamp),
        "parse_and_cast": on_wire(lambda w: _double_price(decode.parse_and_cast(w, keep=("event_id",)))),
        "quarantine_rows": on_wire(
            lambda w: decode.rejected(decode.with_reject_reason(w, keep=("event_id",))).select(
                "event_id", "reject_reason"
            )
        ),
        "decode_versions": _on(views.wire_versions, decode_versions),
        # fact table
        "fact_full": on_dirty(lambda s: rounded(build_fact(s), 2, "revenue")),
        "fact_first_occurrence": on_dirty(lambda s: _sale_columns(keys.first_occurrence(s.drop("event_id")))),
        "fact_merge": fact_merge,
        "fact_merge_idempotent": fact_merge_idempotent,
        "fact_table_merge": fact_table_merge,
        "new_keys_anti": new_keys_anti,
        # quality checks
        "dq_null": on_dirty(quality.null_check),
        "dq_duplicate": on_dirty(quality.duplicate_check),
        "dq_volume_anomaly": on_sales(lambda s: quality.volume_check(s, AS_OF)),
        "dq_volume_anomaly_fail": on_sales(lambda s: quality.volume_check(s, AS_OF_BUSY)),
        "dq_volume_anomaly_bounded": on_sales(lambda s: quality.volume_check(s, AS_OF_UNALIGNED, bounded=True)),
        "dq_revenue_anomaly": on_sales(lambda s: quality.revenue_check(s, AS_OF)),
        "dq_revenue_anomaly_fail": on_sales(lambda s: quality.revenue_check(s, AS_OF_BUSY)),
        "dq_revenue_anomaly_zero_fill": on_sales(
            lambda s: quality.revenue_check(s, AS_OF_UNALIGNED, zero_fill=True)
        ),
        "dq_freshness": on_sales(lambda s: quality.freshness(s, AS_OF)),
        "dq_report": on_dirty(lambda s: quality.check_report(s, AS_OF_BUSY)),
        "dq_summary": on_dirty(lambda s: quality.summary(quality.check_report(s, AS_OF_BUSY))),
        "dq_summary_pass": on_sales(lambda s: quality.summary(quality.check_report(s, AS_OF))),
        "dq_incremental": dq_incremental,
        "dq_alerts": on_dirty(lambda s: quality.alerts(quality.check_report(s, AS_OF_BUSY))),
        "source_freshness": on_sales(lambda s: quality.source_freshness(s, AS_OF)),
        # column tests
        "test_unique": on_dirty(lambda s: column_tests.repeated_values(s, ["transaction_id"])),
        "test_not_null": on_dirty(
            lambda s: column_tests.null_counts(
                with_revenue(s), [c for c, wanted in column_tests.FACT_TESTS.items() if "not_null" in wanted]
            )
        ),
        "test_accepted_values": on_dirty(
            lambda s: column_tests.unexpected_values(s, "payment_type", PAYMENT_TYPES)
        ),
        "test_suite": on_dirty(lambda s: column_tests.run_suite(stored_fact(s), column_tests.FACT_TESTS)),
        "test_relationships": test_relationships,
        "agg_not_null": on_dirty(
            lambda s: column_tests.run_suite(stored_windows(s), column_tests.AGG_TESTS)
        ),
        "agg_unique_key": on_sales(
            lambda s: column_tests.repeated_values(
                stored_windows(s), ["window_start", "window_end", "store_id"]
            ).agg(F.count("*").alias("failures"))
        ),
        # arrival
        "late_rows": _on(
            views.sales_delayed,
            lambda s: late_rows(s, F.floor(F.unix_seconds("arrived_at") / SLOT_SECONDS)).select(
                "transaction_id", "transaction_ts", "watermark"
            ),
        ),
        "reconcile_hourly": reconcile,
        # streams
        "stream_file_scan": on_stream(views.sales, _sale_columns, "scan"),
        "stream_dedup": on_stream(views.sales_repeated, lambda s: _sale_columns(deduplicate(s)), "dedup"),
        "stream_dedup_within": _in_slices(views.sales_resent, "within_watermark", "dedup-within"),
        "stream_late_drop": _in_slices(views.sales_delayed, "global", "late"),
        "stream_implausible": stream_implausible,
        "stream_reconcile": stream_reconcile,
        "stream_metrics": stream_metrics,
        "stream_late_output": stream_late_output,
        "stream_agg_5min": lambda spark, sf_dir: window_money(
            on_stream(views.sales, _stream_windows, "agg")(spark, sf_dir)
        ),
        "stream_raw_append": stream_raw_append,
        "stream_job_windows": lambda spark, sf_dir: window_money(stream_job_windows(spark, sf_dir)),
        "stream_rejects": stream_rejects,
        "dq_rejects": dq_rejects,
        "retention_table": retention_table,
        "compacted_table": compacted_table,
        "sink_upsert_agg": lambda spark, sf_dir: window_money(
            _upsert_twice(
                views.sales,
                _stream_windows,
                AGG_SCHEMA,
                ("store_id", "window_start"),
                "window_start",
                True,
                "upsert-agg",
                AGG_WITHIN,
            )(spark, sf_dir)
        ),
        "sink_upsert_raw": _upsert_twice(
            views.sales_repeated,
            lambda s: _sale_columns(deduplicate(s)),
            RAW_SCHEMA,
            ("transaction_id",),
            "transaction_ts",
            False,
            "upsert-raw",
        ),
    }


def registered() -> dict[str, Query]:
    """All queries, with times shown in UTC whatever the session's zone was."""
    def in_utc(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain_times(query(spark, sf_dir))

        return run

    return {name: in_utc(query) for name, query in _definitions().items()}
