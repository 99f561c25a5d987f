"""Plan-shape checks: pushdown, single parse, partial aggregation, no raw-row windows."""

import pytest

from tidewater.operators import analytics as an
from tidewater.operators import entities as ent
from tidewater.operators.joins import orders_per_customer
from tidewater.plans.catalog import QUERIES
from tidewater.plans.pipeline import route_events
from tidewater.sources import testdata as td

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_once_per_message(spark):
    ev = route_events(td.query_messages(td.load(spark, SF, "events")), "queries")
    p = _plan(ev)
    # one map parse; the typed parses sit behind the route
    assert p.count("THEN from_json(MapType(") == 1
    assert p.count("from_json(") == 3 == p.count("THEN from_json(")
    for route, messages in (("metrics", td.otlp_metric_messages), ("host_logs", td.otlp_log_messages)):
        # messages of one OTLP topic: the typed parse is the only one
        p = _plan(route_events(messages(td.load(spark, SF, "events")), route))
        assert p.count("from_json(") == 1


def test_filter_pushed_to_parquet(spark):
    e = td.load(spark, SF, "events").where("event_type = 'error'").select("event_id")
    p = e._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in p
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in p


def test_topic_prefilter_reaches_source(spark):
    ev = route_events(td.raw_messages(td.load(spark, SF, "events")), "queries")
    opt = ev._jdf.queryExecution().optimizedPlan().toString()
    # the OTLP branches have constant topics and are pruned away entirely
    assert "collect_list" not in opt


def test_entity_aggregation_is_partial(spark):
    ev = route_events(td.log_messages(td.load(spark, SF, "events")), "logs")
    p = _plan(ent.derive_entities(ent.entity_records(ev)))
    assert "partial_min" in p and "partial_max_by" in p
    # raw rows meet a hash aggregate; only the reduced combinations are sorted
    assert "HashAggregate(keys=[entity_id" in p


def test_dedup_uses_aggregate_not_window(spark):
    ev = route_events(td.query_messages(td.load(spark, SF, "events")), "queries")
    p = _plan(an.dedup_first(ev, "id"))
    assert "Window" not in p and "partial_min_by" in p


def test_join_preaggregates_orders(spark):
    j = orders_per_customer(td.load(spark, SF, "customer"), td.load(spark, SF, "orders"))
    p = _plan(j)
    assert "partial_count" in p


def test_topk_is_take_ordered(spark):
    ev = route_events(td.query_messages(td.load(spark, SF, "events")), "queries")
    from tidewater.sinks.tables import db_queries
    p = _plan(an.top_statements_by_calls(db_queries(ev), 10))
    assert "TakeOrderedAndProject" in p


STORED = ["filter_entity_since", "filter_source_type", "filter_metric_entity", "filter_time_between",
          "filter_slow_1000", "filter_logs_combined", "filter_slow_queries", "filter_poor_cache", "filter_high_volume",
          "filter_errors_deadlocks", "statement_shaping", "topk_total_time", "topk_calls", "scan_limit",
          "syslog_scan_limit", "fingerprint_rollup", "regression", "rollup", "trace_correlation",
          "db_queries_view", "db_logs_view", "db_metrics_view"]


@pytest.mark.parametrize("name", STORED)
def test_analyses_read_one_stored_table(spark, name):
    p = _plan(QUERIES[name](spark, SF))
    assert p.count("FileScan parquet") == 1
    assert "from_json" not in p and "parseJson" not in p and "variant_get" not in p


def test_predicates_reach_the_stored_tables(spark):
    """Names of partition and row-group predicates in each plan."""
    wanted = {
        "filter_entity_since": ["EqualTo(entity_id,host-3)", "GreaterThan(timestamp", "(event_date#"],
        "filter_source_type": ["EqualTo(source,postgresql)", "EqualTo(event_type,database_query)"],
        "filter_metric_entity": ["EqualTo(metric_name,postgresql.commits)", "EqualTo(entity_id,host-2)"],
        "filter_time_between": ["GreaterThanOrEqual(timestamp", "LessThanOrEqual(timestamp", "(event_date#"],
        "filter_slow_1000": ["GreaterThan(mean_time_ms,1000.0)"], "filter_high_volume": ["GreaterThan(calls,10000)"],
        "filter_poor_cache": ["LessThan(cache_hit_ratio,0.8)"],
        "filter_logs_combined": ["EqualTo(entity_id,host-1)", "EqualTo(log_level,error)", "(event_date#"],
        "syslog_scan_limit": ["EqualTo(event_type,syslog)"]}
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    try:
        for name, parts in wanted.items():
            p = _plan(QUERIES[name](spark, SF))
            pushed = p[p.index("PartitionFilters"):]
            assert [x for x in parts if x not in pushed] == [], name
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_stored_tables_hold_bloom_filters(spark):
    import glob

    import pyarrow.parquet as pq

    from tidewater.plans import catalog
    catalog.stored(spark, SF)
    base = catalog._stored[spark.sparkContext.applicationId, SF]
    for table in ("events", "metrics"):
        column = pq.ParquetFile(glob.glob(f"{base}/{table}/event_date=*/*.parquet")[0]).metadata.row_group(0)
        stats = {column.column(i).path_in_schema: column.column(i) for i in range(column.num_columns)}
        assert stats["entity_id"].statistics.has_min_max
        assert table == "metrics" or "log_level" in stats


def test_copies_go_before_the_parse(spark):
    p = _plan(QUERIES["dedup_by_id"](spark, SF))
    assert p.index("partial_min_by") < p.rindex("partial_min(struct(") and p.index("from_json") < p.rindex("partial_min(struct(")
