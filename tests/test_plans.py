"""Plan shape: no Python evaluation anywhere, filters and projections reach the scan, no sort
or second aggregate in the temperature build, pivots without a discovery job."""

import pytest

from starmart.operators import aggregate as AG
from starmart.operators.quality import orphan_report
from starmart.plans import adapters as AD
from starmart.plans import analytics as AN
from starmart.plans import pipeline as PL
from starmart.plans import proofs

SF = "/root/testdata/sf0.001"
# queries that write files when called are checked elsewhere (they run jobs at build time)
WRITES = {"parquet_roundtrip", "partitioned_roundtrip", "csv_roundtrip", "csv_semicolon_roundtrip",
          "typed_scan", "incremental_overwrite", "incremental_stream", "place_dim",
          "place_dim_strict", "country_codes", "travel_modes", "star_build", "incremental_star",
          "csv_mixed_headers", "arrivals_csv", "labels_many_pairs", "star_versions",
          "incremental_merge", "trend_moving", "trend_slope", "trend_pruned", "reject_report",
          "labels_split", "profile_merge", "corr_incremental"} | {
              n for n in proofs.QUERIES if n.endswith("_star")}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(proofs.QUERIES) - WRITES))
def test_no_python_udf(spark, name):
    plan = _plan(proofs.QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filter_and_columns_pushed_to_scan(spark):
    df = proofs.QUERIES["filter_code"](spark, SF)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), EqualTo(l_quantity,2.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan


def test_temperature_build_has_no_sort(spark):
    from pyspark.sql import functions as F

    df = proofs.QUERIES["temperature_dim"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort " not in plan and "Sort [" not in plan
    # sums per place, which both tables share, and their means; nothing for a de-duplication
    assert plan.count("Aggregate") == 2


def test_mean_is_partial_then_final(spark):
    plan = _plan(proofs.QUERIES["mean_decimal"](spark, SF))
    assert "partial_avg" in plan


def test_dimension_join_is_broadcast(spark):
    plan = _plan(proofs.QUERIES["lookup_inner"](spark, SF))
    assert "BroadcastHashJoin" in plan


def _exchanges(df):
    return _plan(df).count("Exchange hashpartitioning")


def test_pivot_is_one_shuffle(spark):
    assert _exchanges(proofs.QUERIES["pivot_first"](spark, SF)) == 1


def _jobs(spark, build):
    """The number of jobs that ``build`` runs."""
    sc, group = spark.sparkContext, f"jobs-{build}"
    sc.setJobGroup(group, group)
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_fact_build_is_one_scan_and_one_shuffle(spark):
    df = proofs.QUERIES["fact_build"](spark, SF)
    plan = _plan(df)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
    # building the plan runs nothing but the file listing and the footer read of the table
    table = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert _jobs(spark, lambda: PL.fact_table(PL.pleasure_arrivals(AD.arrivals_from_lineitem(table)))) == 0


def test_profile_is_one_scan_without_a_join(spark):
    t = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _plan(AN.profile_by(t, ["o_custkey"], "o_orderstatus", ["F"], "o_orderpriority", shares=3))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_orphan_report_scans_the_fact_once_and_shuffles_counts_only(spark):
    fact = spark.read.parquet(f"{SF}/lineitem.parquet")
    part = spark.read.parquet(f"{SF}/part.parquet")
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    report = orphan_report(fact, [("l_partkey", "part", part, "p_partkey"),
                                  ("l_suppkey", "nation", nation, "n_nationkey"),
                                  ("l_partkey", "nation", nation, "n_nationkey")])
    plan = _plan(report)
    assert plan.count("lineitem.parquet") == 1
    assert "partial_count" in plan


def test_temperature_tables_from_one_partial_aggregate(spark):
    e, c, n = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("events", "customer", "nation"))
    sums = PL.temperature_sums(AD.temperature_raw(e, c, n))
    for df in PL.temperature_means(sums, home="NATION_1"):
        assert "partial_sum" in _plan(df)


def test_exact_quantiles_are_one_lazy_plan_that_shuffles_owning_ranges_only(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    plans = []
    assert _jobs(spark, lambda: plans.append(AG.profile(df, cols, quantiles=[0.25, 0.5, 0.75], exact=True))) == 0
    # the statistics, the sketch, the ranges, the owning ranges
    assert _plan(plans[0]).count("Scan parquet") == 4
    # AQE submits each broadcast and each shuffle stage by itself
    assert _jobs(spark, plans[0].collect) <= 12
    picked = _plan(AG.order_statistics(df, cols, [0.25, 0.5, 0.75]))
    assert "partial_count" in picked and "rangepartitioning" not in picked and "SortMergeJoin" not in picked


def test_star_enrich_shuffles_line_items_once(spark):
    # simulate scale: no size-based broadcasts
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(proofs.QUERIES["star_enrich"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    assert plan.count("SortMergeJoin") == 3
    assert plan.split("Scan parquet")[0].count("l_orderkey") and plan.count("Exchange hashpartitioning(l_orderkey") == 2


def test_months_are_pruned_through_the_date_dimension(spark):
    """Only the folders of the wanted months are scanned, chosen when the dimension has run."""
    df = proofs.QUERIES["trend_pruned"](spark, SF)
    assert "SubqueryAdaptiveBroadcast dynamicpruning" in _plan(df)
    df.collect()
    scan = next(x for x in _plan(df).split("Initial Plan")[0].splitlines() if "travel_mode_code" in x and "FileScan" in x)
    assert "isnotnull(arrival_month" in scan and "dynamicpru" in scan.split("PartitionFilters")[1]


def test_weekly_series_counts_before_it_shuffles(spark):
    from starmart.plans import trends as TR

    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = _plan(TR.trend_moving(df, "l_shipdate", ["l_returnflag"]))
    assert "partial_count" in plan and "Join" not in plan
