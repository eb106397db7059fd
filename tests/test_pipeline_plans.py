from datetime import date

import __spark_entry__ as entry
from conftest import SF_SMALL
from marginlens.operators import cleaning as C
from marginlens.plans import catalog
from marginlens.plans.pipeline import run_pipeline
from marginlens.sources import testdata as td


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_building_the_pipeline_runs_no_job(spark):
    src = td.sources(spark, SF_SMALL, dirty=True)
    spark.sparkContext.setJobGroup("build-check", "build-check")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup("build-check"))
    outputs = run_pipeline(src["customers"], src["orders"], src["products"], as_of=date(2001, 8, 1))
    # Every output but those that hold price tiers, whose ranges are written when asked for.
    for name in set(outputs) - {"enriched_products", "validation"}:
        assert outputs[name].columns
    assert set(tracker.getJobIdsForGroup("build-check")) == before
    spark.sparkContext.setJobGroup("other", "other")
    assert len(outputs) == 15 and {"enriched_products", "validation", "cleaning_report", "profiles"} <= set(outputs)


def test_pipeline_outputs_equal_standalone_queries(spark):
    src = td.sources(spark, SF_SMALL, dirty=True)
    outputs = run_pipeline(src["customers"], src["orders"], src["products"], as_of=date(2001, 8, 1))
    standalone = catalog.QUERIES["e5_enriched_customers"](spark, SF_SMALL)
    assert outputs["enriched_customers"].exceptAll(standalone).count() == 0
    assert standalone.exceptAll(outputs["enriched_customers"]).count() == 0
    validation = outputs["validation"].collect()
    assert {r["output"] for r in validation} >= {"enriched_customers", "profit_by_year"}


def test_materialized_pipeline_matches(spark):
    src = td.sources(spark, SF_SMALL, dirty=True)
    lazy = run_pipeline(src["customers"], src["orders"], src["products"], as_of=date(2001, 8, 1))
    cut = run_pipeline(src["customers"], src["orders"], src["products"], as_of=date(2001, 8, 1), materialize=True)
    assert "Scan ExistingRDD" in cut["clean_orders"]._jdf.queryExecution().executedPlan().toString() or \
        "LogicalRDD" in cut["clean_orders"]._jdf.queryExecution().optimizedPlan().toString()
    assert lazy["profit_summary"].exceptAll(cut["profit_summary"]).count() == 0


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_catalog_plans(spark):
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
    representative = ["a1_profit_summary", "a4_profit_by_customer", "c7_clean_orders", "c11_cleaning_report",
                      "e5_enriched_customers", "e6_price_tier", "e7_sales_velocity", "e9_enriched_orders",
                      "r1_summary_statistics", "r16_top_customer_trends", "v3_validate_enriched_orders",
                      "v4_validate_profit_summary", "q1_profile_orders"]
    for name in representative:
        plan = plan_text(catalog.QUERIES[name](spark, SF_SMALL))
        assert not any(node in plan for node in python_nodes), name


def test_filters_reach_the_scan(spark):
    plan = C.clean_orders(td.orders(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_extendedprice), IsNotNull(l_discount), IsNotNull(l_orderkey)]" in plan


def test_entry_and_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["Year", "Total_Profit", "Order_Count"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_row_level_plans_never_funnel_into_one_partition(spark):
    # Only global aggregates and top-k reports may end in a single partition.
    for name in ["c7_clean_orders", "e5_enriched_customers", "e6_price_tier_range", "e9_enriched_orders",
                 "a1_profit_summary", "a5_profit_by_customer_year"]:
        assert "SinglePartition" not in plan_text(catalog.QUERIES[name](spark, SF_SMALL)), name


def test_registered_tier_queries_keep_no_category_in_one_task(spark):
    for name in ["e6_price_tier", "e6_price_tier_range", "e8_enriched_products", "r13_enriched_products_preview"]:
        assert "ntile" not in plan_text(catalog.QUERIES[name](spark, SF_SMALL)), name


def test_aggregates_do_not_depend_on_partitioning(spark):
    from marginlens.operators import orders as O
    from marginlens.operators import profit as A

    src = td.sources(spark, SF_SMALL, dirty=True)
    results = []
    for parts in (1, 7):
        enriched = O.enriched_orders(src["orders"].repartition(parts), src["customers"], src["products"])
        results.append(sorted(map(tuple, A.profit_by_customer_year(enriched).collect())))
    assert results[0] == results[1]


def test_customer_join_reuses_the_id_partitioning(spark):
    from marginlens.operators import customers as E

    src = td.sources(spark, SF_SMALL, dirty=True)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = E.enrich_customers(src["customers"], src["orders"], as_of=date(2001, 8, 1))._jdf \
            .queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    # The customers side of the final left join goes straight into the dedupe
    # window: no exchange (and no extra sort) between the window and the join.
    lines = plan.split("\n")
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "LeftOuter" in line)
    window = next(i for i in range(join, len(lines)) if "Window [row_number()" in lines[i])
    between = lines[join + 1:window]
    assert between and not any("Exchange" in line or "Sort [" in line for line in between), between


def test_top_customer_trends_sorts_once(spark):
    # The yearly rows feed a semi join and a window before the final order;
    # a sort of their own would add a range shuffle and a sampling job.
    plan = plan_text(catalog.QUERIES["r16_top_customer_trends"](spark, SF_SMALL))
    assert plan.count("rangepartitioning") == 1
    assert "TakeOrderedAndProject" in plan


def test_salted_pipeline_matches(spark):
    src = td.sources(spark, SF_SMALL, dirty=True)
    plain = run_pipeline(src["customers"], src["orders"], src["products"], as_of=date(2001, 8, 1),
                         tier_method="window")
    salted = run_pipeline(src["customers"], src["orders"], src["products"], as_of=date(2001, 8, 1),
                          tier_method="window", hot_key_rows=2)
    for name in ["enriched_orders", "profit_summary", "profit_by_customer"]:
        assert plain[name].exceptAll(salted[name]).count() == 0, name
        assert salted[name].exceptAll(plain[name]).count() == 0, name
