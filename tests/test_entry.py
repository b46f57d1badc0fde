import __spark_entry__ as entry


def test_entry_and_registry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.count() > 0 and "final_rank" in df.columns


def test_plan_reads_only_what_it_needs(spark):
    plan = entry.queries()["value_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string>" in plan
    plan = entry.queries()["where_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(o_orderpriority" in plan
