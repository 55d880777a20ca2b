"""Properties of the plans that matter on large tables."""

import re

import pytest

from fettle.plans.registry import queries
from fettle.plans.session import tune

QUERIES = queries()
WIDE = [n for n in QUERIES if n not in ("text_scan", "snapshot_scan", "evidence_bundle")]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def order_scans(plan: str) -> int:
    """Scans of orders that read columns; counting the rows of its files reads none."""
    return len(re.findall(r"orders\.parquet[^\n]*ReadSchema: struct<o_", plan))


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", WIDE)
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_queries_hold_in_a_session_as_it_comes(spark, sf_dir):
    """The code generated for the wide view was too large to be compiled: four to ten times slower."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    try:
        for name in ("canonical_nulls", "dup_total", "remediated_table"):
            spark.conf.set(limit, "65535")
            QUERIES[name](spark, sf_dir)
            assert spark.conf.get(limit) == "8000"
    finally:
        tune(spark)


def test_missing_report_is_one_scan_and_one_row_exchange(spark, sf_dir):
    plan = physical(QUERIES["missing_report"](spark, sf_dir))
    assert order_scans(plan) == 1
    assert plan.count("Exchange SinglePartition") == 1  # partial counts, one row per task


def test_columns_are_pruned(spark, sf_dir):
    plan = physical(QUERIES["dup_ref"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and not any("o_orderstatus" in s or "c_mktsegment" in s for s in schemas)


def test_rank_filters_limit_before_the_shuffle(spark, sf_dir):
    plan = physical(QUERIES["report_summary"](spark, sf_dir))
    assert re.search(r"WindowGroupLimit .*Partial", plan) and re.search(r"WindowGroupLimit .*Final", plan)
    # Texts already lie by document: the limit needs no shuffle at all.
    assert "WindowGroupLimit" in physical(QUERIES["top_sections"](spark, sf_dir))


def test_excerpts_use_a_bounded_top(spark, sf_dir):
    for name in ("sample_rows", "search_table", "top_rows", "row_relevance", "budget_concat", "lookup_rows"):
        assert "TakeOrderedAndProject" in physical(QUERIES[name](spark, sf_dir))


def test_row_numbers_have_no_window_over_the_whole_table(spark, sf_dir):
    plan = optimized(QUERIES["row_numbers"](spark, sf_dir))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3
    whole = [line for line in windows if "], [" not in line.split("windowspec")[-1]]
    # Only the running total over key groups lacks a partition, and it has one row per group.
    assert all("row_number()" not in line for line in whole)


def test_duplicate_groups_aggregate_by_hash(spark, sf_dir):
    plan = physical(QUERIES["dup_total"](spark, sf_dir))
    assert "SortAggregate" not in plan
    assert order_scans(plan) == 1


def test_mapping_join_is_not_forced_into_a_broadcast(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(QUERIES["cleaned_table"](spark, sf_dir))
        assert re.search(r"SortMergeJoin \[recipient_legal_name.*LeftOuter", plan)
        # The one forced broadcast, in each scan of the view, is the part table cut to 64 keys.
        assert plan.count("BroadcastHashJoin") == order_scans(plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_variants_count_values_once(spark, sf_dir):
    df = QUERIES["variants_report"](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert order_scans(final) == 1


UNSORTED = "cleaned_table changed_cells cleaning_execution lookup_totals report_summary final_summary".split()


@pytest.mark.parametrize("name", UNSORTED)
def test_no_sort_inside(spark, sf_dir, name):
    assert "rangepartitioning" not in physical(QUERIES[name](spark, sf_dir))


def test_duplicates_read_the_view_twice_at_most(spark, sf_dir):
    for name in ("dup_report", "dup_by_rule"):
        assert order_scans(physical(QUERIES[name](spark, sf_dir))) <= 2


def test_summary_joins_no_table(spark, sf_dir):
    """Names are counted before the mapping is joined: the view is scanned for counts alone."""
    plan = optimized(QUERIES["final_summary"](spark, sf_dir))
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 1 and "raw" in joins[0]


def test_hot_name_is_split_when_the_mapping_is_large(spark):
    from pyspark.sql import functions as F

    from fettle.operators import mapping as mp

    # A third of all rows hold one name; a tenth hold none.
    n = F.col("id")
    name = (
        F.when(n % 3 == 0, "Hot Name")
        .when(n % 10 == 1, None)
        .otherwise(F.concat(F.lit("name "), (n % 5000).cast("string")))
    )
    table = spark.range(600_000, numPartitions=16).select(n.alias("row_number"), name.alias("name"), F.sha2(n.cast("string"), 512).alias("text"))
    pairs = table.select("name").distinct().where("name IS NOT NULL")
    mapping = pairs.select(
        F.col("name").alias("original_value"), F.upper("name").alias("clean_value"),
        F.lit("accepted").alias("status"), F.lit("").alias("reason"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        clean = mp.apply_mapping(table, mapping, "name")
        by_name = clean.groupBy("name").agg(F.count("name_clean").alias("n"), F.max("text"))
        counts = {r["name"]: r.n for r in by_name.collect()}
        final = by_name._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert counts["Hot Name"] == 200_000
    assert sum(counts.values()) == table.where("name IS NOT NULL").count()
    assert "skew=true" in final


def test_hot_spelling_group_is_split(spark):
    from pyspark.sql import functions as F

    from fettle.operators import variants as va

    # A third of all spellings differ in punctuation only, so they share one compact form.
    n = F.col("id")
    noise = F.translate(F.sha2(n.cast("string"), 512), "0123456789abcdef", " -.,;:!?()[]{}*+")
    name = F.when(n % 3 == 0, F.concat(F.lit("Hot"), noise, F.lit("Name"))).otherwise(
        F.concat(F.lit("name "), n.cast("string"))
    )
    table = spark.range(60_000, numPartitions=8).select(n.alias("row_number"), name.alias("name"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        report = va.variants_report(table, "name")
        rows = report.collect()
        final = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 20_000 and len({r.suggested_group for r in rows}) == 1
    assert "skew=true" in final and "ReusedExchange" in final


def rows_read(spark, make) -> int:
    """Rows that all jobs of some steps read from files."""
    group = f"rows-{id(make)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        make()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(store.lastStageAttempt(s).inputRecords() for s in stages if tracker.getStageInfo(s))


@pytest.fixture(scope="module")
def numbered(spark, tmp_path_factory):
    """A numbered table of forty files in order."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("numbered") / "t")
    rows = spark.range(1, 40_001).select(
        F.col("id").alias("row_number"),
        F.when(F.col("id") % 10 == 0, "common").when(F.col("id") == 39_000, "rare").otherwise("other").alias("name"),
    )
    rows.repartitionByRange(40, "row_number").sortWithinPartitions("row_number").write.parquet(path)
    return path


@pytest.mark.parametrize("term, least, most", [("common", 10, 6_000), ("rare", 39_000, 90_000), ("none", 40_000, 90_000)])
def test_search_stops_early(spark, numbered, monkeypatch, term, least, most):
    from fettle.operators import evidence as ev
    from fettle.operators import search as se

    monkeypatch.setattr(se.enough_rows, "__defaults__", (1_000, 16, 3))
    table, found = spark.read.parquet(numbered), []
    read = rows_read(spark, lambda: found.extend(se.search_table(table, term, table.columns, 50, numbered=True).collect()))
    assert found == se.search_table(table, term, table.columns, 50).collect()
    assert least <= read <= most
    rows = ev.lookup_rows(table, term, ["row_number", "name"], numbered=True).collect()
    assert rows == ev.lookup_rows(table, term, ["row_number", "name"]).collect()


def test_search_of_a_hot_range_and_an_empty_table(spark, numbered):
    from fettle.operators import search as se

    table = spark.read.parquet(numbered)
    assert se.search_table(table.where("false"), "common", ["name"], 5, numbered=True).count() == 0
    assert se.search_table(table, "common", ["name"], 0, numbered=True).count() == 0
    assert se.search_table(table, " ", ["name"], 5, numbered=True).count() == 0


def test_evidence_reads_texts_until_the_budget(spark, tmp_path):
    from pyspark.sql import functions as F

    from fettle.operators import evidence as ev

    path = str(tmp_path / "docs")
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 > 0, F.repeat(F.lit("word "), 100)).alias("text"))
    docs.repartitionByRange(50, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    docs, found = spark.read.parquet(path), []
    read = rows_read(spark, lambda: found.extend(ev.budget_concat(ev.enough_documents(docs, "doc_id", lambda d: d), ["doc_id"]).collect()))
    assert found == ev.budget_concat(docs, ["doc_id"]).collect()
    # The keys of all documents, twice, and the texts of a few files only.
    assert read < 2.5 * 20_000
    few = docs.where("doc_id < 20")
    assert ev.enough_documents(few, "doc_id", lambda d: d).count() == 20
    assert ev.enough_documents(docs.where("false"), "doc_id", lambda d: d).count() == 0


@pytest.mark.parametrize("name", ["column_roles", "column_dtypes", "distinct_counts"])
def test_rows_are_not_multiplied_in_width(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    assert "Expand" not in plan and order_scans(plan) == 1


def test_cells_are_counted_before_the_shuffle(spark, sf_dir):
    plan = physical(QUERIES["column_roles"](spark, sf_dir))
    assert re.search(r"hashpartitioning\(ordinal#\d+, fact#\d+L, odd#\d+", plan) and "partial_count" in plan


def test_summaries_read_saved_reports(spark, sf_dir):
    assert order_scans(physical(QUERIES["final_summary"](spark, sf_dir))) <= 2
    assert order_scans(physical(QUERIES["report_summary"](spark, sf_dir))) == 0


def test_distinct_counts_of_all_kinds(spark):
    from pyspark.sql import functions as F

    from fettle.operators import variants as va

    n = F.col("id")
    df = spark.range(3000).select(
        F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("a"),
        F.when(n % 2 == 0, 0.0).otherwise(-0.0).alias("b"),
        F.lit(None).cast("int").alias("c"),
        F.array(n % 5).alias("d"),
        (n % 7).cast("string").cast("binary").alias("a b"),
    )
    got = va.distinct_counts(df, df.columns).first()
    assert tuple(got) == tuple(df.agg(*[F.count_distinct(f"`{c}`") for c in df.columns]).first()) == (2001, 1, 0, 5, 7)
    assert tuple(va.distinct_counts(df.where("false"), ["a", "b"]).first()) == (0, 0)
