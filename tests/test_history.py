"""Kept tables: quality counts of the write, repeats across dates, merged cubes, pruned and co-located reads, footers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_TINY
from viewstar import schemas, scratch_path
from viewstar.operators import quality as qa
from viewstar.operators.ordering import number_rows
from viewstar.plans import colocated, daily_job, history
from viewstar.plans import history_queries as hq
from viewstar.plans import job_queries as jq
from viewstar.plans import registry as r
from viewstar.sinks import writers as w
from viewstar.sources import fixtures as fx
from viewstar.sources import metadata
from viewstar.sources import readers as rd


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)
    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# -- quality counts taken during the write ---------------------------------------------
def test_report_of_the_write_equals_a_recount_and_reads_raw_once(spark):
    raw = fx.raw_viewings(spark, SF_SMALL)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    counted = raw.mapInArrow(count, raw.schema)
    silver = scratch_path(spark, "t_report")
    apartments, attributes = fx.raw_apartments(spark, SF_SMALL), fx.raw_attributes(spark, SF_SMALL)
    daily_job.clean_to_silver(spark, counted, apartments, attributes, silver, "2025-06-28", daily_job.JobOptions())
    read, total = seen.value, raw.count()
    assert total <= read < 1.5 * total  # the rows once, and the first splits for the all-null test
    report = spark.read.parquet(f"{silver}/quality_report")
    assert rows(report) == rows(daily_job.quality_reports(raw, apartments, attributes, "2025-06-28").select(*report.columns))


def test_report_is_counted_again_when_tasks_ran_twice(spark):
    class Twice(qa.Watch):
        def on_read(self, df):
            return super().on_read(df.unionAll(df.limit(1)))  # a partition's rows counted twice

        def on_folded(self, df):
            return super().on_folded(df.withColumn(self.COPIES, F.lit(1).cast("long")))
    watch = Twice("user_viewings", ["viewed_at"])
    qa.clean_viewings(fx.raw_viewings(spark, SF_TINY), watch=watch).write.format("noop").mode("overwrite").save()
    assert watch.report("2025-06-28") is None
    recount = daily_job.quality_reports(fx.raw_viewings(spark, SF_TINY), fx.raw_apartments(spark, SF_TINY),
                                        fx.raw_attributes(spark, SF_TINY), "2025-06-28")
    assert daily_job._watched_report(spark, [watch], "2025-06-28", lambda: recount) is recount


def test_report_of_an_empty_table(spark):
    watch = qa.Watch("user_viewings", ["viewed_at"])
    empty = spark.createDataFrame([], schemas.VIEWINGS_DDL)
    qa.clean_viewings(empty, watch=watch).write.format("noop").mode("overwrite").save()
    assert [row[3:] for row in watch.report()] == [(0, 0, 0, 0)] * 5


# -- staged publish ----------------------------------------------------------------------
def _broken(df, column="id"):
    """Rows of which the last raise while they are written."""
    n = df.count()
    numbered = number_rows(df, [F.col(column)], "_k")
    bad = F.when(F.col("_k") < n - 1, F.col(column)).otherwise(F.raise_error(F.lit("broken row")).cast(df.schema[column].dataType))
    return numbered.repartition(4).withColumn(column, bad).drop("_k")


def test_a_failed_load_leaves_the_date_as_it_was(spark):
    table = f"{hq._database(spark)}.kpi"
    w.load_dated_table(spark, spark.range(50), table, "2025-06-27")
    w.load_dated_table(spark, spark.range(7), table, "2025-06-28")
    with pytest.raises(Exception, match="broken row"):
        w.load_dated_table(spark, _broken(spark.range(1000)), table, "2025-06-27")
    counts = {str(x["dt"]): x["count"] for x in spark.table(table).groupBy("dt").count().collect()}
    assert counts == {"2025-06-27": 50, "2025-06-28": 7}
    root = w._described(spark, table)
    assert len(w.list_names(spark, f"{root}/{w.LOADS}/2025-06-27")) == 1  # nothing of the failed load is left


def test_readers_of_the_replaced_load_can_finish_and_older_loads_go(spark):
    table = f"{hq._database(spark)}.kpi"
    w.load_dated_table(spark, spark.range(5), table, "2025-06-27")
    location = w._described(spark, table, "PARTITION (dt = DATE'2025-06-27')")
    w.load_dated_table(spark, spark.range(9), table, "2025-06-27")
    assert spark.read.parquet(location).count() == 5  # a reader that began before still finds its files
    assert spark.table(table).count() == 9
    for n in range(3):
        w.load_dated_table(spark, spark.range(n), table, "2025-06-27")
    assert spark.table(table).count() == 2
    assert len(w.list_names(spark, f"{w._described(spark, table)}/{w.LOADS}/2025-06-27")) == 2


def test_replaced_tables_are_never_empty_and_may_change_columns(spark):
    table = f"{hq._database(spark)}.dim"
    w.replace_table(spark, spark.range(5), table)
    with pytest.raises(Exception, match="broken row"):
        w.replace_table(spark, _broken(spark.range(100)), table)
    assert spark.table(table).count() == 5
    w.replace_table(spark, spark.range(8), table)
    assert spark.table(table).count() == 8
    w.replace_table(spark, spark.range(3).withColumn("name", F.lit("x")), table)
    assert spark.table(table).columns == ["id", "name"] and spark.table(table).count() == 3


# -- C9 across dates ------------------------------------------------------------------------
def test_earlier_keys_are_tested_by_a_runtime_bloom_filter(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0")
    silver, staged = scratch_path(spark, "t_across"), scratch_path(spark, "t_day")
    clean = r.viewings(spark, SF_TINY)
    for k, dt in enumerate(("2025-06-26", *jq.DATES)):
        w.write_dated(clean.where(F.col("user_id").cast("int") % 3 == k), silver, dt)
    w.write_dated(clean, staged, "2025-06-29")
    day = rd.read_silver(spark, staged, schemas.SILVER_VIEWINGS_DDL, "2025-06-29").select(*schemas.VIEWING_COLUMNS)
    fresh = history.new_viewings(spark, day, silver, "2025-06-28")
    text = plan(fresh)
    assert "might_contain" in text and "LeftSemi" in text and "LeftAnti" in text
    assert rows(fresh) == rows(clean.where(F.col("user_id").cast("int") % 3 == 2).select(*fresh.columns))


def test_a_rerun_of_a_date_gives_the_same_rows(spark):
    silver = scratch_path(spark, "t_again")
    opts = daily_job.JobOptions(across_dates=True, kpis=[], write_full_detail=False)
    raw, apartments, attributes = (fx.raw_viewings(spark, SF_TINY), fx.raw_apartments(spark, SF_TINY),
                                   fx.raw_attributes(spark, SF_TINY))
    first = raw.where("user_id % 2 = 0")
    for dt, day in (("2025-06-27", first), ("2025-06-28", raw), ("2025-06-28", raw), ("2025-06-27", first)):
        daily_job.run(spark, day, apartments, attributes, silver, dt, opts)
    got = rd.read_silver(spark, f"{silver}/user_viewings_cleaned", schemas.SILVER_VIEWINGS_DDL)
    clean = r.viewings(spark, SF_TINY)
    assert rows(got.select(*schemas.VIEWING_COLUMNS)) == rows(clean.select(*schemas.VIEWING_COLUMNS))
    assert got.where("dt = DATE'2025-06-28' AND user_id % 2 = 0").count() == 0


# -- merged cubes -----------------------------------------------------------------------------
def test_merged_kpis_read_no_viewing_and_take_any_dates(spark):
    silver = hq._silver(spark, SF_TINY, again=False, write_cube=True)
    merged = history.kpi_over_dates(spark, silver, "platform")
    files = merged.inputFiles()
    assert any("/engagement_cube/" in f for f in files) and not any("/user_viewings_cleaned/" in f for f in files)
    one = history.kpi_over_dates(spark, silver, "hour_summary", jq.DATES[1], jq.DATES[1])
    from viewstar.plans import kpis, model
    alone = qa.clean_viewings(jq.of_date(fx.raw_viewings(spark, SF_TINY), 1), drop_all_null=False)
    cube = model.engagement_cube(alone, r.cube_listing(spark, SF_TINY), None)
    assert rows(one) == rows(kpis.hour_summary(cube))


# -- calendar, buckets, footers ------------------------------------------------------------------
def test_calendar_dates_prune_folders_at_run_time(spark):
    silver, path = scratch_path(spark, "t_calendar"), scratch_path(spark, "t_days")
    for k in range(1, 6):
        w.write_dated(r.viewings(spark, SF_TINY), f"{silver}/user_viewings_cleaned", f"2025-06-0{k}")
    spark.range(1, 6).select(F.make_date(F.lit(2025), F.lit(6), "id").alias("dt"), (F.col("id") % 4).alias("turn")) \
        .write.parquet(path)
    got = history.viewings_on(spark, silver, spark.read.parquet(path), "turn = 0")
    assert "dynamicpruning" in plan(got)
    assert [str(x.dt) for x in got.select("dt").distinct().collect()] == ["2025-06-04"]


def test_bucketed_join_moves_no_viewing_and_keeps_hot_listings_apart(spark, conf):
    database, scratch = hq._database(spark), scratch_path(spark, "t_bucketed")
    fact = r.viewings(spark, SF_TINY)
    w.write_parquet(fact.unionByName(fact.withColumn("apartment_id", F.when(F.col("user_id") > "3", F.lit("7")))), f"{scratch}/f")
    w.write_parquet(r.listing(spark, SF_TINY), f"{scratch}/l")
    fact, listing = rd.read_parquet(spark, f"{scratch}/f"), rd.read_parquet(spark, f"{scratch}/l")
    hot = colocated.write_colocated(spark, fact, listing, database, 8)
    assert "7" in hot and len(hot) < 8
    got = colocated.full_detail(spark, database, hot)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" in text
    from viewstar.plans import model
    assert rows(got) == rows(model.full_detail(fact, listing).select(*got.columns))


def test_value_counts_come_from_footers(spark):
    silver = scratch_path(spark, "t_footers")
    clean = r.viewings(spark, SF_TINY)
    w.write_dated(clean, silver, "2025-06-27")
    w.write_dated(clean.drop("call_to_action").where("user_id > '5'"), silver, "2025-06-28")
    got = metadata.value_counts(spark, silver, schemas.VIEWING_COLUMNS, "dt")
    assert "PushedAggregation: [COUNT(*)" in plan(got)
    by_date = {str(x.dt): x for x in got.collect()}
    assert by_date["2025-06-27"].rows == by_date["2025-06-27"].call_to_action == clean.count()
    assert by_date["2025-06-28"].call_to_action == 0 < by_date["2025-06-28"].rows
    assert by_date["2025-06-27"].is_wishlisted == clean.where("is_wishlisted IS NOT NULL").count()
    flat = scratch_path(spark, "t_flat")
    w.write_parquet(clean.withColumn("nothing", F.lit(None).cast("int")), flat)
    assert metadata.all_null_columns(spark, flat) == ["nothing"]


def test_number_rows_in_a_hot_tie(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).alias("hot"), F.col("id").alias("place"), F.lit("x").alias("range"))
    got = number_rows(df, [F.col("hot")], "n", 5)
    assert sorted(x.n for x in got.collect()) == list(range(5, 3005))
    assert max(x.n for x in got.collect() if not x.hot) < min(x.n for x in got.collect() if x.hot)
