"""The dated job: clean -> silver -> star model -> KPI tables.

Shape of the work at scale:

* each raw table is cleaned once and written as a silver Parquet table; all
  later steps read the silver files (lineage cut, column pruning, a lost
  executor recomputes from files, not from the raw scan);
* the viewing fact is folded once into the engagement cube (partial
  aggregation before the shuffle absorbs hot keys), joined to the narrow
  listing columns, and written as Parquet to the shared checkpoint folder;
  every KPI is a rollup of that cube;
* only the full-detail table joins the fact row by row: the listing side is
  broadcast when its measured size allows, otherwise a shuffle join with
  AQE skew splitting;
* dated outputs use dynamic partition overwrite, so a rerun replaces its
  own date and nothing else;
* outputs that do not depend on each other (the three silver tables, then
  the KPI tables and the full detail) are submitted as concurrent Spark jobs,
  so small rollups fill the slots a single job leaves idle.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.session import get_session, remove_path, scratch_path
from viewstar.operators import quality as qa
from viewstar.operators.joins import DEFAULT_BROADCAST_BYTES
from viewstar.operators.engagement import fact_cube
from viewstar.plans import history, kpis, model
from viewstar.sinks import writers as w
from viewstar.sources import readers as rd


@dataclass
class JobOptions:
    dedup_keys: Sequence[str] = schemas.VIEWING_KEY
    drop_sentinel: bool = False
    max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES
    write_full_detail: bool = True
    kpis: Sequence[str] = field(default_factory=lambda: ["apartment_performance", *kpis.KPIS])
    # Independent outputs written at once (1 = one after another).
    parallel_writes: int = 4
    write_quality_report: bool = True
    # Leave out viewings whose key an earlier date's silver already holds (dated runs).
    across_dates: bool = False
    # Keep the date's engagement cube, so KPIs over many dates read no viewing (history.kpi_over_dates).
    write_cube: bool = False


def run_all(steps: dict[str, Callable[[], None]], workers: int) -> None:
    """Run independent write steps as concurrent Spark jobs (``workers`` at a
    time; 1 = one after another), then raise the first failure, if any,
    after every step has finished."""
    with ThreadPoolExecutor(max_workers=max(workers, 1), thread_name_prefix="viewstar-write") as pool:
        futures = [pool.submit(step) for step in steps.values()]
    for fut in futures:
        fut.result()


def quality_reports(raw_viewings: DataFrame, raw_apartments: DataFrame, raw_attributes: DataFrame,
                    dt: str | None, dedup_keys: Sequence[str] = schemas.VIEWING_KEY) -> DataFrame:
    """The run's quality report from the raw tables alone: a row per table and column, one aggregate per table."""
    viewings = qa.to_boolean(qa.normalise_timestamps(raw_viewings, ["viewed_at"]), ["is_wishlisted"])
    apartments = qa.to_boolean(qa.normalise_timestamps(raw_apartments, qa.LISTING_TIMES), ["is_active"])
    return (qa.quality_report(viewings, "user_viewings", dedup_keys, ["viewed_at"], dt)
            .unionByName(qa.quality_report(apartments, "apartments", schemas.LISTING_KEY, qa.LISTING_TIMES, dt))
            .unionByName(qa.quality_report(raw_attributes, "apartment_attributes", schemas.LISTING_KEY, (), dt)))


def _watched_report(spark: SparkSession, watches: Sequence[qa.Watch], dt: str | None,
                    recount: Callable[[], DataFrame]) -> DataFrame:
    """The report the silver writes took along; counted again from the raw tables if a lost executor spoilt it."""
    reports = [w.report(dt) for w in watches]
    if any(rows is None for rows in reports):
        return recount()
    return spark.createDataFrame([row for rows in reports for row in rows], qa.REPORT_DDL)


def clean_to_silver(spark: SparkSession, raw_viewings: DataFrame, raw_apartments: DataFrame,
                    raw_attributes: DataFrame, silver: str, dt: str | None,
                    opts: JobOptions) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean the three raw tables, write them, and return them read back with their declared schemas.

    A column null throughout is dropped from what this run writes (C6); the
    declared schema reads it as null, on this date and beside other dates.
    The quality report is counted while the tables are written, so each raw
    table is parsed once.
    """
    watches = [qa.Watch("user_viewings", ["viewed_at"]), qa.Watch("apartments", qa.LISTING_TIMES),
               qa.Watch("apartment_attributes")] if opts.write_quality_report else [None] * 3

    def viewings_step():
        clean = qa.clean_viewings(raw_viewings, opts.dedup_keys, drop_sentinel=opts.drop_sentinel, watch=watches[0])
        path = f"{silver}/user_viewings_cleaned"
        if not (opts.across_dates and dt):
            return _write(clean, path, dt)
        staged = scratch_path(spark, "day")
        try:
            w.write_dated(clean, staged, dt)
            day = rd.read_silver(spark, staged, schemas.SILVER_VIEWINGS_DDL, dt).select(*clean.columns)
            _write(history.new_viewings(spark, day, path, dt, opts.dedup_keys), path, dt)
        finally:
            remove_path(spark, staged)
    run_all({
        "user_viewings_cleaned": viewings_step,
        "apartments_cleaned": lambda: w.write_parquet(
            qa.clean_apartments(raw_apartments, watch=watches[1]), f"{silver}/apartments_cleaned"),
        "apartment_attributes_cleaned": lambda: w.write_parquet(
            qa.clean_attributes(raw_attributes, watch=watches[2]), f"{silver}/apartment_attributes_cleaned"),
    }, opts.parallel_writes)
    if opts.write_quality_report:
        report = _watched_report(spark, watches, dt, lambda: quality_reports(
            raw_viewings, raw_apartments, raw_attributes, dt, opts.dedup_keys))
        _write(report.drop("dt"), f"{silver}/quality_report", dt)
    fact = rd.read_silver(spark, f"{silver}/user_viewings_cleaned", schemas.SILVER_VIEWINGS_DDL, dt, dt is not None)
    return (fact.drop("dt"),
            rd.read_silver(spark, f"{silver}/apartments_cleaned", schemas.SILVER_APARTMENTS_DDL, dated=False),
            rd.read_silver(spark, f"{silver}/apartment_attributes_cleaned", schemas.SILVER_ATTRIBUTES_DDL, dated=False))


def _write(df: DataFrame, path: str, dt: str | None) -> None:
    w.write_dated(df, path, dt) if dt else w.write_parquet(df, path)


def run(spark: SparkSession, raw_viewings: DataFrame, raw_apartments: DataFrame,
        raw_attributes: DataFrame, silver: str, dt: str | None = None,
        opts: JobOptions | None = None) -> dict[str, str]:
    """Run one date (or, without ``dt``, the undated variant); returns {table name: path} of everything written."""
    opts = opts or JobOptions()
    fact, apartments, attributes = clean_to_silver(
        spark, raw_viewings, raw_apartments, raw_attributes, silver, dt, opts)
    # The listing dimension and the cube are written once as Parquet in the
    # shared checkpoint folder and read back: the lineage is cut (a lost
    # executor re-reads files), each is computed once, and each KPI reads only
    # the columns it uses.  Both go when the run ends, failed or not.
    scratch = scratch_path(spark, "daily_job")
    try:
        listing = model.listing_dim(apartments, attributes, None)
        w.write_parquet(listing, f"{scratch}/listing")
        listing = spark.read.schema(listing.schema).parquet(f"{scratch}/listing")
        if opts.write_cube:
            path = f"{silver}/engagement_cube"
            _write(fact_cube(fact), path, dt)
            kept = rd.read_silver(spark, path, history.CUBE_DDL, dt, dt is not None).drop("dt")
            cube = model.with_listing(kept, listing, opts.max_broadcast_bytes)
        else:
            cube = model.engagement_cube(fact, listing, opts.max_broadcast_bytes)
        w.write_parquet(cube, f"{scratch}/cube")
        return _outputs(spark, fact, listing, spark.read.schema(cube.schema).parquet(f"{scratch}/cube"), silver, dt, opts)
    finally:
        remove_path(spark, scratch)


def _outputs(spark: SparkSession, fact: DataFrame, listing: DataFrame, cube: DataFrame, silver: str,
             dt: str | None, opts: JobOptions) -> dict[str, str]:
    written = {
        "user_viewings_cleaned": f"{silver}/user_viewings_cleaned",
        "apartments_cleaned": f"{silver}/apartments_cleaned",
        "apartment_attributes_cleaned": f"{silver}/apartment_attributes_cleaned",
    }
    if opts.write_quality_report:
        written["quality_report"] = f"{silver}/quality_report"
    if opts.write_cube:
        written["engagement_cube"] = f"{silver}/engagement_cube"
    # Plans are built inside the steps, so their analysis overlaps too; the
    # longest write (the row-level full detail) starts first.
    steps: dict[str, Callable[[], None]] = {}
    if opts.write_full_detail:
        path = f"{silver}/viewings_full_detail"
        steps["viewings_full_detail"] = lambda path=path: _write(
            model.full_detail(fact, listing, opts.max_broadcast_bytes, cube), path, dt)
        written["viewings_full_detail"] = path
    for name in opts.kpis:
        path = f"{silver}/kpi_{name}"

        def kpi_step(name=name, path=path):
            table = (kpis.apartment_performance(cube, listing) if name == "apartment_performance"
                     else kpis.KPIS[name](cube))
            _write(table, path, dt)
        steps[f"kpi_{name}"] = kpi_step
        written[f"kpi_{name}"] = path
    run_all(steps, opts.parallel_writes)
    return written


def run_from_landing(spark: SparkSession, landing: str, silver: str, dt: str | None = None,
                     opts: JobOptions | None = None) -> dict[str, str]:
    """The original layout: listings as JSON batches, viewings in ``dt=`` folders.

    Land viewings by arrival date (``land_by_date(..., arrival_date=...)``), so
    those with unreadable times travel with their date; landed by event date
    they would lie under no date, and only a run without ``dt`` reads them.
    """
    viewings = rd.read_viewings_for_date(spark, f"{landing}/user_viewings", dt).drop("dt")
    apartments = rd.read_json(spark, f"{landing}/apartments", schemas.APARTMENTS_DDL)
    attributes = rd.read_json(spark, f"{landing}/apartment_attributes", schemas.ATTRIBUTES_DDL)
    return run(spark, viewings, apartments, attributes, silver, dt, opts)


def load_warehouse(spark: SparkSession, silver: str, database: str, dt: str, location: str | None = None,
                   kpi_names: Sequence[str] | None = None, workers: int = 4) -> list[str]:
    """The warehouse step after a dated run, as one call: two dimensions truncated and loaded, the two
    facts' date replaced, each KPI's date replaced.  Returns the table names.

    Every table is written beside what readers see and then switched, so a
    load that fails leaves that table as it was.

    The facts are loaded per date, so loading a date again leaves one copy
    (plain appending, as the original did, is ``load_table(..., "append")``).
    """
    w.create_database(spark, database, location)
    dims = {"dim_apartments": ("apartments_cleaned", schemas.SILVER_APARTMENTS_DDL),
            "dim_apartment_attributes": ("apartment_attributes_cleaned", schemas.SILVER_ATTRIBUTES_DDL)}
    facts = {"fact_user_viewings": ("user_viewings_cleaned", schemas.SILVER_VIEWINGS_DDL),
             "fact_viewings_full_detail": ("viewings_full_detail", schemas.FULL_DETAIL_DDL)}
    steps: dict[str, Callable[[], None]] = {}
    for table, (name, ddl) in dims.items():
        steps[table] = lambda table=table, name=name, ddl=ddl: w.replace_table(
            spark, rd.read_silver(spark, f"{silver}/{name}", ddl, dated=False), f"{database}.{table}")
    for table, (name, ddl) in facts.items():
        steps[table] = lambda table=table, name=name, ddl=ddl: w.load_dated_table(
            spark, rd.read_silver(spark, f"{silver}/{name}", ddl, dt).drop("dt"), f"{database}.{table}", dt)
    for name in kpi_names if kpi_names is not None else JobOptions().kpis:
        steps[f"kpi_{name}"] = lambda name=name: w.load_dated_table(
            spark, rd.read_parquet(spark, f"{silver}/kpi_{name}").where(F.col("dt") == F.lit(dt).cast("date")).drop("dt"),
            f"{database}.kpi_{name}", dt)
    run_all(steps, workers)
    return list(steps)


def main(argv: Sequence[str] | None = None) -> None:
    """spark-submit entry point: --landing, --silver, optional --dt, --warehouse-database, --two-column-key."""
    parser = argparse.ArgumentParser(description="Clean one date of viewings and write its KPI tables.")
    parser.add_argument("--landing", required=True, help="folder with user_viewings, apartments, apartment_attributes")
    parser.add_argument("--silver", required=True, help="output folder")
    parser.add_argument("--dt", help="run date, YYYY-MM-DD; without it all landed viewings, undated outputs")
    parser.add_argument("--warehouse-database", help="also load the outputs of --dt into this database")
    parser.add_argument("--two-column-key", action="store_true", help="dedup viewings on user and listing only")
    args = parser.parse_args(argv)
    if args.warehouse_database and not args.dt:
        parser.error("--warehouse-database needs --dt")
    spark = get_session()
    opts = JobOptions(dedup_keys=schemas.VIEWING_KEY_TWO if args.two_column_key else schemas.VIEWING_KEY)
    run_from_landing(spark, args.landing, args.silver, args.dt, opts)
    if args.warehouse_database:
        load_warehouse(spark, args.silver, args.warehouse_database, args.dt)


if __name__ == "__main__":
    main()
