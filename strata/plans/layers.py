"""Layer jobs: each reads one layer's datasets and writes the next layer's.

Bronze ingests CSV with the declared schema into Parquet; silver cleans and
filters; gold joins, ranks and shapes. A job is a plain function of paths, so
any scheduler can run it, and a rerun replaces its output (idempotent). Outputs
are checked against their contract, written beside their place and put there
when the write is done, so a job that fails leaves the former dataset.
Datasets are directories; a later job reads all part files of its input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.plans import charge as charge_plans
from strata.plans import disaster as d
from strata.schemas import (
    COUNTRY_SCHEMA,
    EARTHQUAKE_SCHEMA,
    GOLD_EARTHQUAKE_SCHEMA,
    GOLD_TOP_TSUNAMI_SCHEMA,
    TSUNAMI_SCHEMA,
    assert_contract,
    silver_earthquake_schema,
    silver_tsunami_schema,
)
from strata.session import scratch_scope
from strata.sources.files import REJECT, ingest_csv, publish_parquet, read_csv_typed, read_parquet


@dataclass(frozen=True)
class Layout:
    """Dataset locations below one base folder (shared storage)."""

    base: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{name}"


# ---- bronze --------------------------------------------------------------------------


def bronze_job(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    max_corrupt_rows: int | None = None,
    quarantine: str | None = None,
    **csv_options,
) -> str:
    """CSV with a declared schema -> Parquet (whole dataset replaced).

    ``check_header=True`` fails on a file with other column names. With
    ``quarantine``, unparsable rows go to a dataset of that name with a reason
    each, in the same pass; more than ``max_corrupt_rows`` of them fail the job
    and leave the former bronze. Without it, ``corrupt_column`` keeps the raw
    line of such a row in bronze, and ``max_corrupt_rows`` counts them on the
    written data, where only that column is read.
    """
    if quarantine:
        csv_options.pop("corrupt_column", None)
        ingest_csv(spark, source, schema, target, quarantine, max_corrupt_rows, **csv_options)
        return target
    out = publish_parquet(read_csv_typed(spark, source, schema, **csv_options), target)
    column = csv_options.get("corrupt_column")
    if max_corrupt_rows is not None:
        if not column:
            raise ValueError("max_corrupt_rows needs a corrupt_column")
        corrupt = read_parquet(spark, out).filter(F.col(column).isNotNull()).count()
        if corrupt > max_corrupt_rows:
            raise ValueError(f"{corrupt} unparsable rows in {source}; {max_corrupt_rows} are allowed")
    return out


def _write(
    df: DataFrame, target: str, contract: StructType | None, year_of: str | None = None, partition_by: Sequence[str] = ()
) -> str:
    """Check the frame's schema against the contract, then publish it.
    ``year_of`` names a timestamp whose ``year`` becomes the partition."""
    if contract is not None:
        assert_contract(df.schema, contract)
    columns = list(partition_by)
    if year_of:
        df, columns = df.withColumn("year", F.year(year_of)), ["year", *columns]
    return publish_parquet(df, target, partition_by=columns or None)


def to_declared(df: DataFrame, schema: StructType) -> DataFrame:
    """Frame with exactly the declared fields, in order; absent fields are null.

    Values are converted with ``try_cast`` so that a value out of range
    becomes null, like a CSV field that does not fit its declared type.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


# ---- silver --------------------------------------------------------------------------


def _bronze(spark: SparkSession, path: str) -> DataFrame:
    """A bronze dataset without the column of an ingest with a quarantine, which
    is null in all its rows."""
    return read_parquet(spark, path).drop(REJECT)


def silver_country_job(
    spark: SparkSession, bronze: str, target: str, continent: str = d.CONTINENT, contract: StructType | None = None
) -> str:
    return _write(d.silver_country(_bronze(spark, bronze), continent), target, contract)


def silver_earthquake_job(
    spark: SparkSession,
    bronze: str,
    target: str,
    continent: str = d.CONTINENT,
    first_year: int = d.FIRST_YEAR,
    last_year: int = d.LAST_YEAR,
    by_year: bool = False,
    ntz: bool = True,
    contract: StructType | None = None,
) -> str:
    """Silver earthquakes; ``by_year`` partitions by the year of ``time_stamp``."""
    silver = d.silver_earthquake(_bronze(spark, bronze), continent, first_year, last_year, ntz=ntz)
    return _write(silver, target, contract, "time_stamp" if by_year else None)


def silver_tsunami_job(
    spark: SparkSession,
    bronze: str,
    target: str,
    first_year: int = d.FIRST_YEAR,
    last_year: int = d.LAST_YEAR,
    by_year: bool = False,
    partition_by: Sequence[str] = (),
    ntz: bool = True,
    contract: StructType | None = None,
) -> str:
    """Silver tsunamis; ``by_year`` partitions by the year of ``time_stamp`` (the
    date parts are gone by then), ``partition_by`` by columns of the result."""
    silver = d.silver_tsunami(_bronze(spark, bronze), first_year, last_year, ntz=ntz)
    return _write(silver, target, contract, "time_stamp" if by_year else None, partition_by)


# ---- gold ----------------------------------------------------------------------------


def gold_topk_job(
    spark: SparkSession, silver_tsunami: str, silver_country: str, target: str, k: int = 3, contract: StructType | None = None
) -> str:
    """Rows of the k countries hit most often, from the silver datasets."""
    with scratch_scope(spark):
        matched = d.tsunamis_in(
            d.gold_tsunami(read_parquet(spark, silver_tsunami)), d.countries_of(read_parquet(spark, silver_country))
        )
        return _write(d.top_detail(matched, k), target, contract)


def gold_earthquake_job(
    spark: SparkSession, silver_earthquake: str, silver_country: str, target: str, contract: StructType | None = None
) -> str:
    with scratch_scope(spark):
        quakes = d.earthquakes_in(read_parquet(spark, silver_earthquake), d.countries_of(read_parquet(spark, silver_country)))
        return _write(quakes, target, contract)


def gold_charge_job(
    spark: SparkSession,
    start_requests: str,
    start_responses: str,
    stop_requests: str,
    meter_values: str,
    target: str,
    order: Sequence[str] = ("timestamp",),
    split: str = "rows",
    ranges: int | None = None,
    contract: StructType | None = None,
) -> str:
    with scratch_scope(spark):
        records = charge_plans.charge_records(
            read_parquet(spark, start_requests),
            read_parquet(spark, start_responses),
            read_parquet(spark, stop_requests),
            read_parquet(spark, meter_values),
            order=order,
            split=split,
            ranges=ranges,
        )
        return _write(records, target, contract)


# ---- the disaster flow ---------------------------------------------------------------


def run_disaster_layers(
    spark: SparkSession,
    sources: dict[str, str],
    layout: Layout,
    continent: str = d.CONTINENT,
    first_year: int = d.FIRST_YEAR,
    last_year: int = d.LAST_YEAR,
    k: int = 3,
    schemas: dict[str, StructType] | None = None,
    by_year: bool = False,
    quarantine: bool = False,
    max_corrupt_rows: int | None = None,
    **csv_options,
) -> dict[str, str]:
    """Bronze, silver and gold for the sources ``country``, ``earthquake`` and
    ``tsunami`` (CSV folders). Returns the written dataset paths.

    ``schemas`` replaces declared layouts, ``by_year`` partitions the silver
    facts, ``quarantine`` keeps unparsable rows apart (``quarantine/<name>``, at
    most ``max_corrupt_rows`` a source), ``csv_options`` go to ``bronze_job``
    (header and corrupt-row checks). Each silver and gold dataset is held to its
    contract, which follows from the bronze layouts.
    """
    out: dict[str, str] = {}
    declared = {"country": COUNTRY_SCHEMA, "earthquake": EARTHQUAKE_SCHEMA, "tsunami": TSUNAMI_SCHEMA}
    schemas = {**declared, **(schemas or {})}
    for name, schema in schemas.items():
        if name in sources:
            apart = layout.path("quarantine", name) if quarantine else None
            out[f"bronze/{name}"] = bronze_job(
                spark, sources[name], schema, layout.path("bronze", name), max_corrupt_rows, apart, **csv_options
            )
            if apart:
                out[f"quarantine/{name}"] = apart
    # What an ingest keeps besides the declared columns stays in bronze.
    extra = [StructField(csv_options["corrupt_column"], StringType())] if csv_options.get("corrupt_column") and not quarantine else []
    bronze = {name: StructType(schema.fields + extra) for name, schema in schemas.items()}
    out["silver/country"] = silver_country_job(
        spark, out["bronze/country"], layout.path("silver", "country"), continent, bronze["country"]
    )
    if "bronze/earthquake" in out:
        out["silver/earthquake"] = silver_earthquake_job(
            spark, out["bronze/earthquake"], layout.path("silver", "earthquake"), continent, first_year, last_year, by_year,
            contract=silver_earthquake_schema(bronze["earthquake"]),
        )
        out["gold/earthquake"] = gold_earthquake_job(
            spark, out["silver/earthquake"], out["silver/country"], layout.path("gold", "earthquake"), GOLD_EARTHQUAKE_SCHEMA
        )
    if "bronze/tsunami" in out:
        out["silver/tsunami"] = silver_tsunami_job(
            spark, out["bronze/tsunami"], layout.path("silver", "tsunami"), first_year, last_year, by_year,
            contract=silver_tsunami_schema(bronze["tsunami"]),
        )
        out["gold/top_tsunami"] = gold_topk_job(
            spark, out["silver/tsunami"], out["silver/country"], layout.path("gold", "top_tsunami"), k, GOLD_TOP_TSUNAMI_SCHEMA
        )
    return out


def main(argv: list[str] | None = None) -> dict[str, str]:
    """Command line: run the disaster layers for CSV folders into a base folder.

    ``python -m strata.plans.layers --base BASE --country DIR --earthquake DIR
    --tsunami DIR [--continent Asia --first-year 1995 --last-year 2023 --k 3]
    [--check-header --corrupt-column NAME --quarantine --max-corrupt-rows N --by-year]``
    """
    import argparse

    from strata.session import build_session

    parser = argparse.ArgumentParser(description="bronze -> silver -> gold for the disaster datasets")
    parser.add_argument("--base", required=True, help="output base folder (shared storage)")
    parser.add_argument("--country", required=True, help="folder of city CSV files")
    parser.add_argument("--earthquake", help="folder of earthquake CSV files")
    parser.add_argument("--tsunami", help="folder of tsunami CSV files")
    parser.add_argument("--continent", default=d.CONTINENT)
    parser.add_argument("--first-year", type=int, default=d.FIRST_YEAR)
    parser.add_argument("--last-year", type=int, default=d.LAST_YEAR)
    parser.add_argument("--k", type=int, default=3)
    parser.add_argument("--check-header", action="store_true", help="fail on a file with other column names")
    parser.add_argument("--corrupt-column", help="bronze column that keeps the line of an unparsable row")
    parser.add_argument("--quarantine", action="store_true", help="keep unparsable rows in quarantine/ with a reason each")
    parser.add_argument("--max-corrupt-rows", type=int, help="fail on more unparsable rows in a source")
    parser.add_argument("--by-year", action="store_true", help="partition the silver facts by year")
    args = parser.parse_args(argv)
    sources = {name: getattr(args, name) for name in ("country", "earthquake", "tsunami") if getattr(args, name)}
    spark = build_session()
    out = run_disaster_layers(
        spark, sources, Layout(args.base), args.continent, args.first_year, args.last_year, args.k, by_year=args.by_year,
        quarantine=args.quarantine, max_corrupt_rows=args.max_corrupt_rows, check_header=args.check_header,
        **({"corrupt_column": args.corrupt_column} if args.corrupt_column else {}),
    )
    for name, path in out.items():
        print(f"{name}\t{path}")
    return out


if __name__ == "__main__":
    main()
