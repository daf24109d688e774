"""File sources and sinks: typed CSV ingest, Parquet scan, overwrite and manifest."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.schemas import assert_contract
from strata.session import delete_paths, scratch_path


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    header: bool = True,
    sep: str = ",",
    escape: str = "\\",
    quote: str = '"',
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    check_header: bool = False,
) -> DataFrame:
    """CSV scan with a declared schema (no inference pass over the data).

    The header line is skipped, columns map by position. Values that do not
    fit their declared type become null in PERMISSIVE mode; with
    ``corrupt_column`` the raw line of such a row is kept in that column; all
    columns are then parsed whichever are selected, as a pruned column's bad
    value would go unseen. ``check_header`` makes the scan itself compare each
    file's header with the schema's names and fail on a difference (no second
    pass over the data).
    ``escape`` defaults to backslash: a field written with doubled quotes is
    then cut at its next separator. Files are split into blocks and read in
    parallel, as no multi-line option is used.
    """
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
    reader = (
        spark.read.format("csv")
        .schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("escape", escape)
        .option("quote", quote)
        .option("mode", mode)
        .option("enforceSchema", not check_header)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    df = reader.load(path)
    if not corrupt_column:
        return df
    # The scan parses the columns that a query reads; the corrupt column names
    # them all (adding nothing to it), so whoever reads it has all parsed.
    values = [F.col(f"`{f.name}`").cast("string") for f in schema.fields[:-1]]
    raw = F.col(f"`{corrupt_column}`")
    nothing = F.left(F.concat_ws("", *values), F.lit(0))
    return df.withColumn(corrupt_column, F.when(raw.isNotNull(), F.concat(raw, nothing)))


def header_mismatches(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """Files whose header names differ from the declared schema.

    Names the files after a scan with ``check_header`` has failed: one row per
    mismatching file. It scans the text of all files, so it is a diagnosis, not
    a step of the ingest.
    """
    expected = sep.join(field.name for field in schema.fields)
    # The header is in the split that starts at byte 0 of its file; inside one
    # split, monotonically_increasing_id grows in reading order.
    lines = (
        spark.read.format("text")
        .load(path)
        .select(
            F.col("value").alias("header"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("line_id"),
        )
        .filter(F.col("block_start") == 0)
    )
    first = lines.groupBy("file_path").agg(F.min_by("header", "line_id").alias("header"))
    return first.filter(F.col("header") != F.lit(expected))


def corrupt_counts(df: DataFrame, corrupt_column: str) -> DataFrame:
    """Number of rows, and of rows with an unparsable field."""
    return df.select(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(corrupt_column)).alias("corrupt_rows"),
    )


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet scan of a dataset directory (all part files, not one of them)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    max_records_per_file: int | None = None,
    options: dict[str, str] | None = None,
) -> str:
    """Parquet sink; ``overwrite`` replaces the whole dataset.

    Executors write their partitions in parallel; the directory is the unit,
    not a single part file. ``partition_by`` enables partition pruning for
    later readers, ``max_records_per_file`` bounds file sizes; ``options`` go to
    Parquet's writer.
    """
    writer = df.write.mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return path


# ---- publishing: written aside, then put in place ---------------------------------------


def _store(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes its paths."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def recover(spark: SparkSession, path: str) -> bool:
    """Put back a dataset whose replacement stopped between its two renames.
    True if there was one."""
    fs, make = _store(spark, path)
    if fs.exists(make(path)):
        return False
    aside = fs.globStatus(make(f"{path}.replaced-*"))
    if not aside:
        return False
    return fs.rename(aside[0].getPath(), make(path))


def replace_dataset(spark: SparkSession, staged: str, path: str) -> None:
    """Put the dataset at ``staged`` in the place of the one at ``path``.

    Two renames, the old one's first; if the second fails the old one is put
    back. Readers see the old files or the new ones, never a part of either.
    On stores where a rename copies, it isn't one step.
    """
    fs, make = _store(spark, path)
    recover(spark, path)
    aside = f"{path}.replaced-{uuid.uuid4().hex}"
    had = fs.exists(make(path))
    fs.mkdirs(make(path).getParent())
    if had and not fs.rename(make(path), make(aside)):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(make(staged), make(path)):
        if had:
            fs.rename(make(aside), make(path))
        raise OSError(f"can't put {staged} in the place of {path}")
    if had:
        delete_paths(spark, [aside])


@contextmanager
def _staged(spark: SparkSession, path: str) -> Iterator[str]:
    """A place beside ``path`` to write to, gone afterwards whatever happens."""
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        yield staged
    finally:
        delete_paths(spark, [staged])


def publish_parquet(
    df: DataFrame,
    path: str,
    *,
    contract: StructType | None = None,
    partition_by: list[str] | None = None,
    max_records_per_file: int | None = None,
    options: dict[str, str] | None = None,
) -> str:
    """Replace the dataset at ``path`` with ``df``, or leave it as it was.

    The schema is checked against ``contract``, the rows are written beside the
    dataset and put in its place when the write is done: a job that fails, at
    whatever row, leaves the old dataset whole. ``df`` may read ``path`` itself.
    """
    if contract is not None:
        assert_contract(df.schema, contract)
    spark, path = df.sparkSession, path.rstrip("/")
    with _staged(spark, path) as staged:
        write_parquet(df, staged, partition_by=partition_by, max_records_per_file=max_records_per_file, options=options)
        replace_dataset(spark, staged, path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], contract: StructType | None = None) -> str:
    """Replace only those partitions of the dataset at ``path`` that ``df`` has
    rows of. Spark writes them aside and moves them when the job commits."""
    if contract is not None:
        assert_contract(df.schema, contract)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return path


def write_colocated(df: DataFrame, name: str, path: str, by: str, buckets: int) -> DataFrame:
    """``df`` written as a table of ``buckets`` buckets by ``by``, sorted in each,
    and read again.

    Tables with equal bucket counts join on ``by`` without moving a row. The
    bucketing is known to the catalog, so another session has to register the
    table (``name`` at ``path``) with the same clauses. Choose ``buckets`` so
    that one is some 256 MB; a key with more than that makes its bucket larger.
    """
    spark = df.sparkSession
    # One task per bucket, so that a bucket is one file.
    dealt = df.repartition(buckets, by)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, by).sortBy(by).format("parquet").saveAsTable(name)
    return spark.table(name)


# ---- ingest with a quarantine ------------------------------------------------------------

REJECT = "_reject"
REJECT_TYPE = "struct<line: string, reason: string>"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, **csv_options) -> DataFrame:
    """``read_csv_typed`` with one more column ``_reject``: null for a row that
    parses, else its line and the reason.

    The reason is ``number of fields``, or the fields whose text isn't of their
    type, with it. Only rejected lines are taken apart once more for it.
    """
    raw = "__line"
    read = read_csv_typed(spark, path, schema, corrupt_column=raw, **csv_options)
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields) + ", `__short` string"
    options = {"columnNameOfCorruptRecord": "__short", "mode": "PERMISSIVE"}
    options |= {k: csv_options.get(k, default) for k, default in (("sep", ","), ("escape", "\\"), ("quote", '"'))}
    texts = F.from_csv(F.col(raw), ddl, options)
    misfits = [
        F.when(texts.getField(f.name).isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name} is not {f.dataType.simpleString()}"))
        for f in schema.fields
    ]
    reason = F.when(texts.getField("__short").isNotNull(), F.lit("number of fields")).otherwise(F.concat_ws(", ", *misfits))
    reject = F.when(F.col(raw).isNotNull(), F.struct(F.col(raw).alias("line"), reason.alias("reason")))
    return read.withColumn(REJECT, reject).drop(raw)


def ingest_csv(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    quarantine: str,
    max_rejects: int | None = None,
    **csv_options,
) -> dict[str, int]:
    """CSV to two Parquet datasets in one pass: the rows that parse go to
    ``target``, the others to ``quarantine`` as ``line, reason``.

    Returns ``rows`` and ``rejects``, counted while writing (``observe``). Both
    datasets are written beside their places and put there at the end. With more
    than ``max_rejects`` rejects only the quarantine is put in place, and the
    ingest fails.
    """
    target, quarantine = target.rstrip("/"), quarantine.rstrip("/")
    seen = Observation(f"ingest-{uuid.uuid4().hex}")
    rows = read_csv_checked(spark, source, schema, **csv_options)
    rows = rows.withColumn("__rejected", F.col(REJECT).isNotNull())
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("__rejected").alias("rejects"))
    with _staged(spark, target) as staged:
        # One column tells the datasets apart, as folders of one write.
        rows.write.partitionBy("__rejected").parquet(staged)
        counts = {k: int(v) for k, v in seen.get.items()}
        fs, make = _store(spark, staged)
        parts = {}
        for flag, where in ((False, target), (True, quarantine)):
            part = f"{staged}/__rejected={str(flag).lower()}"
            if not fs.exists(make(part)):
                # No such row: an empty dataset with the schema.
                spark.createDataFrame([], rows.drop("__rejected").schema).write.parquet(part)
            parts[where] = part
        replace_dataset(spark, parts[quarantine], quarantine)
        if max_rejects is not None and counts["rejects"] > max_rejects:
            raise ValueError(f"{counts['rejects']} unparsable rows in {source}; {max_rejects} are allowed (see {quarantine})")
        replace_dataset(spark, parts[target], target)
    return counts


def read_ingested(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows that parsed, in their declared columns."""
    return spark.read.schema(schema).parquet(target)


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """``line, reason`` of the rows that didn't."""
    return spark.read.schema(f"{REJECT} {REJECT_TYPE}").parquet(quarantine).select(f"{REJECT}.*")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and return the re-read data.

    For a frame that several branches of a plan read: Spark would recompute it
    per branch (column pruning makes the branches differ, so no exchange is
    shared). Writing it cuts the lineage as well, so a lost executor does not
    send the recomputation back to the sources. The written frame's schema is
    known, so the re-read skips inference.
    """
    spark = df.sparkSession
    path = write_parquet(df, scratch_path(spark, name))
    return spark.read.schema(df.schema).parquet(path)


def output_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of a written Parquet dataset: ``file_path, file_name, file_size, rows``.

    One row per file, those without rows included: the files come from a
    listing (their contents aren't read), the row counts from the metadata
    column of a scan that reads no data column.
    """
    def plain(c: str) -> Column:
        return F.regexp_replace(F.url_decode(F.col(c)), "^file:/+", "file:/")

    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(plain("path").alias("file_path"), F.col("length").alias("file_size"))
    )
    counted = (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("p"))
        .groupBy(plain("p").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    name = F.element_at(F.split("file_path", "/"), -1)
    return listed.join(counted, "file_path", "left").select(
        "file_path", name.alias("file_name"), "file_size", F.coalesce("rows", F.lit(0)).alias("rows")
    )
