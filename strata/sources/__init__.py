"""Sources and sinks (typed CSV, Parquet, publishing, manifests)."""

from strata.sources.files import (
    corrupt_counts,
    header_mismatches,
    ingest_csv,
    materialize,
    output_manifest,
    overwrite_partitions,
    publish_parquet,
    read_csv_checked,
    read_csv_typed,
    read_ingested,
    read_parquet,
    read_quarantine,
    recover,
    replace_dataset,
    write_colocated,
    write_parquet,
)
from strata.sources.layout import (
    generation_differences,
    read_clustered,
    read_generations,
    schema_differences,
    with_z_order,
    write_clustered,
)

__all__ = [
    "corrupt_counts",
    "generation_differences",
    "header_mismatches",
    "ingest_csv",
    "materialize",
    "output_manifest",
    "overwrite_partitions",
    "publish_parquet",
    "read_clustered",
    "read_csv_checked",
    "read_csv_typed",
    "read_generations",
    "read_ingested",
    "read_parquet",
    "read_quarantine",
    "recover",
    "replace_dataset",
    "schema_differences",
    "with_z_order",
    "write_clustered",
    "write_colocated",
    "write_parquet",
]
