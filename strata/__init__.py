"""strata: layered (bronze / silver / gold) analytics as Spark DataFrame operators.

Every operator is a plain function returning a ``DataFrame`` (or a ``Column``
for the scalar helpers in ``strata.functions``) so that it composes with
``DataFrame.transform`` and stays inside Catalyst: no Python UDFs, no driver
side loops, no RDDs.

Sub-packages
------------
sources    CSV / Parquet readers and writers, output manifests
functions  column expressions (text clean-up, timestamps, measures)
operators  filters, dimension joins, ranking, sessionization, relations
plans      end-to-end pipelines and the driver-table query catalog
streaming  incremental (file-stream) variant of the bronze ingest
"""

from strata.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
