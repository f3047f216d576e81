"""Archive export: every posting of validated sites, with its availability."""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobweave.operators import reports
from jobweave.operators.filters import validated_sites
from jobweave.schema import EXPORT_COLUMNS
from jobweave.session import cut_lineage
from jobweave.sources.catalog_csv import write_catalog_csv
from jobweave.sources.normalizers.workday import workday_export


def export_jobs(sites: DataFrame, lists: DataFrame, details: DataFrame, path: str, as_of,
                index_id: str = "") -> DataFrame:
    """Write the 29-column export of the validated sites and return its summary."""
    wanted = validated_sites(sites).select("domain", "site").distinct()
    rows = cut_lineage(
        workday_export(lists.join(wanted, ["domain", "site"], "left_semi"), details, as_of, index_id), "export"
    )
    write_catalog_csv(rows, path, EXPORT_COLUMNS)
    return reports.export_summary(rows)
