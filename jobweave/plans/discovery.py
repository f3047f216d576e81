"""Catalogue jobs: from archived URLs or stored job URLs to validated sites."""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobweave.operators import discovery, reports
from jobweave.schema import DISCOVERY_COLUMNS
from jobweave.sources.catalog_csv import write_catalog_csv


def discover_sites(urls: DataFrame, known: DataFrame, skip: DataFrame, lists: DataFrame, details: DataFrame,
                   order: str, index_id: str, skip_known: bool = True) -> DataFrame:
    """Validated catalogue rows of archived URLs (columns ``url`` and ``order``)."""
    found = discovery.candidates(urls, "url", order)
    picked = discovery.exclude(found, known if skip_known else None, skip)
    return discovery.validate(discovery.flag_known(picked, known), lists, details, index_id)


def seed_sites(urls: DataFrame, known: DataFrame, skip: DataFrame, order: str) -> DataFrame:
    """Candidates rebuilt from stored job URLs."""
    found = discovery.candidates(urls, "url", order, discovery.seed_candidate)
    return discovery.exclude(found, known, skip)


def publish(sites: DataFrame, path: str) -> DataFrame:
    """Write the catalogue file and return its summary."""
    write_catalog_csv(sites, path, DISCOVERY_COLUMNS)
    return reports.discovery_summary(sites)
