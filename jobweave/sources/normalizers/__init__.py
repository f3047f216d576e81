"""Payload normalisers: captured responses of one system in, standard postings out.

A normaliser takes payload DataFrames (``jobweave.schema.PAYLOADS``) by kind and returns
``jobweave.schema.JOBS_STD``.  ``NORMALIZERS`` maps a source name to its function and the
payload kinds it wants; ``register`` adds others.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from jobweave.sources.normalizers import feeds, html_pages, list_detail, lists, workday


class Normalizer(NamedTuple):
    function: Callable[..., DataFrame]
    kinds: tuple[str, ...]


NORMALIZERS: dict[str, Normalizer] = {
    "Jobicy": Normalizer(lists.jobicy, ("list",)),
    "Remotive": Normalizer(lists.remotive, ("list",)),
    "WeWorkRemotely": Normalizer(feeds.weworkremotely, ("feed",)),
    "Arbeitnow": Normalizer(lists.arbeitnow, ("list",)),
    "Greenhouse": Normalizer(lists.greenhouse, ("list",)),
    "Taleo": Normalizer(lists.taleo, ("list",)),
    "SuccessFactors": Normalizer(feeds.successfactors, ("list", "feed")),
    "Lever": Normalizer(lists.lever, ("list",)),
    "Ashby": Normalizer(lists.ashby, ("list",)),
    "SmartRecruiters": Normalizer(list_detail.smartrecruiters, ("list", "detail")),
    "Dayforce": Normalizer(lists.dayforce, ("list",)),
    "Recruitee": Normalizer(lists.recruitee, ("list",)),
    "Jobsoid": Normalizer(lists.jobsoid, ("list",)),
    "Freshteam": Normalizer(html_pages.freshteam, ("list", "detail")),
    "Personio": Normalizer(feeds.personio, ("feed",)),
    "PinpointHQ": Normalizer(feeds.pinpointhq, ("feed", "detail")),
    "OracleCloud": Normalizer(list_detail.oraclecloud, ("list", "detail")),
    "BambooHR": Normalizer(list_detail.bamboohr, ("list", "detail")),
    "JazzHR": Normalizer(html_pages.jazzhr, ("detail",)),
    "ApplicantPro": Normalizer(list_detail.applicantpro, ("list", "detail")),
    "iCIMS": Normalizer(html_pages.icims, ("detail",)),
    "BreezyHR": Normalizer(list_detail.breezyhr, ("list", "detail")),
    "CATSOne": Normalizer(html_pages.catsone, ("detail",)),
    "Workday": Normalizer(workday.workday, ("list", "detail")),
    "ZohoRecruit": Normalizer(html_pages.zohorecruit, ("list", "detail")),
}


def register(name: str, function: Callable[..., DataFrame], kinds: tuple[str, ...]) -> None:
    """Add a normaliser for another system."""
    NORMALIZERS[name] = Normalizer(function, kinds)
