"""A jobs-like batch and stored table derived from orders, customers, nations and regions.

Orders are postings, customers companies, nations places.  The batch is every order; the
stored table holds the finished ones.  References repeat every three orders and URLs
every two, and some are blank, so each branch of the key logic has rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobweave.queries.base import table

LOADED_AT = "2024-06-01 00:00:00"

_TITLES = {
    "1-URGENT": "Software Engineer",
    "2-HIGH": "Data Analyst",
    "3-MEDIUM": "Registered Nurse",
    "4-NOT SPECIFIED": "Account Manager",
    "5-LOW": "Cloud Architect",
}

_TITLE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _TITLES.items())

# column -> expression; {div} is the integer division of the dialect
_JOB = {
    "seq": "o_orderkey",
    "external_id": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE concat('R', o_orderkey {div} 3) END",
    "job_url": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN ''"
    " ELSE concat('https://jobs.example.com/u', o_orderkey {div} 2) END",
    "title": f"concat(CASE o_orderpriority {_TITLE} END, ' ', year(o_orderdate))",
    "company": "c_name",
    "location": "CASE r_name WHEN 'AMERICA' THEN concat(n_name, ', TX')"
    " WHEN 'ASIA' THEN concat(n_name, ', WA; Austin, TX')"
    " WHEN 'EUROPE' THEN concat(n_name, ', Germany')"
    " WHEN 'AFRICA' THEN 'Remote'"
    " ELSE concat(n_name, ', CA | ', n_name, ', NY') END",
    "description": "concat(c_mktsegment, CASE o_orderstatus WHEN 'F' THEN ' team, python and kubernetes'"
    " WHEN 'O' THEN ' team, customers first' ELSE ' team' END)",
    "job_type": "CASE o_orderstatus WHEN 'F' THEN 'Full-time' WHEN 'O' THEN 'Contract' ELSE '' END",
    "is_remote": "r_name = 'AFRICA'",
    "category": "CASE c_mktsegment WHEN 'MACHINERY' THEN 'engineering' WHEN 'HOUSEHOLD' THEN ''"
    " ELSE concat(c_mktsegment, ' operations and related services') END",
    "date_posted": "o_orderdate",
    "o_orderstatus": "o_orderstatus",
}

_STORED = {
    "row_id": "concat('e', seq)",
    "row_order": "seq",
    "job_reference": "external_id",
    "Location": "location",
    "Title": "title",
    "city": "CASE WHEN location LIKE '%;%' THEN location"
    " WHEN location LIKE '%|%' THEN concat('US Remote ', company)"
    " WHEN location LIKE '%, TX' THEN 'texas' END",
    "state": "CASE WHEN location LIKE '%, TX' THEN 'TX' END",
    "zip": "CAST(NULL AS {string})",
    "country": "'USA'",
    "job_type": "job_type",
    "posted_at": "date_posted",
    "company": "company",
    "Isremote": "CASE WHEN is_remote THEN 1 ELSE 0 END",
    "category": "category",
    "url": "job_url",
    "description": "description",
    "cpc": "CAST(0 AS DECIMAL(18,2))",
    "inserteddate": "date_posted",
    "IsIT": "CASE WHEN title LIKE 'Cloud%' THEN NULL ELSE FALSE END",
    "ITScore": "CASE WHEN title LIKE 'Cloud%' OR title LIKE 'Data%' THEN NULL ELSE 0 END",
}


def _select(columns: dict[str, str], **dialect: str) -> list[str]:
    return [f"{e.format(**dialect)} AS {c}" for c, e in columns.items()]


JOBS_CTE = (
    "jobs AS (SELECT " + ", ".join(_select(_JOB, div="//")) + " FROM orders "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey)"
)
STORED_CTE = (
    JOBS_CTE + ", stored AS (SELECT " + ", ".join(_select(_STORED, string="VARCHAR"))
    + " FROM jobs WHERE o_orderstatus = 'F')"
)


def jobs(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The batch.

    A scan has no more tasks with rows than its files have row groups, and every step up to the
    next shuffle, the parsing of pages included, would run in those few.  With ``spread`` the
    narrow orders are dealt out by their key first, for jobs whose costly step comes before one.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    if spread:
        orders = orders.repartition("o_orderkey")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    return joined.selectExpr(*_select(_JOB, div="div"))


def stored(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The stored table: 18 columns, a row id and a scan order."""
    finished = jobs(spark, sf_dir, spread).filter(F.col("o_orderstatus") == "F")
    return finished.selectExpr(*_select(_STORED, string="STRING"))
