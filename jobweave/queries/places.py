"""City and state of locations by a list of places."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave.operators.places import with_places
from jobweave.queries.base import query, table

# Places: every nation is a city of its region, and every market segment a city of each region
# it has customers in.  A region's code is its first two letters.
_PLACES = """places AS (
    SELECT n_name AS city, r_name AS state, left(r_name, 2) AS code FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION SELECT c_mktsegment || ' Park', r_name, left(r_name, 2) FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE c_custkey % 3 = 0)"""
# Ten ways to write a location; the other region is the one after the customer's.
_LOCATIONS = """located AS (
    SELECT c_custkey, CASE c_custkey % 10
        WHEN 0 THEN n_name || ', ' || code WHEN 1 THEN n_name || ' ' || lower(r_name) || ', US' WHEN 2 THEN 'Remote - ' || r_name
        WHEN 3 THEN c_mktsegment || ' park, ' || r_name WHEN 4 THEN c_mktsegment || ' Park' WHEN 5 THEN lower(n_name) || ' (' || lower(code) || ')'
        WHEN 6 THEN n_name || ' / ' || other WHEN 7 THEN code || ' | ' || upper(n_name) || ' | ' || c_mktsegment || ' Park'
        WHEN 8 THEN 'somewhere' ELSE n_name || ' as well' END AS location
    FROM (SELECT customer.*, n_name, r.r_name, left(r.r_name, 2) AS code, o.r_name AS other
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r.r_regionkey
        JOIN region o ON o.r_regionkey = (n_regionkey + 1) % 5))"""
_WORDS = r"list_filter(regexp_split_to_array({}, '[^\p{{L}}\p{{Nd}}]+'), lambda w: w <> '')"


def _key(x: str) -> str:
    return f"lower(array_to_string({_WORDS.format(x)}, ' '))"


_SQL = f"""WITH {_PLACES}, {_LOCATIONS},
    words AS (SELECT DISTINCT location, {_WORDS.format('location')} AS w FROM located),
    runs AS (SELECT location, len(w) AS total, pos, n, array_to_string(w[pos + 1:pos + n], ' ') AS raw
        FROM words, unnest([1, 2, 3, 4]) AS s(n), unnest(range(len(w))) AS p(pos) WHERE pos + n <= len(w)),
    named AS (
        SELECT location, pos, n, code FROM runs JOIN (SELECT DISTINCT {_key('state')} AS name, code FROM places) ON name = lower(raw)
        UNION SELECT location, pos, n, p.code FROM runs JOIN (SELECT DISTINCT code FROM places) p ON lower(p.code) = lower(raw)
        WHERE raw = upper(raw) OR pos + n = total),
    options AS (
        SELECT location, pos, n, code, city, count(*) OVER (PARTITION BY location, pos, n) AS homonyms
        FROM runs JOIN (SELECT {_key('city')} AS name, code, min(city) AS city FROM places GROUP BY 1, 2) ON name = lower(raw)),
    ranked AS (
        SELECT o.*, count(s.code) AS outside, coalesce(bool_or(s.code = o.code), FALSE) AS agrees
        FROM options o LEFT JOIN named s ON s.location = o.location AND (s.pos >= o.pos + o.n OR s.pos + s.n <= o.pos) GROUP BY ALL),
    best AS (
        SELECT location, city, code FROM ranked WHERE agrees OR (homonyms = 1 AND outside = 0)
        QUALIFY row_number() OVER (PARTITION BY location ORDER BY agrees DESC, n DESC, pos, code, city) = 1),
    states AS (SELECT location, code FROM named QUALIFY row_number() OVER (PARTITION BY location ORDER BY n DESC, pos, code) = 1)
    SELECT c_custkey, located.location, best.city, coalesce(best.code, states.code) AS state
    FROM located LEFT JOIN best USING (location) LEFT JOIN states USING (location)"""


def _places(s, d):
    nation, region = table(s, d, "nation"), table(s, d, "region")
    regions = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "n_regionkey", "r_name")
    customer = table(s, d, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    places = regions.select(F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    parks = customer.filter("c_custkey % 3 = 0").select(F.concat("c_mktsegment", F.lit(" Park")).alias("city"), F.col("r_name").alias("state"))
    other = region.select(F.col("r_regionkey").alias("_next"), F.col("r_name").alias("other"))
    customer = customer.join(other, F.col("_next") == (F.col("n_regionkey") + 1) % 5)
    return places.union(parks).distinct().withColumn("code", F.left("state", F.lit(2))), customer.withColumn("code", F.left("r_name", F.lit(2)))


@query("places_lookup", _SQL)
def places_lookup(s, d):
    places, customer = _places(s, d)
    location = F.expr("""CASE c_custkey % 10
        WHEN 0 THEN n_name || ', ' || code WHEN 1 THEN n_name || ' ' || lower(r_name) || ', US' WHEN 2 THEN 'Remote - ' || r_name
        WHEN 3 THEN c_mktsegment || ' park, ' || r_name WHEN 4 THEN c_mktsegment || ' Park' WHEN 5 THEN lower(n_name) || ' (' || lower(code) || ')'
        WHEN 6 THEN n_name || ' / ' || other WHEN 7 THEN code || ' | ' || upper(n_name) || ' | ' || c_mktsegment || ' Park'
        WHEN 8 THEN 'somewhere' ELSE n_name || ' as well' END""")
    return with_places(customer.select("c_custkey", location.alias("location")), places)
