"""City and state of a location by a supplied list of places.

A place list has a row for each city: its name, its state's name, and the state's code.  It can
be as large as a gazetteer: names are looked up by an equi-join of the location's runs of words,
each distinct location once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.functions.location import city_of, state_of
from jobweave.functions.text import clean, col, is_blank, trim_ws

#: Words of the longest name that is looked for.
MAX_WORDS = 4


def raw_words(value) -> Column:
    """Runs of letters and digits, as they are written."""
    return F.filter(F.split(F.coalesce(col(value), F.lit("")), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")


def name_key(value) -> Column:
    """A name as it is looked up: its words in lower case."""
    return F.lower(F.array_join(raw_words(value), " "))


def dictionary(places: DataFrame, city: str = "city", state: str = "state", code: str = "code") -> DataFrame:
    """One row per name: the cities, states and codes it can stand for.

    Places without a code are left out; a name is as ambiguous as it has states.
    """
    rows = places.select(clean(city).alias("city"), F.col(state).alias("state"), F.upper(trim_ws(F.col(code))).alias("code"))
    rows = rows.filter(~is_blank("code"))
    cities = rows.filter(F.col("city").isNotNull()).groupBy(name_key("city").alias("name"), "code").agg(F.min("city").alias("city"))
    nothing = F.lit(None).cast("string")
    entries = cities.select("name", F.struct("code", "city").alias("city"), nothing.alias("state"), nothing.alias("code"))
    empty = F.lit(None).cast("struct<code:string,city:string>")
    entries = entries.unionByName(rows.select(name_key("state").alias("name"), empty.alias("city"), F.col("code").alias("state"), nothing.alias("code")))
    entries = entries.unionByName(rows.select(name_key("code").alias("name"), empty.alias("city"), nothing.alias("state"), F.col("code").alias("code")))
    collected = [F.array_sort(F.collect_set(c)).alias(a) for c, a in (("city", "cities"), ("state", "states"), ("code", "codes"))]
    return entries.filter(F.col("name") != "").groupBy("name").agg(*collected)


def _runs(words: Column) -> Column:
    """(at, n, raw) of every run of one to MAX_WORDS words."""
    def of(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.struct(at.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice(words, at + 1, n), " ").alias("raw")))

    return F.flatten(F.array(*[of(n) for n in range(1, MAX_WORDS + 1)]))


def lookup(locations: DataFrame, location: str, places: DataFrame, **columns: str) -> DataFrame:
    """(location, city, state) of each distinct location that names a listed place.

    A state is named by its name, or by its code in capitals or as the last word.  A city counts
    where one of its states is named outside of the city's own words; else where its name has
    one state only and no state is named outside of it.  Of several, one with its state named
    comes before one without, then the longest name, the first, and the smallest code.  A
    location that names only states has the longest and first of them, and no city.
    """
    distinct = locations.select(F.col(f"`{location}`").alias("location")).filter(~is_blank("location")).distinct()
    words = distinct.select("location", raw_words("location").alias("words"))
    runs = words.select("location", F.size("words").alias("total"), F.explode(_runs(F.col("words"))).alias("r")).select("location", "total", "r.*")
    keyed = runs.withColumn("name", F.lower("raw"))
    hits = keyed.join(dictionary(places, **columns), "name")
    marked = (F.col("raw") == F.upper("raw")) | (F.col("at") + F.col("n") == F.col("total"))
    codes = F.when(marked, F.col("codes")).otherwise(F.array().cast("array<string>"))
    hits = hits.withColumn("named", F.array_union("states", codes))
    # at most as many hits as a location has runs
    found = hits.groupBy("location").agg(F.collect_list(F.struct("at", "n", "cities", "named")).alias("hits"))
    named = F.flatten(F.transform("hits", lambda h: F.transform(h["named"], lambda c: F.struct(h["at"].alias("at"), h["n"].alias("n"), c.alias("code")))))
    found = found.withColumn("named", named)

    def options(h: Column) -> Column:
        outside = F.filter("named", lambda s: (s["at"] >= h["at"] + h["n"]) | (s["at"] + s["n"] <= h["at"]))

        def option(c: Column) -> Column:
            agrees = F.exists(outside, lambda s: s["code"] == c["code"])
            alone = (F.size(h["cities"]) == 1) & (F.size(outside) == 0)
            rank = F.when(agrees, 2).when(alone, 1).otherwise(0)
            return F.struct((-rank).alias("rank"), (-h["n"]).alias("n"), h["at"].alias("at"), c["code"].alias("code"), c["city"].alias("city"))

        return F.filter(F.transform(h["cities"], option), lambda o: o["rank"] < 0)

    best = F.array_min(F.flatten(F.transform("hits", options)))
    state = F.array_min(F.transform("named", lambda s: F.struct((-s["n"]).alias("n"), s["at"].alias("at"), s["code"].alias("code"))))
    found = found.select("location", best.alias("b"), state.alias("s"))
    return found.select("location", F.col("b.city").alias("city"), F.coalesce("b.code", "s.code").alias("state")).filter(F.col("state").isNotNull())


def with_places(df: DataFrame, places: DataFrame, location: str = "location", city: str = "city", state: str = "state",
                fallback: bool = False) -> DataFrame:
    """``df`` with the city and state of its locations, in place of any columns so named.

    Both are NULL where the list knows nothing of the location; with ``fallback`` such a
    location is read as "City, ST" instead.
    """
    found = lookup(df, location, places).select(F.col("location").alias("_at"), F.col("city").alias("_city"), F.col("state").alias("_state"))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (city, state)]
    joined = df.join(found, F.col(f"`{location}`") == F.col("_at"), "left")
    values = [F.col("_city"), F.col("_state")]
    if fallback:
        known = F.col("_at").isNotNull()
        values = [F.when(known, v).otherwise(f(F.col(f"`{location}`"))) for v, f in zip(values, (city_of, state_of))]
    return joined.select(*kept, values[0].alias(city), values[1].alias(state))
