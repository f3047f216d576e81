"""Mixing sources to target weights: budgets by a tree, then prefixes of seeded epochs.

The tree has the levels domain, language and source.  A node's budget in tokens goes to its
children by weight.  A child can use at most its tokens times ``MAX_EPOCHS``; what it can't use
goes to its siblings by weight, again and again, and only what no sibling can use is left over
at the parent, whose siblings then get it.  That is the same as filling children from the top
of the tree down, where a child's room is the room of all leaves below it.

Filling is one pass per level: with children sorted by room per weight, those that can't use
their share come first, so running sums of room and weight tell for each child whether it is
filled up and how much per weight is left for the rest.  All of it is done in whole numbers.

A leaf's documents are ordered anew in each epoch, by a hash of seed, epoch, id and text.  A
budget of several times the leaf's tokens takes every document that often, and of the last
epoch's order the documents that begin before the rest of the budget is used up.  To find them,
a leaf is split by the first digits of the hash: token sums of those parts, in order, tell where
each part begins, and only documents of one part are numbered against each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobweave.llm.common import cut_lineage

MAX_EPOCHS = 4
SEED = 20240601
#: The budget is the corpus's tokens times this share, in percent.
BUDGET_PERCENT = 60
#: Hexadecimal digits of the hash that part a leaf.
PART_DIGITS = 3
LEVELS = ("domain", "lang", "source")

#: Domains: sources are dealt to them by their trailing number.
DOMAINS = ("web", "books", "code", "forum")
DOMAIN_WEIGHTS = {"web": 50, "books": 25, "code": 15, "forum": 10}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
OTHER_WEIGHT = 1


def token_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def domain_of(source: Column) -> Column:
    """A source's domain: by its trailing number, or the first domain if it has none."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    at = F.coalesce(number.try_cast("int"), F.lit(0)) % len(DOMAINS)
    return F.element_at(F.array(*(F.lit(d) for d in DOMAINS)), at + 1)


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(OTHER_WEIGHT)
    for name, value in weights.items():
        out = F.when(F.col(column) == name, value).otherwise(out)
    return out.cast("decimal(38,0)")


def _number(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def fill(children: DataFrame, parent: list[str], name: str, budget: Column) -> DataFrame:
    """``children`` with ``budget``: each child's part of its parent's ``budget`` column.

    Needs ``room`` and ``weight`` per child.  A parent's children are numbered in one task; they
    are nodes of the tree, not documents.
    """
    order = W.partitionBy(*parent).orderBy(F.col("room") / F.col("weight"), name)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*parent)
    left = budget - F.coalesce(F.sum("room").over(before), F.lit(0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    out = children.withColumn("_left", _number(left)).withColumn("_rest", _number(rest))
    out = out.withColumn("_full", F.col("room") * F.col("_rest") <= F.col("_left") * F.col("weight"))
    # the first child that isn't filled up sets what is left per weight for all after it
    first = lambda c: F.min(F.when(~F.col("_full"), F.struct("_rank", c))).over(whole)[c]
    out = out.withColumn("_rank", F.row_number().over(order)).withColumn("_l", first("_left")).withColumn("_r", first("_rest"))
    share = F.call_function("div", F.col("_l") * F.col("weight"), F.col("_r"))
    got = F.when(F.col("_l").isNull(), F.col("room")).otherwise(F.when(F.col("_full"), F.col("room")).otherwise(_number(share)))
    return out.withColumn("budget", _number(F.least(got, F.col("room")))).drop("_left", "_rest", "_full", "_rank", "_l", "_r")


def leaf_budgets(leaves: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, tokens, budget) of each leaf, from its tokens."""
    rooms = leaves.select(*LEVELS, "tokens", _number(F.col("tokens") * max_epochs).alias("room"))
    total = rooms.agg(_number(F.floor(F.sum("tokens") * budget_percent / 100)).alias("budget"))
    weights = (_weight("domain", DOMAIN_WEIGHTS), _weight("lang", LANG_WEIGHTS), _number(F.lit(1)))
    above = total.withColumn("_root", F.lit(1))
    parent: list[str] = ["_root"]
    rooms = rooms.withColumn("_root", F.lit(1))
    for level, weight in zip(LEVELS, weights):
        nodes = rooms.groupBy(*parent, level).agg(F.sum("room").cast("decimal(38,0)").alias("room"))
        nodes = nodes.withColumn("weight", weight).join(above.withColumnRenamed("budget", "_above"), parent)
        above = fill(nodes, parent, level, F.col("_above")).select(*parent, level, "budget")
        parent = [*parent, level]
    return rooms.join(above, parent).select(*LEVELS, "tokens", F.col("budget").cast("long").alias("budget"))


def select_rows(docs: DataFrame, keep: list[str] | None = None, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
                domain: Callable[[Column], Column] = domain_of) -> DataFrame:
    """(text_key, doc_id, domain, lang, source, n_tokens, budget, copies, prefix_tokens).

    ``copies``: how often a document is taken over all epochs; ``prefix_tokens``: how many
    tokens of its last copy lie within the budget, when that copy is the one at its edge.
    Null languages and sources are leaves of their own, written as ''.  Documents without
    tokens are taken in no epoch.
    """
    lang, source = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    text_key = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    slim = docs.select("doc_id", domain(source).alias("domain"), lang.alias("lang"), source.alias("source"), token_count(F.col("text")).alias("n_tokens"), text_key.alias("text_key"))
    slim = cut_lineage(slim, "counted")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves.where("tokens > 0"), budget_percent, max_epochs)
    budgets = cut_lineage(budgets.select(*LEVELS, "budget", F.call_function("div", "budget", "tokens").alias("full"), (F.col("budget") % F.col("tokens")).alias("part_budget")), "budgets")
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.col("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_key")))
    rows = slim.join(budgets, list(LEVELS)).withColumn("draw", drawn).withColumn("part", F.substring("draw", 1, PART_DIGITS))
    parts = rows.groupBy(*LEVELS, "part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.withColumn("before_part", F.sum("n").over(W.partitionBy(*LEVELS).orderBy("part")) - F.col("n")).drop("n")
    inside = W.partitionBy(*LEVELS, "part").orderBy("draw", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumn("within", F.sum("n_tokens").over(inside) - F.col("n_tokens")).join(parts, [*LEVELS, "part"])
    start = F.col("before_part") + F.col("within")
    more = ((start < F.col("part_budget")) & (F.col("n_tokens") > 0)).cast("long")
    edge = F.when(more == 1, F.least("n_tokens", F.col("part_budget") - start)).otherwise(F.lit(0)).cast("long")
    copies = F.when(F.col("n_tokens") > 0, F.col("full") + more).otherwise(F.lit(0)).cast("long")
    return placed.select("text_key", "doc_id", *LEVELS, "n_tokens", "budget", copies.alias("copies"), edge.alias("prefix_tokens"))


def select_documents(docs: DataFrame) -> DataFrame:
    """The documents that are taken: ids, leaves, copies, and tokens in the last copy's prefix."""
    return select_rows(docs).where("copies > 0").select("doc_id", *LEVELS, "n_tokens", "copies", "prefix_tokens")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mixture takes them: a document once per copy, whole.

    Repeated rows count as documents of their own.  Rows with one id and text differ in nothing
    the draw sees: such a group's copies are dealt evenly among its rows, and where that leaves
    some over, the rows with the smallest hashes of all columns (but maps) get one more.  Rows
    that are alike in every column are as good as each other.  Null texts have no tokens and
    are never taken; texts are taken whole, however long.
    """
    chosen = select_rows(docs, **options)
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("lang"), F.col("source"), F.col("text_key")]
    names = ["_k1", "_k2", "_k3", "_k4"]
    group = chosen.groupBy(*(k.alias(n) for k, n in zip(key, names))).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    own = [
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.coalesce(docs["lang"], F.lit("")), F.coalesce(docs["source"], F.lit("")),
        F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")),
    ]
    on = own[0] == F.col("_k1")
    for mine, name in zip(own[1:], names[1:]):
        on = on & (mine == F.col(name))
    joined = docs.join(group.where("_copies > 0"), on)
    even = joined.where("_copies >= _rows").select(*docs.columns, F.call_function("div", "_copies", "_rows").alias("_times"))
    # what is left over, at most one group of a leaf, goes by class of equal rows, so that a
    # class costs one row however often it is repeated
    hashed = [f.name for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    uneven = joined.where("_copies % _rows > 0").withColumn("_tie", F.xxhash64(*[docs[c] for c in hashed]))
    classes = uneven.groupBy(*names, "_tie").agg(F.count("*").alias("_n"), F.min(F.col("_copies") % F.col("_rows")).alias("_over"))
    classes = classes.withColumn("_part", F.pmod("_tie", F.lit(4096)))
    parts = classes.groupBy(*names, "_part").agg(F.sum("_n").alias("_in_part"))
    parts = parts.withColumn("_before", F.sum("_in_part").over(W.partitionBy(*names).orderBy("_part")) - F.col("_in_part"))
    inside = F.sum("_n").over(W.partitionBy(*names, "_part").orderBy("_tie")) - F.col("_n")
    placed = classes.withColumn("_inside", inside).join(parts, [*names, "_part"])
    more = F.least(F.col("_n"), F.col("_over") - F.col("_before") - F.col("_inside")).alias("_times")
    placed = placed.select(*names, "_tie", more).where("_times > 0")
    extra = uneven.dropDuplicates([*names, "_tie"]).join(placed, [*names, "_tie"]).select(*docs.columns, "_times")
    taken = even.union(extra)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select(*docs.columns)


def _sql_weight(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {OTHER_WEIGHT} END"


def _sql_level(name: str, above: str, parent: list[str], level: str, weight: str) -> str:
    own = ", ".join([*parent, level])
    by = f"PARTITION BY {', '.join(parent)}"
    order = f"{by} ORDER BY room / weight, {level}"
    return f"""
{name}_n AS (SELECT {own}, sum(room)::HUGEINT AS room, any_value({weight})::HUGEINT AS weight FROM leaf GROUP BY {own}),
{name}_s AS (
  SELECT n.*, a.budget AS above,
         a.budget - coalesce(sum(room) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rst,
         row_number() OVER ({order}) AS rnk
  FROM {name}_n n JOIN {above} a USING ({', '.join(parent)})),
{name}_f AS (SELECT *, room * rst <= lft * weight AS filled FROM {name}_s),
{name}_e AS (SELECT {', '.join(parent)}, arg_min(lft, rnk) AS l, arg_min(rst, rnk) AS r FROM {name}_f WHERE NOT filled GROUP BY {', '.join(parent)}),
{name} AS (
  SELECT {own}, least(room, CASE WHEN l IS NULL OR filled THEN room ELSE (l * weight) // r END) AS budget
  FROM {name}_f LEFT JOIN {name}_e USING ({', '.join(parent)})),"""


MIX_SQL = f"""
WITH slim AS (
  SELECT row_number() OVER () AS rid, doc_id,
         ['{"', '".join(DOMAINS)}'][coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]{{{{1,9}}}})$', 1) AS INTEGER), 0) % {len(DOMAINS)} + 1] AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens, md5(coalesce(text, '')) AS text_key
  FROM {{documents}}),
leaf AS (SELECT 1 AS root, domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {MAX_EPOCHS} AS room FROM slim GROUP BY ALL HAVING sum(n_tokens) > 0),
top AS (SELECT 1 AS root, (sum(tokens) * {BUDGET_PERCENT} // 100)::HUGEINT AS budget FROM leaf),
{_sql_level("l1", "top", ["root"], "domain", _sql_weight("domain", DOMAIN_WEIGHTS))}
{_sql_level("l2", "l1", ["root", "domain"], "lang", _sql_weight("lang", LANG_WEIGHTS))}
{_sql_level("l3", "l2", ["root", "domain", "lang"], "source", "1")}
budgets AS (SELECT domain, lang, source, budget // tokens AS full_, budget % tokens AS part_budget FROM leaf JOIN l3 USING (root, domain, lang, source)),
drawn AS (
  SELECT *, md5('{SEED}|' || full_ || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_key) AS draw
  FROM slim JOIN budgets USING (domain, lang, source)),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY draw, doc_id, rid ROWS UNBOUNDED PRECEDING) - n_tokens AS start FROM drawn),
chosen AS (
  SELECT *, CAST(CASE WHEN n_tokens > 0 THEN full_ + CAST(start < part_budget AS INTEGER) ELSE 0 END AS BIGINT) AS copies,
         CAST(CASE WHEN n_tokens > 0 AND start < part_budget THEN least(n_tokens, part_budget - start) ELSE 0 END AS BIGINT) AS prefix_tokens
  FROM placed)
"""
MIX_RESULT_SQL = "SELECT doc_id, domain, lang, source, n_tokens, copies, prefix_tokens FROM chosen WHERE copies > 0"
