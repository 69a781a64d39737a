"""Mixing sources to target weights, in DataFrame functions.

Weights go down a tree of domain, language and source. At each node the budget is shared among the
children by weight; what a child cannot use goes to its siblings, and only what no child can use
goes back to the node's own siblings. A leaf gives whole epochs of its documents and, of the next
one, the documents that come first in a seeded order and fit into the rest of its budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.llm.store import stored

#: A word: a run of anything but blank and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the order key that make the groups of a leaf whose sums are taken first.
GROUP_DIGITS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_tie(text: Column) -> Column:
    """Sixteen hex digits that order rows of one id."""
    return F.lpad(F.hex(F.xxhash64(F.coalesce(text, F.lit("")))), 16, "0")


def order_key(key: str, tie: Column, epoch: Column, seed: int) -> Column:
    """Seeded order of the rows of an epoch; only rows of one id and one text are equal in it."""
    ident = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), ident)), tie)


def _weight(column: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in sorted(weights.items()):
        out = F.when(column == value, F.lit(weight)).otherwise(out)
    return out.cast("long")


def shared_out(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """``nodes`` (parents, weight, room, budget of the parent) with ``share``, the budget of each.

    Shares are as the weights, up to the room of a node; what is left over goes to its siblings by
    weight. With nodes in order of room over weight, those are full whose siblings in this order
    could all be given as much for their weight. A weight of 0 gets nothing.
    """
    full_first = F.when(F.col("weight") > 0, F.col("room") / F.col("weight"))
    order = Window.partitionBy(*parents).orderBy(full_first.asc_nulls_last(), "name")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    used = F.when(F.col("weight") > 0, F.col("room")).otherwise(0)
    rows = nodes.select(
        "*",
        F.coalesce(F.sum(used).over(before), F.lit(0)).alias("room before"),
        F.sum("weight").over(rest).alias("weight from"),
    )
    left = F.col("budget") - F.col("room before")
    full = (F.col("weight") > 0) & (F.col("room") * F.col("weight from") <= left * F.col("weight"))
    rows = rows.withColumn("full", full)
    # The level of those not full is that of the first of them.
    by_parent = Window.partitionBy(*parents)
    first = F.min_by(
        F.struct(left.alias("left"), F.col("weight from").alias("weights")),
        F.when(~F.col("full") & (F.col("weight") > 0), F.col("room before")),
    ).over(by_parent)
    share = F.when(F.col("full"), F.col("room")).when(
        F.col("weight") > 0, F.floor(first["left"] * F.col("weight") / first["weights"])
    )
    return rows.withColumn("share", F.coalesce(share, F.lit(0)).cast("long")).drop("room before", "weight from", "full")


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], total: Column, epochs: int) -> DataFrame:
    """``leaves`` (levels, supply) with ``share``, the tokens that each leaf has to give."""
    above: DataFrame | None = None
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        nodes = leaves.groupBy(*path).agg((F.sum("supply") * epochs).cast("long").alias("room"))
        nodes = nodes.withColumn("weight", _weight(F.col(level), weights.get(level, {}))).withColumn("name", F.col(level))
        if above is None:
            nodes = nodes.withColumn("root", F.lit(0)).withColumn("budget", total)
            nodes = shared_out(nodes, ["root"]).drop("root")
        else:
            parent = above.select(*path[:-1], F.col("share").alias("budget"))
            nodes = shared_out(nodes.join(parent, path[:-1]), path[:-1])
        above = nodes
    return leaves.join(above.select(*levels, "share"), levels)


def plan(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    share: float,
    epochs: int,
    seed: int,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """What each leaf gives: the levels, ``whole`` epochs, and of the epoch after them the rows before ``stop`` in order.

    Rows that are equal in the order meet in ``stop`` as well; ``copies`` of them fit.
    """
    names = list(levels)
    narrow = stored(
        docs.select(key, *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()], n_words(F.col(text)).alias("tokens"), text_tie(F.col(text)).alias("tie")),
        "mixing-tokens",
    )
    leaves = stored(narrow.groupBy(*names).agg(F.sum("tokens").alias("supply")), "mixing-leaves")
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0))).first()[0]
    leaves = budgets(leaves, names, weights, F.lit(int(total * share)).cast("long"), epochs)
    whole = F.when(F.col("supply") > 0, F.floor(F.col("share") / F.col("supply"))).otherwise(0).cast("int")
    leaves = leaves.select(*names, whole.alias("whole"), (F.col("share") - whole * F.col("supply")).alias("quota"))
    leaves = stored(leaves, "mixing-shares")
    # Sums of groups of keys first; only the group that holds the end of the prefix is looked into.
    keyed = narrow.join(leaves.where("quota > 0"), names).withColumn("order", order_key(key, F.col("tie"), F.col("whole"), seed))
    keyed = keyed.withColumn("part", F.substring("order", 1, GROUP_DIGITS))
    sums = keyed.groupBy(*names, "part").agg(F.sum("tokens").alias("tokens"), F.first("quota").alias("quota"))
    run = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("tokens").over(run)).where("upto > quota")
    ends = sums.groupBy(*names).agg(F.min("part").alias("part"), F.min_by(F.col("upto") - F.col("tokens"), "part").alias("before"))
    # Equal rows are one before they are put in order.
    edge = keyed.join(ends, [*names, "part"]).groupBy(*names, "order").agg(
        F.first("before").alias("before"), F.first("quota").alias("quota"), F.first("tokens").alias("each"), F.sum("tokens").alias("tokens")
    )
    run = Window.partitionBy(*names).orderBy("order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.col("before") + F.sum("tokens").over(run)).where("upto > quota")
    fitting = F.expr("(quota - (upto - tokens)) div each").alias("copies")
    stops = edge.groupBy(*names).agg(F.min_by(F.struct("order", fitting), "order").alias("stop"))
    stops = stops.select(*names, F.col("stop.order").alias("stop"), F.col("stop.copies").alias("copies"))
    return stored(leaves.join(stops, names, "left"), "mixing-plan")


def _first_copies(rows: DataFrame, leaf: list[str], copies: str) -> DataFrame:
    """Of the rows of each leaf as many as ``copies`` says, counted by the parts in which they are stored."""
    rows = stored(rows.withColumn("stored row", F.monotonically_increasing_id()), "mixing-copies")
    rows = rows.withColumn("stored part", F.shiftright("stored row", 33))
    sums = rows.groupBy(*leaf, "stored part").agg(F.count("*").alias("stored rows"))
    run = Window.partitionBy(*leaf).orderBy("stored part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("rows ahead", F.coalesce(F.sum("stored rows").over(run), F.lit(0)))
    within = Window.partitionBy(*leaf, "stored part").orderBy("stored row")
    rows = rows.join(sums, [*leaf, "stored part"]).withColumn("place in part", F.row_number().over(within))
    return rows.where(F.col("rows ahead") + F.col("place in part") <= F.col(copies))


def mixed(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    share: float = 0.6,
    epochs: int = 2,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with ``epoch``, once for each epoch that takes the row.

    ``levels`` names the levels of the tree, top first, with the value of a row at each; ``weights``
    gives the integer weight of values by level, 1 where none is given. The budget is ``share`` of all
    tokens, which are words. At most ``epochs`` epochs are drawn of a leaf. The prefix of an epoch is the
    longest whose tokens fit, in order of a seeded hash of epoch and id, then of a hash of the text.

    NULL levels count as empty ones; NULL texts have no tokens. Rows without id are in the order as if they had one
    in common; of rows equal in id and text, as many are taken as fit. An empty table gives an empty result. A column called ``epoch``
    is replaced. The plan has a row for each leaf, of which there are as many as the tree has.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c != "epoch"]
    names = list(levels)
    leaves = plan(docs, levels, weights, share, epochs, seed, key, text)
    leaves = leaves.select(*[F.col(n).alias(f"leaf {n}") for n in [*names, "whole", "quota", "stop", "copies"]])
    own = [F.coalesce(c.cast("string"), F.lit("")).alias(f"own {n}") for n, c in levels.items()]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(key).alias("own key"), text_tie(F.col(text)).alias("own tie"), *own)
    rows = rows.join(leaves, [F.col(f"own {n}") == F.col(f"leaf {n}") for n in names])
    rows = rows.withColumn("drawn epoch", F.explode(F.sequence(F.lit(0), F.col("leaf whole"))))
    rows = rows.withColumn("own order", order_key("own key", F.col("own tie"), F.col("drawn epoch"), seed))
    partial = (F.col("drawn epoch") == F.col("leaf whole")) & (F.col("leaf quota") > 0)
    fits = F.col("leaf stop").isNull() | (F.col("own order") < F.col("leaf stop"))
    shown = [*[F.col(f"`{c}`") for c in columns], F.col("drawn epoch").alias("epoch")]
    drawn = rows.where((F.col("drawn epoch") < F.col("leaf whole")) | (partial & fits)).select(*shown)
    if leaves.where(F.col("leaf copies") > 0).isEmpty():
        return drawn
    some = rows.where(partial & (F.col("own order") == F.col("leaf stop")) & (F.col("leaf copies") > 0))
    some = _first_copies(some, [f"leaf {n}" for n in names], "leaf copies")
    return drawn.unionByName(some.select(*shown))


DOMAINS = {"src0": "crawl", **{f"src{i}": "web" for i in range(1, 10)}}
WEIGHTS = {
    "domain": {"crawl": 20, "web": 35, "curated": 45},
    "language": {"en": 50, "de": 20, "fr": 20, "es": 10},
}


def document_levels() -> dict[str, Column]:
    """Domain, language and source of the documents; the first source is a crawl of its own."""
    domain = F.lit("curated")
    for source, name in DOMAINS.items():
        domain = F.when(F.col("source") == source, F.lit(name)).otherwise(domain)
    return {"domain": domain, "language": F.col("lang"), "leaf_source": F.col("source")}


def _level_sql(name: str, parent: str, keys: str, above: str, weight: str) -> str:
    """SQL for one level of ``shared_out``."""
    part = f"PARTITION BY {parent}" if parent else ""
    return f"""
{name}_nodes AS (
  SELECT {keys}, sum(supply) * 2 AS room, {weight} AS weight, {above} AS budget
  FROM leaves {"JOIN " + above.split(".")[0] + f" USING ({parent})" if parent else ""} GROUP BY ALL
), {name}_run AS (
  SELECT *, coalesce(sum(CASE WHEN weight > 0 THEN room ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room_before,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_from
  FROM {name}_nodes WINDOW w AS ({part} ORDER BY room / nullif(weight, 0) NULLS LAST, {keys.split(", ")[-1]})
), {name}_full AS (
  SELECT *, room * weight_from <= (budget - room_before) * weight AS is_full FROM {name}_run
), {name} AS (
  SELECT {keys}, CAST(CASE WHEN is_full THEN room ELSE floor(
           min_by(budget - room_before, room_before) FILTER (NOT is_full) OVER ({part}) * weight
           / min_by(weight_from, room_before) FILTER (NOT is_full) OVER ({part})) END AS BIGINT) AS share
  FROM {name}_full
)"""


ORACLE = (
    r"""
WITH toks AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN regexp_full_match(source, 'src[1-9]') THEN 'web' ELSE 'curated' END AS domain,
         lang AS language, source AS leaf_source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens
  FROM documents
), leaves AS (
  SELECT domain, language, leaf_source, CAST(sum(tokens) AS BIGINT) AS supply FROM toks GROUP BY ALL
),"""
    + _level_sql("dom", "", "domain", "(SELECT CAST(floor(sum(supply) * 0.6) AS BIGINT) FROM leaves)",
                 "CASE domain WHEN 'crawl' THEN 20 WHEN 'web' THEN 35 ELSE 45 END")
    + ","
    + _level_sql("lan", "domain", "domain, language", "dom.share",
                 "CASE language WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 10 ELSE 1 END")
    + ","
    + _level_sql("src", "domain, language", "domain, language, leaf_source", "lan.share", "1")
    + r"""
, plan AS (
  SELECT *, CAST(floor(share / supply) AS INTEGER) AS whole, share - CAST(floor(share / supply) AS BIGINT) * supply AS quota
  FROM src JOIN leaves USING (domain, language, leaf_source)
), ordered AS (
  SELECT toks.*, whole, quota, sum(tokens) OVER (
           PARTITION BY domain, language, leaf_source ORDER BY md5('0:' || whole || ':' || doc_id)) AS upto
  FROM toks JOIN plan USING (domain, language, leaf_source)
)
SELECT doc_id, domain, language, leaf_source, tokens, unnest(range(whole)) ::INTEGER AS epoch FROM ordered
UNION ALL
SELECT doc_id, domain, language, leaf_source, tokens, whole AS epoch FROM ordered WHERE quota > 0 AND upto <= quota
"""
)
