"""Mixing sources to target weights by budgets that flow down a tree of domains, languages and sources.

Defined results: a null text has no tokens; nulls in a level are a node of their own; documents without tokens
cost nothing and are taken with the prefix they stand in; documents of equal place in an epoch are ordered by
id and text; an empty table gives no rows; a budget beyond all supply takes every epoch of everything. The
caller's columns travel in a struct.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

WORD = r"[^\x20\x09-\x0D]+"
# Documents in one bucket of an epoch's order, about; only a leaf's last bucket is put in order.
BUCKET = 512


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    matched = F.lit(True)
    for a, b in zip(left, right):
        matched = matched & F.col(a).eqNullSafe(F.col(b))
    return matched


def _wide(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(19,0)")


def shared_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Budgets of sibling nodes, from ``(budget of the parent, weight, capacity)``.

    Siblings share by weight. A node that can't use its share takes its capacity, and what it leaves goes to its
    siblings by their weights, over and over; in closed form, siblings in order of capacity per weight are
    full up to the first whose share of what the ones before it leave is less than its capacity. Capacities
    per weight are compared to 13 places, and fractions of a token are dropped. Nodes of weight 0 have no capacity.
    """
    per_weight = F.try_divide(F.col("capacity").cast("decimal(20,0)"), F.col("weight").cast("decimal(12,0)"))
    order = Window.partitionBy(*parent).orderBy(per_weight, F.asc_nulls_first(name))
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    siblings = Window.partitionBy(*parent)
    nodes = nodes.withColumn("left", F.col("parent_budget") - before).withColumn("weights", after)
    nodes = nodes.withColumn("full", _wide("capacity") * _wide("weights") <= _wide("weight") * _wide("left"))
    used = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(siblings)
    open_weights = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(siblings)
    nodes = nodes.withColumn("rest", F.col("parent_budget") - used).withColumn("open", open_weights)
    share = F.expr("(CAST(weight AS DECIMAL(19,0)) * CAST(rest AS DECIMAL(19,0))) div CAST(open AS DECIMAL(19,0))")
    nodes = nodes.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(share).cast("long"))
    return nodes.drop("left", "weights", "full", "rest", "open")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    """The weight of a node by its name in its level; 1 where none is given."""
    given = weights.get(level, {})
    if not given:
        return F.lit(1).cast("long")
    pairs = F.create_map(*[F.lit(part) for pair in given.items() for part in pair])
    return F.coalesce(F.try_element_at(pairs, F.coalesce(F.col(level).cast("string"), F.lit(""))), F.lit(1)).cast("long")


def budgets(
    supplies: DataFrame, levels: list[str], weights: Mapping[str, Mapping[str, int]], share: tuple[int, int], epochs: int
) -> DataFrame:
    """``(levels, supply, n_docs, budget)`` of every leaf, from its supply of tokens.

    The whole budget is the fraction ``share`` of all tokens, and a leaf may be read ``epochs`` times. Budgets go
    down level by level. A node's capacity is that of the leaves below it, so a shortage is made up by siblings
    first and reaches an ancestor's siblings only where a whole subtree is used up. A leaf has no capacity, and so
    no budget, if it or anything above it has weight 0.
    """
    wanted = F.lit(True)
    for level in levels:
        wanted = wanted & (_weight(level, weights) > 0)
    leaves = supplies.withColumn("capacity", F.when(wanted, F.col("supply") * epochs).otherwise(0))
    total = leaves.agg(
        F.least(F.expr(f"CAST(sum(supply) * {share[0]} div {share[1]} AS BIGINT)"), F.sum("capacity")).alias("budget")
    ).scalar()
    above = None
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights))
        if above is None:
            nodes = nodes.withColumn("parent_budget", total)
        else:
            renamed = above.select(
                *[F.col(name).alias(f"_{name}") for name in path[:-1]], F.col("budget").alias("parent_budget")
            )
            nodes = nodes.join(renamed, _same(path[:-1], [f"_{name}" for name in path[:-1]])).drop(*renamed.columns[:-1])
        above = shared_out(nodes, path[:-1], level).select(*path, "budget")
    found = above.select(*[F.col(name).alias(f"_{name}") for name in levels], "budget")
    return leaves.join(found, _same(levels, found.columns[:-1])).select(*levels, "supply", "n_docs", "budget")


def mixed(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, int]],
    share: tuple[int, int],
    epochs: int,
    seed: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The chosen rows as ``(row, levels, epoch, n_tokens)``; ``row`` is a struct of all columns of ``docs``.

    Each epoch has an order of its own, by a seeded hash of the ids. A leaf's budget takes whole epochs first and then
    the documents of the next one, in order, as long as their tokens fit. Only sums of buckets of that order
    are gathered per leaf; the documents of the bucket in which the budget ends are put in order alone.
    """
    names = list(levels)
    tokens = F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        *[column.alias(name) for name, column in levels.items()],
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_name"),
        F.xxhash64(text_col).alias("text_hash"),
        tokens.alias("n_tokens"),
    )
    supplies = written(
        rows.groupBy(*names).agg(F.sum("n_tokens").alias("supply"), F.count("*").alias("n_docs")), "supplies"
    )
    leaves = budgets(supplies, names, weights, share, epochs)
    whole = F.when(F.col("supply") > 0, F.expr("budget div supply")).otherwise(0).cast("int")
    digits = F.greatest(F.ceil(F.log(16.0, F.col("n_docs") / BUCKET)), F.lit(0)).cast("int")
    leaves = leaves.select(
        *[F.col(name).alias(f"_{name}") for name in names],
        F.monotonically_increasing_id().alias("leaf"),
        whole.alias("whole"),
        (F.col("budget") - whole * F.col("supply")).alias("rest"),
        digits.alias("digits"),
    )
    leaves = written(leaves, "leaves")
    rows = rows.join(leaves, _same(names, [f"_{name}" for name in names])).drop(*[f"_{name}" for name in names])
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole"), F.col("doc_name")).cast("binary"))
    rows = rows.withColumn("place", place).withColumn("bucket", F.expr("left(place, digits)"))

    sums = rows.groupBy("leaf", "bucket").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = F.sum("tokens").over(Window.partitionBy("leaf").orderBy("bucket"))
    ends = sums.withColumn("upto", upto).where("upto > rest").groupBy("leaf")
    ends = ends.agg(F.min("bucket").alias("end"), F.min(F.col("upto") - F.col("tokens")).alias("before"))
    ends = written(ends, "ends").withColumnRenamed("leaf", "end_leaf")
    rows = rows.join(ends, F.col("leaf") == F.col("end_leaf"), "left")

    out = ["row", *names, "n_tokens"]
    full = rows.where("whole > 0").select(*out, F.explode(F.expr("sequence(0, whole - 1)")).alias("epoch"))
    ahead = rows.where("end IS NULL OR bucket < end").select(*out, F.col("whole").alias("epoch"))
    order = Window.partitionBy("leaf").orderBy("place", "doc_name", "text_hash")
    running = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = rows.where("bucket = end").withColumn("upto", F.col("before") + running).where("upto <= rest")
    last = last.select(*out, F.col("whole").alias("epoch"))
    return full.unionByName(ahead).unionByName(last)


def oracle(levels: Mapping[str, str], weights: Mapping[str, Mapping[str, int]], share: tuple[int, int], epochs: int, seed: int) -> str:
    """The same choice from ``documents`` in SQL, with every leaf in order as a whole."""
    names, steps, parent = list(levels), [], "total"
    for depth, level in enumerate(names):
        path, above = names[: depth + 1], names[:depth]
        cases = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in weights.get(level, {}).items())
        weight = f"CASE {level} {cases} ELSE 1 END" if cases else "1"
        on = " AND ".join([f"n.{a} IS NOT DISTINCT FROM p.{a}" for a in above] or ["true"])
        by = f"PARTITION BY {', '.join(above)} " if above else ""
        order = f"{by}ORDER BY capacity / weight, {level} NULLS FIRST"
        steps.append(f"""
), nodes{depth} AS (
  SELECT n.*, p.budget AS parent_budget FROM (
    SELECT {", ".join(path)}, sum(capacity) AS capacity, {weight} AS weight FROM leaves GROUP BY {", ".join(path)}
  ) n JOIN {parent} p ON {on}
), marked{depth} AS (
  SELECT *, capacity * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= weight * (
    parent_budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM nodes{depth}
), level{depth} AS (
  SELECT *, CASE WHEN filled THEN capacity ELSE weight * (
    parent_budget - coalesce(sum(capacity) FILTER (filled) OVER ({by}), 0)) // sum(weight) FILTER (NOT filled) OVER ({by}) END AS budget
  FROM marked{depth}""")
        parent = f"level{depth}"
    on = " AND ".join(f"l.{a} IS NOT DISTINCT FROM p.{a}" for a in names)
    return rf"""
WITH docs AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::HUGEINT AS n_tokens,
    {", ".join(f"{sql} AS {name}" for name, sql in levels.items() if sql != name)}
  FROM documents
), leaves AS (
  SELECT {", ".join(names)}, sum(n_tokens) AS supply, {epochs} * sum(n_tokens) AS capacity FROM docs GROUP BY {", ".join(names)}
), total AS (
  SELECT least(sum(supply) * {share[0]} // {share[1]}, sum(capacity)) AS budget FROM leaves{"".join(steps)}
), shares AS (
  SELECT l.*, p.budget, CASE WHEN supply > 0 THEN p.budget // supply ELSE 0 END AS whole FROM leaves l JOIN {parent} p ON {on}
), placed AS (
  SELECT l.*, p.whole, p.budget - p.whole * p.supply AS rest, sum(n_tokens) OVER (PARTITION BY {", ".join(f"l.{a}" for a in names)}
    ORDER BY md5('{seed}:' || p.whole || ':' || coalesce(doc_id::VARCHAR, '')), doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs l JOIN shares p ON {on}
)
SELECT doc_id, {", ".join(names)}, n_tokens::BIGINT AS n_tokens, unnest(range(0, (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT)) AS epoch
FROM placed
"""
