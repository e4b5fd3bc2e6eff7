"""A Merkle manifest of a dataset: a digest of every row, tree by tree, with the proof that each row is in it.

Rows of a source, in the order of their ids, are the leaves of a tree; while several nodes are left, each run of
FANOUT consecutive ones becomes their digest. What is left is the source's subroot, and the subroots in the order
of sources form the top tree. A conditional aggregate for each slot spreads the children of a parent into FANOUT
columns: concatenating all of them hashes the parent, and leaving out a child's own slot gives its siblings.
On the way down each parent hands its children what it knows of the path to the root.

Defined results: a null value is hashed as ``-`` and never as a text; a null source or id is a value like any
other and comes first; rows of equal ids stand in the order of their digests, so repeated rows are leaves each; a
source of one row has that leaf as its subroot; an empty table has no root and gives no rows. The caller's
columns travel in a struct, so any names are fine. Digests are held as binary and hashed as lowercase hex.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.llm.places import placed
from towerlens.sources.workspace import written

FANOUT = 3
SLOTS = [f"slot{k}" for k in range(FANOUT)]


def field(value: Column) -> Column:
    """A value as it is hashed: its length in UTF-8 and its text, or ``-``, so that no two rows look the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row of values."""
    return F.unhex(F.sha2(F.concat(*[field(value) for value in values]), 256))


def hexed(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def _joined(parts: Sequence[Column]) -> Column:
    """Digests one after the other, without those that are missing."""
    return F.concat(*[F.coalesce(part, F.lit(b"")) for part in parts])


def _digest(run: Column) -> Column:
    return F.unhex(F.sha2(hexed(run), 256))


def _grown(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The levels above ``nodes`` ``(tree, place, size, hash)``, lowest first: one row for each parent, with its slots.

    ``size`` is the number of nodes of the tree on its level, so a tree is finished where it is 1; ``largest`` is
    the size of the largest tree.
    """
    levels = []
    while largest > 1:
        slot = F.col("place") % FANOUT
        spread = [F.max(F.when(slot == k, F.col("hash"))).alias(name) for k, name in enumerate(SLOTS)]
        size = F.expr(f"CAST((max(size) + {FANOUT - 1}) div {FANOUT} AS BIGINT)").alias("size")
        parent = F.expr(f"CAST(place div {FANOUT} AS BIGINT)").alias("place")
        parents = nodes.where("size > 1").groupBy("tree", parent).agg(size, *spread)
        nodes = written(parents.withColumn("hash", _digest(_joined([F.col(name) for name in SLOTS]))), "level")
        levels.append(nodes)
        largest = -(-largest // FANOUT)
    return levels


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``(tree, top)``: what is left of every tree, on whatever level."""
    tops = nodes.where("size = 1").select("tree", F.col("hash").alias("top"))
    for level in levels:
        tops = tops.union(level.where("size = 1").select("tree", "hash"))
    return tops


def _step(own: Column) -> Column:
    """The siblings before and after slot ``own`` of a parent."""
    cases = [
        F.struct(
            _joined([F.lit(b""), *map(F.col, SLOTS[:k])]).alias("left"), _joined([F.lit(b""), *map(F.col, SLOTS[k + 1 :])]).alias("right")
        )
        for k in range(FANOUT)
    ]
    return F.array(*cases)[own]


def _with_paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``nodes`` with ``path``, the siblings on the way to the top of the tree and on, and the tree's ``top``.

    ``tops`` ``(tree, top, path)`` has what is above each tree. Parents hand down their paths level by level, each
    written, so an executor that is lost costs no more than a level.
    """
    above = None
    for level in [*reversed(levels), nodes]:
        # A tree that ends here takes the path of its top; other nodes that of their parent, one step longer.
        ends = level.where("size = 1").join(tops, "tree")
        if above is None:
            level = ends
        else:
            parents = above.select(
                F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("path").alias("_path"), "top", *SLOTS
            )
            lower = level.where("size > 1").drop(*SLOTS).withColumn("_of", F.expr(f"CAST(place div {FANOUT} AS BIGINT)"))
            lower = lower.join(parents, (F.col("tree") == F.col("_tree")) & (F.col("_of") == F.col("_place")))
            path = F.concat(F.array(_step((F.col("place") % FANOUT).cast("int"))), F.col("_path")).alias("path")
            own = [name for name in level.columns if name not in SLOTS]
            slots = [name for name in SLOTS if name in level.columns]
            if slots:
                # The parent's slots have done their part; the level's own ones take their place.
                kept = level.select(F.col("tree").alias("_t"), F.col("place").alias("_p"), *slots)
                lower = lower.select(*own, "top", path).join(kept, (F.col("tree") == F.col("_t")) & (F.col("place") == F.col("_p")))
                lower = lower.select(*own, *slots, "top", "path")
            else:
                lower = lower.select(*own, "top", path)
            level = ends.select(*own, *slots, "top", "path").union(lower)
        above = written(level, "paths")
    return above


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    carried: Mapping[str, Column],
    source_col: str = "source",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(carried, leaf, subroot, root, path)`` of every row; ``path`` lists the siblings from the leaf to the root."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        leaf([F.col(f"`{name}`") for name in columns]).alias("hash"),
        F.struct(F.lit(0), *[column.alias(name) for name, column in carried.items()]).alias("row"),
    )
    rows = placed(written(rows, "leaves"), "source", [F.asc_nulls_first("id"), F.asc("hash")])
    leaves = written(rows.select(field(F.col("source")).alias("tree"), "source", "place", "size", "hash", "row"), "leaves")

    sources = leaves.groupBy("tree").agg(F.min("source").alias("source"), F.max("size").alias("n")).withColumn("all", F.lit(0))
    sources = written(placed(written(sources, "sources"), "all", [F.asc_nulls_first("source")]), "sources")
    n_sources, largest = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    leaves = leaves.drop("source")
    levels = _grown(leaves.select("tree", "place", "size", "hash"), largest)
    subroots = written(_tops(leaves, levels), "subroots")

    heads = sources.join(subroots, "tree").select(
        F.lit("").alias("tree"), "place", "size", F.col("top").alias("hash"), F.col("tree").alias("of")
    )
    heads = written(heads, "heads")
    upper = _grown(heads.select("tree", "place", "size", "hash"), n_sources)
    nothing = F.array().cast("array<struct<left:binary,right:binary>>")
    roots = _tops(heads, upper).withColumn("path", nothing)
    root = roots.select("top").first()
    heads = _with_paths(heads, upper, roots).select(F.col("of").alias("tree"), F.col("hash").alias("top"), "path")

    rows = _with_paths(leaves, levels, heads)
    root = F.lit(bytes(root[0]) if root else None).cast("binary").alias("root")
    return rows.select(*[F.col("row")[name].alias(name) for name in carried], F.col("hash").alias("leaf"), F.col("top").alias("subroot"), root, "path")


def proof(path: Column | str) -> Column:
    """The digest of all siblings on a path, from left to right and from the leaf to the root, as hex."""
    steps = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(hexed(F.aggregate(steps, F.lit(b""), lambda all_, step: F.concat(all_, step))), 256)


def folded(leaf: Column, path: Column | str) -> Column:
    """The root that a leaf's digest gives with the siblings on its path."""
    return F.aggregate(path, leaf, lambda own, step: _digest(F.concat(step["left"], own, step["right"])))


ORACLE = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS k, doc_id, source, lang, n_chars, text,
    replace(text, chr(10), '') AS other, doc_id IS NOT NULL AND list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)), lambda crc, byte:
        list_reduce(list_prepend(xor(crc, byte), range(8)::UBIGINT[]), lambda x, i:
          xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) % 2 = 1 AS changed
  FROM documents
), leaves AS (
  SELECT k, doc_id, source, changed,
    sha256(concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
      coalesce(strlen(text) || ':' || text, '-'))) AS h,
    sha256(concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
      coalesce(strlen(other) || ':' || other, '-'))) AS other
  FROM given
), placed AS (
  SELECT *, coalesce('s' || source, '') AS tree, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS place
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, place, n, h FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM nodes
  WHERE n > 1 GROUP BY tree, level, place // 3, n
), heads AS (
  SELECT tree, count(*) OVER () AS n, row_number() OVER (ORDER BY tree = '' DESC, encode(tree)) - 1 AS place, h
  FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, place, n, h FROM heads
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM upper
  WHERE n > 1 GROUP BY level, place // 3, n
), steps AS (
  SELECT a.tree, a.level, a.place,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.place // 3 = b.place // 3
  WHERE a.n > 1 GROUP BY ALL
), upper_steps AS (
  SELECT a.level, a.place,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
  FROM upper a JOIN upper b ON a.level = b.level AND a.place // 3 = b.place // 3
  WHERE a.n > 1 GROUP BY ALL
), folds AS (
  SELECT k, tree, 0 AS level, place, CASE WHEN changed THEN other ELSE h END AS h, '' AS proof FROM placed
  UNION ALL
  SELECT f.k, f.tree, f.level + 1, f.place // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.level = f.level AND s.place = f.place
), trees AS (
  SELECT k, arg_max(h, level) AS h, arg_max(proof, level) AS proof, any_value(tree) AS tree FROM folds GROUP BY k
), on_top AS (
  SELECT t.k, 0 AS level, p.place, t.h, t.proof FROM trees t JOIN heads p USING (tree)
  UNION ALL
  SELECT f.k, f.level + 1, f.place // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM on_top f JOIN upper_steps s ON s.level = f.level AND s.place = f.place
), ends AS (
  SELECT k, arg_max(h, level) AS folded, arg_max(proof, level) AS proof FROM on_top GROUP BY k
)
SELECT doc_id, p.h AS leaf, t.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed p JOIN ends USING (k) JOIN heads t USING (tree), (SELECT h AS root FROM upper WHERE n = 1)
"""
