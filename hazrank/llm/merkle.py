"""Merkle manifest of a dataset: a hash tree over all rows, with a proof a row.

A row's leaf is the SHA-256 of its columns, each with its byte count before
it.  The leaves of a language, ascending by id, are the lowest level of its
tree: every two consecutive nodes become the SHA-256 of both, a last one
alone that of itself, until one node remains, the subroot.  The subroots,
ordered by language, are the leaves of the upper tree, whose last node is the
root.  Digests go into digests as lowercase hex text.

Trees are cut into superblocks of 2 ** ``BLOCK_BITS`` consecutive nodes, which
lie under one node of the level that many levels higher.  Upwards, each
superblock is reduced by a task of its own to that node, and the nodes so
found are the next layer's; a layer has a thousandth of the rows of the one
below.  Downwards, the nodes of a superblock and the outer nodes it needs --
the siblings on the way from its top to the root, a few dozen digests -- are
cogrouped by superblock, and one pass over the group does the local reduction,
joins the proofs and folds each leaf (or the leaf put in its place) up to the
root.  So no task holds more than a superblock, whatever the share of a
language, and nothing but the number of layers reaches the driver.

Positions come from a range sort by language, id, leaf and row number and the
counts of its partitions, so rows of one id, or equal rows, may be any share.

Defined cases: a null column enters the leaf as ``-``; a null language is a
language of its own, before all others; null ids come first; rows of one id
are ordered by their leaf; repeated rows are leaves each, with equal leaves
and proofs of their own; a very long text is hashed where it lies and never
moved; columns beyond the five are neither read nor hashed; an empty table
gives an empty manifest.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazrank.llm.common import documents, ship_package, shuffle_partitions, staged

#: Nodes of a superblock: 2 ** BLOCK_BITS.
BLOCK_BITS = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: A level of a path: the sibling's side and digest, or that there is none.
LEFT, RIGHT, NONE = "L", "R", "-"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values: dict | None = None):
    """The leaf of columns ``COLUMNS``, some of them replaced by ``values``."""
    parts = []
    for c in COLUMNS:
        text = (values or {}).get(c, F.col(c)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def levels(n: int) -> int:
    """Levels between ``n`` nodes and the one that remains of them."""
    return (n - 1).bit_length()


def reduced(nodes: list[str], steps: int) -> list[list[str]]:
    """All levels of a superblock, ``steps`` above the lowest."""
    out = [nodes]
    for _ in range(steps):
        low = out[-1]
        out.append([digest(*low[k:k + 2]) for k in range(0, len(low), 2)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[str]:
    """Of node ``at`` of the lowest level, its path's steps to the tree's top."""
    path = []
    for level in tree[:-1]:
        other = at ^ 1
        path.append(NONE if other >= len(level) else (LEFT if other < at else RIGHT) + level[other])
        at >>= 1
    return path


def folded(node: str, path: list[str]) -> str:
    for step in path:
        node = digest(step[1:], node) if step[0] == LEFT else digest(node, step[1:])
    return node


def _positions(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` (with ``tree``) and ``pos``, their place in their tree by
    ``order``, and ``n``, the number of the tree's rows."""
    n = shuffle_partitions(rows.sparkSession)
    keys = [F.col("tree"), *order]
    ordered = staged(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    # one row for each partition and tree in it
    held = ordered.groupBy(part, "tree").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    upto = Window.partitionBy("tree").orderBy("_part")
    held = held.withColumn("_base", F.sum("_rows").over(upto) - F.col("_rows")).withColumn("n", F.sum("_rows").over(Window.partitionBy("tree")))
    held = held.select("_part", "tree", (F.col("_base") - F.col("_first")).alias("_shift"), "n")
    return ordered.withColumn("_part", part).join(held, ["_part", "tree"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _layers(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The layers of all trees (``tree, pos, n, node``), lowest first; in the
    last each tree has one node.  Their number is the logarithm of the
    greatest tree's size."""
    def up(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n = int(part["n"].iloc[0])
        top = reduced(part["node"].tolist(), min(bits, levels(n)))[-1]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n >> bits)], "node": top})

    out = [nodes.select("tree", "pos", "n", "node")]
    most = out[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        low = out[-1].withColumn("block", F.shiftright("pos", bits))
        out.append(staged(low.groupBy("tree", "block").applyInPandas(up, "tree string, pos long, n long, node string")))
        most = -(-most >> bits)
    return out


def _paths(layer: DataFrame, outer: DataFrame, bits: int) -> DataFrame:
    """``outer`` (``tree, pos, path, subroot, root``) of the layer above,
    carried down to the nodes of ``layer``."""
    def down(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        o = above.iloc[0]
        tree = reduced(part["node"].tolist(), min(bits, levels(int(part["n"].iloc[0]))))
        paths = [",".join(siblings(tree, k) + ([o["path"]] if o["path"] else [])) for k in range(len(part))]
        return pd.DataFrame({"tree": part["tree"], "pos": part["pos"], "path": paths, "subroot": o["subroot"], "root": o["root"]})

    low = layer.withColumn("block", F.shiftright("pos", bits)).groupBy("tree", "block")
    return low.cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(
        down, "tree string, pos long, path string, subroot string, root string")


def _proofs(leaves: DataFrame, outer: DataFrame, bits: int) -> DataFrame:
    """Leaves (``tree, pos, n, node, doc_id, changed``) and the outer nodes of
    their superblocks: proof and fold of each leaf."""
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def prove(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        o = above.iloc[0]
        tree = reduced(part["node"].tolist(), min(bits, levels(int(part["n"].iloc[0]))))
        out_path = o["path"].split(",") if o["path"] else []
        out_digests = "".join(s[1:] for s in out_path)
        to_root: dict[str, str] = {}  # of each node that a leaf folds to at the superblock's top
        proof, root = [], []
        for k, leaf in enumerate(part["changed"]):
            path = siblings(tree, k)
            proof.append(digest("".join(s[1:] for s in path), out_digests))
            top = folded(leaf, path)
            if top not in to_root:
                to_root[top] = folded(top, out_path)
            root.append(to_root[top])
        return pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "leaf": part["node"], "subroot": o["subroot"], "root": o["root"], "proof_sha256": proof, "folded_root": root})[columns]

    low = leaves.withColumn("block", F.shiftright("pos", bits)).groupBy("tree", "block")
    return low.cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(
        prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def manifest(rows: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Of ``rows`` (``doc_id, lang, leaf`` and ``changed``, the leaf to fold in
    the place of ``leaf``): the trees (``lang, n, subroot, root``) and a row
    each with ``doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified``."""
    ship_package(rows.sparkSession)
    tree = F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit(""))  # null before all others
    rows = staged(rows.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), F.col("leaf").alias("node"), "changed",
                              F.monotonically_increasing_id().alias("_row")))
    leaves = _positions(rows, [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("_row")])
    lower = _layers(leaves, bits)
    subroots = lower[-1].select(F.lit("").alias("tree"), F.col("tree").alias("member"), F.col("node"))
    subroots = staged(_positions(subroots, [F.col("member")]))
    upper = _layers(subroots, bits)

    outer = upper[-1].select("tree", "pos", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for layer in reversed(upper[:-1]):
        outer = staged(_paths(layer, outer, bits))
    # the upper tree's lowest nodes are the lower trees' tops
    tops = subroots.select("member", "pos", "node").join(outer.select("pos", "path", "root"), "pos")
    outer = staged(tops.select(F.col("member").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"), "root"))
    trees = outer.join(leaves.groupBy("tree").agg(F.first("n").alias("n")), "tree")
    trees = trees.select(F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("lang"), "n", "subroot", "root")
    for layer in reversed(lower[1:-1]):
        outer = staged(_paths(layer, outer, bits))
    proofs = _proofs(leaves, outer, bits)
    return trees, proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    """Contract query: leaves of all documents, of which those whose id's
    crc32 7 divides are folded with one more in ``n_chars``."""
    docs = documents(spark, sf_dir).select(*COLUMNS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    rows = docs.select("doc_id", "lang", leaf_of().alias("leaf"), F.when(hit, leaf_of({"n_chars": F.col("n_chars") + 1})).alias("other"))
    return manifest(rows.withColumn("changed", F.coalesce("other", "leaf")))[1]


#: crc32 of the id's digits, bit by bit; a recursive query per level.
ORACLE_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) AS crc
  FROM documents),
f AS (
  SELECT *, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-')) AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS size,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR, '-') AS other
  FROM d),
leaves AS (
  SELECT doc_id, coalesce('s' || lang, '') AS tree, sha256(head || size || tail) AS leaf,
         CASE WHEN crc % 7 = 0 THEN sha256(head || other || tail) ELSE sha256(head || size || tail) END AS changed
  FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY tree, level, pos // 2),
subroots AS (
  SELECT tree, level AS height, node AS subroot, row_number() OVER (ORDER BY tree COLLATE "C") - 1 AS place FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, place AS pos, subroot AS node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY level, pos // 2),
steps AS (
  SELECT p.tree, p.pos AS leaf_pos, l.level AS step, xor(p.pos >> l.level, 1) < (p.pos >> l.level) AS is_left, o.node AS sibling
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM low WHERE n > 1) l ON l.tree = p.tree
  LEFT JOIN low o ON o.tree = p.tree AND o.level = l.level AND o.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.tree, p.pos, s.height + l.level, xor(s.place >> l.level, 1) < (s.place >> l.level), o.node
  FROM placed p JOIN subroots s ON s.tree = p.tree CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) l
  LEFT JOIN high o ON o.level = l.level AND o.pos = xor(s.place >> l.level, 1)),
folds AS (
  SELECT tree, pos, 0 AS step, changed AS node FROM placed
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, sha256(CASE WHEN t.sibling IS NULL THEN f.node WHEN t.is_left THEN t.sibling || f.node ELSE f.node || t.sibling END)
  FROM folds f JOIN steps t ON t.tree = f.tree AND t.leaf_pos = f.pos AND t.step = f.step),
proofs AS (
  SELECT tree, leaf_pos AS pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof FROM steps GROUP BY tree, leaf_pos),
ends AS (SELECT tree, pos, arg_max(node, step) AS folded_root FROM folds GROUP BY tree, pos)
SELECT p.doc_id, p.leaf, s.subroot, h.node AS root, coalesce(q.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = h.node AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN ends e ON e.tree = p.tree AND e.pos = p.pos
LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos CROSS JOIN (SELECT node FROM high WHERE n = 1) h
"""
