"""Merkle manifest of a dataset: a hash tree over each group's rows and one over the groups' roots.

Slot pivot: the children of a parent are spread by conditional aggregates into one column per
slot. Concatenating the columns gives what the parent hashes; leaving out a child's own slot gives
its siblings, those left of it and those right of it. So a level is one aggregation by (group,
parent), of which no group has more than ``fanout`` rows, and the proofs come down the tree by
exploding the slots again: a row's path is its siblings followed by the path of its parent.

Rows are placed by ranges of (group, order) of even size, so a group of any share is spread. Texts
are hashed where they are read; from there on only digests travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import LOWER, UPPER, row_digest, saved, sha
from docket.llm.ordered import places

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<l:string,r:string>>"


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, digest, lambda h, s: sha(F.concat(s["l"], h, s["r"])))


def siblings(path: Column) -> Column:
    """All siblings on the way to the root, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")


def _pivot(nodes: DataFrame, fanout: int, *payload: str) -> DataFrame:
    """One row per parent: (g, up, n, c0.., payload0..)."""
    slot = F.col("pos") % fanout
    spread = [F.max(F.when(slot == k, F.col(c))).alias(f"{c}{k}") for c in ("digest", *payload) for k in range(fanout)]
    return nodes.groupBy("g", F.floor(F.col("pos") / fanout).alias("up")).agg(F.max("n").alias("n"), *spread)


def _parents(pivot: DataFrame, fanout: int) -> DataFrame:
    return pivot.filter("n > 1").select("g", F.col("up").alias("pos"), F.ceil(F.col("n") / fanout).alias("n"),
                                        sha(F.concat_ws("", *[f"digest{k}" for k in range(fanout)])).alias("digest"))


def _tree(leaves: DataFrame, height: int, fanout: int, *payload: str) -> tuple[list[DataFrame], DataFrame]:
    """The pivots of every level, lowest first, and each group's root (g, digest).

    ``height`` is the levels of the largest group; a smaller one ends lower. Groups of a single
    node have a row in the lowest pivot that hashes nothing.
    """
    pivots = [saved(_pivot(leaves, fanout, *payload), "level")]
    roots = pivots[0].filter("n = 1").select("g", F.col("digest0").alias("digest"))
    nodes = _parents(pivots[0], fanout)
    for _ in range(1, height):
        pivots.append(saved(_pivot(nodes.filter("n > 1"), fanout), "level"))
        roots = roots.unionByName(nodes.filter("n = 1").select("g", "digest"))
        nodes = _parents(pivots[-1], fanout)
    return pivots, roots.unionByName(nodes.filter("n = 1").select("g", "digest"))


def _children(pivot: DataFrame, fanout: int, *payload: str) -> DataFrame:
    """A pivot with its parents' ``path``, back in a row per child: (g, pos, path, payload)."""
    slots = {c: F.array(*[f"{c}{k}" for k in range(fanout)]).alias(f"{c}s") for c in ("digest", *payload)}
    rows = pivot.select("g", "up", "n", "path", *slots.values()).select("*", F.posexplode("digests").alias("slot", "digest")).filter("digest IS NOT NULL")
    beside = F.struct(F.array_join(F.slice("digests", 1, F.col("slot")), "").alias("l"),
                      F.array_join(F.slice("digests", F.col("slot") + 2, fanout), "").alias("r"))
    path = F.when(F.col("n") > 1, F.concat(F.array(beside), F.col("path"))).otherwise(F.col("path"))
    return rows.select("g", (F.col("up") * fanout + F.col("slot")).alias("pos"), path.alias("path"), "digest",
                       *[F.col(f"{c}s")[F.col("slot")].alias(c) for c in payload])


def _down(pivots: list[DataFrame], tops: DataFrame, fanout: int, *payload: str) -> DataFrame:
    """(g, digest, path, payload) of every leaf, from the paths ``tops`` (top, path) of the groups' roots."""
    above = None
    for k in range(len(pivots) - 1, -1, -1):
        here = pivots[k]
        last = here.filter(F.col("n") <= fanout).join(tops, F.col("g") == F.col("top")).drop("top")
        if above is not None:
            up = above.select(F.col("g").alias("top"), F.col("pos").alias("top_pos"), "path")
            last = last.unionByName(here.filter(F.col("n") > fanout).join(
                up, (F.col("g") == F.col("top")) & (F.col("up") == F.col("top_pos"))).drop("top", "top_pos"))
        above = _children(last, fanout, *(payload if k == 0 else ()))
    return above


def _height(nodes: int, fanout: int) -> int:
    levels = 1
    while nodes > fanout:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def manifest(docs: DataFrame, *carried: Column, id_col: str = "doc_id", group_col: str = "source",
             fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT) -> DataFrame:
    """One row per document: id, group, leaf, subroot, root, path and the ``carried`` columns.

    ``path`` lists for every level from the leaf to the root the digests left and right of the
    node on the way, so ``fold(leaf, path) == root``. Leaves are ordered by (id, digest), nulls first;
    groups by the bytes of their name, a null one first and apart from the empty one. Equal rows are
    leaves of their own. A group of one leaf has that leaf as its subroot, a table of one group its
    subroot as root. Null fields hash as ``-``. Columns not in ``fields`` are not read; an empty table
    gives no rows.
    """
    names = [f"carried_{k}" for k in range(len(carried))]
    group = F.col(group_col).cast("string")
    own = docs.select(F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"), F.col(id_col).alias("id"),
                      row_digest(*[F.col(c) for c in fields]).alias("digest"), *[c.alias(x) for c, x in zip(carried, names, strict=True)])
    own = saved(own.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = places(own, "g", "id", "digest", "row")
    placed = placed.select("g", "pos", "n", "digest", F.struct("id", *names).alias("own"))
    largest = own.groupBy("g").count().agg(F.max("count")).first()[0] or 1
    pivots, subroots = _tree(placed, _height(largest, fanout), fanout, "own")

    subroots = saved(subroots, "subroots").withColumn("all", F.lit("*"))
    groups = places(subroots, "all", "g").select(F.col("all").alias("g"), "pos", "n", "digest", F.struct(F.col("g").alias("name")).alias("own"))
    upper, root = _tree(groups, _height(subroots.count(), fanout), fanout, "own")
    root = root.first()
    one = docs.sparkSession.createDataFrame([("*", [])], f"top string, path {PATH}")  # the path of the root itself
    tops = saved(_down(upper, one, fanout, "own").select(F.col("own.name").alias("top"), "path", F.col("digest").alias("subroot")), "tops")
    out = _down(pivots, tops.select("top", "path"), fanout, "own")
    named = tops.select(F.col("top").alias("name"), "subroot")
    return out.join(named, F.col("g") == F.col("name")).select(
        F.col("own.id").alias(id_col), F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias(group_col), F.col("digest").alias("leaf"),
        "subroot", F.lit(root.digest if root else None).cast("string").alias("root"), "path",
        *[F.col(f"own.{x}").alias(x) for x in names])


def tampered_rows(doc_id: Column) -> Column:
    """Rows whose id's crc32 is divisible by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def verify(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` and the verification of its proofs after tampering: texts of
    ``tampered_rows`` are then lower-cased in A-Z (nulls stay), their leaf is hashed again and folded
    with the original siblings."""
    text = F.when(tampered_rows(F.col("doc_id")), F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    seen = row_digest(*[text if c == "text" else F.col(c) for c in FIELDS])
    out = manifest(docs, seen)
    out = out.select("doc_id", "leaf", "subroot", "root", sha(siblings(F.col("path"))).alias("proof_sha256"),
                     fold(F.col("carried_0"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
  FROM range(256) x(b)
), base AS (
  SELECT row_number() OVER () AS id, doc_id, source,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
         xor(list_reduce(list_transform(range(1, 1 + length(coalesce(doc_id::VARCHAR, ''))), lambda i: ascii(substr(doc_id::VARCHAR, i::BIGINT, 1))::BIGINT),
                         lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]), 4294967295::BIGINT), 4294967295) % 5 = 0 AS tampered
  FROM documents, crc_table
), hashed AS (
  SELECT id, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(u) || ':' || u, '-')) AS seen
  FROM (SELECT *, CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS u FROM base)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM hashed
), up AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // 16, max((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY source, lvl, pos // 16
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, max((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 16
), steps AS (
  SELECT source, lvl, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM up WHERE n > 1 WINDOW w AS (PARTITION BY source, lvl, pos // 16 ORDER BY pos)
), top_steps AS (
  SELECT lvl, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM top WHERE n > 1 WINDOW w AS (PARTITION BY lvl, pos // 16 ORDER BY pos)
), way AS (
  SELECT x.id, s.lvl AS k, s.l, s.r FROM leaves x JOIN steps s ON s.source IS NOT DISTINCT FROM x.source AND s.pos = x.pos // (16 ** s.lvl)::BIGINT
  UNION ALL
  SELECT x.id, 1000 + s.lvl, s.l, s.r FROM leaves x JOIN subroots u ON u.source IS NOT DISTINCT FROM x.source JOIN top_steps s ON s.pos = u.pos // (16 ** s.lvl)::BIGINT
), paths AS (
  SELECT id, list(struct_pack(l := l, r := r) ORDER BY k) AS path, string_agg(l || r, '' ORDER BY k) AS proof FROM way GROUP BY id
), fold AS (
  SELECT x.id, 1 AS k, x.seen AS h, p.path FROM leaves x LEFT JOIN paths p USING (id)
  UNION ALL
  SELECT id, k + 1, sha256(path[k].l || h || path[k].r), path FROM fold WHERE k <= len(path)
), folded AS (
  SELECT id, arg_max(h, k) AS folded_root FROM fold GROUP BY id
)
SELECT x.doc_id, x.leaf, u.subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root,
       f.folded_root = (SELECT digest FROM top WHERE n = 1) AS verified
FROM leaves x JOIN subroots u ON u.source IS NOT DISTINCT FROM x.source LEFT JOIN paths p USING (id) JOIN folded f USING (id)
"""
