"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

A text without its white space is cut where its own characters say so, so that a passage is cut
alike wherever it stands. A chunk's identifier is its 64-bit hash plus a rank that is 0 unless
different chunks share the hash: one shuffle of the distinct chunks proves which hashes stand
for one content (the verified identifiers), and the others, normally none, get ranks by
content. A text's recipe is its ordered list of identifiers, computed where the document is;
from there on only recipes are shuffled and compared. Equal recipes are equal texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import SPACE, saved

MIN_CHUNK, MAX_CHUNK = 128, 4096  # code points
# A chunk ends after a pair of characters of these classes, in Latin text one place in about
# 30 to 120; text without such pairs is cut at MAX_CHUNK.
CUT = "[iouIOU.,0-4а-з一-仿][acmpwACMPW5-9и-н倀-忿]"
KEEP_BITS = 64


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def chunks(text: Column) -> Column:
    """Content-defined chunks; joined they are the text."""
    pattern = f"(?s).{{{MIN_CHUNK - 2},{MAX_CHUNK - 2}}}?(?:{CUT})|(?s).{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_hash(chunk: Column, bits: int = KEEP_BITS) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else h.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def ambiguous_chunks(docs: DataFrame, bits: int) -> DataFrame:
    """(h, chunk, rank) for hashes that more than one chunk has. Chunks are combined before the
    shuffle, so a chunk that every document holds arrives once per task."""
    each = docs.select(F.explode(chunks(normalised(F.col("_text")))).alias("chunk"))
    once = each.groupBy(chunk_hash(F.col("chunk"), bits).alias("h"), "chunk").agg(F.count(F.lit(1)).alias("n"))
    twice = once.groupBy("h").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("h")
    if twice.isEmpty():
        return None
    again = once.join(twice, "h").groupBy("h").agg(F.array_sort(F.collect_list("chunk")).alias("all"))
    return again.select("h", F.posexplode("all").alias("rank", "chunk"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = KEEP_BITS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after deleting white space; a null text counts as empty. Of
    equal texts the one with the most code points, then the smallest id, stays. Rows with a null
    id take part (a null id is the smallest); rows repeated with one id and text share their
    fate and all count in group_size. Other columns are not read. An empty table gives no rows.
    ``hash_bits`` narrows the chunk hash (tests use it to make hashes collide).
    """
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    text = normalised(F.col("_text"))
    recipe = own.select("_id", "_text", F.length(F.coalesce("_text", F.lit(""))).cast("long").alias("chars"),
                        F.sha2(text.cast("binary"), 256).alias("text_sha256"), chunks(text).alias("chunks"))
    recipe = recipe.withColumn("hashes", F.transform("chunks", lambda c: chunk_hash(c, hash_bits)))
    ambiguous = ambiguous_chunks(own, hash_bits)
    if ambiguous is None:
        recipe = recipe.select("_id", "chars", "text_sha256", "hashes", F.lit(None).cast("array<int>").alias("ranks"))
    else:
        recipe = recipe.withColumn("row", F.monotonically_increasing_id())
        recipe = saved(recipe.select("row", "_id", "chars", "text_sha256", "hashes", "chunks"), "recipes")
        at = recipe.select("row", F.posexplode("chunks").alias("pos", "chunk"))
        at = at.withColumn("h", chunk_hash(F.col("chunk"), hash_bits)).join(ambiguous, ["h", "chunk"], "inner")
        ranks = at.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "rank"))).alias("x"))
        recipe = recipe.join(ranks.select("row", F.col("x")["rank"].alias("ranks")), "row", "left").drop("row", "chunks")
    recipe = saved(recipe, "recipes")
    # the recipe's hash first, so that sorting and comparing rarely reach the lists
    key = [F.xxhash64("hashes", "ranks").alias("k"), "hashes", F.coalesce("ranks", F.array().cast("array<int>")).alias("ranks")]
    keyed = recipe.select("_id", "chars", "text_sha256", *key)
    groups = keyed.groupBy("k", "hashes", "ranks").agg(
        F.min(F.struct((-F.col("chars")).alias("c"), F.col("_id").alias("i"))).alias("best"),
        F.count(F.lit(1)).alias("group_size"))
    # only groups of two and more come back to their documents; they are written first, so that a hot
    # group is a skewed join of two plain shuffles, which AQE splits
    twins = saved(groups.filter("group_size > 1").select("k", "hashes", "ranks", F.col("best.i").alias("keep_id"), "group_size"), "twins")
    out = keyed.join(twins, ["k", "hashes", "ranks"], "left")
    single = F.col("group_size").isNull()
    return out.select(
        F.col("_id").alias(id_col), F.when(single, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS n
  FROM documents
), w AS (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY n) AS group_size, n
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM w
"""
