"""A Merkle manifest of a table of documents, kept as one hex string per level of an aligned block.

* Leaf: the SHA-256 of a row's fields, each with its byte count in front. The whole text is hashed in the pass that reads it;
  after that only digests travel.
* Place: the leaves of a group (a language) ascend by document. They are sorted by ranges of (group, document, leaf), so a
  large group is spread over many tasks, and a leaf's place is its place in its range plus the counts of the ranges before.
* Block: ``BLOCK`` leaves whose places start at a multiple of ``BLOCK`` are one row. A level of a block is one string of hex
  digests of 64 characters. The parents of a level are the hashes of its substrings of 128 characters; the last one may
  be shorter and is hashed alone. The root of a block is a leaf of the next tier, and so on until a group has one root.
* Proof: at each level the substring on the other side of a node's pair is its sibling. It stands to the left or to the right of
  the node, or is empty. Siblings of a tier are cut from its level strings when the siblings of the tier above
  are known, so a block takes its upper siblings once for all its leaves.
* The roots of all groups, ordered by group (null first, then by the bytes of its name), are the leaves of a last tree.

Everything is DataFrame functions. Defined results: null fields count as ``-``; a null document id comes first in its group
and a null group before all others; rows with equal ids go by their leaves, and repeated rows have one leaf each; a group of one
leaf has it as its root; an empty table has no rows. Only the named fields are read, other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 64  # hex characters of a digest
LEVELS = 8  # of a block
BLOCK = 1 << LEVELS
ROWS_PER_PART = 500_000


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The hash of the fields, each as ``-`` or as its number of bytes, a colon and its value."""
    texts = [c.cast("string") for c in fields]
    return digest(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``place`` (from 0) of each row in its group and ``size`` of the group. ``rows`` is a written table.

    Groups are cut where the ranges end, so none is in one task; the counts that are summed by group are one row for each
    range that holds it.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_PER_PART + 1)
    keys = [*group, *order]
    number = {"_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    sorted_rows = materialize(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns(number), "merkle-order")
    counts = sorted_rows.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_nth").alias("_first"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col("_part").alias("_in"), (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size"))
    same = F.col("_part") == F.col("_in")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return sorted_rows.join(counts, same).select(*rows.columns, (F.col("_nth") + F.col("_shift")).alias("place"), "size")


def parents(level: Column) -> Column:
    """The level above: the hashes of each two nodes, the last of one alone if their number is odd."""
    last = F.floor((F.octet_length(level) - 1) / (2 * DIGEST)).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), last), lambda k: F.sha2(F.substring(level, k * (2 * DIGEST) + 1, F.lit(2 * DIGEST)), 256))
    return F.array_join(pairs, "").cast("binary")


def tiers(nodes: DataFrame, payload: Sequence[str] = ()) -> list[DataFrame]:
    """Blocks of ``nodes(tree, place, size, node, *payload)`` and of the roots of blocks above them, up to one block for each tree:
    ``(tree, block, size, depth, levels, members, root)``, where ``levels`` are strings and ``members`` hold the payload."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    found = []
    while True:
        held = F.array_sort(F.collect_list(F.struct("place", "node", *payload)))
        blocks = nodes.groupBy("tree", F.floor(F.col("place") / BLOCK).alias("block")).agg(F.first("size").alias("size"), held.alias("held"))
        # A tree of one block ends at its root; the blocks of a larger one all have the same number of levels.
        depth = F.when(F.col("size") > BLOCK, LEVELS).when(F.col("size") <= 1, 0).otherwise(F.length(F.bin(F.col("size") - 1))).cast("int")
        leaves = F.array_join(F.transform("held", lambda m: m["node"]), "").cast("binary")
        blocks = blocks.select("tree", "block", "size", depth.alias("depth"), F.array(leaves).alias("leaves"), F.transform("held", lambda m: F.struct(m["place"].alias("place"), *[m[c].alias(c) for c in payload])).alias("members"))
        grown = F.aggregate(F.sequence(F.lit(1), F.col("depth")), F.col("leaves"), lambda levels, _: F.concat(levels, F.array(parents(F.element_at(levels, -1)))))
        blocks = blocks.withColumn("levels", F.when(F.col("depth") > 0, grown).otherwise(F.col("leaves"))).drop("leaves")
        blocks = materialize(blocks.withColumn("root", F.element_at("levels", -1).cast("string")), "merkle-blocks")
        found.append(blocks)
        if most <= BLOCK:
            return found
        most = -(-most // BLOCK)
        nodes, payload = blocks.select("tree", F.col("block").alias("place"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("root").alias("node")), ()


def with_steps(blocks: DataFrame, above: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """``(tree, place, node, steps, *payload)`` and the other columns of ``above(tree, place, steps, ...)``, which has the siblings above
    the root of each block. ``steps`` are pairs of the digests left and right of a node, from its leaf to the top."""
    carried = [c for c in above.columns if c not in ("tree", "place", "steps")]
    above = above.withColumnsRenamed({"place": "block", "steps": "upper"})
    rows = blocks.select("tree", "block", "depth", "levels", "members").join(above, ["tree", "block"])
    rows = rows.select("tree", "depth", "levels", "upper", *carried, F.inline("members"))
    at = F.pmod(F.col("place"), F.lit(BLOCK)).cast("int")
    own = []
    for level in range(LEVELS):
        node = F.shiftright(at, level)
        sibling = F.coalesce(F.substring(F.get("levels", F.lit(level)), node.bitwiseXOR(F.lit(1)) * DIGEST + 1, F.lit(DIGEST)).cast("string"), F.lit(""))
        is_right = node.bitwiseAND(F.lit(1)) == 1
        own.append(F.struct(F.when(is_right, sibling).otherwise("").alias("left"), F.when(is_right, "").otherwise(sibling).alias("right")))
    node = F.substring(F.get("levels", F.lit(0)), at * DIGEST + 1, F.lit(DIGEST)).cast("string")
    steps = F.concat(F.slice(F.array(*own), F.lit(1), F.col("depth")), F.col("upper"))
    return rows.select("tree", "place", node.alias("node"), steps.alias("steps"), *carried, *payload)


def roots(blocks: DataFrame) -> DataFrame:
    return blocks.select("tree", "root")


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """``(doc_id, lang, place, leaf, steps, subroot, root, changed_leaf)`` of every row of ``docs``.

    ``steps`` is the proof of the leaf, see ``with_steps``. ``changed_leaf`` is the hash of the row after ``changed`` has replaced
    some of its fields, or null where that hash is the same.
    """
    fields = [F.col(c) for c in FIELDS]
    leaf = leaf_digest(fields)
    other = F.lit(None).cast("string")
    if changed:
        after = [changed.get(c, F.col(c)) for c in FIELDS]
        differs = F.lit(False)
        for c, value in changed.items():
            differs = differs | ~value.eqNullSafe(F.col(c))
        other = F.when(differs, leaf_digest(after))
    # The last column tells repeated rows apart, so that ranges can cut them; it does not change which leaf has which place.
    leaves = materialize(docs.select("doc_id", "lang", leaf.alias("node"), other.alias("changed_leaf"), F.monotonically_increasing_id().alias("_row")), "merkle-leaves")
    placed = numbered(leaves, ["lang"], ["doc_id", "node", "_row"])
    groups = numbered(materialize(leaves.select("lang").distinct(), "merkle-groups"), [], ["lang"])
    trees = groups.select(F.col("lang").alias("_lang"), F.col("place").alias("tree"), F.col("size").alias("n_trees"))
    nodes = placed.join(trees, F.col("lang").eqNullSafe(F.col("_lang"))).select("tree", "place", "size", "node", "doc_id", "changed_leaf")
    payload = ("doc_id", "changed_leaf")
    leaf_tiers = tiers(nodes, payload)
    subroots = roots(leaf_tiers[-1]).join(trees, "tree")
    top_tiers = tiers(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("n_trees").alias("size"), F.col("root").alias("node")))

    none = F.array().cast("array<struct<left: string, right: string>>")
    above = roots(top_tiers[-1]).select("tree", F.lit(0).cast("long").alias("place"), none.alias("steps"), "root")
    for blocks in reversed(top_tiers):
        above = with_steps(blocks, above).drop("node")
    # A place in the last tree is the tree of a group.
    above = above.select(F.col("place").alias("tree"), "steps", "root").join(subroots.select("tree", F.col("_lang").alias("lang"), F.col("root").alias("subroot")), "tree")
    above = above.withColumn("place", F.lit(0).cast("long"))
    for blocks in reversed(leaf_tiers[1:]):
        above = materialize(with_steps(blocks, above).drop("node"), "merkle-steps")
    rows = with_steps(leaf_tiers[0], above, payload)
    return rows.select("doc_id", "lang", "place", F.col("node").alias("leaf"), "steps", "subroot", "root", "changed_leaf")


def folded(leaf: Column, steps: str) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(F.col(steps), leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(steps: str) -> Column:
    return digest(F.array_join(F.flatten(F.transform(steps, lambda s: F.array(s["left"], s["right"]))), ""))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    rows = manifest(docs, {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed_leaf", "leaf"), "steps"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest("steps").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def crc32_sql(text: str) -> str:
    """The CRC-32 of an ASCII string in DuckDB: a byte is added, then eight bits are shifted out."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    shift = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, x: {shift}), 4294967295)"


def _field_sql(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"CASE WHEN {value or name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c, n_chars if c == "n_chars" else None) for c in FIELDS) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All levels ``(g, v, i, h)`` of the trees over ``leaves(g, i, h)``."""
    return f"""{name} AS (
  SELECT g, 0 AS v, i, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
  UNION ALL
  SELECT g, v + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM {name} WHERE n > 1 GROUP BY g, v, i // 2
)"""


# The levels of the tree of groups follow those of a row's group.
OP11_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} END AS other FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS i, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM d
), leaves AS (SELECT g, i, leaf AS h FROM p), {_tree_sql("t", "leaves")},
subroots AS (SELECT g, h, v FROM t WHERE n = 1),
tops AS (SELECT 0 AS g, g AS i, h FROM subroots), {_tree_sql("u", "tops")},
root AS (SELECT h, v FROM u WHERE n = 1),
steps AS (
  SELECT p.g, p.i, t.v, t.h AS sibling, t.i < (p.i >> t.v) AS is_left FROM p JOIN t ON t.g = p.g AND t.i = xor(p.i >> t.v, 1)
  UNION ALL
  SELECT p.g, p.i, s.v + u.v, u.h, u.i < (p.g >> u.v) FROM p JOIN subroots s ON s.g = p.g JOIN u ON u.i = xor(p.g >> u.v, 1)
), fold AS (
  SELECT g, i, 0 AS v, coalesce(other, leaf) AS h FROM p
  UNION ALL
  SELECT f.g, f.i, f.v + 1, sha256(CASE WHEN s.is_left THEN s.sibling ELSE '' END || f.h || CASE WHEN NOT s.is_left THEN s.sibling ELSE '' END)
  FROM fold f JOIN subroots m ON m.g = f.g CROSS JOIN root LEFT JOIN steps s ON s.g = f.g AND s.i = f.i AND s.v = f.v WHERE f.v < m.v + root.v
), folded AS (
  SELECT g, i, arg_max(h, v) AS h FROM fold GROUP BY 1, 2
), proofs AS (
  SELECT g, i, sha256(string_agg(sibling, '' ORDER BY v)) AS proof FROM steps GROUP BY 1, 2
)
SELECT p.doc_id, p.leaf, s.h AS subroot, root.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM p JOIN subroots s ON s.g = p.g CROSS JOIN root JOIN folded f ON f.g = p.g AND f.i = p.i LEFT JOIN proofs q ON q.g = p.g AND q.i = p.i
"""
