"""Merkle dataset manifest: one hash tree per language over whole rows, one tree over their roots, a proof per row.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. Rows of a language
ascend by id; runs of ``arity`` consecutive nodes become the hash of their hex digests, also a last, shorter run.
Every level is an equijoin of the nodes with themselves, shifted to the siblings' positions (``idx XOR 1`` for pairs, the
``arity - 1`` other slots otherwise); the rows at slot zero then emit the parents. Going down again, a node's path is its
siblings followed by its parent's path.

Defined results: a null language forms a group of its own, ordered first, and a null id comes first in its group; equal ids are ordered
by leaf, equal rows in any order (they are interchangeable, but each has its own place and proof); empty and null texts have different
leaves; a lone leaf is its own root with an empty proof; an empty table gives an empty manifest; other columns don't enter.
Only rows whose id is known are tampered with in ``audited``.

Scale: texts are hashed where they are read and never move; places come from one range partitioning over (language, id, leaf,
row number), so a language, an id or a repeated row may hold any share of the rows. Every level is a written table of
``1 / arity`` of the rows of the one below; the digests of a level meet by key, never in one task or at the driver, which
only learns the sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.llm.common import Workspace, in_fold

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
DIGEST = 32
TAMPERED_FOLDS = 7
_NODES_PER_FILE = 200_000
_LEVELS_PER_TABLE = 5


def digest(value: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(value.cast("binary"), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def encoded(column: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(F.concat(*[encoded(c) for c in columns]))


def group_key(lang: Column) -> Column:
    """Sorts as the language does byte by byte, null first."""
    return F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), lang.cast("string")))


def placed(rows: DataFrame, order: Sequence[str], workspace: Workspace) -> DataFrame:
    """A stored table with ``idx``, a row's place from 0 in its ``key`` by ``order``, and ``n``, the rows of the key.

    One range partitioning over all of ``key`` and ``order`` (which ends with a row number, so that equal rows spread), then
    counts per key and partition.
    """
    ranged = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    stored = workspace.table(ranged.withColumn("at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("at", 33)
    runs = stored.groupBy("key", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    n = F.sum("rows").over(Window.partitionBy("key"))
    offsets = workspace.table(runs.select("key", "part", "first", (upto - F.col("rows")).alias("before"), n.alias("n")), "offsets")
    found = stored.withColumn("part", part).join(offsets, ["key", "part"])
    return found.withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop("part", "first", "before", "at")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with ``others``, the digests of the rest of their run in order, as one binary: equijoins on shifted places."""
    slot = F.col("idx") % arity
    if arity == 2:
        shifts = [("s1", F.col("idx").bitwiseXOR(F.lit(1).cast("bigint")))]
    else:
        shifts = [(f"s{o}", F.col("idx") - slot + (slot + o) % arity) for o in range(1, arity)]
    joined = nodes
    for name, place in shifts:
        other = nodes.select("key", F.col("idx").alias(f"{name}_idx"), F.col("digest").alias(name))
        joined = joined.withColumn(f"{name}_idx", place).join(other, ["key", f"{name}_idx"], "left")
    # offset o of slot s is slot (s + o) % arity: in slot order, those that wrap come first
    absent = F.lit(b"")
    ordered = []
    for other_slot in range(arity):
        found = absent
        for s in range(arity):
            if s != other_slot:
                found = F.when(slot == s, F.coalesce(F.col(f"s{(other_slot - s) % arity}"), absent)).otherwise(found)
        ordered.append(found)
    return joined.select(*nodes.columns, F.concat(*ordered).alias("others"))


def run_digest(own: Column, others: Column, slot: Column) -> Column:
    """Digest of a run from one of its nodes: the hex digests before it, its own, those after it."""
    cut = (slot * DIGEST).cast("int")
    before, after = F.substring(others, F.lit(1), cut), F.substring(others, cut + 1, F.length(others))
    return digest(hex_text(F.concat(before, own, after)))


def levels(leaves: DataFrame, workspace: Workspace, arity: int = ARITY) -> list[DataFrame]:
    """Stored tables ``(key, idx, n, digest, others)`` from the leaves upward, until every key has one node."""
    bare = leaves.select("key", "idx", "n", "digest")
    tables: list[DataFrame] = []
    while True:
        size = bare.groupBy().agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count(F.lit(1)).alias("nodes")).first()
        made = _with_siblings(bare, arity).coalesce(1 + size["nodes"] // _NODES_PER_FILE)
        tables.append(workspace.table(made, f"level{len(tables)}"))
        if size["most"] <= 1:
            return tables
        heads = tables[-1].filter((F.col("n") > 1) & (F.col("idx") % arity == 0))
        bare = heads.select(
            "key",
            F.floor(F.col("idx") / arity).cast("bigint").alias("idx"),
            F.ceil(F.col("n") / arity).cast("bigint").alias("n"),
            run_digest(F.col("digest"), F.col("others"), F.lit(0)).alias("digest"),
        )


def top_nodes(tables: Sequence[DataFrame]) -> DataFrame:
    """``(key, digest)`` of every key's last node."""
    found = [t.filter(F.col("n") == 1).select("key", "digest") for t in tables]
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return whole


def paths(tables: Sequence[DataFrame], workspace: Workspace, arity: int = ARITY) -> DataFrame:
    """``(key, idx, path)`` of the leaves: ``path`` lists ``others`` of every level upward."""
    empty = F.expr("cast(array() as array<binary>)")
    found = tables[-1].select("key", "idx", empty.alias("path"))
    for depth, table in enumerate(reversed(tables[:-1]), 1):
        above = found.select("key", F.col("idx").alias("up"), F.col("path").alias("rest"))
        own = table.withColumn("up", F.when(F.col("n") > 1, F.floor(F.col("idx") / arity).cast("bigint")))
        path = F.when(F.col("n") > 1, F.concat(F.array("others"), F.col("rest"))).otherwise(empty)
        found = own.join(above, ["key", "up"], "left").select("key", "idx", path.alias("path"))
        if depth % _LEVELS_PER_TABLE == 0 and depth < len(tables) - 1:
            found = workspace.table(found, "paths")
    return found


def folded(leaf: Column, idx: Column, path: Column, arity: int = ARITY) -> Column:
    """The root that a leaf at a place and its path lead to."""
    start = F.struct(leaf.alias("digest"), idx.alias("idx"))

    def up(node: Column, others: Column) -> Column:
        made = run_digest(node["digest"], others, node["idx"] % arity)
        return F.struct(made.alias("digest"), F.floor(node["idx"] / arity).cast("bigint").alias("idx"))

    return F.aggregate(path, start, up)["digest"]


def manifest(docs: DataFrame, workspace: Workspace, arity: int = ARITY, altered: Column | None = None) -> DataFrame:
    """``(doc_id, leaf, altered, key, idx, path, key_idx, key_path, subroot, root)``, digests as bytes.

    ``altered`` is a second digest to carry with every row, such as that of changed fields.
    """
    fields = [F.col(f) for f in FIELDS]
    second = leaf_digest(fields) if altered is None else altered
    rows = docs.select("doc_id", group_key(F.col("lang")).alias("key"), leaf_digest(fields).alias("digest"), second.alias("altered"))
    hashed = workspace.table(rows.withColumn("row_number", F.monotonically_increasing_id()), "leaves")
    leaves = workspace.table(placed(hashed, ["doc_id", "digest", "row_number"], workspace).drop("row_number"), "places")
    tables = levels(leaves, workspace, arity)
    subroots = workspace.table(top_nodes(tables), "subroots")
    tops = placed(subroots.withColumnRenamed("key", "lang_key").withColumn("key", F.lit("")), ["lang_key"], workspace)
    tops = workspace.table(tops, "tops")
    top_levels = levels(tops, workspace, arity)
    root = top_nodes(top_levels).select("key", F.col("digest").alias("root"))
    above = tops.join(paths(top_levels, workspace, arity), ["key", "idx"]).join(root, "key")
    above = above.select(
        F.col("lang_key").alias("key"), F.col("idx").alias("key_idx"), F.col("path").alias("key_path"), F.col("digest").alias("subroot"), "root"
    )
    below = leaves.select("doc_id", "key", "idx", F.col("digest").alias("leaf"), "altered")
    return below.join(paths(tables, workspace, arity), ["key", "idx"]).join(workspace.table(above, "above"), "key")


def proof_digest(path: Column, key_path: Column) -> Column:
    """SHA-256 over the hex digests of all siblings, level by level."""
    return hex_text(digest(F.concat(*[F.array_join(F.transform(p, hex_text), "") for p in (path, key_path)])))


def root_of(leaf: Column, arity: int = ARITY) -> Column:
    """The root that a manifest row's place and proof give for ``leaf``."""
    subroot = folded(leaf, F.col("idx"), F.col("path"), arity)
    return folded(subroot, F.col("key_idx"), F.col("key_path"), arity)


def audited(docs: DataFrame, workspace: Workspace | None = None, arity: int = ARITY) -> DataFrame:
    """The manifest's digests in hex, and the check of every row against its proof after some rows were tampered with."""
    workspace = workspace or Workspace(docs.sparkSession)
    tampered = in_fold(F.col("doc_id"), TAMPERED_FOLDS, 0)
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    altered = leaf_digest([n_chars if f == "n_chars" else F.col(f) for f in FIELDS])
    rows = manifest(docs, workspace, arity, F.when(tampered, altered))
    found = root_of(F.coalesce("altered", "leaf"), arity)
    return rows.select(
        "doc_id",
        *[hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        proof_digest(F.col("path"), F.col("key_path")).alias("proof_sha256"),
        hex_text(found).alias("folded_root"),
        (found == F.col("root")).alias("verified"),
    )
