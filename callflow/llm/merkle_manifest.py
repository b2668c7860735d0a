"""A Merkle manifest of a dataset: digest-to-children records, and proofs by descent from the root."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callflow.session import written

#: Children of a node.
FAN = 3


def text_digest(*parts: Column) -> Column:
    """Sha256 of some strings one after the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def row_digest(columns: list[Column]) -> Column:
    return text_digest(*[field(c) for c in columns])


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, as_hex), "")


def in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df``, a table, numbered from 0 without gaps in ``order``, which must tell all rows apart.

    Ranges of the order are sorted apart; the rows of each are numbered by Spark and moved up by
    the rows of those before, of which there is one number per partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_id", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row per partition of the ranges.
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_start", "_id")
    )


@dataclass
class Manifest:
    """A dataset's tree of trees. Every table is a file in the shared folder, so a lost executor costs no digest.

    ``leaves`` (tree, at, leaf, and the columns kept) and ``trees`` (group, tree, n, subroot) tell
    which leaf is which; ``levels[k]`` holds the distinct ``(digest, children)`` records of level
    k + 1 of the groups' trees, ``top`` those of the tree over their subroots. ``root`` is null
    for an empty dataset.
    """

    leaves: DataFrame
    trees: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None

    def save(self, path: str) -> None:
        """The records of all levels, as one table of digest and children, and the leaves and trees beside it."""
        for k, level in enumerate(self.levels):
            level.write.parquet(f"{path}/records/tree=groups/level={k + 1}")
        for k, level in enumerate(self.top):
            level.write.parquet(f"{path}/records/tree=top/level={k + 1}")
        self.leaves.write.parquet(f"{path}/leaves")
        self.trees.write.parquet(f"{path}/trees")


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records of each level over ``nodes(tree, at, n, digest)``, and ``(tree, digest)`` of what remains of each tree.

    A level is a third of the one below, so all levels together shuffle one and a half times the leaves.
    """
    levels, roots = [], nodes.where("n = 1").select("tree", "digest")
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        run = F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"])
        grouped = nodes.where("n > 1").groupBy("tree", F.floor(F.col("at") / FAN).alias("at"), "n").agg(run.alias("children"))
        grown = grouped.select(
            "tree", "at", F.ceil(F.col("n") / FAN).alias("n"), "children", text_digest(_joined(F.col("children"))).alias("digest")
        )
        grown = written(grown, "level")
        # Content-addressed: equal runs of children are one record.
        levels.append(written(grown.select("digest", "children").dropDuplicates(["digest"]), "records"))
        roots = roots.unionByName(grown.where("n = 1").select("tree", "digest"))
        nodes = grown.drop("children")
        largest = -(-largest // FAN)
    return levels, roots


def build(rows: DataFrame, group: str, order: list[str], leaf: str = "leaf") -> Manifest:
    """The manifest of a table with a binary ``leaf`` digest in each row.

    Leaves of a group ascend by ``order`` (null first; ties by digest, rows equal in both are
    alike). While a group has several nodes, every three consecutive ones become their digest, the
    last run being shorter, even one; what remains is its subroot, a lone leaf itself. Subroots in
    the order of the groups (null first, bytewise) make the root likewise. A null group is a group.
    Rows are numbered over ranges of (group, order), so a group of any size is spread; no level
    brings more than three nodes together. An empty table gives a manifest without root.
    ``rows`` is read several times: pass a table.
    """
    marked = written(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, leaf, "_row")]
    ordered = written(in_order(marked, keys, "_at").drop("_row"), "numbered")
    of_groups = written(ordered.groupBy(group).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("n")), "groups")
    trees = in_order(of_groups, [F.col(group).asc_nulls_first()], "tree")
    trees = written(trees, "trees")
    keyed = trees.select(F.col(group).alias("_group"), "tree", "n", "_from")
    leaves = ordered.join(keyed, F.col(group).eqNullSafe(F.col("_group"))).withColumn("at", F.col("_at") - F.col("_from"))
    leaves = written(leaves.drop("_group", "_from", "_at"), "placed")
    levels, subroots = _levels(leaves.select("tree", "at", "n", F.col(leaf).alias("digest")))
    trees = written(trees.drop("_from").join(subroots.withColumnRenamed("digest", "subroot"), "tree"), "subroots")
    over = trees.count()
    top, root = _levels(
        trees.select(F.lit(0).alias("tree"), F.col("tree").alias("at"), F.lit(over).alias("n"), F.col("subroot").alias("digest"))
    )
    found = root.first()
    return Manifest(leaves, trees, levels, top, bytes(found["digest"]) if found else None)


def _descend(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """Requests one digit further down: each child of their nodes, with the children that were not selected."""
    met = frontier.join(records.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"))
    others = [c for c in frontier.columns if c not in ("digest", "at", "path")]
    return met.select(
        *others, "at", "path", "children", F.posexplode("children").alias("_digit", "_child")
    ).select(
        *others,
        (F.col("at") * FAN + F.col("_digit")).alias("at"),
        F.col("_child").alias("digest"),
        F.array_append("path", segment(F.col("children"), F.col("_digit"))).alias("path"),
    )


def segment(children: Column, digit: Column) -> Column:
    """The unselected children of a node: those left and those right of the selected one, in hex."""
    return F.struct(
        _joined(F.slice(children, F.lit(1), digit)).alias("left"),
        _joined(F.slice(children, digit + 2, F.lit(FAN))).alias("right"),
    )


NO_PATH = "CAST(array() AS array<struct<left: string, right: string>>)"


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Leaves with ``subroot`` and ``path``, the segments of siblings from the leaf up to the root.

    ``requests`` are rows of ``manifest.leaves`` (all, if none are given). A request carries the
    digits to base three of its tree's rank and of its leaf's; those with the same digits so far are
    at the same node and travel down as one row, so a level has as many rows as it has requested
    nodes, and its records are read once. The last digit is taken where the requests join their
    leaves' parents. Levels are written, so that a lost executor costs one of them.
    """
    asked = manifest.leaves if requests is None else requests
    spark = manifest.leaves.sparkSession
    if manifest.root is None:
        return asked.limit(0).withColumn("subroot", F.lit(None).cast("binary")).withColumn("path", F.expr(NO_PATH))
    wanted = None
    if requests is not None:  # the digits that are asked for, level by level
        wanted = [written(asked.select("tree", F.floor(F.col("at") / FAN).alias("at")).distinct(), "asked")]
        for _ in manifest.levels[1:]:
            wanted.append(written(wanted[-1].select("tree", F.floor(F.col("at") / FAN).alias("at")).distinct(), "asked"))
    down = spark.createDataFrame([(0, manifest.root)], "at long, digest binary").withColumn("path", F.expr(NO_PATH))
    for records in reversed(manifest.top):
        down = written(_descend(down, records), "down")
    trees = manifest.trees.select("tree", "n")
    tops = down.select(F.col("at").alias("_tree"), F.col("digest").alias("subroot"), "digest", "path")
    tops = written(tops.join(trees, F.col("_tree") == F.col("tree")).drop("_tree"), "tops")
    # A tree of up to 3^k leaves has k levels.
    depth = F.when(F.col("n") == 1, 0)
    for k in range(1, len(manifest.levels) + 1):
        depth = depth.when(F.col("n") <= FAN**k, k)
    tops = tops.select("tree", "subroot", F.lit(0).cast("long").alias("at"), "digest", "path", depth.alias("depth"))
    frontier = None
    for k in range(len(manifest.levels), 0, -1):
        begin = tops.where(F.col("depth") == k).drop("depth")
        frontier = begin if frontier is None else frontier.unionByName(begin)
        if wanted is not None:
            frontier = frontier.join(wanted[k - 1], ["tree", "at"], "left_semi")
        if k > 1:
            frontier = written(_descend(frontier, manifest.levels[k - 1]), "down")
    lone = tops.where("depth = 0").select("tree", "at", "subroot", "path", F.lit(None).cast("array<binary>").alias("children"))
    if frontier is None:
        parents = lone
    else:
        records = manifest.levels[0].withColumnRenamed("digest", "_digest")
        parents = frontier.join(records, F.col("digest") == F.col("_digest"))
        parents = parents.select("tree", "at", "subroot", "path", "children").unionByName(lone)
    parents = parents.withColumnsRenamed({"tree": "_tree", "at": "_parent"})
    met = (F.col("tree") == F.col("_tree")) & (F.floor(F.col("at") / FAN) == F.col("_parent"))
    digit = (F.col("at") % FAN).cast("int")
    last = F.when(F.col("children").isNull(), F.col("path")).otherwise(
        F.array_append("path", segment(F.col("children"), digit))
    )
    return asked.join(parents, met).withColumn("path", F.reverse(last)).drop("_tree", "_parent", "children")


def proof_digest(path: Column) -> Column:
    """Sha256, in hex, of all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root, in hex, that a leaf's hex digest makes with its siblings."""
    return F.aggregate(
        path, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]).cast("binary"), 256)
    )


def document_proofs(documents: DataFrame) -> DataFrame:
    """The leaf, subroot, root and proof of every document, and whether a changed copy would be found out.

    A leaf is the digest of doc_id, source, lang, n_chars and text; groups are sources, in which
    leaves ascend by doc_id (null first, ties by leaf). Of documents whose id has an even crc32 a
    copy without the line breaks of its text is folded up, of others the row itself; ``verified``
    tells whether that gives the root. A null id is not tampered with, a null text stays null.
    Repeated rows are leaves of their own. An empty table gives no rows. Other columns are not read.
    """
    key = F.col("doc_id").cast("string")
    tampered = F.coalesce(F.crc32(key.cast("binary")) % 2 == 0, F.lit(False)) & F.contains("text", F.lit("\n"))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = documents.select(
        "doc_id",
        "source",
        row_digest([*fields, F.col("text")]).alias("leaf"),
        F.when(tampered, row_digest([*fields, F.regexp_replace("text", "\n", "")])).alias("changed"),
    )
    manifest = build(leaves, "source", ["doc_id"])
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    return (
        prove(manifest)
        .select(
            "doc_id",
            as_hex(F.col("leaf")).alias("leaf"),
            as_hex(F.col("subroot")).alias("subroot"),
            root.alias("root"),
            proof_digest(F.col("path")).alias("proof_sha256"),
            folded(as_hex(F.coalesce("changed", "leaf")), F.col("path")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
