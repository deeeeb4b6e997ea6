"""A manifest of a dataset as a Merkle tree: a digest of each row, of each group, and of the whole, with proofs.

A parent's preimage is the joined digests of its children. Those are stored, one row for each parent, and go down the
tree: a row's proof is the list of its ancestors' preimages with its own place in each. Its siblings are what is left of
a preimage without the row's own 64 characters; another version of the row is checked by putting its digest in their
place and hashing upwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat.llm.common import bounded, stored

#: Characters of a digest.
HEX = 64
#: Bytes of proofs that are broadcast at most; above that parents meet their children in a shuffle.
PROOF_BYTES = 32 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the joined parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length, so that no two rows join to the same bytes: '-' for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def ranked(df: DataFrame, groups: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """df stored with _pos (place in its group in order, nulls first) and _n (rows of the group); and the groups with _n.

    Rows are dealt in ranges and sorted within them, so that a group may fill any number of tasks; a row's place is its
    place in its range plus the rows of its group in the ranges before. Only a row for each range and group is summed.
    """
    by = [F.col(c).asc_nulls_first() for c in (*groups, *order)]
    ordered = stored(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    counts = ordered.groupBy(*groups, part).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    mine = Window.partitionBy(*[F.col(g) for g in groups]) if groups else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_rows").over(mine.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marks = stored(counts.select(*[F.col(g).alias(f"_{g}") for g in groups], F.col("_part").alias("_mark"), (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(mine).alias("_n")))
    meet = F.shiftright("_at", 33) == F.col("_mark")
    for g in groups:
        meet = meet & F.col(g).eqNullSafe(F.col(f"_{g}"))
    out = ordered.join(bounded(marks), meet).withColumn("_pos", F.col("_at") + F.col("_shift"))
    sizes = marks.groupBy(*[F.col(f"_{g}").alias(g) for g in groups]).agg(F.max("_n").alias("_n"))
    return out.select(*df.columns, "_pos", "_n"), sizes


def levels(nodes: DataFrame, largest: int, fan: int) -> list[DataFrame]:
    """nodes (tree, pos, n, digest) and the levels above them, each stored with its preimages; trees of one node end."""
    out = [nodes]
    while largest > 1:
        runs = out[-1].where("n > 1").groupBy("tree", F.expr(f"pos div {fan}").alias("pos"))
        children = F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda c: c.digest)
        up = runs.agg(F.expr(f"(max(n) + {fan - 1}) div {fan}").alias("n"), F.array_join(children, "").alias("preimage"))
        out.append(stored(up.withColumn("digest", F.sha2("preimage", 256))))
        largest = -(-largest // fan)
    return out


def _descend(children: DataFrame, parents: DataFrame, tops: DataFrame, fan: int, small: bool) -> DataFrame:
    """children with their path: their parent's preimage, their place in it and the parent's path; a tree's top node (n = 1) has the path of tops."""
    up = parents.select(F.col("tree").alias("_tree"), F.col("pos").alias("_up"), F.struct(F.col("preimage")).alias("_own"), F.col("path").alias("_path"), F.col("subroot"))
    meet = (F.col("tree") == F.col("_tree")) & (F.expr(f"pos div {fan}") == F.col("_up"))
    step = F.struct(F.col("_own.preimage").alias("preimage"), F.expr(f"cast(pos % {fan} as int)").alias("slot"))
    low = children.where("n > 1").join(F.broadcast(up) if small else up, meet).select(*children.columns, "subroot", F.concat(F.array(step), "_path").alias("path"))
    top = children.where("n = 1").join(tops, "tree").select(*children.columns, F.col("digest").alias("subroot"), F.col("path"))
    return low.unionByName(top)


def siblings(path: Column) -> Column:
    """The digests beside a node and beside its ancestors, from below, left to right, joined."""
    rest = lambda p: F.concat(F.substring(p.preimage, F.lit(1), p.slot * HEX), F.substring(p.preimage, p.slot * HEX + HEX + 1, F.length(p.preimage)))
    return F.array_join(F.transform(path, rest), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to."""
    splice = lambda h, p: F.sha2(F.concat(F.substring(p.preimage, F.lit(1), p.slot * HEX), h, F.substring(p.preimage, p.slot * HEX + HEX + 1, F.length(p.preimage))), 256)
    return F.aggregate(path, leaf, splice)


def manifest(docs: DataFrame, now: Column | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text", fan: int = 8) -> DataFrame:
    """id, leaf, subroot, root, siblings, folded_root, verified of every row of docs.

    leaf is the digest of fields. In each value of group_col the leaves ascend by id_col; every fan consecutive nodes
    have their digest as a parent until one is left, the group's subroot. Subroots ascend by group and lead to root in the same way.
    siblings is the proof, folded_root what the proof leads to if the text is now (default: the text as it is), verified
    whether that is root.

    Nulls are values of their own and sort first, in group and id too. Rows that share an id are leaves of their own, in
    the order of their digests. A text counts whole, empty or long. A group of one row has its leaf as subroot, a table of
    one group its subroot as root; an empty table gives no rows. Other columns are left out, whatever their names.

    Plan: texts are read once and never shuffled; leaves are put in order by one range shuffle of digests, so that a
    group may be all of the table. A level has an eighth of the rows of the one below, and a parent's children are combined
    before they are shuffled. Proofs go down the other way: a parent's row holds the preimages above it, so that each
    leaf is joined once, to its parent.
    """
    rest = [F.col(f"`{c}`") for c in fields]
    changed = digest(*[field(now if c == text_col else F.col(f"`{c}`")) for c in fields]) if now is not None else F.lit(None).cast("string")
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), digest(*map(field, rest)).alias("leaf"), changed.alias("changed")))
    leaves, groups = ranked(rows, ["grp"], ["id", "leaf"])
    trees, _ = ranked(groups.withColumnRenamed("_n", "_size"), [], ["grp"])
    trees = stored(trees.select(F.col("grp").alias("_grp"), F.col("_pos").alias("tree"), F.col("_n").alias("trees"), F.col("_size").alias("size")))
    sizes = trees.agg(F.max("size"), F.max("trees"), *[F.sum(F.ceil(F.col("size") / fan**i)) for i in range(64) if fan**i < 1 << 62]).first()
    largest, n_trees = sizes[0] or 0, sizes[1] or 0
    placed = leaves.join(bounded(trees), F.col("grp").eqNullSafe(F.col("_grp")))
    nodes = stored(placed.select("tree", F.col("_pos").alias("pos"), F.col("_n").alias("n"), F.col("leaf").alias("digest"), "id", "changed"))
    below = levels(nodes, largest, fan)

    tops = below[0].where("n = 1").select("tree", "digest")
    for level in below[1:]:
        tops = tops.union(level.where("n = 1").select("tree", "digest"))
    subroots = stored(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).cast("long").alias("n"), "digest"))
    above = levels(subroots, n_trees, fan)
    top = above[-1].first()
    path = F.array().cast("array<struct<preimage:string,slot:int>>")
    # the top node of all has no parent: its own path is empty
    end = subroots.sparkSession.range(1).select(F.col("id").alias("tree"), path.alias("path"))
    proofs = None
    depth = len(below) + len(above)

    def small(count: int, height: int) -> bool:
        return count * (depth - height) * (fan * HEX + 16) <= PROOF_BYTES

    for i in range(len(above) - 1, -1, -1):
        proofs = above[i].join(F.broadcast(end), "tree").withColumn("subroot", F.col("digest")) if proofs is None else _descend(above[i], proofs, end.limit(0), fan, small(-(-n_trees // fan ** (i + 1)), len(below) + i))
    groups_path = proofs.select(F.col("pos").alias("tree"), "path")
    groups_path = F.broadcast(groups_path) if small(n_trees, len(below)) else groups_path
    proofs = None
    for i in range(len(below) - 1, -1, -1):
        if proofs is None:
            proofs = below[i].join(groups_path, "tree").withColumn("subroot", F.col("digest"))
        else:
            proofs = _descend(below[i], proofs, groups_path, fan, small(sizes[2 + i + 1] or 0, i + 1))
    root = F.lit(top.digest if top else None).cast("string")
    folded = fold(F.coalesce("changed", "digest"), F.col("path"))
    out = proofs.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", root.alias("root"), siblings(F.col("path")).alias("siblings"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
