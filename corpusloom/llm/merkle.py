"""A Merkle manifest of a table, and the proof of every row against its root.

1. Every row has a leaf digest: sha256 over its columns, each `-` if NULL, else its length in UTF-8 bytes, `:` and the value.
2. Leaves of one group (a source) are ordered by key. Their places come from a range-partitioned sort: each partition numbers
   its own rows, and a table of (group, partition) counts, which has no row per leaf, gives what lies before. So a group that
   holds a third of all rows is many tasks.
3. Every `FANOUT` consecutive nodes of a level become one node, until one is left, the group's subroot; subroots in order of
   their group make the top tree in the same way. Built levels are stored as rows (node_id, parent_id, slot, run), `run` being
   the digests of the node's children. The first level's rows also hold their leaves.
4. A recursive query climbs from the leaves to the root: each step joins the row that it has come to by `parent_id`, appends the
   siblings found there to the proof and folds the digest of the claimed leaf with them. The up to `FANOUT` leaves of one run have
   all siblings but those of the first level in common, so a row of the climb is a run with one folded digest per leaf.

A step keeps a row for each run; what it appends is `FANOUT` - 1 digests. Digests are 32 bytes inside and hex text where they are
hashed. Tables of every level are written in the shared folder, so a lost executor repeats one level. Every join is on node ids;
rows that share an ancestor meet it by broadcast where the level is small, else by a sort-merge join that splits skewed keys.

Defined: NULL groups come first, groups in order of their bytes. NULL keys come first. Rows of equal key go by leaf digest; rows
that are equal altogether have equal digests, so their order changes nothing, and a random last key spreads them over partitions.
A group of one row has the leaf as its subroot; one group's subroot is the root. An empty table has no root and no rows. Very
long texts are hashed whole. Columns other than those named take no part, and are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.store import cut

FANOUT = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Manifest:
    """`runs`: nodes of the first level with their leaves; `nodes`: all nodes above; `subroots`: one row per group."""

    runs: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def field_text(value: Column) -> Column:
    """`-` for NULL, else the length in UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    """sha256 over the values of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(v) for v in values]), 256))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _hashed(*digests: Column) -> Column:
    """H of 32-byte digests, put together as hex text."""
    return F.unhex(F.sha2(F.concat(*[_hex(d) for d in digests]), 256))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.unhex(F.lit("")), lambda all_, one: F.concat(all_, one))


def _split(run: Column, slot: Column) -> tuple[Column, Column]:
    """What lies left and right of a slot in a run of 32-byte digests."""
    return F.substring(run, F.lit(1), 32 * slot), F.substring(run, 32 * slot + 33, F.lit(32 * FANOUT))


def placed(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """`df` with its 0-based place in its group as `pos` and the size of the group as `size`; no task holds a group."""
    keys = [F.col(group).asc_nulls_first(), *order]
    number = F.monotonically_increasing_id()
    dealt = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", number), name)
    part = F.shiftrightunsigned("_at", 33).alias("_part")
    counted = dealt.groupBy(F.col(group).alias("_group"), part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    of_group = Window.partitionBy("_group")
    before = F.sum("_n").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    spans = counted.select(
        "_group", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(of_group).alias("size")
    )
    here = dealt.withColumn("_here", F.shiftrightunsigned("_at", 33))
    joined = here.join(spans, (F.col("_here") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_here", "_part", "_group", "_shift")


def _node_id(level: int, pos: Column, group: Column) -> Column:
    return F.concat(F.lit(f"{level}/"), pos.cast("string"), F.lit("/"), F.coalesce(F.concat(F.lit("="), group), F.lit("-")))


def _top_id(level: int, pos: Column) -> Column:
    return F.concat(F.lit(f"top/{level}/"), pos.cast("string"))


def _above(pos: Column) -> Column:
    return F.floor(pos / FANOUT).cast("bigint")


def _fewer(size: Column) -> Column:
    return F.floor((size + FANOUT - 1) / FANOUT).cast("bigint")


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _levels(nodes: DataFrame, group: list[str], first: int, node_id, name: str) -> list[DataFrame]:
    """All levels above `nodes` (group, pos, size, digest), each written: (group, level, pos, size, node_id, run, digest)."""
    built, level = [], first
    while (nodes.agg(F.max("size")).first()[0] or 0) > 1:
        children = F.sort_array(F.collect_list(F.struct("pos", "digest")))
        up = (
            nodes.where("size > 1")
            .groupBy(*group, _above(F.col("pos")).alias("above"))
            .agg(_fewer(F.first("size")).alias("size"), _joined(F.transform(children, lambda c: c["digest"])).alias("run"))
            .withColumnRenamed("above", "pos")
            .withColumn("node_id", node_id(level, F.col("pos")))
            .withColumn("digest", _hashed(F.col("run")))
        )
        built.append(cut(up, f"{name}-{level}"))
        nodes, level = built[-1].select(*group, "pos", "size", "digest"), level + 1
    return built


def build(leaves: DataFrame) -> Manifest:
    """The manifest of leaves (group_key string, key, leaf binary, claimed binary)."""
    spread = F.rand(seed=17)
    order = [F.col("key").asc_nulls_first(), F.col("leaf"), F.col("spread")]
    stored = cut(leaves.select("group_key", "key", "leaf", "claimed").withColumn("spread", spread), "merkle-leaves")
    member = F.struct("pos", "key", "leaf", "claimed")
    runs = (
        placed(stored, "group_key", order, "merkle-order")
        .groupBy("group_key", _above(F.col("pos")).alias("above"))
        .agg(F.first("size").alias("leaves"), F.sort_array(F.collect_list(member)).alias("members"))
        .withColumnRenamed("above", "pos")
        .withColumn("run", _joined(F.transform("members", lambda m: m["leaf"])))
        .withColumn("digest", F.when(F.col("leaves") > 1, _hashed(F.col("run"))).otherwise(F.col("run")))
        .withColumn("size", _fewer(F.col("leaves")))
        .withColumn("node_id", _node_id(1, F.col("pos"), F.col("group_key")))
    )
    runs = cut(runs, "merkle-runs")

    def own_id(level: int, pos: Column) -> Column:
        return _node_id(level, pos, F.col("group_key"))

    link = ["group_key", "level", "pos", "size", "node_id", "run", "digest"]
    levels = _levels(runs.select("group_key", "pos", "size", "digest"), ["group_key"], 2, own_id, "merkle-level")
    levels = [df.withColumn("level", F.lit(k)).select(link) for k, df in enumerate(levels, 2)]
    subroots = _union([runs.withColumn("level", F.lit(1)).select(link), *levels]).where("size = 1")
    subroots = subroots.select("group_key", "node_id", "digest").withColumn("all_groups", F.lit(0))
    subroots = placed(subroots, "all_groups", [F.col("group_key").asc_nulls_first()], "merkle-groups")
    subroots = cut(subroots, "merkle-subroots")

    top = _levels(subroots.select("all_groups", "pos", "size", "digest"), ["all_groups"], 1, _top_id, "merkle-top")
    last = (top[-1] if top else subroots).where("size = 1").select("digest").first()
    top = [
        df.withColumn("parent_id", F.when(F.col("size") > 1, _top_id(k + 1, _above(F.col("pos")))))
        .withColumn("slot", (F.col("pos") % FANOUT).cast("int"))
        .select("node_id", "parent_id", "slot", "run")
        for k, df in enumerate(top, 1)
    ]
    # A subroot's parent is a run of the top tree; all other nodes have theirs one level up in their own tree.
    to_top = subroots.select(
        F.col("node_id").alias("subroot_id"),
        F.when(F.col("size") > 1, _top_id(1, _above(F.col("pos")))).alias("top_parent"),
        (F.col("pos") % FANOUT).cast("int").alias("top_slot"),
    )

    def linked(df: DataFrame, level: int) -> DataFrame:
        inside = df.where("size > 1").withColumn("parent_id", _node_id(level + 1, _above(F.col("pos")), F.col("group_key")))
        inside = inside.withColumn("slot", (F.col("pos") % FANOUT).cast("int"))
        at_top = df.where("size = 1").join(to_top, F.col("node_id") == F.col("subroot_id"))
        at_top = at_top.withColumn("parent_id", F.col("top_parent")).withColumn("slot", F.col("top_slot"))
        return inside.unionByName(at_top.drop("subroot_id", "top_parent", "top_slot"))

    above = [linked(df, k).select("node_id", "parent_id", "slot", "run") for k, df in enumerate(levels, 2)] + top
    none = stored.sparkSession.createDataFrame([], "node_id string, parent_id string, slot int, run binary")
    nodes = cut(_union([none, *above]), "merkle-nodes")
    return Manifest(linked(runs, 1), nodes, subroots, last and bytes(last[0]).hex())


@contextmanager
def _without_row_limit(spark: SparkSession):
    """A recursive query may make at most so many rows by default; this one makes one per run and level."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, -1)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# {left} and {right}: the siblings on both sides of the slot that the climb has come to.
CLIMB = """
WITH RECURSIVE climb (start, parent_id, slot, folded, proof) AS (
  SELECT node_id, parent_id, slot, folded, unhex('') FROM {runs}
  UNION ALL
  SELECT c.start, n.parent_id, n.slot,
    transform(c.folded, f -> unhex(sha2(concat(lower(hex({left})), lower(hex(f)), lower(hex({right}))), 256))),
    concat(c.proof, {left}, {right})
  FROM climb c JOIN {nodes} n ON c.parent_id = n.node_id
)
SELECT start, folded, proof FROM climb WHERE parent_id IS NULL
"""
SIDES = {"left": "substring(n.run, 1, 32 * c.slot)", "right": f"substring(n.run, 32 * c.slot + 33, {32 * FANOUT})"}


def verify(manifest: Manifest) -> DataFrame:
    """Every leaf with its subroot, the root, the digest of its proof and the root folded from its claimed digest.

    Returns group_key, key, leaf, claimed, subroot, root, proof_sha256, folded_root (hex text) and verified.
    """
    spark, runs = manifest.runs.sparkSession, manifest.runs

    def first_fold(member: Column, slot: Column) -> Column:
        left, right = _split(F.col("run"), slot)
        return F.when(F.col("leaves") > 1, _hashed(left, member["claimed"], right)).otherwise(member["claimed"])

    start = runs.select("node_id", "parent_id", "slot", F.transform("members", first_fold).alias("folded"))
    # SQL's own parameters take the two tables, so no view is registered in the session.
    with _without_row_limit(spark):
        climbed = cut(spark.sql(CLIMB.format(runs="{runs}", nodes="{nodes}", **SIDES), runs=start, nodes=manifest.nodes), "merkle-climb")
    subroots = manifest.subroots.select(F.col("group_key").alias("_group"), F.col("digest").alias("_subroot"))
    leaf = F.explode(F.arrays_zip("members", "folded"))
    rows = (
        runs.join(climbed, F.col("node_id") == F.col("start"))
        .join(subroots, F.col("group_key").eqNullSafe(F.col("_group")))
        .select("group_key", "pos", "run", "leaves", "proof", _hex(F.col("_subroot")).alias("subroot"), leaf.alias("m"))
    )
    left, right = _split(F.col("run"), (F.col("m.members.pos") % FANOUT).cast("int"))
    proof = F.concat(_hex(left), _hex(right), _hex(F.col("proof")))
    root = F.lit(manifest.root).cast("string")
    folded = _hex(F.col("m.folded"))
    return rows.select(
        "group_key",
        F.col("m.members.key").alias("key"),
        _hex(F.col("m.members.leaf")).alias("leaf"),
        _hex(F.col("m.members.claimed")).alias("claimed"),
        "subroot",
        root.alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )


def leaves_of(df: DataFrame, group: str, key: str, columns: Sequence[str], claimed: dict[str, Column] | None = None) -> DataFrame:
    """The leaves of a table; `claimed` gives columns as they are claimed to be, where they differ from those of the table."""
    claimed = claimed or {}
    return df.select(
        F.col(group).cast("string").alias("group_key"),
        F.col(key).alias("key"),
        leaf_digest([F.col(c) for c in columns]).alias("leaf"),
        leaf_digest([claimed.get(c, F.col(c)) for c in columns]).alias("claimed"),
    )


DOCUMENT = ("doc_id", "source", "lang", "n_chars", "text")


def every_fifth(key: Column) -> Column:
    """True where 5 divides the unsigned crc32 of the decimal key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def checked_documents(docs: DataFrame) -> DataFrame:
    """The proofs of a table of documents, of which every fifth, by crc32 of its id, claims a text in lower case."""
    tampered = F.when(every_fifth(F.col("doc_id")), lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return verify(build(leaves_of(docs, "source", "doc_id", DOCUMENT, {"text": tampered})))
