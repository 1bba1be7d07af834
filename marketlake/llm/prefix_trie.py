"""Prefix trie of conversations by van Emde Boas recursion, every subproblem of a depth at once.

A trie of height 2^k is cut at half its height. The upper trie holds the prefixes down to the
cut; every prefix that reaches the cut is named and is the root of a lower trie. Both halves are
cut again, until single turns are left. A level of the recursion is one Spark job over all its
tries, so k = log2(longest conversation) levels do what turn-by-turn work needs a level each for:

* *blocks*, upwards: the name of 2^j turns from those of its two halves;
* *names*, downwards: the cut prefix of a trie is its root's name with the name of the block
  above the cut, which starts the lower trie. At the bottom every prefix has its name;
* *totals*, upwards: in a trie of height 2^(j+1) the roots of the lower tries hand their totals
  to the prefix they hang from, which grafts them on its ancestors in the upper trie.

A name is a 256-bit digest, so equal names are equal sequences. A node is identified by its
smallest member and its depth: it is the first ``depth`` turns of conversation ``conv_id``.
Only conversations that are the smallest member of some node carry the totals, so copies drop out
early. Rows are keyed by (conversation, place): a conversation that holds a third of all turns is
spread over all tasks. What is keyed by a node is added up before it is shuffled; the one lookup
from conversations to nodes is a join whose hot nodes adaptive execution splits; the root, which
all share, is not looked up. The member list of a node is joined in pieces of 4096 ids, which are
hashed in order as they stream by: a node where very many end is one stream, never one value.

Defined results: rows without conversation id are left out; null role and text are empty; turns
with the same number stand in the order of their digests; repeated rows are turns of their own.
An empty table gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged
from marketlake.operators.numbering import numbered

#: Ids of a node's member list that are joined to one piece of text (a power of two, in bits).
PIECE_BITS = 12
#: Ancestors listed in one array when totals are grafted.
SPREAD = 4096


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _div(c: str, by: int) -> Column:
    return F.call_function("div", F.col(c), F.lit(by)).cast("long")


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, at, digest, n_bytes) with ``at`` from 0 in the order of turn (null first), and
    conversations (conv, n_turns)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        _digest(F.char_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    rows = numbered(rows, ["conv", F.col("turn").asc_nulls_first(), "digest"], "nr")
    convs = staged(rows.groupBy("conv").agg(F.min("nr").alias("first"), F.count(F.lit(1)).alias("n_turns")), "trie-convs")
    turns = rows.join(convs, "conv").select("conv", (F.col("nr") - F.col("first")).alias("at"), "digest", "n_bytes")
    return turns, convs.select("conv", "n_turns")


def with_shared_openings(turns: DataFrame, convs: DataFrame, family: int = 5, openings: int = 9) -> DataFrame:
    """The turns of every conversation c with its first h = crc32(c) mod ``openings`` turns replaced
    by those of conversation c - c mod ``family`` (all if it has fewer, none if there is none)."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(openings)).cast("long")
    info = convs.select("conv", "n_turns", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    lengths = info.select(F.col("conv").alias("base"), F.col("n_turns").alias("n_base"))
    info = staged(info.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "trie-info")
    own = turns.join(info.select("conv", "h", "taken"), "conv").where("at >= h") \
        .select("conv", (F.col("taken") + F.col("at") - F.col("h")).alias("at"), "digest", "n_bytes")
    heads = turns.where((F.col("at") < openings - 1) & (F.col("conv") % family == 0)).withColumnRenamed("conv", "base")
    lent = heads.join(info.select("conv", "base", "h"), "base").where("at < h").select("conv", "at", "digest", "n_bytes")
    return own.union(lent)


def _prefix_names(turns: DataFrame, convs: DataFrame, height: int) -> DataFrame:
    """(conv, depth, name) of every prefix of every conversation, the empty one included."""
    blocks = [turns.select("conv", F.col("at").alias("i"), F.col("digest").alias("name"))]
    for j in range(1, height):
        halves = blocks[-1].groupBy("conv", _div("i", 2).alias("i")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"), F.max(F.when(F.col("i") % 2 == 1, F.col("name"))).alias("b"))
        blocks.append(staged(halves.where("a is not null and b is not null").select("conv", "i", _digest(F.col("a"), F.col("b")).alias("name")), f"trie-blocks-{j}"))
    names = convs.select("conv", F.lit(0).cast("long").alias("i"), F.unhex(F.sha2(F.lit("").cast("binary"), 256)).alias("name"))
    for j in reversed(range(height)):
        above = blocks[j].where(F.col("i") % 2 == 0).select("conv", _div("i", 2).alias("i"), F.col("name").alias("above"))
        lower = names.join(above, ["conv", "i"]).select("conv", (2 * F.col("i") + 1).alias("i"), _digest(F.col("name"), F.col("above")).alias("name"))
        names = staged(names.select("conv", (2 * F.col("i")).alias("i"), "name").union(lower), f"trie-names-{j}")
    return names.withColumnRenamed("i", "depth")


def _grafted(tree: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """(conv, depth, n_leaves, saved): each node's own values with those of all below it.
    ``paths`` gives the node (``of``, depth) on the way of ``conv`` at every depth."""
    own = tree.select("conv", "depth", "parent", "n_leaves", "saved")
    added: list[DataFrame] = []
    sums = F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
    for j in range(height):
        cut = F.col("depth") % (2 << j) == (1 << j)
        roots = reduce(DataFrame.union, [own, *added]).where(cut).groupBy("conv", "depth").agg(F.max("parent").alias("parent"), *sums)
        hung = roots.groupBy("parent", (F.col("depth") - 1).alias("lowest")).agg(*sums)
        step = min(1 << j, SPREAD)
        far = hung.withColumn("far", F.explode(F.sequence(F.lit(0), F.lit((1 << j) - 1), F.lit(step))))
        on = far.withColumn("near", F.explode(F.sequence(F.lit(0), F.lit(step - 1)))).select(
            F.col("parent").alias("conv"), (F.col("lowest") - F.col("far") - F.col("near")).alias("depth"), "n_leaves", "saved")
        part = on.join(paths, ["conv", "depth"]).groupBy(F.col("of").alias("conv"), "depth").agg(*sums)
        added.append(staged(part.select("conv", "depth", F.lit(None).cast("long").alias("parent"), "n_leaves", "saved"), f"trie-graft-{j}"))
    return reduce(DataFrame.union, [own, *added]).groupBy("conv", "depth").agg(*sums)


def _end_digests(names: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256) of the nodes where conversations end."""
    ends = names.groupBy("conv").agg(F.max(F.struct("depth", "name")).alias("end")).select("end.depth", "end.name", "conv")
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = ends.groupBy("depth", "name", F.shiftright("conv", PIECE_BITS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.binary()), pa.array([state.hexdigest()])],
                                              names=["depth", "name", "ends_sha256"])

        for batch in batches:
            for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids"))):
                if key != (depth, name):
                    if key is not None:
                        yield row()
                    key, state = (depth, name), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            yield row()

    dealt = pieces.repartition("depth", "name").sortWithinPartitions("depth", "name", "piece").select("depth", "name", "ids")
    return dealt.mapInArrow(run, "depth long, name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per node of the trie over ``turns`` (conv, at, digest, n_bytes) of ``convs`` (conv; those
    without turns are members of the root): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (bytes that need not be stored twice) and ends_sha256."""
    turns = staged(turns, "trie-turns")
    longest = (turns.agg(F.max("at")).first()[0] or 0) + 1 if not turns.isEmpty() else 0
    height = longest.bit_length()  # 2 ** height > longest
    names = staged(_prefix_names(turns, convs, height), "trie-names")
    nodes = staged(names.groupBy("depth", "name").agg(F.min("conv").alias("of"), F.count(F.lit(1)).alias("n_convs")), "trie-nodes")
    # the way of each conversation that stands for a node; all share the root
    carriers = nodes.select(F.col("of").alias("conv")).distinct()
    ways = names.join(carriers, "conv", "left_semi")
    root = nodes.where("depth = 0").select("of").first()
    below = ways.where("depth > 0").join(nodes.select("depth", "name", "of"), ["depth", "name"]).select("conv", "depth", "of")
    at_root = ways.where("depth = 0").select("conv", "depth", F.lit(root["of"] if root else None).cast("long").alias("of"))
    paths = staged(below.union(at_root), "trie-paths")
    last = turns.select(F.col("conv"), (F.col("at") + 1).alias("depth"), "n_bytes")
    up = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("of").alias("parent"))
    tree = nodes.withColumnRenamed("of", "conv").join(last, ["conv", "depth"], "left").join(up, ["conv", "depth"], "left")
    children = tree.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = tree.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))) \
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long")) \
        .withColumn("saved", (F.col("n_convs") - 1) * F.coalesce("n_bytes", F.lit(0)))
    tree = staged(tree.select("conv", "depth", "name", "parent", "n_convs", "n_children", "n_leaves", "saved"), "trie-tree")
    totals = _grafted(tree, paths, height).withColumnRenamed("saved", "saved_tokens")
    nobody = hashlib.sha256(b"").hexdigest()
    return tree.drop("n_leaves", "saved").join(totals, ["conv", "depth"]).join(_end_digests(names), ["depth", "name"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))


ORACLE = """
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS place, d, n FROM (
    SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, strlen(coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL)),
-- CRC-32 of the decimal id, a bit at a time
convs AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(
           list_prepend(4294967295, flatten([[ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for x in string_split(c::VARCHAR, '')])),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns)),
pieces AS (
  SELECT convs.c, 0 AS part, place, d, n FROM convs JOIN turns ON turns.c = base AND place < h
  UNION ALL SELECT convs.c, 1, place, d, n FROM convs JOIN turns USING (c) WHERE place >= h),
rebuilt AS (SELECT c, row_number() OVER w AS depth, sha256(string_agg(d, '') OVER w) AS name, n FROM pieces
            WINDOW w AS (PARTITION BY c ORDER BY part, place ROWS UNBOUNDED PRECEDING)),
prefixes AS (SELECT * FROM rebuilt UNION ALL SELECT c, 0, '', 0 FROM convs),
nodes AS (SELECT depth, name, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved FROM prefixes GROUP BY depth, name),
ways AS (  -- every node with all nodes above it, itself included
  SELECT v.depth AS depth, v.name AS name, v.conv_id, v.saved, u.depth AS up_depth, u.name AS up_name
  FROM nodes v JOIN prefixes u ON u.c = v.conv_id AND u.depth <= v.depth),
parents AS (SELECT w.depth, w.name, p.conv_id AS parent_conv_id, w.up_name FROM ways w JOIN nodes p ON p.depth = w.up_depth AND p.name = w.up_name WHERE w.up_depth = w.depth - 1),
children AS (SELECT depth - 1 AS depth, up_name AS name, count(*) AS n_children FROM parents GROUP BY ALL),
below AS (SELECT up_depth AS depth, up_name AS name, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
          FROM ways LEFT JOIN children USING (depth, name) GROUP BY ALL),
ends AS (SELECT depth, name, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
         FROM (SELECT c, max(depth) AS depth FROM prefixes GROUP BY c) JOIN prefixes USING (c, depth) GROUP BY ALL)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN below USING (depth, name) LEFT JOIN parents USING (depth, name) LEFT JOIN children USING (depth, name) LEFT JOIN ends USING (depth, name)
"""
