"""Prefix trie of conversations by van Emde Boas recursion (operator 12).

A node is a distinct sequence of first turns (role and text), its members are
the conversations that start with it. Turns are 128-bit names (two 64-bit
halves of a SHA-256 of role and text); a prefix is named by the exclusive or of
its turns' names, each mixed with its depth, so its name does not depend on how
it was put together.

The recursion halves the depth. A problem is one prefix (its group) and a range
of depths below it. It is cut at half depth: the turns above the cut are one
segment per sequence, and the group's name and the segment's make the cut
prefix's name. The turns above the cut go on as the upper trie's problem, with
the same group; the turns below it as the lower forest's, grouped by the cut
prefix. All problems of one size are cut in one job, so a trie of depth D takes
log2(D) rounds, and a round moves each turn once. At size one every turn has
the name of the prefix before it, and the nodes are one aggregation.

Totals of subtrees are grafted upward in as many rounds, from the smallest
blocks of depths to the largest: the totals of the lower block's top nodes are
summed under the cut prefix they hang from and added to each node on the path
to it within the upper block. A path is read from any member of the cut prefix.

How it is spread: turns are numbered by range partitions and offsets, so a
conversation may span any number of tasks. No join has a hot key on both sides,
and aggregates are partial first. A node's children get its id by a broadcast
of the nodes with the most children, at most ``HEAVY`` of them, and by a join
for all others. The digest of members that end at a node is a stream over runs
of their sorted ids; a SHA-256 is sequential by definition.

Defined results: null roles and texts are empty; turns are ordered by turn
(null first), then role, then text; rows without ``conv_id`` belong to no
conversation; ``conv_id - conv_id % 100`` rounds towards zero; an empty table
gives an empty table (no root); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracery.llm.common import batch, partitions
from tracery.session import delete_path, scratch_path

#: Conversations of one block share the first turns of the block's first one, at most ``SHARED - 1``.
BLOCK, SHARED = 100, 6
#: Characters of role and text that order ranges of equal turns; ties beyond them stay in one task.
HEAD = 32
#: Nodes whose children are joined by broadcast, at most.
HEAVY = 100_000
LIGHT_CHILDREN = 1_000
#: Ids per run of a digest.
RUN = 4096
EMPTY = sha256(b"").hexdigest()


class _Steps:
    """Tables written to the shared folder: each is computed once, and may be
    dropped when the next one is written."""

    def __init__(self, frame: DataFrame):
        self.spark, self.folder, self.n = frame.sparkSession, scratch_path(frame.sparkSession, "trie"), 0

    def cut(self, frame: DataFrame, instead: DataFrame | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        frame.write.parquet(path)
        out = self.spark.read.schema(frame.schema).parquet(path)
        out.written_at = path
        if instead is not None:
            delete_path(self.spark, instead.written_at)
        return out


def _half(start: int) -> Column:
    """60 bits of the turn's SHA-256 as a number."""
    return F.conv(F.substring("_sha", start, 15), 16, 10).cast("long")


def numbered_turns(rows: DataFrame, steps: _Steps) -> tuple[DataFrame, DataFrame]:
    """``conv_id, task, at, a, b, chars``, one row per turn in order, and
    ``conv_id, task, first, before, n``: a turn's place is ``at - first + before``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    keys = ["conv_id", "turn", F.substring("role", 1, HEAD), F.substring("text", 1, HEAD)]
    ordered = turns.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions("conv_id", "turn", "role", "text")
    # The role's length keeps ("ab", "c") and ("a", "bc") apart.
    named = ordered.select(
        "conv_id", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("_sha"),
        F.length("text").alias("chars"))
    turns = steps.cut(named.select("conv_id", "task", "at", _half(1).alias("a"), _half(16).alias("b"), "chars"))
    runs = turns.groupBy("conv_id", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return turns, steps.cut(runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))


def rebuilt(rows: DataFrame, steps: _Steps) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, a, b, chars`` of the rebuilt conversations, and ``conv_id, n``
    of all of them: the first turns of the block's first conversation, then
    the conversation's own turns after as many."""
    turns, runs = numbered_turns(rows, steps)
    lengths = runs.groupBy("conv_id").agg(F.sum("n").alias("own"))
    base = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_n"))
    wanted = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED))
    convs = lengths.select("conv_id", "own", wanted.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    convs = convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = steps.cut(convs.select("conv_id", "base", "h", "taken",
                                   (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")))
    # The joins carry one row per run of turns, or at most BLOCK conversations per base.
    place = F.col("at") - F.col("first") + F.col("before")
    shifts = runs.join(convs.select("conv_id", "h", "taken"), "conv_id").select("conv_id", "task", "first", "before", "h", "taken")
    placed = turns.join(shifts, ["conv_id", "task"]).withColumn("pos", place)
    own = placed.filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "chars")
    heads = placed.filter((F.col("pos") < SHARED - 1) & (F.col("conv_id") % BLOCK == 0)).select(
        F.col("conv_id").alias("base"), "pos", "a", "b", "chars")
    shared = convs.filter("taken > 0").select("conv_id", "base", "taken").join(heads, "base").filter("pos < taken")
    return own.unionByName(shared.select("conv_id", "pos", "a", "b", "chars")), convs.select("conv_id", "n")


def named_prefixes(turns: DataFrame, depth: int, steps: _Steps) -> DataFrame:
    """``conv_id, pos, a, b, chars, ga, gb``: each turn with its own name
    ``a, b`` (depth mixed in) and the name ``ga, gb`` of the prefix before it."""
    state = steps.cut(turns.select("conv_id", "pos", F.xxhash64("a", "pos").alias("a"), F.xxhash64("b", "pos").alias("b"), "chars",
                                   F.lit(0).cast("long").alias("ga"), F.lit(0).cast("long").alias("gb")))
    size = 1 << (depth - 1).bit_length() if depth > 1 else 1
    while size > 1:
        half = size // 2
        row = state.withColumn("problem", F.floor(F.col("pos") / size)).withColumn("above", F.col("pos") % size < half)
        # The cut: one segment per sequence and problem.
        segments = row.filter("above").groupBy("conv_id", "problem").agg(
            F.bit_xor("a").alias("sa"), F.bit_xor("b").alias("sb"))
        lower = row.filter("not above").join(segments, ["conv_id", "problem"]).select(
            "conv_id", "pos", "a", "b", "chars", F.col("ga").bitwiseXOR(F.col("sa")).alias("ga"),
            F.col("gb").bitwiseXOR(F.col("sb")).alias("gb"))
        upper = row.filter("above").select("conv_id", "pos", "a", "b", "chars", "ga", "gb")
        state = steps.cut(upper.unionByName(lower), state)
        size = half
    return state


def grafted(nodes: DataFrame, paths: DataFrame, depth: int, steps: _Steps) -> DataFrame:
    """``a, b, depth, leaves, saved``: the nodes' own values summed over their
    subtrees. ``nodes``: ``a, b, depth, ga, gb, conv_id, leaves, saved``."""
    totals = nodes.select("a", "b", "depth", "ga", "gb", "conv_id", "leaves", "saved")
    size = 1
    while size < depth:
        # Blocks of 2 * size depths: the lower half's top nodes hang from the upper half's last ones.
        top = totals.filter((F.col("depth") - 1) % (2 * size) == size)
        hung = top.groupBy("ga", "gb", F.col("depth").alias("_d")).agg(
            F.min("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        hung = hung.select("conv_id", F.floor((F.col("_d") - 1) / (2 * size)).alias("problem"), "leaves", "saved")
        above = paths.filter(F.col("pos") % (2 * size) < size).select(
            "conv_id", F.floor(F.col("pos") / (2 * size)).alias("problem"), "a", "b", (F.col("pos") + 1).alias("depth"))
        more = above.join(hung, ["conv_id", "problem"]).groupBy("a", "b", "depth").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        totals = steps.cut(totals.join(more, ["a", "b", "depth"], "left").select(
            "a", "b", "depth", "ga", "gb", "conv_id", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), totals if size > 1 else None)
        size *= 2
    return totals


def ends_digest(ends: DataFrame) -> DataFrame:
    """``a, b, depth, ends_sha256`` from ``a, b, depth, conv_id`` of the members that end there."""
    key = ["a", "b", "depth"]
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])

    def changes(b: pa.RecordBatch) -> list[int]:
        same = [b.column(k).to_numpy() for k in key]
        new = [i for i in range(1, b.num_rows) if any(x[i] != x[i - 1] for x in same)]
        return [0, *new, b.num_rows]

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, rows = b.column("conv_id").to_pylist(), []
            cuts = changes(b)
            for s, e in zip(cuts, cuts[1:]):
                for at in range(s, e, RUN):
                    rows.append((at, ids[at], ",".join(map(str, ids[at:min(e, at + RUN)]))))
            yield batch(kind, **{k: [b.column(k)[at].as_py() for at, _, _ in rows] for k in key},
                        first=[f for _, f, _ in rows], ids=[t for _, _, t in rows])

    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            done = []
            for node, ids in zip(zip(*(b.column(k).to_pylist() for k in key)), b.column("ids").to_pylist()):
                if node == now:
                    state.update(b",")
                else:
                    if state:
                        done.append((*now, state.hexdigest()))
                    now, state = node, sha256()
                state.update(ids.encode())
            if done:
                yield batch(out, **dict(zip(out.names, zip(*done))))
        if state:
            yield batch(out, **dict(zip(out.names, zip((*now, state.hexdigest())))))

    n = partitions(ends.sparkSession)
    runs = ends.select(*key, "conv_id").repartitionByRange(n, *key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(
        texts, "a long, b long, depth long, first long, ids string")
    return runs.repartition(n, *key).sortWithinPartitions(*key, "first").mapInArrow(
        digests, "a long, b long, depth long, ends_sha256 string")


def with_parents(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id``. ``children``: ``ga, gb, depth, n_children, conv_id`` of every parent."""
    total = children.agg(F.sum("n_children")).first()[0] or 0
    # Each of these has that share of all nodes at least, so there are at most HEAVY.
    bound = max(LIGHT_CHILDREN, -(-total // HEAVY))
    side = children.select("ga", "gb", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    heavy = side.filter(F.col("n_children") >= bound).drop("n_children")
    light = side.filter(F.col("n_children") < bound).select("ga", "gb", "depth", F.col("parent_conv_id").alias("other"))
    found = nodes.join(F.broadcast(heavy), ["ga", "gb", "depth"], "left")
    known = found.filter("parent_conv_id is not null")
    rest = found.filter("parent_conv_id is null").drop("parent_conv_id").join(light, ["ga", "gb", "depth"], "left")
    return known.unionByName(rest.withColumnRenamed("other", "parent_conv_id"))


def trie(rows: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    steps = _Steps(rows)
    turns, convs = rebuilt(rows, steps)
    whole = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.max("n").alias("depth")).first()
    depth = whole.depth or 0
    paths = named_prefixes(turns, depth, steps)
    name = [F.col("a").bitwiseXOR(F.col("ga")).alias("a"), F.col("b").bitwiseXOR(F.col("gb")).alias("b")]
    paths = paths.select("conv_id", "pos", *name, "chars", "ga", "gb")
    found = paths.groupBy("a", "b", (F.col("pos") + 1).alias("depth"), "ga", "gb").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"))
    found = steps.cut(found)
    counts = found.groupBy("ga", "gb", (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = found.join(counts.select(F.col("ga").alias("a"), F.col("gb").alias("b"), "depth", "n_children"),
                         ["a", "b", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = steps.cut(counted.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
                      .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")))
    totals = grafted(nodes, paths, depth, steps)
    # Below the root: every node with its totals, its parent's id and its ends.
    top = totals.filter("depth = 1").agg(F.count(F.lit(1)).alias("n"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    root = rows.sparkSession.createDataFrame(
        [(whole.low, 0, None, whole.n, top.n, top.leaves or 1, top.saved or 0)] if whole.n else [],
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    zero = F.lit(0).cast("long")
    last = paths.join(convs.filter("n > 0").select("conv_id", (F.col("n") - 1).alias("pos")), ["conv_id", "pos"]).select(
        "a", "b", (F.col("pos") + 1).alias("depth"), "conv_id")
    none = convs.filter("n = 0").select(zero.alias("a"), zero.alias("b"), zero.alias("depth"), "conv_id")
    ends = steps.cut(ends_digest(last.unionByName(none)))
    parents = nodes.filter("n_children > 0").select(F.col("a").alias("ga"), F.col("b").alias("gb"), "depth", "n_children", "conv_id")
    parents = parents.unionByName(root.select(zero.alias("ga"), zero.alias("gb"), "depth", "n_children", "conv_id"))
    below = nodes.select("a", "b", "depth", "ga", "gb", "conv_id", "n_convs", "n_children").join(
        totals.select("a", "b", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), ["a", "b", "depth"])
    every = with_parents(below, parents).drop("ga", "gb").unionByName(
        root.withColumn("a", zero).withColumn("b", zero))
    return every.join(ends, ["a", "b", "depth"], "left").select(
        "conv_id", F.col("depth").cast("long"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_tokens").cast("long"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


#: DuckDB SQL of the trie: prefixes are told by their texts, subtrees by the paths of their members.
ORACLE = r"""
with own as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
    from conversations where conv_id is not null
), convs as (
    select conv_id, conv_id - conv_id % 100 as base,
        xor(list_reduce(list_transform(range(1, length(conv_id::varchar) + 1),
            lambda i: ascii(substr(conv_id::varchar, i::int, 1))::ubigint),
            lambda crc, byte: list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end,
                xor(crc, byte)), 4294967295::ubigint), 4294967295::ubigint) % 6 as h
    from (select distinct conv_id from own)
), turns as (
    select c.conv_id, o.pos as pos, 0 as part, o.role, o.text from convs c join own o on o.conv_id = c.base and o.pos < c.h
    union all
    select c.conv_id, o.pos, 1, o.role, o.text from convs c join own o on o.conv_id = c.conv_id and o.pos >= c.h
), placed as (
    select conv_id, row_number() over (partition by conv_id order by part, pos) as depth, length(text) as chars,
        sha256(length(role) || ':' || length(text) || ':' || role || text) as turn
    from turns
), paths as (
    select conv_id, depth, chars, sha256(string_agg(turn, '') over (partition by conv_id order by depth)) as prefix from placed
    union all
    select conv_id, 0, 0, '' from convs
), nodes as (
    select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved
    from paths group by all
), edges as (
    select n.prefix, n.depth, p.prefix as parent, up.conv_id as parent_conv_id
    from nodes n join paths p on p.conv_id = n.conv_id and p.depth = n.depth - 1 join nodes up on up.prefix = p.prefix
), children as (
    select parent as prefix, count(*) as n_children from edges group by all
), below as (
    select p.prefix, sum(case when c.prefix is null then 1 else 0 end) as n_leaves, sum(n.saved) as saved_tokens
    from nodes n join paths p on p.conv_id = n.conv_id and p.depth <= n.depth left join children c on c.prefix = n.prefix
    group by all
), ends as (
    select prefix, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
    from (select conv_id, max_by(prefix, depth) as prefix from paths group by all) group by all
)
select n.conv_id, n.depth::bigint as depth, e.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children,
    b.n_leaves::bigint as n_leaves, b.saved_tokens::bigint as saved_tokens, coalesce(x.ends_sha256, sha256('')) as ends_sha256
from nodes n join below b using (prefix) left join edges e using (prefix) left join children c using (prefix)
left join ends x using (prefix)
"""
