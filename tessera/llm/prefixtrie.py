"""Operator 11: prefix trie of conversations by whole-sequence collapse.

Identical conversations are grouped first: a sequence of turns keeps one
representative (the smallest id), a weight and the list of the conversations
that end there.  A sequence's fingerprint is the XOR of 128 bits hashed from
each (position, turn), so it needs no order, is summed map-side, and the
fingerprint of a prefix is a running XOR.  The sequences that are proper
prefixes of others go by an anti-join, which leaves the leaves; the weighted
prefixes of the representatives are then added up per node.

What a node's subtree saves comes from the same rows: its members' characters
below it, less those of its distinct nodes.  A node belongs to the sequence of
its smallest member; a sequence owns a node and all that follow on its path, so
the distinct nodes' characters below are a suffix of each sequence's own part.

Only hashes travel.  A conversation, a first turn or a group of copies may hold
a third of all rows: positions and running values are cut by ranges (`turns`),
long sequences' facts are broadcast (at most 1,000, `skew_safe_lookup`), sums are
partial, and the ids that end at a node are gathered by ranges of 4,096 ids
and hashed one range after another.

Defined results: a null role or text is empty; rows without conversation id
belong to none; rows that share a turn follow role, then the MD5 of the text, a
null turn comes first; equal rows are all kept; an empty table has no nodes, also
no root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod
from tessera.llm.turns import CRC32_SQL, numbered, running
from tessera.operators.joins import skew_safe_lookup
from tessera.session import materialize

#: Conversations that share a head come in blocks of so many ids; the head is
#: shorter than MAX_HEAD turns.
BLOCK, MAX_HEAD = 100, 6
#: Ids that end at a node are gathered by ranges of 2**ID_BITS ids.
ID_BITS = 12
NODE = ["depth", "p1", "p2"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, chars): the turns of each conversation in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    light = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), F.md5(text).alias("m"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.length(text).cast("long").alias("chars"))
    return numbered(light, "conv_id", ["turn", "role", "m"]).select("conv_id", "pos", "h1", "h2", "chars")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`turn_rows` after each conversation c took the first h turns of
    conversation c - c % 100 for its own, h = crc32(c) % 6; and all ids."""
    c = F.col("conv_id")
    rows = materialize(rows, "turns")
    head = crc_mod(c, MAX_HEAD)
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    owners = sizes.select("conv_id", "n", head.alias("h"), (c - c % BLOCK).alias("base"))
    lengths = sizes.where(c % BLOCK == 0).select(c.alias("base"), F.col("n").alias("n_base"))
    # a block has at most 199 ids and a head at most 5 rows: a small join
    facts = materialize(owners.join(lengths, "base", "left").select(
        "conv_id", "n", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")), "heads")
    heads = rows.where((c % BLOCK == 0) & (F.col("pos") < MAX_HEAD - 1)).withColumnRenamed("conv_id", "base")
    shared = facts.join(heads, "base").where(F.col("pos") < F.col("h")).select("conv_id", "pos", "h1", "h2", "chars")
    own = skew_safe_lookup(rows.where(F.col("pos") >= head), facts.select("conv_id", "h", "taken", "n"), "conv_id", "n")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "h1", "h2", "chars")
    return shared.unionByName(own), facts.select("conv_id")


def _list_hashes(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of the ids that end at each node, in order;
    a task holds one range of ids at a time."""
    parts = ends.groupBy(*NODE, F.shiftright("conv_id", ID_BITS).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if node == now:
                    state.update(b",")
                else:
                    if now:
                        out.append([*now, state.hexdigest()])
                    now, state = node, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=[*NODE, "ends_sha256"])
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in [*now, state.hexdigest()]],
                                             names=[*NODE, "ends_sha256"])

    return (parts.repartition(*[F.col(c) for c in NODE]).sortWithinPartitions(*NODE, "part")
            .select(*NODE, "ids").mapInArrow(run, "depth long, p1 long, p2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of `turns` (conv_id, pos, h1, h2, chars) over the
    conversations `ids`, with turns or without.  A node has depth, conv_id (its
    smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and its fingerprint p1, p2."""
    at = F.col("pos")
    marked = materialize(turns.select(
        "conv_id", (at + 1).alias("depth"), "chars", F.xxhash64(at, "h1", "h2").alias("f1"),
        F.xxhash64(F.lit(1), "h2", at, "h1").alias("f2")), "rebuilt")
    totals = marked.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("depth"), F.bit_xor("f1").alias("p1"), F.bit_xor("f2").alias("p2"),
        F.sum("chars").alias("total"))
    ends = materialize(ids.join(totals, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in [*NODE, "total"]]), "ends")

    # identical conversations become one weighted sequence, named by its smallest id
    sequences = materialize(ends.groupBy(*NODE).agg(
        F.min("conv_id").alias("seq"), F.count(F.lit(1)).alias("weight"), F.min("total").alias("total")), "sequences")
    kept = marked.withColumnRenamed("conv_id", "seq").join(sequences.select("seq"), "seq", "left_semi")
    paths = materialize(running(kept, "seq", "depth", ["f1", "f2"], ["chars"]).select(
        "seq", "depth", F.col("run_f1").alias("p1"), F.col("run_f2").alias("p2"), "f1", "f2", "chars",
        (F.col("run_chars") - F.col("chars")).alias("above")), "paths")

    # distinct nodes: the smallest member owns a node; its parent's fingerprint lacks the last turn
    nodes = materialize(paths.groupBy(*NODE).agg(
        F.min("seq").alias("conv_id"), F.min("chars").alias("chars"), F.min("f1").alias("f1"), F.min("f2").alias("f2"),
    ).select(*NODE, "conv_id", "chars", (F.col("depth") - 1).alias("parent_depth"),
             F.col("p1").bitwiseXOR(F.col("f1")).alias("parent_p1"),
             F.col("p2").bitwiseXOR(F.col("f2")).alias("parent_p2")), "nodes")
    parent_key = [f"parent_{c}" for c in NODE]
    families = materialize(nodes.groupBy(*[F.col(p).alias(c) for p, c in zip(parent_key, NODE)]).agg(
        F.count(F.lit(1)).alias("n_children")), "families")
    # a sequence that some other one continues is no leaf
    leaves = sequences.join(families, NODE, "left_anti").select("seq", F.lit(1).alias("leaf"))
    owned = nodes.groupBy(F.col("conv_id").alias("seq")).agg(
        F.min("depth").alias("owned_from"), F.sum("chars").alias("owned"))
    facts = materialize(
        sequences.join(leaves, "seq", "left").join(owned, "seq", "left").select(
            "seq", "weight", "total", F.col("depth").alias("length"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
            F.coalesce("owned_from", F.col("depth") + 1).alias("owned_from"),
            F.coalesce("owned", F.lit(0)).alias("owned")), "facts")

    weighted = skew_safe_lookup(paths.select("seq", *NODE, "above"), facts, "seq", "length")
    below = F.col("total") - F.col("above")
    distinct_below = F.when(F.col("depth") >= F.col("owned_from"), below).otherwise(F.col("owned"))
    sums = [F.sum("weight").alias("n_convs"), F.sum("leaf").cast("long").alias("n_leaves")]
    saved = weighted.groupBy(*NODE).agg(*sums, F.sum(F.col("weight") * below - distinct_below).alias("saved_tokens"))
    root = facts.groupBy().agg(*sums, F.sum(F.col("weight") * F.col("total") - F.col("owned")).alias("saved_tokens"),
                               F.min("seq").alias("conv_id")).where(F.col("n_convs").isNotNull())
    zero = [F.lit(0).cast("long").alias(c) for c in NODE]
    every = saved.join(nodes.select(*NODE, "conv_id", *parent_key), NODE).unionByName(
        root.select(*zero, "n_convs", "n_leaves", "saved_tokens", "conv_id",
                    *[F.lit(None).cast("long").alias(p) for p in parent_key]))
    every = every.join(families, NODE, "left").join(_list_hashes(ends.select("conv_id", *NODE)), NODE, "left")
    above = nodes.select(*NODE, "conv_id").unionByName(root.select(*zero, "conv_id")).select(
        *[F.col(c).alias(p) for c, p in zip(NODE, parent_key)], F.col("conv_id").alias("parent_conv_id"))
    return every.join(above, parent_key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "p1", "p2")


def members(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(depth, p1, p2, conv_id): the conversations that end at each node."""
    at = F.col("pos")
    marks = [F.xxhash64(at, "h1", "h2"), F.xxhash64(F.lit(1), "h2", at, "h1")]
    totals = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor(marks[0]).alias("p1"),
                                          F.bit_xor(marks[1]).alias("p2"))
    return ids.join(totals, "conv_id", "left").select(*[F.coalesce(c, F.lit(0)).alias(c) for c in NODE], "conv_id")


def digest(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations' trie."""
    return prefix_trie(*rebuilt(turn_rows(conversations))).drop("p1", "p2")


ORACLE = f"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) - 1 as pos
  from conversations where conv_id is not null),
c as (
  select conv_id, conv_id - conv_id % {BLOCK} as base, {CRC32_SQL.format("conv_id::varchar")} % {MAX_HEAD} as h
  from (select distinct conv_id from t)),
n as (select conv_id as base, count(*) as n from t group by conv_id),
r as (
  select c.conv_id, t.pos + 1 as d, t.role, t.text from c join t on t.conv_id = c.base and t.pos < c.h
  union all
  select c.conv_id, t.pos - c.h + least(c.h, coalesce(n.n, 0)) + 1, t.role, t.text
  from c join t on t.conv_id = c.conv_id and t.pos >= c.h left join n on n.base = c.base),
m as (
  select conv_id, d, string_agg(md5(length(role) || ':' || role || text), '') over (partition by conv_id order by d) as k,
         length(text) as chars from r
  union all select conv_id, 0, '', 0 from c),
last as (select conv_id, max(d) as last from m group by conv_id),
node as (
  select d, k, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last = d), '') as ends
  from m join last using (conv_id) group by d, k),
linked as (
  select x.*, p.conv_id as parent_conv_id, p.k as parent_k
  from node x left join node p on p.d = x.d - 1 and p.k = left(x.k, 32 * (x.d::int - 1))),
counted as (
  select x.*, (select count(*) from linked y where y.parent_k = x.k and y.d = x.d + 1) as n_children from linked x),
pairs as (select distinct a.k, b.k as below from m a join m b on a.conv_id = b.conv_id and b.d >= a.d),
subtree as (
  select p.k, sum(y.saved) as saved_tokens, count(*) filter (y.n_children = 0) as n_leaves
  from pairs p join counted y on y.k = p.below group by p.k)
select x.conv_id, x.d::bigint as depth, x.parent_conv_id, x.n_convs::bigint as n_convs, x.n_children::bigint as n_children,
       s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(x.ends) as ends_sha256
from counted x join subtree s using (k)
"""
