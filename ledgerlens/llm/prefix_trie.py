"""The trie of conversation prefixes, built by van Emde Boas recursion on the depth.

A node stands for all conversations that begin with the same turns; its name is the least of their ids. Sequences are cut
at half depth. What lies before the cut makes the upper trie, and every distinct prefix at the cut is given its name, as
the root of a lower tree. Both halves are cut in the same way, all of them in one round, so a trie of depth D takes about
log2(D) rounds of joins and not D. A cut compares whole stretches of turns by a digest of theirs, made from the digests
of its two halves. Conversations that are alone behind a cut form a path there and take no further part.

Totals (leaves, saved bytes) come back in the opposite order. First every turn is a trie of its own; then lower forests
are grafted on the upper tries that end where they begin, twice as deep each round: the root of a lower tree hands its totals to
its ancestors in the upper trie, which its name leads to.

No conversation, node or group is held in one task: turns are rows throughout, counts are combined before their
shuffle, and the ids that end at a node are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm.store import stored

RUN = 1 << 16  # ids per piece of text on their way to a hash
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()


def ordered_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, pos, digest, size): the turns of each conversation from 0 on, null turns first, with a SHA-256 digest of role and
    text and the bytes of the text. Equal turns are ordered by digest, so equal rows are interchangeable.

    Rows without a conversation id take no part; a null role or text is empty. Rows are numbered by a sort over all
    conversations, so one that holds most of the rows is spread over many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    by = ("conv_id", F.asc_nulls_first("turn"), "digest")
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(sorted_.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted-turns")
    stretches = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select("conv_id", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "digest", "size")


def with_shared_openings(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of the rebuilt conversations: the first h turns of conversation ``c - c % family``, as far as it has
    them, then c's own after its first h, where h is the crc32 of c as text modulo ``most``."""
    cid = F.col("conv_id")
    h = F.crc32(cid.cast("string").cast("binary")) % most
    turns = stored(turns, "turns")
    ids = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    head = turns.filter((F.col("pos") < most - 1) & (cid % family == 0)).groupBy(cid.alias("base"))
    head = head.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "size"))).alias("head"))  # fewer than ``most``
    opened = ids.select("conv_id", (cid - cid % family).alias("base"), h.alias("h")).join(head, "base", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0))).cast("int")
    opened = stored(opened.select("conv_id", "h", taken.alias("k"), F.slice("head", F.lit(1), taken).alias("head")), "openings")
    first = opened.select("conv_id", F.inline("head"))
    own = turns.join(opened.select("conv_id", "h", "k"), "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "digest", "size")
    return stored(first.unionByName(own), "rebuilt"), opened.select("conv_id")


def _stretches(turns: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k the digests (conv_id, j, digest) of the turns from j * 2**k to (j + 1) * 2**k, where all of them exist."""
    out = [turns.select("conv_id", F.col("pos").alias("j"), "digest")]
    for _ in range(1, levels):
        half = F.col("j") % 2
        pairs = out[-1].groupBy("conv_id", F.shiftright("j", 1).alias("j")).agg(
            F.max(F.when(half == 0, F.col("digest"))).alias("a"), F.max(F.when(half == 1, F.col("digest"))).alias("b")
        )
        both = pairs.filter("a is not null and b is not null")
        out.append(stored(both.select("conv_id", "j", F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("digest")), "stretches"))
    return out


def _shared_names(turns: DataFrame, root: DataFrame, levels: int) -> DataFrame:
    """(conv_id, depth, name, n) of every prefix that more than one conversation has, and of the root."""
    stretches = _stretches(turns, levels)
    names = root
    for k in reversed(range(levels)):
        half = 1 << k
        # the stretch from ``depth``, where a tree of this round has its root, to the cut
        upper = stretches[k].filter("j % 2 = 0").select("conv_id", (F.col("j") * half).alias("depth"), "digest")
        cut = stored(upper.join(names, ["conv_id", "depth"]).select("conv_id", "depth", "name", "digest"), "cuts")
        found = cut.groupBy("depth", "name", "digest").agg(F.min("conv_id").alias("found"), F.count("*").alias("n")).filter("n > 1")
        named = cut.join(found, ["depth", "name", "digest"])
        named = named.select("conv_id", (F.col("depth") + half).alias("depth"), F.col("found").alias("name"), "n")
        names = names.unionByName(stored(named, "names"))
    return names


def _grafted(totals: DataFrame, names: DataFrame, levels: int) -> DataFrame:
    """(name, depth, leaves, saved) of whole subtrees, from those of single nodes; ``names`` leads to the ancestors."""
    for k in range(levels):
        half = 1 << k
        roots = totals.filter(F.col("depth") % (2 * half) == half)
        above = roots.select(
            F.col("name").alias("conv_id"), "leaves", "saved", F.explode(F.sequence(F.col("depth") - half, F.col("depth") - 1)).alias("depth")
        )
        handed = above.join(names, ["conv_id", "depth"]).select("name", "depth", "leaves", "saved")
        totals = totals.unionByName(handed).groupBy("name", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        totals = stored(totals, "totals")
    return totals


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, depth, conv_id) rows as texts of ids, up to RUN of them."""
    key, ids = None, []
    rows: list[tuple] = []

    def close() -> None:
        if ids:
            rows.append((*key, ids[0], ",".join(map(str, ids))))
            ids.clear()

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        rows.clear()
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["name", "depth", "first", "ids"])

    for batch in batches:
        for name, depth, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (name, depth) != key or len(ids) == RUN:
                close()
                key = (name, depth)
            ids.append(conv)
        yield batch_of()
    close()
    yield batch_of()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of ids as one hash per node; only the state of a hash is kept."""
    key, state = None, hashlib.sha256()
    for batch in batches:
        out: list[tuple] = []
        for name, depth, ids in zip(batch.column("name").to_pylist(), batch.column("depth").to_pylist(), batch.column("ids")):
            if (name, depth) == key:
                state.update(b",")
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (name, depth), hashlib.sha256()
            state.update(ids.as_py().encode())
        yield _hash_batch(out)
    yield _hash_batch([(*key, state.hexdigest())] if key else [])


def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["name", "depth", "ends"])


def _ends(ends: DataFrame) -> DataFrame:
    """(name, depth, ends): SHA-256 of the ids at each node, ascending and comma-joined."""
    by = ("name", "depth", "conv_id")
    runs = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_runs, "name long, depth long, first long, ids string")
    sorted_ = runs.repartition("name", "depth").sortWithinPartitions("name", "depth", "first")
    return sorted_.mapInArrow(_hashes, "name long, depth long, ends string")


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node: conv_id (its least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``turns`` holds (conv_id, pos, digest, size), positions from 0 without gaps, ``ids`` all conversations, those without a turn too; both
    are stored tables, as they are read more than once. n_leaves counts the childless nodes of a subtree,
    its top included. saved_tokens sums ``(n_convs - 1) * size`` over it, with the size of a node's last turn.
    ends_sha256 is the hash of the members that end at the node, ascending in decimal, joined by commas. Ids are not null and unique.
    No conversations give no nodes, not even a root.
    """
    spark = ids.sparkSession
    top = ids.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    if not top["n"]:
        return spark.createDataFrame([], NODES)
    depth = turns.agg(F.max("pos")).first()[0]
    levels = 0 if depth is None else (depth + 1).bit_length()
    zero = F.lit(0).cast("long")
    root = ids.select("conv_id", zero.alias("depth"), F.lit(top["least"]).alias("name"), F.lit(top["n"]).alias("n"))
    names = _shared_names(turns, root, levels)

    deep = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "size").join(names, ["conv_id", "depth"], "left")
    alone = F.col("name").isNull()
    members = deep.select(
        "conv_id", "depth", "size", F.coalesce("name", "conv_id").alias("name"), F.coalesce("n", F.lit(1)).alias("n")
    ).unionByName(root.withColumn("size", zero))
    members = stored(members, "members")
    # the least member stands for its node, and its own prefixes are the node's ancestors
    nodes = members.filter("conv_id = name").select("name", "depth", "size", "n")
    over = members.select(
        F.col("conv_id").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("n").alias("parent_n")
    )
    nodes = stored(nodes.join(over, ["name", "depth"], "left"), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count("*").alias("children"))
    nodes = stored(nodes.join(children, ["name", "depth"], "left").fillna(0, ["children"]), "nodes")

    # below a node of one conversation is a path: one leaf, nothing saved
    shared = (F.col("n") > 1) | (F.col("depth") == 0)
    begins = (F.col("parent_n") > 1) | (F.col("depth") == 1)
    single = nodes.filter(shared | begins).select(
        "name", "depth",
        F.when(shared, (F.col("children") == 0).cast("long")).otherwise(F.lit(1)).alias("leaves"),
        ((F.col("n") - 1) * F.col("size")).alias("saved"),
    )
    totals = _grafted(stored(single, "totals"), names, levels)

    last = members.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = stored(members.join(last, ["conv_id", "depth"]).select("name", "depth", "conv_id", "n"), "ends")
    many = _ends(ends.filter("n > 1 or depth = 0"))
    one = ends.filter("n = 1 and depth > 0").select("name", "depth", F.sha2(F.col("conv_id").cast("string").cast("binary"), 256).alias("ends"))
    full = nodes.join(totals, ["name", "depth"], "left").join(many.unionByName(one), ["name", "depth"], "left")
    return full.select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


#: SQL for the query over ``conversations``. DuckDB has no crc32, so it is computed bit by bit.
ORACLE = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
               lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::BIGINT)),
                   lambda v, i: xor(v >> 1, (v & 1) * 3988292384)))) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT i.conv_id, t.role, t.text, row_number() OVER (PARTITION BY i.conv_id ORDER BY t.pos) AS depth
    FROM ids i JOIN turns t ON (t.conv_id = i.base AND t.pos < i.h) OR (t.conv_id = i.conv_id AND t.pos >= i.h)),
whole AS (
    SELECT conv_id, list(role || chr(0) || text ORDER BY depth) AS seq FROM rebuilt GROUP BY conv_id),
prefixes AS (
    SELECT conv_id, seq[1:d] AS prefix, d AS depth, len(seq) AS long, strlen(split_part(seq[d], chr(0), 2)) AS size
    FROM whole, range(1, 10000) r(d) WHERE d <= len(seq)
    UNION ALL
    SELECT i.conv_id, []::VARCHAR[], 0, coalesce(len(w.seq), 0), 0 FROM ids i LEFT JOIN whole w USING (conv_id)),
nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (long = depth), '') AS ends
    FROM prefixes GROUP BY prefix, depth),
linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1])
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children,
       CAST(count(*) FILTER (b.n_children = 0) AS BIGINT) AS n_leaves,
       CAST(sum((b.n_convs - 1) * b.size) AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM linked a JOIN linked b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix
GROUP BY a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends"""
