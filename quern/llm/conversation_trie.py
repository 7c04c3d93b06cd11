"""Prefix trie of conversations: union-find over the edges between sorted neighbours, in descending depth.

A conversation is the sequence of the hashes of its turns. Equal sequences are one, with a count; sorted, every subtree
of the trie is an interval, and neighbours share a prefix of known length, the depth of the edge between them. Edges are
taken in descending depth: each joins two components under a branching node, or adds one more child to it, and the turns
between a component's own depth and that of its next edge are a chain of nodes with the same members. A piece of a
partition makes its own forest so. Nodes whose interval crosses an edge of the piece (the prefixes shared with a
neighbouring piece, at most one a depth) are left open; all their figures are sums or minima over the pieces, so the
forests are merged by adding up the open nodes, whose number grows with the pieces and not with the conversations.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Bytes of a turn in a sequence: 16 of its hash, and 4 for the size of its text.
HASH, WIDTH = 16, 20
#: Conversations of which the first turns are taken over, and the length below which these are.
FAMILY, HEAD = 5, 9
#: conv_ids that are joined to one string before the ids of equal conversations are hashed, as a power of two.
ID_BLOCK = 12
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_piece(role: Column, text: Column) -> Column:
    """40 hex digits for a turn: equal only for equal role and text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(whole, 256), 1, 2 * HASH), F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, key: the sequence of every conversation after its first turns were replaced by its family's."""
    c = F.col("conv_id").cast("long")
    turns = conversations.filter("conv_id is not null").select(c.alias("conv_id"), (c - c % FAMILY).alias("base"), "turn", turn_piece(F.col("role"), F.col("text")).alias("piece"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "piece")))
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.transform(ordered, lambda x: x["piece"]).alias("own"))
    head = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, HEAD - 1)), ignorenulls=True).over(Window.partitionBy("base"))
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    taken = F.slice(F.coalesce("head", F.array().cast("array<string>")), 1, F.col("n"))
    pieces = F.concat(taken, F.slice("own", F.col("n") + 1, F.size("own") + 1))
    return own.withColumns({"head": head, "n": n}).select("conv_id", F.unhex(F.array_join(pieces, "")).alias("key"))


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """key, n, first, ends, pid, sorted by key over all partitions: how many conversations are equal, their smallest id, the hash of all their ids.

    Ids are joined by ranges before they meet, so a task reads few strings of a sequence that very many conversations have.
    """
    block = F.shiftright("conv_id", ID_BLOCK).alias("block")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")
    joined = rows.groupBy("key", block).agg(ids, F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"))

    def run(batches):
        key, n, first, digest = None, 0, 0, None
        out: tuple[list, list, list, list] = ([], [], [], [])
        for batch in batches:
            for k, i, f, m in zip(*(batch.column(x).to_pylist() for x in ("key", "ids", "first", "n"))):
                if k == key:
                    digest.update(b"," + i.encode())
                    n, first = n + m, min(first, f)
                    continue
                if digest:
                    for column, x in zip(out, (key, n, first, digest.hexdigest())):
                        column.append(x)
                key, n, first, digest = k, m, f, hashlib.sha256(i.encode())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names)
            out = ([], [], [], [])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((key, n, first, digest.hexdigest()), kinds)], names)

    names, kinds = ["key", "n", "first", "ends"], [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    dealt = joined.repartitionByRange("key").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(run, "key binary, n long, first long, ends string").withColumn("pid", F.spark_partition_id())


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        at = (low + high + 1) // 2
        if a[low * WIDTH : at * WIDTH] == b[low * WIDTH : at * WIDTH]:
            low = at
        else:
            high = at - 1
    return low


def shared_edges(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """pid -> turns shared with the partition before and after it, -1 where there is none; a row a partition reaches the driver."""

    def run(batches):
        last = None
        for batch in batches:
            for pid, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if last:
                    n = common(last[2], low)
                    yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]]), pa.array([n])], ["pid", "before", "after"])
                last = (pid, n if last else -1, high)
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]]), pa.array([-1])], ["pid", "before", "after"])

    ends = rows.groupBy("pid").agg(F.min("key").alias("low"), F.max("key").alias("high")).select(F.col("pid").cast("long").alias("pid"), "low", "high")
    found = ends.repartition(1).sortWithinPartitions("pid").mapInArrow(run, "pid long, before long, after long").collect()
    return {r["pid"]: (r["before"], r["after"]) for r in found}


def forest(keys: list[bytes], n: list[int], first: list[int], before: int, after: int) -> dict[str, np.ndarray]:
    """Chains of nodes with the same members, over distinct sorted keys; before, after: turns shared with the neighbours outside.

    lo, hi: the members; top, depth: the chain's nodes are those deeper than top down to depth; kids and below: children of
    the deepest node and tokens saved below it; up: the chain that its first node hangs on.
    """
    m = len(keys)
    length = [len(k) // WIDTH for k in keys]
    edge = [before, *(common(a, b) for a, b in zip(keys, keys[1:])), after]
    size = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, WIDTH)[:, HASH:].copy().view(">u4").ravel().astype(np.int64)
    offset = np.concatenate([[0], np.cumsum(length)]).tolist()
    total = np.concatenate([[0], np.cumsum(size)]).tolist()
    up = list(range(m))
    lo, hi, depth, count, least = list(range(m)), list(range(m)), list(length), list(n), list(first)
    leaves, kids, below = [int(edge[i + 1] < length[i]) for i in range(m)], [0] * m, [0] * m
    hanging: list[list[int]] = [[] for _ in range(m)]
    chains: list[tuple] = []
    parent: list[int] = []

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def lift(c: int, to: int) -> None:
        """Ends the component's chain: what is left of it is a child of a node of depth to."""
        d, a = depth[c], lo[c]
        if d > to:
            for x in hanging[c]:
                parent[x] = len(chains)
            chains.append((a, hi[c], to, d, count[c], least[c], leaves[c], kids[c], below[c]))
            parent.append(-1)
            hanging[c] = [len(chains) - 1]
            at, end = offset[a], total[offset[a] + d]
            below[c] += count[c] * (end - total[at + max(to, 0)]) - (end - total[at + min(d, max(to, edge[a], 0))])
            kids[c], depth[c] = int(edge[a] <= to), to

    for i in sorted(range(1, m), key=lambda i: -edge[i]):
        x, y = find(i - 1), find(i)
        lift(x, edge[i])
        lift(y, edge[i])
        if len(hanging[x]) < len(hanging[y]):
            x, y = y, x
        up[y] = x
        lo[x], hi[x], least[x] = min(lo[x], lo[y]), max(hi[x], hi[y]), min(least[x], least[y])
        count[x] += count[y]
        leaves[x] += leaves[y]
        kids[x] += kids[y]
        below[x] += below[y]
        hanging[x] += hanging[y]
        hanging[y] = []
    if m:
        lift(find(0), -1)
    names = ["lo", "hi", "top", "depth", "n", "first", "leaves", "kids", "below"]
    out = dict(zip(names, np.array(chains, np.int64).reshape(-1, len(names)).T))
    return out | {"up": np.array(parent, np.int64), "edge": np.array(edge), "length": np.array(length), "total": np.array(total), "offset": np.array(offset)}


def prefix_ids(key: bytes, depth: int) -> list[bytes]:
    """Identifiers of the prefixes of 0 to depth turns."""
    digest, out = hashlib.sha256(), []
    for d in range(depth + 1):
        if d:
            digest.update(key[(d - 1) * WIDTH : d * WIDTH])
        out.append(digest.copy().digest()[:HASH])
    return out


NODE = pa.schema([
    ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("id", pa.binary()), ("parent_id", pa.binary()), ("pid", pa.int64()),
])


def nodes_of(keys: list[bytes], n: list[int], first: list[int], ends: list[str], before: int, after: int, pid: int) -> pa.RecordBatch:
    """A row for every node of a piece's forest; id is set where the node is open, parent_id where its parent is."""
    f = forest(keys, n, first, before, after)
    reps = np.repeat(np.arange(len(f["lo"])), f["depth"] - f["top"])
    begin = np.cumsum(f["depth"] - f["top"]) - (f["depth"] - f["top"])
    j = np.arange(len(reps)) - begin[reps] + f["top"][reps] + 1
    lo, d = f["lo"][reps], f["depth"][reps]
    shared, at, total = f["edge"][lo], f["offset"][lo], f["total"]
    last = total[at + d]
    saved = f["below"][reps] + f["n"][reps] * (last - total[at + np.maximum(j - 1, 0)]) - (last - total[at + np.minimum(d, np.maximum(np.maximum(j - 1, shared), 0))])
    open_at = lambda chain, depth: np.where((f["lo"][chain] == 0) & (depth <= before), 1, np.where((f["hi"][chain] == len(keys) - 1) & (depth <= after), 2, 0))
    chain = np.where(j == f["top"][reps] + 1, f["up"][reps], reps)  # of the parent
    opened, above = open_at(reps, j), np.where(j > 0, open_at(chain, j - 1), 0)
    ids = [[], prefix_ids(keys[0], max(before, 0)), prefix_ids(keys[-1], max(after, 0))]
    named = lambda which, depth: pa.array([ids[w][x] if w else None for w, x in zip(which.tolist(), depth.tolist())], pa.binary())
    its_end = (j == d) & (f["length"][lo] == d)
    columns = [
        pa.array(j), pa.array(f["first"][reps]), pa.array(f["first"][chain], mask=(j == 0) | (above > 0)), pa.array(f["n"][reps]),
        pa.array(np.where(j == d, f["kids"][reps], shared <= j)), pa.array(f["leaves"][reps]), pa.array(saved),
        pa.array([ends[i] if e else None for i, e in zip(lo.tolist(), its_end.tolist())], pa.string()), named(opened, j), named(above, j - 1), pa.array(np.full(len(j), pid)),
    ]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, NODE.types)], schema=NODE)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """A row for every distinct sequence of first turns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    conversations: conv_id (an integer), turn, role, text; other columns are not read, whatever their names. Turns are
    ordered by turn, null first, and where these are equal by the hash of role and text; repeated rows are turns of their
    own. Null role and text are empty; rows without conv_id belong to no conversation. Texts are whole. No rows give no
    nodes, otherwise the root has depth 0. A remainder has the sign of conv_id, as in SQL. A conversation's hashes, 20 bytes a turn, are one row.
    """
    rows = stored(distinct_sequences(rebuilt(conversations)))
    edges = shared_edges(rows)

    def run(batches):
        held, before = None, -1
        for batch in batches:
            if len(batch):
                pid, *own = batch.column("pid")[0].as_py(), *(batch.column(x).to_pylist() for x in ("key", "n", "first", "ends"))
                if held:
                    after = common(held[0][-1], own[0][0])
                    yield nodes_of(*held, before, after, pid)
                    before = after
                else:
                    before = edges[pid][0]
                held = own
        if held:
            yield nodes_of(*held, before, edges[pid][1], pid)

    nodes = stored(rows.mapInArrow(run, "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, id binary, parent_id binary, pid long"))
    crossing = nodes.filter("id is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = stored(crossing.groupBy("id").agg(F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("parent_id").alias("parent_id"), *sums, F.max("ends").alias("ends")))
    name = merged.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    figures = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    # A node's children are joined piece of the table by piece, so that the root's or a common turn's don't meet in one task.
    near = crossing.select(F.col("id").alias("parent_id"), "pid").distinct().join(name, "parent_id")
    inner = nodes.filter("id is null")
    out = inner.filter("parent_id is null").select(*figures).unionByName(
        inner.filter("parent_id is not null").drop("parent_conv_id").join(near, ["parent_id", "pid"]).select(*figures)
    ).unionByName(merged.join(name, "parent_id", "left").select(*figures))
    return out.select(*figures[:-1], F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
