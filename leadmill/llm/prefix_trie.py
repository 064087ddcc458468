"""The prefix trie of conversations, by intervals of sorted rows.

A conversation is a key: 16 bytes for each of its turns, so a common prefix is a common prefix of keys and texts are not
carried along. Keys are sorted over range partitions and read in blocks. In a block the longest common prefixes (LCPs) of
neighbouring rows go into a sparse table of range minima, and every prefix that a row is the first to have searches, by itself, how far
to the left and to the right the minimum stays at its depth: its member interval, without a stack. Sums over members are
differences of cumulated sums in (depth, row) order, sums over subtrees of those in preorder.

A node that holds the first or last row of its block may go on beside it. Only these stay open: the block's first and last row go on to
the next level, with what the block has found along their paths, and are sorted and settled there like conversations.
Each level has a small share of the rows of the one before; the last, of a bounded number of rows, is one block, where nothing is open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, small_batches, spool

WIDTH = 16  # bytes of a turn's key
BLOCK = 250_000  # nodes at most on the paths of a block's rows, but LEAST_ROWS rows at least
LEAST_ROWS = 32
TOP_ROWS = 4096  # rows of the last level
LEVEL_ROWS = 1024  # rows of a partition of the levels between
HELD = 500_000  # nodes that may be broadcast, at 24 bytes
SHARES = 16  # over which the rows of one parent are dealt beyond that
NONE = np.iinfo(np.int64).max
CARRIED = ("members", "low", "kids", "leaves", "saved")

ROWS = "key binary, conv long, chars array<long>, " + ", ".join(f"{c} array<long>" for c in CARRIED)
FOUND = pa.schema(
    [("kind", pa.string()), ("node", pa.binary()), ("parent", pa.binary()), ("ids", pa.string()), ("ends_sha256", pa.string())]
    + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("key", pa.binary()), ("conv", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("chars", *CARRIED)]
)
FOUND_SQL = f"kind string, node binary, parent binary, ids string, ends_sha256 string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, {ROWS}"
OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(conversations: DataFrame, group: int, spread: int) -> DataFrame:
    """conv, key, chars of every conversation c: the first h turns of conversation c - c % group, then c's own after its first h, where h
    is the unsigned crc32 of c in decimal modulo `spread`."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn_key = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.filter("conv_id is not null")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv"), F.struct("turn", turn_key.alias("k"), F.char_length(text).cast("long").alias("n")).alias("t"))
    own = spool(rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns")), "turns")
    base = F.col("conv") - F.col("conv") % group
    heads = own.filter(F.col("conv") == base).select(F.col("conv").alias("base"), F.slice("turns", 1, spread - 1).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % spread).cast("int")
    both = own.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0)), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    # The keys of turns joined to one: as hexadecimal text, since arrays of binaries cannot be joined.
    key = F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["k"])), ""))
    return both.select("conv", key.alias("key"), F.transform(turns, lambda t: t["n"]).alias("chars"))


class SparseTable:
    """Minima of ranges of `lcp`, and the searches over them."""

    def __init__(self, lcp: np.ndarray):
        self.levels = [lcp]
        while 2 << (len(self.levels) - 1) <= len(lcp):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row that shares `depth` turns with each row."""
        at, n = row.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            able = at + (1 << k) < n
            low = self.levels[k][np.where(able, at + 1, 0)]
            at += np.where(able & (low >= depth), 1 << k, 0)
        return at

    def left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row that shares `depth` turns with each row."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            able = at - (1 << k) >= 0
            low = self.levels[k][np.where(able, at - (1 << k) + 1, 0)]
            at -= np.where(able & (low >= depth), 1 << k, 0)
        return at


def common_prefixes(keys: list[bytes], turns: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the row before it; -1 for the first."""
    lcp = np.full(len(keys), -1, np.int64)
    if len(keys) > 1:
        own = np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2)
        start = np.cumsum(turns) - turns
        shorter = np.minimum(turns[1:], turns[:-1])
        row = np.repeat(np.arange(1, len(keys)), shorter)
        place = np.arange(len(row)) - np.repeat(np.cumsum(shorter) - shorter, shorter)
        differ = (own[start[row] + place] != own[start[row - 1] + place]).any(axis=1)
        lcp[1:] = shorter
        np.minimum.at(lcp, row[differ], place[differ])
    return lcp


def settle(rows: dict, first_level: bool, last_level: bool) -> dict[str, list]:
    """What a block of sorted rows finds, as columns of FOUND: `node` rows for nodes that lie inside it, `row`s for its first and last row,
    whose prefixes are open, and on the first level `ids` of conversations that end at open nodes."""
    keys, conv = rows["key"], rows["conv"]
    turns = np.array([len(k) // WIDTH for k in keys], np.int64)
    n = len(keys)
    size = turns + 1
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(n), size)
    depth = np.arange(size.sum()) - np.repeat(start, size)
    chars = np.zeros(len(row), np.int64)
    chars[depth > 0] = np.concatenate([*rows["chars"], np.empty(0, np.int64)])
    if first_level:
        zero = np.zeros(len(row), np.int64)
        carried = {"members": zero + 1, "low": conv[row], "kids": zero, "leaves": zero, "saved": zero}
    else:
        carried = {c: np.concatenate(rows[c]) for c in CARRIED}

    lcp = common_prefixes(keys, turns)
    new = depth > lcp[row]  # this row is the first with this prefix
    at, deep = row[new], depth[new]
    table = SparseTable(lcp)
    left, right = table.left(at, deep), table.right(at, deep)

    order = np.argsort(depth, kind="stable")  # by depth, then row: a node's rows stand together
    place = np.empty(len(row), np.int64)
    place[order] = np.arange(len(row))
    begin = place[start[left] + deep]

    def over_members(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values[order])])
        return sums[begin + right - left + 1] - sums[begin]

    by_depth = np.argsort(begin)
    low = np.empty(len(at), np.int64)
    low[by_depth] = np.minimum.reduceat(carried["low"][order], begin[by_depth])
    node_of = np.empty(len(row), np.int64)  # of a prefix, by its place
    node_of[:] = by_depth[np.searchsorted(begin[by_depth], np.arange(len(row)), "right") - 1]
    parent = np.where(deep > 0, node_of[place[start[at] + np.maximum(deep - 1, 0)]], -1)

    members, kids = over_members(carried["members"]), over_members(carried["kids"])
    open_ = np.zeros(len(at), bool) if last_level else (left == 0) | (right == n - 1)
    below = parent >= 0
    all_kids = kids + np.bincount(parent[below], minlength=len(at))
    closed_kids = kids + np.bincount(parent[below & ~open_], minlength=len(at))
    end = np.searchsorted(at, right + 1)

    def over_subtree(own: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(own)])
        return sums[end] - sums[np.arange(len(at))]

    text = chars[start[at] + deep]
    leaves = over_subtree(over_members(carried["leaves"]) + (~open_ & (all_kids == 0)))
    saved = over_subtree(over_members(carried["saved"]) + np.where(open_, 0, (members - 1) * text))

    out: dict[str, list] = {f.name: [] for f in FOUND}

    def add(kind: str, count: int, **columns) -> None:
        for name, values in out.items():
            values.extend(columns.get(name, [None] * count) if name != "kind" else [kind] * count)

    digest = lambda i, d: hashlib.md5(keys[i][: WIDTH * d]).digest()
    shut = np.flatnonzero(~open_)
    above = parent[shut]
    inside = (above >= 0) & ~open_[above]
    ends = dict.fromkeys(shut.tolist(), hashlib.sha256(b"").hexdigest())
    if first_level:
        heads = np.flatnonzero(lcp < turns)  # first rows of runs of equal conversations
        tails = np.append(heads[1:], n)
        for i, j, node in zip(heads.tolist(), tails.tolist(), node_of[place[start[heads] + turns[heads]]].tolist()):
            ids = ",".join(map(str, conv[i:j].tolist()))
            if open_[node]:
                add("ids", 1, node=[digest(i, turns[i])], conv_id=[int(conv[i])], ids=[ids])
            else:
                ends[node] = hashlib.sha256(ids.encode()).hexdigest()
    add(
        "node", len(shut),
        # On further levels the ends, and the children of other blocks, are found by the node's hash.
        node=[None] * len(shut) if first_level else [digest(i, d) for i, d in zip(at[shut].tolist(), deep[shut].tolist())],
        parent=[None if ok or d == 0 else digest(i, d - 1) for ok, i, d in zip(inside.tolist(), at[shut].tolist(), deep[shut].tolist())],
        ends_sha256=list(ends.values()),
        conv_id=low[shut].tolist(), depth=deep[shut].tolist(),
        parent_conv_id=[v if ok else None for ok, v in zip(inside.tolist(), low[above].tolist())],
        n_convs=members[shut].tolist(), n_children=all_kids[shut].tolist(), n_leaves=leaves[shut].tolist(), saved_tokens=saved[shut].tolist(),
    )
    if not last_level:
        # What closed nodes give to the open node above them: its subtree's sum without those of its open children.
        inner = below & open_
        values = {"members": members, "low": low, "kids": closed_kids}
        for name, sums in (("leaves", leaves), ("saved", saved)):
            values[name] = sums.copy()
            np.subtract.at(values[name], parent[inner], sums[inner])
        for i in {0, n - 1}:
            path = node_of[place[start[i] : start[i] + size[i]]]
            mine = (left[path] == 0) == (i == 0)  # what both rows share is told by the first
            told = {c: [np.where(mine, values[c][path], NONE if c == "low" else 0).tolist()] for c in CARRIED}
            add("row", 1, key=[keys[i]], conv=[int(conv[i])], chars=[chars[start[i] + 1 : start[i] + size[i]].tolist()], **told)
    return out


def blocks(batches: Iterator[pa.RecordBatch], block: int, least_rows: int, whole: bool) -> Iterator[dict]:
    """Rows in blocks of bounded weight; all in one with `whole`."""
    held: list[dict] = []
    weight = count = 0

    def joined() -> dict:
        return {c: held[0][c] if len(held) == 1 else (np.concatenate([h[c] for h in held]) if c == "conv" else [x for h in held for x in h[c]]) for c in held[0]}

    for batch in batches:
        keys = batch.column("key").to_pylist()
        load = np.cumsum([len(k) // WIDTH + 1 for k in keys])
        at = 0
        while at < len(keys):
            before = load[at - 1] if at else 0
            to = len(keys) if whole else max(int(np.searchsorted(load, before + block - weight, "right")), at + least_rows - count, at + 1)
            to = min(to, len(keys))
            part = batch.slice(at, to - at)
            held.append({"key": keys[at:to], "conv": part.column("conv").to_numpy(zero_copy_only=False)} | {c: [np.asarray(x.values) for x in part.column(c)] for c in part.schema.names if c not in ("key", "conv")})
            weight, count, at = weight + int(load[to - 1] - before), count + to - at, to
            if not whole and weight >= block and count >= least_rows:
                yield joined()
                held, weight, count = [], 0, 0
    if held:
        yield joined()


def settled(rows: DataFrame, first_level: bool, last_level: bool, parts: int, block: int, least_rows: int) -> DataFrame:
    """FOUND of all blocks of `rows`, which are sorted by range partitions; those of equal keys are dealt by conversation."""
    placed = rows.coalesce(1) if last_level else rows.repartitionByRange(parts, "key", "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, block, least_rows, last_level):
            found = settle(part, first_level, last_level)
            done = pa.table(found, schema=FOUND)
            yield from done.to_batches(max_chunksize=20_000)

    return spool(placed.sortWithinPartitions("key", "conv").mapInArrow(run, FOUND_SQL), "level")


def hashed_ids(parts: DataFrame) -> DataFrame:
    """node, ends_sha256: ids of a node's parts, in the order of their first, as one text. A task streams them, and the pieces of text are few: one
    for each block that a run of equal conversations meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()

        def told():
            return pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})

        for batch in batches:
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if key != node:
                    if node is not None:
                        yield told()
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
        if node is not None:
            yield told()

    return parts.repartition("node").sortWithinPartitions("node", "conv_id").select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, *, group: int = 100, spread: int = 6, block: int = BLOCK, least_rows: int = LEAST_ROWS, top_rows: int = TOP_ROWS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Columns conv_id, turn, role, text are read; others may have any name. Rows without a conv_id take no part. A null turn comes
    first; turns of one number are in the order of the MD5 of role and text, and repeated rows are turns each. A null role or text is
    empty. c % group has the sign of c, as in SQL. No conversations give no nodes. Turns are equal if the MD5 of role and text is.

    A conversation is one row: 16 bytes a turn while it is sorted, about a kilobyte a turn while its block is settled. Nothing else is ever
    gathered: equal conversations, however many, are sorted by their ids over many partitions. `block`, `least_rows` (3 or more) and
    `top_rows` set the size of blocks and of the last level; results do not depend on them.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    rows = spool(rebuilt(conversations, group, spread), "keys")
    parts = partitions(spark)
    levels = [settled(rows, True, False, parts, block, least_rows)]
    names = [c.split()[0] for c in ROWS.split(", ")]
    while True:
        rows = levels[-1].filter("kind = 'row'").select(*names)
        n = rows.count()
        last = n <= top_rows
        # Partitions of many rows, so that a level always has fewer than the one before.
        levels.append(settled(rows, False, last, min(parts, n // LEVEL_ROWS + 1), block, least_rows))
        if last:
            break
    high = levels[1].filter("kind = 'node'")
    for level in levels[2:]:
        high = high.unionByName(level.filter("kind = 'node'"))
    ends = hashed_ids(levels[0].filter("kind = 'ids'").select("node", "conv_id", "ids"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    high = spool(high.drop("ends_sha256").join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty)).select("node", "parent", *OUT), "high")

    nodes = levels[0].filter("kind = 'node'").select("node", "parent", *OUT).unionByName(high)
    found = nodes.filter("parent is null").select(*OUT)
    waiting = nodes.filter("parent is not null").drop("parent_conv_id")
    above = high.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    if above.count() <= HELD:
        joined = waiting.join(F.broadcast(above), "parent")
    else:
        share = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SHARES)).cast("int")
        above = above.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
        joined = waiting.withColumn("share", share).join(above, ["parent", "share"])
    return found.unionByName(joined.select(*OUT))
