"""Near-duplicate documents by MinHash.

A document is its set of word shingles; equal sets are one class from the start, and classes are the nodes of
the graph. 240 universal hash functions (a * x + b, 64 bits) give a set's minima; 40 bands of six minima each
give its buckets. Two sets of similarity 0.8 share no bucket with a probability of five in a million.

Only classes that share a bucket with another one go on; their bucket keys, signatures (a byte of each minimum)
and full sets are written once. The members of a bucket are compared with its smallest member: signatures
first, full sets confirm. The links found give components.

A link can still be missing between members of a bucket that are both unlike its smallest one. Buckets whose
smallest members lie in one component are therefore put together: everything that meets the component in
a bucket is compared with what meets it there without belonging to it, unless both are of one component. This is done
inside groups of bounded weight that hold the full sets, so nothing leaves a group but confirmed links, and of
these only the ones that join components: fewer than the group has members. All links together give the
components of the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_words import WordMemo
from .common import map_texts, spool
from .components import components

BANDS, ROWS = 40, 6
FUNCTIONS = BANDS * ROWS
SIGMAS = 4.5
BLOCK = 1_000_000  # shingles of the members of one block; a group holds two blocks
SEEN = 100_000  # sets of a task that it knows as repeated
BROADCAST_ROWS = 1_000_000  # of two longs
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def universal() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(11)
    return r.integers(0, 2**63, FUNCTIONS, np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 2**63, FUNCTIONS, np.uint64)


def memo() -> WordMemo:
    """Hashes of the words met; each task has its own, so that none outlives its stage."""
    return WordMemo(lambda w: int.from_bytes(blake2b(w, digest_size=8).digest(), "little"), 100_000)


def shingles(text: str | None, size: int, hashes: WordMemo) -> np.ndarray:
    """The sorted different hashes of the text's shingles of `size` words; one of the whole
    sequence if it has fewer words."""
    found = text.encode().lower().split() if text else []  # bytes: A-Z only, and ASCII white space
    if not found:
        return np.empty(0, np.uint64)
    w = np.array(list(map(hashes.__getitem__, found)), np.uint64)
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        h = (h ^ w[k : len(w) - n + 1 + k]) * MULTIPLY
        h ^= h >> np.uint64(29)
    return np.unique(h)


def minima(s: np.ndarray) -> np.ndarray:
    """The upper halves of the minima of all functions."""
    a, b = universal()
    least = np.full(FUNCTIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 1024):
        np.minimum(least, (a[:, None] * s[None, at : at + 1024] + b[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def describe(docs: DataFrame, size: int) -> DataFrame:
    """i, x, n, same (hash of the set), bands, signature of each row of (i, x, t). Where a task meets a set
    again, and where there is no id, bands and signature are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, seen = memo(), set()
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part, rows = batch.iloc[at : at + 2000], []
                for named, text in zip(part["i"].notna(), part["t"]):
                    s = shingles(text, size, hashes)
                    if not len(s):
                        rows.append((0, None, None, None))
                        continue
                    same = blake2b(s.tobytes(), digest_size=16).digest()
                    if same in seen or not named:
                        rows.append((len(s), same, None, None))
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(same)
                    m = minima(s)
                    band = np.full(BANDS, 7, np.uint64) + np.arange(BANDS, dtype=np.uint64)
                    for k in range(ROWS):
                        band = (band ^ m[k::ROWS]) * MULTIPLY
                        band ^= band >> np.uint64(31)
                    rows.append((len(s), same, band.astype(np.int64), m.astype(np.uint8).tobytes()))
                out = pd.DataFrame(rows, columns=["n", "same", "bands", "signature"])
                out.insert(0, "i", part["i"].astype("Int64").array)
                out.insert(1, "x", part["x"].array)
                yield out

    return map_texts(docs, run, "i long, x long, n long, same binary, bands array<long>, signature binary")


def floor(percent: int) -> float:
    """The least share of equal signature bytes with which the similarity is still in question."""
    return percent / 100 - SIGMAS * (percent / 100 * (1 - percent / 100) / FUNCTIONS) ** 0.5


def near(a: str, b: str, percent: int) -> Column:
    """Whether the sizes allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def bucket_members(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """key, k: the buckets with several classes, and these (k, i, n, same, signature), where i is the smallest id
    of the class's rows. The bands of all classes are shuffled twice; what follows is as large as the
    number of classes that share a bucket."""
    known = every.filter("i is not null and n > 0")
    rows = known.filter("bands is not null").select(F.explode("bands").alias("key"), F.xxhash64("same").alias("h"))
    shared = rows.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("key")
    met = spool(rows.join(spool(shared, "shared"), "key"), "met")
    one = known.filter("bands is not null").withColumn("h", F.xxhash64("same")).join(met.select("h").distinct(), "h", "left_semi")
    one = one.groupBy("same").agg(F.first(F.struct("n", "signature")).alias("r"))
    ids = known.groupBy("same").agg(F.min("i").alias("i"))
    classes = one.join(ids, "same").select(F.monotonically_increasing_id().alias("k"), "i", "r.n", "same", "r.signature")
    classes = spool(classes, "classes")
    members = met.join(classes.select(F.xxhash64("same").alias("h"), "k"), "h").select("key", "k").distinct()
    return spool(members, "members"), classes


def full_sets(docs: DataFrame, every: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """k, s: the shingle sets of the classes, each from the text of one of its rows. Texts are shuffled only
    if there are more classes than a broadcast may hold."""
    row = every.select("same", "i", "x").join(classes.select("same", "k", "i"), ["same", "i"])
    row = spool(row.groupBy("k").agg(F.min(F.xxhash64("i", "x")).alias("row")), "rows")
    few = row.count()
    some = docs.select(F.xxhash64("i", "x").alias("row"), "t").join(F.broadcast(row) if few <= BROADCAST_ROWS else row, "row").select("k", "t")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, seen = memo(), set()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                part = part[~part["k"].duplicated() & ~part["k"].isin(seen)]
                seen.update(part["k"])
                yield pd.DataFrame({"k": part["k"], "s": [shingles(t, size, hashes).astype(np.int64) for t in part["t"]]})

    sets = spool(map_texts(some, run, "k long, s array<long>"), "sets")
    # Rows that repeat an id and a text, over several tasks.
    return sets if sets.count() == few else spool(sets.dropDuplicates(["k"]), "sets")


def star_links(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): confirmed links of the buckets' smallest members with the others."""
    centre = members.groupBy("key").agg(F.min("k").alias("u"))
    pairs = members.join(centre, "key").filter("k <> u").select("u", F.col("k").alias("v")).distinct()
    least = floor(percent)

    def agree(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), FUNCTIONS) for s in (a, b))
        return pd.Series((x == y).mean(axis=1) >= least)

    end = lambda c: classes.select(F.col("k").alias(c), F.col("n").alias(f"n{c}"), F.col("signature").alias(f"s{c}"))
    both = pairs.join(end("v"), "v").join(end("u"), "u").filter(near("nu", "nv", percent))
    likely = spool(both.filter(F.pandas_udf(agree, "boolean")("su", "sv")).select("u", "v"), "pairs")
    named = lambda c: sets.select(F.col("k").alias(c), F.col("s").alias(f"s{c}"))
    both = likely.join(named("v"), "v").join(named("u"), "u")
    common = F.size(F.array_intersect("su", "sv"))
    return both.filter(100 * common >= percent * (F.size("su") + F.size("sv") - common)).select("u", "v")


class RareIndex:
    """The sets of a group, listed under their rarest shingles: of a set of n, under all but the ceil(n * percent / 100) that it must share with
    any set so similar, and one more. Two such sets meet in the list of the rarest shingle that they share."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        n = np.array([len(s) for s in sets])
        values, of, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.numbers, self.ends, self.marked = of, np.append(0, np.cumsum(n)), np.zeros(len(values), bool)
        rank = np.empty(len(values), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(values))
        row = np.repeat(np.arange(len(sets)), n)
        rank = np.sort(row * len(values) + rank[of]) - row * len(values)  # of each set in turn, its rarest first
        place = np.arange(len(row)) - np.repeat(self.ends[:-1], n)
        keep = place < np.repeat(n + (-percent * n // 100) + 1, n)
        self.rank, row = rank[keep], row[keep]
        self.first = np.searchsorted(row, np.arange(len(sets) + 1))
        by_rank = np.argsort(self.rank, kind="stable")
        self.rows, self.starts = row[by_rank], np.searchsorted(self.rank[by_rank], np.arange(len(values) + 1))

    def partners(self, u: int) -> np.ndarray:
        """The sets in the lists of u, itself among them."""
        own = self.rank[self.first[u] : self.first[u + 1]]
        own = own[self.starts[own + 1] - self.starts[own] > 1]
        return np.unique(np.concatenate([self.rows[self.starts[r] : self.starts[r + 1]] for r in own])) if len(own) else own

    def common(self, u: int, v: np.ndarray) -> np.ndarray:
        """How many shingles each of the sets v shares with u. Shingles are compared by number, so no order of the sets counts."""
        own = self.numbers[self.ends[u] : self.ends[u + 1]]
        size = self.ends[v + 1] - self.ends[v]
        self.marked[own] = True
        hit = self.marked[np.concatenate([self.numbers[self.ends[x] : self.ends[x + 1]] for x in v])]
        self.marked[own] = False
        return np.add.reduceat(hit, np.append(0, size.cumsum()[:-1]), dtype=np.int64)


def joining_links(g: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Confirmed links between the rows (k, n, c, far, part, signature, s) of one group that join
    components: between rows that are `far` and any others, of different blocks where the group holds two. Only sets that share one of
    their rarest shingles are looked at, so what many share costs nothing."""
    k, n, c, far, part = (g[x].to_numpy() for x in ("k", "n", "c", "far", "part"))
    signature = np.frombuffer(b"".join(g["signature"]), np.uint8).reshape(len(g), FUNCTIONS)
    two, least = part.min() != part.max(), floor(percent)
    index = RareIndex(g["s"].tolist(), percent)
    root = np.unique(c, return_inverse=True)[1]  # of each row, as joined so far
    rows: list[list[int]] = [[] for _ in range(root.max() + 1)]
    for x, r in enumerate(root.tolist()):
        rows[r].append(x)

    def join(a: int, b: int) -> None:
        a, b = (a, b) if len(rows[a]) >= len(rows[b]) else (b, a)
        root[rows[b]] = a
        rows[a] += rows[b]
        rows[b] = []

    links = []
    for u in np.flatnonzero(far):
        v = index.partners(u)
        v = v[(100 * np.minimum(n[v], n[u]) >= percent * np.maximum(n[v], n[u])) & ((part[v] != part[u]) | (not two)) & (~far[v] | (k[v] > k[u]))]
        v = v[root[v] != root[u]]
        v = v[(signature[v] == signature[u]).mean(axis=1) >= least] if len(v) else v
        while len(v):
            some, v = v[:256], v[256:]
            common = index.common(u, some)
            for x in some[100 * common >= percent * (n[some] + n[u] - common)]:
                if root[x] != root[u]:
                    join(int(root[x]), int(root[u]))
                    links.append((int(k[u]), int(k[x])))
            v = v[root[v] != root[u]]
    return links


def mixed_links(members: DataFrame, classes: DataFrame, sets: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """(u, v): confirmed links of different components, from the buckets of three or more that hold several."""
    of = classes.select("k", "n").join(component, classes["k"] == component["node"], "left").select("k", "n", F.coalesce("component", "k").alias("c"))
    of = spool(of, "of")
    centre = members.groupBy("key").agg(F.min("k").alias("u"), F.count("*").alias("m")).filter("m > 2")
    # Every class with the components of the centres that it meets.
    rows = members.join(centre, "key").join(of.select(F.col("k").alias("u"), F.col("c").alias("at")), "u").select("at", "k").distinct().join(of, "k")
    rows = rows.withColumn("far", F.col("c") != F.col("at"))
    held = rows.groupBy("at").agg(F.sum("n").alias("all"), F.sum(F.col("far").cast("int")).alias("few")).filter("few > 0")
    held = held.select("at", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"))
    rows = spool(rows.join(held, "at"), "mixed")
    # Beyond a few blocks, each pair of blocks of which one has far rows is one group.
    rows = rows.withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    blocks = rows.groupBy("at", "part", "blocks").agg(F.max("far").alias("any")).filter("any").select("at", F.col("part").alias("with"), "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    groups = blocks.select("at", "with", other.alias("part")).select("at", "part", F.least("part", "with").alias("p"), F.greatest("part", "with").alias("q"))
    groups = groups.unionByName(groups.select("at", F.when(F.col("part") == F.col("p"), F.col("q")).otherwise(F.col("p")).alias("part"), "p", "q")).distinct()
    full = rows.select("at", "k", "n", "c", "far", "part").join(groups, ["at", "part"]).join(classes.select("k", "signature"), "k").join(sets, "k")
    full = full.repartition("at", "p", "q").sortWithinPartitions("at", "p", "q", "k")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def groups() -> Iterator[pd.DataFrame]:
            held: list[pd.DataFrame] = []
            name = None
            for batch in batches:
                key = batch[["at", "p", "q"]].to_numpy()
                start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
                for a, b in zip(start, np.append(start[1:], len(batch))):
                    if held and tuple(key[a]) != name:
                        yield pd.concat(held, ignore_index=True)
                        held = []
                    name = tuple(key[a])
                    held.append(batch.iloc[a:b])
            if held:
                yield pd.concat(held, ignore_index=True)

        for g in groups():
            if g["far"].any() and len(g) > 1 and (links := joining_links(g, percent)):
                yield pd.DataFrame(links, columns=["u", "v"])

    return map_texts(full, run, "u long, v long").distinct()


def linked(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """i, x, n, component of each row, where x is a hash of its text."""
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("x"), F.col(f"`{text_col}`").cast("string").alias("t"))
    every = spool(describe(plain, size), "described")
    members, classes = bucket_members(every)
    sets = full_sets(plain, every, classes, size)
    links = spool(star_links(members, classes, sets, percent), "links")
    first = spool(components(links), "components")
    more = spool(mixed_links(members, classes, sets, first, percent), "more")
    if not more.isEmpty():
        first = spool(components(links.unionByName(more)), "components")

    joined = first.join(classes.select("k", "i", "same"), first["node"] == F.col("k"))
    least = joined.groupBy("component").agg(F.min("i").alias("least"))
    named = joined.join(least, "component").select("same", "least")
    copies = every.filter("i is not null and n > 0").groupBy("same").agg(F.min("i").alias("least"), F.max("i").alias("most")).filter("least <> most")
    named = named.unionByName(copies.select("same", "least")).groupBy("same").agg(F.min("least").alias("least"))
    out = every.select("i", "x", "n", "same").join(spool(named, "named"), "same", "left")
    # Without an entry a document is its own component.
    return out.select("i", "x", "n", F.when(F.col("i").isNotNull(), F.coalesce("least", "i")).alias("component"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable over links), kept.

    Words are what stands between ASCII white space, with A-Z lower-cased. Two documents are linked
    if their shingle sets have at least percent / 100 of their union in common. A null text, or one
    without words, has an empty set and no links. Rows that repeat an id with the same set have one
    component; those that repeat it with different sets are documents of their own. A row without an id has no component and is
    kept. Only the two named columns are read; an empty table gives no rows; whole texts count.
    """
    found = linked(docs, id_col, text_col, size, percent)
    return found.select(F.col("i").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("i") == F.col("component"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, that near_duplicates keeps.

    Of each group the document with the smallest id stays; rows that repeat its id and text are the same
    document and stay with it. Rows without an id, a text or words stay.
    """
    found = linked(docs, id_col, text_col, size, percent)
    own, text = (f"{n}_{uuid.uuid4().hex}" for n in ("id", "text"))
    lost = spool(found.filter("i <> component").select(F.col("i").alias(own), F.col("x").alias(text)).distinct(), "lost")
    return docs.join(lost, (F.col(f"`{id_col}`").cast("long") == F.col(own)) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col(text)), "left_anti")
