"""Similarity joins of fingerprints: a stated query set against all rows.

Counts of bits bound the similarity, so they are dealt into bands and a query meets the rows of the bands that it can be
similar to. While the queries are small they are broadcast and the rows stay where they are. More queries meet the rows through an
inverted index: of two sets of a similarity, the rarest bits of either, as many as the threshold leaves over, have one in common, so each row
is listed under these bits only. Frequent bits are dealt over parts by the number of their rows. Where bits are so frequent that the lists hold more
comparisons than there are pairs, as with dense fingerprints, blocks of either side meet as matrix products instead, and what a task yields is what it
found. The most similar rows of each query are kept by such blocks too, so that no list of all pairs is ever sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fingerprint import common, popcount, set_bits, tanimoto
from ..store import spool

BROADCAST_BYTES = 16 << 20
BANDS = 16  # of the counts of bits
LISTED = 100_000  # rows of one part of a bit's list
INDEX_COST = 8  # a comparison of the index, in pairs of a product of 64 bits
BLOCK_ROWS, BLOCK_BYTES, BLOCK_PAIRS = 65_536, 4 << 20, 1 << 24  # most of a block; pairs of rows that are worth a task of their own
QUERY_TILE, ROW_TILE = 1024, 4096
FEW_PAIRS = 1 << 22  # pairs that one broadcast join compares in less time than an index or blocks take to be laid out


def fingerprints(rows: DataFrame, id_col: str, fp) -> DataFrame:
    return rows.select(F.col(id_col).alias("id"), fp.alias("fp")).withColumn("n", popcount(F.col("fp")))


def _enough(percent: int, words: int) -> Column:
    """Of columns fq, nq, fh, nh: different rows that are similar to percent / 100. Counts first, they cost least."""
    able = 100 * F.least("nq", "nh") >= percent * F.greatest("nq", "nh")
    # 100 * i >= percent * (nq + nh - i), with the common bits counted once.
    alike = (100 + percent) * common(F.col("fq"), F.col("fh"), words) >= percent * (F.col("nq") + F.col("nh"))
    return (F.col("q") != F.col("h")) & able & (F.col("nq") + F.col("nh") > 0) & alike


def _with_sim(pairs: DataFrame, words: int) -> DataFrame:
    return pairs.select("q", "h", tanimoto(common(F.col("fq"), F.col("fh"), words), F.col("nq"), F.col("nh")).alias("sim"))


def similar_pairs(queries: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """q, h, sim of every query with every other row that is similar to at least percent / 100."""
    count, most, words = queries.agg(F.count("*"), F.max("n"), F.max(F.size("fp"))).first()
    most, words = most or 0, words or 1
    block = max(1, BROADCAST_BYTES // ((BANDS + 1) * (8 * words + 32)))  # queries that may be broadcast
    if count > block and percent > 0:
        found = indexed_pairs(queries, rows, percent, "as blocks")
        return block_pairs(queries, rows, percent) if found is None else found
    width, blocks = most // BANDS + 1, max(1, -(-count // block))
    band = lambda n: F.floor(n / width).cast("int")
    # From n bits: n * percent / 100 to n * 100 / percent; what lies above the queries' counts is one more band.
    low, high = F.ceil(F.col("nq") * percent / 100), F.floor(F.col("nq") * 100 / percent) if percent else F.lit(most)
    top = F.lit(BANDS)
    q = queries.select(F.col("id").alias("q"), F.col("fp").alias("fq"), F.col("n").alias("nq"))
    q = q.withColumn("band", F.explode(F.sequence(band(low), F.least(band(high), top) if percent else top)))
    h = rows.select(F.col("id").alias("h"), F.col("fp").alias("fh"), F.col("n").alias("nh"), F.least(band(F.col("n")), top).alias("band"))
    if blocks == 1:
        both = h.join(F.broadcast(q), "band")
    else:
        parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // blocks)
        q = q.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        h = h.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        both = h.join(q, ["band", "block", "part"])
    return _with_sim(both.filter(_enough(percent, words)), words)


def without_similar(rows: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """The rows (id, fp, n) that are similar to at least percent / 100 to none of few centres. Centres are broadcast, and a row is compared until one is
    similar, so no pair leaves the join."""
    words = centres.agg(F.max(F.size("fp"))).first()[0] or 1
    q = centres.select(F.col("id").alias("q"), F.col("fp").alias("fq"), F.col("n").alias("nq"))
    h = rows.select(F.col("id").alias("h"), F.col("fp").alias("fh"), F.col("n").alias("nh"))
    return h.join(F.broadcast(q), _enough(percent, words), "left_anti").select(F.col("h").alias("id"), F.col("fh").alias("fp"), F.col("nh").alias("n"))


def indexed_pairs(queries: DataFrame, rows: DataFrame, percent: int, most: str | None = None) -> DataFrame | None:
    """As `similar_pairs`, by the index of rarest bits; percent is above 0. A set of n bits that is to share ceil(n * percent / 100) of
    them is listed under all but that many, less one: two such sets, both in the order of rarity, meet at the first bit that they share. A row and a query
    are compared in the list of that bit alone, so no pair comes twice. What is shuffled grows with the rows and the queries. With `most` "as blocks", None
where the lists take longer to compare than blocks do."""
    if percent <= 0:
        raise ValueError("an index needs a threshold")
    words = queries.agg(F.max(F.size("fp"))).first()[0] or 1
    counts = dict(rows.select(F.explode(set_bits(F.col("fp"))).alias("bit")).groupBy("bit").count().collect())  # one number a bit
    order = sorted(range(words * 32), key=lambda b: (counts.get(b, 0), b))
    rank_of = F.lit([rank for _, rank in sorted((b, rank) for rank, b in enumerate(order))])

    def listed(df: DataFrame) -> DataFrame:
        ranks = F.array_sort(F.transform(F.filter(set_bits(F.col("fp")), lambda b: b < words * 32), lambda b: F.get(rank_of, b)))
        keep = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
        return df.filter("n > 0").withColumn("rare", F.slice(ranks, F.lit(1), keep.cast("int")))

    h = spool(listed(rows.select("id", "fp", "n")), "listed")
    lists = dict(h.select(F.explode("rare").alias("bit")).groupBy("bit").count().collect())
    if most == "as blocks":
        asked = listed(queries.select("id", "fp", "n")).select(F.explode("rare").alias("bit")).groupBy("bit").count().collect()
        if INDEX_COST * sum(n * lists.get(rank, 0) for rank, n in asked) > queries.count() * rows.count() * words / 2:
            return None
    parts_of = F.lit([max(1, -(-lists.get(rank, 0) // LISTED)) for rank in range(words * 32)])
    h = h.select(F.col("id").alias("h"), F.col("fp").alias("fh"), F.col("n").alias("nh"), F.col("rare").alias("rh"), F.explode("rare").alias("bit"))
    h = h.withColumn("part", F.pmod(F.xxhash64("h"), F.get(parts_of, F.col("bit"))).cast("int"))
    q = listed(queries.select("id", "fp", "n")).select(F.col("id").alias("q"), F.col("fp").alias("fq"), F.col("n").alias("nq"), F.col("rare").alias("rq"), F.explode("rare").alias("bit"))
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.get(parts_of, F.col("bit")) - 1)))
    first = F.array_min(F.array_intersect("rq", "rh")) == F.col("bit")
    # Lists are short and their comparisons many, so their number of partitions must not follow their bytes.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    h, q = (side.repartition(parts, "bit", "part") for side in (h, q))
    return _with_sim(h.join(q, ["bit", "part"]).filter(_enough(percent, words)).filter(first), words)


def self_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """q, h, sim of all pairs of rows, q < h, that are similar to at least percent / 100, each once."""
    if rows.count() ** 2 <= FEW_PAIRS:
        return similar_pairs(rows, rows, percent).filter("q < h")
    found = indexed_pairs(rows, rows, percent, "as blocks") if percent > 0 else None
    return block_pairs(rows, None, percent) if found is None else found.filter("q < h")


def block_pairs(queries: DataFrame, rows: DataFrame | None, percent: int) -> DataFrame:
    """As `similar_pairs`, by products of blocks; without `rows` as `self_pairs`."""
    among = rows is None

    def run(q: Block, h: Block) -> Iterator[pd.DataFrame]:
        for a, b, sim in alike(q, h, percent):
            if among:
                once = a < b if q.name == h.name else a != b
                a, b, sim = np.minimum(a, b)[once], np.maximum(a, b)[once], sim[once]
            yield pd.DataFrame({"q": a, "h": b, "sim": sim})

    return _met(queries, rows, run, "q long, h long, sim double")


class Block:
    """Rows of one block, by id: ids, counts of bits, and the bits in words of 32."""

    def __init__(self, name: int, ids: bytes, counts: bytes, bits: bytes):
        self.name, self.ids, self.n = name, np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64)
        self.words = np.frombuffer(bits, np.uint32).reshape(len(self.ids), -1)
        # Sums below stay under twice this; in whole numbers up to 2 ** 24 single precision is exact.
        self.kind = np.float32 if 4 * (32 * self.words.shape[1] + 100) ** 2 < 1 << 24 else np.float64

    def matrix(self, part: slice) -> np.ndarray:
        return np.unpackbits(self.words[part].view(np.uint8), axis=1).astype(self.kind)

    def columns(self, part: slice) -> np.ndarray:
        """The right side of a product: a column a row, with its count and a one below its bits."""
        m = self.matrix(part)
        return np.vstack([m.T, self.n[part].astype(self.kind)[None], np.ones((1, len(m)), self.kind)])

    def tiles(self, size: int) -> Iterator[slice]:
        return (slice(at, min(at + size, len(self.ids))) for at in range(0, len(self.ids), size))


def alike(q: Block, h: Block, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids and similarity of the pairs similar to at least percent / 100, tile by tile."""
    for one in q.tiles(QUERY_TILE):
        n = q.n[one].astype(q.kind)[:, None]
        left = np.hstack([(100 + percent) * q.matrix(one), np.full_like(n, -percent), -percent * n])
        for other in h.tiles(ROW_TILE):
            # 100 * i - percent * (nq + nh - i)
            over = left @ h.columns(other)
            r, c = np.nonzero(over >= 0)
            r, c = r + one.start, c + other.start
            some = (q.ids[r] != h.ids[c]) & (q.n[r] + h.n[c] > 0)
            r, c = r[some], c[some]
            i = np.bitwise_count(q.words[r] & h.words[c]).sum(axis=1, dtype=np.int64)
            yield q.ids[r], h.ids[c], i / (q.n[r] + h.n[c] - i)


def most_similar(q: Block, h: Block, k: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids and similarity of the k most similar rows of each query, ties to the smaller id, of those similar to at least percent / 100. Rows come by id,
    so after k of them only what is more similar than the k-th counts; that is asked of all at once, in whole numbers."""
    for one in q.tiles(QUERY_TILE):
        bits, n = q.matrix(one), q.n[one]
        rows = len(n)
        kept = np.empty(0, np.int64), np.empty(0, np.int64)  # rows of the tile and of the block, by row of the tile, best first
        common_of = lambda r, c: np.bitwise_count(q.words[one][r] & h.words[c]).sum(axis=1, dtype=np.int64)
        # Of the k-th: its common bits and all of both; a query without k takes any row.
        i_k, u_k, full = np.zeros(rows, np.int64), np.ones(rows, np.int64), np.zeros(rows, bool)
        at, size = 0, max(32, k)
        while at < len(h.ids):
            part = slice(at, min(at + size, len(h.ids)))
            # i / (nq + nh - i) > i_k / u_k
            alpha, beta, gamma = np.where(full, i_k + u_k, 0), np.where(full, i_k, 0), np.where(full, i_k * n, -1)
            left = np.hstack([bits * alpha.astype(q.kind)[:, None], -beta.astype(q.kind)[:, None], -gamma.astype(q.kind)[:, None]])
            r, c = np.nonzero(left @ h.columns(part) > 0)
            c = c + at
            some = (q.ids[one][r] != h.ids[c]) & (n[r] + h.n[c] > 0)
            r, c = np.concatenate([kept[0], r[some]]), np.concatenate([kept[1], c[some]])
            i = common_of(r, c)
            u = n[r] + h.n[c] - i
            order = np.lexsort((c, -i / u, r))
            r, c, i, u = r[order], c[order], i[order], u[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            last = place == k - 1
            i_k[r[last]], u_k[r[last]], full[r[last]] = i[last], u[last], True
            kept = r[place < k], c[place < k]
            at, size = part.stop, min(ROW_TILE, 2 * size)
        r, c = kept
        i = common_of(r, c)
        u = n[r] + h.n[c] - i
        near = 100 * i >= percent * u
        yield q.ids[one][r[near]], h.ids[c[near]], (i / u)[near]


def _blocks(rows: DataFrame, blocks: int, words: int, name: str) -> DataFrame:
    """The rows (id, fp, n) dealt by id into so many rows of packed columns; those without a fingerprint are similar to nothing."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", kind="stable")
        bits = np.array([[*x, *[0] * (words - len(x))] for x in part["fp"]], np.uint64).astype(np.uint32)
        whole = (part["id"].to_numpy(np.int64).tobytes(), part["n"].to_numpy(np.int64).tobytes(), bits.tobytes())
        return pd.DataFrame([(int(part["block"].iloc[0]), *whole)], columns=["block", "ids", "ns", "fps"])

    dealt = rows.filter("id is not null and n is not null").select(F.col("id").cast("long").alias("id"), "fp", "n", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    packed = dealt.groupBy("block").applyInPandas(pack, "block int, ids binary, ns binary, fps binary")
    return packed.select(F.col("block").alias(name), F.struct("block", "ids", "ns", "fps").alias(f"rows_{name}"))


def _met(queries: DataFrame, rows: DataFrame | None, run, schema: str) -> DataFrame:
    """What `run` makes of each block of queries with each block of rows; without `rows`, of each two blocks of queries, and each with itself, once."""
    stats = [df.agg(F.count("*"), F.max(F.size("fp"))).first() for df in (queries, rows) if df is not None]
    counts, words = [n for n, _ in stats], max(1, *(w or 1 for _, w in stats), 1)
    cap = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (4 * words + 16)))
    tasks = min(max(64, 4 * queries.sparkSession.sparkContext.defaultParallelism), max(1, counts[0] * counts[-1] // BLOCK_PAIRS))
    if rows is None:
        blocks = [max(1, -(-counts[0] // cap), int((2 * tasks) ** 0.5))] * 2
    else:
        blocks = [max(1, -(-n // cap)) for n in counts]
        while blocks[0] * blocks[1] < tasks:
            larger = counts[1] * blocks[0] > counts[0] * blocks[1]
            blocks[larger] *= 2
    a, b = _blocks(queries, blocks[0], words, "i"), _blocks(queries if rows is None else rows, blocks[1], words, "j")
    upto = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high)))
    a = a.withColumn("j", F.explode(F.sequence("i", F.lit(blocks[1] - 1))) if rows is None else upto(0, blocks[1] - 1))
    b = b.withColumn("i", F.explode(F.sequence(F.lit(0), "j")) if rows is None else upto(0, blocks[0] - 1))
    # More partitions than pairs of blocks, so that few tasks get several.
    parts = min(4 * blocks[0] * blocks[1], 4000) if blocks[0] * blocks[1] > 1 else 1
    both = a.repartition(parts, "i", "j").join(b.repartition(parts, "i", "j"), ["i", "j"]).select("rows_i", "rows_j")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, y in zip(batch["rows_i"].tolist(), batch["rows_j"].tolist()):
                sides = (Block(*(side[name] for name in ("block", "ids", "ns", "fps"))) for side in (x, y))
                for out in run(*sides):
                    for at in range(0, len(out), 100_000):
                        yield out.iloc[at : at + 100_000]

    return both.mapInPandas(each, schema)


def top_per_query(queries: DataFrame, rows: DataFrame, k: int, percent: int = 0) -> DataFrame:
    """The k most similar rows of each query, ties to the smaller id. A task yields at most k rows a query, whatever the rows it has seen."""

    def run(q: Block, h: Block) -> Iterator[pd.DataFrame]:
        for a, b, sim in most_similar(q, h, k, percent):
            yield pd.DataFrame({"q": a, "h": b, "sim": sim})

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "h"))
    found = _met(queries, rows, run, "q long, h long, sim double")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("q", "h", "sim", "rank")


def nearest(pairs: DataFrame) -> DataFrame:
    """(h, q, sim): of pairs (q, h, sim) each h with its most similar q, ties to the smaller q."""
    best = F.max(F.struct("sim", (-F.col("q")).alias("order"))).alias("b")
    return pairs.groupBy("h").agg(best).select("h", (-F.col("b.order")).alias("q"), "b.sim")


def assign_to_nearest(centres: DataFrame, rows: DataFrame, percent: int = 0) -> DataFrame:
    """(h, q, sim): each row's most similar centre of those similar to at least percent / 100, a centre itself being
    its own; ties to the smaller centre."""
    own = centres.select(F.col("id").alias("h"), F.col("id").alias("q"), F.lit(1.0).alias("sim"))
    others = rows.join(own.select(F.col("h").alias("id")), "id", "left_anti")
    return nearest_centre(centres, others, percent).unionByName(own)


def nearest_centre(centres: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(h, q, sim): each row's most similar other centre of those similar to at least percent / 100, ties to the smaller centre."""
    count = centres.count()
    if percent > 0 and count * rows.count() <= FEW_PAIRS:
        return nearest(similar_pairs(centres, rows, percent))
    many = percent > 0 and count > QUERY_TILE  # an index is dear to lay out; few centres are one tile
    found = indexed_pairs(centres, rows, percent, "as blocks") if many else None
    if found is not None:
        return nearest(found)
    return top_per_query(rows, centres, 1, percent).select(F.col("q").alias("h"), F.col("h").alias("q"), "sim")


def write_store(rows: DataFrame, path: str, width: int) -> None:
    """Fingerprints (id, fp, n) as a table in folders by `width` counts of bits, sorted by the count within each file: what cannot be similar to
    a query is neither listed nor, within a file, read."""
    banded = rows.select("id", "fp", "n", F.floor(F.col("n") / width).cast("int").alias("band"))
    # By ranges of count and id, so that a count that many rows share is written by many tasks.
    banded.repartitionByRange("n", "id").sortWithinPartitions("n", "id").write.partitionBy("band").parquet(path)


def stored_pairs(queries: DataFrame, path: str, width: int, percent: int) -> DataFrame:
    """`similar_pairs` with the rows of a store, of which only the folders and row groups are read that the queries' counts of bits leave open."""
    low, high = queries.agg(F.min("n"), F.max("n")).first()
    rows = queries.sparkSession.read.parquet(path)
    if low is not None and percent > 0:
        least, most = -(-low * percent // 100), high * 100 // percent
        rows = rows.filter(F.col("band").between(least // width, most // width) & F.col("n").between(least, most))
    return similar_pairs(queries, rows.select("id", "fp", "n"), percent)
