"""Line deduplication by a deletion-neighbourhood join, within one edit.

Lines of at least `min_chars` characters are compared over all documents; the earliest of a line and its
neighbours, by document and place, is kept. Two lines are one edit apart exactly if
  - deleting one character of the one gives the other, or
  - deleting the character at the same place gives the same from both.
So each line emits, as hashed keys, itself and all variants with one deletion: a plain key joins a line
with variants of longer lines, a key with the place joins variants with variants. The first kind gives
pairs of a line and its longer neighbours; all members of the second are neighbours of each other, and
each is paired with the earliest. Pairs thus grow with the variants, not with a group's square. The edit
distance of every pair is verified on the texts.

A line has as many variants as characters, so only lines that can have a neighbour emit them. An edit
lies in one half of a line; the other half stays as it is. Lines meet by the hash of a half (and the
shorter line's length); those whose halves meet no other line have no neighbour. The edit bound is one: the prior
step and the two kinds of keys hold for it alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, spool

BROADCAST_BYTES = 16_000_000  # of rows; beyond that both sides are shuffled
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
ROWS_OUT = 100_000


def small(df: DataFrame, width: int) -> DataFrame:
    """`df`, of rows of at most `width` bytes, marked for broadcast if they are few enough."""
    most = BROADCAST_BYTES // width
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def deletions(line: str) -> tuple[int, np.ndarray]:
    """The hash of the line, and those of its variants without the character at each place."""
    c = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    powers = np.full(len(c), BASE, np.uint64)
    powers[:1] = 1
    powers = np.cumprod(powers)
    term = spread(c + np.uint64(1)) * powers
    upto = np.cumsum(term, dtype=np.uint64)
    total = upto[-1] if len(c) else np.uint64(0)
    with np.errstate(over="ignore"):
        without = (upto - term) + (total - upto) * np.uint64(INVERSE)
    return int(spread(np.array([total]))[0]), spread(without)


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """i, x, at, line: the compared lines of (i, x, t), with their places."""
    rows = docs.filter("i is not null and t is not null").select("i", "x", F.posexplode(F.split("t", "\n")).alias("at", "line"))
    return rows.filter(F.length("line") >= min_chars)


def identity(line: str) -> Column:
    return F.unhex(F.md5(F.col(line).cast("binary")))


def halves(lines: DataFrame) -> DataFrame:
    """key, h, line: a key for either half, with the line as the shorter or the longer of two."""
    n = F.length("line")

    def of(m: Column) -> list[Column]:
        head = F.floor(m / 2).cast("int")
        tail = F.substring(F.col("line"), n - (m - head) + 1, m - head)
        return [F.xxhash64(m, F.lit("head"), F.substring(F.col("line"), F.lit(1), head)), F.xxhash64(m, F.lit("tail"), tail)]

    return lines.select("line", F.xxhash64("line").alias("h"), F.explode(F.array(*of(n), *of(n - 1))).alias("key"))


def lines_with_chance(lines: DataFrame) -> DataFrame:
    """The lines (all occurrences) of which a half meets another line."""
    keyed = halves(lines)
    meet = keyed.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("key")
    meet = spool(meet, "halves")
    some = spool(keyed.join(small(meet, 40), "key", "left_semi").select("h").distinct(), "chance")
    return lines.withColumn("h", F.xxhash64("line")).join(small(some, 40), "h", "left_semi").drop("h")


def variants(lines: DataFrame) -> DataFrame:
    """kind ('line', 'variant', 'place'), key, id of each different line (id, line)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def out():
            return pd.concat(held, ignore_index=True)

        for batch in batches:
            for id_, line in zip(batch["id"], batch["line"]):
                own, without = deletions(line)
                place = spread(without ^ spread(np.arange(len(without), dtype=np.uint64) + np.uint64(1)))
                for kind, key in (("line", np.array([own], np.uint64)), ("variant", np.unique(without)), ("place", place)):
                    held.append(pd.DataFrame({"kind": kind, "key": key.view(np.int64), "id": id_}))
                    size += len(key)
                if size >= ROWS_OUT:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return map_texts(lines.select("id", "line"), run, "kind string, key long, id long")


def neighbours(lines: DataFrame) -> DataFrame:
    """The ids of lines that have an earlier line within one edit, of different lines
    (id, line) whose ids ascend from the earliest."""
    keyed = spool(variants(lines), "variants")
    kind = lambda k: keyed.filter(F.col("kind") == k).select("key", "id")
    own = kind("line").select("key", F.col("id").alias("x"))
    longer = kind("variant").join(own, "key").select(F.least("id", "x").alias("early"), F.greatest("id", "x").alias("late"))
    earliest = kind("place").groupBy("key").agg(F.min("id").alias("early"), F.count("*").alias("n")).filter("n > 1").select("key", "early")
    same = kind("place").join(spool(earliest, "earliest"), "key").filter("id <> early").select("early", F.col("id").alias("late"))
    pairs = longer.unionByName(same).distinct()
    text = lambda c: lines.select(F.col("id").alias(c), F.col("line").alias(f"t_{c}"))
    both = pairs.join(text("early"), "early").join(text("late"), "late")
    return both.filter(F.levenshtein("t_early", "t_late", 1) == 1).select(F.col("late").alias("id")).distinct()


def removals(docs: DataFrame, min_chars: int) -> DataFrame:
    """i, x, gone (places of the lines to remove, ascending) of the documents (i, x, t) that lose any."""
    lines = occurrences(docs, min_chars)
    first = F.min(F.struct("i", "x", "at")).alias("first")
    repeated = lines.groupBy(identity("line").alias("m")).agg(first, F.count("*").alias("n")).filter("n > 1").select("m", "first")
    chance = lines_with_chance(lines).groupBy(identity("line").alias("m")).agg(first, F.first("line").alias("line"))
    # Sorted, so that ids ascend with the places and tell which of two lines is the earlier.
    chance = spool(chance.orderBy("first").select("m", "line", "first", F.monotonically_increasing_id().alias("id")), "lines")
    late = neighbours(chance)
    gone = chance.join(late, "id", "left_semi").select("m", F.lit(True).alias("late"))
    marked = repeated.join(gone, "m", "full").select("m", "first", F.coalesce("late", F.lit(False)).alias("late"))
    marked = spool(marked, "marked")
    found = lines.select("i", "x", "at", identity("line").alias("m"))
    keys, most = marked.select(F.xxhash64("m").alias("h")), BROADCAST_BYTES // 40
    if keys.limit(most + 1).count() <= most:  # few enough to leave the other lines where they are
        found = found.withColumn("h", F.xxhash64("m")).join(F.broadcast(keys), "h", "left_semi")
    lost = found.join(marked, "m").filter(F.col("late") | (F.struct("i", "x", "at") != F.col("first")))
    return spool(lost.select("i", "x", "at").distinct().groupBy("i", "x").agg(F.array_sort(F.collect_list("at")).alias("gone")), "gone")


def without(lines: Column, gone: Column) -> Column:
    """The lines but those at the places `gone` (ascending), joined: what stands between two places is one
    slice, so the work is in proportion to the lines."""

    def joined(s: Column) -> Column:
        start = lambda n: F.coalesce(F.get(s["gone"], n - 1) + 1, F.lit(0))
        length = lambda n: F.coalesce(F.get(s["gone"], n), F.size(s["lines"])) - start(n)
        between = F.filter(F.sequence(F.lit(0), F.size(s["gone"])), lambda n: length(n) > 0)
        return F.array_join(F.transform(between, lambda n: F.array_join(F.slice(s["lines"], start(n) + 1, length(n)), "\n")), "\n")

    # An array of one, so that the split is a value and not computed for every slice.
    return F.transform(F.array(F.struct(lines.alias("lines"), gone.alias("gone"))), joined)[0]


def deduplicate_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 30, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """The rows of `docs` with repeated lines taken out of `text_col`, and two counts named by `counts`: the
    lines there were, and those removed.

    A line of at least `min_chars` characters goes if an earlier one, by (id, place), is the same or one
    edit away, itself kept or not. Shorter lines always stay. Lines are what line feeds part;
    the rest is joined by them again. A null text stays null with no lines; an empty text has one. Rows
    without an id are neither compared nor changed. Rows that repeat an id and a text count as one document: the
    same places go in each; different texts of one id follow each other in a fixed order. All other columns stay, but for any with a name of
    the counts; an empty table gives no rows.
    """
    column = F.col(f"`{text_col}`")
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.xxhash64(column.cast("string")).alias("x"), column.cast("string").alias("t"))
    own, text, places = (f"{n}_{uuid.uuid4().hex}" for n in ("id", "text", "gone"))
    gone = removals(plain, min_chars)
    size = gone.agg(F.sum(40 + 8 * F.size("gone"))).first()[0] or 0
    gone = F.broadcast(gone) if size <= BROADCAST_BYTES else gone
    gone = gone.select(F.col("i").alias(own), F.col("x").alias(text), F.col("gone").alias(places))
    joined = docs.join(gone, (F.col(f"`{id_col}`").cast("long") == F.col(own)) & (F.xxhash64(column.cast("string")) == F.col(text)), "left")
    lines = F.split(column.cast("string"), "\n")
    left = F.when(F.col(places).isNull(), column).otherwise(without(lines, F.col(places)))
    counted = {
        counts[0]: F.when(column.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"),
        counts[1]: F.when(F.col(places).isNull(), F.lit(0)).otherwise(F.size(places)).cast("long"),
    }
    kept = [left.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in counted]
    return joined.select(*kept, *(c.alias(n) for n, c in counted.items()))
