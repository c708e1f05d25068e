"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words, so each of its documents is wanted target/size times:
a whole number of copies and a fraction. The fractions are rounded by pairs. In a pair,
words move from one document to the other, up or down with the odds that keep both
expectations, until one of the two fractions is 0 or 1; the other goes on to the next
pair. The words of a pair never change, so a source's total is off by no more than the
rounding of the one document that is left at the very end.

The pairing is a reduction tree. Leaves are buckets of document ids by hash, of about
``LEAF`` rows whatever the source; a leaf leaves at most one open document per source.
Open documents meet in groups of ``FAN`` buckets, level by level. A hot source is spread
over all leaves, and nothing but open documents ever moves up. Inside a node, long
documents are settled first: what is open in the end is then one of the short ones.

Which way words move follows from a hash of the two ids, so another layout, a lost
executor or a second run gives the same mix.

Defined cases: a null or blank text has size 0 and gets its source's whole copies, which
weigh nothing; the null source is a source, the last in order; rows that repeat an id, or have
none, are rounded one by one and spread over the leaves by their texts; an empty table gives an
empty mix; other columns are ignored, whatever their names. The table of sources (one row each) is what is ordered in a single task.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.scratch import fresh_path

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
LEAF = 4096
FAN = 64
SEED = 17
CLOSE = 1e-12

WORDS = r"[^\x20\x09-\x0D]+"
OPEN = "row long, doc_id string, turn long, src string, size long, copies long, fraction double, bucket long"
NODE = f"{OPEN}, open boolean"


def word_count(text: Column) -> Column:
    """Number of words of a text: the pieces between runs of white space that are not empty."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds ``target`` to rows (src, source_size).

    Targets are proportional to weight except where that exceeds ``most`` times the size.
    With the sources in order of size per weight, the stopped ones come first, and the
    level of the rest follows from running sums.
    """
    ordered = Window.orderBy(F.col("src").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    rows = sources.withColumn("weight", weight).withColumn("stop", F.col("source_size") * most)
    steep = Window.orderBy(F.col("stop") / F.col("weight"), F.col("src").asc_nulls_last())
    before = steep.rowsBetween(Window.unboundedPreceding, -1)
    after = steep.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * share
    level = (total - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    # The level rises with every source that has to stop, and falls with any that need not.
    free = F.max("level").over(Window.partitionBy())
    rows = rows.withColumn("level", level).withColumn("free", free)
    target = F.least(F.col("stop"), F.col("free") * F.col("weight"))
    return rows.select("src", "source_size", target.alias("target"))


def _chance(a: int, b: int) -> float:
    """A number in [0, 1) from two ids."""
    return int.from_bytes(hashlib.blake2b(f"{SEED}:{a}:{b}".encode(), digest_size=7).digest(), "big") / 2**56


def round_pairs(ids: list[int], sizes: list[int], fractions: list[float]) -> tuple[list[float], int | None]:
    """Fractions after pairing, and the place of the one still open; longest first.

    The longer half is paired in turn. What stays open of it is paired with the shorter
    half as one partner, whose documents give or take in proportion; then the shorter half
    is treated alike. So what is open in the end is among the shortest.
    """
    out = [0.0 if not w else p for p, w in zip(fractions, sizes)]
    is_open = lambda j: CLOSE < out[j] < 1 - CLOSE
    rest, held = [j for j in range(len(out)) if is_open(j)], None

    def moved(j: int, room: tuple[float, float], seal: int) -> float:
        """Words that move to document j (from it, if negative); room is what a partner can give and take."""
        up = min((1 - out[j]) * sizes[j], room[0])
        down = min(out[j] * sizes[j], room[1])
        return up if _chance(ids[j], seal) * (up + down) < down else -down

    while rest:
        half = -(-len(rest) // 2)
        longer, rest = rest[:half], rest[half:]
        for i in longer:
            if held is None:
                held = i
                continue
            move = moved(held, (out[i] * sizes[i], (1 - out[i]) * sizes[i]), ids[i])
            out[held], out[i] = out[held] + move / sizes[held], out[i] - move / sizes[i]
            held = held if is_open(held) else i if is_open(i) else None
        if held is not None and rest:
            give = sum(out[j] * sizes[j] for j in rest)
            take = sum((1 - out[j]) * sizes[j] for j in rest)
            move = moved(held, (give, take), ids[rest[0]] + 1)
            out[held] += move / sizes[held]
            for j in rest:
                out[j] += (1 - out[j]) * -move / take if move < 0 else -out[j] * move / give
            rest = [j for j in rest if is_open(j)]
            held = held if is_open(held) else None
    return [p if j == held else float(round(p)) for j, p in enumerate(out)], held


def _node(rows: pd.DataFrame) -> pd.DataFrame:
    """One node of the tree: per source, everything but one document gets settled."""
    # Rows alike in id, text and source are interchangeable, so their order does not matter.
    rows["number"] = pd.array([None if i is None else int(i) for i in rows["doc_id"]], dtype="Int64")
    rows = rows.sort_values(["size", "number", "turn"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    rows["open"] = False
    named = rows["src"].isna()
    for _, part in rows.groupby([named, rows["src"].fillna("")], sort=False):
        ids = [int(i) if i is not None else int(t) for i, t in zip(part["doc_id"], part["turn"])]
        after, held = round_pairs(ids, part["size"].tolist(), part["fraction"].tolist())
        rows.loc[part.index, "fraction"] = after
        if held is not None:
            rows.loc[part.index[held], "open"] = True
    return rows.drop(columns="number")


def _kept(frame: DataFrame, name: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _copies(rows: DataFrame, leaf: int, fan: int) -> DataFrame:
    """Adds source_size, target and copies to rows (row, doc_id, turn, src, size)."""
    sources = _kept(targets(rows.groupBy("src").agg(F.sum("size").alias("source_size"))), "targets")
    buckets = max(1, -(-rows.count() // leaf))
    named = sources.withColumnRenamed("src", "name")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    wanted = rows.join(named, rows["src"].eqNullSafe(named["name"])).select(
        "row", F.col("doc_id").cast("string").alias("doc_id"), "turn", "src", "size", F.floor(rate + CLOSE).alias("copies"),
        F.greatest(rate - F.floor(rate + CLOSE), F.lit(0.0)).alias("fraction"), F.pmod(F.xxhash64("doc_id", "turn"), F.lit(buckets)).alias("bucket"),
    )
    nodes = _kept(wanted.groupBy("bucket").applyInPandas(_node, NODE), "mix")
    settled = nodes.filter("NOT open")
    while buckets > 1:
        buckets = -(-buckets // fan)
        up = nodes.filter("open").drop("open").withColumn("bucket", F.floor(F.col("bucket") / fan))
        nodes = _kept(up.groupBy("bucket").applyInPandas(_node, NODE), "mix")
        settled = settled.unionByName(nodes.filter("NOT open"))
    last = nodes.filter("open").withColumn("fraction", F.when(F.col("fraction") >= 0.5, 1.0).otherwise(0.0))
    done = settled.unionByName(last).withColumn("doc_id", F.col("doc_id").cast("long"))
    return done.join(named, done["src"].eqNullSafe(named["name"])).select(
        "row", "doc_id", "src", "size", "source_size", "target", (F.col("copies") + F.round("fraction").cast("long")).alias("copies")
    )


def _sized(docs: DataFrame, row: Column, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        row.alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("turn"), F.col(source_col).alias("src"), word_count(text).alias("size")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """Per document: doc_id, src, size, source_size, target, copies, taken (copies times size)."""
    rows = _kept(_sized(docs, F.lit(0).cast("long"), id_col, text_col, source_col), "sizes")
    return _copies(rows, leaf, fan).drop("row").withColumn("taken", F.col("copies") * F.col("size"))


def repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """The mix as documents: each row as often as it is taken, with its own columns, whatever their names.

    Rows alike in id, text and source are interchangeable: each is repeated as often as all
    of them can be, and what is left of their copies comes from one of them.
    """
    id_, text, source = (F.col(f"`{c}`") for c in (id_col, text_col, source_col))
    key = F.xxhash64(id_, id_.isNull(), text, source, source.isNull())
    copies = _copies(_kept(_sized(docs, key, f"`{id_col}`", f"`{text_col}`", f"`{source_col}`"), "sizes"), leaf, fan)
    alike = copies.groupBy("row").agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias("rows")).filter("all > 0")
    alike = _kept(alike.select("row", F.expr("all div rows AS each"), F.expr("all % rows AS rest")), "copies")
    held = docs.select(F.struct("*").alias("doc"), key.alias("row"))
    times = lambda name: F.explode(F.sequence(F.lit(1).cast("long"), F.col(name)))
    # There are about as many counts as documents, so they are merged at any size and never broadcast.
    every = held.join(alike.filter("each > 0").select("row", "each").hint("merge"), "row").select("doc", times("each").alias("copy"))
    left = alike.filter("rest > 0").select("row", "rest")
    if left.isEmpty():
        return every.select("doc.*")
    # Only rows that are alike leave a rest, so these are few texts.
    one = held.join(left, "row").groupBy("row", "rest").agg(F.first("doc").alias("doc"))
    return every.unionAll(one.select("doc", times("rest").alias("copy"))).select("doc.*")
