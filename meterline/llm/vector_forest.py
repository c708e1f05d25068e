"""Near copies among vectors of one label, by a forest of random-projection trees.

A tree cuts space again and again at the median of a random projection. Vectors within a
margin of the cut go to both sides (spill), so close pairs are rarely parted; the margin is
a share of the spread that a pair at the threshold has on a random direction. Many trees
make up for pairs that one tree parts. A node is a leaf once none of its labels has more than
``leaf`` vectors, as far as a sample tells; a node that no direction divides, for a crowd of
vectors lies closer together than the margin, is a dense leaf. Trees are fitted on a sample of
about ``sample`` vectors a node, drawn by a hash; leaves that are still too large are fitted
again on samples of their own, round by round. Every vector is put into every tree.

Vectors are compared in double precision within leaves, exactly and all with all of the same
label. A dense leaf of many vectors is compared part by part, each pair of parts a group of its
own, so no group grows with the table. No pairs are written: a link counts in the least of
the leaves that both vectors share, so a group adds up the links of each of its vectors and
returns one row a vector, with a vector of its component inside the group. Those rows, united,
are the components.

Equal vectors of a label are one vector with a weight, so copies cost nothing.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, and
vectors without a label, link with nothing; so do vectors of different dimension; rows that
repeat an id are vectors of their own; a null id names a component only if there is no other; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.links import roots
from meterline.scratch import fresh_path

COSINE = 0.93
TREES = 8
LEAF = 512
SPILL = 0.5  # of the standard deviation that a pair at the threshold has on a direction
SAMPLE = 8192
FEWEST = 16  # sampled vectors of a node that is still cut
TRIES = 12  # directions tried before a node counts as dense
SHRINK = 0.8  # a cut is of use if no side keeps more of the node than this
BITS = 10  # of a leaf's number within the tree fitted in one round
ROUNDS = 5
SHARE = 1 << 16  # vectors of a leaf that are sorted into its subtree together

MODEL = "tree int, leaf long, cuts binary, kids binary, dense binary"
PLACES = "node long, label string, tree int, leaf long, dense boolean"
FOUND = "node long, links long, peer long"


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so squares neither vanish nor overflow."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _direction(tree: int, leaf: int, number: int, dim: int) -> np.ndarray:
    drawn = np.random.default_rng([tree, leaf, number]).normal(size=dim)
    return drawn / np.linalg.norm(drawn)


class Subtree:
    """Cuts of one round below a node: direction number, threshold and children of every inner node.

    A child below zero is a leaf: ~child is its number.
    """

    def __init__(self, tree: int, leaf: int, cuts: np.ndarray, kids: np.ndarray, dense: np.ndarray, margin: float):
        self.tree, self.leaf, self.cuts, self.kids, self.dense, self.margin = tree, leaf, cuts, kids, dense, margin

    @classmethod
    def fit(cls, tree: int, leaf: int, x: np.ndarray, labels: np.ndarray, scale: float, most: float, margin: float) -> Subtree:
        """Cut until a leaf holds at most ``most`` of each label; a sampled vector stands for ``scale``."""
        cuts: list[tuple[int, float]] = []
        kids: list[list[int]] = []
        dense: list[bool] = []

        def end(is_dense: bool) -> int:
            dense.append(is_dense)
            return ~(len(dense) - 1)

        def cut(held: np.ndarray, room: int) -> int:
            """The node over these vectors, of at most ``room`` leaves."""
            if np.bincount(labels[held]).max(initial=0) * scale <= most or len(held) < FEWEST or room < 2:
                return end(False)
            for attempt in range(TRIES):
                number = len(cuts) * TRIES + attempt
                on = x[held] @ _direction(tree, leaf, number, x.shape[1])
                at = float(np.median(on))
                left, right = held[on <= at + margin], held[on >= at - margin]
                if max(len(left), len(right)) <= SHRINK * len(held):
                    break
            else:
                return end(True)
            here = len(cuts)
            cuts.append((number, at))
            kids.append([0, 0])
            kids[here] = [cut(left, room // 2), cut(right, room // 2)]
            return here

        if cut(np.arange(len(x)), 1 << BITS) < 0:
            dense[:] = [True]  # not cut at all: there is nothing that another round could do
        pairs = np.array(cuts, dtype=[("number", "<i8"), ("at", "<f8")])
        return cls(tree, leaf, pairs, np.array(kids, dtype="<i4").reshape(-1, 2), np.array(dense, dtype=bool), margin)

    def put(self, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(number of a leaf, which rows it gets), spill included."""
        if not len(self.cuts):
            return [(0, np.arange(len(x)))]
        out, todo = [], [(0, np.arange(len(x)))]
        while todo:
            here, held = todo.pop()
            if not len(held):
                continue
            if here < 0:
                out.append((~here, held))
                continue
            number, at = self.cuts[here]
            on = x[held] @ _direction(self.tree, self.leaf, int(number), x.shape[1])
            todo += [(int(self.kids[here, 0]), held[on <= at + self.margin]), (int(self.kids[here, 1]), held[on >= at - self.margin])]
        return out

    def row(self) -> tuple:
        return self.tree, self.leaf, self.cuts.tobytes(), self.kids.tobytes(), np.packbits(self.dense).tobytes() + len(self.dense).to_bytes(4, "little")

    @classmethod
    def of(cls, row: object, margin: float) -> Subtree:
        cuts = np.frombuffer(row.cuts, dtype=[("number", "<i8"), ("at", "<f8")])
        flags = np.frombuffer(row.dense[:-4], dtype=np.uint8)
        dense = np.unpackbits(flags, count=int.from_bytes(row.dense[-4:], "little")) == 1
        return cls(int(row.tree), int(row.leaf), cuts, np.frombuffer(row.kids, dtype="<i4").reshape(-1, 2), dense, margin)


def _margin(cosine: float, spill: float, dim: int) -> float:
    return spill * float(np.sqrt(2 * (1 - cosine) / dim))


def _placed(rows: pd.DataFrame, subtree: Subtree) -> Iterator[pd.DataFrame]:
    x = _unit(rows["vec"])
    for number, held in subtree.put(x):
        part = rows.iloc[held]
        yield pd.DataFrame(
            {"node": part["node"], "label": part["label"], "tree": subtree.tree, "leaf": subtree.leaf << BITS | number, "dense": bool(subtree.dense[number])}
        )


def _none(ddl: str) -> pd.DataFrame:
    return pd.DataFrame(columns=[c.split()[0] for c in ddl.split(", ")])


def plant(classes: DataFrame, cosine: float, trees: int, leaf: int, spill: float, sample: int) -> DataFrame:
    """(node, label, tree, leaf): the leaves of every vector of classes (node, label, vec)."""
    spark = classes.sparkSession

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = _unit(rows["vec"])
        scale = float(rows["total"].iloc[0]) / len(rows)
        labels = pd.factorize(rows["label"])[0]
        tree, at = int(rows["tree"].iloc[0]), int(rows["leaf"].iloc[0])
        grown = Subtree.fit(tree, at, x, labels, scale, leaf, _margin(cosine, spill, x.shape[1]))
        return pd.DataFrame([grown.row()], columns=[c.split()[0] for c in MODEL.split(", ")])

    def fitted(rows: DataFrame, totals: DataFrame) -> DataFrame:
        """A model of each node, from about ``sample`` of its rows."""
        drawn = F.pmod(F.xxhash64("node", "tree"), F.lit(1 << 30)) * F.col("total") < F.lit(float(sample << 30))
        path = fresh_path(spark, "subtrees")
        rows.join(totals, ["tree", "leaf"]).filter(drawn).groupBy("tree", "leaf").applyInPandas(fit, MODEL).write.parquet(path)
        return spark.read.parquet(path)

    # The first round: a root for every tree and dimension, whose models are few.
    sown = classes.withColumn("leaf", F.size("vec").cast("long")).withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(trees)])))
    totals = classes.groupBy(F.size("vec").cast("long").alias("leaf")).agg(F.count(F.lit(1)).alias("total"))
    grown = fitted(sown, totals.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(trees)]))))
    models = {(r.tree, r.leaf): tuple(map(bytes, (r.cuts, r.kids, r.dense))) for r in grown.collect()}
    sent = spark.sparkContext.broadcast(models)

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[Subtree]] = {}
        for frame in frames:
            for dim, rows in frame.groupby(frame["vec"].map(len)):
                if dim not in held:
                    found = [pd.Series({"tree": t, "leaf": d, "cuts": m[0], "kids": m[1], "dense": m[2]}) for (t, d), m in sent.value.items() if d == dim]
                    held[dim] = [Subtree.of(m, _margin(cosine, spill, dim)) for m in found]
                for subtree in held[dim]:
                    yield from _placed(rows, subtree)

    path = fresh_path(spark, "leaves")
    classes.select("node", "label", "vec").mapInPandas(put, PLACES).write.parquet(path)
    done, now = [], spark.read.parquet(path)
    for r in range(ROUNDS):
        sizes = now.groupBy("tree", "leaf", "label").agg(F.count(F.lit(1)).alias("n"), F.bool_or("dense").alias("dense"))
        nodes = sizes.groupBy("tree", "leaf").agg(F.max("n").alias("most"), F.sum("n").alias("total"), F.bool_or("dense").alias("fixed"))
        open_path = fresh_path(spark, "open")
        nodes.filter((F.col("most") > 2 * leaf) & ~F.col("fixed")).select("tree", "leaf", "total").write.parquet(open_path)
        wide = spark.read.parquet(open_path)
        if r == ROUNDS - 1 or wide.isEmpty():
            break
        done.append(now.join(wide, ["tree", "leaf"], "left_anti"))
        again = now.join(wide, ["tree", "leaf"]).join(classes.select("node", "vec"), "node")
        models = fitted(again.drop("total"), wide)
        parts = F.ceil(F.col("total") / SHARE)
        salted = again.withColumn("salt", F.pmod(F.xxhash64("node"), parts)).groupBy("tree", "leaf", "salt")
        # Read anew: the two sides of a cogroup may not share columns.
        spread = models.join(spark.read.parquet(open_path), ["tree", "leaf"]).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))

        def deeper(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
            if not len(rows) or not len(model):
                return _none(PLACES)
            dim = len(rows["vec"].iloc[0])
            return pd.concat(_placed(rows, Subtree.of(next(model.itertuples()), _margin(cosine, spill, dim))))

        path = fresh_path(spark, "leaves")
        salted.cogroup(spread.groupBy("tree", "leaf", "salt")).applyInPandas(deeper, PLACES).write.parquet(path)
        now = spark.read.parquet(path)
    for other in done:
        now = now.unionAll(other.select(now.columns))
    return now.select("node", "label", "tree", "leaf")


def _components(linked: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The least node that each row of a and of b reaches within the group."""
    none = np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(a, np.where(linked, b[None, :], none).min(axis=1, initial=none))
        new_b = new_a if same else np.minimum(b, np.where(linked, new_a[:, None], none).min(axis=0, initial=none))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b


def compare(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of the vectors of one group: all with all, or part ``i`` with part ``j`` of a dense leaf."""
    first = rows.iloc[0]
    same = first["i"] == first["j"]
    x, node, weight = _unit(rows["vec"]), rows["node"].to_numpy(dtype=np.int64), rows["weight"].to_numpy(dtype=np.int64)
    part = rows["part"].to_numpy()
    a = np.arange(len(x)) if same else np.flatnonzero(part == first["i"])
    b = a if same else np.flatnonzero(part == first["j"])
    linked = x[a] @ x[b].T >= cosine
    if same:
        np.fill_diagonal(linked, False)
    some_a, some_b = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(some_a):
        return _none(FOUND)
    linked, a, b = linked[np.ix_(some_a, some_b)], a[some_a], b[some_b]
    use = np.union1d(a, b)
    # Leaves before this one that two or more of the vectors share.
    where = np.repeat(use, [len(rows["codes"].iloc[k]) for k in use])
    codes = np.concatenate([rows["codes"].iloc[k] for k in use])
    before = codes < first["code"]
    kinds, which, times = np.unique(codes[before], return_inverse=True, return_counts=True)
    member = np.zeros((len(x), len(kinds)), dtype=np.float32)
    member[where[before], which] = 1
    member = member[:, times > 1]
    own = linked & (member[a] @ member[b].T == 0)
    links = np.zeros(len(x), dtype=np.int64)
    np.add.at(links, a, own @ weight[b])
    if not same:
        np.add.at(links, b, own.T @ weight[a])
    peer = node.copy()
    reach_a, reach_b = _components(linked, node[a], node[b], same)
    peer[a], peer[b] = reach_a, reach_b
    return pd.DataFrame({"node": node[use], "links": links[use], "peer": peer[use]})


def found_links(classes: DataFrame, places: DataFrame, cosine: float, leaf: int) -> DataFrame:
    """FOUND rows of every group, for classes (node, label, weight, vec) and their leaves."""
    spark = classes.sparkSession
    coded = places.select("node", "label", F.xxhash64("tree", "leaf").alias("code"))
    parts = coded.groupBy("label", "code").agg(F.ceil(F.count(F.lit(1)) / (2 * leaf)).alias("parts"))
    crowded = coded.join(parts, ["label", "code"]).select("node", "code", "parts", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    signed = crowded.groupBy("node").agg(F.collect_list(F.struct("code", "parts", "part")).alias("leaves"))
    full = classes.select("node", "label", "weight", "vec").join(signed, "node")
    rows = full.withColumn("codes", F.col("leaves.code")).select("node", "label", "weight", "vec", "codes", F.inline("leaves"))
    low, high = F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    units = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select("*", low, high)
    path = fresh_path(spark, "links")
    units.groupBy("label", "code", "i", "j").applyInPandas(lambda rows: compare(rows, cosine), FOUND).write.parquet(path)
    return spark.read.parquet(path)


def near_copies(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
    trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE,
) -> DataFrame:
    """Per vector: vec_id, n_links (other vectors linked with it), component_id (least id reachable), kept."""
    spark = vectors.sparkSession
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    vec = F.col("vec") if kind == "float" else F.col("vec").cast("array<double>")
    # Written once, so a row has one key however often the table is read.
    path = fresh_path(spark, "vectors")
    vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vec"), F.monotonically_increasing_id().alias("row")
    ).withColumn("vec", vec).write.parquet(path)
    rows = spark.read.parquet(path)
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    keyed = rows.filter(F.coalesce(usable, F.lit(False))).withColumns({"one": F.xxhash64(F.lit(1), "vec"), "two": F.xxhash64(F.lit(2), "vec")})
    same = ["label", "one", "two"]
    where = fresh_path(spark, "classes")
    keyed.groupBy(*same).agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"), F.first("vec").alias("vec")
    ).write.parquet(where)
    classes = spark.read.parquet(where)
    found = found_links(classes, plant(classes, cosine, trees, leaf, spill, sample), cosine, leaf)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = classes.select("node", "weight", "least", *same).join(roots(found, "node", "peer"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    told = rooted.join(names, "root").join(counts, "node", "left").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    linked = keyed.select("vec_id", *same).join(told, same).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(usable, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
