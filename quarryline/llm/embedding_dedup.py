"""Embedding near-dedup by a random-projection tree forest.

Equal vectors become one node first. Dense groups, found on a bounded sample, become balls: a vector inside a ball
is compared with every vector that its angle to the centre leaves within reach, in tile pairs of one task each, so
no link of it is missed. Trees for the other vectors are fitted on the rest of the sample: every inner node cuts
along a random direction at the median of its sample, and points within ``spill`` quantiles of the cut go to both
sides. A vector is sent down every tree; a leaf is a task's group, where all its vectors are compared. A pair that
meets in several leaves counts in the first of them only, so links are counted without listing pairs: a leaf
returns how many links each vector gained, and the few links that connect its vectors.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import connected_components, pinned, prepare
from quarryline.llm.vectors import usable

THRESHOLD = 0.9
TREES = 10
SPILL = 0.06
LEAF_SAMPLE = 48
MIN_SAMPLE = 20_000
MAX_SAMPLE = 1_000_000
ROWS_PER_SAMPLE = 64
SEED = 20_240_501
# Sampled vectors within the threshold of a centre that make a dense group; trees seldom cut through fewer.
DENSE_SAMPLE = 128
# Rows of a tile of a dense group, and of a comparison block inside a leaf or a pair of tiles.
TILE = 8192
BLOCK = 2048
# Radians added to what the triangle inequality asks for, as angles of 32-bit vectors are not exact.
SLACK = 0.002


class Tree:
    """Inner nodes as arrays; a negative child is a leaf."""

    def __init__(self):
        self.planes: list[np.ndarray] = []
        self.low: list[float] = []
        self.high: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0

    def freeze(self) -> Tree:
        self.planes = np.array(self.planes, dtype=np.float32) if self.planes else np.zeros((0, 0), np.float32)
        return self


def fit_tree(sample: np.ndarray, seed: int, leaf_sample: int = LEAF_SAMPLE, spill: float = SPILL) -> Tree:
    """Cut a sample by random directions until ``leaf_sample`` points or fewer are in a leaf."""
    rng = np.random.default_rng(seed)
    tree = Tree()

    def leaf() -> int:
        tree.leaves += 1
        return -tree.leaves

    todo = [(np.arange(len(sample)), None, 0)]
    root = None
    while todo:
        members, parent, side = todo.pop()
        child = None
        if len(members) > leaf_sample:
            plane = rng.standard_normal(sample.shape[1]).astype(np.float32)
            projected = sample[members] @ plane
            cut, low, high = np.quantile(projected, [0.5, 0.5 - spill, 0.5 + spill])
            left, right = members[projected <= cut], members[projected > cut]
            if len(left) and len(right):
                child = len(tree.planes)
                tree.planes.append(plane)
                tree.low.append(float(low))
                tree.high.append(float(high))
                tree.children.append([0, 0])
                todo += [(left, child, 0), (right, child, 1)]
        if child is None:
            child = leaf()
        if parent is None:
            root = child
        else:
            tree.children[parent][side] = child
    tree.root = root
    return tree.freeze()


def leaves_of(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the vectors and the leaves they reach; a vector near a cut reaches several."""
    rows, leaves, todo = [], [], [(tree.root, np.arange(len(vectors)))]
    while todo:
        node, members = todo.pop()
        if not len(members):
            continue
        if node < 0:
            rows.append(members)
            leaves.append(np.full(len(members), -node - 1, dtype=np.int32))
            continue
        projected = vectors[members] @ tree.planes[node]
        left, right = tree.children[node]
        todo.append((left, members[projected <= tree.high[node]]))
        todo.append((right, members[projected >= tree.low[node]]))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(leaves)


def _angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ centres.T, -1.0, 1.0))


def find_balls(
    sample: np.ndarray, threshold: float, dense_sample: int = DENSE_SAMPLE, leaf_sample: int = LEAF_SAMPLE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres and radii of dense groups, and the sampled vectors in none of them.

    A leaf of a tree lies mostly inside a group that is much larger than the leaf, so leaves whose vectors are mostly
    within the threshold of their mean propose centres. This goes on until the rest proposes none.
    """
    reach = math.acos(threshold)
    rng = np.random.default_rng(SEED)
    centres, radii = [], []
    while len(sample) >= dense_sample:
        rows, leaves = leaves_of(fit_tree(sample, int(rng.integers(1 << 31)), leaf_sample, 0.0), sample)
        order = np.argsort(leaves, kind="stable")
        covered = np.zeros(len(sample), dtype=bool)
        for members in np.split(rows[order], np.flatnonzero(np.diff(leaves[order])) + 1):
            members = members[~covered[members]]
            centre = _centre(sample[members])
            if centre is None or np.mean(_angles(sample[members], centre[None])[:, 0] <= reach) <= 0.5:
                continue
            for _ in range(2):
                near = sample[~covered & (_angles(sample, centre[None])[:, 0] <= reach)]
                moved = _centre(near) if len(near) >= dense_sample else None
                if moved is None:
                    break
                centre = moved
            angles = _angles(sample, centre[None])[:, 0]
            own = angles[~covered & (angles <= reach)]
            if len(own) < dense_sample:
                continue
            # Tight groups need small balls only, so that little else is within their reach.
            radius = min(reach, 1.1 * float(np.quantile(own, 0.99)) + SLACK)
            centres.append(centre)
            radii.append(radius)
            covered |= angles <= radius
        if not covered.any():
            break
        sample = sample[~covered]
    return np.array(centres, dtype=np.float32).reshape(-1, sample.shape[1]), np.array(radii), sample


def _centre(vectors: np.ndarray) -> np.ndarray | None:
    total = vectors.sum(axis=0, dtype=np.float64)
    length = math.sqrt(float(total @ total))
    return (total / length).astype(np.float32) if length > 0 else None


def home_of(angles: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Nearest ball that each vector is inside of; the number of balls where there is none."""
    inside = np.where(angles <= radii, angles, np.inf)
    return np.where(np.isfinite(inside.min(axis=1)), inside.argmin(axis=1), len(radii))


def _canonical(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for vectors in batches:
        names, packed, sizes = [], [], []
        for values in vectors:
            vector = usable(values)
            if vector is None or not vector.any():
                names.append(None)
                packed.append(None)
                sizes.append(0)
                continue
            raw = (vector + 0.0).tobytes()  # no negative zeros
            names.append(hashlib.blake2b(raw, digest_size=16).hexdigest())
            packed.append(raw)
            sizes.append(len(vector))
        yield pd.DataFrame({"node": names, "vector": packed, "dims": sizes})


def _unit(packed: bytes, dims: int | None = None) -> np.ndarray:
    vector = np.frombuffer(packed, dtype=np.float64)
    vector = vector / np.abs(vector).max()
    vector = vector / math.sqrt(float(vector @ vector))
    if dims is None or dims == len(vector):
        return vector
    padded = np.zeros(dims)
    padded[: min(dims, len(vector))] = vector[:dims]
    return padded


def _gather(balls_file, dims: int, threshold: float):
    """Rows (ball, core, node, copies, vector) for every ball that a vector is inside of or within reach of.

    Two vectors inside different balls meet in the first of these only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, radii = balls_file.value
        for whole in batches:
            for low in range(0, len(whole), BLOCK):
                batch = whole.iloc[low : low + BLOCK].reset_index(drop=True)
                vectors = np.stack([_unit(v, dims) for v in batch["vector"]]).astype(np.float32)
                angles = _angles(vectors, centres)
                home = home_of(angles, radii)
                numbers = np.arange(len(radii))
                within = angles <= radii + math.acos(threshold) + SLACK
                at, ball = np.nonzero((within & (numbers < home[:, None])) | (numbers == home[:, None]))
                out = batch.iloc[at].reset_index(drop=True)
                out["ball"] = ball.astype(np.int32)
                out["core"] = ball == home[at]
                yield out[["ball", "core", "node", "copies", "vector"]]

    return run


def in_tile_pairs(rows: DataFrame, tile_rows: int = TILE) -> DataFrame:
    """Rows of balls, once for every pair of tiles they belong to; the first tile of a pair is of vectors inside."""
    sizes = rows.groupBy("ball").agg(
        F.ceil(F.count_if("core") / F.lit(tile_rows)).cast("int").alias("inner"),
        F.ceil(F.count_if(~F.col("core")) / F.lit(tile_rows)).cast("int").alias("outer"),
    ).where("inner > 0")
    salt = F.xxhash64("node")
    tile = F.when(F.col("core"), F.pmod(salt, F.col("inner"))).otherwise(F.col("inner") + F.pmod(salt, F.col("outer")))
    last = F.when(F.col("core"), F.col("inner") + F.col("outer")).otherwise(F.col("inner")) - 1
    rows = rows.join(sizes, "ball").withColumn("tile", tile.cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select(
        "ball", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "tile", "node", "copies", "vector"
    )


def _descend(forest_file, dims: int):
    """Rows (leaf, node, copies, vector, signature) for every leaf a vector reaches; vectors inside balls reach none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, (centres, radii) = pickle.loads(forest_file.value)
        for whole in batches:
            for low in range(0, len(whole), BLOCK):
                batch = whole.iloc[low : low + BLOCK].reset_index(drop=True)
                vectors = np.stack([_unit(v, dims) for v in batch["vector"]]).astype(np.float32)
                if len(radii):
                    outside = home_of(_angles(vectors, centres), radii) == len(radii)
                    batch, vectors = batch[outside].reset_index(drop=True), vectors[outside]
                    if not len(batch):
                        continue
                reached: list[list[int]] = [[] for _ in range(len(batch))]
                rows, leaves, start = [], [], 0
                for tree in forest:
                    at, leaf = leaves_of(tree, vectors)
                    leaf = leaf + start
                    for i, x in zip(at.tolist(), leaf.tolist()):
                        reached[i].append(x)
                    rows.append(at)
                    leaves.append(leaf)
                    start += tree.leaves
                at = np.concatenate(rows)
                signature = [np.array(sorted(x), dtype=np.int32).tobytes() for x in reached]
                out = batch.iloc[at].reset_index(drop=True)
                out["leaf"] = np.concatenate(leaves)
                out["signature"] = [signature[i] for i in at.tolist()]
                yield out[["leaf", "node", "copies", "vector", "signature"]]

    return run


def _first_meeting(one: bytes, other: bytes) -> int:
    return int(np.intersect1d(np.frombuffer(one, np.int32), np.frombuffer(other, np.int32), assume_unique=True)[0])


class _Links:
    """Links among the rows of a task: how many each row gained, and the few that connect them."""

    def __init__(self, rows: pd.DataFrame, threshold: float):
        self.nodes, self.copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        self.lengths = np.array([len(v) for v in rows["vector"]])
        self.units = np.zeros((len(rows), int(self.lengths.max()) // 8))
        for i, packed in enumerate(rows["vector"]):
            self.units[i, : self.lengths[i] // 8] = _unit(packed)
        self.threshold = threshold
        self.gained = np.zeros(len(rows), dtype=np.int64)
        self.joined = np.arange(len(rows))
        self.links: list[tuple[int, int]] = []

    def near(self, a: slice, b: slice) -> np.ndarray:
        near = self.units[a] @ self.units[b].T >= self.threshold
        near &= self.lengths[a, None] == self.lengths[None, b]
        if a == b:
            near &= ~np.tri(len(near), dtype=bool)
        return near

    def add(self, a: slice, b: slice, near: np.ndarray) -> None:
        self.gained[a] += near @ self.copies[b]
        self.gained[b] += near.T @ self.copies[a]
        joined = self.joined
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            others = np.flatnonzero(near[i]) + b.start
            i += a.start
            others = others[joined[others] != joined[i]]
            while len(others):
                j = int(others[0])
                self.links.append((i, j))
                joined[joined == joined[j]] = joined[i]
                others = others[joined[others] != joined[i]]

    def found(self) -> pd.DataFrame:
        some = np.flatnonzero(self.gained)
        nodes, links = self.nodes, self.links
        counted = pd.DataFrame({"node": nodes[some], "other": None, "gained": self.gained[some]})
        linked = pd.DataFrame({"node": [nodes[i] for i, _ in links], "other": [nodes[j] for _, j in links], "gained": 0})
        return pd.concat([counted, linked], ignore_index=True).astype({"gained": "int64"})


def _blocks(start: int, end: int) -> list[slice]:
    return [slice(low, min(low + BLOCK, end)) for low in range(start, end, BLOCK)]


def _compare_tiles(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, tile_a, tile_b = key
        rows = rows.sort_values(["tile", "node"], ignore_index=True)
        links = _Links(rows, threshold)
        first = int((rows["tile"] == tile_a).sum())
        for i, a in enumerate(_blocks(0, first)):
            for b in _blocks(0, first)[i:] if tile_a == tile_b else _blocks(first, len(rows)):
                near = links.near(a, b)
                if near.any():
                    links.add(a, b, near)
        return links.found()

    return run


def _compare(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        leaf = key[0]
        rows = rows.sort_values("node", ignore_index=True)
        size = len(rows)
        links = _Links(rows, threshold)
        # Membership in the leaves that come before this one, as sparse sets with a common numbering.
        earlier = [np.frombuffer(s, np.int32) for s in rows["signature"]]
        earlier = [s[s < leaf] for s in earlier]
        numbers, flat = np.unique(np.concatenate(earlier), return_inverse=True) if size else (np.zeros(0), np.zeros(0))
        member = np.zeros((size, len(numbers)), dtype=np.float32)
        member[np.repeat(np.arange(size), [len(s) for s in earlier]), flat] = 1
        for i, a in enumerate(_blocks(0, size)):
            for b in _blocks(0, size)[i:]:
                near = links.near(a, b)
                if not near.any():
                    continue
                near &= member[a] @ member[b].T == 0
                links.add(a, b, near)
        return links.found()

    return run


def near_duplicates(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    trees: int = TREES,
    spill: float = SPILL,
    leaf_sample: int = LEAF_SAMPLE,
    min_sample: int = MIN_SAMPLE,
    max_sample: int = MAX_SAMPLE,
    dense_sample: int = DENSE_SAMPLE,
    tile_rows: int = TILE,
) -> DataFrame:
    """Links of cosine ``threshold`` or more, counted and joined to components.

    Returns one row per input row: ``key``, ``n_links`` (other rows linked directly), ``component_id`` (smallest key
    reachable), ``kept`` (the row is its component's smallest). Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing and are their own component; vectors of different length never link.
    Rows with equal vectors link with each other. A null key is never the smallest if the component has others.
    Rows that share a key stay separate rows. An empty table gives no rows. Other columns are not looked at.

    Balls and forest are fitted on a sample of one row in ``ROWS_PER_SAMPLE``, at least ``min_sample`` and at most
    ``max_sample`` rows; all rows are indexed. The only links missed are of pairs that no tree brings together and of
    which neither vector is inside a ball. Groups of ``dense_sample`` sampled vectors or more become balls; their
    tile pairs grow with the square of a group.
    """
    spark = rows.sparkSession
    prepare(spark)
    source = rows.select(F.col(key).alias("key"), F.col(vector).alias("embedding"))
    canonical = F.pandas_udf(_canonical, "node string, vector binary, dims int")
    listed = pinned(source.select("key", canonical("embedding").alias("v")).select("key", "v.*"), "vectors")
    # The vector follows from the node, so any row's copy of it will do.
    nodes = pinned(
        listed.where("node is not null").groupBy("node").agg(
            F.min("key").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"), F.first("dims").alias("dims")
        ),
        "nodes",
    )
    total, dims = nodes.agg(F.count("*"), F.max("dims")).first()
    if total:
        wanted = min(max(min_sample, total // ROWS_PER_SAMPLE), max_sample)
        share = min(1.0, wanted / total)
        sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        sample = sample.orderBy(F.xxhash64("node", F.lit(1))).limit(wanted) if share < 1 else sample.limit(wanted)
        picked = np.stack([_unit(bytes(r["vector"]), dims) for r in sample.select("vector").toLocalIterator()]).astype(np.float32)
        order = np.lexsort(picked.T[::-1])
        centres, radii, rest = find_balls(picked[order], threshold, dense_sample, leaf_sample)
        forest = [fit_tree(rest, SEED + i, leaf_sample, spill) for i in range(trees)]
        shared = spark.sparkContext.broadcast(pickle.dumps((forest, (centres, radii))))
        reached = nodes.select("node", "copies", "vector").mapInPandas(
            _descend(shared, dims), "leaf int, node string, copies long, vector binary, signature binary"
        )
        found = reached.groupBy("leaf").applyInPandas(_compare(threshold), "node string, other string, gained long")
        if len(radii):
            balls = spark.sparkContext.broadcast((centres, radii))
            gathered = nodes.select("node", "copies", "vector").mapInPandas(
                _gather(balls, dims, threshold), "ball int, core boolean, node string, copies long, vector binary"
            )
            pairs = in_tile_pairs(pinned(gathered, "balls"), tile_rows).groupBy("ball", "tile_a", "tile_b")
            found = found.unionByName(pairs.applyInPandas(_compare_tiles(threshold), "node string, other string, gained long"))
        found = pinned(found, "leaf-links")
        links = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
        gained = found.where("other is null").groupBy("node").agg(F.sum("gained").alias("gained"))
        roots = connected_components(links)
    else:
        gained = nodes.select("node", F.lit(0).cast("long").alias("gained"))
        roots = nodes.select("node", F.col("node").alias("root"))
    joined = nodes.select("node", "least", "copies").join(gained, "node", "left").join(roots, "node", "left")
    joined = joined.withColumn("root", F.coalesce("root", "node"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component"))
    labels = joined.join(smallest, "root").select(
        "node", (F.coalesce("gained", F.lit(0)) + F.col("copies") - 1).alias("links"), "component"
    )
    done = listed.select("key", "node").join(labels, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component"))
    return done.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )
