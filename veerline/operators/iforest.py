"""Isolation forest whose rows, samples and trees are Spark rows.

Fitting: every user draws the trees it is a candidate for by hashing its key, so that the
samples of all trees come out of one pass over the users; each tree is then grown in its own
group of about ``tree_sample`` rows, whatever the number of users. The model is a table of
nodes. Scoring: the nodes, at most ``trees * 2 * tree_sample`` rows, go to every task, and
users are scored where they are, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path double, sample int"
)


def _tree_samples(df: DataFrame, columns: Sequence[str], rows: int, settings: Settings) -> DataFrame:
    """Candidates of every tree: (tree, draw, x).

    The threshold admits a little more than the sample on average (by eight standard
    deviations), so that a tree can keep exactly the smallest draws.
    """
    wanted = settings.tree_sample
    share = min(1.0, (wanted + 8 * math.sqrt(wanted) + 16) / max(rows, 1))
    limit = F.lit(int(-(2**63) + share * (2**64 - 2**12)))

    def draw(tree: Column) -> Column:
        return F.xxhash64(F.col("user"), F.lit(settings.seed), tree)

    trees = F.sequence(F.lit(0), F.lit(settings.trees - 1))
    if share < 1.0:
        trees = F.filter(trees, lambda t: draw(t) <= limit)
    return df.select(
        "user",
        F.array(*[F.col(c).cast("double") for c in columns]).alias("x"),
        F.explode(trees).alias("tree"),
    ).select("tree", draw(F.col("tree")).alias("draw"), "user", "x")


def fit_iforest(
    df: DataFrame, columns: Sequence[str], settings: Settings = DEFAULT, rows: int | None = None
) -> DataFrame:
    """Node table of a forest on ``columns`` of a table with one row per ``user``."""
    if rows is None:
        rows = df.count()
    wanted = min(settings.tree_sample, rows)
    height = max(1, math.ceil(math.log2(max(wanted, 2))))
    seed = settings.seed

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        tree = int(key[0])
        chosen = pdf.sort_values(["draw", "user"]).head(wanted)
        points = np.stack(chosen["x"].to_numpy())
        rng = np.random.default_rng([seed, tree])

        def unsplit_depth(n: int) -> float:
            if n <= 1:
                return 0.0
            if n == 2:
                return 1.0
            return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n

        nodes = []
        waiting = [(np.arange(len(points)), 0, None)]
        while waiting:
            members, depth, slot = waiting.pop()
            here = len(nodes)
            if slot is not None:
                nodes[slot[0]][slot[1]] = here
            block = points[members]
            spread = block.max(axis=0) > block.min(axis=0)
            if depth >= height or len(members) <= 1 or not spread.any():
                nodes.append([tree, here, -1, 0.0, -1, -1, depth + unsplit_depth(len(members)), len(points)])
                continue
            feature = int(rng.choice(np.flatnonzero(spread)))
            values = block[:, feature]
            low, high = float(values.min()), float(values.max())
            cut = float(rng.uniform(low, high))
            if cut >= high:
                # Neighbouring floats have nothing in between; either side must keep a row.
                cut = low
            below = values <= cut
            nodes.append([tree, here, feature, cut, -1, -1, 0.0, len(points)])
            waiting.append((members[~below], depth + 1, (here, 5)))
            waiting.append((members[below], depth + 1, (here, 4)))
        return pd.DataFrame(
            nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path", "sample"]
        )

    samples = _tree_samples(df, columns, rows, settings)
    return samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def load_trees(nodes: DataFrame, settings: Settings = DEFAULT) -> list[dict]:
    """The forest as arrays per tree; refuses a table larger than a forest can be."""
    bound = settings.trees * 2 * settings.tree_sample
    table = nodes.limit(bound + 1).toPandas()
    if len(table) > bound:
        raise ValueError(f"more than {bound} nodes: not a forest of {settings.trees} trees")
    forest = []
    for _, tree in table.sort_values(["tree", "node"]).groupby("tree"):
        forest.append({c: tree[c].to_numpy() for c in ("feature", "threshold", "left", "right", "path", "sample")})
    return forest


def isolation_score(forest: list[dict], columns: Sequence[str | Column], height: int | None = None) -> Column:
    """Score in [-1,0) of the given feature columns: the lower, the easier to isolate."""
    steps = height or max(1, math.ceil(math.log2(max(int(forest[0]["sample"][0]), 2))))

    def score(batches):
        import numpy as np

        n = int(forest[0]["sample"][0])
        if n <= 1:
            usual = 0.0
        elif n == 2:
            usual = 1.0
        else:
            usual = 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n
        for batch in batches:
            points = np.column_stack([c.to_numpy(dtype=float) for c in batch])
            every = np.arange(len(points))
            total = np.zeros(len(points))
            for tree in forest:
                at = np.zeros(len(points), dtype=np.int64)
                for _ in range(steps):
                    feature = tree["feature"][at]
                    inner = feature >= 0
                    if not inner.any():
                        break
                    goes_left = points[every, np.where(inner, feature, 0)] <= tree["threshold"][at]
                    at = np.where(inner, np.where(goes_left, tree["left"][at], tree["right"][at]), at)
                total += tree["path"][at]
            mean = total / len(forest)
            yield pd.Series(-np.power(2.0, -mean / usual) if usual > 0 else np.full(len(points), -0.5))

    from collections.abc import Iterator

    score.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    cells = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.pandas_udf(score, "double")(*[c.cast("double") for c in cells])


def score_iforest(
    df: DataFrame, columns: Sequence[str], nodes: DataFrame, settings: Settings = DEFAULT
) -> DataFrame:
    """Adds ``anomaly_score``. Only the feature columns travel to Python and back."""
    return df.withColumn("anomaly_score", isolation_score(load_trees(nodes, settings), columns))
