"""Per-row additive attribution of a score to its features, and its summaries.

An attribution is an array of (feature, shap_value, feature_value) on each row;
for every model the values and the base value sum to the model's margin.

Trees are additive, so large ensembles go through in blocks of trees. The node counts of the trees decide the blocks, before
a node is read; a block's leaves are what tasks receive, and each block adds its part to the rows' values. In a task,
a leaf's values are looked up by the pattern of its conditions that a row meets; that table is made once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_dir, staged
from .boosting import ContinuedModel
from .models import FittedModel

TOP_FEATURES = 15
TOP_PER_ROW = 10
BLOCK_NODES = 65_536   # of the trees that tasks receive at once, about 20 MB of leaves
TABLE_CONDITIONS = 10  # of a leaf: up to these, a table holds the values of all 1,024 patterns
_ARRAY = "array<struct<feature:string,shap_value:double,feature_value:double>>"


def _entry(feature: str, value: Column) -> Column:
    return F.struct(F.lit(feature).alias("feature"), value.alias("shap_value"),
                    F.col(f"`{feature}`").cast("double").alias("feature_value"))


def linear_attribution(df: DataFrame, weights: Mapping[str, float], means: Mapping[str, float],
                       keep: Sequence[str]) -> DataFrame:
    """Closed form for a linear margin: weight * (value - mean)."""
    entries = [_entry(c, F.lit(float(w)) * (F.col(f"`{c}`") - F.lit(float(means[c]))))
               for c, w in weights.items()]
    return df.select(*keep, F.array(*entries).alias("contributions"))


def linear_model_attribution(df: DataFrame, model: FittedModel, keep: Sequence[str]) -> DataFrame:
    """Attribution of a fitted logistic regression in log-odds."""
    coefficients = model.model.coefficients.toArray()
    weights = {c: w / model.scaling[c][1] for c, w in zip(model.feature_cols, coefficients)}
    return linear_attribution(df, weights, {c: m for c, (m, _) in model.scaling.items()}, keep)


def feature_importance(attributed: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """Mean absolute contribution of each feature, largest first."""
    return (attributed.select(F.inline("contributions")).groupBy("feature")
            .agg(F.avg(F.abs("shap_value")).alias("importance"))
            .orderBy(F.desc("importance"), "feature").limit(top))


def top_contributors(attributed: DataFrame, top: int = TOP_PER_ROW) -> DataFrame:
    """The largest contributions of every row, by size, with their direction."""
    # Sorted by negated size; the position keeps equal sizes in feature order.
    keyed = F.transform("contributions", lambda c, i: F.struct(
        (-F.abs(c["shap_value"])).alias("size"), i.alias("position"), c.alias("c")))
    best = F.transform(F.slice(F.array_sort(keyed), 1, top), lambda k: F.struct(
        k["c"]["feature"].alias("feature"), k["c"]["shap_value"].alias("shap_value"),
        k["c"]["feature_value"].alias("feature_value"),
        F.when(k["c"]["shap_value"] > 0, "toward churn").otherwise("away from churn").alias("direction")))
    return attributed.withColumn("top_contributors", best).drop("contributions")


@dataclass
class Leaf:
    """A leaf as a box: per distinct feature on its path an interval and a cover ratio."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    ratio: np.ndarray


@dataclass(frozen=True)
class Ensemble:
    """Where the nodes of an ensemble are stored, the trees' weights, and whether leaves hold margins or votes."""

    path: str
    weights: tuple[float, ...]
    margins: bool

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/data").select("treeID", "nodeData")

    def blocks(self, spark: SparkSession, most: int) -> list[tuple[int, int]]:
        """Runs of trees (first, end) that hold `most` nodes or fewer; one row a tree is read for it."""
        sizes = {r.treeID: r.n for r in self.nodes(spark).groupBy("treeID").agg(F.count("*").alias("n")).collect()}
        out, held = [], 0
        for tree in range(len(self.weights)):
            n = sizes.get(tree, 0)
            if n > most:
                raise ValueError(f"a tree of {n} nodes is more than the {most} that a task receives; limit its depth")
            if not out or held + n > most:
                out.append((tree, tree))
                held = 0
            out[-1], held = (out[-1][0], tree + 1), held + n
        return out

    def leaves(self, spark: SparkSession, first: int, end: int) -> list[Leaf]:
        nodes: dict[int, dict[int, dict]] = {}
        for r in self.nodes(spark).where(F.col("treeID").between(first, end - 1)).collect():
            nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
        leaves: list[Leaf] = []
        for tree, table in sorted(nodes.items()):
            children = {c for n in table.values() for c in (n["leftChild"], n["rightChild"]) if c >= 0}
            root = next(i for i in table if i not in children)
            _walk(table, root, {}, leaves, self.margins, self.weights[tree])
        return leaves


def stored_ensemble(model, spark: SparkSession) -> Ensemble:
    """The trees of a fitted model, saved to the shared folder.

    Boosted trees give log-odds (twice Spark's boosting margin), forests give the probability, and the added trees of a
    continued model give log-odds as they are.
    """
    path = f"{shared_dir(spark)}/trees-{uuid.uuid4().hex}"
    learner = model.extra if isinstance(model, ContinuedModel) else model.model
    learner.write().overwrite().save(path)
    weights = [float(w) for w in learner.treeWeights]
    margins = model.model_class != "RandomForestClassifier"
    scale = 1.0 if isinstance(model, ContinuedModel) else 2.0 if margins else 1.0 / sum(weights)
    return Ensemble(path, tuple(scale * w for w in weights), margins)


def base_value(leaves: Sequence[Leaf]) -> float:
    return sum(leaf.value * float(np.prod(leaf.ratio)) for leaf in leaves)


def tree_leaves(model: FittedModel, spark: SparkSession) -> tuple[list[Leaf], float]:
    """All weighted leaves of an ensemble that fits one block, and its base value."""
    stored = stored_ensemble(model, spark)
    (first, end), = stored.blocks(spark, BLOCK_NODES)
    leaves = stored.leaves(spark, first, end)
    return leaves, base_value(leaves)


def _walk(table, node_id, boxes, leaves, boosted, weight) -> None:
    node = table[node_id]
    if node["leftChild"] < 0:
        stats = node["impurityStats"]
        value = node["prediction"] if boosted else stats[1] / sum(stats)
        names = sorted(boxes)
        leaves.append(Leaf(weight * value, np.array(names, dtype=int),
                           *(np.array([boxes[f][k] for f in names], dtype=float) for k in range(3))))
        return
    split = node["split"]
    if split["numCategories"] != -1:
        raise ValueError("attribution expects continuous features")
    feature, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
    low, high, ratio = boxes.get(feature, (-np.inf, np.inf, 1.0))
    for child, box in ((node["leftChild"], (low, min(high, cut))), (node["rightChild"], (max(low, cut), high))):
        share = table[child]["rawCount"] / node["rawCount"]
        _walk(table, child, {**boxes, feature: (*box, ratio * share)}, leaves, boosted, weight)


def _leaf_shapley(inside: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Shapley values of the game 'product over S of inside, over the rest of ratio'.

    `inside` holds one row of 0/1 per pattern. The others' product is a polynomial
    whose k-th coefficient sums the coalitions of size k.
    """
    n, d = inside.shape
    share = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)])
    out = np.empty((n, d))
    for i in range(d):
        poly = np.zeros((n, d))
        poly[:, 0] = 1.0
        for j in range(d):
            if j != i:
                poly[:, 1:] = poly[:, 1:] * ratio[j] + poly[:, :-1] * inside[:, [j]]
                poly[:, 0] *= ratio[j]
        out[:, i] = (poly @ share) * (inside[:, i] - ratio[i])
    return out


class LeafTables:
    """Leaves ready to explain rows; one table a leaf of what each pattern of met conditions gives."""

    def __init__(self, leaves: Sequence[Leaf]):
        self.leaves = [leaf for leaf in leaves if len(leaf.features)]
        self.tables: list[np.ndarray | None] = []
        for leaf in self.leaves:
            d = len(leaf.features)
            known = None
            if d <= TABLE_CONDITIONS:
                every = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
                known = leaf.value * _leaf_shapley(every, leaf.ratio)
            self.tables.append(known)

    def add(self, x: np.ndarray, phi: np.ndarray) -> None:
        """Adds the attributions of the rows of `x` to `phi`."""
        for leaf, table in zip(self.leaves, self.tables):
            values = x[:, leaf.features]
            inside = (values > leaf.low) & (values <= leaf.high)
            if table is None:  # too many conditions for a table: only the patterns that occur
                patterns, where = np.unique(inside.astype(float), axis=0, return_inverse=True)
                phi[:, leaf.features] += leaf.value * _leaf_shapley(patterns, leaf.ratio)[where.reshape(-1)]
            else:
                phi[:, leaf.features] += table[inside @ (1 << np.arange(len(leaf.features)))]


def shapley_values(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Path-dependent tree attributions of the rows of `x`."""
    phi = np.zeros(x.shape)
    LeafTables(leaves).add(x, phi)
    return phi


def add_leaves(rows: DataFrame, leaves: Sequence[Leaf]) -> DataFrame:
    """`rows` hold arrays x and phi of one length; adds the leaves' part to phi."""
    place = {c: rows.columns.index(c) for c in ("x", "phi")}
    names = rows.columns

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for b in batches:
            tables = tables or LeafTables(leaves)
            x, phi = (b.column(place[c]).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).copy() for c in ("x", "phi"))
            if b.num_rows:
                tables.add(x, phi)
            added = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (phi.shape[1] if b.num_rows else 0)), pa.array(phi.ravel()))
            yield pa.RecordBatch.from_arrays([added if i == place["phi"] else c for i, c in enumerate(b.columns)], names=names)

    return rows.mapInArrow(explain, rows.schema)


def tree_attribution(df: DataFrame, model, keep: Sequence[str], block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(keep, contributions, base_value): attribution of a tree ensemble, or of a continued model, in log-odds.

    Forests are explained in probability. Blocks of trees travel to the tasks one after the other, rows stay where they
    are; from the second block on, the values so far are written down in between.
    """
    spark, names = df.sparkSession, list(model.feature_cols)
    start, base = F.array(*[F.lit(0.0) for _ in names]), F.lit(0.0)
    ensembles = [model]
    if isinstance(model, ContinuedModel):
        first = model.base
        if first.model_class == "RandomForestClassifier":
            raise ValueError("votes of a forest do not add up with the margins of further trees")
        if first.scaling:  # a linear start: its values are a formula
            coefficients = first.model.coefficients.toArray()
            parts = {c: float(w) / first.scaling[c][1] for c, w in zip(first.feature_cols, coefficients)}
            start = F.array(*[F.lit(parts[c]) * (F.col(f"`{c}`").cast("double") - F.lit(float(first.scaling[c][0]))) for c in names])
            base = F.lit(float(first.model.intercept))
        else:
            ensembles = [first, model]
    rows = df.select(*keep, F.array(*[F.col(f"`{c}`").cast("double") for c in names]).alias("x"), start.alias("phi"))
    done = 0
    for part in ensembles:
        stored = stored_ensemble(part, spark)
        for block in stored.blocks(spark, block_nodes):
            leaves = stored.leaves(spark, *block)
            rows = add_leaves(staged(rows, "attribution") if done else rows, leaves)
            base, done = base + F.lit(base_value(leaves)), done + 1
    labels = F.array(*[F.lit(c) for c in names])
    entries = F.zip_with(F.arrays_zip(labels.alias("feature"), F.col("phi").alias("shap_value")), "x",
                         lambda a, v: F.struct(a["feature"].alias("feature"),
                                               a["shap_value"].alias("shap_value"), v.alias("feature_value")))
    return rows.select(*keep, entries.cast(_ARRAY).alias("contributions"), base.alias("base_value"))
