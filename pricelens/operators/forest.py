"""Random-forest price models, with the spread and the own score of their trees.

Sizes and quote prices are cut into bins. Rows of equal bins and categories, a cell, cannot be parted by
a tree: of a cell it needs how many of its rows it draws, and their sum. Every tree draws every row by
itself (Poisson with mean 1, by a hash of the row), however many rows there are; only then are the rows of a cell
added. So the work of growing is bounded by the cells that occur, and the rule is one for every size. A tree
is grown whole by one task (``trees.py``), which holds the cells. The trees are ``FOLDS`` parts fitted beside each
other; each leaves out the rows whose key hashes to its fold, so every row is scored by trees that never saw it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..sources.tables import computed, inline_table, materialize, shared_folder
from . import trees as growing
from .joins import lookup_join

CATEGORIES = ["type_of_product", "subindustry", "channel"]
# Fixed values.
UNKNOWN = "Desconocido"
TREES, MIN_LEAF, SEED = 100, 2, 42
# Trees grow to the smallest leaf; 30 is as deep as trees of Spark's own forests may be.
MAX_DEPTH = 30
MAX_BINS = 64
# Parts of the trees, each fitted without one fold of the rows.
FOLDS = 8
_PARTS = "part int, first int, trees int"
_HEX = 8  # digits of a digest that make a number


def _hashed(key: Column, from_digit: int, parts: int) -> Column:
    """A number below ``parts`` for each key, the same at any time."""
    digest = F.md5(F.concat_ws("-", F.lit(str(SEED)), key.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, from_digit, _HEX), 16, 10).cast("bigint"), F.lit(parts))


def fold_of(key: Column, folds: int = FOLDS) -> Column:
    """The part of the trees that never sees a row of this key."""
    return _hashed(key, 1, folds)


def _bins(numbers: list[str]) -> list[str]:
    return [f"{c}_bin" for c in numbers]


def _side_by_side(work: Callable, count: int) -> list:
    """``work(i)`` for every i below ``count``; Spark runs their jobs beside each other."""
    spark, pool = SparkSession.builder.getOrCreate(), ThreadPool(max(1, count))
    try:
        return pool.map(inheritable_thread_target(spark)(work), range(count), chunksize=1)
    finally:
        pool.close()


@dataclass
class Part:
    """Trees ``first`` and following, as a table of their nodes."""

    nodes: DataFrame
    first: int
    getNumTrees: int


@dataclass
class Forest:
    """Stages that make bins and indices of rows, and parts of trees; a fitted one also knows its training rows."""

    prepare: PipelineModel
    parts: list[Part]
    nodes: DataFrame
    rows: DataFrame | None = None

    @property
    def stages(self) -> list:
        return [*self.prepare.stages, self]

    @property
    def leaves(self) -> DataFrame:
        """price of every leaf, and n, total and squares of the labels of all rows its tree may see."""
        return self.nodes.filter(F.col("feature") < 0).select(
            "tree", F.col("node").alias("leaf"), "price", "n", "total", "squares")

    @property
    def getNumTrees(self) -> int:
        return sum(part.getNumTrees for part in self.parts)

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``unit_price``, the mean of the trees."""
        spread = with_tree_spread(self.prepare.transform(rows), self)
        return spread.withColumnRenamed("tree_mean", "unit_price").drop("tree_spread")


def _prepared(rows: DataFrame, numbers: list[str], max_bins: int) -> PipelineModel:
    """Category flags, and bins between quantiles of the numbers, learned from ``rows``."""
    indexed, encoded = [f"{c}_index" for c in CATEGORIES], [f"{c}_flags" for c in CATEGORIES]
    steps = [i / max_bins for i in range(max_bins)]
    quantiles = rows.approxQuantile(numbers, steps, 0.25 / max_bins)
    cuts = [[-math.inf, *sorted(set(own)), math.inf] for own in quantiles]
    stages = [
        StringIndexer(
            inputCols=CATEGORIES, outputCols=indexed, stringOrderType="alphabetDesc",
            handleInvalid="keep",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        Bucketizer(splitsArray=cuts, inputCols=numbers, outputCols=_bins(numbers)),
    ]
    return Pipeline(stages=stages).fit(rows)


def _sizes(prepare: PipelineModel) -> list[int]:
    """How many values each feature has: bins of the size, the categories with one for unknown, bins of the quote."""
    size, quote = (len(cuts) - 1 for cuts in prepare.stages[2].getSplitsArray())
    return [size, *[len(labels) + 1 for labels in prepare.stages[0].labelsArray], quote]


def _cell(prepare: PipelineModel) -> Column:
    """One number for the bins and indices that ``prepare`` gives a row."""
    size, quote = prepare.stages[2].getOutputCols()
    cell = F.lit(0).cast("bigint")
    for name, values in zip([size, *[f"{c}_index" for c in CATEGORIES], quote], _sizes(prepare)):
        cell = cell * F.lit(values) + F.col(name).cast("bigint")
    return cell


class RandomForestRegressor:
    """The trees of one part, each grown by a task of its own."""

    def __init__(self, first: int, trees: int, sizes: list[int], max_depth: int, path: str):
        self.first, self.trees, self.sizes, self.max_depth, self.path = first, trees, sizes, max_depth, path

    def fit(self, ready: DataFrame) -> Part:
        """``ready`` has cells as ``trees.CELLS``, with how often and how high each tree of the part draws them."""
        its = ready.select(
            "cell", "weight", "total", "squares", F.posexplode(F.arrays_zip("drawn", "sums")).alias("place", "_of"),
        ).select("cell", "weight", "total", "squares", "_of.drawn", "_of.sums",
                 (F.col("place") + self.first).cast("int").alias("tree"))
        grown = growing.grown(self.sizes, self.max_depth, MIN_LEAF)
        its.repartition(self.trees, "tree").groupBy("tree").applyInArrow(grown, growing.NODES).write.parquet(self.path)
        nodes = ready.sparkSession.read.schema(growing.NODES).parquet(self.path)
        return Part(nodes, self.first, self.trees)


def fit_forest(
    train: DataFrame,
    size: str,
    label: str,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    max_bins: int = MAX_BINS,
    key: str | None = None,
) -> Forest:
    """One-hot categories plus size and quote price into a regression forest.

    Unseen categories encode to all zeros. ``size`` is 'volume_liters' or
    'total_quantity', ``label`` the matching unit price. Folds are drawn by the column ``key``;
    without one, rows are numbered as they are written. Fewer than two trees leave no row out.
    """
    numbers = [size, "approved_quote_price"]
    narrow = train.dropna(subset=[size, label]).fillna(0.0, subset=["approved_quote_price"]).select(
        (F.monotonically_increasing_id() if key is None else F.col(key)).alias("key"),
        *[F.col(c).cast("double").alias(c) for c in numbers], F.col(label).cast("double").alias("label"),
        *[F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in CATEGORIES],
    )
    # Read again for cuts, merging and score, with the same numbers as keys: written once.
    rows = materialize(narrow, "train")
    spark, folds = rows.sparkSession, min(FOLDS, trees)
    prepare = _prepared(rows, numbers, max_bins)
    sizes, firsts = _sizes(prepare), [i * trees // folds for i in range(folds + 1)]
    coded = prepare.transform(rows).select(
        _cell(prepare).alias("cell"), fold_of(F.col("key"), folds).alias("fold"), "label",
        F.xxhash64(F.lit(SEED), "key", "label", *numbers, *CATEGORIES).alias("number"))
    # A hot cell may be dealt to several tasks: what they count of it is added when a tree is grown.
    sorted_rows = coded.hint("rebalance", "cell").sortWithinPartitions("cell", "number")
    base = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    sorted_rows.mapInArrow(growing.drawn(firsts), growing.CELLS).write.partitionBy("part").parquet(f"{base}/cells")
    cells = spark.read.schema(growing.CELLS).parquet(f"{base}/cells")

    def grown(part: int) -> Part:
        regressor = RandomForestRegressor(
            firsts[part], firsts[part + 1] - firsts[part], sizes, max_depth, f"{base}/nodes/part={part}")
        return regressor.fit(cells.filter(F.col("part") == part).drop("part"))

    return Forest(prepare, _side_by_side(grown, folds), _nodes(spark, f"{base}/nodes"), rows)


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{growing.NODES}, part int").parquet(path)


def _fallen(asked: DataFrame, model: Forest) -> DataFrame:
    """Leaf and price of every ``tree`` and ``cell`` asked for."""
    tasks = model.getNumTrees
    by_tree = [x.repartition(tasks, "tree").groupBy("tree") for x in (model.nodes.drop("part"), asked)]
    return by_tree[0].cogroup(by_tree[1]).applyInArrow(growing.fallen(_sizes(model.prepare)), growing.FALLEN)


def _each_tree(cells: DataFrame, model: Forest) -> DataFrame:
    every = F.sequence(F.lit(0), F.lit(model.getNumTrees - 1))
    return cells.select("cell", F.explode(every).alias("tree"))


def _with_tree_stats(prices: DataFrame, *by: Column | str) -> DataFrame:
    """``tree_mean`` and ``tree_spread`` of every group's prices, one for each tree, added up in the trees' order."""
    gathered = prices.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("tree", "price"))).alias("_each"))
    mean, spread = tree_stats(F.col("_values"))
    return computed(gathered, {"_values": F.col("_each.price")}).withColumns(
        {"tree_mean": mean, "tree_spread": spread}).drop("_each", "_values")


def save_model(model: Forest, path: str) -> None:
    model.prepare.write().overwrite().save(f"{path}/prepare")
    model.nodes.write.mode("overwrite").partitionBy("part").parquet(f"{path}/nodes")
    # Written last: a model without it is not whole.
    spark = SparkSession.builder.getOrCreate()
    parts = [(i, part.first, part.getNumTrees) for i, part in enumerate(model.parts)]
    inline_table(spark, parts, _PARTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/whole")


def load_model(path: str) -> Forest:
    spark = SparkSession.builder.getOrCreate()
    parts = spark.read.schema(_PARTS).parquet(f"{path}/whole").orderBy("part").collect()  # FOLDS rows
    nodes = _nodes(spark, f"{path}/nodes")
    its = [Part(nodes.filter(F.col("part") == i), first, count) for i, first, count in parts]
    return Forest(PipelineModel.load(f"{path}/prepare"), its, nodes)


def confidence(mean: Column, spread: Column) -> Column:
    """100 for agreeing trees, down to 0 when the spread is half the mean."""
    share = F.lit(1.0) - F.lit(2.0) * F.try_divide(spread, mean)
    return F.when(mean == 0, 0.0).otherwise(
        F.round(F.greatest(F.lit(0.0), share) * 100, 2)
    )


def tree_stats(values: Column) -> tuple[Column, Column]:
    """Mean and population standard deviation of an array of the trees' predictions."""
    count = F.size(values).cast("double")
    mean = F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / count
    # The mean is found once a row, not once more for every tree.
    return mean, F.sqrt(text.let(mean, lambda m: F.aggregate(
        F.transform(values, lambda v: (v - m) * (v - m)), F.lit(0.0), lambda total, v: total + v) / count))


def flags(model: Forest, rows: DataFrame) -> DataFrame:
    """The category flags the forest sees, one string of 0 and 1 per category column."""
    for stage in model.stages[:2]:
        rows = stage.transform(rows)
    return rows.withColumns({
        f"{c}_flags": F.array_join(
            F.transform(vector_to_array(f"{c}_flags"), lambda x: x.cast("int").cast("string")), "")
        for c in CATEGORIES
    })


def with_tree_spread(scored: DataFrame, forest: Forest) -> DataFrame:
    """Mean and spread of the trees' predictions, row by row.

    ``scored`` has the bins and indices of the forest's ``prepare``. Rows of one cell fall into the same leaves, so
    trees are asked for the cells that occur; every row finds its own cell again, whatever its key or
    theirs, and none is lost or paired with another. The rows are written first: what is asked for is what is priced.
    """
    rows = materialize(scored.withColumn("_cell", _cell(forest.prepare)), "to-price")
    cells = rows.select(F.col("_cell").alias("cell")).distinct()
    prices = _with_tree_stats(_fallen(_each_tree(cells, forest), forest), F.col("cell").alias("_cell"))
    return lookup_join(rows, materialize(prices, "cell-prices"), ["_cell"], "left").drop("_cell")


def predict(products: DataFrame, path: str, size: str) -> DataFrame:
    """Unit price and confidence of every product from the model saved at ``path``.

    The size is read from ``size``, a column of ``products`` named as in training. A
    product without size or quote price keeps its row; its price and confidence are NULL.
    """
    model = load_model(path)
    numbers = [size, "approved_quote_price"]
    known = F.col(size).isNotNull() & F.col("approved_quote_price").isNotNull()
    # Columns of no type cannot be written, and come back as they are.
    void = [c for c, kind in products.dtypes if kind == "void"]
    kept = F.struct(*[F.col(f"`{c}`") for c in products.columns if c not in void])
    given = products.select(kept.alias("_given"), *numbers, *CATEGORIES).withColumn("_known", known)
    coded = model.prepare.transform(given.fillna(0.0, subset=numbers)).drop(
        *numbers, *CATEGORIES, *[f"{c}_flags" for c in CATEGORIES])
    spread = with_tree_spread(coded, model)
    sure = confidence(F.col("tree_mean"), F.col("tree_spread"))
    return spread.select(
        *[F.lit(None).alias(c) if c in void else F.col(f"_given.`{c}`") for c in products.columns],
        F.when(F.col("_known"), F.col("tree_mean")).alias("predicted_price_per_unit"),
        F.when(F.col("_known"), sure).alias("model_confidence"),
    )


def with_leaf_stats(rows: DataFrame, model: Forest) -> DataFrame:
    """``rows`` with mean, spread and ``leaf_spread`` from the table of leaves.

    The means of the leaves a row falls into are its trees' predictions. ``leaf_spread`` is
    the standard deviation of a label drawn from one of these leaves: spread between the
    trees and within the leaves, so it tells how far a price may lie from the mean.
    """
    prepared = model.prepare.transform(rows).withColumn("_cell", _cell(model.prepare))
    numbered = materialize(prepared.select(*rows.columns, "_cell"), "to-price")
    cells = numbered.select(F.col("_cell").alias("cell")).distinct()
    around = (F.col("squares") - 2 * F.col("price") * F.col("total")) / F.col("n") + F.col("price") * F.col("price")
    stats = model.leaves.select("tree", "leaf", "price", around.alias("_around"))
    mean = F.avg("price")
    fallen = _fallen(_each_tree(cells, model), model).drop("price")
    spread = fallen.join(stats, ["tree", "leaf"]).groupBy(F.col("cell").alias("_cell")).agg(
        mean.alias("tree_mean"), F.stddev_pop("price").alias("tree_spread"),
        F.sqrt(F.greatest(F.lit(0.0), F.avg("_around")) + F.var_pop("price")).alias("leaf_spread"),
    )
    return lookup_join(numbered, materialize(spread, "cell-prices"), ["_cell"], "left").drop("_cell")


def out_of_bag(model: Forest) -> DataFrame:
    """key, label, fold and price of every training row, by the trees that never saw it."""
    fold = fold_of(F.col("key"), len(model.parts)).alias("fold")
    ready = model.prepare.transform(model.rows).select("key", "label", fold, _cell(model.prepare).alias("cell"))
    ends = [(part.first, part.first + part.getNumTrees - 1) for part in model.parts]
    first, last = (F.get(F.array(*[F.lit(e[i]) for e in ends]), F.col("fold").cast("int")) for i in (0, 1))
    asked = ready.select("fold", "cell").distinct().select("cell", F.explode(F.sequence(first, last)).alias("tree"))
    part = [i for i, part in enumerate(model.parts) for _ in range(part.getNumTrees)]
    own = F.get(F.array(*[F.lit(i).cast("bigint") for i in part]), F.col("tree")).alias("fold")
    prices = _with_tree_stats(_fallen(asked, model), own, "cell").withColumnRenamed("tree_mean", "price")
    scored = lookup_join(ready, materialize(prices, "cell-prices"), ["fold", "cell"], "left")
    return scored.select("key", "label", "fold", "price")


def out_of_bag_score(model: Forest) -> float | None:
    """Share of the labels' variance that the out-of-bag prices explain; None for equal labels."""
    scored = out_of_bag(model)
    missed = F.col("label") - F.col("price")
    r = scored.agg(F.avg(missed * missed).alias("error"), F.var_pop("label").alias("variance")).first()
    return 1 - r["error"] / r["variance"] if r["variance"] else None


def holdout_score(
    train: DataFrame, size: str, label: str, share: float = 0.2, metric: str = "r2", **options
) -> float:
    """Score on a seeded hold-out."""
    fitted, held = train.randomSplit([1 - share, share], seed=SEED)
    model = fit_forest(fitted, size, label, **options)
    known = held.dropna(subset=[size, label]).fillna(UNKNOWN, subset=CATEGORIES)
    scored = model.transform(known.fillna(0.0, subset=["approved_quote_price"]))
    return RegressionEvaluator(
        labelCol=label, predictionCol="unit_price", metricName=metric
    ).evaluate(scored)
