"""Model families on Spark ML, their comparison and their feature importance."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.evaluation import classification_metrics, regression_metrics, roc_auc
from riskframe.operators.ordering import clean, small_side
from riskframe.sources.tables import shared_folder, stage

#: Rows keep the number of their node, so deep trees are not walked again for each level. The
#: lineage of these numbers, and that of boosting's residuals, is cut every few rounds in the
#: session's checkpoint folder.
FOREST_OPTIONS = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 512}
BOOSTED_OPTIONS = {"checkpointInterval": 10, "maxMemoryInMB": 512}
#: Boosting reads each cell of its binned columns as one row if there can be at most this many cells.
MAX_CELLS = 1 << 20
#: A forest keeps a weight and a label per cell and tree, so it takes fewer cells.
FOREST_CELLS = 1 << 16
#: Smaller tables are fitted row by row, as the jobs of many single trees take longer than such a fit.
FOREST_ROWS = 100_000
#: Bootstrap counts that a task draws at once.
DRAWS = 1 << 20
MISSING_CATEGORY = "\uffff"  # sorts after every category

REGRESSION = "regression"
CLASSIFICATION = "classification"
SELECTION_METRIC = {REGRESSION: "r2", CLASSIFICATION: "f1"}


@dataclass
class Fitted:
    """A fitted model with its metrics: one row per side (train, test)."""

    name: str
    task: str
    model: Model
    metrics: DataFrame


def vector_pipeline(cats: Sequence[str], nums: Sequence[str]) -> Pipeline:
    """One-hot vectors (first category dropped, missing last) and numbers as ``features``.

    The vectors are sparse, so a column of many categories costs no column per category.
    """
    indexed = [f"_{c}_index" for c in cats]
    encoded = [f"_{c}_onehot" for c in cats]
    stages = []
    if cats:
        stages.append(StringIndexer(
            inputCols=list(cats), outputCols=indexed, stringOrderType="alphabetDesc", handleInvalid="error"
        ))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=[*encoded, *nums], outputCol="features", handleInvalid="error"))
    return Pipeline(stages=stages)


def _indexed(indexer: StringIndexerModel, df: DataFrame) -> DataFrame:
    """Category numbers; an unseen category takes that of the first category, which is encoded as zeros."""
    names = indexer.getOutputCols()
    seen = indexer.transform(df).schema
    lenient = indexer.copy({indexer.handleInvalid: "keep"}).transform(df)
    return lenient.withColumns({
        name: F.least(F.col(name), F.lit(len(labels) - 1.0)).alias(name, metadata=seen[name].metadata)
        for name, labels in zip(names, indexer.labelsArray)
    })


def assemble(
    df: DataFrame,
    cats: Sequence[str],
    nums: Sequence[str],
    target: str,
    keep: Sequence[str] = (),
    encoder: PipelineModel | None = None,
) -> tuple[DataFrame, PipelineModel]:
    """(features, label and kept columns; fitted encoder). Rows without a target are dropped.

    A category that a given encoder has not seen gets zeros, as its first category does.
    """
    ready = df.where(F.col(target).isNotNull()).withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)) for c in cats}
        | {c: F.col(c).cast("double") for c in nums}
    )
    if encoder is None:
        encoder = vector_pipeline(cats, nums).fit(ready)
        table = encoder.transform(ready)
    elif cats:
        table = PipelineModel(encoder.stages[1:]).transform(_indexed(encoder.stages[0], ready))
    else:
        table = encoder.transform(ready)
    return table.select(*keep, "features", F.col(target).cast("double").alias("label")), encoder


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the slots of a vector column, from its metadata."""
    groups = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)
    return [_plain(name) for _, name in slots]


def _plain(name: str) -> str:
    """Readable slot name: the encoder's ``_<column>_onehot_<category>`` loses its marks."""
    head, mark, category = name.partition("_onehot_")
    if not mark:
        return name
    return f"{head.removeprefix('_')}_{'nan' if category == MISSING_CATEGORY else category}"


def with_predictions(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and, for classifiers, ``score``: the probability of class 1."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out


def _evaluate(name: str, task: str, model: Model, train: DataFrame, test: DataFrame) -> Fitted:
    sides = {"train": train, "test": test}
    pred = reduce(
        DataFrame.unionByName,
        [with_predictions(model, df).withColumn("side", F.lit(side)) for side, df in sides.items()],
    )
    if task == REGRESSION:
        metrics = regression_metrics(pred, by=["side"])
    else:
        # The ranks behind the curve take several passes: keep them off the model.
        pred = stage(pred.select("side", "label", "prediction", "score"))
        metrics = classification_metrics(pred, by=["side"])
        auc = reduce(
            DataFrame.unionByName,
            [roc_auc(pred.where(F.col("side") == s)).select(F.lit(s).alias("side"), "roc_auc") for s in sides],
        )
        metrics = metrics.join(F.broadcast(auc), "side", "left")
    return Fitted(name, task, model, metrics.select(F.lit(name).alias("model"), "*"))


def fit_linear(train: DataFrame, test: DataFrame) -> Fitted:
    """Ordinary least squares on ``features`` and ``label``."""
    model = LinearRegression(regParam=0.0).fit(train)
    return _evaluate("Linear Regression", REGRESSION, model, train, test)


def fit_forest(
    train: DataFrame,
    test: DataFrame,
    task: str = REGRESSION,
    n: int = 100,
    depth: int | None = None,
    seed: int = 42,
    max_bins: int = 32,
) -> Fitted:
    """Random forest. ``None`` is the deepest tree Spark allows, 30 levels.

    With few columns and many rows each tree is fitted to the cells of its bootstrap (``bootstrap_cells``).
    """
    options = dict(numTrees=n, maxDepth=30 if depth is None else depth, seed=seed, maxBins=max_bins, **FOREST_OPTIONS)
    if task == REGRESSION:
        estimator = RandomForestRegressor(featureSubsetStrategy="all", **options)
    else:
        estimator = RandomForestClassifier(featureSubsetStrategy="sqrt", **options)
    kind = "Regressor" if task == REGRESSION else "Classifier"
    cells = bootstrap_cells(train, task, n, seed, max_bins) if train.count() >= FOREST_ROWS else None
    if cells is None:
        model = estimator.fit(train)
    else:
        classes = None if task == REGRESSION else int(train.agg(F.max("label")).first()[0]) + 1
        model = _fit_by_cells(estimator, *cells, n, classes)
    return _evaluate(f"Random Forest {kind}", task, model, train, test)


def _kinds(df: DataFrame) -> list[str]:
    """Kind of each slot of ``features`` (numeric, binary, nominal), from its metadata; empty if that is unknown."""
    groups = df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return [kind for _, kind in sorted((a["idx"], kind) for kind, attrs in groups.items() for a in attrs)]


def _cuts(slots: DataFrame, numeric: Sequence[str], max_bins: int) -> dict[str, list[float]]:
    """Cut points of each column; bin k holds the values up to the k-th cut.

    Quantiles, or the middles between all values of a column that has at most ``max_bins``.
    """
    if not numeric:
        return {}
    distinct = slots.agg(*[F.approx_count_distinct(c).alias(c) for c in numeric]).first()
    few = [c for c in numeric if distinct[c] <= 2 * max_bins]
    sets = slots.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in few]).first() if few else {}
    cuts = {c: [(a + b) / 2 for a, b in zip(sets[c], sets[c][1:])] for c in few if len(sets[c]) <= max_bins}
    many = [c for c in numeric if c not in cuts]
    quantiles = slots.approxQuantile(many, [i / max_bins for i in range(1, max_bins)], 0.001) if many else []
    return cuts | {c: sorted(set(q)) for c, q in zip(many, quantiles)}


def _binned(train: DataFrame, max_bins: int, most: int) -> tuple[DataFrame, list[str], list[list[float]]] | None:
    """Rows as label and bins, the names of the bins, and the cuts of each slot.

    None if there can be more than ``most`` cells of equal bins, or if the slots are not known to be
    numbers or indicators.
    """
    kinds = _kinds(train)
    if not kinds or not set(kinds) <= {"numeric", "binary"}:
        return None
    if math.prod(2 if kind == "binary" else max_bins for kind in kinds) > most:
        return None
    names = [f"_x{i}" for i in range(len(kinds))]
    array = vector_to_array("features")
    slots = train.select("label", *[array[i].alias(name) for i, name in enumerate(names)])
    numeric = [name for name, kind in zip(names, kinds) if kind == "numeric"]
    cuts = _cuts(slots, numeric, max_bins)
    slots, binned = _bucketed(slots, {name: cuts[name] for name in numeric if cuts[name]})
    keys = [(F.col(binned[n]) + 1 if n in binned else F.col(n) if n not in cuts else F.lit(1e0)).alias(n) for n in names]
    return slots.select("label", *keys), names, [cuts.get(n, []) for n in names]


def _bucketed(df: DataFrame, cuts: dict[str, Sequence[float]]) -> tuple[DataFrame, dict[str, str]]:
    """The table with the bin of each column, and the names of these; bin k holds the values up to the k-th cut."""
    binned = {name: f"_b{name}" for name in cuts}
    if not binned:
        return df, binned
    # A Bucketizer's bins start at their split, a tree's end with it.
    ends = [[-math.inf, *[math.nextafter(c, math.inf) for c in cuts[name]], math.inf] for name in binned]
    buckets = Bucketizer(splitsArray=ends, inputCols=list(binned), outputCols=list(binned.values()), handleInvalid="keep")
    return buckets.transform(df), binned


def cells_of(train: DataFrame, task: str, max_bins: int) -> tuple[DataFrame, list[list[float]]] | None:
    """Staged cells of equal binned features with their number of rows (``weight``), and the cuts of each slot.

    None if the slots are too many, or not known to be numbers or indicators. The trees of boosting
    see nothing of a row but its bins and its gradient. A squared error's sums of gradients follow
    from the mean label of a cell, so rows with equal bins are one cell; in classification rows with
    equal bins and label are, as they have one gradient. Every split and leaf is that of all rows.
    """
    binned = _binned(train, max_bins, MAX_CELLS)
    if binned is None:
        return None
    rows, names, cuts = binned
    if task == REGRESSION:
        cells = rows.groupBy(*names).agg(F.avg("label").alias("label"), F.count("label").alias("weight"))
    else:
        cells = rows.groupBy(*names, "label").agg(F.count("label").alias("weight"))
    features = array_to_vector(F.array(*names)).alias("features", metadata=train.schema["features"].metadata)
    return stage(cells.select(features, "label", F.col("weight").cast("double").alias("weight"))), cuts


def _drawn(n: int, seed: int, n_keys: int):
    """Partial sums per run of equal keys: weight and sum of labels of its rows in each of ``n`` bootstraps.

    Columns in: the keys, label, copies. A row is drawn by Poisson(1), so equal rows are by their number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed & 0xFFFFFFFF, TaskContext.get().partitionId()])
        for whole in batches:
            for at in range(0, whole.num_rows, max(1, DRAWS // n)):
                batch = whole.slice(at, max(1, DRAWS // n))
                values = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                keys, label, copies = values[:n_keys], values[n_keys], values[n_keys + 1]
                starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
                times = rng.poisson(copies[:, None], (len(label), n)).astype(float)
                sums = [np.add.reduceat(x, starts) for x in (times, times * label[:, None])]
                ends = pa.array(np.arange(len(starts) + 1) * n, pa.int32())
                columns = [pa.array(k[starts]) for k in keys] + [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in sums]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:n_keys], "_w", "_s"])

    return run


def bootstrap_cells(
    train: DataFrame, task: str, n: int, seed: int, max_bins: int
) -> tuple[DataFrame, list[list[float]]] | None:
    """Staged cells as in ``cells_of`` with, for each of ``n`` bootstraps t of all rows, ``w<t>`` and ``s<t>``:
    the number of rows drawn and the sum of their labels. None if there are too many cells, or too few.

    Rows are drawn one by one, or equal ones together, each by Poisson(1) as Spark's forests do.
    """
    binned = _binned(train, max_bins, FOREST_CELLS)
    if binned is None:
        return None
    rows, names, cuts = binned
    keys = names if task == REGRESSION else [*names, "label"]
    counted = rows.groupBy(*names, "label").agg(F.count("label").cast("double").alias("copies"))
    # Dealt by cell and label, a cell of very many rows is spread among tasks.
    dealt = counted.repartitionByRange(*names, "label").sortWithinPartitions(*names, "label")
    dealt = dealt.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "label", "copies")
    schema = ", ".join([*[f"_k{i} double" for i in range(len(keys))], "_w array<double>", "_s array<double>"])
    drawn = dealt.mapInArrow(_drawn(n, seed, len(keys)), schema).toDF(*keys, "_w", "_s")
    sums = [F.sum(F.col(f"_{c}")[t]).alias(f"{c}{t}") for t in range(n) for c in ("w", "s")]
    features = array_to_vector(F.array(*names)).alias("features", metadata=train.schema["features"].metadata)
    totals = [f"{c}{t}" for t in range(n) for c in ("w", "s")]
    cells = stage(drawn.groupBy(*keys).agg(*sums).select(features, *totals))
    # Spark fits no tree to one row if there are indicators.
    sizes = cells.agg(*[F.count_if(F.col(f"w{t}") > 0) for t in range(n)]).first()
    return (cells, cuts) if min(sizes) >= 2 else None


def _model_folder() -> str:
    return f"{shared_folder(SparkSession.active())}/riskframe/model-{uuid.uuid4().hex}"


def _on_columns(kind: type[Model], old: str, cuts: Sequence[Sequence[float]]) -> Model:
    """The model of folder ``old``, fitted on cells, for the columns themselves: thresholds are cuts, and nodes count rows."""
    spark = SparkSession.active()
    new = _model_folder()
    spark.read.text(f"{old}/metadata").write.text(f"{new}/metadata")
    spark.read.parquet(f"{old}/treesMetadata").write.parquet(f"{new}/treesMetadata")
    n = F.col("nodeData")
    split, values, stats = n["split"], n["split"]["leftCategoriesOrThreshold"], n["impurityStats"]
    known = F.array(*[F.array(*map(F.lit, c)).cast("array<double>") for c in cuts])
    cut = F.get(F.get(known, split["featureIndex"]), (F.floor(F.get(values, F.lit(0))) - 1).cast("int"))
    # Of a forest's classifier the statistics are the counts of the classes, else the first one is that of the rows.
    classes = kind.__name__ == "RandomForestClassificationModel"
    rows = F.aggregate(stats, F.lit(0e0), lambda a, b: a + b) if classes else F.get(stats, F.lit(0))
    moved = n.withField("rawCount", F.round(rows).cast("long")).withField(
        "split.leftCategoriesOrThreshold", F.when((split["featureIndex"] >= 0) & (split["numCategories"] == -1), F.array(cut)).otherwise(values)
    )
    nodes = spark.read.parquet(f"{old}/data")
    nodes.withColumn("nodeData", moved).write.parquet(f"{new}/data")
    return kind.load(new)


def _fit_by_cells(
    estimator: RandomForestRegressor | RandomForestClassifier, cells: DataFrame, cuts: Sequence[Sequence[float]], n: int, n_classes: int | None
) -> Model:
    """A forest of ``n`` trees, each fitted by Spark to the cells of its bootstrap (``bootstrap_cells``), several at a time."""
    spark, folder = cells.sparkSession, _model_folder()
    options = {"numTrees": 1, "bootstrap": False, "weightCol": "weight", "cacheNodeIds": False}
    one = estimator.copy({estimator.getParam(k): v for k, v in options.items()})
    about = {"metadata": {"ml_attr": {"type": "nominal", "num_vals": n_classes}}} if n_classes else {}

    def fit(t: int) -> type[Model]:
        label = (F.col(f"s{t}") / F.col(f"w{t}")).alias("label", **about)
        rows = cells.where(F.col(f"w{t}") > 0).select("features", label, F.col(f"w{t}").alias("weight"))
        model = one.copy({one.seed: estimator.getSeed() + t}).fit(rows)
        model.write().save(f"{folder}/tree-{t}")
        return type(model)

    with ThreadPool(min(n, spark.sparkContext.defaultParallelism)) as pool:
        kind = pool.map(inheritable_thread_target(spark)(fit), range(n), chunksize=1)[0]
    number = F.regexp_extract("_metadata.file_path", r"/tree-(\d+)/[^/]+/[^/]+$", 1).cast("int")
    for part in ("treesMetadata", "data"):
        table = spark.read.parquet(f"{folder}/tree-*/{part}")
        table.withColumn(table.columns[0], number).write.parquet(f"{folder}/forest/{part}")
    about = spark.read.text(f"{folder}/tree-0/metadata")
    about.select(F.regexp_replace("value", '"numTrees":1\\b', f'"numTrees":{n}').alias("value")).write.text(f"{folder}/forest/metadata")
    model = _on_columns(kind, f"{folder}/forest", cuts)
    model.set(model.bootstrap, True)
    return model


def fit_boosted(
    train: DataFrame,
    test: DataFrame,
    task: str = REGRESSION,
    n: int = 100,
    depth: int = 6,
    lr: float = 0.1,
    seed: int = 42,
    max_bins: int = 32,
) -> Fitted:
    """Gradient-boosted trees; classification is binary. Few columns are fitted by their cells (``cells_of``)."""
    options = dict(maxIter=n, maxDepth=depth, stepSize=lr, seed=seed, maxBins=max_bins, **BOOSTED_OPTIONS)
    estimator = GBTRegressor(**options) if task == REGRESSION else GBTClassifier(**options)
    kind = "Regressor" if task == REGRESSION else "Classifier"
    cells = cells_of(train, task, max_bins)
    if cells is None:
        model = estimator.fit(train)
    else:
        folder, of_cells = _model_folder(), estimator.setWeightCol("weight").fit(cells[0])
        of_cells.write().save(folder)
        model = _on_columns(type(of_cells), folder, cells[1])
    return _evaluate(f"Boosted Trees {kind}", task, model, train, test)


NODES = [
    "tree", "weight", "node", "left", "right", "feature", "threshold", "categories", "prediction", "stats", "rows",
]


def node_table(model: Model) -> DataFrame:
    """All nodes of a forest or boosted model as a table, written once to the shared folder.

    Columns: tree, weight (of the tree), node (0 is the root), left, right (-1 in leaves), feature,
    threshold (left if not above; NULL for category splits), categories (that go left),
    prediction, stats (class counts of a classifier's node), rows (that reached the node).
    """
    spark = SparkSession.active()
    path = _model_folder()
    model.write().save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata")
    weights = trees.toDF("tree", "_about", "weight").select("tree", "weight")
    n = F.col("nodeData")
    split, values = n["split"], n["split"]["leftCategoriesOrThreshold"]
    continuous = split["numCategories"] == -1
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        split["featureIndex"].alias("feature"), F.when(continuous, F.get(values, F.lit(0))).alias("threshold"),
        F.when(~continuous & (split["numCategories"] > 0), values).alias("categories"), n["prediction"].alias("prediction"),
        n["impurityStats"].alias("stats"), n["rawCount"].alias("rows"),
    )
    # One row per tree.
    return nodes.join(F.broadcast(weights), "tree").select(NODES)


def depth_of(model: Model) -> int:
    """Levels of the deepest tree."""
    return max(t.depth for t in model.trees)


def _positions(nodes: DataFrame) -> dict[int, tuple[list[float], float]] | None:
    """Of each feature that a node splits, its thresholds and its largest category (-1: none); None if there are too many."""
    splits = nodes.where("_left >= 0").groupBy("_feature").agg(
        F.count_distinct("_threshold").alias("n"), F.max(F.array_max("_categories")).alias("category")
    ).limit(MAX_CELLS.bit_length()).collect()
    if not splits or math.prod(r["n"] + (2 if r["category"] is None else 2 + int(r["category"])) for r in splits) > MAX_CELLS:
        return None
    cuts = nodes.where("_left >= 0").groupBy("_feature").agg(F.sort_array(F.collect_set("_threshold")).alias("cuts"))
    known = {r["_feature"]: r["cuts"] for r in cuts.collect()}
    return {r["_feature"]: (known[r["_feature"]], -1.0 if r["category"] is None else r["category"]) for r in splits}


def predict_by_nodes(model: Model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns and ``recomputed``: the prediction found by walking the node table, one join per level.

    Independent of the model object's own code: each row starts at the root of each tree
    and moves to a child until all are in leaves. Rows that no node can tell apart (the thresholds
    give them equal bins) walk as one, if the nodes allow few such cells.
    """
    keep = list(keep)
    nodes = stage(node_table(model)).toDF(*[f"_{c}" for c in NODES])
    known = _positions(nodes)
    array = vector_to_array("features")
    if known is None:
        state = df.select(*keep, F.monotonically_increasing_id().alias("_row"), array.alias("_x"))
        return _walked(model, nodes, state, [*keep, "_row"]).select(*keep, "recomputed")
    names = {f: f"_f{f}" for f in sorted(known)}
    rows = df.select(*keep, *[array[f].alias(name) for f, name in names.items()])
    rows, binned = _bucketed(rows, {names[f]: cuts for f, (cuts, category) in known.items() if category < 0})
    keys = [binned.get(name, name) for name in names.values()]
    # All rows of a cell are on one side of every threshold, and so is the largest value of each column.
    cells = rows.groupBy(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)]).agg(*[F.max(n).alias(n) for n in names.values()])
    cells = stage(cells.select(*[f"_c{i}" for i in range(len(keys))], F.array(*names.values()).alias("_x")))
    place = F.array_position(F.array(*map(F.lit, names)), F.col("_feature")) - 1
    found = stage(_walked(model, nodes.withColumn("_feature", place.cast("int")), cells, [f"_c{i}" for i in range(len(keys))]))
    same = [F.col(k) == F.col(f"_c{i}") for i, k in enumerate(keys)]
    return rows.join(small_side(found), same).select(*keep, "recomputed")


def _walked(model: Model, nodes: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys and ``recomputed`` of rows with the values ``_x``, which the keys tell apart.

    The node table is broadcast after its size is known; rows are never shuffled then but for the
    sum over the trees.
    """
    steps = small_side(nodes.where("_left >= 0").select("_tree", "_node", "_left", "_right", "_feature", "_threshold", "_categories"))
    roots = [r[0] for r in nodes.select("_tree").distinct().collect()]
    x = F.element_at("_x", F.col("_feature") + 1)
    goes_left = F.when(F.col("_categories").isNull(), x <= F.col("_threshold")).otherwise(F.array_contains("_categories", x))
    state = rows.withColumn("_tree", F.explode(F.array(*map(F.lit, roots)))).withColumn("_node", F.lit(0))
    for _ in range(depth_of(model)):
        moved = state.join(steps, ["_tree", "_node"], "left")
        child = F.when(goes_left, F.col("_left")).otherwise(F.col("_right"))
        state = moved.select(*keys, "_x", "_tree", F.when(F.col("_left").isNull(), F.col("_node")).otherwise(child).alias("_node"))
    leaves = small_side(nodes.where("_left < 0").select("_tree", "_node", "_weight", "_prediction", "_stats"))
    ended = state.join(leaves, ["_tree", "_node"])
    name = type(model).__name__
    if name == "RandomForestClassificationModel":
        share = F.transform("_stats", lambda s: s / F.aggregate("_stats", F.lit(0e0), lambda a, b: a + b))
        sums = [F.sum(share[1]).alias("_one"), F.sum(share[0]).alias("_zero")]
        found = F.when(F.col("_one") > F.col("_zero"), 1e0).otherwise(0e0)
    else:
        sums = [F.sum(F.col("_prediction") * F.col("_weight")).alias("_total"), F.sum("_weight").alias("_weights")]
        if name == "GBTClassificationModel":
            found = F.when(F.col("_total") > 0, 1e0).otherwise(0e0)
        else:
            found = F.col("_total") if "GBT" in name else F.col("_total") / F.col("_weights")
    return ended.groupBy(*keys).agg(*sums).select(*keys, found.alias("recomputed"))


def compare_models(results: Sequence[Fitted]) -> DataFrame:
    """Metrics of all models, with ``best`` marking the best test metric (R2 or F1)."""
    metric = SELECTION_METRIC[results[0].task]
    rows = reduce(DataFrame.unionByName, [r.metrics for r in results])
    # Two rows per model.
    rows = rows.sparkSession.createDataFrame(rows.collect(), rows.schema)
    best = rows.where(F.col("side") == "test").orderBy(F.col(metric).desc_nulls_last(), "model").limit(1)
    winner = best.select(F.col("model").alias("_best"))
    return rows.crossJoin(F.broadcast(winner)).withColumn("best", F.col("model") == F.col("_best")).drop("_best")


def best_model(results: Sequence[Fitted], comparison: DataFrame | None = None) -> Fitted:
    comparison = compare_models(results) if comparison is None else comparison
    name = comparison.where("best").select("model").first()[0]
    return next(r for r in results if r.name == name)


def feature_importance(
    df: DataFrame, model: Model, names: Sequence[str] | None = None, top_n: int | None = 20
) -> DataFrame:
    """(feature, importance), largest first: tree importances, or |coefficient| for a linear model.

    ``df`` is a table with the ``features`` column, for the slot names and the session.
    """
    names = list(names) if names else feature_names(df)
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        values = abs(model.coefficients.toArray())
    else:
        raise ValueError("Model has neither feature importances nor coefficients")
    rows = [(str(f), float(v)) for f, v in zip(names, values)]
    ranked = df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )
    return ranked if top_n is None else ranked.limit(top_n)


def numeric_vectors(df: DataFrame, nums: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, features, label) from numeric columns; rows with a missing value are dropped."""
    rows = df.select(*keep, *[clean(F.col(c)).alias(c) for c in [*nums, target]]).dropna(subset=[*nums, target])
    table, _ = assemble(rows, [], nums, target, keep)
    return table
