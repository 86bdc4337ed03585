"""Engineered features, encodings, imputation and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import schema as catalog
from riskframe.functions.columns import (
    BAND_LABELS,
    band_ordinal,
    has_claim,
    premium_to_sum_insured,
    row_loss_ratio,
    value_band,
    vehicle_age,
)
from riskframe.operators.ordering import BROADCAST_ROWS, clean, exact_quantiles, small_side
from riskframe.sources.tables import stage

IDS = ["PolicyID", "UnderwrittenCoverID"]

# Columns an engineered feature is computed from.
DERIVED_FROM = {
    "HasClaim": {"TotalClaims"},
    "LossRatio": {"TotalClaims", "TotalPremium"},
    "PremiumToSumInsuredRatio": {"TotalPremium", "SumInsured"},
    "PremiumCategory": {"TotalPremium"},
    "VehicleAge": {"RegistrationYear"},
    "VehicleValueCategory": {"CustomValueEstimate"},
}


def quantile_band(
    df: DataFrame,
    col: str,
    out: str,
    q: int = 4,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Add the equal-frequency band of a column, as ``out`` and ``out + 'Ordinal'``.

    Bands are right-closed and the lowest value is included. Equal quantiles merge, and
    the remaining bands take the first labels.
    """
    names = list(labels) if labels else (BAND_LABELS if q == 4 else [f"Q{i}" for i in range(1, q + 1)])
    probs = [i / q for i in range(q + 1)]
    edges = exact_quantiles(df, [col], probs).agg(
        F.array_distinct(F.max("quantiles")).alias("_edges")
    )
    value = clean(F.col(col))
    inner = F.slice(F.col("_edges"), 1, F.greatest(F.size("_edges") - 1, F.lit(1)))
    below = F.size(F.filter(inner, lambda e: e < value))
    ordinal = F.when(value.isNotNull(), F.greatest(below, F.lit(1)))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), ordinal)
    return (
        df.crossJoin(F.broadcast(edges))
        .withColumn(f"{out}Ordinal", ordinal)
        .withColumn(out, F.when(F.col(f"{out}Ordinal").isNotNull(), label))
        .drop("_edges")
    )


def engineer_features(df: DataFrame, as_of_year: int) -> DataFrame:
    """Add every feature whose inputs exist."""
    have = set(df.columns)
    features: dict[str, Column] = {}
    if "RegistrationYear" in have:
        features["VehicleAge"] = vehicle_age(as_of_year)
    if "TotalClaims" in have:
        features["HasClaim"] = has_claim()
    if {"TotalPremium", "SumInsured"} <= have:
        features["PremiumToSumInsuredRatio"] = premium_to_sum_insured()
    if {"TotalPremium", "TotalClaims"} <= have:
        features["LossRatio"] = row_loss_ratio()
    if "CustomValueEstimate" in have:
        features["VehicleValueCategory"] = value_band()
        features["VehicleValueOrdinal"] = band_ordinal(value_band())
    out = df.withColumns(features) if features else df
    if "TotalPremium" in have:
        out = quantile_band(out, "TotalPremium", "PremiumCategory").withColumnRenamed(
            "PremiumCategoryOrdinal", "PremiumOrdinal"
        )
    return out


ORDINALS = {"VehicleValueOrdinal": "VehicleValueCategory", "PremiumOrdinal": "PremiumCategory"}


def leaking_columns(target: str, also: Sequence[str] = ()) -> set[str]:
    """The target, and every engineered column computed from it or from a hidden column."""
    sources = {target, *also} | DERIVED_FROM.get(target, set()) & {"TotalClaims"}
    hidden = {c for c, inputs in DERIVED_FROM.items() if inputs & sources}
    hidden |= {o for o, band in ORDINALS.items() if band in hidden}
    return sources | hidden


def feature_frame(
    df: DataFrame,
    target: str,
    exclude: Sequence[str] | None = None,
    cats: Sequence[str] | None = None,
    nums: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, list[str], list[str]]:
    """(table of features, target and kept columns; categorical names; numeric names).

    The target never is a feature, nor is a column derived from it. The ordinal twins of
    band labels count as features only when asked for by name.
    """
    hidden = leaking_columns(target) | set(IDS if exclude is None else exclude)
    candidates = [c for c in df.columns if c not in hidden and c not in keep]
    table = df.select(candidates)
    if cats is None:
        cats = catalog.select_by_kind(table, "categorical")
    if nums is None:
        nums = [c for c in catalog.select_by_kind(table, "numeric") if c not in ORDINALS]
    cats = [c for c in cats if c in candidates]
    nums = [c for c in nums if c in candidates]
    return df.select(*keep, *cats, *nums, target), cats, nums


def _text_cells(df: DataFrame, cols: Sequence[str], missing: str | None = None) -> DataFrame:
    """(measure, value) with one row per cell; values as text."""
    def text(c: str) -> Column:
        value = F.col(c).cast("string")
        return value if missing is None else F.coalesce(value, F.lit(missing))

    cells = F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), text(c))])
    return df.select(cells.alias("measure", "value"))


def categories(df: DataFrame, cols: Sequence[str], limit: int | None = None) -> dict[str, list]:
    """Sorted categories per column, a missing value last. One scan for all columns.

    One-hot encoding makes a column per category. A caller who can't use a wide table sets
    ``limit``; more categories in one column are then an error. The vectors of the model
    pipelines and ``label_encode`` need no column per category.
    """
    found = _text_cells(df, cols).distinct()
    if limit is not None:
        found = found.limit(limit * len(cols) + 1)
    out: dict[str, list] = {c: [] for c in cols}
    for measure, value in found.collect():
        out[measure].append(value)
    for c, values in out.items():
        if limit is not None and len(values) > limit:
            raise ValueError(f"Too many categories for one-hot columns (limit {limit}), e.g. '{c}'")
        values.sort(key=lambda v: (v is None, v))
    return out


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    fitted: dict[str, list] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Replace columns by 0/1 columns ``<column>_<category>``, the first category dropped.

    A missing value is its own, last category (``nan``). With ``fitted`` categories an
    unseen value gives zeros.
    """
    fitted = fitted or categories(df, cols, limit)
    new = []
    for c in cols:
        text = F.col(c).cast("string")
        for v in fitted[c][1:]:
            hit = text.isNull() if v is None else F.coalesce(text == F.lit(v), F.lit(False))
            new.append(F.when(hit, 1.0).otherwise(0.0).alias(f"{c}_{'nan' if v is None else v}"))
    return df.select(*[c for c in df.columns if c not in cols], *new)


LABEL_BUCKETS = 200


def label_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Dictionary (measure, value, code): rank from 0 of each distinct text per column.

    Texts are spread over buckets by cut points, drawn from a hash sample of the distinct
    texts, so no task orders a whole dictionary; bucket totals make the ranks exact.
    """
    words = stage(_text_cells(df, cols, "nan").distinct())
    total = words.count()
    keep_one_in = max(1, total // (LABEL_BUCKETS * 20))
    drawn = words.where(F.pmod(F.xxhash64("measure", "value"), F.lit(keep_one_in)) == 0)
    texts = sorted(r[0] for r in drawn.select("value").distinct().collect())
    step = max(1, len(texts) // LABEL_BUCKETS)
    cuts = F.array(*[F.lit(t) for t in texts[step::step]] or [F.lit("")])
    placed = words.withColumn("bucket", F.size(F.filter(cuts, lambda c: c <= F.col("value"))))
    per_column = Window.partitionBy("measure").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sizes = placed.groupBy("measure", "bucket").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select(
        "measure", "bucket", (F.sum("size").over(per_column) - F.col("size")).alias("start")
    )
    inside = Window.partitionBy("measure", "bucket").orderBy("value")
    # At most LABEL_BUCKETS + 1 rows per column.
    return placed.join(F.broadcast(starts), ["measure", "bucket"]).select(
        "measure",
        "value",
        (F.col("start") + F.row_number().over(inside) - 1).cast("bigint").alias("code"),
    )


def label_encode(df: DataFrame, cols: Sequence[str], hot: int = BROADCAST_ROWS) -> DataFrame:
    """Replace columns by the rank of their text; a missing value is the text ``nan``.

    The ``hot`` most frequent texts of all columns together are looked up where the rows
    are. Only if there are more, the rows are numbered and written once, and their other
    cells, of any number of columns, are looked up in one join and come back in another;
    none of those texts is frequent, so no key is crowded.
    """
    codes = stage(label_codes(df, cols))
    if codes.count() <= hot:
        return _looked_up(df, cols, codes)
    counts = _text_cells(df, cols, "nan").groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = stage(codes.join(counts, ["measure", "value"]))
    first = ranked.orderBy(F.col("n").desc(), "measure", "value").limit(hot).select("measure", "value", "code")
    # The codes found go next to the texts, which the other cells still need.
    texts = {f"_t{i}": F.coalesce(F.col(c).cast("string"), F.lit("nan")) for i, c in enumerate(cols)}
    numbered = df.withColumns({**texts, "_row": F.monotonically_increasing_id()})
    looked = stage(_looked_up(numbered, cols, first))
    cells = F.stack(F.lit(len(cols)), *[x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"_t{i}"), F.col(c))])
    open_cells = looked.select("_row", cells.alias("measure", "value", "found")).where(F.col("found").isNull())
    found = open_cells.join(codes, ["measure", "value"]).groupBy("_row").agg(
        *[F.max(F.when(F.col("measure") == c, F.col("code"))).alias(f"_c{i}") for i, c in enumerate(cols)]
    )
    whole = looked.join(found, "_row", "left")
    return whole.withColumns({c: F.coalesce(F.col(c), F.col(f"_c{i}")) for i, c in enumerate(cols)}).select(df.columns)


def _looked_up(df: DataFrame, cols: Sequence[str], codes: DataFrame) -> DataFrame:
    """Codes in place of texts, from a small table; a text that it lacks becomes NULL."""
    out = df
    for i, c in enumerate(cols):
        lookup = codes.where(F.col("measure") == c).select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_code{i}"))
        text = F.coalesce(F.col(c).cast("string"), F.lit("nan"))
        out = out.join(F.broadcast(lookup), text == F.col(f"_v{i}"), "left").withColumn(c, F.col(f"_code{i}"))
        out = out.drop(f"_v{i}", f"_code{i}")
    return out


def fit_imputer(
    df: DataFrame,
    numeric: str = "median",
    categorical: str = "most_frequent",
    fill_value: str = "missing_value",
) -> dict[str, object]:
    """Fill value per column; a column without values has none.

    Numeric: ``median`` (exact), ``mean`` or ``most_frequent``. Categorical:
    ``most_frequent`` or ``constant``. The smallest value wins a tie.
    """
    nums = catalog.select_by_kind(df, "numeric")
    cats = catalog.select_by_kind(df, "categorical")
    fills: dict[str, object] = {}
    if nums and numeric == "median":
        rows = exact_quantiles(df, nums, [0.5]).collect()
        fills |= {r.measure: r.quantiles[0] for r in rows}
    elif nums and numeric == "mean":
        means = df.agg(*[F.avg(clean(F.col(c))).alias(c) for c in nums]).first().asDict()
        fills |= {c: m for c, m in means.items() if m is not None}
    elif nums and numeric == "most_frequent":
        fills |= _most_frequent(df, nums, "double")
    elif nums:
        raise ValueError(f"Unknown numeric strategy: {numeric}")
    if cats and categorical == "most_frequent":
        fills |= _most_frequent(df, cats, "string")
    elif cats and categorical == "constant":
        fills |= {c: fill_value for c in cats}
    elif cats:
        raise ValueError(f"Unknown categorical strategy: {categorical}")
    return fills


def _most_frequent(df: DataFrame, cols: Sequence[str], kind: str) -> dict[str, object]:
    cells = F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(c).cast(kind))])
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("best")
    rows = (
        df.select(cells.alias("measure", "value"))
        .where(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("measure")
        .agg(best)
        .collect()
    )
    return {r.measure: r.best.value for r in rows}


def impute(
    df: DataFrame,
    numeric: str = "median",
    categorical: str = "most_frequent",
    fills: dict[str, object] | None = None,
) -> DataFrame:
    """Fill missing cells; ``fills`` from ``fit_imputer`` on another table may be given."""
    fills = fit_imputer(df, numeric, categorical) if fills is None else fills
    numbers = set(catalog.select_by_kind(df, "numeric"))
    filled = {
        c: F.coalesce(clean(F.col(c)) if c in numbers else F.col(c), F.lit(v))
        for c, v in fills.items()
        if c in df.columns
    }
    return df.withColumns(filled) if filled else df


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """md5 text of the keys and the seed."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))).cast("binary"))


def hash_split(
    df: DataFrame, keys: Sequence[str], test: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Mark about a share ``test`` of the keys as test rows: repeatable, without a shuffle."""
    head = F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("double")
    return df.withColumn(out, head / F.lit(float(2**32)) < F.lit(float(test)))


#: Hex digits by which the cut of a class is narrowed at a time, and rows ordered at the end, about.
HASH_STEP, HASH_LENGTH, ORDERED_ROWS = 3, 32, 100_000


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    test: float = 0.2,
    seed: int = 42,
    out: str = "is_test",
    ordered_rows: int = ORDERED_ROWS,
) -> DataFrame:
    """Mark round(test * n) rows of each class as test rows, those with the smallest hashes.

    Rows with the same key stay together, so a class may get more rows by the copies of
    its last key. Counts per hash prefix show the prefix at which a class is cut; only its
    rows are counted by a longer one, until at most ``ordered_rows`` of a class (or one
    hash) are left to be ordered.
    """
    hashed = key_hash(keys, seed)
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("_label"), hashed.alias("_hash"))
    group = Window.partitionBy("_label")
    cut = None
    for length in range(HASH_STEP, HASH_LENGTH + 1, HASH_STEP):
        left = rows if cut is None else rows.join(cut, ["_label"]).where(F.col("_hash").startswith(F.col("_prefix")))
        known = [] if cut is None else [F.max("_start").alias("_base"), F.max("_want").alias("_want")]
        sizes = left.groupBy("_label", F.substring("_hash", 1, length).alias("_at")).agg(F.count(F.lit(1)).alias("_size"), *known)
        if cut is None:
            sizes = sizes.withColumn("_base", F.lit(0).cast("long"))
            sizes = sizes.withColumn("_want", F.floor(F.sum("_size").over(group) * F.lit(float(test)) + 0.5))
        running = group.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        stop = F.col("_base") + F.sum("_size").over(running)
        placed = sizes.select("_label", F.col("_at").alias("_prefix"), (stop - F.col("_size")).alias("_start"), stop.alias("_stop"), "_want")
        # One row per class.
        cut = small_side(placed.where((F.col("_want") > F.col("_start")) & (F.col("_want") <= F.col("_stop"))))
        if cut.where(F.col("_stop") - F.col("_start") > ordered_rows).isEmpty():
            break
        cut = cut.drop("_stop")
    copies = (
        rows.join(cut.select("_label", "_prefix", "_start", "_want"), "_label")
        .where(F.col("_hash").startswith(F.col("_prefix")))
        .groupBy("_label", "_start", "_want", "_hash")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = Window.partitionBy("_label").orderBy("_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The last test hash of each class: one row per class.
    last = (
        copies.withColumn("_upto", F.col("_start") + F.sum("_n").over(upto))
        .where(F.col("_upto") >= F.col("_want"))
        .groupBy("_label")
        .agg(F.min("_hash").alias("_last"))
    )
    marked = df.join(small_side(last), F.col(label) == F.col("_label"), "left")
    return marked.withColumn(out, F.coalesce(hashed <= F.col("_last"), F.lit(False))).drop(
        "_label", "_last"
    )


def category_support(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per one-hot feature: (feature, n), a missing value as ``nan``."""
    return (
        _text_cells(df, cols, "nan")
        .groupBy(F.concat_ws("_", "measure", "value").alias("feature"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
