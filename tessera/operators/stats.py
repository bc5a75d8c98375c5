"""Feature statistics against a label (A1-A16), as aggregations.

Every test first turns the wide feature table into a long
``(feature, x, y)`` stream with ``unpivot``; Spark fuses the unpivot with the
partial aggregate, so the long form is never materialised and only per-task
partial rows are shuffled. Reports have one row per feature.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import jvmstats
from ..session import cut_lineage
from .ranking import average_ranks, exact_median
from .util import attach_scalar

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)

# Fixed values used by the reports.
MIN_PAIRS = 10              # fewer usable pairs → feature skipped
ANOVA_MIN_VAR = 1e-10       # groups with population variance at or below are dropped
CATEGORICAL_LABEL_MAX = 20  # label with at most this many values is categorical
MISSING_CATEGORY = "__missing__"


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def to_long(df: DataFrame, features: Sequence[str], label: str | None = None,
            value_type: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``features`` into ``(keep…, label as y, feature, x)``."""
    ids = list(keep) + ([label] if label else [])
    sel = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in features])
    out = sel.unpivot(ids, list(features), "feature", "x")
    return out.withColumnRenamed(label, "y") if label else out


# ---------------------------------------------------------------- A1 missingness

def missingness_report(splits: Mapping[str, DataFrame]) -> DataFrame:
    """A1: null counts and rates per column for each split, sorted by the first split's nulls.

    One aggregation pass per split; columns are those of the first split.
    """
    names = list(splits)
    first = splits[names[0]]
    columns = first.columns
    out = None
    for name in names:
        df = splits[name]
        have = [c for c in columns if c in df.columns]
        row = df.agg(F.count(F.lit(1)).alias("__rows"),
                     *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in have],
                     *[F.lit(0).cast("long").alias(c) for c in columns if c not in have])
        long = row.unpivot(["__rows"], columns, "column", f"{name}_missing").select(
            "column", F.col(f"{name}_missing").cast("long").alias(f"{name}_missing"),
            F.when(F.col("__rows") > 0, F.col(f"{name}_missing") / F.col("__rows"))
             .otherwise(F.lit(0.0)).alias(f"{name}_pct"))
        out = long if out is None else out.join(long, "column")
    ordered = (["column"] + [f"{n}_missing" for n in names] + [f"{n}_pct" for n in names])
    return out.select(*ordered).orderBy(F.col(f"{names[0]}_missing").desc(), "column")


def missingness_by_split(df: DataFrame, names: Sequence[str], split: str = "split") -> DataFrame:
    """A1 over one table with a split column: the report of :func:`missingness_report` from a single aggregation."""
    columns = [c for c in df.columns if c != split]
    counts = df.where(F.col(split).isin(*names)).groupBy(split).agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    long = counts.unpivot([split, "__rows"], columns, "column", "__missing")
    of = lambda n, c: F.coalesce(F.max(F.when(F.col(split) == n, F.col(c))), F.lit(0))
    wide = long.groupBy("column").agg(*[of(n, "__missing").cast("long").alias(f"{n}_missing") for n in names], *[of(n, "__rows").alias(f"__{n}_rows") for n in names])
    rates = [F.when(F.col(f"__{n}_rows") > 0, F.col(f"{n}_missing") / F.col(f"__{n}_rows")).otherwise(F.lit(0.0)).alias(f"{n}_pct") for n in names]
    return wide.select("column", *[f"{n}_missing" for n in names], *rates).orderBy(F.col(f"{names[0]}_missing").desc(), "column")


def all_null_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P2 helper: columns whose every value is null (one pass)."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in columns])
    return (row.unpivot(["__rows"], list(columns), "column", "non_null")
            .where(F.col("non_null") == 0).select("column"))


# ---------------------------------------------------------------- A2-A5 imputation

def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2: exact interpolated median per numeric column, nulls ignored → (column, median)."""
    long = to_long(df, columns).withColumnRenamed("feature", "column")
    med = exact_median(long, "column", "x")
    cols = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return cols.join(med, "column", "left")


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A3: most frequent value per string column; ties → smallest value; none → ``__missing__``."""
    long = to_long(df, columns, value_type="string").withColumnRenamed("feature", "column")
    counts = long.where(F.col("x").isNotNull()).groupBy("column", "x").count()
    top = counts.groupBy("column").agg(F.max("count").alias("count"))
    mode = counts.join(top, ["column", "count"]).groupBy("column").agg(F.min("x").alias("mode"))
    cols = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return cols.join(mode, "column", "left").select(
        "column", F.coalesce("mode", F.lit(MISSING_CATEGORY)).alias("mode"))


def fit_imputation(train: DataFrame, id_cols: Sequence[str] = ("id",),
                   embedding_cols: Sequence[str] = ()) -> dict:
    """A4/A5 fit: medians and modes on the training split only, all-null columns dropped.

    Returns the imputation spec (a small dict bounded by the number of columns).
    """
    feats = [c for c in train.columns if c not in id_cols]
    dropped = [r["column"] for r in all_null_columns(train, feats).collect()]
    feats = [c for c in feats if c not in dropped]
    kept = train.select(*feats)
    num = numeric_columns(kept)
    cat = [c for c in feats if c not in num and c not in embedding_cols]
    med = {r["column"]: r["median"] for r in column_medians(train, num).collect()} if num else {}
    mode = {r["column"]: r["mode"] for r in column_modes(train, cat).collect()} if cat else {}
    return {
        "numeric_impute_values": {c: (float(med[c]) if med.get(c) is not None else 0.0) for c in num},
        "categorical_impute_values": {c: str(mode[c]) for c in cat},
        "dropped_all_missing_cols": dropped,
        "id_cols": list(id_cols),
        "embedding_cols": list(embedding_cols),
    }


def apply_imputation(df: DataFrame, spec: Mapping) -> DataFrame:
    """A4 apply: numerics → double filled with the median, strings filled with the mode,
    leftovers 0.0 / ``__missing__``, all-null columns dropped, id columns first."""
    num = spec["numeric_impute_values"]
    cat = spec["categorical_impute_values"]
    ids = [c for c in spec.get("id_cols", []) if c in df.columns]
    drop = set(spec.get("dropped_all_missing_cols", []))
    cols = []
    for c in df.columns:
        if c in drop:
            continue
        if c in num:
            cols.append(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(num[c]))).alias(c))
        elif c in cat:
            cols.append(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(str(cat[c]))).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    out = df.select(*cols)
    return out.select(*ids, *[c for c in out.columns if c not in ids])


# ---------------------------------------------------------------- A6-A8 correlations

def correlation_stats(df: DataFrame, features: Sequence[str], label: str, checkpoint: bool = True) -> DataFrame:
    """Pearson r and Spearman rho (average ranks) of each feature vs the label.

    Pairs with a null on either side are dropped. Features with fewer than
    ``MIN_PAIRS`` pairs or a constant side are skipped. Pearson is one aggregate with partial sums in the
    tasks (a row a feature is shuffled). Ranks need the distinct ``(feature, x, y)`` counts, written once into the
    shared folder; Spearman is a weighted Pearson of their average ranks. Output: feature, n, pearson_r, spearman_r.
    """
    long = to_long(df, features, label).where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("y", F.col("y").cast("double"))
    mom = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("pearson_r"),
        F.min("x").alias("__xmin"), F.max("x").alias("__xmax"), F.min("y").alias("__ymin"), F.max("y").alias("__ymax"))
    mom = mom.where((F.col("n") >= MIN_PAIRS) & (F.col("__xmin") < F.col("__xmax"))
                    & (F.col("__ymin") < F.col("__ymax")))
    if checkpoint:
        mom = cut_lineage(mom)                       # one row per feature: bounded by the schema
    pear = mom.select("feature", "n", "pearson_r")
    pairs = long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("w"))
    if checkpoint:
        pairs = cut_lineage(pairs)
    w = F.col("w")

    rx = average_ranks(pairs, ["feature"], "x", "w").select("feature", "x", F.col("rank").alias("rx"))
    ry = average_ranks(pairs, ["feature"], "y", "w").select("feature", "y", F.col("rank").alias("ry"))
    ranked = pairs.join(rx, ["feature", "x"]).join(ry, ["feature", "y"])
    # mean of average ranks over n rows is (n+1)/2 exactly → centred sums are stable
    tot = ranked.join(F.broadcast(mom.select("feature", "n")), "feature")
    mid = (F.col("n") + 1) / 2.0
    rdx, rdy = F.col("rx") - mid, F.col("ry") - mid
    spear = tot.groupBy("feature").agg(
        (F.sum(w * rdx * rdy) / F.sqrt(F.sum(w * rdx * rdx) * F.sum(w * rdy * rdy))).alias("spearman_r"))
    return pear.join(spear, "feature", "left").select("feature", F.col("n").cast("long").alias("n"),
                                                      "pearson_r", "spearman_r")


def correlation_report(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Statistics plus two-sided p-values, sorted by |pearson_r| desc."""
    spark = df.sparkSession
    rows = correlation_stats(df, features, label).collect()  # one row per feature
    out = [(r["feature"], int(r["n"]), float(r["pearson_r"]), jvmstats.pearson_p(spark, r["pearson_r"], r["n"]),
            float(r["spearman_r"]), jvmstats.pearson_p(spark, r["spearman_r"], r["n"]))
           for r in rows if r["pearson_r"] is not None and r["spearman_r"] is not None]
    rep = spark.createDataFrame(out, "feature string, n long, pearson_r double, pearson_p double, "
                                     "spearman_r double, spearman_p double")
    return rep.orderBy(F.abs("pearson_r").desc(), "feature")


# ---------------------------------------------------------------- A9-A11 chi-square

def contingency(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Long contingency table (feature, x, y, count); nulls are a category only if imputed."""
    long = to_long(df, features, label, value_type="string")
    return long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("count"))


def chi_square_stats(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """χ², dof, n and Cramér's V per categorical feature (Yates when dof = 1).

    Computed over observed cells only (no category × label grid):
    χ² = n·(Σ o²/(R·C) − 1); for 2×2 with Yates
    χ² = n·max(0, |ad − bc| − n/2)² / (R1·R2·C1·C2).
    Rows with a null category or label take no part in any total.
    """
    # the table is built once: its totals, sizes and cells read what was written
    ct = cut_lineage(contingency(df, features, label).where(F.col("x").isNotNull() & F.col("y").isNotNull()))
    rows = ct.groupBy("feature", "x").agg(F.sum("count").alias("row_total"))
    cols = ct.groupBy("feature", "y").agg(F.sum("count").alias("col_total"))
    dims = ct.groupBy("feature").agg(
        F.sum("count").alias("n"), F.countDistinct("x").alias("r"), F.countDistinct("y").alias("k"),
        F.min("x").alias("__x0"), F.min("y").alias("__y0"))
    # dimensions are a row a feature (bounded by the schema); a label may have any number of values
    cell = ct.join(rows, ["feature", "x"]).join(cols, ["feature", "y"]).join(F.broadcast(dims), "feature")
    agg = cell.groupBy("feature", "n", "r", "k").agg(
        F.sum(F.col("count") * F.col("count") / (F.col("row_total") * F.col("col_total"))).alias("__s"),
        # 2×2 cells: a = (x0, y0), d = (x1, y1), b/c the off-diagonal ones
        F.sum(F.when((F.col("x") == F.col("__x0")) & (F.col("y") == F.col("__y0")), F.col("count"))
              .otherwise(0)).alias("__a"),
        F.sum(F.when((F.col("x") != F.col("__x0")) & (F.col("y") != F.col("__y0")), F.col("count"))
              .otherwise(0)).alias("__d"),
        F.sum(F.when((F.col("x") == F.col("__x0")) & (F.col("y") != F.col("__y0")), F.col("count"))
              .otherwise(0)).alias("__b"),
        F.sum(F.when((F.col("x") != F.col("__x0")) & (F.col("y") == F.col("__y0")), F.col("count"))
              .otherwise(0)).alias("__c"),
        F.max(F.when(F.col("x") == F.col("__x0"), F.col("row_total"))).alias("__r1"),
        F.max(F.when(F.col("x") != F.col("__x0"), F.col("row_total"))).alias("__r2"),
        F.max(F.when(F.col("y") == F.col("__y0"), F.col("col_total"))).alias("__c1"),
        F.max(F.when(F.col("y") != F.col("__y0"), F.col("col_total"))).alias("__c2"))
    dof = (F.col("r") - 1) * (F.col("k") - 1)
    n = F.col("n").cast("double")
    yates = (n * F.pow(F.greatest(F.lit(0.0), F.abs(F.col("__a") * F.col("__d") - F.col("__b") * F.col("__c"))
                                  - n / 2.0), 2)
             / (F.col("__r1").cast("double") * F.col("__r2") * F.col("__c1") * F.col("__c2")))
    chi2 = F.when(dof == 1, yates).otherwise(F.greatest(F.lit(0.0), n * (F.col("__s") - 1.0)))
    out = agg.where((F.col("r") >= 2) & (F.col("k") >= 2)).select(
        "feature", chi2.alias("chi2"), dof.cast("long").alias("dof"), F.col("n").cast("long").alias("n"),
        F.least(F.col("r"), F.col("k")).alias("__m"))
    return out.select("feature", "chi2", "dof",
                      F.sqrt(F.col("chi2") / (F.col("n") * (F.col("__m") - 1))).alias("cramers_v"), "n")


def chi_square_report(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """A10/A11 with p-values; sorted by Cramér's V desc."""
    spark = df.sparkSession
    rows = chi_square_stats(df, features, label).collect()
    out = [(r["feature"], float(r["chi2"]), jvmstats.chi2_sf(spark, r["chi2"], r["dof"]), int(r["dof"]),
            float(r["cramers_v"]), int(r["n"])) for r in rows]
    rep = spark.createDataFrame(out, "feature string, chi2 double, p_value double, dof long, "
                                     "cramers_v double, n long")
    return rep.orderBy(F.col("cramers_v").desc(), "feature")


def cramers_v(chi2: float, n: int, r: int, k: int) -> float:
    """A11 formula (scalar)."""
    m = min(r, k)
    return float("nan") if m <= 1 else (chi2 / (n * (m - 1))) ** 0.5


# ---------------------------------------------------------------- A12 ANOVA

def group_moments(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Per (feature, label group): n, mean, population variance (non-null x)."""
    long = to_long(df, features, label).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return long.groupBy("feature", "y").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var"))


def anova_stats(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F per feature over label groups.

    Groups with ≤1 row or variance ≤ 1e-10 are dropped; at least two groups
    must remain. Output: feature, F, df_between, df_within.
    """
    g = cut_lineage(group_moments(df, features, label).where((F.col("n") > 1) & (F.col("var") > ANOVA_MIN_VAR)))
    per = g.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("__grand"),
        F.sum(F.col("n") * F.col("var")).alias("ssw"))
    ssb = g.join(per, "feature").groupBy("feature").agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("__grand"), 2)).alias("ssb"))
    out = per.join(ssb, "feature").where(F.col("k") >= 2)
    f = (F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("n_total") - F.col("k")))
    return out.select("feature", f.alias("F"), (F.col("k") - 1).cast("long").alias("df_between"),
                      (F.col("n_total") - F.col("k")).cast("long").alias("df_within")) \
        .where(~F.isnan("F") & F.col("F").isNotNull() & (F.abs("F") != float("inf")))


def anova_report(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """A12 with p-values, sorted by p ascending."""
    spark = df.sparkSession
    rows = anova_stats(df, features, label).collect()
    out = []
    for r in rows:
        p = jvmstats.f_sf(spark, r["F"], r["df_between"], r["df_within"])
        if p == p:  # finite
            out.append((r["feature"], float(r["F"]), float(p)))
    return spark.createDataFrame(out, "feature string, F double, p_value double").orderBy("p_value", F.col("F").desc(), "feature")


# ---------------------------------------------------------------- A13 Tukey HSD

def tukey_hsd(df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.05) -> DataFrame:
    """Tukey HSD pairwise comparisons of label groups for each feature.

    Group moments come from one aggregation. A label with more than ``CATEGORICAL_LABEL_MAX`` values is no category
    and raises, so the driver holds at most that many moments, and 190 pairs, per feature.
    Output: group1, group2, meandiff, p-adj, lower, upper, reject, feature.
    """
    spark = df.sparkSession
    levels = df.select(label).where(F.col(label).isNotNull()).distinct().limit(CATEGORICAL_LABEL_MAX + 1).count()
    if levels > CATEGORICAL_LABEL_MAX:
        raise ValueError(f"{label} has more than {CATEGORICAL_LABEL_MAX} values: no groups to compare")
    mom = group_moments(df, features, label).collect()
    by_feat: dict[str, list] = {}
    for r in mom:
        by_feat.setdefault(r["feature"], []).append(r)
    out = []
    for feat in features:
        groups = sorted(by_feat.get(feat, []), key=lambda r: r["y"])
        k = len(groups)
        big_n = sum(r["n"] for r in groups)
        if k < 2 or big_n < MIN_PAIRS or big_n - k <= 0:
            continue
        dfw = big_n - k
        mse = sum(r["n"] * r["var"] for r in groups) / dfw
        if k == 2:
            crit = (2 ** 0.5) * jvmstats.t_quantile(spark, 1 - alpha / 2, dfw)
        else:
            crit = jvmstats.studentized_range_quantile(1 - alpha, k, dfw)
        for i in range(k):
            for j in range(i + 1, k):
                g1, g2 = groups[i], groups[j]
                diff = g2["mean"] - g1["mean"]
                se = (mse / 2.0 * (1.0 / g1["n"] + 1.0 / g2["n"])) ** 0.5
                q = abs(diff) / se if se > 0 else float("inf")
                if k == 2:
                    p = jvmstats.t_two_sided_p(spark, q / (2 ** 0.5), dfw)
                else:
                    p = jvmstats.studentized_range_sf(q, k, dfw)
                p = min(max(p, 0.0), 1.0)
                out.append((str(g1["y"]), str(g2["y"]), float(diff), float(p), float(diff - crit * se),
                            float(diff + crit * se), bool(p < alpha), feat))
    return spark.createDataFrame(out, "group1 string, group2 string, meandiff double, `p-adj` double, "
                                      "lower double, upper double, reject boolean, feature string")


# ---------------------------------------------------------------- A14-A16 label

def label_diagnostics(df: DataFrame, label: str) -> DataFrame:
    """Number of distinct labels, categorical flag (≤20), label type."""
    dtype = df.schema[label].dataType.simpleString()
    return df.agg(F.count_distinct(label).alias("n_unique")).select(
        "n_unique", (F.col("n_unique") <= CATEGORICAL_LABEL_MAX).alias("is_categorical"),
        F.lit(dtype).alias("dtype"))


def label_codes(df: DataFrame, label: str, out: str = "label_code") -> DataFrame:
    """Non-numeric labels → codes 0..k-1 in sorted order (dense rank over distinct values)."""
    from pyspark.ml.feature import StringIndexer
    idx = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="keep")
    return idx.fit(df).transform(df)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and imbalance ratio (negatives / positives for 0/1 labels)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    tot = counts.agg(F.sum("count").alias("__n"),
                     F.sum(F.when(F.col(label) == 0, F.col("count"))).alias("__neg"),
                     F.sum(F.when(F.col(label) == 1, F.col("count"))).alias("__pos"))
    return attach_scalar(counts, tot).select(
        label, "count", (F.col("count") / F.col("__n")).alias("share"),
        (F.col("__neg") / F.col("__pos")).alias("imbalance_ratio"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n/(k·n_c), and the neg/pos ratio as the positive-class weight."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    tot = counts.agg(F.sum("count").alias("__n"), F.count(F.lit(1)).alias("__k"),
                     F.sum(F.when(F.col(label) == 0, F.col("count"))).alias("__neg"),
                     F.sum(F.when(F.col(label) == 1, F.col("count"))).alias("__pos"))
    return attach_scalar(counts, tot).select(
        label, "count",
        (F.col("__n") / (F.col("__k") * F.col("count"))).alias("balanced_weight"),
        F.when(F.col(label) == 1, F.col("__neg") / F.col("__pos")).otherwise(F.lit(1.0)).alias("ratio_weight"))


def with_class_weight(df: DataFrame, label: str, weights: DataFrame, column: str = "balanced_weight",
                      out: str = "weight") -> DataFrame:
    """Attach a fitted per-class weight to every row (the class table has one row per class)."""
    return df.join(F.broadcast(weights.select(label, F.col(column).alias(out))), label, "left")
