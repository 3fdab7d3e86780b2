"""Column statistics for feature selection: variance (A16), correlation (A17),
ANOVA F (A18), binned mutual information (A19), histogram (A22).

Each statistic is one aggregate pass (or one shuffle of a melted, pre-binned
table); only per-column numbers come back, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.operators.encode import AGG_BLOCK, _blocks, column_stats
from riskweave.operators.exact import exact_mean, exact_sum, exact_var_pop

# --- A16 -------------------------------------------------------------------------


def variance_table(df: DataFrame, cols: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """(pos, column_name, variance, kept): population variance, nulls skipped,
    kept when strictly above the threshold (a constant column is dropped)."""
    found = column_stats(df, {c: exact_var_pop(F.col(c)) for c in cols}, size=AGG_BLOCK // 8)  # eight sums a variance
    long = df.sparkSession.createDataFrame([(i, c, found[c]) for i, c in enumerate(cols)], "pos int, column_name string, variance double")
    return long.withColumn("kept", F.coalesce(F.col("variance") > F.lit(threshold), F.lit(False)))


# --- A17 -------------------------------------------------------------------------


def _pair_corr(x: str, y: str) -> Column:
    """Pearson r over rows where both are present; NULL when either side is
    constant (ANSI ``corr`` would raise on the zero division)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    cov = F.covar_pop(F.when(both, xc), F.when(both, yc))
    sx = F.stddev_pop(F.when(both, xc))
    sy = F.stddev_pop(F.when(both, yc))
    den = sx * sy
    varies = (F.min(F.when(both, xc)) < F.max(F.when(both, xc))) & (F.min(F.when(both, yc)) < F.max(F.when(both, yc)))
    return F.try_divide(cov, F.when(varies & (den != 0), den))


GRAM_MIN_COLS = 3    # measured: the Gram pass beats per-pair aggregates already at 8 columns


def correlation_pairs(df: DataFrame, cols: Sequence[str], method: str = "auto") -> DataFrame:
    """(i, j, col_i, col_j, r, abs_r) for every i < j over pairwise-complete rows.

    ``aggregate``: p(p-1)/2 aggregate expressions in blocks of ``AGG_BLOCK``
    (fine for a few dozen columns). ``gram``: one pass; every Arrow batch
    adds masked cross-product matrices (n, Σx, Σx², Σxy per pair), the
    partial matrices are summed by a shuffle on (i, j). ``auto`` picks by
    width."""
    if method == "gram" or (method == "auto" and len(cols) >= GRAM_MIN_COLS):
        return correlation_pairs_gram(df, cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    stats = column_stats(df, {f"{i}:{j}": _pair_corr(cols[i], cols[j]) for i, j in pairs})
    rows = [(i, j, cols[i], cols[j], stats[f"{i}:{j}"],
             None if stats[f"{i}:{j}"] is None else abs(stats[f"{i}:{j}"])) for i, j in pairs]
    spark = df.sparkSession
    return spark.createDataFrame(rows, "i int, j int, col_i string, col_j string, r double, abs_r double")


def correlation_pairs_gram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Masked Gram route of ``correlation_pairs``.

    Values are shifted by the column mean first (one small aggregate), which
    keeps Σx² - (Σx)²/n from cancelling catastrophically. Memory per task is
    4 p x p doubles (p = 500: 8 MB); the shuffle carries p(p-1)/2 rows per
    map task."""
    p = len(cols)
    x = {c: F.col(c).cast("double") for c in cols}
    stats = column_stats(df, {f"{kind}:{c}": f(x[c]) for c in cols for kind, f in (("mean", F.avg), ("lo", F.min), ("hi", F.max))})
    means = {c: stats[f"mean:{c}"] for c in cols}
    constant = [k for k, c in enumerate(cols) if stats[f"lo:{c}"] == stats[f"hi:{c}"]]
    shifted = df.select(*[(F.col(c).cast("double") - F.lit(means[c] or 0.0)).alias(f"x{k}")
                          for k, c in enumerate(cols)])
    names = [f"x{k}" for k in range(p)]

    def partials(batches):
        import numpy as np
        import pyarrow as pa
        n = np.zeros((p, p)); sx = np.zeros((p, p)); sxx = np.zeros((p, p)); sxy = np.zeros((p, p))
        for b in batches:
            x = np.column_stack([b.column(nm).to_numpy(zero_copy_only=False).astype("float64")
                                 for nm in names]) if b.num_rows else np.zeros((0, p))
            m = ~np.isnan(x)
            x0 = np.where(m, x, 0.0)
            mf = m.astype("float64")
            n += mf.T @ mf
            sx += x0.T @ mf
            sxx += (x0 * x0).T @ mf
            sxy += x0.T @ x0
        iu, ju = np.triu_indices(p, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(iu.astype("int32")), pa.array(ju.astype("int32")), pa.array(n[iu, ju]),
             pa.array(sx[iu, ju]), pa.array(sx[ju, iu]), pa.array(sxx[iu, ju]), pa.array(sxx[ju, iu]),
             pa.array(sxy[iu, ju])],
            names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = shifted.mapInArrow(partials, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    cov = F.col("sxy") - sx * sy / n
    vx = F.col("sxx") - sx * sx / n
    vy = F.col("syy") - sy * sy / n
    den = F.sqrt(vx * vy)
    # A constant column leaves float noise in its variance: what is far below its sum of squares is none.
    r = F.when((n > 0) & (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
               & ~F.col("i").isin(constant) & ~F.col("j").isin(constant), cov / den)
    names_map = F.create_map(*[e for k, c in enumerate(cols) for e in (F.lit(k), F.lit(c))])
    return sums.select("i", "j", names_map[F.col("i")].alias("col_i"), names_map[F.col("j")].alias("col_j"),
                       r.alias("r"), F.abs(r).alias("abs_r"))


def correlated_to_drop(pairs: DataFrame, cols: Sequence[str], threshold: float = 0.95) -> list[str]:
    """Column j goes when any earlier column i < j has |r| > threshold (even
    an i that is itself dropped); NULL r (constant column) never drops."""
    hit = (pairs.where(F.col("abs_r") > F.lit(threshold)).select("j").distinct().collect())
    js = {r["j"] for r in hit}
    return [c for k, c in enumerate(cols) if k in js]


# --- A18 -------------------------------------------------------------------------


def anova_f(df: DataFrame, cols: Sequence[str], label_col: str) -> DataFrame:
    """(pos, feature, f_score) with classes of ``label_col`` as groups.

    Group-bys on the label (a block of columns each) give, per class and feature,
    n, mean and population variance; F = (SSB / (k - 1)) / (SSW / (n - k)). No spread
    within classes: +Infinity when the class means differ, NULL when the
    column is constant (ranked last).
    """
    present = df.where(F.col(label_col).isNotNull())
    x = {i: F.col(c).cast("double") for i, c in enumerate(cols)}
    long = None
    for block in _blocks(list(x), AGG_BLOCK // 12):  # about twelve aggregates a column
        per_class = present.groupBy(label_col).agg(*[e for i in block for e in (
            F.count(x[i]).alias(f"n{i}"), exact_mean(x[i]).alias(f"m{i}"), exact_var_pop(x[i]).alias(f"v{i}"),
            F.min(x[i]).alias(f"lo{i}"), F.max(x[i]).alias(f"hi{i}"))])
        rows = per_class.select(label_col, F.inline(F.array(*[
            F.struct(F.lit(i).alias("pos"), F.lit(cols[i]).alias("feature"), *(F.col(f"{s}{i}").alias(s) for s in ("n", "m", "v", "lo", "hi")))
            for i in block]))).where(F.col("n") > 0)
        long = rows if long is None else long.unionByName(rows)
    # k classes x p features rows: small, bounded by the label cardinality.
    n, m, gm = F.col("n").cast("double"), F.col("m"), F.col("gm")
    means = long.groupBy("pos").agg((exact_sum(n * m) / F.sum("n").cast("double")).alias("gm"))
    s = long.join(means, "pos").groupBy("pos", "feature").agg(
        exact_sum(n * (m - gm) * (m - gm)).alias("ssb"), exact_sum(n * F.col("v")).alias("ssw"),
        F.sum("n").cast("double").alias("n"), F.count(F.lit(1)).alias("k"),
        (F.min("lo") == F.max("hi")).alias("constant"))
    f = F.try_divide(F.col("ssb") / (F.col("k") - 1), F.col("ssw") / (F.col("n") - F.col("k")))
    # A constant column: no score, whatever float noise the class means carry.
    score = (F.when(F.col("constant"), F.lit(None).cast("double"))
              .when((F.col("ssw") == 0) & (F.col("ssb") > 0), F.lit(float("inf")))
              .when(F.col("ssw") == 0, F.lit(None).cast("double"))
              .otherwise(f))
    return s.select("pos", "feature", score.alias("f_score"))


def top_k_by_score(scores: DataFrame, k: int, score_col: str = "f_score") -> DataFrame:
    """K4: best k by score (NULL last; ties keep the later column), returned
    in column order."""
    best = scores.orderBy(F.col(score_col).desc_nulls_last(), F.col("pos").desc()).limit(k)
    return best.orderBy("pos")


# --- A19 -------------------------------------------------------------------------


LOG_UNIT = float(2 ** 40)   # terms with a logarithm are cut to multiples of 1 / this: engines' logarithms differ in the last bit


def _below(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows with a smaller value of the same feature, for each distinct value.

    ``cells``: pos, v, n, .... ``edges``: pos, edges (sorted). Values between two
    edges are counted in one window; what lies before is a sum over the at most
    ``len(edges) + 1`` stretches of the feature.
    """
    cut = cells.join(F.broadcast(edges), "pos").withColumn(
        "stretch", F.size(F.filter("edges", lambda e: e <= F.col("v")))).drop("edges")
    stretches = cut.groupBy("pos", "stretch").agg(F.sum("n").alias("inside"))
    before = Window.partitionBy("pos").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("pos", "stretch", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("ahead"),
                                 F.sum("inside").over(Window.partitionBy("pos")).alias("total"))
    within = Window.partitionBy("pos", "stretch").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    return (cut.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(stretches, ["pos", "stretch"])
            .withColumn("below", F.col("ahead") + F.col("within")).drop("stretch", "within", "ahead"))


def mutual_info_binned(df: DataFrame, cols: Sequence[str], label_col: str, bins: int = 10, stretches: int = 64) -> DataFrame:
    """(pos, feature, mi): mutual information (nats) between quantile bins of
    each feature and the label. A re-aim of the nearest-neighbour estimator,
    which has no distributed form; values differ from it by design.

    The bin of a value is ``bins`` times the share of rows (with a label) whose
    value is smaller, rounded down: bins hold about equally many rows, equal
    values share a bin, and monotone transforms change nothing. The shares are
    exact: one pass of mergeable quantile sketches over all columns only deals
    the distinct values into ``stretches`` of about equal weight, in which they
    are counted. NaN and NULL are left out.
    """
    x = {i: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for i, c in enumerate(cols)}
    known = df.where(F.col(label_col).isNotNull())
    shares = [k / stretches for k in range(1, stretches)]
    sketches = column_stats(known, {str(i): F.percentile_approx(x[i], shares, 10_000) for i in x}, size=32)
    spark = df.sparkSession
    edges = spark.createDataFrame([(i, sorted(set(sketches[str(i)] or []))) for i in x], "pos int, edges array<double>")
    cells = (known.select(F.col(label_col).alias("y"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"), x[i].alias("v")) for i, c in enumerate(cols)])))
        .where(F.col("v").isNotNull()).groupBy("pos", "feature", "v", "y").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("pos", "feature", "v").agg(F.sum("n").alias("n"), F.collect_list(F.struct("y", F.col("n").alias("nxy"))).alias("classes")))
    placed = _below(cells, edges).withColumn("bin", F.floor(F.col("below") * bins / F.col("total")))
    binned = (placed.select("pos", "feature", "bin", F.inline("classes")).groupBy("pos", "feature", "bin", "y")
              .agg(F.sum("nxy").alias("nxy")))
    # features x bins x classes rows: bounded by construction.
    t = binned.select("pos", "feature", "nxy", F.sum("nxy").over(Window.partitionBy("pos", "bin")).alias("nx"),
                      F.sum("nxy").over(Window.partitionBy("pos", "y")).alias("ny"), F.sum("nxy").over(Window.partitionBy("pos")).alias("n"))
    nxy, nx, ny, n = (F.col(c).cast("double") for c in ("nxy", "nx", "ny", "n"))
    term = (nxy / n) * F.log((nxy * n) / (nx * ny))
    return t.groupBy("pos", "feature").agg(exact_sum(F.floor(term * F.lit(LOG_UNIT) + F.lit(0.5)).cast("double") / F.lit(LOG_UNIT)).alias("mi"))


# --- A22 -------------------------------------------------------------------------


def histogram(df: DataFrame, col: str, bins: int = 50, probe: float | None = None) -> DataFrame:
    """(bin, lo, hi, count, is_probe_bin): equal-width bins over [min, max];
    the maximum falls in the last bin. ``probe`` marks the bin of one value."""
    st = column_stats(df, {"lo": F.min(F.col(col).cast("double")), "hi": F.max(F.col(col).cast("double"))})
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count bigint, is_probe_bin boolean")
    width = (hi - lo) / bins if hi > lo else 1.0

    def bin_of(x: Column) -> Column:
        if hi == lo:
            return F.lit(1)
        return F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))) + 1, F.lit(bins)).cast("int")

    counts = (df.where(F.col(col).isNotNull()).select(bin_of(F.col(col).cast("double")).alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    probe_bin = bin_of(F.lit(float(probe))) if probe is not None else F.lit(None).cast("int")
    return counts.select(
        "bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lo"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("hi"), "count",
        F.coalesce(F.col("bin") == probe_bin, F.lit(False)).alias("is_probe_bin"))

