"""Encoding, imputation and column-statistics driven rewrites.

Statistics (missing shares, medians, distinct category values) are computed
in one wide aggregate per block of columns; only those few numbers reach the
driver, then a single ``select`` applies them to every row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.functions.scalar import raw_ratio
from riskweave.operators.exact import exact_mean, exact_var_pop
from riskweave.session import scratch_path

UNKNOWN = "Unknown"           # fill value of a missing category
AGG_BLOCK = 250               # expressions per aggregate pass (measured: 300 wide costs the same CPU
                              # as 3 x 100 and saves two scans; 1000 wide is ~2x slower per expression)
MAX_INLINE_VALUES = 256       # category values looked up in a literal array (linear per row)
MAX_CATEGORY_VALUES = 10_000  # one-hot / share columns: one output column per value


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [n for n, t in df.dtypes if t == "string" and n not in ex]


def _blocks(items: Sequence, size: int | None = None):
    size = size or AGG_BLOCK
    for i in range(0, len(items), size):
        yield items[i:i + size]


def column_stats(df: DataFrame, exprs: Mapping[str, Column], size: int | None = None) -> dict:
    """Evaluate named aggregate expressions, ``size`` (``AGG_BLOCK``) at a time."""
    names = list(exprs)
    out: dict = {}
    for blk in _blocks(names, size):
        row = df.agg(*[exprs[n].alias(f"_s{i}") for i, n in enumerate(blk)]).first()
        out.update({n: row[f"_s{i}"] for i, n in enumerate(blk)})
    return out


# --- F4 / F14: label encoding ---------------------------------------------------

def distinct_values(df: DataFrame, col: str, fill: str | None = UNKNOWN,
                    limit_check: int = MAX_CATEGORY_VALUES) -> list | None:
    """Sorted distinct values (missing -> ``fill``); None if above the check."""
    c = F.coalesce(F.col(col), F.lit(fill)) if fill is not None else F.col(col)
    rows = (df.select(c.alias("v")).where(F.col("v").isNotNull()).distinct()
              .orderBy("v").limit(limit_check + 1).collect())
    if len(rows) > limit_check:
        return None
    return [r["v"] for r in rows]


def label_encode(df: DataFrame, cols: Sequence[str], fill: str = UNKNOWN) -> DataFrame:
    """Code = rank (from 0) of the value among the sorted distinct values,
    missing values first replaced by ``fill`` and ranked with the others.

    Few values: the sorted values are inlined and looked up with
    ``array_position`` (no join). Many values: a ranked distinct table is
    joined. Codes and column order are the same either way.
    """
    out = df
    for c in cols:
        filled = F.coalesce(F.col(c), F.lit(fill))
        vals = distinct_values(out, c, fill, limit_check=MAX_INLINE_VALUES)
        if vals is not None:
            arr = F.array(*[F.lit(v) for v in vals]) if vals else F.array().cast("array<string>")
            out = out.withColumn(c, (F.array_position(arr, filled) - 1).cast("int"))
            continue
        codes = dense_codes(out.select(filled.alias("_v")), "_v", "_code")
        out = (out.withColumn("_v", filled).join(codes, "_v", "left")
                  .drop("_v", c).withColumnRenamed("_code", c))
    return out.select(*(F.col(f"`{c}`") for c in df.columns))


def dense_codes(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """(value, dense rank from 0) over the distinct values of ``col``, in the
    JVM and without a global window: the distinct values are range-partitioned
    (partition i holds smaller values than partition i + 1), numbered inside
    each partition, and offset by the counts of the earlier partitions (one
    number per partition). The ranges come from a sample, so the partitioned
    values are written once to the shared folder; counts and numbers both read
    that copy."""
    ranged = (df.select(col).where(F.col(col).isNotNull()).distinct()
                .repartitionByRange(col).withColumn("_pid", F.spark_partition_id()))
    path = scratch_path(df.sparkSession, "dense-codes")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # one row per range partition: a bounded, broadcastable table
    numbered = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(col)))
    return (numbered.join(F.broadcast(offsets), "_pid")
                    .select(col, (F.col("_off") + F.col("_rn") - 1).cast("int").alias(out)))


# --- F15: one-hot -----------------------------------------------------------------

def one_hot(df: DataFrame, cols: Sequence[str], fill: str = UNKNOWN,
            values: Mapping[str, Sequence] | None = None, max_values: int = MAX_CATEGORY_VALUES) -> DataFrame:
    """``{col}_{value}`` 0/1 int columns, source dropped, new columns last,
    per source column in value order (pandas ``get_dummies``).

    Every value is an output column, so a source column with more than
    ``max_values`` values raises; pass more, or ``values``, to go beyond."""
    new_cols: list[Column] = []
    for c in cols:
        vals = values[c] if values and c in values else distinct_values(df, c, fill, max_values)
        if vals is None:
            raise ValueError(f"{c}: more than {max_values} values to one-hot encode")
        filled = F.coalesce(F.col(c), F.lit(fill))
        new_cols += [(filled == F.lit(v)).cast("int").alias(f"{c}_{v}") for v in vals]
    keep = [F.col(f"`{n}`") for n in df.columns if n not in set(cols)]
    return df.select(*keep, *new_cols)


# --- A12 / F6: missing shares --------------------------------------------------------

def missing_shares(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    cols = list(cols) if cols is not None else df.columns
    return column_stats(df, {c: F.avg(F.col(f"`{c}`").isNull().cast("double")) for c in cols})


def drop_high_missing(df: DataFrame, threshold: float, exclude: Iterable[str] = (),
                      stats_df: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Drop columns whose missing share is strictly above ``threshold``."""
    ex = set(exclude or ())
    cols = [c for c in df.columns if c not in ex]
    shares = missing_shares(stats_df if stats_df is not None else df, cols)
    dropped = [c for c in cols if shares[c] is not None and shares[c] > threshold]
    return df.drop(*dropped), dropped


# --- A13 / F5 / F2: medians ----------------------------------------------------------

INTEGERS = ("tinyint", "smallint", "int", "bigint")
SELECT_BUCKETS = 4096       # range buckets per narrowing pass of the exact median
SELECT_FINAL_ROWS = 200_000 # candidate rows per column finished with a window


def medians(df: DataFrame, cols: Sequence[str], approx: bool = False, accuracy: int = 10_000,
            method: str = "select") -> dict[str, float]:
    """Exact interpolated median per column (nulls skipped).

    ``method="select"`` (default): distributed selection, no task ever holds
    more than ``SELECT_FINAL_ROWS`` values of a column (see
    ``exact_medians``). ``"aggregate"``: Spark's ``median()``, whose final
    merge keeps a count per distinct value in one task (fine for small
    tables). ``approx=True``: ``percentile_approx`` (a bounded sketch).
    """
    if approx:
        return column_stats(df, {c: F.percentile_approx(F.col(c), 0.5, accuracy).cast("double") for c in cols})
    if method == "aggregate":
        return column_stats(df, {c: F.median(F.col(c)).cast("double") for c in cols})
    return exact_medians(df, cols)


def exact_medians(df: DataFrame, cols: Sequence[str], buckets: int = SELECT_BUCKETS,
                  final_rows: int = SELECT_FINAL_ROWS) -> dict[str, float]:
    """Exact median by selection (Spark's interpolation: v[k1] + f * (v[k2] - v[k1])
    at position (n - 1) / 2).

    Each pass, for every unresolved column at once: approximate quantiles of
    the candidate range [lo, hi) give up to ``buckets`` edges (one aggregate);
    a ``Bucketizer`` (binary search) counts the rows per (column, bucket), a
    table of at most columns x buckets rows; the range shrinks to the buckets
    holding the two wanted ranks. A range of one distinct value is resolved
    at once (a hot value never reaches a window). When a range holds at most
    ``final_rows`` rows, a window per column numbers them and the two wanted
    values are read. Only per-column numbers reach the driver.
    """
    from pyspark.ml.feature import Bucketizer

    cols = list(cols)
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    n = column_stats(df, {c: F.count(F.when(~F.isnan(x[c]), x[c])) for c in cols})
    out: dict[str, float] = {c: None for c in cols}
    state = {}
    for c in cols:
        if n[c]:
            pos = (n[c] - 1) / 2.0
            k1 = int(pos // 1)
            state[c] = {"lo": None, "hi": None, "k1": k1, "k2": k1 + (1 if pos > k1 else 0),
                        "frac": pos - k1, "count": n[c]}

    def in_range(c):
        st = state[c]
        cond = x[c].isNotNull() & ~F.isnan(x[c])
        if st["lo"] is not None:
            cond = cond & (x[c] >= F.lit(st["lo"]))
        if st["hi"] is not None:
            cond = cond & (x[c] < F.lit(st["hi"]))
        return cond

    while True:
        open_cols = [c for c in state if state[c]["count"] > final_rows]
        if not open_cols:
            break
        qs = [i / buckets for i in range(1, buckets)]
        st_aggs = {}
        for c in open_cols:
            v = F.when(in_range(c), x[c])
            # the answer is exact whatever the sketch error; accuracy only
            # balances the buckets, so a small sketch per column and task
            st_aggs[f"q:{c}"] = F.percentile_approx(v, qs, 10 * buckets)
            st_aggs[f"lo:{c}"] = F.min(v)
            st_aggs[f"hi:{c}"] = F.max(v)
        stats = column_stats(df, st_aggs)
        cand = []
        for c in open_cols:
            if stats[f"lo:{c}"] == stats[f"hi:{c}"]:      # one distinct value left
                out[c] = stats[f"lo:{c}"]
                del state[c]
            else:
                edges = sorted({float(b) for b in stats[f"q:{c}"]} - {stats[f"lo:{c}"]})
                state[c]["edges"] = edges or [(stats[f"lo:{c}"] + stats[f"hi:{c}"]) / 2.0]
                cand.append(c)
        if not cand:
            continue
        names = [f"_v{i}" for i in range(len(cand))]
        vals = df.select(*[F.when(in_range(c), x[c]).alias(nm) for c, nm in zip(cand, names)])
        bz = Bucketizer(splitsArray=[[float("-inf")] + state[c]["edges"] + [float("inf")] for c in cand],
                        inputCols=names, outputCols=[f"_b{i}" for i in range(len(cand))],
                        handleInvalid="keep")
        structs = [F.when(F.col(nm).isNotNull(), F.struct(F.lit(i).alias("i"), F.col(f"_b{i}").cast("int").alias("b")))
                   for i, nm in enumerate(names)]
        counts = (bz.transform(vals).select(F.explode(F.array(*structs)).alias("s"))
                    .where(F.col("s").isNotNull()).groupBy("s.i", "s.b").count().collect())
        per: dict[int, dict[int, int]] = {}
        for r in counts:
            per.setdefault(r["i"], {})[r["b"]] = r["count"]
        for i, c in enumerate(cand):
            st, e = state[c], state[c]["edges"]
            b1 = b2 = None
            before1 = cum = 0
            for b in sorted(per.get(i, {})):
                nb = per[i][b]
                if b1 is None and st["k1"] < cum + nb:
                    b1, before1 = b, cum
                if st["k2"] < cum + nb:
                    b2 = b
                    break
                cum += nb
            if b1 is None or b2 is None:
                raise RuntimeError(f"{c}: the ranks of its median are in no bucket; the input changed between passes")
            # bucket b holds e[b-1] <= x < e[b] (edge list padded by -inf / inf)
            st["lo"] = e[b1 - 1] if b1 >= 1 else st["lo"]
            st["hi"] = e[b2] if b2 < len(e) else st["hi"]
            st["count"] = sum(per[i][b] for b in per[i] if b1 <= b <= b2)
            st["k1"] -= before1
            st["k2"] -= before1
    if state:
        idx = {c: cols.index(c) for c in state}
        pieces = [F.when(in_range(c), F.struct(F.lit(idx[c]).alias("i"), x[c].alias("v"))) for c in state]
        ranked = (df.select(F.explode(F.array(*pieces)).alias("s")).where(F.col("s").isNotNull())
                    .select("s.i", "s.v")
                    .withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy("v")) - 1))
        want = None
        for c, st in state.items():
            cond = (F.col("i") == F.lit(idx[c])) & F.col("r").isin(st["k1"], st["k2"])
            want = cond if want is None else want | cond
        got: dict[int, dict[int, float]] = {}
        for r in ranked.where(want).collect():
            got.setdefault(r["i"], {})[r["r"]] = r["v"]
        for c, st in state.items():
            g = got.get(idx[c], {})
            v1, v2 = g.get(st["k1"]), g.get(st["k2"])
            if v1 is not None and v2 is not None:
                out[c] = v1 + st["frac"] * (v2 - v1)
    return out


def median_impute(df: DataFrame, cols: Sequence[str], stats_df: DataFrame | None = None,
                  approx: bool = False) -> DataFrame:
    """Fill missing values with the column median (of ``stats_df``, default
    ``df``). Medians are computed only for columns that have a missing value
    in ``df`` (one counting pass first); filling the others is a no-op."""
    if not cols:
        return df
    nulls = column_stats(df, {c: F.count_if(F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double"))) for c in cols})
    need = [c for c in cols if nulls[c]]
    if not need:
        return df
    med = medians(stats_df if stats_df is not None else df, need, approx)
    # An integer column with gaps becomes double: its median may lie between two integers.
    fills = {c: F.coalesce(F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).cast("double" if t in INTEGERS else t),
                           F.lit(med[c]).cast("double" if t in INTEGERS else t))
             for c, t in df.select(*need).dtypes if med.get(c) is not None}
    return df.withColumns(fills)


def ratio_impute(df: DataFrame, ratios: Mapping[str, tuple[str, str]], approx: bool = False) -> DataFrame:
    """ratio a/b; where pandas gives inf / NaN use the median of the ratio."""
    if not ratios:
        return df
    df = df.withColumns({n: raw_ratio(a, b) for n, (a, b) in ratios.items()})
    med = medians(df, list(ratios), approx)
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(med[n])) for n in ratios})


# --- A14 / F16: type narrowing ------------------------------------------------------

INT_RANGES = (("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647), ("bigint", -(2 ** 63), 2 ** 63 - 1))
FLOAT32_MAX = 3.4028234663852886e38


def narrow_plan(df: DataFrame, cols: Sequence[str] | None = None,
                floats_to_float: bool = False) -> list[tuple[str, object, object, str]]:
    """(column, min, max, narrowest type) per numeric column.

    Integers go to the smallest int type holding [min, max]; floating columns
    stay double unless ``floats_to_float`` (never half precision: lossy).
    """
    num = [(n, t) for n, t in df.dtypes if t in
           ("tinyint", "smallint", "int", "bigint", "float", "double")]
    if cols is not None:
        num = [(n, t) for n, t in num if n in set(cols)]
    ex = {}
    for n, _ in num:
        ex[f"{n}\x00min"] = F.min(n)
        ex[f"{n}\x00max"] = F.max(n)
    st = column_stats(df, ex)
    plan = []
    for n, t in num:
        lo, hi = st[f"{n}\x00min"], st[f"{n}\x00max"]
        if t in ("float", "double"):
            target = "float" if (floats_to_float and lo is not None and
                                 max(abs(lo), abs(hi)) < FLOAT32_MAX) else t
        elif lo is None:
            target = t
        else:
            target = next(name for name, a, b in INT_RANGES if a <= lo and hi <= b)
        plan.append((n, lo, hi, target))
    return plan


def narrow_types(df: DataFrame, floats_to_float: bool = False) -> DataFrame:
    plan = narrow_plan(df, floats_to_float=floats_to_float)
    return df.withColumns({n: F.col(n).cast(t) for n, _, _, t in plan})


# --- F17: standardise ----------------------------------------------------------------

def standardise_params(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    ex = {}
    for c in cols:
        ex[f"{c}\x00m"] = exact_mean(F.col(c))
        ex[f"{c}\x00s"] = F.sqrt(exact_var_pop(F.col(c)))
    st = column_stats(df, ex, size=AGG_BLOCK // 6)  # about twelve sums a column
    out = {}
    for c in cols:
        s = st[f"{c}\x00s"]
        out[c] = (st[f"{c}\x00m"], 1.0 if (s is None or s == 0) else s)
    return out


def standardise(df: DataFrame, cols: Sequence[str],
                params: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / population sd, sd 0 -> 1 (the reference's scaler)."""
    params = params or standardise_params(df, cols)
    return df.withColumns({c: (F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1]) for c in cols})


# --- U1 / P5 -------------------------------------------------------------------------

def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)
