"""Grouped aggregation operators (one ``groupBy.agg`` per operator).

A spec is an ordered mapping ``{column: [agg, ...]}``; every output column is
named ``{prefix}{COLUMN}_{AGG}`` (the flattened two-level label of a pandas
``groupby.agg``). Aggregates run with map-side partial aggregation, so a hot
group key is pre-combined on every map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.exact import exact_mean, exact_sum, exact_var_pop, exact_var_samp

AggSpec = Mapping[str, Sequence[str]]


def _sum0(c: Column) -> Column:
    # pandas sums an all-missing group to 0; Spark gives NULL.
    return F.coalesce(F.sum(c), F.lit(0))


# name -> builder(column) ; "size" ignores its column (row count).
AGG_BUILDERS: dict[str, Callable[[Column], Column]] = {
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "sum": _sum0,
    "sum_null": F.sum,
    "var": exact_var_samp,
    "var_pop": exact_var_pop,
    "std_pop": lambda c: F.sqrt(exact_var_pop(c)),
    "median": F.median,
    "size": lambda c: F.count(F.lit(1)),
    "count": F.count,
    "nunique": F.count_distinct,
}

# Of doubles, whose plain sums depend on the order of rows.
DOUBLE_BUILDERS: dict[str, Callable[[Column], Column]] = {
    "mean": exact_mean,
    "sum": lambda c: F.coalesce(exact_sum(c), F.lit(0.0)),
    "sum_null": exact_sum,
}


def agg_name(prefix: str, col: str, agg: str) -> str:
    return f"{prefix}{col}_{agg.upper()}"


def agg_exprs(df: DataFrame, spec: AggSpec, prefix: str = "", zero_sum: bool = True) -> list[Column]:
    """Aggregates of a spec; sums, means and variances of doubles do not depend on the order of rows."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    out = []
    for col, aggs in spec.items():
        for a in aggs:
            kind = "sum_null" if (a == "sum" and not zero_sum) else a
            fn = DOUBLE_BUILDERS[kind] if col in doubles and kind in DOUBLE_BUILDERS else AGG_BUILDERS[kind]
            out.append(fn(F.col(col)).alias(agg_name(prefix, col, a)))
    return out


def grouped_agg(df: DataFrame, key: str | Sequence[str], spec: AggSpec, prefix: str = "",
                zero_sum: bool = True, extra: Iterable[Column] = ()) -> DataFrame:
    """A1: one ``groupBy(key).agg`` built from a spec dict.

    Rows with a missing key are dropped first (pandas group-by does the same).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond).groupBy(*keys).agg(*agg_exprs(df, spec, prefix, zero_sum), *extra)


HOT_ROWS = 100_000   # from so many rows of one key on, rows are combined before the shuffle


def rows_by_key(df: DataFrame, key: str, counted: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``df`` that have the key, dealt out by it, for keys of a few rows each.

    There map-side aggregates save no rows, and a wide spec's buffers are many
    times as long as a row: to shuffle the rows is less, and group-bys and joins
    on the key need no other exchange. If a key has more than ``hot_rows`` rows,
    ``df`` stays as it is, so that no task gets all rows of that key.
    ``counted``: a frame to count the rows of a key in, if ``df`` is costly.
    """
    rows = (df if counted is None else counted).where(F.col(key).isNotNull())
    most = rows.groupBy(key).count().agg(F.max("count")).first()[0]
    return df.where(F.col(key).isNotNull()).repartition(key) if most is None or most <= hot_rows else df


# --- A2: rule-driven spec -------------------------------------------------

Rule = tuple[Callable[[str], bool], Sequence[str]]


def rule_spec(df: DataFrame, rules: Sequence[Rule], default: Sequence[str] = ("mean",),
              exclude: Iterable[str] = ()) -> dict[str, list[str]]:
    """Spec over the numeric columns of ``df``: the first matching rule wins."""
    excl = set(exclude)
    spec: dict[str, list[str]] = {}
    for name, dtype in df.dtypes:
        if name in excl or dtype == "string":
            continue
        for pred, aggs in rules:
            if pred(name):
                spec[name] = list(aggs)
                break
        else:
            spec[name] = list(default)
    return spec


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    excl = set(exclude)
    return [n for n, t in df.dtypes if n not in excl and t != "string"
            and not t.startswith(("array", "map", "struct"))]


# --- A11: two-level aggregate ----------------------------------------------

def two_level_agg(child: DataFrame, link: DataFrame, child_key: str, parent_key: str,
                  spec: AggSpec, prefix: str, level2: Sequence[str] = ("mean", "max")) -> DataFrame:
    """child rows -> one row per child_key (spec) -> link (parent, child) -> parent.

    Level 1 groups the child table by its loan key (partial aggregation, one
    shuffle). The link join is on a unique key on both sides, so it cannot
    skew. Level 2 shuffles one row per loan (:func:`rows_by_key`; the child
    rows, too, if the caller deals them out so). Loans without child rows keep
    NULL stats (left join) and are skipped by mean / max at level 2; child
    rows of loans absent from the link vanish.
    """
    p = f"{prefix}_"
    lvl1 = grouped_agg(child, child_key, spec, prefix=p)
    stat_cols = [c for c in lvl1.columns if c != child_key]
    linked = (link.select(parent_key, child_key)
                  .where(F.col(child_key).isNotNull())
                  .join(lvl1, child_key, "left"))
    spec2 = {c: list(level2) for c in stat_cols}
    return grouped_agg(rows_by_key(linked, parent_key, link), parent_key, spec2, prefix=p, zero_sum=False)


def two_level_aggs(children: Sequence[tuple[DataFrame, AggSpec, str]], link: DataFrame,
                   child_key: str, parent_key: str, level2: Sequence[str] = ("mean", "max")) -> DataFrame:
    """Several two-level aggregates over the same (parent, child) links.

    Each child table is grouped by the child key (its output is
    hash-partitioned on that key); the links are shuffled once and
    left-joined to every level-1 result without further exchanges; one
    group-by then produces all level-2 columns. Same values as calling
    ``two_level_agg`` per child, with one link shuffle and one parent
    shuffle instead of one each per child.
    """
    links = linked = link.select(parent_key, child_key).where(F.col(child_key).isNotNull())
    spec2: dict[str, list[str]] = {}
    for child, spec, prefix in children:
        lvl1 = grouped_agg(child, child_key, spec, prefix=f"{prefix}_")
        linked = linked.join(lvl1, child_key, "left")
        spec2.update({c: list(level2) for c in lvl1.columns if c != child_key})
    out_cols = [F.col(parent_key)]
    parts = []
    for _, _, prefix in children:
        cols = {c: a for c, a in spec2.items() if c.startswith(f"{prefix}_")}
        parts.append((prefix, cols))
    exprs = []
    for prefix, cols in parts:
        exprs += agg_exprs(linked, cols, prefix=f"{prefix}_", zero_sum=False)
    keys = F.col(parent_key).isNotNull()
    return rows_by_key(linked, parent_key, links).where(keys).groupBy(parent_key).agg(*exprs)


# --- A7/A8: category shares -------------------------------------------------

MAX_CATEGORY_VALUES = 10_000


def values_by_frequency(df: DataFrame, col: str, limit_check: int = MAX_CATEGORY_VALUES) -> list:
    """Distinct non-null values, most frequent first (ties by value).

    Only the distinct values reach the driver; their number is checked so
    an unexpectedly high-cardinality column fails loudly instead of
    producing a plan with millions of columns.
    """
    vc = (df.where(F.col(col).isNotNull()).groupBy(col).count()
            .orderBy(F.desc("count"), F.asc(col)))
    rows = vc.limit(limit_check + 1).collect()
    if len(rows) > limit_check:
        raise ValueError(f"{col}: more than {limit_check} distinct values; not a category")
    return [r[col] for r in rows]


SHARE_PIVOT_FROM = 64   # from this many values on, shares come from a (key, value) count + pivot


def category_shares(df: DataFrame, key: str, col: str, values: Sequence | None = None,
                    name_prefix: str | None = None, spec: AggSpec | None = None,
                    prefix: str = "", method: str = "auto") -> DataFrame:
    """For every category value v the mean of the 0/1 indicator ``col == v``.

    A missing category counts as 0 in every share. ``spec`` adds ordinary
    aggregates. Few values (``expr``): one pass, one conditional mean per value
    (one shuffle for all). Many values (``pivot``): rows are counted per
    (key, value) with map-side combine, pivoted per key and divided by the
    key's row count, so each row costs O(1) instead of O(values).
    """
    if values is None:
        values = values_by_frequency(df, col)
    np_ = name_prefix if name_prefix is not None else f"{col}_"
    names = [f"{prefix}{np_}{v}_MEAN" for v in values]
    if method == "expr" or (method == "auto" and len(values) < SHARE_PIVOT_FROM):
        shares = [F.avg(F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("double")).alias(n)
                  for v, n in zip(values, names)]
        return grouped_agg(df, key, spec or {}, prefix=prefix, extra=shares)
    base = grouped_agg(df, key, spec or {}, prefix=prefix, extra=[F.count(F.lit(1)).alias("__rows")])
    counts = (df.where(F.col(key).isNotNull() & F.col(col).isin(list(values)))
                .groupBy(key, col).agg(F.count(F.lit(1)).alias("__n"))
                .groupBy(key).pivot(col, list(values)).agg(F.first("__n")))
    out = base.join(counts, key, "left")
    return out.select(*[c for c in base.columns if c != "__rows"], *[
        (F.coalesce(counts[f"`{str(v).replace('`', '``')}`"], F.lit(0)).cast("double") / F.col("__rows")).alias(n)
        for v, n in zip(values, names)])


# --- A9: latest non-null value per column ------------------------------------

def latest_non_null(df: DataFrame, key: str, order_col: str, tie_col: str,
                    cols: Sequence[str], prefix: str = "") -> list[Column]:
    """Expressions for the last non-missing value of each column after a sort
    by (order_col, tie_col) within the group; each column on its own.

    A missing sort key sorts last (pandas), hence ``order_col IS NULL`` as the
    first struct field. Returned as aggregate expressions so they fold into
    the same ``agg`` as other statistics (no extra group-by + join).
    """
    out = []
    for c in cols:
        ordering = F.struct(F.col(order_col).isNull(), F.col(order_col), F.col(tie_col))
        out.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering))
                   .alias(f"{prefix}{c}"))
    return out


# --- A10: conditional rate ------------------------------------------------------

def conditional_rate(pred: Column, count_col: str, name: str) -> Column:
    """Rows matching ``pred`` / non-null count of ``count_col``; 0 if none match."""
    return F.coalesce(
        F.try_divide(F.count_if(F.coalesce(pred, F.lit(False))).cast("double"),
                     F.count(F.col(count_col)).cast("double")),
        F.lit(0.0)).alias(name)


# Offset of the cut between two grid cells (fixed). Decimal data averaged over
# small counts lands exactly on halves of the last kept digit, where engine
# summation order then decides the side; a cut at an "odd" fraction is not
# hit by decimal ties.
GRID_CUT = 0.3765433


# (upper bound of |x|, grid scale): 6 decimals below 1000, otherwise about 9
# significant digits. Engines that sum in another order differ in the last
# bits; the coarser the grid, the rarer such noise straddles a cell edge.
GRID_BANDS = ((1e3, 1e6), (1e6, 1e3), (1e9, 1.0), (1e12, 1e-3), (1e15, 1e-6))


def round_fixed(c: Column, digits: int | None = None) -> Column:
    """Quantise a double onto a grid: ``floor(x * s + cut) / s``.

    The same double comes out of any engine that computed the same x up to
    float noise, unlike ``round(x, d)`` (Spark rounds the shortest decimal
    form, other engines the binary value). By default the scale s keeps ~9
    significant digits (``GRID_BANDS``); non-finite and huge values pass. With
    ``digits`` it is plain half-up rounding for display.
    One small expression per column keeps wide projections inside the
    generated-code size limit.
    """
    x = c.cast("double")
    if digits is not None:  # display rounding: half up, on the decimal form
        return F.round(x.cast("decimal(38,10)"), digits).cast("double")
    ax = F.abs(x)
    sc = None
    for bound, scale in GRID_BANDS:
        sc = (F.when(ax < F.lit(bound), F.lit(scale)) if sc is None
              else sc.when(ax < F.lit(bound), F.lit(scale)))
    return F.when(F.isnan(x) | sc.isNull(), x).otherwise(
        F.floor(x * sc + F.lit(GRID_CUT)).cast("double") / sc)


def grid_scale(x: Column) -> Column:
    """The grid scale of ``round_fixed`` for x (NULL: leave x as it is)."""
    ax = F.abs(x)
    sc = None
    for bound, scale in GRID_BANDS:
        sc = (F.when(ax < F.lit(bound), F.lit(scale)) if sc is None
              else sc.when(ax < F.lit(bound), F.lit(scale)))
    return F.when(~F.isnan(x), sc)


def round_doubles(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Quantise every double column (presentation / oracle comparison).

    Two projections: the scale of each column first, then the grid; each
    expression is then generated once (a single fused expression per column
    repeats the band lookup and overflows the generated-method limit on
    wide aggregates)."""
    fields = [(f.name, isinstance(f.dataType, (T.DoubleType, T.FloatType))) for f in df.schema.fields]
    if digits is not None:
        return df.select(*[round_fixed(F.col(f"`{n}`"), digits).alias(n) if d else F.col(f"`{n}`")
                           for n, d in fields])
    scaled = df.select(*[F.col(f"`{n}`") for n, _ in fields],
                       *[grid_scale(F.col(f"`{n}`").cast("double")).alias(f"__sc{i}")
                         for i, (n, d) in enumerate(fields) if d])
    out = []
    for i, (n, d) in enumerate(fields):
        c = F.col(f"`{n}`")
        if d:
            x, sc = c.cast("double"), F.col(f"__sc{i}")
            c = F.when(sc.isNull(), x).otherwise(F.floor(x * sc + F.lit(GRID_CUT)).cast("double") / sc)
        out.append(c.alias(n))
    return scaled.select(*out)
