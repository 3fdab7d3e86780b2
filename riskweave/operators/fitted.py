"""Fitted encoders (F4, F5, F14, F15, F17 with M20, M21): what training rows taught, kept with the model.

``pyspark.ml`` estimators whose models hold value lists, medians and scaling
parameters, so one ``PipelineModel`` goes to disk with the learner and scores
other rows without their statistics. A model's numbers and values are a
Parquet table beside its metadata, not a parameter string: a list of a million
values is read like any other table.

Values that the training rows did not have are *unseen*: their code is -1 and
their one-hot columns are all 0 (``unseen="other"``), or the transform fails
(``unseen="error"``). A missing value counts as the fill value, which is unseen
too unless a training row lacked a value. NaN is a missing number. Missing
numbers of a column that was always missing stay missing; a column without
spread is divided by 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import encode as E
from riskweave.session import scratch_path

FITTED = "column string, pos int, value string, number double, scale double"


class _Writer(MLWriter):
    def __init__(self, model: FittedModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802 - the name that pyspark.ml calls
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.active())
        self.model.fitted.write.parquet(f"{path}/fitted")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.kind(spark.read.schema(FITTED).parquet(f"{path}/fitted"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class FittedModel(Model, HasInputCols, MLReadable, MLWritable):
    """A transformer over a table (column, pos, value, number, scale)."""

    def __init__(self, fitted: DataFrame | None = None):
        super().__init__()
        self.fitted = fitted

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

    def numbers(self) -> dict[str, tuple[float | None, float | None]]:
        """(number, scale) of each column: as many rows as there are columns."""
        return {r["column"]: (r["number"], r["scale"]) for r in self.fitted.collect()}


class _ColumnsEstimator(Estimator, HasInputCols):
    def __init__(self, cols: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(cols))

    def _model(self, df: DataFrame, rows: list[tuple], kind: type) -> FittedModel:
        model = kind(df.sparkSession.createDataFrame(rows, FITTED))
        return self._copyValues(model)


def _number(c: str):
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x), x)


class MedianFill(_ColumnsEstimator):
    """missing numbers get the training median; columns become double."""

    def _fit(self, df: DataFrame) -> MedianFillModel:
        cols = self.getInputCols()
        med = E.medians(df.select(*(_number(c).alias(c) for c in cols)), cols)
        return self._model(df, [(c, 0, None, med[c], None) for c in cols], MedianFillModel)


class MedianFillModel(FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        found = self.numbers()
        return df.withColumns({c: F.coalesce(_number(c), F.lit(found[c][0]).cast("double")) for c in self.getInputCols()})


class PopulationScaler(_ColumnsEstimator):
    """(x - mean) / population sd of the training rows."""

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        found = E.standardise_params(df.select(*(_number(c).alias(c) for c in cols)), cols)
        return self._model(df, [(c, 0, None, found[c][0], found[c][1]) for c in cols], PopulationScalerModel)


class PopulationScalerModel(FittedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        found = self.numbers()
        return E.standardise(df.withColumns({c: _number(c) for c in self.getInputCols()}), self.getInputCols(),
                             {c: (0.0 if m is None else m, s) for c, (m, s) in found.items()})


class _CategoryParams(Params):
    kind = Param(Params._dummy(), "kind", "codes or onehot", TypeConverters.toString)
    fill = Param(Params._dummy(), "fill", "value of a missing category", TypeConverters.toString)
    unseen = Param(Params._dummy(), "unseen", "other or error", TypeConverters.toString)


class CategoryEncoder(_ColumnsEstimator, _CategoryParams):
    """label codes (places among the sorted training values) or 0/1 columns."""

    def __init__(self, cols: Sequence[str] = (), kind: str = "codes", fill: str = E.UNKNOWN, unseen: str = "other"):
        super().__init__(cols)
        if kind not in ("codes", "onehot") or unseen not in ("other", "error"):
            raise ValueError("kind is codes or onehot, unseen is other or error")
        self._set(kind=kind, fill=fill, unseen=unseen)

    def _fit(self, df: DataFrame) -> CategoryEncoderModel:
        fill, lists = self.getOrDefault("fill"), None
        for c in self.getInputCols():
            codes = E.dense_codes(df.select(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(fill)).alias("value")), "value", "pos")
            rows = codes.select(F.lit(c).alias("column"), "pos", "value", F.lit(None).cast("double").alias("number"),
                                F.lit(None).cast("double").alias("scale"))
            lists = rows if lists is None else lists.unionByName(rows)
        if lists is None:
            lists = df.sparkSession.createDataFrame([], FITTED)
        path = scratch_path(df.sparkSession, "category-values")  # written once: the model does not read the training rows again
        lists.write.parquet(path)
        return self._copyValues(CategoryEncoderModel(df.sparkSession.read.schema(FITTED).parquet(path)))


class CategoryEncoderModel(FittedModel, _CategoryParams):
    def _transform(self, df: DataFrame) -> DataFrame:
        fill, strict = self.getOrDefault("fill"), self.getOrDefault("unseen") == "error"
        names, out = df.columns, df
        columns: dict[str, list] = {}
        for c in self.getInputCols():
            values = self.fitted.where(F.col("column") == F.lit(c)).select("value", "pos")
            few = values.orderBy("pos").limit(E.MAX_INLINE_VALUES + 1).collect()
            filled = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(fill))
            if self.getOrDefault("kind") == "onehot":
                if len(few) > E.MAX_INLINE_VALUES:  # an output column each
                    few = values.orderBy("pos").limit(E.MAX_CATEGORY_VALUES + 1).collect()
                    if len(few) > E.MAX_CATEGORY_VALUES:
                        raise ValueError(f"{c}: more than {E.MAX_CATEGORY_VALUES} values to one-hot encode")
                if strict:
                    known = F.array(*(F.lit(r["value"]) for r in few)).cast("array<string>")
                    filled = F.when(F.array_contains(known, filled), filled).otherwise(F.raise_error(F.concat(F.lit(f"{c}: unseen value "), filled)))
                columns[c] = [(filled == F.lit(r["value"])).cast("int").alias(f"{c}_{r['value']}") for r in few]
                continue
            if len(few) <= E.MAX_INLINE_VALUES:
                known = F.array(*(F.lit(r["value"]) for r in few)).cast("array<string>")
                code = (F.array_position(known, filled) - 1).cast("int")
            else:
                # A unique list; a value that most rows share makes a skewed left side, which AQE splits.
                out = out.withColumn("fitted_value", filled).join(values.withColumnRenamed("value", "fitted_value")
                                                                  .withColumnRenamed("pos", "fitted_pos"), "fitted_value", "left")
                code = F.coalesce("fitted_pos", F.lit(-1))
            if strict:
                code = F.when(code >= 0, code).otherwise(F.raise_error(F.concat(F.lit(f"{c}: unseen value "), filled)).cast("int"))
            out = out.withColumn(c, code).select(*(F.col(f"`{n}`") for n in names))
        keep = [F.col(f"`{n}`") for n in names if n not in columns]
        return out.select(*keep, *(x for c in self.getInputCols() for x in columns.get(c, [])))
