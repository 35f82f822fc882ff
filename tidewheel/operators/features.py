"""Feature encoding with Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .category_index import CategoryIndex, fit_category_index
from .clean import FillValues, fit_fill_values
from .ordered import dim_id


def index_name(column: str) -> str:
    return f"{column}_index"


def one_hot_name(column: str) -> str:
    return f"{column}_ohe"


def indexer(columns: Sequence[str], unseen: str = "error") -> StringIndexer:
    """Index by falling frequency (ties by name); one stage and one pass for all columns."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[index_name(c) for c in columns],
        stringOrderType="frequencyDesc",
        handleInvalid=unseen,
    )


def encoder(columns: Sequence[str]) -> OneHotEncoder:
    """One-hot vectors of indexed columns, the last category being all zeros."""
    return OneHotEncoder(
        inputCols=[index_name(c) for c in columns], outputCols=[one_hot_name(c) for c in columns], dropLast=True
    )


def scaling(inputs: Sequence[str], invalid: str = "error") -> list:
    """Assemble one vector and divide each part by its sample deviation (no centring)."""
    return [
        VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid=invalid),
        StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False),
    ]


MAX_LABELS = 1_000_000


def string_index(df: DataFrame, columns: Sequence[str], unseen: str = "error", max_labels: int = MAX_LABELS) -> DataFrame:
    """Index with a fitted stage, which keeps every value on the driver: more than ``max_labels`` raise an error.

    Use :func:`frequency_index` for such columns.
    """
    for c in columns:
        if df.select(c).distinct().limit(max_labels + 1).count() > max_labels:
            raise ValueError(f"{c} has more than {max_labels} values: use frequency_index")
    return indexer(columns, unseen).fit(df).transform(df)


def frequency_index(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """The index of :func:`string_index` for a column of any cardinality.

    ``StringIndexer`` keeps all values on the driver; here they stay a table that is joined.
    Rows with a null are skipped.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ids = dim_id(counts, [F.desc("_n"), F.col(column)], "_id")
    index = (F.col("_id") - 1).cast("double").alias(name or index_name(column))
    return df.join(ids.select(column, index), column)


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return Pipeline(stages=[indexer(columns), encoder(columns)]).fit(df).transform(df)


def assemble_scale(df: DataFrame, inputs: Sequence[str], invalid: str = "error") -> DataFrame:
    return Pipeline(stages=scaling(inputs, invalid)).fit(df).transform(df)


def feature_stages(
    numeric: Sequence[str], categorical: Sequence[str], encoding: str, unseen: str = "skip", large: Sequence[str] = ()
) -> list:
    """Stages from raw columns to ``scaled_features`` for encoding 'index' or 'onehot'; ``large`` are indexed already."""
    stages = [indexer(categorical, unseen)] if categorical else []
    if encoding == "onehot":
        stages += [encoder(categorical)] if categorical else []
        encoded = [one_hot_name(c) for c in categorical]
    elif encoding == "index":
        encoded = [index_name(c) for c in categorical]
    else:
        raise ValueError(f"unknown encoding {encoding!r}")
    return stages + scaling([*numeric, *encoded, *map(index_name, large)], "skip")


@dataclass
class FeatureModel:
    """Imputation values, category tables and fitted feature stages, saved and loaded as one thing."""

    fills: FillValues
    stages: PipelineModel
    tables: list[CategoryIndex] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with an unseen category or a null left after imputation are skipped."""
        return self.stages.transform(self._known(self._indexed(self.fills.apply(df))))

    def transform_marked(self, df: DataFrame) -> DataFrame:
        """All rows with their features and ``skipped``, the causes for which :meth:`transform` would skip a row.

        A cause is ``unseen`` or ``missing`` and a column; rows that are kept have none, skipped rows have no features. Store
        the result: the kept rows, the others and :meth:`skip_counts` then come from one scoring pass. Observed
        metrics would do that too, but in Spark 4.1 an observation makes its session one that cannot be serialised, and
        every newly fitted logistic regression carries its session into tasks.
        """
        filled = self._indexed(self.fills.apply(df))
        checked = filled
        for stage in self._indexers():
            seen = [f"_seen_{c}" for c in stage.getInputCols()]
            checked = stage.copy({stage.handleInvalid: "keep", stage.outputCols: seen}).transform(checked)
        marks = [F.when(test, F.lit(cause)) for cause, test in self._causes().items()]
        given = F.struct(*filled.columns).alias("_given")
        checked = checked.select(*filled.columns, given, F.array_compact(F.array(*marks)).alias("_skipped"))
        kept, types = F.size("_skipped") == 0, dict(filled.dtypes)
        passing = checked.withColumns(
            {c: F.when(kept, F.col(c)).otherwise(F.lit(v).cast(types[c])) for c, v in self._harmless().items()}
        )
        features = F.when(kept, F.col("scaled_features")).alias("scaled_features")
        return self.stages.transform(passing).select("_given.*", features, F.col("_skipped").alias("skipped"))

    def skip_counts(self, marked: DataFrame) -> DataFrame:
        """``cause, n`` of a marked table: rows given and kept, and the rows of each cause. A row may have several causes."""
        counts = {"given": F.count(F.lit(1)), "kept": F.count_if(F.size("skipped") == 0)}
        counts |= {cause: F.count_if(F.array_contains("skipped", cause)) for cause in self._causes()}
        rows = [F.struct(F.lit(cause).alias("cause"), n.alias("n")) for cause, n in counts.items()]
        return marked.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))

    def _numbers(self) -> list[str]:
        """Columns that are assembled as they come."""
        made = {index_name(t.column) for t in self.tables}
        for stage in self.stages.stages:
            if isinstance(stage, VectorAssembler):
                return [c for c in stage.getInputCols() if c not in made]
            made.update(stage.getOutputCols())
        return []

    def _indexers(self) -> list[StringIndexerModel]:
        return [s for s in self.stages.stages if isinstance(s, StringIndexerModel)]

    def _causes(self) -> dict[str, Column]:
        """A test for each cause, on rows with indexes that keep unseen values."""
        causes = {}
        for t in self.tables:
            value = F.col(t.column)
            causes[f"unseen {t.column}"] = value.isNotNull() & F.col(index_name(t.column)).isNull()
            causes[f"missing {t.column}"] = value.isNull()
        for stage in self._indexers():
            for c, labels in zip(stage.getInputCols(), stage.labelsArray):
                causes[f"unseen {c}"] = F.col(c).isNotNull() & (F.col(f"_seen_{c}") == len(labels))
                causes[f"missing {c}"] = F.col(c).isNull()
        for c in self._numbers():
            number = F.col(c).cast("double")
            causes[f"missing {c}"] = number.isNull() | F.isnan(number)
        return causes

    def _harmless(self) -> dict[str, object]:
        """Values with which a row passes all stages."""
        words = {c: labels[0] for s in self._indexers() for c, labels in zip(s.getInputCols(), s.labelsArray)}
        return {**words, **{c: 0 for c in [*self._numbers(), *[index_name(t.column) for t in self.tables]]}}

    def _indexed(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, t: t.transform(d, index_name(t.column)), self.tables, df)

    def _known(self, df: DataFrame) -> DataFrame:
        return df.dropna(subset=[index_name(t.column) for t in self.tables]) if self.tables else df

    def save(self, spark: SparkSession, path: str) -> None:
        self.fills.save(spark, f"{path}/fills")
        self.stages.write().overwrite().save(f"{path}/stages")
        listed = spark.createDataFrame([(i, t.column) for i, t in enumerate(self.tables)], "place int, column string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/tables/list")
        for i, t in enumerate(self.tables):
            t.save(f"{path}/tables/{i}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        """A model saved before there were category tables has none."""
        try:
            listed = spark.read.parquet(f"{path}/tables/list").orderBy("place").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            listed = []
        tables = [CategoryIndex.load(spark, r["column"], f"{path}/tables/{r['place']}") for r in listed]
        return cls(FillValues.load(spark, f"{path}/fills"), PipelineModel.load(f"{path}/stages"), tables)


def fit_features(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    encoding: str = "onehot",
    fills: FillValues | None = None,
    large: Sequence[str] = (),
) -> FeatureModel:
    """Fit imputation (unless given), encoding and scaling on training rows only.

    Categories in ``large`` have any number of values: their index is a stored table that is joined, and one feature
    in either encoding. They are not imputed.
    """
    kept = train.select(*numeric, *categorical, *large).persist(StorageLevel.MEMORY_AND_DISK)  # every stage reads it
    try:
        fills = fills or fit_fill_values(kept, numeric, categorical)
        model = FeatureModel(fills, PipelineModel([]), [fit_category_index(kept, c) for c in large])
        ready = model._known(model._indexed(fills.apply(kept)))
        model.stages = Pipeline(stages=feature_stages(numeric, categorical, encoding, large=large)).fit(ready)
    finally:
        kept.unpersist()
    return model
