"""Boosting as a ``pyspark.ml`` Estimator and Model, for pipelines and cross-validation."""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, functions as F

from formbook.ml.samme import LABEL_META, SammeClassifier, SammeModel, SammeParams
from formbook.schemas import SEED


class _BoostedTreesParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "boosting rounds at most", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "factor on each tree's say", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "rows of a leaf at least", TypeConverters.toInt)
    minSamplesSplit = Param(Params._dummy(), "minSamplesSplit", "rows of a split at least", TypeConverters.toInt)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "features tried per split: all, sqrt or log2", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(
            featuresCol="features", labelCol="label", predictionCol="prediction", seed=SEED, numTrees=100,
            learningRate=1.0, maxDepth=4, minSamplesLeaf=1, minSamplesSplit=2, maxFeatures="all",
        )

    def boosting(self) -> SammeParams:
        get, most = self.getOrDefault, self.getOrDefault(self.maxFeatures)
        return SammeParams(
            n_estimators=get(self.numTrees), learning_rate=get(self.learningRate), max_depth=get(self.maxDepth),
            min_samples_leaf=get(self.minSamplesLeaf), min_samples_split=get(self.minSamplesSplit),
            max_features=None if most == "all" else most, seed=get(self.seed),
        )


class BoostedTrees(Estimator, _BoostedTreesParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees over a vector column and a label 0, 1 or 2; classes weigh alike."""

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", seed=SEED, numTrees=100,
        learningRate=1.0, maxDepth=4, minSamplesLeaf=1, minSamplesSplit=2, maxFeatures="all",
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "BoostedTreesModel":
        rows = dataset.select(
            F.col(self.getFeaturesCol()).alias("features"),
            F.col(self.getLabelCol()).cast("double").alias("label", metadata=LABEL_META),
        )
        return self._copyValues(BoostedTreesModel(SammeClassifier(self.boosting()).fit(rows)))


class BoostedTreesModel(Model, _BoostedTreesParams, MLReadable, MLWritable):
    """Adds the prediction, and ``scores``, ``probabilities`` and ``predicted_label``, which must not be there."""

    def __init__(self, trees: SammeModel):
        super().__init__()
        self.trees = trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.trees.transform(dataset, self.getFeaturesCol(), self.getPredictionCol())

    def copy(self, extra=None) -> "BoostedTreesModel":
        return self._copyValues(BoostedTreesModel(self.trees), extra)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        self.model.trees.save(self.sparkSession, f"{path}/boosting")
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)


class _ModelReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> BoostedTreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(SammeModel.load(self.sparkSession, f"{path}/boosting"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
