"""Principal components with centred projection."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions.vectors import concat_features


class CentredPCA:
    """Spark's PCA projects without centring; here the mean is taken off first, so angles between projections are those around the mean."""

    def __init__(self, model: PCAModel, mean: list[float]) -> None:
        self.model, self.mean = model, mean

    @classmethod
    def fit(cls, df: DataFrame, k: int, vector: str = "embedding") -> CentredPCA:
        rows = df.where(F.col(vector).isNotNull()).select(array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
        stats = rows.agg(Summarizer.mean(F.col("v")).alias("mean"), F.count("*").alias("n")).first()
        if not stats["n"] or k > min(stats["n"], len(stats["mean"])):
            raise ValueError(f"{k} components of {stats['n']} rows")
        return cls(PCA(k=k, inputCol="v", outputCol="p").fit(rows), [float(x) for x in stats["mean"]])

    @property
    def explained(self) -> list[float]:
        return [float(x) for x in self.model.explainedVariance]

    def transform(self, df: DataFrame, vector: str = "embedding", out: str = "reduced") -> DataFrame:
        """df with the projection; a null vector has a null one."""
        mean = F.array(*(F.lit(m) for m in self.mean))
        centred = F.zip_with(F.col(vector).cast("array<double>"), mean, lambda x, m: x - m)
        some = F.when(F.col(vector).isNotNull(), centred).otherwise(mean)
        done = self.model.setInputCol("_v").setOutputCol("_p").transform(df.withColumn("_v", array_to_vector(some)))
        return done.withColumn(out, F.when(F.col(vector).isNotNull(), vector_to_array("_p"))).drop("_v", "_p")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(self.mean,)], "mean array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/mean")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CentredPCA:
        return cls(PCAModel.load(f"{path}/model"), spark.read.parquet(f"{path}/mean").first()[0])


def combine_features(first: DataFrame, second: DataFrame, k: int | None = None, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(key, vector): both encoders' features by id, one after the other, and their first k components if k is given."""
    joined = first.select(key, F.col(vector).alias("_a")).join(second.select(key, F.col(vector).alias("_b")), key)
    both = joined.select(key, concat_features("_a", "_b").alias(vector))
    return both if k is None else CentredPCA.fit(both, k, vector).transform(both, vector, "_r").select(key, F.col("_r").alias(vector))
