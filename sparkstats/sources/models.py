"""Model storage: Parquet tables and `PipelineModel` directories in a shared folder."""

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one in the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Feature steps and estimator as one artefact."""
    model.write().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, id_col: str = "id") -> DataFrame:
    """One prediction per input row; nothing is fitted again."""
    return model.transform(df).select(id_col, "prediction")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a cut in the lineage
    that survives lost executors."""
    path = new_path(df.sparkSession, name)
    save_table(df, path)
    return load_table(df.sparkSession, path)


@dataclass
class Written:
    """A table in the shared folder that an iterative fit replaces as it goes on and deletes at its end."""

    frame: DataFrame
    path: str

    @staticmethod
    def of(df: DataFrame, name: str) -> "Written":
        path = new_path(df.sparkSession, name)
        save_table(df, path)
        return Written(load_table(df.sparkSession, path), path)

    def replaced(self, df: DataFrame) -> "Written":
        """Write `df`, which may read this table, and delete this one."""
        new = Written.of(df, self.path.rsplit("/", 1)[1].rsplit("-", 1)[0])
        self.delete()
        return new

    def delete(self) -> None:
        spark = self.frame.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
