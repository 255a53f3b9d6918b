"""Save and load fitted models per epoch.

Names follow "<run>--EPOCH-<n>". A naive Bayes model is its weight table
(Parquet) plus prior and word count (a one-row Parquet table); a
logistic-regression model is a ``PipelineModel`` folder, or its weight table and
word counts with a one-row table of the rest. Loading a missing
model raises instead of carrying on untrained.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from polarity.operators.logistic import TermLR
from polarity.operators.model import NBModel
from polarity.sources.files import exists


def model_path(root: str, run: str, epoch: int) -> str:
    return f"{root.rstrip('/')}/{run}--EPOCH-{epoch}"


def save_model(model, root: str, run: str, epoch: int, overwrite: bool = True) -> str:
    path = model_path(root, run, epoch)
    if isinstance(model, NBModel):
        mode = "overwrite" if overwrite else "errorifexists"
        model.weights.write.mode(mode).parquet(f"{path}/weights")
        spark = model.weights.sparkSession
        (spark.createDataFrame([(float(model.prior), int(model.n_words))],
                               "prior double, n_words long")
         .write.mode(mode).parquet(f"{path}/meta"))
    elif isinstance(model, TermLR):
        mode = "overwrite" if overwrite else "errorifexists"
        model.weights.write.mode(mode).parquet(f"{path}/weights")
        model.counts.write.mode(mode).parquet(f"{path}/counts")
        rest = (float(model.intercept), int(model.n_words), int(model.iterations), float(model.gradient))
        (model.weights.sparkSession.createDataFrame(
            [rest], "intercept double, n_words long, iterations long, gradient double")
         .write.mode(mode).parquet(f"{path}/meta"))
    elif isinstance(model, PipelineModel):
        w = model.write()
        (w.overwrite() if overwrite else w).save(path)
    else:
        raise TypeError(f"cannot save {type(model).__name__}")
    return path


def load_model(spark: SparkSession, root: str, run: str, epoch: int, kind: str = "nb"):
    path = model_path(root, run, epoch)
    if not exists(spark, path):
        raise FileNotFoundError(f"no saved model at {path}")
    if kind == "nb":
        meta = spark.read.parquet(f"{path}/meta").first()
        weights = spark.read.parquet(f"{path}/weights")  # word, weight, mass
        return NBModel(weights=weights, prior=meta["prior"], n_words=meta["n_words"])
    if exists(spark, f"{path}/counts"):
        m = spark.read.parquet(f"{path}/meta").first()
        return TermLR(spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/counts"),
                      m["intercept"], m["n_words"], m["iterations"], m["gradient"])
    return PipelineModel.load(path)
