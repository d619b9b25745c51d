"""Experiment documents exported as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trialmetrics.sources.quarantine import Quarantine, parted
from trialmetrics.sources.schemas import EXPERIMENT_DOCUMENTS
from trialmetrics.sources.tables import CORRUPT


def read_experiment_documents(spark: SparkSession, path: str, one_per_file: bool = True,
                              quarantine: Quarantine | None = None) -> DataFrame:
    """Documents of exported responses ``{"experiments": [...], "offset": n}``.

    ``position`` orders them: pages by their offset (by file name if it is missing), and
    documents as they stand in the page. A file holds one response, however many lines it
    takes, or one per line. A response that cannot be read in full is an error, or set apart in ``quarantine``.
    """
    response = T.StructType([T.StructField("experiments", T.ArrayType(EXPERIMENT_DOCUMENTS)),
                             T.StructField("offset", T.LongType())])
    if quarantine is None:
        pages = spark.read.schema(response).json(path, multiLine=one_per_file, mode="FAILFAST")
    else:
        pages = spark.read.schema(response.add(CORRUPT, "string")).json(path, multiLine=one_per_file, columnNameOfCorruptRecord=CORRUPT)
        # What was read of it comes along: of a broken response alone Spark reads nothing.
        record = F.concat(F.col(CORRUPT), F.lit(" | read: "), F.coalesce(F.size("experiments"), F.lit(0)).cast("string"))
        reason = F.when(F.col(CORRUPT).isNotNull(), "not a response").otherwise("")
        pages = parted(pages, reason, record, "documents", quarantine)
    pages = pages.select("offset", F.input_file_name().alias("file"), "experiments")
    documents = pages.select("offset", "file", F.posexplode("experiments").alias("index", "document"))
    return documents.select(F.struct("offset", "file", "index").alias("position"), "document.*")
