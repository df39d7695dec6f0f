"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space that separates words: blank, tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
#: Remainder of the split whose rows are never learned from.
HELD_OUT, FOLDS = 1, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether the row's label must not be learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the cluster's ``spark.checkpoint.dir``; only a local session may take a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="ledgerspan-llm-")
    context.setCheckpointDir(root)


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, where lost executors can't take it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name that driver and executors all see."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"


def map_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow``; workers also look for this package where the driver found it."""
    root = str(pathlib.Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
    return df.mapInArrow(function, schema)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
