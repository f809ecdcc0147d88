"""Cutting lineage by a reliable checkpoint, in the folder that the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """``df``, computed once and written to ``spark.checkpoint.dir``; a temporary folder only on one machine where that is unset."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        root = sc.getConf().get("spark.checkpoint.dir")
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all of its machines share")
            root = f"file://{(own := tempfile.mkdtemp(prefix='waymark-'))}"
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(root)
    return df.checkpoint()
