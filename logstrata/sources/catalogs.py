"""Sample catalogues: YAML documents that list raw files with their sourcetype."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from logstrata.functions import pytext
from logstrata.functions.barrier import once

TEMPLATE = "TEMPLATE.yml"


@F.arrow_udf(StringType())
def _yaml_to_json(documents: pa.Array) -> pa.Array:
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    return pa.array([json.dumps(yaml.load(d, Loader=loader), default=str) for d in documents.to_pylist()], pa.string())


# JSON texts of values that count as "no technique given".
_EMPTY = ("null", "[]", "{}", '""', "0", "0.0", "false")


def catalog_samples(documents: DataFrame) -> DataFrame:
    """``(manifest_path, pos, path, sourcetype, labeled)`` of ``(path, content)`` YAML documents.

    Templates and empty documents list nothing; a technique marks all samples of
    its document as labeled.
    """
    parsed = F.from_json(
        _yaml_to_json(F.col("content")),
        "mitre_technique variant, datasets array<struct<path string, sourcetype string>>",
    )
    technique = F.coalesce(F.to_json(F.col("doc.mitre_technique")), F.lit("null"))
    listed = documents.where(pytext.basename(F.col("path")) != TEMPLATE)
    return (
        once(listed.select(F.col("path").alias("manifest_path"), parsed.alias("_parsed")), doc=F.col("_parsed"))
        .select("manifest_path", (~technique.isin(*_EMPTY)).alias("labeled"), F.posexplode_outer("doc.datasets").alias("pos", "entry"))
        .where("pos is not null")
        .select("manifest_path", "pos", "entry.path", "entry.sourcetype", "labeled")
    )
