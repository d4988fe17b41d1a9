"""Small documents: settings, manifests, checksums, viewer states."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical(document: Any) -> str:
    """JSON text with sorted keys and no spaces: equal documents have equal text."""
    return json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(document: Any) -> str:
    return hashlib.sha256(canonical(document).encode()).hexdigest()


def write(path: str, document: Any, overwrite: bool = False) -> None:
    """Writes a JSON document at once or not at all."""
    if os.path.exists(path) and not overwrite:
        raise FileExistsError(path)
    handle, name = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(handle, "w") as f:
        json.dump(document, f, indent=2, sort_keys=True)
    os.replace(name, path)


def overlaid(defaults: dict, given: dict) -> dict:
    """Defaults with what is given on top, nested documents merged."""
    out = dict(defaults)
    for k, v in given.items():
        out[k] = overlaid(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, bytes) of every file below a folder; one task a file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def segment_properties(ids: DataFrame) -> DataFrame:
    """One row of JSON: ids in numeric order with their names, for a viewer."""
    rows = F.sort_array(F.collect_list(F.struct(F.col("id").cast("long").alias("id"), "name")))
    doc = ids.agg(rows.alias("r"))
    inline = F.struct(F.transform("r", lambda x: x["id"].cast("string")).alias("ids"), F.array(F.struct(F.lit("label").alias("id"), F.lit("label").alias("type"), F.transform("r", lambda x: x["name"]).alias("values"))).alias("properties"))
    return doc.select(F.to_json(F.struct(F.lit("neuroglancer_segment_properties").alias("@type"), inline.alias("inline"))).alias("json"))


def viewer_url(states: DataFrame, base: str) -> DataFrame:
    """(state) JSON text -> with ``url``: the state percent-encoded after ``#!``."""
    return states.withColumn("url", F.concat(F.lit(f"{base}#!"), F.replace(F.url_encode("state"), F.lit("+"), F.lit("%20"))))


def read_settings(path: str) -> dict:
    """Settings from a JSON or YAML file; YAML needs its library."""
    with open(path, encoding="utf-8") as f:
        if path.lower().endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as missing:
                raise ImportError("YAML settings need the yaml package; JSON does not") from missing
            out = yaml.safe_load(f)
        else:
            out = json.load(f)
    if not isinstance(out, dict):
        raise ValueError(f"{path} holds no mapping")
    return out


def checksum_lines(files: DataFrame) -> DataFrame:
    """(path, sha256) -> (path, value): the lines of a checksum file, to be written in order of path."""
    return files.select("path", F.concat("sha256", F.lit("  "), "path").alias("value"))


def viewer_states(layers: DataFrame, key: str, scale: float) -> DataFrame:
    """(key, position, name, kind, source, x, y, z) -> (key, state): the JSON state of a viewer with the
    layers in order, at the mean of their centres."""
    one = F.struct(F.col("position"), F.struct(F.col("kind").alias("type"), "source", "name").alias("layer"))
    per = layers.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("l"), *[F.avg(a).alias(a) for a in "xyz"])
    state = F.struct(F.array("x", "y", "z").alias("position"), F.lit(scale).alias("crossSectionScale"), F.transform("l", lambda r: r["layer"]).alias("layers"), F.lit("xy").alias("layout"))
    return per.select(key, F.to_json(state).alias("state"))
