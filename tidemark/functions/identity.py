"""Content-addressed identities of schemas and batches."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import canonical_json
from tidemark.model import FactModel


def schema_text(schema: T.StructType) -> str:
    """``name:type:nullable`` per field, in field order, joined by a bar."""
    return "|".join(
        f"{f.name}:{f.dataType.simpleString()}:{str(f.nullable).lower()}" for f in schema.fields
    )


def schema_fingerprint(schema: T.StructType) -> str:
    return hashlib.sha256(schema_text(schema).encode()).hexdigest()


def model_schema_version(model: FactModel) -> str:
    """Fingerprint of the typed fact and filing columns of a model."""
    declared = {**model.fact_types}
    fields = [f"{n}:{t}:{str(n not in model.fact_key).lower()}" for n, t in declared.items()]
    fields += [f"{n}:{t}:true" for n, t in model.filing_types.items()]
    return hashlib.sha256("|".join(fields).encode()).hexdigest()


def manifest_entries(
    source_hashes: Column, schema_version: Column, code_version: Column, params: Mapping[str, Column]
) -> Column:
    """Manifest map: sorted source hashes, schema, code version, ``param.*``."""
    pairs = [
        F.lit("source_sha256"),
        F.array_join(F.sort_array(source_hashes), ","),
        F.lit("schema_version"),
        schema_version,
        F.lit("code_sha"),
        code_version,
    ]
    for name, value in params.items():
        pairs += [F.lit(f"param.{name}"), value]
    return F.create_map(*pairs)


def with_batch_identity(manifests: DataFrame, entries: Column) -> DataFrame:
    """Add ``manifest_json`` and its SHA-256, ``batch_id``."""
    return manifests.withColumn("manifest_json", canonical_json(entries)).withColumn(
        "batch_id", F.sha2("manifest_json", 256)
    )


def batch_manifest(
    source_hashes: list[str], schema_version: str, code_version: str, params: Mapping[str, str]
) -> tuple[str, str]:
    """``(batch_id, manifest_json)`` of one batch whose file hashes are known.

    Gives the same text as :func:`with_batch_identity`; used once per batch by
    the ingest job, where the hashes are already a handful of driver values.
    """
    entries = {
        "source_sha256": ",".join(sorted(source_hashes)),
        "schema_version": schema_version,
        "code_sha": code_version,
        **{f"param.{k}": v for k, v in params.items()},
    }
    text = json.dumps(entries, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest(), text
