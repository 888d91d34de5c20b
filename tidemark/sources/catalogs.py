"""Recordings from CSV files and folder trees, label registries, and user sources."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import audio_uri
from .ranged import file_checksums, listed
from .records import csv_records


class CatalogRefused(ValueError):
    """A catalog whose header or template does not fit its configuration."""


def _header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.option("header", False).option("inferSchema", False).csv(path).limit(1).collect()
    return [str(x or "").lstrip("﻿") for x in first[0]] if first else []


def _located(cell: Column, file: Column) -> Column:
    """The stored URI of an audio cell; a relative place is read from the folder of its file."""
    folder = F.regexp_replace(file, "/[^/]*$", "")
    local = F.try_url_decode(F.regexp_replace(F.regexp_replace(folder, "^file:/+", "/"), "[+]", "%2B"))
    relative = ~cell.startswith("/") & ~cell.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    away = ~folder.rlike("^(file:)?/")
    return F.when(F.trim(cell) == "", cell).when(relative & away, F.concat(folder, F.lit("/"), cell)).otherwise(audio_uri(cell, local))


def csv_catalog(spark: SparkSession, path: str, namespace: str, id_column: str, audio_column: str, duration_column: str | None = None) -> DataFrame:
    """(file, row, namespace, value, audio_uri, duration_seconds, problem) of each record; the header is row 1 of its file.

    Cells may hold line breaks in quotes, also over splits of a file; empty records have a number and no row here, short
    ones have empty cells. Blank ids and places are problems, blank durations unknown. Files must have one header.
    """
    records = csv_records(spark, path)
    heads = records.where("record = 1").select("text").distinct().limit(2).collect()  # one, unless headers differ
    if not heads:
        raise CatalogRefused("there is no header row")
    if len(heads) > 1:
        raise CatalogRefused("the files have different headers")
    header = next(csv.reader(io.StringIO(heads[0]["text"], newline="")), [])
    for name in filter(None, (id_column, audio_column, duration_column)):
        if header.count(name) != 1:
            raise CatalogRefused(f"the header must have {name} once")
    schema = ", ".join(f"c{i} string" for i in range(len(header)))
    cells = F.from_csv("text", schema, {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    rows = records.where("record > 1 AND text <> ''").withColumn("cells", cells)
    at = lambda name: F.coalesce(F.col(f"cells.c{header.index(name)}"), F.lit(""))
    duration = F.trim(at(duration_column)).try_cast("double") if duration_column else F.lit(None).cast("double")
    given = (F.trim(at(duration_column)) != "") if duration_column else F.lit(False)
    uri = _located(at(audio_column), F.col("file"))
    problem = (
        F.when(~F.is_valid_utf8("text"), "not_utf8")
        .when(F.trim(at(id_column)) == "", "blank_id")
        .when(F.trim(at(audio_column)) == "", "blank_audio")
        .when(uri.isNull(), "bad_uri")
        .when(given & (duration.isNull() | F.isnan(duration) | (duration <= 0) | (duration == float("inf"))), "bad_duration")
    )
    return rows.select(
        "file", F.col("record").alias("row"), F.lit(namespace).alias("namespace"), at(id_column).alias("value"), F.coalesce(uri, at(audio_column)).alias("audio_uri"),
        F.when(given, duration).alias("duration_seconds"), problem.alias("problem"),
    )


def template_regex(template: str) -> tuple[str, list[str]]:
    """Java regex of a ``{field}`` template over whole relative paths, and its fields; a repeated field must match alike."""
    fields: list[str] = []
    out = []
    for literal, field in re.findall(r"([^{}]*)(?:\{(\w+)\})?", template):
        out.append(re.sub(r"([^\w/ -])", r"\\\1", literal))
        if field:
            out.append(f"\\{fields.index(field) + 1}" if field in fields else "([^/]+)")
            if field not in fields:
                fields.append(field)
    return "^" + "".join(out) + "$", fields


def folder_catalog(spark: SparkSession, root: str, namespace: str, layout: str, identity: str) -> DataFrame:
    """Files below ``root`` whose relative path matches ``layout``; the identity is built by a second template."""
    regex, fields = template_regex(layout)
    unknown = [f for f in re.findall(r"\{(\w+)\}", identity) if f not in fields]
    if unknown:
        raise CatalogRefused(f"fields that the layout lacks: {unknown}")
    files = listed(spark, root)
    base = re.sub(r"^file:/+", "/", root).rstrip("/")
    relative = F.substring_index(F.regexp_replace(F.col("path"), "^[a-z]+:/+", "/"), base + "/", -1)
    matched = files.withColumn("relative", relative).where(F.col("relative").rlike(regex))
    values = {f: F.regexp_extract("relative", regex, i + 1) for i, f in enumerate(fields)}
    parts = [values[field] if field else F.lit(literal) for literal, field in re.findall(r"([^{}]+)|\{(\w+)\}", identity)]
    return matched.select(F.lit(namespace).alias("namespace"), F.concat(*parts).alias("value"), F.col("path").alias("audio_uri"), "relative", *(values[f].alias(f) for f in fields))


REGISTRY_COLUMNS = ("class_index", "label", "label_kind", "scientific_name", "common_name", "gbif_taxon_key")


def registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """A label registry with a ``problem`` per row: kind obligations, repeated labels, class indexes that are not dense.

    ``fingerprint`` is the checksum of the file's bytes. A registry of several files, without rows, with a repeated
    column or without a required one is refused.
    """
    files = file_checksums(spark, path, "*.csv").limit(2).collect()  # one
    if len(files) != 1:
        raise CatalogRefused("a registry is one CSV file")
    header = _header(spark, path)
    repeated = [c for c in REGISTRY_COLUMNS if header.count(c) > 1]
    if repeated:
        raise CatalogRefused(f"the registry repeats {repeated}")
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in REGISTRY_COLUMNS[:3] if c not in rows.columns]
    if missing:
        raise CatalogRefused(f"the registry lacks {missing}")
    if rows.isEmpty():
        raise CatalogRefused("the registry has no rows")
    text = {c: F.nullif(F.col(c), F.lit("")) if c in rows.columns else F.lit(None).cast("string") for c in REGISTRY_COLUMNS}
    rows = rows.select(
        text["class_index"].try_cast("int").alias("class_index"), text["label"].alias("label"), text["label_kind"].alias("label_kind"),
        text["scientific_name"].alias("scientific_name"), text["common_name"].alias("common_name"), text["gbif_taxon_key"].try_cast("long").alias("gbif_taxon_key"),
    )
    name, key = F.col("scientific_name").isNotNull(), F.col("gbif_taxon_key").isNotNull()
    kind = F.col("label_kind")
    obligations = F.when(kind == "taxon", name & key).when(kind == "unresolved", name & ~key).when(kind == "non_taxonomic", ~name & ~key).otherwise(F.lit(False))
    same = F.count(F.lit(1)).over(Window.partitionBy("label"))
    place = F.row_number().over(Window.orderBy("class_index")) - 1  # a vocabulary is one small file
    problem = (
        F.when(F.col("label").isNull(), "blank_label").when(~F.coalesce(obligations, F.lit(False)), "kind_obligations").when(same > 1, "repeated_label").when(~place.eqNullSafe(F.col("class_index")), "class_index_not_dense")
    )
    return rows.withColumns({"problem": problem, "fingerprint": F.lit(files[0]["checksum"])})


def verify_pinned(pins: DataFrame, found: DataFrame) -> DataFrame:
    """Pins (role, path, size_bytes, digest) with a ``code`` where the file is missing or differs."""
    joined = pins.join(found, "path", "left")
    code = F.when(F.col("length").isNull(), "model_file_unavailable").when((F.col("length") != F.col("size_bytes")) | (F.col("checksum") != F.col("digest")), "model_file_digest_mismatch")
    return joined.select("role", "path", code.alias("code"))


CATALOGS: dict[str, Callable[..., DataFrame]] = {"csv_list": csv_catalog, "folder_layout": folder_catalog}
MAX_SOURCE_BYTES = 65_536


def select_recordings(spark: SparkSession, adapter: str, source: str, **settings) -> DataFrame:
    """Recordings of a registered source, each with a ``source`` text that says where it comes from (64 KiB at most)."""
    if len(source.encode()) > MAX_SOURCE_BYTES:
        raise CatalogRefused("the source text is too long")
    return CATALOGS[adapter](spark, **settings).withColumn("source", F.lit(source))
