"""Scalar functions on text: URIs, paths, canonical JSON and digests."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, functions as F

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def percent_encode(text: Column) -> Column:
    """Percent-encoding of everything but letters, digits and ``-._~``."""
    encoded = F.url_encode(text)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return encoded


def hive_layout(kind: Column, namespace: Column, value: Column) -> Column:
    return F.concat(kind, F.lit("/recording_namespace="), percent_encode(namespace), F.lit("/recording_value="), percent_encode(value), F.lit("/"), kind, F.lit(".parquet"))


def decoded_partition(text: Column) -> Column:
    """A value read from a percent-encoded layout, which Spark decodes byte by byte."""
    return F.decode(F.encode(text, "ISO-8859-1"), "UTF-8")


def _encoded_path(path: Column) -> Column:
    return F.array_join(F.transform(F.split(path, "/"), percent_encode), "/")


def audio_uri(location: Column, folder: Column | None = None) -> Column:
    """The stored URI: other schemes as written, paths as percent-encoded ``file:///`` URIs; null if refused."""
    is_path = location.startswith("/")
    is_file = F.lower(location).startswith("file:")
    inner = F.try_url_decode(F.regexp_replace(F.substr(location, F.lit(8)), "[+]", "%2B"))
    same = F.concat(F.lit("file://"), _encoded_path(inner))
    uri = F.when(is_path, F.concat(F.lit("file://"), _encoded_path(location))).when(is_file, F.when(location == same, location)).when(location.rlike(SCHEME), location)
    if folder is not None:
        uri = uri.otherwise(F.concat(F.lit("file://"), _encoded_path(F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"), location))))
    return uri


def location_form(location: Column) -> Column:
    """s3, bundled, file, path, or null for none of these."""
    return (
        F.when(location.rlike("^s3://[^/]+/."), "s3")
        .when(location.rlike("^bundled:."), "bundled")
        .when(location.rlike("^file:///."), "file")
        .when(location.rlike("^/."), "path")
    )


def storable(text: Column) -> Column:
    """Not empty, no NUL, valid UTF-8."""
    return F.coalesce((F.length(text) > 0) & (F.instr(text, "\x00") == 0) & F.is_valid_utf8(text), F.lit(False))


def is_canonical_digest(text: Column) -> Column:
    return text.rlike("^sha256:v1:[0-9a-f]{64}\\z")


def is_checksum(text: Column) -> Column:
    return text.rlike("^sha256:[0-9a-f]{64}\\z")


def under_root(uri: Column, root: Column) -> Column:
    """Whether an s3 URI is strictly below a root in the same bucket, without empty or dot segments."""
    parts = lambda c: F.split(F.regexp_replace(c, "^s3://", ""), "/")
    u, r = parts(uri), parts(F.regexp_replace(root, "/$", ""))
    return (F.size(u) > F.size(r)) & (F.slice(u, F.lit(1), F.size(r)) == r) & ~F.exists(u, lambda x: x.isin("", ".", ".."))


def selection_test(field: Column, value: object) -> Column:
    """Equality with a text, membership in a list, or an inclusive range {from, to} in code point order."""
    if isinstance(value, str):
        return field == value
    if isinstance(value, list):
        return field.isin(*value)
    if isinstance(value, dict) and set(value) == {"from", "to"}:
        return field.between(value["from"], value["to"])
    raise ValueError(f"not a selection: {value!r}")


def double_text(number: Column) -> Column:
    """The shortest text of a finite double, as in JSON written by Python, for magnitudes from 1e-3 to 1e16; zero has no sign."""
    plain = F.when(number == 0, F.lit("0.0")).otherwise(number.cast("string"))
    large = F.concat(number.cast("decimal(20,0)").cast("string"), F.lit(".0"))
    return F.when((F.abs(number) >= 1e7) & (F.abs(number) < 1e16) & (F.floor(number) == number), large).otherwise(plain)


def json_text(text: Column) -> Column:
    """A JSON string literal; null stays the literal null."""
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(text.alias("v"))), '(?s)^\\{"v":(.*)\\}\\z', 1), F.lit("null"))


def canonical_json(fields: dict[str, Column]) -> Column:
    """A JSON object with sorted keys and no spaces; the columns give the JSON text of each value."""
    parts: list[Column] = []
    for i, name in enumerate(sorted(fields)):
        parts += [F.lit(("," if i else "{") + json.dumps(name, ensure_ascii=False) + ":"), F.coalesce(fields[name], F.lit("null"))]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def sha256_v1(json_column: Column) -> Column:
    return F.concat(F.lit("sha256:v1:"), F.sha2(json_column, 256))


def checksum(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def detection_id(namespace: Column, value: Column, work_digest: Column, recipe: Column, start: Column, rank: Column) -> Column:
    return sha256_v1(
        canonical_json(
            {
                "rank": rank.cast("string"),
                "recipe_fingerprint": json_text(recipe),
                "recording_namespace": json_text(namespace),
                "recording_value": json_text(value),
                "recording_work_digest": json_text(work_digest),
                "window_start_s": double_text(start),
            }
        )
    )


def index_uris(root: Column, exported_at: Column) -> tuple[Column, Column]:
    """(dated path, current path) of an index export at a UTC time."""
    stamp = F.date_format(exported_at, "yyyyMMdd'T'HHmmss'Z'")
    return F.concat(root, F.lit("/index/history/"), stamp, F.lit("/current_files.parquet")), F.concat(root, F.lit("/index/current_files.parquet"))


def canonical_number(value: float) -> float:
    """Driver-side form of a parameter: no negative zero, nothing that is not finite."""
    if not math.isfinite(value):
        raise ValueError("not a finite number")
    return value + 0.0
