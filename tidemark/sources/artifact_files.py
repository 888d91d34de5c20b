"""Files of one recording each, with their provenance in the Parquet footer: a sink that publishes them, and verified readers.

The sink writes staged files in tasks and publishes them when all tasks have ended: a file is linked to its place only
where none is, equal bytes are a replay, other bytes refuse the whole write. Readers look at footers by ranged reads and
take the width and the storage type of vectors from the header.
"""

from __future__ import annotations

import hashlib
import io
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .ranged import Ranged, dealt, file_system, listed, opens_in_tasks, stream_sha256

KEY = ["namespace", "value"]
PREFIX = "tidemark."
# The entries of a header, without the prefix.
FILE_KEYS = ("contract", "recording_work_digest", "recording_namespace", "recording_value", "recipe_fingerprint", "recipe", "model_ref", "model_card_digest", "model_file_digests")
REGISTRY_KEYS = ("registry_uri", "registry_fingerprint")
SCORE_KEYS = ("score_domain", "score_retention")
RETENTION_KEYS = {"full": (), "thresholded": ("score_floor",), "top_k": ("score_floor", "score_top_k")}
EMBEDDING_KEYS = ("embedding_dim", "embedding_source_dtype", "embedding_storage_dtype", "backbone_ref", "backbone_card_digest")
DETECTION_KEYS = ("detection_policy", "source_artifacts")
STORED = {"float32": (pa.float32(), np.float32), "float16": (pa.float16(), np.float16)}
_F64, _TEXT = pa.float64(), pa.string()


@dataclass(frozen=True)
class Contract:
    """Columns (name, Arrow type, may be null, Spark type), row order and rows of a row group of a kind of file."""

    id: str
    columns: tuple
    order: tuple[str, ...]
    group_rows: int


CONTRACTS = {
    "scores": Contract("scores.parquet/1", (("window_start_s", _F64, False, "double"), ("window_end_s", _F64, False, "double"), ("label", _TEXT, False, "string"), ("score", _F64, False, "double")), ("window_start_s", "label"), 1 << 20),
    "embeddings": Contract("embeddings.parquet/1", (("window_start_s", _F64, False, "double"), ("window_end_s", _F64, False, "double"), ("embedding", None, False, "array<float>")), ("window_start_s",), 1 << 20),
    "detections": Contract(
        "detections.parquet/1",
        (
            ("window_start_s", _F64, False, "double"), ("window_end_s", _F64, False, "double"), ("label", _TEXT, False, "string"), ("label_kind", _TEXT, False, "string"), ("score", _F64, False, "double"),
            ("rank", pa.int32(), False, "int"), ("scientific_name", _TEXT, True, "string"), ("common_name", _TEXT, True, "string"), ("gbif_taxon_key", pa.int64(), True, "bigint"),
        ),
        ("window_start_s", "rank"), 1 << 16,
    ),
}
#: Bytes of vectors in a row group of embeddings.
VECTOR_BYTES = 1 << 20


class ArtifactRefused(ValueError):
    """Files whose bytes, schema or header are not what they should be, or places that hold other bytes."""


def required_keys(kind: str, header: dict[str, str]) -> tuple[str, ...]:
    """Entries that a header of a kind needs, given what it declares."""
    if kind == "scores":
        return FILE_KEYS + REGISTRY_KEYS + SCORE_KEYS + RETENTION_KEYS.get(header.get("score_retention"), ())
    bound = REGISTRY_KEYS if any(k in header for k in REGISTRY_KEYS) else ()
    return FILE_KEYS + (EMBEDDING_KEYS + bound if kind == "embeddings" else REGISTRY_KEYS + DETECTION_KEYS)


def vector_width(header: dict[str, str]) -> int | None:
    """The declared width, None if it is no positive 32-bit integer."""
    raw = header.get("embedding_dim", "")
    width = int(raw) if raw.isascii() and raw.isdigit() and len(raw) <= 10 else 0
    return width if 0 < width < 1 << 31 else None


def header_code(kind: str, header: dict[str, str]) -> tuple[str, str] | None:
    """(code, detail) of the first thing wrong with a header; keys are without the prefix."""
    if header.get("contract") != CONTRACTS[kind].id:
        return "artifact_contract_unexpected", f"it declares {header.get('contract')!r}"
    missing = [k for k in required_keys(kind, header) if k not in header]
    if missing:
        return "artifact_metadata_incomplete", ", ".join(missing)
    if kind == "scores" and header["score_retention"] not in RETENTION_KEYS:
        return "artifact_schema_invalid", f"retention {header['score_retention']!r}"
    if kind == "embeddings" and vector_width(header) is None:
        return "artifact_schema_invalid", f"width {header['embedding_dim']!r}"
    if kind == "embeddings" and header["embedding_storage_dtype"] not in STORED:
        return "artifact_schema_invalid", f"storage type {header['embedding_storage_dtype']!r}"
    return None


def file_schema(kind: str, header: dict[str, str]) -> pa.Schema:
    vector = lambda: pa.list_(STORED[header["embedding_storage_dtype"]][0], vector_width(header))
    return pa.schema([pa.field(name, kind_ or vector(), nullable=null) for name, kind_, null, _ in CONTRACTS[kind].columns])


def schema_code(schema: pa.Schema, declared: pa.Schema, strict: bool) -> tuple[str, str] | None:
    """Columns are matched by name and type, and by nullability if ``strict``; more columns and any order are fine."""
    for field in declared:
        places = schema.get_all_field_indices(field.name)
        if len(places) != 1:
            return "artifact_schema_invalid", f"{field.name} is there {len(places)} times"
        actual = schema.field(places[0])
        plain = field.name == "embedding" and not strict and pa.types.is_list(actual.type) and actual.type.value_type == pa.float32()
        if not plain and actual.type != field.type:
            return "artifact_schema_invalid", f"{field.name} is {actual.type}, not {field.type}"
        if strict and actual.nullable != field.nullable:
            return "artifact_schema_invalid", f"{field.name} has nullable={actual.nullable}"
    return None


def null_count(file: pq.ParquetFile, column: str) -> int:
    """Nulls of a column from the statistics of its row groups; a group without them has the column read."""
    meta, n = file.metadata, 0
    places = [j for j in range(meta.num_columns) if meta.schema.column(j).path.split(".")[0] == column]
    for g in range(meta.num_row_groups):
        stats = [meta.row_group(g).column(j).statistics for j in places]
        if all(s is not None and s.has_null_count for s in stats):
            n += sum(s.null_count for s in stats)
        else:
            n += file.read_row_group(g, columns=[column]).column(0).null_count
    return n


def decoded_header(raw: dict[bytes, bytes] | None, prefix: str) -> dict[str, str]:
    """Entries below the prefix, as text without it; UnicodeDecodeError for bytes that are none."""
    start = prefix.encode()
    return {k[len(start) :].decode(): v.decode() for k, v in (raw or {}).items() if k.startswith(start)}


VERDICT = "path string, length long, checksum string, code string, detail string, namespace string, value string, header map<string,string>, rows long, row_groups int, bytes_read long"


def _verdict(kind: str, form: str, prefix: str, file: Ranged, wanted: str | None, hashed: bool) -> dict:
    out = {"checksum": None, "code": None, "detail": None, "namespace": None, "value": None, "header": {}, "rows": None, "row_groups": None}
    if hashed or wanted is not None:
        out["checksum"] = stream_sha256(file)
        file.seek(0)
        if wanted is not None and out["checksum"] != wanted:
            return out | {"code": "artifact_checksum_mismatch", "detail": wanted}
    try:
        found = pq.ParquetFile(pa.PythonFile(file, mode="r"))
        schema = found.schema_arrow
    except (pa.ArrowException, OSError) as error:
        return out | {"code": "artifact_malformed", "detail": str(error)[:200]}
    try:
        header = decoded_header(schema.metadata, prefix)
    except UnicodeDecodeError as error:
        return out | {"code": "artifact_malformed", "detail": str(error)[:200]}
    out |= {"header": header, "namespace": header.get("recording_namespace"), "value": header.get("recording_value"), "rows": found.metadata.num_rows, "row_groups": found.metadata.num_row_groups}
    if form == "table":
        declared = pa.schema([*(pa.field(k, pa.string()) for k in KEY), *file_schema(kind, {"embedding_storage_dtype": "float32", "embedding_dim": "1"})])
        problem = schema_code(schema, declared, False)
    elif kind == "embeddings":  # the header says what the schema should be
        problem = header_code(kind, header) or schema_code(schema, file_schema(kind, header), True)
    else:
        problem = schema_code(schema, file_schema(kind, header), True) or header_code(kind, header)
    if problem is None and form == "table":
        nulls = {c: n for c, _, null, _ in CONTRACTS[kind].columns if not null and (n := null_count(found, c))}
        problem = ("artifact_malformed", f"nulls in {', '.join(nulls)}") if nulls else None
    return out if problem is None else out | dict(zip(("code", "detail"), problem))


def _verdicts(kind: str, form: str, prefix: str, hashed: bool):
    """A function of batches (path, length, wanted, content) that gives the verdict of each file."""

    def run(batches):
        for batch in batches:
            rows = []
            for path, length, wanted, content in zip(*(c.to_pylist() for c in batch.columns)):
                row = {"path": path, "length": length, "bytes_read": 0}
                if length is None:
                    rows.append(row | {"code": "artifact_unreadable", "detail": "no such file"})
                    continue
                try:
                    with Ranged(path, content) as file:
                        row |= _verdict(kind, form, prefix, file, wanted, hashed)
                        row["bytes_read"] = file.bytes_read
                except OSError as error:
                    row |= {"code": "artifact_unreadable", "detail": str(error)[:200]}
                rows.append(row)
            names = [f.split()[0] for f in VERDICT.split(", ")]
            kinds = {"length": pa.int64(), "rows": pa.int64(), "bytes_read": pa.int64(), "row_groups": pa.int32(), "header": pa.map_(pa.string(), pa.string())}
            columns = [[list(v.items()) if isinstance(v := r.get(n), dict) else v for r in rows] for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns)], names=names)

    return run


def verified_files(spark: SparkSession, path: str, kind: str, expected: DataFrame | None = None, form: str = "file", prefix: str = PREFIX, hashed: bool = False) -> DataFrame:
    """A row for each Parquet file below ``path``: what is wrong with it (``code``, null if nothing), its header and rows.

    Without checksums a few KB of each file are read, whatever its size; with them each file goes by once more, a few MB
    at a time. ``expected`` has the checksums (path, checksum) that files must have; a file of it that is missing has a
    code too. ``hashed`` asks for the checksums of all. In the form "file" a file holds one recording and its header;
    in the form "table" Spark wrote it, with the recordings as columns, all columns nullable and no header, so nulls are
    counted from the statistics of its row groups.
    """
    if opens_in_tasks(path):
        files = listed(spark, path, "*.parquet").withColumn("content", F.lit(None).cast("binary"))
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path", "length", "content")
    wanted = F.lit(None).cast("string")
    if expected is not None:
        files = files.join(expected.select("path", F.col("checksum").alias("wanted")), "path", "full")
        wanted = F.col("wanted")
    return dealt(files.select("path", "length", wanted.alias("wanted"), "content")).mapInArrow(_verdicts(kind, form, prefix, hashed), VERDICT)


def _rows(kind: str):
    """A function of batches (path, group, namespace, value, storage) that gives the rows of each row group."""
    names = [c[0] for c in CONTRACTS[kind].columns]

    def run(batches):
        opened, file = None, None
        for batch in batches:
            for path, group, namespace, value, storage in zip(*(c.to_pylist() for c in batch.columns)):
                if path != opened:
                    opened, file = path, pq.ParquetFile(pa.PythonFile(Ranged(path), mode="r"))
                for part in file.iter_batches(batch_size=1 << 16, row_groups=[group], columns=names):
                    if bad := [n for n, _, null, _ in CONTRACTS[kind].columns if not null and part.column(n).null_count]:
                        raise ArtifactRefused(f"{path}: artifact_malformed: nulls in {', '.join(bad)}")
                    columns = [part.column(n) for n in names]
                    if kind == "embeddings":
                        vectors = columns[-1]
                        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                        offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.type.list_size)
                        columns[-1] = pa.ListArray.from_arrays(offsets, pa.array(values))
                        columns.append(pa.array([storage] * len(part), pa.string()))
                    own = [pa.array([x] * len(part), pa.string()) for x in (namespace, value)]
                    yield pa.RecordBatch.from_arrays([*own, *columns], names=[*KEY, *names, *(["storage_dtype"] if kind == "embeddings" else [])])

    return run


def read_files(spark: SparkSession, verdicts: DataFrame, kind: str) -> DataFrame:
    """Rows of the files without a code, with their recordings from the headers; a row group is a unit of work.

    Vectors are read as 32-bit floats from either width, and ``storage_dtype`` tells which it was.
    """
    good = verdicts.where("code is null and row_groups > 0")
    units = good.select("path", F.explode(F.sequence(F.lit(0), F.col("row_groups") - 1)).alias("group"), *KEY, F.element_at("header", "embedding_storage_dtype").alias("storage"))
    schema = ", ".join(["namespace string", "value string", *(f"{n} {t}" for n, _, _, t in CONTRACTS[kind].columns), *(["storage_dtype string"] if kind == "embeddings" else [])])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(tasks, "path", "group").sortWithinPartitions("path", "group").mapInArrow(_rows(kind), schema)


def read_artifacts(spark: SparkSession, path: str, kind: str, expected: DataFrame | None = None, refuse: bool = True, prefix: str = PREFIX) -> DataFrame:
    """Rows of the files of a kind below ``path``; files with a code are refused, or left out if not ``refuse``."""
    verdicts = verified_files(spark, path, kind, expected, prefix=prefix)
    if refuse:
        refuse_bad(verdicts)
    return read_files(spark, verdicts, kind)


def refuse_bad(verdicts: DataFrame) -> None:
    shown = verdicts.where("code is not null").orderBy("path").limit(20).collect()  # a report
    if shown:
        raise ArtifactRefused("; ".join(f"{r['path']}: {r['code']}: {r['detail']}" for r in shown))


def file_records(verdicts: DataFrame, kind: str) -> DataFrame:
    """A catalog row for each good file: kind, contract, recording, uri, checksum, size and rows, from the file itself."""
    return verdicts.where("code is null").select(
        F.lit(kind).alias("kind"), F.element_at("header", "contract").alias("contract_id"), *KEY, F.col("path").alias("uri"), "checksum", F.col("length").alias("size_bytes"), "rows"
    )


def footer_headers(verdicts: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(namespace, value, header) with prefixed keys, as ``provenance_header`` gives them, from the footers."""
    return verdicts.select(*KEY, F.transform_keys("header", lambda k, v: F.concat(F.lit(prefix), k)).alias("header"))


# the sink


def artifact_path(kind: str, namespace: str, value: str) -> str:
    """Relative place of a recording's file; each part is percent-encoded, so a value stays in its folder."""
    return f"{kind}/recording_namespace={quote(namespace, safe='')}/recording_value={quote(value, safe='')}/{kind}.parquet"


class _Hashed(io.RawIOBase):
    """An output stream that hashes and counts what it writes."""

    def __init__(self, out: pa.NativeFile):
        self._out, self.digest, self.size = out, hashlib.sha256(), 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        data = bytes(data)
        self.digest.update(data)
        self.size += len(data)
        self._out.write(data)
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self._out.close()
        super().close()


class _OneFile:
    """One staged file of a recording; a row group ends at the first window at or after its number of rows."""

    def __init__(self, kind: str, namespace: str, value: str, header: dict[str, str], place: str, prefix: str, checked: bool):
        own = {k[len(prefix) :]: v for k, v in header.items() if k.startswith(prefix)}
        problem = header_code(kind, own) if checked else None
        if problem:
            raise ArtifactRefused(f"{namespace} {value}: {problem[0]}: {problem[1]}")
        if checked and (own["recording_namespace"], own["recording_value"]) != (namespace, value):
            raise ArtifactRefused(f"{namespace} {value}: the header names another recording")
        self.kind, self.key, self.place, self.rows = kind, (namespace, value), place, 0
        self.schema = file_schema(kind, own)
        width = self.schema.field("embedding").type if kind == "embeddings" else None
        self.limit = max(1, VECTOR_BYTES // (width.list_size * width.value_type.bit_width // 8)) if width else CONTRACTS[kind].group_rows
        system, path = file_system(place)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self._out = _Hashed(system.open_output_stream(path))
        self._writer = pq.ParquetWriter(self._out, self.schema.with_metadata({k.encode(): v.encode() for k, v in header.items()}), compression="zstd")
        self._pending: list[pa.Table] = []
        self._held = 0

    def _vectors(self, column: pa.ChunkedArray) -> pa.Array:
        kind = self.schema.field("embedding").type
        whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if whole.null_count or (np.diff(whole.offsets.to_numpy()) != kind.list_size).any():
            raise ArtifactRefused(f"{self.key}: a vector is null or not {kind.list_size} wide")
        values = whole.flatten().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            stored = values.astype(kind.value_type.to_pandas_dtype())
        if (np.isfinite(values) & ~np.isfinite(stored)).any():
            raise ArtifactRefused(f"{self.key}: embedding_value_out_of_storage_dtype_range")
        return pa.FixedSizeListArray.from_arrays(pa.array(stored, kind.value_type), kind.list_size)

    def add(self, rows: pa.RecordBatch) -> None:
        columns = [self._vectors(rows.column(f.name)) if f.name == "embedding" else rows.column(f.name).cast(f.type) for f in self.schema]
        self._pending.append(pa.Table.from_arrays(columns, schema=self.schema))
        self._held += len(rows)
        if self._held >= self.limit:
            table = pa.concat_tables(self._pending).combine_chunks()
            starts = table.column("window_start_s").to_numpy()
            ends = np.flatnonzero(starts[1:] != starts[:-1]) + 1  # places where a window begins
            at = 0
            while len(table) - at >= self.limit:
                later = ends[np.searchsorted(ends, at + self.limit) :]
                if not len(later):
                    break
                self._write(table.slice(at, int(later[0]) - at))
                at = int(later[0])
            self._pending, self._held = [table.slice(at)], len(table) - at

    def _write(self, table: pa.Table) -> None:
        if len(table):
            self._writer.write_table(table, row_group_size=len(table))
            self.rows += len(table)

    def finish(self) -> dict:
        if self._pending:
            self._write(pa.concat_tables(self._pending))
        self._writer.close()
        self._out.close()
        return {"kind": self.kind, "key": self.key, "place": self.place, "checksum": "sha256:" + self._out.digest.hexdigest(), "size": self._out.size, "rows": self.rows}


@dataclass
class Staged(WriterCommitMessage):
    files: list[dict]


def _checksum_at(place: str) -> str | None:
    system, path = file_system(place)
    if system.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    with Ranged(place) as file:
        return stream_sha256(file)


def _link(staged: str, final: str) -> bool:
    """Give a staged file its final name; False if a file is there. On local disks this is one step, elsewhere two."""
    system, source = file_system(staged)
    target = file_system(final)[1]
    system.create_dir(target.rpartition("/")[0], recursive=True)
    if isinstance(system, pafs.LocalFileSystem):
        try:
            os.link(source, target)
        except FileExistsError:
            return False
        return True
    if system.get_file_info(target).type != pafs.FileType.NotFound:
        return False
    system.move(source, target)
    return True


def publish(files: list[dict], root: str) -> dict[str, int]:
    """Publish staged files below ``root``: {"new": n, "replay": n}. Any place with other bytes refuses all, before the first link.

    ``there`` is the checksum of what a file's place held when it was staged, which its task has read.
    """
    counts, fresh, conflicts = {"new": 0, "replay": 0}, [], []
    for file in files:
        final, there = f"{root}/{artifact_path(file['kind'], *file['key'])}", file["there"]
        if there is None:
            fresh.append((file, final))
        elif there == file["checksum"]:
            counts["replay"] += 1
        else:
            conflicts.append(f"{final} holds {there}, not {file['checksum']}")
    if conflicts:
        raise ArtifactRefused("artifact_publication_failed: " + "; ".join(conflicts[:20]))
    for file, final in fresh:
        if not _link(file["place"], final):  # someone else was faster
            if _checksum_at(final) != file["checksum"]:
                raise ArtifactRefused(f"artifact_publication_failed: {final} holds other bytes")
            counts["replay"] += 1
        else:
            counts["new"] += 1
    return counts


class ArtifactWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.kind = options["path"].rstrip("/"), options["kind"]
        self.prefix, self.checked = options.get("prefix", PREFIX), options.get("checked", "true") == "true"
        #: Hidden from readers; gone after the commit or the abort, with what killed tasks left.
        self.staging = f"{self.root}/.staged-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        folder = f"{self.staging}/{context.partitionId()}-{context.taskAttemptId()}"
        done, current = [], None

        def finished(file: _OneFile) -> dict:
            return file.finish() | {"there": _checksum_at(f"{self.root}/{artifact_path(file.kind, *file.key)}")}

        for batch in iterator:
            spaces, values, headers = (batch.column(c).to_pylist() for c in (*KEY, "header"))
            n, at = batch.num_rows, 0
            while at < n:
                to = at
                if headers[at] is not None:
                    if current is not None:
                        done.append(finished(current))
                    if spaces[at] is None or values[at] is None or done and (spaces[at], values[at]) == done[-1]["key"]:
                        raise ArtifactRefused(f"{spaces[at]} {values[at]}: a recording needs a name and one header")
                    current = _OneFile(self.kind, spaces[at], values[at], dict(headers[at]), f"{folder}/{len(done)}.parquet", self.prefix, self.checked)
                    at += 1
                    continue
                if current is None or (spaces[at], values[at]) != current.key:
                    raise ArtifactRefused(f"{spaces[at]} {values[at]}: artifact_metadata_incomplete: no header")
                while to < n and headers[to] is None and (spaces[to], values[to]) == current.key:
                    to += 1
                current.add(batch.slice(at, to - at))
                at = to
        if current is not None:
            done.append(finished(current))
        return Staged(done)

    def _clear(self) -> None:
        system, path = file_system(self.staging)
        if system.get_file_info(path).type == pafs.FileType.Directory:
            system.delete_dir(path)

    def commit(self, messages: list) -> None:
        try:
            publish([f for m in messages if m is not None for f in m.files], self.root)
        finally:
            self._clear()

    def abort(self, messages: list) -> None:
        self._clear()


class ArtifactFiles(DataSource):
    """The sink ``tidemark-artifacts`` with the options path, kind, prefix, checked."""

    @classmethod
    def name(cls) -> str:
        return "tidemark-artifacts"

    def writer(self, schema, overwrite: bool) -> ArtifactWriter:
        return ArtifactWriter(dict(self.options))


def write_artifacts(rows: DataFrame, headers: DataFrame, root: str, kind: str, prefix: str = PREFIX, checked: bool = True) -> None:
    """Publish one file for each recording of ``headers`` (namespace, value, header map) with its rows, which may be none.

    The same rows give the same bytes, so a second run changes nothing; a place with other bytes fails the write and
    keeps its file, and none of this write's files. A header that the reader would refuse is refused here, unless not
    ``checked``; so is a recording without a header. A recording's rows are one file and so one task.
    """
    spark = rows.sparkSession
    contract = CONTRACTS[kind]
    spark.dataSource.register(ArtifactFiles)
    heads = headers.select(*KEY, "header", *(F.lit(None).cast(t).alias(n) for n, _, _, t in contract.columns))
    body = rows.select(*KEY, F.lit(None).cast("map<string,string>").alias("header"), *(F.col(n).cast(t).alias(n) for n, _, _, t in contract.columns))
    ordered = heads.unionByName(body).repartition(*KEY).sortWithinPartitions(*KEY, F.col("header").isNull(), *contract.order)
    ordered.write.format(ArtifactFiles.name()).mode("append").option("path", root).option("kind", kind).option("prefix", prefix).option("checked", str(checked).lower()).save()
