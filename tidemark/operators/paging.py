"""Stable pages by key: rows strictly after the cursor's key in list order, one more than the page to know of a next one."""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

DEFAULT_LIMIT, MAX_LIMIT = 100, 1000


class PageRefused(ValueError):
    """A limit out of range, or a cursor that is malformed or of another list or other filters."""


class Cursor:
    """The key of the last row of a page as a hexadecimal text, bound to a list and its filters.

    Layout: one byte with the version, 16 bytes that name list and filters, 4 bytes that check the rest, then each value
    of the key as a letter for its type, its length in 4 bytes, and its text.
    """

    VERSION = 1
    TYPES = {
        "n": (type(None), lambda text: None),
        "i": (int, int),
        "f": (float, float.fromhex),
        "s": (str, str),
        "t": (datetime.datetime, datetime.datetime.fromisoformat),
        "d": (datetime.date, datetime.date.fromisoformat),
    }

    def __init__(self, list_name: str, filters: Mapping[str, object]):
        said = [list_name, *(f"{name}={filters[name]!r}" for name in sorted(filters))]
        self._bound = hashlib.blake2b("\0".join(said).encode(), digest_size=16).digest()

    def write(self, key: list) -> str:
        body = b""
        for value in key:
            letter = next((k for k, (kind, _) in self.TYPES.items() if isinstance(value, kind)), None)
            if letter is None:
                raise PageRefused(f"no cursor for keys of the type {type(value).__name__}")
            text = ("" if value is None else value.hex() if letter == "f" else value.isoformat() if letter in "td" else str(value)).encode()
            body += letter.encode() + len(text).to_bytes(4) + text
        return (bytes([self.VERSION]) + self._bound + self._check(body) + body).hex()

    def read(self, cursor: str, parts: int) -> list:
        try:
            raw = bytes.fromhex(cursor)
        except ValueError as error:
            raise PageRefused("malformed cursor") from error
        if raw[:1] != bytes([self.VERSION]):
            raise PageRefused("a cursor of another version")
        if raw[1:17] != self._bound:
            raise PageRefused("the cursor is of another list or other filters")
        if raw[17:21] != self._check(raw[21:]):
            raise PageRefused("malformed cursor")
        key, at = [], 21
        while at < len(raw):
            end = at + 5 + int.from_bytes(raw[at + 1 : at + 5])
            key.append(self.TYPES[chr(raw[at])][1](raw[at + 5 : end].decode()))
            at = end
        if len(key) != parts:
            raise PageRefused("malformed cursor")
        return key

    @staticmethod
    def _check(body: bytes) -> bytes:
        return hashlib.blake2b(body, digest_size=4).digest()


def keyset_page(rows: DataFrame, keys: list[str], limit: int = DEFAULT_LIMIT, after: list | None = None, descending: bool = False) -> DataFrame:
    """Up to ``limit`` + 1 rows after ``after`` in the order of ``keys``."""
    if not 1 <= limit <= MAX_LIMIT:
        raise PageRefused(f"the limit must be 1 to {MAX_LIMIT}")
    if after is not None:
        here = F.struct(*(F.col(k).alias(k) for k in keys))
        there = F.struct(*(F.lit(v).cast(rows.schema[k].dataType).alias(k) for k, v in zip(keys, after)))
        rows = rows.where(here < there if descending else here > there)
    return rows.orderBy(*(F.col(k).desc() if descending else F.col(k).asc() for k in keys)).limit(limit + 1)


def next_page(rows: DataFrame, keys: list[str], list_name: str, filters: Mapping[str, object], limit: int = DEFAULT_LIMIT, cursor: str | None = None, descending: bool = False):
    """(rows of the page, next cursor or None); the page is collected, at most MAX_LIMIT rows."""
    place = Cursor(list_name, filters)
    after = None if cursor is None else place.read(cursor, len(keys))
    found = keyset_page(rows, keys, limit, after, descending).collect()
    more = len(found) > limit
    return found[:limit], place.write([found[limit - 1][k] for k in keys]) if more else None


def runs_filter(runs: DataFrame, submitted_by: str | None = None, created_after: str | None = None) -> DataFrame:
    """Runs of a submitter, created after a time, which must have a zone."""
    if submitted_by is not None:
        runs = runs.where(F.col("submitted_by") == submitted_by)
    if created_after is not None:
        try:
            after = datetime.datetime.fromisoformat(created_after)
        except ValueError as error:
            raise PageRefused(f"not an ISO 8601 time: {created_after}") from error
        if after.tzinfo is None:
            raise PageRefused(f"the time has no zone: {created_after}")
        # columns without a zone hold UTC
        text, kind = after.astimezone(datetime.UTC).replace(tzinfo=None).isoformat(), runs.schema["created_at"].dataType.simpleString()
        runs = runs.where(F.col("created_at") > (F.lit(text).cast(kind) if kind == "timestamp_ntz" else F.lit(text + "Z").cast("timestamp")))
    return runs


STATES = ("pending", "covered", "failed", "released", "skipped", "withdrawn")
SKIP_REASONS = ("already_covered", "in_progress", "input_not_available", "input_has_no_windows", "input_location_unsupported")


def recordings_filter(recordings: DataFrame, state: str | None = None, skip_reason: str | None = None) -> DataFrame:
    for name, value, known in (("state", state, STATES), ("skip_reason", skip_reason, SKIP_REASONS)):
        if value is not None:
            if value not in known:
                raise PageRefused(f"unknown {name}: {value}")
            recordings = recordings.where(F.col(name) == value)
    return recordings
