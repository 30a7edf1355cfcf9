"""BSON dumps as a Spark data source.

A file is cut into byte ranges without being read. A reader finds the first anchored place in its range by itself and
reads on to the first one beyond it, so ranges are read side by side and each document once. A place is anchored if the
bytes decode and a document, or the end of the file, follows: embedded documents have the same framing, but no document
follows them. Bytes that are no document are stepped over one by one to the next such place,
in windows, and are reported as corrupt. A read that fails is tried again.
"""

from __future__ import annotations

import datetime as dt
import json
import random
import struct
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyarrow import fs as stores
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LEAST, MOST = 5, 16 << 20
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Malformed(ValueError):
    """The bytes are not a BSON document."""


def _cstring(raw: bytes, at: int) -> tuple[str, int]:
    end = raw.find(b"\0", at)
    if end < 0:
        raise Malformed("unterminated name")
    return raw[at:end].decode("utf-8", "replace"), end + 1


def _string(raw: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<i", raw, at)
    if n < 1 or at + 4 + n > len(raw):
        raise Malformed("string length")
    return raw[at + 4 : at + 3 + n].decode("utf-8", "replace"), at + 4 + n


def _value(kind: int, raw: bytes, at: int) -> tuple[Any, int]:
    """A value in JSON terms: binary as hex, times as ISO-8601, object ids as hex strings."""
    if kind == 0x01:
        return struct.unpack_from("<d", raw, at)[0], at + 8
    if kind in (0x02, 0x0D, 0x0E):
        return _string(raw, at)
    if kind in (0x03, 0x04):
        (n,) = struct.unpack_from("<i", raw, at)
        made = decode(raw[at : at + n])
        return (list(made.values()) if kind == 0x04 else made), at + n
    if kind == 0x05:
        (n,) = struct.unpack_from("<i", raw, at)
        return raw[at + 5 : at + 5 + n].hex(), at + 5 + n
    if kind == 0x07:
        return raw[at : at + 12].hex(), at + 12
    if kind == 0x08:
        return raw[at] != 0, at + 1
    if kind == 0x09:
        (ms,) = struct.unpack_from("<q", raw, at)
        try:
            return (_EPOCH + dt.timedelta(milliseconds=ms)).isoformat(), at + 8
        except OverflowError:
            return ms, at + 8
    if kind in (0x06, 0x0A, 0xFF, 0x7F):
        return None, at
    if kind == 0x0B:
        pattern, at = _cstring(raw, at)
        options, at = _cstring(raw, at)
        return f"/{pattern}/{options}", at
    if kind == 0x10:
        return struct.unpack_from("<i", raw, at)[0], at + 4
    if kind in (0x11, 0x12):
        return struct.unpack_from("<q", raw, at)[0], at + 8
    if kind == 0x13:
        return raw[at : at + 16].hex(), at + 16
    raise Malformed(f"type {kind}")


def decode(raw: bytes) -> dict[str, Any]:
    """A document, by the public BSON specification."""
    try:
        (n,) = struct.unpack_from("<i", raw)
        if n != len(raw) or n < LEAST or raw[-1]:
            raise Malformed("framing")
        out, at = {}, 4
        while at < n - 1:
            kind = raw[at]
            name, at = _cstring(raw, at + 1)
            out[name], at = _value(kind, raw, at)
        if at != n - 1:
            raise Malformed("overrun")
        return out
    except (struct.error, IndexError) as e:
        raise Malformed(str(e)) from None


def _plain(x: Any) -> Any:
    """NaN and infinities have no JSON form."""
    if isinstance(x, float) and (x != x or x in (float("inf"), float("-inf"))):
        return None
    if isinstance(x, dict):
        return {k: _plain(v) for k, v in x.items()}
    return [_plain(v) for v in x] if isinstance(x, list) else x


def _store(path: str) -> tuple[stores.FileSystem, str]:
    """File system and path of a URI; a plain path is local."""
    return stores.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (stores.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    """URIs of the dumps under a folder, or of the one file."""
    store, at = _store(path)
    info = store.get_file_info(at)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    if info.type == stores.FileType.Directory:
        return sorted(prefix + i.path for i in store.get_file_info(stores.FileSelector(at, recursive=True)) if i.path.endswith(".bson"))
    return [path] if info.type == stores.FileType.File else []


#: Bytes read at once, tries of a read, and seconds before the second try (then twice as many each time).
WINDOW, ATTEMPTS, PAUSE = 1 << 20, 5, 0.5


class Bytes:
    """Random access to a file through a window, with reads tried again after a failure."""

    def __init__(self, path: str, window: int = WINDOW, pause: float = PAUSE) -> None:
        self.store, self.name = _store(path)
        self.size, self.window, self.pause = self.store.get_file_info(self.name).size, window, pause
        self.file, self.start, self.held = None, 0, b""

    def _fetch(self, at: int, n: int) -> bytes:
        for attempt in range(ATTEMPTS):
            try:
                if self.file is None:
                    self.file = self.store.open_input_file(self.name)
                return self.file.read_at(n, at)
            except OSError:
                if attempt == ATTEMPTS - 1:
                    raise
                self.file = None
                time.sleep(self.pause * 2**attempt * (1 + random.random()))
        return b""

    def get(self, at: int, n: int) -> bytes:
        """The n bytes at `at`, fewer at the end of the file."""
        if not (self.start <= at and at + n <= self.start + len(self.held)):
            self.start, self.held = at, self._fetch(at, min(max(n, self.window), self.size - at))
        return self.held[at - self.start : at - self.start + n]


def _framed(f: Bytes, at: int) -> int:
    """Length of the document at `at`, or 0 if none is framed there."""
    head = f.get(at, 4)
    if len(head) < 4:
        return 0
    (n,) = struct.unpack("<i", head)
    return n if LEAST <= n <= MOST and at + n <= f.size and f.get(at + n - 1, 1) == b"\0" else 0


def _decodes(f: Bytes, at: int, n: int) -> bool:
    try:
        decode(f.get(at, n))
        return True
    except Malformed:
        return False


def anchored(f: Bytes, at: int) -> bool:
    """Whether a document starts at `at` that another one, or the end of the file, follows."""
    n = _framed(f, at)
    return bool(n) and (at + n == f.size or _framed(f, at + n) > 0) and _decodes(f, at, n)


def _alone(f: Bytes, at: int) -> bool:
    """Whether a document with an id of its own starts at `at`, whatever follows."""
    n = _framed(f, at)
    return n > 8 and f.get(at + 5, 4) == b"_id\0" and _decodes(f, at, n)


def resumed(f: Bytes, at: int, lone: bool = False) -> int:
    """The first anchored place from `at` on; the end of the file if there is none. With `lone`, a document with an id
    between two runs of bad bytes counts too: ranges never begin there, but reading goes on there."""
    while at < f.size:
        block = np.frombuffer(f.get(at, min(f.window, f.size - at)), np.uint8).astype(np.int64)
        if len(block) < LEAST:
            return f.size
        length = block[:-3] | block[1:-2] << 8 | block[2:-1] << 16 | block[3:] << 24
        for i in np.flatnonzero((length >= LEAST) & (length <= MOST)).tolist():
            if anchored(f, at + i) or (lone and _alone(f, at + i)):
                return at + i
        at += len(block) - 3
    return f.size


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int


def splits(path: str, most: int) -> Iterator[Split]:
    """Byte ranges of `most` bytes, the last one shorter."""
    store, name = _store(path)
    size = store.get_file_info(name).size
    for start in range(0, size, most):
        yield Split(path, start, min(start + most, size))


class BsonReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.most = int(options.get("splitBytes", 64 << 20))

    def partitions(self) -> list[InputPartition]:
        return [s for f in _files(self.path) for s in splits(f, self.most)] or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[tuple]:
        """path, offset, doc (JSON text) of each document from the first anchored place in the range up to the first one
        beyond it; doc is NULL with the length in `corrupt` for bad bytes."""
        if not partition.path:
            return
        f = Bytes(partition.path)
        at = 0 if partition.start == 0 else resumed(f, partition.start)
        while at < partition.end or (at < f.size and not anchored(f, at)):
            n = _framed(f, at)
            if n and _decodes(f, at, n):
                yield partition.path, at, json.dumps(_plain(decode(f.get(at, n))), ensure_ascii=False), 0
                at += n
                continue
            # a sound frame around a bad document is skipped whole if something follows it, else byte by byte
            to = at + n if n and (at + n == f.size or _framed(f, at + n)) else resumed(f, at + 1, True)
            yield partition.path, at, None, to - at
            at = to


class BsonSource(DataSource):
    """spark.dataSource.register(BsonSource); spark.read.format("bson_dump").option("splitBytes", n).load(path)"""

    @classmethod
    def name(cls) -> str:
        return "bson_dump"

    def schema(self) -> str:
        return "path string, offset long, doc string, corrupt long"

    def reader(self, schema: Any) -> BsonReader:
        return BsonReader(self.options)


#: What the file-reputation and domain dumps are read as. Counts are doubles, since both ints and floats occur.
FILE_DOC = (
    "_id string, vtClassifierV2Classification struct<classification: string>, value struct<response_code: double, sha1: string, "
    "sha256: string, md5: string, scan_date: string, positives: double, total: double, "
    "scans: map<string, struct<detected: string, result: string>>>"
)
DOMAIN_DOC = "_id string, response string, value struct<detectedUrls: array<struct<url: string, positives: string>>>"


def file_docs(rows):  # noqa: ANN001, ANN201
    """Typed file-reputation documents of a scan."""
    from pyspark.sql import functions as F

    d = rows.where("doc IS NOT NULL").select("path", "offset", F.from_json("doc", FILE_DOC).alias("d"))
    return d.select("path", "offset", F.col("d._id").alias("_id"), F.col("d.value").alias("value"), F.col("d.vtClassifierV2Classification").alias("verdict"))


def domain_docs(rows):  # noqa: ANN001, ANN201
    """Typed domain documents: positives may be plain or wrapped as {"$numberInt": n}."""
    from pyspark.sql import functions as F

    from quarry.functions import scalars

    d = rows.where("doc IS NOT NULL").select("path", "offset", F.from_json("doc", DOMAIN_DOC).alias("d"))
    wrapped = lambda p: scalars.number_of(scalars.truncated(p), scalars.truncated(F.get_json_object(p, "$['$numberInt']")))
    urls = F.transform("d.value.detectedUrls", lambda u: F.struct(wrapped(u["positives"]).alias("positives")))
    return d.select("path", "offset", F.col("d._id").alias("_id"), F.col("d.response").alias("response"), urls.alias("urls"))
