"""Files that tasks write and read themselves, below a folder all executors see by one name.

Hadoop's local file system starts several processes for each file it makes, and Spark copies
its configuration for each file it reads; these take most of the time when files are small.
"""

from __future__ import annotations

import codecs
import io
import itertools
import os
import re
import struct
import sys
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Tasks get this module with the function they run: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# How Spark names the folder of a value.
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Hadoop's checksum files have a sum for each so many bytes.
_SUMMED = 512
_SUMS_HEAD = b"crc\0" + struct.pack(">i", _SUMMED)
# Bytes held before they are written; a multiple of _SUMMED.
_HELD = 1 << 20


def _folder(name: str, value: str | None) -> str:
    if not value:
        return f"{name}={_NO_VALUE}"
    return f"{name}=" + _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", value)


class _File:
    """A file and its checksums, put in place when they are whole."""

    def __init__(self, scratch: str, folder: str, name: str, header: str):
        self._placed = {f"{scratch}/{n}": f"{folder}/{n}" for n in (name, f".{name}.crc")}
        self._text, self._sums = (open(made, "wb") for made in self._placed)
        self._held = bytearray(header.encode() + b"\n")
        self._sums.write(_SUMS_HEAD)

    def add(self, lines: list[str]) -> None:
        self._held += "\n".join(lines).encode() + b"\n"
        if len(self._held) >= _HELD:
            self._put(len(self._held) // _SUMMED * _SUMMED)

    def _put(self, size: int) -> None:
        ready = bytes(self._held[:size])
        del self._held[:size]
        self._text.write(ready)
        for start in range(0, size, _SUMMED):
            self._sums.write(struct.pack(">I", zlib.crc32(ready[start : start + _SUMMED])))

    def close(self) -> None:
        self._put(len(self._held))
        self._text.close()
        self._sums.close()
        for made, placed in self._placed.items():
            os.replace(made, placed)


def line_writer(root: str, scratch: str, job: str, header: str) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``, on lines ordered by the columns before them, which name their folder.

    A folder gets one file of each task that has lines of it. A task that runs again makes
    the same names; it replaces whole files only.
    """

    def write(batches: Iterator) -> Iterator:
        task = TaskContext.get()
        own = f"{scratch}/{task.taskAttemptId()}"
        os.makedirs(own)
        name = f"part-{task.partitionId():05d}-{job}.c000.csv"
        last = file = None
        for batch in batches:
            *values, lines = (column.to_pylist() for column in batch.columns)
            names = batch.schema.names[:-1]
            start = 0
            for of, same in itertools.groupby(zip(*values, strict=True)):
                end = start + sum(1 for _ in same)
                if file is None or of != last:
                    if file is not None:
                        file.close()
                    folder = "/".join([root, *map(_folder, names, of)])
                    os.makedirs(folder, exist_ok=True)
                    last, file = of, _File(own, folder, name, header)
                file.add(lines[start:end])
                start = end
        if file is not None:
            file.close()
        os.rmdir(own)
        yield from ()

    return write


# Lines or paths of a batch.
_BATCH = 10_000
# What a reading task gets, unless one file alone has more.
_GROUP_FILES, _GROUP_BYTES = 2_000, 64 << 20
_BLANK = "".join(map(chr, range(33)))


def _hidden(name: str) -> bool:
    """Spark's readers leave these out."""
    return name[0] == "." or name[0] == "_" and "=" not in name or name.endswith("._COPYING_")


def below(path: str) -> list[str]:
    """What Spark's readers see directly below a folder; a file itself."""
    if not os.path.isdir(path):
        return [path]
    return [f"{path}/{name}" for name in sorted(os.listdir(path)) if not _hidden(name)]


def _files(path: str) -> Iterator[str]:
    for inner in below(path):
        if inner == path:
            yield path
        else:
            yield from _files(inner)


def _list(batches: Iterator) -> Iterator:
    paths = (p for b in batches for folder in b.column(0).to_pylist() for p in below(folder))
    while some := list(itertools.islice(paths, _BATCH)):
        yield pa.record_batch([pa.array(some, pa.string())], names=["path"])


def _grouped(most: int) -> Callable[[Iterator], Iterator]:
    """Files in groups, each packed; those of more than ``most`` bytes apart, by name."""

    def batch(packed: bytes | None, large: str | None) -> pa.RecordBatch:
        values = [pa.array([packed], pa.binary()), pa.array([large], pa.string())]
        return pa.record_batch(values, names=["packed", "large"])

    def pack(group: list[str]) -> pa.RecordBatch:
        return batch(zlib.compress("\0".join(group).encode(errors="surrogateescape")), None)

    def run(batches: Iterator) -> Iterator:
        group, size = [], 0
        paths = (p for b in batches for path in b.column(0).to_pylist() for p in _files(path))
        for path in paths:
            of = os.path.getsize(path)
            if of > most:
                yield batch(None, path)
                continue
            if group and (len(group) == _GROUP_FILES or size + of > _GROUP_BYTES):
                yield pack(group)
                group, size = [], 0
            group.append(path)
            size += of
        if group:
            yield pack(group)

    return run


def _checked(path: str) -> Iterator[bytes]:
    """The bytes of a file, compared with its checksums where it has some."""
    folder, name = os.path.split(path)
    try:
        with open(f"{folder}/.{name}.crc", "rb") as file:
            sums = file.read()
    except FileNotFoundError:
        sums = b""
    summed = struct.unpack(">i", sums[4:8])[0] if sums[:4] == _SUMS_HEAD[:4] else 0
    at = 8
    with open(path, "rb") as file:
        while block := file.read(max(1, _HELD // summed) * summed if summed else _HELD):
            for start in range(0, len(block) if summed else 0, summed or 1):
                found = struct.pack(">I", zlib.crc32(block[start : start + summed]))
                if found != sums[at : at + 4]:
                    raise OSError(f"checksum error: {path}")
                at += 4
            yield block


def _lines(path: str) -> Iterator[str]:
    """Lines as Spark's CSV reader takes them: neither blank ones nor the header."""
    text = codecs.getincrementaldecoder("utf-8-sig")("replace")
    text = io.IncrementalNewlineDecoder(text, translate=True)
    rest, header = "", True
    for block in itertools.chain(_checked(path), [None]):
        *whole, rest = (rest + text.decode(block or b"", final=block is None)).split("\n")
        for line in whole if block is not None else [*whole, rest]:
            if line.strip(_BLANK):
                if not header:
                    yield line
                header = False


def _read(batches: Iterator) -> Iterator:
    packed = (p for b in batches for p in b.column(0).to_pylist())
    paths = (
        path for p in packed
        for path in zlib.decompress(p).decode(errors="surrogateescape").split("\0")
    )
    lines = (line for path in paths for line in _lines(path))
    while some := list(itertools.islice(lines, _BATCH)):
        yield pa.record_batch([pa.array(some, pa.string())], names=["line"])


def csv_lines(
    spark: SparkSession, folders: list[str], most: int
) -> tuple[DataFrame | None, list[str]]:
    """Lines of the files below, and names of the files of more than ``most`` bytes, left out.

    Tasks list the files, now, and read them, later. The driver holds the names packed, in
    groups: a few bytes a file.
    """
    paths = spark.createDataFrame([(f,) for f in folders], "path string")
    inner = paths.mapInArrow(_list, "path string").repartition("path")
    found = inner.mapInArrow(_grouped(most), "packed binary, large string").collect()
    groups = [(bytes(packed),) for packed, _ in found if packed is not None]
    large = [path for _, path in found if path is not None]
    if not groups:
        return None, large
    # A relation of unknown size: what the names take says nothing about the files, and a
    # join must not take them for small.
    dealt = spark.createDataFrame(
        spark.sparkContext.parallelize(groups, len(groups)), "packed binary"
    )
    return dealt.mapInArrow(_read, "line string"), large
