"""Whole files, listed and read by tasks: the driver knows folders, not files."""

from __future__ import annotations

import bz2
import gzip
import posixpath
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from siftline.sources.file_sink import file_system

# Names, and bytes of contents, about, that a task hands on at once.
BATCH_NAMES, BATCH_BYTES = 10_000, 8 << 20
# Files, and bytes of them, that are worth a further task.
TASK_FILES, TASK_BYTES = 32, 32 << 20


def read_files(spark: SparkSession, path: str, most_tasks: int) -> DataFrame | None:
    """path, content: one row per file under ``path``; None where Arrow can't open its file system.

    The files are those that Spark's readers take: no empty ones, no hidden names, and of
    the folders below ``path`` only those named key=value.  They are unpacked as their names
    ask for, and a file that can't be read fails the job.  Spark's readers keep the list of
    all files in the driver; here tasks list a folder each, and deal its names out to others,
    ``most_tasks`` at most, which read them in the order of their paths.
    """
    uris = _matches(spark, path)
    try:
        opened = [file_system(uri) for uri in uris]
    except (pa.ArrowException, OSError):
        return None
    if not opened:
        return None
    uri, roots = uris[0], [top.rstrip("/") or "/" for _, top in opened]

    def over(paths: list[str]) -> DataFrame:
        return spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), most_tasks))

    def folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(uri)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = _listed(fs, path)
                sizes, below = [x.size or 0 for x in found if _file(x)], [x.path for x in found if _folder(x)]
                row = [pa.array([path]), pa.array([len(sizes)]), pa.array([sum(sizes)]), pa.array([below], pa.list_(pa.string()))]
                yield pa.record_batch(row, names=["path", "files", "bytes", "below"])

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(uri)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = _listed(fs, path)
                sums = {x.path for x in found if x.is_file and x.extension == "crc"} if fs.type_name == "local" else set()
                files = [x.path for x in found if _file(x) and x.size != 0]
                for part in (files[i : i + BATCH_NAMES] for i in range(0, len(files), BATCH_NAMES)):
                    yield pa.record_batch([pa.array(part), pa.array([_sums_of(x) in sums for x in part])], names=["path", "summed"])

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(uri)
        paths, found, size = [], [], 0
        for batch in batches:
            for path, summed in zip(batch.column("path").to_pylist(), batch.column("summed").to_pylist(), strict=True):
                content = _bytes(fs, path)
                if summed:
                    _check(path, content, _bytes(fs, _sums_of(path)))
                paths.append(path)
                found.append(unpacked(path, content))
                size += len(found[-1])
                if size >= BATCH_BYTES:
                    yield pa.record_batch([pa.array(paths), pa.array(found, pa.binary())], names=["path", "content"])
                    paths, found, size = [], [], 0
        yield pa.record_batch([pa.array(paths, pa.string()), pa.array(found, pa.binary())], names=["path", "content"])

    filled, level = {}, roots
    while level:
        rows = over(level).mapInArrow(folders, "path string, files long, bytes long, below array<string>").collect()
        filled |= {r.path: r for r in rows if r.files}
        level = [p for r in rows for p in r.below]
    files = {x.path for x in opened[0][0].get_file_info(roots) if x.is_file}
    chosen = _chosen(roots, files, list(filled))
    held = [filled[p] for p in chosen if p in filled]
    many, size = sum(r.files for r in held), sum(r.bytes for r in held)
    worth = max(min(many, spark.sparkContext.defaultParallelism), many // TASK_FILES, size // TASK_BYTES)
    tasks = max(1, min(worth, most_tasks))
    listed = over(chosen).mapInArrow(names, "path string, summed boolean")
    return listed.repartition(tasks).sortWithinPartitions("path").mapInArrow(contents, "path string, content binary")


def _matches(spark: SparkSession, path: str) -> list[str]:
    """The files and folders that ``path``, which may be a pattern, stands for."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = named.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(named)
    return [status.getPath().toUri().toASCIIString() for status in found or ()]


def _listed(fs: pyarrow.fs.FileSystem, path: str) -> list[pyarrow.fs.FileInfo]:
    """What is in a folder, or the file itself and its checksums."""
    if fs.get_file_info(path).is_file:
        return fs.get_file_info([path, _sums_of(path)])
    return fs.get_file_info(pyarrow.fs.FileSelector(path))


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _file(info: pyarrow.fs.FileInfo) -> bool:
    return info.is_file and not _hidden(info.base_name)


def _folder(info: pyarrow.fs.FileInfo) -> bool:
    kept = info.base_name.startswith(("_metadata", "_common_metadata"))
    return info.type == pyarrow.fs.FileType.Directory and (kept or not _hidden(info.base_name))


def _chosen(roots: list[str], files: set[str], filled: list[str]) -> list[str]:
    """What to list of ``roots``, some of them ``files``: the partitions key=value below them, or else the roots.

    As for Spark's readers, if there are partitions, all folders ``filled`` with files must
    lie below one folder, and the partitions must have the same keys.
    """
    tops, bases, keys, partitions = set(roots), set(), set(), []
    for folder in filled:
        at, found = folder, []
        while at not in tops:
            key, equals, _ = posixpath.basename(at).partition("=")
            if found and not equals:
                break
            found += [key] * bool(equals)
            at = posixpath.dirname(at)
        bases.add(posixpath.dirname(at) if at in files else at)
        if found:
            keys.add(tuple(found))
            partitions.append(folder)
    if partitions and (len(bases) > 1 or len(keys) > 1):
        raise ValueError(f"conflicting folders: {sorted(bases)[:9]}, partitions by {sorted(keys)[:9]}")
    return partitions or roots


def _bytes(fs: pyarrow.fs.FileSystem, path: str) -> bytes:
    with fs.open_input_stream(path, compression=None) as file:
        return file.read()


def _sums_of(path: str) -> str:
    """The file of checksums that Hadoop keeps beside a local file."""
    folder, name = posixpath.split(path)
    return posixpath.join(folder, f".{name}.crc")


def _check(path: str, content: bytes, sums: bytes) -> None:
    step = int.from_bytes(sums[4:8], "big")
    if sums[:4] != b"crc\0" or not step:
        return  # Hadoop, too, goes on without
    for n, at in enumerate(range(0, len(content), step)):
        if sums[8 + 4 * n : 12 + 4 * n] != zlib.crc32(content[at : at + step]).to_bytes(4, "big"):
            raise OSError(f"wrong checksum: {path} at {at}")


def unpacked(path: str, content: bytes) -> bytes:
    """What a file holds, unpacked by the codec of Hadoop's that its name ends in, if any."""
    match posixpath.splitext(path)[1].lower():
        case ".gz":
            return gzip.decompress(content)
        case ".bz2":
            return bz2.decompress(content)
        case ".deflate":
            return zlib.decompress(content)
        case ".zst":
            return pa.CompressedInputStream(pa.BufferReader(content), "zstd").read()
        case ".snappy":
            return b"".join(_blocks(content, "snappy", _snappy_size))
        case ".lz4":
            return b"".join(_blocks(content, "lz4_raw", _lz4_size))
    return content


def _blocks(content: bytes, codec: str, size_of) -> Iterator[bytes]:
    """Hadoop's blocks: the length of each, then its parts, each after its packed length."""
    at, codec = 0, pa.Codec(codec)
    while at < len(content):
        left, at = int.from_bytes(content[at : at + 4], "big"), at + 4
        while left > 0:
            begin = at + 4
            at = begin + int.from_bytes(content[at:begin], "big")
            if not begin < at <= len(content):
                raise EOFError("cut short")
            part = content[begin:at]
            size = size_of(part)
            yield codec.decompress(part, decompressed_size=size, asbytes=True)
            left -= size


def _snappy_size(part: bytes) -> int:
    size = shift = 0
    for byte in part:
        size |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            break
    return size


def _lz4_size(part: bytes) -> int:
    """The sum of the lengths of literals and matches."""
    at = size = 0
    while at < len(part):
        token, at = part[at], at + 1
        for length, least in ((token >> 4, 0), (token & 15, 4)):
            if least:
                at += 2  # of the match's distance
            if length == 15:
                more = 255
                while more == 255:
                    more, at = part[at], at + 1
                    length += more
            size += length + least
            if not least:
                at += length
                if at >= len(part):
                    break
    return size
