"""FASTQ reader as a Python data source.

A record is four lines and ``@`` may also start a quality line, so plain text splitting does not
find record borders. Plain files are cut into byte ranges, each re-synchronised on a record
start; gzip files are read whole by one task per file. Batches leave as Arrow. A task takes consecutive
ranges of a file, as many as give it an even share of all bytes, so tasks don't grow with the number of ranges.

Files of samples that are not asked for are left out before they are opened, and columns that are not
asked for are not built. Both are options and not pushed-down filters: in Spark 4.1 a Python source that
took a filter keeps it for later queries of the same DataFrame that have none. Paths without a
scheme are on Spark's default file system.

Options: ``path`` (comma-separated files, folders or globs), ``layout`` (``interleaved``, ``mate1``
or ``mate2``), ``splitBytes``, ``tasks`` (how many to share the bytes among; by default each range is one), ``samples`` (a JSON list), ``samplePattern`` (a regular expression whose group 1, searched in the
file path, is the sample).
"""

import glob
import json
import os
import re
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "sample string, pair_id string, mate int, seq string, qual string"
ARROW = pa.schema(
    [("sample", pa.string()), ("pair_id", pa.string()), ("mate", pa.int32()), ("seq", pa.string()), ("qual", pa.string())]
)
BATCH = 8192
BLOCK = 1 << 20
#: Bytes looked at before a range, for the record that comes before its first one.
BACK = 1 << 12
DEFAULT_SPLIT = 128 << 20
DEFAULT_PATTERN = r"([^/.]+)(?:\.[^/]*)?$"


@dataclass
class FastqRange(InputPartition):
    path: str
    start: int
    end: int  # -1: to the end of the file
    step: int = 0  # bytes of one range; 0: all is one


def _filesystem(path):
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _list_files(path):
    found = []
    for part in path.split(","):
        system, name = _filesystem(part)
        if any(ch in name for ch in "*?["):
            if not isinstance(system, pafs.LocalFileSystem):
                root = name[: re.search(r"[*?\[]", name).start()].rsplit("/", 1)[0]
                pattern = re.compile(glob.translate(name)) if hasattr(glob, "translate") else None
                infos = system.get_file_info(pafs.FileSelector(root, recursive=True))
                prefix = part[: len(part) - len(name)]
                found += [(prefix + i.path, i.size) for i in infos if i.is_file and pattern.match(i.path)]
            else:
                found += [(p, os.path.getsize(p)) for p in sorted(glob.glob(name))]
            continue
        info = system.get_file_info([name])[0]
        if info.type == pafs.FileType.Directory:
            prefix = part[: len(part) - len(name)]
            found += [
                (prefix + i.path, i.size)
                for i in system.get_file_info(pafs.FileSelector(name, recursive=True))
                if i.is_file and not i.base_name.startswith(("_", "."))
            ]
        elif info.type == pafs.FileType.File:
            found.append((part, info.size))
        else:
            raise FileNotFoundError(part)
    return sorted(found)


def _plain_lines(stream, offset, size=BLOCK):
    """(offset, line) pairs from the stream's position on, read in blocks of ``size``."""
    stream.seek(offset)
    rest, at = b"", offset
    while True:
        block = stream.read(size)
        if not block:
            if rest:
                yield at, rest
            return
        *lines, rest = (rest + block).split(b"\n")
        for line in lines:
            yield at, line
            at += len(line) + 1


def _gzip_lines(stream):
    """Lines of a gzip file, concatenated members included."""
    rest, unzip = b"", zlib.decompressobj(31)
    while True:
        block = stream.read(BLOCK)
        if not block:
            break
        while block:
            rest += unzip.decompress(block)
            block = unzip.unused_data
            if unzip.eof:
                unzip = zlib.decompressobj(31)
                continue
            block = b""
        *lines, rest = rest.split(b"\n")
        for line in lines:
            yield 0, line
    if rest:
        yield 0, rest


def _records(lines, synchronised):
    """(offset, header, seq, qual); skips to the first record border when not synchronised."""
    window = []
    for at, line in lines:
        window.append((at, line.rstrip(b"\r")))
        if len(window) < 4:
            continue
        header, seq, plus, qual = (text for _, text in window)
        looks_right = header[:1] == b"@" and plus[:1] == b"+" and len(seq) == len(qual)
        if looks_right:
            synchronised = True
            yield window[0][0], header[1:].decode(), seq.decode(), qual.decode()
            window = []
        elif synchronised:
            if not any(text for _, text in window):
                window = []
                continue
            raise ValueError(f"broken FASTQ record near byte {window[0][0]}: {header[:80]!r}")
        else:
            window.pop(0)
    if synchronised and any(text for _, text in window):
        raise ValueError("FASTQ file ends inside a record")


def _name_and_mate(header):
    """Record name without its mate mark, and the mate the mark states (or None)."""
    name, _, comment = header.partition(" ")
    if name[-2:] in ("/1", "/2"):
        return name[:-2], int(name[-1])
    if re.match(r"[12]:[YN]:", comment):
        return name, int(comment[0])
    return name, None


def _sample_of(pattern, path):
    match = re.search(pattern, path)
    return match.group(1) if match else None


class FastqReader(DataSourceReader):
    def __init__(self, options, columns=tuple(ARROW.names)):
        self.columns = list(columns)
        named = options.get("samples")
        self.samples = None if named is None else set(json.loads(named))
        self.path = options["path"]
        self.layout = options.get("layout", "interleaved")
        if self.layout not in ("interleaved", "mate1", "mate2"):
            raise ValueError(f"unknown layout: {self.layout}")
        self.split = int(options.get("splitbytes", options.get("splitBytes", DEFAULT_SPLIT)))
        self.tasks = int(options.get("tasks", 0))
        self.pattern = options.get("samplepattern", options.get("samplePattern", DEFAULT_PATTERN))

    def partitions(self):
        parts = []
        files = [
            (path, size)
            for path, size in _list_files(self.path)
            if self.samples is None or _sample_of(self.pattern, path) in self.samples
        ]
        plain = sum(size for path, size in files if not path.endswith(".gz"))
        share = min(DEFAULT_SPLIT, plain // self.tasks) if self.tasks else 0
        run = max(1, share // self.split) * self.split
        for path, size in files:
            if path.endswith(".gz"):
                parts.append(FastqRange(path, 0, -1))
            else:
                parts += [FastqRange(path, s, min(s + run, size), self.split) for s in range(0, size, run)]
        return parts

    def read(self, partition):
        if partition is None:  # No file at all: Spark still asks once.
            return
        sample = _sample_of(self.pattern, partition.path)
        kept = [ARROW.names.index(c) for c in self.columns]
        system, name = _filesystem(partition.path)
        rows = []
        with system.open_input_file(name) as stream:
            for part in self._ranges(partition):
                for pair_id, mate, seq, qual in self._mates(stream, part):
                    rows.append((sample, pair_id, mate, seq, qual))
                    if len(rows) == BATCH:
                        yield self._batch(rows, kept)
                        rows = []
        if rows:
            yield self._batch(rows, kept)

    @staticmethod
    def _ranges(partition):
        if not partition.step:
            return [partition]
        starts = range(partition.start, partition.end, partition.step)
        return (FastqRange(partition.path, s, min(s + partition.step, partition.end)) for s in starts)

    @staticmethod
    def _batch(rows, kept):
        columns = list(zip(*rows))
        fields = [ARROW.field(i) for i in kept]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[i], type=field.type) for i, field in zip(kept, fields)], schema=pa.schema(fields)
        )

    def _in_range(self, stream, partition):
        """(record, previous record name) for records that start inside the range."""
        if partition.end < 0:
            source = _records(_gzip_lines(stream), True)
        else:
            source = self._from_before(stream, partition.start, partition.end)
        previous = None
        for at, header, seq, qual in source:
            if partition.end >= 0 and at >= partition.end:
                return
            if at >= partition.start:
                yield header, seq, qual, previous
            previous = header

    @staticmethod
    def _from_before(stream, start, end):
        """Records from a little before the range on, so that its first record can be paired.

        Two records must begin before it: the first may be one whose header was cut.
        """
        back = BACK
        while True:
            at = max(0, start - back)
            if at:
                probe = _records(_plain_lines(stream, at, min(back, BLOCK)), False)
                next(probe, None)
                second = next(probe, None)
            if at == 0 or (second is not None and second[0] < start):
                return _records(_plain_lines(stream, at, min(BLOCK, end - at + BACK)), at == 0)
            back *= 4

    def _mates(self, stream, partition):
        fixed = {"mate1": 1, "mate2": 2}.get(self.layout)
        last, last_mate = None, None
        for header, seq, qual, before in self._in_range(stream, partition):
            name, stated = _name_and_mate(header)
            if last is None and before is not None:
                last = _name_and_mate(before)[0]
                last_mate = 1
            mate = fixed or stated or (2 if name == last and last_mate == 1 else 1)
            yield name, mate, seq, qual
            last, last_mate = name, mate


class FastqSource(DataSource):
    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FastqReader(self.options, schema.names)


def _qualified(spark, path):
    """The path with its scheme, as Spark itself would read it; a glob stays a glob."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(folder).toString()


def read_fastq(spark, path, layout="interleaved", sample_pattern=DEFAULT_PATTERN, split_bytes=DEFAULT_SPLIT, samples=None, columns=None):
    """Reads of one or many FASTQ files, plain or gzip.

    ``path`` is a path, glob or list of them; for ``layout="split"`` a pair of such values, the
    first mates and the second mates. ``samples`` are the names whose files are read and ``columns`` those
    to build (all by default).
    """
    spark.dataSource.register(FastqSource)
    types = dict(field.split() for field in SCHEMA.split(", "))
    schema = ", ".join(f"{c} {types[c]}" for c in columns or types)

    def load(where, how):
        parts = where.split(",") if isinstance(where, str) else where
        reader = spark.read if samples is None else spark.read.option("samples", json.dumps(list(samples)))
        return (
            reader.format("fastq")
            .schema(schema)
            .option("path", ",".join(_qualified(spark, p) for p in parts))
            .option("layout", how)
            .option("samplePattern", sample_pattern)
            .option("splitBytes", str(split_bytes))
            .option("tasks", str(4 * spark.sparkContext.defaultParallelism))
            .load()
        )

    if layout == "split":
        first, second = path
        return load(first, "mate1").unionByName(load(second, "mate2"))
    return load(path, layout)
