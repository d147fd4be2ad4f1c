"""BAM files as tables: a data source after the public SAM/BAM specification.

A file is read block by block by one task; a folder gives one task for each
file, so convert large files once and work on Parquet.  The writer makes one
BAM file for each partition, under a temporary name until the job commits.
"""

from __future__ import annotations

import base64
import gzip
import json
import os
import struct
import uuid
import warnings
import zlib
from collections.abc import Iterator
from pathlib import Path
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from poolspark.functions import barcode
from poolspark.schema import QC
from poolspark.sources import tables

#: Unmapped, secondary and supplementary alignments.
SKIP = 4 | 256 | 2048
_SIZE = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
#: Rows that pass between Spark and Python at a time.
ROWS = 10_000
#: The columns of a table of records, before ``raw``.
KINDS = (pa.string(), pa.string(), pa.int16(), pa.int32(), pa.int32(), pa.int16(), pa.string(), pa.int32())
_CODE = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
# Fixed value: the empty block that ends a file.
_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def tags(data: bytes) -> dict[str, object]:
    """Optional fields of a record; arrays are skipped."""
    out, at = {}, 0
    while at + 3 <= len(data):
        name, kind, at = data[at : at + 2].decode(), chr(data[at + 2]), at + 3
        if kind in "ZH":
            end = data.index(0, at)
            out[name], at = data[at:end].decode(), end + 1
        elif kind == "B":
            sub, n = chr(data[at]), struct.unpack_from("<I", data, at + 1)[0]
            at += 5 + n * _SIZE[sub]
        else:
            out[name] = chr(data[at]) if kind == "A" else struct.unpack_from("<" + _CODE[kind], data, at)[0]
            at += _SIZE[kind]
    return out


def header(f: BinaryIO) -> tuple[bytes, list[str]]:
    """The header's bytes and the names of the reference sequences."""
    raw = f.read(8)
    if raw[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    raw += f.read(struct.unpack_from("<i", raw, 4)[0])
    n = f.read(4)
    raw, names = raw + n, []
    for _ in range(struct.unpack("<i", n)[0]):
        size = f.read(4)
        body = f.read(struct.unpack("<i", size)[0] + 4)
        raw, names = raw + size + body, [*names, body[:-5].decode()]
    return raw, names


def records(f: BinaryIO) -> Iterator[bytes]:
    while len(size := f.read(4)) == 4:
        yield f.read(struct.unpack("<i", size)[0])


def row(rec: bytes, names: list[str]) -> tuple:
    """(Read, BC, MAPQ, as_, NM, XAcount, frag_loc, flag) of a record."""
    ref, pos, name_len, mapq, _, n_cigar, flag, seq_len, mate_ref, mate_pos = struct.unpack_from("<iiBBHHHiii", rec)
    read = rec[32 : 31 + name_len].decode()
    own = tags(rec[32 + name_len + 4 * n_cigar + (seq_len + 1) // 2 + seq_len :])
    xa = own.get("XA")
    mate = mate_pos if flag & 1 and not flag & 8 else -1
    chrom = names[ref] if 0 <= ref < len(names) else "*"
    score = lambda t: int(own[t]) if t in own else None
    return read, own.get("CB", own.get("BC")), mapq, score("AS"), score("NM"), xa.count(";") if isinstance(xa, str) else 0, f"{chrom}:{pos}:{mate}", flag


def _local(path: str) -> str:
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path}: BAM files are read and written on mounted paths")
    return path.removeprefix("file://").removeprefix("file:")


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.raw = _local(options["path"]), options.get("raw", "false") == "true"

    def partitions(self):
        own = Path(self.path)
        return [InputPartition(str(p)) for p in (sorted(own.glob("*.bam")) if own.is_dir() else [own])] or [InputPartition("")]

    def read(self, partition):
        if not partition.value:
            return
        fields = [*zip([*QC.fieldNames(), "flag"], KINDS, strict=True), *([("raw", pa.binary())] if self.raw else [])]
        batch = lambda held: pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*held, strict=True), fields, strict=True)], schema=pa.schema(fields))
        held = []
        with gzip.open(partition.value) as f:
            _, names = header(f)
            for rec in records(f):
                out = row(rec, names)
                if self.raw:
                    held.append((*out, rec))
                elif not out[-1] & SKIP:
                    held.append(out)
                if len(held) >= ROWS:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)


def _record(refs: dict[str, int], read, bc, mapq, as_, nm, xa, frag_loc) -> bytes:
    chrom, pos, mate = (frag_loc or "*:-1:-1").split(":")
    name = (read or "*").encode() + b"\0"
    paired = int(mate) >= 0
    head = struct.pack("<iiBBHHHiiii", refs.get(chrom, -1), int(pos), len(name), mapq or 0, 0, 0, 1 if paired else 0, 0, refs.get(chrom, -1) if paired else -1, int(mate), 0)
    out = head + name
    for tag, value in (("AS", as_), ("NM", nm)):
        if value is not None:
            out += tag.encode() + b"i" + struct.pack("<i", value)
    for tag, text in (("CB", bc), ("XA", "x,+1,1M,0;" * (xa or 0) or None)):
        if text is not None:
            out += tag.encode() + b"Z" + text.encode() + b"\0"
    return out


def _block(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class _Message(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.header = _local(options["path"]), base64.b64decode(options["header"])
        self.refs = {n: i for i, n in enumerate(json.loads(options["refs"]))}

    def write(self, iterator):
        os.makedirs(self.path, exist_ok=True)
        name = f"part-{uuid.uuid4().hex}.bam"
        with open(f"{self.path}/.{name}", "wb") as f:
            held = bytearray(self.header)
            for rec in self._records(iterator):
                held += struct.pack("<i", len(rec)) + rec
                while len(held) >= 60_000:
                    f.write(_block(bytes(held[:60_000])))
                    del held[:60_000]
            f.write((_block(bytes(held)) if held else b"") + _END)
        return _Message(name)

    def _records(self, batches) -> Iterator[bytes]:
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                own = b.slice(at, ROWS)
                if "raw" in own.schema.names:
                    yield from own.column("raw").to_pylist()
                else:
                    for cells in zip(*[own.column(c).to_pylist() for c in QC.fieldNames()], strict=True):
                        yield _record(self.refs, *cells)

    def commit(self, messages):
        for m in messages:
            if m is not None:
                os.rename(f"{self.path}/.{m.name}", f"{self.path}/{m.name}")

    def abort(self, messages):
        for m in messages:
            if m is not None and os.path.exists(f"{self.path}/.{m.name}"):
                os.remove(f"{self.path}/.{m.name}")


class BamSource(DataSource):
    """Format ``poolspark_bam``; option raw=true adds each record's bytes and keeps all records."""

    @classmethod
    def name(cls):
        return "poolspark_bam"

    def schema(self):
        raw = [StructField("raw", BinaryType())] if self.options.get("raw") == "true" else []
        return StructType([*QC.fields, StructField("flag", IntegerType()), *raw])

    def reader(self, schema):
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite):
        return _Writer(dict(self.options))


def read_bam(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """QC rows and flags of the primary mapped alignments; barcodes are normalised if a sample is named."""
    spark.dataSource.register(BamSource)
    rows = spark.read.format("poolspark_bam").option("path", path).load()
    return rows if sample is None else rows.withColumn("BC", barcode.normalized(F.col("BC"), sample))


def make_header(names: list[str], length: int = 1 << 29) -> bytes:
    text = "".join(["@HD\tVN:1.6\n", *(f"@SQ\tSN:{n}\tLN:{length}\n" for n in names)]).encode()
    refs = b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", length) for n in names)
    return b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(names)) + refs


def write_bam(rows: DataFrame, path: str) -> None:
    """QC rows as BAM files without sequences; the reference sequences are those that the rows name."""
    rows.sparkSession.dataSource.register(BamSource)
    names = sorted(r[0] for r in rows.select(F.split_part("frag_loc", F.lit(":"), F.lit(1))).distinct().collect() if r[0] and r[0] != "*")
    own = rows.select(*QC.fieldNames())
    own.write.format("poolspark_bam").option("path", path).option("header", base64.b64encode(make_header(names)).decode()).option("refs", json.dumps(names)).mode("append").save()


def clean_bam(spark: SparkSession, source: str, drops: DataFrame, target: str) -> None:
    """A BAM file, or a folder of them with one header, without the alignments of dropped reads; all else unchanged."""
    spark.dataSource.register(BamSource)
    first = min(Path(_local(source)).glob("*.bam"), default=None) if os.path.isdir(_local(source)) else _local(source)
    if first is None:
        raise FileNotFoundError(f"no BAM files in {source}")
    with gzip.open(first) as f:
        head, names = header(f)
    rows = spark.read.format("poolspark_bam").option("path", source).option("raw", "true").load()
    kept = rows.join(drops.where("read_id is not null").select(F.col("read_id").alias("Read")).distinct(), "Read", "left_anti").select("raw")
    kept.write.format("poolspark_bam").option("path", target).option("header", base64.b64encode(head).decode()).option("refs", json.dumps(names)).option("raw", "true").mode("append").save()


def clean_bams(spark: SparkSession, drops: DataFrame, out_dir: str, source: str | None = None, bam_map: str | None = None, suffix: str = ".clean.bam") -> dict[str, str]:
    """{bam_id: output} of one BAM file, or of all in a map; those that do not exist are skipped with a warning."""
    if (source is None) == (bam_map is None):
        raise ValueError("give either a BAM or a map of BAMs")
    pairs = [("bam", source)] if source is not None else tables.read_bam_map(spark, bam_map)
    out = {}
    for name, path in pairs:
        if not tables.exists(spark, path):
            warnings.warn(f"no BAM {path}", stacklevel=2)
            continue
        out[name] = f"{out_dir}/{os.path.splitext(os.path.basename(path))[0]}{suffix}"
        clean_bam(spark, path, drops, out[name])
    return out


def read_sam(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """The same rows from SAM text, by column expressions."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("c"))
    at = lambda i: F.col("c")[i]
    tag = lambda t: F.regexp_extract(F.array_join(F.slice("c", 12, 1 << 20), "\t"), rf"(?:^|\t){t}:[A-Za-z]:([^\t]*)", 1)
    text = lambda t: F.when(tag(t) != "", tag(t))
    flag = at(1).cast("int")
    mate = F.when((flag.bitwiseAND(1) != 0) & (flag.bitwiseAND(8) == 0), at(7).cast("int") - 1).otherwise(-1)
    xa = F.length(tag("XA")) - F.length(F.replace(tag("XA"), F.lit(";")))
    rows = lines.where(flag.bitwiseAND(SKIP) == 0).select(
        at(0).alias("Read"), F.coalesce(text("CB"), text("BC")).alias("BC"), at(4).cast("short").alias("MAPQ"), text("AS").cast("int").alias("as_"), text("NM").cast("int").alias("NM"), xa.cast("short").alias("XAcount"),
        F.concat_ws(":", at(2), (at(3).cast("int") - 1).cast("string"), mate.cast("string")).alias("frag_loc"),
    )
    return rows if sample is None else rows.withColumn("BC", barcode.normalized(F.col("BC"), sample))
