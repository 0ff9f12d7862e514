"""BAM files, read in stretches of compressed blocks."""

from __future__ import annotations

import bisect
import gzip
import io
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..schemas import SAM, columns

ROWS = 10_000
CIGAR, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
#: Types of numbers in a record's tags, and what a compressed block begins with.
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
MAGIC = b"\x1f\x8b\x08\x04"
#: Bytes in which the first record of a stretch is looked for at a time, and records that must follow from a place for it to be one's beginning.
LOOK, SENSE = 1 << 20, 3


def _opened(path: str):
    store, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return store.open_input_file(name)


def tags(block: bytes, at: int) -> Iterator[str]:
    """The tags from a place of a record on, as SAM text."""
    plain = lambda v, kind: f"{v:g}" if kind == "f" else str(v)
    while at + 3 <= len(block):
        key, kind = block[at : at + 2].decode(), chr(block[at + 2])
        at += 3
        if kind == "A":
            text, at = chr(block[at]), at + 1
        elif kind in NUMBERS:
            (v,) = struct.unpack_from("<" + NUMBERS[kind], block, at)
            text, at, kind = plain(v, kind), at + struct.calcsize(NUMBERS[kind]), kind if kind == "f" else "i"
        elif kind in "ZH":
            end = block.index(0, at)
            text, at = block[at:end].decode(), end + 1
        elif kind == "B":
            own, n = chr(block[at]), struct.unpack_from("<i", block, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[own]}", block, at + 5)
            text, at = ",".join([own, *(plain(v, own) for v in values)]), at + 5 + n * struct.calcsize(NUMBERS[own])
        else:
            raise ValueError(f"unknown type {kind} of tag {key}")
        yield f"{key}:{kind}:{text}"


def row_of(block: bytes, refs: list[str]) -> tuple:
    """The SAM columns of a record."""
    name = lambda i: refs[i] if i >= 0 else "*"
    ref, pos, l_name, mapq, _, n_cigar, flag, l_seq, mate, mate_pos, tlen = struct.unpack_from("<iiBBHHHiiii", block)
    at = 32 + l_name
    ops = struct.unpack_from(f"<{n_cigar}I", block, at)
    at += 4 * n_cigar
    packed = block[at : at + (l_seq + 1) // 2]
    at += (l_seq + 1) // 2
    seq = "".join(BASES[x >> 4] + BASES[x & 15] for x in packed)[:l_seq] or "*"
    qual = block[at : at + l_seq]
    qual = "*" if not l_seq or qual[0] == 255 else bytes(q + 33 for q in qual).decode()
    nxt = "=" if mate == ref and mate >= 0 else name(mate)
    return block[32 : 31 + l_name].decode(), flag, name(ref), pos + 1, mapq, "".join(f"{o >> 4}{CIGAR[o & 15]}" for o in ops) or "*", nxt, mate_pos + 1, tlen, seq, qual, "\t".join(tags(block, at + l_seq)) or None


def references(stream) -> list[str]:
    """The names of the references; the stream is left at the first record."""
    if stream.read(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    stream.read(struct.unpack("<i", stream.read(4))[0])
    refs = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        refs.append(stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode())
        stream.read(4)
    return refs


def _block_size(head: bytes) -> int:
    """Bytes of the compressed block that begins with head; 0 if none does."""
    if len(head) < 18 or head[:4] != MAGIC:
        return 0
    extra, at = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 6 <= len(extra):
        kind, n = extra[at : at + 2], struct.unpack_from("<H", extra, at + 2)[0]
        if kind == b"BC" and n == 2:
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + n
    return 0


class Blocks:
    """What the compressed blocks of a file hold from one of them on: data, and by where it lies in data the place of each block in the file."""

    def __init__(self, file, at: int):
        self.file, self.next = file, at
        self.data, self.starts, self.places = bytearray(), [], []
        self.ended = False

    def load(self, upto: int) -> bool:
        """Whether there are as many bytes of data."""
        while len(self.data) < upto and not self.ended:
            self.file.seek(self.next)
            head = self.file.read(1 << 16)
            size = _block_size(head)
            if not head:
                self.ended = True
                break
            if not size or size > len(head):
                raise ValueError(f"no whole block at byte {self.next}")
            body = zlib.decompress(head[12 + struct.unpack_from("<H", head, 10)[0] : size - 8], -15)
            self.starts.append(len(self.data))
            self.places.append(self.next)
            self.data += body
            self.next += size
        return len(self.data) >= upto

    def place(self, at: int) -> int:
        """The block in which a place of data lies."""
        return self.places[bisect.bisect_right(self.starts, at) - 1]

    def drop(self, n: int) -> int:
        """Lets the first bytes go, whole blocks of them; how many."""
        k = bisect.bisect_right(self.starts, n) - 1
        gone = self.starts[k] if k > 0 else 0
        if gone:
            del self.data[:gone]
            self.starts, self.places = [s - gone for s in self.starts[k:]], self.places[k:]
        return gone

    def read(self, n: int) -> bytes:
        """For the header: the next bytes, counted in `done`."""
        self.load(self.done + n)
        out = bytes(self.data[self.done : self.done + n])
        self.done += n
        return out

    done = 0


def _end(data: bytearray, at: int, refs: int) -> int | None:
    """Where the record that begins at a place ends; -1 if none can begin there, None if that lies beyond the data."""
    if len(data) < at + 36:
        return None
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < refs and -1 <= mate < refs and pos >= -1 and mate_pos >= -1 and l_name and l_seq >= 0):
        return -1
    if not 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq <= size < 1 << 28:
        return -1
    name = data[at + 36 : at + 36 + l_name]
    if len(name) == l_name and (name[-1] or not all(33 <= c <= 126 for c in name[:-1])):
        return -1
    return at + 4 + size


def _begins(blocks: Blocks, at: int, refs: int) -> bool:
    """Whether records that make sense follow from a place: SENSE of them, or all up to the end of the file."""
    for _ in range(SENSE):
        end = _end(blocks.data, at, refs)
        if end == -1 or end is None and blocks.ended:
            return False
        if end is None or end > len(blocks.data):
            return not blocks.ended
        at = end
        if at == len(blocks.data) and blocks.ended:
            return True
    return True


def _first_block(file, start: int, size: int) -> int | None:
    """The first compressed block at or after a place: its beginning is followed by another block, or the end, where it says."""
    while start < size:
        file.seek(start)
        chunk = file.read(1 << 17)
        at = chunk.find(MAGIC)
        while at >= 0:
            if n := _block_size(chunk[at : at + 64]):
                file.seek(start + at + n)
                if start + at + n == size or file.read(4) == MAGIC:
                    return start + at
            at = chunk.find(MAGIC, at + 1)
        start += max(1, len(chunk) - 64)  # a head may lie across the end of what was read
    return None


def records(path: str, start: int, end: int) -> Iterator[tuple]:
    """The SAM columns of the records that begin in the compressed blocks that begin in [start, end) of a file; of a file that isn't in blocks, all if start is 0 and none else."""
    with _opened(path) as file:
        size = file.size()
        if not _block_size(file.read(64)):
            if start == 0:
                file.seek(0)
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BufferedReader(file, 1 << 20)), 1 << 20)
                refs = references(stream)
                while head := stream.read(4):
                    yield row_of(stream.read(struct.unpack("<i", head)[0]), refs)
            return
        blocks = Blocks(file, 0)
        refs = references(blocks)
        at = blocks.done
        blocks.load(at + 1)
        if start > blocks.place(at):
            first = _first_block(file, start, size)
            if first is None or first >= end:
                return
            blocks, at = Blocks(file, first), 0
            while True:
                blocks.load(at + LOOK)
                while at < len(blocks.data) and not _begins(blocks, at, len(refs)):
                    at += 1
                if at < len(blocks.data) or blocks.ended or blocks.places[-1] >= end:
                    break
        while blocks.load(at + 4):
            if blocks.place(at) >= end:
                return
            n = 4 + struct.unpack_from("<i", blocks.data, at)[0]
            if not blocks.load(at + n) or _end(blocks.data, at, len(refs)) != at + n:
                raise ValueError(f"malformed BAM record in the block at byte {blocks.place(at)}")
            yield row_of(bytes(blocks.data[at + 4 : at + n]), refs)
            at += n
            if at > LOOK:
                at -= blocks.drop(at)


def _bam(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    fields = columns(SAM)
    made = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])
    for b in batches:
        for path, start, end in zip(*(c.to_pylist() for c in b.columns)):
            rows: list[tuple] = []
            for row in records(path, start, end):
                rows.append(row)
                if len(rows) == ROWS:
                    yield made(rows)
                    rows = []
            yield made(rows)


def read_bam(spark: SparkSession, paths: list[str], split: int = 64 << 20) -> DataFrame:
    """The SAM columns of BAM files. A file in compressed blocks is read in stretches of `split` bytes, each a task: the records that begin in a stretch's blocks are its own. Where the first of them begins is told by records that make sense from there on; one that doesn't is an error."""
    rows = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
        rows += [(p, at, min(size, at + split)) for at in range(0, max(size, 1), split)]
    return spark.createDataFrame(rows, "path string, start long, end long").repartition(max(1, len(rows))).mapInArrow(_bam, SAM)
