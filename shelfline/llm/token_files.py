"""Token ids in seekable Zstandard files: independent frames, a trailing seek table, checksums.

A file is a run of Zstandard frames, each holding the ids of whole documents as little-endian
unsigned 32-bit integers, then a skippable frame with the documents' ids and lengths, then the seek
table of the public seekable format (compressed size, size and low 32 bits of XXH64 per frame) with
its footer. A reader takes the table from the end and decompresses only the frames that hold the
documents it wants.

Documents are range-partitioned and sorted by id; each task writes files named after its attempt
and reports them as manifest rows, which are staged, so only files of committed tasks count and a
lost executor costs a rerun of its tasks. Global offsets are sums over the manifest.

Defined results: a null or empty text has only the end id; null ids come first and read back as
null; rows of one id follow each other, by text; an empty table gives an empty manifest; a damaged
frame or table raises; other columns are not read, whatever their names; a very long text is one
document of one frame. Paths may be on any file system that pyarrow opens.
"""

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.llm.bpe import encode_frames
from shelfline.llm.common import ship, stage
from shelfline.session import scratch_dir

FRAME_TOKENS = 1 << 16
FILE_TOKENS = 1 << 26
LEVEL = 1
NULL_ID = -(2**63)
# Fixed values of the public Zstandard seekable format.
SKIPPABLE = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
SEEKABLE = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

MANIFEST = "path string, part int, number int, n_docs long, n_tokens long, n_frames long, n_bytes long"


def _open(path, mode):
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    if mode == "w":
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(place, compression=None)
    return system.open_input_file(place)


class FileWriter:
    """Writes one file, frame by frame; ``close`` adds the document index and the seek table."""

    def __init__(self, path):
        import zstandard

        self.path, self.sink = path, _open(path, "w")
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.frames, self.docs, self.counts = [], [], []
        self.waiting, self.n_waiting, self.n_tokens, self.n_bytes = [], 0, 0, 0

    def add(self, doc_id, ids):
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_tokens += len(ids)
        if self.n_waiting >= FRAME_TOKENS:
            self._flush()

    def _write(self, data):
        self.sink.write(data)
        self.n_bytes += len(data)

    def _flush(self):
        import xxhash

        if not self.n_waiting:
            return
        raw = np.concatenate(self.waiting).astype("<u4").tobytes()
        packed = self.compressor.compress(raw)
        self._write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF))
        self.waiting, self.n_waiting = [], 0

    def close(self):
        self._flush()
        index = np.array([self.docs, self.counts], dtype="<i8").tobytes()
        packed = self.compressor.compress(index)
        self._write(struct.pack("<II", INDEX_FRAME, len(packed)) + packed)
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEKABLE)
        self._write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.sink.close()
        return len(self.docs), self.n_tokens, len(self.frames), self.n_bytes


class FileReader:
    """Reads the tables of one file, then any frames asked for."""

    def __init__(self, path):
        import zstandard

        self.source = _open(path, "r")
        self.decompressor = zstandard.ZstdDecompressor()
        size = self.source.size()
        n_frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != WITH_CHECKSUMS:
            raise ValueError(f"{path}: not a seekable file with checksums")
        table = self._at(size - 9 - 12 * n_frames, 12 * n_frames)
        self.frames = np.frombuffer(table, "<u4").reshape(n_frames, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        magic, length = struct.unpack("<II", self._at(int(self.places[-1]), 8))
        if magic != INDEX_FRAME:
            raise ValueError(f"{path}: no document index")
        index = np.frombuffer(self.decompressor.decompress(self._at(int(self.places[-1]) + 8, length)), "<i8")
        self.docs, self.counts = index.reshape(2, -1)
        self.ends = np.cumsum(self.counts)
        self.frame_ends = np.cumsum(self.frames[:, 1] // 4)

    def _at(self, offset, length):
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, number):
        import xxhash

        packed, length, checksum = map(int, self.frames[number])
        raw = self.decompressor.decompress(self._at(int(self.places[number]), packed), max_output_size=length)
        if len(raw) != length or xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return np.frombuffer(raw, "<u4")

    def by_frame(self, wanted=None):
        """(positions of documents in the file, their ids) of each frame that holds any wanted one."""
        last = np.searchsorted(self.frame_ends, self.ends, side="left")
        for number in range(len(self.frames)):
            inside = np.flatnonzero(last == number)
            if wanted is not None:
                inside = inside[np.isin(self.docs[inside], wanted)]
            if len(inside):
                ids = self.frame(number)
                base = int(self.frame_ends[number]) - len(ids)
                yield inside, [ids[e - n - base : e - base] for e, n in zip(self.ends[inside], self.counts[inside])]


def write_token_files(docs, tokenizer_path, end_id, folder=None, id_col="doc_id", text_col="text"):
    """Writes all rows in ascending order of id; returns the staged manifest, one row per file."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch_dir(spark, "token-files")

    def write(batches):
        part, run, number, writer = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], 0, None

        def closed():
            return pd.DataFrame([(writer.path, part, number, *writer.close())], columns=columns)

        columns = [field.split(" ")[0] for field in MANIFEST.split(", ")]
        for frame, flat, counts in encode_frames(batches, tokenizer_path):
            ends = np.cumsum(counts)
            known = frame["doc_id"].notna().to_numpy()
            ids = frame["doc_id"].fillna(0).astype("int64").to_numpy()
            for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
                if writer is None:
                    writer = FileWriter(f"{folder}/tokens-{part:06d}-{number:04d}-{run}.zst")
                writer.add(int(ids[i]) if known[i] else NULL_ID, np.append(flat[end - n : end], end_id))
                if writer.n_tokens >= FILE_TOKENS:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stage(ordered.mapInPandas(write, MANIFEST), "token-manifest")


def read_token_files(manifest):
    """Rows (doc_id, start, n_tokens, ids_crc32) read back from the files, every frame checked."""
    spark = manifest.sparkSession
    ship(spark)
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("path", "base")

    def read(batches):
        for frame in batches:
            for path, base in zip(frame["path"], frame["base"]):
                reader = FileReader(path)
                for inside, parts in reader.by_frame():
                    doc_ids = pd.Series(reader.docs[inside], dtype="Int64")
                    yield pd.DataFrame(
                        {
                            "doc_id": doc_ids.where(doc_ids != NULL_ID),
                            "start": base + reader.ends[inside] - reader.counts[inside],
                            "n_tokens": reader.counts[inside],
                            "ids_crc32": [zlib.crc32(ids.tobytes()) for ids in parts],
                        }
                    )

    spread = placed.repartition(max(spark.sparkContext.defaultParallelism, 1), "path")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(path, doc_ids):
    """{doc_id: ids} of some documents of one file; only their frames are decompressed."""
    reader = FileReader(path)
    found = {}
    for inside, parts in reader.by_frame(np.asarray(doc_ids, np.int64)):
        found.update((int(reader.docs[i]), ids) for i, ids in zip(inside, parts))
    return found
