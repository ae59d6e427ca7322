"""Token-id files: independent zstandard frames with a trailing seek table.

File layout (zstd seekable format, readable by any zstd decoder):

* one frame per document: its ids, little-endian unsigned 32-bit, written with
  the frame's own content checksum;
* a skippable frame (magic 0x184D2A50) with the document index: per document
  the doc_id as little-endian signed 64-bit, then one byte per document that
  is 0 if the doc_id is null;
* a skippable frame (magic 0x184D2A5E) with the seek table: per frame the
  compressed size, the decompressed size and the low 32 bits of the content's
  XXH64; then number of frames, descriptor byte (bit 7: checksums), magic
  0x8F92EAB1.

A reader takes the footer, the table and the index from the file's end and
decompresses only the frames it wants.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, running_total
from tessera.session import ensure_checkpoint_dir

# The numbers of the zstd seekable format.
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY = np.dtype([("packed", "<u4"), ("raw", "<u4"), ("check", "<u4")])
FOOTER = 9

TEXT_BYTES = 48 << 20       # bytes of text per written partition
FILE_BYTES = 256 << 20      # a task begins another file beyond this
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long"
ROWS = "part int, seq int, place long, doc_id long, n_tokens long, ids_crc32 long"


def _u32(*values: int) -> bytes:
    return b"".join(v.to_bytes(4, "little") for v in values)


class FileWriter:
    """Writes documents to one file; ``close`` puts it in place under its final name."""

    def __init__(self, folder: str, name: str, level: int = 3):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.uri = f"{base}/{name}", f"{folder}/{name}"
        self.out = self.fs.open_output_stream(f"{self.path}.part")
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries, self.ids, self.size, self.n_tokens = [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.out.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.size += len(frame)
        self.n_tokens += len(ids) // 4

    def close(self) -> int:
        keys = np.array([0 if i is None else i for i in self.ids], "<i8").tobytes()
        index = keys + bytes(i is not None for i in self.ids)
        table = np.array(self.entries, ENTRY).tobytes() + _u32(len(self.entries)) + bytes([CHECKSUMS]) + _u32(FOOTER_MAGIC)
        tail = _u32(INDEX_MAGIC, len(index)) + index + _u32(TABLE_MAGIC, len(table)) + table
        self.out.write(tail)
        self.out.close()
        self.fs.move(f"{self.path}.part", self.path)
        return self.size + len(tail)


class FileReader:
    """Random access to one file."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file, size = fs.open_input_file(path), fs.get_file_info(path).size
        n, magic = np.frombuffer(self._at(size - FOOTER, 4), "<u4")[0], self._at(size - 4, 4)
        if magic != _u32(FOOTER_MAGIC):
            raise ValueError(f"{uri}: no seek table at the end")
        table = int(n) * ENTRY.itemsize + FOOTER
        index = int(n) * 9
        at = size - table - 8 - index
        if self._at(size - table - 8, 4) != _u32(TABLE_MAGIC) or self._at(at - 8, 4) != _u32(INDEX_MAGIC):
            raise ValueError(f"{uri}: broken seek table")
        self.uri, self.entries = uri, np.frombuffer(self._at(size - table, table - FOOTER), ENTRY)
        keys = self._at(at, index)
        known = np.frombuffer(keys[8 * int(n):], np.uint8)
        self.doc_ids = [int(i) if k else None for i, k in zip(np.frombuffer(keys[:8 * int(n)], "<i8"), known)]
        ends = np.cumsum(self.entries["packed"].astype(np.int64))
        self.starts = ends - self.entries["packed"]
        self.unpacker = zstandard.ZstdDecompressor()

    def _at(self, start: int, length: int) -> bytes:
        return self.file.read_at(length, start)

    def get(self, place: int) -> bytes:
        """The ids of the document at ``place``; raises if a checksum does not fit."""
        e = self.entries[place]
        raw = self.unpacker.decompress(self._at(int(self.starts[place]), int(e["packed"])), max_output_size=int(e["raw"]))
        if len(raw) != e["raw"] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != e["check"]:
            raise ValueError(f"{self.uri}: checksum of frame {place}")
        return raw


def write_token_files(docs: DataFrame, folder: str, make_encoder: Callable[[], Callable[[str | None], bytes]],
                      end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      text_bytes: int = TEXT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``docs`` in ascending doc_id order (null first); returns the manifest, one row per file.

    Rows are range partitioned by doc_id, each task writes its range to files
    of its own, with a fresh name per attempt: a retried or lost task leaves
    files that no manifest names.  Null and empty texts are written with the
    end id only; repeated rows are written as often as they come; an empty
    table gives no file and an empty manifest.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(1, -(-total // text_bytes))
    end = _u32(end_id)

    def run(batches):
        encode, part = make_encoder(), TaskContext.get().partitionId()
        attempt, writer, seq, done = uuid.uuid4().hex, None, 0, []

        def finish():
            size = writer.close()
            done.append((part, seq, writer.uri, len(writer.ids), writer.n_tokens, size))
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                writer = writer or FileWriter(folder, f"ids-{part:06d}-{seq:04d}-{attempt}.zst")
                writer.add(doc_id, encode(text) + end)
                if writer.size >= file_bytes:
                    finish()
                    writer, seq = None, seq + 1
        if writer:
            finish()
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        if done:
            cast = pa.schema([(n, t) for n, t in zip(names, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))])
            yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema=cast)
    dealt = rows.repartitionByRange(n_parts, "doc_id").sortWithinPartitions("doc_id")
    return checkpointed(dealt.mapInArrow(run, MANIFEST))


def read_token_files(manifest: DataFrame, n_parts: int | None = None) -> DataFrame:
    """Every document of the files: ``part, seq, place, doc_id, n_tokens, ids_crc32``; all checksums are checked."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = FileReader(row["path"])
                for at in range(0, len(file.doc_ids), 4096):
                    places = range(at, min(at + 4096, len(file.doc_ids)))
                    raws = [file.get(p) for p in places]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["part"]] * len(raws), pa.int32()), pa.array([row["seq"]] * len(raws), pa.int32()),
                        pa.array(list(places), pa.int64()), pa.array([file.doc_ids[p] for p in places], pa.int64()),
                        pa.array([len(r) // 4 for r in raws], pa.int64()),
                        pa.array([zlib.crc32(r) for r in raws], pa.int64())],
                        names=["part", "seq", "place", "doc_id", "n_tokens", "ids_crc32"])
    files = manifest.select("part", "seq", "path")
    return files.repartition(n_parts or 64, "part", "seq").mapInArrow(run, ROWS)


def read_documents(uris: Iterable[str], doc_ids: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """``(doc_id, ids)`` of the requested documents; only their frames are decompressed."""
    wanted = set(doc_ids)
    for uri in uris:
        file = FileReader(uri)
        for place, doc_id in enumerate(file.doc_ids):
            if doc_id in wanted:
                yield doc_id, np.frombuffer(file.get(place), "<u4")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for files, as a URI, beside the checkpoints in the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/token-files-{uuid.uuid4().hex}"


def token_spans(docs: DataFrame, make_encoder, end_id: int, folder: str | None = None) -> DataFrame:
    """Write, read back, and place every document: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, folder or new_folder(spark), make_encoder, end_id)
    rows = read_token_files(manifest, spark.sparkContext.defaultParallelism * 4)
    return running_total(rows, ["part", "seq", "place"], F.col("n_tokens"), "start").select(
        "doc_id", "start", "n_tokens", "ids_crc32")
