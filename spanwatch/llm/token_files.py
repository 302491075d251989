"""Token ids of documents as flat files of unsigned integers, and these files read back.

The documents are cut into ranges of their key and each task writes one range: a file of ids
(the smallest unsigned type that holds every id, little-endian), 64-bit offsets of the documents
in it, and their keys. A table names the files of the tasks that finished, so what a lost
executor leaves behind belongs to nothing. Where a file begins among all ids is a prefix sum over
one number a file; nothing else comes to the driver.

Null and empty texts have the closing id only. Rows without a key come first. Repeated rows all
count; rows of equal keys follow in the order of their texts. An empty table gives no file and
reads back as no rows. Columns beside key and text are not looked at, whatever their names.
"""

import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from spanwatch.llm import byte_runs

PARTS = "part int, file string, unit string, docs long, ids long"
READ_IDS = 1 << 20
READ_TASKS = 10_000

# Longer pieces are encoded each time; a worker forgets all once it knows so many.
KNOWN_BYTES, KNOWN_PIECES = 64, 800_000

# ---- fixed values: how a word tokenizer (NFC, lower case, white space dropped, letters apart
# from all else but for contractions) may be cut without changing any id ------------------------
# Texts of ASCII and of letters that stay letters in lower case, without the start of a special
# token, are cut at the ends of letter runs; all others at white space only.
BEYOND, SPECIAL = re.compile("[^\x00-\x7fÀ-ÖØ-öø-įı-ſ]"), "<|"
SPACE, LETTER, APOSTROPHE, OTHER = 0, 1, 2, 3
NEAR_KINDS = byte_runs.kinds(
    OTHER, k0=" \t\r\n", k1=bytes([*range(ord("a"), ord("z") + 1), *range(128, 256)]), k2="'"
)
FAR_KINDS = byte_runs.kinds(OTHER, k0=" \t\r\n")
LOWER = bytes(range(256)).lower()
# ------------------------------------------------------------------------------------------------


class Encoder:
    """Documents to ids. Distinct pieces of a block are looked up in what the worker has met
    before, and only new ones are encoded; `by_words=False` encodes whole texts instead, for
    tokenizers that are not of the kind above."""

    def __init__(self, tokenizer: str, end_id: int, by_words: bool):
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.end_id, self.by_words = end_id, by_words
        self.unit = np.dtype(unit_of(self.tokenizer, end_id))
        self.known: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array([*ids, self.end_id], self.unit)

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of distinct pieces."""
        packed = list(map(self.known.get, pieces))
        new = [n for n, ids in enumerate(packed) if ids is None]
        # ASCII letters in lower case go to the merges as they are.
        plain = [n for n in new if pieces[n].isalpha() and pieces[n].islower()]
        merged = self.tokenizer.model.tokenize
        for n in plain:
            packed[n] = self._packed([token.id for token in merged(pieces[n].decode())])
        other = [n for n in new if packed[n] is None]
        texts = [pieces[n].decode() for n in other]
        for n, found in zip(other, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            packed[n] = self._packed(found.ids)
        if len(self.known) + len(new) > KNOWN_PIECES:
            self.known.clear()
        self.known.update((pieces[n], packed[n]) for n in new if len(pieces[n]) <= KNOWN_BYTES)
        return packed

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.unit.char}", *ids)

    def _block(self, texts: list[bytes], near: bool) -> list[np.ndarray]:
        """Ids of each text. Texts are joined by a line end, which no piece reaches across."""
        data = b"\n".join(texts)
        lengths = np.fromiter(map(len, texts), np.int32, len(texts))
        begins = np.cumsum(lengths + 1, dtype=np.int32) - lengths - 1
        if near:
            data = data.translate(LOWER)
            starts, ends, kind = byte_runs.runs(data, NEAR_KINDS)
            # A piece between white space with an apostrophe anywhere stays whole.
            first = np.ones(len(starts), bool)
            first[1:] = starts[1:] != ends[:-1]
            chunk = np.cumsum(first) - 1
            whole = np.bincount(chunk[kind == APOSTROPHE], minlength=len(first)) > 0
            cut = first | ~whole[chunk]
            starts, ends = starts[cut], ends[np.append(cut[1:], True)] if len(cut) else ends
        else:
            starts, ends, _ = byte_runs.runs(data, FAR_KINDS)
        codes, pieces = byte_runs.coded(data, starts, ends)
        packed = self._pieces(pieces)
        sizes = np.fromiter(map(len, packed), np.int32, len(packed)) // self.unit.itemsize
        flat = np.frombuffer(b"".join(packed), self.unit)
        counts = sizes[codes]
        places = np.zeros(len(codes) + 1, np.int32)
        np.cumsum(counts, out=places[1:])
        source = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes)[codes] - places[:-1], counts)
        source += np.arange(places[-1], dtype=np.int32)
        ids = flat[source]
        bounds = places[np.append(np.searchsorted(starts, begins), len(starts))]
        return [
            np.append(ids[a:b], self.unit.type(self.end_id))
            for a, b in zip(bounds[:-1], bounds[1:])
        ]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        texts = [text or "" for text in texts]
        if not self.by_words:
            return [self._whole(text) for text in texts]
        found: list[np.ndarray] = [None] * len(texts)
        near = [
            SPECIAL not in text and (text.isascii() or not BEYOND.search(text)) for text in texts
        ]
        for side in (True, False):
            numbers = [n for n in range(len(texts)) if near[n] is side]
            raw = [texts[n].encode() for n in numbers]
            for block in byte_runs.blocks(raw):
                for n, ids in zip(block, self._block([raw[n] for n in block], side)):
                    found[numbers[n]] = ids
        return found


@lru_cache(maxsize=1)
def encoder_of(tokenizer: str, end_id: int, by_words: bool) -> Encoder:
    """A worker keeps its encoder, and the pieces that it knows, from task to task."""
    return Encoder(tokenizer, end_id, by_words)


def unit_of(tokenizer: Tokenizer, end_id: int) -> str:
    """The smallest unsigned type, little-endian, that holds all ids."""
    most = max(tokenizer.get_vocab_size() - 1, end_id)
    return np.min_scalar_type(most).newbyteorder("<").str


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and its path there."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(),
        folder,
    )


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    by_words: bool = False,
) -> None:
    """Writes the ids of all documents in ascending order of the key below `folder`, which must
    be new. `tokenizer` is the path of a file of the tokenizers library.

    Rows that agree in key and text are told apart by their place in the input, so that a crowd
    of them is cut like any other range; `docs` should come straight from a stored table, whose
    rows have the same place whenever a task is run again.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(Tokenizer.from_file(tokenizer).to_str())
    key_type = docs.schema[key].dataType

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, name = TaskContext.get().partitionId(), f"ids-{uuid.uuid4().hex}"
        encoder, files, keys, offset, n_docs = None, None, None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = encoder_of(shipped.value, end_id, by_words)
                system, path = filesystem(folder)
                system.create_dir(path)
                files = [system.open_output_stream(f"{path}/{name}.{x}") for x in ("bin", "off")]
                sink = system.open_output_stream(f"{path}/{name}.keys")
                keys = pq.ParquetWriter(sink, pa.schema([batch.schema.field(0)]))
                files[1].write(np.zeros(1, "<u8").tobytes())
            texts = batch.column(1)
            for start, length in byte_runs.slices(texts):
                ids = encoder.encode(texts.slice(start, length).to_pylist())
                ends = offset + np.cumsum(np.fromiter(map(len, ids), "<u8", len(ids)), dtype="<u8")
                offset, n_docs = int(ends[-1]), n_docs + len(ids)
                files[0].write(np.concatenate(ids).tobytes())
                files[1].write(ends.tobytes())
            keys.write_batch(batch.select([0]))
        if encoder is not None:
            keys.close()
            for file in (*files, sink):
                file.close()
            row = (part, name, encoder.unit.str, n_docs, offset)
            names = ("part", "file", "unit", "docs", "ids")
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, kinds)], names
            )

    place = F.monotonically_increasing_id()
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    order = (F.col("_key").asc_nulls_first(), F.xxhash64("_text"))
    (
        rows.withColumn("_place", place)
        .repartitionByRange(*order, "_place")
        .sortWithinPartitions(*order)
        .select("_key", "_text")
        .mapInArrow(write_part, PARTS)
        .write.parquet(f"{folder}/parts")
    )
    # An empty table that says of which type the keys are, should there be no document.
    spark.createDataFrame([], f"key {key_type.simpleString()}").write.parquet(f"{folder}/key")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, ids) of every document that `write` left below a folder: where its ids begin
    among those of all, and the ids themselves, 32 bits each, little-endian. Files on a local or
    mounted file system are memory-mapped; of others only what is asked for is read."""
    key = spark.read.parquet(f"{folder}/key").schema["key"]
    parts = sorted(spark.read.schema(PARTS).parquet(f"{folder}/parts").collect())
    before = np.concatenate([[0], np.cumsum([part["ids"] for part in parts], dtype=np.int64)])
    shape = f"key {key.dataType.simpleString()}, start long, ids binary"
    listed = spark.createDataFrame(
        [(*part, int(base)) for part, base in zip(parts, before)], f"{PARTS}, base long"
    )

    def read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                yield from documents(folder, part)

    tasks = max(1, min(len(parts), READ_TASKS))
    return listed.repartitionByRange(tasks, "part").mapInArrow(read_part, shape)


def documents(folder: str, part: dict) -> Iterator[pa.RecordBatch]:
    """The documents of one file, some READ_IDS ids at a time."""
    system, path = filesystem(folder)
    path, unit = f"{path}/{part['file']}", np.dtype(part["unit"])
    local = isinstance(system, fs.LocalFileSystem)
    opened = pa.memory_map if local else system.open_input_file
    keys = pq.ParquetFile(system.open_input_file(f"{path}.keys")).read().column(0)
    with opened(f"{path}.bin") as ids, opened(f"{path}.off") as stored:
        offsets = np.frombuffer(stored.read(), "<u8").astype(np.int64)
        first = 0
        while first < part["docs"]:
            last = int(np.searchsorted(offsets, offsets[first] + READ_IDS, "right")) - 1
            last = min(max(last, first + 1), part["docs"])
            low, high = int(offsets[first]), int(offsets[last])
            raw = ids.read_at((high - low) * unit.itemsize, low * unit.itemsize)
            wide = np.frombuffer(raw, unit).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(first, last - first).combine_chunks(),
                    pa.array(part["base"] + offsets[first:last], pa.int64()),
                    pa.array(
                        [
                            wide[a:b].tobytes()
                            for a, b in zip(offsets[first:last] - low, offsets[first + 1 : last + 1] - low)
                        ],
                        pa.binary(),
                    ),
                ],
                ["key", "start", "ids"],
            )
            first = last
