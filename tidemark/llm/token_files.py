"""Token ids as Arrow IPC files of equal-length sequences.

Documents are range-sorted by key, tokenized, ended with an end id and
packed one after the other into sequences of a fixed length.  A task
writes its key range as one file of record batches whose columns are
fixed-size lists (``ids``, unsigned 16 or 32 bits; ``mask``, true where a
position holds a token), plus a small index file of its documents.  The
buffers of a mapped file are the sequences themselves, so any sequence of
any batch is read without copying or decoding.

Scale: one range shuffle of the texts; a file per task; positions across
files come from one row per file.  A file name is used by one task attempt
only and the manifest holds the files of the attempts that succeeded, so
lost executors and retries leave nothing half-written in the result.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, SegmentTable, shuffle_partitions, split_distinct, text_slices

SEQUENCE_LENGTH = 2048
#: Sequences of a record batch.
BATCH_SEQUENCES = 64
#: A mark that stands between words that go through the library together.
SEPARATOR = "|"
MANIFEST = "part long, path string, index_path string, n_tokens long, n_docs long"
INDEX = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class WordTokenizer:
    """A tokenizer of the ``tokenizers`` library whose tokens never span
    white space: texts are cut at spaces and line feeds and every distinct
    chunk goes through the library once a worker."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_str(definition)
        self.vocabulary_size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._marks = {".": 0, ",": 1}
        self._mark_ids = np.array([self._single(m) for m in self._marks], np.int32)
        self._separator = self._single(SEPARATOR)
        #: tokens that match a text as it stands, in their case only
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()
                       if not t.normalized]
        self._stems = SegmentTable(self._encode_words, 252 << 20)
        self._table = SegmentTable(self._encode_chunks, 140 << 20)
        self._ends_words: dict[str, bool] = {}

    def _single(self, text: str) -> int:
        found, = self._tokenizer.encode(text, add_special_tokens=False).ids
        return found

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of words, many to a call of the library, told
        apart by the id of a separator that none of them holds."""
        alone = [w for w in words if SEPARATOR in w]
        joined = [w for w in words if SEPARATOR not in w] if alone else words
        found = {w: e.ids for w, e in zip(alone, self._tokenizer.encode_batch_fast(
            alone, add_special_tokens=False))}
        lens, ids = [], []
        for at in range(0, len(joined), 500):
            some = joined[at:at + 500]
            got = np.array(self._tokenizer.encode_batch_fast(
                [f" {SEPARATOR} ".join(some)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.append(np.flatnonzero(got == self._separator), len(got))
            lens.append(np.diff(ends, prepend=-1) - 1)
            ids.append(got[got != self._separator])
            assert len(lens[-1]) == len(some)
        lens, ids = (np.concatenate([*x, np.zeros(0, np.int32)]).astype(np.int64)
                     for x in (lens, ids))
        if not alone:
            return lens, ids
        parts = iter(np.split(ids, np.cumsum(lens)[:-1]) if len(lens) else ())
        parts = [np.array(found[w], np.int64) if w in found else next(parts) for w in words]
        return np.array([len(x) for x in parts], np.int64), np.concatenate(parts)

    def _ends_word(self, letter: str) -> bool:
        """Whether a mark behind this letter is a token of its own, as the
        library has it: not behind one whose normal form ends in a
        combining mark, which joins the mark that follows."""
        known = self._ends_words.get(letter)
        if known is None:
            ids = [self._tokenizer.encode(letter + m, add_special_tokens=False).ids for m in ("", *self._marks)]
            known = self._ends_words[letter] = all(
                found == [*ids[0], mark] for found, mark in zip(ids[1:], self._mark_ids.tolist()))
        return known

    def _lower(self, chunk: str) -> str:
        """The chunk in lower case, unless that would make an added token."""
        low = chunk.lower()
        return chunk if low != chunk and any(t in low for t in self._added) else low

    def _encode_chunks(self, chunks):
        # an ASCII letter's case, and one mark at the end of a word, change
        # no other token: chunks alike but for these share one encoding
        stems, marks = [], []
        for c in chunks:
            mark = -1
            if len(c) > 1 and c[-1] in ".," and c[-2].isalpha() and self._ends_word(c[-2]):
                mark, c = self._marks[c[-1]], c[:-1]
            stems.append(self._lower(c) if c.isascii() else c)
            marks.append(mark)
        place = self._stems.indices(stems)
        self._stems.flush()
        ids, ends = self._stems.gather(place)
        self._stems.trim(place)
        marks = np.array(marks)
        marked = marks >= 0
        lens = np.diff(ends, prepend=0) + marked
        # the marks' ids go behind those of their words
        return lens, np.insert(ids, ends[marked], self._mark_ids[marks[marked]])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Id arrays of texts (no nulls)."""
        chunks, place, cuts = split_distinct(pa.compute.replace_substring(texts, "\n", " "))
        return self._table.encode(self._table.indices(chunks)[place], cuts)


_TOKENIZERS: dict[int, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    key = hash(definition)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordTokenizer(definition)
    return _TOKENIZERS[key]


def _schema(dtype: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", dtype, nullable=False), length)),
                      ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length))])


class SequenceWriter:
    """Packs id arrays into fixed-length sequences of an Arrow IPC file."""

    def __init__(self, sink, dtype: np.dtype, length: int, batch: int = BATCH_SEQUENCES):
        self._dtype, self._length, self._cells = dtype, length, length * batch
        self._schema = _schema(pa.from_numpy_dtype(dtype), length)
        self._writer = pa.ipc.new_file(sink, self._schema)
        self._held, self._n = [], 0
        self.n_tokens = 0

    def _emit(self, ids: np.ndarray) -> None:
        pad = -len(ids) % self._length
        mask = np.ones(len(ids) + pad, bool)
        if pad:
            mask[len(ids):] = False
            ids = np.concatenate([ids, np.zeros(pad, self._dtype)])
        cols = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type)
                for x, f in zip((ids, mask), self._schema)]
        self._writer.write_batch(pa.RecordBatch.from_arrays(cols, schema=self._schema))

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids.astype(self._dtype))
        self._n += len(ids)
        self.n_tokens += len(ids)
        if self._n >= self._cells:
            held = np.concatenate(self._held)
            full = len(held) - len(held) % self._cells
            for at in range(0, full, self._cells):
                self._emit(held[at:at + self._cells])
            self._held, self._n = [held[full:]], len(held) - full

    def close(self) -> None:
        if self._n:
            self._emit(np.concatenate(self._held))
        self._writer.close()


def _open_input(path: str):
    fs, at = pa.fs.FileSystem.from_uri(path)
    return pa.memory_map(at) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(at)


class SequenceReader:
    """Random access to the sequences of one file; views, no copies."""

    def __init__(self, path: str):
        self._file = pa.ipc.open_file(_open_input(path))
        self.length = self._file.schema.field("ids").type.list_size
        self._at, self._batch = None, None

    def _load(self, batch: int) -> pa.RecordBatch:
        if self._at != batch:
            self._at, self._batch = batch, self._file.get_batch(batch)
        return self._batch

    def sequence(self, i: int, batch: int = BATCH_SEQUENCES) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of sequence ``i``."""
        b = self._load(i // batch)
        at = i % batch * self.length
        ids = b.column(0).values.to_numpy(zero_copy_only=True)[at:at + self.length]
        return ids, b.column(1).values.slice(at, self.length)

    def span(self, start: int, n: int, batch: int = BATCH_SEQUENCES):
        """Views of the ``n`` ids from position ``start``, batch by batch."""
        cells = self.length * batch
        while n > 0:
            ids = self._load(start // cells).column(0).values.to_numpy(zero_copy_only=True)
            part = ids[start % cells:start % cells + n]
            yield part
            start, n = start + len(part), n - len(part)


def write_token_files(docs: DataFrame, definition: str, folder: str, *, end_id: int,
                      key: str = "doc_id", text: str = "text",
                      length: int = SEQUENCE_LENGTH, files: int | None = None) -> DataFrame:
    """Tokenize ``docs`` into ``folder`` (a URI all executors share) in
    ascending ``key`` order, null keys first; returns the manifest, a row
    per file.  ``definition``: JSON of a tokenizer whose tokens never span
    white space.

    A null text is empty: its document is the end id alone.  Rows that
    share a key follow each other by text.  No rows write no file.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)
    n = files or shuffle_partitions(spark)
    ordered = (docs.select(F.col(f"`{key}`").cast("bigint").alias("key"),
                           F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
               .repartitionByRange(n, "key").sortWithinPartitions("key", "text"))

    def write(batches):
        tokenizer, out = None, None
        part = TaskContext.get().partitionId()
        for rows in text_slices(batches, "text"):
            if out is None:
                tokenizer = _tokenizer(shared.value)
                dtype = np.dtype("<u2" if tokenizer.vocabulary_size <= 1 << 16 else "<u4")
                fs, at = pa.fs.FileSystem.from_uri(folder)
                fs.create_dir(at, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                sink, index_sink = (fs.open_output_stream(f"{at}/{name}.{x}")
                                    for x in ("arrow", "docs.arrow"))
                out = SequenceWriter(sink, dtype, length)
                index, n_docs = pa.ipc.new_file(index_sink, INDEX), 0
            starts, lens = [], []
            for ids in tokenizer.encode(rows.column(1)):
                starts.append(out.n_tokens)
                out.add(np.append(ids, end_id))
                lens.append(len(ids) + 1)
            index.write_batch(pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(starts, pa.int64()), pa.array(lens, pa.int64())],
                schema=INDEX))
            n_docs += rows.num_rows
        if out is not None:
            for x in (out, index, sink, index_sink):
                x.close()
            yield pa.RecordBatch.from_pylist([{
                "part": part, "path": f"{folder}/{name}.arrow",
                "index_path": f"{folder}/{name}.docs.arrow",
                "n_tokens": out.n_tokens, "n_docs": n_docs}],
                schema=pa.schema([("part", pa.int64()), ("path", pa.string()),
                                  ("index_path", pa.string()), ("n_tokens", pa.int64()),
                                  ("n_docs", pa.int64())]))

    return Scratch(spark, "token-manifest").keep(ordered.mapInArrow(write, MANIFEST), "files")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, read back from the files of a manifest:
    ``key``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers)."""
    spark = manifest.sparkSession
    files = (manifest.withColumn("before", F.sum("n_tokens").over(W.orderBy("part"))
                                 - F.col("n_tokens"))  # a row per file
             .repartitionByRange(shuffle_partitions(spark), "part")
             .select("path", "index_path", "before"))

    def read(batches):
        for batch in batches:
            for f in batch.to_pylist():
                data = SequenceReader(f["path"])
                docs = pa.ipc.open_file(_open_input(f["index_path"]))
                for i in range(docs.num_record_batches):
                    b = docs.get_batch(i)
                    crcs = []
                    for start, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                        crc = 0
                        for ids in data.span(start, n):
                            crc = zlib.crc32(ids.astype("<u4"), crc)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0), pa.compute.add(b.column(1), f["before"]), b.column(2),
                         pa.array(crcs, pa.int64())], ["key", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long")
