"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir

#: Words of ``documents`` as the mixing contract counts them: runs of
#: characters other than space and the ASCII controls 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Intermediate tables of one call, in the shared checkpoint folder.

    ``keep`` writes a DataFrame as Parquet and reads it back: the lineage
    is cut, every executor sees the files, and a lost executor costs no
    recomputation of what was written.  ``drop`` deletes a table that no
    returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{base}/tidemark-llm/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        sc = self.spark.sparkContext
        for name in names:
            p = sc._jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` holds about ``max_bytes`` each
    (one row at least): bounds a task's memory whatever the text lengths."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(col), 0)
                         .to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            end = int(np.searchsorted(ends, before + max_bytes, side="right"))
            end = min(max(end, at + 1), n)
            yield batch.slice(at, end - at)
            at = end


class Lookup(dict):
    """Word -> value, computed on first use; forgets everything once it
    holds ``limit`` entries, so a worker's memory stays bounded."""

    def __init__(self, compute, limit: int = 200_000):
        super().__init__()
        self._compute, self._limit = compute, limit

    def __missing__(self, word):
        if len(self) >= self._limit:
            self.clear()
        value = self[word] = self._compute(word)
        return value


def map_texts(docs: DataFrame, text: str, carry: list[str], fields: str, make,
              max_bytes: int = 4 << 20) -> DataFrame:
    """``make()`` runs once a task and gives a function from an Arrow array
    of texts (null as empty) to one Arrow array per field of ``fields`` (a DDL
    string).  Returns ``row`` (a struct of the ``carry`` columns, so no
    name can clash) and the fields.  Texts go through in slices of about
    ``max_bytes``; nothing is shuffled."""
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
                         F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([source.schema["row"], *T.StructType.fromDDL(fields).fields])
    names = schema.names

    def run(batches):
        work = None
        for part in text_slices(batches, "_text", max_bytes):
            work = work or make()
            texts = pa.compute.fill_null(part.column(1), "")
            yield pa.RecordBatch.from_arrays([part.column(0), *work(texts)], names)

    return source.mapInArrow(run, schema)


class SegmentTable:
    """Segments of text -> id sequences, encoded once a worker.

    New segments are gathered by ``indices`` and encoded together by
    ``flush``; ``gather`` concatenates the sequences of many segments with
    array operations.  Beyond about ``limit_bytes`` of keys and ids the
    table goes on with the segments of the last slice only, which bounds a
    worker's memory and changes no result.
    """

    #: Bytes of an entry beside its text and ids: objects, dictionary, places.
    ENTRY = 280

    class _Index(dict):
        def __init__(self):
            super().__init__()
            self.pending: list = []

        def __missing__(self, key):
            at = self[key] = len(self)
            self.pending.append(key)
            return at

    def __init__(self, encode_many, limit_bytes: int = 96 << 20):
        #: ``encode_many(keys) -> (lengths, all ids in order)``
        self._encode, self._limit = encode_many, limit_bytes
        self._reset()

    def _reset(self):
        self._index = self._Index()
        self._n = self._n_ids = self._key_bytes = 0
        self._lens = np.zeros(1 << 10, np.int32)
        self._starts = np.zeros(1 << 10, np.int64)
        self._ids = np.zeros(1 << 12, np.int32)

    def indices(self, keys) -> np.ndarray:
        """Places of the keys; new keys wait for ``flush``."""
        return np.fromiter(map(self._index.__getitem__, keys), np.int64)

    @staticmethod
    def _room(held: np.ndarray, n: int) -> np.ndarray:
        """``held`` with room for ``n``, at least twice its size if it grows."""
        if n <= len(held):
            return held
        out = np.zeros(max(n, 2 * len(held)), held.dtype)
        out[:len(held)] = held
        return out

    def _append(self, keys, lens: np.ndarray, ids: np.ndarray) -> None:
        n, n_ids = self._n + len(lens), self._n_ids + len(ids)
        self._lens, self._starts = self._room(self._lens, n), self._room(self._starts, n)
        self._ids = self._room(self._ids, n_ids)
        self._lens[self._n:n] = lens
        self._starts[self._n:n] = self._n_ids + np.cumsum(lens) - lens
        self._ids[self._n_ids:n_ids] = ids
        self._n, self._n_ids = n, n_ids
        self._key_bytes += sum(map(len, keys))

    def flush(self) -> None:
        pending, self._index.pending = self._index.pending, []
        if pending:
            self._append(pending, *self._encode(pending))

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments in order, where each segment ends)."""
        if not len(index):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lens = self._lens[index]
        ends = np.cumsum(lens, dtype=np.int64)
        shift = self._starts[index] - (ends - lens)
        return self._ids[np.arange(ends[-1]) + np.repeat(shift, lens)], ends

    def trim(self, last: np.ndarray) -> None:
        """Beyond the limit, forgets all but the segments at ``last``."""
        if self.ENTRY * self._n + 2 * self._key_bytes + 4 * self._n_ids <= self._limit:
            return
        last = np.unique(last)
        keys = list(self._index)
        keys = [keys[i] for i in last.tolist()]
        lens, (ids, _) = self._lens[last], self.gather(last)
        self._reset()
        for k in keys:
            self._index[k] = len(self._index)
        self._append(keys, lens, ids)
        if self.ENTRY * self._n + 2 * self._key_bytes + 4 * self._n_ids > self._limit // 2:
            self._reset()

    def encode(self, index: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
        """Id arrays of documents; document i has the segments ``index``
        holds from ``cuts[i]`` up to ``cuts[i + 1]``."""
        self.flush()
        ids, ends = self.gather(index)
        at = np.concatenate([[0], ends])[cuts]
        self.trim(index)
        return [ids[a:b] for a, b in zip(at[:-1], at[1:])]


#: White space as ``str.split`` takes it, but for the space.
WHITE_SPACE = (r"[\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
               r"\x{205f}\x{3000}]")


def spaced(texts: pa.Array) -> pa.Array:
    """Texts with a space for every white-space character, one for one, so
    that offsets in characters stay."""
    return pa.compute.replace_substring_regex(texts, WHITE_SPACE, " ")


def split_distinct(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Chunks between single spaces of all texts: (distinct chunks, place
    of each chunk among them, where each text's chunks start and end)."""
    lists = pa.compute.split_pattern(texts, " ")
    found = lists.flatten().dictionary_encode()
    cuts = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())])
    return found.dictionary.to_pylist(), found.indices.to_numpy(), cuts
