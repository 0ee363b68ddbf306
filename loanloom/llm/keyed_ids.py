"""Token ids in binary shards with a minimal perfect hash index.

A store is a folder with three files per shard, all little-endian:

- ``*.ids``: the ids of the shard's documents in ascending key order, unsigned,
  of 16 bits if the tokenizer has at most 65,536 ids and else of 32, nothing
  between them;
- ``*.keys``: the keys in the same order, signed 64-bit;
- ``*.mph``: the index. Header of eight unsigned 64-bit numbers (magic, seed,
  documents, levels, words of bits, null keys, bytes of an id, 0), the bits of
  each level,
  the words of all levels, the set bits before each word (unsigned 32-bit), and
  per slot a fingerprint (unsigned 32-bit), the id offset and the number of ids
  (unsigned 64-bit).

The hash function has levels of bit arrays: a key that falls alone on a bit of a
level stays there, the others go on to the next, smaller level. The rank of its
bit is the key's slot, so n keys have slots 0 to n - 1. A lookup reads at most
one bit per level, on average fewer than two, whatever n is; the fingerprint
refuses keys that were never stored. A manifest, a Parquet table, names the
files of the shards and their key ranges; files of lost attempts are not in it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm.arrays import mix, released
from loanloom.llm.scratch import shuffles_freed
from loanloom.llm.tokens import piece_encoder

MAGIC = 0x3144494D5048
GAMMA = 2.0
MAX_LEVELS = 48
GROUP = 512
READ_IDS = 1 << 20
#: The key under which a document without an id is stored; ``null keys`` of the
#: header tells how many of the first documents are meant.
NULL_KEY = -(1 << 63)

MANIFEST = (
    "shard int, file string, n_docs long, n_ids long, n_null long, first_key long, last_key long"
)


def hashed(keys: np.ndarray, ordinals: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes; without repeated keys no two are equal, as every step is
    a bijection."""
    h = mix(keys.view(np.uint64) + np.uint64(seed * 2 + 1))
    again = ordinals > 0
    if again.any():
        h[again] = mix(h[again] + ordinals[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h


def ordinals(keys: np.ndarray) -> np.ndarray:
    """0 for the first of equal neighbours, 1 for the second, and so on."""
    at = np.arange(len(keys))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _bit(h: np.ndarray, level: int, size: int) -> np.ndarray:
    x = mix(h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return (x >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)


@dataclass
class PerfectHash:
    """Slots of a fixed set of 64-bit hashes."""

    sizes: list[int]
    words: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash | None:
        """None if the levels end before all hashes have a place (equal hashes);
        then another seed is taken."""
        sizes, parts, left = [], [], hashes
        for level in range(MAX_LEVELS):
            if not len(left):
                break
            size = max(64, int(len(left) * GAMMA) + 63 & ~63)
            at = _bit(left, level, size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            sizes.append(size)
            parts.append(bits)
            left = left[~alone[at]]
        if len(left):
            return None
        words = np.concatenate(parts) if parts else np.zeros(0, "<u8")
        counts = np.bitwise_count(words).astype(np.uint32)
        return cls(sizes, words, np.cumsum(counts, dtype=np.uint32) - counts)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1 if it cannot be one of the set."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        first = 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = _bit(hashes[open_], level, size).astype(np.int64) + first
            word, shift = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> shift & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << shift) - np.uint64(1))
            out[open_[here]] = (self.ranks[at >> 6] + np.bitwise_count(below))[here]
            open_ = open_[~here]
            first += size
        return out


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def index_bytes(
    keys: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, n_null: int, width: int = 4
) -> bytes:
    """The ``.mph`` file of a shard; keys ascend."""
    order = ordinals(keys)
    seed = 0
    while True:
        h = hashed(keys, order, seed)
        found = PerfectHash.build(h)
        if found is not None:
            break
        seed += 1
    slot = found.slots(h)
    prints, at, n = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u8"), np.zeros(len(keys), "<u8")
    prints[slot], at[slot], n[slot] = fingerprint(h), offsets, lengths
    header = np.asarray(
        [MAGIC, seed, len(keys), len(found.sizes), len(found.words), n_null, width, 0], "<u8"
    )
    parts = [header, np.asarray(found.sizes, "<u8"), found.words, found.ranks.astype("<u4"), prints, at, n]
    return b"".join(p.tobytes() for p in parts)


class Index:
    """A read ``.mph`` file."""

    def __init__(self, data: bytes) -> None:
        head = np.frombuffer(data, "<u8", 8).tolist()
        magic, self.seed, n, levels, words, self.n_null, self.width, _ = head
        if magic != MAGIC:
            raise ValueError("not an index file")
        at = 64

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, kind, count, at)
            at += part.nbytes
            return part

        sizes = take("<u8", levels).tolist()
        self._hash = PerfectHash(sizes, take("<u8", words), take("<u4", words))
        self._prints, self._at, self._n = take("<u4", n), take("<u8", n), take("<u8", n)

    def find(self, keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and number of ids of each (key, ordinal); offset -1: absent."""
        h = hashed(keys, order, self.seed)
        slot = self._hash.slots(h)
        ok = slot >= 0
        ok[ok] = self._prints[slot[ok]] == fingerprint(h[ok])
        at, n = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        at[ok], n[ok] = self._at[slot[ok]], self._n[slot[ok]]
        return at, n


def ids_of(data: bytes, width: int) -> bytes:
    """Stored ids of ``width`` bytes as unsigned 32-bit ones."""
    return data if width == 4 else np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as the session resolves it; tasks, which
    open it themselves, would take one without a scheme for a local folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    local = uri.removeprefix("file:")
    if local != uri:
        return arrow_fs.LocalFileSystem(), "/" + local.lstrip("/")
    return arrow_fs.FileSystem.from_uri(uri)


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    end_id: int,
    shards: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encodes and writes all texts; returns the manifest, read from the store.

    Rows are dealt to shards by ranges of (id, hash of the text) and written in
    ascending order by one streaming pass per shard, so that an id (or null) that
    owns a large share of the rows spans shards; a shard holds keys and offsets in
    memory, 24 bytes a document. A null text is ``end_id`` alone. Null ids come
    first, under ``NULL_KEY``; rows with equal ids are kept each, in the order of
    the hashes of their texts. An empty table gives no shard.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        docs[id_column].cast("long").alias("id"), docs[text_column].alias("text")
    )
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder = piece_encoder(tokenizer_file, keeps_space=False)
        largest = max(end_id + 1, encoder.tokenizer.get_vocab_size())
        width = 2 if largest <= 1 << 16 else 4
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        files, path = open_folder(folder)
        keys: list[np.ndarray] = []
        lengths: list[int] = []
        n_null, out = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files.create_dir(path, recursive=True)
                out = files.open_output_stream(f"{path}/{name}.ids")
            n_null += batch.column(0).null_count
            keys.append(pc.fill_null(batch.column(0), NULL_KEY).to_numpy(zero_copy_only=False))
            texts = pc.fill_null(batch.column(1), "")
            for at in range(0, len(texts), GROUP):
                for ids in encoder.encode(texts.slice(at, GROUP).to_pylist()):
                    stored = np.frombuffer(ids + end, "<u4").astype(f"<u{width}")
                    out.write(stored.tobytes())
                    lengths.append(len(stored))
        if out is None:
            return
        out.close()
        all_keys, n = np.concatenate(keys).astype("<i8"), np.asarray(lengths, np.int64)
        offsets = np.cumsum(n) - n
        for suffix, data in (
            ("keys", all_keys.tobytes()),
            ("mph", index_bytes(all_keys, offsets, n, n_null, width)),
        ):
            with files.open_output_stream(f"{path}/{name}.{suffix}") as stream:
                stream.write(data)
        row = [shard, name, len(n), int(n.sum()), n_null, int(all_keys[0]), int(all_keys[-1])]
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
            [f.split()[0] for f in MANIFEST.split(", ")],
        )

    with shuffles_freed(spark):
        dealt.mapInArrow(released(run), MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest, one partition per shard, with the ids before each shard.
    There is one row per shard, so the driver can add them up."""
    rows = sorted(read_manifest(spark, folder).collect(), key=lambda r: r.shard)
    before, out = 0, []
    for r in rows:
        out.append((r.shard, r.file, before))
        before += r.n_ids
    df = spark.createDataFrame(out, "shard int, file string, before long")
    return df.repartition(max(1, len(out)), "shard")


def read_ids(
    spark: SparkSession, folder: str, id_column: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """One row per stored document, read through the index: id, start (ids of
    all documents before it), n_tokens, ids_crc32 and, with ``with_ids``, ids.
    """
    folder = qualified(spark, folder)
    schema = "id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                files, path = open_folder(folder)
                stem = f"{path}/{shard['file']}"
                with files.open_input_file(f"{stem}.mph") as stream:
                    index = Index(stream.read())
                with files.open_input_file(f"{stem}.keys") as stream:
                    keys = np.frombuffer(stream.read(), "<i8")
                at, n = index.find(keys, ordinals(keys))
                if (at < 0).any():
                    raise ValueError(f"{stem}: the index misses stored keys")
                null = np.arange(len(keys)) < index.n_null
                with files.open_input_file(f"{stem}.ids") as payload:
                    first = 0
                    while first < len(keys):
                        ids = np.cumsum(n[first : first + 4096])
                        last = first + max(1, int(np.searchsorted(ids, READ_IDS, "right")))
                        stored = int(at[last - 1] + n[last - 1] - at[first])
                        data = payload.read_at(index.width * stored, index.width * int(at[first]))
                        data = ids_of(data, index.width)
                        cut = 4 * (at[first:last] - at[first])
                        parts = [data[a : a + 4 * k] for a, k in zip(cut.tolist(), n[first:last].tolist(), strict=True)]
                        columns = [
                            pa.array(keys[first:last], mask=null[first:last]),
                            pa.array(at[first:last] + shard["before"]),
                            pa.array(n[first:last]),
                            pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        ]
                        if with_ids:
                            columns.append(pa.array(parts, pa.binary()))
                        yield pa.RecordBatch.from_arrays(columns, names)
                        first = last

    return _shards(spark, folder).mapInArrow(run, schema).withColumnRenamed("id", id_column)


def lookup_ids(keys: DataFrame, folder: str, id_column: str = "doc_id") -> DataFrame:
    """Keyed access: the ids stored under each key (the first of equal ones);
    null where the key is absent. Keys meet the shard whose range holds them;
    each key costs one index probe and one read of its ids."""
    spark = keys.sparkSession
    folder = qualified(spark, folder)
    shards = sorted(read_manifest(spark, folder).collect(), key=lambda r: r.shard)
    last = np.asarray([r.last_key for r in shards], np.int64)
    file = [r.file for r in shards]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        held: dict[int, Index] = {}
        for batch in batches:
            column = batch.column(0)
            wanted = pc.fill_null(column, NULL_KEY).to_numpy(zero_copy_only=False)
            shard = np.searchsorted(last, wanted, "left")
            out: list[bytes | None] = [None] * len(wanted)
            for s in np.unique(shard[shard < len(file)]):
                here = np.flatnonzero(shard == s)
                if s not in held:
                    held.clear()
                    with files.open_input_file(f"{path}/{file[s]}.mph") as stream:
                        held[s] = Index(stream.read())
                at, n = held[s].find(wanted[here], np.zeros(len(here), np.int64))
                with files.open_input_file(f"{path}/{file[s]}.ids") as payload:
                    for k, a, count in zip(here.tolist(), at.tolist(), n.tolist(), strict=True):
                        if a >= 0 and column[k].is_valid:
                            width = held[s].width
                            out[k] = ids_of(payload.read_at(width * count, width * a), width)
            yield pa.RecordBatch.from_arrays([column, pa.array(out, pa.binary())], ["id", "ids"])

    rows = keys.select(keys[id_column].cast("long").alias("id"))
    dealt = rows.repartitionByRange(max(1, len(file)), "id").sortWithinPartitions("id")
    return dealt.mapInArrow(run, "id long, ids binary").withColumnRenamed("id", id_column)
