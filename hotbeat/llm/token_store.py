"""Token ids as raw binary shards with a minimal perfect hash index.

File format of a store (a folder in shared storage):

* ``ids-*.bin``: one file a shard, nothing but little-endian unsigned 16-bit ids, documents one
  after the other in ascending key order (null keys first, repeated keys one after the other);
* ``shards``: Parquet table (shard, file, start): the valid files in order and the ids before each;
* ``index``: Parquet table, one row a hash bucket: a minimal perfect hash over the keys of the
  bucket (bit levels; a key's slot is the rank of its bit) and, by slot, a 32-bit fingerprint,
  shard, offset in the shard and length.

A key is found in constant time: hash, bucket, at most a few bit tests, one slot, fingerprint
check, one seek.  A key that is not in the store fails the fingerprint check (but for 1 in 2^32).
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hotbeat.llm.chunk_bpe import encoder
from hotbeat.llm.common import file_system
from hotbeat.session import broadcast_if_small, scratch_path

#: Keys of a bucket on average: bounds what one task holds and what one lookup reads.
KEYS_PER_BUCKET = 4096
#: Levels of the perfect hash; keys that still collide (equal 64-bit hashes) are listed.
LEVELS = 24
WIDTH = 2


@dataclass
class TokenStore:
    spark: SparkSession
    path: str
    buckets: int

    @property
    def shards(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/shards")

    @property
    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/index")


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    x = h.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_perfect_hash(hashes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, all bits, slot of each hash) of a minimal perfect hash.

    At each level the hashes that fall on a bit of their own keep it; the others go to the next.
    Hashes without a bit in the end (equal ones) get the slots behind.
    """
    left = np.arange(len(hashes))
    sizes, bits, placed, base = [], [], [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = 2 * len(left)
        at = (_mix(hashes[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        own = alone[at]
        placed.append((left[own], base + at[own]))
        left, base = left[~own], base + size
    all_bits = np.concatenate(bits) if bits else np.zeros(0, bool)
    rank = np.cumsum(all_bits) - 1
    slots = np.empty(len(hashes), np.int64)
    for who, where in placed:
        slots[who] = rank[where]
    slots[left] = int(all_bits.sum()) + np.arange(len(left))
    return sizes, all_bits, slots


def find_slots(sizes, all_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Slot of each hash by the levels, -1 where no level has it."""
    rank = np.cumsum(all_bits) - 1
    slots, open_, base = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
    for level, size in enumerate(sizes):
        where = base + (_mix(hashes[open_], level) % np.uint64(size)).astype(np.int64)
        hit = all_bits[where]
        slots[open_[hit]] = rank[where[hit]]
        open_, base = open_[~hit], base + size
    return slots


def _keyed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Adds the 64-bit hash, the fingerprint and the bucket of (key, occurrence)."""
    return (df.withColumn("h", F.xxhash64(F.col(key).cast("string"), F.col(key).isNull(), F.col("occ")))
            .withColumn("fp", F.hash(F.lit(11), F.col("occ"), F.col(key).isNull(), F.col(key).cast("string")))
            .withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)).cast("int")))


def write_store(docs: DataFrame, tokenizer_path: str, kind: str, end_id: int, key: str = "doc_id",
                text: str = "text", path: str | None = None) -> TokenStore:
    """Encode every document into a store.

    Null text is an empty text (only the end id).  Repeated keys are kept; the n-th document of a key
    in file order is found under (key, n).  Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-store")

    def write_shard(batches):
        shard = TaskContext.get().partitionId()
        # a name of its own for each attempt: the index lists the files of the attempts that counted
        name = f"ids-{shard:06d}-{uuid.uuid4().hex}.bin"
        enc, tail = encoder(tokenizer_path, kind), np.array([end_id], "<u2").tobytes()
        fs, folder = file_system(path)
        out, offset, row = None, 0, 0
        try:
            for batch in batches:
                if out is None:
                    fs.create_dir(folder, recursive=True)
                    out = fs.open_output_stream(f"{folder}/{name}")
                lengths = []
                for t in batch.column("t").to_pylist():
                    ids = enc.encode(t)
                    out.write(ids.tobytes())
                    out.write(tail)
                    lengths.append(len(ids) + 1)
                n = np.array(lengths, np.int64)
                ends = offset + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k"), pa.array([shard] * len(n), pa.int32()), pa.array([name] * len(n)),
                     pa.array(np.arange(row, row + len(n))), pa.array(ends - n), pa.array(n)],
                    names=["k", "shard", "file", "row", "offset", "n"])
                offset, row = int(ends[-1]) if len(n) else offset, row + len(n)
        finally:
            if out is not None:
                out.close()

    kind_of_key = docs.schema[key].dataType.simpleString()
    (docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
     .withColumn("i", F.monotonically_increasing_id())  # splits a repeated key over shards
     .repartitionByRange("k", "i").sortWithinPartitions("k", "i")
     .mapInArrow(write_shard, f"k {kind_of_key}, shard int, file string, row long, offset long, n long")
     .write.parquet(f"{path}/entries"))
    entries = spark.read.parquet(f"{path}/entries")

    # one row a shard: as few as there were tasks
    totals = entries.groupBy("shard").agg(F.max("file").alias("file"), F.sum("n").alias("ids"), F.count("*").alias("rows"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (totals.select("shard", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"),
                   F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_row"))
     .write.parquet(f"{path}/shards"))
    shards, n_shards = broadcast_if_small(spark.read.parquet(f"{path}/shards"), 100_000)
    placed = entries.join(shards.select("shard", "first_row"), "shard").withColumn("nth", F.col("first_row") + F.col("row"))
    first = placed.groupBy("k").agg(F.min("nth").alias("first"))
    placed = placed.join(first.withColumnRenamed("k", "k2"), F.col("k").eqNullSafe(F.col("k2"))).withColumn("occ", F.col("nth") - F.col("first"))
    buckets = max(1, -(-entries.count() // KEYS_PER_BUCKET))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "fp", "shard", "offset"], ignore_index=True)
        h = pdf["h"].to_numpy()
        sizes, bits, slots = build_perfect_hash(h)
        order = np.argsort(slots)
        col = lambda c, t: pdf[c].to_numpy()[order].astype(t).tobytes()
        return pd.DataFrame([{"bucket": int(pdf["bucket"].iloc[0]), "sizes": sizes, "bits": np.packbits(bits).tobytes(),
                              "n_bits": len(bits), "hashes_behind": h[order][int(bits.sum()):].tobytes(), "fps": col("fp", "<i4"),
                              "shards": col("shard", "<i4"), "offsets": col("offset", "<i8"), "lengths": col("n", "<i8")}])

    (_keyed(placed, "k", buckets).select("bucket", "h", "fp", "shard", "offset", "n").groupBy("bucket")
     .applyInPandas(build, "bucket int, sizes array<int>, bits binary, n_bits int, hashes_behind binary, fps binary,"
                           " shards binary, offsets binary, lengths binary").write.parquet(f"{path}/index"))
    return TokenStore(spark, path, buckets)


def locate(store: TokenStore, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where each document of the given keys lies: key, occ, shard, offset, n (absent keys: no row)."""
    asked = (keys.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("c"))
             .select("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("occ")))
    kind = asked.schema["k"].dataType.simpleString()

    def look_up(_, want: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out = want[["k", "occ"]].copy()
        if not len(have) or not len(want):
            return out.iloc[:0].assign(shard=0, offset=0, n=0)
        x = have.iloc[0]
        bits = np.unpackbits(np.frombuffer(x["bits"], np.uint8))[: x["n_bits"]].astype(bool)
        h, fp = want["h"].to_numpy(), want["fp"].to_numpy()
        fps = np.frombuffer(x["fps"], "<i4")
        slots = find_slots(x["sizes"], bits, h)
        behind, first = np.frombuffer(x["hashes_behind"], np.int64), int(bits.sum())
        for k in np.flatnonzero(np.isin(h, behind)) if len(behind) else []:
            same = first + np.flatnonzero((behind == h[k]) & (fps[first:] == fp[k]))
            slots[k] = same[0] if len(same) else -1
        ok = (slots >= 0) & (fps[np.maximum(slots, 0)] == fp)
        s = slots[ok]
        return out[ok].assign(shard=np.frombuffer(x["shards"], "<i4")[s], offset=np.frombuffer(x["offsets"], "<i8")[s],
                              n=np.frombuffer(x["lengths"], "<i8")[s])

    return (_keyed(asked, "k", store.buckets).groupBy("bucket").cogroup(store.index.groupBy("bucket"))
            .applyInPandas(look_up, f"k {kind}, occ long, shard int, offset long, n long").withColumnRenamed("k", key))


def read_ids(store: TokenStore, located: DataFrame, key: str = "doc_id") -> DataFrame:
    """Seek each located document in its shard: key, occ, start, n_tokens, ids (binary, 16-bit)."""
    return _read(store, located, key, "ids binary", lambda raw: raw)


def _read(store: TokenStore, located: DataFrame, key: str, field: str, digest) -> DataFrame:
    shards, n = broadcast_if_small(store.shards.select("shard", "file", "start"), 100_000)
    kind, path, name = located.schema[key].dataType.simpleString(), store.path, field.split()[0]
    out_type = pa.binary() if field.endswith("binary") else pa.int64()

    def read(batches):
        fs, folder = file_system(path)
        opened, f = None, None
        for b in batches:
            got = []
            for file, offset, length in zip(b.column("file").to_pylist(), b.column("offset").to_pylist(), b.column("n").to_pylist()):
                if file != opened:
                    if f is not None:
                        f.close()
                    opened, f = file, fs.open_input_file(f"{folder}/{file}")
                f.seek(offset * WIDTH)
                got.append(digest(f.read(length * WIDTH)))
            start = np.array(b.column("start")) + np.array(b.column("offset"))
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("occ"), pa.array(start.astype(np.int64)), b.column("n"), pa.array(got, out_type)],
                                             names=[key, "occ", "start", "n_tokens", name])
        if f is not None:
            f.close()

    return (located.join(shards, "shard").repartition(max(1, n), "shard").sortWithinPartitions("shard", "offset")
            .select(key, "occ", "file", "start", "offset", "n")
            .mapInArrow(read, f"{key} {kind}, occ long, start long, n_tokens long, {field}"))


def read_digests(store: TokenStore, located: DataFrame, key: str = "doc_id") -> DataFrame:
    """As ``read_ids``, with ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    return _read(store, located, key, "ids_crc32 long", lambda raw: zlib.crc32(np.frombuffer(raw, "<u2").astype("<u4").tobytes()))
