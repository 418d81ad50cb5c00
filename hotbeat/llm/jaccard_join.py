"""Near-duplicate classes by an n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of the 64-bit hashes of its 5-word shingles.  Shingles have one order for all:
those in one document first, then rare ones, then the frequent ones by their document count.  Two sets
with Jaccard similarity t or more share at least l shingles of their first s - ceil(t s) + l ones, for
any l.  Each document takes the l that makes its estimated candidates cheapest: a longer prefix, but
as many more matches demanded.  A pair must share the smaller l of the two; then it is verified exactly.

Only classes are wanted, so pairs need not all be looked at.  Within the documents of a prefix shingle
the pairs with a few pivots are verified first and their links contracted.  Pairs that still lie in
different components are then all verified: one by one where few documents share a shingle, and for
shingles that many share in blocks of sets, whose common shingles are counted by one matrix product;
no pair is written there.  Documents with equal sets are one class from the start.

Spark shuffles (1) packed shingle counts, (2) prefix rows, (3) the sets of documents in a candidate
pair.  Two bitmaps and the list of frequent shingles go to all tasks; their sizes are fixed, and what
does not fit in them costs time only: any order of the shingles gives the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.common import written
from hotbeat.llm.components import components

SHINGLE = 5
#: Frequent shingles known to all tasks: at most so many (12 bytes each), each in ``FREQUENT`` documents or more.
MOST_FREQUENT = 1_000_000
FREQUENT = 8
#: Bits of the map of shingles that are in more than one document, and of the map of wanted sets.
BITMAP_BITS = 26
#: Matches a document may demand, and what verifying a candidate costs against reading a row.
MATCHES = 8
VERIFY_COST = 10
PIVOTS = 4
#: Documents of a shingle up to which its remaining pairs are listed; beyond, they meet in blocks.
LISTED = 24
#: Sets of a block on average, and shingles of a matrix product.
BLOCK = 128
WIDTH = 4096
#: Shingles that a task gathers before it ships their counts, and bytes of sets that it returns at once.
FLUSH = 2_000_000
RETURNED = 4_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = " \t\n\x0b\x0c\r"


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles (A-Z lower-cased, words between white space)."""
    words = text.encode("utf-8", "replace").lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h)
    if not n:
        return h
    width = min(SHINGLE, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ (out >> np.uint64(29))) * _MIX + h[k:n - width + 1 + k]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def class_key(s: np.ndarray) -> int:
    """One key for all documents with the same set (64 bits, as a signed long)."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def _signed(x: np.ndarray) -> np.ndarray:
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def prefix_bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits set where a (signed) 64-bit key has that many leading bits; put together by ranges of keys."""
    parts = 12

    def pack(t: pa.Table) -> pa.Table:
        k = t.column("k").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
        part = int(k[0] >> np.uint64(64 - parts))
        low = np.zeros(1 << (bits - parts), np.uint8)
        low[(k >> np.uint64(64 - bits)).astype(np.int64) & ((1 << (bits - parts)) - 1)] = 1
        return pa.table({"part": pa.array([part], pa.int32()), "b": pa.array([np.packbits(low).tobytes()], pa.binary())})

    k = F.col(column).alias("k")
    rows = (keys.select(k).withColumn("part", F.shiftright("k", 64 - parts)).groupBy("part")
            .applyInArrow(pack, "part int, b binary").collect())  # 2^bits / 8 bytes at most
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (bits - parts - 3)
    for r in rows:
        out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["b"], np.uint8)
    return out


def _in_bitmap(bitmap: np.ndarray, keys: np.ndarray, bits: int = BITMAP_BITS) -> np.ndarray:
    at = (keys >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set it links to."""
    return -(-n * percent // 100)


def count_shingles(docs: DataFrame, ranges_bits: int) -> DataFrame:
    """One pass over the texts: rows (kind 0) of the documents and (kind 1) of the frequent shingles,
    (kind 2) maps of the shingles that more than one set has.

    Counts travel as packed 32-bit remainders of the hashes, by range of their leading bits.
    """
    fields = "kind int, part int, doc_id long, n long, key long, b binary"
    names = ["kind", "part", "doc_id", "n", "key", "b"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    shift = np.uint64(32 - ranges_bits)
    map_bits = BITMAP_BITS - ranges_bits

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def packed(k):
        """Rows of a buffer of shingles, which is sorted in place: for each range its 32-bit remainders."""
        k.sort()
        k >>= shift
        bounds = np.searchsorted(k, np.arange((1 << ranges_bits) + 1, dtype=np.uint64) << np.uint64(32))
        parts = np.flatnonzero(bounds[1:] > bounds[:-1])
        rest = k.astype(np.uint32)
        m = len(parts)
        return batch_of([[1] * m, parts.tolist(), [None] * m, [None] * m, [None] * m,
                         [rest[a:b].tobytes() for a, b in zip(bounds[parts].tolist(), bounds[parts + 1].tolist())]])

    def first(batches):
        seen, buffer, size = set(), np.empty(FLUSH, np.uint64), 0
        for b in batches:
            ids, ns, keys = b.column("doc_id").to_pylist(), [], []
            for t in b.column("t"):  # one text at a time, as a batch may hold 10,000
                s = shingles(t.as_py())
                key = class_key(s)
                ns.append(len(s))
                keys.append(key)
                if key not in seen and len(s):
                    seen.add(key)
                    if size + len(s) > FLUSH and size:
                        yield packed(buffer[:size])
                        size = 0
                    if len(s) > FLUSH:
                        yield packed(s)
                        continue
                    buffer[size:size + len(s)] = s
                    size += len(s)
            m = len(ids)
            # spread by key over the ranges: they pass through
            yield batch_of([[0] * m, [k & ((1 << ranges_bits) - 1) for k in keys], ids, ns, keys, [None] * m])
        if size:
            yield packed(buffer[:size])
        del buffer
        pa.default_memory_pool().release_unused()

    def reduced(part, blobs):
        rest, counts = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in blobs]), return_counts=True)
        often = counts >= FREQUENT
        some = np.zeros(1 << map_bits, np.uint8)
        some[rest[counts > 1] >> np.uint32(32 - map_bits)] = 1
        m = int(often.sum())
        keys = (np.int64(part) << 32) | rest[often].astype(np.int64)
        return batch_of([[2] + [1] * m, [part] * (m + 1), [None] * (m + 1), [0] + counts[often].tolist(), [0] + keys.tolist(),
                         [np.packbits(some).tobytes()] + [None] * m])

    def second(batches):
        part, blobs = None, []
        for b in batches:
            kinds = b.column("kind").to_numpy()
            documents = b.filter(pa.array(kinds == 0))
            if documents.num_rows:
                yield documents
            counted = b.filter(pa.array(kinds == 1))
            for p, x in zip(counted.column("part").to_pylist(), counted.column("b").to_pylist()):
                if p != part and blobs:
                    yield reduced(part, blobs)
                    blobs = []
                part = p
                blobs.append(x)
        if blobs:
            yield reduced(part, blobs)

    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(first, fields)
            .repartition("part").sortWithinPartitions("part").mapInArrow(second, fields))


def prefix_rows(docs: DataFrame, several: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], shift: int, percent: int) -> DataFrame:
    """(shingle, key, m): the prefix shingles of each set that others may have; m is 16 n + matches demanded."""
    known, counts = frequent
    shared = docs.sparkSession.sparkContext.broadcast((several, known, counts))

    def run(batches):
        several, known, counts = shared.value
        seen = set()
        for b in batches:
            out_s, out_k, out_m = [], [], []
            for t in b.column("t"):
                s = shingles(t.as_py())
                n = len(s)
                key = class_key(s)
                if not n or key in seen:
                    continue
                seen.add(key)
                overlap = _least_overlap(n, percent)
                most = min(MATCHES, overlap)
                reach = n - overlap + most
                others = s[_in_bitmap(several, s)]  # the rest is in no other set and comes first
                alone = n - len(others)
                if alone >= reach:
                    continue
                df = np.ones(len(others), np.int64)
                if len(known):
                    short = others >> np.uint64(shift)
                    at = np.minimum(np.searchsorted(known, short), len(known) - 1)
                    df = np.where(known[at] == short, counts[at], df)
                order = np.lexsort((others, df))[:reach - alone]
                cost = np.concatenate([[0], np.cumsum(np.maximum(df[order] - 1, 1))])
                ends = np.maximum(np.arange(1, most + 1) + n - overlap - alone, 0)
                estimate = cost[ends] + VERIFY_COST * cost[ends] / np.arange(1, most + 1)
                matches = int(np.argmin(estimate)) + 1
                prefix = others[order[:ends[matches - 1]]]
                if len(prefix):
                    out_s.append(prefix)
                    out_k.append(np.full(len(prefix), key, np.int64))
                    out_m.append(np.full(len(prefix), 16 * n + matches, np.int64))
            if out_s:
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(out_s))), pa.array(np.concatenate(out_k)), pa.array(np.concatenate(out_m))],
                                                 names=["shingle", "key", "m"])
        pa.default_memory_pool().release_unused()

    return docs.select(F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, "shingle long, key long, m long")


def shared_rows(rows: DataFrame) -> DataFrame:
    """The prefix rows of shingles that two or more sets have, repeated ones dropped, read in sorted order."""

    def run(batches):
        held, tied = None, False  # the last row, and whether an earlier one has its shingle
        for b in batches:
            t = [b.column(i).to_numpy() for i in range(3)]
            if held is not None:
                t = [np.concatenate([x, y]) for x, y in zip(held, t)]
            if not len(t[0]):
                continue
            new = np.concatenate([[True], (t[0][1:] != t[0][:-1]) | (t[1][1:] != t[1][:-1])])
            t = [x[new] for x in t]
            same = t[0][1:] == t[0][:-1]
            two = np.concatenate([same, [False]]) | np.concatenate([[tied], same])
            held, tied = [x[-1:] for x in t], bool(two[-1])
            two[-1] = False
            if two.any():
                yield batch_of([x[two] for x in t])
        if tied:
            yield batch_of(held)

    def batch_of(t):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in t], names=["shingle", "key", "m"])

    return rows.repartition("shingle").sortWithinPartitions("shingle", "key").mapInArrow(run, "shingle long, key long, m long")


def _fits(m_a: Column, m_b: Column, percent: int) -> Column:
    """Sizes that allow a link."""
    a, b = F.floor(m_a / 16), F.floor(m_b / 16)
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def pivot_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the ``PIVOTS`` first members of each shingle (in one shuffled order for all) with
    its other members.  Linear in the rows; read in sorted order."""

    def run(batches):
        shingle, pivots = None, []
        for b in batches:
            s, k, m = (b.column(c).to_numpy() for c in ("shingle", "key", "m"))
            out: list[list[np.ndarray]] = [[], []]
            cuts = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                if s[lo] != shingle:
                    shingle, pivots = s[lo], []
                for i in range(lo, hi):
                    if len(pivots) == PIVOTS:
                        break
                    pivots.append((k[i], m[i]))
                for pk, pm in pivots:
                    ok = k[lo:hi] != pk
                    ok &= np.minimum(m[lo:hi], pm) // 16 * 100 >= np.maximum(m[lo:hi], pm) // 16 * percent
                    if ok.any():
                        out[0].append(np.full(int(ok.sum()), pk))
                        out[1].append(k[lo:hi][ok])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["a", "b"])

    ordered = (rows.withColumn("o", F.xxhash64("key")).repartition("shingle").sortWithinPartitions("shingle", "o")
               .select("shingle", "key", "m"))
    pairs = ordered.mapInArrow(run, "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def remaining_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share as many prefix shingles as the less demanding of the two asks."""
    a = rows.select("shingle", F.col("key").alias("a"), F.col("m").alias("m_a"), F.col("root").alias("r_a"))
    b = rows.select("shingle", F.col("key").alias("b"), F.col("m").alias("m_b"), F.col("root").alias("r_b"))
    return (a.join(b, "shingle").where((F.col("a") < F.col("b")) & (F.col("r_a") != F.col("r_b")) & _fits(F.col("m_a"), F.col("m_b"), percent))
            .groupBy("a", "b").agg(F.count("*").alias("c"), F.min(F.least(F.col("m_a") % 16, F.col("m_b") % 16)).alias("asked"))
            .where(F.col("c") >= F.col("asked")).select("a", "b"))


def sets_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, s) with the set of each wanted key: a bitmap of the keys keeps most other sets from the shuffle."""
    wanted = docs.sparkSession.sparkContext.broadcast(prefix_bitmap(keys, "key"))

    def run(batches):
        bitmap, seen = wanted.value, set()
        for b in batches:
            ks, ss, size = [], [], 0
            for t in b.column("t"):
                s = shingles(t.as_py())
                key = class_key(s)
                if key in seen or not len(s) or not _in_bitmap(bitmap, np.array([key + 2**63], np.uint64))[0]:
                    continue
                seen.add(key)
                ks.append(key)
                ss.append(s.tobytes())
                size += len(ss[-1])
                if size >= RETURNED:
                    yield batch_of(ks, ss)
                    ks, ss, size = [], [], 0
            if ks:
                yield batch_of(ks, ss)
        pa.default_memory_pool().release_unused()

    def batch_of(ks, ss):
        return pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(ss, pa.binary())], names=["key", "s"])

    found = docs.select(F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, "key long, s binary")
    return found.join(keys, "key", "left_semi").dropDuplicates(["key"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets have the similarity, exactly."""

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("s_a"), b.column("s_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            t = b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
            if t.num_rows:
                yield t
        pa.default_memory_pool().release_unused()

    left = sets.select(F.col("key").alias("a"), F.col("s").alias("s_a"))
    right = sets.select(F.col("key").alias("b"), F.col("s").alias("s_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def links_in_blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components among the sets that share one of the given (crowded) shingles.

    A shingle's sets are put with those of the component that has most of them, so that the shingles
    of one crowd give one group.  The group's sets are dealt to blocks, and every two blocks (and
    every block with itself) meet in a task, which counts common shingles by matrix products and
    returns one link for two components.  All pairs of the group are compared, none is written.
    """

    def compare(t: pa.Table) -> pa.Table:
        key, root, block, n = (t.column(c).to_numpy() for c in ("key", "root", "block", "n"))
        held = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("s")]
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        tokens = tokens[counts > 1]
        common = np.zeros((len(held), len(held)), np.float64)
        for a in range(0, len(tokens), WIDTH):
            part = tokens[a:a + WIDTH]
            x = np.zeros((len(held), len(part)), np.float32)
            for i, s in enumerate(held):
                at = np.minimum(np.searchsorted(part, s), len(part) - 1)
                x[i, at[part[at] == s]] = 1
            common += x @ x.T
        linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
        linked &= root[:, None] < root[None, :]
        if len(np.unique(block)) > 1:
            linked &= block[:, None] != block[None, :]  # within one block: the task of that block
        i, j = np.nonzero(linked)
        _, one = np.unique(np.stack([root[i], root[j]]), axis=1, return_index=True)
        return pa.table({"a": pa.array(key[i[one]]), "b": pa.array(key[j[one]])})

    most = (rows.groupBy(F.col("shingle").alias("s2"), "root").agg(F.count("*").alias("c"))
            .groupBy("s2").agg(F.max_by("root", F.struct("c", "root")).alias("crowd")))
    members = rows.join(most, F.col("shingle") == F.col("s2")).select("crowd", "key", "root").distinct()
    blocks = members.groupBy(F.col("crowd").alias("c2")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = (members.join(blocks, F.col("crowd") == F.col("c2")).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("crowd", "key", "root", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    return (dealt.join(sets, "key").withColumn("n", F.length("s") / 8).groupBy("crowd", "lo", "hi")
            .applyInArrow(compare, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text; other columns are ignored).

    Null and empty texts have no shingles and are linked with nothing; a text of fewer than five words
    is one shingle.  component_id is the least doc_id of the component; repeated rows are equal sets.
    A row with a null doc_id takes part, but never names a component unless all its rows are null.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    n = docs.count()
    ranges_bits = min(16, max(8, (max(n, 1) // 64).bit_length()))
    counted = written(count_shingles(docs, ranges_bits), "shingle-counts")
    documents = counted.where("kind = 0").select("doc_id", "n", "key")

    often = counted.where("kind = 1").orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).select("key", "n").toPandas().sort_values("key")
    frequent = (often["key"].to_numpy().astype(np.uint64), often["n"].to_numpy().astype(np.int32))
    several = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    size = len(several) >> ranges_bits
    for r in counted.where("kind = 2").select("part", "b").collect():  # 2^BITMAP_BITS bits at most
        several[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["b"], np.uint8)

    rows = written(shared_rows(prefix_rows(docs, several, frequent, 32 - ranges_bits, percent)), "prefix-rows")
    sets = written(sets_of(docs, rows.select("key").distinct()), "candidate-sets")
    pairs = written(pivot_pairs(rows, percent), "pivot-pairs")
    links = written(verified(pairs, sets, percent), "links")
    roots = components(links, rounds=2)
    # rows of shingles whose sets lie in several components yet
    known = written(rows.join(roots, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key")).drop("node"), "rooted-rows")
    crowds = (known.groupBy(F.col("shingle").alias("s2")).agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count("*").alias("c"))
              .where("r1 <> r2").select("s2", "c"))
    open_ = written(known.join(crowds, F.col("shingle") == F.col("s2")).drop("s2"), "open-rows")
    listed = remaining_pairs(open_.where(F.col("c") <= LISTED), percent).join(pairs, ["a", "b"], "left_anti")
    more = verified(written(listed, "listed-pairs"), sets, percent)
    crowded = links_in_blocks(open_.where(F.col("c") > LISTED), sets, percent)
    roots = components(links.unionByName(written(more.unionByName(crowded), "more-links")))

    classes = documents.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key"))
    least = classes.groupBy("root").agg(F.min("least").alias("component"))
    classes = classes.join(least, "root").select("key", "component")
    classes = written(classes, "classes")
    full, empty = documents.where("n > 0"), documents.where("n = 0")
    return (full.join(classes, "key").select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
            .unionByName(empty.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))
