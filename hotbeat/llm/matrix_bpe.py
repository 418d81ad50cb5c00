"""Byte-level BPE encoding and decoding by length-bucketed padded matrices.

A text is split by the rank files' pattern; every distinct chunk of a batch becomes one row of a padded
matrix together with chunks of about its length, one cell a byte.  Each round every unfinished row
merges its leftmost pair of least rank; exactly one column of each row falls away, so the matrix is
compacted by one mask and one reshape.  Ranks of pairs come from a hash table in numpy arrays, and only
the two pairs beside a merge are looked up again.  A row leaves the matrix when none of its pairs is in
the table.  A chunk that is itself a token is that token, as in the ``tiktoken`` library.

Rows longer than ``WIDEST`` bytes are first cut where two bytes meet that stand side by side in no token
(no merge crosses such a place); what is still longer is merged in the same order with a heap instead of
one matrix round a merge.  Results do not depend on batches, buckets or caches.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of the longest row that is merged in a matrix.
WIDEST = 1024
#: Cells of one matrix: bounds memory, not results.
CELLS = 1 << 20
#: Distinct chunks kept between batches, in each of two generations.
MAX_CHUNKS = 150_000
#: Chunks longer than this are not kept between batches.
KEPT_BYTES = 256
#: Characters of documents that are encoded together, and matches taken at once from a longer one.
TOGETHER = 1_000_000
MATCHES = 100_000
NONE = np.iinfo(np.int32).max

_MODELS: dict[str, "MatrixBpe"] = {}


class PairTable:
    """Open-addressing hash table from a pair of token ids to the id (and rank) of the merged token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(4 * len(merged) + 1).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int32)
        key = (left.astype(np.int64) << 32) | right
        at, left_over = self._slot(key), np.arange(len(key))
        self.probes = 0
        while len(left_over):
            self.probes += 1
            free = self.keys[at[left_over]] < 0
            tried = left_over[free]
            slots, first = np.unique(at[tried], return_index=True)
            self.keys[slots], self.values[slots] = key[tried[first]], merged[tried[first]]
            left_over = left_over[self.keys[at[left_over]] != key[left_over]]
            at[left_over] = (at[left_over] + 1) & (size - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, ``NONE`` for pairs that never merge and for padding (-1)."""
        key = (left.astype(np.int64) << 32) | right
        out = np.full(key.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        flat, result = key.ravel(), out.ravel()
        at = self._slot(flat[todo])
        for _ in range(self.probes):
            held = self.keys[at]
            hit = held == flat[todo]
            result[todo[hit]] = self.values[at[hit]]
            more = ~hit & (held >= 0)
            todo, at = todo[more], (at[more] + 1) & (len(self.keys) - 1)
            if not len(todo):
                break
        return result.reshape(key.shape)


class Splitter:
    """Splits texts by the rank files' pattern as ``tiktoken`` does.

    Which characters are letters, numbers or blanks depends on the Unicode version of a regex library.
    Characters on which the two libraries disagree are replaced, for the split only, by an ordinary
    character of the class that ``tiktoken`` gives them.
    """

    def __init__(self):
        import regex
        import tiktoken

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        bytes_only = {bytes([b]): b for b in range(256)}

        def classes(find):
            return [set(find(c)) for c in (r"\p{L}", r"\p{N}", r"\s")]

        def theirs(c):
            own = tiktoken.Encoding("class", pat_str=c, mergeable_ranks=bytes_only, special_tokens={})
            return own.decode(own.encode_ordinary(every))

        want, have = classes(theirs), classes(lambda c: regex.findall(c, every))
        self.stand_in = {}
        for c in set().union(*(w ^ h for w, h in zip(want, have))):
            self.stand_in[c] = "x" if c in want[0] else "0" if c in want[1] else " " if c in want[2] else "!"
        self.disputed = frozenset(self.stand_in)
        self.table = str.maketrans(self.stand_in)

    def split(self, text: str) -> list[str]:
        if text.isascii() or self.disputed.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.table))]

    def split_slowly(self, text: str):
        """The same chunks, as lists of bounded length."""
        plain = text if text.isascii() or self.disputed.isdisjoint(text) else text.translate(self.table)
        found = self.pattern.finditer(plain)
        while part := [text[m.start():m.end()] for m in islice(found, MATCHES)]:
            yield part


class MatrixBpe:
    """Ranks of one file, its pair table, and the encoding of batches of texts."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        pairs = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t))
                 if t[:k] in ranks and t[k:] in ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.meet = np.zeros((256, 256), bool)  # bytes that stand side by side in some token
        for t in ranks:
            for a, b in zip(t, t[1:]):
                self.meet[a, b] = True
        self.splitter = Splitter()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merge_matrix(self, cells: np.ndarray) -> list[np.ndarray]:
        """Ids of every row of a padded matrix (-1 behind the end) after all merges."""
        out: list[np.ndarray | None] = [None] * len(cells)
        who = np.arange(len(cells))
        ranks = self.pairs.ranks(cells[:, :-1], cells[:, 1:])
        while len(who):
            width = cells.shape[1]
            at = ranks.argmin(1) if width > 1 else np.zeros(len(who), np.int64)
            best = ranks[np.arange(len(who)), at] if width > 1 else np.full(len(who), NONE)
            done = best == NONE
            if done.any():
                for n, row in zip(who[done].tolist(), cells[done]):
                    out[n] = row[row >= 0]
                go = ~done
                who, cells, ranks, at, best = who[go], cells[go], ranks[go], at[go], best[go]
                if not len(who):
                    break
            rows = np.arange(len(who))
            cells[rows, at] = best
            keep = np.ones(cells.shape, bool)
            keep[rows, at + 1] = False
            cells = cells[keep].reshape(len(who), width - 1)
            keep = np.ones(ranks.shape, bool)
            keep[rows, at] = False
            ranks = ranks[keep].reshape(len(who), width - 2)
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.pairs.ranks(cells[before, at[before] - 1], best[before])
            behind = np.flatnonzero(at < width - 2)
            ranks[behind, at[behind]] = self.pairs.ranks(best[behind], cells[behind, at[behind] + 1])
        return out

    def _merge_long(self, row: bytes) -> np.ndarray:
        """One row merged pair by pair in the same order: least rank first, then leftmost."""
        n = len(row)
        ids = self.byte_ids[np.frombuffer(row, np.uint8)]
        first = self.pairs.ranks(ids[:-1], ids[1:])
        ids, rank = array("i", ids.tolist()), array("i", [*first.tolist(), NONE])
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        keys, values, bits, mask = self.pairs.keys, self.pairs.values, self.pairs.bits, len(self.pairs.keys) - 1
        known: dict[int, int] = {}

        def look_up(a, b):
            key = a << 32 | b
            if key not in known:
                at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - bits)
                while keys[at] >= 0 and keys[at] != key:
                    at = at + 1 & mask
                known[key] = int(values[at])
            return known[key]

        heap = ((first.astype(np.int64) << 32) | np.arange(n - 1))[first != NONE].tolist()
        heapq.heapify(heap)
        while heap:
            best, p = divmod(heapq.heappop(heap), 1 << 32)
            if rank[p] != best:
                continue
            q = after[p]
            ids[p], ids[q], rank[q] = best, -1, NONE
            after[p] = r = after[q]
            rank[p] = NONE
            if r < n:
                before[r] = p
                rank[p] = look_up(best, ids[r])
                if rank[p] != NONE:
                    heapq.heappush(heap, rank[p] << 32 | p)
            if (o := before[p]) >= 0:
                rank[o] = look_up(ids[o], best)
                if rank[o] != NONE:
                    heapq.heappush(heap, rank[o] << 32 | o)
        out = np.frombuffer(ids, np.int32)
        return out[out >= 0]

    def _parts(self, row: bytes) -> list[bytes]:
        """A long row cut where no merge can cross."""
        codes = np.frombuffer(row, np.uint8)
        cuts = [0, *(np.flatnonzero(~self.meet[codes[:-1], codes[1:]]) + 1).tolist(), len(row)]
        return [row[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_chunks(self, chunks: list[bytes]) -> list[np.ndarray]:
        """Ids of every chunk (none of them empty)."""
        out: list[np.ndarray | None] = [None] * len(chunks)
        parts: list[list[np.ndarray | None]] = []
        rows: list[tuple[bytes, list, int]] = []  # bytes of a row, where its ids go
        owners = []
        for n, c in enumerate(chunks):
            if c in self.ranks:
                out[n] = np.array([self.ranks[c]], np.int32)
                continue
            cut = [c] if len(c) <= WIDEST else self._parts(c)
            parts.append([None] * len(cut))
            owners.append(n)
            for k, p in enumerate(cut):
                if len(p) <= WIDEST:
                    rows.append((p, parts[-1], k))
                else:
                    parts[-1][k] = self._merge_long(p)
        rows.sort(key=lambda r: len(r[0]))
        a = 0
        while a < len(rows):
            # rows of one bucket differ by an eighth of their length, or four bytes, at most
            shortest = len(rows[a][0])
            most, b = shortest + max(4, shortest // 8), a + 1
            while b < len(rows) and len(rows[b][0]) <= most and (b - a + 1) * len(rows[b][0]) <= CELLS:
                b += 1
            width = len(rows[b - 1][0])
            sizes = np.array([len(r[0]) for r in rows[a:b]])
            cells = np.full((b - a, width), -1, np.int32)
            cells[np.arange(width) < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join(r[0] for r in rows[a:b]), np.uint8)]
            for (_, target, k), ids in zip(rows[a:b], self._merge_matrix(cells)):
                target[k] = ids
            a = b
        for n, p in zip(owners, parts):
            out[n] = p[0] if len(p) == 1 else np.concatenate(p)
        return out

    def _joined(self, split: list[list[str]]) -> list[bytes]:
        """Ids of the chunks of every text, little-endian unsigned 32-bit."""
        if len(self.cache) > MAX_CHUNKS:
            self.cache, self.older = {}, self.cache
        cache, older, large = self.cache, self.older, {}
        new = []
        for c in set().union(*split).difference(cache):
            if c in older:
                cache[c] = older[c]
            else:
                new.append(c)
        raw = [c.encode("utf-8") for c in new]
        for c, r, ids in zip(new, raw, self.encode_chunks(raw)):
            (cache if len(r) <= KEPT_BYTES else large)[c] = ids.astype("<u4").tobytes()
        find = cache.__getitem__ if not large else lambda c: large[c] if c in large else cache[c]
        return [b"".join(map(find, s)) for s in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        if sum(map(len, texts)) <= 2 * TOGETHER:
            return self._joined([self.splitter.split(t) for t in texts])
        return [b"".join(self._joined([part])[0] for part in self.splitter.split_slowly(t)) for t in texts]

    def decode(self, ids: bytes | None) -> bytes | None:
        """Bytes that the ids stand for; None for ids that the file lacks or a broken length."""
        if ids is None or len(ids) % 4:
            return None
        try:
            return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        except KeyError:
            return None


def bpe_model(path: str) -> MatrixBpe:
    """The worker's model of a rank file, loaded once per process."""
    if path not in _MODELS:
        _MODELS[path] = MatrixBpe(path)
    return _MODELS[path]


def _slices(batch: pa.RecordBatch, sizes: np.ndarray):
    """Slices of a batch of ``TOGETHER`` bytes at most, or of one row."""
    a = 0
    ends = np.cumsum(sizes)
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + TOGETHER, side="right")))
        yield batch.slice(a, b - a)
        a = b


def _sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def encode(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): little-endian unsigned 32-bit ids of every whole text; null and empty texts have none.

    Rows are independent: repeated rows and null keys stay, an empty table gives an empty table, other
    columns are ignored.  Bytes that are not UTF-8 are encoded as the replacement character.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        model = bpe_model(ranks_path)
        for b in batches:
            for part in _slices(b, _sizes(b.column("t"))):
                texts = [t.decode("utf-8", "replace") for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(model.encode(texts), pa.binary())], names=[key, "ids"])

    return (docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t"))
            .mapInArrow(run, f"`{key}` {kind}, ids binary"))


def decode(encoded: DataFrame, ranks_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, decoded): the bytes that the ids of every row stand for.

    Null for null ids, for ids that the file lacks and for a length that is no multiple of four bytes.
    """
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        model = bpe_model(ranks_path)
        for b in batches:
            for part in _slices(b, _sizes(b.column("ids"))):
                raw = [model.decode(x) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("ids"), pa.array(raw, pa.binary())], names=[key, "ids", "decoded"])

    return (encoded.select(F.col(key).alias("k"), F.col(ids).alias("ids"))
            .mapInArrow(run, f"`{key}` {kind}, ids binary, decoded binary"))
