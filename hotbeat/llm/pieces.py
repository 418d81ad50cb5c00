"""SentencePiece encoding and decoding by suffix-array matching.

For a batch of texts the chunks not met before (runs of blanks with the word behind them; no piece
crosses such a border) are concatenated and indexed by a suffix array.  Every piece of the vocabulary is
looked up in it by binary search; the occurrences of its range become edges, which are sorted by
position.  Relaxation then follows the model's rule (BPE): of the edges that join two neighbouring
parts of a chunk the one with the best score is taken, the leftmost of equals, until none is left.
Characters that no piece covers become byte pieces.  Decoding puts the pieces' bytes together.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
_CHUNK = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
#: Cached chunks of a generation and worker; then the generation before goes, and what is met again
#: moves on (memory bound only).
MAX_CHUNKS = 250_000
#: Characters indexed at once, and parts of a longer chunk that are put together at once.
MAX_INDEXED = 300_000
PARTS = 100_000
#: Chunks up to this length are relaxed together, one merge of each a round; longer ones with a heap.
SHORT = 64

_MODELS: dict[str, "PieceModel"] = {}


class PieceModel:
    """A BPE piece model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if n > 1 << 16:
            raise ValueError("ids of this model do not fit in 16 bits")
        texts = [sp.id_to_piece(i) for i in range(n)]
        usual = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.byte_ids = {int(texts[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.rank = [-sp.get_score(i) for i in range(n)]  # low is good
        self.raw = [texts[i].encode() for i in range(n)]
        for b, i in self.byte_ids.items():
            self.raw[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                self.raw[i] = b""
        self.width = max(len(texts[i]) for i in usual)
        alphabet = sorted({c for i in usual for c in texts[i]})
        self.letter = {c: k + 1 for k, c in enumerate(alphabet)}  # 0: in no piece
        self.codes = np.zeros(0x110000, np.int16)
        for c, k in self.letter.items():
            self.codes[ord(c)] = k
        by_rank = sorted(range(n), key=lambda i: (self.rank[i], i))
        self.place = np.empty(n, np.int64)  # by rank; equal scores share a place
        for k, i in enumerate(by_rank):
            same = k and self.rank[by_rank[k - 1]] == self.rank[i]
            self.place[i] = self.place[by_rank[k - 1]] if same else k
        ids = sorted(usual, key=lambda i: [self.letter[c] for c in texts[i]])
        self.ids = np.array(ids, np.int64)
        self.lengths = np.array([len(texts[i]) for i in ids], np.int64)
        self.low = self._keys([texts[i] for i in ids], 0)
        self.high = self._keys([texts[i] for i in ids], 255)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _two_bytes(self, codes: np.ndarray) -> np.ndarray:
        """Letters as two bytes that keep their order and are never 0."""
        return np.stack([1 + codes // 250, 1 + codes % 250], -1).astype(np.uint8)

    def _keys(self, texts: list[str], fill: int) -> np.ndarray:
        """Fixed-width sort keys of pieces: the first and last suffix that starts with each."""
        out = np.full((len(texts), self.width, 2), fill, np.uint8)
        for row, t in zip(out, texts):
            row[:len(t)] = self._two_bytes(np.array([self.letter[c] for c in t]))
        return out.reshape(len(texts), -1).view(f"S{2 * self.width}").ravel()

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, length, piece) of every occurrence of every piece in a text, by position."""
        codes = self.codes[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")].astype(np.int64)
        letters = np.concatenate([self._two_bytes(codes), np.ones((self.width, 2), np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(letters, self.width, axis=0)[:len(text)]
        suffixes = np.ascontiguousarray(windows.transpose(0, 2, 1)).reshape(len(text), -1).view(f"S{2 * self.width}").ravel()
        array = np.argsort(suffixes, kind="stable")
        ordered = suffixes[array]
        lo, hi = np.searchsorted(ordered, self.low), np.searchsorted(ordered, self.high, side="right")
        count = hi - lo
        which = np.repeat(np.arange(len(count)), count)
        position = array[np.repeat(lo, count) + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)]
        order = np.lexsort((self.lengths[which], position))
        return position[order], self.lengths[which][order], self.ids[which][order]

    def _relax_together(self, cut: np.ndarray, chunk: np.ndarray, position, length, piece) -> None:
        """Clears the cuts that merges remove, in all chunks side by side.

        An edge may be taken while it starts and ends at cuts with exactly one cut inside.
        """
        begin, end, who, place = position, position + length, chunk[position], self.place[piece]
        first = np.searchsorted(chunk, np.arange(int(chunk[-1]) + 1 if len(chunk) else 0))
        value = (place << 24) + (begin - first[who])  # best score first, then leftmost
        while len(begin):
            upto = np.cumsum(cut)
            inside = upto[end - 1] - upto[begin]
            alive = cut[begin] & cut[end] & (inside > 0)
            now = np.where(alive & (inside == 1), value, np.iinfo(np.int64).max)
            starts = np.concatenate([[0], np.flatnonzero(who[1:] != who[:-1]) + 1])
            best = np.repeat(np.minimum.reduceat(now, starts), np.diff(np.concatenate([starts, [len(who)]])))
            merging = best < np.iinfo(np.int64).max
            taken = merging & (now == best)
            places = np.flatnonzero(cut)
            cut[places[upto[begin[taken]]]] = False
            stay = alive & merging & ~taken
            begin, end, who, value = begin[stay], end[stay], who[stay], value[stay]

    def _relax_long(self, start: int, size: int, edge: dict[int, int]) -> list[int]:
        """Inner cuts of one long chunk after all merges; ``edge`` has 32 * position + length."""
        rank = self.rank
        after = {p: p + 1 for p in range(start, start + size)}
        before = {p + 1: p for p in range(start, start + size)}
        heap: list[tuple[float, int, int]] = []

        def offer(p):
            q = after.get(p)
            e = after.get(q)
            if e is not None and e - p < 32 and (i := edge.get(32 * p + e - p)) is not None:
                heapq.heappush(heap, (rank[i], p, e))

        for p in range(start, start + size):
            offer(p)
        while heap:
            _, p, e = heapq.heappop(heap)
            q = after.get(p)
            if q is None or after.get(q) != e:
                continue
            after[p] = e
            before[e] = p
            del after[q]
            before.pop(q, None)
            offer(p)
            if p in before:
                offer(before[p])
        out, p = [], after[start]
        while p < start + size:
            out.append(p)
            p = after[p]
        return out

    def _encode_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        text = "\n".join(chunks)
        position, length, piece = self.edges(text)
        sizes = np.array([len(c) for c in chunks])
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        chunk = np.repeat(np.arange(len(chunks)), sizes + 1)[:len(text)]
        cut = np.ones(len(text) + 1, bool)
        joins, short = length > 1, sizes <= SHORT
        use = joins & short[chunk[position]]
        self._relax_together(cut, chunk, position[use], length[use], piece[use])
        for k in np.flatnonzero(~short).tolist():
            a, size = int(starts[k]), int(sizes[k])
            own = slice(*np.searchsorted(position, [a, a + size]))
            edge = dict(zip((32 * position[own] + length[own]).tolist(), piece[own].tolist()))
            cut[a:a + size] = False
            cut[[a, *self._relax_long(a, size, edge)]] = True
        begin = np.flatnonzero(cut)
        begin, end = begin[:-1], begin[1:]
        key, known = 32 * begin + np.minimum(end - begin, 31), 32 * position + length
        at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
        found = known[at] == key if len(known) else np.zeros(len(key), bool)
        ids = np.where(found, piece[at] if len(piece) else 0, 0)
        count = np.ones(len(begin), np.int64)
        separator = np.zeros(len(text) + 1, bool)
        separator[starts[1:] - 1] = True
        count[separator[begin]] = 0
        other = np.flatnonzero(~found & ~separator[begin])
        bytes_of = [[self.byte_ids[x] for x in text[a:b].encode()] for a, b in zip(begin[other].tolist(), end[other].tolist())]
        count[other] = [len(x) for x in bytes_of]
        ends = np.cumsum(count)
        out = np.repeat(ids, count).astype("<u2")
        for e, x in zip(ends[other].tolist(), bytes_of):
            out[e - len(x):e] = x
        # ids before each chunk, and before its end
        before = np.concatenate([[0], ends])
        lo, hi = before[np.searchsorted(begin, starts)], before[np.searchsorted(begin, starts + sizes)]
        raw = out.tobytes()
        return {c: raw[2 * a:2 * b] for c, a, b in zip(chunks, lo.tolist(), hi.tolist())}

    def _encode_long(self, chunk: str) -> bytes:
        """Ids of a chunk that is too long to be indexed at once.

        Overlapping windows give every piece's occurrences; the chunk is cut wherever none of them crosses,
        and as no merge crosses either, the parts are encoded apart.  What is still longer between two such
        places is indexed as a whole.
        """
        n, reach = len(chunk), MAX_INDEXED + self.width + 1
        crossing = np.zeros(n + reach, np.int32)
        for a in range(0, n, MAX_INDEXED):
            position, length, _ = self.edges(chunk[a:a + MAX_INDEXED + self.width - 1])
            own = (position < MAX_INDEXED) & (length > 1)
            position, length = position[own], length[own]
            crossing[a:a + reach] += (np.bincount(position + 1, minlength=reach) - np.bincount(position + length, minlength=reach)).astype(np.int32)
        cuts = np.concatenate([[0], np.flatnonzero(np.cumsum(crossing[1:n]) == 0) + 1, [n]])
        known: dict[str, bytes] = {}
        out = []
        for a in range(0, len(cuts) - 1, PARTS):
            ends = cuts[a:a + PARTS + 1].tolist()
            parts = [chunk[x:y] for x, y in zip(ends, ends[1:])]
            if len(known) > MAX_CHUNKS:
                known = {}
            group, size = [], 0
            for part in dict.fromkeys(parts):
                if part in known:
                    continue
                if group and size + len(part) >= MAX_INDEXED:
                    known.update(self._encode_chunks(group))
                    group, size = [], 0
                group.append(part)
                size += len(part) + 1
            if group:
                known.update(self._encode_chunks(group))
            out.append(b"".join(map(known.__getitem__, parts)))
        return b"".join(out)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed 16-bit ids of each text (none for an empty text)."""
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif "  " in t or t[0] == " " or BLANK in t:
                split.append(_CHUNK.findall(BLANK + t.replace(" ", BLANK)))
            else:
                split.append([BLANK + w for w in t.split(" ")])
        if len(self.cache) > MAX_CHUNKS:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        new, size, long = [], 0, {}
        for c in set().union(*split).difference(cache):
            if c in older:
                cache[c] = older[c]
                continue
            if len(c) > MAX_INDEXED:  # not kept between batches
                long[c] = self._encode_long(c)
                continue
            new.append(c)
            size += len(c) + 1
            if size >= MAX_INDEXED:
                cache.update(self._encode_chunks(new))
                new, size = [], 0
        if new:
            cache.update(self._encode_chunks(new))
        find = (lambda c: long[c] if c in long else cache[c]) if long else cache.__getitem__
        return [b"".join(map(find, s)) for s in split]

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u2").tolist()))
        return raw.decode("utf-8", "replace").replace(BLANK, " ")[1:]


def piece_model(path: str) -> PieceModel:
    """The worker's model of a file, loaded once per process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): little-endian unsigned 16-bit ids of every whole text; null and empty texts have none.

    Rows are independent: repeated rows and null keys stay; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        model = piece_model(model_path)
        for b in batches:
            for a in range(0, b.num_rows, 2000):
                part = b.slice(a, 2000)
                ids = model.encode_batch(part.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(ids, pa.binary())], names=[key, "ids"])

    return (docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
            .mapInArrow(run, f"{key} {kind}, ids binary"))


def decode(encoded: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, text) with the text that the ids stand for."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        model = piece_model(model_path)
        for b in batches:
            texts = [model.decode(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("ids"), pa.array(texts, pa.string())], names=[key, "ids", "text"])

    return (encoded.select(key, F.coalesce(F.col("ids"), F.lit(b"")).alias("ids"))
            .mapInArrow(run, f"{key} {kind}, ids binary, text string"))
