"""Packing of documents into training sequences by order-preserving dynamic programming.

The documents of a partition form one stream of tokens, in their order.  It is cut into windows of at
most ``length`` tokens.  Places to cut are document ends (free), sentence ends (a small penalty) and,
inside long stretches without either, every ``HARD_STEP`` tokens (a larger penalty).  The cuts minimise
padding plus penalties: best[j] = penalty[j] + length - p[j] + min(best[i] + p[i]) over the places i at
most ``length`` before j, a sliding minimum that a monotone queue keeps, so the work is linear.

Blocks of the stream are solved one after the other; the last window of a block opens the next one, so
memory stays bounded and only a partition's last sequence can be short.  Nothing is shuffled.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.chunk_bpe import encoder

SENTENCE_PENALTY = 2
HARD_PENALTY = 8
HARD_STEP = 32
#: Tokens solved at once.
BLOCK = 2_000_000
SENTENCE_ENDS = (".", "!", "?", "\n", "。")


def best_cuts(places: list[int], penalties: list[int], length: int) -> list[int]:
    """Indexes of the places at which to cut, first and last included; gaps are ``length`` at most."""
    n = len(places)
    key, back = [0] * n, [0] * n  # key: cost so far plus place
    queue = deque([0])
    key[0] = places[0]
    for j in range(1, n):
        p = places[j]
        while places[queue[0]] < p - length:
            queue.popleft()
        i = queue[0]
        back[j] = i
        k = key[j] = key[i] + length + penalties[j]
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def places_to_cut(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, penalties) of a stream; 0 and its end are among them."""
    soft = np.flatnonzero(sentence_end[ids]) + 1
    places = np.unique(np.concatenate([[0], soft, doc_ends]))
    gaps = np.diff(places)
    more = (gaps - 1) // HARD_STEP
    starts = np.repeat(places[:-1], more)
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(more) - more, more) + 1
    hard = starts + nth * HARD_STEP
    everywhere = np.concatenate([places, hard])
    penalties = np.concatenate([np.full(len(places), SENTENCE_PENALTY), np.full(len(hard), HARD_PENALTY)])
    order = np.argsort(everywhere, kind="stable")
    everywhere, penalties = everywhere[order], penalties[order]
    penalties[np.searchsorted(everywhere, doc_ends)] = 0
    return everywhere, penalties


def pack(docs: DataFrame, tokenizer_path: str, kind: str, end_id: int, length: int = 1024, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row a piece: key, start, length, doc_tokens, sequence_id, offset, ids (binary, 32-bit).

    ``start`` counts the document's ids before the piece, ``offset`` those before it in its sequence;
    pieces of a sequence lie in it without gaps.  A null text is empty: its only id is the end id.
    Repeated rows are documents of their own; null keys stay null; other columns are ignored.  Each
    id lies in exactly one piece.  Sequences are numbered by partition and place: unique, not dense.
    """
    kind_of_key = docs.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoder(tokenizer_path, kind)
        vocabulary = enc.library.get_vocab_size()
        ends = np.array([enc.library.decode([i]).endswith(SENTENCE_ENDS) for i in range(vocabulary)])
        ends = np.concatenate([ends, np.zeros((1 << 16) - vocabulary, bool)])
        sequence = TaskContext.get().partitionId() << 40
        # segments of the open stream: key, start in the document, the document's tokens, ids
        open_: list[tuple] = []
        size = 0

        def solve(last: bool):
            nonlocal open_, size, sequence
            keys, starts, totals, parts = zip(*open_)
            ids = np.concatenate(parts)
            doc_ends = np.cumsum([len(p) for p in parts])
            doc_starts = np.concatenate([[0], doc_ends[:-1]])
            places, penalties = places_to_cut(ids, doc_ends, ends)
            cuts = places[best_cuts(places.tolist(), penalties.tolist(), length)]
            done = len(ids) if last else int(cuts[-2])
            cuts = cuts[cuts <= done]
            edges = np.unique(np.concatenate([cuts, doc_ends[doc_ends <= done]]))
            begin, stop = edges[:-1], edges[1:]
            doc = np.searchsorted(doc_ends, begin, side="right")
            window = np.searchsorted(cuts, begin, side="right") - 1
            wide = ids[:done].astype("<u4")
            out = [pa.array([keys[d] for d in doc.tolist()], key_type),
                   pa.array(np.array(starts, np.int64)[doc] + begin - doc_starts[doc]), pa.array(stop - begin),
                   pa.array(np.array(totals, np.int64)[doc]), pa.array(sequence + window), pa.array(begin - cuts[window]),
                   pa.array([wide[a:b].tobytes() for a, b in zip(begin.tolist(), stop.tolist())], pa.binary())]
            sequence += len(cuts) - 1
            if done == len(ids):
                open_ = []
            else:
                first = int(np.searchsorted(doc_ends, done, side="right"))
                cut = done - int(doc_starts[first])
                open_ = [(keys[first], starts[first] + cut, totals[first], parts[first][cut:]), *open_[first + 1:]]
            size = len(ids) - done
            return pa.RecordBatch.from_arrays(out, names=[key, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            key_type = batch.schema.field("k").type
            tail = np.array([end_id], "<u2")
            for k, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist()):
                ids = np.concatenate([enc.encode(t), tail])
                open_.append((k, 0, len(ids), ids))
                size += len(ids)
                if size >= BLOCK:
                    yield solve(False)
        if open_:
            yield solve(True)

    return (docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
            .mapInArrow(run, f"{key} {kind_of_key}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"))
