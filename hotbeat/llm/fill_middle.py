"""Fill-in-the-middle transformation over a sparse exception index.

Texts stay UTF-8 bytes, a whole batch in one buffer.  The index of a batch records only its multibyte
characters: where each starts, counted in code points of its text, and how many bytes more than one it
takes (running sums).  A code point's byte offset is its number plus the excess of the exceptions before
it, found by ``searchsorted``; spans without exceptions are plain arithmetic.  The same index turns byte
offsets back into code points when a text is restored.

A text of n code points is cut at two of them: prefix, middle, suffix.  ``psm`` writes
``<P>prefix<S>suffix<M>middle``, ``spm`` writes ``<S>suffix<P>prefix<M>middle``, ``plain`` the text itself.
Cuts and forms follow a hash of the row's key, so they do not depend on partitions or retries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

P, S, M = b"<P>", b"<S>", b"<M>"
#: Percentage of texts that are rearranged, and percentage of those in ``spm`` order.
REARRANGED = 90
SUFFIX_FIRST = 20
#: Bytes of texts that are indexed together.
TOGETHER = 4_000_000


class ExceptionIndex:
    """Multibyte characters of many texts that lie one behind the other in a byte buffer."""

    def __init__(self, buffer: np.ndarray, starts: np.ndarray):
        """``starts``: byte offset of every text, and the end of the last."""
        self.starts = starts.astype(np.int64)
        lead = np.flatnonzero(buffer >= 0xC0)
        kind = buffer[lead]
        excess = 1 + (kind >= 0xE0).astype(np.int64) + (kind >= 0xF0)
        self.total = np.concatenate([[0], np.cumsum(excess)])  # excess bytes before each exception
        self.points = lead - self.total[:-1]  # code points of the buffer before each exception
        self.bytes = lead
        #: exceptions before each text, and code points before each text
        self.first = np.searchsorted(lead, self.starts)
        self.before = self.starts - self.total[self.first]

    def lengths(self) -> np.ndarray:
        """Code points of every text."""
        return np.diff(self.before)

    def to_bytes(self, text: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Byte offset in the buffer of a code point (0 to its length) of a text."""
        at = self.before[text] + point
        return at + self.total[np.searchsorted(self.points, at, side="left")]

    def to_points(self, text: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """Code point within its text of a byte offset in the buffer that starts a character."""
        return offset - self.total[np.searchsorted(self.bytes, offset, side="left")] - self.before[text]


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and the offsets of its rows."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def _slices(batch: pa.RecordBatch, column: str):
    """Slices of a batch of ``TOGETHER`` bytes at most, or of one row."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + TOGETHER, side="right")))
        yield batch.slice(a, b - a)
        a = b


def _with_cuts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, h1 to h3, form) with the key's hashes and the form as far as the text allows it."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    word = lambda n: F.conv(F.substring("digest", 8 * n - 7, 8), 16, 10).cast("long")
    keyed = df.select(F.col(key).alias("k"), F.make_valid_utf8(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"), digest.alias("digest"))
    marked = F.contains("t", F.lit("<P>")) | F.contains("t", F.lit("<S>")) | F.contains("t", F.lit("<M>"))
    plain = (F.col("t") == "") | marked | (word(3) % 100 >= REARRANGED)
    form = F.when(plain, "plain").when(word(4) % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    return keyed.select("k", F.col("t").cast("binary").alias("t"), word(1).alias("h1"), word(2).alias("h2"), form.alias("form"))


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output): every whole text with its middle moved behind.

    ``output`` holds UTF-8 bytes; ``n``, ``prefix_chars`` and ``middle_chars`` count code points, the
    latter two are null for ``plain``.  Bytes that are not UTF-8 count as replacement characters.  Null texts count as empty; empty texts and texts with one of the
    marks stay plain.  A null key hashes like an empty one; rows with equal keys are cut by equal hashes;
    rows are independent, other columns are ignored, an empty table gives an empty table.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        for batch in batches:
            for b in _slices(batch, "t"):
                raw, starts = _buffer(b.column("t"))
                index = ExceptionIndex(raw, starts)
                n = index.lengths()
                h1, h2 = (b.column(h).to_numpy() for h in ("h1", "h2"))
                first, second = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), 0)
                rows = np.arange(len(n))
                cut1, cut2 = index.to_bytes(rows, first).tolist(), index.to_bytes(rows, second).tolist()
                forms, data, out = b.column("form").to_pylist(), memoryview(raw), []
                for form, lo, a, z, hi in zip(forms, starts.tolist(), cut1, cut2, starts[1:].tolist()):
                    if form == "psm":
                        out.append(b"".join((P, data[lo:a], S, data[z:hi], M, data[a:z])))
                    elif form == "spm":
                        out.append(b"".join((S, data[z:hi], P, data[lo:a], M, data[a:z])))
                    else:
                        out.append(bytes(data[lo:hi]))
                plain = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [b.column("k"), pa.array(n, pa.int64()), b.column("form"), pa.array(first, pa.int64(), mask=plain),
                     pa.array(second - first, pa.int64(), mask=plain), pa.array(out, pa.binary())], names=names)

    return _with_cuts(docs, key, text).mapInArrow(
        run, f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")


def restore(rearranged: DataFrame, *keep: str | Column, form: str = "form", output: str = "output") -> DataFrame:
    """The rows of ``keep`` with ``restored`` (UTF-8 bytes of the exact text), ``found_prefix`` and ``found_middle``.

    Only ``form`` and ``output`` are read: the marks are found in the output and their byte offsets become
    code points through the exception index (null for ``plain``).  A text without marks has no other place
    where one could begin, because a mark's first character stands nowhere else in it.  Rows with a null
    output, an unknown form or missing marks restore to null.
    """
    kept = rearranged.select(*keep)
    for name in ("restored", "found_prefix", "found_middle"):
        if name in kept.columns:
            raise ValueError(f"column {name} would stand twice")
    names = [f"c{i}" for i in range(len(kept.columns))]
    rows = rearranged.select(*[F.col(c) if isinstance(c, str) else c for c in keep], F.col(form).alias("__form"), F.col(output).cast("binary").alias("__out"))
    rows = rows.toDF(*names, "form", "out")
    types = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept.schema.fields))

    def cuts_of(form: str | None, out: bytes | None):
        """Byte spans of prefix, middle and suffix in an output, or None."""
        if out is None:
            return None
        if form == "plain":
            return (0, len(out)), (0, 0), (0, 0)
        head, then = (P, S) if form == "psm" else (S, P)
        if form not in ("psm", "spm") or not out.startswith(head):
            return None
        second = out.find(then, 3)
        third = out.find(M, second + 3) if second >= 0 else -1
        if third < 0:
            return None
        one, two, middle = (3, second), (second + 3, third), (third + 3, len(out))
        return (one, middle, two) if form == "psm" else (two, middle, one)

    def run(batches):
        for batch in batches:
            for b in _slices(batch, "out"):
                outs, forms = b.column("out").to_pylist(), b.column("form").to_pylist()
                spans = [cuts_of(f, o) for f, o in zip(forms, outs)]
                texts = [None if s is None else b"".join(o[a:z] for a, z in s) for s, o in zip(spans, outs)]
                starts = np.concatenate([[0], np.cumsum([len(t or b"") for t in texts])])
                index = ExceptionIndex(np.frombuffer(b"".join(t or b"" for t in texts), np.uint8), starts)
                size = lambda part: np.array([0 if s is None else s[part][1] - s[part][0] for s in spans], np.int64)
                at, who = starts[:-1] + size(0), np.arange(len(spans))
                prefix = index.to_points(who, at)
                middle = index.to_points(who, at + size(1)) - prefix
                none = np.array([s is None or f == "plain" for s, f in zip(spans, forms)], bool)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in names], pa.array(texts, pa.binary()), pa.array(prefix, pa.int64(), mask=none),
                     pa.array(middle, pa.int64(), mask=none)], names=[*names, "restored", "found_prefix", "found_middle"])

    out = rows.mapInArrow(run, f"{types + ', ' if names else ''}restored binary, found_prefix long, found_middle long")
    return out.toDF(*kept.columns, "restored", "found_prefix", "found_middle")
