"""Fill-in-the-middle against plain string slicing."""

import hashlib
import random

import numpy as np
import pytest

from hotbeat.llm import fill_middle
from hotbeat.llm.fill_middle import ExceptionIndex

SCHEMA = "doc_id long, text string, n string, form string, output string, k int, t int, h1 int, prefix_chars string"
EXTRA = ("n", "f", "o", 1, 2, 3, "p")


def plainly(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by code points of a Python string."""
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def odd_rows():
    rng = random.Random(5)
    pools = ["abc <>PSM\n", "aé日🙂", "日本語", "ascii only ", "<P<S<M>>", "🙂é", "́e‍👩"]
    rows = [(i, "".join(rng.choices(rng.choice(pools), k=rng.randint(0, 30)))) for i in range(600)]
    return rows + [(1000, None), (1001, ""), (None, "no id é"), (1002, "has <M> in it"), (7, "same id"), (7, "same id"), (-3, "negative é"),
                   (1003, "long é text " * 200_000), (1004, "x" * 1_000_000), (1005, "🙂"), (1006, "<"), (1007, "\x00\x7f߿￿")]


def test_every_row_equals_plain_slicing_and_is_restored(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    done = fill_middle.transform(df)
    out = fill_middle.restore(done, *done.columns).collect()
    got = sorted((str(r["doc_id"]), r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), bytes(r["output"])) for r in out)
    want = []
    for k, t in rows:
        n, form, a, m, o = plainly(k, t)
        want.append((str(k), n, form, str(a), str(m), o.encode()))
    assert got == sorted(want)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    assert sorted(bytes(r["restored"]) for r in out) == sorted((t or "").encode() for _, t in rows)
    assert all((r["found_prefix"], r["found_middle"]) == (r["prefix_chars"], r["middle_chars"]) for r in out)


def test_empty_table_and_broken_outputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fill_middle.restore(fill_middle.transform(empty), "doc_id").count() == 0
    rows = [("psm", "<P>a<S>b"), ("psm", None), (None, "x"), ("other", "x"), ("spm", "<P>a<S>b<M>c"), ("spm", "<S>b<P>a<M>c")]
    df = spark.createDataFrame(rows, "form string, output string")
    assert [r["restored"] for r in fill_middle.restore(df, "form").collect()] == [None] * 5 + [b"acb"]
    with pytest.raises(ValueError):
        fill_middle.restore(df.withColumn("restored", df.form), "restored")


def test_bytes_that_are_not_text_are_replaced(spark):
    bad = spark.sql("SELECT id AS doc_id, CAST(X'61FF62F0' AS STRING) AS text FROM range(50)")
    out = fill_middle.restore(fill_middle.transform(bad), "n").collect()
    assert {bytes(r["restored"]).decode() for r in out} == {"a�b�"} and {r["n"] for r in out} == {4}


def test_exception_index_converts_both_ways():
    rng = random.Random(6)
    texts = ["".join(rng.choices("ab é日🙂", k=rng.randint(0, 40))) for _ in range(200)] + ["", "plain"]
    raw = [t.encode() for t in texts]
    index = ExceptionIndex(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    assert index.lengths().tolist() == [len(t) for t in texts]
    assert len(index.bytes) == sum(ord(c) > 127 for t in texts for c in t)  # ASCII leaves no entry
    for k, t in enumerate(texts):
        points = np.arange(len(t) + 1)
        who = np.full(len(points), k)
        offsets = index.to_bytes(who, points)
        assert (offsets - index.starts[k]).tolist() == [len(t[:p].encode()) for p in points]
        assert index.to_points(who, offsets).tolist() == points.tolist()


def test_batches_of_any_size_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "TOGETHER", 16)
    rows = odd_rows()[:80]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    got = sorted((str(r["doc_id"]), bytes(r["output"])) for r in fill_middle.transform(df).collect())
    assert got == sorted((str(k), plainly(k, t)[4].encode()) for k, t in rows)
