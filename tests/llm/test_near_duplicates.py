"""Near-duplicate classes and the pipeline against brute force."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from hotbeat.llm import jaccard_join, quality, toxicity
from hotbeat.llm.common import table
from hotbeat.llm.components import components
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key long, n long, m long, s string, shingle string, root long, kind int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "s", "x", 4, 5) for r in rows], SCHEMA).repartition(4)


def brute(rows):
    """Sorted (doc_id, set size, least id reachable) by comparing the shingle strings themselves."""
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k if k is not None else -1), len(sets[i]), least.get(find(i), -1) if sets[i] else (k if k is not None else -1)) for i, (k, _) in enumerate(rows))


def classes(spark, rows):
    got = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    return sorted(tuple(-1 if x is None else x for x in (r["doc_id"], r["n_shingles"], r["component_id"])) for r in got)


def made_up(seed):
    """Shared passages, exact and near copies in chains, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage = [word() for _ in range(60)]
    texts = ["", None, "   ", "one two three four", "One TWO three four", "one two three"]
    base = [word() for _ in range(70)]
    for _ in range(60):  # a large group of near copies
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
    chain = [word() for _ in range(120)]
    for _ in range(8):  # each a near copy of the one before
        chain = list(chain)
        chain[rng.randrange(len(chain))] = word()
        chain[rng.randrange(len(chain))] = word()
        texts.append(" ".join(chain))
    for _ in range(25):  # unrelated texts that share a passage
        texts.append(" ".join([word() for _ in range(rng.randint(5, 80))] + passage))
    texts += [texts[10]] * 30 + [texts[80]] * 3
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [*zip(ids, texts)] + [(None, texts[10]), (None, "alone without an id at all"), (ids[12], texts[12])]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made_up(seed)
    assert classes(spark, rows) == brute(rows)


def test_no_documents(spark):
    assert jaccard_join.near_duplicates(frame(spark, [])).count() == 0
    assert classes(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_long_text(spark):
    rng = random.Random(3)
    words = [str(rng.randrange(10**6)) for _ in range(30_000)]
    rows = [(3, " ".join(words)), (2, " ".join(words[:-500])), (1, " ".join(words[9000:]))]
    assert [(k, c) for k, _, c in classes(spark, rows)] == [(1, 1), (2, 2), (3, 2)]


def test_small_capacity_changes_nothing(spark, monkeypatch):
    """Fewer known frequent shingles and smaller bitmaps cost time, never links."""
    monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", 10)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 1)
    monkeypatch.setattr(jaccard_join, "LISTED", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "WIDTH", 50)
    rows = made_up(4)
    assert classes(spark, rows) == brute(rows)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    model = toxicity.fit(docs, labels)
    if model.constant is None:
        a, b = toxicity.compressor(model.ordinary), toxicity.compressor(model.toxic)
        clean = [(k, t) for k, t in rows if toxicity.logistic(toxicity.features(toxicity.excess(toxicity.windows(t or ""), a, b), model.threshold)[None], model.calibration)[0] < 0.5]
    else:
        clean = [x for x in rows if model.constant < 0.5]
    left = docs.where(docs.doc_id.isin([k for k, _ in clean]))
    model = quality.fit(left, labels)
    good = [(k, t) for k, t in clean if (model.constant if model.constant is not None else quality.predict(model, [quality.encode(t or "")])[0]) >= 0.3]
    kept = {c for _, _, c in brute(good)}
    want = [(k, t) for k, t in good if k in kept]
    assert 0 < len(want) < len(rows)

    docs_now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_now = stage(spark, docs_now, SF)
        assert docs_now.columns == docs.columns
        docs_now = spark.createDataFrame(docs_now.collect(), docs.schema)
    assert sorted((r["doc_id"], r["text"]) for r in docs_now.collect()) == sorted(want)

    from hotbeat.llm import packing

    check_packing(packing.pack(docs_now, corpus_pipeline.BYTE_BPE, "byte", 0).collect(), want)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert sum(r["length"] for r in pieces) == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())
    assert {r["doc_id"] for r in pieces} == {k for k, _ in want}


def test_pipeline_stages_on_edge_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a few words here to keep", "en", "s", 1), (1, "a few words here to keep", "en", "s", 1), (2, None, None, None, None),
            (3, "", "en", "s", 0), (None, "no id", "en", "s", 1), (4, "A few words here to keep", "en", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
    left = corpus_pipeline.one_of_each_group(spark, docs, SF).collect()
    assert sorted((r["doc_id"] or 0) for r in left) == [0, 1, 2, 3]


def test_an_id_on_two_texts_keeps_both(spark):
    """Rows are chosen by id and text: a repeated id does not drop a text nor let a near copy survive."""
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in ("first", "second"))
    rows = [(7, one), (7, two), (3, two + " end"), (None, one), (None, "a text of its own without an id"), (None, ""), (None, ""), (8, None), (9, one), (9, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 5):
        left = corpus_pipeline.one_of_each_group(spark, docs.repartition(parts), SF).collect()
        assert sorted(map(tuple, left), key=repr) == sorted(
            [(7, one), (3, two + " end"), (None, "a text of its own without an id"), (None, ""), (None, ""), (8, None)], key=repr)


class _Caught:
    """Stands for a frame: keeps the functions that would run in tasks."""

    def __init__(self, session=None):
        self.tasks, self.sparkSession = [], session

    def mapInArrow(self, f, schema):
        self.tasks.append(f)
        return self

    def __getattr__(self, name):
        return lambda *a, **b: self


def _peak(task, batches):
    """Bytes of Python and NumPy that a task holds at most, beside its input."""
    tracemalloc.start()
    try:
        for _ in task(batches):
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_tasks_hold_little_of_a_large_batch(spark):
    """Texts and sets are taken from a batch one by one, and the counts' buffer is sorted in place."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=700)) for _ in range(6000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "t": texts})
    size = batch.nbytes
    assert size > 28e6
    caught = _Caught()
    jaccard_join.count_shingles(caught, 8)
    assert _peak(caught.tasks[0], [batch]) < 1.6 * size

    key = jaccard_join.shingles(texts[0]).tobytes()
    rows = pa.RecordBatch.from_pydict({"a": [1] * 6000, "b": [2] * 6000, "s_a": [key] * 6000, "s_b": [key] * 6000})
    caught = _Caught()
    jaccard_join.verified(caught, spark.createDataFrame([(1, b"")], "key long, s binary"), 80)
    assert _peak(caught.tasks[0], [rows]) < 0.1 * rows.nbytes


def test_rows_of_a_frequent_shingle_are_not_held():
    caught = _Caught()
    jaccard_join.shared_rows(caught)
    read = []

    def batches():
        for i in range(50):
            read.append(i)
            yield pa.RecordBatch.from_pydict({"shingle": [5] * 4, "key": [4 * i, 4 * i + 1, 4 * i + 1, 4 * i + 2], "m": [i] * 4})

    out = caught.tasks[0](batches())
    first = next(out)
    assert len(read) == 1
    got = [x for b in [first, *out] for x in b.column("key").to_pylist()]
    assert got == [k for i in range(50) for k in (4 * i, 4 * i + 1, 4 * i + 2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_rows_over_any_batches(seed):
    rng = random.Random(seed)
    rows = sorted((rng.randrange(12), rng.randrange(6), 0) for _ in range(40))
    caught = _Caught()
    jaccard_join.shared_rows(caught)
    cuts = [0, *sorted(rng.sample(range(len(rows)), 9)), len(rows)]
    batches = [pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in rows[a:b]], pa.int64()) for i, c in enumerate(("shingle", "key", "m"))}) for a, b in zip(cuts, cuts[1:])]
    got = [tuple(r.values()) for b in caught.tasks[0](iter(batches)) for r in b.to_pylist()]
    distinct = sorted(set(rows))
    assert got == [r for r in distinct if sum(x[0] == r[0] for x in distinct) > 1]


def test_a_set_larger_than_the_buffer(spark, monkeypatch):
    """Full buffers and sets that are larger than one are shipped as they are."""
    rows = made_up(6)
    want = classes(spark, rows)
    monkeypatch.setattr(jaccard_join, "FLUSH", 50)
    monkeypatch.setattr(jaccard_join, "RETURNED", 500)
    assert classes(spark, rows) == want == brute(rows)
