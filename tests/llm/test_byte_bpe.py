"""Matrix BPE against the tiktoken library over the same rank file."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from hotbeat.llm import matrix_bpe
from hotbeat.llm.matrix_bpe import MatrixBpe

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, k string, t string, decoded int"
EXTRA = ("x", "k", "t", 3)


@pytest.fixture(scope="module")
def model():
    return MatrixBpe(MULTI)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def odd_texts(model):
    rng = random.Random(1)
    pools = ["abcdefghij '  \n", "".join(map(chr, range(1, 3000))), "日本語中文漢字かなカナ한국어 ", "0123456789 .,!?'sdt",
             "".join(sorted(model.splitter.disputed)[::50]) + "ab 1"]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randint(0, 120))) for _ in range(3000)]
    return texts + ["", " ", "a" * 5000, "the" * 2000, "".join(rng.choices("abcdefghijklmnop", k=20_000)), "日本語" * 3000, " " * 3000,
                    "\n\n \t" * 700, "<|endoftext|>", "word " * 30_000, "\x00\x1c\x85 x"]


def test_ids_equal_library_and_round_trip(model, library):
    texts = odd_texts(model)
    got = [g for i in range(0, len(texts), 250) for g in model.encode(texts[i:i + 250])]
    for t, g in zip(texts, got):
        assert ids(g) == library.encode_ordinary(t)
        assert model.decode(g) == t.encode()


def test_matrix_and_long_rows_merge_alike(model, monkeypatch):
    rng = random.Random(2)
    rows = ["".join(rng.choices("etaoinshrd日本", k=rng.randint(2, 300))).encode() for _ in range(200)]
    plain = model.encode_chunks(rows)
    monkeypatch.setattr(matrix_bpe, "WIDEST", 1)  # every row is cut and merged by the heap
    assert all((a == b).all() for a, b in zip(plain, model.encode_chunks(rows)))
    monkeypatch.setattr(matrix_bpe, "WIDEST", 1024)
    monkeypatch.setattr(matrix_bpe, "CELLS", 64)  # many small matrices
    assert all((a == b).all() for a, b in zip(plain, model.encode_chunks(rows)))


def test_pair_table_finds_every_pair_and_no_other(model):
    ranks = model.ranks
    known = {(ranks[t[:k]], ranks[t[k:]]): i for t, i in list(ranks.items())[::7] for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
    left, right = np.array(list(known)).T
    assert model.pairs.ranks(left, right).tolist() == list(known.values())
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, len(ranks), (2, 5000))
    want = [ranks.get(model.tokens[x] + model.tokens[y], matrix_bpe.NONE) for x, y in zip(a.tolist(), b.tolist())]
    assert model.pairs.ranks(a, b).tolist() == want
    assert (model.pairs.ranks(np.array([-1, 5]), np.array([5, -1])) == matrix_bpe.NONE).all()


def test_unbroken_text_of_a_million_letters(model, library):
    text = "".join(random.Random(3).choices("abcdefghijklmnop", k=1_000_000))
    assert ids(model.encode([text])[0]) == library.encode_ordinary(text)


def test_long_documents_are_split_in_parts(model, library, monkeypatch):
    monkeypatch.setattr(matrix_bpe, "TOGETHER", 10)
    monkeypatch.setattr(matrix_bpe, "MATCHES", 3)
    for t in ["It's  a   longer text,\n\n with 12 blanks ... ", "日本 ՘ x" * 9, "՘'ll 've'd Ꟑa" * 4]:
        assert ids(model.encode([t])[0]) == library.encode_ordinary(t)


def test_rows_of_a_table(spark, library):
    rows = [(1, "The quick brown fox"), (2, None), (3, ""), (None, "no id"), (1, "The quick brown fox"), (1, "same id"), (4, "日本 🙂 " * 500),
            (5, "plain words " * 100_000)]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    out = matrix_bpe.decode(matrix_bpe.encode(df, MULTI), MULTI).collect()
    got = sorted((str(r["doc_id"]), ids(r["ids"]), bytes(r["decoded"])) for r in out)
    assert got == sorted((str(k), library.encode_ordinary(t or ""), (t or "").encode()) for k, t in rows)
    assert matrix_bpe.decode(matrix_bpe.encode(df.where("1 = 0"), MULTI), MULTI).count() == 0


def test_broken_ids_decode_to_null_and_broken_text_is_replaced(spark):
    df = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\xff")), (2, bytearray(b"abc")), (3, None), (4, bytearray())], "doc_id long, ids binary")
    assert {r["doc_id"]: r["decoded"] for r in matrix_bpe.decode(df, MULTI).collect()} == {1: None, 2: None, 3: None, 4: b""}
    bad = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert bytes(matrix_bpe.decode(matrix_bpe.encode(bad, MULTI), MULTI).first()["decoded"]) == "a�b".encode()


def test_query_on_the_table(spark, library):
    import pyarrow.parquet as pq

    from hotbeat.llm.queries import QUERIES

    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op12_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    want = {}
    for k, text in zip(t["doc_id"], t["text"]):
        i = library.encode_ordinary(text or "")
        want[k] = (len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert got == want
