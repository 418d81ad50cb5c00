"""Token store, piece encoding and packing against the tokenizer libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from hotbeat.llm import packing, pieces, token_store
from hotbeat.llm.chunk_bpe import encoder

WORD, BYTE, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, ids string, start long, n long, h string, k string, occ int, shard string"
EXTRA = ("x", 1, 2, "h", "k", 3, "s")
TEXTS = [(5, "The quick brown fox. Jumps over!\nthe lazy dog, isn't it?"), (2, None), (3, ""), (4, "  two  blanks "), (None, "no id"),
         (9, "word " * 30_000), (5, "The quick brown fox. Jumps over!\nthe lazy dog, isn't it?"), (5, "same id, other text"),
         (7, "日本 œuvre 🙂 \x1c É ²½ <|endoftext|>"), (8, "x" * 3000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


@pytest.mark.parametrize("path,kind", [(WORD, "word"), (BYTE, "byte")])
def test_encoder_equals_library(path, kind):
    e = encoder(path, kind)
    rng = random.Random(3)
    latin, plain = [chr(i) for i in range(1, 256)], "abcdefghijklmnopqrstuvwxyz  ,.'0"
    texts = [t or "" for _, t in TEXTS] + ["".join(rng.choices(latin, k=60)) for _ in range(400)] + ["".join(rng.choices(plain, k=150)) for _ in range(400)]
    for t in texts:
        assert e.encode(t).tolist() == e.library.encode(t, add_special_tokens=False).ids


def expected_store(rows):
    e = encoder(WORD, "word")
    start, out = 0, []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = e.library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_store_round_trip(spark):
    df = frame(spark, TEXTS)
    store = token_store.write_store(df, WORD, "word", 2)
    rows = token_store.read_digests(store, token_store.locate(store, df.select("doc_id"))).collect()
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=lambda r: r[1])
    assert got == expected_store(TEXTS)
    absent = spark.createDataFrame([(12345,), (77,)], "doc_id long")
    assert token_store.locate(store, absent).count() == 0
    one = token_store.read_ids(store, token_store.locate(store, spark.createDataFrame([(7,)], "doc_id long"))).collect()
    assert np.frombuffer(one[0]["ids"], "<u2").tolist()[:-1] == encoder(WORD, "word").encode(TEXTS[8][1]).tolist()


def test_store_of_nothing(spark):
    df = frame(spark, [])
    store = token_store.write_store(df, WORD, "word", 2)
    assert token_store.read_digests(store, token_store.locate(store, df.select("doc_id"))).count() == 0


def test_perfect_hash_is_minimal_and_survives_equal_hashes():
    h = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5000)
    h[10] = h[11] = h[12]
    sizes, bits, slots = token_store.build_perfect_hash(h)
    assert sorted(slots) == list(range(5000))
    found = token_store.find_slots(sizes, bits, h)
    apart = np.ones(5000, bool)
    apart[10:13] = False
    assert (found[apart] == slots[apart]).all()


def test_unbroken_text_is_cut_where_no_piece_crosses(monkeypatch):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model = pieces.piece_model(PIECE)
    rng = random.Random(9)
    texts = ["".join(rng.choices("日本語中文漢字かなカナ的一是", k=4000)), "".join(rng.choices("abcdefgh", k=3000)), "the" * 900, "x日" * 800, "\n" * 500 + "é🙂" * 300]
    monkeypatch.setattr(pieces, "MAX_INDEXED", 300)  # windows of 300 characters
    for t in texts:
        assert np.frombuffer(model.encode_batch([t])[0], "<u2").tolist() == sp.encode(t)
    assert not any(len(c) > 300 for c in model.cache)


def test_pieces_equal_library_and_round_trip(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rng = random.Random(4)
    rows = TEXTS + [(100 + i, "".join(rng.choices("etaoinshrdlu  .\n", k=120))) for i in range(200)] + [(900, "a" * 5000), (901, "the" * 700)]
    df = frame(spark, rows)
    got = pieces.decode(pieces.encode(df, PIECE), PIECE).collect()
    assert len(got) == len(rows)
    want = sorted(((k if k is not None else -1), tuple(sp.encode(t or "")), t or "") for k, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, tuple(np.frombuffer(r["ids"], "<u2").tolist()), r["text"]) for r in got) == want
    assert pieces.decode(pieces.encode(frame(spark, []), PIECE), PIECE).count() == 0


def brute_cuts(places, penalties, length):
    n = len(places)
    best = [0] + [None] * (n - 1)
    for j in range(1, n):
        best[j] = min(best[i] + length - (places[j] - places[i]) + penalties[j] for i in range(j) if places[j] - places[i] <= length and best[i] is not None)
    return best[-1]


def test_cuts_are_optimal():
    rng = random.Random(5)
    for _ in range(200):
        places = sorted({0, *(rng.randrange(1, 300) for _ in range(rng.randrange(20, 60)))})
        full = [0]
        for p in places[1:]:
            while p - full[-1] > 40:
                full.append(full[-1] + 40)
            full.append(p)
        penalties = [rng.choice([0, 2, 8]) for _ in full]
        cuts = packing.best_cuts(full, penalties, 40)
        gaps = [full[b] - full[a] for a, b in zip(cuts, cuts[1:])]
        assert max(gaps) <= 40 and cuts[0] == 0 and cuts[-1] == len(full) - 1
        assert sum(40 - g for g in gaps) + sum(penalties[c] for c in cuts[1:]) == brute_cuts(full, penalties, 40)


def check_packing(rows, docs, length=1024):
    """Every id in exactly one piece, sequences without gaps, little padding."""
    e = encoder(BYTE, "byte")
    want = {}
    for k, t in docs:
        want.setdefault(k, []).append([*e.library.encode(t or "", add_special_tokens=False).ids, 0])
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(want)
    for k, texts in want.items():
        pieces_ = sorted(by_doc[k], key=lambda r: (r["sequence_id"], r["offset"]))
        whole = sorted(tuple(t) for t in texts)
        got, current = [], []
        for r in pieces_:
            assert r["start"] == len(current)
            current += np.frombuffer(r["ids"], "<u4").tolist()
            if len(current) == r["doc_tokens"]:
                got.append(tuple(current))
                current = []
        assert not current and sorted(got) == whole
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    used = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        used += at
    return used, len(sequences) * length


def test_packing_edge_cases(spark):
    df = frame(spark, TEXTS)
    check_packing(packing.pack(df.coalesce(1), BYTE, "byte", 0).collect(), TEXTS)
    assert packing.pack(frame(spark, []), BYTE, "byte", 0).count() == 0


def test_packing_over_several_blocks(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    used, room = check_packing(packing.pack(df, BYTE, "byte", 0).collect(), docs)
    assert room < 1.02 * used + 1024
