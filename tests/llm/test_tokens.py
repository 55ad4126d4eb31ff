import random

import numpy as np
import pandas as pd
import pytest
import sentencepiece

from shelfrank.llm import packing as P
from shelfrank.llm import sentencepiece as S

from edge_data import SF

TEXTS = ["", " ", "  Hello  wörld\n日本😀 x ", "\n\n a", "中文测试 \x00\x01é", "  \n  ", "a\n b \nc", "trailing ", "x" * 500,
         "The quick brown fox.\nJumps over it!"]


@pytest.fixture(scope="module")
def model():
    with open(S.MODEL_FILE, "rb") as f:
        return S.UnigramModel(f.read())


@pytest.fixture(scope="module")
def library():
    """The public library on the same pieces and scores, as a unigram model (model type 2 -> 1)."""
    with open(S.MODEL_FILE, "rb") as f:
        raw = f.read()
    at = raw.index(b"\x12\x06tok_v0\x18\x02")
    p = sentencepiece.SentencePieceProcessor()
    p.LoadFromSerializedProto(raw[:at] + b"\x12\x06tok_v0\x18\x01" + raw[at + 10:])
    return p


def total(model, ids):
    """Path score; an unknown character counts once, however many byte pieces it has."""
    text, score = b"", 0.0
    e = S.Encoder(model)
    for i in ids:
        if model.types[i] == S.BYTE:
            b = e.surface[i]
            score += model.unknown_score if b[0] < 0x80 or b[0] >= 0xC0 else 0.0
        else:
            score += model.scores[i]
        text += e.surface[i]
    return score


def test_best_paths_of_words_equal_the_library(model, library):
    words = sorted({w for t in pd.read_parquet(f"{SF}/documents.parquet").text[:40] for w in t.split()})[:1500]
    e = S.Encoder(model)
    for w in words:
        assert e.encode(w).tolist() == library.nbest_encode_as_ids(w, 1)[0], w


def test_by_line_equals_by_pattern_and_texts_come_back(model):
    docs = list(pd.read_parquet(f"{SF}/documents.parquet").text) + TEXTS
    e, slow = S.Encoder(model), S.Encoder(model, remembered=3)
    slow.by_line = False
    for t in docs:
        ids = e.encode(t)
        assert ids.tolist() == slow.encode(t).tolist()
        assert e.decode(ids) == t


def test_whole_text_is_not_beaten_by_the_library(model, library):
    for t in list(pd.read_parquet(f"{SF}/documents.parquet").text[:30]) + TEXTS:
        assert total(model, S.Encoder(model).encode(t).tolist()) >= total(model, library.encode(t)) - 1e-6 * len(t)


def test_units_together_equal_one_by_one(model):
    e = model.open()
    rng = np.random.default_rng(3)
    letters = list("abcdeinorst") + ["é", "日", "😀", "\x00", "ß", "\t", ".", "▁"]
    units = ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(3000)] + ["▁the", "the", "x" * 64, "ￂ"]
    got = e.viterbi_all(units)
    for u, ids in zip(units, got, strict=True):
        assert np.frombuffer(ids, model.width).tolist() == e.viterbi(u), u
    texts = [None, "", " a  b", "the cat\n\nsat on\n", "word " * 70, "y" * 500 + " z", "a ▁ b"]
    plain = [e.encode(t).tolist() for t in texts]
    f = model.open()
    f.limit = 3
    f.prepare(texts)
    assert [f.encode(t).tolist() for t in texts] == plain


def test_double_array_holds_exactly_its_keys():
    rnd = random.Random(4)
    keys = {bytes(rnd.choices(b"abc\xc3\xa9", k=rnd.randrange(1, 7))) for _ in range(400)}
    trie = S.DoubleArray([(k, i) for i, k in enumerate(sorted(keys))])

    def find(key):
        s = 0
        for b in key:
            t = trie.base[s] + b + 1
            if trie.check[t] != s:
                return -1
            s = t
        return int(trie.value[s])

    ordered = sorted(keys)
    for k in keys | {k + b"x" for k in keys} | {k[:-1] for k in keys if len(k) > 1}:
        assert find(k) == (ordered.index(k) if k in keys else -1)


def test_encode_and_decode_edges(spark, edges, nothing, model):
    got = S.encode(edges, model)
    rows = {(r.doc_id, len(r.ids)): r.round_trip for r in got.select("doc_id", "ids", "round_trip").collect()}
    assert rows[(2, 0)] and rows[(3, 0)] and rows[(None, 0)]
    assert [ok for (d, n), ok in rows.items() if d == 10] == [False]        # it holds the marker itself
    back = {r.doc_id: r.text for r in S.decode(got.where("doc_id in (5, 7)"), model).select("doc_id", "text").collect()}
    want = {r.doc_id: r.text for r in edges.where("doc_id in (5, 7)").select("doc_id", "text").collect()}
    assert back == want and S.encode(nothing, model).count() == 0


def brute_bins(lengths, size):
    free = []
    for n in sorted((x for x in lengths if x), reverse=True):
        fit = [k for k, f in enumerate(free) if f >= n]
        if fit:
            free[min(fit, key=lambda k: free[k])] -= n
        else:
            free.append(size - n)
    return sorted(free)


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    size = rnd.choice([1, 7, 8, 16, 100])
    lengths = np.array([rnd.randrange(0, size + 1) for _ in range(rnd.randrange(1, 80))])
    row, start, n = P.best_fit_decreasing(lengths, size)
    used = np.bincount(row, lengths, n).astype(int)
    if lengths.any():
        assert sorted(size - used) == brute_bins(lengths.tolist(), size)
    cells = [(r, s + i) for r, s, k in zip(row, start, lengths) for i in range(k)]
    assert len(set(cells)) == len(cells) and all(s < size for _, s in cells)


def test_byte_bpe_texts_come_back(spark):
    import public_tokenizers
    assert P.PATTERN == public_tokenizers.PATTERN
    e = P.ByteBpe.load(spark).open()
    for t in list(pd.read_parquet(f"{SF}/documents.parquet").text) + TEXTS:
        assert e.decode(e.encode(t)) == t


@pytest.mark.parametrize("kind", ["pieces", "bytes"])
def test_packed_ids_come_back(spark, edges, nothing, model, kind):
    model = model if kind == "pieces" else P.ByteBpe.load(spark)
    packed = P.pack(edges, model, row_length=64, block_tokens=5000).cache()
    for r in packed.collect():
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == len(r.resets) + 1
        assert len(r.ids) == r.n_rows * 64 * 2 and all(s.length <= 64 for s in r.segments)
    got = {}
    for r in P.unpack(packed).orderBy("partition", "block", "offset").collect():
        got.setdefault((r.partition, r.block, r.doc_id), []).append((r.offset, r.ids))
    e = model.open()
    want = sorted([(r.doc_id or 0, e.encode(r.text).tolist()) for r in edges.select("doc_id", "text").collect()], key=str)
    flat = []
    for (_, _, d), parts in got.items():
        copies = sum(o == 0 for o, _ in parts)         # a repeated row stands there twice
        ids = [x for o, p in sorted(parts)[::copies] for x in p]
        flat += [(d or 0, ids)] * copies if d is not None else []
    assert sorted(flat, key=str) == [w for w in want if w[0]]
    assert P.pack(nothing, model).count() == 0
