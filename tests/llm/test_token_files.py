import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import TEXTS, docs, rows_of
from tokenizers import Tokenizer

from ascentframe.llm import token_files as T
from ascentframe.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.just(0), st.integers(0, 1), st.integers(0, 500), st.integers(0, 49407), st.integers(0, 2**64 - 1), st.sampled_from([T.MARK, T.MARK - 1, T.MARK + 1])), max_size=600), st.integers(0, 400))
@settings(max_examples=150, deadline=None)
def test_words_round_trip(values, zeros):
    values = np.array(values + [0] * zeros + values[:50], np.uint64)
    words, escapes = T.pack(values)
    assert (T.unpack(words, escapes, len(values)) == values).all()


def greedy(values):
    words, k = 0, 0
    while k < len(values):
        for n, w in zip(T.COUNTS.tolist(), T.WIDTHS.tolist()):
            if all(v < 1 << w for v in values[k : k + n]):
                k, words = k + n, words + 1
                break
    return words


def test_as_few_words_as_greedy_packing():
    rng = np.random.default_rng(1)
    for limit in (1, 2, 30, 1000, 49408):
        values = rng.integers(0, limit, 2000)
        assert len(T.pack(values)[0]) == greedy(values.tolist())


def library_ids(rows):
    own = Tokenizer.from_file(PATH)
    return [(i, [*own.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def expected(rows):
    out, start = [], 0
    for i, ids in library_ids(sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, (r[1] or "").encode()))):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def written(spark, frame, folder):
    T.write(frame, PATH, folder)
    return rows_of(T.digests(T.read(spark, folder)), "doc_id", "start", "n_tokens", "ids_crc32")


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_messy_rows(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK_IDS", block)
    odd = [(40, "a <|endoftext|> b"), (41, "<|STARTOFTEXT|>x|><|startoftext|>"), (42, "x\x1cy\x1f z\x85w\u2028v"), (43, "caf\u00e9, caf\u00e9\u2026 end' it's. \u3042\u3002")]
    odd += [(30, "ä b\u0301 J\u030c"), (31, "don't  'S x\t\ty z\u00a0\u3000q İSTANBUL ΣΑΣ Σ"), (32, "end. and, so... on!?. a1. B,")]
    rows = [*TEXTS, *odd]
    assert written(spark, docs(spark, rows), str(tmp_path / "a")) == expected(rows)
    assert written(spark, docs(spark, []), str(tmp_path / "b")) == []


PIECES = ["a", "The", "é", "É", "ß", "straße", "ÿ.", "x,", "...", "'s", "'", "don't", "_", "b_", "1", "2nd", "漢字", "。", "\u0301", "\u0300", "J\u030c", "\u3099", "İ", "Σ", "ς",
          " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\u00a0", "\u2003", "\u2028", "\u3000", "\u200b", "😀", "|>", "<|", "<|endoftext|>", "<|STARTOFTEXT|>", "K", "Å"]


def test_random_texts_like_the_library():
    rng, own, library = random.Random(9), T.WordCoder(PATH), Tokenizer.from_file(PATH)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(25))) for _ in range(8000)]
    for k in range(0, len(texts), 1000):
        ids, lengths = own.encode(texts[k : k + 1000])
        for text, i in zip(texts[k : k + 1000], np.split(ids, np.cumsum(lengths)[:-1])):
            assert i.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_given_table(spark, tmp_path):
    frame = table(spark, "/root/testdata/sf0.001", "documents")
    assert written(spark, frame.repartition(5), str(tmp_path / "a")) == expected([(r.doc_id, r.text) for r in frame.collect()])
