import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from messy import TEXTS, clashing, docs, rows_of
from pyspark.sql import functions as F

from ascentframe.llm import sentencepiece_bpe as S
from ascentframe.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_mended"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode(text or "")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)), 0))
    return sorted(out, key=repr)


def test_messy_rows(spark, library):
    assert rows_of(S.digests(docs(spark), PATH), *COLUMNS) == expected(library, TEXTS)
    assert S.digests(docs(spark, []), PATH).count() == 0
    whole = S.decode(S.encode(clashing(docs(spark)), PATH), PATH).collect()
    assert all(r.decoded == (r.text or "") and r.ids == library.encode(r.text or "") and r.n_mended == 0 for r in whole)
    assert len(whole) == len(TEXTS) and whole[0].words == "clash"


def test_given_table(spark, library):
    frame = table(spark, "/root/testdata/sf0.01", "documents")
    assert rows_of(S.digests(frame, PATH), *COLUMNS) == expected(library, [(r.doc_id, r.text) for r in frame.collect()])


PARTS = [" ", "  ", "\n", "\n\n", "\t", "▁", "▁▁", "a", "the", " the", "ing", "é", "漢", "字", "😀", "\r\n", "\x00", "<s>", "<0x0A>", "ﬁ", "Ａ", "0", "1", "...", "​", "�", "in", "er", "tion", "ḿ"]


def test_random_texts(library):
    rng, own = random.Random(3), S.Coder(PATH)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(5000)]
    ids, counts, mended = own.encode(texts)
    for text, i, back in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), own.decode(ids, counts)):
        assert i.tolist() == library.encode(text)
        assert back == library.decode(i.tolist())
    assert not mended.any()


def test_agenda_alone_gives_the_library_ids(library):
    """Without the check behind it, for short texts (list) and long ones (heap)."""
    rng, own = random.Random(4), S.Coder(PATH)
    for size in [rng.randrange(1, 30) for _ in range(300)] + [500, 3000]:
        text = "".join(rng.choice(PARTS) for _ in range(size))
        assert own.ids_of(S.BLANK + text.replace(" ", S.BLANK)) == library.encode(text)
    for text in ("a" * 3000, " " * 3000 + "x", "漢字é" * 700):
        assert own.encode([text])[0].tolist() == library.encode(text)


def test_a_wrong_agenda_is_mended_and_counted(library):
    own = S.Coder(PATH)
    own.ranks = {}  # nothing is ever joined
    ids, counts, mended = own.encode(["the thing", "x"])
    assert ids.tolist() == library.encode("the thing") + library.encode("x")
    assert mended.tolist() == [2, 1]


def test_random_ids_are_decoded_like_the_library(library):
    rng, own = random.Random(5), S.Coder(PATH)
    some = [0, 1, 2, 259, 28705, 13, 264, *(3 + b for b in (0xE9, 0xBC, 0xA1, 0xF0, 0xBF))]
    runs = [[rng.choice([*some, rng.randrange(32_000)]) for _ in range(rng.randrange(9))] for _ in range(5000)]
    texts = own.decode(np.array([i for r in runs for i in r], np.int64), np.array(list(map(len, runs))))
    assert texts == [library.decode(r) for r in runs]


def test_null_ids(spark):
    rows = spark.createDataFrame([(1, [264]), (2, []), (3, None)], "doc_id long, ids array<int>").withColumn("decoded", F.lit(9))
    assert rows_of(S.decode(rows, PATH), "doc_id", "decoded") == [(1, "a"), (2, ""), (3, None)]
