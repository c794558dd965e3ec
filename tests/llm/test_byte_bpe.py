import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from messy import TEXTS, clashing, docs, rows_of

from ascentframe.llm import byte_bpe as B
from ascentframe.llm.common import table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        digest = lambda x: hashlib.sha256(x).hexdigest()
        out.append((i, len(ids), digest(",".join(map(str, ids)).encode()), digest((text or "").encode())))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_messy_rows(spark, library):
    assert rows_of(B.digests(docs(spark), PATH), *COLUMNS) == expected(library, TEXTS)
    assert B.digests(docs(spark, []), PATH).count() == 0
    whole = B.decode(B.encode(clashing(docs(spark)), PATH), PATH).collect()
    assert all(r.decoded == (r.text or "").encode() and len(r.ids) == len(r.offsets) for r in whole)
    assert len(whole) == len(TEXTS) and whole[0].words == "clash"


def test_given_table(spark, library):
    frame = table(spark, "/root/testdata/sf0.01", "documents")
    assert rows_of(B.digests(frame, PATH), *COLUMNS) == expected(library, [(r.doc_id, r.text) for r in frame.collect()])


def test_random_texts_of_all_symbols(library):
    rng, own = random.Random(7), B.Coder(PATH)
    parts = [" ", "  ", "\n", "\t", "'s", "'re", "'", "''", "'ll", "a", "Zé", "1", "٣", "!", "\u00a0", "\u2003", "😀", "\r\n", "\x1c", "é", "漢字", "'v", "'l", "'ve", "'m", "D"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(5000)]
    ids, offsets, counts = own.encode(texts)
    ends = np.cumsum(counts)[:-1]
    for text, i, o in zip(texts, np.split(ids, ends), np.split(offsets, ends)):
        assert i.tolist() == library.encode_ordinary(text)
        assert own.decode(i, o) == text.encode()


def test_every_code_point_is_classed_like_the_library(library):
    own = B.Coder(PATH)
    points = [chr(k) for k in range(0x20000) if not 0xD800 <= k < 0xE000]
    for k in range(0, len(points), 4096):
        text = "a".join(points[k : k + 4096])
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_long_slices(library):
    own = B.Coder(PATH)
    for text in ("a" * 3000, "ab'" * 1000, " " * 3000 + "x", "é漢" * 700):
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text)
