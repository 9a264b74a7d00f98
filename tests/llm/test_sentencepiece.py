import random

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from blotterflow.llm.pieces import Codec, Model
from blotterflow.llm.sentencepiece_codec import encode_decode

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = "a|b|er|in| |  |   |\n|\t|é|😀|1|23|the|(|_|==|----|\0|▁|中|ß|http|://|​|ﷺ|\r\n| the|ing|A|xx|０".split("|")


@pytest.fixture(scope="module")
def codec():
    return Codec(Model(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_texts(codec, library):
    pick = random.Random(1)
    for _ in range(3000):
        text = "".join(pick.choice(PARTS) for _ in range(pick.randrange(40)))
        ids = library.encode(text)
        assert codec.encode(text).tolist() == ids
        assert codec.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_runs(codec, library):
    for n in range(1, 120):
        for part in (" ", "a", "=-", "\n", "ab"):
            for text in (part * n, f"x{part * n}y"):
                assert codec.encode(text).tolist() == library.encode(text)


def test_any_ids_decode(codec, library):
    pick = random.Random(2)
    for _ in range(3000):
        ids = [pick.choice([pick.randrange(32000), pick.randrange(260), 28705, 259]) for _ in range(pick.randrange(9))]
        assert codec.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_column(spark, library):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x" * 50_000), (5, "word é " * 30_000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, IDS int")
    out = encode_decode(df, PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for r in out.collect():
        ids = library.encode(r.text or "")
        assert list(r.ids) == ids and r.decoded == library.decode(ids) == (r.text or "")
    assert encode_decode(df.limit(0), PATH).count() == 0
