import random

import numpy as np
import pytest
import sentencepiece

from siftworks.llm import sentencepiece_codec as sc
from siftworks.llm.queries import TOKENIZER

HARD = ["a  b   c", "  x", "x  ", "\n\n a\n", "😀 é ﬁ Ｆ", "a" * 40, "", "1234567890" * 30, " ", "   ", "\t\ttab", "ﷺ x", "你好 世界 안녕", "<s> </s> <unk> <0x41>", "=" * 30, "x" * 300]


@pytest.fixture(scope="module")
def model():
    return sc.load_vocabulary(TOKENIZER)


def test_ids_are_those_of_the_library(spark, model):
    draw = random.Random(1)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + HARD
    texts += ["".join(draw.choice(["a", "th", "e", " ", "  ", "=", "-", "ing", "1", "\n", "é", "ö"]) for _ in range(150)) for _ in range(150)]
    want = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER).encode(texts, num_threads=1)
    got = [g.tolist() for g in model.encode(texts)]
    assert got == want and [model.decode(g) for g in got] == texts
    assert all(model._final(model._one(sc._whole(w))) == ids for w, ids in list(model.memo.items())[::50])


def brute_unigram(v, word):
    best = {0: (0.0, [])}
    for i in range(1, len(word) + 1):
        found = []
        for j in range(i):
            piece = word[j:i]
            if piece in v.ids:
                found.append((best[j][0] + v.scores[v.ids[piece]], best[j][1] + [v.ids[piece]]))
            elif i - j == 1:
                found.append((best[j][0] + v.unknown_score, best[j][1] + [len(v.pieces) + ord(piece)]))
        best[i] = max(found, key=lambda f: round(f[0], 9))
    return best[len(word)][0]


def test_unigram_scores():
    draw = random.Random(2)
    pieces = ["<unk>", *sorted({"".join(draw.choice("ab▁") for _ in range(draw.randrange(1, 5))) for _ in range(40)})]
    v = sc.Vocabulary(pieces, [0.0, *(-draw.random() * 9 for _ in pieces[1:])], [False] + [True] * (len(pieces) - 1), [], 0, True, False)
    words = ["".join(draw.choice("abc") for _ in range(9)) for _ in range(60)]
    total = lambda ids: sum(v.scores[i] if i < len(pieces) else v.unknown_score for i in ids)
    for word, found in zip(words, v._same_length(words)):
        assert abs(total(found) - brute_unigram(v, word)) < 1e-9 and abs(total(v._one(word)) - total(found)) < 1e-9
        assert "".join(v.text_of(i) for i in found) == word


def test_tables(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "▁x y", "c"), (3, "▁x y", "c"), (4, "word " * 30_000, None)], "doc_id long, text string, ids string")
    got = sc.encode_documents(docs, TOKENIZER, rows=True)
    assert got.columns == ["doc_id", "text", "ids", "_ids", "n_tokens", "round_trip"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == 0 and rows[1]["round_trip"] and not rows[3]["round_trip"] and rows[4]["round_trip"] and rows[1]["ids"] == "a"
    back = {r["doc_id"]: r["decoded"] for r in sc.decode_ids(sc.encode_documents(docs, TOKENIZER), TOKENIZER).collect()}
    assert back[4] == "word " * 30_000 and back[3] == " x y" and back[2] == ""
    assert sc.encode_documents(docs.limit(0), TOKENIZER).count() == 0


def test_keys_are_found_by_their_slots():
    v = sc.load_vocabulary(TOKENIZER)
    wanted = np.array([sc._hash(p) for p in list(v.ids)[::3]], np.uint64)
    absent = wanted ^ np.uint64(1 << 40)
    at, hit = v._find(np.concatenate([wanted, absent]), v._slot(np.concatenate([wanted, absent])))
    assert hit[:len(wanted)].all() and v.key_ids[at[:len(wanted)]].tolist() == list(v.ids.values())[::3]
    assert hit[len(wanted):].tolist() == [k in set(v.keys.tolist()) for k in absent.tolist()]
    assert v.shared.sum() < 0.02 * len(v.keys)
