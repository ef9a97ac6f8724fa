import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import sentencepieces as S

from .helpers import ODD_TEXTS, TOK, documents, empty_documents, odd_documents

MODEL = f"{TOK}/piece_bpe_32k.model"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PIECES = S.Pieces(MODEL)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcde th  \n\té日😀▁", max_size=40), st.integers(0, 5), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_any_rate_is_lossless(text, key, rate):
    assert PIECES.decode(PIECES.encode([text], [key], rate, 3)[0]) == text


def test_rate_zero_is_the_models_own_segmentation(spark):
    texts = [r["text"] for r in documents(spark).collect()] + [t for t in ODD_TEXTS if t and "▁" not in t and "\x00" not in t]
    for text, ids in zip(texts, PIECES.encode(texts, list(range(len(texts))), 0.0, 1)):
        assert ids.tolist() == LIBRARY.encode(text)


def test_long_words_follow_the_same_rule(monkeypatch, spark):
    texts = [r["text"] for r in documents(spark).limit(20).collect()]
    keys = list(range(len(texts)))
    a = PIECES.encode(texts, keys, 0.2, 1)
    monkeypatch.setattr(S, "LONG", 3)
    b = PIECES.encode(texts, keys, 0.2, 1)
    monkeypatch.setattr(S, "SIDE_BY_SIDE", 50)
    c = PIECES.encode(texts, keys, 0.2, 1)
    assert all(np.array_equal(x, y) and np.array_equal(x, z) for x, y, z in zip(a, b, c))


def test_dropout_depends_on_seed_and_document_only():
    text = "the quick brown fox jumps over the lazy dog " * 20
    a = PIECES.encode([text, text], [1, 2], 0.1, 7)
    assert not np.array_equal(a[0], a[1])
    assert np.array_equal(a[1], PIECES.encode([text], [2], 0.1, 7)[0])
    assert not np.array_equal(a[0], PIECES.encode([text], [1], 0.1, 8)[0])
    assert len(PIECES.encode([text], [1], 1.0, 7)[0]) == len(text) + 1


def test_share_of_skipped_merges():
    words = " ".join(["in"] * 4000)
    ids = PIECES.encode([words], [5], 0.1, 1)[0]
    whole = PIECES.encode([words], [5], 0.0, 1)[0]
    kept = np.isin(ids, whole).sum() / len(whole)
    assert 0.7 < kept < 0.95


def test_query_rows(spark):
    for docs in (documents(spark), odd_documents(spark)):
        rows = S.encode_documents(docs, MODEL).collect()
        assert len(rows) == docs.count() and all(r["lossless"] for r in rows)
        assert all(r["n_ids"] == len(r["ids"]) for r in rows)
    assert S.encode_documents(empty_documents(spark), MODEL).count() == 0
