"""Counts against the tokenizer's own library."""

import public_tokenizers
from conftest import DATA
from helpers import no_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracklane.llm import common, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "<|ENDOFTEXT|>", "İstanbul ΣΑΣ ß", "e\u0301 e\u0301x", "12 345", "don't I'LL they've", "\u00a0x\u2003y\u3000z", "日本語テキスト 한국어", "👩‍👩‍👧 ok", "\x00\x01 \x7f", "a\u0085b", "ﬁ ǅ", "x" * 3000]


def check(spark, df):
    got = token_counts.count_tokens(df, PATH).collect()
    texts = {(r.doc_id, r.text or "") for r in df.collect()}
    want = sorted(((i is None, i or 0), len(t.encode()), n := len(LIBRARY.encode(t, add_special_tokens=False).ids), n > 2048) for i, t in texts)
    assert sorted({((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in got}) == want
    assert len(got) == df.count()


def test_documents_and_odd_texts(spark):
    check(spark, common.table(spark, f"{DATA}/sf0.01", "documents", "doc_id", "text"))
    check(spark, odd_docs(spark, *ODD))
    assert token_counts.count_tokens(no_docs(spark), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    import pyarrow as pa

    words, _ = common.split_words(pa.array([text]))
    assert sum(map(token_counts.counter(PATH).count, words.to_pylist())) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x500), st.sampled_from("abcst'.,<|>09éЯ")), max_size=40))
def test_pieces_of_any_text(text):
    import pyarrow as pa

    words, _ = common.split_words(pa.array([text]))
    counts, begin, size = token_counts.piece_counts(PATH).of(words)
    assert sum(int(counts[b : b + n].sum()) for b, n in zip(begin, size, strict=True)) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_memory_of_pieces_may_run_out(monkeypatch):
    import pyarrow as pa

    from tracklane.llm import word_pieces

    monkeypatch.setattr(word_pieces, "CACHE_PIECES", 5)
    own = word_pieces.Pieces(PATH, token_counts.counter(PATH).values)
    for text in ("the cat, sat", "on a mat. the", "cat don't", "日本 the cat"):
        words, _ = common.split_words(pa.array([text]))
        counts, begin, size = own.of(words)
        assert sum(int(counts[b : b + n].sum()) for b, n in zip(begin, size, strict=True)) == len(LIBRARY.encode(text, add_special_tokens=False).ids)
