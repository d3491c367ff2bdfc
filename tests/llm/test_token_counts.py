import pytest
from helpers import STRANGE, documents
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from stowage.llm import token_counts as T


def exact(pieces):
    tokenizer = Tokenizer(models.Unigram(list(pieces), unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids) if text else 0


BYTES = [(f"<0x{k:02X}>", 0.0) for k in range(256)]
# Many sums are equal here.
TIES = [("<unk>", 0.0), *BYTES, ("▁", -2.0), ("▁a", -3.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -2.0), ("ab", -3.0),
        ("ba", -3.0), ("aab", -4.0), ("bb", -4.0), ("▁aab", -7.0), ("é", -3.0)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aabbcé▁ 日", max_size=30))
def test_ties(text):
    count, tokens = T.Counter(TIES).count, exact(TIES)
    assert sum(map(count, T.words(text))) == tokens(text)


@pytest.fixture(scope="module")
def whole():
    return exact(T.vocabulary())


def test_documents(spark, sf_dir, whole):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    from stowage.llm.queries import op7_tokens

    rows = op7_tokens(spark, sf_dir).collect()
    assert len(rows) == len(texts) and all(r.n_tokens == whole(texts[r.doc_id]) for r in rows)


def test_strange_texts(spark, whole):
    docs = documents(spark, STRANGE).withColumnRenamed("node", "n_tokens")
    rows = T.token_counts(docs).collect()
    assert sorted((r.n_tokens for r in rows)) == sorted(whole(t) for _, t in STRANGE) and len(rows) == len(STRANGE)
    assert T.token_counts(documents(spark, [])).collect() == []


def unsplit(pieces):
    """The model over the whole text at once."""
    tokenizer = Tokenizer(models.Unigram(list(pieces), unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids) if text else 0


SPACES = [*TIES, ("▁▁", -3.0), ("▁▁▁", -6.0), ("▁▁▁▁", -5.0), ("▁▁a", -4.0)]
UNSPLIT, RUNS = unsplit(T.vocabulary()), T.Counter(T.vocabulary())
UNSPLIT_TIES, RUNS_TIES = unsplit(SPACES), T.Counter(SPACES)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab▁    é\n", max_size=40))
def test_runs_of_spaces(text):
    assert sum(map(RUNS_TIES.count, T.words(text))) == UNSPLIT_TIES(text)
    assert sum(map(RUNS.count, T.words(text))) == UNSPLIT(text)


def test_indented_text(spark):
    texts = ["if x:\n    return 1", "a   b", "a" + " " * 40 + "b  ", "    ", "  def f(x):\n        return  x\n"]
    rows = T.token_counts(documents(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {k: UNSPLIT(t) for k, t in enumerate(texts)}
    assert [UNSPLIT(t) for t in texts[:2]] == [9, 3]


def test_pieces_that_go_on_after_a_space(spark, monkeypatch):
    pieces = (*TIES, ("a▁b", -1.0))
    monkeypatch.setattr(T, "vocabulary", lambda path: pieces)
    rows = T.token_counts(documents(spark, [(0, "a b a  b"), (1, None)])).collect()
    assert {r.doc_id: (r.n_tokens, r.n_words) for r in rows} == {0: (unsplit(pieces)("a b a  b"), 5), 1: (0, 0)}
