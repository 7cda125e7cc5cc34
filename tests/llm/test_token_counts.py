import uuid

import pyarrow as pa
import pytest

from papervein.llm import token_counts, tokens
from papervein.llm.queries import tokenizer_path
from papervein.llm.shared import shared_folder

SF = "/root/testdata/sf0.001"


@pytest.fixture
def cache(spark):
    return f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}"


def library_count(path, text):
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)
    import sentencepiece

    return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))


def test_query(spark):
    from papervein.llm.queries import op10_token_counts

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rows = op10_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert tuple(r)[1:] == (len((texts[r.doc_id] or "").encode()), n, n > 512)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_odd_documents(spark, odd_documents, cache, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    texts = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    rows = token_counts.count_tokens(odd_documents, path, cache).collect()
    expected = [(str(i), len((t or "").encode()), library_count(path, t)) for i, t in texts]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == sorted(expected)


def test_only_misses_are_encoded(spark, cache):
    path = tokenizer_path()
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "doc_id long, text string")
    token_counts.count_tokens(first, path, cache).count()
    assert spark.read.parquet(cache).count() == 2
    second = spark.createDataFrame([(4, "a b"), (5, "new text"), (6, "")], "doc_id long, text string")
    counts = token_counts.count_tokens(second, path, cache)
    assert spark.read.parquet(cache).count() == 3
    assert {r.doc_id: r.n_tokens for r in counts.collect()} == {4: 2, 5: 2, 6: 0}
    # A stored count is taken as it is; another tokenizer does not see it.
    version = tokens.version_digest(path)
    assert spark.read.parquet(cache).select("tokenizer").distinct().collect() == [(version,)]
    import public_tokenizers

    other = public_tokenizers.path("piece_bpe_32k.model")
    token_counts.count_tokens(second, other, cache).count()
    assert spark.read.parquet(cache).count() == 6


def test_empty(spark, no_documents, cache):
    assert token_counts.count_tokens(no_documents, tokenizer_path(), cache).count() == 0


def test_repeated_rows_are_encoded_once(spark, cache):
    """Rows that repeat an id and its text, and rows without id, give one stored count a text."""
    rows = [(7, "the same text")] * 300 + [(None, "without id")] * 200 + [(8, "another"), (None, "another")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    counts = token_counts.count_tokens(docs, tokenizer_path(), cache).collect()
    assert len(counts) == len(rows) and spark.read.parquet(cache).count() == 3

    class Counting:
        calls = 0

        def ids(self, text):
            self.calls += 1
            return bytes(4 * len(text))

    encoder = Counting()
    batches = [pa.RecordBatch.from_pydict({"digest": [b"a", b"b", b"a"], "text": ["x", "yy", "x"]})] * 5
    out = pa.Table.from_batches(token_counts.count_once(encoder, iter(batches)))
    assert encoder.calls == 2 and out.to_pydict() == {"digest": [b"a", b"b"], "n_tokens": [1, 2]}


def test_unseen_pre_tokens_go_to_the_model(monkeypatch):
    """Plain texts never take the slow way of the whole library, and their ids are its own."""
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(tokenizer_path()), tokens.Encoder(tokenizer_path())

    def refused(self, texts):
        raise AssertionError(texts)

    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    monkeypatch.setattr(tokens.Encoder, "_library_ids", refused)
    letters = "".join(chr(c) for c in [*range(9, 14), *range(32, 127), *range(0xC0, 0x250)]) + "‐‧‰⁞€"
    texts = [letters, " ".join(letters), "it's  we'll\n\n x1 22 ÀÉé ſƀ ǅ \t ", *(f"w{k} ünïcode{k}'s  {k}€" for k in range(60)), ""]
    for text in texts * 2:
        assert encoder.ids(text) == b"".join(i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids)
