import hashlib
import random

import pytest

from papervein.llm import pieces
from papervein.llm.queries import PIECES, op13_sentencepiece, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))


def digest(library, text):
    ids = library.encode(text or "")
    joined = ",".join(map(str, ids))
    return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op13_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts)
    assert all(tuple(r)[1:] == digest(library, texts[r.doc_id]) for r in rows)


def test_odd_documents(spark, library, odd_documents):
    model = tokenizer_path(PIECES)
    texts = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    rows = pieces.digest(pieces.decode(pieces.encode(odd_documents, model), model)).collect()
    assert sorted(rows, key=str) == sorted(pieces.digest(pieces.encode(odd_documents, model, True)).collect(), key=str)
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in rows) == sorted((str(i), *digest(library, t)) for i, t in texts)


def test_empty(spark, no_documents):
    model = tokenizer_path(PIECES)
    assert pieces.digest(pieces.decode(pieces.encode(no_documents, model), model)).count() == 0


@pytest.mark.parametrize("alphabet", [
    "ab", "aeiourstnlhdc  ", "▁ a", "  \t\n.", "中文字é́ÿ🙂 ", "0123456789 -_", "xX<>s/unk|", "\x00\x01 �퟿", "\ue000\ue001\ue002a ",
])
def test_encoding_is_the_librarys(library, alphabet):
    rng = random.Random(alphabet)
    own = pieces.codec(tokenizer_path(PIECES))
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))
        assert own.encode(text).tolist() == library.encode(text)


def test_long_runs_without_spaces(library):
    own = pieces.codec(tokenizer_path(PIECES))
    rng = random.Random(5)
    for text in ("x" * 20_000, "ab" * 10_000, " " * 5000, "中" * 9000, "\ue000" * 9000 + "ab" * 9, "".join(rng.choice("abcdefghij") for _ in range(50_000))):
        assert own.encode(text).tolist() == library.encode(text)


def test_every_piece_and_pair_of_pieces(library):
    """The text of each piece, and of pieces side by side, is encoded as the library does."""
    own = pieces.codec(tokenizer_path(PIECES))
    rng = random.Random(6)
    known = list(own.ids)
    for piece in known:
        assert own.encode(piece.replace("▁", " ")).tolist() == library.encode(piece.replace("▁", " "))
    for _ in range(5000):
        text = rng.choice(known) + rng.choice(known) + rng.choice(known)
        assert own.encode(text).tolist() == library.encode(text)


def test_decoding_of_any_ids(library):
    own = pieces.codec(tokenizer_path(PIECES))
    rng = random.Random(7)
    for _ in range(20_000):
        ids = [
            rng.choice((rng.randrange(32_000), rng.randrange(3, 259), rng.choice((0, 1, 2, 259, 260, 28705)))) for _ in range(rng.randrange(9))
        ]
        assert own.decode(ids) == library.decode(ids)


def test_backtracking_gives_up_pieces(library):
    """The longest pieces alone are often wrong; the test texts do exercise the way back."""
    own = pieces.codec(tokenizer_path(PIECES))
    rng = random.Random(8)
    greedy = 0
    for _ in range(500):
        text = "▁" + "".join(rng.choice("aeiourstnlhdc") for _ in range(30))
        out, at = [], 0
        while at < len(text):
            size = next(n for n in range(min(16, len(text) - at), 0, -1) if n == 1 or text[at : at + n] in own.ids)
            out.append(text[at : at + size])
            at += size
        greedy += out != own.pieces(text)
        assert own.pieces(text) == own.merged(text)
    assert greedy > 100


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer_path(PIECES), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.byte_fallback = False
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Codec(str(tmp_path / "other.model"))
