import math

import numpy as np
import pytest

from docweave.llm import pieces

TEXTS = [
    "Hello world", "Hello  world\nfoo é 漢\t x", "", None, " a  b ", "💩💩 日本語", "ﬀ ▁ x", "x" * 5000,
    "The the THE", "don't stop", "a\u0000b", "tail  ",
]


def as_unigram(scores):
    """The library's own Viterbi over the same pieces and scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = pb.ModelProto()
    with open(pieces.default_model(), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    table = pieces.vocabulary(pieces.default_model(), scores)
    for i, score in zip(table.ids.tolist(), table.scores.tolist(), strict=True):
        model.pieces[i].score = score
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_words_score_as_well_as_the_library_finds():
    library = as_unigram("rank")
    encoder = pieces.Encoder(pieces.default_model(), "rank")
    table = encoder.pieces
    score = dict(zip(table.ids.tolist(), table.scores.tolist(), strict=True))
    words = [w for t in TEXTS if t for w in t.split() if w.isascii() and "\0" not in w] + ["internationalization", "tokenizers"]
    for word, ids in zip(words, encoder.encode(words), strict=True):
        ours, theirs = np.frombuffer(ids, "<i4").tolist(), library.encode(word)
        assert math.isclose(sum(score[i] for i in ours), sum(score[i] for i in theirs), rel_tol=1e-4), word
    assert np.frombuffer(encoder.encode(["Hello world"])[0], "<i4").tolist() == library.encode("Hello world")


def brute_force(word, table):
    """Best score over all segmentations, by recursion over places."""
    names = {}
    score = dict(zip(table.ids.tolist(), table.scores.tolist(), strict=True))
    for i in table.ids.tolist():
        names[table.bytes[i].decode().replace(" ", pieces.BLANK)] = score[i]
    best = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - table.longest), j):
            value = names.get(word[i:j], table.unknown if j - i == 1 else -math.inf)
            best[j] = max(best[j], best[i] + value)
    return best[-1]


@pytest.mark.parametrize("scores", ["rank", "stored"])
def test_search_is_optimal(scores):
    table = pieces.vocabulary(pieces.default_model(), scores)
    score = dict(zip(table.ids.tolist(), table.scores.tolist(), strict=True))
    bytes_of = set(table.byte_ids.tolist())
    words = ["▁the", "▁internationally", "▁thhetionhaest", "▁▁x", "▁q漢z"]
    for word, ids in zip(words, table.encode_words(words), strict=True):
        found = np.frombuffer(ids, "<i4").tolist()
        total, spelled = 0.0, []
        for i in found:
            if i in bytes_of:
                spelled.append(i)
            else:
                total += score[i]
        total += table.unknown * (len(spelled) // 3)  # the one such character here has three bytes
        assert math.isclose(total, brute_force(word, table), rel_tol=1e-9)


def test_round_trip_and_columns(spark, docs):
    model = pieces.default_model()
    own = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "doc_id AS `odd name`")
    encoded = pieces.encode(own, model)
    assert encoded.columns == ["doc_id", "text", "odd name", "ids"]
    decoded = {r.doc_id: r.text for r in pieces.decode(encoded, model).collect()}
    assert decoded == {i: t or "" for i, t in enumerate(TEXTS)} | {6: TEXTS[6].replace(pieces.BLANK, " ")}
    digests = pieces.digests(docs, model)
    assert digests.count() == docs.count()
    assert digests.filter("NOT round_trip").count() == 0


def test_few_words_are_held(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 3)
    encoder = pieces.Encoder(pieces.default_model(), "rank")
    whole = pieces.Encoder(pieces.default_model(), "rank")
    assert [encoder.encode([t])[0] for t in TEXTS] == whole.encode(TEXTS)


def test_empty_table(no_docs):
    assert pieces.digests(no_docs, pieces.default_model()).count() == 0
