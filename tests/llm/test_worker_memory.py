"""What an operator's task leaves in its Python worker, which goes on to other tasks."""

import random

import pyarrow as pa

from quire.llm import common, packing
from quire.llm.tokens import KEPT_WORDS, WordEncoder, default_tokenizer, encoder


def words(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(9)) for _ in range(n)]


def test_packing_leaves_few_words_in_the_workers(spark):
    docs = spark.createDataFrame([(i, " ".join(words(i, 2500))) for i in range(40)], "doc_id long, text string").coalesce(1)
    assert packing.token_pieces(docs).count() >= 40
    path = default_tokenizer()

    def held(parts):
        n = sum(part.num_rows for part in parts)
        enc = encoder(path)
        yield pa.RecordBatch.from_pydict({"n": [n], "words": [len(enc.words) + len(enc.older) + len(enc.stems)]})

    left = spark.range(400, numPartitions=32).mapInArrow(held, "n long, words long").collect()
    assert sum(r.n for r in left) == 400
    assert max(r.words for r in left) <= KEPT_WORDS < 40 * 2500


def test_a_word_and_its_forms_with_punctuation_share_an_entry():
    enc = WordEncoder(default_tokenizer())
    some = words(1, 500)
    enc.encode(" ".join(["x", *some]))
    assert len(enc.words) + len(enc.stems) == 500


def test_encoder_holds_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr("quire.llm.tokens.CACHE_WORDS", 64)
    enc, fresh = WordEncoder(default_tokenizer()), WordEncoder(default_tokenizer())
    for i in range(60):
        text = " ".join(["x", *(w + m for w in words(i % 40, 9) for m in ("", ",", "!?"))])
        assert enc.encode(text) == fresh._whole(text)
        assert len(enc.words) <= 32 and len(enc.older) <= 32
    monkeypatch.setattr("quire.llm.tokens.KEPT_WORDS", 5)
    enc.forget()
    assert len(enc.words) == 5 and not enc.older and not enc.stems
    assert enc.encode(text) == fresh._whole(text)


def test_frugal_gives_back_memory_when_the_rows_end(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.frugal(lambda parts: (2 * x for x in parts))(iter([1, 2]))) == [2, 4]
    assert given == [1]
    rows = common.frugal(lambda parts: parts)(iter([1, 2]))
    next(rows)
    rows.close()
    assert given == [1, 1]


def test_texts_are_those_of_the_column():
    values = [None if i % 7 == 0 else "" if i % 7 == 1 else f"é{i}" for i in range(3 * common.TEXTS + 5)]
    assert list(common.texts(pa.array(values, pa.string()))) == values
    assert list(common.texts(pa.array(values, pa.string()).slice(9))) == values[9:]
    assert list(common.texts(pa.array([], pa.string()))) == []
