from __future__ import annotations

import random

import numpy as np

from ridemill.llm import language_id as op

from . import cases

ENGLISH = "the house stands with many things and nothing whatever should have been thought through".split()
GERMAN = "das schöne Haus steht zwischen vielen Bäumen und nichts wird überhaupt geändert worden sein".split()


def training(spark):
    rnd = random.Random(1)
    rows = [(" ".join(rnd.choices(words, k=30)), lang) for lang, words in (("en", ENGLISH), ("de", GERMAN)) for _ in range(30)]
    rows += [(None, "en"), ("no language", None), ("x" * 5000, "en")]
    return spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")


def test_forward_sums_all_segmentations():
    known, rnd = op.pieces(None), np.random.default_rng(2)
    chances = rnd.random((known.size + 1, 2))
    chances /= chances.sum(axis=0)
    chances[-1] = 0

    def total(text, column):
        if not text:
            return 1.0
        found = 0.0
        for size in range(1, min(op.LONGEST, len(text)) + 1):
            piece = known.numbers.get(text[:size], known.missing)
            if piece == known.missing and size == 1:
                piece = known.unknown
            if piece != known.missing:
                found += chances[piece, column] * total(text[size:], column)
        return found

    words = ["house", "thinking", "a", "Bäume", "漢字", "", "aaaaaaaaaaaa"]
    found = op.word_scores([w.encode() for w in words], chances, None)
    for word, own in zip(words, found, strict=True):
        assert np.allclose(own, [np.log(total("▁" + word, c)) for c in (0, 1)])


def test_expected_counts_cover_each_text():
    known = op.pieces(None)
    chances = np.full((known.size + 1, 1), 1 / known.size)
    chances[-1] = 0
    words = [b"house", b"things", "Bäume".encode()]
    found = op.expected(words, np.array([2, 1, 3]), chances, None)
    lengths = np.ones(known.size)
    for piece, number in known.numbers.items():
        lengths[number] = len(piece)
    assert np.isclose(found @ lengths, sum(n * (1 + len(w.decode())) for w, n in zip(words, (2, 1, 3), strict=True)))


def test_steps_of_the_trie_are_those_that_bisection_finds(monkeypatch):
    # With few hashes most keys share theirs, and go by bisection.
    monkeypatch.setattr(op, "HASH_BITS", 8)
    monkeypatch.setattr(op, "HASHES", 1 << 8)
    known, rnd = op.Pieces(None), np.random.default_rng(6)
    keys = np.concatenate((rnd.choice(known.keys, 5000), rnd.choice(known.keys, 5000) + 1, rnd.integers(0, 1 << 40, 1000), [0, 1 << 40]))
    found, nodes = known.steps(keys)
    place = np.minimum(np.searchsorted(known.keys, keys), len(known.keys) - 1)
    assert (found == (known.keys[place] == keys)).all() and 0 < found.sum() < len(keys)
    assert (nodes == known.next[place[found]]).all()


def test_words_with_few_pieces_do_not_cost_every_length():
    known, calls = op.pieces(None), []

    class Chances(np.ndarray):
        def __getitem__(self, at):
            calls.append(at)
            return np.ndarray.__getitem__(self, at)

    chances = np.full((known.size + 1, 1), 1 / known.size)
    chances[-1] = 0
    edges = known.edges(["漢" * 30 + "字" * 2] * 8)
    wanted = np.asarray(op.forward(edges, chances))
    assert np.allclose(op.forward(edges, chances.view(Chances)), wanted)
    # The characters have no piece together: one length of sixteen brings a chance.
    assert sum(np.size(at) for at in calls) < 8 * 32 * 2


def test_predictions(spark):
    texts = cases.odd_texts() + [(30, "Through the many houses"), (31, "zwischen schönen Bäumen"), (32, "1234 ... 99"), (33, "the " * 3000 + "x" * 3000), (34, "½ ²"), (35, "Ⅷ 7"), (36, "½ é")]
    found = op.language_id(cases.table(spark, texts), training(spark)).collect()
    assert len(found) == len(texts)
    own = {r.doc_id: r.lang_pred for r in found}
    assert (own[30], own[31], own[33]) == ("en", "de", "en")
    assert own[34] == own[35] == op.UNDECIDED and own[36] != op.UNDECIDED
    assert own[1] == own[2] == own[3] == own[32] == op.UNDECIDED
    assert all(0 <= r.score <= 1 for r in found)


def test_empty_tables(spark):
    none = training(spark).where("false")
    assert op.language_id(cases.table(spark, []), training(spark)).collect() == []
    assert {r.lang_pred for r in op.language_id(cases.table(spark, [(1, "text"), (2, None)]), none).collect()} == {op.UNDECIDED}


def test_long_words_are_cut_between_characters_and_start_once():
    known, word = op.pieces(None), "漢字é" * 1000
    chances = np.full((known.size + 1, 1), 1 / known.size)
    chances[-1] = 0
    found = op.expected([word.encode()], np.array([2]), chances, None)
    lengths, starts = np.ones(known.size), np.zeros(known.size)
    for piece, number in known.numbers.items():
        lengths[number], starts[number] = len(piece), piece.startswith("▁")
    assert np.isclose(found @ lengths, 2 * (1 + len(word)))
    assert np.isclose(found @ starts, 2)
    assert found[known.numbers["▁"]] > 0 and not any(found[n] for p, n in known.numbers.items() if "�" in p)


def test_scores_are_the_same_with_little_room(monkeypatch):
    known, rnd = op.pieces(None), np.random.default_rng(4)
    chances = rnd.random((known.size + 1, 3))
    chances[-1] = 0
    chances /= chances.sum(axis=0)
    words = [w.encode() for w in cases.prose(5, 300).split()] + [("é漢" * 700).encode()]
    wanted = op.word_scores(words, chances, None).sum(axis=0)
    monkeypatch.setattr(op, "MOST_SCORES", 30)
    monkeypatch.setattr(op, "MOST_AT_ONCE", 60)
    scores = op.Scores(chances, None)
    assert np.allclose(scores.total(words), wanted) and len(scores.scores) <= 10


def test_three_hundred_languages(spark):
    def text(i):
        return " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26)}{k}" for k in "xyz"] * 5)

    training = spark.createDataFrame([(i, text(i), f"l{i:03}") for i in range(300)], "doc_id long, text string, lang string")
    found = op.language_id(training.where("doc_id % 50 = 0"), training, rounds=1).collect()
    assert {(r.doc_id, r.lang_pred) for r in found} == {(i, f"l{i:03}") for i in range(0, 300, 50)}
