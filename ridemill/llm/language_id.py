"""Language identification by unigrams of pieces, summed over all segmentations.

Each language has a probability for each piece of a fixed public vocabulary.  A word
can be cut into pieces in many ways; its probability is the sum over all of them,
which the forward algorithm gives.  The piece probabilities are learned by
expectation maximisation from counts of the words of all training documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import bodies, in_batches, parts_of, rows_of, written

VOCABULARY = "piece_bpe_32k.model"
LONGEST = 16
ROUNDS = 2
#: Added to each piece's expected count.
SMOOTHING = 0.1
#: Characters of a part that a longer word is cut into when expected counts are taken.
COUNTED = 64
UNDECIDED = "und"
ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: Numbers, a word's score in a language each, that a task keeps: fewer words with more languages.
MOST_SCORES = 8_000_000
#: Bits of the hashes by which steps of the trie are found.
HASH_BITS = 20
HASHES = 1 << HASH_BITS
#: Numbers that are worked on at once.
MOST_AT_ONCE = 4_000_000


def hashed(keys: np.ndarray) -> np.ndarray:
    """A number below HASHES for each key of the trie."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


class Pieces:
    """The vocabulary; `missing` stands for no piece, `unknown` for a character that is no piece."""

    def __init__(self, path: str | None):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
        own = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.size = len(own) + 1
        self.unknown, self.missing = len(own), len(own) + 1
        self.numbers = {model.id_to_piece(i): number for number, i in enumerate(own)}
        # A trie: from a node and a code point to the next node, as sorted keys; and the piece that ends at a node.
        nodes, steps = {"": 0}, {}
        for piece in self.numbers:
            for end in range(1, len(piece) + 1):
                if piece[:end] not in nodes:
                    nodes[piece[:end]] = len(nodes)
                    steps[nodes[piece[: end - 1]] << 21 | ord(piece[end - 1])] = nodes[piece[:end]]
        self.keys = np.array(sorted(steps), np.int64)
        self.next = np.array([steps[k] for k in self.keys.tolist()], np.int64)
        # For each hash the place of one key that has it; the other keys are found by bisection.
        self.places = np.zeros(HASHES, np.int32)
        self.places[hashed(self.keys)] = np.arange(len(self.keys), dtype=np.int32)
        self.crowded = np.zeros(HASHES, bool)
        self.crowded[hashed(self.keys[self.places[hashed(self.keys)] != np.arange(len(self.keys))])] = True
        self.ending = np.array([self.numbers.get(prefix, self.missing) for prefix in nodes], np.int32)

    def steps(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `keys` are in the trie, and the nodes that those lead to."""
        hashes = hashed(keys)
        place = self.places[hashes]
        known = self.keys[place] == keys
        again = np.flatnonzero(~known & self.crowded[hashes])
        if len(again):
            place[again] = np.minimum(np.searchsorted(self.keys, keys[again]), len(self.keys) - 1)
            known[again] = self.keys[place[again]] == keys[again]
        return known, self.next[place[known]]

    def edges(self, words: list[str]) -> np.ndarray:
        """For words of one length: the piece at each start and of each length."""
        length = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64).reshape(len(words), length)
        found = np.full((len(words), length, min(LONGEST, length)), self.missing, np.int32)
        row, start = (x.ravel() for x in np.indices(codes.shape))
        node = np.zeros(len(row), np.int64)
        for size in range(1, found.shape[2] + 1):
            known, node = self.steps(node << 21 | codes[row, start + size - 1])
            row, start = row[known], start[known]
            found[row, start, size - 1] = self.ending[node]
            inside = start + size < length
            row, start, node = row[inside], start[inside], node[inside]
        single = found[:, :, 0]
        single[single == self.missing] = self.unknown
        return found


@lru_cache(maxsize=1)
def pieces(path: str | None) -> Pieces:
    return Pieces(path)


def has_letter(text: str) -> bool:
    """Whether a character is a letter by its Unicode category; other numerals and signs are not."""
    return any(unicodedata.category(c)[0] == "L" for c in set(text))


def marked(word: bytes) -> str:
    """A word as the vocabulary spells it, its start marked."""
    return "▁" + word.decode("utf-8", "replace")


def by_length(texts: list[str], languages: int = 1, most: int = 2048) -> Iterator[tuple[list[int], list[str]]]:
    """Places and texts of one length, at most `most` at once and fewer if they are long or languages are many."""
    groups: dict[int, list[int]] = {}
    for place, text in enumerate(texts):
        groups.setdefault(len(text), []).append(place)
    for length, places in groups.items():
        step = max(1, min(most, 400_000 // length, MOST_AT_ONCE // ((LONGEST + 1) * languages)))
        for at in range(0, len(places), step):
            yield places[at : at + step], [texts[i] for i in places[at : at + step]]


def usual(pieces: np.ndarray, missing: int) -> np.ndarray | slice:
    """Where `pieces` are not missing; everything if that is most of them."""
    rows = np.flatnonzero(pieces != missing)
    return rows if 4 * len(rows) < len(pieces) else slice(None)


def forward(edges: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """The log of the sum over all segmentations (words, languages).

    `chances`: a row for each piece, a column for each language; the last row is 0.
    Only the sums of the last LONGEST prefixes are held, in turn; they are scaled
    whenever all have been replaced.
    """
    count, length, longest = edges.shape
    by_start = np.ascontiguousarray(edges.transpose(1, 2, 0))
    held = LONGEST + 1
    sums = np.zeros((held, count, chances.shape[1]))
    logs = np.zeros((count, chances.shape[1]))
    sums[0] = 1
    for end in range(1, length + 1):
        now = sums[end % held]
        now[:] = 0
        for size in range(1, min(longest, end) + 1):
            piece = by_start[end - size, size - 1]
            rows = usual(piece, len(chances) - 1)
            now[rows] += sums[(end - size) % held][rows] * chances[piece[rows]]
        if end % LONGEST == 0:
            top = sums.max(axis=0)
            sums /= top
            logs += np.log(top)
    return np.log(sums[length % held]) + logs


def word_scores(words: list[bytes], chances: np.ndarray, path: str | None) -> np.ndarray:
    """The log probability of each word in each language."""
    found = np.empty((len(words), chances.shape[1]))
    for places, texts in by_length([marked(w) for w in words], chances.shape[1]):
        found[places] = forward(pieces(path).edges(texts), chances)
    return found


class Scores:
    """Scores of words in all languages, computed when first asked for; emptied when there is no room for new ones."""

    def __init__(self, chances: np.ndarray, path: str | None):
        self.chances, self.path = chances, path
        self.room = max(1, MOST_SCORES // chances.shape[1])
        self.place: dict[bytes, int] = {}
        self.scores = np.empty((min(self.room, 4096), chances.shape[1]))

    def learn(self, words: list[bytes]) -> None:
        """Know all of at most `room` words."""
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if len(self.place) + len(new) > self.room:
            self.place.clear()
            new = list(dict.fromkeys(words))
        first, last = len(self.place), len(self.place) + len(new)
        if last > len(self.scores):
            wider = np.empty((min(self.room, max(last, 2 * len(self.scores))), self.scores.shape[1]))
            wider[:first] = self.scores[:first]
            self.scores = wider
        self.scores[first:last] = word_scores(new, self.chances, self.path)
        self.place.update(zip(new, range(first, last), strict=True))

    def total(self, words: list[bytes]) -> np.ndarray:
        """The sum of the scores of words; of more words than there is room for, part by part."""
        found = np.zeros(self.scores.shape[1])
        step = min(self.room, max(1, MOST_AT_ONCE // self.scores.shape[1]))
        for at in range(0, len(words), step):
            part = words[at : at + step]
            if len(words) > step:
                self.learn(part)
            found += self.scores[np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))].sum(axis=0)
        return found


def expected(words: list[bytes], counts: np.ndarray, chances: np.ndarray, path: str | None) -> np.ndarray:
    """How often each piece is expected in `words` of one language, each with its count.

    Longer words are cut into parts of whole characters; only the first has the mark of a start.
    """
    known = pieces(path)
    found = np.zeros(known.size + 1)
    parts = [(text[at : at + COUNTED], n) for text, n in zip(map(marked, words), counts.tolist(), strict=True) for at in range(0, len(text), COUNTED)]
    counts = np.array([n for _, n in parts])
    for places, texts in by_length([part for part, _ in parts]):
        edges = np.ascontiguousarray(known.edges(texts).transpose(1, 2, 0))
        length, longest, count = edges.shape
        # The sums of a whole part are kept, each scaled by a usual chance for a character.
        scale = np.exp(-np.log(np.maximum(chances[edges[:, 0], 0], 1e-6)).mean())
        own = chances[:, 0][edges] * (scale ** np.arange(1, longest + 1))[:, None]
        there = (edges != known.missing).any(axis=2)
        steps = [(start, size) for start in range(length) for size in range(1, min(longest, length - start) + 1) if there[start, size - 1]]
        sums, back = np.zeros((length + 1, count)), np.zeros((length + 1, count))
        sums[0] = back[length] = 1
        # All that ends where a piece starts has been added up before it.
        for start, size in steps:
            sums[start + size] += sums[start] * own[start, size - 1]
        for start, size in reversed(steps):
            back[start] += back[start + size] * own[start, size - 1]
        total = sums[length]
        usable = np.isfinite(total) & (total > 0)
        weight = np.where(usable, counts[places] / np.where(usable, total, 1), 0)
        for start, size in steps:
            own[start, size - 1] *= sums[start] * back[start + size] * weight
        met = edges != known.missing
        shares = own[met]
        if not np.isfinite(shares).all():
            shares = np.nan_to_num(shares)
        found += np.bincount(edges[met], shares, known.size + 1)
    return found[: known.size]


def is_held_out(parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves `part` when divided by `parts`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % parts == part


def language_words(docs: DataFrame) -> DataFrame:
    """lang, word and n over all rows of `docs` with a lang: a word's count in a language."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, dict[bytes, int]] = {}
            for lang, body in rows_of(iter([batch])):
                own = counts.setdefault(lang, {})
                for word in (body or b"").split():
                    own[word] = own.get(word, 0) + 1
            yield from in_batches(((lang, w, n) for lang, own in counts.items() for w, n in own.items()), schema, 65_536)

    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("body"))
    counted = rows.mapInArrow(run, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learned(docs: DataFrame, rounds: int = ROUNDS, path: str | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, piece probabilities (a column for each language, a row of 0 at the end) and shares of documents."""
    spark = docs.sparkSession
    words = written(language_words(docs), "language-words")
    shares = docs.where("lang IS NOT NULL AND text IS NOT NULL").groupBy(F.col("lang").cast("string").alias("lang")).count().collect()
    # Languages are few: a table of pieces by languages is what the model is.
    languages = sorted(r["lang"] for r in shares)
    size = pieces(path).size
    chances = np.zeros((size + 1, len(languages)))
    chances[:size] = 1 / size
    place = {lang: i for i, lang in enumerate(languages)}
    schema = pa.schema([("column", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])
    for _ in range(rounds if languages else 0):
        now = spark.sparkContext.broadcast(chances)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            found = np.zeros((len(place), size))
            for batch in batches:
                columns = np.array([place[x] for x in batch.column(0).to_pylist()])
                own, counts = batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
                for column in np.unique(columns).tolist():
                    at = np.flatnonzero(columns == column)
                    found[column] += expected([own[i] for i in at.tolist()], counts[at].astype(float), now.value[:, [column]], path)
            column, piece = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int32()), pa.array(piece, pa.int32()), pa.array(found[column, piece])], schema=schema)

        sums = words.mapInArrow(run, "column int, piece int, n double").groupBy("column", "piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full((size, len(languages)), SMOOTHING)
        counts[sums["piece"].to_numpy(), sums["column"].to_numpy()] += sums["n"].to_numpy()
        chances = np.zeros((size + 1, len(languages)))
        chances[:size] = counts / counts.sum(axis=0)
    documents = {r["lang"]: r["count"] for r in shares}
    weights = np.array([documents[lang] for lang in languages], float)
    return languages, chances, weights / max(1.0, weights.sum())


def language_id(docs: DataFrame, training: DataFrame, rounds: int = ROUNDS, path: str | None = None) -> DataFrame:
    """doc_id, lang_pred and score (its probability among the languages, 0 to 1) of every row of `docs`.

    `training` has text and lang; rows without either teach nothing.  A prediction
    reads the whole text and nothing else.  A null text, one without a letter, and any
    text where nothing was learned are `und` with score 0.  Of equal scores the first
    language in alphabetical order wins.  Repeated rows are judged each for itself.
    """
    languages, chances, shares = learned(training, rounds, path)
    known = docs.sparkSession.sparkContext.broadcast((chances, np.log(shares)))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        chances, prior = known.value
        scores = Scores(chances, path) if languages else None
        for batch in parts_of(batches):
            texts = [(doc_id, body or b"") for doc_id, body in rows_of(iter([batch]))]
            held, size = [], 0
            for doc_id, body in texts:
                words = body.split()
                if not languages or not (ASCII_LETTER.search(body) or has_letter(body.decode("utf-8", "replace"))):
                    yield doc_id, UNDECIDED, 0.0
                    continue
                # Texts that together fit are learned at once.
                if held and size + len(words) > scores.room:
                    yield from decided(held, scores, prior)
                    held, size = [], 0
                held.append((doc_id, words))
                size += len(words)
            if held:
                yield from decided(held, scores, prior)

    def decided(held: list[tuple], scores: Scores, prior: np.ndarray) -> Iterator[tuple]:
        if sum(len(words) for _, words in held) <= scores.room:
            scores.learn([w for _, words in held for w in words])
        for doc_id, words in held:
            logs = scores.total(words) + prior
            best = int(logs.argmax())
            yield doc_id, languages[best], float(1 / np.exp(logs - logs[best]).sum())

    return bodies(docs).mapInArrow(lambda batches: in_batches(judged(batches), schema), "doc_id long, lang_pred string, score double")
