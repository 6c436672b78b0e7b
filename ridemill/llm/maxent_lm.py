"""Language-model scores from a hashed maximum-entropy model with classes of words.

A word's probability is that of its class after its context, times its own inside
the class.  The most frequent words are classes of their own, the others share
classes by a hash of how they begin.  The class is predicted by a softmax over
hashed features: the word before (bigram), the word before that (skip), both
(trigram), and a bias.  All features depend on the hashed pair of preceding words,
so counts of classes for each pair, over all training tokens, hold all that training
needs; gradients over these counts are summed up in tasks, and the weights updated.
Inside a class, words have their smoothed shares of all training tokens.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import Memo, Scratch, bodies, in_batches, parts_of, rows_of, written

#: The token that ends each text; no word is empty.
END = b""
OWN_CLASSES = 32
CLASSES = 64
BUCKETS = 128
PAIR_FEATURES = 4096
FEATURES = 1 + 2 * BUCKETS + PAIR_FEATURES
UPDATES = 12
RATE = 0.4
PRIOR = 4.0
#: Words whose counts every task knows: at most so many, the most frequent.
SHARED_WORDS = 200_000
#: Tasks that gradients are computed in, at most so many at any size: the counts they read have a fixed size.
GRADIENT_TASKS = 4
#: Distinct words that a task gathers before it hands their counts on.
GATHERED = 500_000
#: Bigrams that a task gathers before it hands their counts on.
GATHERED_BIGRAMS = 1 << 19
#: Words whose hash a task remembers.
KNOWN_HASHES = 200_000
#: A bigram has a weight if it was seen so often, and is taken to be seen DISCOUNT times less.
SEEN = 2
DISCOUNT = 0.75
BIGRAM_UPDATES = 6
#: Places of the table of weights and normalisers that every task knows, and 64-bit words of the
#: filter that tells which others there are: 8 megabytes each, whatever the input.
PLACES = 1 << 20
FILTER_WORDS = 1 << 20
#: Hash of what comes before a text's first token, and factors that mix a word before with a class.
START = np.uint64(1)
MIX_BEFORE, MIX_CLASS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Stands for the word where a row counts a class after a pair of buckets.
CELL = 0
PAIRS = np.arange(BUCKETS * BUCKETS)
FIRST, SECOND = PAIRS // BUCKETS, PAIRS % BUCKETS
#: For each pair of buckets the rows of its four features.
ACTIVE = np.stack(
    (
        np.zeros_like(PAIRS),
        1 + FIRST,
        1 + BUCKETS + SECOND,
        1 + 2 * BUCKETS + (PAIRS.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % PAIR_FEATURES,
    )
)


def token_words(body: bytes | None) -> list[bytes]:
    return [*(body or b"").lower().split(), END]


def word_counts(docs: DataFrame) -> DataFrame:
    """word and c: how often each token occurs in all of `docs`."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found: Counter[bytes] = Counter()
        for _, body in rows_of(batches):
            found.update(token_words(body))
            if len(found) >= GATHERED:
                yield from found.items()
                found.clear()
        yield from found.items()

    rows = bodies(docs).mapInArrow(lambda batches: in_batches(counted(batches), schema, 65_536), "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """What each task knows of the words: shared counts, and totals by class."""

    train_tokens: int
    distinct: int
    words: dict[bytes, int]
    log_counts: np.ndarray
    class_logs: np.ndarray

    def packed(self, word: bytes) -> int:
        """The word's place among the shared ones from 1 (0: none), its class and its bucket as one number."""
        place = self.words.get(word, -1) + 1
        if 0 < place <= OWN_CLASSES:
            return place << 16 | (place - 1) << 8 | (place - 1)
        bucket = OWN_CLASSES + zlib.crc32(word[-2:]) % (BUCKETS - OWN_CLASSES)
        return place << 16 | hashed_class(word) << 8 | bucket


def hashed_class(word: bytes) -> int:
    return OWN_CLASSES + zlib.crc32(word[:2]) % (CLASSES - OWN_CLASSES)


def class_number() -> Column:
    """`hashed_class` of the column `word`."""
    return (F.crc32(F.substring("word", 1, 2)) % (CLASSES - OWN_CLASSES) + OWN_CLASSES).cast("int")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The shared words are those above a count that at most SHARED_WORDS reach."""
    log = F.floor(F.log2("c") * 8).cast("int")
    steps = counts.groupBy(log.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.sum("c").alias("tokens")).collect()
    held, lowest = 0, None
    for row in sorted(steps, key=lambda r: -r["step"]):
        held += row["words"]
        if held > SHARED_WORDS:
            break
        lowest = row["step"]
    found = counts.where(log >= (1 << 30 if lowest is None else lowest)).select("word", "c").toArrow()
    shared = sorted(zip(found["word"].to_pylist(), found["c"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    own = {w for w, _ in shared[:OWN_CLASSES]}
    rest = counts.where(~F.col("word").isin([bytearray(w) for w in own])) if own else counts
    totals = np.zeros((CLASSES, 2))
    for row in rest.groupBy(class_number().alias("class")).agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("words")).collect():
        totals[row["class"]] = row["tokens"], row["words"]
    class_logs = np.log10(totals[:, 0] + 0.5 * (totals[:, 1] + 1))
    logs = np.log10(np.array([0.0, *(c for _, c in shared)]) + 0.5)
    tokens, words = sum(r["tokens"] for r in steps), sum(r["words"] for r in steps)
    return Vocabulary(tokens, words, {w: i for i, (w, _) in enumerate(shared)}, logs, class_logs)


def contexts(codes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The pair of buckets before each token, and its class."""
    buckets = np.concatenate(([start, start], codes & 255))
    return buckets[1:-1] * BUCKETS + buckets[:-2], codes >> 8 & 255


def word_hash(word: bytes) -> int:
    """As Spark's xxhash64 of a binary column, unsigned."""
    return xxhash.xxh64_intdigest(word, 42)


def bigram_contexts(hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """A key for each token's word before it and its class."""
    return np.concatenate(([START], hashes[:-1])) * MIX_BEFORE + kinds.astype(np.uint64) * MIX_CLASS


def context_counts(docs: DataFrame, known) -> DataFrame:
    """context, word, n, total: what follows what in all of `docs`, in one pass over the texts.

    Rows whose `word` is CELL say how often a class follows a pair of buckets, both in
    `context` as pair * CLASSES + class.  The others say how often a word (its hash)
    follows another one in its class; they are the bigrams seen SEEN times or more, and
    `total` counts all tokens of their context.  Words that are classes of their own
    have no such rows.
    """
    schema = pa.schema([("context", pa.int64()), ("word", pa.int64()), ("n", pa.int64())])

    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        context, word = (np.concatenate(part) for part in zip(*held, strict=True))
        _, first, n = np.unique(context ^ word, return_index=True, return_counts=True)
        for at in range(0, len(first), 65_536):
            own = first[at : at + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (context[own].view(np.int64), word[own].view(np.int64), n[at : at + 65_536])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, hashed = Memo(known.value.packed), Memo(word_hash, KNOWN_HASHES)
        found = np.zeros(len(PAIRS) * CLASSES, np.int64)
        held, tokens = [], 0
        for batch in batches:
            cells = [np.empty(0, np.int64)]
            for _, body in rows_of(iter([batch])):
                words = token_words(body)
                codes = np.fromiter(map(packed.__getitem__, words), np.int64, len(words))
                hashes = np.fromiter(map(hashed.__getitem__, words), np.uint64, len(words))
                pair, kind = contexts(codes, packed[END] & 255)
                cells.append(pair * CLASSES + kind)
                shares = kind >= OWN_CLASSES
                held.append((bigram_contexts(hashes, kind)[shares], hashes[shares]))
                tokens += len(words)
                if tokens >= GATHERED_BIGRAMS:
                    yield from counted(held)
                    held, tokens = [], 0
            found += np.bincount(np.concatenate(cells), minlength=len(found))
        if held:
            yield from counted(held)
        own = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (own, np.full(len(own), CELL), found[own])], schema=schema)

    # Tasks have added up what they saw, so rows are dealt by context once, for the sums and the totals.
    rows = bodies(docs).mapInArrow(run, "context long, word long, n long").repartition("context")
    rows = rows.groupBy("context", "word").agg(F.sum("n").alias("n"))
    rows = rows.withColumn("total", F.sum("n").over(Window.partitionBy("context")))
    return rows.where((F.col("word") == CELL) | (F.col("n") >= SEEN))


def in_class_values(counts: DataFrame, words: DataFrame, vocab: Vocabulary, updates: int = BIGRAM_UPDATES) -> DataFrame:
    """key, value and n: log10 weights of bigrams (context xor word), and of contexts less the log10 of their normaliser.

    A weight starts where the word would have its discounted share of the context if
    nothing else changed, and follows the difference of what was shown and is expected.
    """
    size = F.array(*(F.lit(float(10**log)) for log in vocab.class_logs))
    shares = words.where(F.col("c") >= SEEN).select(F.xxhash64("word").alias("word"), ((F.col("c") + 0.5) / F.element_at(size, class_number() + 1)).alias("share"))
    rows = counts.where(F.col("word") != CELL).join(shares, "word")
    shown = F.col("n") - F.lit(DISCOUNT)
    rows = rows.withColumn("weight", F.log(shown / (F.col("total") * F.col("share"))))
    # All words of the class, those without a weight included: their shares add up to one.
    context = Window.partitionBy("context")
    whole = F.lit(1.0) + F.sum(F.col("share") * (F.exp("weight") - 1)).over(context)
    for _ in range(updates):
        rows = rows.withColumn("whole", whole)
        expected = F.col("total") * F.col("share") * F.exp("weight") / F.col("whole")
        rows = rows.withColumn("weight", F.col("weight") + (shown - expected) / F.greatest(shown, expected))
    rows = rows.withColumn("whole", whole).withColumn("least", F.min("word").over(context))

    def entry(key: Column, log10: Column, n: Column) -> Column:
        return F.struct(key.alias("key"), log10.cast("float").alias("value"), n.alias("n"))

    own = entry(F.col("context").bitwiseXOR(F.col("word")), F.col("weight") / np.log(10), F.col("n"))
    # One of a context's rows brings its normaliser along.
    normaliser = entry(F.col("context"), -F.log10("whole"), F.col("total"))
    both = F.when(F.col("word") == F.col("least"), F.array(own, normaliser)).otherwise(F.array(own))
    return written(rows.select(F.inline(both)), "in-class-values")


@dataclass
class Places:
    """For each place the upper half and the value of the most frequent key there; and a filter of all keys."""

    tags: np.ndarray
    values: np.ndarray
    filter: np.ndarray

    def of(self, keys: np.ndarray) -> tuple[float, np.ndarray]:
        """The sum of what is known of `keys`, and those of which only the table may know."""
        place = (keys & np.uint64(len(self.tags) - 1)).astype(np.int64)
        known = self.tags[place] == (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)
        others = keys[~known]
        bits = self.filter[(others >> np.uint64(12) & np.uint64(FILTER_WORDS - 1)).astype(np.int64)] >> (others >> np.uint64(6) & np.uint64(63))
        return float(self.values[place[known]].sum(dtype=np.float64)), others[(bits & np.uint64(1)).astype(bool)]


def shared_places(values: DataFrame) -> Places:
    held = Places(np.zeros(PLACES, np.int32), np.zeros(PLACES, np.float32), np.zeros(FILTER_WORDS, np.uint64))
    tag = F.shiftright("key", 32).cast("int").alias("tag")
    best = F.max_by(F.struct(tag, "value"), F.struct("n", "key")).alias("best")
    rows = values.groupBy(F.col("key").bitwiseAND(F.lit(PLACES - 1)).cast("int").alias("place")).agg(best)
    for batch in rows.select("place", "best.tag", "best.value").toArrow().to_batches():
        place, tags, logs = (c.to_numpy() for c in batch.columns)
        held.tags[place], held.values[place] = tags, logs
    word = F.shiftright("key", 12).bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, int(shiftright(key, 6) & 63L))")
    for batch in values.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow().to_batches():
        held.filter[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return held


def class_logits(weights: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    return weights[ACTIVE[:, pairs]].sum(axis=0)


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def feature_sums(pairs: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of `values`, one for each pair, added up for each feature."""
    found = np.zeros((FEATURES, CLASSES))
    for features in ACTIVE[:, pairs]:
        order = np.argsort(features, kind="stable")
        numbers, starts = np.unique(features[order], return_index=True)
        found[numbers] += np.add.reduceat(values[order], starts, axis=0)
    return found


def trained(counts: DataFrame, updates: int = UPDATES) -> np.ndarray:
    """Weights (features, classes) after as many updates.

    Each task sums up what its pairs of buckets show and what the model expects there;
    a weight follows the difference, in proportion to the larger of both.
    """
    spark = counts.sparkSession
    # What a pair is expected to show grows with its count, so its rows may lie in several tasks.
    counts = written(counts, "class-counts").coalesce(GRADIENT_TASKS)
    schema = pa.schema([("shown", pa.binary()), ("expected", pa.binary())])
    weights = np.zeros((FEATURES, CLASSES))
    for _ in range(updates):
        now = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            found = np.zeros((len(PAIRS), CLASSES))
            for batch in batches:
                pair, kind, n = (c.to_numpy() for c in batch.columns)
                np.add.at(found, (pair, kind), n)
            pairs = np.flatnonzero(found.any(axis=1))
            if not len(pairs):
                return
            shown = found[pairs]
            model = np.exp(log_softmax(class_logits(now.value, pairs))) * shown.sum(axis=1, keepdims=True)
            sums = [[feature_sums(pairs, v).tobytes()] for v in (shown, model)]
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.binary()) for s in sums], schema=schema)

        parts = counts.mapInArrow(run, "shown binary, expected binary").collect()
        shown, model = (sum((np.frombuffer(p[i]) for p in parts), np.zeros(FEATURES * CLASSES)).reshape(weights.shape) for i in (0, 1))
        now.unpersist()
        weights = weights + RATE * (shown - model) / (np.maximum(shown, model) + PRIOR)
    return weights


def part_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of equally long `columns`; the others of `schema` are null."""
    size = len(columns["row"])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def lm_scores(docs: DataFrame, training: Column, updates: int = UPDATES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of `docs`.

    The model learns from the rows where `training` holds.  base_score is the log10
    probability of the text by smoothed shares of single tokens, score that of the
    model.  Tokens are the words, A-Z in lower case, and one end; a null text has the
    end only.  Repeated rows get a row each.  Without a training row each token has the
    share of an unknown one.
    """
    learned_from = docs.where(training)
    counts = written(word_counts(learned_from), "word-counts")
    vocab = vocabulary(counts)
    known = docs.sparkSession.sparkContext.broadcast(vocab)
    scratch = Scratch(docs.sparkSession)
    seen = scratch.written(context_counts(learned_from, known), "context-counts")
    cells = seen.where(F.col("word") == CELL).select((F.col("context") / CLASSES).cast("int").alias("pair"), (F.col("context") % CLASSES).cast("int").alias("class"), "n")
    weights = trained(cells, updates)
    # For each pair of buckets the log10 probability of each class: a table of fixed size.
    logs = np.empty((len(PAIRS), CLASSES), np.float32)
    for at in range(0, len(PAIRS), 1024):
        logs[at : at + 1024] = log_softmax(class_logits(weights, PAIRS[at : at + 1024])) / np.log(10)
    table = docs.sparkSession.sparkContext.broadcast(logs)
    values = in_class_values(seen, counts, vocab)
    scratch.drop(seen)
    places = docs.sparkSession.sparkContext.broadcast(shared_places(values))
    fields = [("row", pa.int64()), ("doc_id", pa.int64()), ("word", pa.binary()), ("key", pa.int64()), ("times", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64())]
    schema = pa.schema(fields)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, logs, inside = known.value, table.value, places.value
        packed, hashed = Memo(vocab.packed), Memo(word_hash, KNOWN_HASHES)
        row = TaskContext.get().partitionId() << 40
        for batch in parts_of(batches):
            texts, rare, open_keys = [], [], [np.empty((3, 0), np.int64)]
            for doc_id, body in rows_of(iter([batch])):
                row += 1
                words = token_words(body)
                codes = np.fromiter(map(packed.__getitem__, words), np.int64, len(words))
                place = codes >> 16
                pair, kind = contexts(codes, packed[END] & 255)
                shared = place > 0
                own_class = shared & (place <= OWN_CLASSES)
                found = vocab.log_counts[place] * shared
                model = float(logs[pair, kind].sum(dtype=np.float64) + found[~own_class].sum() - vocab.class_logs[kind[~own_class]].sum())
                hashes = np.fromiter(map(hashed.__getitem__, words), np.uint64, len(words))
                context = bigram_contexts(hashes, kind)[~own_class]
                value, keys = inside.of(np.concatenate((context, context ^ hashes[~own_class])))
                texts.append((row, doc_id, len(words), int(shared.sum()), float(found.sum()), model + value))
                for word, times in Counter([words[i] for i in np.flatnonzero(~shared).tolist()]).items():
                    rare.append((row, word, times))
                own, times = np.unique(keys.view(np.int64), return_counts=True)
                open_keys.append(np.stack((np.full(len(own), row), own, times)))
            yield part_rows(schema, **dict(zip(("row", "doc_id", "n_tokens", "n_known", "base", "model"), zip(*texts, strict=True), strict=True)))
            if rare:
                yield part_rows(schema, **dict(zip(("row", "word", "times"), zip(*rare, strict=True), strict=True)))
            rows, keys, times = np.concatenate(open_keys, axis=1)
            for at in range(0, len(rows), 65_536):
                yield part_rows(schema, row=rows[at : at + 65_536], key=keys[at : at + 65_536], times=times[at : at + 65_536])

    columns = "row long, doc_id long, word binary, key long, times long, n_tokens long, n_known long, base double, model double"
    parts = written(bodies(docs).mapInArrow(scored, columns), "lm-parts")
    # Only words that are not shared meet their counts by a join; a text's sum of logs is the same for both scores.
    rare = parts.where("word IS NOT NULL").select("row", "word", "times").join(counts, "word", "left")
    share = F.col("times") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(0.5))
    rare = rare.select("row", share.alias("rare"), F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("rare_known"), F.lit(0.0).alias("inside"))
    # So do weights and normalisers that did not win their place.
    others = parts.where("key IS NOT NULL").select("row", "key", "times").join(values, "key")
    others = others.select("row", F.lit(0.0).alias("rare"), F.lit(0).cast("long").alias("rare_known"), (F.col("times") * F.col("value").cast("double")).alias("inside"))
    rare = rare.unionByName(others).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("rare", "rare_known", "inside")))
    rows = parts.where("word IS NULL AND key IS NULL").select("row", "doc_id", "n_tokens", "n_known", "base", "model").join(rare, "row", "left")
    more = F.coalesce("rare", F.lit(0.0))
    whole = float(np.log10(vocab.train_tokens + 0.5 * (vocab.distinct + 1)))
    return rows.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model") + more + F.coalesce("inside", F.lit(0.0))).alias("score"),
    )
