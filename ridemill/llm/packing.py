"""Packing of tokenized documents into sequences, as a cutting-stock problem.

A document is cut into full sequences and one rest.  The lengths of all pieces,
rounded up to a few hundred classes, form a histogram: all that comes to the driver,
and as large for any input.  Column generation solves the linear program over it: a
pattern says how many pieces of each class fill a sequence, a knapsack over the dual
prices finds the next useful pattern.  Patterns are used a whole number of times;
what that leaves is filled up greedily.  Pieces are ranked inside their class, and
the rank says which pattern, sequence and place a piece gets.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import BUCKET_ROWS, bodies, in_batches, parts_of, ranked, rows_of, small_batches, written

CAPACITY = 2048
#: Tokens that a class of lengths spans; a piece of the class counts as its longest.
UNIT = 8
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Part of the sequences by which the program may miss its optimum.
GAP = 1e-3
#: The program stops there at the latest; any basis packs all pieces.
MOST_PIVOTS = 5_000
#: Words, and parts of words, whose ids a task keeps.
MOST_KNOWN = 500_000
#: What a vocabulary does to a text before its merges, if `plain` words may be cut here.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Words of ASCII without apostrophe and `<`, and of Latin letters that nothing composes with.
PLAIN = re.compile("[!-&(-;=-~À-ÖØ-öø-ÿ]+")
PLAIN_PART = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
LATIN = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"


class WordIds(dict):
    """Token ids of words, as little-endian unsigned 32-bit bytes; `meet` adds those of new words.

    The vocabulary drops white space and never joins over it, and no added token holds any, so
    words can be tokenized each for itself.  Where it also cuts words into runs of letters, single
    digits and runs of signs, plain words are cut so here, and their parts, which many words
    share, go through the merges alone.
    """

    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        steps = [json.loads(step.__getstate__()) if step else None for step in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.cuts = steps == [NORMALIZER, PRE_TOKENIZER] and not any(PLAIN.fullmatch(token.content) for token in added)
        self.parts: dict[str, bytes] = {}
        self.spelled = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in LATIN}) if self.cuts else {}

    def meet(self, words: set[bytes]) -> None:
        new = [word for word in words if word not in self]
        if len(self) + len(new) > MOST_KNOWN:
            self.clear()
            new = list(words)
        texts = [word.decode() for word in new]
        others = []
        for word, text in zip(new, texts, strict=True):
            if self.cuts and PLAIN.fullmatch(text):
                self[word] = b"".join(map(self.part, PLAIN_PART.findall(text.lower())))
            else:
                others.append((word, text))
        found = self.tokenizer.encode_batch_fast([text for _, text in others], add_special_tokens=False)
        self.update((word, array("I", own.ids).tobytes()) for (word, _), own in zip(others, found, strict=True))

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            if len(self.parts) >= MOST_KNOWN:
                self.parts.clear()
            found = self.parts[text] = array("I", [token.id for token in self.tokenizer.model.tokenize(text.translate(self.spelled))]).tobytes()
        return found


@lru_cache(maxsize=1)
def word_ids(path: str | None) -> WordIds:
    # The tasks are the parallelism; the library's own threads would add to it.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, ids: each document's ids, its end id last, in pieces of `capacity` and a rest.

    ids are little-endian unsigned 32-bit numbers, null where they are not asked for.  `path`: the vocabulary's file.
    """
    fields = [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    schema = pa.schema([*fields, ("ids", pa.binary())])
    end = END_ID.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known = word_ids(path)
        for batch in parts_of(batches):
            rows = [(doc_id, (body or b"").split()) for doc_id, body in rows_of(iter([batch]))]
            known.meet(set().union(*(words for _, words in rows)))
            for doc_id, words in rows:
                ids = b"".join(map(known.__getitem__, words)) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    own = ids[4 * start : 4 * (start + capacity)]
                    yield doc_id, start, len(own) // 4, zlib.crc32(own), total, own if with_ids else None

    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    return bodies(docs).mapInArrow(lambda batches: in_batches(pieces(batches), schema, 1024), columns)


def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable filling of `room`, any number of each size: its value and counts."""
    best, taken = np.zeros(room + 1), np.full(room + 1, -1)
    for space in range(1, room + 1):
        best[space] = best[space - 1]
        fits = np.searchsorted(sizes, space, side="right")
        if fits:
            values = best[space - sizes[:fits]] + prices[:fits]
            pick = int(values.argmax())
            if values[pick] > best[space] + 1e-12:
                best[space], taken[space] = values[pick], pick
    counts, space = np.zeros(len(sizes), np.int64), room
    while space > 0:
        if taken[space] < 0:
            space -= 1
        else:
            counts[taken[space]] += 1
            space -= int(sizes[taken[space]])
    return float(best[room]), counts


def patterns(histogram: Mapping[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """How often each pattern (pieces by size) is used so that all of `histogram` is packed into bins of `room`."""
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    if not len(sizes):
        return []
    # Plain array arithmetic: these arrays are too small for a linear algebra library's threads.
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / (room // sizes))
    used = demand / (room // sizes)
    bound = float(sizes @ demand) / room
    for _ in range(MOST_PIVOTS):
        value, column = knapsack(inverse.sum(axis=0), sizes, room)
        # No packing needs less than all pieces fill, nor less than what is used now divided by `value`.
        bound = max(bound, used.sum() / max(1.0, value))
        if used.sum() <= bound * (1 + GAP):
            break
        step = (inverse * column).sum(axis=1)
        able = step > 1e-9
        out = int(np.where(able, used / np.where(able, step, 1), np.inf).argmin())
        basis[:, out] = column
        share = used[out] / step[out]
        used = np.maximum(used - share * step, 0)
        used[out] = share
        row = inverse[out] / step[out]
        inverse -= np.multiply.outer(step, row)
        inverse[out] = row
    plan, left = [], demand.copy()
    # The largest first, so that rounding errors can never use more pieces than there are.
    for j in np.argsort(-used).tolist():
        column = basis[:, j].astype(np.int64)
        own = column > 0
        times = int(min(np.floor(used[j] + 1e-6), (left[own] // column[own]).min()))
        if times > 0:
            plan.append((column, times))
            left -= column * times
    while left.any():
        column, space = np.zeros(len(sizes), np.int64), room
        for i in range(len(sizes) - 1, -1, -1):
            column[i] = min(left[i], space // sizes[i])
            space -= int(column[i] * sizes[i])
        own = column > 0
        times = int((left[own] // column[own]).min())
        plan.append((column, times))
        left -= column * times
    return [({int(s): int(n) for s, n in zip(sizes, column, strict=True) if n}, times) for column, times in plan]


def packed(docs: DataFrame, capacity: int = CAPACITY, unit: int = UNIT, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece, and its ids where asked for.

    Sequences hold at most `capacity` tokens; offsets in a sequence have no gaps.  Null
    and empty texts are the end id alone.  Rows that repeat a doc_id are documents of
    their own, each packed once.  An empty table gives an empty result.
    """
    pieces = token_pieces(docs, capacity, path, with_ids)
    pieces = pieces.withColumn("size", F.ceil(F.col("length") / unit).cast("int"))
    with small_batches(docs.sparkSession):
        pieces = written(pieces if with_ids else pieces.drop("ids"), "pieces")
    histogram = {r["size"]: r["count"] for r in pieces.groupBy("size").count().collect()}
    slots, sequences, taken = [], 0, dict.fromkeys(histogram, 0)
    for pattern, times in patterns(histogram, -(-capacity // unit)):
        for size, copies in pattern.items():
            slots.append((size, taken[size], taken[size] + copies * times, copies, sequences))
            taken[size] += copies * times
        sequences += times
    layout = "slot_size int, from_rank long, to_rank long, copies long, first_sequence long"
    # A pattern has few classes, and there are about as many patterns as classes: the table is small for any input.
    plan = F.broadcast(docs.sparkSession.createDataFrame(slots, layout))
    buckets = max(32, sum(histogram.values()) // BUCKET_ROWS)
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    placed = ranked(pieces, ["size"], order, F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)), "place")
    fits = (F.col("size") == F.col("slot_size")) & (F.col("place") >= F.col("from_rank")) & (F.col("place") < F.col("to_rank"))
    placed = placed.join(plan, fits)
    placed = placed.withColumn("sequence_id", F.expr("first_sequence + (place - from_rank) DIV copies"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return placed.select(*columns, *(["ids"] if with_ids else []))
