"""SentencePiece encoding as a max-plus parallel scan, and decoding.

The public vocabulary is a byte-pair one.  Its encoding of a text is the only cut into
pieces in which each two neighbours fit: merging the text of both alone gives them
back.  So the encoding is a best path: a piece that follows one it fits adds its
ids, one as a rule, and any other is impossible (minus infinity).  The state at a boundary is the piece that
covers or ends at it, and a chunk of a giant document is a matrix that says for each
state before it and each state after it how many ids the path between them has.
These matrices combine associatively; from the products before and after a boundary
follows the one state there, and each chunk finds its pieces on its own.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import Memo, in_batches, rows_of, written

VOCABULARY = "piece_bpe_32k.model"
#: Longest piece in characters, and so what a chunk sees of its neighbours.
LONGEST = 16
#: Characters of a chunk.
CHUNK = 32_768
SPACE = "▁"
#: No piece goes on into a new word, so words are encoded each for itself.
WORD_BYTES = re.compile(rb" *[^ ]+| +")
NEVER = float("-inf")
BOUNDARY = re.compile(f"(?<=[^{SPACE}]){SPACE}")
#: Words whose ids a task keeps, and pairs of pieces that it knows to fit or not.
MOST_KNOWN, MOST_PAIRS = 700_000, 200_000
State = tuple[str, int]


class Model:
    def __init__(self, path: str | None):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
        size = model.get_piece_size()
        self.bytes_of = {i: bytes([int(model.id_to_piece(i)[3:5], 16)]) for i in range(size) if model.is_byte(i)}
        self.byte_ids = {b[0]: i for i, b in self.bytes_of.items()}
        own = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i): i for i in own}
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in own}
        self.texts = {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()} | self.bytes_of
        # Whether a text is a piece that merging gives; False: it only begins one.
        self.begun: dict[str, bool] = {}
        for piece in self.ids:
            for end in range(1, len(piece)):
                self.begun.setdefault(piece[:end], end == 1)
            self.begun[piece] = len(piece) == 1 or self.merged(piece) == [piece]
        self.fits = Memo(lambda pair: not pair[0] or self.merged(pair[0] + pair[1]) == list(pair), MOST_PAIRS)
        self.words = Memo(self.word_ids, MOST_KNOWN)

    def text_ids(self, body: bytes) -> bytes:
        """The ids of a whole text.  Words are looked up as bytes, which take less room."""
        if not body:
            return b""
        body = b" " + body.replace(SPACE.encode(), b" ")
        return b"".join(map(self.words.__getitem__, WORD_BYTES.findall(body)))

    def word_ids(self, body: bytes) -> bytes:
        """Merging takes the square of a word's length, the best path its length: short words are merged."""
        word = body.decode().replace(" ", SPACE)
        return self.as_ids(self.merged(word) if len(word) <= 2 * LONGEST else self.path(word, ("", 0), len(word)))

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text as its definition says: the best pair is merged first, the leftmost of equals."""
        parts, score = list(text), self.scores.get
        scores = [score(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > NEVER:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def weight(self, piece: str) -> int:
        return 1 if piece in self.ids else len(piece.encode())

    def ends(self, text: str, state: State, stop: int) -> dict[int, tuple[str, int]]:
        """From a state on: for each place up to `stop` that a path reaches, the last piece and the number of ids."""
        found = {state[1]: (state[0], 0)}
        for start in range(state[1], stop):
            if start not in found:
                continue
            before, number = found[start]
            for end in range(start + 1, min(stop, start + LONGEST) + 1):
                piece = text[start:end]
                usable = self.begun.get(piece, False if end > start + 1 else True)
                if usable and end not in found and self.fits[before, piece]:
                    found[end] = piece, number + self.weight(piece)
                elif not usable and piece not in self.begun:
                    break
        return found

    def back(self, found: dict[int, tuple[str, int]], start: int, stop: int) -> list[str]:
        pieces = []
        while stop > start:
            pieces.append(found[stop][0])
            stop -= len(pieces[-1])
        return pieces[::-1]

    def path(self, text: str, state: State, stop: int) -> list[str]:
        return self.back(self.ends(text, state, stop), state[1], stop)

    def as_ids(self, pieces: list[str]) -> bytes:
        ids: list[int] = []
        for piece in pieces:
            own = self.ids.get(piece)
            ids += [own] if own is not None else [self.byte_ids[b] for b in piece.encode()]
        return struct.pack(f"<{len(ids)}I", *ids)

    def states(self, text: str, boundary: int) -> list[State]:
        """The pieces that begin before a boundary and end at it or behind: all states that it can have."""
        starts = range(max(0, boundary - LONGEST), boundary)
        ends = range(boundary, min(len(text), boundary + LONGEST - 1) + 1)
        return [(text[s:e], e) for s in starts for e in ends if self.begun.get(text[s:e], e == s + 1)]

    def inner(self, text: str, begin: int, stop: int) -> tuple[int, int] | None:
        """The first and the last word start in a chunk at which all states meet."""
        found = [m.start() for m in BOUNDARY.finditer(text, begin, stop)]
        return (found[0], found[-1]) if found else None

    def inner_words(self, text: str) -> list[bytes]:
        return WORD_BYTES.findall(text.replace(SPACE, " ").encode())

    def reach(self, row: np.ndarray, found: dict[int, tuple[str, int]], after: list[State]) -> None:
        for j, (piece, end) in enumerate(after):
            last = found.get(end - len(piece))
            if last is not None and self.fits[last[0], piece]:
                row[j] = last[1] + self.weight(piece)

    def transfer(self, text: str, before: list[State], after: list[State], stop: int) -> np.ndarray:
        """How many ids lead from each state before the chunk to each state after it."""
        matrix = np.full((len(before), len(after)), -np.inf)
        meet = self.inner(text, max(e for _, e in before) + 1, stop)
        if meet:
            middle = sum(len(self.words[w]) // 4 for w in self.inner_words(text[meet[0] : meet[1]]))
            tail = self.ends(text, ("", meet[1]), stop)
        for i, state in enumerate(before):
            if state[1] >= stop and state in after:  # one piece covers the whole chunk
                matrix[i, after.index(state)] = 0
            elif meet:
                head = self.ends(text, state, meet[0])
                if meet[0] not in head:
                    continue
                found = {p: (piece, n + head[meet[0]][1] + middle) for p, (piece, n) in tail.items()}
                self.reach(matrix[i], found, after)
            else:
                self.reach(matrix[i], self.ends(text, state, stop), after)
        return matrix

    def chunk_ids(self, text: str, before: State, after: State, stop: int) -> bytes:
        """The ids of the pieces after the state before the chunk, the state after it included."""
        if before == after:
            return b""
        piece, end = after
        target = end - len(piece)
        meet = self.inner(text, before[1] + 1, target + 1)
        if meet:
            head = self.as_ids(self.path(text, before, meet[0]))
            middle = b"".join(map(self.words.__getitem__, self.inner_words(text[meet[0] : meet[1]])))
            return head + middle + self.as_ids([*self.path(text, ("", meet[1]), target), piece])
        return self.as_ids([*self.path(text, before, target), piece])


@lru_cache(maxsize=1)
def model(path: str | None) -> Model:
    return Model(path)


def max_plus(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The product of two matrices where sums are maxima and products are sums."""
    return (left[:, :, None] + right[None, :, :]).max(axis=1, initial=-np.inf)


def boundary_choices(matrices: list[np.ndarray]) -> list[int]:
    """The state at each boundary of a document, from the products of all matrices before and behind it."""
    before = [np.zeros((1, 1))]
    for matrix in matrices:
        before.append(max_plus(before[-1], matrix))
    behind = [np.zeros((matrices[-1].shape[1], 1))]
    for matrix in reversed(matrices):
        behind.append(max_plus(matrix, behind[-1]))
    return [int((b[0] + a[:, 0]).argmax()) for b, a in zip(before, reversed(behind), strict=True)]


def chunk_states(own: Model, text: str, lead: int, at: int, total: int, chunk: int) -> tuple[list[State], list[State], int]:
    """States before and after a chunk that begins `lead` characters into `text`, and its end there."""
    stop = min(lead + chunk, lead + total - at)
    last = at + chunk >= total
    before = own.states(text, lead) if at else [("", 0)]
    after = own.states(text, stop)
    return before, [s for s in after if s[1] == stop] if last else after, stop


def encoded_whole(docs: DataFrame, path: str | None) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own = model(path)
        for doc_id, body in rows_of(batches):
            yield doc_id, own.text_ids(body or b"")

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("body"))
    return rows.mapInArrow(lambda b: in_batches(run(b), schema, 1024), "doc_id long, ids binary")


def encoded_chunks(docs: DataFrame, chunk: int, path: str | None) -> DataFrame:
    """The same for giant documents, whose chunks are encoded in tasks of their own."""
    text = F.concat(F.lit(SPACE), F.translate("text", " ", SPACE))
    rows = docs.select("doc_id", text.alias("text")).withColumn("total", F.length("text").cast("long"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("at", F.explode(F.expr(f"sequence(0L, total - 1, {chunk}L)"))).withColumn("lead", F.expr(f"least(at, {LONGEST}L)"))
    part = F.expr(f"substring(text, CAST(at - lead + 1 AS INT), CAST({chunk + LONGEST} + lead AS INT))")
    rows = written(rows.select("row", "doc_id", "at", "total", "lead", part.alias("part")), "text-chunks")
    # Few rows hold much text: each becomes a task's input of its own size.
    rows = rows.repartition("row", "at")
    columns = ["row", "at", "total", "lead", "part"]

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own = model(path)
        for row, at, total, lead, part in rows_of(batches):
            before, after, stop = chunk_states(own, part, lead, at, total, chunk)
            matrix = own.transfer(part, before, after, stop)
            yield row, at, len(before), matrix.ravel().tolist()

    schema = pa.schema([("row", pa.int64()), ("at", pa.int64()), ("states", pa.int64()), ("matrix", pa.list_(pa.float64()))])
    matrices = rows.select(*columns).mapInArrow(lambda b: in_batches(transfers(b), schema, 64), "row long, at long, states long, matrix array<double>")

    def chosen(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("at")
        picks = boundary_choices([np.array(m).reshape(n, -1) for m, n in zip(own["matrix"], own["states"], strict=True)])
        return pd.DataFrame({"row": own["row"], "at": own["at"], "first": picks[:-1], "last": picks[1:]})

    # A group is the matrices of one document, some dozen states wide.
    picks = matrices.groupBy("row").applyInPandas(chosen, "row long, at long, first long, last long")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own = model(path)
        for row, at, total, lead, part, doc_id, first, last in rows_of(batches):
            before, after, stop = chunk_states(own, part, lead, at, total, chunk)
            yield row, doc_id, at, own.chunk_ids(part, before[first], after[last], stop)

    found = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("ids", pa.binary())])
    parts = rows.join(picks, ["row", "at"]).select(*columns, "doc_id", "first", "last")
    parts = parts.mapInArrow(lambda b: in_batches(pieces(b), found, 64), "row long, doc_id long, at long, ids binary")

    def whole(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("at")
        return pd.DataFrame({"doc_id": own["doc_id"].iloc[:1], "ids": [b"".join(own["ids"])]})

    return parts.groupBy("row").applyInPandas(whole, "doc_id long, ids binary")


def encoded(docs: DataFrame, chunk: int = CHUNK, path: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of every row of `docs`.

    The ids are those that the SentencePiece library gives for the vocabulary's file
    (`path`).  Null and empty texts have none.  Repeated rows, and those with a null
    doc_id, get a row each.  An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    return encoded_whole(rows.where(~giant), path).unionByName(encoded_chunks(rows.where(giant), chunk, path))


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of every row of `ids`; null ids are none.  Ids beyond the vocabulary are an error."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        texts = model(path).texts
        for doc_id, own in rows_of(batches):
            text = b"".join(map(texts.__getitem__, np.frombuffer(own or b"", "<u4").tolist())).decode("utf-8", "replace")
            yield doc_id, text.removeprefix(" ")

    return ids.select("doc_id", "ids").mapInArrow(lambda b: in_batches(run(b), schema, 1024), "doc_id long, text string")


def round_trip(docs: DataFrame, chunk: int = CHUNK, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, and length and hash of the decoded text, of every row of `docs`."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_chars", pa.int64()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        texts = model(path).texts
        for doc_id, own in rows_of(batches):
            text = b"".join(map(texts.__getitem__, np.frombuffer(own or b"", "<u4").tolist())).decode("utf-8", "replace").removeprefix(" ")
            yield doc_id, len(own) // 4, zlib.crc32(own), len(text), hashlib.sha256(text.encode()).hexdigest()

    columns = "doc_id long, n_tokens long, ids_crc32 long, decoded_chars long, decoded_sha256 string"
    return encoded(docs, chunk, path).mapInArrow(lambda b: in_batches(run(b), schema), columns)
