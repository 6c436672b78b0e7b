"""Quality rules, lines first.

Each line with a word is judged: by its punctuation, as navigation, as boilerplate.
Lines that fail are taken out; a document whose lost lines hold too much of its text
is rejected whole.  The base rules look at the words of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import WHITE_SPACE, bodies, in_batches, parts_of, rows_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
FEWEST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: Bytes of words in lines that fail, per cent of those in all lines.
MOST_LOST_PERCENT = 50

# Wording of page furniture and of placeholder text.
BOILERPLATE = (
    "lorem ipsum",
    "dolor sit amet",
    "consectetur adipiscing elit",
    "javascript",
    "cookie",
    "terms of use",
    "terms of service",
    "privacy policy",
    "all rights reserved",
    "subscribe",
    "newsletter",
    "sign in",
    "log in",
    "sign up",
    "click here",
    "read more",
    "add to cart",
    "powered by",
    "back to top",
    "share on",
)
#: Whole words; a byte beyond ASCII belongs to a word.
BOILERPLATE_WORDING = re.compile(rb"(?<![\w\x80-\xff])(?:%s)s?(?![\w\x80-\xff])" % "|".join(map(re.escape, BOILERPLATE)).encode())
SENTENCE_END = re.compile("[.!?…。！？:;,][\"'”’»)\\]]*$")
SEPARATORS = frozenset((b"|", b">", b"/", "»".encode(), "·".encode(), "•".encode()))
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Bytes of UTF-8 that begin no code point.
CONTINUATION = bytes(range(0x80, 0xC0))
REASONS = ("punctuation", "navigation", "boilerplate")


def line_fault(line: bytes, words: list[bytes]) -> str | None:
    """Why a line fails, or None.  `words` are those of the line, one at least.

    navigation: a separator stands for every three words or more.
    boilerplate: wording of page furniture makes up half of a short line or more.
    punctuation: symbols make up a tenth of it, or it has no letter and no digit,
    or it is long and has no sentence mark at all.
    """
    separators = sum(w in SEPARATORS for w in words)
    if separators and 4 * separators >= len(words):
        return "navigation"
    written = sum(map(len, words))
    if len(words) <= 20:
        wording = b"".join(BOILERPLATE_WORDING.findall(line.lower())).translate(None, WHITE_SPACE)
        if wording and 2 * len(wording) >= written:
            return "boilerplate"
    if 10 * (len(line) - len(line.translate(None, SYMBOLS))) >= written:
        return "punctuation"
    if not any(c.isalnum() for c in line.decode("utf-8", "replace")):
        return "punctuation"
    if len(words) > 100 and not any(SENTENCE_END.search(w.decode("utf-8", "replace")) for w in words):
        return "punctuation"
    return None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of `window` words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=len(words))
    mixed = (ids + np.uint64(1)) * MIX
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        hashes = hashes * STEP + mixed[i : i + n]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    # Windows with one hash are compared word by word.
    seen: dict[bytes, int] = {}
    covered = np.zeros(len(words), dtype=bool)
    for i in np.sort(order[np.concatenate((same, [False])) | np.concatenate(([False], same))]).tolist():
        first = seen.setdefault(ids[i : i + window].tobytes(), i)
        if first != i:
            covered[first : first + window] = True
            covered[i : i + window] = True
    return int(covered.sum())


def judged(body: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines lost by reason, bytes of words lost and in all, kept text."""
    body = body or b""
    words = body.split()
    bare = body.translate(None, WHITE_SPACE)
    chars = len(bare.translate(None, CONTINUATION))
    symbols = len(bare) - len(bare.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    duplicate, lost, faults, kept = 0, 0, dict.fromkeys(REASONS, 0), []
    for line in body.split(b"\n"):
        own = line.split()
        if not own:
            kept.append(line)
            continue
        duplicate += line in seen
        seen.add(line)
        fault = line_fault(line, own)
        if fault:
            faults[fault] += 1
            lost += sum(map(len, own))
        else:
            kept.append(line)
    return len(words), chars, symbols, duplicate, repeated_words(words), *faults.values(), lost, len(bare), b"\n".join(kept)


def verdict(n_words: int, n_repeat_words: int, lost_bytes: int, word_bytes: int) -> tuple[bool, bool]:
    """base_failed and kept."""
    failed = n_words < FEWEST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words
    return failed, not failed and 100 * lost_bytes <= MOST_LOST_PERCENT * word_bytes


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *(f"lost_{r}" for r in REASONS), "lost_bytes")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: counts, lines lost by reason, the verdicts, and the text without lost lines.

    A null text counts as empty, has no words and fails; repeated rows are judged each
    for itself; an empty table gives an empty result.  Columns: doc_id, those of
    COUNTS, base_failed, kept, kept_text.
    """
    fields = [("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("kept_text", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, body in rows_of(iter([batch])):
                *counts, word_bytes, text = judged(body)
                verdicts = verdict(counts[0], counts[4], counts[-1], word_bytes)
                found.append((doc_id, *counts, *verdicts, text.decode("utf-8", "replace")))
            yield from in_batches(iter(found), schema)

    columns = f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean, kept_text string"
    return bodies(docs).mapInArrow(run, columns)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, all their columns, texts without the lines that fail.

    `n_chars`, where it is a column, follows the text.  Each row is judged for itself,
    without a shuffle; other columns pass as they are, whatever their names.
    """
    at, counted = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            kept, texts = [], []
            for text in batch.column(at).to_pylist():
                *counts, word_bytes, left = judged(text.encode() if text is not None else None)
                kept.append(verdict(counts[0], counts[4], counts[-1], word_bytes)[1])
                texts.append(left.decode())
            columns = batch.columns
            columns[at] = pa.array(texts, columns[at].type)
            if counted is not None:
                columns[counted] = pa.array(map(len, texts), pa.int64()).cast(columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
