from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa

from ridemill.llm import quality_rules as op

from . import cases


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    repeated = {i + k for own in places.values() if len(own) > 1 for i in own for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_base_counts(spark):
    texts = cases.odd_texts() + [(20, "a b c d e " * 3 + cases.prose(3, 100) + "\nx\nx\ny\n\n\nx"), (21, "p q r s t u " + "p q r s t")]
    found = op.quality_rules(cases.table(spark, texts)).collect()
    assert len(found) == len(texts)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    wanted = sorted(((d, *brute(t)) for d, t in texts), key=repr)
    assert sorted(((r.doc_id, *(r[c] for c in columns)) for r in found), key=repr) == wanted
    assert all(not (r.base_failed and r.kept) for r in found)


def test_lines_are_judged_first():
    def fault(line):
        return op.line_fault(line.encode(), line.encode().split())

    assert fault("Home | News | Sport | About") == "navigation"
    assert fault("All rights reserved 2020") == "boilerplate"
    assert fault("wor## ld*** a%%% b&&&") == "punctuation"
    assert fault("--- ... ---") == "punctuation"
    assert fault("x " * 150) == "punctuation"
    assert fault("A plain line of words that simply ends") is None
    assert fault("Élan vital, c'est ça.") is None


def test_rejects_documents_that_lose_too_much(spark):
    good = cases.prose(5, 80)
    bad = "\n".join("aa | bb | cc | dd%d" % i for i in range(30))
    docs = cases.table(spark, [(1, good), (2, bad), (3, good + "\n" + "x | y | z"), (4, bad + "\n" + cases.prose(6, 30)), (5, None)])
    left = op.quality_filter(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in left.collect()} == {1: (good, len(good)), 3: (good, len(good))}


def test_empty_table(spark):
    assert op.quality_rules(cases.table(spark, [])).collect() == []
    assert op.quality_filter(cases.table(spark, [])).collect() == []


def test_boilerplate_is_whole_words_and_most_of_the_line(spark):
    def fault(line):
        return op.line_fault(line.encode(), line.encode().split())

    clean = (
        "She wrote the catalog in two months.",
        "They had a dialog in French.",
        "He taught design in Rome.",
        "And is erer. Ereaes oftheshare onstor.",
        "The baker put one more cookie on each plate and smiled.",
        "Read more books by candlelight, said the old teacher to us.",
        "Le prélog in extenso, dit-il.",
    )
    assert [fault(x) for x in clean] == [None] * len(clean)
    furniture = ("Sign in", "LOG IN | Sign up", "Accept cookies", "Subscribe to our newsletter", "Click here to read more", "Lorem ipsum dolor sit amet, consectetur adipiscing elit.")
    assert [fault(x) for x in furniture] == ["boilerplate"] * len(furniture)
    texts = [(1, clean[4]), (2, "\n".join(clean))]
    assert {r.doc_id: r.text for r in op.quality_filter(cases.table(spark, texts)).collect()} == dict(texts)


def test_the_filter_holds_few_texts_at_once():
    class Rows:
        columns, schema = ["doc_id", "text"], None

        def mapInArrow(self, run, schema):
            return run

    given = pa.RecordBatch.from_pydict({"doc_id": list(range(1_500)), "text": [cases.prose(i, 60, 4000) for i in range(1_500)]})
    run = op.quality_filter(Rows())
    made, alone = list(run(iter([given]))), list(run(given.slice(i, 1) for i in range(given.num_rows)))
    assert len(made) == 3 and all(batch.num_rows <= 512 for batch in made)
    assert pa.Table.from_batches(made).to_pylist() == pa.Table.from_batches(alone).to_pylist()
