import hashlib
import random
import re

import pytest
from llm_tools import documents, odd_rows, sentence
from tidemark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, items):
    out = []
    for doc, text, _ in rows:
        found, hit, met = words(text), set(), set()
        for item, phrase in items:
            listed = words(phrase)
            width = min(13, len(listed))
            windows = {tuple(listed[i : i + width]) for i in range(len(listed) - width + 1)} if listed else ()
            for i in range(len(found) - width + 1):
                if tuple(found[i : i + width]) in windows:
                    hit |= set(range(i, i + width))
                    met |= set() if item is None else {str(item)}
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((doc, len(found), len(hit), len(met), digest, bool(hit) and 20 * len(hit) >= len(found)))
    return sorted(out, key=str)


def planted():
    rng = random.Random(8)
    items = [(i, sentence(rng, rng.choice([1, 2, 5, 12, 13, 14, 40]), 60)) for i in range(30)]
    items += [(2, "Two words"), (100, None), (101, ""), (None, "no id at all"), (5, items[7][1])]
    rows = odd_rows()
    for i in range(60):
        text = sentence(rng, rng.randrange(0, 300), 60).split()
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            cut = (rng.choice(items)[1] or "").upper().replace(" ", ", ")
            text[at:at] = cut.split() * rng.choice([1, 1, 2])
        rows.append((100 + i, " ".join(text), None))
    return rows, items


@pytest.mark.parametrize("block", [200_000, 20])
def test_report_equals_plain_search(spark, block):
    rows, items = planted()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.report(documents(spark, rows), benchmark, block=block).drop("hit_spans")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)


def test_keep_clean_drops_the_contaminated_only(spark):
    rows, items = planted()
    docs = documents(spark, rows)
    kept = decontaminate.keep_clean(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((r[0] for r in brute(rows, items) if not r[5]), key=str)


def test_passages_of_items_without_id_are_hit(spark):
    phrase = " ".join(f"u{i}" for i in range(15))
    benchmark = spark.createDataFrame([(None, phrase), (7, phrase[:20])], "item_id bigint, text string")
    docs = documents(spark, [(1, f"before {phrase} after", None), (2, "clean", None)])
    rows = {r["doc_id"]: r for r in decontaminate.report(docs, benchmark).collect()}
    assert (rows[1]["n_hit"], rows[1]["n_items"], rows[1]["contaminated"]) == (15, 1, True)
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark).collect()] == [2]


def test_empty_benchmark_finds_nothing(spark):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontaminate.report(documents(spark, odd_rows()), empty).collect()
    assert len(rows) == len(odd_rows()) and not any(r["contaminated"] for r in rows)
