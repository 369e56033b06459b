"""Benchmark passages: the filter loses nothing, the alignment is exact."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from wattline.llm import op1_decontamination as op1
from wattline.llm.op1_decontamination import align, band_counts, build_index, find_leaks, grams, matches, normalise, original_places

ITEM = "Which of the rivers that cross the old town carries the most water in spring, and why does it flood the lower market?"


def distance(a, b):
    """Fewest edits of a against any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_alignment_is_exact():
    rng = random.Random(1)
    for _ in range(400):
        a, b = (bytes(rng.choice(b"abc") for _ in range(rng.randint(1, n))) for n in (14, 30))
        budget = rng.randint(0, 5)
        edits, start, end = align(a, b, len(b), budget)
        true = distance(a, b)
        assert (edits <= budget) == (true <= budget)
        if true <= budget:
            assert edits == true == distance(a, b[start:end])


def test_codes_tell_grams_apart():
    data = bytes(random.Random(2).choice(b"abcd ") for _ in range(500))
    for q in (8, 12, 16):
        codes = grams(data, q).tolist()
        texts = [data[i : i + q] for i in range(len(data) - q + 1)]
        assert len(codes) == len(texts) and len(set(codes)) == len(set(texts))
    assert grams(b"short", 12).size == 0


def test_every_occurrence_within_the_budget_is_found():
    rng = random.Random(3)
    index = build_index([(7, ITEM), (8, ITEM.upper() + " " + "Another part entirely. " * 60)], q=12, rate=0.06)
    budget = int(index.budgets[0])
    assert budget >= 5
    for _ in range(200):
        s = list(ITEM)
        for _ in range(rng.randint(0, budget)):
            p = rng.randrange(len(s))
            s[p] = rng.choice([rng.choice("xyz"), "", s[p] + rng.choice("xyz")])
        around = ["", "Some words before. ", "q" * 3000][rng.randrange(3)]
        text = around + "".join(s) + [" And after.", ""][rng.randrange(2)]
        if distance(normalise(ITEM), normalise(text)) > budget:
            continue
        found = matches(index, ["unrelated text", text, None, ""])
        assert any(index.ids[m[0]] == 7 for m in found[1]) and not (found[0] or found[2] or found[3])


def test_repetitive_text_is_no_leak():
    index = build_index([(1, ITEM)], 12, 0.06)
    assert matches(index, ["the old town " * 3000, ITEM[:60] * 3]) == [[], []]


def test_places_in_the_original():
    text = "Intro\n\n  here:  " + ITEM.replace(" ", "\n  ") + "  end"
    index = build_index([(1, ITEM)], 12, 0.06)
    ((_, start, end, edits),) = matches(index, [text])[0]
    a, b = original_places(text, normalise(text), [start, end])
    assert edits == 0 and normalise(text[a:b]) == normalise(ITEM)


def test_table(spark, docs, nothing):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (None, ITEM), (4, "tiny"), (1, ITEM), (5, ITEM + " More of it follows here.")], "item_id bigint, text string")
    extra = docs.limit(2).selectExpr("900L AS doc_id", f'"{ITEM} tail" AS text', "lang", "source", "n_chars", "score", "n_tokens").limit(1)
    short = extra.selectExpr("901L AS doc_id", "' TINY ' AS text", "lang", "source", "n_chars", "score", "n_tokens")
    rows = docs.unionByName(extra).unionByName(short)
    for block in (1 << 20, 50):  # one block, and several
        found = {(r.doc_id, tuple(sorted({x.item_id for x in r.leaks}))) for r in find_leaks(rows, bench, block_bytes=block).where("size(leaks) > 0").collect()}
        assert found == {(900, (1,)), (901, (4,))}
    assert find_leaks(rows, bench).columns == [*rows.columns, "leaks"]
    assert find_leaks(nothing, bench).count() == 0 and find_leaks(docs, bench.limit(0)).where("size(leaks) > 0").count() == 0


def test_repeated_characters():
    """A line of one character in an item and a text full of it: bands are counted without spreading out the pairs."""
    index = build_index([(1, "-" * 400), (2, "ab" * 40 + " and then some more words of the item")], q=12, rate=0.06)
    started = time.process_time()
    found = matches(index, ["-" * 500_000 + " x " + "ab" * 200_000, "a short one", "-" * 390 + "+" + "-" * 9])
    assert time.process_time() - started < 60
    assert found[1] == [] and [m[0] for m in found[2]] == [0]
    places = [m[1:3] for m in found[0]]
    assert len(places) > 1000 and all(b - a <= 424 for a, b in places) and all(x[1] <= y[0] for x, y in zip(places, places[1:], strict=False))


def test_heavy_grams_keep_every_band(monkeypatch):
    rng = random.Random(9)
    items = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(60, 200)))) for i in range(4)]
    index = build_index(items, q=12, rate=0.06)
    texts = ["".join(rng.choice("ab") for _ in range(300)) + items[i % 4][1] + "ab" * 50 for i in range(6)]
    plain = matches(index, texts)
    for heavy in (0, 3):
        monkeypatch.setattr(op1, "HEAVY_PAIRS", heavy)
        monkeypatch.setattr(op1, "LOT", 7)
        assert matches(index, texts) == plain
    assert all(any(m[0] == i % 4 and m[3] == 0 for m in found) for i, found in enumerate(plain))
    assert [len(x) for x in band_counts(index, np.zeros(0, int), np.zeros(0, int), 10)] == [0, 0]


def test_columns_named_like_inner_ones(spark):
    rows = spark.createDataFrame([(1, "x " + ITEM, 3)], "doc_id bigint, text string, more int").withColumns({c: F.lit(c) for c in ("score", "key", "id", "c", "leak")})
    found = find_leaks(rows, spark.createDataFrame([(7, ITEM)], "item_id bigint, text string"))
    assert set(found.columns) == {*rows.columns, "leaks"} and found.first().more == 3 and len(found.first().leaks) == 1
