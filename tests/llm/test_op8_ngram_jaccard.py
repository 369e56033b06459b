"""The join against all pairs, and the bounds it rests on."""

import numpy as np
import pytest

from wattline.llm import op8_ngram_jaccard as op8
from wattline.llm.components import connected_components
from wattline.llm.op8_ngram_jaccard import Bound, block_links, components, link_sets, may_link, parities, shingle_sets, signatures


def words_of(text):
    return (text or "").encode().lower().split()


def truth(rows, percent, width):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    links = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in sorted(links):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return sets, links, {i: find(i) for i in sets}


@pytest.fixture(scope="module")
def rows():
    """Families of texts with more and more edits, exact copies, short ones, and a passage that all share."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary, 12))
    out, key = [], 0
    for _ in range(25):
        base = list(rng.choice(vocabulary, int(rng.choice([3, 6, 12, 25, 60, 150]))))
        for copy in range(int(rng.integers(1, 9))):
            text = base[:]
            for _ in range(int(rng.integers(0, 1 + len(base) // 12)) if copy else 0):
                text[int(rng.integers(len(text)))] = str(rng.choice(vocabulary))
            if rng.random() < 0.15:
                text = text[: -max(1, len(text) // 15)]
            out.append((key := key + 1, (passage + "\n" if rng.random() < 0.3 else "") + " ".join(text)))
    out += [(key + 1, None), (key + 2, ""), (key + 3, " \t\n"), (key + 4, "one"), (key + 5, "ONE"), (key + 6, "one two"), (key + 7, "é one two")]
    return out


@pytest.mark.parametrize(("percent", "width"), [(90, 3), (80, 5), (60, 2)])
def test_against_all_pairs(spark, rows, percent, width):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets, links, roots = truth(rows, percent, width)
    assert len(links) > 20
    found = {r.id: (r.n_shingles, r.component) for r in components(df, "doc_id", "text", percent, width).collect()}
    assert found == {i: (len(sets[i]), roots[i]) for i in sets}


def test_all_links_in_small_blocks(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets, links, _ = truth(rows, 80, 3)
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    wanted = {(a, b): len(sets[a] & sets[b]) for a, b in links if first[sets[a]] == a and first[sets[b]] == b}
    _, _, found = link_sets(df, "doc_id", "text", 80, 3, block=2, all_links=True)
    assert {tuple(sorted((r.a, r.b))): r.overlap for r in found.collect()} == wanted


@pytest.mark.parametrize(("percent", "width", "block", "cells"), [(90, 3, 7, 400_000), (80, 5, 2, 120)])
def test_families_of_many_blocks(spark, rows, percent, width, block, cells):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    _, _, roots = truth(rows, percent, width)
    assert {r.id: r.component for r in components(df, "doc_id", "text", percent, width, block, cells).collect()} == roots


def test_a_family_of_five_thousand(spark, edits=9):
    """Each text edited on its own: linked in part."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 10_000, 150)
    rows = []
    for i in range(5000):
        text = base.copy()
        text[rng.choice(150, rng.integers(0, edits), replace=False)] = rng.integers(10_000, 10**8)
        rows.append((i, " ".join(map(str, text))))
    codes, sets = {}, []
    for _, t in rows:
        w = t.split()
        sets.append({codes.setdefault(tuple(w[k : k + 3]), len(codes)) for k in range(148)})
    incidence = np.zeros((5000, len(codes)), np.float32)
    for i, x in enumerate(sets):
        incidence[i, list(x)] = 1
    often = incidence[:, incidence.sum(axis=0) > 1]
    overlap, n = often @ often.T, incidence.sum(axis=1)
    linked = 100 * overlap >= 90 * (n[:, None] + n[None, :] - overlap)
    root, left = np.full(5000, -1), set(range(5000))
    while left:
        todo = [min(left)]
        first = todo[0]
        while todo:
            x = todo.pop()
            if x in left:
                left.discard(x)
                root[x] = first
                todo += [y for y in np.flatnonzero(linked[x]).tolist() if y in left]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.id: r.component for r in components(df).collect()}
    assert found == dict(enumerate(root.tolist()))


def test_rows_without_an_id(spark):
    rows = [(None, "a b c d e f"), (None, "A b c d e f"), (3, "p q r s t u"), (None, "p q r s t u"), (None, None), (-4, "k l m n o p"), (None, "k l m n o p"), (None, "y y y z")]
    found = components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.id, r.n_shingles, r.component) for r in found), key=repr) == sorted(
        [(None, 4, None), (None, 4, None), (3, 4, 3), (None, 4, 3), (None, 0, None), (-4, 4, -4), (None, 4, -4), (None, 2, None)], key=repr)


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_bounds(percent):
    bound, rng = Bound(percent), np.random.default_rng(0)
    levels = [bound.level(n) for n in range(1, 1200)]
    assert all(levels[m - 1] - levels[n - 1] <= 1 for n in range(1, 1200) for m in range(n, min(1200, 100 * n // percent + 1)))
    linked = 0
    for _ in range(4000):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 150), dtype=np.uint64))
        kept = x[rng.permutation(len(x))[: max(1, len(x) - int(rng.integers(0, 1 + len(x) // 4)))]]
        y = np.unique(np.concatenate((kept, rng.integers(0, 1 << 63, rng.integers(0, 4), dtype=np.uint64))))
        if bound.linked(len(np.intersect1d(x, y)), len(x), len(y)):
            linked += 1
            assert len(np.intersect1d(signatures(x, bound), signatures(y, bound)))
            common = len(np.intersect1d(x[: bound.front(len(x))], y[: bound.front(len(y))]))
            assert common >= max(bound.needed(len(x)), bound.needed(len(y)))
    assert linked > 300


def test_product_over_column_ranges():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    a, b, overlap = block_links(sets[:6], sets[6:], False, Bound(50), columns=7)
    found = dict(zip(zip(a.tolist(), b.tolist(), strict=True), overlap.tolist(), strict=True))
    for i, x in enumerate(sets[:6]):
        for j, y in enumerate(sets[6:]):
            o = len(np.intersect1d(x, y))
            assert ((i, j) in found) == (100 * o >= 50 * (len(x) + len(y) - o)) and found.get((i, j), o) == o


def test_words():
    assert [len(s) for s in shingle_sets(["a b c", "A B C d", None, "", "a\x0bb", "a b"], 3)] == [1, 2, 0, 0, 1, 1]
    one, two, other = shingle_sets(["A\tb \x0cC", "a b c", "a b"], 3)
    assert (one == two).all() and one[0] != other[0]


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [tuple(map(int, rng.integers(200, 400, 2))) for _ in range(150)]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    for in_one_task in (0, 1000):
        found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), in_one_task=in_one_task).collect()
        assert {r.node: r.component for r in found} == {n: find(n) for e in edges if e[0] != e[1] for n in e}
        assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), in_one_task=in_one_task - 1).count() == 0


def test_odd_tables(spark, docs, nothing):
    found = sorted(components(docs).collect(), key=lambda r: (r.id is None, r.id))
    assert [(r.id, r.component) for r in found] == [(1, 1), (2, 2), (3, 3), (4, 1), (4, 1), (5, 5), (6, 6), (None, None)]
    assert components(nothing).count() == 0


def test_rows_of_a_repeated_id_belong_together(spark):
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (3, "p q r s t u"), (5, "p q r s t u"), (5, None), (6, "k l m n o p"), (7, None)]
    found = components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.id, r.component) for r in found.collect()) == [(1, 1), (3, 1), (5, 1), (5, 1), (5, 1), (6, 6), (7, 7)]


def test_parities_never_hide_a_link():
    rng = np.random.default_rng(4)
    bound = Bound(80)
    for size in (1, 5, 40, 700):
        whole = rng.integers(0, 2**63, 2 * size).astype(np.uint64)
        sets = [np.unique(np.concatenate((whole[: size + rng.integers(0, size // 4 + 1)][rng.random() < 0.5 :], whole[-rng.integers(1, size + 1) :]))) for _ in range(30)]
        sets += [np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for _ in range(30)]
        n = np.array([len(x) for x in sets])
        ok = may_link([parities(x) for x in sets], n, [parities(x) for x in sets], n, bound)
        shared = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
        linked = bound.linked(shared, n[:, None], n[None, :])
        assert not (linked & ~ok).any() and linked.sum() > len(sets)
    assert ok.sum() < 0.7 * ok.size


def test_fronts_and_sets_are_shuffled_once(spark, rows, monkeypatch):
    """No stored step filters its fronts by a semi-join more than once, and none filters finished sets by one."""
    plans, store = [], op8.materialize
    monkeypatch.setattr(op8, "materialize", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or store(df))
    link_sets(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    assert len(plans) > 3 and max(p.count("LeftSemi") for p in plans) == 1
    assert [p.count("LeftSemi") for p in plans if "signs#" in p and "MapInArrow" in p] == [0]


def test_one_set_of_many_writings_and_many_sets_of_one_id(spark):
    one, two = "a b c d e f g h i j k l m n o p q r s t u v", "k1 k2 k3 k4 k5 k6 k7 k8 k9 l1 l2 l3 l4 l5 l6 l7 l8 l9 m1 m2 m3 m4"
    rows = [(7, one), (7, one.upper()), (7, one.replace(" ", "\t")), (7, two), (7, two), (8, one + " w"), (9, two + " w"), (10, "z z z z"), (None, two + " w x")]
    found = components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.id or 0, r.n_shingles, r.component) for r in found.collect()) == [
        (0, 22, 7), *[(7, 20, 7)] * 5, (8, 21, 7), (9, 21, 7), (10, 1, 10)]
