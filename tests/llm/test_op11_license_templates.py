"""Template automata against backtracking over the same markup, and against plain search for phrases."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.llm.op11_license_templates import Automaton, Free, Region, Template, Words, automaton, known_templates, parse, scan_licenses
from wattline.llm.queries import op11_license_templates
from wattline.llm.words import word_pieces, words_of

PLAIN = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def ends(items, words, at):
    """Every place where a sequence of regions can end that begins at ``at``."""
    if not items:
        return {at}
    item, rest, out = items[0], items[1:], set()
    if isinstance(item, Words):
        if tuple(words[at : at + len(item.words)]) == item.words:
            out |= ends(rest, words, at + len(item.words))
    elif isinstance(item, Free):
        for n in range(item.high + 1):
            if at + n > len(words) or (n and item.pattern and not re.fullmatch(item.pattern.encode(), words[at + n - 1])):
                break
            if n >= item.low:
                out |= ends(rest, words, at + n)
    else:
        out |= ends(rest, words, at)
        for end in ends(item.items, words, at):
            out |= ends(rest, words, end)
    return out


MARKUPS = [
    "a b c", "a a", "a <<beginOptional>>b<<endOptional>> c", 'a <<var;name="x";original="b";words="0-2">> c',
    "a <<beginOptional>>b <<beginOptional>>b c<<endOptional>> a<<endOptional>> <<beginOptional>>c<<endOptional>>",
    '<<beginOptional>>b<<endOptional>> a <<var;name="x";match="[bc]";words="1-3">> a',
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.integers(1, 8))
def test_every_end_is_found(letters, piece):
    words = [w.encode() for w in letters]
    own = Automaton([Template(str(i), m) for i, m in enumerate(MARKUPS)])
    pieces = [words[i : i + piece] for i in range(0, len(words), piece)]
    found = set(own.accepted(pieces))
    every = {(t, i, e) for t, m in enumerate(MARKUPS) for i in range(len(words)) for e in ends(parse(m).items, words, i)}
    assert found <= every
    # of the matches with one end, at least the one that begins first is told
    assert {(t, e, min(i for u, i, f in every if (u, f) == (t, e))) for t, _, e in every} <= {(t, e, i) for t, i, e in found}


def test_phrases_on_every_document(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in op11_license_templates(spark, small).collect():
        words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (docs[r.doc_id] or "").encode().lower())]
        places = [(k, p.split()) for k, p in PLAIN.items()]
        hits = [(i, k) for k, p in places for i in range(len(words)) if words[i : i + len(p)] == p]
        assert (r.n_words, r.n_base) == (len(words), len(hits))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        base = {k for _, k in hits}
        assert r.base_labels == ",".join(sorted(base))
        labels = [x for x in r.labels.split(",") if x]
        assert base <= set(labels) and labels == sorted(set(labels)) and 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def found(text):
    own = automaton(known_templates())
    return sorted({own.templates[t].label for t, _, _ in own.matches(word_pieces(text))[0]})


@pytest.mark.parametrize(("text", "labels"), [
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]), ("Licensed under CC-BY 4.0", ["cc-by"]),
    ("released under the mit license", ["mit"]), ("Distributed under the terms of the MIT licence.", ["mit"]),
    ("licensed under the Apache License, v2.0", []), ("licensed under the Apache License v 2", ["apache-2"]),
    ("we spoke about the license of the mit lab, version 2", []), ("", []), (None, []),
])
def test_notices(text, labels):
    assert found(text) == labels


def test_whole_licenses():
    """The license texts that come with the public tokenizers; one changed word of the wording, and it isn't that license."""
    with open("/opt/tokenizers/LICENSES.txt") as f:
        mit = f.read().split("word_bpe_49k")[0]
    assert found(mit) == ["mit"]
    assert found(mit.replace("publish, distribute", "distribute")) == []
    assert found(mit.replace("THE AUTHORS OR COPYRIGHT HOLDERS BE", "SOME COMPANY OF OUR OWN BE")) == ["mit"]


def test_refused_markup():
    for markup in ("a <<beginOptional>> b", "a <<endOptional>>", "<<other>> a", 'a <<var;words="3-1">>'):
        with pytest.raises(ValueError):
            parse(markup)
    for markup in ("<<beginOptional>>a<<endOptional>>", '<<var;words="1-2">> a', ""):
        with pytest.raises(ValueError):
            Automaton([Template("x", markup)])
    assert parse("A b<<beginOptional>>C<<endOptional>>") == Region([Words((b"a", b"b")), Region([Words((b"c",))])])


def test_odd_rows(spark, docs, nothing):
    given_rows = docs.withColumns({"matches": F.lit(1), "coverage": F.lit("mine")})
    rows = scan_licenses(given_rows)
    assert set(rows.columns) == {*docs.columns, "n_words", "matches", "coverage"} - {"text"}
    assert rows.count() == docs.count() and rows.where("coverage <> 0 OR coverage IS NULL").count() == 0
    assert scan_licenses(nothing).count() == 0
    long = spark.createDataFrame([(1, "x " * 900_000 + "under the MIT license " * 70_000)], "doc_id bigint, text string")
    r = scan_licenses(long).select("n_words", F.size("matches").alias("n"), F.col("matches")[0]["start"].alias("s"), "coverage").first()
    assert (r.n_words, r.n, r.s) == (1_180_000, 140_000, 900_000) and r.coverage == pytest.approx(280 / 1180)
    assert len(words_of("x y")) == 2
