"""Cuts and forms against a plain reading of the contract."""

import hashlib

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.llm.op12_fill_in_middle import MARKS, Cuts, fill_in_middle, repeated, restored
from wattline.llm.queries import op12_fill_in_middle

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plainly(key, text):
    n, x = len(text), sha(f"1:{key}")
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    head, middle, tail = text[:i], text[i:j], text[j:]
    return n, form, i, j - i, f"<P>{head}<S>{tail}<M>{middle}" if form == "psm" else f"<S>{tail}<P>{head}<M>{middle}"


def test_every_document(spark, small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    forms = set()
    for r in op12_fill_in_middle(spark, small).collect():
        n, form, i, m, output = plainly(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, i, m, sha(output), sha(docs[r.doc_id]))
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é日😀\ń‍👩👧", max_size=60), st.sampled_from([".", r"\X", r"\S+|\s+"]), st.integers(1, 9))
def test_windows_change_nothing(text, unit, window):
    whole = [m.end() for m in regex.finditer(unit, text, regex.DOTALL)]
    for cuts in (Cuts(text, unit), Cuts(text, unit, window)):
        assert cuts.n == len(whole)
        assert [cuts.offset(k) for k in range(cuts.n + 1)] == [0, *whole]


def test_units_must_cover(spark):
    with pytest.raises(ValueError):
        repeated("a*")
    with pytest.raises(ValueError):
        Cuts("a b", r"\w")


def test_odd_rows(spark, docs, nothing):
    rows = docs.withColumns({"form": F.lit(3), "n": F.lit("x"), "output": F.lit(None).cast("int")})
    extra = spark.createDataFrame([(9, "has <M> inside"), (10, "<<P<S< S>" * 9), (11, "<" * 50)], "doc_id bigint, text string")
    for table in (rows, extra):
        made = fill_in_middle(table.withColumn("again", F.col("text")), keep=["doc_id", "again"])
        back = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
        assert len(back) == table.count()
        for r in back:
            text = r.again or ""
            assert r.back == text
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly("" if r.doc_id is None else r.doc_id, text)
    assert set(fill_in_middle(rows).columns) == {*rows.columns, "prefix_chars", "middle_chars"} - {"text"}
    assert fill_in_middle(nothing).count() == 0


def test_very_long_text(spark):
    text = "aé😀\n" * 700_000
    for r in fill_in_middle(spark.createDataFrame([(5, text), (6, text)], "doc_id bigint, text string")).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, text)
