"""Token ids, counts and spans against the library."""

import hashlib
import struct

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from wattline.llm.op9_token_counts import count_tokens
from wattline.llm.op10_sentencepiece import decode, encode, encode_digests
from wattline.llm.pieces import CharMap, Codec, codec, read_model
from wattline.llm.queries import model_path

ODD = ["", "a", " ", "  a", "a\n b\n\n", "▁", "▁▁ x", "\t\r\n", "é́ 日本語 😀\x00z", "<s></s><0x0A>", "a▁b ▁ c", "x" * 5000, " " * 40 + "b\n" + " " * 33]


@pytest.fixture(scope="module")
def own():
    return codec(read_model(model_path()))


def check(own, texts):
    lib = own.lib
    for text, e in zip(texts, own.encode(texts), strict=True):
        assert e.ids.tolist() == lib.encode(text, add_bos=True, add_eos=True)
        data = text.encode()
        assert b"".join(data[a:b] for a, b in zip(e.starts, e.ends, strict=True)) == data
        for i, a, b in zip(e.ids.tolist(), e.starts, e.ends, strict=True):
            if own.kinds[i] == 1 and a:  # a normal piece stands for its own bytes; the first also for the prefix
                assert own.pieces[i].replace("▁", " ").encode() in (data[a:b], data[a:b].replace("▁".encode(), b" "))


def test_odd_texts(own):
    check(own, ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t▁é日😀.X"), max_size=40), min_size=1, max_size=5))
def test_any_text(own, texts):
    check(own, texts)


def test_memory_is_renewed(own, monkeypatch):
    monkeypatch.setattr(type(own.cuts), "REMEMBERED", 10)
    check(own, [f"word{i} other{i}" for i in range(50)])
    check(own, ["word1 other49 new"])


def compiled(rules: dict[bytes, bytes]) -> bytes:
    """A character map by the public double-array layout, built place by place."""
    strings, where = b"", {}
    for value in rules.values():
        where.setdefault(value, len(strings))
        strings += value + b"\0"
    units, taken = [0] * 4096, {0}
    todo = [(0, b"")]
    while todo:
        at, prefix = todo.pop()
        nexts = sorted({k[len(prefix)] for k in rules if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in rules
        for base in range(1, 2000):
            cells = [at ^ base ^ c for c in nexts] + ([at ^ base] if leaf else [])
            if base < 1 << 21 and not any(c in taken for c in cells):
                break
        taken.update(cells)
        units[at] = (units[at] & 0xFF) | base << 10 | leaf << 8
        if leaf:
            units[at ^ base] = 1 << 31 | where[rules[prefix]]
        for c in nexts:
            units[at ^ base ^ c] = c
            todo.append((at ^ base ^ c, prefix + bytes([c])))
    array = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(array)) + array + strings


RULES = {"ﬁ".encode(): b"fi", "é".encode(): b"e", "é".encode(): b"E", "ab".encode(): b"X Y", "a".encode(): b"A", "　".encode(): b" ", "​".encode(): b""}


def field(number: int, payload: bytes) -> bytes:
    size = b""
    n = len(payload)
    while True:
        size += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return bytes([number << 3 | 2]) + size + payload


@pytest.mark.parametrize("squeeze", [0, 1])
def test_character_map(squeeze):
    blob = compiled(RULES)
    assert CharMap(blob).longest(b"abc", 0) == (2, b"X Y")
    assert CharMap(blob).longest(b"zz", 0) is None
    spec = field(1, b"own") + field(2, blob) + bytes([3 << 3, 1, 4 << 3, squeeze])
    model = Codec(read_model(model_path()) + field(3, spec))
    assert model.cuts is None
    for text in ["ﬁne café ab", "  ab  a   b ", "é é", "a　b​c", "​", "ab", "  ", " a", "x​ y", "abé"]:
        normal, origin = model.normalise(text.encode())
        assert normal.decode() == model.lib.normalize(text).replace(" ", "▁"), text
        ids = model.lib.encode(text, add_bos=True, add_eos=True)
        e = model.align(text, np.array(ids, np.uint32))
        assert len(origin) == len(normal) + 1
        assert (np.diff(e.starts) >= 0).all() and (e.ends >= e.starts).all() and e.ends[-1] <= len(text.encode())


def test_tables(spark, docs, nothing):
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    found = count_tokens(docs, model_path(), limit=10)
    assert "score" in found.columns and found.columns.count("n_tokens") == 1
    for row, text in zip(found.collect(), [r.text for r in docs.collect()], strict=True):
        ids = lib.encode(text or "")
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (len(ids), len((text or "").encode()), len(ids) > 10)
    for row, text in zip(encode_digests(docs, model_path(), ["doc_id"]).collect(), [r.text or "" for r in docs.collect()], strict=True):
        ids = lib.encode(text, add_bos=True, add_eos=True)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest() and row.spans_cover
    coded = encode(docs.drop("n_tokens"), model_path(), spans=True, check=True)
    assert [r.decoded for r in decode(coded, model_path()).collect()] == [r.text or "" for r in docs.collect()]
    assert count_tokens(nothing, model_path(), 10).count() == 0 == encode(nothing, model_path()).count()
