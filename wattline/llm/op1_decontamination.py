"""Benchmark passages in documents: q-gram lemma filter and banded alignment.

Texts are lower-cased, white space runs become one space; characters are the bytes of the result. An item of m
characters that occurs with at most k edits shares at least ``m + 1 - q * (k + 1)`` q-grams with the document, on
diagonals (document place minus item place) no further apart than k. Shared q-grams are counted in diagonal bands that
overlap by k, so that every occurrence lies whole in one band; bands below the lemma's count are discarded, and the
region of each other band is aligned with the item in a band of the same width. ``k`` is ``rate`` times m.

Items come in blocks of bounded size; each block's q-gram index is sent to all tasks and meets all documents.
Long items are searched in consecutive pieces.

Defined results: null and empty documents and items match nothing; an item with less than ``q`` characters matches
only a document that equals it (both normalised); an item whose budget leaves no q-gram to count is searched with the
largest budget that does; items that repeat (same id) are searched each; places are characters of the original text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_texts

BITS = 22
#: Pairs of places that are spread out at once, and above which a gram is counted band by band.
LOT, HEAVY_PAIRS = 1 << 18, 1 << 16
REGIONS = 1024
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def normalise(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode()


def grams(data: bytes, q: int) -> np.ndarray:
    """A 64-bit code of the q bytes at every place (8 <= q <= 16); for q = 8 it is those bytes themselves."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    words = np.empty(len(data) - 7, np.uint64)
    for shift in range(min(8, len(words))):
        part = np.frombuffer(data, "<u8", (len(data) - shift) // 8, shift)
        words[shift::8] = part[: len(words[shift::8])]
    return words[:n] * MIX + (words[q - 8 : q - 8 + n] ^ (words[:n] >> np.uint64(32))) * MIX2


@dataclass
class Index:
    """The q-grams of a block of items."""

    q: int
    ids: list  # of pieces
    pieces: list[bytes]
    budgets: np.ndarray
    needed: np.ndarray
    widths: np.ndarray  # of the diagonal bands
    codes: np.ndarray  # distinct, sorted
    begins: np.ndarray
    piece_at: np.ndarray
    place_at: np.ndarray
    bitmap: np.ndarray
    short: dict[bytes, list]


def build_index(items: list[tuple[int, str | None]], q: int, rate: float, piece: int = 512) -> Index:
    ids, pieces, short = [], [], {}
    for key, text in items:
        data = normalise(text)
        if 0 < len(data) < q:
            short.setdefault(data, []).append(key)
        elif data:
            n = max(1, round(len(data) / piece))
            cuts = [len(data) * i // n for i in range(n + 1)]
            pieces += [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            ids += [key] * n
    sizes = np.array([len(p) for p in pieces], np.int64)
    budgets = np.minimum((sizes * rate).astype(np.int64), np.maximum(sizes // q - 1, 0))
    needed = np.maximum(1, sizes + 1 - q * (budgets + 1))
    codes = [grams(p, q) for p in pieces]
    every = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(pieces)), [len(c) for c in codes])
    place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    distinct, begins = np.unique(every[order], return_index=True)
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[(distinct >> np.uint64(64 - BITS)).astype(np.int64)] = True
    widths = np.maximum(16, 2 * (budgets + 1))
    return Index(q, ids, pieces, budgets, needed, widths, distinct, np.append(begins, len(every)), owner[order], place[order], bitmap, short)


def _last_row(a: np.ndarray, b: np.ndarray, left: int, right: int) -> np.ndarray:
    """Fewest edits of all of ``a`` against a part of ``b``, for its end on each diagonal from ``-left`` to ``right``.

    The part may start anywhere on these diagonals; places outside ``b`` equal no byte.
    """
    width = left + right + 1
    pad = np.full(len(a) + width, 256, np.int64)
    inside = b[: len(a) + width - left]
    pad[left : left + len(inside)] = inside
    steps = np.arange(width)
    row = np.where(steps >= left, 0, left - steps)  # before b begins, skipped places cost
    for i, byte in enumerate(a.tolist()):
        new = row + (pad[i : i + width] != byte)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return row


def align(item: bytes, region: bytes, slack: int, budget: int) -> tuple[int, int, int]:
    """Fewest edits of ``item`` against a part of ``region`` that ends on a diagonal from ``-budget`` to ``slack``:
    edits, start, end. More than ``budget`` edits are reported as such, not exactly."""
    exact = region.find(item)
    if exact >= 0:
        return 0, exact, exact + len(item)
    a, b = np.frombuffer(item, np.uint8).astype(np.int64), np.frombuffer(region, np.uint8).astype(np.int64)
    row = _last_row(a, b, budget, slack)
    ends = len(a) + np.arange(-budget, slack + 1)
    row = np.where((ends <= len(b)) & (ends >= 0), row, len(a) + 1)
    at = int(row.argmin())
    edits, end = int(row[at]), int(ends[at])
    if edits > budget:
        return edits, 0, 0
    back = _last_row(a[::-1], b[:end][::-1], edits, edits)
    starts = end - len(a) - np.arange(-edits, edits + 1)
    back = np.where((starts >= 0) & (starts <= end), back, len(a) + 1)
    return edits, int(starts[int(back.argmin())]), end


def band_counts(index: Index, at: np.ndarray, slot: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared q-grams by diagonal band, as (piece * span + band + 1, number); ``at`` and ``slot``: places of known grams in the
    texts, and which grams they are.

    Pairs of a gram's places in the texts and in the items are spread out in lots of bounded size. A gram with very many
    pairs (one character or a short pattern, repeated) isn't: for each of its places in an item, the bands are found in
    which the text has the gram at all, so that its cost grows with the bands, not with the pairs.
    """
    places = index.begins[slot + 1] - index.begins[slot]
    often = np.bincount(slot, minlength=len(index.codes))
    heavy = often * np.diff(index.begins) > HEAVY_PAIRS
    light = ~heavy[slot]
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(keys, n):
        found.append((keys, n))
        if sum(len(k) for k, _ in found) > 4 * LOT:
            found[:] = [_summed(found)]

    lot_at, lot_slot, lot_places = at[light], slot[light], places[light]
    upto = np.cumsum(lot_places)
    for a, b in _lots(upto):
        count = lot_places[a:b]
        posting = np.repeat(index.begins[lot_slot[a:b]] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        piece, diagonal = index.piece_at[posting], np.repeat(lot_at[a:b], count) - index.place_at[posting]
        width = index.widths[piece]
        band = diagonal // width
        late = (diagonal - band * width < index.budgets[piece]) & (band >= 0)  # these also lie in the part that the band before overlaps
        own = band >= -1  # further ahead of the first text no item begins
        add(*np.unique(np.concatenate((piece[own] * span + band[own] + 1, piece[late] * span + band[late])), return_counts=True))
    for gram in np.flatnonzero(heavy).tolist():
        own = at[slot == gram]
        postings = slice(index.begins[gram], index.begins[gram + 1])
        for piece in np.unique(index.piece_at[postings]).tolist():
            inside = index.place_at[postings][index.piece_at[postings] == piece]
            width, budget = int(index.widths[piece]), int(index.budgets[piece])
            bands = np.unique(own // width)
            bands = np.unique((bands[:, None] - np.arange(inside.min() // width - 1, inside.max() // width + 3)).ravel())
            bands = bands[bands >= -1]
            n = np.zeros(len(bands), np.int64)
            for place in inside.tolist():
                n += np.searchsorted(own, (bands + 1) * width + budget + place) > np.searchsorted(own, bands * width + place)
            add(piece * span + bands[n > 0] + 1, n[n > 0])
    return _summed(found) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _lots(upto: np.ndarray):
    """Consecutive stretches whose numbers add up to about ``LOT``, one element at least."""
    a = 0
    while a < len(upto):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + LOT, "right")))
        yield a, b
        a = b


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    keys, place = np.unique(keys, return_inverse=True)
    return keys, np.bincount(place, n).astype(np.int64)


def matches(index: Index, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
    """For every text, (piece, start, end, edits) in the normalised text; overlapping finds of a piece keep the best."""
    data = [normalise(t) for t in texts]
    out: list[list] = [[] for _ in data]
    if not index.pieces or not data:
        return out
    q = index.q
    gap = b"\0" * q
    joined = gap.join([b"", *data, b"\0" * 8])
    begins = np.cumsum([q] + [len(d) + q for d in data])[:-1]
    code = grams(joined, q)
    at = np.flatnonzero(index.bitmap[(code >> np.uint64(64 - BITS)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(index.codes, code[at]), len(index.codes) - 1)
    real = index.codes[slot] == code[at]
    at, slot = at[real], slot[real]
    if not len(at):
        return out
    span = int(len(joined)) + 2
    keys, n = band_counts(index, at, slot, span)
    aligned: dict[tuple[int, bytes], tuple[int, int, int]] = {}  # repetitive texts have the same region many times
    for key in keys[n >= index.needed[keys // span]].tolist():
        p, b = divmod(key, span)
        low, slack = (b - 1) * int(index.widths[p]), int(index.widths[p] + index.budgets[p])
        k, item = int(index.budgets[p]), index.pieces[p]
        # a match may run over a border of the band by its insertions and deletions
        doc = int(np.searchsorted(begins, low + slack + len(item) // 2, "right")) - 1
        for d in {max(0, min(doc + x, len(data) - 1)) for x in (-1, 0, 1)}:
            start = max(low - k, int(begins[d]))
            stop = min(low + slack + len(item) + k, int(begins[d]) + len(data[d]))
            if stop - start < len(item) - k:
                continue
            region = joined[start:stop]
            known = aligned.get((p, region))
            if known is None:
                known = align(item, region, max(0, min(slack + 2 * k, stop - start - len(item) + k)), k)
                if len(aligned) >= REGIONS:
                    aligned.clear()
                aligned[p, region] = known
            edits, s, e = known
            if edits <= k:
                out[d].append((p, start - int(begins[d]) + s, start - int(begins[d]) + e, edits))
    for found in out:
        found.sort(key=lambda m: (m[0], m[3], m[1]))
        kept: dict[int, list] = {}
        for m in found:
            own = kept.setdefault(m[0], [])  # of one piece, without overlaps and in order
            i = bisect_left(own, m[1], key=lambda x: x[1])
            if (i == 0 or own[i - 1][2] <= m[1]) and (i == len(own) or m[2] <= own[i][1]):
                own.insert(i, m)
        found[:] = sorted((m for own in kept.values() for m in own), key=lambda m: (m[1], m[0]))
    return out


def original_places(text: str, normal: bytes, places: list[int]) -> list[int]:
    """Character places in the text for byte places in its normalised form, to the nearest word-inner character."""
    words = list(re.finditer(r"\S+", text))
    sizes = [len(w.group().lower().encode()) for w in words]
    starts = np.concatenate(([0], np.cumsum([s + 1 for s in sizes])))
    out = []
    for place in places:
        i = max(0, min(int(np.searchsorted(starts, place, "right")) - 1, len(words) - 1))
        inner = normal[int(starts[i]) : place].decode(errors="ignore")
        out.append(min(words[i].start() + len(inner), words[i].end()))
    return out


def find_leaks(
    df: DataFrame, benchmark: DataFrame, text: str = "text", q: int = 12, rate: float = 0.06, block_bytes: int = 1 << 20, keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) and ``leaks``: array of item_id, start, end, edits, in text order.

    ``benchmark`` has item_id and text. Its texts are taken in blocks of about ``block_bytes``; each is one pass.
    """
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    keep = [c for c in df.columns if c != "leaks"] if keep is None else keep
    found = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]).withColumn("leaks", F.array().cast("array<struct<item_id:bigint,start:bigint,end:bigint,edits:bigint>>"))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        found = _pass(found, build_index([(r["item_id"], r["text"]) for r in rows], q, rate), text)
    return found.select(*[F.col(f"`{c}`") for c in keep], "leaks")


def _pass(df: DataFrame, index: Index, text: str) -> DataFrame:
    spread = df.sparkSession.sparkContext.broadcast(index)  # a block's index is bounded by block_bytes

    def make(texts):
        own, out = spread.value, []
        for t, found in zip(texts, matches(own, texts), strict=True):
            normal = normalise(t) if found or own.short else b""
            places = original_places(t, normal, [x for m in found for x in m[1:3]]) if found else []
            row = [{"item_id": own.ids[m[0]], "start": places[2 * i], "end": places[2 * i + 1], "edits": m[3]} for i, m in enumerate(found)]
            row += [{"item_id": key, "start": 0, "end": len(t), "edits": 0} for key in own.short.get(normal, [])] if normal else []
            out.append(row)
        return {"__more": out}

    marked = map_texts(df, text, "__more array<struct<item_id:bigint,start:bigint,end:bigint,edits:bigint>>", make, df.columns)
    return marked.withColumn("leaks", F.concat("leaks", "__more")).drop("__more")
