"""Exact n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

1. Every text becomes its set of word shingles (64-bit hashes). Texts with equal sets are one row of the matrix.
2. Bounds on sizes discard most rows before any are compared. In one fixed order of all shingles, the c first shingles
   that two similar sets share stand within the first ``missing + c`` of each, ``missing`` being how many shingles of a
   set the threshold lets the other lack. A row is kept if enough of its front is also in another row's front.
   Kept rows are brought together without comparing pairs. Two sets of at most n shingles with similarity t differ in
   at most d = (1 - t) / (1 + t) * 2n shingles, so when the shingle space is split into d + 1 parts, one part at least is the
   same in both. Sets get a signature for each part, at the two size levels they can meet others on. A part that is
   empty on both sides says nothing: there are spare parts for that, and sets with more empty parts than those also get,
   for each, the shared-front shingles in its place.
   Rows with a common signature belong to one family; families are the connected components of these links.
3. Products of two sparse blocks of rows accumulate overlap counts, column range by column range; pairs below the overlap
   that their sizes demand are discarded, and what is left are the links. A family that fits in one block is one product.
   A larger one is cut into blocks of one size level, and first each block is multiplied with itself and a few pivot rows
   of the family, so a row is sent once. What that joins is one component from then on. Then all pairs of its blocks meet
   whose levels permit the threshold, but no block of the main component with another of it: first only the parities of
   the shingles' classes, a sixteenth of a set or less, whose differences are a lower bound of the sets' own. Rows that may link
   with none of the other block go; the products are made of the rest.
   A product returns links that join its rows (a spanning forest), or all.
4. Components of the links, carried back to every document.

Signatures and equal sets rest on 64- and 128-bit hashes of whole texts; every link is decided on the sets themselves.

Defined results: null and empty texts, and texts without words, have no shingles and link with nothing; a text shorter
than a shingle is one shingle; texts of any length are used whole; rows that repeat an id keep one result row each, with
the set of their own text, and belong together; rows without an id take part by their text, and their component is the
smallest id they reach, if any.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_texts
from wattline.llm.components import connected_components
from wattline.session import discard, drop_shuffles, materialize

MIX1, MIX2, MIX3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Rows of a part of a family that are compared with all others, before blocks are.
PIVOTS = 4
S29, S32 = np.uint64(29), np.uint64(32)


def scramble(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> S32)) * by
    x = (x ^ (x >> S29)) * MIX2
    return x ^ (x >> S32)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text. Words: runs without ASCII white space, A-Z lower-cased."""
    split = [(t or "").encode().lower().split() for t in texts]
    sizes = [len(s) for s in split]
    codes, unique = pd.factorize(np.array([w for s in split for w in s], object))
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in unique), np.uint64, len(unique))
    hashes = known[codes] if len(unique) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i in range(width):
        rolled = scramble(rolled + hashes[i : i + len(rolled)], MIX1)
    out, at = [], 0
    for n in sizes:
        if n >= width:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            value = np.zeros(1, np.uint64)
            for i in range(n):
                value = scramble(value + hashes[at + i : at + i + 1], MIX1)
            out.append(scramble(value + np.uint64(n), MIX3))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


class Bound:
    """What a similarity of ``percent`` hundredths demands, in whole numbers."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 99:
            raise ValueError("percent must be from 50 to 99")
        self.percent = percent

    def linked(self, overlap, n, m):
        return 100 * overlap >= self.percent * (n + m - overlap)

    def level(self, n: int) -> int:
        """Sets whose sizes permit a link are on the same level or on neighbouring ones."""
        level, top = 0, 1
        while n > top:
            top = self.next_top(top)
            level += 1
        return level

    def next_top(self, top: int) -> int:
        return max(top + 1, 100 * (top + 1) // self.percent)

    def top(self, level: int) -> int:
        top = 1
        for _ in range(level):
            top = self.next_top(top)
        return top

    def parts(self, level: int) -> tuple[int, int]:
        """Parts at a level, and how many of them are spare: more than the shingles in which linked sets can differ."""
        differ = 2 * self.top(level) * (100 - self.percent) // (100 + self.percent)
        spare = (differ + 1) // 10
        return differ + 1 + spare, spare

    def missing(self, n: int) -> int:
        return n - -(-self.percent * n // 100)

    def common(self, n: int) -> int:
        """Shingles that the fronts of a set of this size are made to share with any linked set that isn't smaller."""
        return max(1, n * 8 // 100)

    def front(self, n: int) -> int:
        return self.missing(n) + self.common(n)

    def needed(self, n: int) -> int:
        """Shared front shingles of a set that has a link: the other may be the smaller one."""
        return self.common(-(-self.percent * n // 100))


def signatures(own: np.ndarray, bound: Bound) -> np.ndarray:
    """The signatures of one set."""
    if not own.size:
        return np.zeros(0, np.uint64)
    level, found = bound.level(own.size), []
    spread = scramble(own, MIX3)
    for at in (level, level + 1):
        k, spare = bound.parts(at)
        part = ((spread >> S32) * np.uint64(k)) >> S32
        order = np.argsort(part, kind="stable")
        held, begins = np.unique(part[order], return_index=True)
        sums = np.add.reduceat(scramble(own[order], MIX2), begins)
        found.append(scramble(sums + scramble(held + np.uint64(at << 32), MIX1), MIX3))
        if k - held.size > spare:
            empty = np.setdiff1d(np.arange(k, dtype=np.uint64), held)
            first = own[: bound.missing(own.size) + 1]
            keys = scramble(empty + np.uint64((1 << 63) + (at << 32)), MIX1)
            found.append(scramble((keys[:, None] + scramble(first, MIX2)[None, :]).ravel(), MIX3))
    return np.unique(np.concatenate(found))


def row_name(own: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return xxhash.xxh3_128_digest(own.tobytes())


def parities(own: np.ndarray) -> bytes:
    """For each of 2^k classes of shingles, whether a set holds an odd number of them; at least four classes a shingle, up
    to a million. Two sets differ in at least as many shingles as in parities."""
    classes = min(1 << 20, 1 << max(6, (4 * len(own) - 1).bit_length()))
    held = (scramble(own, MIX3) & np.uint64(classes - 1)).astype(np.int64)
    return np.packbits((np.bincount(held, minlength=classes) & 1).astype(np.uint8)).tobytes()


def may_link(left: list[bytes], n: np.ndarray, right: list[bytes], m: np.ndarray, bound: Bound) -> np.ndarray:
    """Matrix of the pairs whose parities leave room for a link; ``n`` and ``m`` are the sizes of their sets."""
    classes = 8 * min(map(len, left + right))

    def signs(packed: list[bytes]) -> np.ndarray:
        out = np.empty((len(packed), classes), np.float32)
        for i, x in enumerate(packed):
            bits = np.unpackbits(np.frombuffer(x, np.uint8))
            while len(bits) > classes:  # classes of twice as many, two by two
                bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
            out[i] = 1 - 2 * bits.astype(np.float32)
        return out

    apart = ((classes - signs(left) @ signs(right).T) / 2).astype(np.int64)
    most = np.minimum((n[:, None] + m[None, :] - apart) // 2, np.minimum(n[:, None], m[None, :]))
    return bound.linked(most, n[:, None], m[None, :])


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the links (in order) join what wasn't joined before."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            keep[i] = True
    return keep


def block_links(left: list[np.ndarray], right: list[np.ndarray], same: bool, bound: Bound, columns: int = 2048):
    """Linked (row of left, row of right, overlap) by a product of the two incidence blocks."""
    n, m = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    rows = np.repeat(np.arange(len(left)), n), np.repeat(np.arange(len(right)), m)
    values = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(values[0], values[1])
    overlap = np.zeros((len(left), len(right)), np.float32)
    at = [np.searchsorted(shared, v) for v in values]
    here = [(p < shared.size) & (shared[np.minimum(p, shared.size - 1)] == v) for p, v in zip(at, values, strict=True)] if shared.size else None
    if here is not None:
        cells = [(r[h], p[h]) for r, p, h in zip(rows, at, here, strict=True)]
        for low in range(0, shared.size, columns):
            blocks = []
            for (r, p), size in zip(cells, overlap.shape, strict=True):
                block = np.zeros((size, columns), np.float32)
                inside = (p >= low) & (p < low + columns)
                block[r[inside], p[inside] - low] = 1
                blocks.append(block)
            overlap += blocks[0] @ blocks[1].T
    count = overlap.astype(np.int64)
    ok = bound.linked(count, n[:, None], m[None, :])
    if same:
        ok &= np.triu(np.ones(ok.shape, bool), 1)
    a, b = np.nonzero(ok)
    return a, b, count[a, b]


def _numbers(spread: DataFrame, node: str, sign: str) -> DataFrame:
    """Links between rows that share a signature: each to the smallest of its signature."""
    met = spread.groupBy(sign).agg(F.min(node).alias("low"), F.max(node).alias("high")).where("low < high").select(sign, "low")
    return spread.join(met, sign).where(F.col(node) != F.col("low")).select(F.col(node).alias("a"), F.col("low").alias("b"))


def _families(links: DataFrame) -> DataFrame:
    return connected_components(links).select(F.col("node").alias("id"), F.col("component").alias("family"))


def _upto(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))


def _cell(part1: Column, cut1: Column, part2: Column, cut2: Column) -> Column:
    return F.struct(part1.alias("part1"), cut1.alias("cut1"), part2.alias("part2"), cut2.alias("cut2"))


def _cuts(rows: DataFrame, block: int, block_cells: int) -> DataFrame:
    """Rows (``family``, ``part``, ``n``) with the number of blocks of every part of their family, and their own block."""
    counts = rows.groupBy("family", "part").agg(F.count("*").alias("rows"), F.sum("n").alias("cells"))
    counts = counts.withColumn("cuts", F.greatest(F.ceil(F.col("rows") / block), F.ceil(F.col("cells") / block_cells)))
    cuts = counts.groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("part", "cuts"))).alias("cuts"))
    return rows.join(cuts, "family").withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")[F.col("part")]))


def _with_blocks_of(part: Column, cell) -> Column:
    """The cells that ``cell(part, number of the block)`` names for every block of a part of the family."""
    n = F.coalesce(F.col("cuts")[part], F.lit(0).cast("bigint"))
    return F.transform(_upto(n), lambda x: cell(part, x))


class Product:
    """Products of blocks of the stored sets ``again`` (``id``, ``name``, ``n``, ``shingles``, ``parities``)."""

    def __init__(self, again: DataFrame, bound: Bound, all_links: bool):
        self.again, self.bound, self.all_links = again, bound, all_links

    def links(self, tasks: DataFrame) -> DataFrame:
        """Links in the cells of ``tasks``: a row's ``id``, ``name``, ``family``, its ``own`` block and a cell it takes part in.

        A cell with one block compares all its rows with each other, one with two blocks those of one with those of the other.
        """
        bound, all_links = self.bound, self.all_links
        work = self.again.select("id", "name", "shingles").join(tasks, ["id", "name"]).select("id", "shingles", "family", "cell.*", "own.*")

        def multiply(part: pa.Table) -> pa.Table:
            ids, packed = np.asarray(part.column("id")), part.column("shingles").to_pylist()
            own = np.stack([np.asarray(part.column(c)) for c in ("part", "cut")])
            i, j = ((part.column(f"part{x}")[0].as_py(), part.column(f"cut{x}")[0].as_py()) for x in (1, 2))
            order = np.argsort(ids, kind="stable")
            if i == j:
                left = right = order
            else:
                left, right = (order[(own[0, order] == x[0]) & (own[1, order] == x[1])] for x in (i, j))
            unpack = lambda at: [np.frombuffer(packed[x], np.uint64) for x in at]
            a, b, overlap = block_links(unpack(left), unpack(right), i == j, bound) if len(left) and len(right) else (np.zeros(0, int),) * 3
            if not all_links and len(a):
                keep = _forest(left[a], right[b], len(ids))
                a, b, overlap = a[keep], b[keep], overlap[keep]
            return pa.table({"a": ids[left[a]], "b": ids[right[b]], "overlap": overlap.astype(np.int64)})

        return work.groupBy("family", "part1", "cut1", "part2", "cut2").applyInArrow(multiply, "a bigint, b bigint, overlap bigint")

    def promising(self, tasks: DataFrame) -> DataFrame:
        """The rows of ``tasks`` that, by parities and sizes, may link with another row of their cell."""
        bound = self.bound
        work = self.again.select("id", "name", "n", "parities").join(tasks, ["id", "name"]).select("id", "name", "n", "parities", "family", "cell.*", "own.*")

        def pick(part: pa.Table) -> pa.Table:
            n, packed = np.asarray(part.column("n")), part.column("parities").to_pylist()
            own = np.stack([np.asarray(part.column(c)) for c in ("part", "cut")])
            i, j = ((part.column(f"part{x}")[0].as_py(), part.column(f"cut{x}")[0].as_py()) for x in (1, 2))
            left, right = (np.flatnonzero((own[0] == x[0]) & (own[1] == x[1])) for x in (i, j))
            keep = np.zeros(len(n), bool)
            if len(left) and len(right):
                ok = may_link([packed[x] for x in left], n[left], [packed[x] for x in right], n[right], bound)
                if i == j:
                    np.fill_diagonal(ok, False)
                keep[left[ok.any(axis=1)]] = True
                keep[right[ok.any(axis=0)]] = True
            return part.filter(pa.array(keep)).drop_columns(["n", "parities"])

        places = "part1 bigint, cut1 bigint, part2 bigint, cut2 bigint, part bigint, cut bigint"
        kept = work.groupBy("family", "part1", "cut1", "part2", "cut2").applyInArrow(pick, f"id bigint, name binary, family bigint, {places}")
        cell = _cell(*[F.col(c) for c in ("part1", "cut1", "part2", "cut2")])
        return kept.select("id", "name", "family", F.struct("part", "cut").alias("own"), cell.alias("cell"))

    def all_pairs(self, rows: DataFrame, block: int, block_cells: int) -> DataFrame:
        """Links of all rows of a family (``id``, ``name``, ``family``, ``level``, ``n``, ``kind``), but none between rows of kind 1.

        A part of a family is a size level and a kind; parts meet whose levels permit a link.
        """
        numbers = _cuts(rows.withColumn("part", 2 * F.col("level") + F.col("kind")), block, block_cells)
        part, own = F.col("part"), F.col("cut")
        meets = [
            # kind 0: the same part, then the next and the last level's, then kind 1 at the three levels
            _with_blocks_of(part, lambda to, x: _cell(part, F.least(x, own), part, F.greatest(x, own))),
            _with_blocks_of(part + 2, lambda to, x: _cell(part, own, to, x)),
            _with_blocks_of(part - 2, lambda to, x: _cell(to, x, part, own)),
            *[_with_blocks_of(part + d, lambda to, x: _cell(part, own, to, x)) for d in (-1, 1, 3)],
        ]
        others = [_with_blocks_of(part - d, lambda to, x: _cell(to, x, part, own)) for d in (-1, 1, 3)]
        cells = F.when(F.col("kind") == 0, F.concat(*meets)).otherwise(F.concat(*others))
        tasks = numbers.select("id", "name", "family", F.struct("part", "cut").alias("own"), F.explode(cells).alias("cell"))
        return self.links(self.promising(tasks))

    def blocks_alone(self, rows: DataFrame, block: int, block_cells: int) -> DataFrame:
        """Links inside blocks, and of every block's rows with ``PIVOTS`` rows of each neighbouring part of the family."""
        numbers = _cuts(rows.withColumn("part", F.col("level")), block, block_cells)
        part, own = F.col("part"), F.col("cut")
        dealt = numbers.select("id", "name", "family", F.struct("part", "cut").alias("own"), _cell(part, own, part, own).alias("cell"))
        picked = [F.min(F.struct(F.xxhash64(F.lit(i), "id", "name"), "id", "name")).alias(f"p{i}") for i in range(PIVOTS)]
        pivots = numbers.groupBy("family", "part").agg(*picked, F.first("cuts").alias("cuts"))
        pivots = pivots.select("family", "part", "cuts", F.explode(F.array_distinct(F.array(*[F.struct(f"p{i}.id", f"p{i}.name") for i in range(PIVOTS)]))).alias("pivot"))
        pivots = pivots.select("family", "part", "cuts", "pivot.*").withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")[part]))
        other = F.filter(
            F.flatten(F.array(*[_with_blocks_of(part + d, lambda to, x: _cell(to, x, to, x)) for d in (-1, 0, 1)])),
            lambda c: (c["part1"] != part) | (c["cut1"] != own))
        sent = pivots.select("id", "name", "family", F.struct("part", "cut").alias("own"), F.explode(other).alias("cell"))
        return self.links(dealt.unionByName(sent))

    def links_of(self, rows: DataFrame, block: int, block_cells: int, full: bool) -> tuple[DataFrame, DataFrame]:
        """Links of families (``id``, ``name``, ``family``, ``level``, ``n``, ``kind``), and the rows whose pairs aren't all decided yet."""
        sizes = rows.groupBy("family").agg(F.count("*").alias("rows"), F.sum("n").alias("cells"))
        small = ((F.col("rows") <= block) & (F.col("cells") <= block_cells)).alias("small")
        rows = materialize(rows.join(sizes.select("family", small), "family"))
        none = F.lit(0).cast("bigint")
        at_once = rows.where("small").select(
            "id", "name", "family", F.struct(none.alias("part"), none.alias("cut")).alias("own"), _cell(none, none, none, none).alias("cell"))
        large = rows.where("NOT small").drop("small")
        found = self.all_pairs(large, block, block_cells) if full else self.blocks_alone(large, block, block_cells)
        return materialize(self.links(at_once).unionByName(found).distinct()), large


def link_sets(df: DataFrame, key: str, text: str, percent: int = 90, width: int = 3, block: int = 512, block_cells: int = 400_000, all_links: bool = False):
    """Rows (``id``, ``n``, ``name``), sets (``name``, ``first``: smallest id), and links (``a``, ``b``: firsts of linked sets, ``overlap``).

    A block holds about ``block`` rows and ``block_cells`` shingles at most. With ``all_links`` every linked pair of different
    sets is returned, else enough of them to join what is linked. A set that only rows without an id have gets a first of
    its own, below all ids.
    """
    bound = Bound(percent)
    source = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    marked = source.withColumn("mark", F.xxhash64("text"))

    def describe(texts):
        sets = shingle_sets(texts, width)
        fronts = [x[: bound.front(len(x))].view(np.int64) for x in sets]
        return {"n": [len(x) for x in sets], "name": [row_name(x) for x in sets], "front": fronts, "needed": [bound.needed(len(x)) for x in sets]}

    described = materialize(map_texts(marked, "text", "n bigint, name binary, front array<bigint>, needed bigint", describe, ["id", "mark"]))
    rows = materialize(described.select("id", "n", "name"))
    firsts = materialize(rows.where("n > 0").groupBy("name").agg(F.min("id").alias("first"), F.count("*").alias("rows")))
    nameless = firsts.where("first IS NULL")
    nameless = None if nameless.isEmpty() else nameless
    if nameless is not None:
        below = F.lit(_lowest(rows) - 1) - F.monotonically_increasing_id()
        nameless = materialize(nameless.select("name", below.alias("first"), "rows"))
        firsts = materialize(firsts.where("first IS NOT NULL").unionByName(nameless))
    of_set = firsts.select(F.col("first").alias("id"), "name")
    once = described.where("n > 0").select("name", "needed", "front", "id", "mark")
    named = once.join(of_set, ["id", "name"], "left_semi")
    if nameless is not None:
        named = named.unionByName(once.where("id IS NULL").drop("id").join(of_set, "name").where(F.col("id") < _lowest(rows)))
    # fronts are read twice, and shuffled once
    named = materialize(named)

    # Fronts are compared by so many leading bits that few differ and agree: agreeing by chance only keeps a row more.
    total = described.agg(F.sum(F.size("front")).alias("s")).first()["s"] or 1
    drop = max(0, 64 - max(32, int(total).bit_length() + 7))
    discard(described)
    drop_shuffles(df.sparkSession)
    fronts = named.select("id", "needed", F.explode("front").alias("x")).select("id", "needed", F.shiftright("x", drop).alias("x"))
    shared = fronts.groupBy("x").agg(F.count("*").alias("c")).where("c > 1").select("x")
    kept = fronts.join(shared, "x").groupBy("id", "needed").agg(F.count("*").alias("c")).where("c >= needed").select("id")
    # a kept set with one of the texts it is made of
    kept = materialize(named.join(kept.distinct(), "id").groupBy("id", F.col("name").alias("of")).agg(F.min("mark").alias("mark")))
    discard(named)
    drop_shuffles(df.sparkSession)

    def sets(texts):
        found = shingle_sets(texts, width)
        return {
            "name": [row_name(x) for x in found], "n": [len(x) for x in found], "level": [bound.level(len(x)) for x in found],
            "signs": [signatures(x, bound).view(np.int64) for x in found], "shingles": [x.tobytes() for x in found],
            "parities": [parities(x) for x in found],
        }

    schema = "name binary, n bigint, level bigint, signs array<bigint>, shingles binary, parities binary"
    # kept ids grow with the table, so they are no side to broadcast
    again = map_texts(marked.join(kept.hint("merge"), ["id", "mark"]), "text", schema, sets, ["id", "of"]).where("name = of").drop("of")
    if nameless is not None:
        others = map_texts(source.where("id IS NULL"), "text", schema, sets, ["id"]).drop("id").join(nameless.select("name", F.col("first").alias("id")), "name")
        again = again.unionByName(others.join(kept, "id", "left_semi"))
    if not rows.where("n > 0").groupBy("id", "name").count().where("count > 1").isEmpty():
        again = again.dropDuplicates(["id", "name"])
    again = materialize(again)
    drop_shuffles(df.sparkSession)
    product = Product(again, bound, all_links)
    narrow = again.select("id", "name", "level", "n")

    family = _families(_numbers(again.select("id", F.explode("signs").alias("sign")), "id", "sign"))
    drop_shuffles(df.sparkSession)
    links, large = product.links_of(narrow.join(family, "id").withColumn("kind", F.lit(0)), block, block_cells, all_links)
    drop_shuffles(df.sparkSession)
    if all_links or large.isEmpty():
        discard(kept, *([] if all_links else [again]))
        return rows, firsts, links

    # What is linked by now is one component. Pairs of two components are compared.
    joined = connected_components(links).select(F.col("node").alias("id"), "component")
    undecided = materialize(large.drop("kind").join(joined, "id", "left").withColumn("component", F.coalesce("component", "id")))
    sizes = undecided.groupBy("family", "component").agg(F.count("*").alias("rows"))
    main = sizes.groupBy("family").agg(F.max_by("component", F.struct("rows", "component")).alias("main"))
    undecided = undecided.join(main, "family").withColumn("kind", (F.col("component") == F.col("main")).cast("int"))
    more, _ = product.links_of(undecided.drop("component", "main"), block, block_cells, True)
    links = materialize(links.unionByName(more).distinct())
    discard(kept, again)
    drop_shuffles(df.sparkSession)
    return rows, firsts, links


def _lowest(rows: DataFrame) -> int:
    return rows.agg(F.least(F.min("id"), F.lit(0)).alias("x")).first()["x"] or 0


def components(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90, width: int = 3, block: int = 512, block_cells: int = 400_000) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component`` (the smallest id reachable by links)."""
    rows, firsts, links = link_sets(df, key, text, percent, width, block, block_cells)
    # the sets of an id that repeats with different texts are linked through it
    repeated = rows.where("id IS NOT NULL").select("id", "name").distinct().groupBy("id").count().where("count > 1").select("id")
    repeated = materialize(rows.join(repeated, "id", "left_semi").join(firsts, "name").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct())
    found = connected_components(links.select("a", "b").unionByName(repeated))
    named = firsts.join(found, firsts["first"] == found["node"], "left").select("name", "first", F.coalesce("component", "first").alias("of_set"))
    lowest = _lowest(rows)
    if not firsts.where(F.col("first") < lowest).isEmpty():
        real = named.groupBy("of_set").agg(F.min(F.when(F.col("first") >= lowest, F.col("first"))).alias("real"))
        named = named.join(real, "of_set").select("name", F.col("real").alias("of_set"))
    named = named.select("name", "of_set")
    through = found.join(repeated.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("id"), F.col("component").alias("of_id"))
    result = rows.join(named, "name", "left").join(through, "id", "left")
    return result.select("id", F.col("n").alias("n_shingles"), F.coalesce("of_set", "of_id", "id").alias("component"))
