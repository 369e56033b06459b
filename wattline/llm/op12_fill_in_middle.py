"""Fill-in-the-middle by repeated-capture matching.

One full match of ``(unit)*`` by the regex library keeps every repetition of the group, so ``match.ends(1)`` is at once
the number of units and every place where a text may be cut; no loop looks for the cuts. Texts above ``window``
characters are matched window by window, to bound what is held; a window's last unit is matched again in the next one,
since the window's end may have shortened it. A unit may not look beyond the unit that follows it.

The two cuts and the form come from a hash of the row's key, so a row is always cut the same way.

Defined results: a null text counts as empty; empty texts and texts that hold one of the three marks stay plain; a null
key hashes like an empty string; rows that repeat a key are each cut by their own text; any length is cut whole; other
columns are carried along, and those named like made ones are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.llm.common import _arrow_schema, prepare, release, text_slices

MARKS = ("<P>", "<S>", "<M>")
MADE = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
WINDOW = 1 << 20


@lru_cache(maxsize=8)
def repeated(unit: str) -> regex.Pattern:
    if regex.compile(unit, regex.DOTALL).fullmatch("") is not None:
        raise ValueError("a unit must hold a character")
    return regex.compile(f"({unit})*", regex.DOTALL)


class Cuts:
    """The units of one text: how many there are, and where each ends."""

    def __init__(self, text: str, unit: str = ".", window: int = WINDOW):
        self.text, self.pattern, self.window = text, repeated(unit), window
        self.befores, self.begins, self.last, self.n = [0], [0], None, 0
        at = 0
        while at < len(text):
            ends = self._match(at)
            self.n += len(ends)
            at = ends[-1]
            if at < len(text):
                self.befores.append(self.n)
                self.begins.append(at)
        # one match serves the count and both cuts of nearly every text
        self.last = (0, ends) if len(self.begins) == 1 and text else None

    def _match(self, at: int) -> list[int]:
        """The ends of the units from ``at``, up to the text's end or about a window further."""
        size = self.window
        while at + size < len(self.text):
            ends = self.pattern.match(self.text, at, at + size).ends(1)[:-1]
            if ends:
                return ends
            size *= 2
        found = self.pattern.fullmatch(self.text, at)
        if found is None:
            raise ValueError("the units don't cover the text")
        return found.ends(1)

    def offset(self, k: int) -> int:
        """Characters before the cut that follows ``k`` units."""
        if k == 0:
            return 0
        i = bisect_left(self.befores, k) - 1
        if self.last is None or self.last[0] != i:
            self.last = (i, self._match(self.begins[i]))
        return self.last[1][k - self.befores[i] - 1]


def arrange(text: str, h: tuple[int, int, int, int], unit: str, plain: int, spm: int, marks: tuple[str, str, str], window: int = WINDOW):
    """Units, form, characters of prefix and middle, output of one text under its four hash numbers."""
    cuts = Cuts(text, unit, window)
    low, high = sorted((h[0] % (cuts.n + 1), h[1] % (cuts.n + 1)))
    if not text or any(m in text for m in marks) or h[2] % 100 >= 100 - plain:
        return cuts.n, "plain", None, None, text
    i, j = cuts.offset(low), cuts.offset(high)
    p, s, m = marks
    if h[3] % 100 < spm:
        return cuts.n, "spm", i, j - i, f"{s}{text[j:]}{p}{text[:i]}{m}{text[i:j]}"
    return cuts.n, "psm", i, j - i, f"{p}{text[:i]}{s}{text[j:]}{m}{text[i:j]}"


def key_numbers(key: Column, salt: str = "1:") -> list[Column]:
    """Four unsigned 32-bit numbers of a row's key."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, unit: str = ".", salt: str = "1:",
    plain: int = 10, spm: int = 20, marks: tuple[str, str, str] = MARKS, window: int = WINDOW,
) -> DataFrame:
    """``keep`` (all other columns by default) with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``plain`` hundredths of the texts stay as they are; of the rest ``spm`` hundredths begin with the suffix. ``unit`` is
    a pattern of the regex library (``.``: code points, ``\\X``: grapheme clusters) that can cover any text.
    """
    repeated(unit)
    prepare(df.sparkSession)
    made = StructType.fromDDL(MADE)
    keep = [c for c in df.columns if c != text and c not in made.names] if keep is None else keep
    carried = df.select(*[F.col(f"`{c}`") for c in keep])
    out = StructType([*carried.schema.fields, *made.fields])
    target, width = _arrow_schema(out), len(keep)
    numbers = [c.alias(f"__h{i}") for i, c in enumerate(key_numbers(F.col(f"`{key}`"), salt))]
    source = df.select(*[F.col(f"`{c}`") for c in keep], *numbers, F.col(f"`{text}`").cast("string").alias("__text"))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "__text"):
                hashes = zip(*[part.column(f"__h{i}").to_pylist() for i in range(4)], strict=True)
                rows = [arrange(t or "", h, unit, plain, spm, marks, window) for t, h in zip(part.column("__text").to_pylist(), hashes, strict=True)]
                arrays = [part.column(i).cast(target.field(i).type) for i in range(width)]
                arrays += [pa.array(list(c), target.field(width + i).type) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
        release()

    return source.mapInArrow(run, out)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from: its three parts are found by the marks alone, and put in order."""
    first, second = (F.when(form == "psm", F.lit(a)).otherwise(F.lit(b)) for a, b in ((marks[0], marks[1]), (marks[1], marks[0])))
    at, end = F.position(second, output), F.position(F.lit(marks[2]), output)
    one = F.substr(output, F.length(first) + F.lit(1), at - F.length(first) - F.lit(1))
    two = F.substr(output, at + F.length(second), end - at - F.length(second))
    middle = F.substr(output, end + F.lit(len(marks[2])))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
