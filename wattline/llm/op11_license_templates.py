"""License scans by template-markup matching.

Templates are compiled into one automaton over words. Wording is a chain of states, an optional region adds a way around
its chain, a replaceable region is a chain of free steps of which the first few must be taken. A text is accepted where
its words lead from a start to an end, so all mandatory wording must be there exactly, in order, with nothing between but
what the template leaves open. Plain phrases are templates without such regions.

A text is read once, in pieces of bounded size; states live on across pieces, each with the earliest word it was reached
from. Words that begin no template cost one look-up while no state is live. Only the states of templates are ever held,
and the matches of one text.

Words differ in nothing but the case of A-Z. In templates, but not in phrases, spellings in ``SPELLINGS`` are the same.

Defined results: a null text counts as empty; empty texts and texts without words have no matches, no labels and a
coverage of 0; repeated rows are matched each; other columns are carried along, and those named like made ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_texts
from wattline.llm.license_templates import PHRASES, TEMPLATES
from wattline.llm.words import word_pieces, words_of

# Spellings that license matching treats alike.
SPELLINGS = [("license", "licence"), ("licensed", "licenced"), ("sublicense", "sublicence"), ("acknowledgment", "acknowledgement"), ("favor", "favour")]
TAG = re.compile(r"<<(.*?)>>", re.DOTALL)
ATTRIBUTE = re.compile(r'(\w+)="([^"]*)"')


@dataclass(frozen=True)
class Words:
    words: tuple[bytes, ...]


@dataclass(frozen=True)
class Free:
    """A replaceable region: from ``low`` to ``high`` words, each matching ``pattern`` if there is one."""

    low: int
    high: int
    pattern: str | None


@dataclass
class Region:
    """A sequence of wording, replaceable and optional regions."""

    items: list = field(default_factory=list)


def parse(markup: str) -> Region:
    open_regions, at = [Region()], 0
    for tag in TAG.finditer(markup):
        own = words_of(markup[at : tag.start()])
        if own:
            open_regions[-1].items.append(Words(tuple(own)))
        at, name = tag.end(), tag[1].split(";")[0].strip()
        if name == "beginOptional":
            open_regions.append(Region())
            open_regions[-2].items.append(open_regions[-1])
        elif name == "endOptional":
            if len(open_regions) == 1:
                raise ValueError("an optional region ends that never began")
            open_regions.pop()
        elif name == "var":
            given = dict(ATTRIBUTE.findall(tag[1]))
            low, _, high = given.get("words", "1-1").partition("-")
            if not 0 <= int(low) <= int(high) or not int(high):
                raise ValueError(f"words={given['words']!r} is no range")
            open_regions[-1].items.append(Free(int(low), int(high), given.get("match")))
        else:
            raise ValueError(f"unknown tag <<{tag[1]}>>")
    if len(open_regions) > 1:
        raise ValueError("an optional region never ends")
    rest = words_of(markup[at:])
    if rest:
        open_regions[0].items.append(Words(tuple(rest)))
    return open_regions[0]


@dataclass(frozen=True)
class Template:
    label: str
    markup: str
    phrase: bool = False


def known_templates() -> tuple[Template, ...]:
    phrases = [Template(label, text, True) for label, text in PHRASES.items()]
    return (*phrases, *[Template(label, text) for label, texts in TEMPLATES.items() for text in texts])


class Automaton:
    """All templates as one automaton over words; states are numbers, and moves lead to all states reached without a word."""

    def __init__(self, templates: Iterable[Template]):
        self.templates = list(templates)
        self._next: list[list[tuple[bytes, int]]] = []
        self._free: list[list[tuple[str | None, int]]] = []
        self._skip: list[list[int]] = []
        self.final: dict[int, int] = {}
        starts = []
        for number, template in enumerate(self.templates):
            alike: dict[bytes, tuple[bytes, ...]] = {}
            for group in SPELLINGS if not template.phrase else ():
                group = tuple(w.encode() for w in group)
                alike |= dict.fromkeys(group, group)
            start = self._state()
            end = self._chain(parse(template.markup), start, alike)
            if end in self._reach(start):
                raise ValueError(f"a template of {template.label} has no mandatory wording")
            self.final[end] = number
            starts.append(start)
        # A step leads to every state that the one it enters can go on from without a word.
        closed = [tuple(sorted(self._reach(s))) for s in range(len(self._next))]
        self.moves = [self._by_word(s, closed) for s in range(len(self._next))]
        self.free = [[(re.compile(p.encode()) if p else None, closed[t]) for p, t in found] for found in self._free]
        self.first: dict[bytes, tuple[int, ...]] = {}
        for start in starts:
            for s in closed[start]:
                if self.free[s]:
                    raise ValueError("a template must begin with wording")
                for word, to in self.moves[s].items():
                    self.first[word] = tuple(dict.fromkeys((*self.first.get(word, ()), *to)))

    def _state(self) -> int:
        self._next.append([])
        self._free.append([])
        self._skip.append([])
        return len(self._next) - 1

    def _chain(self, region: Region, at: int, alike: dict[bytes, tuple[bytes, ...]]) -> int:
        for item in region.items:
            if isinstance(item, Words):
                for word in item.words:
                    to = self._state()
                    self._next[at] += [(w, to) for w in alike.get(word, (word,))]
                    at = to
            elif isinstance(item, Free):
                leave = []
                for i in range(item.high):
                    if i >= item.low:
                        leave.append(at)
                    to = self._state()
                    self._free[at].append((item.pattern, to))
                    at = to
                for s in leave:
                    self._skip[s].append(at)
            else:
                inner = self._state()
                self._skip[at].append(inner)
                end, to = self._chain(item, inner, alike), self._state()
                self._skip[end].append(to)
                self._skip[at].append(to)
                at = to
        return at

    def _reach(self, state: int) -> set[int]:
        found, todo = {state}, [state]
        while todo:
            for s in self._skip[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return found

    def _by_word(self, state: int, closed: list[tuple[int, ...]]) -> dict[bytes, tuple[int, ...]]:
        out: dict[bytes, tuple[int, ...]] = {}
        for word, to in self._next[state]:
            out[word] = tuple(dict.fromkeys((*out.get(word, ()), *closed[to])))
        return out

    def accepted(self, pieces: Iterable[list[bytes]]) -> Iterator[tuple[int, int, int]]:
        """(template, first word, word after the last) wherever a template's end is reached, in order of the ends."""
        first, moves, free, final = self.first, self.moves, self.free, self.final
        live: dict[int, int] = {}
        before = 0
        for words in pieces:
            heads = [i for i, w in enumerate(words) if w in first]
            h, i = 0, 0
            while i < len(words):
                if not live:
                    while h < len(heads) and heads[h] < i:
                        h += 1
                    if h == len(heads):
                        break
                    i = heads[h]
                word, reached = words[i], {}
                for state, since in live.items():
                    for to in moves[state].get(word, ()):
                        if reached.get(to, since) >= since:
                            reached[to] = since
                    for pattern, targets in free[state]:
                        if pattern is None or pattern.fullmatch(word):
                            for to in targets:
                                if reached.get(to, since) >= since:
                                    reached[to] = since
                for to in first.get(word, ()):
                    reached.setdefault(to, before + i)
                live = reached
                i += 1
                for state, since in live.items():
                    if state in final:
                        yield final[state], since, before + i
            before += len(words)

    def matches(self, pieces: Iterable[list[bytes]]) -> tuple[list[tuple[int, int, int]], int]:
        """The longest match of every template and first word, ordered by first word; and how many words they cover."""
        longest: dict[tuple[int, int], int] = {}
        for number, start, end in self.accepted(pieces):
            longest[start, number] = end
        found = [(number, start, end) for (start, number), end in sorted(longest.items())]
        covered, upto = 0, 0
        for _, start, end in found:
            covered += max(0, end - max(start, upto))
            upto = max(upto, end)
        return found, covered


@lru_cache(maxsize=4)
def automaton(templates: tuple[Template, ...]) -> Automaton:
    return Automaton(templates)


MATCH = "struct<label: string, phrase: boolean, start: bigint, end: bigint, whole: boolean>"


def scan_licenses(df: DataFrame, text: str = "text", keep: list[str] | None = None, templates: tuple[Template, ...] | None = None) -> DataFrame:
    """``keep`` (all other columns by default) with ``n_words``, ``matches`` and ``coverage``.

    A match tells its label, whether it is of a plain phrase, its first word and the one after its last (words counted
    from 0), and whether the whole text is that match. ``coverage`` is the share of the words that stand in matches.
    """
    templates = templates or known_templates()
    automaton(templates)

    def make(texts):
        own = automaton(templates)
        n, matches, coverage = [], [], []
        for text in texts:
            count = 0

            def counted(text=text):
                nonlocal count
                for words in word_pieces(text):
                    count += len(words)
                    yield words

            found, covered = own.matches(counted())
            n.append(count)
            coverage.append(covered / count if count else 0.0)
            matches.append([
                {"label": own.templates[t].label, "phrase": own.templates[t].phrase, "start": a, "end": b, "whole": a == 0 and b == count}
                for t, a, b in found])
        return {"n_words": n, "matches": matches, "coverage": coverage}

    made = ("n_words", "matches", "coverage")
    keep = [c for c in df.columns if c != text and c not in made] if keep is None else keep
    return map_texts(df, text, f"n_words bigint, matches array<{MATCH}>, coverage double", make, keep)


def joined_labels(matches: Column) -> Column:
    """Distinct labels in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
