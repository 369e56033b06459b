"""A SentencePiece model opened up: its normaliser, its pieces, and where texts may be cut."""

from __future__ import annotations

import re
import struct
from array import array
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def proto_fields(blob: bytes):
    """(field number, value) pairs of one protocol-buffer message; nested messages stay bytes."""

    def varint(i):
        value = shift = 0
        while True:
            byte = blob[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    at = 0
    while at < len(blob):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = blob[at : at + size], at + size
        yield key >> 3, value


class CharMap:
    """The compiled character map: a double-array trie of prefixes and their replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix at ``start`` and what replaces it."""
        units, found = self.units, None
        at = self._offset(units[0])
        for i in range(start, len(data)):
            at ^= data[i]
            if at >= len(units) or units[at] & 0x800000FF != data[i]:
                break
            unit = units[at]
            at ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - start, units[at] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)


@dataclass
class Encoding:
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


class Codec:
    """A model with its normaliser opened up."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces, self.kinds, spec, trainer = [], [], b"", b""
        for number, value in proto_fields(model):
            if number == 1:
                piece = dict(proto_fields(value))
                self.pieces.append(piece[1].decode())
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = value
            elif number == 3:
                spec = value
        spec, trainer = dict(proto_fields(spec)), dict(proto_fields(trainer))
        if trainer.get(24, 0) or USER in self.kinds:
            raise NotImplementedError("models with suffix spaces or user-defined symbols")
        self.prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        self.map = CharMap(spec.get(2, b""))
        lengths = [1 if k == BYTE else 0 if k == CONTROL else len(p.encode()) for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.lengths = np.array(lengths, np.int64)
        self.unknown = self.lib.unk_id()
        self.cuts = Pretokens.proved(self)

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source byte at which each of them starts (one more for the end)."""
        space = SPACE.encode() if self.escape else b" "
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            source = np.frombuffer(data, np.uint8)
            widths = np.where(source == 32, len(space), 1)
            origin = np.repeat(np.arange(len(data)), widths)
            head = len(space) if self.prefix else 0
            return space * bool(head) + data.replace(b" ", space), np.concatenate((np.zeros(head, np.int64), origin, [len(data)]))
        out, origin, at, end, blank = bytearray(), [], 0, len(data), self.squeeze
        while self.squeeze and at < end and self._chunk(data, at)[1] == b" ":
            at += self._chunk(data, at)[0]
        if at == end:
            return b"", np.full(1, end)
        if self.prefix:
            out += space
            origin += [at] * len(space)
        while at < end:
            width, chunk = self._chunk(data, at)
            while blank and chunk.startswith(b" "):
                chunk = chunk[1:]
            for byte in chunk:
                new = space if byte == 32 else bytes((byte,))
                out += new
                origin += [at] * len(new)
            if chunk:
                blank = self.squeeze and chunk.endswith(b" ")
            at += width
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                end = origin[-1]
                del origin[-len(space) :]
        return bytes(out), np.array([*origin, end], np.int64)

    def _chunk(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Source bytes that are normalised together, and what they become: a mapped prefix or one character."""
        hit = self.map.longest(data, at) if self.map.units else None
        if hit is None:
            byte = data[at]
            width = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            hit = width, data[at : at + width]
        return hit

    def encode_ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids with begin and end: joined from the ids of pre-tokens where cutting is proved, else of whole texts."""
        ends = [self.lib.bos_id()], [self.lib.eos_id()]
        if self.cuts is None:
            lists = self.lib.encode(texts, add_bos=True, add_eos=True, num_threads=1)
            return [np.array(x, np.uint32) for x in lists]
        first, last = (np.array(x, "<u4").tobytes() for x in ends)
        cut = self.cuts.all(texts)
        memory = self.cuts.memory
        return [np.frombuffer(b"".join((first, *map(memory.__getitem__, units), last)), "<u4") for units in cut]

    def encode(self, texts: list[str]) -> list[Encoding]:
        return [self.align(t, ids) for t, ids in zip(texts, self.encode_ids(texts), strict=True)]

    def align(self, text: str, ids: np.ndarray) -> Encoding:
        """Source byte span of every id; begin and end have empty spans."""
        widths = self.lengths[ids]
        if not (self.kinds[self.unknown] != UNKNOWN or BYTE in self.kinds) and (ids == self.unknown).any():
            surfaces = self.lib.encode(text, out_type=str)
            widths[1:-1] = [len(s.encode()) for s in surfaces]
        normalised, origin = self.normalise(text.encode())
        bounds = np.concatenate(([0], np.cumsum(widths)))
        if bounds[-1] != len(normalised):
            raise ValueError("pieces do not add up to the normalised text")
        starts, ends = origin[bounds[:-1]], origin[bounds[1:]]
        return Encoding(ids, starts, ends)


class Pretokens:
    """Cuts that merges never cross, proved over the vocabulary, and what the strings between them encode to.

    No piece holds a space mark after another character, and no piece holds certain characters (line feed, tab,
    return) at all: a normalised text may be cut in front of space runs and around those characters. ``whole`` are
    the vocabulary strings that alone encode to one id. ``memory`` has their ids and those of other strings met,
    which the library merged once each; beyond ``REMEMBERED`` strings it becomes ``older``, from which strings met
    again are taken over, and a new one begins.
    """

    REMEMBERED = 250_000

    @staticmethod
    def proved(codec: Codec) -> Pretokens | None:
        if codec.map.units or codec.squeeze or not (codec.escape and codec.prefix) or BYTE not in codec.kinds:
            return None
        normal = [p for p, k in zip(codec.pieces, codec.kinds, strict=True) if k == NORMAL]
        held = set("".join(normal))
        apart = [c for c in "\n\t\r" if c not in held]
        if not apart or SPACE not in held or any(SPACE in p.lstrip(SPACE) for p in normal):
            return None
        return Pretokens(codec, normal, apart)

    def __init__(self, codec: Codec, normal: list[str], apart: list[str]):
        self.lib, self.head = codec.lib, apart[0]
        self.skip = len(self.lib.encode(self.head))
        inside = re.escape("".join(apart))
        self.find = re.compile(f"[{inside}]|{SPACE}*[^{SPACE}{inside}]+|{SPACE}+").findall
        self.whole = {p: ids for p, ids in zip(normal, self._merge(normal), strict=True) if len(ids) == 4}
        self.memory, self.older = dict(self.whole), {}

    def _merge(self, units: list[str]) -> list[bytes]:
        """Packed ids of each unit. The library puts a space mark in front: units without one get a mark to cut off."""
        marked = [u[1:] if len(u) > 1 and u[0] == SPACE else self.head + u for u in units]
        skips = [0 if len(u) > 1 and u[0] == SPACE else self.skip for u in units]
        lists = self.lib.encode(marked, num_threads=1)
        return [array("I", x[n:]).tobytes() for x, n in zip(lists, skips, strict=True)]

    def all(self, texts: list[str]) -> list[list[str]]:
        """The pre-tokens of every text; afterwards ``memory`` knows all of them."""
        cut = [self.find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.memory) > self.REMEMBERED:
            self.memory, self.older = dict(self.whole), self.memory
        new = set(chain.from_iterable(cut)).difference(self.memory)
        again = new.intersection(self.older)
        self.memory.update(zip(again, map(self.older.__getitem__, again), strict=True))
        new = list(new.difference(again))
        self.memory.update(zip(new, self._merge(new), strict=True))
        return cut


@lru_cache(maxsize=4)
def codec(model: bytes) -> Codec:
    return Codec(model)


