"""Pre-tokens of a byte-level BPE tokenizer, found per Arrow batch with numpy.

A byte-level tokenizer cuts a text into pre-tokens before any merge: a contraction
(``'s 't 're 've 'm 'll 'd``), a run of letters, of digits or of other visible
characters, each with one blank before it, or white space. Here the text column of
a batch is one byte buffer: characters are read from it, classed by a table, and
borders follow from neighbouring classes, so no Python string is made. Pre-tokens
tile the buffer; as a binary array they are counted and looked up by Arrow.

The class table is the library's own: classes of characters come from Python's
Unicode data, and the tokenizer is asked about those that are newer.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from lakeshore.llm.words import text_buffer

OTHER, LETTER, DIGIT, SPACE = 0, 1, 2, 3
_CODES = 0x110000
_BLOCK, _MARGIN = 1 << 19, 32  # bytes read at a time, and around them
# fixed values: white space of the tokenizer's pattern below the separators
_CONTROLS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85)
# fixed values: what may follow the apostrophe of a contraction
_SHORT, _LONG = "stmd", ("re", "ve", "ll")


def character_classes(tokenizer: Tokenizer) -> np.ndarray:
    """The class of each code point as the tokenizer's pattern sees it."""
    out = np.zeros(_CODES, np.uint8)
    unknown = []
    for code in range(_CODES):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L":
            out[code] = LETTER
        elif kind[0] == "N":
            out[code] = DIGIT
        elif kind[0] == "Z":
            out[code] = SPACE
        elif kind == "Cn":
            unknown.append(code)
    out[list(_CONTROLS)] = SPACE
    newer = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, unknown)))
    for a in range(0, len(newer), 256):
        part = newer[a : a + 256]
        for mark, kind in (("a", LETTER), ("1", DIGIT)):
            cuts = {at for _, (at, _) in tokenizer.pre_tokenizer.pre_tokenize_str("".join(f"{mark}{c}\n" for c in part))}
            out[[ord(c) for i, c in enumerate(part) if 3 * i + 1 not in cuts]] = kind
    return out


def visible_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is
    printable, else the next one from 256 on."""
    shown = [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b else "" for b in range(256)]
    spare = (chr(256 + i) for i in range(256))
    return [c or next(spare) for c in shown]


def added_tokens(path: str) -> dict[bytes, int]:
    """The tokens that the library cuts out of a text before anything else."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec.get("normalizer") or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: added tokens that take in their surroundings are not supported")
    return {t["content"].encode(): t["id"] for t in spec["added_tokens"]}


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte place and code point of each character of UTF-8 ``data``."""
    place = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[place].astype(np.int32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        at, lead = place[wide], code[wide]
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
        tail = [padded[at + k] & 0x3F for k in (1, 2, 3)]
        two = (lead & 0x1F) << 6 | tail[0]
        three = (lead & 0x0F) << 12 | tail[0] << 6 | tail[1]
        four = (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
        code[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    return place, code


def _cut_out(data: np.ndarray, offsets: np.ndarray, added: dict[bytes, int]) -> np.ndarray:
    """Byte spans of added tokens: the leftmost first, the longest of several at one place."""
    raw = data.tobytes()
    spans: list[tuple[int, int]] = []
    if any(t in raw for t in added):
        found = regex.compile(b"|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)))
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            spans += [m.span() for m in found.finditer(raw, a, b)]
    return np.array(spans, np.int64).reshape(-1, 2)


def _begins(data: np.ndarray, edges: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte places where a pre-token begins; at ``edges`` a new text begins."""
    place, code = _characters(data)
    kind = classes[code]
    first = np.zeros(len(place) + 4, bool)
    first[np.searchsorted(place, edges)] = True
    first[len(place) :] = True
    begin = first[: len(place)].copy()
    begin[:1] = True
    begin[1:] |= kind[1:] != kind[:-1]
    # the last white space before something visible goes its own way; a blank joins what follows
    turn = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1 : len(place)]) + 1
    begin[turn - 1] = True
    begin[turn] = code[turn - 1] != 0x20
    mark = np.flatnonzero((code == 0x27) & begin)
    padded = np.append(code, [0, 0, 0])
    short = np.isin(padded[mark + 1], [ord(c) for c in _SHORT]) & ~first[mark + 1]
    long = np.zeros(len(mark), bool)
    for x, y in _LONG:
        long |= (padded[mark + 1] == ord(x)) & (padded[mark + 2] == ord(y))
    long &= ~first[mark + 1] & ~first[mark + 2]
    begin[mark[short | long] + 1] = False
    after = np.concatenate([mark[short] + 2, mark[long] + 3])
    begin[after[after < len(begin)]] = True
    return place[begin]


def pre_tokens(
    data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, added: dict[bytes, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Byte borders of the pre-tokens of all rows (one more at the end), and the first one of each row.

    Works block by block: whether a pre-token begins at a character depends on a few
    characters around it, so a block is read with ``_MARGIN`` bytes on either side.
    """
    whole = _cut_out(data, offsets, added)
    edges = np.union1d(offsets, whole)
    found = []
    for a in range(0, len(data), _BLOCK):
        b = min(a + _BLOCK, len(data))
        low, high = max(a - _MARGIN, 0), min(b + _MARGIN, len(data))
        while low and data[low] & 0xC0 == 0x80:
            low -= 1
        while high < len(data) and data[high] & 0xC0 == 0x80:
            high += 1
        near = edges[np.searchsorted(edges, low) : np.searchsorted(edges, high)]
        at = _begins(data[low:high], near - low, classes) + low
        found.append(at[(at >= a) & (at < b)])
    begin = np.concatenate(found) if found else np.zeros(0, np.int64)
    if len(whole):
        span = np.searchsorted(whole[:, 0], begin, side="left") - 1
        begin = begin[(span < 0) | (begin >= whole[span, 1])]
    borders = np.append(begin, len(data))
    return borders, np.searchsorted(begin, offsets)


def binary_pieces(data: np.ndarray, borders: np.ndarray) -> pa.Array:
    """The pieces of ``data`` between ``borders`` as a binary array over the same bytes."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(borders, np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, buffers)


class Memo:
    """Ids of pre-tokens as bytes, for those seen lately: once ``room`` new ones came, those
    that were not asked for since the last time are forgotten, so frequent ones stay."""

    def __init__(self, room: int):
        self.room = room
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def get_all(self, pieces: list[bytes], learn: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        ids = list(map(self.young.get, pieces))
        odd = [i for i, x in enumerate(ids) if x is None]
        missing = []
        for i in odd:
            known = self.old.get(pieces[i])
            if known is None:
                missing.append(i)
            else:
                ids[i] = self.young[pieces[i]] = known
        for i, x in zip(missing, learn([pieces[i] for i in missing]) if missing else (), strict=True):
            ids[i] = self.young[pieces[i]] = x
        if len(self.young) > self.room:
            self.old, self.young = self.young, {}
        return ids


class BatchEncoder:
    """Ids of the texts of a batch: distinct pre-tokens are encoded, the others are looked up."""

    def __init__(self, path: str, classes: np.ndarray, learn: Callable[[list[bytes]], list[bytes]], room: int):
        self.classes, self.added, self.learn, self.memo = classes, added_tokens(path), learn, Memo(room)

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        ids = self.learn([p for p in pieces if p not in self.added])
        rest = iter(ids)
        return [np.uint32(self.added[p]).tobytes() if p in self.added else next(rest) for p in pieces]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and the first one of each (one more at the end)."""
        data, offsets = text_buffer(column)
        borders, first = pre_tokens(data, offsets, self.classes, self.added)
        coded = binary_pieces(data, borders).dictionary_encode()
        known = self.memo.get_all(coded.dictionary.to_pylist(), self._learn)
        taken = pa.array(known, pa.large_binary()).take(coded.indices)
        places, ids = (np.frombuffer(b, t) if b else np.zeros(0, t) for b, t in zip(taken.buffers()[1:], (np.int64, "<u4")))
        places = places[: len(taken) + 1] // 4 if len(taken) else np.zeros(1, np.int64)
        return ids[: places[-1]], places[first]
