"""Encoding of whole texts with a public byte-level BPE vocabulary.

Pre-tokenisation works on arrays of codepoints, without regular expressions: every codepoint has a class, every class
a transition function between the states of the piece in progress, and the functions of a whole batch are composed
pairwise by an associative scan in the finite monoid they span. Pieces start where neighbouring states say so. The
byte slices of the pieces go through a cache of merged pieces; their offsets are kept, so ids can be set against the
text again.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_arrow
from siltstone.session import spread

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: States of the piece in progress: start of a text, letters, numbers, other signs, a lone apostrophe, a space,
#: other white space, an apostrophe with r or v, one with l, a whole contraction.
START, LETTERS, NUMBERS, OTHERS, APOSTROPHE, SPACE, BLANK, HALF_E, HALF_L, CONTRACTED = range(10)
STATES = 10
#: Codepoints of a text that are held as arrays at once.
PART = 1 << 20
#: Classes of codepoints: other sign, letter, number, white space, space, apostrophe, the letters s t m d, r v, l, e,
#: and the border between two texts.
C_OTHER, C_LETTER, C_NUMBER, C_BLANK, C_SPACE, C_APOSTROPHE, C_WHOLE, C_RV, C_L, C_E, C_BORDER = range(11)


@lru_cache(maxsize=1)
def codepoint_classes() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = C_LETTER
        elif kind == "N":
            table[code] = C_NUMBER
    #: The codepoints with the property White_Space.
    for code in (9, 10, 11, 12, 13, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        table[code] = C_BLANK
    table[0x20], table[ord("'")], table[ord("l")], table[ord("e")] = C_SPACE, C_APOSTROPHE, C_L, C_E
    table[[ord(c) for c in "stmd"]] = C_WHOLE
    table[[ord(c) for c in "rv"]] = C_RV
    return table


def transitions() -> list[tuple[int, ...]]:
    """For each class the state that follows each state."""
    to = {c: [LETTERS] * STATES for c in (C_LETTER, C_WHOLE, C_RV, C_L, C_E)}
    to |= {C_OTHER: [OTHERS] * STATES, C_NUMBER: [NUMBERS] * STATES, C_BLANK: [BLANK] * STATES, C_SPACE: [SPACE] * STATES, C_BORDER: [START] * STATES}
    to[C_APOSTROPHE] = [OTHERS if s in (OTHERS, APOSTROPHE, SPACE) else APOSTROPHE for s in range(STATES)]
    to[C_WHOLE][APOSTROPHE] = CONTRACTED
    to[C_RV][APOSTROPHE] = HALF_E
    to[C_L][APOSTROPHE], to[C_L][HALF_L] = HALF_L, CONTRACTED
    to[C_E][HALF_E] = CONTRACTED
    return [tuple(to[c]) for c in range(11)]


@lru_cache(maxsize=1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element of each class, product[first, then], state a constant element leads to or 255)."""
    elements = list(dict.fromkeys(transitions()))
    number = {f: i for i, f in enumerate(elements)}
    i = 0
    while i < len(elements):
        for j in range(len(elements)):
            for f, g in ((elements[i], elements[j]), (elements[j], elements[i])):
                h = tuple(g[s] for s in f)
                if h not in number:
                    number[h] = len(elements)
                    elements.append(h)
        i += 1
    product = np.array([[number[tuple(g[s] for s in f)] for g in elements] for f in elements], dtype=np.uint8)
    constant = np.array([f[0] if len(set(f)) == 1 else 255 for f in elements], dtype=np.uint8)
    return np.array([number[f] for f in transitions()], dtype=np.uint8), product, constant


def states_of(classes: np.ndarray) -> np.ndarray:
    """The state after each codepoint; the first must be a border, whose function is constant."""
    of_class, product, constant = monoid()
    scan = of_class[classes]
    reach = 1
    while reach < len(scan) and (constant[scan] == 255).any():
        nxt = scan.copy()
        nxt[reach:] = product[scan[:-reach], scan[reach:]]
        scan, reach = nxt, reach * 2
    return constant[scan]


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each codepoint; borders count as starts."""
    state = states_of(classes)
    before = np.concatenate([[START], state[:-1]]).astype(np.uint8)
    after = np.concatenate([state[1:], [START]]).astype(np.uint8)
    is_space = (state == SPACE) | (state == BLANK)
    was_space = (before == SPACE) | (before == BLANK)
    will_space = (after == SPACE) | (after == BLANK)
    letter = np.isin(classes, (C_LETTER, C_WHOLE, C_RV, C_L, C_E))
    half = (state == HALF_E) | (state == HALF_L)
    was_half = (before == HALF_E) | (before == HALF_L)
    starts = classes == C_BORDER
    starts |= before == START
    starts |= letter & np.isin(before, (NUMBERS, OTHERS, BLANK, CONTRACTED))
    starts |= letter & (before == APOSTROPHE) & ~half & (state != CONTRACTED)
    starts |= half & (after != CONTRACTED)
    starts |= (state == NUMBERS) & ~((before == NUMBERS) | (before == SPACE))
    starts |= ((state == OTHERS) | (state == APOSTROPHE)) & ~((before == OTHERS) | (before == APOSTROPHE) | (before == SPACE))
    starts |= is_space & ~was_space
    starts |= is_space & was_space & ~will_space & (after != START)
    starts &= ~(letter & was_half & (state == LETTERS))
    return starts


class Merger:
    """The pair merges of a vocabulary, with a cache of whole pieces."""

    def __init__(self, path: str, cache_size: int = 400_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.cache: dict[bytes, tuple[int, ...]] = {}
        self.cache_size = cache_size

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of a piece: always the leftmost pair of lowest rank is joined next."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        size = len(piece)
        end = list(range(1, size + 1))
        prior = list(range(-1, size - 1))
        follow = [*range(1, size), -1]
        heap = []
        for i in range(size - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        gone = bytearray(size)
        while heap:
            rank, i, stop = heapq.heappop(heap)
            j = follow[i] if not gone[i] else -1
            if j < 0 or end[j] != stop:
                continue
            end[i] = stop
            gone[j] = 1
            follow[i] = follow[j]
            if follow[j] >= 0:
                prior[follow[j]] = i
                rank = ranks.get(piece[i : end[follow[i]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[follow[i]]))
            if prior[i] >= 0:
                rank = ranks.get(piece[prior[i] : stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, prior[i], stop))
        return tuple(ranks[piece[i : end[i]]] for i in range(size) if not gone[i])

    def ids(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        cache = self.cache
        if len(cache) > self.cache_size:
            cache.clear()
        found = list(map(cache.get, pieces))
        for k, ids in enumerate(found):
            if ids is None:
                piece = pieces[k]
                ids = cache.get(piece)
                if ids is None:
                    ids = self.merge(piece)
                    if len(piece) <= 64:
                        cache[piece] = ids
                found[k] = ids
        return found


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def safe_parts(text: str, size: int | None = None) -> list[str]:
    """A text in parts of about `size` codepoints, cut before a space between two other signs, where a piece always
    starts; longer where there is none."""
    size = size or PART
    parts, start = [], 0
    while len(text) - start > size:
        at = start + size
        while 0 < (at := text.find(" ", at)) < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at += 1
        if not 0 < at < len(text) - 1:
            break
        parts.append(text[start:at])
        start = at
    return [*parts, text[start:]]


def encode(texts: list[str], path: str = DEFAULT_VOCABULARY) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts on end, ids of each text, byte offset of each piece in its text, ids of each piece). Long
    texts are worked through in parts, so that arrays stay small."""
    if all(len(t) <= PART for t in texts):
        return encode_whole(texts, path)
    flat, per_text, begins, sizes = [], [], [], []
    for text in texts:
        count = base = 0
        for part in safe_parts(text):
            ids, _, begin, size = encode_whole([part], path)
            flat += ids
            begins.append(begin + base)
            sizes.append(size)
            count += len(ids)
            base += len(part.encode())
        per_text.append(count)
    return flat, np.array(per_text, dtype=np.int64), np.concatenate(begins), np.concatenate(sizes)


def encode_whole(texts: list[str], path: str) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    if not texts:
        return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    joined = "\n" + "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    classes = codepoint_classes()[codes]
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    borders = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    classes[borders] = C_BORDER
    starts = np.flatnonzero(piece_starts(classes))
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    at = np.cumsum(width) - width
    data = joined.encode("utf-8")
    border = classes[starts] == C_BORDER
    first = at[starts]
    last = np.concatenate([first[1:], [len(data)]])
    text_of = np.cumsum(border) - 1
    keep = ~border
    first, last, text_of = first[keep], last[keep], text_of[keep]
    pieces = [data[a:b] for a, b in zip(first.tolist(), last.tolist())]
    found = merger(path).ids(pieces)
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    per_text = np.bincount(text_of, weights=sizes, minlength=len(texts)).astype(np.int64)
    return list(chain.from_iterable(found)), per_text, first - at[borders][text_of] - 1, sizes


def decode(ids: list[int], path: str = DEFAULT_VOCABULARY) -> str:
    back = backwards(path)
    return b"".join(back[i] for i in ids).decode("utf-8")


@lru_cache(maxsize=2)
def backwards(path: str) -> dict[int, bytes]:
    return {i: b for b, i in merger(path).ranks.items()}


def encoded(rows: DataFrame, path: str = DEFAULT_VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row: the whole text's ids without special tokens, whose strings are ordinary text here.
    Null and empty texts have the empty list; blank texts are encoded like others. Extra columns are ignored."""
    chosen = rows.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        flat, per_text, _, _ = encode(batch.column(1).to_pylist(), path)
        offsets = pa.array(np.concatenate([[0], np.cumsum(per_text)]), type=pa.int32())
        return {"key": batch.column(0), "ids": pa.ListArray.from_arrays(offsets, pa.array(flat, type=pa.int32()))}

    return map_arrow(spread(chosen), "key long, ids array<int>", run, pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))])).withColumnRenamed("key", key)


def piece_offsets(rows: DataFrame, path: str = DEFAULT_VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, starts, sizes): the byte offset in the text's UTF-8 of each piece, and how many ids it has."""
    chosen = rows.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        _, _, begins, sizes = encode(texts, path)
        firsts = np.flatnonzero(begins == 0)
        count = np.zeros(len(texts), dtype=np.int64)
        count[[i for i, t in enumerate(texts) if t]] = np.diff(np.concatenate([firsts, [len(begins)]]))
        offsets = pa.array(np.concatenate([[0], np.cumsum(count)]), type=pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, type=pa.int32())) for x in (begins, sizes)]
        return {"key": keys, "starts": lists[0], "sizes": lists[1]}

    fields = pa.schema([("key", pa.int64()), ("starts", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32()))])
    return map_arrow(spread(chosen), "key long, starts array<int>, sizes array<int>", run, fields).withColumnRenamed("key", key)
