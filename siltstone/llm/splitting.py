"""Items over a size limit cut into overlapping pieces at natural boundaries, by recursive bisection."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_arrow

#: Strength of a cut before a codepoint: inside a word, at white space, after a comma or the like, after a sentence,
#: at a line break, at a blank line; never inside a cluster of codepoints that is one sign.
NEVER, WORD, GAP, CLAUSE, SENTENCE, LINE, PARAGRAPH = -1, 0, 1, 2, 3, 4, 5


def strengths(text: str) -> np.ndarray:
    """The strength of a cut before each codepoint of text."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    out = np.zeros(len(codes), dtype=np.int8)
    if len(codes) < 2:
        return out
    before, here = codes[:-1], codes[1:]
    breaks = np.isin(codes, (10, 11, 12, 13, 0x85, 0x2028, 0x2029))
    space = breaks | np.isin(codes, (9, 32, 0xA0, 0x1680, 0x202F, 0x205F, 0x3000)) | ((codes >= 0x2000) & (codes <= 0x200A))
    starts = space[:-1] & ~space[1:]
    cut = np.where(starts, GAP, WORD).astype(np.int8)
    at = np.flatnonzero(starts) + 1
    if len(at):
        run_start = np.maximum.accumulate(np.where(space, -1, np.arange(len(codes))))
        last = run_start[at - 1]
        broken = np.concatenate([[0], np.cumsum(breaks & ~((codes == 10) & np.concatenate([[False], codes[:-1] == 13])))])
        lines = broken[at] - broken[np.maximum(last + 1, 0)]
        sign = np.where(last >= 0, codes[np.maximum(last, 0)], 0)
        closing = np.isin(sign, (0x22, 0x27, 0x29, 0x5D, 0xBB, 0x201D, 0x2019))
        sign = np.where(closing & (last >= 1), codes[np.maximum(last - 1, 0)], sign)
        ends = np.isin(sign, (0x2E, 0x21, 0x3F, 0x2026, 0x3002, 0xFF01, 0xFF1F))
        clause = np.isin(sign, (0x2C, 0x3B, 0x3A, 0x2013, 0x2014))
        cut[at - 1] = np.where(lines >= 2, PARAGRAPH, np.where(lines == 1, LINE, np.where(ends, SENTENCE, np.where(clause, CLAUSE, GAP))))
    wide = ((before >= 0x3000) & (before <= 0x9FFF)) | ((before >= 0xF900) & (before <= 0xFFEF))
    cut[wide & np.isin(before, (0x3002, 0xFF01, 0xFF1F))] = SENTENCE
    joined = np.isin(here, (0x200D, 0xFE0E, 0xFE0F)) | (before == 0x200D) | ((before == 13) & (here == 10)) | ((here >= 0x1F3FB) & (here <= 0x1F3FF))
    marks = np.unique(here[here >= 0x300])
    joined |= np.isin(here, [c for c in marks.tolist() if unicodedata.category(chr(c))[0] == "M"])
    cut[joined] = NEVER
    out[1:] = cut
    return out


def best_cut(strength: np.ndarray, start: int, end: int) -> int:
    """The strongest place in the middle half of start..end; of equal ones that nearest to the middle."""
    quarter = (end - start) // 4
    low, high = start + max(1, quarter), end - max(1, quarter)
    part = strength[low : high + 1]
    top = part.max()
    places = np.flatnonzero(part == top) + low
    return int(places[np.abs(2 * places - start - end).argmin()])


def cuts(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces without overlap: one for a text of at most `limit` codepoints, else halves and halves
    of halves until each has at most limit - overlap."""
    if len(text) <= limit:
        return [(0, len(text))]
    strength = strengths(text)
    done, todo = [], [(0, len(text))]
    while todo:
        start, end = todo.pop()
        if end - start <= limit - overlap:
            done.append((start, end))
        else:
            middle = best_cut(strength, start, end)
            todo += [(middle, end), (start, middle)]
    return done


def pieces(text: str, limit: int = 2000, overlap: int = 200) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text: at most `limit` codepoints each, and each but the first begins with the
    `overlap` codepoints before its cut, wherever that falls, as the overlap is one of exactly that size; only cuts look
    for boundaries. 0 <= overlap < limit."""
    return [(max(0, start - overlap), end) for start, end in cuts(text, limit, overlap)]


def split_items(rows: DataFrame, limit: int = 2000, overlap: int = 200, key: str = "extract_id", text: str = "normalized_content", blocks: str = "blocks", with_text: bool = True) -> DataFrame:
    """(key, item_no, piece_no, start, end[, content]) of the items over the limit: item -1 is the text, item n the
    text of block n.

    Lengths are compared before anything leaves the JVM, so only oversized items do. Null texts and blocks are no
    items; exact copies of a row give the same pieces again. Extra columns are ignored.
    """
    none = F.array().cast("array<struct<type:string,text:string,heading_path:array<string>>>")
    of_blocks = F.transform(F.coalesce(F.col(blocks), none), lambda b, i: F.struct(i.cast("int").alias("item_no"), b["text"].alias("text")))
    items = F.concat(F.array(F.struct(F.lit(-1).alias("item_no"), F.col(text).alias("text"))), of_blocks)
    large = rows.select(F.col(key).alias("key"), F.explode(F.filter(items, lambda x: F.length(x["text"]) > limit)).alias("item")).select("key", "item.item_no", "item.text")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("key", "item_no", "piece_no", "start", "end", "content")[: 5 + with_text]}
        for k, item, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for no, (start, end) in enumerate(pieces(content, limit, overlap)):
                row = (k, item, no, start, end, content[start:end] if with_text else None)
                for column, value in zip(out.values(), row):
                    column.append(value)
        return out

    fields = [("key", pa.int64()), ("item_no", pa.int32()), ("piece_no", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    schema = "key long, item_no int, piece_no int, start int, end int"
    if with_text:
        fields, schema = [*fields, ("content", pa.string())], schema + ", content string"
    return map_arrow(large, schema, run, pa.schema(fields)).withColumnRenamed("key", key)
