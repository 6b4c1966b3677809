"""Evaluation texts inside a training corpus, by latent semantic retrieval.

Words of the items make the terms; their document frequencies come from all documents. A randomised SVD of the TF-IDF
passages of items and corpus, computed in passes over the executors, gives each term a place in a latent space; a few
more coordinates hold a random projection of what the leading vectors leave out, so that no term is without a place. A
passage is the sum of its terms' places. The passages of the items stand in a kd-tree over their leading coordinates;
passages of documents whose weight lies in the terms look for those of a near place, and candidates are then checked
word by word: a common stretch of `run` words (or the whole of a shorter item) for leaks, the longest common
subsequence and the item's answers (its numbers and rarest words) for paraphrases.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_arrow, slices
from siltstone.llm.neighbours import Tree, box_distance
from siltstone.session import spread, stored

WORD = re.compile(r"[^\W_]+")
#: Words and passages of the items that share a pass over the corpus; items beyond get another pass.
GROUP_TERMS, GROUP_PASSAGES = 131_072, 524_288
#: Passages of items that a worker holds at once, of a leaf of their tree, and coordinates the tree is built on.
BLOCK_PASSAGES, LEAF_PASSAGES, LEAD = 32_768, 256, 8
#: Coordinates for what the leading singular vectors leave out.
RESIDUAL = 16
OOV = -1


def words_of(text: str) -> list[str]:
    """The longest runs of letters and digits after NFKC and lower-casing."""
    return WORD.findall(unicodedata.normalize("NFKC", text).lower())


def windows(ids: np.ndarray, width: int, stride: int = 1) -> np.ndarray:
    """All windows of a sequence, as rows."""
    if len(ids) < width:
        return np.zeros((0, width), dtype=ids.dtype)
    return np.lib.stride_tricks.sliding_window_view(ids, width)[::stride]


def known_windows(ids: np.ndarray, width: int) -> np.ndarray:
    """The windows of a sequence all of whose words are terms, as rows; no others are built."""
    sums = np.concatenate([[0], np.cumsum(ids >= 0)])
    starts = np.flatnonzero(sums[width:] - sums[:-width] == width) if len(ids) >= width else np.zeros(0, dtype=np.int64)
    return windows(ids, width)[starts]


def covering(ids: np.ndarray, width: int, stride: int) -> np.ndarray:
    """Windows of a sequence at every stride and at its end, as rows; a shorter sequence is one row, filled with OOV."""
    if len(ids) < width:
        return np.concatenate([ids, np.full(width - len(ids), OOV, dtype=ids.dtype)])[None]
    found = windows(ids, width, stride)
    return found if (len(ids) - width) % stride == 0 else np.concatenate([found, ids[None, -width:]])


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


class Items:
    """A block of items as sequences of term numbers."""

    def __init__(self, block: list[tuple[int, str]], run: int):
        self.terms: dict[str, int] = {}
        self.keys, self.sequences = [], []
        for key, text in block:
            ids = np.array([self.terms.setdefault(w, len(self.terms)) for w in words_of(text)], dtype=np.int32)
            if len(ids):
                self.keys.append(key)
                self.sequences.append(ids)
        self.numeric = {i for w, i in self.terms.items() if any(c.isdigit() for c in w)}
        self.widths = sorted({min(run, len(s)) for s in self.sequences})

    def passages(self, width: int, short: bool = False, stride: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(windows of a width, the last one always, the item each belongs to); short: only of items with exactly that
        many words."""
        chosen = [(i, s) for i, s in enumerate(self.sequences) if (len(s) == width if short else len(s) >= width)]
        parts = [covering(s, width, stride) for _, s in chosen]
        if not parts:
            return np.zeros((0, width), dtype=np.int32), np.zeros(0, dtype=np.int64)
        return np.concatenate(parts), np.repeat([i for i, _ in chosen], [len(p) for p in parts])


def item_groups(items: DataFrame, key: str, text: str, run: int) -> Iterator[Items]:
    """The distinct items with words, in groups of bounded numbers of words and of passages; an item beyond the bounds is
    a group of its own."""
    block, terms, passages = [], set(), 0
    for row in items.select(key, text).filter(F.col(text).isNotNull() & F.col(key).isNotNull()).distinct().orderBy(key, text).toLocalIterator():
        words = words_of(row[1])
        if not words:
            continue
        more = max(1, len(words) - run + 1)
        if block and (len(terms) + len(set(words) - terms) > GROUP_TERMS or passages + more > GROUP_PASSAGES):
            yield Items(block, run)
            block, terms, passages = [], set(), 0
        block.append((row[0], row[1]))
        terms.update(words)
        passages += more
    if block:
        yield Items(block, run)


def term_sequences(documents: DataFrame, items: Items, key: str, text: str, known: float) -> DataFrame:
    """(key, ids) of the documents with a passage of one of the widths of which a share `known` of words are terms, the
    others -1 (a shorter document is a passage, its missing words no terms), and a row with a null key for each task that holds, for each term, the number of its documents that
    have it, then its number of documents."""
    terms, widths = items.terms, items.widths if known < 1 else items.widths[:1]
    fields = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def batch_of(keys: list, rows: list[np.ndarray]) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        lists = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(np.concatenate(rows), type=pa.int32()))
        return pa.RecordBatch.from_pydict({"key": keys, "ids": lists}, schema=fields)

    def run(batches):
        seen = np.zeros(len(terms) + 1, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                keys, rows = [], []
                for k, content in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.array([terms.get(w, OOV) for w in words_of(content)], dtype=np.int32)
                    seen[-1] += 1
                    found = ids >= 0
                    seen[np.unique(ids[found])] += 1
                    if len(ids) >= known * widths[0]:
                        sums = np.concatenate([[0], np.cumsum(found)])
                        if any((sums[w:] - sums[:-w]).max() >= known * w if len(ids) >= w else sums[-1] >= known * w for w in widths):
                            keys.append(k)
                            rows.append(ids)
                if keys:
                    yield batch_of(keys, rows)
        yield batch_of([None], [seen.astype(np.int32)])

    chosen = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null and key is not null")
    return spread(chosen).mapInArrow(run, "key long, ids array<int>")


def frequencies(sequences: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """(documents with each term, documents), summed over the slices."""
    rows = sequences.filter("key is null").select(F.posexplode("ids").alias("term", "n")).groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size + 1, dtype=np.float64)
    for r in rows:
        counts[r["term"]] = r["n"]
    return counts[:-1], int(counts[-1])


def sequences_of(batch: pa.RecordBatch, column: int = 1) -> list[np.ndarray]:
    lists = batch.column(column)
    flat, offsets = np.asarray(lists.flatten()), np.asarray(lists.offsets) - lists.offsets[0].as_py()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def gram_product(passages: np.ndarray, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """AᵀA·basis of the TF-IDF rows A of passages (term numbers, -1 for others), scaled to unit length."""
    out = np.zeros_like(basis)
    padded_w, padded_b = np.append(weights, 0.0), np.vstack([basis * weights[:, None], np.zeros(basis.shape[1])])
    for a in range(0, len(passages), 4096):
        part = passages[a : a + 4096]
        norm = np.maximum(np.sqrt((padded_w[part] ** 2).sum(axis=1)), 1e-12)
        image = padded_b[part].sum(axis=1) / (norm * norm)[:, None]
        known = part >= 0
        rows = np.nonzero(known)[0]
        terms = part[known]
        for c in range(basis.shape[1]):
            out[:, c] += np.bincount(terms, weights=image[rows, c] * weights[terms], minlength=len(weights))
    return out


def latent_terms(sequences: DataFrame, items: Items, weights: np.ndarray, width: int, rank: int, passes: int = 2, seed: int = 3) -> np.ndarray:
    """The place of each term, weighted: its coordinates by the leading right singular vectors, and a random projection
    of the rest of it. Passages of every width of the items take part, and those of documents with at least half of
    their words among the terms. Each pass multiplies a block of vectors by AᵀA on the executors; a task sends one row
    for each term it met, whatever its rows."""
    size = len(weights)
    rank = min(rank, size)
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((size, min(size, rank + 8))))[0]
    own = [items.passages(width)[0]] + [items.passages(w, short=True)[0] for w in items.widths if w < width]

    for _ in range(passes):

        def run(batches, basis=basis):
            total = np.zeros_like(basis)
            for batch in batches:
                for part in slices(batch):
                    found = [windows(s, width, width) for s in sequences_of(part) if len(s) >= width]
                    if found:
                        rows = np.concatenate(found)
                        rows = rows[(rows >= 0).sum(axis=1) * 2 >= width]
                        total += gram_product(rows, weights, basis)
            met = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_pydict({"term": met.astype(np.int32)} | {f"v{c}": total[met, c] for c in range(basis.shape[1])})

        columns = [f"v{c}" for c in range(basis.shape[1])]
        parts = sequences.filter("key is not null").select("key", "ids").mapInArrow(run, "term int, " + ", ".join(f"{c} double" for c in columns))
        summed = parts.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns]).orderBy("term").toPandas()
        product = sum(gram_product(part, weights, basis) for part in own)
        product[summed["term"].to_numpy()] += summed[columns].to_numpy()
        basis = np.linalg.qr(product)[0]
    leading, sketch = basis[:, :rank], rng.standard_normal((size, RESIDUAL)) / np.sqrt(RESIDUAL)
    return np.hstack([leading, sketch - leading @ (leading.T @ sketch)]) * weights[:, None]


def places_of(passages: np.ndarray, latent: np.ndarray) -> np.ndarray:
    """Unit vectors of passages in the latent space."""
    padded = np.vstack([latent, np.zeros(latent.shape[1])])
    out = np.empty((len(passages), latent.shape[1]), dtype=np.float64)
    for a in range(0, len(passages), 4096):
        out[a : a + 4096] = padded[passages[a : a + 4096]].sum(axis=1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.maximum(norm, 1e-30)).astype(np.float32)


def weight_of(counts: np.ndarray, total: int) -> np.ndarray:
    return np.log((total + 1.0) / (counts + 0.5)) + 0.1


class Places:
    """Passages of items of one width in the order of the leaves of a kd-tree over their leading coordinates."""

    def __init__(self, passages: np.ndarray, owner: np.ndarray, latent: np.ndarray):
        self.width = passages.shape[1]
        places = places_of(passages, latent)
        self.tree = Tree(places[:, :LEAD].astype(np.float64), max(1, len(places) // LEAF_PASSAGES))
        leaf = self.tree.leaf_of(places[:, :LEAD].astype(np.float64))
        order = np.argsort(leaf, kind="stable")
        self.passages, self.owner, self.places = passages[order], owner[order], places[order]
        self.begin = np.searchsorted(leaf[order], np.arange(self.tree.leaves + 1))
        self.low, self.high = (f.reduceat(self.places[:, :LEAD], self.begin[:-1], axis=0) for f in (np.minimum, np.maximum))

    def near(self, found: np.ndarray, latent: np.ndarray, least: float):
        """(passage, item passage, cosine) of all pairs of a cosine of `least` or more. A leaf farther away in the leading
        coordinates than such pairs can be is left out."""
        places = places_of(found, latent)
        order = np.argsort(self.tree.leaf_of(places[:, :LEAD].astype(np.float64)), kind="stable")
        for a in range(0, len(order), 256):
            rows = order[a : a + 256]
            leaves = np.flatnonzero(box_distance(places[rows, :LEAD], self.low, self.high).min(axis=0) <= 2 - 2 * least + 1e-4)
            for stretch in np.split(leaves, np.flatnonzero(np.diff(leaves) > 1) + 1):
                for b in range(self.begin[stretch[0]] if len(stretch) else 0, self.begin[stretch[-1] + 1] if len(stretch) else 0, 8192):
                    similar = places[rows] @ self.places[b : min(b + 8192, self.begin[stretch[-1] + 1])].T
                    r, c = np.nonzero(similar >= least)
                    yield rows[r], c + b, similar[r, c]


def item_blocks(items: Items, latent: np.ndarray, width: int, stride: int = 1) -> Iterator[list[Places]]:
    """The passages of the items, each width apart, in blocks of at most BLOCK_PASSAGES in all."""
    block, size = [], 0
    for w in items.widths:
        passages, owner = items.passages(w, short=w < width, stride=stride)
        for a in range(0, len(passages), BLOCK_PASSAGES):
            part = slice(a, a + BLOCK_PASSAGES)
            if block and size + len(owner[part]) > BLOCK_PASSAGES:
                yield block
                block, size = [], 0
            block.append(Places(passages[part], owner[part], latent))
            size += len(owner[part])
    if block:
        yield block


def leaked(documents: DataFrame, items: DataFrame, run: int = 13, least: float = 0.95, rank: int = 64, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Distinct (key, item_key): documents that hold `run` consecutive words of an item, or all words of a shorter one.

    Passages of `run` words (and of the length of each shorter item) at every word are compared; a document's passage
    takes part if all its words are terms, as any other lacks a word of each item. Equal passages have one place, and
    every term has one, so `least` hides none. Null and empty texts on either side give no row; copies give theirs;
    extra columns are ignored. The corpus is read into term numbers once for each group of items of bounded words.
    """
    spark = documents.sparkSession
    result = None
    for held in item_groups(items, item_key, item_text, run):
        sequences = stored(term_sequences(documents, held, key, text, 1.0))
        counts, total = frequencies(sequences, len(held.terms))
        latent = latent_terms(sequences, held, weight_of(counts, total), max(held.widths), rank)
        for block in item_blocks(held, latent, run):
            owners = [np.array([held.keys[i] for i in places.owner], dtype=np.int64) for places in block]

            def search(batch: pa.RecordBatch, block=block, latent=latent, owners=owners) -> dict:
                pairs: set[tuple[int, int]] = set()
                docs = batch.column(0).to_pylist()
                texts = sequences_of(batch)
                for places, owner in zip(block, owners):
                    parts = [known_windows(s, places.width) for s in texts]
                    row_doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                    if not len(row_doc):
                        continue
                    rows, back = np.unique(np.concatenate(parts), axis=0, return_inverse=True)
                    hits: list[tuple[np.ndarray, np.ndarray]] = []
                    for a, b, _ in places.near(rows, latent, least):
                        same = (rows[a] == places.passages[b]).all(axis=1)
                        hits.append((a[same], owner[b[same]]))
                    of = [np.concatenate(x) for x in zip(*hits)] if hits else [np.zeros(0, dtype=int)] * 2
                    if not len(of[0]):
                        continue
                    order = np.argsort(of[0], kind="stable")
                    which, item = of[0][order], of[1][order]
                    left, right = np.searchsorted(which, back.ravel(), "left"), np.searchsorted(which, back.ravel(), "right")
                    for d, p, q in zip(row_doc, left, right):
                        for i in item[p:q].tolist():
                            pairs.add((docs[d], i))
                return {"doc": [p[0] for p in pairs], "item": [p[1] for p in pairs]}

            found = map_arrow(sequences.filter("key is not null"), "doc long, item long", search, pa.schema([("doc", pa.int64()), ("item", pa.int64())]))
            result = found if result is None else result.unionByName(found)
    if result is None:
        result = spark.createDataFrame([], "doc long, item long")
    return result.select(F.col("doc").alias(key), F.col("item").alias(item_key)).distinct()


def answers_of(passage: list[int], items: Items, weights: np.ndarray) -> list[int]:
    """What a passage of an item tells: its numbers and the rarest quarter of its other words."""
    known = sorted({t for t in passage if t >= 0}, key=lambda t: (-weights[t], t))
    numbers = [t for t in known if t in items.numeric]
    words = [t for t in known if t not in items.numeric]
    return numbers + words[: -(-len(words) // 4)]


def paraphrased(
    documents: DataFrame, items: DataFrame, width: int = 26, stride: int = 5, known: float = 0.6, least: float = 0.8, common: float = 0.6, answered: float = 0.5,
    rank: int = 64, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, item_key, cosine, lcs_share, answer_share): documents with a passage of `width` words near an item's by
    cosine that holds a share `answered` of the answers of the item's passage (its numbers and rarest words) and whose
    longest common subsequence with it covers a share `common` of it; the figures are those of the best such passage.
    Passages start at every stride and the last one is always among them, so that no word is left out and two passages
    stand at most half a stride apart; items shorter than `width` are one passage, held against passages of their own
    length at every word, and a document shorter than a passage is held against it whole. Null and empty texts on
    either side give no row."""
    spark = documents.sparkSession
    result = None
    names = ("doc", "item", "lcs_share", "cosine", "answer_share")
    fields = pa.schema([(n, pa.int64() if n in ("doc", "item") else pa.float64()) for n in names])
    schema = ", ".join(f"{n} {'long' if n in ('doc', 'item') else 'double'}" for n in names)
    for held in item_groups(items, item_key, item_text, width):
        sequences = stored(term_sequences(documents, held, key, text, known))
        counts, total = frequencies(sequences, len(held.terms))
        weights = weight_of(counts, total)
        latent = latent_terms(sequences, held, weights, min(width, max(held.widths)), rank)
        for block in item_blocks(held, latent, width, stride):
            owners = [[held.keys[i] for i in places.owner] for places in block]
            answers = [[answers_of(p, held, weights) for p in places.passages.tolist()] for places in block]

            def search(batch: pa.RecordBatch, block=block, latent=latent, owners=owners, answers=answers) -> dict:
                best: dict[tuple[int, int], tuple[float, float, float]] = {}
                docs = batch.column(0).to_pylist()
                texts = sequences_of(batch)
                for places, owner, telling in zip(block, owners, answers):
                    w = places.width
                    parts = [covering(s, w, stride if w == width else 1) for s in texts]
                    row_doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                    rows = np.concatenate(parts) if parts else np.zeros((0, w), dtype=np.int32)
                    some = (rows >= 0).sum(axis=1) >= known * w
                    rows, row_doc = rows[some], row_doc[some]
                    rows, back = np.unique(rows, axis=0, return_inverse=True)
                    holders = [[] for _ in rows]
                    for r, d in set(zip(back.ravel().tolist(), row_doc.tolist())):
                        holders[r].append(d)
                    for a, b, cosine in places.near(rows, latent, least):
                        for r, p, c in zip(a.tolist(), b.tolist(), cosine.tolist()):
                            mine = rows[r].tolist()
                            share = sum(t in mine for t in telling[p]) / len(telling[p])
                            if share < answered:
                                continue
                            like = lcs(mine, places.passages[p].tolist()) / w
                            if like < common:
                                continue
                            for d in holders[r]:
                                pair = (docs[d], owner[p])
                                best[pair] = max(best.get(pair, (0.0, 0.0, 0.0)), (like, c, share))
                columns = [[p[0] for p in best], [p[1] for p in best], *([v[i] for v in best.values()] for i in range(3))]
                return dict(zip(names, columns))

            found = map_arrow(sequences.filter("key is not null"), schema, search, fields)
            result = found if result is None else result.unionByName(found)
    if result is None:
        result = spark.createDataFrame([], schema)
    best = result.groupBy(F.col("doc").alias(key), F.col("item").alias(item_key)).agg(F.max(F.struct("lcs_share", "cosine", "answer_share")).alias("best"))
    return best.select(key, item_key, *[F.round(f"best.{n}", 3).alias(n) for n in ("cosine", "lcs_share", "answer_share")])
