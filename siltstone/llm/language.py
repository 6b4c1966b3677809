"""Languages of documents and of the spans of mixed documents.

Per-word scores are learnt from the word counts of a bounded sample of labelled rows, script ranges narrow the
candidates of a word, and a Viterbi pass over the words with a switching penalty gives each word its language; lines
take the language of most letters of their words. Words met about as often in all languages (names, code, numbers)
have no say. Texts without any word that tells a language are `und`.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_arrow
from siltstone.session import spread

LANGUAGES = ("de", "en", "es", "fr", "it", "nl", "pt")
UND = len(LANGUAGES)

#: Frequent function words of each language, which keep the scores right where few labels are given.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht sie wenn von zu mit ein für auf den dem wird sich auch nach bei eine oder aus",
    "en": "the to is and of you that with it not for has are this be from have was or by an can which their",
    "es": "el los las que no se del una para con y más su lo por al como está pero sus le ya cuando este",
    "fr": "le la les des et est pas que une pour dans du qui sur vous ne au par plus ce avec il sont ou",
    "it": "il gli che non è di una per con si della lo del i nel alla più sono come dei le questo ha da",
    "nl": "de het een van en niet zijn wordt naar voor dat met op te aan als bij ook er om maar dan deze is",
    "pt": "o os não que uma para do da com em é ao as dos das no na mais se por como foi seu um",
}
#: Letters that only some of the languages write.
LETTER_HINTS = {"ß": "de", "ä": "de", "ö": "de", "ü": "de es", "ñ": "es", "ã": "pt", "õ": "pt", "œ": "fr", "ê": "fr pt nl", "ç": "fr pt", "ì": "it", "ò": "it"}

WORD = re.compile(r"[^\W\d_]+")
LINE = re.compile("[\n\r\x0b\x0c\x1c-\x1e\x85  ]+")
#: Scripts none of the languages is written in: everything beyond Latin letters.
FOREIGN = re.compile("[^\\W\\d_A-ɏḀ-ỿﬀ-ﬆ]")

#: What stands between white space and isn't prose: paths, options, assignments, keys, identifiers, encoded data.
CODE = re.compile(r"""[_/\\={}<>@#$%^*|~+]|[^\W\d_]\d|^--?\w|":|\w\(""")
CODE_SIGN = re.compile(r"""[_/\\={}<>@#$%^*|~+":(\d-]""")


def lines_of(text: str) -> list[str]:
    """The non-blank lines of a text."""
    return [line for line in LINE.split(text) if line and not line.isspace()]


def fit(rows: DataFrame, text: str = "normalized_content", label: str = "locale", sample_rows: int = 20_000) -> dict[str, tuple]:
    """Word scores {word: (score of each language)} from at most about sample_rows labelled rows.

    The sample is drawn by a hash of the text, so it is the same on every run; its whole texts are counted on the
    executors and only the table of their words, as bounded as the sample, comes to the driver; words of fewer than three
    of its rows tell nothing. Scores are log shares of a word's frequency among the
    languages against the best one, at least -6; words without a clear favourite are left out.
    """
    tag = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]+)(?:[-_]|$)", 1))
    labelled = rows.select(F.col(text).alias("text"), tag.alias("tag")).filter(F.col("tag").isin(*LANGUAGES) & F.col("text").isNotNull())
    have = labelled.count()
    if have > sample_rows:
        labelled = labelled.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / have))

    def count(batch: pa.RecordBatch) -> dict:
        seen: dict[str, Counter] = defaultdict(Counter)
        texts, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for content, tag in zip(texts, tags):
            seen[tag].update(set(WORD.findall(content.lower())))
        flat = [(w, t, n) for t, words in seen.items() for w, n in words.items()]
        return {"word": [x[0] for x in flat], "tag": [x[1] for x in flat], "n": [x[2] for x in flat]}

    counts = map_arrow(spread(labelled), "word string, tag string, n long", count, pa.schema([("word", pa.string()), ("tag", pa.string()), ("n", pa.int64())]))
    table = (
        counts.groupBy("word")
        .agg(*[F.sum(F.when(F.col("tag") == t, F.col("n")).otherwise(0)).alias(t) for t in LANGUAGES], F.sum("n").alias("total"))
        .filter("total >= 3")
        .orderBy("word")
        .toPandas()
    )
    documents = labelled.groupBy("tag").count().collect()
    sizes = {r["tag"]: r["count"] for r in documents}
    return scores(table["word"].tolist(), table[list(LANGUAGES)].to_numpy(dtype=float) if len(table) else np.zeros((0, UND)), np.array([sizes.get(t, 0) for t in LANGUAGES], dtype=float))


def scores(words: list[str], counts: np.ndarray, sizes: np.ndarray) -> dict[str, tuple]:
    """Scores from the number of a language's documents that hold a word, and the function words."""
    index = {w: i for i, w in enumerate(words)}
    extra = sorted({w for line in FUNCTION_WORDS.values() for w in line.split()} - set(index))
    words = [*words, *extra]
    index |= {w: i for i, w in enumerate(words)}
    counts = np.vstack([counts, np.zeros((len(extra), UND))])
    rate = (counts + 0.02) / (sizes + 4.0)
    for k, t in enumerate(LANGUAGES):
        for w in FUNCTION_WORDS[t].split():
            rate[index[w], k] += 0.15
    weight = counts.sum(axis=1) + 9.0 * np.array([any(w in FUNCTION_WORDS[t].split() for t in LANGUAGES) for w in index])
    share = rate / rate.sum(axis=1, keepdims=True)
    share = (share * weight[:, None] + 4.0 / UND) / (weight[:, None] + 4.0)
    best = share.max(axis=1)
    log = np.maximum(np.log(share) - np.log(best)[:, None], -6.0)
    return {w: tuple(np.round(log[i], 3)) for w, i in index.items() if best[i] >= 0.5 or weight[i] >= 20 and best[i] >= 0.4}


class Labeller:
    """Viterbi over the telling words of many documents at once."""

    def __init__(self, model: dict[str, tuple], switch: float = 5.0):
        self.switch = switch
        self.rows = {w: i + 1 for i, w in enumerate(model)}
        table = np.zeros((len(model) + 1 + len(LETTER_HINTS), UND), dtype=np.float32)
        for w, i in self.rows.items():
            table[i] = model[w]
        self.hints = []
        for j, (letter, tags) in enumerate(LETTER_HINTS.items()):
            table[len(model) + 1 + j] = [0.0 if t in tags.split() else -2.0 for t in LANGUAGES]
            self.hints.append((letter, len(model) + 1 + j))
        self.table = table
        self.odd = re.compile("|".join(x for x, _ in self.hints))
        self.hint_of = dict(self.hints)
        self.known: dict[str, int] = {}

    def row(self, word: str) -> int:
        """The score row of a word: 0 if it has no say; words in other scripts have no candidates."""
        found = self.rows.get(word)
        if found is None:
            if len(word) > 2 and (m := self.odd.search(word)) and not FOREIGN.search(word):
                found = self.hint_of[m[0]]
            else:
                found = 0
        return found

    def label(self, texts: list[str]) -> list[tuple[list[int], list[int], list[float]]]:
        """For each text the language number of each non-blank line, its letters and its certainty; -1: a line of
        code or without a telling word; UND: five words or more, hardly any code among them, of which less than a fifth tell a language."""
        known = self.known
        if len(known) > 500_000:
            known.clear()
        ids: list[int] = []
        lines_no: list[int] = []
        doc_ends, line_letters, line_counts, line_words, natural, coded = [], [], [], [], [], []
        line = 0
        for text in texts:
            lines = lines_of(text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text))
            for content in lines:
                content = content.lower()
                kept = size = 1
                if CODE_SIGN.search(content):
                    marks = content.split()
                    plain = [x for x in marks if not CODE.search(x)]
                    kept, size = sum(map(len, plain)), sum(map(len, marks))
                    content = " ".join(plain)
                words = WORD.findall(content)
                line_letters.append(sum(map(len, words)))
                line_words.append(len(words))
                natural.append(kept > 0.9 * size)
                coded.append(kept < 0.7 * size)
                for w in words:
                    r = known.get(w)
                    if r is None:
                        r = known[w] = self.row(w)
                    if r:
                        ids.append(r)
                        lines_no.append(line)
                line += 1
            line_counts.append(len(lines))
            doc_ends.append(len(ids))
        ids_a, lines_a = np.array(ids, dtype=np.int64), np.array(lines_no, dtype=np.int64)
        ends = np.array(doc_ends, dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        states = self.viterbi(ids_a, starts, ends - starts)
        votes = np.zeros((max(line, 1), UND), dtype=np.float64)
        if len(ids_a):
            np.add.at(votes, (lines_a, states), 1.0)
            support = np.zeros(max(line, 1))
            np.add.at(support, lines_a, self.table[ids_a, states] - np.partition(self.table[ids_a], -2, axis=1)[:, -2])
        else:
            support = np.zeros(max(line, 1))
        size, telling = np.array(line_words or [0]), votes.sum(axis=1)
        best = np.where(telling > 0, votes.argmax(axis=1), -1)
        best[(telling < 0.2 * size) | np.array(coded or [False])] = -1
        best[(telling < 0.2 * size) & (size >= 5) & np.array(natural or [False])] = UND
        sure = np.where((best >= 0) & (best < UND), 1.0 / (1.0 + np.exp(-np.clip(support, -30, 30))), 0.0)
        out, at = [], 0
        for n in line_counts:
            out.append((best[at : at + n].tolist(), line_letters[at : at + n], sure[at : at + n].tolist()))
            at += n
        return out

    def viterbi(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best state of each word; documents of like length go step by step together."""
        states = np.zeros(len(ids), dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        at = 0
        while at < len(order):
            longest = int(lengths[order[at]])
            width = max(1, min(len(order) - at, 400_000 // longest))
            width = min(width, int(np.searchsorted(-lengths[order[at:]], -(longest // 2), side="right")))
            docs = order[at : at + max(width, 1)]
            self.step_through(ids, states, starts[docs], lengths[docs], longest)
            at += len(docs)
        return states

    def step_through(self, ids, states, starts, lengths, longest) -> None:
        n = len(starts)
        live = np.array([np.searchsorted(-lengths, -t, side="left") for t in range(longest)]) if n > 1 else np.ones(longest, dtype=int)
        value = np.zeros((n, UND), dtype=np.float32)
        came = np.zeros((longest, n), dtype=np.int8)
        jumped = np.zeros((longest, n), dtype=np.uint8)
        bits = (1 << np.arange(UND)).astype(np.uint8)
        for t in range(longest):
            k = int(live[t])
            now = value[:k]
            top = now.argmax(axis=1)
            limit = now[np.arange(k), top] - self.switch
            jump = now < limit[:, None]
            came[t, :k] = top
            jumped[t, :k] = jump @ bits
            np.maximum(now, limit[:, None], out=now)
            now += self.table[ids[starts[:k] + t]]
        state = value.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            k = int(live[t])
            states[starts[:k] + t] = state[:k]
            jump = (jumped[t, :k] >> state[:k].astype(np.uint8)) & 1
            state[:k] = np.where(jump == 1, came[t, :k], state[:k])


def segments(labels: list[int], letters: list[int], sure: list[float]) -> tuple[int, float, list[tuple[int, int, int, float]]]:
    """(main language or UND, certainty, [(language, first line, last line, certainty)]) of one document.

    Lines without a language neither end a stretch nor count for any language; if words that tell no language make up
    most letters, the main language is UND.
    """
    total = [0] * (UND + 1)
    runs: list[list] = []
    for i, (k, n, p) in enumerate(zip(labels, letters, sure)):
        if k < 0:
            continue
        total[k] += n
        if k == UND:
            continue
        if runs and runs[-1][0] == k:
            runs[-1][2] = i
            runs[-1][3].append((n, p))
        else:
            runs.append([k, i, i, [(n, p)]])
    if not runs:
        return UND, 1.0, []
    main = max(range(UND + 1), key=lambda k: (total[k], -k))
    mean = lambda pairs: sum(n * p for n, p in pairs) / max(1, sum(n for n, _ in pairs))
    stretches = [(k, a, b, mean(pairs)) for k, a, b, pairs in runs]
    certainty = total[main] / max(1, sum(total)) * (1.0 if main == UND else mean([x for r in runs if r[0] == main for x in r[3]]))
    return main, certainty, stretches


def label_documents(rows: DataFrame, model: dict[str, tuple], key: str = "extract_id", text: str = "normalized_content", locale: str = "locale", switch: float = 5.0) -> DataFrame:
    """(key, segment_no, lang, confidence, first_line, last_line, given, mixed): segment 0 is the whole document with its
    main language; mixed documents also have a row for each stretch of lines in one language, from 1.

    Null and blank texts give no row, exact copies of a row the same rows again (the caller takes distinct ones);
    given is the first subtag of the locale in lower case, null where it is missing. Extra columns are ignored.
    """
    given = F.lower(F.regexp_extract(F.trim(locale), r"^([^-_]*)", 1))
    chosen = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), given.alias("given")).filter(F.col("text").isNotNull())
    holder: dict[str, Labeller] = {}
    names = (*LANGUAGES, "und")

    def run(batch: pa.RecordBatch) -> dict:
        if "it" not in holder:
            holder["it"] = Labeller(model, switch)
        keys, texts, tags = (batch.column(i).to_pylist() for i in range(3))
        out: dict[str, list] = {c: [] for c in ("key", "segment_no", "lang", "confidence", "first_line", "last_line", "given", "mixed")}
        for k, tag, (labels, letters, sure) in zip(keys, tags, holder["it"].label(texts)):
            if not labels:
                continue
            main, certainty, runs = segments(labels, letters, sure)
            found = [(main, 0, len(labels) - 1, certainty)]
            mixed = len({r[0] for r in runs}) > 1
            if mixed:
                found += runs
            for no, (lang, a, b, p) in enumerate(found):
                for c, v in zip(out, (k, no, names[lang], float(p), a, b, tag, mixed)):
                    out[c].append(v)
        return out

    fields = pa.schema([("key", pa.int64()), ("segment_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32()), ("given", pa.string()), ("mixed", pa.bool_())])
    found = map_arrow(spread(chosen), "key long, segment_no int, lang string, confidence double, first_line int, last_line int, given string, mixed boolean", run, fields)
    return found.withColumnRenamed("key", key)


def wrong_or_mixed(labelled: DataFrame, key: str = "extract_id") -> DataFrame:
    """Distinct rows of label_documents() of the documents whose label is missing or wrong, or that are mixed."""
    right = F.when(F.col("lang") == "und", F.coalesce(F.col("given"), F.lit("")).isin("", "und")).otherwise(F.coalesce(F.col("given") == F.col("lang"), F.lit(False)))
    whole = (F.col("segment_no") > 0) | ~right | F.col("mixed")
    return labelled.filter(whole).select(key, "segment_no", "lang", "confidence").dropDuplicates([key, "segment_no", "lang"])
