"""The blocks of a page that aren't its own article, by two passes of block rules.

The first pass decides blocks by themselves: by length, density of stop words and density of links, by how many pages
of the same site carry the block, and by the shapes of page furniture (bread crumbs, language lists, prompts, notices,
contents). The second pass gives each short block left over the label of its nearest decided neighbours: headings look
forward, other blocks back.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_arrow
from siltstone.llm.language import FUNCTION_WORDS
from siltstone.session import spread

STOP_WORDS = frozenset(w for line in FUNCTION_WORDS.values() for w in line.split())
WORD = re.compile(r"[^\W\d_]+")
ANCHOR = re.compile(r"<(/?)a(?=[\s>])", re.I)
#: Signs between the entries of a line of links.
BETWEEN = re.compile(r"[|·•>›»/→,;]| [-–—] ")
#: Characters of an entry of a list of related links that reads as a sentence; longer ones are the article's.
RELATED_ENTRY = 120
#: Share of the letters of a block from which on it counts as links.
DENSE_LINKS = 0.6
MARKDOWN_LINK = re.compile(r"\[([^\]\n]+)\]\([^)\s]+\)")
TAG = re.compile(r"<[^>]+>")
BULLET = re.compile(r"^(?:[-*•+]|\d+[.)])\s+")

#: How page furniture begins in the seven languages. Matched in lower case at the start of a block.
SKIP = "skip to|jump to content|jump to main|zum hauptinhalt|zum inhalt|aller au contenu|naar de hoofdinhoud|naar de inhoud|ir al contenido|vai al contenuto|saltar para o conteúdo|ir para o conteúdo"
RELATED = "related articles|related links|related topics|people also read|more from|see also|you may also|ähnliche beiträge|ähnliche artikel|mehr aus|auch interessant|articles liés|articles similaires|à lire aussi|plus sur|verwante artikelen|meer over|lees ook|artículos relacionados|más sobre|lea también|articoli collegati|articoli correlati|altro su|leggi anche|artigos relacionados|mais sobre|leia também"
CONTENTS = "contents|table of contents|on this page|in this article|inhalt|inhaltsverzeichnis|auf dieser seite|sommaire|table des matières|sur cette page|inhoud|inhoudsopgave|op deze pagina|contenido|en esta página|sommario|contenuti|indice|in questa pagina|conteúdo|nesta página|índice|sumário"
PROMPT = "share this page|share this article|tell a colleague about|rate this|was this page|was this article|seite teilen|beitrag teilen|war diese seite|diese seite bewerten|partager la page|partager cette page|cette page vous a|deel deze pagina|was deze pagina|compartir la página|compartir esta página|le ha servido esta|condividi la pagina|condividi questa|la pagina è stata|partilhar a página|esta página foi|subscribe to|sign up for the|melden sie sich zum rundbrief|melden sie sich zum newsletter|abonnez-vous|inscrivez-vous à la lettre|schrijf u in voor|suscríbase al|suscríbete|iscriviti al|subscreva|assine"
NOTICE = "we use cookies|this site uses cookies|this site stores|your privacy matters|wir verwenden cookies|diese seite speichert|verwalten sie hier ihre|nous utilisons des cookies|ce site utilise|gérez ici votre|wij gebruiken cookies|deze site gebruikt|beheer hier uw|usamos cookies|este sitio usa|gestione aquí su|usiamo i cookie|questo sito usa|gestisci qui|gestisca qui|este site usa|este site guarda|gira aqui|faça aqui a gestão"
LEGAL = "imprint|privacy|press|contact us|contact|careers|status page|terms of use|legal notice|impressum|datenschutz|presse|kontakt|karriere|mentions légales|confidentialité|carrières|colofon|pers|vacatures|aviso legal|privacidad|contacto|empleo|prensa|note legali|contatti|lavora con noi|stampa|privacidade|carreiras|imprensa|contacte-nos|contactos"
LANGUAGE_NAMES = "english|deutsch|nederlands|français|español|italiano|português"
STARTS = re.compile("^(?:¿)?(?:" + "|".join((SKIP, PROMPT, NOTICE)) + ")")
RELATED_START = re.compile("^(?:" + RELATED + r")\b")
CONTENTS_LINE = re.compile("^(?:" + CONTENTS + r"):?$")
EXACT = re.compile("^(?:" + LEGAL + "|" + LANGUAGE_NAMES + ")$")
COPYRIGHT = re.compile(r"^(?:©|\(c\)|copyright)\s*\d{4}\b|.{2,60} [–—-] all prices exclude tax")
CRUMBS = re.compile(r"^[^.!?]{1,80}?(?:\s+[>›»/→]\s+[^.!?>]{1,80}){1,6}$")

ENDED = re.compile(r"[.!?…][\s\"')»”]*$")

GOOD, BAD, SHORT, ASIDE = "good", "bad", "short", "aside"


def plain(text: str) -> str:
    """A block's text in NFKC and lower case, white space as single spaces, without a list sign at its start."""
    return BULLET.sub("", " ".join(unicodedata.normalize("NFKC", text).lower().split()))


def site_key(text: str) -> int:
    """Number of a block's text with digit runs as one sign, as the count of a site's pages knows it."""
    return xxhash.xxh3_64_intdigest(re.sub(r"\d+", "0", plain(text)).encode()) - (1 << 63)


def anchors(body: str) -> list[str]:
    """What stands between the tags of each anchor of a body, whatever its length; one without an end ends at the next."""
    out, begin = [], -1
    for m in ANCHOR.finditer(body):
        if begin >= 0:
            out.append(body[begin : m.start()])
        opened = -1 if m[1] else body.find(">", m.end())
        begin = opened + 1 if opened >= 0 else -1
    return out


def links_of(body: str | None, content_type: str | None) -> frozenset[str]:
    """The texts of all links of a page, as plain() has them."""
    if not body:
        return frozenset()
    if "html" in (content_type or "") or "<a " in body:
        return frozenset(plain(html.unescape(TAG.sub("", m))) for m in anchors(body))
    return frozenset(plain(m) for m in MARKDOWN_LINK.findall(body))


def link_density(text: str, links: frozenset[str]) -> float:
    """Share of the letters and digits of a block, as plain() has it, that stand in links: the whole block or entries
    between signs."""
    if not text or not links:
        return 0.0
    if text in links:
        return 1.0
    parts = [p.strip() for p in BETWEEN.split(text)]
    size = lambda p: sum(map(str.isalnum, p))
    return sum(size(p) for p in parts if p in links) / max(1, size(text)) if len(parts) > 1 else 0.0


def first_pass(types: list[str], texts: list[str], title: str | None, links: frozenset[str], frequent: frozenset[int]) -> tuple[list[str], int]:
    """(label of each block, number of the article's own heading or -1). ASIDE is furniture that also stands between
    the blocks of an article and says nothing of its neighbours."""
    flat = [plain(t) for t in texts]
    wanted = plain(title) if title else ""
    labels = []
    for kind, raw, text in zip(types, texts, flat):
        words = WORD.findall(text)
        stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        linked = kind != "heading" and link_density(text, links) >= DENSE_LINKS
        if STARTS.match(text):
            label = ASIDE
        elif COPYRIGHT.match(text) or CONTENTS_LINE.match(text):
            label = BAD
        elif RELATED_START.match(text) and re.search(r"^.{4,60}?:\s+\S", text):
            label = ASIDE
        elif RELATED_START.match(text) and (kind == "heading" or len(words) <= 6 and not raw.rstrip().endswith(".")):
            label = BAD
        elif EXACT.match(text):
            label = BAD
        elif CRUMBS.match(text) and kind != "code" and ("://" not in text):
            label = BAD
        elif kind == "code":
            label = GOOD
        elif not linked and (len(words) >= 9 and stops >= 0.2 or len(words) >= 12 and stops >= 0.1 and ENDED.search(raw)):
            label = GOOD
        elif site_key(raw) in frequent and sum(map(len, words)) >= 3 and kind != "table-cell":
            label = BAD
        elif linked:
            label = BAD
        elif len(words) >= 6 and stops >= 0.25 and text.endswith((".", "!", "?")):
            label = GOOD
        else:
            label = SHORT
        labels.append(label)
    own = -1
    if wanted:
        same = [i for i, t in enumerate(flat) if t and wanted.startswith(t) and len(t) * 3 >= len(wanted)]
        heads = [i for i in same if types[i] == "heading"]
        own = (heads or same or [-1])[-1 if not heads else 0]
    return labels, own


LISTS = re.compile(r"<(/?(?:ul|ol|dl|table))\b|<(?:p|li|h[1-6]|td|th|pre|blockquote|dd|dt|figcaption)\b", re.I)


def list_numbers(body: str | None, content_type: str | None, size: int) -> list[int]:
    """For each block the number of the list or table it stands in or between, from the tags of an HTML body; zeros
    where tags and blocks don't match or there are no tags."""
    if not body or "html" not in (content_type or ""):
        return [0] * size
    out, number = [], 0
    for m in LISTS.finditer(body):
        if m[1]:
            number += 1
        else:
            out.append(number)
    return out if len(out) == size else [0] * size


def labels_of(types: list[str], texts: list[str], title: str | None, links: frozenset[str], frequent: frozenset[int], lists: list[int] | None = None) -> list[bool]:
    """Whether each block is boilerplate."""
    lists = lists or [0] * len(types)
    labels, own = first_pass(types, texts, title, links, frequent)
    flat = [plain(t) for t in texts]
    n = len(labels)
    later = {}
    for i in range(n - 1, -1, -1):
        later.setdefault(flat[i], i)
    # contents: entries after their title that come again further down
    inside = False
    for i in range(n):
        if CONTENTS_LINE.match(flat[i]):
            inside = True
            continue
        if inside:
            if later[flat[i]] > i and types[i] != "heading" or labels[i] == BAD and flat[i] in links:
                labels[i] = BAD
            else:
                inside = False
    if own < 0 or labels[own] == BAD and CONTENTS_LINE.match(flat[own]):
        own = next((i for i in range(n) if labels[i] == GOOD or labels[i] == SHORT and types[i] == "heading"), n)
        while own > 0 and labels[own - 1] == SHORT and any(w in STOP_WORDS for w in WORD.findall(flat[own - 1])):
            own -= 1
    if own < n:
        # of several blocks with the title's text the last one before the first good block is the heading
        first_good = next((i for i in range(n) if labels[i] == GOOD), n)
        twins = [i for i in range(own, min(first_good, n)) if flat[i] == flat[own]]
        if twins and types[own] != "heading":
            own = twins[-1]
        labels[own] = GOOD
        for i in range(own):
            labels[i] = BAD
        for i in range(own + 1, n):
            if labels[i] == SHORT and types[i] == "table-cell" and flat[i] not in links:
                labels[i] = GOOD
    # related links: entries after their heading up to the next block of another kind
    listing = False
    kind = ""
    for i in range(n):
        if labels[i] == BAD and RELATED_START.match(flat[i]):
            listing, kind = True, ""
            if i > own:
                labels[i] = ASIDE
        elif listing:
            form = (types[i], bool(BULLET.match(texts[i])), lists[i])
            entry = labels[i] in (SHORT, BAD) or labels[i] == GOOD and types[i] in ("list-item", "paragraph") and len(texts[i]) <= RELATED_ENTRY
            if labels[i] == ASIDE and not kind:
                continue
            if i != own and entry and form[0] in ("list-item", "paragraph") and kind in ("", form) and not ENDED.search(texts[i]):
                kind = form
                labels[i] = ASIDE if i > own else BAD
            else:
                listing = False
    # second pass: runs of short blocks between decided ones
    i = 0
    while i < n:
        if labels[i] != SHORT:
            i += 1
            continue
        j = i
        while j < n and labels[j] in (SHORT, ASIDE):
            j += 1
        before = next((labels[k] for k in range(i - 1, -1, -1) if labels[k] in (GOOD, BAD)), BAD)
        after = next((labels[k] for k in range(j, n) if labels[k] in (GOOD, BAD)), BAD)
        for k in range(i, j):
            if labels[k] == SHORT:
                labels[k] = GOOD if before == GOOD else BAD
                if before == BAD and after == GOOD and k > own:
                    # between furniture and the article: from the first heading on, all where there is none
                    headed = any(types[m] == "heading" for m in range(i, k + 1))
                    labels[k] = GOOD if headed or not any(types[m] == "heading" for m in range(k, j)) else BAD
        i = j
    return [x != GOOD for x in labels]


def site_frequency(pages: DataFrame, least: int = 3, share: float = 0.08, key: str = "page_id", source: str = "source_id") -> DataFrame:
    """(source, frequent): for each site the numbers of the block texts that stand on at least `least` of its pages and
    a share `share` of them; at most (blocks of a page / share) numbers. Counts are aggregated before the shuffle."""
    none = F.array().cast("array<string>")
    texts = F.coalesce(F.transform("blocks", lambda b: b["text"]), none)
    chosen = pages.select(F.col(key).alias("key"), F.coalesce(F.col(source), F.lit("")).alias("source"), texts.alias("texts"))

    def run(batch: pa.RecordBatch) -> dict:
        keys, sources, numbers = [], [], []
        for k, s, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = {site_key(t) for t in found if t}
            keys += [k] * len(own)
            sources += [s] * len(own)
            numbers += own
        return {"key": keys, "source": sources, "number": numbers}

    fields = pa.schema([("key", pa.int64()), ("source", pa.string()), ("number", pa.int64())])
    counts = map_arrow(spread(chosen), "key long, source string, number long", run, fields).distinct().groupBy("source", "number").agg(F.count(F.lit(1)).alias("n"))
    total = chosen.select("source", "key").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("pages"))
    often = counts.filter(F.col("n") >= least).join(total, "source").filter(F.col("n") >= share * F.col("pages"))
    return often.groupBy("source").agg(F.collect_list("number").alias("frequent"))


def page_blocks(pages: DataFrame, key: str = "page_id", source: str = "source_id") -> DataFrame:
    """(key, block_no, boilerplate) of every block. Null bodies count as pages without links, null blocks as none, null
    texts of blocks as empty; exact copies of a row give their rows again. Extra columns are ignored."""
    none = F.array().cast("array<string>")
    chosen = pages.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        "title",
        "content_type",
        "body",
        F.coalesce(F.transform("blocks", lambda b: F.coalesce(b["type"], F.lit(""))), none).alias("types"),
        F.coalesce(F.transform("blocks", lambda b: F.coalesce(b["text"], F.lit(""))), none).alias("texts"),
    ).filter(F.size("texts") > 0)
    joined = spread(chosen).join(site_frequency(pages, key=key, source=source), "source", "left").drop("source")

    def run(batch: pa.RecordBatch) -> dict:
        keys, numbers, flags = [], [], []
        for k, title, content_type, body, types, texts, frequent in zip(*(batch.column(i).to_pylist() for i in range(7))):
            found = labels_of(types, texts, title, links_of(body, content_type), frozenset(frequent or ()), list_numbers(body, content_type, len(texts)))
            keys += [k] * len(found)
            numbers += range(len(found))
            flags += found
        return {"key": keys, "block_no": numbers, "boilerplate": flags}

    fields = pa.schema([("key", pa.int64()), ("block_no", pa.int32()), ("boilerplate", pa.bool_())])
    return map_arrow(joined, "key long, block_no int, boilerplate boolean", run, fields).withColumnRenamed("key", key)


def main_text(pages: DataFrame, key: str = "page_id", source: str = "source_id") -> DataFrame:
    """(key, content): the article's own blocks, a line each; pages without any give the empty text."""
    kept = page_blocks(pages, key, source).distinct()
    texts = pages.select(key, F.posexplode("blocks").alias("block_no", "block")).select(key, "block_no", F.col("block.text").alias("text")).distinct()
    lines = F.sort_array(F.collect_list(F.when(~F.col("boilerplate"), F.struct("block_no", "text"))))
    return texts.join(kept, [key, "block_no"]).groupBy(key).agg(F.array_join(F.transform(lines, lambda x: x["text"]), "\n").alias("content"))
