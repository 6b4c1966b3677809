"""Records that hold template residue, filler, error pages or notices that scripts are needed, in place of real text.

Records of one template are aligned by what they share. Placeholders found by their syntax give, where they are used and
not talked about, the frames of their slots (the words around them, names masked) and the names of the variables; lines
with the same frame are aligned with them, and a slot that still holds a variable's name, a default, blanks or any word
in signs is flagged as well. Error templates are whole pages: a line, with names and numbers masked, that stands alone as
the page of several records under unlike titles, and otherwise only on pages made of such lines, is one, and so are whole
pages that come back under unlike titles. Phrases of errors, notices and filler are only a prior, for templates that
are too rare to come back.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_arrow
from siltstone.llm.language import FUNCTION_WORDS, lines_of
from siltstone.session import spread, stored

STOP_WORDS = frozenset(w for line in FUNCTION_WORDS.values() for w in line.split())

#: The common forms of placeholders; the first group that matched holds the variable's name.
PLACEHOLDER = re.compile(
    r"\{\{ {0,3}([\w. ]{1,60}?) {0,3}\}\}|\{%-? {0,3}(?:\w+\s+)?([\w. ]{1,60}?) {0,3}-?%\}|[$#@]\{ {0,3}([\w.]{1,60}) {0,3}\}|<%[=-]? {0,3}([\w. ]{1,60}?) {0,3}-?%>|%%(\w{1,60})%%"
    r"|\[\[ {0,3}([\w ]{1,60}?) {0,3}\]\]|@@(\w{1,60})@@|(?<!\w)__([A-Z][A-Z_]{0,60})__(?!\w)|<(?:your|ihr|ihre|votre|su|uw|il vostro|o seu) ([\w ]{1,60})>"
    r"|\[(?:insert|add|enter|inserire|inserisci|insérer|inserir|insertar|inserte|introducir) ([\w ]{1,60})\]|\[([\w ]{1,60}?) (?:hier|here) (?:invullen|einfügen|eintragen)\]|\[([\w ]{1,60}?) hier\]"
    r"|\bX{3,} (\w{1,40}) X{3,}\b|\[(?:TBD|TBC|TODO|FIXME):? ([\w ]{1,60})\]",
    re.I,
)
NUMBERED = re.compile(r"\{\d{1,2}\}|%\d\$?s")
#: A count in a pattern such as \d{2} or [a-z]{2}, which ends before the brace.
COUNTED = re.compile(r"(?:\\[a-zA-Z]|[\])])$")
#: Words between signs of any kind, which only tell in a slot of a known frame, or in a title if they name a variable.
OPEN = re.compile(r"(?<![^\s.,;:!?'\"’”“„»«()…–—-])[^\w\s.,;:!?'\"’”“„»«()…–—-]{1,4} ?([^\W\d][\w .:-]{0,60}?) ?[^\w\s.,;:!?'\"’”“„»«()…–—-]{1,4}(?!\w)")
OPENS = re.compile(r"[\[\]{}<>%$#@_|~^*=§/\\+&]")
#: Words that tell that a placeholder is talked about, before and after it.
TALKS_BEFORE = frozenset("template templates vorlage vorlagen modèle gabarit plantilla modello modelo sjabloon variable variables placeholder placeholders platzhalter marcador segnaposto type types typing enter syntax notation tippen tapez escriben digitano typen".split())
TALKS_AFTER = re.compile(r"^[\"'”»`)\s]*(?:stands for|represents|is replaced|is filled|représente|est remplacé|representa|se sustituye|rappresenta|viene sostituit|staat voor|wordt vervangen|steht für|für den|wird ersetzt|é substituíd|where the value)", re.I)
QUOTES = {'"': '"', "'": "'", "`": "`", "“": "”", "„": "“", "«": "»", "‘": "’"}
SIGNS = re.compile(r"\{\{|\{%|\{\d|%\d|[$#@]\{|<%|%%|\[\[|@@|__|X{3}|<\w|\[\w|TODO:")
#: Blanks and defaults; a name only tells if it is a variable's.
DEFAULT = re.compile(r"\bX{3,}\b|\bundefined\b|\bNaN\b|\bnull\b|\bTBD\b|\?{3,}|_{3,}|\byour [a-z_]+\b|(?P<name>\b[a-z]+_[a-z]+\b|\b(?-i:[A-Z]{3,})\b)", re.I)
WORD = re.compile(r"[^\W\d]+")
#: Characters before and after a slot that tell how it is used.
NEAR = 300
SENTENCE = re.compile(r"[.!?…]\s")
DIGITS = re.compile(r"\d+")
#: Words from their first capital on.
NAME = re.compile(r"[A-ZÀ-Þ]\w*")
THREE_WORDS, FIVE_WORDS = (re.compile(r"(?:[^\W\d]+[\W\d]+){%d}[^\W\d]" % n) for n in (2, 4))
CAPITALS = re.compile(r"[A-Z]{3}")

#: Error, access and script notices in the seven languages, in lower case.
ERRORS = re.compile(
    "too many requests|internal server error|bad gateway|gateway timeout|service unavailable|page you (?:asked|are looking) for|article you are looking for|page not found|is no longer here|do(?:es)? not have permission to|don't have permission to|access denied|403 forbidden|session has (?:ended|expired)|could not load this content|something went wrong|is down for maintenance|enable javascript|needs scripts to run|allow scripts to|blocking javascript|javascript is (?:required|disabled)"
    "|seite wurde nicht gefunden|seite nicht gefunden|keine berechtigung|sitzung ist abgelaufen|ist ein fehler aufgetreten|aktivieren sie javascript|skripte im browser erlaubt|zugriff verweigert|wartungsarbeiten"
    "|pagina niet gevonden|sessie is verlopen|er ging iets mis|schakel javascript in|geen toestemming om|toegang geweigerd|onderhoud en is zo terug"
    "|page introuvable|session a expiré|une erreur est survenue|activer javascript|pas l'autorisation|accès refusé|en maintenance et sera"
    "|página no encontrada|sesión ha caducado|se ha producido un error|active javascript|no tiene permiso|acceso denegado"
    "|pagina non trovata|sessione è scaduta|si è verificato un errore|attivate javascript|attiva javascript|non (?:avete|hai) il permesso|accesso negato"
    "|página não encontrada|sessão (?:expirou|terminou)|a sua sessão|ocorreu um erro|ative o javascript|não tem permissão|acesso negado"
)
#: Stand-in texts, in lower case.
FILLER = re.compile(
    "lorem ipsum|dummy (?:content|text)|sample text|replace this (?:paragraph|text)|placeholder (?:article|text)|real text will follow|your (?:heading|text) here|click here to edit|todo: |text goes here|coming soon|under construction"
    "|beispieltext|blindtext|mustertext|platzhaltertext|ihr text hier|texte d'exemple|faux texte|votre texte ici|texto de ejemplo|su texto aquí|texto de relleno|testo di esempio|testo segnaposto|voorbeeldtekst|uw tekst hier|texto de exemplo|o seu texto aqui"
)
BARE_HEAD = re.compile(r"^(?:error|oops|fehler|erreur|errore|erro|fout|ups|\d{3})[\s\W\d]*$")
CODE_SIGN = re.compile(r"[{}<>=\\|~^@#$%&*_+/\d\[\]]")


def is_talked_about(line: str, start: int, end: int, title: bool = False) -> bool:
    """Whether a placeholder at start..end of a line is quoted or explained instead of used; in titles the words before
    it are part of the subject and don't tell."""
    before, after = line[max(0, start - NEAR) : start].rstrip(), line[end : end + NEAR]
    if before and before[-1] in QUOTES and after.lstrip()[:1] == QUOTES[before[-1]]:
        return True
    if TALKS_AFTER.match(after):
        return True
    sentence = SENTENCE.split(before)[-1]
    return not title and any(w in TALKS_BEFORE for w in WORD.findall(sentence.lower())[-4:])


def used_placeholders(line: str, title: bool = False) -> list[tuple[int, int, str]]:
    """(start, end, variable) of the placeholders of a line that are used, not talked about; numbered ones have the empty
    variable."""
    if not ("{" in line or "<" in line or "[" in line or "%" in line or "@@" in line or "__" in line or "XXX" in line):
        return []
    found = [(m.start(), m.end(), next((g for g in m.groups() if g), "").lower()) for m in PLACEHOLDER.finditer(line)]
    found += [(m.start(), m.end(), "") for m in NUMBERED.finditer(line) if not COUNTED.search(line, max(0, m.start() - 2), m.start())]
    return [x for x in found if not is_talked_about(line, x[0], x[1], title)]


def frame_words(text: str, head: bool) -> list[str]:
    """The words of a stretch of a line in lower case, those with capitals as n, but for the first of the line (head)."""
    text = NUMBERED.sub(" ", PLACEHOLDER.sub(" ", text)) if SIGNS.search(text) else text
    words = WORD.findall(text)
    return [w if w.islower() else w.lower() if head and i == 0 else "n" for i, w in enumerate(words)]


def frame_of(line: str, start: int, end: int) -> tuple[str, str] | None:
    """Two words before and after a slot; ^ and $ stand for the ends of the line. None if fewer than two of them are
    plain words."""
    begin = max(0, start - NEAR)
    before = frame_words(line[begin:start], begin == 0)[-2:] or ["^"]
    after = frame_words(line[end : end + NEAR], False)[:2] or ["$"]
    plain = sum(w not in ("n", "^", "$") for w in (*before, *after))
    return (" ".join(before), " ".join(after)) if plain >= 2 else None


def has_default(line: str, frames: frozenset[tuple[str, str]], variables: frozenset[str]) -> bool:
    """Whether a slot of a known frame in this line holds a variable's name, a default, blanks or words in signs."""
    return any((name is None or name in variables) and frame in frames for frame, name in default_slots(line))


def variable_of(words: str) -> str:
    """The name of a variable as it is compared: without what leads to it, spaces as underscores."""
    return re.split(r"[.:]", words)[-1].strip().lower().replace(" ", "_")


def may_hold_default(line: str) -> bool:
    """Whether DEFAULT can match, by what each of its alternatives holds."""
    if "_" in line or "???" in line or CAPITALS.search(line):
        return True
    low = line.lower()
    return "xxx" in low or "your " in low or "undefined" in low or "null" in low or "nan" in low or "tbd" in low


def default_slots(line: str) -> list[tuple[tuple[str, str], str | None]]:
    """(frame, name) of the places of a line that count if their frame is a template's, where they have a name only if
    it is a variable's too. Places that are talked about are left out."""
    out = []
    for m in DEFAULT.finditer(line) if may_hold_default(line) else ():
        frame = frame_of(line, m.start(), m.end())
        if frame and not is_talked_about(line, m.start(), m.end()):
            out.append((frame, m["name"].lower() if m["name"] else None))
    for m in OPEN.finditer(line) if OPENS.search(line) else ():
        frame = frame_of(line, m.start(), m.end())
        if frame and not is_talked_about(line, m.start(), m.end()):
            out.append((frame, None))
    return out


def title_slots(title: str | None) -> list[str]:
    """The words in signs of a title, which count if they name a variable."""
    if not title or not OPENS.search(title):
        return []
    return [variable_of(m[1]) for m in OPEN.finditer(title) if not is_talked_about(title, m.start(), m.end(), True)]


@lru_cache(maxsize=1)
def phrases() -> ahocorasick.Automaton:
    """The plain pieces of the fixed phrases, each long enough to be rare, as one automaton."""
    tree = ahocorasick.Automaton()
    for pattern in (ERRORS.pattern, FILLER.pattern):
        for phrase in re.split(r"\|(?![^(]*\))", pattern):
            pieces = re.split(r"\(\?:[^)]*\)\??|.\?", phrase)
            tree.add_word(max(pieces, key=len), 1)
    tree.make_automaton()
    return tree


def tells(low: str) -> bool:
    """Whether a line in lower case holds an error, notice or filler phrase."""
    return next(phrases().iter(low), None) is not None and (ERRORS.search(low) or FILLER.search(low)) is not None


def is_stand_in(line: str) -> bool:
    """Whether a long line of plain words holds next to none of the words any of the languages can't do without."""
    words = line.lower().split()
    if len(words) < 10 or sum(w in STOP_WORDS for w in words) * 20 >= len(words):
        return False
    words = WORD.findall(line.lower())
    if len(words) < 10 or len(CODE_SIGN.findall(line)) * 20 > len(line) or line.count(",") * 4 > len(words):
        return False
    return sum(w in STOP_WORDS for w in words) * 20 < len(words) and sum(map(len, words)) / len(words) < 12


def is_residue(title: str | None, text: str, frames: frozenset[tuple[str, str]] = frozenset(), variables: frozenset[str] = frozenset(), prior: bool = True) -> bool:
    """Whether a record with text is one of the cases; without the prior no phrases are asked."""
    lines = lines_of(text)
    if not lines:
        return False
    if title and used_placeholders(title, True):
        return True
    marked = SIGNS.search(text) is not None
    if marked and any("TODO:" in line or used_placeholders(line) for line in lines):
        return True
    if frames and any(has_default(line, frames, variables) for line in lines):
        return True
    own = " ".join(title.lower().split()) if title else None
    told = other = 0
    whole = len(text)
    for line in lines:
        low = " ".join(line.lower().split())
        bare = NUMBERED.sub("", PLACEHOLDER.sub("", line)) if marked else line
        size = len(bare)
        if low == own or BARE_HEAD.match(low) or low.count(" ") < 2 or marked and not any(map(str.isalpha, bare)):
            told += 1 if marked and NUMBERED.search(line) and not any(map(str.isalpha, bare)) else 0
        elif prior and tells(low) or is_stand_in(line):
            told += size
        else:
            other += size
            if other * 10 > whole * 4:
                return False
    return told > 0 and other * 6 <= told * 4


def masked_line(line: str) -> str:
    """A line with digits and names (words with capitals) as signs."""
    return NAME.sub("N", DIGITS.sub("0", line)).lower()


def page_lines(title: str | None, lines: list[str], marked: bool = True) -> list[str]:
    """The masked lines of three words or more that make up a page, without its title and lines of placeholders, which
    only marked pages have."""
    own = " ".join(title.lower().split()) if title else None
    out = []
    for line in lines:
        if own and " ".join(line.lower().split()) == own:
            continue
        if marked and SIGNS.search(line) and ("TODO:" in line or used_placeholders(line)):
            continue
        masked = masked_line(line)
        if THREE_WORDS.search(masked):
            out.append(masked)
    return out


def masked_title(title: str | None) -> str:
    """A title with digits and names as signs."""
    return masked_line(title or "")


def record_slots(lines: list[str]) -> list[tuple[str, str, str]]:
    """(kind, before, after) of the frames and variables of the used placeholders of lines."""
    out = []
    for line in lines:
        for start, end, name in used_placeholders(line):
            frame = frame_of(line, start, end)
            out += ([("frame", *frame)] if frame else []) + ([("variable", variable_of(name), "")] if name else [])
    return out


def slots(rows: DataFrame, text: str = "normalized_content") -> DataFrame:
    """(kind, before, after, n): frames (kind `frame`) and variables (kind `variable`, its name in before) of the used
    placeholders, with their number of occurrences."""
    chosen = rows.select(F.col(text).alias("text")).filter("text is not null").filter(F.col("text").rlike(SIGNS.pattern))

    def run(batch: pa.RecordBatch) -> dict:
        found = [row for content in batch.column(0).to_pylist() for row in record_slots(lines_of(content))]
        return {name: [row[i] for row in found] for i, name in enumerate(("kind", "before", "after"))}

    fields = pa.schema([("kind", pa.string()), ("before", pa.string()), ("after", pa.string())])
    return map_arrow(spread(chosen), "kind string, before string, after string", run, fields).groupBy("kind", "before", "after").agg(F.count(F.lit(1)).alias("n"))


def number_of(*words: str) -> int:
    """A 64-bit hash of a frame or a variable."""
    return xxhash.xxh3_64_intdigest("\n".join(words).encode()) - (1 << 63)


def error_lines(pages: DataFrame, repeats: int, alone: float = 0.05, pure: float = 0.8) -> DataFrame:
    """(line): the lines of whole-page templates, of (key, site, head, plain, lines). Such a line is alone on the pages of
    at least `repeats` records, a share `alone` of all records that have it, under titles that differ in more than names
    and numbers, or under different titles in different sources; and at least a share `pure` of its records consist of
    such lines only. Lines of articles fail that, as they stand among lines of their own."""
    each = stored(pages.filter(F.size("lines") > 0).select("key", F.size("lines").alias("size"), "head", "plain", "site", F.explode("lines").alias("line")))
    ends = [f(c).alias(f"{n}_{c}") for c in ("head", "plain", "site") for n, f in (("a", F.min), ("z", F.max))]
    single = each.filter("size = 1").groupBy("line").agg(F.count(F.lit(1)).alias("times"), *ends)
    unlike = "a_plain <> z_plain or a_head <> z_head and a_site <> z_site"
    n = each.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    found = stored(single.filter((F.col("times") >= repeats) & F.expr(unlike)).join(n, "line").filter(F.col("times") >= alone * F.col("n")).select("line", "n"))
    near = stored(each.join(found.select("line"), "line").select("key", "size", "line"))
    while True:
        kept = near.join(found.select("line"), "line")
        whole = kept.groupBy("key", "size").agg(F.count(F.lit(1)).alias("kept")).filter("kept = size").select("key")
        counted = kept.join(whole, "key").groupBy("line").agg(F.count(F.lit(1)).alias("times"))
        after = stored(found.join(counted, "line").filter(F.col("times") >= pure * F.col("n")).select("line", "n"))
        if after.count() == found.count():
            return after.select("line")
        found = after


def residue(rows: DataFrame, key: str = "extract_id", title: str = "title", text: str = "normalized_content", repeats: int = 3, source: str = "source_id", prior: bool = True) -> DataFrame:
    """Distinct keys of the records that hold residue; `prior` tells whether the phrases of errors and filler are asked.

    The model is the frames and variables of the used placeholders, all of them, as a table of hashes that the places
    which may hold defaults are joined to, and the lines of error templates; nothing of it comes to the driver. A record
    is a case if all lines of its page are lines of error templates. Whole pages that come back at least `repeats` times
    under different titles, whatever their length, are found by one shuffle of a hash for each
    page. Within one source as many titles must differ in more than names and digits, of records that aren't cases by
    themselves, as articles about several products may be worded alike. Null and blank texts are no cases, whatever their title; exact copies of a row count once; extra columns are ignored.
    """
    chosen = rows.select(F.col(key).alias("key"), F.col(title).alias("title"), F.col(text).alias("text"), F.xxhash64(source).alias("site")).filter("text is not null")

    def hashed(value: str) -> int:
        return xxhash.xxh3_64_intdigest(value.encode()) - (1 << 63)

    def run(batch: pa.RecordBatch) -> dict:
        keys, flags, pages, heads, plains, sites, line_lists, slot_lists, frame_lists, name_lists = ([] for _ in range(10))
        for k, head, content, site in zip(*(batch.column(i).to_pylist() for i in range(4))):
            lines = lines_of(content)
            if not lines:
                continue
            found = is_residue(head, content, prior=prior)
            marked = SIGNS.search(content) is not None
            page = page_lines(head, lines, marked)
            model = set(record_slots(lines)) if marked else set()
            places = set() if found else {(number_of(*frame), number_of(name) if name else None) for line in lines for frame, name in default_slots(line)} | {(None, number_of(name)) for name in title_slots(head)}
            keys.append(k)
            flags.append(found)
            whole_page = "\n".join(page)
            pages.append(hashed(whole_page) if FIVE_WORDS.search(whole_page) else None)
            heads.append(hashed(head or ""))
            plains.append(hashed(masked_title(head)))
            sites.append(site)
            line_lists.append(sorted({hashed(line) for line in page}))
            slot_lists.append([{"frame": f, "name": v} for f, v in places])
            frame_lists.append([number_of(before, after) for kind, before, after in model if kind == "frame"])
            name_lists.append([number_of(name) for kind, name, _ in model if kind == "variable"])
        return {"key": keys, "found": flags, "page": pages, "head": heads, "plain": plains, "site": sites, "lines": line_lists, "slots": slot_lists, "frames": frame_lists, "names": name_lists}

    fields = pa.schema([("key", pa.int64()), ("found", pa.bool_()), ("page", pa.int64()), ("head", pa.int64()), ("plain", pa.int64()), ("site", pa.int64()), ("lines", pa.list_(pa.int64())), ("slots", pa.list_(pa.struct([("frame", pa.int64()), ("name", pa.int64())]))), ("frames", pa.list_(pa.int64())), ("names", pa.list_(pa.int64()))])
    seen = stored(map_arrow(spread(chosen), "key long, found boolean, page long, head long, plain long, site long, lines array<long>, slots array<struct<frame:long,name:long>>, frames array<long>, names array<long>", run, fields))
    whole = seen.filter("page is not null").select("key", "page", "head", "plain", "site", "found").distinct()
    ends = [(f, f"{n}_{c}", c) for c in ("head", "site") for n, f in (("a", F.min), ("z", F.max))]
    titles = whole.groupBy("page", "plain").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(~F.col("found"), 1).otherwise(0)).alias("own"), *[f(c).alias(name) for f, name, c in ends])
    pages = titles.groupBy("page").agg(F.sum("n").alias("n"), F.sum("own").alias("titles"), *[f(name).alias(name) for f, name, _ in ends])
    across = (F.col("n") >= repeats) & (F.col("a_head") != F.col("z_head")) & (F.col("a_site") != F.col("z_site"))
    again = pages.filter(across | (F.col("titles") >= repeats)).select("page")
    repeated = whole.join(again, "page").select("key")
    templates = error_lines(seen.select("key", "head", "plain", "site", "lines").distinct(), repeats)
    lines = seen.select("key", F.size("lines").alias("size"), F.explode("lines").alias("line")).distinct().join(templates, "line")
    errors = lines.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")).filter("n = size").select("key")
    frames, variables = (seen.select(F.explode(column).alias(name)).distinct() for column, name in (("frames", "frame"), ("names", "name")))
    open_slots = seen.filter(F.size("slots") > 0).select("key", F.explode("slots").alias("slot")).select("key", "slot.frame", "slot.name").distinct()
    framed = open_slots.filter("frame is not null").join(frames, "frame")
    named = framed.filter("name is not null").select("key", "name").unionByName(open_slots.filter("frame is null").select("key", "name")).join(variables, "name")
    defaults = framed.filter("name is null").select("key").unionByName(named.select("key"))
    return seen.filter("found").select("key").unionByName(repeated).unionByName(errors).unionByName(defaults).distinct().withColumnRenamed("key", key)
