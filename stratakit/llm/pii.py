"""Surrogates for personal data.

Detected entities get keyed replacements of the same type and format: digits
for digits, letters of the same case for letters, valid octets, the same card
brand and check-digit state, names of the same gender and script.  Structured
types go through a keyed permutation of all values of their shape (a Feistel
network with cycle walking), so that different entities can't meet.  Names are
drawn, and a grouped check over the distinct names of all documents redraws
those that met, with more syllables as draws go on, until every surrogate
stands for one name.  The same entity gets the same surrogate in all documents,
in whatever format it stands (a phone number with or without its ``+1``); a
surname alone gets the surname's.  A first name's gender is that of the titles
before it in most rows of all documents (as many: female; none: neither), so it is
one name after any title.

The key is an argument, or the Spark setting ``KEY_SETTING``; where neither is
given, each session draws a random key, so that nobody can turn surrogates back
but nor do sessions agree.  With a key, structured types agree between runs by
themselves, and names through a stored table (``names_path``).

Bare runs of digits are cards only if their check digit holds.

Rows: null text stays null; texts without entities come back unchanged; null or
repeated ``doc_id`` rows are replaced one by one; an empty table gives an empty
result.  Other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
import secrets
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.llm.common import documents, few_at_once, staged

#: Spark setting that holds the secret key; Spark redacts values of settings so named in its pages and logs.
KEY_SETTING = "spark.stratakit.pii.secret"
_SESSION_KEYS: dict[str, str] = {}

# Titles before names, by gender.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "госпожа"),
    "": ("Dr", "Prof", "Professor"),
}
# Name endings by script and gender, and syllables by script.
SYLLABLES = {
    "LATIN": ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "va", "we", "xi", "yo", "zu"),
    "CYRILLIC": ("ба", "ве", "ди", "фо", "гу", "ха", "же", "ки", "ло", "му", "на", "пе", "ри", "со", "ту", "ва", "це", "чи", "шо", "зу"),
    "GREEK": ("βα", "γε", "δι", "ζο", "θυ", "κα", "λε", "μι", "νο", "πυ", "ρα", "σε", "τι", "φο", "χυ", "ψα", "ξε", "βι", "γο", "δυ"),
}
ENDINGS = {
    "LATIN": {"m": ("n", "r", "s", "l"), "f": ("lia", "nna", "ra", "sa"), "": ("nt", "rd", "ck", "ll")},
    "CYRILLIC": {"m": ("н", "р", "с", "л"), "f": ("лия", "нна", "ра", "са"), "": ("нт", "рд", "к", "лл")},
    "GREEK": {"m": ("ς", "ν", "ος", "ας"), "f": ("α", "η", "ια", "να"), "": ("δης", "κος", "λας", "ρης")},
}

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Titles in capitals, before names in capitals; shorter ones are more often something else.
_CAPITALS = {t.upper(): t for ts in TITLES.values() for t in ts if t not in ("Ms", "Sr") and t.upper() != t}
_TITLE = "|".join([*(t for ts in TITLES.values() for t in ts), *_CAPITALS])
_MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_ACCESS = r"AKIA[0-9A-Z]{16}"
_BEFORE_SECRET = r"(?i:\b(?:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|token)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"
_IBAN = r"[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?"
#: A word of a name: not one where another entity begins.
_NAME = rf"(?!{_MAIL}|{_ACCESS}\b|{_IBAN}\b|{_BEFORE_SECRET}[^\s\"',;]{{6}})(?![a-z])[^\W\d_][\w'-]+"
PATTERN = re.compile(
    rf"(?P<email>{_MAIL})"
    rf"|(?P<key>\b{_ACCESS}\b)"
    rf"|{_BEFORE_SECRET}(?P<secret>[^\s\"',;]{{6,}})"
    rf"|(?<![\d.])(?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?!\d|\.\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])"
    r"|(?<!\w)(?P<phone>\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{2,3}(?:[ .-]?\(?\d{2,4}\)?){3,4}(?!\d)|(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|[2-9]\d{2}[2-9]\d{6}(?![\w.]*\d))"
    r"|(?<!\d)(?P<card>\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
    rf"|\b(?P<iban>{_IBAN})\b"
    rf"|\b(?P<title>{_TITLE})\.? (?P<name>{_NAME}(?: {_NAME})?)"
)
_OWNED = re.compile(r"(?<=\w)'[sS]?$")
_HINT = re.compile(rf"[0-9@=:]|(?:{_TITLE})")


def secret_key(spark: SparkSession) -> str:
    """The key set for Spark, or one drawn for this application."""
    return spark.conf.get(KEY_SETTING, None) or _SESSION_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def keyed(key: str, *parts: object, size: int = 16) -> int:
    """A keyed number of ``size`` bytes."""
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), key=key.encode()[:64], digest_size=size).digest(), "big")


def permuted(n: int, total: int, key: str, *tweak: object) -> int:
    """A keyed permutation of ``range(total)``."""
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = n >> half, n & mask
        for i in range(8):
            a, b = b, a ^ (keyed(key, *tweak, total, i, b, size=max(8, half // 8 + 1)) & mask)
        n = a << half | b
        if n < total:
            return n


def recoded(value: str, alphabets: list[str | None], key: str, *tweak: object) -> str:
    """``value`` with the characters that have an alphabet permuted as one number."""
    n, total = 0, 1
    for ch, alphabet in zip(value, alphabets):
        if alphabet:
            n, total = n * len(alphabet) + alphabet.index(ch), total * len(alphabet)
    if total == 1:
        return value
    shape = "".join(ch if not a else chr(1 + len(a)) for ch, a in zip(value, alphabets))
    m, out = permuted(n, total, key, shape, *tweak), list(value)
    for k in range(len(value) - 1, -1, -1):
        if alphabets[k]:
            m, r = divmod(m, len(alphabets[k]))
            out[k] = alphabets[k][r]
    return "".join(out)


def by_class(value: str) -> list[str | None]:
    return [DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else None for c in value]


def luhn(digits: str) -> int:
    """The check digit that goes after ``digits``."""
    return -sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits))) % 10


def iban_check(value: str) -> int:
    """The check digits of an IBAN, whichever it has."""
    return 98 - int("".join(str(int(c, 36)) for c in f"{value[4:]}{value[:2]}00")) % 97


def structured(kind: str, value: str, key: str) -> str:
    """The surrogate of a canonical value of a structured type."""
    if kind == "email":
        local, domain = value.split("@")
        labels = domain.split(".")
        kept = 2 if labels[-2] == "example" else 1
        if kept == len(labels):  # a domain that nobody owns stays
            return f"{recoded(local, by_class(local), key, kind, domain)}@{domain}"
        body = f"{local}@{'.'.join(labels[:-kept])}"
        return ".".join([recoded(body, by_class(body), key, kind, *labels[-kept:]), *labels[-kept:]])
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        n = permuted(int.from_bytes(bytes(octets), "big"), 1 << 32, key, kind)
        return ".".join(map(str, n.to_bytes(4, "big")))
    if kind == "card":  # the brand digit and whether the check digit holds stay
        off = (int(value[-1]) - luhn(value[:-1])) % 10
        body = value[0] + recoded(value[1:-1], [DIGITS] * (len(value) - 2), key, kind, value[0], off)
        return body + str((luhn(body) + off) % 10)
    if kind == "phone":
        if value[0] == "+":  # sign and country code stay
            return value[:3] + recoded(value[3:], [DIGITS] * (len(value) - 3), key, kind, value[:3])
        alphabets: list[str | None] = [DIGITS] * len(value)
        for k in (0, 3):  # area and exchange codes begin with 2 to 9
            if value[k] in DIGITS[2:]:
                alphabets[k] = DIGITS[2:]
        return recoded(value, alphabets, key, kind)
    if kind == "key":
        return value[:4] + recoded(value[4:], [DIGITS + UPPER] * 16, key, kind)
    if kind == "iban":
        off = (int(value[2:4]) - iban_check(value)) % 100  # as with cards
        body = recoded(value[4:], by_class(value[4:]), key, kind, value[:2], off)
        return f"{value[:2]}{(iban_check(f'{value[:2]}00{body}') + off) % 100:02}{body}"
    if kind == "secret" and all(c in DIGITS + LOWER[:6] for c in value):
        return recoded(value, [DIGITS + LOWER[:6]] * len(value), key, kind)
    return recoded(value, by_class(value), key, kind)


def drawn_name(kind: str, key: str, value: str, draw: int) -> str:
    """A name of the kind's gender and script; later draws are longer."""
    _, gender, script = kind.split(":")
    syllables, endings = SYLLABLES[script], ENDINGS[script][gender]
    n = keyed(key, kind, value, draw)
    out = ""
    for _ in range(3 + draw // 3):
        n, r = divmod(n, len(syllables))
        out += syllables[r]
    return (out + endings[n % len(endings)]).capitalize()


def surrogate(kind: str, value: str, key: str, draw: int = 0) -> str:
    return drawn_name(kind, key, value, draw) if ":" in kind else structured(kind, value, key)


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN").split(" ")[0]
    return name if name in SYLLABLES else "LATIN"


def entities(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """``start, end, kind, canonical value, text`` of the entities, in order.

    Canonical values leave out what formats the entity: case of mail addresses
    and names, spaces and signs of numbers, the country code 1.
    """
    start = 0
    while m := PATTERN.search(text, start):
        kind, start = m.lastgroup, m.end()
        if kind == "name":
            words, at = m["name"].split(" "), m.start("name")
            if not words[0][0].isupper():
                start = at  # what stands behind the title may be an entity itself
                continue
            title = _CAPITALS.get(m["title"], m["title"])
            if title != m["title"] and not words[0].isupper():
                start = at
                continue
            if len(words) > 1 and (not words[1][0].isupper() or title != m["title"] and not words[1].isupper() or _OWNED.search(words[0])):
                words = words[:1]
            words[-1] = _OWNED.sub("", words[-1])  # the name's owner, without the mark
            gender = next(g for g, ts in TITLES.items() if title in ts)
            for k, w in enumerate(words):
                role = f"last::{script_of(w)}" if k == len(words) - 1 else f"first:{gender}:{script_of(w)}"
                yield at, at + len(w), role, w.casefold(), w
                at += len(w) + 1
            start = at - 1
            continue
        raw = m[kind]
        value = raw.lower() if kind == "email" else re.sub(r"\D", "", raw) if kind in ("phone", "card", "ssn") else raw.replace(" ", "") if kind == "iban" else raw
        if kind == "card" and raw.isdigit() and luhn(raw[:-1]) != int(raw[-1]):
            continue
        if kind == "phone":
            value = value[-10:] if raw.startswith("+1") or raw[0] != "+" else f"+{value}"
        yield m.start(kind), m.end(kind), kind, value, raw


def poured(kind: str, raw: str, value: str) -> str:
    """A surrogate in the format of one occurrence."""
    if kind in ("phone", "card", "ssn", "iban"):
        found = sum(c.isalnum() for c in raw)
        left = iter(value.lstrip("+").rjust(found, "1"))  # a country code 1 that the value leaves out
        return "".join(next(left) if c.isalnum() else c for c in raw)
    return value.upper() if (":" in kind or kind == "email") and raw.isupper() and len(raw) > 1 else value


def name_occurrences(docs: DataFrame) -> DataFrame:
    """``row1, row2, kind, value``: names, distinct within each document's text."""
    schema = "row1 long, row2 long, kind string, value string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            rows = [(a, b, k, v) for a, b, t in zip(*(batch.column(c).to_pylist() for c in ("row1", "row2", "text"))) for k, v in {(e[2], e[3]) for e in entities(t) if ":" in e[2]}]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["row1", "row2", "kind", "value"])

    titled = F.col("text").rlike(rf"\b(?:{_TITLE})\.? ")
    return docs.where(titled).select(*row_keys(), "text").mapInArrow(run, schema)


def row_keys() -> tuple:
    """128 bits of id and text: rows that agree in both have the same names."""
    return F.xxhash64("doc_id", "text").alias("row1"), F.xxhash64(F.lit(0x5EED), "text", "doc_id").alias("row2")


def draws(found: DataFrame, key: str, settled: DataFrame | None = None) -> DataFrame:
    """``kind, value, draw, surrogate``: each name's first draw that no other
    name has.  Names in ``settled``, rows of the same columns, keep theirs.

    In each round the names without a surrogate draw one; of those that meet,
    the least goes first, unless a settled name has it.  Later draws are
    longer, so the rounds end, however many names there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind, value, draw = (b.column(c).to_pylist() for c in ("kind", "value", "draw"))
            out = [drawn_name(k, key, v, d) for k, v, d in zip(kind, value, draw)]
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(value, pa.string()), pa.array(draw, pa.int32()), pa.array(out, pa.string())], names=["kind", "value", "draw", "surrogate"])

    names = found.select("kind", "value").distinct()
    left = (names if settled is None else names.join(settled, ["kind", "value"], "left_anti")).withColumn("draw", F.lit(0))
    while True:
        made = staged(left.mapInArrow(run, "kind string, value string, draw int, surrogate string"))
        free = made if settled is None else made.join(settled, ["kind", "surrogate"], "left_anti")
        won = staged(free.groupBy("kind", "surrogate").agg(F.min(F.struct("value", "draw")).alias("first")).select("kind", "first.value", "first.draw", "surrogate"))
        settled = won if settled is None else settled.unionByName(won)
        left = made.join(won, ["kind", "value"], "left_anti").select("kind", "value", (F.col("draw") + 1).cast("int").alias("draw"))
        if left.isEmpty():
            return settled


def one_gender(found: DataFrame, settled: DataFrame | None = None) -> DataFrame:
    """``kind, value, as_kind``: under which kind each name found draws.  First
    names that are settled stay under theirs; see the module's text for others."""
    gender, other = F.regexp_extract("kind", "^first:(.?):", 1), F.regexp_replace("kind", "^first:.?:", "first::")
    rows = found.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).withColumns({"gender": gender, "other": other})
    of = lambda g: F.sum(F.when(F.col("gender") == g, F.col("n")).otherwise(0))
    sums = rows.groupBy("other", "value").agg(of("f").alias("f"), of("m").alias("m"))
    best = F.when((F.col("f") == 0) & (F.col("m") == 0), "").when(F.col("f") >= F.col("m"), "f").otherwise("m")
    sums = sums.select("other", "value", best.alias("best"))
    if settled is not None:
        held = settled.where(F.col("kind").startswith("first:")).groupBy(other.alias("other"), "value").agg(F.min(gender).alias("held"))
        sums = sums.join(held, ["other", "value"], "left").select("other", "value", F.coalesce("held", "best").alias("best"))
    as_kind = F.when(F.col("kind").startswith("first:"), F.regexp_replace("other", "^first::", F.concat(F.lit("first:"), F.col("best"), F.lit(":")))).otherwise(F.col("kind"))
    return rows.join(sums, ["other", "value"]).select("kind", "value", as_kind.alias("as_kind"))


def stored_names(spark: SparkSession, path: str | None) -> DataFrame | None:
    if path is None:
        return None
    try:
        return staged(spark.read.schema("kind string, value string, draw int, surrogate string").parquet(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def replace_pii(docs: DataFrame, key: str, names_path: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities`` (a column of that
    name is replaced).

    Texts get first draws where they stand.  Redraws, and names whose gender is
    another than their title's, come by a join on the keys
    of the row, whose small side Spark broadcasts if its size allows.  With
    ``names_path``, names keep the surrogates of earlier runs with the same key,
    and new ones are appended there.
    """
    spark = docs.sparkSession
    found = staged(name_occurrences(docs))
    before = stored_names(spark, names_path)
    kinds = staged(one_gender(found, before))
    table = draws(kinds.select(F.col("as_kind").alias("kind"), "value"), key, before)
    if names_path is not None:
        new = table if before is None else table.join(before, ["kind", "value"], "left_anti")
        staged(new).write.mode("append").parquet(names_path)
    drawn = table.select(F.col("kind").alias("as_kind"), "value", "draw")
    redrawn = kinds.join(drawn, ["as_kind", "value"]).where("draw > 0 OR kind <> as_kind")
    pairs = F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "value").alias("what"), "as_kind", "draw"))
    per_row = staged(found.distinct().join(redrawn, ["kind", "value"]).groupBy("row1", "row2").agg(pairs.alias("_redrawn")).withColumnsRenamed({"row1": "_row1", "row2": "_row2"}))
    columns = [c for c in docs.columns if c != "n_entities"]
    one, two = row_keys()
    joined = docs.select(*columns, one.alias("_own1"), two.alias("_own2")).join(per_row, (F.col("_own1") == F.col("_row1")) & (F.col("_own2") == F.col("_row2")), "left").drop("_own1", "_own2", "_row1", "_row2")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.select(*columns).schema] + [T.StructField("n_entities", T.IntegerType())])

    def replaced(text: str | None, redrawn: list | None) -> tuple[str | None, int]:
        if text is None or not _HINT.search(text):
            return text, 0
        draw = {x["what"]: (x["as_kind"], x["draw"]) for x in redrawn or ()}
        out, at, n = [], 0, 0
        for start, end, kind, value, raw in entities(text):
            as_kind, n_draw = draw.get(f"{kind}\x1f{value}", (kind, 0))
            new = poured(kind, raw, surrogate(as_kind, value, key, n_draw))
            out += [text[at:start], new]
            at, n = end, n + 1
        return ("".join([*out, text[at:]]), n) if n else (text, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            new = [replaced(t, r) for t, r in zip(batch.column("text").to_pylist(), batch.column("_redrawn").to_pylist())]
            kept = [batch.column(c) if c != "text" else pa.array([x[0] for x in new], batch.schema.field("text").type) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([x[1] for x in new], pa.int32())], names=schema.names)

    return joined.mapInArrow(run, schema)


def op9_surrogate_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' texts with surrogates for their personal data."""
    return replace_pii(documents(spark, sf_dir), secret_key(spark)).select("doc_id", "text", "n_entities")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with surrogates in ``text``; null texts, repeated rows and other
    columns pass as they are (see the module's text), no rows give none."""
    return replace_pii(docs, secret_key(spark)).select(*docs.columns)
