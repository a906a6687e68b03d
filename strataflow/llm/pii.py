"""Personal data replaced by keyed surrogates.

Entities are found by patterns with checks (Luhn, mod 97, octet ranges, honorifics). Each is replaced by a surrogate of
its own type and format: letters and digits go through a keyed permutation of all strings of the same shape (a Feistel
network over the mixed-radix number that the string spells), so unlike entities of one shape get unlike surrogates and
equal entities the same one in every document. Names are rebuilt from syllables of their script with an ending of
their gender. A collision check over all distinct entities finds surrogates that two entities share, or that equal a
real entity; those entities move to their next attempt. In a shape that real entities nearly fill, some attempts never
end; all entities of such a shape go back to the first permutation, under which no two share a surrogate, though one may
get what is another's real value.

The key must be secret: who has it can undo the surrogates of all types but names.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import uuid
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.shared import stash
from strataflow.llm.text import release, rows_of

ATTEMPTS = 20

_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
#: Honorifics and the gender they tell; fixed values.
HONORIFICS = {
    "mr": "m", "mister": "m", "sir": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "signor": "m", "господин": "m", "г-н": "m", "κύριος": "m",
    "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "lady": "f", "frau": "f", "madame": "f", "mme": "f", "señora": "f", "sra": "f", "signora": "f", "госпожа": "f", "г-жа": "f", "κυρία": "f",
    "dr": "n", "prof": "n", "doctor": "n", "professor": "n",
}
PATTERNS = (
    ("email", r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}"),
    ("secret", r"(?i:\b(?:api[_-]?key|access[_-]?key|auth|token|secret|password|passwd|pwd)\b)[\"']?\s*[:=]\s*[\"']?(?P<secret_value>[A-Za-z0-9+/_=-]{12,})"),
    ("iban", r"(?<![^\W_])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![^\W_])"),
    ("ip", r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"),
    ("card", r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w]|\.\d)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("phone", r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?![\w])|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\w]|[.-]\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w]|[.-]\d)"),
)
_FIND = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in PATTERNS))
_TITLES = "|".join(sorted(HONORIFICS, key=len, reverse=True))
#: The honorific in any case; the words behind it are walked through one by one.
_TITLE = re.compile(rf"(?i)(?<![\w])(?P<title>{_TITLES})(?:\.|(?=\s)) ?(?={_NAME})")
_WORD = re.compile(rf" ?(?P<word>{_NAME})(?P<dot>\.(?= ?[^\W\d_]))?")
#: Words that join the parts of a name in lower case; fixed values.
PARTICLES = frozenset("af al am bin da das de del della den der di do dos du e el la le ter van vom von y zu zum zur".split())
#: Letters from which a name is looked for where it stands without its title.
BARE_LENGTH = 3

#: Characters that stand for each other; everything else in an entity stays as it is.
CLASSES = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψωάέήίόύώς",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩΆΈΉΊΌΎΏ",
)
HEX = ("0123456789abcdef", "0123456789ABCDEF")
_CLASS_OF = {c: group for group in CLASSES for c in group}
#: Domain labels that stay, since they belong to nobody.
RESERVED = {"example", "test", "invalid", "localhost"}
#: Consonants, vowels, and endings by gender, for made-up names of each script.
SYLLABLES = {
    "latin": ("bdfgklmnprstvz", "aeiou", {"m": ("o", "us", "in", "ert"), "f": ("a", "ia", "elle", "ine"), "n": ("en", "is", "ar", "or")}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"m": ("ов", "ин", "ей", "ан"), "f": ("ова", "ина", "ея", "ана"), "n": ("ко", "ис", "ых", "ер")}),
    "greek": ("βγδζκλμνπρστ", "αεηιο", {"m": ("ος", "ης", "ας", "ων"), "f": ("ια", "ου", "ινη", "ανα"), "n": ("ακη", "ιδη", "ελη", "ορα")}),
}


def _digest(key: bytes, *parts) -> int:
    text = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(text, key=key[:64], digest_size=32).digest(), "big")


def permuted(key: bytes, value: int, size: int, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1: a Feistel network over the next even number of bits, walked until it is
    back in range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for turn in range(6):
            wide = _digest(key, tweak, turn, size, right)
            left, right = right, left ^ (wide & mask if half <= 256 else int.from_bytes(hashlib.shake_256(wide.to_bytes(32, "big")).digest(half // 8 + 1), "big") & mask)
        value = left << half | right
        if value < size:
            return value


def shaped(key: bytes, text: str, tweak: str, classes=None) -> str:
    """A string of the same shape: each character stays in its class, others stay as they are."""
    groups = [classes if classes and c in classes else _CLASS_OF.get(c) for c in text]
    size, value = 1, 0
    for c, group in zip(text, groups):
        if group:
            value = value * len(group) + group.index(c)
            size *= len(group)
    if size < 2:
        return text
    value = permuted(key, value, size, tweak)
    out = list(text)
    for i in range(len(text) - 1, -1, -1):
        if groups[i]:
            value, rest = divmod(value, len(groups[i]))
            out[i] = groups[i][rest]
    return "".join(out)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "")
    return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"


def _made_name(key: bytes, word: str, tweak: str, gender: str) -> str:
    onset, vowel, endings = SYLLABLES[_script(word)]
    seed = _digest(key, tweak, word)
    out = ""
    # Each attempt after the third adds a syllable, so names never run out.
    for _ in range((2 if len(word) < 6 else 3) + max(0, int(tweak.rsplit("/", 1)[1]) - 3)):
        seed, a = divmod(seed, len(onset))
        seed, b = divmod(seed, len(vowel))
        out += onset[a] + vowel[b]
    seed, a = divmod(seed, len(onset))
    return out + onset[a] + endings[gender][seed % len(endings[gender])]


@lru_cache(maxsize=50_000)
def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate of an entity in its normal form, as a normal form of the same type."""
    tweak = f"{kind}/{attempt}"
    if kind == "email":
        local, host = entity.rsplit("@", 1)
        labels = host.split(".")
        labels[:-1] = [x if x in RESERVED else shaped(key, x, f"host/{attempt}") for x in labels[:-1]]
        return f"{shaped(key, local, tweak)}@{'.'.join(labels)}"
    if kind == "ip":
        parts = [int(x) for x in entity.split(".")]
        # Private ranges stay private: what names the range is kept.
        fixed = 1 if parts[0] in (0, 10, 127) else 2 if (parts[0], parts[1]) in ((192, 168), (169, 254)) or (parts[0] == 172 and 16 <= parts[1] < 32) else 0
        number = 0
        for x in parts[fixed:]:
            number = number << 8 | x
        size = 1 << 8 * (4 - fixed)
        while True:
            number = permuted(key, number, size, f"{tweak}/{parts[:fixed]}")
            out = parts[:fixed] + [number >> 8 * i & 255 for i in range(3 - fixed, -1, -1)]
            if fixed or not (out[0] in (0, 10, 127) or (out[0], out[1]) in ((192, 168), (169, 254)) or (out[0] == 172 and 16 <= out[1] < 32)):
                return ".".join(map(str, out))
    if kind == "card":
        body = entity[0] + shaped(key, entity[1:-1], f"{tweak}/{entity[0]}")
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        body = shaped(key, entity[4:], f"{tweak}/{entity[:2]}")
        return f"{entity[:2]}{98 - _mod97(entity[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        country, number = entity.split("/")
        area, middle, end = number[:-7], number[-7:-4], number[-4:]
        if middle == "555":  # numbers for fiction stay such numbers
            made = shaped(key, area + end, f"{tweak}/{country}/555")
            return f"{country}/{made[: len(area)]}555{made[len(area):]}"
        return f"{country}/{shaped(key, number, f'{tweak}/{country}')}"
    if kind == "secret":
        group = next((h for h in HEX if all(c in h for c in entity)), None)
        return shaped(key, entity, tweak, group)
    if kind in ("given", "family"):
        gender, word = entity.split("/")
        return f"{gender}/{_made_name(key, word, tweak, gender)}"
    return shaped(key, entity, tweak)


def _name_words(text: str, at: int) -> list[tuple[str, int]]:
    """The words of a name that begins at a place: capitalised words or words in capitals, any number of them, particles
    only between such words. Initials are passed over."""
    spots, waiting = [], 0
    while (m := _WORD.match(text, at)) and (waiting == 0 or m.group()[0] == " "):
        word = m["word"]
        initial = len(word) == 1 and word.isupper()
        if not (initial or (word[0].isupper() and len(word) > 1) or (spots and word in PARTICLES) or (waiting > 0 and word in PARTICLES)):
            break
        if len(word) > 1 and word[0].isupper():
            spots.append((word, m.start("word")))
        waiting, at = waiting + 1, m.end()
        if m["dot"] and not initial:
            break
    return spots


def _people(text: str) -> list[tuple[str, str, int, int]]:
    """Names behind an honorific, and where they stand again without one. The last word is the family name."""
    found: list[tuple[str, str, int, int]] = []
    known: dict[str, tuple[str, str]] = {}
    for m in _TITLE.finditer(text):
        gender, spots = HONORIFICS[m["title"].lower()], _name_words(text, m.end())
        for i, (word, start) in enumerate(spots):
            kind = "family" if i == len(spots) - 1 else "given"
            value = f"{gender if kind == 'given' else 'n'}/{word.casefold()}"
            found.append((kind, value, start, start + len(word)))
            if len(word) >= BARE_LENGTH:
                known.setdefault(word.casefold(), (kind, value))
    if known:
        bare = re.compile(rf"(?i)(?<![\w])(?:{'|'.join(re.escape(w) for w in sorted(known, key=len, reverse=True))})(?![\w])")
        told = {f[2] for f in found}
        for m in bare.finditer(text):
            if m.start() not in told and m.group()[0].isupper() and m.group().casefold() in known:
                found.append((*known[m.group().casefold()], *m.span()))
    return found


def entities(text: str) -> list[tuple[str, str, int, int]]:
    """(type, normal form, start, end) of every entity in order, without overlaps. The normal form leaves out case and
    separators where they do not tell entities apart."""
    found = []
    if "@" in text or re.search(r"\d{3}", text) or re.search(r"\d\.\d", text) or "=" in text or ":" in text:
        for m in _FIND.finditer(text):
            kind, value, (start, end) = m.lastgroup, m.group(), m.span()
            if m["secret"] is not None:
                kind, value, (start, end) = "secret", m["secret_value"], m.span("secret_value")
            digits = re.sub(r"\D", "", value)
            if kind == "email":
                value = value.lower()
            elif kind == "ip" and any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in value.split(".")):
                continue
            elif kind == "card":
                if not luhn(digits) or len(set(digits)) == 1:
                    continue
                value = digits
            elif kind == "iban":
                value = value.replace(" ", "")
                if not 15 <= len(value) <= 34 or _mod97(value) != 1:
                    continue
            elif kind == "phone":
                if not 9 <= len(digits) <= 15:
                    continue
                country = re.match(r"\+(\d{1,3})(?=[ .(-])", value)
                value = f"{country[1]}/{digits[len(country[1]):]}" if country else f"/{digits}"
                if len(value.split("/")[1]) < 7:
                    continue
            found.append((kind, value, start, end))
    if people := _people(text):
        apart, last = [], -1
        # Where a name and another entity overlap the one that begins first counts.
        for one in sorted([*found, *people], key=lambda x: (x[2], -x[3])):
            if one[2] >= last:
                apart.append(one)
                last = one[3]
        found = apart
    return found


def _dressed(kind: str, made: str, shown: str) -> str:
    """A surrogate in the format in which the entity was shown: its separators and its case."""
    if kind in ("given", "family"):
        name = made.split("/")[1]
        return name.upper() if shown.isupper() else name.title()
    if kind == "email":
        return made.upper() if shown.isupper() else made
    if kind in ("card", "phone", "iban"):
        kept = iter(made.replace("/", ""))
        return "".join(next(kept) if c.isalnum() else c for c in shown)
    return made


def replaced(text: str, key: bytes, attempts: dict | None = None) -> tuple[str, list[tuple[str, int, int, str]]]:
    """The text with surrogates, and (type, start, end, surrogate) of each entity in the old text."""
    out, last, marks = [], 0, []
    for kind, value, start, end in entities(text):
        made = _dressed(kind, surrogate(key, kind, value, (attempts or {}).get(f"{kind}:{value}", 0)), text[start:end])
        out += [text[last:start], made]
        last = end
        marks.append((kind, start, end, made))
    return "".join(out) + text[last:], marks


def _occurrences(batches):
    for batch in batches:
        docs, kinds, values = [], [], []
        for doc, text in rows_of(batch.column(0), batch.column(1)):
            for kind, value in {e[:2] for e in entities(text or "")}:
                docs.append(doc)
                kinds.append(kind)
                values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["doc", "kind", "entity"])
    release()


def _shape(kind: str, entity: str) -> str:
    """What a surrogate has in common with its entity: two entities of unlike shapes never share one."""
    if kind == "ip":
        parts = entity.split(".")
        return ".".join(parts[:1] if parts[0] in ("0", "10", "127") else parts[:2] if parts[0] in ("192", "169", "172") else ["public"])
    if kind in ("given", "family"):
        return entity
    return "".join(_CLASS_OF[c][0] if c in _CLASS_OF else c for c in entity)


def attempts(distinct: DataFrame, key: bytes, most: int = ATTEMPTS) -> DataFrame:
    """(kind, entity, attempt) of the entities that need an attempt after the first. Of entities that share a surrogate
    the smallest keeps it; a surrogate that is a real entity is given up by whoever got it. What is shared after `most`
    rounds goes back to the first attempt with its whole shape, where surrogates are a permutation."""

    @F.arrow_udf("string")
    def made(kinds: pa.Array, entities: pa.Array, tries: pa.Array) -> pa.Array:
        return pa.array([surrogate(key, *row) for row in rows_of(kinds, entities, tries)], pa.string())

    @F.arrow_udf("string")
    def shape(kinds: pa.Array, entities: pa.Array) -> pa.Array:
        return pa.array([_shape(*row) for row in rows_of(kinds, entities)], pa.string())

    now = stash(distinct.select("kind", "entity", F.lit(0).alias("attempt"), made("kind", "entity", F.lit(0)).alias("made")), "surrogates")
    real = distinct.select("kind", F.col("entity").alias("made"), F.lit(True).alias("real"))
    for turn in range(most + 1):
        first = now.groupBy("kind", "made").agg(F.min(F.struct("attempt", "entity")).alias("first"))
        judged = now.join(first, ["kind", "made"]).join(real, ["kind", "made"], "left")
        shared = F.col("entity") != F.col("first.entity")
        if turn == most:
            dense = judged.where(shared).select("kind", shape("kind", "entity").alias("shape")).distinct()
            back = now.withColumn("shape", shape("kind", "entity")).join(dense.withColumn("dense", F.lit(True)), ["kind", "shape"], "left")
            now = stash(back.select("kind", "entity", F.when(F.col("dense"), 0).otherwise(F.col("attempt")).alias("attempt")), "surrogates")
            break
        bad = F.col("real").isNotNull() | shared
        bad = stash(judged.where(bad).select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "collisions")
        if bad.isEmpty():
            break
        again = bad.select("*", made("kind", "entity", "attempt").alias("made"))
        now = stash(now.join(bad.select("kind", "entity"), ["kind", "entity"], "left_anti").unionByName(again), "surrogates")
    return now.where("attempt > 0").select("kind", "entity", "attempt")


def with_surrogates(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """All rows and columns with the text replaced under a secret key (any bytes, the same for all runs that must agree), and the name of an added column: an array of the entities found
    (type, begin, end in the old text, surrogate). Null texts stay null, empty ones empty. Rows without a key or that
    repeat one are replaced each. An empty table gives an empty result."""
    seen = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    seen = stash(seen.mapInArrow(_occurrences, "doc long, kind string, entity string"), "entities")
    moved = attempts(seen.select("kind", "entity").distinct(), secret)
    # Only documents that hold an entity on a later attempt get a map; mostly there are few or none.
    pair = F.struct(F.concat_ws(":", "kind", "entity"), "attempt")
    doc, maps, marks = (f"{name}_{uuid.uuid4().hex}" for name in ("doc", "maps", "marks"))
    per_doc = seen.join(moved, ["kind", "entity"]).select("doc", "kind", "entity", "attempt").distinct()
    per_doc = stash(per_doc.groupBy(F.col("doc").alias(doc)).agg(F.map_from_entries(F.collect_list(pair)).alias(maps)), "attempts")
    joined = docs.join(per_doc, F.col(key).cast("long").eqNullSafe(F.col(doc)), "left")

    @F.arrow_udf("struct<text: string, marks: array<struct<type: string, begin: int, end: int, surrogate: string>>>")
    def rewrite(texts: pa.Array, tried: pa.Array) -> pa.Array:
        # Texts without entities, most of them, are passed on as they came.
        new, found = [], []
        for old, attempt in rows_of(texts, tried):
            done, spots = replaced(old, secret, dict(attempt) if attempt else None) if old is not None else (None, [])
            new.append(done if spots else None)
            found.append([{"type": k, "begin": b, "end": e, "surrogate": s} for k, b, e, s in spots])
        kind = pa.list_(pa.struct([("type", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))
        whole = pc.coalesce(pa.array(new, texts.type), texts)
        release()
        return pa.StructArray.from_arrays([whole, pa.array(found, kind)], names=["text", "marks"])

    done = joined.withColumn(marks, rewrite(F.col(text), F.col(maps)))
    columns = [F.col(marks)["text"].alias(c) if c == text else F.col(c) for c in docs.columns]
    return done.select(*columns, F.col(marks)["marks"].alias(marks)), marks


def replace_private(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of the input, with surrogates in the text."""
    done, marks = with_surrogates(docs, secret, key, text)
    return done.drop(marks)


def private_report(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text with surrogates, n_entities, entities of every row."""
    done, marks = with_surrogates(docs, secret, key, text)
    return done.select(F.col(key), F.col(text), F.size(marks).alias("n_entities"), F.col(marks).alias("entities"))
