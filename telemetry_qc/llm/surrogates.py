"""PII: every detected entity gets a keyed surrogate of its own kind.

Detected are mail addresses, telephone, card, account (IBAN) and social
security numbers, IP addresses, access keys, values assigned to passwords,
tokens and the like, and names after a form of address.  A surrogate keeps the
format: separators, case, kind of every character, check digits where there
are some, the country of a number, the script and gender of a name.  It is
drawn by a keyed hash of the entity's canonical form, so the same entity has
the same surrogate wherever and however written (coreference), and nobody
without the key can go back.  A mail address is two entities, so that one
domain has one surrogate.  A given name has the gender that most of its forms
of address tell over the corpus (none: of the lists, or any), whatever form
stands before it in one place.

Distinctness is checked over all entities of the corpus: two that draw the
same surrogate, or one that draws another's real value or its own, draw
again, all but the least, until there is none.  From the second or third draw
on surrogates get longer, so that there are always enough, also for secrets of
signs alone or where all values of a short format occur.  Entities that had to
draw again are few; they are sent to the documents that hold them, as are the
genders of names.

Null text is empty text.  Equal rows get equal texts; rows of one doc_id with
different texts are documents of their own.  Texts without an entity are
unchanged.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import DOC_COLUMNS, KEY, documents, order_key, saved, ship, small

#: Forms of address and the gender they tell (n: none).
TITLES = {
    "Mr": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f",
    "Herr": "m", "Herrn": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mademoiselle": "f", "Mme": "f", "Mlle": "f",
    "Señor": "m", "Señora": "f", "Señorita": "f", "Sr": "m", "Sra": "f", "Srta": "f", "Don": "m", "Doña": "f",
    "господин": "m", "госпожа": "f", "Господин": "m", "Госпожа": "f",
    "κύριος": "m", "κυρία": "f", "Κύριος": "m", "Κυρία": "f",
    "Dr": "n", "Prof": "n",
}

#: Given names by script and gender, family names by script.
GIVEN = {
    ("latin", "m"): "Adam Albert Bruno Carl David Edgar Felix Georg Henri Ivan Jonas Karim Louis Martin Nils Oscar Paul Robert Simon Thomas Victor Walter".split(),
    ("latin", "f"): "Alice Anna Berta Clara Diana Elena Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Tina Vera Wanda".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Георгий Дмитрий Иван Кирилл Лев Михаил Николай Олег Павел".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Ольга".split(),
    ("greek", "m"): "Αλέξανδρος Γεώργιος Δημήτρης Ηλίας Κώστας Νίκος Πέτρος Σταύρος".split(),
    ("greek", "f"): "Αγγελική Βασιλική Δήμητρα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία".split(),
}
FAMILY = {
    "latin": "Abel Bauer Conti Dupont Ekman Fischer Garcia Holm Ibsen Jansen Keller Lopez Meyer Novak Olsen Petit Quinn Rossi Silva Turner Urban Vidal Weber Young".split(),
    "cyrillic": "Алексеенко Бондаренко Гончаренко Дорошенко Ермак Коваль Лысенко Мороз Оленич Петренко".split(),
    "greek": "Αγγέλου Βασιλείου Γεωργίου Δημητρίου Ιωάννου Κωνσταντίνου Νικολάου Παπαδάκη".split(),
}

_NAME = r"\p{Lu}[\p{L}\p{M}'’]*(?:-\p{Lu}[\p{L}\p{M}]*)*"
#: Kinds in the order of precedence: pattern, and what a text must hold.
PATTERNS = [
    ("mail", r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.\p{L}{2,}", "@"),
    ("key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])", "A"),
    ("secret", r"(?i:\b(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth)\b[\"']?\s*[=:]\s*[\"']?)\K[^\s\"',;<>]{6,}", "=:"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "0"),
    ("ip", r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])", "0"),
    ("card", r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", "0"),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", "0"),
    ("phone", r"(?<![\w.+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-][0-9]{2,5}){1,4}(?![\w-])|(?<![\w.+-])\+[0-9]{8,14}(?!\w)", "0"),
    ("name", rf"\b(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})\.? \K{_NAME}(?: {_NAME}){{0,2}}", "T"),
]
_COMPILED = [(kind, regex.compile(p), need) for kind, p, need in PATTERNS]
_TITLE = regex.compile(rf"\b({'|'.join(sorted(TITLES, key=len, reverse=True))})\.? $")
_DIGITS = regex.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def script(word: str) -> str:
    c = word[0]
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _valid(kind: str, found: str) -> bool:
    if kind == "card":
        return luhn("".join(_DIGITS.findall(found)))
    if kind == "iban":
        return iban_ok(found.replace(" ", ""))
    if kind == "ip":
        return all(int(p) < 256 for p in found.split("."))
    if kind == "phone":
        n = len(_DIGITS.findall(found))
        dotted = regex.fullmatch(r"\d{1,3}(?:\.\d{1,3}){3}", found)  # like an IP address
        return 8 <= n <= 15 and (found[0] in "+(" or n >= 10) and not dotted
    return True


def canonical(kind: str, found: str) -> str:
    """One form for all ways of writing an entity."""
    if kind in ("card", "ssn", "phone"):
        return "".join(_DIGITS.findall(found))
    if kind == "iban":
        return found.replace(" ", "")
    if kind == "mail" or kind.startswith(("given", "family")):
        return found.lower()
    return found


def detect(text: str, has: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, canonical, gender), in order, not overlapping;
    ``has`` tells which patterns are worth a try.  The gender is n for all but
    given names."""
    out: list[tuple[int, int, str, str, str]] = []
    taken: list[tuple[int, int]] = []
    for kind, pattern, need in _COMPILED:
        if not any(n in has for n in need):
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            found = m.group()
            if kind == "secret":
                while found[-1] in ".)]}":
                    found, b = found[:-1], b - 1
                    if not found:
                        break
            if not found or not _valid(kind, found) or any(a < e and s < b for s, e in taken):
                continue
            taken.append((a, b))
            if kind != "name":
                out.append((a, b, kind, canonical(kind, found), "n"))
                continue
            gender = TITLES[_TITLE.search(text[max(0, a - 16) : a]).group(1)]
            parts = list(regex.finditer(r"[^ ]+", found))
            for i, part in enumerate(parts):
                word = part.group()
                given = i < len(parts) - 1
                role = f"{'given' if given else 'family'} {script(word)}"
                out.append((a + part.start(), a + part.end(), role, canonical(role, word), gender if given else "n"))
    return sorted(out)


#: The letters of scripts.
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}


@cache
def alphabet(c: str) -> str:
    """Letters of a letter's script, small ones where it has two cases;
    other scripts: of its own kind in its part of the character table."""
    if ord(c) < 0x250 or script(c) != "latin":
        return LETTERS[script(c)]
    kind, first = unicodedata.category(c), ord(c) & ~63
    return "".join(chr(x) for x in range(first, first + 64) if unicodedata.category(chr(x)) == kind)


class Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: str):
        self.seed = hashlib.blake2b("\0".join(parts).encode(), key=key, digest_size=32).digest()
        self.pool, self.used = 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            block = hashlib.blake2b(self.seed + self.used.to_bytes(8, "little")).digest()
            self.used += 1
            self.pool, self.left = int.from_bytes(block, "little"), 1 << 512
        self.pool, out = divmod(self.pool, n)
        self.left //= n
        return out

    def like(self, text: str, hexadecimal: bool = False, longer: int = 0) -> str:
        """Every character another of its kind, and ``longer`` more of the
        kind of the last that has one (letters, if none has)."""
        if longer:
            last = next((c for c in reversed(text) if c.isalnum()), "x")
            text += last * longer
        out = []
        for c in text:
            if c.isdigit():
                out.append("0123456789"[self.below(10)])
            elif hexadecimal and c in "abcdef":
                out.append("abcdef"[self.below(6)])
            elif c.isalpha():
                some = alphabet(c)
                s = some[self.below(len(some))]
                out.append(s.upper() if c.isupper() else s)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int, gender: str = "n") -> str:
    """The surrogate of a canonical form, itself in canonical form; of a mail
    address, with the domain it has."""
    for more in range(20):
        draw = Draw(key, kind, value, str(attempt), str(more))
        new = _surrogate(draw, kind, value, attempt, gender)
        if new != value:
            break
    return new


def _surrogate(draw: Draw, kind: str, value: str, attempt: int, gender: str) -> str:
    # Later draws come from a growing set; at once, where nothing can change.
    longer = attempt // 2 if any(map(str.isalnum, value)) else attempt
    if kind == "mail":
        local, _, domain = value.rpartition("@")
        if not any(map(str.isalnum, local)):
            longer = attempt
        return draw.like(local, longer=longer) + "@" + domain
    if kind == "domain":
        first, *more, ending = value.split(".")  # which stays
        return ".".join([draw.like(first, longer=longer), *map(draw.like, more), ending])
    if kind == "ip":
        if attempt < 8:
            return ".".join(str(1 + draw.below(254)) for _ in range(4))
        # Of the range kept for examples, once the short form runs out.
        return "2001:db8:" + ":".join(f"{draw.below(1 << 16):x}" for _ in range(6))
    if kind == "card":
        body = value[0] + draw.like(value[1:-1], longer=longer)
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        body = value[:2] + "00" + draw.like(value[4:], longer=longer)
        check = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
        return f"{value[:2]}{check:02d}{body[4:]}"
    if kind == "phone":
        # What may be the country and the first digit of the area stay.
        keep = max(0, len(value) - 9)
        return value[:keep] + draw.like(value[keep:], longer=longer)
    if kind == "key":
        return value[:4] + draw.like(value[4:], longer=longer)
    if kind.startswith(("given", "family")):
        role, written = kind.split()
        if role == "family":
            names = FAMILY[written]
        else:
            if gender == "n":
                gender = next((g for (_, g), some in GIVEN.items() if value.capitalize() in some), "n")
            names = GIVEN.get((written, gender)) or GIVEN[written, "m"] + GIVEN[written, "f"]
        # Later draws take double names, then more parts, from a growing set.
        return "-".join(names[draw.below(len(names))] for _ in range(1 + (attempt + 1) // 2)).lower()
    return draw.like(value, hexadecimal=not set(value) - set("0123456789abcdef"), longer=longer)


def written(kind: str, found: str, new: str) -> str:
    """A surrogate's canonical form in the format of the original."""
    if kind in ("card", "ssn", "phone", "iban"):
        rest = iter(new)
        return "".join([*(next(rest, "") if c.isalnum() else c for c in found), *rest])
    if kind == "mail":
        if len(found) == len(new):
            return "".join(n.upper() if c.isupper() else n for c, n in zip(found, new))
        return new
    if kind.startswith(("given", "family")):
        return new.upper() if found.isupper() and len(found) > 1 else "-".join(p.capitalize() for p in new.split("-"))
    return new


def _holds(data: np.ndarray, offsets: np.ndarray, texts: list[str]) -> list[str]:
    """For every text which of the characters that patterns need it has; T: a
    form of address."""
    out = [""] * len(texts)
    marks = {"@": data == 64, "0": (data >= 48) & (data < 58), "=": data == 61, ":": data == 58}
    for mark, at in marks.items():
        where = np.unique(np.searchsorted(offsets, np.flatnonzero(at), "right") - 1)
        for i in where.tolist():
            out[i] += mark
    for i, text in enumerate(texts):
        if "AKIA" in text or "ASIA" in text:
            out[i] += "A"
        if any(t in text for t in _TITLE_STEMS):
            out[i] += "T"
    return out


#: Every title, followed by a blank or a point, holds one of these.
_TITLE_STEMS = [t + end for t in TITLES for end in (" ", ".")]


def _found(batch):
    """(place, text, entities) of the texts of a batch that have any."""
    data, offsets = words.utf8(batch.column("text"))
    texts = [t or "" for t in batch.column("text").to_pylist()]
    for i, has in enumerate(_holds(data, offsets, texts)):
        if has:
            found = detect(texts[i], has)
            if found:
                yield i, texts[i], found


def replaced(secret: bytes, text: str, spans, known: dict[tuple[str, str], tuple[int, str]]) -> str:
    """``text`` with surrogates; ``known`` has the attempt and the gender of
    (kind, value) where these are not 0 and n."""
    out, at = [], 0
    for a, b, kind, value, _ in spans:
        new = surrogate(secret, kind, value, *known.get((kind, value), (0, "n")))
        if kind == "mail":
            local, _, domain = new.rpartition("@")
            new = f"{local}@{surrogate(secret, 'domain', domain, *known.get(('domain', domain), (0, 'n')))}"
        out += [text[at:a], written(kind, text[a:b], new)]
        at = b
    return "".join(out) + text[at:]


def named(found) -> set[tuple[str, str, str]]:
    """(kind, value, gender) of the entities of a text."""
    out = {f[2:] for f in found}
    return out | {("domain", value.rpartition("@")[2], "n") for kind, value, _ in out if kind == "mail"}


def entities(docs: DataFrame) -> DataFrame:
    """(key, kind, value, gender): the different entities of each document."""

    def find(batches):
        for batch in batches:
            keys = batch.column("key").to_pylist()
            rows = [(keys[i], *entity) for i, _, found in _found(batch) for entity in named(found)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.decimal128(38, 0), pa.string(), pa.string(), pa.string()))],
                    ["key", "kind", "value", "gender"],
                )

    return docs.select(order_key().alias("key"), "text").mapInArrow(find, f"key {KEY}, kind string, value string, gender string")


def drawn(known: DataFrame, secret: bytes) -> DataFrame:
    """(kind, value, attempt, gender) with the surrogate."""
    names = ["kind", "value", "attempt", "gender"]

    def draw(batches):
        for batch in batches:
            new = [surrogate(secret, *row) for row in zip(*(batch.column(c).to_pylist() for c in names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*names, "new"])

    return known.select(*names).mapInArrow(draw, "kind string, value string, attempt int, gender string, new string")


def distinct_surrogates(found: DataFrame, secret: bytes) -> DataFrame:
    """(kind, value, attempt, gender, new): one surrogate for each entity, no
    two the same within a kind and none a real value of it."""
    told = [F.count_if(F.col("gender") == g) for g in "mf"]
    gender = F.when(told[0] > told[1], "m").when(told[1] > told[0], "f").otherwise("n")
    real = saved(found.groupBy("kind", "value").agg(gender.alias("gender")), "entities")
    known = saved(drawn(real.withColumn("attempt", F.lit(0)), secret), "drawn")
    while True:
        first = known.groupBy("kind", "new").agg(F.min("value").alias("first"))
        clash = known.join(first, ["kind", "new"]).where("value > first").select("kind", "value")
        held = real.select("kind", F.col("value").alias("new"))
        taken = known.join(held, ["kind", "new"], "left_semi").select("kind", "value")
        again = saved(clash.union(taken).distinct(), "again")
        if again.limit(1).count() == 0:
            return known
        redrawn = drawn(known.join(again, ["kind", "value"]).withColumn("attempt", F.col("attempt") + 1), secret)
        known = saved(known.join(again, ["kind", "value"], "left_anti").unionByName(redrawn), "drawn")


def replace_entities(docs: DataFrame, secret: bytes) -> DataFrame:
    """The columns of documents with surrogates in the text, and kinds, the
    kinds of the entities replaced, in order.  ``secret``: the key, at most 64
    bytes."""
    ship(docs.sparkSession)
    docs = documents(docs)
    found = saved(entities(docs), "found")
    again = distinct_surrogates(found, secret).where("attempt > 0 or gender <> 'n'").drop("new")
    again = saved(again, "redrawn")
    per = found.select("key", "kind", "value").distinct().join(again, ["kind", "value"]).groupBy("key").agg(
        F.collect_set(F.struct("kind", "value", "attempt", "gender")).alias("redrawn")
    )
    per = small(saved(per, "per_document"), rows=500_000)

    def replace(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            kinds: list[list[str]] = [[] for _ in texts]
            redrawn = batch.column("redrawn")
            for i, text, spans in _found(batch):
                known = {(r["kind"], r["value"]): (r["attempt"], r["gender"]) for r in redrawn[i].as_py() or ()}
                texts[i] = replaced(secret, text, spans, known)
                kinds[i] = [s[2].split()[0] for s in spans]
            columns = [batch.column(c) for c in DOC_COLUMNS]
            columns[1] = pa.array(texts, pa.string())
            columns[4] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kinds, pa.list_(pa.string()))], [*DOC_COLUMNS, "kinds"])

    rows = docs.withColumn("key", order_key()).join(per, "key", "left").drop("key")
    schema = ", ".join(f"{n} {t}" for n, t in DOC_COLUMNS.items()) + ", kinds array<string>"
    return rows.mapInArrow(replace, schema)
