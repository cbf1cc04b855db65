"""Operator 7 - surrogate generation for personal data.

Detected entities are replaced by keyed surrogates of the same kind and shape:

* e-mail addresses, phone and payment card numbers, IPv4 addresses, social security
  numbers, IBANs and secrets keep their format (a digit for a digit, a letter for a letter
  of the same case; card, IBAN check digits are made valid again);
* names of persons keep script (Latin or Cyrillic), and first names their gender; a full
  name and a later "Ms. Surname" share their surname's surrogate.

A surrogate is a function of (key, kind, entity, attempt) alone: every mention of an entity,
in any document and format, gets the same one (coreference).  Distinctness is checked in
Spark: the distinct entities of the corpus get their attempt-0 surrogates; where two
entities of a kind meet in one surrogate, or a surrogate is a real entity of the corpus, all
but the first try again with the next attempt, until nothing collides.  Only entities
whose attempt is not 0 have to travel back to their documents; their table is written
first, so the planner broadcasts it only when its size on disk is small and shuffles
otherwise.  All other replacements are made within the scan.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_right

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx
from shiplens.session import materialize, release

KEY = b"shiplens-surrogates"   # a parameter: production passes its own secret

# fixed values: gendered first names by script, titles by gender
FIRST = {
    "latin": {"f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Maria Laura Julia Emma "
                   "Sophie Marie Claire Lucia Carmen".split(),
              "m": "James Robert John Michael David William Richard Joseph Thomas Charles Peter Paul Martin Lukas Hans "
                   "Pierre Jean Carlos Pablo Jorge".split()},
    "cyrillic": {"f": "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана".split(),
                 "m": "Иван Сергей Алексей Дмитрий Андрей Михаил Николай Владимир".split()},
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f",
          "Sr": "m", "Sra": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "господин": "m", "госпожа": "f"}
SYLLABLES = {"latin": "ba be bri co da del fa gan har jo ken la mar mon nor pel ra ros sta ten vel win".split(),
             "cyrillic": "ба ве го да жи ка ле ми но пе ро са те ша".split()}
TAILS = {"latin": {"": ["son", "ley", "man", "field", "er"], "f": ["a", "ine", "elle"], "m": ["o", "us", "an"]},
         "cyrillic": {"": ["ов", "ин", "ский"], "f": ["ина", "ия"], "m": ["ислав", "имир"]}}

_GENDER = {n: (script, g) for script, by in FIRST.items() for g, names in by.items() for n in names}
_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
_FIRST = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]+)?"

PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)+(?<!-)"),
    "secret": re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
                         r"|(?i:pass(?:word|wd)?|pwd|secret|token|api[_-]?key)\s*[=:]\s*\"?'?[A-Za-z0-9+/_-]{8,})"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![\d.])(?:\d[ -]?){12,18}\d(?![\d])"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "phone": re.compile(r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\d.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"),
    "ip": re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"),
    "person": re.compile(rf"(?<!\w)(?:(?P<title>{_TITLE})\.?\s+(?:(?P<first>{_CAP})\s+)?(?P<last>{_CAP})"
                         rf"|(?P<first2>{_FIRST})\s+(?P<last2>{_CAP}))(?!\w)"),
}
_GROUPS, _DIGITS = re.compile(r"\d+(?:[ -]\d+)*"), re.compile(r"\d+")
_LEXICON = [w.encode() for w in [*TITLES, *_GENDER]]


def _digits(s: str) -> str:
    return re.sub(r"\D", "", s)


def luhn_ok(d: str) -> bool:
    back = [int(c) for c in d[::-1]]
    return (sum(back[0::2]) + sum(sum(divmod(2 * x, 10)) for x in back[1::2])) % 10 == 0


def _cards(text: str, free):
    """Spans of valid card numbers.

    Where a run of digit groups as a whole is none (a card next to an expiry date, a CVV,
    a count), its parts of whole groups are tried, left to right and the longest first;
    groups but the last have three digits at least, so lists of small numbers stay alone.
    """
    at = 0
    while m := PATTERNS["card"].search(text, at):
        at = m.end()
        if free(*m.span()) and luhn_ok(_digits(m.group())):
            yield m.span()
            continue
        run = _GROUPS.match(text, m.start())  # the match may end inside of a card
        groups = [g.span() for g in _DIGITS.finditer(text, m.start(), run.end())]
        for i, (a, _) in enumerate(groups):
            if a >= m.end():
                break
            ends, n = [], 0
            for x, b in groups[i:]:
                n += b - x
                if n > 19:
                    break
                if n >= 13:
                    ends.append(b)
                if b - x < 3:
                    break
            end = next((b for b in reversed(ends) if free(a, b) and luhn_ok(_digits(text[a:b]))), None)
            if end:
                yield a, end
                at = end
                break


def _iban_check(country: str, body: str) -> str:
    value = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{98 - value % 97:02d}"


def _script(name: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", name) else "latin"


def find(text: str, lettered: bool = True) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) of the parts to replace, in order, not overlapping.

    ``entity`` is the canonical form: the same for every way an entity is written.
    ``lettered`` False skips names (the caller knows that no title or first name occurs).
    """
    found: list[tuple[int, int, str, str]] = []
    taken: list[int] = []            # starts and ends of the spans so far, in order: no two overlap

    def free(a, b):
        at = bisect_right(taken, a)
        return at % 2 == 0 and (at == len(taken) or b <= taken[at])

    def take(a, b):
        at = bisect_right(taken, a)
        taken[at:at] = [a, b]
    for kind, pattern in PATTERNS.items():
        if kind == "email" and "@" not in text or kind == "person" and not lettered:
            continue
        if kind == "card":
            for a, b in _cards(text, free):
                found.append((a, b, kind, _digits(text[a:b])))
                take(a, b)
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            if not free(a, b):
                continue
            s = m.group()
            if kind == "person":
                first, last = (("first", "last") if m["last"] else ("first2", "last2"))
                gender = TITLES.get(m["title"], "") if m["title"] else ""
                if m[first]:
                    script, g = _GENDER.get(m[first], (_script(m[first]), gender))
                    found.append((*m.span(first), f"first_{g or 'm'}_{script}", m[first].lower()))
                found.append((*m.span(last), f"last_{_script(m[last])}", m[last].lower()))
            elif kind == "secret" and not s.startswith("AKIA"):
                v = re.search(r"[A-Za-z0-9+/_-]+$", s)
                found.append((a + v.start(), b, kind, v.group()))
            elif kind == "iban":
                d = s.replace(" ", "")
                if _iban_check(d[:2], d[4:]) != d[2:4]:
                    continue
                found.append((a, b, kind, d))
            else:
                found.append((a, b, kind, s.lower() if kind == "email" else _digits(s) if kind in ("phone", "ssn") else s))
            take(a, b)
    return sorted(found)


class _Stream:
    """Keyed pseudo-random numbers for one (kind, entity, attempt)."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.seed, self.n, self.pool = f"{kind}|{attempt}|{entity}".encode(), 0, b""
        self.key = key

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x % n

    def like(self, s: str, hexa: bool = False) -> str:
        """A digit for a digit, a letter for a letter of its case; other characters stay."""
        low = "abcdef" if hexa else "abcdefghijklmnopqrstuvwxyz"
        return "".join(str(self.below(10)) if c.isdigit() and c.isascii() else
                       low[self.below(len(low))] if "a" <= c <= "z" else
                       low[self.below(len(low))].upper() if "A" <= c <= "Z" else c for c in s)


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical entity."""
    r = _Stream(key, kind, entity, attempt)
    if kind == "email":
        local, _, domain = entity.partition("@")
        top = domain.rsplit(".", 1)[1]
        return f"{r.like(local)}@{r.like(domain.split('.')[0])}.example.{top}"
    if kind == "secret":
        if entity.startswith("AKIA"):
            return "AKIA" + r.like(entity[4:])
        return r.like(entity, hexa=bool(re.fullmatch("[0-9a-f]+", entity)))
    if kind == "card":
        body = entity[0] + r.like(entity[1:-1])
        return next(body + c for c in "0123456789" if luhn_ok(body + c))
    if kind == "iban":
        body = r.like(entity[4:])
        return entity[:2] + _iban_check(entity[:2], body) + body
    if kind == "ip":
        return ".".join(str(1 + r.below(223) if i == 0 else 1 + r.below(254)) for i in range(4))
    if kind in ("phone", "ssn"):
        head = max(0, len(entity) - 10) if kind == "phone" else 0  # the country code stays
        return entity[:head] + "".join(str(1 + r.below(9)) if i in (0, 3) else str(r.below(10)) for i in range(len(entity) - head))
    part, _, script = kind.rpartition("_")
    gender = part[6:] if part.startswith("first") else ""
    if gender and attempt == 0:  # listed names first; made-up ones when those are taken
        names = FIRST[script][gender]
        return names[r.below(len(names))].lower()
    tails = TAILS[script][gender]
    return "".join(SYLLABLES[script][r.below(len(SYLLABLES[script]))] for _ in range(2 + attempt // 3)) + tails[r.below(len(tails))]


def render(kind: str, mention: str, canonical: str) -> str:
    """The canonical surrogate in the format of the mention."""
    if kind in ("card", "phone", "ssn", "iban"):
        chars = iter(canonical)
        return "".join(next(chars) if c.isalnum() else c for c in mention)
    if kind.startswith(("first_", "last_")):
        return canonical.upper() if mention.isupper() else canonical[:1].upper() + canonical[1:]
    return canonical


def _named(arr: pa.Array) -> list[bool]:
    """Rows in which some word starts like a title or a listed first name."""
    pattern = "|".join(re.escape(w.decode()) for w in _LEXICON)
    return pc.match_substring_regex(arr, rf"(?:^|[^\pL])(?:{pattern})(?:$|[^\pL])").to_pylist()


def _mentions(arr: pa.Array):
    """Per row: its text and its entities; rows without digits, @ and names cost one regex."""
    arr = arr.fill_null("") if arr.null_count else arr
    maybe = pc.match_substring_regex(arr, r"[0-9@=:]").to_pylist()
    named = _named(arr)
    for i in range(len(arr)):
        if maybe[i] or named[i]:
            text = arr[i].as_py()
            yield i, text, find(text, named[i])


def _surrogater(key: bytes):
    def run(batches):
        for batch in batches:
            kind, entity, attempt = (batch.column(i) for i in range(3))
            made = [surrogate(key, k, e, a) for k, e, a in zip(kind.to_pylist(), entity.to_pylist(), attempt.to_pylist())]
            yield pa.RecordBatch.from_arrays([kind, entity, attempt, pa.array(made, pa.string())],
                                             names=["kind", "entity", "attempt", "surrogate"])
    return run


def assign(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, entity, attempt, surrogate) of the distinct ``entities`` (kind, entity), without collisions.

    Of entities of a kind that share a surrogate the smallest keeps it; a surrogate that is
    a real entity of its kind is kept by none.  Settled surrogates never change again, so
    every pass settles some of what is left.
    """
    schema = "kind string, entity string, attempt int, surrogate string"
    real = materialize(entities.select("kind", "entity").distinct())
    now = real.withColumn("attempt", F.lit(0))
    settled = None
    while True:
        made = materialize(now.mapInArrow(_surrogater(key), schema))
        # a minimum is summed map-side: entities that share a surrogate never meet in one task
        first = made.groupBy("kind", "surrogate").agg(F.min("entity").alias("first"))
        taken = real.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("taken"))
        if settled is not None:
            taken = taken.unionAll(settled.select("kind", "surrogate", F.lit(True))).distinct()
        open_ = made.join(first.join(taken, ["kind", "surrogate"], "left"), ["kind", "surrogate"]).withColumn(
            "ok", (F.col("entity") == F.col("first")) & F.col("taken").isNull())
        open_ = materialize(open_)
        done = open_.filter("ok").select("kind", "entity", "attempt", "surrogate")
        settled = done if settled is None else settled.unionAll(done)
        again = open_.filter("NOT ok").select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        release(made)
        if not again.limit(1).count():
            return settled
        now = again


def _replacer(key: bytes):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                arr = tx.column(part, "text")
                others = tx.column(part, "others")
                texts = {}
                count = [0] * part.num_rows
                for i, text, found in _mentions(arr):
                    if not found:
                        continue
                    special = {(x["kind"], x["entity"]): x["surrogate"] for x in others[i].as_py() or []}
                    out, at = [], 0
                    for a, b, kind, entity in found:
                        canonical = special.get((kind, entity)) or surrogate(key, kind, entity)
                        out += [text[at:a], render(kind, text[a:b], canonical)]
                        at = b
                    texts[i] = "".join([*out, text[at:]])
                    count[i] = len(found)
                if texts:
                    whole = arr.to_pylist()
                    for i, t in texts.items():
                        whole[i] = t
                    arr = pa.array(whole, pa.string())
                yield pa.RecordBatch.from_arrays([tx.column(part, "row"), arr.cast(pa.string()), pa.array(count, pa.int64())],
                                                 names=["row", "clean", "n_replaced"])
    return run


def _mention_rows(batches):
    """(doc_id, kind, entity) of the entities of each document, once."""
    for batch in batches:
        for part in tx.slices(batch, "text"):
            ids = tx.column(part, "doc_id").to_pylist()
            rows = sorted({(ids[i], k, e) for i, _, found in _mentions(tx.column(part, "text")) for _, _, k, e in found
                           if ids[i] is not None})
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows) if rows else ([], [], []), (pa.int64(), pa.string(), pa.string()))], names=["doc_id", "kind", "entity"])


def replace_pii(documents: DataFrame, key: bytes = KEY) -> DataFrame:
    """Rows (row, clean, n_replaced): the input row as a struct, its text with surrogates.

    Defined cases: a null text stays null, an empty one empty.  A row without doc_id is
    cleaned too, with attempt-0 surrogates where a collision was settled otherwise.
    Repeated rows get equal texts.  An empty table gives no rows.  Further columns may have
    any name.
    """
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    mentions = materialize(rows.select("doc_id", "text").mapInArrow(_mention_rows, "doc_id long, kind string, entity string"))
    moved = materialize(assign(mentions, key).filter("attempt > 0"))
    others = materialize(mentions.join(moved, ["kind", "entity"]).groupBy("doc_id").agg(
        F.collect_list(F.struct("kind", "entity", "surrogate")).alias("others")))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("clean", T.StringType()),
                           T.StructField("n_replaced", T.LongType())])
    return rows.join(others, "doc_id", "left").select("row", "text", "others").mapInArrow(_replacer(key), schema)
