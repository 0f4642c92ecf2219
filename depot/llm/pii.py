"""Personal data by weak supervision: labelers vote, their reliabilities are
estimated by expectation-maximisation, and a span classifier learns from that.

One scan of the whole texts stores, for every document, the base matches
(strict patterns) and further candidate spans (near misses, unusual notations,
names, identity numbers), each with the votes of seven labelers and hashed
features.  Everything after that reads the stored candidates only:

1. the votes of a candidate are one of 3^7 patterns, so counts by (kind,
   pattern) hold all that expectation-maximisation needs, whatever the corpus;
2. a logistic classifier over votes, shape and context words is trained on the
   posteriors of all candidates: each gradient round is a Spark job whose sums
   are integers, so reruns and lost executors change no weight;
3. candidates at or above the threshold become spans; base matches always do.

No document leaves its task and nothing is shuffled but sums.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.llm.common import byte_slices, ints, map_arrow, stored

SLICE = 4 << 20
KINDS = ["email", "ip", "card", "phone", "name", "id"]
BASE = 4                                # the first four kinds have base patterns
EMAIL, IP, CARD, PHONE, NAME, ID = range(6)
SLOTS = 1 << 12
SCALE = 1 << 20                         # gradients are summed as integers of 1/SCALE
NEAR = 60                               # characters of context on either side

LABELERS = ["pattern", "checksum", "gazetteer", "cue", "counter", "shape", "boundary"]
#: How often a vote is assumed right before any counts are seen.
_START = [0.9, 0.85, 0.7, 0.85, 0.8, 0.8, 0.8]

# ---- patterns; digit runs are taken whole, so no pattern goes back over a long run
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBERS = re.compile(r"[0-9]++(?:[ .()/-]{1,3}[0-9]++)*+")     # every match of digits and separators lies in one of these
_SPOKEN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?\(dot\) ?| ?\[dot\] ?| dot |\.)[A-Za-z0-9-]{1,63})+", re.IGNORECASE)
_SPOKEN_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,5}\)?[ ./-]{1,2}[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SURNAME = re.compile(r"(?: [A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]{1,30}){1,2}")
_SPACE = re.compile(r"[ .(),;:!?\"'\[\]<>\t\n\r]+")

# ---- fixed values: gazetteers and cue words
_GIVEN = ["Alice", "Amelia", "Andrea", "Anna", "Antoine", "Antonio", "Barbara", "Carlos", "Carmen", "Charles", "Charlotte", "Christian", "Claire", "Daniel", "David",
          "Elena", "Elizabeth", "Emily", "Emma", "Fatima", "Francisco", "Franz", "George", "Hans", "Helen", "Isabel", "James", "Javier", "Jennifer", "Jessica",
          "John", "Jose", "Joseph", "Juan", "Julia", "Karen", "Karl", "Katharina", "Klaus", "Laura", "Linda", "Louis", "Lucas", "Luis", "Manuel", "Maria",
          "Marie", "Mary", "Michael", "Mohammed", "Nathalie", "Olivia", "Patricia", "Paul", "Peter", "Pierre", "Richard", "Robert", "Sarah", "Sofia", "Susan",
          "Thomas", "Ursula", "William", "Wolfgang"]
_TITLES = ["Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora", "Don", "Doña"]
_NAMED = ["my name is", "name:", "ich heiße", "mein name ist", "je m'appelle", "me llamo", "mi nombre es", "signed by"]
_AT = [" at ", "(at)", "[at]", " AT ", "(AT)", "[AT]"]
_CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57",
          "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "212", "213", "234", "254", "351", "352", "353", "354", "358", "380", "420", "972"}
_ENDINGS = {"com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "it", "nl", "ch", "at", "eu", "mx", "ar", "co", "ca", "us", "br", "in", "jp", "cn", "ru"}
_CUES = [["mail", "contact", "write", "correo", "courriel", "kontakt"],
         ["ip", "host", "server", "address", "login", "adresse", "dirección"],
         ["card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"],
         ["phone", "tel", "call", "mobile", "cell", "fax", "telefon", "anruf", "téléphone", "teléfono", "móvil"],
         [x.lower() for x in _TITLES] + _NAMED,
         ["ssn", "social", "security", "identity", "passport", "ausweis", "dni", "identité"]]
_COUNTER = ["version", "isbn", "issn", "page", "figure", "table", "section", "chapter", "order", "invoice", "sku", "build", "release", "total", "item", "part"]
_GIVEN_SET, _HEAD = set(_GIVEN), re.compile("|".join(re.escape(x) for x in sorted(_TITLES + _GIVEN)))
_NAMED_AT = [y for x in _NAMED for y in (x, x[0].upper() + x[1:])]


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain.more, in linear time: each @ looks back
    over its own run of local characters, not beyond the last match."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, end)):
            yield start, m.end()
            last = end = m.end()
        else:
            last = end
        at = text.find("@", end)


def numbers(text: str) -> Iterator[tuple[int, int]]:
    """Runs of digits and separators that are long enough for any pattern."""
    for m in _NUMBERS.finditer(text):
        if m.end() - m.start() >= 7:
            yield m.span()


def found_at(text: str, marks: list[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of every occurrence of the marks."""
    for mark in marks:
        at = text.find(mark)
        while at >= 0:
            yield at, at + len(mark)
            at = text.find(mark, at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, each kind on its own."""
    out = [(EMAIL, s, e) for s, e in emails(text)] if "@" in text else []
    for lo, hi in numbers(text):
        for m in _IP.finditer(text, lo, hi):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
                out.append((IP, m.start(), m.end()))
        for m in _CARD.finditer(text, lo, hi):
            if m.end() - m.start() >= 12 and 12 <= len(d := digits(m.group())) <= 19 and luhn(d):
                out.append((CARD, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits(m.group())) <= 15:
                out.append((PHONE, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def more_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Further candidates, which need votes to become spans."""
    for s, e in found_at(text, _AT):
        s, e = s - (text[s] != " " and text[s - 1:s] == " "), e + (text[s] != " " and text[e:e + 1] == " ")
        if (after := _SPOKEN_DOMAIN.match(text, e)) and (before := _SPOKEN_LOCAL.search(text, max(0, s - 64), s)):
            yield EMAIL, before.start(), after.end()
    if text.count(":") >= 7:
        for m in _IP6.finditer(text):
            yield IP, m.start(), m.end()
    for lo, hi in numbers(text):
        for m in _CARD.finditer(text, lo, hi):
            if m.end() - m.start() >= 13 and 13 <= len(digits(m.group())) <= 19:
                yield CARD, m.start(), m.end()
        lo, hi = max(0, lo - 2), hi + 1             # an opening + or ( and what follows
        for m in _LOCAL_PHONE.finditer(text, lo, hi):
            if 9 <= len(digits(m.group())) <= 13:
                yield PHONE, m.start(), m.end()
        for m in _ID.finditer(text, lo, hi):
            yield ID, m.start(), m.end()
    for m in _HEAD.finditer(text):
        if (m.start() == 0 or not text[m.start() - 1].isalnum()) and (tail := _SURNAME.match(text, m.end())):
            yield NAME, m.start() if m.group() in _GIVEN_SET else m.end() + 1, tail.end()
    for _, e in found_at(text, _NAMED_AT):
        tail = _SURNAME.match(text, e)
        if tail and not text.startswith(tuple(_TITLES), tail.start() + 1):      # a title leads to its own candidate
            yield NAME, tail.start() + 1, tail.end()


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) by start and kind.  A further candidate that
    touches a base match, or one before it, gives way."""
    base = base_spans(text)
    out = [(*x, True) for x in base]
    taken, i, last = [(s, e) for _, s, e in base], 0, -1
    for kind, s, e in sorted(set(more_spans(text)), key=lambda x: (x[1], x[0], -x[2])):
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if s >= last and not any(a < e and s < b for a, b in taken[i:i + 8]):
            out.append((kind, s, e, False))
            last = e
    return sorted(out, key=lambda x: (x[1], x[0], not x[3]))


# ---- labelers: 1 for, -1 against, 0 no vote
def votes(text: str, kind: int, start: int, end: int, base: bool, words: list[str]) -> list[int]:
    """``words``: the lower-case words before the span, the nearest last."""
    span, number = text[start:end], digits(text[start:end])
    pattern = 1 if base or kind == ID else 0 if kind == NAME or "(" in span and kind == EMAIL or "[" in span else -1
    gazetteer = checksum = 0
    if kind == EMAIL:
        ending = re.split(r"[^A-Za-z0-9]+", span)[-1].lower()
        checksum, gazetteer = (1 if ending.isalpha() and len(ending) > 1 else -1), int(ending in _ENDINGS)
    elif kind == IP:
        checksum = -1 if set(span) <= set("0.:") else 1
        gazetteer = -1 if span.startswith(("0.", "127.", "255.")) else 0
    elif kind == CARD:
        checksum, gazetteer = (1 if luhn(number) else -1), (1 if number[0] in "3456" else -1)
    elif kind == PHONE:
        checksum = 1 if len(set(number)) > 2 else -1
        gazetteer = int(span[0] == "+" and any(number[:k] in _CODES for k in (1, 2, 3)))
    elif kind == NAME:
        gazetteer = int(not _GIVEN_SET.isdisjoint(span.split()))
    else:
        checksum = -1 if number[:3] in ("000", "666") or number[0] == "9" or number[3:5] == "00" or number[5:] == "0000" else 1
    near = " ".join(words)
    cue = int(any(c in near for c in _CUES[kind]) if kind == NAME else any(w.startswith(c) for w in words[-4:] for c in _CUES[kind]))
    counter = -int(any(w.startswith(c) for w in words[-2:] for c in _COUNTER))
    run = "01234567890123456789"
    shape = -1 if number and (len(set(number)) == 1 or number in run or number in run[::-1]) else 0
    beside = text[start - 1:start] + text[end:end + 1]
    boundary = -1 if any(c.isalnum() or c == "_" for c in beside) else 0
    return [pattern, checksum, gazetteer, cue, counter, shape, boundary]


_CODE = 3 ** np.arange(len(LABELERS))


def described(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, list[int]]:
    """(vote pattern, feature slots) of a candidate."""
    before = [w for w in _SPACE.split(text[max(0, start - NEAR):start].lower()) if w]
    # titles keep their full stop
    cue_words = text[max(0, start - NEAR):start].lower().split() if kind == NAME else before
    v = votes(text, kind, start, end, base, cue_words)
    after = [w for w in _SPACE.split(text[end:end + NEAR].lower()) if w]
    span = text[start:end]
    shape = re.sub("a+", "a", re.sub("9+", "9", re.sub("[A-Za-z]", "a", re.sub("[0-9]", "9", span))))[:24]
    names = [f"{kind}", f"{kind} size {min(len(span), 40) // 4}", f"{kind} shape {shape}", *(f"{kind} {name} {x}" for name, x in zip(LABELERS, v)),
             *(f"{kind} before {w}" for w in before[-3:]), *(f"{kind} after {w}" for w in after[:2])]
    return int(np.dot(np.array(v) + 1, _CODE)), sorted({zlib.crc32(x.encode()) % SLOTS for x in names})


FOUND = "array<struct<kind:int,start:long,end:long,base:boolean,votes:int,slots:array<int>>>"
_FOUND = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.int32()), ("slots", pa.list_(pa.int32()))]))
_COUNTS = [f"n_{k}" for k in KINDS[:BASE]]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, base counts, base_sha256, found) of every document, from its whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                counts, digests, found = np.zeros((BASE, part.num_rows), np.int64), [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    all_found = candidates(text or "")
                    strict = [x[:3] for x in all_found if x[3]]
                    for kind, _, _ in strict:
                        counts[kind, i] += 1
                    digests.append(hashlib.sha256(_joined(strict).encode()).hexdigest())
                    rows = []
                    for kind, s, e, base in all_found:
                        code, slots = described(text, kind, s, e, base)
                        rows.append({"kind": kind, "start": s, "end": e, "base": base, "votes": code, "slots": slots})
                    found.append(rows)
                yield pa.RecordBatch.from_arrays([part.column("id"), *map(ints, counts), pa.array(digests, pa.string()), pa.array(found, _FOUND)],
                                                 ["id", *_COUNTS, "base_sha256", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, base_sha256 string, found {FOUND}"
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


# ---- reliabilities
def reliabilities(counts: list[tuple[int, int, int]], rounds: int = 40, prior: float = 20.0) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over (kind, vote pattern, n) counts: (how often
    a labeler that votes is right, by true class and labeler; posterior by kind
    and pattern).  Not to vote says nothing about the class."""
    patterns = np.arange(3 ** len(LABELERS))
    vote = np.stack([patterns // 3 ** i % 3 for i in range(len(LABELERS))])            # 0 against, 1 none, 2 for
    n = np.zeros((len(KINDS), len(patterns)))
    for kind, code, count in counts:
        n[kind, code] += count
    start = np.array([_START, _START])
    right, share = start.copy(), np.full(len(KINDS), 0.5)
    post = np.zeros_like(n)
    for _ in range(rounds):
        log = np.zeros((2, len(patterns)))
        for y in (0, 1):
            for i in range(len(LABELERS)):
                of = np.array([1 - right[y, i], 1.0, right[y, i]])
                log[y] += np.log(of if y else of[::-1])[vote[i]]
        odds = (np.log(share) - np.log1p(-share))[:, None] + (log[1] - log[0])[None]
        post = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        share = (np.sum(n * post, axis=1) + prior / 2) / (n.sum(axis=1) + prior)
        for y, p in ((0, 1 - post), (1, post)):
            mass = (n * p).sum(axis=0)
            for i in range(len(LABELERS)):
                seen = np.bincount(vote[i], mass, 3)
                right[y, i] = (seen[2 * y] + prior * start[y, i]) / (seen[0] + seen[2] + prior)
    return right, post


@dataclass
class Model:
    weights: np.ndarray                 # a slot each
    reliability: dict[str, list[float]]  # how often each labeler's vote is right on false and on true candidates
    threshold: float


def _flat(found: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes, slots, candidate of each slot) of a column of candidate lists."""
    rows = found.flatten()
    slots = rows.field("slots")
    of = np.repeat(np.arange(len(rows)), np.diff(slots.offsets.to_numpy()))
    return rows.field("kind").to_numpy(), rows.field("votes").to_numpy(), slots.flatten().to_numpy(), of


def _probability(weights: np.ndarray, slots: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.bincount(of, weights[slots], n), -60, 60)))


def train(found: DataFrame, rounds: int = 12, rate: float = 0.7, threshold: float = 0.7) -> Model:
    """The span classifier, from all stored candidates: counts by kind and vote
    pattern for expectation-maximisation, then gradient rounds against the
    posteriors.  Without candidates all weights are 0."""
    each = found.select(F.explode("found").alias("c"))
    counts = [tuple(r) for r in each.groupBy("c.kind", "c.votes").agg(F.count(F.lit(1)).alias("n")).collect()]     # 6 kinds x 3^7 patterns at most
    right, post = reliabilities(counts)
    total = max(1, sum(c[2] for c in counts))
    weights, size = np.zeros(SLOTS), np.full(SLOTS, 1e-6)
    some = found.filter(F.size("found") > 0).select("found")
    for _ in range(rounds if counts else 0):
        now = weights.copy()

        def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(SLOTS, np.int64)
            for b in batches:
                kind, code, slots, of = _flat(b.column("found"))
                miss = _probability(now, slots, of, len(kind)) - post[kind, code]
                np.add.at(out, slots, np.rint(miss * SCALE).astype(np.int64)[of])
            there = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([ints(there), ints(out[there])], ["slot", "g"])

        step = np.zeros(SLOTS)
        for r in map_arrow(some, gradient, "slot long, g long").groupBy("slot").agg(F.sum("g").alias("g")).collect():   # SLOTS rows at most
            step[r["slot"]] = r["g"] / SCALE / total
        size += step * step
        weights -= rate * step / np.sqrt(size)
    return Model(weights, {name: right[:, i].tolist() for i, name in enumerate(LABELERS)}, threshold)


def decide(found: DataFrame, model: Model, id_col: str) -> DataFrame:
    """Documents with their spans: base matches, and candidates at or above the threshold."""
    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("found")
            rows = col.flatten()
            kind, _, slots, of = _flat(col)
            score = _probability(model.weights, slots, of, len(kind))
            base = rows.field("base").to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(base | (score >= model.threshold))
            start, end = rows.field("start").to_numpy(), rows.field("end").to_numpy()
            values = pa.StructArray.from_arrays([pa.array([KINDS[k] for k in kind[keep]], pa.string()), ints(start[keep]), ints(end[keep]), pa.array(base[keep]), pa.array(score[keep])],
                                                [f[0] for f in fields])
            offsets = np.searchsorted(keep, col.offsets.to_numpy() - col.offsets[0].as_py()).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), *(b.column(c) for c in [*_COUNTS, "base_sha256"]), pa.ListArray.from_arrays(pa.array(offsets), values)],
                                             [id_col, *_COUNTS, "base_sha256", "spans"])

    kind = found.schema["id"].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, base_sha256 string, "
              "spans array<struct<kind:string,start:long,end:long,base:boolean,score:double>>")
    return map_arrow(found, run, schema)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every
    document; a span is (kind, start, end, base, score), offsets in code points.

    A null or empty text has no spans and the digest of the empty string; null
    ids and repeated rows stay as they are, an empty table gives no rows, other
    columns do not matter.  Texts are read whole, once; the candidates are
    stored, so a lost executor reads them again.
    """
    found = stored(scan(docs, id_col, text_col), "pii-candidates")
    return decide(found, train(found, threshold=threshold), id_col)


def joined(spans="spans"):
    """Spans as kind:start:end, comma-joined (they are in order)."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def mask(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets
    (overlapping spans by the first one's).  A null text stays null; all other
    columns and rows stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text_col, SLICE):
                out = []
                for text in part.column(text_col).to_pylist():
                    pieces, at = [], 0
                    for kind, s, e, base in candidates(text or ""):
                        if base or _probability(model.weights, slots := np.array(described(text, kind, s, e, base)[1]), np.zeros(len(slots), int), 1)[0] >= model.threshold:
                            if s >= at:
                                pieces += [text[at:s], f"[{KINDS[kind].upper()}]"]
                            at = max(at, e)
                    out.append(text if text is None else "".join(pieces) + text[at:])
                i = part.schema.get_field_index(text_col)
                yield part.set_column(i, part.schema.field(i), pa.array(out, part.schema.field(i).type))

    return map_arrow(docs, run, docs.schema)
