"""Personal data by a semi-Markov conditional random field over whole spans.

Fixed patterns give the certain spans. Around digits, @ and its bracketed spellings a
semi-Markov field scores candidate segments as wholes - their digits, check sums,
grouping, neighbours - and dynamic programming chooses boundaries and kinds of a zone
jointly, with entities of bounded length. What it finds beyond the patterns, such as phone
numbers without a country code or addresses with [at], is added; certain spans stay.

The field is fitted on spans of the patterns in a bounded sample of documents, on the same spans
rewritten in the spellings that the patterns miss, and on numbers that are no personal data.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import whole_text

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits does, and takes whole runs; said so, each run is read once.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
AT = r"[\[(] ?at ?[\])]"
TRIGGER = re.compile(rf"[0-9@]|{AT}", re.I)
TOKEN = re.compile(rf"{AT}|[\[(] ?dot ?[\])]|[A-Za-z]+|[0-9]+|\s|.", re.I | re.S)
#: Documents the fit takes.
FIT_DOCS, FIT_CHARS = 2000, 20_000
#: Tokens and characters an entity of the field may have, the characters between triggers of one zone, and around it.
LONGEST, LONGEST_CHARS, GAP, AROUND = 24, 96, 12, 48

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit of a number is right."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The certain spans, by kind and then start; kinds may overlap each other."""
    found: list[Span] = []
    after = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        match = EMAIL.match(text, start) if start < at else None
        if match:
            found.append(("email", start, match.end()))
            after = match.end()
        at = text.find("@", max(at + 1, after))
    if DIGITS.search(text) is None:
        return found
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(DIGITS.findall(m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def zones(text: str) -> list[tuple[int, int]]:
    """The stretches that may hold personal data: around triggers, out to white space within AROUND."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        if out and m.start() - out[-1][1] <= GAP:
            out[-1] = (out[-1][0], m.end())
        else:
            out.append((m.start(), m.end()))
    wide: list[tuple[int, int]] = []
    for start, end in out:
        least, most = max(0, start - AROUND), min(len(text), end + AROUND)
        while start > least and not text[start - 1].isspace():
            start -= 1
        # One more word, which may be the name before a bracketed sign.
        word = start - 1
        while word > least and not text[word - 1].isspace():
            word -= 1
        start = max(word, 0) if start > least else start
        while end < most and not text[end].isspace():
            end += 1
        word = end + 1
        while word < most and not text[word].isspace():
            word += 1
        end = min(word, len(text))
        if wide and start <= wide[-1][1]:
            wide[-1] = (wide[-1][0], max(end, wide[-1][1]))
        else:
            wide.append((start, end))
    return wide


_AT_SIGN = re.compile(rf"@|{AT}", re.I)
_DOTTED = re.compile(r"(?:\.|[\[(] ?dot ?[\])])\s?[A-Za-z]{2,}$", re.I)
_ADDRESS = re.compile(rf"^[A-Za-z0-9._%+-]+ ?(?:@|{AT}) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]+)+$", re.I)
_NUMBER = re.compile(r"^[+(]?[0-9][0-9 ().-]*[0-9]$")
_TIME = re.compile(r"[0-9]{1,4}[-./][0-9]{1,2}[-./][0-9]{1,4}|[0-9]:[0-9]|,")


def features(text: str, start: int, end: int) -> list[str]:
    """What a candidate is like as a whole, and what stands next to it; empty if it can be no entity."""
    span = text[start:end]
    digits = DIGITS.findall(span)
    at = _AT_SIGN.search(span)
    if not at and (len(digits) < 4 or not _NUMBER.match(span)):
        return []
    out = ["any"]
    before, after = text[start - 1 : start], text[end : end + 1]
    if before and (before.isalnum() or before in "+_@#$=/\"'.,:-"):
        out.append("glued-left:" + ("word" if before.isalnum() else before))
    if after and (after.isalnum() or after in "_@=/%"):
        out.append("glued-right")
    if DIGITS.match(text[end + 1 : end + 2]) and after in " -.,:()":
        out.append("goes-on")
    if start > 1 and DIGITS.match(text[start - 2]) and before in " -.,:()":
        out.append("went-on")
    if at:
        out += ["at", "address" if _ADDRESS.match(span) else "at-loose", "dotted" if _DOTTED.search(span) else "undotted"]
        if at[0] != "@":
            out.append("bracket")
        return out
    n = len(digits)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    out += [f"digits:{min(n, 20)}", f"groups:{min(len(groups), 6)}", "shape:" + "-".join(map(str, groups[:6]))]
    out.append("seps:" + "".join(sorted(set(re.sub(r"[0-9]", "", span)))))
    if n >= 13:
        out.append("luhn" if luhn("".join(digits)) else "no-luhn")
    if span[0] in "+(":
        out.append("starts:" + span[0])
    if len(groups) == 4 and span.count(".") == 3 and all(map(_octet, span.split("."))):
        out.append("octets")
    if 8 <= n <= 15 and groups[-1] in (3, 4) and len(groups) >= 3:
        out.append("grouped-number")
    if _TIME.search(span):
        out.append("date-like")
    return out


class Field:
    """Weights of a semi-Markov conditional random field; kind "" is what is outside, with score 0 per token."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def segments(self, text: str, start: int, end: int):
        """Token ends of a zone and, by token position of the end, the candidates: first token, kind, features."""
        edges = [start] + [m.end() for m in TOKEN.finditer(text, start, end)]
        ending = defaultdict(list)
        for i in range(len(edges) - 1):
            first = text[edges[i]]
            if not (first.isalnum() or first in "+("):
                continue
            for j in range(i + 1, min(len(edges), i + LONGEST + 1)):
                last = text[edges[j] - 1]
                if edges[j] - edges[i] > LONGEST_CHARS:
                    break
                if last.isascii() and last.isalnum():
                    found = features(text, edges[i], edges[j])
                    if found:
                        kinds = ("email",) if "at" in found else ("ip", "card", "phone")
                        ending[j] += [(i, kind, found) for kind in kinds]
        return edges, ending

    def score(self, kind: str, found: list[str]) -> float:
        return sum(self.weights.get((kind, f), 0.0) for f in found)

    def best(self, text: str, start: int, end: int) -> list[Span]:
        """The entities of the best segmentation of a zone."""
        edges, ending = self.segments(text, start, end)
        if not ending:
            return []
        best, back = [0.0] * len(edges), [None] * len(edges)
        for j in range(1, len(edges)):
            best[j] = best[j - 1]
            for i, kind, found in ending.get(j, ()):
                value = best[i] + self.score(kind, found)
                if value > best[j]:
                    best[j], back[j] = value, (i, kind)
        out, j = [], len(edges) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((kind, edges[i], edges[j]))
                j = i
        return out[::-1]

    def gradient(self, text: str, start: int, end: int, truth: set[Span]) -> dict[tuple[str, str], float]:
        """Of the log-likelihood of a zone: counts of features in the truth less the expected ones, by forward and backward sums."""
        edges, ending = self.segments(text, start, end)
        n = len(edges)
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        scored = {j: [(i, kind, found, self.score(kind, found)) for i, kind, found in c] for j, c in ending.items()}
        ahead = [0.0] * n
        for j in range(1, n):
            ahead[j] = ahead[j - 1]
            for i, _, _, value in scored.get(j, ()):
                ahead[j] = add(ahead[j], ahead[i] + value)
        behind = [float("-inf")] * n
        behind[-1] = 0.0
        for j in range(n - 1, 0, -1):
            behind[j - 1] = add(behind[j - 1], behind[j]) if behind[j - 1] > float("-inf") else behind[j]
            for i, _, _, value in scored.get(j, ()):
                reached = behind[j] + value
                behind[i] = add(behind[i], reached) if behind[i] > float("-inf") else reached
        change: dict[tuple[str, str], float] = defaultdict(float)
        for j, candidates in scored.items():
            for i, kind, found, value in candidates:
                part = ((kind, edges[i], edges[j]) in truth) - math.exp(ahead[i] + value + behind[j] - ahead[-1])
                if abs(part) > 1e-6:
                    for f in found:
                        change[kind, f] += part
        return change

    @classmethod
    def fit(cls, texts: list[str], seed: int = 42, rounds: int = 4) -> Field:
        """Weights from examples made of the texts, by stochastic gradient steps with shrinking."""
        examples = training_examples(texts, seed)
        field, squares, rng = cls(), defaultdict(float), random.Random(seed)
        for _ in range(rounds):
            rng.shuffle(examples)
            for text, truth in examples:
                for start, end in zones(text):
                    for key, part in field.gradient(text, start, end, truth).items():
                        part -= 0.002 * field.weights.get(key, 0.0)
                        squares[key] += part * part
                        field.weights[key] = field.weights.get(key, 0.0) + 0.5 * part / (1e-6 + squares[key]) ** 0.5
        return field

    def spans(self, text: str) -> list[Span]:
        """All spans of a text: the certain ones, and those of the field that overlap none of them, by kind, then start."""
        if not text:
            return []
        found = base_spans(text)
        taken = sorted((s, e) for _, s, e in found)
        more = []
        for start, end in zones(text):
            inside = [t for t in taken if t[0] < end and t[1] > start] if taken else []
            more += [x for x in self.best(text, start, end) if not any(s < x[2] and e > x[1] for s, e in inside)]
        return sorted({*found, *more}, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def training_examples(texts: list[str], seed: int) -> list[tuple[str, set[Span]]]:
    """Short texts and their spans: certain ones as found, rewritten, and numbers that are none."""
    rng = random.Random(seed)
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    filler = lambda: rng.choice([w for w in rng.choice(texts).split()[:200] if w.isalpha()] or ["and"]) if texts else "and"
    out: list[tuple[str, set[Span]]] = []

    def put(kind: str | None, value: str) -> None:
        left = filler() + rng.choice([" ", " ", ": ", ", "])
        out.append((left + value + rng.choice([" ", ". ", ", "]) + filler(), {(kind, len(left), len(left) + len(value))} if kind else set()))

    found = []
    for text in texts:
        spans = base_spans(text)
        found += [(kind, text[s:e]) for kind, s, e in spans]
        # The numbers of real texts that no pattern takes.
        for start, end in zones(text)[:3]:
            if not any(s < end and e > start for _, s, e in spans):
                out.append((text[start:end], set()))
    rng.shuffle(found)
    # Something of each kind, whatever the texts hold.
    found = found[:1500] + [("email", f"{filler().lower()}.{digit(2)}@{filler().lower()}.{rng.choice(['com', 'org', 'net'])}") for _ in range(150)]
    found += [("phone", f"+{digit(1)} ({digit(3)}) {digit(3)}-{digit(4)}") for _ in range(150)]
    found += [("ip", ".".join(str(rng.randrange(256)) for _ in range(4))) for _ in range(150)]
    for _ in range(150):
        number = digit(15)
        found.append(("card", number + next(d for d in "0123456789" if luhn(number + d))))
    for kind, value in found:
        put(kind, value)
        digits = "".join(DIGITS.findall(value))
        if kind == "email":
            sign, dot = rng.choice(["[at]", "(at)", " [at] ", " (at) "]), rng.choice([".", ".", " [dot] ", "[dot]"])
            name, _, host = value.partition("@")
            put("email", name + sign + host.replace(".", dot))
        elif kind == "phone" and len(digits) >= 10:
            a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
            put("phone", rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]))
        elif kind == "card" and len(digits) == 16:
            put("card", rng.choice(" -").join(digits[i : i + 4] for i in (0, 4, 8, 12)))
    year = lambda: str(rng.randrange(1900, 2100))
    two = lambda most: f"{rng.randrange(1, most):02d}"
    for _ in range(400):
        put(None, rng.choice([
            f"{year()}-{two(13)}-{two(29)}", f"{two(29)}.{two(13)}.{year()}", f"{two(24)}:{two(60)}:{two(60)}", digit(rng.randrange(4, 16)),
            f"{rng.randrange(10)}.{rng.randrange(10)}.", f"{digit(3)},{digit(3)}.{digit(2)}", f"{year()}-{year()}", f"{digit(4)} {digit(4)}",
            f"{digit(2)}.{digit(2)}", f"{digit(3)}-{digit(1)}-{digit(5)}-{digit(3)}-{digit(1)}", f"{digit(9)}-{digit(9)}", f"{year()}, {year()}", f"{digit(3)} {digit(3)} {digit(3)}",
        ]))
        number = digit(16)
        put(None, number if not luhn(number) else digit(5))
    return out


def fit(docs: DataFrame) -> Field:
    """A field from up to FIT_DOCS different texts with digits or @, of up to FIT_CHARS characters; the choice depends on the texts alone.

    The hashes that are chosen come first, so that only the chosen texts leave their tasks.
    """
    short = docs.select("text", F.xxhash64("text").alias("draw")).where((F.length("text") <= FIT_CHARS) & F.col("text").rlike("[0-9@]"))
    draws = [r.draw for r in short.select("draw").distinct().orderBy("draw").limit(FIT_DOCS).collect()]
    if not draws:
        return Field.fit([])
    chosen = short.where(F.col("draw") <= draws[-1]).groupBy("draw").agg(F.min("text").alias("text"))
    return Field.fit([r.text for r in sorted(chosen.collect())])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts of the certain spans by kind, base_sha256 of their list, and all spans.

    `docs` has doc_id and text; other columns are ignored, repeated rows are rows like any
    other. A NULL or empty text has no spans. Places count code points. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # as large as the list of features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts, digests, lists = [], [], []
                for text in part.column(1).to_pylist():
                    base = base_spans(text)
                    counts.append([sum(s[0] == kind for s in base) for kind in KINDS])
                    digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                    lists.append(_listed(field.spans(text)))
                columns = [part.column(0), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(4)), pa.array(digests), pa.array(lists)]
                yield pa.record_batch(columns, ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced together, by the first one's kind."""
    out, at = [], 0
    ordered = sorted(spans, key=lambda x: (x[1], -x[2]))
    i = 0
    while i < len(ordered):
        kind, start, end = ordered[i]
        i += 1
        while i < len(ordered) and ordered[i][1] < end:
            end = max(end, ordered[i][2])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """All documents, their texts without personal data; other columns as they are, but n_chars, if there, counts anew."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            names = batch.schema.names
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t and masked(t, field.spans(t)) for t in part.column(names.index("text")).to_pylist()]
                columns = [pa.array(texts, pa.string()) if n == "text" else part.column(i) for i, n in enumerate(names)]
                yield pa.record_batch(columns, names)

    changed = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed
