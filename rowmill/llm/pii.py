"""Personal data: base patterns, and more spans from a semi-Markov conditional random field.

Base spans are exact: the leftmost non-overlapping matches of a kind's pattern that pass its test, in code
points. The field adds spans that the patterns miss, such as numbers in groups or without their prefix.

The field works on islands, runs of chunks (text between blanks) around a digit or `@`; chunks outside any
island can only be `other`, so leaving them out changes nothing. A segment is one to `LONGEST` chunks with one
label. Its score comes from features of the whole span: its shape, its numbers of digits and groups, the
test of its kind, the words before it. Dynamic programming over all segmentations, with segments bounded
by LONGEST, gives the likelihood while learning and the best boundaries and types together while finding.

Weights are learned from a sample of documents (`SAMPLE` in expectation, by a hash of the id): the base spans
of their islands are the labels, and the same islands with their spans rewritten (grouped digits, other
separators, a missing prefix) teach the field what the patterns miss. Without any base span nothing is added.

Defined cases: NULL and empty texts have no span; equal rows give equal rows; an empty table gives an empty
result; of equal texts all have the same spans. Input columns are carried; those named as a result are
replaced. Added spans never overlap base spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 3000  # documents
ISLANDS = 1500  # islands to learn from
LONGEST = 6  # chunks of a segment
BLOCK = 2048  # chunks of an island whose scores are held at a time
AROUND = 2  # chunks before and after that belong to an island
EPOCHS = 6
SURE = 0.9  # probability that a found segment must have
FEATURES = 1 << 14

# The kinds, in the order of the report.
KINDS = ("email", "ip", "card", "phone")
OTHER = "other"
LABELS = (OTHER, *KINDS)
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

# The patterns are written so that they run in linear time on any text: no match can begin inside a
# run of digits that an earlier start has tried.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
CHUNK = re.compile(r"\S+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return re.sub("[^0-9]+", "", s)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: around each @, the run of local characters before it and a domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def passes(kind: str, s: str) -> bool:
    d = digits_of(s)
    if kind == "ip":
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in s.split(".")))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return kind != "phone" or 9 <= len(d) <= 15


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", b, e) for b, e in emails(text)]
    if DIGIT.search(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if passes(kind, m[0])]
    return out


def islands(text: str) -> list[list[tuple[int, int]]]:
    """Chunks (start, end) without surrounding punctuation, in runs around a digit or @."""
    if "@" not in text and not DIGIT.search(text):
        return []
    chunks = [(m.start(), m.end()) for m in CHUNK.finditer(text)]
    live = [k for k, (b, e) in enumerate(chunks) if "@" in text[b:e] or DIGIT.search(text, b, e)]
    out: list[list[int]] = []
    for k in live:
        low, high = max(k - AROUND, 0), min(k + AROUND, len(chunks) - 1)
        if out and low <= out[-1][1] + 1:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [[trimmed(text, *c) for c in chunks[low : high + 1]] for low, high in out]


def trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    """Without quotes, commas and stops around it; brackets stay, as they belong to numbers."""
    while begin < end - 1 and text[begin] in "\"'<[{,;:":
        begin += 1
    while end > begin + 1 and text[end - 1] in "\"'>]},;:.!?":
        end -= 1
    return begin, end


@lru_cache(maxsize=1 << 16)
def bucket(name: str) -> int:
    h = 0
    for c in name:
        h = (h * 1000003 + ord(c)) & 0xFFFFFFFF
    return h % FEATURES


def shape(s: str) -> str:
    """Letters as a, digits as 9, runs cut to four."""
    s = re.sub(r"[^\W\d_]", "a", re.sub("[0-9]", "9", s))
    return re.sub(r"(.)\1{3,}", r"\1\1\1\1", s)[:40]


def features(text: str, chunks: list[tuple[int, int]], i: int, j: int) -> list[int]:
    """Features of the segment of chunks i to j - 1.

    Shapes, group sizes, marks and the chunk before are cut to bounded names; they describe a segment, and no
    text is left out of the search by it.
    """
    begin, end = chunks[i][0], chunks[j - 1][1]
    s, d = text[begin:end], digits_of(text[begin:end])
    groups = re.findall("[0-9]+", s)
    names = [f"shape {shape(s)}", f"chunks {j - i}", f"digits {len(d)}", f"groups {len(groups)}"]
    names.append("sizes " + " ".join(str(min(len(g), 9)) for g in groups[:6]))
    names.append("marks " + "".join(sorted({c for c in s if not c.isalnum()}))[:12])
    names.append(f"letters {bool(re.search(r'[^\W\d_]', s))}")
    if d:
        names.append(f"luhn {13 <= len(d) <= 19 and luhn(d)} {13 <= len(d) <= 19}")
        names.append(f"octets {len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
        names.append(f"bare {s[:1].isdigit() and s[-1:].isdigit()} {s[:1]}")
    before = text[slice(*chunks[i - 1])].lower() if i else ""
    names.append(f"before {before[:12]}")
    return [bucket(n) for n in names]


def possible(s: str) -> list[bool]:
    """Whether a span can have each label at all: by its digits, groups and characters."""
    d, groups = digits_of(s), re.findall("[0-9]+", s)
    lettered = bool(re.search(r"[^\W\d_]", s))
    return [
        True,
        "@" in s,
        len(groups) == 4 and not lettered and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        13 <= len(d) <= 19 and not lettered and luhn(d),
        9 <= len(d) <= 15 and not re.search(r"[^\x20().+0-9/-]", s),
    ]


class Field:
    """Weights of (feature, label) and of (label, label)."""

    def __init__(self):
        self.weights = np.zeros((FEATURES, len(LABELS)))
        self.moves = np.zeros((len(LABELS), len(LABELS)))
        self.trained = False

    def segments(self, text: str, chunks: list[tuple[int, int]]) -> Iterator[tuple[tuple[int, int], list[int]]]:
        n = len(chunks)
        for i in range(n):
            for j in range(i + 1, min(i + LONGEST, n) + 1):
                if j == i + 1 or text[chunks[i][0] : chunks[j - 1][1]].count("\n") == 0:
                    yield (i, j), features(text, chunks, i, j)

    def lattice(self, text: str, chunks: list[tuple[int, int]]) -> dict[tuple[int, int], list[int]]:
        return dict(self.segments(text, chunks))

    def scores(self, text: str, chunks: list[tuple[int, int]], found: dict) -> dict[tuple[int, int], np.ndarray]:
        out = {}
        for (i, j), f in found.items():
            s = self.weights[f].sum(axis=0)
            s[~np.array(possible(text[chunks[i][0] : chunks[j - 1][1]]))] = -np.inf
            if j > i + 1:
                s[0] = -np.inf  # other chunks are segments of their own
            out[i, j] = s
        return out

    def forward(self, n: int, scores: dict) -> np.ndarray:
        alpha = np.full((n + 1, len(LABELS)), -np.inf)
        alpha[0, 0] = 0.0
        for j in range(1, n + 1):
            for i in range(max(0, j - LONGEST), j):
                if (i, j) in scores:
                    came = np.logaddexp.reduce(alpha[i][:, None] + self.moves, axis=0)
                    alpha[j] = np.logaddexp(alpha[j], came + scores[i, j])
        return alpha

    def backward(self, n: int, scores: dict) -> np.ndarray:
        beta = np.full((n + 1, len(LABELS)), -np.inf)
        beta[n] = 0.0
        for i in range(n - 1, -1, -1):
            for j in range(i + 1, min(i + LONGEST, n) + 1):
                if (i, j) in scores:
                    beta[i] = np.logaddexp(
                        beta[i], np.logaddexp.reduce(self.moves + (scores[i, j] + beta[j])[None, :], axis=1)
                    )
        return beta

    def learn(self, text: str, chunks: list, gold: list[tuple[int, int, int]], rate: float) -> None:
        """One gradient step of the log-likelihood; gold: (i, j, label) of every segment."""
        found = self.lattice(text, chunks)
        if any((i, j) not in found for i, j, _ in gold):
            return
        n, scores = len(chunks), self.scores(text, chunks, found)
        if any(not np.isfinite(scores[i, j][label]) for i, j, label in gold):
            return
        alpha, beta = self.forward(n, scores), self.backward(n, scores)
        whole = np.logaddexp.reduce(alpha[n])
        before = 0
        for i, j, label in gold:
            np.add.at(self.weights[:, label], found[i, j], rate)
            self.moves[before, label] += rate
            before = label
        for (i, j), f in found.items():
            came = alpha[i][:, None] + self.moves
            p = np.exp(came + (scores[i, j] + beta[j])[None, :] - whole)
            np.add.at(self.weights, f, -rate * p.sum(axis=0)[None, :])
            self.moves -= rate * p

    def ending(self, text: str, chunks: list[tuple[int, int]], first: int, last: int) -> np.ndarray:
        """Scores of the segments that end with chunks first to last - 1: [end, place of the beginning, label].

        The last place is the end chunk alone, the one before begins a chunk earlier, and so on. Segments of
        several chunks that no label allows have no features and score -inf, as do those across lines.
        """
        out = np.full((last - first, LONGEST, len(LABELS)), -np.inf)
        for j in range(first + 1, last + 1):
            for i in range(j - 1, max(0, j - LONGEST) - 1, -1):
                s = text[chunks[i][0] : chunks[j - 1][1]]
                if j > i + 1 and "\n" in s:
                    break
                allowed = np.array(possible(s))
                if j > i + 1:
                    allowed[0] = False  # other chunks are segments of their own
                if allowed.any():
                    own = self.weights[features(text, chunks, i, j)].sum(axis=0)
                    out[j - 1 - first, LONGEST - (j - i)] = np.where(allowed, own, -np.inf)
        return out

    def find(self, text: str, chunks: list[tuple[int, int]]) -> list[Span]:
        """The best segmentation's segments of a kind whose probability is at least SURE.

        Scores are held for one block of chunks at a time, and computed again on the way back; what is kept
        of an island are the sums and the back pointers, a few numbers per chunk.
        """
        n, kinds = len(chunks), len(LABELS)
        held: dict[int, np.ndarray] = {}

        def scores(j: int) -> np.ndarray:
            first = (j - 1) // BLOCK * BLOCK
            if first not in held:
                held.clear()
                held[first] = self.ending(text, chunks, first, min(first + BLOCK, n))
            return held[first][j - 1 - first]

        # Row j + LONGEST belongs to the place before chunk j; the rows before it are those it is reached from.
        best = np.full((n + 1 + LONGEST, kinds), -np.inf)
        best[LONGEST, 0] = 0.0
        alpha, beta = best.copy(), np.full_like(best, -np.inf)
        came_from = np.zeros((n + 1, kinds, 2), dtype=np.int8)
        columns = np.arange(kinds)
        for j in range(1, n + 1):
            own = scores(j)
            came = best[j : j + LONGEST, :, None] + self.moves
            value = came.max(axis=1) + own
            place = value.argmax(axis=0)
            best[j + LONGEST] = value[place, columns]
            came_from[j, :, 0], came_from[j, :, 1] = place, came[place, :, columns].argmax(axis=1)
            came = np.logaddexp.reduce(alpha[j : j + LONGEST, :, None] + self.moves, axis=1)
            alpha[j + LONGEST] = np.logaddexp.reduce(came + own, axis=0)
        path, j, k = {}, n, int(best[n + LONGEST].argmax())
        while j:
            place, before = map(int, came_from[j, k])
            if k:
                path[j] = place, k
            j, k = j - LONGEST + place, before
        if not path:
            return []
        whole = np.logaddexp.reduce(alpha[n + LONGEST])
        beta[n + LONGEST] = 0.0
        out = []
        for j in range(n, min(path) - 1, -1):
            own, after = scores(j), beta[j + LONGEST]
            if j in path:
                place, k = path[j]
                came = np.logaddexp.reduce(alpha[j + place] + self.moves[:, k])
                if np.exp(came + own[place, k] + after[k] - whole) >= SURE:
                    out.append((LABELS[k], chunks[j - LONGEST + place][0], chunks[j - 1][1]))
            # All segments that end before chunk j have been added to its row by now.
            more = np.logaddexp.reduce(self.moves[None] + (own + after)[:, None, :], axis=2)
            beta[j : j + LONGEST] = np.logaddexp(beta[j : j + LONGEST], more)
        return out[::-1]


def labelled(chunks: list[tuple[int, int]], spans: list[Span]) -> list[tuple[int, int, int]] | None:
    """Segments (i, j, label) of an island, or None if a span does not begin and end with chunks."""
    begins, ends = {c[0]: k for k, c in enumerate(chunks)}, {c[1]: k + 1 for k, c in enumerate(chunks)}
    low, high = chunks[0][0], chunks[-1][1]
    out, covered = [], set()
    for kind, b, e in spans:
        if b < high and e > low:
            i, j = begins.get(b), ends.get(e)
            if i is None or j is None or j - i > LONGEST or covered & set(range(i, j)):
                return None
            covered |= set(range(i, j))
            out.append((i, j, LABELS.index(kind)))
    out += [(k, k + 1, 0) for k in range(len(chunks)) if k not in covered]
    return sorted(out)


def rewritten(kind: str, s: str, turn: int) -> str:
    """The same item as people also write it, in one of a few ways."""
    d = digits_of(s)
    if kind == "card":
        sign = " -"[turn % 2]
        return sign.join(d[k : k + 4] for k in range(0, len(d), 4))
    if kind == "phone":
        last = d[-10:]
        if len(last) < 10:
            return s
        a, b, c = last[:3], last[3:6], last[6:]
        return (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{d[:-10] or '1'} {a} {b} {c}")[turn % 4]
    return s


def learned(texts: list[str]) -> Field:
    """A field from the base spans of islands, each text being one island with its surroundings."""
    field, lessons = Field(), []
    for turn, text in enumerate(texts):
        spans = base_spans(text)
        spans = [s for s in spans if not any(o != s and s[1] < o[2] and o[1] < s[2] and o[2] - o[1] > s[2] - s[1] for o in spans)]
        versions = [(text, spans)]
        new, moved, at = "", [], 0
        for kind, b, e in sorted(spans, key=lambda s: s[1]):
            if b < at:
                continue
            new += text[at:b]
            begin = len(new)
            new += rewritten(kind, text[b:e], turn)
            moved.append((kind, begin, len(new)))
            at = e
        if spans and new + text[at:] != text:
            versions.append((new + text[at:], moved))
        for t, own in versions:
            for chunks in islands(t):
                gold = labelled(chunks, own)
                if gold:
                    lessons.append((t, chunks, gold))
                    field.trained |= any(k for _, _, k in gold)
    for epoch in range(EPOCHS if field.trained else 0):
        order = np.random.default_rng(epoch).permutation(len(lessons))
        for k in order:
            field.learn(*lessons[k], rate=0.2 / (1 + epoch))
    return field


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans, by kind and start."""
    base = base_spans(text)
    more = []
    if field.trained:
        for chunks in islands(text):
            more += field.find(text, chunks)
    taken = sorted((b, e) for _, b, e in base)
    starts = [b for b, _ in taken]
    ends = list(np.maximum.accumulate([e for _, e in taken])) if taken else []
    added = []
    for kind, b, e in more:
        k = np.searchsorted(starts, e)  # base spans that begin before this one's end
        if not k or ends[k - 1] <= b:
            added.append((kind, b, e))
    order = {k: n for n, k in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1], s[2]))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """Learn from islands of a sample of the documents that hold a digit or @.

    The sample is about `sample` documents; of their distinct islands under 1,000 characters, up to ISLANDS by
    hash are learned from. Longer islands are searched like all others, but not learned from.
    """
    held = docs.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).rlike("[0-9@]"))
    n = held.count()
    limit = int(min(1.0, sample / max(n, 1)) * (1 << 30))
    drawn = held.where(F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < limit).select(F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(0):
                t = value.as_py()
                out += [t[c[0][0] : c[-1][1]] for c in islands(t) if c[-1][1] - c[0][0] < 1000]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["island"])

    order = F.xxhash64("island")
    cuts = drawn.mapInArrow(cut, "island string").distinct().orderBy(order, "island").limit(ISLANDS)
    return learned([r["island"] for r in cuts.collect()])


RESULTS = "base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, field: Field, text: str = "text", redact: bool = False) -> DataFrame:
    """docs with base and all spans; with redact, every span in the text replaced by its mark."""
    added = T._parse_datatype_string(RESULTS).fields
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("base", "spans")]
    schema = T.StructType([*kept, *added])
    at = [f.name for f in kept].index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_rows = lambda spans: [dict(zip(("kind", "start", "end"), s)) for s in spans]
        for batch in batches:
            base, spans, texts = [], [], []
            for value in batch.column(at):
                t = value.as_py()
                own, every = all_spans(t or "", shared.value)
                base.append(as_rows(own))
                spans.append(as_rows(every))
                texts.append(redacted(t, every) if redact and every else t)
            columns = batch.columns
            if redact:
                columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(base, kind), pa.array(spans, kind)], names=schema.names
            )

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(scan, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """Overlapping spans become one mark, that of the span that begins first (the longest of these)."""
    out, at = [], 0
    for kind, b, e in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b >= at:
            out += [text[at:b], MARKS[kind]]
        at = max(at, e)
    return "".join(out) + text[at:]


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of base spans, and all spans."""
    listed = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"),
    )
