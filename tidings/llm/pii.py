"""Personal data: fixed rules, and a semi-Markov conditional random field that adds spans.

The field scores whole candidate segments. A run of text that may hold an entity (digits with their
separators, or the surroundings of an at-sign) is cut into atoms: runs of digits, runs of letters,
single other characters. A segment is up to ``MAX_ATOMS`` atoms and ``MAX_CHARS`` characters, so the
dynamic program is linear in the length of a run. A segment's features look at all of it: digit count,
group pattern, separators, checksum, domain shape, its neighbours and the word before it. Boundaries
and types are chosen jointly; text outside entities is a chain of one-atom segments.

Trained in numpy on the runs of a bounded sample of documents. The rules label them; copies in which
an entity is written in a way that the rules miss (no plus sign, "(at)" for the sign) keep its label,
so the field learns to find those. A span is added where its marginal probability reaches ``LEAST``
and it overlaps no span of the rules.

Defined cases: a NULL or empty text has no spans; each row of a repeated document has its own result;
positions count code points; texts and words of any length take time in proportion to their length;
with no entity in the sample, only the rules speak; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import table

KINDS = ["email", "ip", "card", "phone"]
MAX_ATOMS, MAX_CHARS = 24, 128
LEAST = 0.9
# The rules. Lookbehinds and possessive repetition only spare starts that cannot match.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

TRIGGER = re.compile(r"[0-9@]|[(\[][aA][tT][)\]]")
NUMBER_RUN = re.compile(r"(?<![0-9])[+(]{0,2}[0-9][0-9 ().+-]*+")
AT = re.compile(r"@|[(\[][aA][tT][)\]]")
ATOM = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
NUMERIC = re.compile(r"[+(]{0,2}[0-9][0-9 ().+-]*[0-9]")
MAILBOX = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*(?:@|[(\[][aA][tT][)\]])[A-Za-z0-9-]+(?:(?:\.|[(\[][dD][oO][tT][)\]])[A-Za-z0-9-]+)+")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def part_fits(part: str) -> bool:
    """At most 255, whatever its length in leading zeros."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed rules, by kind and start."""
    found, end = [], 0
    for m in DOMAIN.finditer(text):
        # The match starts at the first character of the run before the sign, but after the last match.
        start = m.start()
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        if start < m.start():
            found.append((0, start, m.end()))
            end = m.end()
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(map(part_fits, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


# --- runs and candidate segments ---------------------------------------------------------------

def runs(text: str) -> list[tuple[int, int]]:
    """The stretches of a text in which an entity may lie."""
    spots = [(m.start(), m.end()) for m in NUMBER_RUN.finditer(text) if sum("0" <= c <= "9" for c in m[0]) >= 7 or m[0].count(".") >= 3]
    for m in AT.finditer(text):
        low, high = m.start(), m.end()
        while low > 0 and m.start() - low < MAX_CHARS and not text[low - 1].isspace():
            low -= 1
        while high < len(text) and high - m.end() < MAX_CHARS and not text[high].isspace():
            high += 1
        spots.append((low, high))
    merged: list[tuple[int, int]] = []
    for low, high in sorted(spots):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def char_class(c: str) -> str:
    return "" if not c else "d" if c.isdigit() else "a" if c.isalpha() else "s" if c.isspace() else c if c in "+-.@()" else "p"


def features(kind: int, segment: str, before: str, after: str, word: str) -> list[str]:
    """Features of a whole segment as an entity of one kind."""
    out = [f"{kind}|bias", f"{kind}|<{char_class(before)}", f"{kind}|>{char_class(after)}", f"{kind}|w={word}"]
    if kind == 0:
        sign = AT.search(segment)
        domain = segment[sign.end():]
        labels = re.split(r"\.|[(\[]dot[)\]]", domain, flags=re.I)
        out += [f"0|sign={sign[0].lower()}", f"0|labels={min(len(labels), 5)}", f"0|top={labels[-1].isalpha()},{min(len(labels[-1]), 4)}", f"0|local={min(sign.start(), 6)}"]
        return out
    digits = digits_of(segment)
    groups = [len(g) for g in re.findall("[0-9]+", segment)]
    marks = "".join(sorted(set(re.findall(r"[^0-9]", segment))))
    out += [f"{kind}|n={len(digits)}", f"{kind}|marks={marks}", f"{kind}|groups={','.join(map(str, groups[:6]))}", f"{kind}|plus={segment[0]}", f"{kind}|first={segment[0] == '0'}"]
    if kind == 1:
        parts = segment.split(".")
        out.append(f"1|parts={len(parts) == 4 and all(p.isdigit() and part_fits(p) for p in parts)}")
    if kind == 2:
        out.append(f"2|luhn={luhn(digits)},{len(digits)}")
    return out


def candidates(text: str, low: int, high: int) -> tuple[list[int], list[tuple[int, int, int, list[str]]]]:
    """Atom edges of a run, and its segments (first atom, atom after the last, kind, features)."""
    edges = [low + m.start() for m in ATOM.finditer(text[low:high])] + [high]
    n, found = len(edges) - 1, []
    for i in range(n):
        c = text[edges[i]]
        if not (c.isalnum() or c in "+("):
            continue
        word = re.search(r"([^\W\d_]*)\W*$", text[max(0, edges[i] - 24):edges[i]])[1].lower()
        for j in range(i + 1, min(n, i + MAX_ATOMS) + 1):
            if edges[j] - edges[i] > MAX_CHARS:
                break
            segment = text[edges[i]:edges[j]]
            if segment[-1].isspace() or not segment[-1].isalnum():
                continue
            before, after = text[max(0, edges[i] - 1):edges[i]], text[edges[j]:edges[j] + 1]
            if NUMERIC.fullmatch(segment):
                count = sum("0" <= c <= "9" for c in segment)
                kinds = ([1] if segment.count(".") == 3 and 4 <= count <= 12 else []) + ([2] if 12 <= count <= 19 else []) + ([3] if 7 <= count <= 15 else [])
            else:
                kinds = [0] if MAILBOX.fullmatch(segment) else []
            found += [(i, j, k, features(k, segment, before, after, word)) for k in kinds]
    return edges, found


# --- the field -------------------------------------------------------------------------------

def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def marginals(weights: dict[str, float], n: int, segments: list[tuple[int, int, int, list[str]]]) -> tuple[list[float], float]:
    """The probability of each segment, summed over all segmentations of n atoms, and log Z.

    Segments outside entities are single atoms with score 0; two entities that touch pay ``touch``.
    """
    scores = [sum(weights.get(f, 0.0) for f in fs) for _, _, _, fs in segments]
    touch = weights.get("touch", 0.0)
    by_end, by_start = defaultdict(list), defaultdict(list)
    for k, (i, j, _, _) in enumerate(segments):
        by_end[j].append(k)
        by_start[i].append(k)
    out_f, in_f = [-math.inf] * (n + 1), [-math.inf] * (n + 1)  # the last segment was outside / an entity
    out_f[0] = 0.0
    for at in range(1, n + 1):
        out_f[at] = _log_sum([out_f[at - 1], in_f[at - 1]])
        if by_end[at]:
            in_f[at] = _log_sum([scores[k] + _log_sum([out_f[segments[k][0]], in_f[segments[k][0]] + touch]) for k in by_end[at]])
    after_out, after_in = [0.0] * (n + 1), [0.0] * (n + 1)  # what follows, given the last segment
    for at in range(n - 1, -1, -1):
        entity = [scores[k] + after_in[segments[k][1]] for k in by_start[at]]
        after_out[at] = _log_sum([after_out[at + 1], *entity])
        after_in[at] = _log_sum([after_out[at + 1], *[e + touch for e in entity]])
    total = _log_sum([out_f[n], in_f[n]])
    probability = [
        math.exp(scores[k] + _log_sum([out_f[i], in_f[i] + touch]) + after_in[j] - total) for k, (i, j, _, _) in enumerate(segments)
    ]
    return probability, total


def best_path(weights: dict[str, float], n: int, segments: list[tuple[int, int, int, list[str]]]) -> list[int]:
    """The segments of the best joint choice of boundaries and types."""
    by_end = defaultdict(list)
    for k, (_, j, _, _) in enumerate(segments):
        by_end[j].append(k)
    touch = weights.get("touch", 0.0)
    best = [(0.0, -math.inf)]  # the best score that ends outside / with an entity
    back: list[int | None] = [None]
    for at in range(1, n + 1):
        inside, used = -math.inf, None
        for k in by_end[at]:
            i, _, _, fs = segments[k]
            value = sum(weights.get(f, 0.0) for f in fs) + max(best[i][0], best[i][1] + touch)
            if value > inside:
                inside, used = value, k
        best.append((max(best[at - 1]), inside))
        back.append(used)
    path, at, entity = [], n, best[n][1] > best[n][0]
    while at > 0:
        if entity:
            path.append(back[at])
            at = segments[back[at]][0]
            entity = best[at][1] + touch > best[at][0]
        else:
            at -= 1
            entity = best[at][1] > best[at][0]
    return path[::-1]


def variants(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """A text with its spans, and copies with one entity each written in another way."""
    out = [(text, spans)]
    for kind, start, end in spans:
        entity, others = text[start:end], []
        if kind == 3:
            bare = re.sub(r"^\+[0-9]+[ .-]*", "", entity)
            others = [bare] if bare and bare[0] in "(0123456789" and len(digits_of(bare)) >= 9 and not bare.isdigit() else []
        elif kind == 0:
            others = [entity.replace("@", "(at)"), entity.replace("@", "[at]").replace(".", "[dot]")]
        for other in others:
            moved = [(k, s + (len(other) - len(entity)) * (s >= end), e + (len(other) - len(entity)) * (e >= end)) for k, s, e in spans]
            out.append((text[:start] + other + text[end:], moved))
    return out


def train(texts: list[str], epochs: int = 6, rate: float = 0.5, decay: float = 1e-4) -> dict[str, float]:
    """Weights that make the labelled segments likely (Adagrad on the log-likelihood of each run)."""
    examples = []
    for text in texts:
        for version, spans in variants(text, rule_spans(text)):
            for low, high in runs(version):
                edges, segments = candidates(version, low, high)
                gold = {(k, s, e) for k, s, e in spans}
                hits, taken = [], -1
                for k, (i, j, kind, _) in enumerate(segments):
                    if (kind, edges[i], edges[j]) in gold and edges[i] >= taken:
                        hits.append(k)
                        taken = edges[j]
                if segments:
                    examples.append((len(edges) - 1, segments, set(hits)))
    weights: dict[str, float] = defaultdict(float)
    squares: dict[str, float] = defaultdict(lambda: 1e-3)
    if not any(hits for _, _, hits in examples):
        return {}
    for _ in range(epochs):
        for n, segments, hits in examples:
            probability, _ = marginals(weights, n, segments)
            slope: dict[str, float] = defaultdict(float)
            for k, (_, _, _, fs) in enumerate(segments):
                d = (k in hits) - probability[k]
                if abs(d) > 1e-4:
                    for f in fs:
                        slope[f] += d
            for f, d in slope.items():
                d -= decay * weights[f]
                squares[f] += d * d
                weights[f] += rate * d / math.sqrt(squares[f])
    return dict(weights)


def all_spans(text: str, weights: dict[str, float], least: float = LEAST) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The spans of the rules, and those that the field adds."""
    if not TRIGGER.search(text):
        return [], []
    base, added = rule_spans(text), []
    if weights:
        edges_of_base = sorted((s, e) for _, s, e in base)
        for low, high in runs(text):
            edges, segments = candidates(text, low, high)
            if not segments:
                continue
            probability, _ = marginals(weights, len(edges) - 1, segments)
            for k in best_path(weights, len(edges) - 1, segments):
                i, j, kind, _ = segments[k]
                if probability[k] >= least:
                    added.append((kind, edges[i], edges[j]))
        added = _apart(added, edges_of_base)
    return base, added


def _apart(spans: list[tuple[int, int, int]], others: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The spans (in order, disjoint) that overlap none of the others (in order of start)."""
    out, k = [], 0
    reach = -1  # the furthest end among the others that start before the span's end
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        while k < len(others) and others[k][0] < end:
            reach = max(reach, others[k][1])
            k += 1
        if reach <= start:
            out.append((kind, start, end))
    return out


# --- documents -------------------------------------------------------------------------------

def fit(docs: DataFrame, sample_docs: int = 400, slice_chars: int = 4000) -> dict[str, float]:
    """Train on at most ``sample_docs`` documents that hold a digit or an at-sign, by the hash of doc_id.

    Of a long text, the ``slice_chars`` characters around its first sign are used.
    """
    holds = F.rlike(F.col("text"), F.lit(r"\+[0-9]|@|[0-9]{7}|[0-9]\.[0-9]+\."))
    there = docs.where(holds).count()
    share = 2.0 * sample_docs / max(there, 1)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    at = F.regexp_instr("text", F.lit(r"[0-9]{3}|@"))
    piece = F.substring("text", F.greatest(F.lit(1), at - slice_chars // 2), F.lit(slice_chars))
    drawn = docs.where((place < share) & holds).select(place.alias("place"), piece.alias("piece"))
    rows = sorted(drawn.collect(), key=lambda r: (r["place"], r["piece"]))  # about 2 * sample_docs rows
    return train([r["piece"] for r in rows[:sample_docs]])


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find_personal_data(docs: DataFrame, weights: dict[str, float], keep: list[str]) -> DataFrame:
    """One row per document: counts by the rules, the digest of their spans, all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # features of at most sample_docs documents
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = source.select(*keep).schema
    for name in KINDS:
        schema = schema.add(f"n_{name}", "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            counts, digests, lists = [[] for _ in KINDS], [], []
            for value in batch.column("text"):
                base, added = all_spans(value.as_py() or "", shared.value)
                for k, column in enumerate(counts):
                    column.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest() if base else empty)
                lists.append(_listed(sorted(base + added)))
            arrays = [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests, pa.string()), pa.array(lists, pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *arrays], names=schema.names)

    return source.mapInArrow(run, schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return find_personal_data(docs, fit(docs), ["doc_id"])
