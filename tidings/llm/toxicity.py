"""Toxicity: gradient-boosted trees over dense features of the whole text, calibrated by isotonic regression.

The features are densities and counts of three lexicons, over the whole text and in its densest stretches: a
fixed list without the words that the labelled sample refutes, words, and fragments of words (stems
that endings vary), both learned from the labelled sample by the log odds of their document frequencies; how close insults stand to the second person; and rates of capitals, punctuation, digits,
repetition and obfuscation (signs or digits in place of letters in a lexicon word, stretched letters).
Trees are grown in numpy on histograms of the features, from labelled rows and variants of them: disguised,
shortened, addressed, and put into long clean texts. The features of a labelled row come from lexicons
of the other half of the sample, and scores are calibrated on rows that the trees have not seen.

Defined cases: a NULL text is empty; an empty text is scored like any other (its features are zeros);
labels other than 0 and 1, and NULL labels, teach nothing; of several labels of a document the largest
counts; each row of a repeated doc_id is scored; with labels of one kind only, or none, every score is
the share of toxic labels (0 without labels); texts of any length are read whole.
"""

from __future__ import annotations

import random
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import remainder, table
from tidings.session import local_table

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
# Common insults of English, and the second person in four languages.
INSULTS = """asshole bastard bitch clown coward creep crap cretin cunt damn disgusting dumb dumbass fool freak fuck
fucking garbage hate hateful horrible idiot idiotic imbecile jerk kill liar loser lowlife moron nasty pathetic
pig retard revolting rubbish scum shit shut sick slut stupid sucker trash ugly useless vermin vile whore worthless
wretch""".split()
SECOND_PERSON = "you your yours yourself youre u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer usted ustedes tus ti vosotros".split()
LEET = str.maketrans("0134578@$!|", "oieastbasil")
WORD = re.compile(r"[^\W_]+")
DISGUISED = re.compile(r"\b(?=\w*[^\W\d_])[^\W_]*[0134578@$!|][^\W_]*[^\W\d_]+[0134578@$!|\w]*")
STRETCHED, STRETCHES = re.compile(r"([^\W\d_])\1\1"), re.compile(r"([^\W\d_])\1{2,}")
NEAR = 6  # words
SHORT, LONG = 50, 200  # words of the windows whose densest one counts
FEATURES = ["insults", "insult_count", "insults_short", "insults_long", "learned", "learned_short", "distinct", "beside_you", "beside_count", "nearest_you",
            "you", "disguised", "disguised_count", "stretched", "capitals", "upper_words", "exclaims", "questions", "punctuation", "digits", "symbols",
            "other_scripts", "repeats", "log_words", "mean_word", "learned_max", "stems", "stem_count", "stems_short", "stem_max"]
FRAGMENT, LONGEST_WORD = range(4, 7), 64  # characters of a fragment, of a word between spaces; longer words teach none


def plain(text: str) -> str:
    return unicodedata.normalize("NFC", text).casefold()


def word_fragments(word: str) -> set[str]:
    spaced = f" {word} "
    return {spaced[k:k + size] for size in FRAGMENT for k in range(len(spaced) - size + 1)} if len(word) <= LONGEST_WORD else set()


@dataclass
class Lexicon:
    learned: dict[str, float]  # word -> log odds
    insults: frozenset = frozenset(INSULTS)
    fragments: dict[str, float] = field(default_factory=dict)  # fragment -> log odds
    you: frozenset = frozenset(SECOND_PERSON)
    either: frozenset = field(init=False)

    def __post_init__(self):
        self.either = self.insults | frozenset(self.learned)


def _rate(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


KIND = np.zeros(256, np.uint8)  # of a byte: 1 capital, 2 other letter, 3 digit, 4 ! 5 ? 6 other punctuation of prose, 7 symbol
for _b in range(33, 127):
    _c = chr(_b)
    KIND[_b] = 1 if _c.isupper() else 2 if _c.islower() else 3 if _c.isdigit() else 4 if _c == "!" else 5 if _c == "?" else 6 if _c in ",.;:'\"()-" else 7


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The features of one whole text."""
    raw = text.encode("utf-8", "replace")
    kinds = np.bincount(KIND[np.frombuffer(raw, np.uint8)], minlength=8)
    letters = int(kinds[1] + kinds[2])
    words, disguised = _unmasked(plain(text), lexicon, bool(kinds[3] or kinds[7] or kinds[4]))
    n = len(words)
    either = lexicon.either
    hits = np.array([i for i, w in enumerate(words) if w in either], np.int64)
    sworn = np.array([words[i] in lexicon.insults for i in hits], bool)
    weights = [lexicon.learned.get(words[i], 0.0) for i in hits]
    you = np.array([i for i, w in enumerate(words) if w in lexicon.you], np.int64) if len(hits) else np.zeros(0, np.int64)
    beside, nearest = 0, NEAR * 4.0
    if sworn.any() and len(you):
        at = hits[sworn]
        k = np.searchsorted(you, at)
        gaps = np.minimum(np.abs(at - you[np.maximum(k - 1, 0)]), np.abs(at - you[np.minimum(k, len(you) - 1)]))
        beside, nearest = int((gaps <= NEAR).sum()), min(nearest, float(gaps.min()))
    insults, learned = int(sworn.sum()), len(hits) - int(sworn.sum())
    held, stem_max = _stems(words, lexicon.fragments)
    stretched = sum(1 for _ in STRETCHED.finditer(text))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    return [
        _rate(1000.0 * insults, n), float(np.log1p(insults)), _densest(hits[sworn], SHORT), _densest(hits[sworn], LONG),
        _rate(1000.0 * learned, n), _densest(hits[~sworn], SHORT), float(len({words[i] for i in hits[sworn]})),
        _rate(1000.0 * beside, n), float(np.log1p(beside)), nearest, _rate(1000.0 * len(you), n),
        _rate(1000.0 * disguised, n), float(np.log1p(disguised)), _rate(1000.0 * stretched, n),
        _rate(float(kinds[1]), letters), _rate(float(sum(w.isupper() and len(w) > 1 for w in text.split())), n) if kinds[1] > 1 else 0.0,
        _rate(1000.0 * kinds[4], len(raw)), _rate(1000.0 * kinds[5], len(raw)), _rate(float(kinds[6]), len(raw)), _rate(float(kinds[3]), len(raw)),
        _rate(float(kinds[7]), len(raw)), _rate(float(len(raw) - kinds[1:].sum()), len(raw)), _rate(float(repeats), n),
        float(np.log1p(n)), _rate(float(sum(map(len, words))), n), max(weights, default=0.0),
        _rate(1000.0 * len(held), n), float(np.log1p(len(held))), _densest(held, SHORT), stem_max]


def _densest(places: np.ndarray, width: int) -> float:
    """The most of these words in any stretch of ``width`` words."""
    return float((np.searchsorted(places, places + width) - np.arange(len(places))).max()) if len(places) else 0.0


def _stems(words: list[str], fragments: dict[str, float]) -> tuple[np.ndarray, float]:
    """The places of the words that hold learned fragments, and the largest log odds among these."""
    spaced = f" {' '.join(words)} "
    found = [f for f in fragments if f in spaced]
    if not found:
        return np.zeros(0, np.int64), 0.0
    starts = np.cumsum([1, *(len(w) + 1 for w in words[:-1])])
    at = []
    for f in found:
        place = spaced.find(f)
        while place >= 0:
            at.append(place + 1)  # of a fragment that begins with a space, its word's start
            place = spaced.find(f, place + 1)
    return np.unique(np.searchsorted(starts, np.array(at), side="right") - 1), max(fragments[f] for f in found)


def _unmasked(low: str, lexicon: Lexicon, masked: bool) -> tuple[list[str], int]:
    """The words, those in disguise (signs for letters, stretched letters) put right, and how many insults were disguised."""
    found = 0

    def right(match: re.Match) -> str:
        nonlocal found
        for tried in (match[0], match[0].rstrip("!|$@")):
            word = tried.translate(LEET)
            if word != tried and (word in lexicon.either or word in lexicon.you):
                found += word in lexicon.either
                return word
        return match[0]

    if masked:
        low = DISGUISED.sub(right, low)
    words = WORD.findall(low)
    if STRETCHED.search(low):
        for i, word in enumerate(words):
            if STRETCHED.search(word) and (short := STRETCHES.sub(r"\1", word)) in lexicon.either:
                words[i], found = short, found + 1
    return words, found


# --- boosted trees ---------------------------------------------------------------------------

@dataclass
class Trees:
    """Trees of one depth, as arrays: feature, threshold and two children per level; leaves last."""

    base: float
    features: np.ndarray  # (trees, 2^depth - 1)
    thresholds: np.ndarray
    leaves: np.ndarray  # (trees, 2^depth)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total, depth = np.full(len(x), self.base), int(np.log2(self.leaves.shape[1]))
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (len(leaf) - 1)]
        return total


def grow_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss; splits from histograms of gradients."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin, inner, all_f, all_t, all_l = np.full(len(y), base), 2**depth - 1, [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node, fs, ts = np.zeros(len(y), np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = np.flatnonzero(node == k)
                best = 1e-3
                for f in range(x.shape[1]) if len(mine) else ():
                    gs = np.cumsum(np.bincount(binned[mine, f], g[mine], len(cuts[f]) + 1))
                    hs = np.cumsum(np.bincount(binned[mine, f], h[mine], len(cuts[f]) + 1))
                    gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
                    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - gs[-1] ** 2 / (hs[-1] + ridge)
                    gain[(hl < 0.5) | (hr < 0.5)] = 0
                    if len(gain) and gain.max() > best:
                        best, fs[k] = float(gain.max()), f
                        ts[k] = cuts[f][int(gain.argmax())]
            node = 2 * node + 1 + (x[np.arange(len(y)), fs[node]] > ts[node])
        leaf = node - inner
        leaves = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += leaves[leaf]
        all_f.append(fs)
        all_t.append(ts)
        all_l.append(leaves)
    return Trees(base, np.array(all_f), np.array(all_t), np.array(all_l))


def isotonic(margins: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (margin, probability); equal margins are pooled first."""
    blocks: list[list[float]] = []  # sum of y, weight, first margin, last margin
    values, place = np.unique(margins, return_inverse=True)
    sums, counts = np.bincount(place, y * weights), np.bincount(place, weights)
    for value, s, c in zip(values, sums, counts):
        blocks.append([s, c, value, value])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, c, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, blocks[-1][2], last]
    knots = [(m, s / c) for s, c, a, b in blocks for m in ((a, b) if b > a else (a,))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    share: float

    def score(self, rows: list[list[float]]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(rows), self.share)
        margins = self.trees.margin(np.array(rows).reshape(-1, len(FEATURES)))
        return np.clip(np.interp(margins, *self.knots), 0.0, 1.0)


# --- documents -------------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, sample_per_class: int) -> tuple[DataFrame, list[float]]:
    """(text, toxic, place) of at most ``sample_per_class`` labelled documents of each class, by hash,
    and how many labels of the class each of them stands for.

    The ids are drawn first. They are bounded by the parameter, so they are broadcast and no text is
    shuffled to find them.
    """
    usable = labels.where((remainder(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("toxic") == value, min(1.0, 2.0 * sample_per_class / n)).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.withColumn("place", place).where(F.col("place") < share).collect()  # about 2 * sample_per_class of each class
    kept = []
    for value in (0, 1):
        mine = sorted((r["place"], r["doc_id"]) for r in drawn if r["toxic"] == value)
        kept += [(doc_id, value, at) for at, doc_id in mine[:sample_per_class]]
    sizes = [sum(k[1] == v for k in kept) for v in (0, 1)]
    ids = F.broadcast(local_table(docs.sparkSession, kept, "doc_id long, toxic int, place double"))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id").select("text", "toxic", "place")
    return found, [counts.get(v, 0) / max(sizes[v], 1) for v in (0, 1)]


class _Taught:
    """The words of a labelled sample, as numbers."""

    def __init__(self, sample: list[tuple[str, int]]):
        numbers: dict[str, int] = {}
        half = len(sample) // 2
        number = lambda word: numbers.setdefault(word, len(numbers))
        self.docs = [np.unique(np.fromiter(map(number, WORD.findall(plain(text))), np.int64)) for text, _ in sample]
        self.kind = [1 + (at >= half) if toxic else 0 for at, (_, toxic) in enumerate(sample)]  # 0 clean; toxic ones by half
        self.words = list(numbers)

    def counts(self, starts: np.ndarray, parts: np.ndarray, size: int) -> np.ndarray:
        """(3, size): the texts of each kind that hold a part; word w has the parts ``parts[starts[w]:starts[w + 1]]``."""
        found, lengths = np.zeros((3, size), np.int64), np.diff(starts)
        for doc, kind in zip(self.docs, self.kind):
            many = lengths[doc]
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found[kind][np.unique(parts[np.repeat(starts[doc], many) + inside])] += 1
        return found

    def word_counts(self) -> np.ndarray:
        n = len(self.words)
        return self.counts(np.arange(n + 1), np.arange(n), n)

    def told(self, counts: np.ndarray, least_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Which parts enough toxic texts hold, in both halves, and the lower ends of the log odds of their document
        frequencies: few texts tell little."""
        clean, toxic = counts[0], counts[1] + counts[2]
        sizes = self.kind.count(0), len(self.kind) - self.kind.count(0)
        cells = [toxic + 0.5, sizes[1] - toxic + 0.5, clean + 0.5, sizes[0] - clean + 0.5]
        odds = np.log(cells[0] / cells[1]) - np.log(cells[2] / cells[3]) - 1.64 * np.sqrt(sum(1 / c for c in cells))
        return (toxic >= least_docs) & (counts[1:] > 0).all(axis=0), odds


def learn_words(sample: list[tuple[str, int]] | _Taught, least_docs: int = 4, most_words: int = 300) -> dict[str, float]:
    """Words beside the fixed insults that tell toxic documents, in both halves of the sample: the strongest ones."""
    taught = sample if isinstance(sample, _Taught) else _Taught(sample)
    often, odds = taught.told(taught.word_counts(), least_docs)
    told = {w: o for k in np.flatnonzero(often & (odds > 1.0)).tolist() if (w := taught.words[k]).isalpha() and w not in INSULTS for o in [float(odds[k])]}
    return dict(sorted(told.items(), key=lambda kv: (-kv[1], kv[0]))[:most_words])


def learn_fragments(sample: list[tuple[str, int]] | _Taught, least_docs: int = 5, most_fragments: int = 120) -> dict[str, float]:
    """Fragments of words that tell toxic documents, whatever endings or beginnings the words have.

    Words of the fixed list count for nothing here. Only words that are more frequent among toxic texts bring
    fragments; these are then counted in all texts. The strongest are kept, then the longest, each for a word that has none yet.
    """
    taught = sample if isinstance(sample, _Taught) else _Taught(sample)
    counts, clean_texts = taught.word_counts(), taught.kind.count(0)
    toxic, listed = counts[1:].sum(axis=0), frozenset(INSULTS)
    brought: Counter = Counter()
    telling = (toxic > 0) & (toxic * clean_texts > counts[0] * (len(taught.kind) - clean_texts))
    for k in np.flatnonzero(telling).tolist():
        if taught.words[k] not in listed:
            brought.update(dict.fromkeys(word_fragments(taught.words[k]), int(toxic[k])))
    names = [f for f, n in brought.items() if n >= least_docs]
    del brought
    numbers = {f: k for k, f in enumerate(names)}
    flat, starts = array("i"), array("q", [0])
    for word in taught.words:
        if word not in listed:
            flat.extend([numbers[f] for f in word_fragments(word) & numbers.keys()])
        starts.append(len(flat))
    starts, parts = np.array(starts), np.array(flat, np.int64)
    often, odds = taught.told(taught.counts(starts, parts, len(names)), least_docs)
    strong = np.flatnonzero(often & (odds > 2.0))
    at = np.flatnonzero(np.isin(parts, strong))
    holders: dict[int, set[int]] = {}  # the telling words of strong fragments
    for k, word in zip(parts[at].tolist(), (np.searchsorted(starts, at, side="right") - 1).tolist()):
        if telling[word]:
            holders.setdefault(k, set()).add(word)
    kept, covered = {}, set()
    for k in sorted(holders, key=lambda k: (-odds[k], -len(names[k]), names[k])):
        if len(kept) < most_fragments and not holders[k] <= covered:
            kept[names[k]] = float(odds[k])
            covered |= holders[k]
    return kept


def confirmed_insults(sample: list[tuple[str, int]], least_docs: int = 3) -> frozenset:
    """The fixed insults without those that are at least as frequent among the sample's clean documents."""
    listed, found, sizes = frozenset(INSULTS), (Counter(), Counter()), [0, 0]
    for text, toxic in sample:
        sizes[toxic] += 1
        found[toxic].update(listed & set(WORD.findall(plain(text))))
    return listed - {w for w, n in found[0].items() if n >= least_docs and n * sizes[1] >= found[1][w] * sizes[0]}


def learn(sample: list[tuple[str, int]]) -> Lexicon:
    taught = _Taught(sample)
    return Lexicon(learn_words(taught), confirmed_insults(sample), learn_fragments(taught))


def variants(sample: list[tuple[str, int]], lexicon: Lexicon, seed: int) -> list[tuple[str, int]]:
    """Copies of training rows in other forms: insults shortened to their surroundings, spoken to somebody,
    exchanged for others of the list, disguised, and put into long clean texts; clean texts cut short and strung together."""
    rng = random.Random(seed)
    clean = [t for t, y in sample if not y and t.strip()]
    insults, out = sorted(lexicon.insults), []
    signs = {"o": "0", "i": "1", "e": "3", "a": "@", "s": "$"}

    def disguise(word: str) -> str:
        spots = [k for k, c in enumerate(word) if c in signs and 0 < k < len(word) - 1]
        if not spots:
            return word
        k = rng.choice(spots)
        return word[:k] + signs[word[k]] + word[k + 1:]

    def long_clean(length: int) -> list[str]:
        words: list[str] = []
        while clean and sum(map(len, words)) + len(words) < length:
            words += rng.choice(clean).split()
        return words

    for text, toxic in sample:
        words = text.split()
        if not toxic:
            if len(words) > 12:
                at = rng.randrange(len(words) - 10)
                out.append((" ".join(words[at:at + rng.randrange(3, 40)]), 0))
            if rng.random() < 0.4:
                out.append((" ".join(words + long_clean(rng.choice([1000, 4000, 16000]))), 0))
            continue
        bare = [next(iter(WORD.findall(plain(w))), "") for w in words]
        hits = [k for k, w in enumerate(bare) if w in lexicon.insults]
        if not hits:
            continue
        centre = rng.choice(hits)
        part = words[max(0, centre - 12):centre + 12]
        inside = [k for k in range(len(part)) if next(iter(WORD.findall(plain(part[k]))), "") in lexicon.insults]
        swapped = [rng.choice(insults) if k in inside else w for k, w in enumerate(part)]
        addressed = [rng.choice(["you", "You are a", "you are such a", "shut up you"]), rng.choice(insults)]
        hidden = [disguise(plain(w)) if k in inside else w for k, w in enumerate(part)]
        out += [(" ".join(addressed), 1), (" ".join([addressed[0], disguise(addressed[1])]), 1)]
        for phrase in ([part] if len(inside) > 1 else []) + ([swapped, hidden] if len(inside) > 1 else []) + [addressed, [addressed[0], disguise(addressed[1])]]:
            body = long_clean(rng.choice([300, 1500, 6000, 20000]))
            at = rng.randrange(len(body) + 1)
            out.append((" ".join(body[:at] + phrase + body[at:]), 1))
            if len(phrase) > 4:
                out.append((" ".join(phrase), 1))
    return out


def train(sample: list[tuple[str, int]], odds: float = 1.0) -> Model:
    """Lexicon and trees from the whole sample, calibrated on rows that the trees have not seen.

    The sample has two halves. Rows of one, and variants of them, get their features by a lexicon of the
    other, so its weight is not overstated; trees of one half give the margins of the other, on which
    the scores are calibrated. ``odds``: how many clean documents of the corpus a clean row of the
    sample stands for, against a toxic one.
    """
    y = np.array([label for _, label in sample], float)
    weights = np.where(y == 1, 1.0, odds)
    share = float((y * weights).sum() / weights.sum()) if len(y) else 0.0
    halves = sample[:len(sample) // 2], sample[len(sample) // 2:]
    if len(y) < 20 or any(len({label for _, label in rows}) < 2 for rows in halves):
        return Model(Lexicon({}), None, (np.zeros(1), np.zeros(1)), share)

    def seen(rows: list[tuple[str, int]], lexicon: Lexicon, seed: int) -> tuple[np.ndarray, np.ndarray]:
        rows = rows + variants(rows, lexicon, seed)
        return np.array([features(t, lexicon) for t, _ in rows]).reshape(-1, len(FEATURES)), np.array([label for _, label in rows], float)

    parts = [seen(rows, learn(other), seed) for rows, other, seed in ((halves[0], halves[1], 1), (halves[1], halves[0], 2))]
    margins = np.concatenate([grow_trees(*other).margin(x) for (x, _), other in zip(parts, reversed(parts))])
    x, labels = (np.concatenate(p) for p in zip(*parts))
    return Model(learn(sample), grow_trees(x, labels), isotonic(margins, labels, np.where(labels == 1, 1.0, odds)), share)


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = 3000) -> Model:
    """Train on at most ``sample_per_class`` labelled texts of each class outside the held-out fold.

    What comes to the driver is bounded by that number of texts.
    """
    drawn, stands_for = labelled_sample(docs, labels, sample_per_class)
    rows = sorted(drawn.collect(), key=lambda r: (r["place"], r["text"]))
    return train([(r["text"], r["toxic"]) for r in rows], stands_for[0] / stands_for[1] if stands_for[1] else 1.0)


def score_documents(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Add ``score`` to the columns ``keep``; each text is read once, in the scanning task."""
    # Trees, a few hundred words and fragments, as plain values: executors need no copy of this package.
    trees = model.trees and (model.trees.base, model.trees.features, model.trees.thresholds, model.trees.leaves)
    shared = docs.sparkSession.sparkContext.broadcast(((model.lexicon.learned, model.lexicon.insults, model.lexicon.fragments), trees, model.knots, model.share))
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = source.select(*keep).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, trees, knots, share = shared.value
        model = Model(Lexicon(*words), trees and Trees(*trees), knots, share)
        for batch in batches:
            rows = [features(value.as_py() or "", model.lexicon) for value in batch.column("text")]
            scores = model.score(rows) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(scores, pa.float64())], names=[*keep, "score"])

    return source.mapInArrow(run, schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return score_documents(docs, model, ["doc_id"]).select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
