"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads windows: a window is one word with the space after it, and at most ``WINDOW`` bytes
of a longer run. It labels every byte position with a distribution over the learned languages; a
document's distribution is the mean over all its letter positions, of its whole text. As the state
starts anew in each window, equal windows have equal sums, so a task computes each distinct word once.

Trained in numpy by backpropagation through time on slices of a bounded sample of documents
(``sample_per_lang`` texts of each language, ``slice_chars`` characters each from a pseudorandom place).

Defined cases: a NULL text or one without any letter is ``und`` with score 0; a text of a script that
was never seen still gets the likeliest learned language; a NULL doc_id is scored like any other row
(its held_out comes from the empty text); repeated rows each give one row; with nothing to learn from,
every document is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import remainder, table, tidied

WINDOW = 48  # bytes
CACHE_WORDS = 200_000  # distinct words that a task remembers
UNKNOWN = "und"
LETTER_BYTE = np.array([bytes([b]).isalpha() or b >= 128 for b in range(256)])
FOLDS, HELD_OUT = 4, 2


@dataclass
class Model:
    languages: list[str]
    weights: dict[str, np.ndarray]


# --- the network -----------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def new_weights(hidden: int, embedding: int, languages: int, seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    weights = {"bytes": draw(256, embedding) * 8, "out": draw(2 * hidden, languages), "out_bias": np.zeros(languages, np.float32)}
    for side in ("f", "b"):
        weights |= {f"in_{side}": draw(embedding, 3 * hidden), f"rec_{side}": draw(hidden, 3 * hidden), f"bias_{side}": np.zeros(3 * hidden, np.float32)}
    return weights


def _run_side(w: dict, side: str, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (length, batch, hidden) of one direction for windows of one length."""
    count, length = ids.shape
    recurrent, hidden = w[f"rec_{side}"], w[f"rec_{side}"].shape[0]
    inputs = (w["bytes"] @ w[f"in_{side}"] + w[f"bias_{side}"])
    state, states = np.zeros((count, hidden), np.float32), np.empty((length, count, hidden), np.float32)
    for t in range(length) if side == "f" else range(length - 1, -1, -1):
        x, r = inputs[ids[:, t]], state @ recurrent
        gates = _sigmoid(x[:, :2 * hidden] + r[:, :2 * hidden])
        update, reset = gates[:, :hidden], gates[:, hidden:]
        new = np.tanh(x[:, 2 * hidden:] + reset * r[:, 2 * hidden:])
        if keep is not None:
            keep.append((t, state, update, reset, new, r[:, 2 * hidden:]))
        state = new + update * (state - new)
        states[t] = state
    return states


def position_probabilities(w: dict, ids: np.ndarray) -> np.ndarray:
    """(length, batch, languages): a distribution for each position of windows of one length."""
    both = np.concatenate([_run_side(w, "f", ids), _run_side(w, "b", ids)], axis=2)
    logits = both @ w["out"] + w["out_bias"]
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    return logits / logits.sum(axis=2, keepdims=True)


def gradients(w: dict, ids: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradient by backpropagation through time."""
    count, length = ids.shape
    hidden, tapes = w["rec_f"].shape[0], {"f": [], "b": []}
    both = np.concatenate([_run_side(w, s, ids, tapes[s]) for s in ("f", "b")], axis=2)
    logits = both @ w["out"] + w["out_bias"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    rows = np.arange(count)
    loss = -np.log(p[:, rows, labels] + 1e-12).mean()
    p[:, rows, labels] -= 1
    p /= count * length
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["out"] = both.reshape(-1, 2 * hidden).T @ p.reshape(-1, p.shape[2])
    g["out_bias"] = p.sum(axis=(0, 1))
    d_both = p @ w["out"].T
    for k, side in enumerate(("f", "b")):
        recurrent, d_state = w[f"rec_{side}"], np.zeros((count, hidden), np.float32)
        d_inputs = np.zeros((256, 3 * hidden), np.float32)
        for t, before, update, reset, new, r_new in reversed(tapes[side]):
            d = d_state + d_both[t][:, k * hidden:(k + 1) * hidden]
            d_new = d * (1 - update) * (1 - new * new)
            d_update = d * (before - new) * update * (1 - update)
            d_reset = d_new * r_new * reset * (1 - reset)
            d_x = np.concatenate([d_update, d_reset, d_new], axis=1)
            d_r = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            g[f"rec_{side}"] += before.T @ d_r
            np.add.at(d_inputs, ids[:, t], d_x)
            d_state = d * update + d_r @ recurrent.T
        g[f"in_{side}"] = w["bytes"].T @ d_inputs
        g[f"bias_{side}"] = d_inputs.sum(axis=0)
        g["bytes"] += d_inputs @ w[f"in_{side}"].T
    return float(loss), g


def cut_windows(word: bytes) -> list[bytes]:
    """The windows of one word: with its space, at most WINDOW bytes each."""
    word += b" "
    return [word[i:i + WINDOW] for i in range(0, len(word), WINDOW)]


def train(samples: list[tuple[str, str]], hidden: int = 12, embedding: int = 8, steps: int = 600, batch: int = 256, rate: float = 0.01, seed: int = 0) -> Model | None:
    """Learn from (language, text) pairs; every language is drawn equally often."""
    languages = sorted({lang for lang, _ in samples})
    by_length: dict[int, list[list[np.ndarray]]] = {}
    for lang, text in samples:
        for word in text.encode("utf-8", "ignore").split():
            for piece in cut_windows(word):
                if LETTER_BYTE[list(piece)].any():
                    by_length.setdefault(len(piece), [[] for _ in languages])[languages.index(lang)].append(piece)
    if not by_length:
        return None
    rng, w = np.random.default_rng(seed), new_weights(hidden, embedding, len(languages), seed)
    lengths = np.array(sorted(by_length))
    share = np.array([sum(map(len, by_length[n])) for n in lengths], float)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pools = by_length[int(rng.choice(lengths, p=share / share.sum()))]
        usable = [k for k, pool in enumerate(pools) if pool]
        labels = rng.choice(usable, batch)
        ids = np.stack([np.frombuffer(pools[k][rng.integers(len(pools[k]))], np.uint8) for k in labels])
        _, g = gradients(w, ids, labels)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        now = rate * (1 - step / (steps + 1))
        for k in w:
            v = g[k] * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            w[k] = w[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return Model(languages, {k: v.astype(np.float32) for k, v in w.items()})


# --- documents -------------------------------------------------------------------------------

def word_sums(model: Model, words: list[bytes], block: int = 1024) -> np.ndarray:
    """For each word: the summed distribution over its letter positions, and their number."""
    out = np.zeros((len(words), len(model.languages) + 1))
    pieces: dict[int, tuple[list[int], list[bytes]]] = {}
    for owner, word in enumerate(words):
        for piece in cut_windows(word):
            owners, found = pieces.setdefault(len(piece), ([], []))
            owners.append(owner)
            found.append(piece)
    for length, (owners, found) in pieces.items():
        for i in range(0, len(found), block):
            ids = np.frombuffer(b"".join(found[i:i + block]), np.uint8).reshape(-1, length)
            letters = LETTER_BYTE[ids].T[:, :, None]
            sums = (position_probabilities(model.weights, ids) * letters).sum(axis=0)
            np.add.at(out, np.array(owners[i:i + block]), np.concatenate([sums, letters.sum(axis=0)], axis=1))
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Scorer:
    """Scores texts; remembers the sums of the words that it has met."""

    def __init__(self, model: Model):
        self.model, self.known, self.sums = model, {}, np.zeros((0, len(model.languages) + 1))

    def _look_up(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            if len(self.known) + len(new) > CACHE_WORDS:
                self.known, self.sums = {}, self.sums[:0]
                new = list(dict.fromkeys(words))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.sums = np.concatenate([self.sums, word_sums(self.model, new)])
        return self.sums[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        docs = [i for i, t in enumerate(texts) if t and has_letter(t)]
        split = [texts[i].encode("utf-8", "replace").split() for i in docs]
        for start in range(0, len(docs), 64):
            part = split[start:start + 64]
            sums = self._look_up([w for words in part for w in words])
            at = 0
            for i, words in zip(docs[start:start + 64], part):
                total = sums[at:at + len(words)].sum(axis=0)
                at += len(words)
                best = int(np.argmax(total[:-1]))
                out[i] = (self.model.languages[best], float(min(1.0, total[best] / total[-1])))
        return out


def fit(docs: DataFrame, sample_per_lang: int = 300, slice_chars: int = 1500, **settings) -> Model | None:
    """Train on documents outside the held-out fold; at most ``sample_per_lang`` texts of each language.

    The sample is taken by the hash of doc_id, so it does not depend on the table's layout. What
    comes to the driver is bounded by languages x sample_per_lang x slice_chars characters.
    """
    usable = docs.where((remainder(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * sample_per_lang / n))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    start = (F.pmod(F.xxhash64("doc_id", F.lit("slice")), F.greatest(F.lit(1), F.length("text") - slice_chars)) + 1).cast("int")
    drawn = usable.where(place < F.element_at(share, F.col("lang"))).select(
        "lang", place.alias("place"), F.substring("text", start, F.lit(slice_chars)).alias("piece"))
    kept: dict[str, list] = {}
    for row in sorted(drawn.collect(), key=lambda r: (r["lang"], r["place"], r["piece"])):
        kept.setdefault(row["lang"], []).append((row["lang"], row["piece"]))
    return train([pair for pairs in kept.values() for pair in pairs[:sample_per_lang]], **settings)


def score_documents(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """Add lang_pred and score to the columns ``keep``; the text is read once, in the scanning task."""
    spark = docs.sparkSession
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((model.languages, model.weights))  # a few thousand numbers, as plain values
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = source.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = scorer.score(part.column("text").to_pylist())
                columns = [part.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=[*keep, "lang_pred", "score"])

    return source.mapInArrow(tidied(run), schema)


def keep_identified(docs: DataFrame, model: Model | None, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` or more, all columns kept.

    Only the text goes to Python, and a flag comes back. Without ``least`` the bar lies a fifteenth of the way
    from chance (one over the number of languages) to certainty: it rejects texts without letters and
    those whose positions say as good as nothing about the language; clean texts stay far above.
    """
    if model is None:
        return docs.limit(0)
    chance = 1 / len(model.languages)
    bar = chance + (1 - chance) / 15 if least is None else least
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))

    @F.arrow_udf("boolean")
    def fits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(Model(*shared.value))

        def flagged(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in arrays:
                flags = []
                for at in range(0, len(texts), 250):
                    flags += [lang != UNKNOWN and score >= bar for lang, score in scorer.score(texts.slice(at, 250).to_pylist())]
                yield pa.array(flags, pa.bool_())

        yield from tidied(flagged)(batches)

    return docs.where(fits(F.col("text")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = score_documents(docs, fit(docs), ["doc_id"])
    return found.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
