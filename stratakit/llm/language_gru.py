"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes in both directions and labels every byte with a distribution over the
languages; a document's distribution is the mean over all bytes of its words that hold a letter. State starts
anew at white space, so equal words get equal labels and each distinct word of a batch is run once. It is
trained here, in numpy, by backpropagation through time, on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import bound_batches, sliced

UNKNOWN = "und"
LONGEST = 32
"""Bytes read as one sequence; a longer word is read in several."""


@dataclass
class LanguageModel:
    languages: list[str]
    weights: dict[str, np.ndarray]


# ---- the network ---------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _begin(hidden: int, classes: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    weights = {}
    for side in "fb":
        weights[f"E{side}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        weights[f"U{side}"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden))
    weights["V"] = rng.normal(0, hidden**-0.5, (2 * hidden, classes))
    weights["c"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _gru(rows: np.ndarray, embed: np.ndarray, recur: np.ndarray, keep: list | None = None) -> list[np.ndarray]:
    """States after each byte of sequences of one length, rows x length; keep gets what the way back needs."""
    size = recur.shape[0]
    state = np.zeros((rows.shape[0], size), np.float32)
    states = []
    for t in range(rows.shape[1]):
        given, held = embed[rows[:, t]], state @ recur
        gates = _sigmoid(given[:, : 2 * size] + held[:, : 2 * size])
        stay, reset = gates[:, :size], gates[:, size:]
        fresh = np.tanh(given[:, 2 * size :] + reset * held[:, 2 * size :])
        after = fresh + stay * (state - fresh)
        if keep is not None:
            keep.append((state, stay, reset, fresh, held[:, 2 * size :]))
        state = after
        states.append(after)
    return states


def _gru_back(rows, grads, embed, recur, keep) -> tuple[np.ndarray, np.ndarray]:
    """Backpropagation through time: gradients of embed and recur from those of the states."""
    size = recur.shape[0]
    d_embed, d_recur = np.zeros_like(embed), np.zeros_like(recur)
    flow = np.zeros_like(grads[0])
    for t in range(rows.shape[1] - 1, -1, -1):
        state, stay, reset, fresh, held = keep[t]
        flow = flow + grads[t]
        d_fresh = flow * (1 - stay) * (1 - fresh * fresh)
        d_stay = flow * (state - fresh) * stay * (1 - stay)
        d_reset = d_fresh * held * reset * (1 - reset)
        d_given = np.concatenate([d_stay, d_reset, d_fresh], 1)
        d_held = np.concatenate([d_stay, d_reset, d_fresh * reset], 1)
        np.add.at(d_embed, rows[:, t], d_given)
        d_recur += state.T @ d_held
        flow = flow * stay + d_held @ recur.T
    return d_embed, d_recur


def position_probabilities(rows: np.ndarray, weights: dict[str, np.ndarray]) -> np.ndarray:
    """Of every byte of sequences of one length: rows x length x languages."""
    ahead = _gru(rows, weights["Ef"], weights["Uf"])
    back = _gru(rows[:, ::-1], weights["Eb"], weights["Ub"])[::-1]
    logits = np.stack([np.concatenate(x, 1) @ weights["V"] for x in zip(ahead, back)], 1) + weights["c"]
    logits = np.exp(logits - logits.max(2, keepdims=True))
    return logits / logits.sum(2, keepdims=True)


def _gradients(rows, labels, weights) -> dict[str, np.ndarray]:
    kept_ahead, kept_back = [], []
    ahead = _gru(rows, weights["Ef"], weights["Uf"], kept_ahead)
    back = _gru(rows[:, ::-1], weights["Eb"], weights["Ub"], kept_back)
    size = weights["Uf"].shape[0]
    grads = {k: np.zeros_like(v) for k, v in weights.items()}
    to_ahead, to_back = [], [None] * rows.shape[1]
    for t, state in enumerate(ahead):
        both = np.concatenate([state, back[rows.shape[1] - 1 - t]], 1)
        logits = both @ weights["V"] + weights["c"]
        probs = np.exp(logits - logits.max(1, keepdims=True))
        probs /= probs.sum(1, keepdims=True)
        probs[np.arange(len(labels)), labels] -= 1
        probs /= rows.size
        grads["V"] += both.T @ probs
        grads["c"] += probs.sum(0)
        down = probs @ weights["V"].T
        to_ahead.append(down[:, :size])
        to_back[rows.shape[1] - 1 - t] = down[:, size:]
    grads["Ef"], grads["Uf"] = _gru_back(rows, to_ahead, weights["Ef"], weights["Uf"], kept_ahead)
    grads["Eb"], grads["Ub"] = _gru_back(rows[:, ::-1], to_back, weights["Eb"], weights["Ub"], kept_back)
    return grads


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in words, their bytes as rows x length), for each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join([words[i] for i in at]), np.uint8).reshape(len(at), size)


def train(words: list[bytes], labels: np.ndarray, languages: list[str], hidden: int = 12, epochs: int = 4,
          batch: int = 512, rate: float = 0.01, seed: int = 7) -> LanguageModel:
    """Fit on words and the language numbers of their documents, with Adam. The same input gives the same model."""
    weights = _begin(hidden, len(languages), seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    rng, step = np.random.default_rng(seed), 0
    groups = [(rows, labels[at]) for at, rows in _by_length(words)]
    for epoch in range(epochs):
        parts = []
        for g, (rows, _) in enumerate(groups):
            order = rng.permutation(len(rows))
            parts += [(g, order[i : i + batch]) for i in range(0, len(rows), batch)]
        for p in rng.permutation(len(parts)):
            g, at = parts[p]
            grads = _gradients(groups[g][0][at], groups[g][1][at], weights)
            step += 1
            pace = rate * 0.5**epoch * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * min(1.0, len(at) / batch + 0.1)
            for k, grad in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                weights[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return LanguageModel(languages, weights)


# ---- documents -----------------------------------------------------------------------------------


def has_letter(word: str) -> bool:
    """Letters as Unicode has them; number signs such as a superscript two or a Roman eight are none."""
    return word.isalpha() or any(map(str.isalpha, word))


def _words(text: str) -> list[str]:
    """The sequences of a whole text: lower case, parted by white space, full stops and commas."""
    return text.lower().replace(".", " ").replace(",", " ").split()


def _pieces(word: str) -> list[bytes]:
    raw = word.encode("utf-8", "replace")
    return [raw[i : i + LONGEST] for i in range(0, len(raw), LONGEST)]


def word_sums(words: list[str], model: LanguageModel, rows_at_once: int = 2048) -> np.ndarray:
    """Per word the sum of its bytes' distributions; zeros for a word without a letter."""
    sums = np.zeros((len(words), len(model.languages)))
    raw = [w.encode("utf-8", "replace") if has_letter(w) else b"" for w in words]
    longer = [i for i, w in enumerate(raw) if len(w) > LONGEST]
    pieces = [raw[i][k : k + LONGEST] for i in longer for k in range(LONGEST, len(raw[i]), LONGEST)]
    owner = [i for i in longer for _ in range(LONGEST, len(raw[i]), LONGEST)]
    for at, rows in _by_length([w[:LONGEST] for w in raw] if longer else raw):
        for i in range(0, len(at) if rows.shape[1] else 0, rows_at_once):
            sums[at[i : i + rows_at_once]] = _summed(rows[i : i + rows_at_once], model)
    for at, rows in _by_length(pieces):
        for i in range(0, len(at), rows_at_once):
            np.add.at(sums, np.asarray(owner)[at[i : i + rows_at_once]], _summed(rows[i : i + rows_at_once], model))
    return sums


def _summed(rows: np.ndarray, model: LanguageModel) -> np.ndarray:
    return position_probabilities(rows, model.weights).sum(1)


class WordSums:
    """Words seen so far with their sums. Starts anew beyond so many, so that memory stays bounded."""

    def __init__(self, model: LanguageModel, most: int = 100_000):
        self.model, self.most = model, most
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.sums = np.zeros((0, len(self.model.languages)))

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text the sums of all its words together."""
        if len(self.number) > self.most:
            self._forget()
        number, before = self.number, len(self.number)
        found = []
        for text in texts:
            words = _words(text)
            found.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        if len(number) > before:
            self.sums = np.concatenate([self.sums, word_sums(list(islice(number, before, None)), self.model)])
        return [self.sums[at].sum(0) for at in found]


def predict(texts: list[str], model: LanguageModel, known: WordSums | None = None) -> tuple[list[str], np.ndarray]:
    """Language and score of each whole text."""
    known = known or WordSums(model)
    names, scores = [], np.zeros(len(texts))
    for begin, end in sliced(texts, 2_000_000):
        for i, pooled in enumerate(known.of(texts[begin:end]), begin):
            total = pooled.sum()
            best = int(pooled.argmax()) if total > 0 else -1
            names.append(model.languages[best] if total > 0 else UNKNOWN)
            scores[i] = min(1.0, pooled[best] / total) if total > 0 else 0.0
    return names, scores


def labelled_words(df: DataFrame, text: str, lang: str, key: Column, docs_per_language: int, words_per_doc: int,
                   seed: int) -> pd.DataFrame:
    """(lang, word) from about docs_per_language documents of each language, chosen by a hash of the key.

    A document gives at most words_per_doc words with letters, drawn from its whole text.
    """
    label, mark = F.col(f"`{lang}`"), F.pmod(F.xxhash64(key.cast("string"), F.lit(seed)), F.lit(1 << 30))
    usable = df.where(label.isNotNull() & F.col(f"`{text}`").isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(label.alias("lang")).count().limit(1001).collect()}
    if len(counts) > 1000:
        raise ValueError("more than 1000 languages")
    if not counts:
        return pd.DataFrame({"lang": [], "word": []})
    chosen = F.lit(False)
    for name, rows in counts.items():
        chosen = chosen | ((label == name) & (mark < int((1 << 30) * min(1.0, docs_per_language / rows))))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, drawn = [], []
            for language, body, salt in zip(batch["lang"], batch["text"], batch["salt"]):
                words = [w for w in _words(body) if has_letter(w)]
                if len(words) > words_per_doc:
                    at = np.random.default_rng(salt).choice(len(words), words_per_doc, replace=False)
                    words = [words[i] for i in sorted(at)]
                drawn += words
                langs += [language] * len(words)
            yield pd.DataFrame({"lang": langs, "word": drawn}, dtype=object)

    sample = usable.where(chosen).select(label.alias("lang"), F.col(f"`{text}`").alias("text"), mark.alias("salt"))
    return sample.mapInPandas(draw, "lang string, word string").toPandas().sort_values(["lang", "word"], ignore_index=True)


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", docs_per_language: int = 600,
        words_per_doc: int = 50, seed: int = 7) -> LanguageModel:
    """A model from a bounded sample: at most about docs_per_language x words_per_doc words of each language.

    Rows without text or language are not used. Without any labelled row the model knows no language and
    predicts ``und``.
    """
    bound_batches(df.sparkSession)
    words = labelled_words(df, text, lang, F.col(f"`{key}`"), docs_per_language, words_per_doc, seed)
    languages = sorted(words["lang"].unique())
    number = {name: i for i, name in enumerate(languages)}
    pieces = [(p, number[name]) for name, word in zip(words["lang"], words["word"]) for p in _pieces(word)]
    if not pieces:
        return LanguageModel([], {})
    return train([p for p, _ in pieces], np.array([n for _, n in pieces]), languages, seed=seed)


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows with lang_pred and score added, replacing columns of these names.

    ``und`` with score 0 stands for a text that is null, empty or has no letter, and for all texts if the
    model knows no language. One pass, no shuffle; memory holds a slice of 2 million characters, or one text, its
    distinct words and up to 100000 words before.
    """
    bound_batches(df.sparkSession)
    kept = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    names = [f"c{i}" for i in range(len(kept))]
    at = names[kept.index(text)]

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = WordSums(model)
        for batch in texts:
            found, scores = predict(batch.fillna("").tolist(), model, known) if model.languages else ([UNKNOWN] * len(batch), 0.0)
            # Plain objects: pandas' own string column can hold several chunks, which a struct can't take.
            yield pd.DataFrame({"lang_pred": pd.Series(found, dtype=object), "score": scores}, index=range(len(batch)))

    found = rows.toDF(*names).withColumn("found", label(F.col(at)))
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, kept)], "found.lang_pred", "found.score")
