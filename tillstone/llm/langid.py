"""Language of texts by a linear-chain conditional random field over their words.

Words have hashed affix, n-gram and lexicon features; transitions between the
languages of neighbouring words are learned, from training sequences that also
switch language midway. Forward-backward gives each word's probabilities; a
text's language is the one with the largest sum over its words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.common import settle, words_of

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Field:
    """The fit uses at most ``documents`` labelled documents a language, and ``sequences`` runs of ``length`` words cut
    from anywhere in them. ``features`` is the size of the hashed feature space, ``words`` what a task remembers."""

    documents: int = 200
    sequences: int = 300
    length: int = 32
    features: int = 1 << 15
    epochs: int = 4
    rate: float = 0.3
    words: int = 300_000


def letters(text: str | None) -> list[str]:
    """The words of a text, in lower case: runs of letters."""
    words = WORD.findall((text or "").lower())
    # Superscripts and the like count as word characters, but not as letters.
    return [p for w in words for p in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def features(word: str, size: int) -> list[int]:
    """Affixes of one to three letters, n-grams of two and three, and the word itself."""
    w = word.encode()
    names = [b"w" + w]
    for n in (1, 2, 3):
        names += (b"p" + word[:n].encode(), b"s" + word[-n:].encode())
    padded = f"<{word}>"
    names += [b"g" + padded[i : i + n].encode() for n in (2, 3) for i in range(len(padded) - n + 1)]
    return [zlib.crc32(x) % size for x in names]


class Chain:
    """Weights of a chain: ``emit`` (features x labels), ``move`` (labels x labels), ``begin`` (labels)."""

    def __init__(self, labels: list[str], how: Field):
        n = len(labels)
        self.labels, self.how = labels, how
        self.emit, self.move, self.begin = np.zeros((how.features, n), np.float32), np.zeros((n, n)), np.zeros(n)

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores of words: the mean weight of their features, on the scale of a root."""
        lists = [features(w, self.how.features) for w in words]
        sizes = np.array([len(x) for x in lists])
        at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        sums = np.add.reduceat(self.emit[np.concatenate([np.array(x) for x in lists])], at, axis=0)
        return sums / np.sqrt(sizes)[:, None]

    def marginals(self, scores: np.ndarray, lengths: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over many sequences at once, one place after the other.

        ``scores`` holds the sequences one after the other, the longest first.
        Returns each word's label probabilities and, with ``pairs``, the expected transitions.
        """
        total, n = scores.shape
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        alive = np.searchsorted(-lengths, -np.arange(1, lengths.max() + 1), "right")
        place = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
        move, alpha, out = np.exp(self.move), np.empty((total, n)), np.empty((total, n))
        a = np.exp(self.begin) * place[first]
        for t, k in enumerate(alive):
            at = first[:k] + t
            if t:
                a = (a[:k] @ move) * place[at]
            a /= a.sum(axis=1, keepdims=True)
            alpha[at] = a
        moves = np.zeros((n, n))
        beta = np.zeros((0, n))
        for t in range(len(alive) - 1, -1, -1):
            k = alive[t]
            at = first[:k] + t
            b = np.ones((k, n))
            if len(beta):
                ahead = beta * place[first[: len(beta)] + t + 1]
                if pairs:
                    both = alpha[at[: len(beta)], :, None] * move * ahead[:, None, :]
                    moves += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b[: len(beta)] = ahead @ move.T
                b[: len(beta)] /= b[: len(beta)].sum(axis=1, keepdims=True)
            m = alpha[at] * b
            out[at] = m / m.sum(axis=1, keepdims=True)
            beta = b
        return out, moves


def train(sequences: list[tuple[str, list[str]]], how: Field) -> Chain:
    """A chain fitted to (label, words) sequences by stochastic gradient steps with a rate for each weight."""
    labels = sorted({label for label, _ in sequences})
    chain, rng = Chain(labels, how), np.random.default_rng(8)
    number = {label: i for i, label in enumerate(labels)}
    runs = [([number[label]] * len(words), words) for label, words in sequences if words]
    # Code-switched runs: the first half of one sequence and the second of another.
    for i, j in enumerate(rng.permutation(len(runs))):
        (y, w), (z, v) = runs[i], runs[j]
        runs.append((y[: len(y) // 2] + z[len(z) // 2 :], w[: len(w) // 2] + v[len(v) // 2 :]))
    runs = [r for r in runs if r[1]]
    known = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in runs for w in ws))}
    lists = [np.array(features(w, how.features)) for w in known]
    n = len(labels)
    steps = [np.full((how.features, n), 1e-3, np.float32), np.full((n, n), 1e-3), np.full(n, 1e-3)]
    for _ in range(how.epochs):
        for part in np.array_split(rng.permutation(len(runs)), max(1, len(runs) // 128)):
            part = sorted(part, key=lambda i: -len(runs[i][1]))
            lengths = np.array([len(runs[i][1]) for i in part])
            words = [w for i in part for w in runs[i][1]]
            gold = np.array([y for i in part for y in runs[i][0]])
            own = [lists[known[w]] for w in words]
            found, moves = chain.marginals(chain.scores(words), lengths, pairs=True)
            found[np.arange(len(gold)), gold] -= 1
            sizes = np.array([len(x) for x in own])
            at, per = np.concatenate(own), np.repeat(found / np.sqrt(sizes)[:, None], sizes, axis=0)
            emit = np.stack([np.bincount(at, per[:, j], how.features) for j in range(n)], axis=1)
            first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            inner = np.setdiff1d(np.arange(len(gold)), first)
            np.add.at(moves, (gold[inner - 1], gold[inner]), -1)
            for weight, step, slope in zip((chain.emit, chain.move, chain.begin), steps, (emit, moves, found[first].sum(axis=0))):
                slope = slope / len(part)
                step += slope**2
                weight -= (how.rate * slope / np.sqrt(step)).astype(weight.dtype)
    return chain


def judged(chain: Chain, texts: list[str | None], memory: dict[str, int], scores: list[np.ndarray]) -> list[tuple[str, float]]:
    """(language, score) of each text; ``memory`` and ``scores`` keep the words seen before."""
    out: list = [("und", 0.0)] * len(texts)
    if len(memory) > chain.how.words:
        memory.clear()
        scores.clear()
    ids = []
    for text in texts:
        words = letters(text)
        new = [w for w in dict.fromkeys(words) if w not in memory]
        if new:
            for w in new:
                memory[w] = len(memory)
            scores.append(chain.scores(new))
        ids.append(np.fromiter(map(memory.__getitem__, words), np.int64, len(words)))
    full = sorted((i for i in range(len(texts)) if len(ids[i])), key=lambda i: -len(ids[i]))
    if not full:
        return out
    scores[:] = [np.concatenate(scores)]
    lengths = np.array([len(ids[i]) for i in full])
    found, _ = chain.marginals(scores[0][np.concatenate([ids[i] for i in full])], lengths)
    sums = np.add.reduceat(found, np.concatenate(([0], np.cumsum(lengths)[:-1])), axis=0) / lengths[:, None]
    for i, row in zip(full, sums):
        out[i] = chain.labels[int(row.argmax())], float(min(1.0, row.max()))
    return out


def held_out(doc_id: str | Column) -> Column:
    """Documents that are never learned from; a NULL id is not held out, but has no label for the fit either."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, how: Field) -> list[tuple[str, list[str]]]:
    """The bounded training sample: chosen by a hash of the id, evenly for each language."""
    order = F.xxhash64("doc_id")
    labelled = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    labelled = labelled.select("doc_id", "lang", "text").withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id", "text")))
    labelled = labelled.filter(F.col("turn") <= how.documents).drop("turn")
    cut = labelled.select("doc_id", "lang", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.floor((F.size("words") - 1) / how.length).cast("int"))
    runs = cut.select("doc_id", "lang", F.posexplode(F.transform(starts, lambda i: F.slice("words", i * how.length + 1, F.lit(how.length)))).alias("i", "words"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "i"), "doc_id", "i", "words"))
    runs = runs.withColumn("turn", turn).filter(F.col("turn") <= how.sequences).orderBy("lang", "turn")
    return [(r["lang"], letters(" ".join(r["words"]))) for r in runs.select("lang", "words").collect()]


def predict(docs: DataFrame, how: Field = Field()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    ``und`` with score 0 where the text is NULL or has no letter, and for all
    texts if there is nothing to learn from. Predictions see the text alone.
    Repeated rows are judged alike; other columns are not looked at.
    """
    runs = [r for r in sample(docs, how) if r[1]]
    chain = train(runs, how) if runs else None
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory: dict[str, int] = {}
        scores: list[np.ndarray] = []
        for batch in batches:
            texts = list(batch["text"])
            # Texts of like length together, in parts of bounded size.
            order = sorted(range(len(texts)), key=lambda i: -len(texts[i] or ""))
            found: list = [None] * len(texts)
            part, size = [], 0
            for i in [*order, None]:
                if part and (i is None or size > 1_500_000):
                    done = judged(chain, [texts[j] for j in part], memory, scores) if chain else [("und", 0.0)] * len(part)
                    for j, x in zip(part, done):
                        found[j] = x
                    part, size = [], 0
                if i is not None:
                    part.append(i)
                    size += len(texts[i] or "")
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]}
            )

    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op8(docs: DataFrame) -> DataFrame:
    return predict(docs)
