"""Toxicity by weak supervision: many lexicon and pattern voters, a generative model of how accurate they are
and which of them go together, and a linear classifier trained on the model's posterior labels."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metframe.llm.text import Sent, byte_codes, corpus, pieces_of, prefix_sums, span_hashes
from metframe.session import cut_lineage

TRAIN_ROWS = 10_000  # labelled documents that are learned from, at most, chosen by a hash of their id
LEXICON = 400  # words that become voters, at most
LEAST = 4  # training documents that such a word must be in
BUCKETS = 1 << 16  # hashed word features of the classifier
ROUNDS = 25
EPOCHS = 30
THRESHOLD = 0.3

# Insults that vote from the start, whatever the labels say.
INSULTS = [
    "idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
    "imbecile", "hate", "ugly", "garbage", "vermin", "filthy", "shut up", "kill yourself", "idiota", "estúpido", "imbécil",
    "idiote", "stupide", "connard", "dummkopf", "arschloch", "abschaum",
]
PATTERNS = {
    "shouting": r"(?:\b[A-ZÀ-Þ]{3,}\b[ ,]*){4}",
    "exclamation": r"!{2,}",
    "threat": r"(?i)\b(?:i|we) (?:will|ll|am going to) (?:kill|hurt|find|beat)\b",
    "address": r"(?i)\byou(?:'re| are)? (?:a |an |such |so )*(?:idiot|moron|stupid|loser|clown|trash|pathetic|worthless)",
    "masked": r"\b\w[*#@$]{2,}\w*\b",
}

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Voters:
    """One voter for each word of the lexicon, for a half and for several of its words, and for each pattern.
    A voter says 1 (toxic) or nothing; one more says that none of them spoke."""

    def __init__(self, words: Sequence[str]):
        self.words = list(dict.fromkeys([*INSULTS, *words]))
        self.single = {w: i for i, w in enumerate(self.words) if " " not in w}
        self.phrases = [(w, i) for i, w in enumerate(self.words) if " " in w]
        self.patterns = [re.compile(p) for p in PATTERNS.values()]
        self.count = len(self.words) + len(self.patterns) + 3

    def votes(self, text: str, words: set[str] | None = None) -> list[int]:
        words = set(words_of(text)) if words is None else words
        found = [self.single[w] for w in words if w in self.single]
        lower = text.lower()
        found += [i for w, i in self.phrases if w in lower]
        out = list(found)
        n = len(self.words)
        out += [n + i for i, p in enumerate(self.patterns) if p.search(text)]
        n += len(self.patterns)
        if len(found) >= 2:
            out.append(n)
        if len(found) >= 4:
            out.append(n + 1)
        if not out:
            out.append(n + 2)
        return out


class LabelModel:
    """Each voter speaks with some probability on toxic and on other documents (its accuracy); voters that
    speak together more often than that explains are correlated, and their evidence counts in part."""

    def __init__(self, votes: np.ndarray, seen: np.ndarray, rounds: int):
        """``seen``: the labels, 1 or 0. They may be wrong, so they are strong evidence, not a fact."""
        v = votes.astype(np.float64)
        posterior = np.where(seen > 0, 0.95, 0.02)
        for _ in range(rounds):
            self.prior = float(np.clip(posterior.mean(), 1e-3, 0.999))
            self.on = (posterior @ v + 0.5 * self.prior) / (posterior.sum() + 1)
            self.off = ((1 - posterior) @ v + 0.5 * 0.01) / ((1 - posterior).sum() + 1)
            self.share = self.shares(v, posterior)
            estimate = self.posterior(v)
            odds = np.log(estimate / (1 - estimate)) + np.where(seen > 0, 3.0, -3.0)
            fresh = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            if np.abs(fresh - posterior).max() < 1e-6:
                break
            posterior = fresh
        self.training_posterior = posterior

    def shares(self, v: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        """What part of a voter's evidence counts: 1 over one plus its correlations with others within a class."""
        total = np.zeros((v.shape[1], v.shape[1]))
        for weight, rate in ((posterior, self.on), (1 - posterior, self.off)):
            mean = np.clip(weight @ v / max(weight.sum(), 1e-9), 1e-9, 1 - 1e-9)
            joint = (v * weight[:, None]).T @ v / max(weight.sum(), 1e-9)
            spread = np.sqrt(mean * (1 - mean))
            total += np.abs(joint - np.outer(mean, mean)) / np.outer(spread, spread) / 2
        np.fill_diagonal(total, 0)
        return 1 / (1 + np.where(total > 0.2, total, 0).sum(axis=1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        v = votes.astype(np.float64)
        on, off = np.clip(self.on, 1e-6, 1 - 1e-6), np.clip(self.off, 1e-6, 1 - 1e-6)
        said, silent = np.log(on / off), np.log((1 - on) / (1 - off))
        odds = np.log(self.prior / (1 - self.prior)) + v @ (self.share * said) + (1 - v) @ (self.share * silent)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def buckets_of(words: Sequence[str]) -> np.ndarray:
    """Distinct hashed word features of a text."""
    if not words:
        return np.empty(0, np.int64)
    data = [w.encode() for w in words]
    ends = np.cumsum([len(d) for d in data])
    sums = prefix_sums(np.frombuffer(b"".join(data), np.uint8), byte_codes())
    return np.unique((span_hashes(sums, ends - np.array([len(d) for d in data]), ends) % np.uint64(BUCKETS)).astype(np.int64))


class Classifier:
    """Logistic regression on the voters and on hashed words, the latter scaled down by their number."""

    def __init__(self, voters: int):
        self.voter_weights, self.word_weights, self.bias = np.zeros(voters), np.zeros(BUCKETS), 0.0

    def odds(self, votes: Sequence[np.ndarray], words: Sequence[np.ndarray]) -> np.ndarray:
        return np.array([
            self.bias + self.voter_weights[v].sum() + (self.word_weights[w].sum() / np.sqrt(len(w)) if len(w) else 0.0) for v, w in zip(votes, words)
        ])

    def fit(self, votes: Sequence[np.ndarray], words: Sequence[np.ndarray], target: np.ndarray, epochs: int) -> "Classifier":
        """Adaptive gradient steps over all rows at a time; nothing depends on their order."""
        rows = np.repeat(np.arange(len(votes)), [len(v) for v in votes])
        at = np.concatenate([np.empty(0, np.int64), *votes]).astype(np.int64)
        word_rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
        word_at = np.concatenate([np.empty(0, np.int64), *words]).astype(np.int64)
        scale = 1 / np.sqrt(np.maximum(1, np.array([len(w) for w in words])))
        n = max(1, len(target))
        memory = [np.full(len(self.voter_weights), 1e-8), np.full(BUCKETS, 1e-8), 1e-8]
        for _ in range(epochs):
            odds = self.bias + np.bincount(rows, self.voter_weights[at], n) + scale * np.bincount(word_rows, self.word_weights[word_at], n)
            error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
            steps = [
                np.bincount(at, error[rows], len(self.voter_weights)) / n + 1e-5 * self.voter_weights,
                np.bincount(word_at, (error * scale)[word_rows], BUCKETS) / n + 1e-3 * self.word_weights,
                error.mean(),
            ]
            for i, (step, rate) in enumerate(zip(steps, (0.5, 0.02, 0.3))):
                memory[i] = memory[i] + step * step
                change = rate * step / np.sqrt(memory[i])
                if i == 0:
                    self.voter_weights -= change
                elif i == 1:
                    self.word_weights -= change
                else:
                    self.bias -= float(change)
        return self


class Model:
    """What scoring needs: the voters, the classifier and the odds that its threshold stands for."""

    def __init__(self, voters: Voters, votes: list[np.ndarray], words: list[np.ndarray], labels: np.ndarray):
        """Of training documents the votes, the word features and the labels (1 or 0)."""
        self.voters = voters
        matrix = np.zeros((len(votes), voters.count), bool)
        for i, v in enumerate(votes):
            matrix[i, v] = True
        self.labels = LabelModel(matrix, labels, ROUNDS) if len(votes) else None
        self.classifier, self.shift = Classifier(voters.count), 0.0
        if len(votes):
            self.classifier.fit(votes, words, self.labels.training_posterior, EPOCHS)
            self.shift = self.cut(self.classifier.odds(votes, words), labels)

    @staticmethod
    def cut(odds: np.ndarray, labels: np.ndarray) -> float:
        """The shift that puts the cut with the best F1 on the training labels at the threshold."""
        if not (labels == 1).any():
            return 0.0
        order = np.argsort(-odds, kind="stable")
        hits = np.cumsum(labels[order] == 1)
        f1 = 2 * hits / (np.arange(1, len(odds) + 1) + (labels == 1).sum())
        # Only between different odds is there a cut.
        f1[:-1][odds[order][:-1] == odds[order][1:]] = -1
        best = int(f1.argmax())
        low = odds[order][best + 1] if best + 1 < len(odds) else odds[order][best] - 2
        return float(np.log(THRESHOLD / (1 - THRESHOLD)) - (odds[order][best] + low) / 2)

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        odds = self.classifier.odds(*features(self.voters, texts)) + self.shift
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def features(voters: Voters, texts: Sequence[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The voters that speak on each text, and its word features."""
    votes, words = [], []
    for text in texts:
        own = words_of(text)
        votes.append(np.array(sorted(set(voters.votes(text, set(own)))), np.int64))
        words.append(buckets_of(own))
    return votes, words


def word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every distinct word of every training document, with the document's label."""
    for batch in pieces_of(batches):
        words, marks = [], []
        for text, mark in zip(batch["text"].to_pylist(), batch["mark"].to_pylist()):
            own = set(words_of(text))
            words += own
            marks += [mark] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(marks, pa.int64())], names=["word", "mark"])


def feature_rows(voters: Voters):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            votes, words = features(voters, batch["text"].to_pylist())
            of_int = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(votes, of_int), pa.array(words, of_int)], names=["doc_id", "mark", "votes", "words"])

    return rows


def lexicon(training: DataFrame) -> list[str]:
    """The words that tell toxic training documents best, by log odds; only such as are far likelier there."""
    n_bad, n = (x or 0 for x in training.agg(F.sum("mark"), F.count("*")).first())
    counts = training.select("text", "mark").mapInArrow(word_sets, "word string, mark long").groupBy("word").agg(
        F.sum("mark").alias("bad"), F.sum(1 - F.col("mark")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n - n_bad + 1))
    best = counts.where(F.col("bad") >= LEAST).withColumn("odds", odds).where("odds > 2").orderBy(F.desc("odds"), "word").limit(LEXICON)
    return [r.word for r in best.collect()]


def scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            scores = model.value.scores(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return score


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out`` (its crc32 modulo 4 is 2: its label is never looked at),
    ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.3 on).

    At most ``train_rows`` labelled documents that are not held out train the model, chosen by a hash of
    their id. Every text is scored whole, empty and null ones by what the model makes of an empty text. Rows
    are scored each for itself, so null ids (never held out), repeated rows and other columns do not matter.
    """
    marks = labels.select(F.col("doc_id").alias("id"), F.col(f"`{label}`").cast("long").alias("mark")).dropna().where(~held_out("id"))
    marks = marks.groupBy("id").agg(F.max("mark").alias("mark")).orderBy(F.xxhash64("id"), "id").limit(train_rows)
    base = corpus(docs, doc_id, text)
    # The sample is bounded by train_rows, so it may be sent to every task and, as features, to the driver.
    training = cut_lineage(base.join(F.broadcast(marks), F.col("doc_id") == F.col("id")).dropDuplicates(["doc_id"]).select("doc_id", "text", "mark"))
    voters = Voters(lexicon(training))
    rows = training.mapInArrow(feature_rows(voters), "doc_id long, mark long, votes array<int>, words array<int>").toPandas().sort_values("doc_id")
    model = Model(
        voters, [np.asarray(v, np.int64) for v in rows["votes"]], [np.asarray(w, np.int64) for w in rows["words"]], rows["mark"].to_numpy(np.int64))
    sent = Sent(docs.sparkSession, model)
    scores = base.mapInArrow(scorer(sent), "doc_id long, score double")
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
