"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. The numbers
of documents with each pattern of votes are counted over all documents in one grouped
aggregation (at most 3^11 patterns), and expectation-maximisation finds from them how
often each labeller is right and each document's probability of being good. Documents of
a bounded sample, with these probabilities as labels, train a linear scorer over hashed
features; the scorer then decides on every document.

Labellers see whole texts. The scorer sees word hashes and character shapes, not votes,
so it also decides where labellers were silent.

Defined results: null and empty texts have no words and are rejected with score 0;
equal texts get equal scores; a null id stays null; an empty table gives an empty table;
other columns are not read. With fewer than two kinds of documents (all good, say) the
scorer learns the one kind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shingles import mix, word_hashes
from gaugeworks.llm.tables import rows_of
from gaugeworks.session import settle

#: Documents that train the scorer: those with the smallest hash of id.
SAMPLE = 3_000
SHAPES, WORD_BUCKETS = 1024, 1024
#: Score from which on a document is kept.
LEAST = 0.5
#: Very frequent words of English, German, French and Spanish.
FREQUENT_WORDS = (
    "the of and to in a is that it was for on are with as be by this from or an at not "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par sur au pas plus "
    "el los las y que en un una por con no se su para es al lo como del"
).split()
_FREQUENT = np.unique(np.concatenate(word_hashes(FREQUENT_WORDS)))
GOOD, NONE, BAD = 1, 0, -1

#: First and last characters of scripts that set no blanks between words: South-East Asian, Chinese and Japanese ones.
_UNSPACED = np.array([(0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0xA4CF), (0xA980, 0xA9DF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF), (0x20000, 0x3FFFF)])

#: Kinds of bytes: 0 space, 1 line end, 2 lower, 3 upper, 4 digit, 5 sentence sign, 6 to 15 other signs.
_KIND = np.array(
    [
        1 if c == 10
        else 0 if c in b" \t\r\x0b\x0c"
        else 3 if 65 <= c <= 90
        else 2 if 97 <= c <= 122 or c >= 128
        else 4 if 48 <= c <= 57
        else 5 if c in b".,;:'\"-?()"
        else 6 + c % 10
        for c in range(256)
    ],
    np.int64,
)
_SHAPE_BUCKET = (mix(np.arange(4096, dtype=np.uint64)) % np.uint64(SHAPES)).astype(np.int64)


#: Values at which no labeller votes good, or none votes bad.
NEVER = (2.0, 1.0)


def _vote(value: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
    """Good if the value lies in ``good``, bad if in ``bad``, else nothing."""
    return GOOD if good[0] <= value <= good[1] else BAD if bad[0] <= value <= bad[1] else NONE


def _unspaced(text: str, raw: np.ndarray) -> bool:
    """Whether a third of the characters or more are of scripts without blanks between words."""
    if raw.max(initial=0) < 0xE0:  # these take three bytes or more
        return False
    place = np.searchsorted((_UNSPACED + (0, 1)).ravel(), np.frombuffer(text.encode("utf-32-le"), np.uint32), side="right")
    return bool(3 * (place % 2).sum() >= len(text))


def votes(text: str, words: np.ndarray) -> list[int]:
    """One vote per labeller for a text and the hashes of its words.

    Labellers that look for one kind of defect say nothing where they do not find it.
    Frequent words are a sign of good form; a text without them may be in a language
    that the list does not cover. Word lengths are in characters, and say nothing in
    scripts without blanks.
    """
    n = len(words)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=16)
    letters, ink = kinds[2] + kinds[3], max(1, len(raw) - kinds[0] - kinds[1])
    characters = ink - int(((raw & 0xC0) == 0x80).sum())
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    distinct, count = np.unique(words, return_counts=True)
    often = np.isin(distinct, _FREQUENT)
    long_enough = n >= 12
    again = float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0
    pairs = len(np.unique(words[1:] + words[:-1] * np.uint64(3))) / max(n - 1, 1)
    return [
        _vote(again, NEVER, (0.25, 1)) if long_enough else NONE,
        _vote(count.max(initial=0) / max(n, 1), NEVER, (0.35, 1)) if long_enough else NONE,
        _vote(pairs, (0.75, 1), (0, 0.35)) if long_enough else NONE,
        _vote(kinds[3] / max(letters, 1), NEVER, (0.5, 1)) if letters >= 20 else NONE,
        _vote(kinds[6:].sum() / ink, NEVER, (0.12, 1)),
        _vote(text.count("!") / max(n, 1), NEVER, (0.5, 99)) if long_enough else NONE,
        _vote(text.count("|") / max(n, 1), NEVER, (0.2, 99)) if long_enough else NONE,
        _vote(letters / ink, (0.9, 1), (0, 0.55)) if long_enough else NONE,
        _vote(characters / max(n, 1), (3, 11), (16, 1e9)) if long_enough and not _unspaced(text, raw) else NONE,
        _vote(count[often].sum() / max(n, 1), (0.12, 1), NEVER) if n >= 30 else NONE,
        _vote(1 - len(set(lines)) / max(len(lines), 1), NEVER, (0.4, 1)) if len(lines) >= 4 else NONE,
    ]


def features(text: str, words: np.ndarray) -> np.ndarray:
    """Shares of hashed shape triples and of hashed words and word repetitions, square-rooted."""
    kind = _KIND[np.frombuffer(text.encode("utf-8"), np.uint8)]
    triple = kind[:-2] * 256 + kind[1:-1] * 16 + kind[2:]
    shape = np.bincount(_SHAPE_BUCKET[triple], minlength=SHAPES) / max(len(triple), 1)
    bucket = (words % np.uint64(WORD_BUCKETS - 2)).astype(np.int64) + 2
    word = np.bincount(bucket, minlength=WORD_BUCKETS) / max(len(words), 1)
    if len(words) > 1:
        word[0] = (words[1:] == words[:-1]).mean()
        word[1] = (words[2:] == words[:-2]).mean() if len(words) > 2 else 0
    return np.sqrt(np.concatenate([shape, word]))


#: Bounds of the odds that one vote may carry: no vote counts against its name, and none decides alone for ever.
BAD_ODDS, GOOD_ODDS = (1.0, 200.0), (1.0, 200.0)


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and per labeller the log odds for good of a bad, no and good vote."""

    good: float
    evidence: np.ndarray  # labeller by vote (bad, none, good)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good per row of votes."""
        odds = np.log(self.good / (1 - self.good)) + self.evidence[np.arange(patterns.shape[1]), patterns + 1].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over patterns of votes and their numbers of documents.

    A labeller's accuracy is how many times likelier its vote is in the class it names
    than in the other; votes are weighed by these odds, estimated with pseudo-counts and
    kept within bounds, so that no labeller is turned against its name by others that
    happen to agree with each other. Starts from the votes, a bad one counting twice.
    """
    weight = counts.astype(float)
    good = np.clip(0.5 + 0.2 * ((patterns > 0).sum(axis=1) - 2.0 * (patterns < 0).sum(axis=1)), 0.02, 0.98)
    model = LabelModel(0.5, np.zeros((patterns.shape[1], 3)))
    for _ in range(rounds):
        n_good, n_bad = (weight * good).sum(), (weight * (1 - good)).sum()

        def odds(vote: int, of: np.ndarray, n_of: float, n_other: float, bounds: tuple[float, float]) -> np.ndarray:
            hit = (patterns == vote) * weight[:, None]
            own, other = (hit * of[:, None]).sum(axis=0), (hit * (1 - of)[:, None]).sum(axis=0)
            return np.log(np.clip((own + 1) / (n_of + 2) / ((other + 1) / (n_other + 2)), *bounds))

        bad_votes = -odds(BAD, 1 - good, n_bad, n_good, BAD_ODDS)
        good_votes = odds(GOOD, good, n_good, n_bad, GOOD_ODDS)
        share = float(np.clip(n_good / max(n_good + n_bad, 1e-9), 1e-3, 1 - 1e-3))
        model = LabelModel(share, np.stack([bad_votes, np.zeros_like(bad_votes), good_votes], axis=1))
        before, good = good, model.posterior(patterns)
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return model


def fit_scorer(x: np.ndarray, label: np.ndarray, rounds: int = 200, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on soft labels, both classes weighing the same."""
    if not len(x):
        return np.zeros(SHAPES + WORD_BUCKETS), 0.0
    good = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    importance = (label / (2 * good) + (1 - label) / (2 * (1 - good))).astype(np.float32)
    x, label = x.astype(np.float32), label.astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    speed_w, speed_b = np.zeros_like(w), 0.0
    for _ in range(rounds):
        z = x @ (w + 0.9 * speed_w) + b + 0.9 * speed_b
        error = (importance * (1 / (1 + np.exp(-z)) - label) / len(x)).astype(np.float32)
        speed_w = (0.9 * speed_w - 4.0 * (error @ x + ridge * w)).astype(np.float32)
        speed_b = 0.9 * speed_b - 4.0 * error.sum()
        w, b = w + speed_w, b + speed_b
    return w, float(b)


def _voted(source: DataFrame) -> DataFrame:
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [bytes(v + 1 for v in votes(t, w)) for t, w in zip(texts, word_hashes(texts), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=["id", "votes"])

    return source.mapInArrow(vote, f"id {dict(source.dtypes)['id']}, votes binary")


def label_model(source: DataFrame) -> LabelModel:
    """The label model of all texts of ``source`` (id, text)."""
    counts = _voted(source).groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()  # one row per pattern
    labellers = len(votes("", word_hashes([""])[0]))
    patterns = np.array([list(r["votes"]) for r in counts], np.int64).reshape(len(counts), labellers) - 1
    return fit_labels(patterns, np.array([r["n"] for r in counts], np.int64))


def _training_rows(source: DataFrame, sample: int) -> DataFrame:
    """Texts of the ``sample`` documents with the smallest hash of their id and text."""
    mark = F.xxhash64("id", "text")
    hashes = source.where("text is not null").select(mark.alias("h"))
    limit = hashes.orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    return source.where(mark <= limit) if limit is not None else source.limit(0)


def _fitted(source: DataFrame, sample: int) -> Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]:
    """Label model and scorer of (id, text), as a function from texts to scores and probabilities of good."""
    model = label_model(source)

    def example(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            words = word_hashes(texts)
            rows = [features(t, w).astype(np.float16).tobytes() for t, w in zip(texts, words, strict=True)]
            good = model.posterior(np.array([votes(t, w) for t, w in zip(texts, words, strict=True)]))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(good)], names=["x", "good"])

    rows = settle(_training_rows(source, sample).mapInArrow(example, "x binary, good double"), "examples")
    examples = rows.orderBy("good", "x").limit(sample).collect()  # bounded: ``sample`` rows of 4 kB
    x = np.array([np.frombuffer(r["x"], np.float16) for r in examples], np.float32).reshape(len(examples), SHAPES + WORD_BUCKETS)
    weights, intercept = fit_scorer(x, np.array([r["good"] for r in examples], np.float32))

    def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        texts = [t or "" for t in texts]
        words = word_hashes(texts)
        good = model.posterior(np.array([votes(t, w) for t, w in zip(texts, words, strict=True)]))
        z = np.array([features(t, w) @ weights + intercept for t, w in zip(texts, words, strict=True)])
        return np.where([len(w) > 0 for w in words], 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0), good

    return score


def quality(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE, least: float = LEAST) -> DataFrame:
    """Per row its score, the label model's probability of good, and whether it is kept (score at least ``least``)."""
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    score = _fitted(source, sample)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            scores, good = score(batch.column("text").to_pylist())
            columns = [batch.column("id"), pa.array(scores), pa.array(good), pa.array(scores >= least)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "p_good", "keep"])

    kind = dict(source.dtypes)["id"]
    return source.mapInArrow(judge, f"id {kind}, score double, p_good double, keep boolean").withColumnRenamed("id", id_column)


def keep_good(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE, least: float = LEAST) -> DataFrame:
    """The rows of ``df`` that :func:`quality` keeps, whole and without a shuffle."""
    score = _fitted(df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), sample)

    def good_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            yield batch.filter(pa.array(score(batch.column(text_column).to_pylist())[0] >= least))

    return df.mapInArrow(good_rows, df.schema)
