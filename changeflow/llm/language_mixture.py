"""Language proportions of a text by expectation-maximisation, with the set of languages chosen by penalised likelihood.

Training counts the character trigrams of labelled texts per language. A text is then taken as a mixture: each of its
trigrams was drawn from one of the languages, and the proportions that make the trigrams likeliest are found by
expectation-maximisation. More languages never make a text less likely, so a set pays a penalty for each language in it;
starting from all, the least present language is taken out for as long as the penalised likelihood rises.

Trigrams fall into a fixed number of buckets by a hash of their code points, so the model's size is languages times
buckets, whatever the corpus. Counting is one pass with a bounded table per task; scoring needs no shuffle.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

from .common import arrow, fresh, map_column

BUCKETS = 1 << 14
SMOOTHING = 0.5
ROUNDS = 25
#: What one more language costs, in units of the logarithm of the number of trigrams; trigrams overlap by two thirds,
#: so they tell a third of what independent draws would.
PENALTY = 0.5
EVIDENCE = 1 / 3
UNKNOWN = "und"
#: Distinct trigrams times languages that are worked on together, 32 MB in each of a few arrays; a single text may be more,
#: up to buckets times languages.
CELLS = 1 << 22


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves remainder 2 by 4; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trigram_buckets(text: str) -> np.ndarray:
    """Bucket of each trigram of the lower-cased text between blanks, runs of anything but letters being one blank."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # letters of any script lie above the ASCII ones; what else lies there acts as a letter of its own
    letter = (code >= 0x61) & (code <= 0x7A) | (code >= 0xAA) & (code != 0xD7) & (code != 0xF7) & ~((code >= 0x2000) & (code <= 0x2BFF))
    code = np.where(letter, code, np.uint32(32))
    code = np.concatenate(([np.uint32(32)], code, [np.uint32(32)]))
    code = code[np.concatenate(([True], (code[1:] != 32) | (code[:-1] != 32)))].astype(np.uint64)
    if len(code) < 3:
        return np.empty(0, dtype=np.int64)
    word = (code[:-2] << np.uint64(42)) ^ (code[1:-1] << np.uint64(21)) ^ code[2:]
    word = (word ^ (word >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (word >> np.uint64(64 - 14)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """``languages`` in order; ``logs``: buckets by languages, log probabilities; ``prior``: share of training texts."""

    languages: tuple[str, ...]
    logs: np.ndarray
    prior: np.ndarray


def fit(train: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> LanguageModel:
    """The model of all rows of ``train`` that have a text and a language.

    A task counts into one table per language and gives it as rows (language, bucket, count), which are summed before
    they come to the driver: at most languages times buckets rows. Languages are expected in the hundreds.
    """
    labelled = train.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for language, words in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    table = tables.setdefault(language, np.zeros(buckets + 1, dtype=np.int64))
                    table[:buckets] += np.bincount(trigram_buckets(words) % buckets, minlength=buckets)
                    table[buckets] += 1
        for language, table in tables.items():
            (full,) = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(full)), pa.array(full), pa.array(table[full])], names=["lang", "bucket", "n"]
            )

    counted = arrow(labelled, count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    place = {name: at for at, name in enumerate(names)}
    counts = np.zeros((buckets + 1, len(names)))
    at = np.array([place[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
    counts[rows.column("bucket").to_numpy().astype(np.int64), at] = rows.column("n").to_numpy()
    smooth = counts[:buckets] + SMOOTHING
    prior = (counts[buckets] + 1) / (counts[buckets].sum() + len(names)) if names else np.empty(0)
    return LanguageModel(tuple(names), np.log(smooth / smooth.sum(axis=0)) if names else np.zeros((buckets, 0)), prior)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def _mixtures(logs: np.ndarray, weight: np.ndarray, starts: np.ndarray, of: np.ndarray, active: np.ndarray) -> tuple:
    """Proportions and log likelihoods of the texts whose trigrams lie one after another, over their active languages."""
    top = logs.max(axis=1)
    likely = np.exp(logs - top[:, None])
    total = _sums(weight, starts)
    share = active / active.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = likely * share[of]
        part *= (weight / part.sum(axis=1))[:, None]
        share = _sums(part, starts) / total[:, None]
    fit_of = _sums(weight * (np.log((likely * share[of]).sum(axis=1)) + top), starts)
    return share, fit_of


def infer(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the proportions by language (zero for languages not in the chosen set) and the number of trigrams.

    Texts are worked on together up to ``CELLS``. Those without a trigram get no proportions and zero trigrams.
    """
    shares, numbers, group, cells = [], [], [], 0
    for t in texts:
        counted = np.unique(trigram_buckets(t) % len(model.logs), return_counts=True)
        size = len(counted[0]) * len(model.languages)
        if group and cells + size > CELLS:
            done = _infer(model, group)
            shares.append(done[0])
            numbers.append(done[1])
            group, cells = [], 0
        group.append(counted)
        cells += size
    done = _infer(model, group)
    return np.concatenate([*shares, done[0]]), np.concatenate([*numbers, done[1]])


def _infer(model: LanguageModel, found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``infer`` for texts given as their distinct buckets and how often each occurs."""
    n = np.array([int(c.sum()) for _, c in found], dtype=np.int64)
    shares = np.zeros((len(found), len(model.languages)))
    rows = np.flatnonzero(n)
    if not len(rows) or not model.languages:
        return shares, n
    sizes = np.array([len(found[r][0]) for r in rows])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    of = np.repeat(np.arange(len(rows)), sizes)
    logs = model.logs[np.concatenate([found[r][0] for r in rows])]
    weight = np.concatenate([found[r][1] for r in rows]).astype(np.float64)
    cost = PENALTY * np.log(n[rows] + 1.0) / EVIDENCE
    single = _sums(logs * weight[:, None], starts) + np.log(model.prior) / EVIDENCE
    best_one = single.argmax(axis=1)
    chosen = np.eye(len(model.languages))[best_one]
    if len(model.languages) > 1:
        _eliminate(model, logs, weight, starts, of, cost, single.max(axis=1), chosen)
    shares[rows] = chosen
    return shares, n


def _eliminate(model, logs, weight, starts, of, cost, best, chosen) -> None:
    """Write into ``chosen`` the proportions of the set with the highest penalised likelihood on the way down from all.

    A set is worth its likelihood less ``cost`` for each language beyond the first. ``best`` holds the worth of one
    language alone, which no mixture can beat if the likelihood under all languages, less one cost, does not.
    """
    live = np.arange(len(chosen))
    active = np.ones_like(chosen)
    while len(live):
        size = np.diff(np.append(starts, len(of)))
        share, likelihood = _mixtures(logs, weight, starts, of, active)
        extra = active.sum(axis=1) - 1
        worth = likelihood - cost * extra
        better = (worth > best) & (extra > 0)
        chosen[live[better]] = share[better]
        best = np.where(better, worth, best)
        # a subset has at most this likelihood, and pays for one more language at least
        go = (likelihood - cost > best) & (extra > 1)
        if not go.any():
            return
        weakest = np.where(active > 0, share, np.inf).argmin(axis=1)
        active[np.arange(len(active)), weakest] = 0
        keep = np.repeat(go, size)
        logs, weight, of = logs[keep], weight[keep], np.repeat(np.arange(go.sum()), size[go])
        starts = np.concatenate(([0], np.cumsum(size[go])[:-1]))
        active, cost, best, live = active[go], cost[go], best[go], live[go]


def with_languages(df: DataFrame, model: LanguageModel, text: str = "text") -> tuple[DataFrame, str, str, str]:
    """``df`` with the leading language, its proportion and the map of all chosen proportions; the three columns' names.

    The language is ``und`` and the proportion zero where the text is NULL or has no letter. A text of letters too short
    for a trigram, or of none that training saw, gets the language that is likeliest all the same.
    """
    lang, score, mix, letters = fresh(df, "lang_pred", "score", "mixture", "letters")
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages times buckets doubles

    def work(texts: list) -> list[pa.Array]:
        m = shared.value
        shares, _ = infer(m, [t or "" for t in texts])
        led = shares.argmax(axis=1) if m.languages else np.zeros(len(texts), dtype=int)
        names, scores, mixes = [], [], []
        for t, row, at in zip(texts, shares, led, strict=True):
            known = t is not None and bool(m.languages)
            if known and not row.any():
                at = int(m.prior.argmax())
                row = m.prior
            names.append(m.languages[at] if known else UNKNOWN)
            scores.append(min(float(row[at]), 1.0) if known else 0.0)
            mixes.append([(m.languages[k], float(row[k])) for k in np.flatnonzero(row)] if known else [])
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(mixes, pa.map_(pa.string(), pa.float64()))]

    # only texts with a letter (of any script, as the regular expression engine knows them) go to work
    lettered = df.withColumn(letters, F.when(F.col(text).rlike("\\p{L}"), F.col(text)))
    schema = StructType([StructField(lang, StringType()), StructField(score, DoubleType()), StructField(mix, MapType(StringType(), DoubleType()))])
    return map_column(lettered, letters, schema, work).drop(letters), lang, score, mix


def identify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: id, whether it was held out of training, ``lang_pred``, ``score`` (the proportion) and the mixture.

    Trained on the rows of ``docs`` that are not held out. A NULL id is neither held out nor trained on; repeated rows
    are answered each; without any labelled row every answer is ``und``.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = fit(rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    seen, lang_pred, score, mixture = with_languages(rows.select("doc_id", "text"), model)
    return seen.select(
        F.col("doc_id").alias(id_column),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(lang_pred).alias("lang_pred"),
        F.col(score).alias("score"),
        F.col(mixture).alias("mixture"),
    )


def rows_with_language(docs: DataFrame, min_share: float = 0.4, **columns) -> DataFrame:
    """The rows of ``docs`` with a leading language that holds at least ``min_share`` of the text."""
    id_column, text, lang = (columns.get(c, c) for c in ("doc_id", "text", "lang"))
    train = docs.filter(F.col(id_column).isNotNull() & ~held_out(F.col(id_column)))
    seen, lang_pred, score, _ = with_languages(docs, fit(train, text, lang), text)
    return seen.filter((F.col(lang_pred) != UNKNOWN) & (F.col(score) >= min_share)).select(docs.columns)
