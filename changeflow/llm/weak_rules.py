"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at one signal of a text and votes good (1), bad (0) or abstains (NULL). How far a vote can be trusted is
estimated without labels: expectation-maximisation over the vote patterns of all texts finds the share of good texts
and, for each rule, how often it votes rightly on good and on bad ones. A text's quality is the posterior probability of
good given its votes, so one doubtful vote does not reject a text that the other rules vouch for.

Bad texts are bad in different ways, and a rule that knows one way votes good on the others. So the hidden state is one
of several kinds, good or one kind of bad, and a rule's accuracy is estimated for each. (With a single bad class the
estimate settles on the commonest way to be bad, repetition, and lets noisy texts pass as good ones.) The patterns number
at most 3^rules however many texts there are: one aggregate counts them, and the rounds run on the counts.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, fresh, let, stored, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Frequent function words of the languages in scope.
FUNCTION_WORDS = (
    "the of and to in is that for it with as was on be by at from this "
    "le la les et des est une dans que pour qui pas sur au "
    "der die und das den ist von mit zu nicht ein auf für sich "
    "el los las del con por una para es se en"
).split()
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _removed(text: Column, characters: str) -> Column:
    """How many of ``characters`` the text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


#: Bits of a packed window that tell its place; the others are from its hash.
PLACE_BITS = 24


def _suspects(w: Column) -> Column:
    """Places of the three-word windows whose hash another window shares, and so of all that occur twice or more.

    Hash and place of a window fill one long, since an array of longs is sorted without comparing strings. A text
    of so many words that a place does not fit its bits suspects every window.
    """
    starts = F.sequence(F.lit(0), F.size(w) - 3)
    hashed = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    packed = F.transform(starts, lambda i: F.shiftleft(hashed(i), PLACE_BITS).bitwiseOR(i.cast("long")))

    def places(p: Column) -> Column:
        same = lambda x, k: F.coalesce(F.shiftright(x, PLACE_BITS) == F.shiftright(F.get(p, k), PLACE_BITS), F.lit(False))
        shared = F.filter(p, lambda x, k: same(x, k + 1) | same(x, k - 1))
        return F.transform(shared, lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))

    return F.when(F.size(w) < 1 << PLACE_BITS, let(F.sort_array(packed), places)).otherwise(starts)


def _repeat_words(w: Column) -> Column:
    """Words that lie in a three-word window which the text has twice or more.

    Sorting the windows puts equal ones side by side; the places of those with an equal neighbour, in order, each cover
    three words less what the next place covers. Only windows of equal hashes are compared as strings.
    """
    windows = F.transform(_suspects(w), lambda i: F.struct(F.array_join(F.slice(w, i + 1, 3), " ").alias("s"), i.alias("i")))

    def places(s: Column) -> Column:
        as_next = lambda x, k: F.coalesce(x["s"] == F.get(s, k + 1)["s"], F.lit(False))
        as_last = lambda x, k: F.coalesce(x["s"] == F.get(s, k - 1)["s"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, k: as_next(x, k) | as_last(x, k)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        own = F.transform(p, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - at, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda total, n: total + n)

    return F.when(F.size(w) >= 3, let(let(F.array_sort(windows), places), covered)).otherwise(0).cast("long")


def _line_signals(lines: Column) -> Column:
    ended = F.filter(lines, lambda x: F.rtrim(x).rlike("[.!?:;\"'”»)]$"))
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(ended).cast("long").alias("n_ended_lines"),
    )


def _word_signals(w: Column) -> Column:
    known = F.array(*[F.lit(x) for word in FUNCTION_WORDS for x in (word, word.capitalize())])
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_kinds"),
        F.size(F.array_intersect(w, known)).cast("long").alias("n_function_words"),
    )


def signals(text: Column) -> Column:
    """A struct of counts over the whole text; NULL and empty texts count as no words and no lines."""
    whole = F.coalesce(text, F.lit(""))
    with_word = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    of_words, of_lines = let(words(whole), _word_signals), let(with_word, _line_signals)
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        F.length(F.translate(whole, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _removed(whole, SYMBOLS).alias("n_symbols"),
        _removed(whole, UPPER).alias("n_upper"),
        _removed(whole, LOWER).alias("n_lower"),
        _removed(whole, "!").alias("n_exclaim"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1)).cast("byte")


def rules(s: Column) -> dict[str, Column]:
    """Votes over a struct of signals: 1 good, 0 bad, NULL abstains. None votes on a text without words."""
    n = s["w"]["n_words"]
    letters = s["n_upper"] + s["n_lower"]
    per_word = lambda x: F.try_divide(x, n)
    some = n > 0
    return {
        "words_of_usual_length": _vote(per_word(s["word_chars"]).between(3, 10), some & ~per_word(s["word_chars"]).between(2, 14)),
        "few_symbols": _vote(per_word(s["n_symbols"]) <= 0.02, per_word(s["n_symbols"]) > 0.1),
        "few_repeated_lines": _vote(
            (s["l"]["n_lines"] >= 3) & (s["l"]["n_dup_lines"] == 0), s["l"]["n_dup_lines"] > 0.3 * s["l"]["n_lines"]
        ),
        "few_repeated_words": _vote(some & (s["w"]["n_repeat_words"] <= 0.1 * n), s["w"]["n_repeat_words"] > 0.3 * n),
        "rich_vocabulary": _vote(some & (s["w"]["n_kinds"] >= 0.3 * n), s["w"]["n_kinds"] < 0.1 * F.least(n, F.lit(1000))),
        "mostly_lower_case": _vote((letters > 0) & (s["n_upper"] <= 0.2 * letters), s["n_upper"] > 0.5 * letters),
        "function_words": _vote(s["w"]["n_function_words"] >= 2, some & (s["w"]["n_function_words"] == 0)),
        "lines_end_as_sentences": _vote(
            some & (s["l"]["n_ended_lines"] >= 0.5 * s["l"]["n_lines"]),
            (s["l"]["n_lines"] >= 3) & (s["l"]["n_ended_lines"] < 0.1 * s["l"]["n_lines"]),
        ),
        "few_exclamations": _vote(some & (s["n_exclaim"] <= 0.02 * n), s["n_exclaim"] > 0.2 * n),
    }


def with_votes(df: DataFrame, text: str = "text") -> tuple[DataFrame, str, str]:
    """``df`` with a struct of signals and a struct of votes, and the names of the two columns."""
    measured, voted = fresh(df, "signals", "votes")
    seen = df.withColumn(measured, let(signals(F.col(text)), lambda s: s))
    votes = F.struct(*[v.alias(k) for k, v in rules(F.col(measured)).items()])
    return seen.withColumn(voted, votes), measured, voted


#: Kinds of bad texts and the rules written to catch them.
KINDS = {
    "repetitive": ("few_repeated_lines", "few_repeated_words", "rich_vocabulary"),
    "noisy": ("few_symbols",),
    "shouting": ("mostly_lower_case", "few_exclamations"),
    "no_prose": ("function_words", "lines_end_as_sentences"),
    "misshapen": ("words_of_usual_length",),
}
GOOD = "good"


@dataclass(frozen=True)
class LabelModel:
    """``share``: of each kind among the texts; ``bad_vote``: per kind and rule, how often its votes are bad ones."""

    share: dict[str, float]
    bad_vote: dict[str, dict[str, float]]

    def joint(self, votes: Column) -> Column:
        """Array by kind: the probability of the kind and of these votes; a rule that abstains takes no part.

        The parameters enter as array constants, so the compiled code stays the same from round to round.
        """
        rates = F.array(*[F.array(*[F.lit(p) for p in by_rule.values()]) for by_rule in self.bad_vote.values()])
        shares = F.array(*[F.lit(x) for x in self.share.values()])
        cast = F.array(*[votes[r] for r in self.bad_vote[GOOD]])
        factor = lambda v, p: F.when(v == 0, p).when(v == 1, 1 - p).otherwise(1.0)
        return let(
            cast,
            lambda c: F.zip_with(shares, rates, lambda x, row: F.aggregate(F.zip_with(c, row, factor), x, lambda a, f: a * f)),
        )

    def posteriors(self, votes: Column) -> Column:
        """Array by kind: the probability of the kind given the votes; the shares where all abstain."""
        return let(
            self.joint(votes),
            lambda j: let(F.aggregate(j, F.lit(0.0), lambda a, x: a + x), lambda whole: F.transform(j, lambda x: x / whole)),
        )

    def posterior(self, votes: Column) -> Column:
        """The probability of good given the votes."""
        return F.get(self.posteriors(votes), list(self.share).index(GOOD))


def start(rules_of: dict[str, tuple[str, ...]], names: list[str]) -> LabelModel:
    kinds = [GOOD, *rules_of]
    share = {k: 0.8 if k == GOOD else 0.2 / len(rules_of) for k in kinds}
    return LabelModel(share, {k: {r: 0.8 if r in rules_of.get(k, ()) else 0.02 for r in names} for k in kinds})


def fit(
    voted: DataFrame, votes: str, kinds: dict[str, tuple[str, ...]] = KINDS, tolerance: float = 1e-6, patience: int = 20_000
) -> LabelModel:
    """The label model of all rows of ``voted`` by expectation-maximisation.

    It starts from rules that catch four of five bad texts of their kind and fault one in fifty others, and counts ten
    imagined votes of that sort for each (so a rule that never votes keeps its start). What the names mean is held fast:
    a rule faults between one in a hundred and one in twenty good texts and catches at least half of its own kind. Without rows the start is
    returned.

    Spark counts how often each pattern of votes occurs; patterns number at most three to the power of the rules, so the
    rounds run on their counts alone. They end when a round moves no parameter by ``tolerance``; not getting there
    within ``patience`` rounds is an error. Two kinds that share texts drift apart slowly, so every two rounds are followed
    by a squared step along their direction, which is taken back if it makes the votes less likely.
    """
    names = [f.name for f in voted.schema[votes].dataType.fields]
    counted = voted.groupBy(*[F.col(votes)[n].alias(n) for n in names]).agg(F.count("*").alias("texts"))
    patterns = sorted(counted.collect(), key=lambda row: [-1 if v is None else v for v in row])
    first = start(kinds, names)
    if not patterns:
        return first
    rounds = _Rounds(patterns, first, kinds, names)
    here, done = rounds.vector(first), 0
    while done < patience:
        one, _ = rounds.step(here)
        two, _ = rounds.step(one)
        done += 2
        if np.abs(two - one).max() < tolerance:
            return rounds.model(two)
        step, bend = one - here, two - 2 * one + here
        far = np.linalg.norm(step) / max(np.linalg.norm(bend), 1e-300)
        here = two
        if far > 1:
            leap = rounds.allowed(one - step + 2 * far * step + far * far * bend)
            after, likely = rounds.step(leap)
            _, likely_before = rounds.step(two)
            done += 2
            if likely >= likely_before:
                here = after
    raise RuntimeError(f"the accuracies of the rules still move after {done} rounds")


class _Rounds:
    """Rounds of the estimate over counted patterns; a point is the shares and the rates of all kinds in one vector."""

    def __init__(self, patterns: list, first: LabelModel, kinds: dict[str, tuple[str, ...]], names: list[str]):
        self.first, self.kinds, self.names, self.all = first, kinds, names, list(first.share)
        self.texts = np.array([float(row["texts"]) for row in patterns])
        # a place past the last rule, where every text "votes", sums the kinds themselves
        cast = np.array([[*(row[n] for n in names), 0] for row in patterns], dtype=float)
        self.bad, self.good = cast == 0, cast == 1

    def vector(self, model: LabelModel) -> np.ndarray:
        return np.array([*model.share.values(), *(p for by_rule in model.bad_vote.values() for p in by_rule.values())])

    def model(self, at: np.ndarray) -> LabelModel:
        shares, rates = at[: len(self.all)], at[len(self.all) :].reshape(len(self.all), -1)
        by_kind = {k: dict(zip(self.names, map(float, row), strict=True)) for k, row in zip(self.all, rates, strict=True)}
        return LabelModel(dict(zip(self.all, map(float, shares), strict=True)), by_kind)

    def allowed(self, at: np.ndarray) -> np.ndarray:
        """The point moved to where shares add up to one and rates are within their bounds."""
        shares = np.maximum(at[: len(self.all)], 1e-9)
        model = self.model(np.concatenate([shares / shares.sum(), at[len(self.all) :]]))
        held = {k: {r: _held(p, k, r in self.kinds.get(k, ())) for r, p in row.items()} for k, row in model.bad_vote.items()}
        return self.vector(LabelModel(model.share, held))

    def step(self, at: np.ndarray) -> tuple[np.ndarray, float]:
        """The next point, and how likely the votes, imagined ones included, are at this one."""
        shares, rates = at[: len(self.all)], at[len(self.all) :].reshape(len(self.all), -1)
        joint = np.log(shares) + self.bad[:, :-1] @ np.log(rates).T + self.good[:, :-1] @ np.log1p(-rates).T
        top = joint.max(axis=1, keepdims=True)
        whole = top + np.log(np.exp(joint - top).sum(axis=1, keepdims=True))
        weight = (np.exp(joint - whole) * self.texts[:, None]).T
        bad, cast = weight @ self.bad, weight @ (self.bad | self.good)
        found = {(k, r): (bad[k, r], cast[k, r]) for k in range(len(self.all)) for r in range(len(self.names) + 1)}
        began = self.vector(self.first)
        imagined, starts = began[: len(self.all)], began[len(self.all) :].reshape(len(self.all), -1)
        likely = float(self.texts @ whole[:, 0]) + 10 * float(imagined @ np.log(shares) + (starts * np.log(rates) + (1 - starts) * np.log1p(-rates)).sum())
        return self.vector(_estimate(found, self.first, self.kinds, self.names)), likely


def _estimate(found: dict, first: LabelModel, kinds: dict[str, tuple[str, ...]], names: list[str]) -> LabelModel:
    """Rates and shares from the sums by kind and rule, the imagined votes included."""
    texts = sum(found[k, len(names)][1] for k in range(len(first.share)))
    share, bad_vote = {}, {}
    for at, k in enumerate(first.share):
        share[k] = (found[at, len(names)][1] + 10 * first.share[k]) / (texts + 10)
        bad_vote[k] = {}
        for n, r in enumerate(names):
            bad, voted = found.get((at, n), (0.0, 0.0))
            bad_vote[k][r] = _held((bad + 10 * first.bad_vote[k][r]) / (voted + 10), k, r in kinds.get(k, ()))
    return LabelModel(share, bad_vote)


def _held(rate: float, kind: str, own: bool) -> float:
    low, high = (0.01, 0.05) if kind == GOOD else (0.5, 0.9999) if own else (0.0001, 0.9999)
    return min(max(rate, low), high)


def base_failed(s: Column) -> Column:
    return (s["w"]["n_words"] < MIN_WORDS) | (100 * s["w"]["n_repeat_words"] > MAX_REPEAT_PERCENT * s["w"]["n_words"])


def judge(docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """A row per row of ``docs``: id, base counts, ``base_failed``, ``kept``, ``quality`` (the posterior) and the votes.

    NULL texts have no words and fail the base; ids may be NULL or repeat, and every row is answered.
    """
    voted, measured, votes = with_votes(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")))
    seen = stored(voted.drop("text"), "votes")
    s = F.col(measured)
    quality = fit(seen, votes).posterior(F.col(votes))
    return seen.select(
        F.col("doc_id").alias(id_column),
        s["w"]["n_words"].alias("n_words"),
        s["word_chars"].alias("word_chars"),
        s["n_symbols"].alias("n_symbols"),
        s["l"]["n_dup_lines"].alias("n_dup_lines"),
        s["w"]["n_repeat_words"].alias("n_repeat_words"),
        base_failed(s).alias("base_failed"),
        (~base_failed(s) & (quality >= threshold)).alias("kept"),
        quality.alias("quality"),
        F.col(votes).alias("votes"),
    )


def good_rows(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass the base and whose quality reaches ``threshold``, with the columns of ``docs``."""
    voted, measured, votes = with_votes(docs, text)
    seen = stored(voted, "voted")
    quality = fit(seen, votes).posterior(F.col(votes))
    return seen.filter(~base_failed(F.col(measured)) & (quality >= threshold)).select(docs.columns)
