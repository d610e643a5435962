"""Secret scans: patterns propose candidates, a random forest removes false positives.

Candidates are strings that look like credentials, and whatever is assigned to a credential's name. What tells a credential from a digest, a card number, an address or a
long word are the string itself (length, the transitions between kinds of characters, how usual its letter pairs are,
how much of it dictionary words cover), where it stands (the document's path, quoted, assigned, inside a link) and the
words beside it. The forest learns from labelled findings; ``labelled_findings`` takes them from the corpus itself:
candidates that a credential's fixed format or an assignment to a credential's name proves, and candidates that the
format of something else or a name such as ``sha256`` refutes. Candidates that neither tells are what the forest decides.
Since a label's evidence is among the features, each labelled finding is also learned with that evidence hidden, so that
the forest can judge the string and its place where nothing proves anything.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, fresh, lower_ascii, stored, words

MAX_TRAINING = 20_000
DICTIONARY_WORDS = 20_000
MIN_WORD, MAX_WORD = 3, 12
THRESHOLD = 0.5

#: A private key's armour up to its END line, headers and escapes included. The body stops before any other armour line, so
#: that no text is searched twice; without an END line it is header lines and key lines as far as they go.
PEM = (
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:(?:\s|\\+[nrt])*+(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):(?:[^\r\n\\-]++|-(?!----))*+)*+[A-Za-z0-9+/=\s\\]*+)"
)
#: Fixed formats of well-known credentials.
FORMATS = (
    ("aws_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("github_token", r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,255}(?![A-Za-z0-9])"),
    ("slack_token", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("stripe_key", r"(?<![A-Za-z0-9])[sr]k_live_[A-Za-z0-9]{16,}"),
    ("google_key", r"(?<![A-Za-z0-9])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    ("jwt", r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("private_key", PEM),
)
#: Whatever else may be a credential: a run of 12 key characters or more, of any length, with a digit or a change from
#: lower to upper case. It may follow '=' directly, as in NAME=value; a name before '=' and a value is none, as '=' ends a
#: run only as padding. An armour line that follows without a break is not part of it.
GENERIC = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{12})(?=[A-Za-z+/_-]*(?:[0-9]|(?<=[a-z])[A-Z]))"
    r"(?:[A-Za-z0-9+/_]|-(?!----BEGIN ))(?:[A-Za-z0-9+/_]|-(?!----BEGIN )){11,}+={0,2}(?![A-Za-z0-9+/_=]|-(?!----BEGIN ))"
)
CANDIDATE = re.compile("|".join(f"(?P<{k}>{p})" for k, p in FORMATS) + f"|(?P<generic>{GENERIC})")

NAMES_OF_SECRETS = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "access_key", "auth", "credential", "private_key")
NAMES_OF_OTHERS = ("sha", "md5", "digest", "checksum", "hash", "commit", "uuid", "guid", "id", "version", "order", "card", "phone", "isbn", "example")
#: What is assigned to a name that ends in a credential's word: up to the closing quote, or up to a blank (as without
#: a closing quote on the line), of any length and any characters. A backslash may stand before each quote. In query strings and lists the next ``&name=`` or ``;name=`` ends it.
CREDENTIAL_WORDS = "pass(?:word|wd|phrase|code)?|pwd|secret(?:[_-]?key)?|(?:api|access|private|auth)[_-]?key|token|credentials?|auth"
ASSIGNMENT = re.compile(
    rf"(?:(?<![A-Za-z])|(?<=[a-z0-9])(?=[A-Z]))(?i:{CREDENTIAL_WORDS})(?:\\{{0,2}}[\"'])?[ \t]{{0,4}}(?::=|=>|[:=])[ \t]{{0,4}}"
    r"(?:(?P<quote>\\{0,2}[\"'`])(?P<quoted>(?:(?!(?P=quote))(?:\\[^\r\n]|[^\\\r\n]))++)(?P=quote)"
    r"|(?:\\{0,2}[\"'`])?(?P<bare>(?![=:>\"'`\\])(?:[^\s\"'`&;]|[&;](?![A-Za-z_][\w.-]*+=|\s|$))++))"
)
#: What an assignment's text must hold, in lower case, to be searched for one.
ASSIGNMENT_HINTS = ("pass", "pwd", "secret", "key", "token", "credential", "auth")
#: Values that stand for another: variables, calls, blanks to fill in and words for nothing.
PLACEHOLDER = re.compile(
    r"(?is)[$%]\{?\w+\}?%?|\$\(.*|\{\{.*|<[^<>]*>|\[[^\[\]]*\]|%[sdr]|\{\w*\}|[x*.#_?-]+|(?:self|this|os|process|env|config|settings|request|args|ctx)[.\[].*"
    r"|[A-Za-z_][\w.]*\(.*|none|null|nil|true|false|undefined|empty|required|optional|string|(?:your|my|the|some|any|enter)[ _-].*|change[_-]?me"
)
ASSIGNED = re.compile(r"([A-Za-z_][A-Za-z0-9_.-]{0,60})[\"']?\s{0,4}(?::=|=>|[:=])\s{0,4}[\"'`]?$")
BEFORE, AFTER = 80, 40

FEATURES = (
    "length", "digit_share", "upper_share", "symbol_share", "entropy", "class_changes", "pair_likelihood", "dictionary_share",
    "hex_only", "digits_only", "quoted", "assigned", "in_link", "name_of_secret", "name_of_other", "secret_word_near",
    "other_word_near", "path_hint", "known_format", "placeholder",
)
#: Features that tell of a label's evidence, and what they are where it is hidden.
EVIDENCE = ("name_of_secret", "name_of_other", "digits_only", "in_link", "secret_word_near", "other_word_near", "known_format")


@dataclass(frozen=True)
class Vocabulary:
    """The corpus's commonest words and how likely each pair of lower-case letters is in them."""

    words: frozenset
    pairs: np.ndarray


def vocabulary(docs: DataFrame, text: str = "text", size: int = DICTIONARY_WORDS) -> Vocabulary:
    """Counted over all texts; the ``size`` commonest words of 3 to 12 Latin letters, of like counts the alphabetically first.

    Words are taken by classes of like counts (eight to a doubling), the commonest class first, as long as a whole class
    fits; the one that does not fit is divided by counts, then by ever longer beginnings of words. So the driver gets a few
    histograms and then at most ``size`` words, however many partitions count, and nothing is sorted.
    """
    word = F.explode(words(lower_ascii(F.col(text)))).alias("word")
    counted = docs.select(word).filter(F.col("word").rlike(f"^[a-z]{{{MIN_WORD},{MAX_WORD}}}$")).groupBy("word").count()
    counted = stored(counted.withColumn("class", F.floor(F.log2("count") * 8).cast("int")), "words")
    rest, kept, inside = size, F.lit(False), F.lit(True)
    # by the second key on, what has the first ones in common with the first word left out
    for key in (-F.col("class"), -F.col("count"), *[F.substring("word", 1, n) for n in (3, 6, 9, MAX_WORD)]):
        last = cut = None
        for row in counted.filter(inside).groupBy(key.alias("key")).agg(F.count("*").alias("words")).orderBy("key").collect():
            if row["words"] > rest:
                cut = row["key"]
                break
            rest, last = rest - row["words"], row["key"]
        if last is not None:
            kept = kept | inside & (key <= last)
        if cut is None or not rest:
            break
        inside = inside & (key == cut)
    top = counted.filter(kept).select("word", "count").collect()
    pairs = np.ones((27, 27))
    for row in top:
        at = [0, *[ord(c) - 96 for c in row["word"]], 0]
        np.add.at(pairs, (at[:-1], at[1:]), row["count"])
    return Vocabulary(frozenset(r["word"] for r in top), np.log(pairs / pairs.sum(axis=1, keepdims=True)))


def _covered(value: str, known: frozenset) -> float:
    """Share of characters that lie in dictionary words, longest words first from left to right."""
    at = covered = 0
    while at < len(value):
        for size in range(min(MAX_WORD, len(value) - at), MIN_WORD - 1, -1):
            if value[at : at + size] in known:
                covered += size
                at += size
                break
        else:
            at += 1
    return covered / len(value)


def _features(value: str, kind: str, before: str, after: str, path: str, vocabulary: Vocabulary) -> list[float]:
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value]
    counts = np.unique(np.array([ord(c) for c in value]), return_counts=True)[1] / n
    low = value.lower()
    letters = [ord(c) - 96 if "a" <= c <= "z" else 0 for c in low]
    assigned = ASSIGNED.search(before)
    name = assigned[1].lower() if assigned else ""
    near = f"{before} {after}".lower()
    near_words = set(re.findall("[a-z0-9_]+", near))
    link = re.search(r"(?:://|www\.|/)\S*$", before) is not None or after[:1] in ("/", "@", ".") and after[1:2].isalnum()
    return [
        float(n),
        kinds.count("d") / len(kinds),
        kinds.count("u") / len(kinds),
        kinds.count("s") / len(kinds),
        float(-(counts * np.log2(counts)).sum()),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(len(kinds) - 1, 1),
        float(vocabulary.pairs[letters[:-1], letters[1:]].mean()) if n > 1 else 0.0,
        _covered(low, vocabulary.words),
        float(all(c in "0123456789abcdef" for c in low)),
        float(value.isdigit()),
        float(before[-1:] in "\"'`" and before[-1:] != "" and after[:3].lstrip("\\")[:1] == before[-1:]),
        float(assigned is not None),
        float(link),
        float(any(x in name for x in NAMES_OF_SECRETS)),
        float(bool(name) and any(name == x or x in name and len(x) > 2 for x in NAMES_OF_OTHERS)),
        float(any(x in near_words for x in NAMES_OF_SECRETS)),
        float(any(x in near_words for x in NAMES_OF_OTHERS)),
        float(bool(re.search(r"(?i)config|\.env|secret|credential|deploy|key", path))),
        float(kind not in ("generic", "assigned")),
        float(PLACEHOLDER.fullmatch(value) is not None),
    ]


def find(text: str) -> list[tuple[int, int, str]]:
    """``(start, stop, kind)`` of the candidates of a text in order, none overlapping another.

    An assigned value gives way to a credential's fixed format anywhere in it and to a run of key characters that it equals
    or crosses; runs that lie within it give way to it.
    """
    found = [(m.start(), m.end(), m.lastgroup) for m in CANDIDATE.finditer(text)]
    low = text.lower()
    if not any(x in low for x in ASSIGNMENT_HINTS):
        return found
    out, at = [], 0
    for m in ASSIGNMENT.finditer(text):
        group = "quoted" if m["bare"] is None else "bare"
        start, stop = m.span(group)
        if group == "bare":
            stop = start + len(m[group].rstrip(".,:;!?)]}>") or m[group])
        while at < len(found) and found[at][1] <= start:
            out.append(found[at])
            at += 1
        met = at
        while met < len(found) and found[met][0] < stop:
            met += 1
        inside = all(k == "generic" and start <= a and b <= stop and (a, b) != (start, stop) for a, b, k in found[at:met])
        if inside:
            out.append((start, stop, "assigned"))
        else:
            out.extend(found[at:met])
        at = met
    return out + found[at:]


def candidates(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text: str = "text", path: str = "source", row_column: str | None = None) -> DataFrame:
    """``row, id, kind, start, stop, value_sha256, features, label``: every candidate of every whole text.

    ``row`` numbers the rows of ``docs``, or is their column ``row_column`` if that is given; ``start`` and ``stop`` count characters. ``label``
    is 1 or 0 for a labelled finding, NULL otherwise. The value itself is not given out, only its digest.
    """
    schema = f"row long, {id_column} {docs.schema[id_column].dataType.simpleString()}, kind string, start long, stop long, value_sha256 string, features array<double>, label int"
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by its number of words
    path_column = F.col(path).cast("string") if path in docs.columns else F.lit("")
    number = F.monotonically_increasing_id() if row_column is None else F.col(row_column)
    numbered = docs.select(number.alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text"), path_column.alias("path"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", id_column, "kind", "start", "stop", "value_sha256", "features", "label"]
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                at, found = [], []
                for row, (t, p) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    for start, stop, kind in find(t or ""):
                        value = t[start:stop]
                        before, after = t[max(0, start - BEFORE) : start], t[stop : stop + AFTER]
                        features = _features(value, kind, before, after, p or "", shared.value)
                        at.append(row)
                        found.append((kind, start, stop, sha256(value.encode()).hexdigest(), features, _label(kind, features)))
                rows = pa.array(at, pa.int64())
                columns = list(zip(*found, strict=True)) or [()] * 6
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.int32()]
                arrays = [part.column(0).take(rows), part.column(1).take(rows)]
                arrays += [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return arrow(numbered, scan, schema)


def _label(kind: str, features: list[float]) -> int | None:
    """What the format or the name beside a candidate proves: 1 a credential, 0 something else, None neither."""
    f = dict(zip(FEATURES, features, strict=True))
    if kind == "assigned":
        letters_only = f["digit_share"] + f["symbol_share"] == 0
        if f["placeholder"] or letters_only and not f["quoted"] and f["dictionary_share"] >= 0.8:
            return 0
        if f["quoted"]:
            return 1 if f["dictionary_share"] < 0.5 or not letters_only and not f["digits_only"] else None
        return 1 if f["digit_share"] and not f["digits_only"] else None
    if kind != "generic" or f["name_of_secret"] and not f["name_of_other"] and f["entropy"] >= 2.5 and f["dictionary_share"] < 0.5:
        return 1
    if f["name_of_other"] and not f["name_of_secret"] or f["digits_only"] or f["in_link"] or f["dictionary_share"] >= 0.8:
        return 0
    return None


def train(findings: DataFrame, limit: int = MAX_TRAINING, trees: int = 20, depth: int = 6, seed: int = 11) -> RandomForestClassificationModel | None:
    """A forest fitted on up to ``limit`` labelled findings, those with the smallest hash; None unless both labels occur.

    Findings of equal features and label, such as those of copied documents, count as one. Each enters once as it is and once
    with the features of ``EVIDENCE`` at zero. The sample's bound is a parameter of fitting alone: every candidate is scored.
    """
    labelled = findings.filter("label is not null").select("features", F.col("label").cast("double").alias("label"))
    hidden = [F.lit(0.0) if name in EVIDENCE else F.get("features", F.lit(i)) for i, name in enumerate(FEATURES)]
    views = F.explode(F.array(F.col("features"), F.array(*hidden)))
    labelled = labelled.select(views.alias("features"), "label").dropDuplicates(["features", "label"])
    order = [F.xxhash64("features", "label"), "features"]
    each = [labelled.filter(F.col("label") == x).orderBy(*order).limit(limit // 2) for x in (0.0, 1.0)]
    sample = stored(each[0].unionByName(each[1]).repartition(1).sortWithinPartitions(*order, "label"), "training")
    if sample.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    vectors = sample.select(array_to_vector("features").alias("features"), "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=32, featureSubsetStrategy="sqrt").fit(vectors)


def score(findings: DataFrame, forest: RandomForestClassificationModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """``findings`` with ``probability`` and ``is_secret``; without a forest the labels alone decide.

    Then a finding without a label is no secret and its probability NULL, since nothing tells how likely it is one.
    """
    if forest is None:
        p = F.col("label").cast("double")
        return findings.withColumn("probability", p).withColumn("is_secret", F.coalesce(p >= threshold, F.lit(False)))
    scored = forest.transform(findings.withColumnRenamed("features", "raw").withColumn("features", array_to_vector("raw")))
    p: Column = F.get(vector_to_array("probability"), F.lit(1))
    kept = [F.col("raw").alias("features") if c == "features" else F.col(c) for c in findings.columns]
    return scored.select(*kept, p.alias("probability"), (p >= threshold).alias("is_secret"))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str = "source", limit: int = MAX_TRAINING) -> DataFrame:
    """A row per candidate of ``docs``: id, ``kind, start, stop, value_sha256, probability, is_secret``.

    NULL and empty texts have none; repeated rows give theirs each; a NULL id is carried along.
    """
    found = stored(candidates(docs, vocabulary(docs, text), id_column, text, path), "candidates")
    out = score(found, train(found, limit))
    return out.select(id_column, "kind", "start", "stop", "value_sha256", "probability", "is_secret")


def redact(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str = "source", mark: str = "[SECRET]", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``, and the column ``length``, if there, counted anew.

    The rows are numbered once and stored with their numbers, so that a span finds its row again whatever splits later scans
    are read in. Only texts with secrets are rewritten.
    """
    row, spans = fresh(docs, "row", "spans")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = stored(candidates(numbered, vocabulary(numbered, text), id_column, text, path, row), "candidates")
    secrets = score(found, train(found)).filter("is_secret")
    by_row = secrets.groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(spans))
    # the rows with secrets grow with the table, so they are never broadcast
    joined = numbered.join(by_row.hint("merge"), row, "left")
    changed = F.col(spans).isNotNull()
    # what stands between one span's end and the next one's start, with a mark in each seam
    stops = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["stop"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    parts = F.zip_with(stops, starts, lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int")))
    out = joined.withColumn(text, F.when(changed, F.array_join(parts, mark)).otherwise(F.col(text)))
    if length in docs.columns:
        out = out.withColumn(length, F.when(changed, F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return out.select(docs.columns)
