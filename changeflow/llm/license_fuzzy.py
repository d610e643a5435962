"""License scan: exact phrases, and short notices found within a bounded number of edits.

A notice that occurs with at most k edits holds, by the pigeonhole principle, one of any k + 1 pieces of it unchanged.
One Aho-Corasick automaton finds all pieces of all notices in a text's normal form (its words, joined by spaces); around
each hit lies the window in which the whole notice must stand, and there the regex library's bounded-error matching
decides, counts the edits and gives the span. Windows of one notice that overlap are joined first, so a text that repeats
a notice many times is read once. A text is scanned whole, in time that grows with its length and its hits.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, arrow

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWERED = str.maketrans(UPPER, LOWER)

#: Phrases that label a text wherever their words stand one after another.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices in their normal form and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("all rights reserved", "proprietary"),
)
#: One edit for so many characters of a notice.
CHARACTERS_PER_EDIT = 12


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int
    pattern: regex.Pattern = field(compare=False)

    @staticmethod
    def of(text: str, label: str, per_edit: int = CHARACTERS_PER_EDIT) -> "Notice":
        edits = len(text) // per_edit
        # whole words; the first match, improved in place (a best-match search would pass over what stands before the best)
        return Notice(text, label, edits, regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(text, literal_spaces=True)}){{e<={edits}}}(?![^ ])"))

    def pieces(self) -> list[tuple[str, int]]:
        """The notice cut into ``edits + 1`` pieces of nearly equal length, with their places."""
        cuts = [len(self.text) * n // (self.edits + 1) for n in range(self.edits + 2)]
        return [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]


@dataclass(frozen=True)
class Hit:
    label: str
    start: int
    stop: int
    edits: int
    length: int


class Scanner:
    def __init__(self, notices=NOTICES, phrases=None, per_edit: int = CHARACTERS_PER_EDIT):
        self.notices = [Notice.of(t, label, per_edit) for t, label in notices]
        self.phrases = dict(PHRASES if phrases is None else phrases)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, notice in enumerate(self.notices):
            for piece, at in notice.pieces():
                seeds.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def windows(self, normal: str) -> dict[int, list[tuple[int, int]]]:
        """Per notice the joined windows of ``normal`` that can hold it, in order, each cut at word boundaries."""
        found: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.automaton.iter(normal):
            for n, at in places:
                notice = self.notices[n]
                begin = max(0, end + 1 - size - at - notice.edits)
                stop = min(len(normal), end + 1 - size - at + len(notice.text) + notice.edits)
                own = found.setdefault(n, [])
                # hits of different pieces come in no order of their windows' starts, but nearly so
                if own and begin <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(own[-1][0], begin), max(own[-1][1], stop)
                else:
                    own.append([begin, stop])
        return {n: _joined(w, normal) for n, w in found.items()}

    def notices_in(self, normal: str) -> list[Hit]:
        """Verified notices, by place; of those that overlap, the one with fewer edits for its length stays."""
        hits = []
        for n, spans in self.windows(normal).items():
            notice = self.notices[n]
            for begin, stop in spans:
                for m in notice.pattern.finditer(normal, begin, stop):
                    hits.append(Hit(notice.label, m.start(), m.end(), sum(m.fuzzy_counts), len(notice.text)))
        hits.sort(key=lambda h: (h.start, h.stop, h.edits / h.length, -h.length, h.label))
        chosen: list[Hit] = []
        # hits that touch no other group's are decided on their own
        begin, reach = 0, -1
        for n, hit in enumerate(hits):
            if hit.start >= reach:
                chosen += _best(hits[begin:n])
                begin = n
            reach = max(reach, hit.stop)
        return chosen + _best(hits[begin:])

    def phrases_in(self, normal: str) -> list[tuple[int, str]]:
        """Start (in characters) and label of every place of a phrase, overlapping ones included."""
        places, padded = [], f" {normal} "
        for phrase, label in self.phrases.items():
            at = padded.find(f" {phrase} ")
            while at >= 0:
                places.append((at, label))
                at = padded.find(f" {phrase} ", at + 1)
        return sorted(places)


def _best(hits: list[Hit]) -> list[Hit]:
    """Of overlapping hits the best ones that leave each other free, by place."""
    taken: list[tuple[int, int]] = []
    chosen: list[Hit] = []
    for hit in sorted(hits, key=lambda h: (h.edits / h.length, -h.length, h.start, h.label)):
        at = bisect_right(taken, (hit.start, hit.stop))
        free = (at == 0 or taken[at - 1][1] <= hit.start) and (at == len(taken) or hit.stop <= taken[at][0])
        if free:
            taken.insert(at, (hit.start, hit.stop))
            chosen.append(hit)
    return sorted(chosen, key=lambda h: h.start)


def _joined(windows: list[list[int]], normal: str) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, stop in sorted(windows):
        if begin and normal[begin - 1] != " ":
            begin = normal.rfind(" ", 0, begin) + 1
        if stop < len(normal) and normal[stop] != " ":
            end = normal.find(" ", stop)
            stop = len(normal) if end < 0 else end
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([begin, stop])
    return [(a, b) for a, b in out]


def normal_form(text: str) -> str:
    return " ".join(WORD.findall(text.translate(LOWERED) if not text.isascii() else text.lower()))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: id, ``n_words, n_base, first_word, last_word, base_labels, labels, score`` and the notices' spans.

    A span tells label, first word, words and edits. ``score`` is one for a phrase, else the best notice's share of
    unedited characters, zero without either. NULL is an empty text; ids may be NULL or repeat.
    """
    name = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {name}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, notices array<struct<label:string,first_word:bigint,words:bigint,edits:bigint>>"
    )
    spans = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("edits", pa.int64())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), spans]
    names = [id_column, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**options)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                rows = [_judge(scanner, normal_form(t or "")) for t in part.column(1).to_pylist()]
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=names)

    return arrow(docs.select(F.col(id_column).alias(id_column), F.col(text).alias("text")), run, schema)


def _judge(scanner: Scanner, normal: str) -> tuple:
    base, hits = scanner.phrases_in(normal), scanner.notices_in(normal)
    blanks = [m.start() for m in re.finditer(" ", normal)] if base or hits else []
    word_at = lambda at: bisect_left(blanks, at)
    base_labels = {label for _, label in base}
    score = 1.0 if base else max((1 - h.edits / h.length for h in hits), default=0.0)
    notices = [{"label": h.label, "first_word": word_at(h.start), "words": word_at(h.stop) - word_at(h.start) + 1, "edits": h.edits} for h in hits]
    return (
        normal.count(" ") + 1 if normal else 0,
        len(base),
        word_at(base[0][0]) if base else None,
        word_at(base[-1][0]) if base else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | {h.label for h in hits})),
        score,
        notices,
    )
