"""Exact encoding with a merge-type (BPE) SentencePiece model, by backtracking, and decoding by the library.

The library merges the best-scored adjacent pair again and again. The same result is the only sequence of pieces in
which every two neighbours are compatible: merging their joined text from scratch gives those two pieces back. So an
encoder may walk from left to right, take the longest piece that starts where it stands and is compatible with the one
before, and step back when none is; positions from which no way led on are marked in a bitfield and never tried again.
Pieces are looked up in a trie, that of an Aho-Corasick automaton whose failure links are not used: the longest prefix of
what follows is asked for at each position where a piece may start, in place of one pass that finds all pieces of a text.

Text is first cut where no piece of the vocabulary crosses (before a space mark, after a letter that no letter follows);
no merge can cross there either. The parts repeat a lot, so their encodings are remembered, in bounded memory.
"""

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from operator import add

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow

MARK = "▁"
#: Letters of the Latin and Cyrillic scripts.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏЀ-ӿ"
#: From the finest to the coarsest; the first that no piece of the vocabulary crosses is used.
CUTS = (
    rf"{MARK}+[^{LETTERS}{MARK}]*[{LETTERS}]*|[^{LETTERS}{MARK}]+[{LETTERS}]*|[{LETTERS}]+",
    rf"{MARK}*[^{MARK}]+|{MARK}+",
    r"(?s:.+)",
)
REMEMBERED = 500_000
LONGEST_REMEMBERED = 48
PAIRS = 200_000
#: Up to this many characters, looking through all pairs beats keeping a heap of them.
SHORT = 40

_encoders: dict[str, "Encoder"] = {}


class _Memory(dict):
    """Encodings by part, in two generations: when the young one is full it becomes the old one."""

    def __init__(self, work, most: int):
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, part: str):
        found = self.old.get(part)
        if found is None:
            ids = tuple(self.work(part))
            found = ids, ",".join(map(str, ids))
            if len(part) > LONGEST_REMEMBERED:
                return found
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[part] = found
        return found


class Encoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(library.get_piece_size())
        special = [i for i in ids if library.is_control(i) or library.is_unknown(i) or library.is_byte(i)]
        if any(library.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are not supported")
        left_out = set(special)
        self.ids = {library.id_to_piece(i): i for i in ids if i not in left_out}
        self.scores = {p: library.get_score(i) for p, i in self.ids.items()}
        self.bytes = {b: library.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.fallback = all(library.is_byte(i) for i in self.bytes.values())
        self.unknown = library.unk_id()
        # a model that only turns spaces into marks, with or without one in front, is imitated; what any other does to a
        # text the library is asked
        simple = [p for p in ("", MARK) if all(library.normalize(t) == p + t.replace(" ", MARK) for t in _PROBES)]
        self.prefix = simple[0] if simple else None
        self.cut = next(c for c in map(re.compile, CUTS) if all(len(c.findall(p)) == 1 for p in self.ids))
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        # which of two different pieces of one score is merged first depends on where they stand, so texts with such
        # pieces are merged as a whole
        times = Counter(s for p, s in self.scores.items() if len(p) > 1)
        tied = [re.escape(p) for p, s in self.scores.items() if times[s] > 1 and len(p) > 1]
        self.tied = re.compile("|".join(tied)) if tied else None
        self.most = max(map(len, self.ids))
        self.characters = frozenset(p for p in self.ids if len(p) == 1)
        self.prefixes: dict[str, str] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memory = _Memory(self.encode_part, remembered)

    def merge(self, part: str) -> list[str]:
        """The library's own way: the pair with the highest score, of equal ones the leftmost, until none is a piece."""
        if len(part) > SHORT:
            return self._merge_long(part)
        scores, symbols = self.scores, list(part)
        while True:
            best, at = None, -1
            for k, pair in enumerate(map(add, symbols, symbols[1:])):
                score = scores.get(pair)
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _merge_long(self, part: str) -> list[str]:
        """The same with a heap of pairs, in time that hardly grows faster than the text."""
        scores = self.scores
        symbols: list[str | None] = list(part)
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))

        def pair_at(a: int) -> tuple | None:
            b = after[a]
            score = scores.get(symbols[a] + symbols[b]) if b < size else None
            return None if score is None else (-score, a, symbols[a], symbols[b])

        heap = [p for p in map(pair_at, range(size)) if p]
        heapq.heapify(heap)
        while heap:
            _, a, left, right = heapq.heappop(heap)
            b = after[a]
            if symbols[a] != left or b >= size or symbols[b] != right:
                continue  # one of the two has been merged since
            symbols[a], symbols[b] = left + right, None
            after[a] = after[b]
            if after[b] < size:
                before[after[b]] = a
            for start in (a, before[a]):
                if start >= 0 and (p := pair_at(start)):
                    heapq.heappush(heap, p)
        return [s for s in symbols if s is not None]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' joined text from scratch gives the two pieces; ``left`` may be empty."""
        known = self.merge(left + right) == ([left, right] if left else [right])
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = known
        return known

    def longest(self, part: str, at: int) -> str:
        """The longest piece that starts at ``at``: the trie says how far any piece goes on like the text."""
        piece = part[at : at + self.automaton.longest_prefix(part[at : at + self.most])]
        return piece if piece in self.ids else self.shorter(piece)

    def shorter(self, text: str) -> str:
        """The longest piece that is a proper prefix of ``text``, itself a prefix of a piece; empty if there is none."""
        known = self.prefixes.get(text)
        if known is None:
            known = text[:-1]
            while known and known not in self.ids:
                known = known[:-1]
            self.prefixes[text] = known
        return known

    def backtrack(self, part: str) -> list[str]:
        """Pieces of a text all of whose characters are pieces."""
        if self.tied is not None and self.tied.search(part):
            return self.merge(part)
        out: list[str] = []
        at, size, last, failed, pairs = 0, len(part), "", None, self.pairs
        piece = self.longest(part, 0)
        while True:
            end = at + len(piece)
            if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                fits = pairs.get((last, piece))
                if fits is None:
                    fits = self.compatible(last, piece)
            else:
                fits = False
            if fits:
                out.append(piece)
                if end == size:
                    return out
                at, last, piece = end, piece, self.longest(part, end)
                continue
            piece = self.shorter(piece)
            while not piece:
                # no piece leads on from here: never come back, and try a shorter one before
                if failed is None:
                    failed = bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    return self.merge(part)  # pieces that merging never builds stand in the way
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else ""
                piece = self.shorter(piece)

    def encode_part(self, part: str) -> list[int]:
        """Ids of a part; characters that are no piece become their bytes, or the unknown id without byte fallback."""
        ids = self.ids
        if self.characters.issuperset(part):
            return [ids[p] for p in self.backtrack(part)]
        out, known = [], ""
        for c in [*part, None]:
            if c in self.characters:
                known += c
                continue
            if known:
                out += [ids[p] for p in self.backtrack(known)]
                known = ""
            if c is not None:
                out += [self.bytes[b] for b in c.encode()] if self.fallback else [self.unknown]
        return out

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.findall(self.library.normalize(text) if self.prefix is None else self.prefix + text.replace(" ", MARK))

    def encode(self, text: str) -> list[int]:
        return [i for part in self.parts(text) for i in self.memory[part][0]]

    def encode_with_text(self, text: str) -> tuple[list[int], str]:
        """The ids, and the same as decimal text joined by commas."""
        found = [self.memory[part] for part in self.parts(text)]
        return [i for ids, _ in found for i in ids], ",".join([joined for _, joined in found])


_PROBES = (" a", "a ", "a  b", "\uff21\u00c5A\u030a \ufb01\u00b2", "\ta\r\n b\u3000c\u200b\x00d", "\u00c9\u00ad\u00bd\u2026")


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, model: str, id_column: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, ``n_tokens``, SHA-256 of the ids as decimal text and of the text decoded from them (and the ``ids``).

    ``model`` is the path of the model file on every executor. NULL is an empty text, which has no tokens; ids of rows may
    be NULL or repeat.
    """
    name = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {name}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                n, digests, decoded, kept = [], [], [], []
                for words in part.column(1).to_pylist():
                    ids, joined = own.encode_with_text(words or "")
                    n.append(len(ids))
                    digests.append(sha256(joined.encode()).hexdigest())
                    decoded.append(sha256(own.library.decode(ids).encode() if ids else b"").hexdigest())
                    if with_ids:
                        kept.append(ids)
                arrays = [part.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.list_(pa.int32()))] * with_ids, names=names)

    return arrow(docs.select(F.col(id_column).alias(id_column), F.col(text).alias("text")), run, schema)
