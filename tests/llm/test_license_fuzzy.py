import random
import re
import time
from types import SimpleNamespace

from pyspark.sql import functions as F

from changeflow.llm import license_fuzzy as lf

FILLER = "lorem ipsum dolor sit amet the under software license copy to of rights apache mit general public".split()


def damaged(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(1, len(out) - 1)
        rng.choice([lambda: out.__setitem__(at, rng.choice("abcxyz")), lambda: out.insert(at, "q"), lambda: out.pop(at)])()
    return "".join(out)


def corpus():
    rng = random.Random(12)
    texts = []
    for _ in range(150):
        words = [rng.choice(FILLER) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 1, 1, 3])):
            text, _ = rng.choice(lf.NOTICES)
            words.insert(rng.randint(0, len(words)), damaged(rng, text, rng.randint(0, len(text) // lf.CHARACTERS_PER_EDIT + 1)))
        texts.append(rng.choice([" ", "\n", ", ", " -- "]).join(words))
    odd = [None, "", " .. ", "MIT License", "the mit\nlicense mit license", "Apache-License, (version 2.0)", "GNU General Public License.",
           "mit licenses smit license", "mitélicense", "İMIT LICENSE", "Released under the MIT License. " * 3000, "x" * 300_000]
    return list(enumerate(texts + odd)) + [(0, texts[0]), (None, "released under the mit license")]


def plain_base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    places = [(i, label) for phrase, label in lf.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_base_columns_equal_a_plain_version(docs_of):
    pairs = corpus()
    rows = lf.scan(docs_of(pairs).withColumn("labels", F.lit("clash"))).collect()
    got = [(str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows]
    assert sorted(got, key=str) == sorted(((str(i), *plain_base(t)) for i, t in pairs), key=str)
    for r in rows:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))


def test_seeds_lose_no_notice_that_a_scan_of_the_whole_text_finds():
    scanner = lf.Scanner()
    for _, text in corpus()[:-4]:
        normal = lf.normal_form(text or "")
        whole = {n: [m.span() for m in notice.pattern.finditer(normal)] for n, notice in enumerate(scanner.notices)}
        windows = scanner.windows(normal)
        for n, spans in whole.items():
            for a, b in spans:
                assert any(x <= a and b <= y for x, y in windows.get(n, []))


def test_spans_are_within_the_edits_they_report():
    scanner = lf.Scanner()
    found = 0
    for _, text in corpus()[:150]:
        normal = lf.normal_form(text or "")
        for hit in scanner.notices_in(normal):
            notice = min((n for n in scanner.notices if n.label == hit.label), key=lambda n: distance(n.text, normal[hit.start : hit.stop]))
            assert distance(notice.text, normal[hit.start : hit.stop]) <= hit.edits <= notice.edits
            found += 1
    assert found > 100


def test_damaged_notices_are_found_with_their_place():
    rng = random.Random(2)
    scanner = lf.Scanner()
    for text, label in lf.NOTICES:
        for edits in range(len(text) // lf.CHARACTERS_PER_EDIT + 1):
            inner = damaged(rng, text, edits)
            hits = scanner.notices_in(f"some words before {lf.normal_form(inner)} and after")
            assert any(h.label == label or h.edits <= edits for h in hits), (label, inner)


def test_a_text_full_of_notices_takes_linear_time():
    scanner, taken = lf.Scanner(), []
    for copies in (4_000, 32_000):
        text = lf.normal_form("All rights reserved. " * copies)
        best = []
        for _ in range(3):
            started = time.perf_counter()
            row = lf._judge(scanner, text)
            best.append(time.perf_counter() - started)
        taken.append(min(best))
        assert row[0] == 3 * copies and row[5] == "proprietary"
        assert [n["first_word"] for n in row[7]] == list(range(0, 3 * copies, 3)) and {n["words"] for n in row[7]} == {3}
    # eight times the text; time that grows with its square would take 64 times as long
    assert taken[1] < 20 * taken[0]


def test_choosing_group_by_group_equals_choosing_among_all_hits():
    rng = random.Random(5)
    for _ in range(200):
        hits = [lf.Hit(rng.choice("ab"), s, s + rng.randint(1, 12), rng.randint(0, 3), 12) for s in rng.choices(range(90), k=14)]
        scanner = lf.Scanner()
        scanner.windows = lambda normal: {0: [(0, 1)]}
        match = lambda h: SimpleNamespace(start=lambda: h.start, end=lambda: h.stop, fuzzy_counts=(h.edits,))
        scanner.notices = [SimpleNamespace(label="a", text="x" * 12, pattern=SimpleNamespace(finditer=lambda *_: map(match, hits)))]
        ordered = sorted(hits, key=lambda h: (h.start, h.stop))
        assert scanner.notices_in("") == lf._best([lf.Hit("a", h.start, h.stop, h.edits, 12) for h in ordered])


def test_clean_prose_has_no_label():
    prose = "the bridge was under the license of the town and all its rights were in the hands of the public"
    assert lf.Scanner().notices_in(prose) == []


def test_empty_table(docs_of):
    assert lf.scan(docs_of([])).count() == 0
