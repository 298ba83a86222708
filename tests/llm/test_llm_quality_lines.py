"""Quality ledger and line dedup against plain Python; nulls, repeats, clashing columns, empty tables."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from civicmart.llm import lines, quality

LONG = " ".join(f"w{i}" for i in range(25))
OTHER = " ".join(f"v{i}" for i in range(30))
TEXTS = [
    None, "", " \t\n", "one two", "a b c d e " * 6, LONG, f"{LONG}\n{OTHER}\nshort", f"head\n{LONG.upper()}\ntail {OTHER}",
    "# * $ % & | < > x y z", "\n".join(["same line here again now"] * 5), "é ü   ß\x0bq\x0cr " + "x" * 50_000,
    "WOW!! " * 12 + LONG, "x y z x y z x y z w", " ".join(f"t{i % 977}" for i in range(6_000)),
]


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if twice[g] > 1 for k in range(5)}
    rows = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(rows) - len(set(rows)), len(covered))


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, TEXT string, n_chars long")


def test_measurements(spark):
    got = {r["doc_id"]: r for r in quality.ledger(docs(spark)).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(t), i
        assert bool(r["fail_bits"] & quality.BASE.mask) == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])


def test_kept_rows_and_columns(spark):
    table = docs(spark)
    bits = {r["doc_id"]: r["fail_bits"] for r in quality.ledger(table).collect()}
    kept = quality.kept(table, quality.CURRENT)
    assert kept.columns == table.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(i for i, b in bits.items() if not b)


def test_ablations(spark):
    entries = quality.ledger(docs(spark)).cache()
    bits = [r["fail_bits"] for r in entries.collect()]
    for r in quality.ablations(entries).collect():
        policy = next(p for p in (quality.BASE, quality.CURRENT) if p.version == r["policy"])
        bit = 1 << [n for n, _ in quality.RULES].index(r["rule"])
        assert r["n_failed"] == sum(bool(b & bit) for b in bits)
        assert r["n_only"] == sum((b & policy.mask) == bit for b in bits)
        assert r["n_rejected"] == sum(bool(b & policy.mask) for b in bits)


def test_empty_tables(spark):
    none = docs(spark).limit(0)
    assert quality.ledger(none).count() == 0 and quality.kept(none, quality.CURRENT).count() == 0
    assert lines.dedup_lines(none).count() == 0


def plain_lines(rows):
    """Earliest occurrence by (doc_id null last, text digest, line) stays."""
    import hashlib

    key = lambda t: "null" if t is None else hashlib.md5(t.encode()).hexdigest()
    seen, out = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, key(r[1]))):
        cut = []
        for n, d in lines.line_units(t):
            if d in seen:
                cut.append((n, seen[d]))
            else:
                seen[d] = i
        out[i, t] = cut
    return out


def test_line_dedup_against_plain(spark):
    rows = [*enumerate(TEXTS), (3, LONG), (100, LONG), (None, OTHER), (100, LONG), (101, f"{OTHER}\n\n{OTHER}")]
    table = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("clash").alias("n_removed")).select("*", F.lit(1).alias("Doc_id"))
    done = lines.dedup_lines(table, window=None)
    assert done.columns == ["doc_id", "text", "n_removed", "Doc_id", "n_removed", "removed"]
    want = plain_lines(rows)
    texts = sorted((repr(i), repr("\n".join(x for n, x in enumerate(t.split("\n")) if n not in {c for c, _ in want[i, t]})) if t is not None else "None") for i, t in rows)
    found = done.collect()
    assert sorted((repr(r[0]), repr(r[1])) for r in found) == texts
    original = {}
    for i, t in rows:
        original.setdefault(i, set()).add(t)
    for r in found:
        for s in r[5] or []:
            assert any(t is not None and len(t[s["start"] : s["end"]].split()) >= lines.MIN_WORDS for t in original[r[0]])


def test_passage_is_left_in_one_document_only(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    table = spark.createDataFrame([(i, f"own {i} text\n{passage}\nend {i}") for i in range(300)], "doc_id long, text string")
    done = lines.without_repeats(table)
    assert done.columns == table.columns
    assert [r[0] for r in done.filter(F.col("text").contains(passage)).collect()] == [0]


@pytest.mark.parametrize("text,cut,left", [("a\nb\nc", [1], "a\nc"), ("a", [0], ""), ("\n", [0], "")])
def test_cut_lines(text, cut, left):
    assert lines.cut_units(text, dict.fromkeys(cut), [], [])[0] == left


def test_cut_runs():
    text = "a b\n c d  e f\ng h"
    left, spans = lines.cut_units(text, {}, [(2, 7)], [], 2)
    assert (left, spans) == ("a b\ne f\ng h", [(1, 5, 8, 7)])
    left, spans = lines.cut_units(text, {}, [(3, 7)], [], 2)
    assert (left, spans) == ("a b\n c f\ng h", [(1, 7, 11, 7)])
    left, spans = lines.cut_units(text, {}, [(4, 7), (6, 9)], [], 2)
    assert (left, spans) == ("a b\n c d", [(1, 10, 13, 7), (2, 14, 17, 9)])
    assert lines.cut_units(text, {}, [(1, 7), (2, 7)], [0, 1, 2], 2) == (text, [])
    assert lines.cut_units(text, {}, [(5, 3)], [4], 2) == ("a b\n c d  e f\nh", [(2, 14, 15, 3)])


def test_dedup_against_plain(spark):
    import random

    rng = random.Random(8)
    new = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = [new(n) for n in (50, 60, 75, 120, 200)] + ["in " * 80]
    rows = []
    for i in range(120):
        parts = [new(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 5))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared).upper() if rng.random() < 0.2 else rng.choice(shared))
        rows.append((i, "".join(p + rng.choice([" ", "  ", "\n", "\n\n"]) for p in parts)))
    rows += [(None, None), (700, ""), (None, rows[3][1]), (500, rows[4][1]), (500, rows[4][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("run")).select("*", F.lit(2).alias("at"))
    want = plain_words(rows)
    found = lines.dedup_lines(table).collect()
    assert sorted(repr((r[0], None if r[1] is None else r[1].split())) for r in found) == sorted(repr((i, want[i, t])) for i, t in rows)
    original = dict(rows)
    for r in found:
        assert r["n_removed"] == len(r["removed"] or []) and r["removed"] != []
        if r[0] is not None and r[0] < 120:
            t = original[r[0]]
            cut = set()
            for s in r["removed"] or []:
                assert t.count("\n", 0, s["start"]) == s["line"]
                cut.update(range(s["start"], s["end"]))
            assert "".join(c for k, c in enumerate(t) if k not in cut).split() == r[1].split()


def test_passage_inside_lines(spark):
    """Every passage of 50 words is found whatever surrounds it; texts that share none stay."""
    import random

    rng = random.Random(3)
    new = lambda n: " ".join(f"v{rng.randrange(10**7)}" for _ in range(n))
    rows, held = [], {}
    for i in range(150):
        passage = new(50)
        for k in (3 * i, 3 * i + 1):
            held[k] = passage
            rows.append((k, f"{new(rng.randrange(0, 60))} {passage} {new(rng.randrange(0, 60))}"))
        rows.append((3 * i + 2, f"{new(45)}\n{new(70)}"))
    got = {r[0]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        if k % 3 == 1:
            assert got[k]["n_removed"] == 1 and got[k]["removed"][0]["first_doc_id"] == k - 1
            assert len(set(got[k]["text"].split()) & set(held[k].split())) <= 2 * (lines.WINDOW - 1)
            assert set(t.split()) - set(held[k].split()) <= set(got[k]["text"].split())
        else:
            assert got[k]["text"] == t and got[k]["n_removed"] == 0 and got[k]["removed"] is None


@pytest.mark.parametrize("copies", [3, 7, 20])
def test_every_later_copy_goes_whole(spark, copies):
    """Passages inside lines, in several documents with unlike surroundings: all words of all later copies go."""
    import random

    rng = random.Random(copies)
    new = lambda n: " ".join(f"u{rng.randrange(10**8)}" for _ in range(n))
    passages = [new(n) for n in (25, 30, 49, 60, 60, 60, 120)]
    rows = [(k * copies + i, f"{new(rng.randrange(1, 40))} {p} {new(rng.randrange(1, 40))}") for k, p in enumerate(passages) for i in range(copies)]
    got = {r[0]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        p, first = passages[i // copies], i // copies * copies
        assert got[i]["text"].split() == (t if i == first else t.replace(p, "")).split(), i
        by = [r["first_doc_id"] for r in got[i]["removed"] or []]
        assert len(by) == (i != first) and all(first <= d < i for d in by)


def test_no_repeated_line_stays_but_the_earliest(spark):
    """Short lines too, in hundreds of documents, and doc_ids that have several texts or are null."""
    rows = [(i, f"own {i} a\nshared line here\nx\nown {i} b") for i in range(200)]
    rows += [(7, "shared line here\nonly this"), (7, "zz\nshared line here"), (None, "x\nnull one"), (None, "shared line here\nnull two"), (None, None)]
    found = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(x for r in found if r[1] for x in r[1].split("\n"))["shared line here"] == 1
    assert [r[0] for r in found if r[1] and "shared" in r[1]] == [0]
    want = plain_words(rows)
    assert sorted(repr((r[0], None if r[1] is None else r[1].split())) for r in found) == sorted(repr((r[0], want[r])) for r in rows)


def test_what_stays_here_does_not_save_words_of_earlier_documents(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(0, f"x {a} y"), (1, f"z {b} v"), (2, f"q {a} {b} r"), (3, f"s {a} {b} t")]
    got = dict(lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect())
    assert got == {0: rows[0][1], 1: rows[1][1], 2: "q r", 3: "s t"}


@pytest.mark.parametrize("window", [2, 3, 8, 25])
def test_cells_hold_every_run_and_equal_runs_share_an_anchor(window):
    import random

    rng = random.Random(window)
    for _ in range(50):
        anchor_of = {}
        for t in (" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60))) for _ in range(2)):
            runs, at = dict(lines.passage_units(t, window)), 0
            for first, n, whole, anchor in zip(*lines.cells(t, window)):
                assert first == at and n > 0
                assert [whole] == [d for i, d in lines.passage_units(t, window + n - 1) if i == first]
                assert {anchor_of.setdefault(runs[i], anchor) for i in range(first, first + n)} == {anchor}
                at += n
            assert at == len(runs)


def words_of(text):
    return re.findall(r"[^ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_lines_of(text):
    """(line number, words) of the lines with a word."""
    return [(n, tuple(words_of(x))) for n, x in enumerate((text or "").split("\n")) if words_of(x)]


def plain_runs_of(text, size=25):
    """(word number, words) of all runs."""
    words = words_of(text)
    return [(n, tuple(words[n : n + size])) for n in range(len(words) - size + 1)]


def plain_words(rows):
    """Words of (doc_id, text) after a plain pass in rank order: lines seen before go, and words of runs
    seen before; what stays here saves words only from runs that are first in the same text."""
    import hashlib

    key = lambda t: "null" if t is None else hashlib.md5(t.encode()).hexdigest()
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, key(r[1])))
    several = Counter(d for _, t in order for _, d in plain_runs_of(t))
    seen, out = {}, {}
    for r in order:
        gone = {n for n, d in plain_lines_of(r[1]) if seen.setdefault(("line", d), (r, n)) != (r, n)}
        own, stay, sure = set(), set(), set()
        for n, d in plain_runs_of(r[1]):
            first = seen.setdefault(("run", d), (r, n))
            if several[d] > 1:
                (stay if first == (r, n) else own if first[0] == r else sure).update(range(n, n + 25))
        parts, w = [], 0
        for n, line in enumerate((r[1] or "").split("\n")):
            words = re.findall(r"[^ \t\n\x0b\x0c\r]+", line)
            parts += [x for k, x in enumerate(words) if n not in gone and w + k not in sure | (own - stay)]
            w += len(words)
        out[r] = None if r[1] is None else parts
    return out


def test_dedup_word_by_word(spark):
    """Passages side by side and within themselves repeated, in 150 texts."""
    import random

    rng = random.Random(21)
    new = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = [new(n) for n in (24, 25, 33, 50, 60, 120)] + ["in " * 80, "to and fro " * 20]
    rows = []
    for i in range(150):
        parts = [new(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(0, 5)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared).upper() if rng.random() < 0.2 else rng.choice(shared))
        rows.append((i, "".join(p + rng.choice([" ", "  ", "\n", "\n\n"]) for p in parts)))
    rows += [(None, None), (700, ""), (None, rows[3][1]), (500, rows[4][1]), (500, rows[4][1])]
    want = plain_words(rows)
    found = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(repr((r[0], None if r[1] is None else r[1].split())) for r in found) == sorted(repr((r[0], want[r])) for r in rows)
