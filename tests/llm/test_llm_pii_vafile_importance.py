"""Personal data, clustering and importance resampling against plain Python; odd inputs of each."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicmart.llm import importance, pii, vafile

# ------------------------------------------------------------------------------- personal data


def plain_base(text):
    """The base kinds as their patterns read, with the library's own search."""
    found = []
    for kind in pii.BASE:
        for m in re.finditer(pii.PATTERNS[kind], text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if ok:
                found.append((m.start(), pii.BASE.index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(found)]


def spans(text, kinds=pii.KINDS):
    return [f"{s.kind}:{s.start}:{s.end}" for s in pii.spans_of(text) if s.kind in kinds]


def test_base_spans_against_the_patterns():
    rng = random.Random(4)
    bits = ["a", "b@c.de", "@", ".", "-", "_", "%", "x.y", "@d-e.f.g", "1", "23", "4444", "255", "256", "007", "1.2.3.4", "+", "+1 (415) 555-0100", "()", " ", "  ", "\n", "é", "😀",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "5555555555554444", "0" * 15, "B", "c.d@"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert spans(text, pii.BASE) == plain_base(text), repr(text)


def test_added_spans():
    iban, spaced = "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"
    assert spans(f"to {iban}.") == ["iban:3:25"]
    assert spans(f"to {spaced} IS MY account") == ["iban:3:30"]
    assert spans(f"to {iban[:-1]}1 ") == []  # wrong check digits
    assert spans(f"to {iban}7 ") == []  # longer than the country's
    assert spans("ssn 123-45-6789, order of 5") == []  # a word against it takes the word for it back
    assert spans("my ssn is 123-45-6789") == ["ssn:10:21"]
    assert spans("no. 123-45-6789") == [] and spans("ssn 666-45-6789") == []
    assert spans("call (415) 555-0100 now") == ["local_phone:5:19"] and spans("code (415) 555-0100") == []
    assert spans("call +1 (415) 555-0100 now") == ["phone:5:22"]  # no second span inside the first


def test_scores():
    score = lambda text: [s.score for s in pii.spans_of(text)]
    assert score("a@b.cd") == [80] and score("mail a@b.cd") == [100] and score("example a@b.cd") == [60]
    assert score("4111111111111111") == [80] and score("visa 4111111111111111") == [100]
    assert score("Version 1.2.3.4") == [30]  # doubtful, but a base span stays
    assert score("x" * 41 + "mail" + " " * 40 + "a@b.cd") == [80]  # too far


def test_long_runs_are_linear():
    begun = time.time()
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1 " * 500_000, "a@" * 500_000, "a.b@c." * 200_000, "+1" + " " * 1_000_000, "x@" + "a." * 500_000, "1.2." * 300_000, "AB12" * 300_000):
        pii.spans_of(text)
    assert time.time() - begun < 60


def test_found_and_redacted_tables(spark):
    long = "word " * 200_000 + "a@b.cd" + " word" * 10
    rows = [(1, None), (2, ""), (3, "a@b.cd 1.2.3.4"), (3, "a@b.cd 1.2.3.4"), (None, "+1 415 555 0100"), (5, long)]
    table = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("TEXT"), F.lit("x").alias("spans"))
    got = sorted(repr((r[0], [f"{s['kind']}:{s['start']}:{s['end']}" for s in r[1]])) for r in pii.find(table).collect())
    assert got == sorted(repr((i, spans(t))) for i, t in rows)
    clean = pii.redacted(table)
    assert clean.columns == table.columns
    assert sorted(repr(r[1])[:40] for r in clean.collect()) == sorted(repr(x)[:40] for x in (None, "", "<email> <ip>", "<email> <ip>", "<phone>", long))
    assert pii.redact("+14155550100") == "<phone>" and pii.redact("4111 1111 1111 1111@b.cd!") == "<card>!"
    assert pii.find(table.limit(0)).count() == 0


# ------------------------------------------------------------------------------------ clusters


def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in range(len(cents)):
            mine = [v for (_, v), m in zip(kept, own) if m == n]
            if mine:
                cents[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted((repr(i), near(v)[1], near(v)[0]) for i, v in kept), cents


@pytest.mark.parametrize("dims", [5, 64])
def test_clusters_against_plain(spark, dims):
    rng = random.Random(dims)
    rows = [(i, [rng.choice((-1.0, -0.5, 0.0, 0.25, rng.gauss(0, 1))) for _ in range(dims)]) for i in range(150)]
    rows += [rows[3], rows[3], (7, rows[8][1]), (None, rows[9][1]), (None, None), (200, None), (201, [0.0] * (dims - 1)), (202, []), (203, [None] + [0.0] * (dims - 1)),
             (204, [math.nan] * dims), (205, [math.inf] * dims), (206, [100.0] * dims)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit(1).alias("Embedding"), F.lit(2).alias("v"), F.lit(3).alias("cells"))
    found, cents = vafile.cluster(table, k=12, rounds=3, dims=dims)
    want, plain = plain_clusters(rows, 12, 3, dims)
    assert sorted((repr(r[0]), r[1], r[2]) for r in found.collect()) == want
    assert cents.tolist() == plain
    full = vafile.with_inertia(found, cents).collect()
    sums = Counter()
    for _, c, d in want:
        sums[c] += d
    assert len(full) == len(want)
    for r in full:
        assert (r["cluster_inertia"], r["inertia"]) == (sums[r["cluster"]], sum(sums.values()))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, plain[r["cluster"]])).encode()).hexdigest()


def test_intervals_hold_and_settle():
    rng = np.random.default_rng(1)
    cents = rng.integers(-200, 200, (7, 6))
    v = np.concatenate([rng.integers(-300, 300, (400, 6)), cents, cents[:1] + 1])
    low = v.min(0)
    width = (v.max(0) - low) // vafile.CELLS + 1
    cells, tables = vafile.cells_of(v, low, width), vafile.interval_tables(cents, low, width)
    exact = ((v[:, None, :] - cents[None]) ** 2).sum(2)
    least, most = (sum(t[d][cells[:, d]] for d in range(6)) for t in tables)
    assert (least <= exact).all() and (exact <= most).all()
    chosen, fetched = vafile.nearest(v, cells, cents, tables)
    assert (chosen == exact.argmin(1)).all() and 0 < fetched < len(v) / 2


def test_clusters_few_empty_and_too_large(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vafile.with_inertia(*vafile.cluster(table)).collect()
    assert sorted(r["vec_id"] for r in got) == [0, 1, 2] and {r["inertia"] for r in got} == {0}
    assert vafile.with_inertia(*vafile.cluster(table.limit(0))).count() == 0
    same = vafile.cluster(spark.createDataFrame([(1, [0.5] * 64)] * 90, "vec_id long, embedding array<float>"))[0]
    assert {(r["cluster"], r["distance"]) for r in same.collect()} == {(0, 0)}
    with pytest.raises(Exception, match="beyond"):
        vafile.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>"))


# ---------------------------------------------------------------------------------- importance

BITS = ["alpha", "Beta", "3d", "é", "日本", "x" * 70, "the", "of", "-", ".", "q_r"]


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def plain_resample(rows, target, percent=25):
    s, t = (Counter(b for x in texts for b in plain_features(x)[1]) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    out = []
    for i, text in rows:
        n, f = plain_features(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    drawn = able[: percent * len(able) // 100]
    ranks = [(*r, k + 1) for k, r in enumerate(drawn)]
    left = Counter(out) - Counter(drawn)
    return sorted(repr((r[0], *r[2:])) for r in ranks + [(*r, None) for r in left.elements()])


def resampled(docs, target, **more):
    rows = importance.with_ranks(importance.resample(docs, target, **more))
    return sorted(repr(tuple(r)) for r in rows.select("doc_id", "n_features", "weight", "score", "rank").collect())


def corpus(n, seed=3):
    rng = random.Random(seed)
    text = lambda k: " ".join(rng.choice(BITS) for _ in range(k))
    return [(i, text(rng.randrange(60))) for i in range(n)] + [(None, text(40)), (None, None), (9_000, ""), (9_001, text(5_000)), (9_002, "é" * 30_000)]


@pytest.mark.parametrize("percent", [25, 100, 0])
def test_resample_against_plain(spark, percent):
    rows = corpus(300)
    rows += [rows[5]] * 150 + [(rows[6][0], rows[7][1])] * 3  # a hot row, and one id with two texts
    target = ["alpha beta 3d alpha", None, "", "日本 the of"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).select("*", F.lit(1).alias("Text"), F.lit(1).alias("row"), F.lit(2).alias("rank"))
    aims = spark.createDataFrame([(i, x, 0) for i, x in enumerate(target)], "item_id long, text string, TEXT int")
    want = plain_resample(rows, target, percent)
    assert resampled(docs, aims, percent=percent) == want
    assert resampled(docs.repartition(2), aims, percent=percent) == want  # reruns agree


def test_bracket_widens(spark, monkeypatch):
    scores = spark.range(10_000).select((F.col("id") % 7).alias("score"))
    monkeypatch.setattr(importance, "MARGIN", 1e-9)
    monkeypatch.setattr(importance, "ACCURACY", 2)
    for take in (1, 1_400, 1_429, 5_000, 9_999, 10_000):
        low, high, above = importance.bracket(scores, take, 10_000)
        inside = scores.filter(F.col("score").between(low, high)).count()
        assert above == scores.filter(F.col("score") > high).count() and above < take <= above + inside


def test_resample_empty(spark):
    docs = spark.createDataFrame(corpus(20), "doc_id long, text string")
    aims = spark.createDataFrame([], "item_id long, text string")
    assert resampled(docs, aims) == plain_resample(corpus(20), [])
    assert resampled(docs.limit(0), aims) == []


def test_features_in_pieces(monkeypatch):
    text = " ".join(t for _, t in corpus(60) if t)
    monkeypatch.setattr(importance, "word_pieces", lambda data, pieces=importance.word_pieces: pieces(data, 11))
    words, found = 0, []
    for n, b in importance.buckets_of(text.encode(), importance._Words()):
        words, found = words + n, found + b.tolist()
    assert (words, sorted(found)) == (plain_features(text)[0], sorted(plain_features(text)[1]))


def test_gains_are_the_stated_formula():
    s, t = np.array([0, 5, 100, 7]), np.array([3, 0, 1, 9])
    assert importance.gains(s, t).tolist() == [math.floor(1000 * math.log((b + 1) * (112 + 4) / ((a + 1) * (13 + 4)))) for a, b in zip(s, t)]
