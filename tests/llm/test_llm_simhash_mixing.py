"""SimHash components and the source mix against plain Python."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from civicmart.llm import mixing, simhash


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " ", "One", "One Two", "a b c", "É È a B c d", "x " * 70_000, "İ ß   k\x0bq"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def union_find(points, distance):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    points = list(points)
    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in points}


def test_classes_against_union_find(spark):
    rng = random.Random(5)
    points = {0, 3}
    for _ in range(12):  # chains and clusters around random centres
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 14)):
            points.add(p)
            for _ in range(rng.randint(1, 3)):
                p ^= 1 << rng.randrange(64)
    signed = [(p - 2**64 if p >> 63 else p,) for p in points]
    found = {r["fp"] % 2**64: r["root"] for r in simhash.classes(spark.createDataFrame(signed, "fp long")).collect()}
    want = union_find(points, 2)
    assert len({(found[p], want[p]) for p in points}) == len(set(found.values())) == len(set(want.values()))


def test_near_duplicates_and_keep_one(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [(5, base), (3, base), (9, base + " end"), (1, "other words entirely here"), (2, None), (7, ""), (None, base), (3, base), (4, "x y")]
    table = spark.createDataFrame(texts, "doc_id long, text string").select("*", F.lit(1).alias("TEXT")).select("*", F.lit("clash").alias("fp"))
    got = simhash.near_duplicates(table).collect()
    points = {plain_fingerprint(t) for _, t in texts}
    roots = union_find(points, 2)
    least = {}
    for i, t in texts:
        if i is not None:
            r = roots[plain_fingerprint(t)]
            least[r] = min(least.get(r, i), i)
    want = sorted((repr(i), f"{plain_fingerprint(t):016x}", least[roots[plain_fingerprint(t)]]) for i, t in texts)
    assert sorted((repr(r[0]), r[1], r[2]) for r in got) == want
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(least.values())
    assert simhash.near_duplicates(table.limit(0)).count() == 0 and simhash.keep_one(table.limit(0)).count() == 0


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).withColumnRenamed("id", "fp"), 3)


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * sizes[s]} if w else set()
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        capped |= over


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * max(0, int(rng.expovariate(1 / 60)))), "hot" if i % 3 else f"s{i % 7}") for i in range(3_000)]
    rows += [(5_000, None, None), (5_001, "a b", None), (5_002, "tiny", "a"), (5_003, "one two", "b"), (5_003, "one two", "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", F.lit("clash").alias("copies"))
    got = mixing.mix(table).collect()
    again = mixing.mix(table.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = plain_targets(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(3, 0.02 * t), (s, taken[s], t)
    out = mixing.mixed(table)
    assert out.columns == table.columns
    assert out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(table.limit(0)).count() == 0 and mixing.mixed(table.limit(0)).count() == 0


def test_reruns_agree_with_many_repeated_rows(spark):
    """Whatever the partitions: five documents that repeat hundreds of times, one also in another source."""
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 90)), f"s{i % 4}") for i in range(3_000)]
    rows += [rows[k] for k in range(5) for _ in range(60 + 100 * k)] + [(rows[0][0], rows[0][1], "s3")] * 90
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [sorted(((r["doc_id"], r["source"], r["taken"]) for r in mixing.mix(t).collect())) for t in (table.coalesce(1), table.repartition(5), table.repartition(9, "text"))]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)


def test_rounding_keeps_expectations(spark):
    """Over many sources with the same documents, each size is taken about as often as expected."""
    rows = [(s * 100 + d, " ".join(["w"] * (2 ** (d % 6))), f"s{s:03d}") for s in range(300) for d in range(12)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by_size = {}
    for r in got:
        by_size.setdefault(r["size"], []).append((r["copies"], r["target"] / r["source_size"]))
    for size, pairs in by_size.items():
        assert sum(c for c, _ in pairs) / len(pairs) == pytest.approx(sum(e for _, e in pairs) / len(pairs), abs=0.08), size


@pytest.mark.parametrize("words", [1, 10])
def test_mix_of_equal_documents_keeps_every_row_once(spark, words):
    """Blocks that settle exactly leave no residual: equal sizes, three equal sources, one with a fraction of a half."""
    rows = [(i, "w " * words, "abc"[i % 3]) for i in range(6_000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(6_000))
    for s in "abc":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= words
