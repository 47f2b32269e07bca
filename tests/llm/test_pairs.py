"""Spelling variants, hard negatives and document fingerprints against plain Python."""

import hashlib
import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import bottom_k, fm_index, hard_negatives, spelling

SCHEMA = "doc_id long, text string"
CLASH = "word int, n string, key int, h string, side int, hash string, position int, next int, id int, sketch string, anchor int, grp int, score int"


def with_clash(df):
    return df.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASH.split(", ")]).repartition(3)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made_words(r, n, letters="abé"):
    return ["".join(r.choice(letters) for _ in range(r.randint(5, 7))) for _ in range(n)]


def texts(seed=1, n=60):
    r = random.Random(seed)
    words = made_words(r, 120)
    often = ["colour", "modelling", "straße", "ÀÉÎÕÜÿ"]
    out = [(1, None), (2, ""), (3, " 12 ++ \n"), (None, "Colour colour COLOUR colours " * 3), (4, "colour" * 4000 + " " + "modelling " * 9)]
    for i in range(5, n):
        out.append((i, " ".join(r.choice(words) + r.choice(["", ".", "-x", "\n"]) for _ in range(r.randint(1, 80))) + " " + " ".join(often * 3)))
    out += [(i, "colors " * 3 + "Modeling " + "colouur") for i in range(70, 76)]
    return out + [out[7]] * 3


def test_one_error_search_equals_brute_force():
    r = random.Random(1)
    for narrow in (32, 0):  # lists of next codes, and the whole alphabet
        fm_index.NARROW = narrow
        for _ in range(25):
            words = sorted({"".join(r.choice("abc") for _ in range(r.randint(6, 9))) for _ in range(r.randint(1, 120))})
            codes = lambda ws: np.frombuffer("".join(ws).encode(), np.uint8) - 96
            index = fm_index.BidirectionalIndex([codes([w]) for w in words], 5)
            asked = [*words, "abcabc"]
            lengths = np.array([len(w) for w in asked])
            q, w = index.within_one_error(codes(asked), np.cumsum(lengths) - lengths, lengths, lengths // 2)
            got = sorted((asked[a], words[b]) for a, b in zip(q, w, strict=True))
            assert got == sorted((a, b) for a in asked for b in words if brute.one_error(a, b) and a[:len(a) // 2] == b[:len(a) // 2])
    fm_index.NARROW = 32


def test_spelling_variants_equal_brute_force(spark):
    rows = texts()
    got = spelling.group_variants(spelling.word_counts(with_clash(spark.createDataFrame(rows, SCHEMA)), spelling.drop_letter))
    want = brute.variants(brute.word_counts(rows, 6, 199))
    assert rows_of(got) == sorted(want, key=repr)
    assert sum(r[1] is not None for r in want) > 1 and max(r[4] for r in want) > 3
    plain = spelling.group_variants(spelling.word_counts(spark.createDataFrame(rows, SCHEMA)))
    assert rows_of(plain) == sorted(brute.variants(brute.word_counts(rows, 6)), key=repr)


def test_crowded_beginnings_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SHARD", 7)
    r = random.Random(3)
    counts = {w: 5 * 6**r.randint(0, 4) for w in ["abcabc" + w for w in made_words(r, 60, "abc")] + made_words(r, 60, "abc") if len(w) > 5}
    counts |= {"marble": 5, "marbles": 40, "marblest": 900, "marblesty": 9000}
    got = spelling.group_variants(spark.createDataFrame([*counts.items(), (None, 9), ("short", 99), ("seldom", 4)], "word string, n long"))
    want = brute.variants(counts)
    assert rows_of(got) == sorted(want, key=repr)
    assert any(x[1] and x[1] != x[2] for x in want)


def vectors(seed=2, n=260, dims=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dims))
    rows = [(i, int(r.integers(0, 4)), (centres[r.integers(0, 4)] + 0.7 * r.normal(size=dims)).tolist()) for i in range(n)]
    rows += [(n + i, i % 4, rows[20][2]) for i in range(30)]  # ties
    rows += [(400, 1, None), (401, None, rows[1][2]), (410, 1, []), (420, 1, [None] * dims), (430, 1, [math.nan] * dims), (440, 2, [math.inf] * dims),
             (None, 1, rows[2][2]), (450, 1, [1.0, 2.0]), (451, 1, [1.0, 1.0]), (452, 2, [1.0, 0.3]), (460, 1, [0.0] * dims), (470, 3, [-0.5] * dims),
             (480, 1, [3e17] * dims), (481, 1, [1e-3] * dims), (482, 2, [8e-4] * dims), rows[10], rows[10], rows[13], (20, 3, rows[4][2])]
    return rows


def test_hard_negatives_equal_brute_force(spark):
    rows = vectors()
    df = with_clash(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    usable = {(i, k, tuple(math.floor(256 * x) for x in v)) for i, k, v in rows
              if None not in (i, k) and v and all(x is not None and math.isfinite(x) for x in v)}
    want = brute.negatives(sorted(usable), 10)
    assert rows_of(hard_negatives.mine(df, every=10)) == sorted(want, key=repr)
    assert len(want) > 100 and {r[2] for r in want} == {1, 2, 3}


def test_scans_in_many_groups_and_small_blocks(spark, monkeypatch):
    rows = vectors(3, 150, 8)[:150]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    exact = [(i, k, tuple(math.floor(256 * x) for x in np.array(v, np.float32).tolist())) for i, k, v in rows]
    monkeypatch.setattr(hard_negatives, "GROUP", 4)
    monkeypatch.setattr(hard_negatives, "SLICES", 3)
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    assert rows_of(hard_negatives.mine(df, every=10)) == sorted(brute.negatives(exact, 10), key=repr)


def test_bounds_leave_every_wanted_row():
    r = np.random.default_rng(5)
    rows = np.floor(256 * r.normal(size=(300, 40)))
    block = hard_negatives.Block(range(300), [0] * 300, [x.tobytes() for x in rows])
    query, seen = rows[0] * (r.random(40) < 0.3), []
    exact = rows @ query
    cut = np.sort(exact)[-10]

    def wanted(least, most):
        seen.append(len(least))
        return most >= cut

    left, score = hard_negatives.vertical_scan(query, block, np.arange(300), wanted)
    assert set(np.flatnonzero(exact >= cut)) <= set(left) and (score == exact[left]).all() and seen[-1] < 300


def fingerprint_rows():
    r = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    out = [(5, None), (9, ""), (7, " \t\n"), (11, "one"), (12, "one two three four"), (13, "é" * 401), (14, "word " * 4000), (15, "a b c d e f g h " * 3)]
    out += [(20 + i, " ".join(r.choice(words) for _ in range(r.randint(1, 400)))) for i in range(25)]
    out += [(60, out[9][1]), (61, out[9][1]), (None, out[10][1]), (None, "null id"), (0, "zero id, not the null one"), (20, "the same id again"), out[9], out[9], (90, "last one of them all")]
    return out


@pytest.mark.parametrize("k", [8, 128])
def test_fingerprints_equal_brute_force(spark, k):
    rows = fingerprint_rows()
    signed = lambda t: (lambda h: h - 2**64 if h >= 2**63 else h)(brute.chained(t))
    docs = sorted({(i is not None, i or 0, signed(t or ""), t or "") for i, t in rows})
    want = {}
    for d, e in zip(docs, docs[1:] + docs[:1], strict=True):
        text, other = d[3], e[3]
        edited = text[:len(text) - len(text) // 4] + other[:len(text) // 4]
        a, b, c = (brute.bottom_k(t, k) for t in (text, edited, other))
        want[d[1] if d[0] else None, text] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, brute.alike(a, b, k), brute.alike(a, c, k))
    got = bottom_k.compare_neighbours(with_clash(spark.createDataFrame(rows, SCHEMA)), k)
    assert rows_of(got) == sorted(((i, *want[i, t or ""]) for i, t in rows), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
    one = bottom_k.compare_neighbours(spark.createDataFrame([(3, "a b c d e f g h")], SCHEMA)).first()
    assert (one["near_edited"], one["near_next"]) == (brute.alike(brute.bottom_k("a b c d e f g h", 128), brute.bottom_k("a b c d e f a b", 128), 128), 1.0)


def test_sketches_merge_and_estimate(spark):
    r = random.Random(6)
    a = [f"a{r.random()}" for _ in range(6000)]
    shared, own, other = a[:4000], a[4000:5000], a[5000:]
    rows = [(1, " ".join(shared), " ".join(shared[:2000]), "x"), (2, " ".join(own), "", "x"), (3, " ".join(other), None, "y"), (4, "", "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string, part string")
    sketched = df.select("part", bottom_k.sketch("text", 512).alias("sketch"), bottom_k.sketch("other", 512).alias("o"))
    merged = {x["part"]: x["sketch"] for x in bottom_k.merge_sketches(sketched, ["part"], k=512).collect()}
    assert merged == {"x": sorted({*brute.bottom_k(rows[0][1], 512), *brute.bottom_k(rows[1][1], 512)})[:512], "y": brute.bottom_k(rows[2][1], 512)}
    s, o = F.col("sketch"), F.col("o")
    first = sketched.select(bottom_k.distinct_count(s, 512).alias("n"), bottom_k.resemblance(s, o, 512).alias("r"), bottom_k.containment(o, s, 512).alias("c"),
                            bottom_k.containment(s, o, 512).alias("d"), bottom_k.merged(s, o, 512).alias("m")).collect()
    assert abs(first[0]["n"] / 3996 - 1) < 0.15 and abs(first[0]["r"] - 0.5) < 0.08 and first[0]["c"] > 0.85 and abs(first[0]["d"] - 0.5) < 0.1
    assert first[0]["m"] == brute.bottom_k(rows[0][1], 512) and first[3]["r"] == first[3]["c"] == 1.0 and first[3]["n"] == 0.0


def test_empty_tables(spark):
    docs, vecs = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert spelling.group_variants(spelling.word_counts(docs)).count() == 0
    assert hard_negatives.mine(vecs).count() == 0
    assert bottom_k.compare_neighbours(docs).count() == 0
