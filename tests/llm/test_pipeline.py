import random

import brute
import corpus_pipeline
import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def kept(rows):
    """Brute force: the smallest row, null ids first, of each component of similar texts."""
    sets = [shingles(r[1]) for r in rows]
    label = brute.components(list(range(len(rows))), np.array([[near(a, b) for b in sets] for a in sets]))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    return sorted((min((r for r, c in zip(rows, label, strict=True) if c == g), key=key) for g in set(label)), key=repr)


def documents(seed, n, ids):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{r.randrange(5000)}" for _ in range(r.randint(40, 300))]
        rows.append((ids(len(rows)), " ".join(words)))
        for _ in range(2):  # a word in 60 to 20 changed: similarities about 0.6 to 0.9
            rate = r.uniform(1 / 200, 1 / 20)
            rows.append((ids(len(rows)), " ".join(f"x{r.randrange(5000)}" if r.random() < rate else w for w in words)))
    return rows


def stage(spark, rows):
    docs = spark.createDataFrame([(*x, "en", "a", len(x[1] or "")) for x in rows], SCHEMA).repartition(3)
    run = dict(corpus_pipeline.STAGES)
    f = run.get("near-dedup") or run["simhash near-dedup"]
    return sorted(((x["doc_id"], x["text"]) for x in f(spark, docs, "").collect()), key=repr)


def test_near_copies_from_similarity_08_are_dropped_and_no_others(spark):
    rows = documents(3, 60, lambda k: k)
    want = kept(rows)
    assert 60 < len(want) < 150
    assert stage(spark, rows) == want


def test_clean_documents_without_or_with_shared_ids_stay(spark):
    rows = documents(4, 40, lambda k: None if k % 3 == 0 else 7 if k % 5 == 0 else k)
    rows += [(None, ""), (500, None), (501, " \n"), (None, "a b"), (502, "A  b"), (503, "a c"), rows[3], rows[3], (None, rows[4][1])]
    got = stage(spark, rows)
    key = lambda x: (x[0], frozenset(shingles(x[1])))
    assert sorted(map(key, got), key=repr) == sorted(map(key, kept(rows)), key=repr)
    assert sum(x[0] is None for x in got) > 20


def test_large_groups_are_compared_block_against_block(spark, monkeypatch):
    from tallyline.llm import shingle_dedup

    monkeypatch.setattr(shingle_dedup, "BLOCK", 4)
    r = random.Random(5)
    words = [f"w{r.randrange(5000)}" for _ in range(300)]
    rows = []
    for k in range(40):
        words[r.randrange(300)] = f"x{k}"
        rows.append((k, " ".join(words)))
    assert stage(spark, rows) == kept(rows)


def encoded(text):
    import base64

    import public_tokenizers
    import tiktoken
    from tallyline.llm import bpe

    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text or "")


def corpus(seed=9):
    r = random.Random(seed)
    common, rare = [f"w{k}" for k in range(60)], [f"x{k}" for k in range(40)]
    line = "A line that many of the documents share, word for word"
    rows = [(1, None, "a"), (2, "", "b"), (3, "too short", "b"), (4, "again and " * 40, None), (5, " \n\n ", "a")]
    for i in range(6, 90):
        words = [r.choice(common if i % 5 else rare) for _ in range(r.randint(12, 160))]
        text = " ".join(words) + (f"\n {line.upper() if i % 2 else line} \n" if i % 3 == 0 else "") + ("\n### $$$ %%%" if i % 11 == 0 else "")
        rows.append((None if i % 13 == 0 else i, text, ["a", "b", "é", None][i % 4]))
        if i % 9 == 0:
            rows += [(200 + i, text, "a"), (300 + i, text.replace("w7", "w8", 1), "b")]
    rows += [(400, " ".join(r.choice(common) for _ in range(9000)), "a"), rows[20], rows[20]]
    labels = [(i, int(i % 5 != 0), int(i % 17 == 0)) for i in range(1, 60)] + [(None, 1, 0), (7, None, None)]
    return rows, labels


def stored(spark, folder, rows, labels):
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), "kept", 1) for i, t, s in rows], SCHEMA + ", shard string, cells int")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_run_equals_brute_force(spark, tmp_path):
    from tallyline.llm import mixing, quality

    rows, labels = corpus()
    cells = quality.cells_for(sum(len(t or "") for _, t, _ in rows))
    flags = brute.quality_kept([r[:2] for r in rows], labels, cells)
    good = [r for r, f in zip(rows, flags, strict=True) if f]
    assert 40 < len(good) < len(rows) - 10
    lines = [(i, text, s) for (i, _, _, text), (*_, s) in zip(brute.drop_lines([r[:2] for r in good]), good, strict=True)]
    assert any(t != r[1] for (_, t, _), r in zip(lines, good, strict=True))
    sets = [shingles(t) for _, t, _ in lines]
    label = brute.components(list(range(len(lines))), np.array([[near(a, b) for b in sets] for a in sets]))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "", "en", r[2] is not None, r[2] or "")
    one = [min((r for r, c in zip(lines, label, strict=True) if c == g), key=key) for g in set(label)]
    assert len(one) < len(lines)
    epochs = brute.mixed(one, mixing.SEED)
    want = [(i, len(encoded(t))) for (i, t, _), n in zip(one, epochs, strict=True) for _ in range(n)]
    got = corpus_pipeline.run(spark, stored(spark, tmp_path, rows, labels))
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert {0, 1} <= set(epochs)


def test_every_stage_of_an_empty_table(spark, tmp_path):
    folder = stored(spark, tmp_path, [], [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0 and (name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_near_dedup_takes_candidates_from_the_fingerprint_index(spark, monkeypatch):
    from tallyline.llm import shingle_dedup, simhash_dedup

    seen, links = [], simhash_dedup.links
    monkeypatch.setattr(simhash_dedup, "links", lambda fps, *a: seen.append(fps.count()) or links(fps, *a))
    monkeypatch.setattr(shingle_dedup, "bands", lambda grams: [int(grams[0]) // 2] if len(grams) else [])  # bands that find next to nothing
    words = [f"word{k}" for k in range(400)]
    texts = [" ".join(words), " ".join([*words[:399], "other"]), " ".join(f"more{k}" for k in range(50)), "", None]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r["doc_id"] for r in shingle_dedup.drop_near_copies(docs).collect())
    assert seen == [3] and kept == [0, 2, 3]
