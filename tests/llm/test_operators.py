import base64
import collections
import math
import os
import random
import struct

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import (bpe, common, components, embed_dedup, line_dedup, mixing, pieces, quality, sharding, simhash_dedup,
                           suffix_dedup, token_files, warc)
from tallyline.session import scratch_path

WORDS = "the of an ion stone river Light glass under eleven copper field autumn ledger minor valley seventh orbit".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
# Columns whose names the operators use for their results.
CLASH = "shard int, slot string, kept string, n_lines int, size string, target int, llr string, taken int, key int, id int"


def prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ".", ","]) for _ in range(n))


def edge_rows():
    r = random.Random(11)
    shared = "this exact line is shared by many documents of the set"
    passage = prose(r, 60)
    rows = [(1, None, None, None), (2, "", "en", "b"), (3, "x", "en", "b"), (4, "word " * 3000, "en", "a"), (5, " \n\t\n ", "en", None)]
    for i in range(6, 30):
        rows.append((i, prose(r, r.randint(5, 60)) + f"\n  {shared.upper() if i % 3 else shared}  \n" + prose(r, 12), "en", "abcé"[i % 4]))
    copy = prose(r, 80)
    rows += [(i, copy, "en", "a") for i in range(30, 40)]
    rows += [(i, copy.replace("river", "rivers", 1), "en", "a") for i in range(40, 43)]
    rows += [(i, prose(r, 20) + passage + prose(r, 20), None, "a") for i in range(43, 47)]
    rows += [(47, "é" * 900, "fr", "b"), (None, copy, "en", None), (None, prose(r, 30), "en", "a")]
    rows += [rows[10], rows[10], rows[35]]
    return [(*x, len(x[1] or "")) for x in rows]


@pytest.fixture(scope="module")
def edge(spark):
    rows = edge_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clash = docs.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASH.split(", ")])
    return rows, clash


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def test_edge_tables_give_what_plain_python_gives(spark, edge):
    rows, docs = edge
    pairs = [(r[0], r[1]) for r in rows]
    got = line_dedup.drop_lines(docs).select("doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit(""))).collect()
    assert sorted_rows(got) == sorted_rows(brute.drop_lines(pairs))
    assert sum(r[2] for r in got) > 20

    got = suffix_dedup.remove_repeats(docs, length=60, spread=40).collect()
    assert sorted_rows((*r[:4], bytes(r[4])) for r in got) == sorted_rows(brute.repeats(pairs, 60))
    hot = suffix_dedup.remove_repeats(docs, length=60, spread=40, group=3).collect()
    assert sorted_rows(map(tuple, hot)) == sorted_rows(map(tuple, got))
    many = suffix_dedup.remove_repeats(docs.repartition(7), length=60, spread=40, batches=7).collect()
    assert sorted_rows(map(tuple, many)) == sorted_rows(map(tuple, got))

    got = simhash_dedup.near_duplicates(docs).collect()
    low = -(2**63)
    ids = [low if r[0] is None else r[0] for r in rows]
    fp = np.array([brute.simhash(r[1]) for r in rows], dtype=np.uint64)
    label = brute.components(ids, np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4)
    want = [(r[0], int(f.astype(np.int64)), None if c == low else c) for r, f, c in zip(rows, fp, label, strict=True)]
    assert sorted_rows(got) == sorted_rows(want)


def test_mix_meets_its_targets(spark, edge):
    rows, docs = edge
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sum(r["size"] for r in got) == sum(brute.base_features(r[1])[0] for r in rows)
    names = sorted({r["source"] for r in got if r["source"] is not None}, key=lambda s: s.encode()) + [None]
    size = {s: sum(r["size"] for r in got if r["source"] == s) for s in names}
    weight, capped, total = {s: 1 + i % 3 for i, s in enumerate(names)}, {}, sum(size.values())
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        if not over:
            break
        capped |= {s: 3 * size[s] for s in over}
    target = {s: capped.get(s, level * weight[s]) for s in names}
    for r in got:
        assert r["source_size"] == size[r["source"]] and math.isclose(r["target"], target[r["source"]])
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["epochs"] * r["size"]
    for s in names:  # equal rows go together, so a source may miss its target by half of the largest such group
        groups = collections.Counter()
        for r in got:
            if r["source"] == s:
                groups[r["doc_id"], r["text"]] += r["size"]
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target[s]) <= max(groups.values()) / 2 + 1e-6
    assert sorted_rows(got) == sorted_rows(mixing.mix(docs.repartition(5)).collect())


def test_mix_of_rows_without_or_with_shared_ids(spark):
    r = random.Random(8)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, prose(r, r.randint(5, 40)), "en", "ab"[i % 4 == 0], 1) for i in range(900)]
    names = "s, last_key, last_id, key, c, b, p, rest, epochs, _mix_key, _mix_last_id, w, level".split(", ")
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(n).alias(n) for n in names])
    got = mixing.mix(docs).collect()
    assert len(got) == 900 and all(x[n] == n for x in got for n in names if n != "epochs")
    for s in "ab":
        mine = [x for x in got if x["source"] == s]
        assert abs(sum(x["taken"] for x in mine) - mine[0]["target"]) <= max(x["size"] for x in mine)
        assert all(len({x["epochs"] for x in mine if x["doc_id"] == i}) == 2 for i in (None, 7))


def test_mix_prefers_documents_of_higher_weight(spark):
    rows = [(i, "plain words here" if i % 2 else "### $$$ words", "en", "ab"[i % 2 if i < 200 else 1], 1) for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).where("source = 'b'").collect()
    part = lambda odd: np.mean([r["epochs"] for r in got if r["doc_id"] % 2 == odd])
    assert part(1) > part(0)


def test_shards_have_exact_sizes_and_gapless_slots(spark, edge):
    rows, docs = edge
    got = sharding.shard_rows(docs, 8).collect()
    by_shard = collections.defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    counts = [len(by_shard[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and all(sorted(x) == list(range(len(x))) for x in by_shard.values())
    assert sorted_rows(r[:5] for r in got) == sorted_rows(rows)


def test_communication_matrix_has_its_sums_and_its_distribution():
    rows, shards = [5, 0, 7, 20], [8, 12, 12]
    draws = [sharding.communication_matrix(rows, shards, seed) for seed in range(3000)]
    assert all((m.sum(axis=1) == rows).all() and (m.sum(axis=0) == shards).all() for m in draws)
    for i in range(4):
        for j in range(3):
            x = [m[i, j] for m in draws]
            mean, p = rows[i] * shards[j] / 32, shards[j] / 32
            assert abs(np.mean(x) - mean) < 0.12
            assert abs(np.var(x) - rows[i] * p * (1 - p) * (32 - rows[i]) / 31) < 0.25
    rng = np.random.default_rng(1)
    big = [sharding.hypergeometric(rng, 4 * 10**10, 10**11, 10**8) for _ in range(300)]
    assert abs(np.mean(big) - 4 * 10**7) < 4 * math.sqrt(2.4e7 / 300) and 0.7 < np.var(big) / 2.4e7 < 1.4


def test_bpe_chunks_and_round_trip(spark, edge):
    rows, docs = edge
    import public_tokenizers
    import tiktoken

    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(1)
    bits = ["a", "b ", " ", "\n", "'s", "'re", " 12", "é", " \n  ", "...", "word ", "\x1f", " ", "中"]
    odd = ["".join(r.choice(bits) for _ in range(n)) for n in (5, 300, 900, 1500, 2500)] + ["x" * 3000, " " * 3000, "ab " * 1500]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    got = bpe.decode(bpe.encode(every, chunk=300, overlap=40)).collect()
    texts = [(x[0], x[1] or "") for x in rows] + [(100 + i, t) for i, t in enumerate(odd)]
    assert sorted_rows((x["doc_id"], x["ids"], bytes(x["decoded"])) for x in got) == sorted_rows(
        (i, encoding.encode_ordinary(t), t.encode()) for i, t in texts)


def test_stitching_stops_where_neighbours_never_agree():
    heads = [np.array([]), np.array([10, 12]), np.array([21])]
    assert bpe.stitches(heads, [np.array([11, 12]), np.array([21, 23]), np.array([])]) == [12, 21]
    assert bpe.stitches(heads, [np.array([11]), np.array([21, 23]), np.array([])]) == []


def test_piece_cache_equals_the_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.TOKENIZER)
    tokenizer.encode_special_tokens = True
    cache = pieces.PieceCache(pieces.json_file_cache(token_files.TOKENIZER).encode, most=50)
    r = random.Random(5)
    bits = ["a", "b ", " ", "\n", "'s", "'re", " 12", "é", " \n  ", ". ", "word ", "\x1f", "中", "x.", "\n\n", "y,", "'", "\t", "<|endoftext|>", "%%%", "&&&", "(", "--", "_", "É"]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 25)))
        assert np.frombuffer(cache.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_encoded_as_the_library_does(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.TOKENIZER)
    cache = pieces.json_file_cache(token_files.TOKENIZER)
    assert np.frombuffer(cache.ids("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    r = random.Random(6)
    bits = ["a", "b ", " ", "\n", "'s", " 12", "é", "word ", "<|endoftext|>", "<|endoftext|", "<|ENDOFTEXT|>", "x."]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 15))) for _ in range(2000)]
    plain = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    assert all(np.frombuffer(cache.ids(t), "<u4").tolist() == plain(t) for t in texts)
    docs = spark.createDataFrame(list(enumerate(texts[:40])), "doc_id long, text string")
    got = token_files.read_token_files(token_files.write_token_files(docs, scratch_path(spark, "tokens"))).collect()
    assert {x["doc_id"]: np.frombuffer(x["ids"], "<u4").tolist() for x in got} == {i: plain(t) + [0] for i, t in enumerate(texts[:40])}


def test_token_files_read_back_whole_and_in_part(spark, edge, empty):
    rows, docs = edge
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.TOKENIZER)
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write_token_files(docs, folder)
    got = token_files.read_token_files(manifest).collect()
    ids = lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
    assert sorted_rows((r["doc_id"], bytes(r["ids"])) for r in got) == sorted_rows((r[0], ids(r[1])) for r in rows)
    in_order = sorted(got, key=lambda r: r["start"])
    known = [r["doc_id"] for r in in_order]
    assert known == sorted(known, key=lambda i: (i is not None, i or 0))
    ends = np.cumsum([len(r["ids"]) // 4 for r in in_order])
    assert [r["start"] for r in in_order] == [0, *ends[:-1].tolist()]
    part = token_files.read_token_files(manifest, [7, 33, 9999]).collect()
    assert sorted_rows(part) == sorted_rows(r for r in got if r["doc_id"] in (7, 33))
    assert token_files.read_token_files(token_files.write_token_files(empty, scratch_path(spark, "tokens"))).count() == 0


def test_a_folder_without_a_scheme_is_in_the_store_that_spark_takes(spark):
    conf = spark._jsc.hadoopConfiguration()
    assert common.full_address(spark, "/a/b") == "file:/a/b"
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://names:8020")
    try:
        assert common.full_address(spark, "/a/b") == "hdfs://names:8020/a/b"
        assert common.full_address(spark, "file:///a/b").startswith("file:/")
        assert common.full_address(spark, "s3a://bucket/a") == "s3a://bucket/a"
    finally:
        conf.set("fs.defaultFS", before)
    assert common.shared_fs("file:///a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="names no store"):
        common.shared_fs("/a/b")


def test_a_token_file_is_read_by_frames_and_checked(tmp_path):
    path = tmp_path / "x"
    docs = [(i, np.arange(i, i + 500, dtype="<u4").tobytes()) for i in range(50)]
    with open(path, "wb") as f:
        writer = token_files.FrameWriter(f, frame_bytes=8000)
        for d in docs:
            writer.add(*d)
        writer.close()
    with open(path, "rb") as f:
        reader = token_files.FrameReader(f, os.path.getsize(path))
        assert len(reader.frames) == 13 and list(reader.read(np.array([4, 5, 49]))) == [docs[4], docs[5], docs[49]]
        assert reader.frames_read == 2
    raw = bytearray(path.read_bytes())
    raw[-5] ^= 0  # the seek table itself stays
    at = len(raw) - 9 - 12 * 13 + 8
    raw[at:at + 4] = struct.pack("<I", 12345)
    path.write_bytes(raw)
    with open(path, "rb") as f, pytest.raises(ValueError, match="frame 0 is damaged"):
        list(token_files.FrameReader(f, os.path.getsize(path)).read())


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        sizes, bits = line_dedup.build_hash(keys)
        assert sorted(line_dedup.probe_hash(sizes, bits, keys)) == list(range(len(keys)))


def test_quality_equals_plain_python(spark, edge):
    rows, docs = edge
    labels = [(i, int(i % 5 != 0), int(i % 7 == 0)) for i in range(1, 40)] + [(None, 1, 0), (6, None, None), (8, 0, 0)]
    got = quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    bad = {i for i, q, t in labels if q == 0 or t == 1}
    trusted = {i for i, q, t in labels if i is not None and q == 1} - bad
    B = quality.cells_for(sum(len(r[1] or "") for r in rows))
    assert [quality.cells_for(n) for n in (0, 6 * 2**24, 6 * 2**24 + 6, 6 * 2**28)] == [2**16, 2**16, 2**17, 2**18]

    def cells(text):
        w = brute.re.findall(brute.WORD, text or "")
        return [brute.cell(brute.chained(x), B) for x in w] + [B + brute.cell(brute.chained(x, y), B) for x, y in zip(w, w[1:], strict=False)]

    raw, target = collections.Counter(), collections.Counter()
    for r in rows:
        raw.update(cells(r[1]))
        if r[0] in trusted:
            target.update(cells(r[1]))
    totals = [(sum(v for k, v in c.items() if k // B == o)) for o in (0, 1) for c in (raw, target)]

    def score(text):
        g = cells(text)
        scale = [totals[1] / totals[0], totals[3] / totals[2]]
        return sum(math.log((target[c] + 10) / (raw[c] * scale[c // B] + 10)) for c in g) / (len(g) + 16)

    plain = lambda r: (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
    assert sorted_rows(map(plain, got)) == sorted_rows((r[0], *brute.base_features(r[1])) for r in rows)
    for r in got:
        assert math.isclose(r["llr"], score(r["text"]), abs_tol=1e-9)
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert (r["base_failed"], r["kept"]) == (failed, not failed and r["llr"] >= quality.THRESHOLD)
    # A filter must not make the features dearer or different.
    assert quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("kept").count() == sum(r["kept"] for r in got)


def test_quality_tells_held_out_labels_apart(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    held = quality.judge(docs, half).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed AND coalesce(toxic, 0) = 0")
    rate = {r["quality"]: r["r"] for r in held.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("r")).collect()}
    assert rate[1] >= 0.97 and rate[0] <= 0.25  # fitted on some 75 trusted documents


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    x, z = rng.normal(size=(150, 16)), rng.normal(size=(150, 16))
    rows = [*x.tolist(), *(x[:60] * 3).tolist(), *(x[:80] + 0.15 * z[:80]).tolist(), *x[:20].tolist(), None, [], [0.0] * 16,
            [float("nan")] * 16, [None] * 16, [1.0], (x[0] * 1e200).tolist(), (x[1] * 1e-200).tolist()]
    table = [*enumerate(rows), (None, x[0].tolist())]
    got = {r["vec_id"]: tuple(r) for r in embed_dedup.link_vectors(spark.createDataFrame(table, "vec_id long, embedding array<double>")).collect()}
    usable = [v is not None and len(v) == 16 and all(y is not None and math.isfinite(y) for y in v) and any(v) for v in rows]
    unit = np.array([np.array(v) / np.abs(v).max() if ok else np.zeros(16) for v, ok in zip(rows, usable, strict=True)])
    unit[usable] /= np.linalg.norm(unit[usable], axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    label = brute.components(list(range(len(rows))), linked)
    want = {i: (i, int(linked[i].sum()), label[i], i == label[i]) for i in range(len(rows))} | {None: (None, 0, None, True)}
    assert got == want
    assert embed_dedup.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vectors_of_each_length_link_among_themselves(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 6)), rng.normal(size=(50, 9))
    rows = [*x.tolist(), *y.tolist(), *(x + 0.05 * rng.normal(size=x.shape)).tolist(), *(y + 0.05 * rng.normal(size=y.shape)).tolist(), [1.0], [2.0], [-1.0], [1.0] * 20, [2.0] * 20]
    got = {r["vec_id"]: tuple(r)[1:3] for r in embed_dedup.link_vectors(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")).collect()}
    unit = [np.array(v) / np.linalg.norm(v) for v in rows]
    linked = np.array([[i != j and len(a) == len(b) and a @ b >= 0.9 for j, b in enumerate(unit)] for i, a in enumerate(unit)])
    label = brute.components(list(range(len(rows))), linked)
    assert got == {i: (int(linked[i].sum()), label[i]) for i in range(len(rows))}
    assert sum(linked[:40].sum(axis=1) > 0) == 40 and got[180] == (1, 180) and got[184] == (1, 183)


def test_embedding_recall_at_the_threshold(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.901 * x + math.sqrt(1 - 0.901**2) * z
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    got = embed_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.where("component_id < vec_id").count() >= 0.97 * 3000  # 0.9 is asked for


def test_byte_triples_and_components(spark):
    from itertools import combinations

    triples = [set(t) for t in simhash_dedup.byte_triples()]
    assert len(triples) == 20 and all(any(t <= set(c) for t in triples) for c in combinations(range(8), 4))
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (50, 60), (60, 55)]
    got = dict(map(tuple, components.components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100, 60: 50, 55: 50}


def test_long_posting_lists_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "LIST", 4)
    monkeypatch.setattr(simhash_dedup, "BLOCK", 3)
    r = random.Random(4)
    values = list({sum(1 << b for b in r.sample(range(24), 4)) for _ in range(60)})
    rows = [(i, v) for i, v in enumerate(values)]
    got = dict(map(tuple, components.components(simhash_dedup.links(spark.createDataFrame(rows, "id long, fp long"))).collect()))
    fp = np.array(values, dtype=np.uint64)
    label = brute.components(list(range(len(values))), np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4)
    assert {i: got.get(i, i) for i in range(len(values))} == dict(enumerate(label))


def test_archives(spark):
    long, short = "x" * 200, "y" * 50
    pages = [(1, "http://a/ü b\n", long), (2, None, long), (3, "u", None), (None, "u", long), (5, "u", short), (6, "u", short), (1, "z", long), (7, "w", "é\r\n\r\nWARC/1.1\r\n" * 20)]
    folder = scratch_path(spark, "archives")
    warc.write_pages(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), folder)
    got = warc.read_archive(spark, folder).select(warc.page_number("record_id").alias("page"), "record_type", warc.page_number("refers_to"), "payload_bytes", "payload")
    want = [(1, "response", None, 200, long), (2, "revisit", 1, 200, None), (3, "response", None, 0, ""), (None, "revisit", 1, 200, None),
            (5, "response", None, 50, short), (6, "response", None, 50, short), (1, "response", None, 200, long), (7, "response", None, len(pages[-1][2].encode()), pages[-1][2])]
    assert sorted_rows((*r[:4], None if r[4] is None else bytes(r[4]).decode()) for r in got.collect()) == sorted_rows(want)
    only = warc.read_archive(spark, folder, payload=False).where("record_type = 'revisit' AND record_id LIKE '<urn:%'")
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert only.count() == 2 and "record_type" in plan and "revisit" not in plan  # the reader has taken both filters
    assert only.where("payload IS NOT NULL").count() == 0


def test_unwanted_blocks_are_jumped_over(tmp_path):
    path = tmp_path / "a.warc"
    with open(path, "wb") as f:
        for i in range(5):
            f.write(warc.record("response", str(i), "u", "d", None, b"p" * (3 << 20), 3 << 20))

    class Counting:
        def __init__(self, f):
            self.f, self.n = f, 0

        def read(self, n):
            out = self.f.read(n)
            self.n += len(out)
            return out

        def seek(self, at):
            self.f.seek(at)

    with open(path, "rb") as f:
        counting = Counting(f)
        assert len(list(warc.records(counting, lambda row: False, True))) == 0 and counting.n < 6 << 20
        f.seek(0)
        rows = list(warc.records(f, lambda row: row["record_id"].endswith("3>"), True))
        assert len(rows) == 1 and rows[0]["payload"] == b"p" * (3 << 20)


def test_a_family_that_is_opened_again_goes_on(spark, edge):
    docs = edge[1].select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(0).cast("long").alias("mark"))
    entries = common.materialize(suffix_dedup.suffixes(docs.repartition(5), 5, 60, 40), "entries")
    batch = lambda k: entries.where(F.col("batch") == k)
    family, found = suffix_dedup.Family(spark), []
    for k in range(5):
        found += [r["key"] for r in family.take(batch(k)).collect()]
        folder = family.keep()
        for _, name in family.levels:  # another session knows the files only
            spark.sql(f"DROP TABLE {name}")
        family = suffix_dedup.Family.open(spark, folder)
    assert [n for n, _ in family.levels] == [4, 1]
    times = {r["key"]: r["count"] for r in entries.groupBy("key").count().collect()}
    assert set(found) == {k for k, n in times.items() if n > 1} and len(found) > 5
    keys = spark.createDataFrame([(k,) for k in set(found)], "key long")
    got = sorted_rows(family.places(keys).collect())
    assert got == sorted_rows(entries.where(F.col("key").isin(list(set(found)))).select("key", "doc_id", "mark", "place").collect())
    arrays = [r for _, name in family.levels for r in spark.table(name).collect()]
    assert sum(r["n"] for r in arrays) == entries.count() and all(sorted(r["key"] for r in arrays).count(k) <= 2 for k in set(found))
    plan = family.spark.table(family.levels[0][1]).join(family.spark.table(family.levels[1][1]).hint("merge"), "key")._jdf.queryExecution().toString()
    assert "Exchange" not in plan  # levels meet bucket by bucket
    family.drop()


def test_strings_of_one_hash_are_told_apart_by_their_bytes():
    contexts = [b"abcdef", b"xbcdeg", b"abcdzz"]
    row, place, hashed = suffix_dedup._windows(contexts, 4)
    told = suffix_dedup._numbers(contexts, row, place, hashed, 4)
    clash = suffix_dedup._numbers(contexts, row, place, np.zeros_like(hashed), 4)
    strings = [contexts[i][a:a + 4] for i, a in zip(row, place, strict=True)]
    for numbers in (told, clash):
        assert [[a == b for b in numbers] for a in numbers] == [[a == b for b in strings] for a in strings]


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(empty, labels).count() == 0
    assert line_dedup.drop_lines(empty).count() == 0
    assert simhash_dedup.near_duplicates(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert sharding.shard_rows(empty).count() == 0
    assert bpe.decode(bpe.encode(empty)).count() == 0
    folder = scratch_path(spark, "archives")
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_archive(spark, folder).count() == 0
