"""Each operator against brute force or an exact round trip, and its edge cases."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from foliary.llm import ball_tree, best_fit, chosen_path, chunk_store, duck_bpe, jpeg_media, language_fusion, pu_quality, tag_paths, weak_toxicity

DOCS = "doc_id long, text string, score string, label string, sid string"
ODD = [
    (1, "The quick brown fox, it's 12,345.6 don't.\nNext line  two spaces "), (2, None), (3, ""), (4, "  a  b\n\n c, d ,e..f\n . x\t\ny "), (5, "a\x01b, c <|endoftext|> "),
    (6, "ünïcödé é é, ñ. 　 z  w ٣٤"), (7, "x" * 5000 + " " * 70 + "\n" * 5), (8, "漢字仮名交じり文章" * 40), (1, "The quick brown fox, it's 12,345.6 don't.\nNext line  two spaces "), (9, "İstanbul ǅ ≠= x"), (None, "no id here"), (10, "word " * 3000),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "l", "x") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_duck_bpe_equals_tiktoken(odd, empty):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=duck_bpe.read_ranks(path), special_tokens={})
    rows = duck_bpe.encode_decode(odd, path, public_tokenizers.PATTERN, digests=True).collect()
    want = sorted(((-1 if i is None else i), len(ids := e.encode_ordinary(t or "")), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    for r in duck_bpe.encode_decode(odd, path, public_tokenizers.PATTERN).collect():
        assert bytes(r.decoded).decode() in {t or "" for _, t in ODD} and e.decode(r.ids).encode() == bytes(r.decoded)
    assert duck_bpe.encode_decode(empty, path, public_tokenizers.PATTERN, digests=True).count() == 0


def test_duck_bpe_of_long_words():
    import time

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=duck_bpe.read_ranks(path), special_tokens={})
    duck = duck_bpe.DuckBpe(path, public_tokenizers.PATTERN)
    rng = random.Random(8)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    latin = "abcdefghijklmnopqrstuvwxyz"
    words = ["a" * 5000, "=" * 3000, "ab" * 2000, "-" * 777, "Ã" * 1500, "the" * 300, "=-" * 2000]
    words += [word(latin, rng.randint(1, 220)) for _ in range(300)] + [word("aabétèionsr", rng.randint(60, 900)) for _ in range(20)] + [word("etaoin", n) for n in range(90, 200)]
    assert duck.encode_words([w.encode() for w in words]) == [e.encode_ordinary(w) for w in words]
    for w in (word(latin, 100_000), "=" * 100_000):
        began = time.process_time()
        assert duck.encode_words([w.encode()]) == [e.encode_ordinary(w)]
        assert time.process_time() - began < 30  # some 4 to 6 seconds


def test_pieces_equal_whole_texts():
    """Fuzz over what normalisation takes apart or puts together, odd white space and the strings of special tokens."""
    import pyarrow as pa

    from foliary.llm.pieces import library_table

    rng = random.Random(11)
    alphabet = ["İ", "क़", "ŉ", "é", "e\u0301", "ǅ", "K", "Å", "ﬁ", "ß", "Σ", "a", "b", "x", "I", "1", "²", "٣", "漢", "\u0338", "\u200d", "\u200b", "\xad", "\u180e", ",", ".", "'s", "'", "!", "-", " ", " ", " ", "\n", "\t", "\r", "\xa0", "\u3000", "\x0b", "\x1c", "\x85", "\x01", "\x02", "<|endoftext|>", "<|startoftext|>", "<|", "|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(20_000)] + ["İ, x", "क़, x", "a <|endoftext|> b", " <|startoftext|>,", "\u0307, x. \u0307", "a \x02 b \x02"]
    for name, vanish in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        encode = library(name)
        table = library_table(public_tokenizers.path(name), limit=500)
        for at in range(0, len(texts), 2000):
            part = texts[at : at + 2000]
            ids, ends = table.encode_texts(pa.array(part), spaces_vanish=vanish)
            for t, a, b in zip(part, ends[:-1], ends[1:], strict=True):
                assert ids[a:b].tolist() == encode(t), (name, t)


def test_packing_does_not_depend_on_batches(spark):
    rng = random.Random(2)
    pieces = best_fit.stage(spark.createDataFrame([(i, 0, 0, rng.randint(1, 256), i) for i in range(9000)], best_fit.PIECES), "t")
    found = []
    for size in ("10000", "700"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        found.append(sorted(map(tuple, best_fit.pack(pieces, capacity=256, open_bins=20).collect())))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1]
    ends, whole = {}, 0
    for _, _, _, n, _, which, offset in sorted(found[0], key=lambda r: r[5:]):
        assert offset == ends.get(which, 0)
        ends[which] = offset + n
        whole += n
    assert max(ends.values()) <= 256 and sum(ends.values()) == whole


def test_best_fit_pieces_and_places(odd, empty):
    encode = library("word_bpe_49k.json")
    rows = best_fit.pack_documents(odd, public_tokenizers.path("word_bpe_49k.json"), capacity=256).collect()
    texts = dict(ODD)
    for r in rows:
        ids = [*encode(texts[r.doc_id]), 0]
        assert zlib.crc32(u32(ids[r.start : r.start + r.length])) == r.ids_crc32 and r.start == 256 * r.piece
    assert sum(r.length for r in rows) == sum(len(encode(t)) + 1 for _, t in ODD)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert best_fit.pack_documents(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_best_fit_closes_the_fullest():
    b = best_fit.BestFit(10, 2)
    assert b.place(6) == (0, 0) and b.place(7) == (1, 0)
    assert b.place(3) == (1, 7)  # the best fit is filled
    assert b.place(8) == (2, 0) and b.place(9) == (3, 0)  # bin 2 (2 free) closes, bin 0 (4 free) stays
    assert b.place(4) == (0, 6)
    rng = random.Random(3)
    sizes = [rng.randint(1, 10) for _ in range(3000)]
    b = best_fit.BestFit(10, 64)
    for n in sizes:
        b.place(n)
    assert b.n_bins <= 1.02 * sum(sizes) / 10 + 64


def test_chunk_store_round_trip(spark, odd, empty, tmp_path):
    path, tokenizer = str(tmp_path / "store"), public_tokenizers.path("byte_bpe_50k.json")
    encode = library("byte_bpe_50k.json")
    chunk_store.write_store(odd, path, tokenizer)
    want = {i: [*encode(t), 0] for i, t in ODD}
    got = chunk_store.verify(spark, path).collect()
    assert len(got) == len(ODD)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(u32(want[r.doc_id]))
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((i for i, _ in ODD), key=lambda i: -1 if i is None else i)
    for r in chunk_store.reconstruct(spark, path).collect():
        assert r.ids == want[r.doc_id]
    digests = [bytes(r.digest) for r in spark.read.parquet(path).where("kind = 'chunk'").select("digest").collect()]
    assert len(digests) == len(set(digests))
    assert chunk_store.store_and_verify(empty, tokenizer).count() == 0


def test_chunks_of_shared_passages_are_shared():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 50000, 6000)
    a, b = np.concatenate([rng.integers(0, 50000, 100), passage]), np.concatenate([rng.integers(0, 50000, 333), passage])
    chunks = []
    for x in (a, b):
        cuts = chunk_store.cut_points(x, np.array([0, len(x)]), 16, 512, 64, 4096)[0]
        chunks.append({x[s:e].tobytes() for s, e in zip([0, *cuts], cuts, strict=False)})
        assert cuts[-1] == len(x)
    assert len(chunks[0] & chunks[1]) >= len(chunks[0]) - 3


def store(spark, path, rows):
    chunk_store.write_store(frame(spark, rows), path, public_tokenizers.path("byte_bpe_50k.json"))
    return path


def changed_copy(spark, path, other, which, change):
    """A store like ``path`` in which ``change`` was applied to one of its tables."""
    for end in ("", "-recipes", "-top"):
        df = spark.read.parquet(path + end)
        writer = (change(df) if end == which else df).write
        (writer.partitionBy("kind") if end != "-top" else writer).parquet(other + end)
    return other


def test_a_changed_store_is_found(spark, tmp_path):
    rows = [(i, f"document {i} of equal length") for i in range(10, 40)] + [(50, None), (51, "one " * 3000)]
    path = store(spark, str(tmp_path / "store"), rows)
    assert chunk_store.verify(spark, path).count() == len(rows)
    recipes = spark.read.parquet(f"{path}-recipes")
    other = recipes.where("doc_id = 13").first()
    one = F.col("doc_id") == 11
    lost = spark.read.parquet(path).where("kind = 'chunk'").first().digest
    page = F.col("kind") == "manifest"
    for i, (which, message, change) in enumerate([
        ("", "doesn't match its digest", lambda df: df.withColumn("payload", F.when(F.col("kind") == "chunk", F.concat("payload", F.lit(b"\0\0"))))),
        ("", "a chunk is missing", lambda df: df.where(F.col("digest") != F.lit(bytes(lost)))),
        ("-recipes", "don't give its Merkle root", lambda df: df.withColumn("digests", F.when(one, F.lit(bytes(other.digests))).otherwise(F.col("digests")))),
        ("-recipes", "don't give its root in the manifest", lambda df: df.withColumn("digests", F.when(one, F.lit(bytes(other.digests))).otherwise(F.col("digests"))).withColumn("root", F.when(one, F.lit(bytes(other.root))).otherwise(F.col("root")))),
        ("-recipes", "don't give its Merkle root", lambda df: df.withColumn("root", F.when(one, F.lit(bytes(other.root))).otherwise(F.col("root")))),
        ("-recipes", "not as many as the manifest says", lambda df: df.where(~one | page)),
        ("-recipes", "not as many as its recipe says", lambda df: df.withColumn("n_tokens", F.when(one, F.col("n_tokens") + 1).otherwise(F.col("n_tokens")))),
        ("-recipes", "doesn't match the root on top", lambda df: df.withColumn("root", F.when(page, F.lit(bytes(other.root))).otherwise(F.col("root")))),
        ("-recipes", "doesn't match the root on top", lambda df: df.where(~page)),
        ("-top", "doesn't match the root on top", lambda df: df.withColumn("root", F.lit(bytes(other.root)))),
    ]):
        with pytest.raises(Exception, match=message):
            chunk_store.verify(spark, changed_copy(spark, path, str(tmp_path / f"changed{i}"), which, change)).collect()


def test_reconstruct_finds_lost_changed_and_swapped_chunks(spark, tmp_path):
    rows = [(i, f"document {i} of equal length") for i in range(12)] + [(50, "one " * 4000), (51, "two " * 4000)]
    path = store(spark, str(tmp_path / "store"), rows)
    chunks = spark.read.parquet(path).where("kind = 'chunk'").orderBy("digest").select("digest", "payload").collect()
    a, b = chunks[0], chunks[1]
    is_a, is_b = F.col("digest") == F.lit(bytes(a.digest)), F.col("digest") == F.lit(bytes(b.digest))
    payload = lambda when: lambda df: df.withColumn("payload", when.otherwise(F.col("payload")))
    one, longer = F.col("doc_id") == 1, F.col("kind") == "recipe"
    two = spark.read.parquet(f"{path}-recipes").where("doc_id = 2").first()
    for i, (which, message, change) in enumerate([
        ("", "is missing", lambda df: df.where(~F.coalesce(is_a, F.lit(False)))),
        ("", "doesn't match its digest", payload(F.when(is_a, F.concat(F.col("payload"), F.lit(b"\0\0"))))),
        ("", "doesn't match its digest", payload(F.when(is_a, F.lit(bytes(b.payload))).when(is_b, F.lit(bytes(a.payload))))),
        ("-recipes", "don't give its Merkle root", lambda df: df.withColumn("digests", F.when(one & longer, F.lit(bytes(two.digests))).otherwise(F.col("digests")))),
        ("-recipes", "ids", lambda df: df.withColumn("n_tokens", F.when(one & longer, F.col("n_tokens") + 1).otherwise(F.col("n_tokens")))),
    ]):
        with pytest.raises(Exception, match=message):
            chunk_store.reconstruct(spark, changed_copy(spark, path, str(tmp_path / f"changed{i}"), which, change)).collect()
    assert {r.doc_id for r in chunk_store.reconstruct(spark, path).collect()} == {i for i, _ in rows}


def test_pages_of_the_manifest(spark, tmp_path, monkeypatch):
    rows = [(i % 700, f"text {i % 900}") for i in range(2500)]
    path = store(spark, str(tmp_path / "store"), rows)
    encode = library("byte_bpe_50k.json")
    got = chunk_store.verify(spark, path).collect()
    want = sorted((d, zlib.crc32(u32([*encode(t), 0]))) for d, t in rows)
    assert sorted((r.doc_id, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    pages = spark.read.parquet(f"{path}-recipes").where("kind = 'manifest'")
    assert pages.count() >= 3 and pages.agg(F.sum("n_docs")).first()[0] == len(rows)


def test_ball_tree_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(400, 8))
    base[100:200] = base[100]  # ties
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(base)]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * 6), (1002, [float("nan")] * 8), (1003, [float("inf")] * 8), (None, [1.0] * 8), (50, rows[50][1]), (2000, [1.0, 2.0]), (2050, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    v = np.floor(np.array([r[1] for r in rows[:400]]) * 256).astype(np.int64)
    want = []
    for q in range(0, 400, 50):
        order = sorted((-int(v[q] @ v[i]), i) for i in range(400) if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(order)]
    want += [(2000, 1, 2050, (256 * 768 + 512 * 1024)), (2050, 1, 2000, (256 * 768 + 512 * 1024))]
    for shard_rows in (20_000, 60):
        got = ball_tree.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    huge = spark.createDataFrame([(0, [1e7]), (1, [3e15]), (2, [-5.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ball_tree.top_k(huge, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, -2_560_000_000 * 1280)]
    assert ball_tree.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_ball_tree_asks_few_balls_on_clusters_and_splits_copies(spark):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(40, 16)) * 4
    base = middles[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16)) * 0.2
    base[1000:2000] = base[1000]  # a third of all rows are copies
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    v = np.floor(base * 256).astype(np.int64)
    want = []
    for q in range(0, 3000, 50):
        order = sorted((-int(s), i) for i, s in enumerate(v @ v[q]) if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(order)]
    for near in (1, 4):
        sent = []
        got = ball_tree.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=60, near=near, sent=sent)
        assert sorted(map(tuple, got.collect())) == sorted(want)
        assert sum(x.count() for x in sent) < 60 * 50 / 4  # queries times shards of 60 rows
    even = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.random((600, 16)))], "vec_id long, embedding array<double>")
    by_one = ball_tree.top_k(even, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, ball_tree.top_k(even, F.col("vec_id") % 20 == 0, shard_rows=40).collect())) == sorted(map(tuple, by_one.collect()))


def brute_classes(texts, threshold=0.8):
    import pyarrow as pa

    s, e = chosen_path.shingle_sets(pa.array([t for _, t in texts], pa.string()))
    sets = [frozenset(s[e[i] : e[i + 1]].tolist()) for i in range(len(texts))]
    unique = list(dict.fromkeys(sets))
    near = [[j for j, b in enumerate(unique) if j != i and len(a & b) / len(a | b) >= threshold - 1e-12] for i, a in enumerate(unique)]
    root = list(range(len(unique)))
    for _ in unique:
        for i, js in enumerate(near):
            for j in js:
                root[i] = root[j] = min(root[i], root[j])
    ids = {}
    for (i, _), x in zip(texts, sets, strict=True):
        r = root[unique.index(x)]
        ids[r] = min(ids.get(r, i), i)
    return {i: (ids[root[unique.index(x)]], len(near[unique.index(x)])) for (i, _), x in zip(texts, sets, strict=True)}


def test_similarity_join_equals_brute_force(spark, empty):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(120)]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(120)] = word()
            texts.append((n, " ".join(own)))
            n += 1
    family = [word() for _ in range(200)]
    for _ in range(90):  # more than a bucket and a block, so that groups are split
        own = list(family)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(200)] = word()
        texts.append((n, " ".join(own)))
        n += 1
    texts += [(n + i, t) for i, t in enumerate(["", None, "one", "One.", "two words", "  ", "|||", "same long text of more than five words", "Same long text, of more than FIVE words!"])]
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.similarity_join(frame(spark, texts), bucket=16, block=32).collect()}
    assert got == brute_classes([(i, t or "") for i, t in texts])
    assert chosen_path.similarity_join(empty).count() == 0
    one = chosen_path.similarity_join(frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "q"), (2, "A b c d e f")])).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_copies) for r in one) == [(0, 0, 1), (1, 1, 3), (1, 1, 3), (2, 1, 3)]


def test_words_of_any_white_space_and_script():
    import pyarrow as pa

    lines = ["one two three four five six", "one\xa0two\u3000three\x0cfour\r\nfive\u2028six", "漢字かな交じり文", "漢字 かな交じ り文"]
    s, e = chosen_path.shingle_sets(pa.array(lines))
    sets = [set(s[e[i] : e[i + 1]].tolist()) for i in range(4)]
    assert sets[0] == sets[1] and sets[2] == sets[3] and len(sets[2]) == 4


def test_rows_without_doc_id_are_compared(spark):
    base = [f"w{i}" for i in range(100)]
    near = " ".join([*base[:-1], "other"])
    docs = frame(spark, [(None, " ".join(base)), (5, near), (None, near.upper()), (7, "something else"), (None, "x y z"), (None, "X y, z"), (7, " ".join(base[1:])), (3, " ".join(base[2:]))])
    rows = chosen_path.similarity_join(docs).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in rows) == [(0, 0, 0), (0, 0, 0), (0, 3, 3), (0, 3, 3), (3, 3, 3), (5, 3, 3), (7, 3, 3), (7, 7, 0)]
    kept = chosen_path.keep_one(docs, chosen_path.stage(chosen_path.similarity_join(docs), "t")).collect()
    assert sorted((r.doc_id or 0, r.text.lower().replace(",", "")) for r in kept) == [(0, "x y z"), (3, " ".join(base[2:])), (7, "something else")]


def test_keep_one_keeps_one_row_of_each_class(spark):
    docs = frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "other"), (None, "none")])
    classes = chosen_path.stage(chosen_path.similarity_join(docs), "t")
    assert sorted((r.doc_id or 0, r.text) for r in chosen_path.keep_one(docs, classes).collect()) == [(0, "none"), (1, "a b c d e f"), (3, "other")]


def test_jpeg_round_trip(odd, empty):
    media = jpeg_media.to_media(odd)
    rows = jpeg_media.features(media).collect()
    seen = {}
    for r in rows:
        raw = (dict(ODD)[r.doc_id] or "").encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert seen.setdefault(payload, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)
    assert len(rows) == len(ODD) and jpeg_media.features(jpeg_media.to_media(empty)).count() == 0
    data = bytes(media.where("doc_id = 1").first().media)
    assert data[:2] == b"\xff\xd8" and data[-2:] == b"\xff\xd9"


def test_jpeg_of_any_bytes():
    rng = np.random.default_rng(2)
    payloads = [rng.integers(0, 256, 64 * n, dtype=np.uint8).tobytes() for n in (1, 3, 40)] + [b"\xff" * 640, b"\0" * 64, bytes([0, 255] * 320), b"ab" * (jpeg_media.FRAME // 2)]
    files = jpeg_media.encode_images(payloads)
    for (image, grid), p in zip(jpeg_media.decode_dc(files), payloads, strict=True):
        assert grid.tobytes() == p and (image.width, image.height) == (512, 8 * len(p) // 64)
    assert jpeg_media.split_files(b"".join(files)) == files
    with pytest.raises(ValueError):
        jpeg_media.decode_dc([files[2][:-900] + b"\xff\xd9"])
    for broken in (b"GIF89a", files[0][:-2], files[0] + b"x"):
        with pytest.raises(ValueError):
            jpeg_media.decode_dc(jpeg_media.split_files(broken))


def test_jpeg_of_a_text_beyond_one_image(spark):
    """70 MB: more than 16 bits of height and width could hold in one image."""
    rng = np.random.default_rng(3)
    raw = rng.integers(32, 127, 70_000_000, dtype=np.uint8).tobytes()
    row = jpeg_media.store_and_read(frame(spark, [(1, raw.decode())])).first()
    payload = jpeg_media.payload_of(raw)
    assert (row.n_bytes, row.payload_bytes, row.payload_sha256, row.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert row.feature.startswith(f"512x{8 * len(payload) // 64} ")


def test_jpeg_reads_ac_coefficients():
    """A file of two components with AC coefficients and no restarts: only DC counts."""
    import struct

    dc = {0: 2, 3: 2, 5: 2}
    ac = {0x00: 2, 0x12: 2, 0xF0: 3, 0x01: 3}
    (dcc, dcb), (acc, acb) = jpeg_media._canonical(dc), jpeg_media._canonical(ac)
    bits = ""
    put = lambda code, extra="": format(code[0], f"0{code[1]}b") + extra
    for value, tail in ((5, [(0x12, "10"), (0xF0, ""), (0x01, "1")]), (-4, []), (20, [(0x01, "0")]), (0, [])):  # Y, Cb, Y, Cb differences
        size = abs(value).bit_length()
        v = value if value >= 0 else value + (1 << size) - 1
        bits += put(dcc[size], format(v, f"0{size}b") if size else "")
        bits += "".join(put(acc[s], e) for s, e in tail) + put(acc[0])
    bits += "1" * (-len(bits) % 8)
    data = int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\0")
    seg = lambda m, b: struct.pack(">BBH", 0xFF, m, len(b) + 2) + b
    head = b"\xff\xd8" + seg(0xDB, b"\0" + bytes([8] + [1] * 63)) + seg(0xC0, struct.pack(">BHHB", 8, 8, 16, 2) + bytes([1, 0x11, 0, 2, 0x11, 0]))
    head += seg(0xC4, b"\x00" + dcb + b"\x10" + acb) + seg(0xDA, bytes([2, 1, 0, 2, 0, 0, 63, 0]))
    image, grid = jpeg_media.decode_dc([head + data + b"\xff\xd9"])[0]
    assert grid.tolist() == [[133, 153]] and (image.width, image.height) == (16, 8)


def test_main_text():
    page = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{a:"</p>"}</style></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice">We use cookies, many.</div><header>Site name</header><article><h1>A &amp; B</h1><p><b>First   line.<br><p>Second&nbsp;one, long enough, with signs.</p><p>Hm.</p>
    <script>var t="</p>";</script><div id="comments"><p>Nice article, thanks, really!</p></div><form>Mail <input></form></article><aside>Other, news.</aside><footer>&copy; 2024</footer>"""
    assert tag_paths.main_text(page) == "A & B\nFirst line.\nSecond one, long enough, with signs.\nHm."
    bare = "<body><div class=menu><a>x</a></div><div class=post><h2>Head</h2><p>Some text, of a post, that goes on. And on.</p><p>More, of it, here.</p></div><div class=footer>bye</div>"
    assert tag_paths.main_text(bare) == "Head\nSome text, of a post, that goes on. And on.\nMore, of it, here."
    assert [tag_paths.main_text(x) for x in (None, "", "<nav>a</nav>", "<p>cut &am", "plain", "<p", "<!-- open <p>x</p>")] == ["", "", "", "cut &am", "plain", "", ""]


def test_extract_rows(spark):
    rows = [(1, "u", "<article><p>Hello there.</p></article>"), (1, "u", "<article><p>Hello there.</p></article>"), (None, None, None)]
    got = tag_paths.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "Hello there.", 12), (1, "Hello there.", 12)]


def test_language_fusion(spark):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the house of the king and the queen was with them", "en"), ("das haus und der könig und die königin waren dort nicht", "de")] * 20)], "doc_id long, text string, lang string")
    html = "<html lang={}><body><article><p>{}</p></article></body></html>"
    pages = [(1, "http://a.example.com/x", html.format("en", "the queen and the house, with the king.")), (2, "http://b.de/", html.format("de", "der könig und das haus, nicht die königin.")), (3, "http://b.de/2", html.format("de", "")), (4, None, None), (5, "http://b.de/3", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("lang", F.lit("clash"))
    got = {r.page_id: r for r in language_fusion.identify(df, docs).collect()}
    assert [got[i].language for i in (1, 2, 3, 5)] == ["en", "de", "de", "de"] and got[4].host == "" and got[4].language in ("en", "de")
    assert language_fusion.identify(df.limit(0), docs).count() == 0
    assert {r.language for r in language_fusion.identify(df, docs.limit(0)).collect()} == {None}
    assert language_fusion.address("https://u@fr.Example.org:80/de-DE/x?y", ["de", "fr"]) == ("fr.example.org", "example.org", "de")


def accuracy(spark, module, column, threshold=0.3):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = module.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert found["score"].between(0, 1).all() and ((found["score"] >= threshold) == (found["predicted"] == 1)).all()
    return found, (found["predicted"] == found[column]).mean()


def test_quality_on_held_out_labels(spark):
    found, share = accuracy(spark, pu_quality, "quality")
    assert share > 0.95 and (found[found["quality"] == 1]["predicted"] == 1).mean() > 0.97


def test_toxicity_on_held_out_labels(spark):
    found, share = accuracy(spark, weak_toxicity, "toxic")
    assert share > 0.92 and (found[found["toxic"] == 0]["predicted"] == 0).mean() > 0.98


@pytest.mark.parametrize("module", [pu_quality, weak_toxicity])
def test_classifiers_on_odd_input(spark, odd, empty, module):
    kinds = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (4, 0, 1), (None, 1, 1), (10, 1, 1), (77, 1, 1)], kinds)
    for known in (labels, labels.limit(0)):
        rows = module.classify(odd, known).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert module.classify(empty, labels).count() == 0
    held = {r.doc_id: r.held_out for r in rows}
    modulus, rest = (5, 0) if module is pu_quality else (4, 2)
    assert all(held[i] == (zlib.crc32(str(i).encode()) % modulus == rest) for i in held if i is not None) and held[None] is False


def test_labels_of_the_held_out_fold_are_not_read(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for module, column, fold in ((pu_quality, "quality", (5, 0)), (weak_toxicity, "toxic", (4, 2))):
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold[0] == fold[1]
        other = labels.withColumn(column, F.when(held, 1 - F.col(column)).otherwise(F.col(column)))
        a, b = ({r.doc_id: r.score for r in module.classify(docs, x).collect()} for x in (labels, other))
        assert a == b


def test_pu_prior():
    rng = np.random.default_rng(4)
    positive = rng.normal(0, 1, (3000, 3))
    unlabelled = np.concatenate([rng.normal(0, 1, (2100, 3)), rng.normal(4, 1, (900, 3))])
    model, prior = pu_quality.fit(positive, unlabelled)
    assert 0.6 < prior < 0.85
    assert (model.scores(unlabelled[:2100]) > 0.5).mean() > 0.95 and (model.scores(unlabelled[2100:]) < 0.5).mean() > 0.95


def test_label_model_weighs_good_voters():
    rng = np.random.default_rng(6)
    y = rng.random(3000) < 0.2
    good, copy, noise = (y & (rng.random(3000) < 0.8)) | (rng.random(3000) < 0.02), None, rng.random(3000) < 0.2
    copy = good.copy()
    third = (y & (rng.random(3000) < 0.7)) | (rng.random(3000) < 0.03)
    known = np.where(rng.random(3000) < 0.3, y.astype(int), -1)
    posterior, weight = weak_toxicity.label_model(np.column_stack([good, copy, noise, third]).astype(float), known)
    assert abs(weight[2]) < 0.5 < weight[3] and weight[0] + weight[1] < 2 * np.log(0.8 / 0.02)
    assert ((posterior > 0.5) == y).mean() > 0.93


def test_path_ratios_choose_the_content():
    long = "Some text, of a page, that goes on. " * 8
    page = f"<body><div>Products Solutions</div><div>Our team</div><article><p>Sign up</p></article><div class=x><p>{long}</p><p>Short.</p></div><div>All rights</div></body>"
    assert tag_paths.main_text(page) == f"{long.strip()}\nShort."
    # an article element with nothing but weak lines gives way; a list in a node that passes stays
    page = f"<body><article><p>Read on</p></article><div><p>{long}</p><ul><li>one item</li><li>two items</li><li>three</li><li>four</li><li>five</li></ul></div></body>"
    assert tag_paths.main_text(page).split("\n") == [long.strip(), "one item", "two items", "three", "four", "five"]


def hot_pairs(pairs=2000):
    """Isolated pairs at about 0.8: each holds six passages of 30, so that most of its shingles stand in many other texts."""
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    passages, rows = [word(24) for _ in range(30)], []
    for i in range(pairs):
        common = [w for k in sorted(rng.choice(30, 6, replace=False)) for w in passages[k]]
        rows += [(2 * i, " ".join(common + word(17))), (2 * i + 1, " ".join(common + word(17)))]
    return rows


def test_chosen_path_recall_of_pairs_in_split_buckets(spark):
    import pyarrow as pa

    rows = hot_pairs()
    s, e = chosen_path.shingle_sets(pa.array([t for _, t in rows[:2]]))
    a, b = (set(s[e[i] : e[i + 1]].tolist()) for i in range(2))
    assert 0.8 <= len(a & b) / len(a | b) < 0.81
    got = {r.doc_id: r.class_id for r in chosen_path.similarity_join(frame(spark, rows), bucket=2).collect()}
    assert [i for i in range(0, len(rows), 2) if got[i] != got[i + 1]] == []
    t, more = 0.8, chosen_path.more_runs(0.8, 0.9999, 6, 4)
    assert (1 - t) ** 6 + (1 - t**4) ** (6 + more) <= 1 - 0.9999 < (1 - t) ** 6 + (1 - t**4) ** (5 + more)


def test_blocks_outside_one_element_stay():
    long = "Some text, of a post, that goes on. " * 8
    part = "Second part, of the text, that goes on."
    assert tag_paths.main_text(f"<main><p>{long}</p></main><article>Teaser, short.</article>") == long.strip()
    assert tag_paths.main_text(f"<article><p>First part, of it.</p></article><article><p>{part}</p></article>") == f"First part, of it.\n{part}"
    lead = f"<div id=post><h1>Head</h1><div class=lead><p>{part}</p></div><div class=entry><p>{long}</p><p>{long}</p></div></div>"
    assert tag_paths.main_text(lead) == f"Head\n{part}\n{long.strip()}\n{long.strip()}"
    box = f"<article><p>{long}</p><figure><figcaption>A caption, of it.</figcaption></figure><fieldset>Set, in a box.</fieldset></article>"
    assert tag_paths.main_text(box) == f"{long.strip()}\nA caption, of it.\nSet, in a box."
    assert tag_paths.main_text(f"<div class=menu-open><p>{long}</p><p>{long}</p></div><div class=ad>Buy, now.</div>") == f"{long.strip()}\n{long.strip()}"
