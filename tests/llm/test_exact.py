"""Operators with exact results against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import EDGES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlake.llm import bpe, iblt, induced_sort, line_dedup, quality, queries, simhash, suffix_array, token_store, window_dedup, windows

SF = "/root/testdata/sf0.001"


def order(rows):
    return sorted(rows, key=repr)


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def got(df, *cols):
    return order(tuple(r[c] for c in cols) for r in df.collect())


# --- quality measures -------------------------------------------------------------------------------------------


def test_measures(small):
    rows, docs = small
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = quality.judge(quality.stage(quality.measure(docs).select("doc_id", "__m"), "m"))
    out = out.select("doc_id", *[f"__m.{c}" for c in names], "__failed", "__kept")
    assert order(tuple(r)[:-1] for r in out.collect()) == order((i, *brute.measures(t)) for i, t in rows)
    assert out.where("__failed and __kept").isEmpty() and out.where("__kept is null").isEmpty()
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns and kept.count() == out.where("__kept").count()


def test_posterior_finds_bad_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.judge(quality.stage(quality.measure(docs).select("doc_id", "__m"), "m")).join(labels, "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", F.col("__kept").alias("kept")).count().collect()}
    assert counts[1, True] > 0.95 * (counts[1, True] + counts.get((1, False), 0))
    assert counts[0, False] > 0.8 * (counts[0, False] + counts.get((0, True), 0))


# --- byte-level BPE ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    return ranks, own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_bpe_equals_the_library(vocabulary):
    ranks, own, library = vocabulary
    decoder, rng = bpe.Decoder(ranks), random.Random(1)
    letters = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 abé'stlve0²Ⅷ一!?<|>😀ß\x00"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(4000)] + ["a" * 30000, "ab" * 9000, " " * 3000, "x" + " " * 99 + "y"]
    for text in texts:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert decoder.decode(ids) == text.encode()


def test_bpe_frames(small, vocabulary):
    rows, docs = small
    ranks, own, library = vocabulary
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    want = order((i, len(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert got(out.withColumn("n", bpe.n_tokens()).withColumn("decoded", F.col("decoded")), "doc_id", "n", "decoded") == order((i, n, bytearray(d)) for i, n, d in want)


def test_bpe_pieces_are_merged_once(vocabulary, monkeypatch):
    ranks, _, library = vocabulary
    own, asked = bpe.Encoder(ranks, public_tokenizers.PATTERN), []
    merge_all = own.merge_all
    monkeypatch.setattr(own, "merge_all", lambda pieces: asked.extend(pieces) or merge_all(pieces))
    for text in ("x thesrent, thesrent. thesrent", "y thesrent*** (thesrent)", "x thesrent\nthesrent,"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)
    assert asked.count(" thesrent") == 1 and asked.count("thesrent") == 1


def test_bpe_memory_is_bounded(vocabulary, monkeypatch):
    ranks, _, library = vocabulary
    monkeypatch.setattr(bpe, "CACHE", 20_000)
    own, rng = bpe.Encoder(ranks, public_tokenizers.PATTERN), random.Random(5)
    for _ in range(30):
        texts = [None, "", *("  "[: rng.randint(1, 2)].join("".join(rng.choices("aeinstéß,.\n", k=rng.randint(1, 9))) for _ in range(50)) for _ in range(5))]
        ids = own.encode_all(pa.array(texts, pa.string()).slice(1))
        assert [np.frombuffer(x, "<u4").tolist() for x in ids.to_pylist()] == [library.encode_ordinary(t) for t in texts[1:]]
        assert own.pieces.strings.nbytes + own.pieces.ids.nbytes < 60_000
        assert bpe.Decoder(ranks).decode_all(ids.slice(2)).to_pylist() == [t.encode() for t in texts[3:]]
    with pytest.raises(ValueError):
        bpe.Encoder(ranks, r"[\s\S]+").encode("one two three")


# --- suffix arrays ----------------------------------------------------------------------------------------------


def test_induced_sorting(tmp_path):
    rng = random.Random(3)
    for case in range(400):
        depth, letters = rng.choice([1, 2, 3, 5, 13]), rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
        pieces = [bytes(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(rng.randint(1, 6))]
        x = [s for p in pieces + pieces[:1] for s in [*(b + 2 for b in p), 1]] + [0]
        folder = tmp_path / str(case)
        folder.mkdir()
        found = induced_sort.Sorter(np.array(x + [0, 0, 0], np.uint16), len(x), depth, str(folder)).groups()
        found = sorted(int(i) for part in found for i in part if i + depth <= len(x))
        strings = [tuple(x[i : i + depth]) for i in range(len(x) - depth + 1)]
        count = Counter(strings)
        assert found == [i for i, s in enumerate(strings) if count[s] > 1]


def test_bucket_queue_spills(tmp_path):
    queue = induced_sort.BucketQueue(str(tmp_path), "q", limit=100)
    for i in range(20):
        queue.push(i % 3, np.array([i, i + 100]), np.array([i, 1], np.int32))
    for symbol in range(3):
        pos, shared = queue.pop(symbol)
        want = [i for i in range(20) if i % 3 == symbol]
        assert pos.tolist() == [p for i in want for p in (i, i + 100)] and shared.tolist() == [p for i in want for p in (i, 1)]
    assert not list(tmp_path.iterdir()) and not len(queue.pop(0)[0])


@pytest.mark.parametrize("options", [{}, {"length": 20, "gram": 7, "hot": 2}])
def test_byte_dedup(small, options):
    rows, docs = small
    out = suffix_array.remove_repeats(docs, **options)
    want = brute.byte_dedup([t for _, t in rows], options.get("length", 200))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == order((i, n, r, s, bytearray(k)) for (i, _), (n, r, s, k) in zip(rows, want))


def test_byte_dedup_on_documents(spark):
    rows = given(spark)
    want = brute.byte_dedup([t for _, t in rows], 200)
    out = queries.op4_suffix_array_dedup(spark, SF)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == order((i, *w[:3], brute.sha(w[3])) for (i, _), w in zip(rows, want))


# --- token store ------------------------------------------------------------------------------------------------


def test_blocks():
    rng = np.random.default_rng(1)
    for n in (1, 2, 31, 1000, token_store.BLOCK):
        for ids in (rng.integers(0, 50257, n), rng.integers(0, 3, n), np.zeros(n, int), np.r_[np.zeros(n - 1, int), 2**32 - 1], rng.integers(0, 2**32, n)):
            ids = ids.astype(np.uint32)
            assert (token_store.unpack_block(token_store.pack_block(ids), n) == ids).all()
    parts = [rng.integers(0, 50257, n).astype(np.uint32) for n in (1, 5000, 3, 1024)]
    segment = token_store.Segment(token_store.write_segment(parts))
    assert all((a == b).all() for a, b in zip(segment.documents(), parts))
    assert (segment.ids(1000, 2100) == np.concatenate(parts)[1000:2100]).all()


def plain_block(ids):
    """A block as the module's text describes it, bit by bit."""
    rest = ids.astype(np.int64) - int(ids.min())
    width = int(np.sort(rest)[(len(rest) * token_store.PERCENTILE + 99) // 100 - 1]).bit_length()
    odd = [i for i, x in enumerate(rest.tolist()) if x >> width]
    packed = sum((x & (1 << width) - 1) << k * width for k, x in enumerate(rest.tolist())).to_bytes((len(rest) * width + 7) // 8, "little")
    head = int(ids.min()).to_bytes(4, "little") + bytes([width]) + len(odd).to_bytes(2, "little")
    return head + packed + np.array(odd, "<u2").tobytes() + (rest[odd] >> width).astype("<u4").tobytes()


def test_blocks_are_packed_together():
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 65, token_store.BLOCK):
        rows = np.array([rng.integers(0, 1 << w, n) + rng.integers(0, 2) * ((1 << 32) - (1 << w)) for w in (0, 1, 7, 8, 16, 17, 31, 32) for _ in range(3)], np.uint64).astype(np.uint32)
        rows[::5, 0] = 2**32 - 1
        blocks = token_store.pack_blocks(rows)
        assert blocks == [plain_block(r) for r in rows]
        assert (token_store.unpack_blocks([memoryview(b) for b in blocks], n) == rows).all()


def test_token_store_forgets(monkeypatch):
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(6)
    monkeypatch.setattr(token_store, "CACHE", 20_000)
    monkeypatch.setattr(token_store, "PART", 2_000)
    own, library = token_store.Tokens(token_store.read_model(path)), Tokenizer.from_file(path)
    for _ in range(10):
        texts = ["", None, *("  "[: rng.randint(1, 2)].join("".join(rng.choices("aeinstéß,.\n", k=rng.randint(1, 9))) for _ in range(50)) for _ in range(9))]
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]
        assert [x.tolist() for x in own.encode(pa.array(texts, pa.string()).slice(1))] == want
        assert own.held < 300_000


def test_token_store_words_are_encoded_once():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = token_store.Tokens(token_store.read_model(path)), Tokenizer.from_file(path)
    texts = ["x thesrent thesrent. thesrent,", "y thesrent*** thesrent's thesrent' 's. ß! é? a². a1. ... \U0001f600! thesrent._", "z thesrent.\nThe, \n thesrent. a\u0301."]
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert "thesrent" in own.numbers and not {"thesrent.", "thesrent,", "thesrent***"} & {*own.numbers}


def test_token_store_lines_are_parted():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = token_store.Tokens(token_store.read_model(path)), Tokenizer.from_file(path)
    texts = ["x thesrent.\nThe thesrent\nThe's end\n", "\nThe thesrent.\n\nThe  thesrent\n", "thesrent\n The \nthesrent \u3000\nx"]
    assert [x.tolist() for x in own.encode(pa.array(texts[:1]))] == [library.encode(texts[0], add_special_tokens=False).ids]
    assert not [x for x in own.numbers if "\n" in x] and "The" not in own.numbers
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_store_units_equal_the_library():
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(8)
    own, library = token_store.Tokens(token_store.read_model(path)), Tokenizer.from_file(path)
    letters = [*"  \n\n\t\r\x0b\x1c\x1f\x85\xa0\u1680\u2003\u200b\u2028\u205f\u3000 abé'stlve0²Ⅷ一あ!?.,<|>«ßàè×÷жё😀\u0301\x00", "'s", "'re", "a b", "é. ", "<|endoftext|>"]
    few = [*" \na.é'"]
    texts = ["".join(rng.choices(rng.choice([letters, few]), k=rng.randint(0, 12))) for _ in range(20_000)] + [" " * 3000, "a" * 9000, "a " * 4000, "x" + " " * 99 + "y\n"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for some in (slice(None), slice(7, None, 3)):
        assert [x.tolist() for x in own.encode(pa.array(texts, pa.string())[some])] == want[some]
    assert [x.tolist() for x in own.encode(pa.array([None, *texts[:50]], pa.large_string()).slice(9, 30))] == want[8:38]


def test_token_store_calls_are_bounded(monkeypatch):
    path, asked = public_tokenizers.path("byte_bpe_50k.json"), []
    monkeypatch.setattr(token_store, "CALL", 4_000)
    own, library = token_store.Tokens(token_store.read_model(path)), Tokenizer.from_file(path)

    class Library:
        def encode_batch_fast(self, texts, **how):
            asked.append(sum(len(t.encode()) for t in texts))
            return library.encode_batch_fast(texts, **how)

    own.tokenizer = Library()
    texts = [x * 300 + str(i) for i in range(40) for x in ("一", "a一 ", "一 b")] + [" " + "x" * i for i in range(300, 400)]
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(asked) > 8 and max(asked) <= token_store.JOINED + 4_000


def test_token_store_tasks_share_a_memory(spark):
    def held(batches):
        from marketlake.llm import token_store as own

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(t.held for t in own._TOKENS.values())], pa.int64())], names=["held"])

    queries.op5_token_store(spark, SF).count()
    assert max(r[0] for r in spark.range(0, 16, 1, 16).mapInArrow(held, "held long").collect()) > 1000


def stored(rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return order(out)


def test_token_store(small):
    rows, docs = small
    rows = rows + [(99, "a <|endoftext|> b")] if rows else rows
    model = token_store.read_model(public_tokenizers.path("byte_bpe_50k.json"))
    if rows:
        docs = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame([(99, "a <|endoftext|> b")], "doc_id long, text string"))
    assert got(token_store.write_and_read(docs, model), "doc_id", "start", "n_tokens", "ids_crc32") == stored(rows)


def test_token_store_on_documents(spark):
    assert got(queries.op5_token_store(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == stored(given(spark))


# --- fingerprints -----------------------------------------------------------------------------------------------


def paragraphs(text):
    return {p for p in re.split(r"\n+|(?<=[.!?]) +", text) if brute.WORD.search(p)}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return round(len(a & b) / len(a | b), 9) if a | b else 1.0


def versions(rows):
    ranked = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for k, (i, t) in enumerate(ranked):
        t, after = t or "", ranked[(k + 1) % len(ranked)][1] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        out.append((i, len(t), brute.sha(edited), likeness(t, edited), likeness(t, after)))
    return order(out)


def test_fingerprints(small):
    rows, docs = small
    rows = [(i, (t or "").replace("\U0001f600", "*")) for i, t in rows]  # one order of texts in both
    docs = docs.select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), "\U0001f600", "*").alias("text"))
    out = iblt.fingerprints(docs).withColumn("near_edited", F.round("near_edited", 9)).withColumn("near_next", F.round("near_next", 9))
    assert got(out, "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next") == versions(rows)


def test_fingerprints_on_documents(spark):
    out = queries.op6_fingerprints(spark, SF).withColumn("near_edited", F.round("near_edited", 9)).withColumn("near_next", F.round("near_next", 9)).cache()
    rows = given(spark)
    assert got(out, "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next") == versions(rows)
    prints = {r.doc_id: r.fingerprint for r in out.collect()}
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, set()).add(prints[i])
    assert all(len(p) == 1 for p in by_text.values()) and len({*prints.values()}) > 0.9 * len(by_text)


def test_sketch_peels_or_retries(spark):
    sets = [(list(range(n)), list(range(k, n + k))) for n, k in ((0, 0), (5, 1), (40, 40), (3, 0), (200, 150))]
    df = spark.createDataFrame(sets, "a array<long>, b array<long>")
    near = [r.near for r in iblt.with_likeness(df, "a", "b", "near").collect()]
    assert near == [1.0 if not a else len({*a} & {*b}) / len({*a} | {*b}) for a, b in sets]


# --- words ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("length", [50, 4])
def test_word_dedup(small, length):
    rows, docs = small
    out = window_dedup.remove_repeats(docs, length=length)
    assert got(out, "doc_id", "n_words", "n_removed", "kept") == order(brute.word_dedup(rows, length))


def test_word_dedup_on_documents(spark):
    want = order((i, n, r, brute.sha(k)) for i, n, r, k in brute.word_dedup(given(spark), 50))
    assert got(queries.op8_substring_dedup(spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_sliding_minimum():
    x = np.random.default_rng(2).integers(0, 9, 500).astype(np.uint64)
    for width in (1, 3, 7, 500):
        assert windows.sliding_min(x, width).tolist() == [min(x[i : i + width]) for i in range(501 - width)]


# --- SimHash ----------------------------------------------------------------------------------------------------


def test_triples_cover_all_fours():
    assert all(any({*t} <= {*four} for t in simhash.TRIPLES) for four in combinations(range(8), 4))


def test_near_duplicates(small):
    rows, docs = small
    assert got(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == order(brute.near_duplicates(rows))
    kept = simhash.drop_near_duplicates(docs)
    groups = {c for _, _, c in brute.near_duplicates(rows, width=5)}
    assert kept.columns == docs.columns and kept.count() == len(groups)


@pytest.mark.parametrize("longest", [4096, 30, 3])
def test_links_of_dense_fingerprints(spark, longest):
    rng = random.Random(4)
    fps = {0}
    for _ in range(4):
        x = rng.getrandbits(64)
        for _ in range(150):
            x ^= 1 << rng.randrange(64) if rng.random() < 0.7 else (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            if rng.random() < 0.2:
                x ^= rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)
            fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    near = {int(f): [int(y) for y in fps[np.bitwise_count(fps ^ f) <= 4]] for f in fps}
    want = {}
    for f, root in brute.components(near).items():
        want.setdefault(root, set()).add(f)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    found = {}
    for r in simhash.link(df, longest).collect():
        found.setdefault(r.root, {r.root % 2**64}).add(r.fp % 2**64)
    assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_similar(small):
    rows, docs = small
    kept = simhash.drop_similar(docs)
    want = brute.similar_groups(rows)
    assert kept.columns == docs.columns and order(r.doc_id for r in kept.collect()) == order(want)


@pytest.mark.parametrize("longest", [4096, 20, 3])
def test_similar_cuts_long_postings(spark, monkeypatch, longest):
    monkeypatch.setattr(simhash.link_entries, "__defaults__", (longest,))
    rng = random.Random(6)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    texts = [" ".join(base)]
    for k in range(60):  # a hot group: each differs from the base in one word
        texts.append(" ".join([*base[: 4 * k], f"new{k}", *base[4 * k + 1 :]]))
    texts += [" ".join(rng.sample(base, len(base))) for _ in range(20)]  # the same words in another order stay
    rows = list(enumerate(texts))
    kept = simhash.drop_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(61, 81)]


def test_similar_finds_what_shares_its_shingles(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r.doc_id: brute.shingle_set(r.text) for r in docs.collect()}
    kept = {r.doc_id for r in simhash.drop_similar(docs).collect()}
    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    near = Counter()
    for ids in by_shingle.values():
        near.update(p for p in combinations(sorted(ids), 2))
    near = {(a, b): n / (len(sets[a]) + len(sets[b]) - n) for (a, b), n in near.items()}
    copies = {(a, b) for (a, b), j in near.items() if j >= 0.85}
    assert sum(not (a in kept and b in kept) for a, b in copies) >= 0.95 * len(copies) > 0
    close = {i for p, j in near.items() if j >= 0.7 for i in p}
    assert {i for i in sets if sets[i] and i not in kept} <= close


# --- lines ------------------------------------------------------------------------------------------------------


def test_lines(docs_of):
    rows = [(i, f"menu\nown {i}\n\nmenu", "en", "a") for i in range(10)] + [(20, "menu\nrare", "en", "b"), (21, None, "en", "a"), (22, "", "en", None)]
    rows += [(30 + i, f"menu\n{i}", "en", None) for i in range(4)]
    out = {r.doc_id: (r.text, r["__n_lines"], r["__n_dropped"]) for r in line_dedup.drop_boilerplate(docs_of(rows), percent=50).collect()}
    assert out[0] == ("own 0\n", 4, 2) and out[20] == ("menu\nrare", 2, 0) and out[21] == (None, 0, 0) and out[22] == ("", 1, 0) and out[31] == ("1", 2, 1)


def test_lines_keep_rows(small):
    rows, docs = small
    out = line_dedup.drop_boilerplate(docs)
    assert out.count() == len(rows) and out.columns[: len(docs.columns)] == docs.columns


def test_edges_hold_repeats():
    assert len(EDGES) > len({*EDGES})
