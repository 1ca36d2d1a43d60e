"""The text operators against brute force, libraries, round trips and held-out labels."""

from __future__ import annotations

import base64
import math
import random
import zlib
from collections import Counter
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from claimwright.llm import bpe, bpe_digests, fuzzy_lines, id_files, labelled, mixing, pitman_yor, pu, quality, queries
from claimwright.llm import rules, token_groups, topk, toxicity
from claimwright.llm.components import connected_components
from claimwright.llm.perfect_hash import PerfectHash
from claimwright.llm.shingles import Blocks, grown_sketch, near_sketches, odd_sketch, overlaps
from claimwright.llm.storage import _written_paths, discard, give_back_memory, prepare, remove_written, shared_folder, written
from claimwright.llm.token_groups import similar_components
from claimwright.llm.topk import top_k
from tests.compare import differences, oracle_connection

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    return prepare(spark)


def documents(spark, texts):
    """Texts under ids 0, 1, ..., or pairs of id and text, with a column of a clashing name."""
    rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)
    return df.withColumn("score", F.lit("x")).withColumn("component", F.lit(1))


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


ODD = [None, "", " \n\t ", "one", "one", (None, "one two"), (0, "again"), "word " * 30_000]


# SQL and registered queries


@pytest.mark.parametrize("key", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, key):
    rows, difference = differences(
        queries.QUERIES[key](spark, SF), oracle_connection(SF), queries.ORACLE_SQL[key]
    )
    assert rows and not difference


# positive-unlabelled learning


def test_corrected_risk_finds_the_hidden_negatives():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, (500, 2))
    unlabelled = np.vstack([rng.normal(2, 1, (300, 2)), rng.normal(-2, 1, (700, 2))])
    scores = pu.fit(positive, unlabelled, 0.3, rate=0.05).scores(unlabelled.astype(np.float32))
    assert ((scores >= 0.5) == (np.arange(1000) < 300)).mean() > 0.95


@pytest.mark.parametrize(
    "score, column", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")]
)
def test_classifier_on_held_out_labels(spark, score, column):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r[column] for r in rows) / len(rows)
    wrongly = [r for r in rows if r.predicted == 1 and r[column] == 0]
    assert right > 0.9 and len(wrongly) <= 0.02 * len(rows)


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_on_odd_rows(spark, score):
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = score(documents(spark, ODD), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert score(documents(spark, []), labels.limit(0)).count() == 0


# rule ledger


def test_a_sampled_id_of_many_rows_is_one_text(spark):
    docs = documents(spark, [(1, f"text {k}") for k in range(500)] + [(2, "b"), (3, None), (4, "no")])
    sample = spark.createDataFrame([(1, True), (1, False), (2, False), (3, False)], "doc_id long, positive boolean")
    rows = sorted((r.doc_id, r.positive, r.text) for r in labelled.sampled_texts(docs, sample).collect())
    assert rows == [(1, False, "text 0"), (1, True, "text 0"), (2, False, "b"), (3, False, None)]


def test_ledger_counts_and_ablations(spark):
    eight = "a b c d e f g h"
    texts = [*ODD, f"{eight} x {eight}", "same line\nsame line\nother", "A" * 40 + " B" * 30]
    rows = rules.rule_ledger(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    assert [r.n_words for r in rows if r.doc_id == 8] == [17]
    assert [r.n_repeat_words for r in rows if r.doc_id == 8] == [16]
    assert [r.n_dup_lines for r in rows if r.doc_id == 9] == [1]
    ledger = rules.ledger(documents(spark, texts), ["doc_id"])
    policies = list(rules.POLICIES.values())
    for row in rules.ablations(ledger, policies).collect():
        policy = rules.POLICIES[row.version]
        bits = policy.rules & ~rules.BIT.get(row.rule, 0)
        assert row.kept_docs == sum(r.fail_bits & bits == 0 for r in rows)


# similarity join


def brute_components(texts, size, percent):
    sets, above = {}, {}
    for k, text in texts.items():
        words = (text or "").encode().lower().split()
        grams = zip(*(words[i:] for i in range(size)))
        sets[k] = {tuple(words)} if 0 < len(words) < size else set(grams)
        above[k] = k

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * (len(sets[a] | sets[b])):
                x, y = root(a), root(b)
                above[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    texts = [prose(rng, words, rng.randint(1, 80)) for _ in range(30)]
    for _ in range(90):
        copy = rng.choice(texts).split()
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += ["", None, "a b", "A  b", "a"]
    found = similar_components(documents(spark, texts), size, percent).collect()
    expected = brute_components(dict(enumerate(texts)), size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_components_of_odd_rows(spark):
    rows = similar_components(documents(spark, ODD), 3, 90).collect()
    assert len(rows) == len(ODD)
    assert sorted(r.component_id for r in rows if r.n_shingles == 1 and r.doc_id in (3, 4)) == [3, 3]
    assert similar_components(documents(spark, []), 3, 90).count() == 0


def test_similar_sets_share_a_block_and_sketches_bound_differences():
    rng = np.random.default_rng(1)
    blocks = Blocks(80)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        dropped = one[rng.random(len(one)) > 0.08]
        other = np.unique(np.r_[dropped, rng.integers(0, 2**63, n // 12).astype(np.uint64)])
        if not len(other):
            continue
        shared = overlaps([one], [other])[0, 0]
        assert shared == len(np.intersect1d(one, other))
        apart = len(one) + len(other) - 2 * shared
        xor = odd_sketch(one) ^ odd_sketch(other)
        assert np.bitwise_count(xor.view(np.uint64)).sum() <= apart
        if 100 * shared >= 80 * (len(one) + len(other) - shared):
            assert np.intersect1d(blocks.keys(one), blocks.keys(other)).size


def test_grown_sketches_bound_differences_and_tell_sets_apart():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for n in (3, 60, 700, 9_000):
            base = rng.integers(0, 1 << 62, n).astype(np.uint64)
            sets = [base]
            for kept in (0.98, 0.93, 0.88, 0.7, 0.4, 0.1):
                fresh = rng.integers(0, 1 << 62, n - int(kept * n)).astype(np.uint64)
                sets.append(np.unique(np.r_[base[: int(kept * n)], fresh]))
            sides = [(np.array([len(s)]), [grown_sketch(s)]) for s in sets]
            for s, side in zip(sets, sides):
                shared = len(np.intersect1d(s, base))
                near = bool(near_sketches(side, sides[0], percent)[0])
                assert near or 100 * shared < percent * (len(s) + n - shared)
                # Large sets that share a passage are not taken for similar.
                assert not (near and n >= 700 and shared <= n // 2)
        together = np.concatenate([size for size, _ in sides]), [b for _, (b,) in sides]
        alone = [bool(near_sketches(side, sides[0], percent)[0]) for side in sides]
        assert near_sketches(together, sides[0], percent).tolist() == alone


def test_no_tokens_travel_between_groups_that_share_a_passage(spark, monkeypatch):
    """Texts of their own words around one common passage: no group asks another for its sets."""
    tables = {}

    def kept(df, name, *replaced):
        tables.setdefault(name, []).append(written(df, name))
        return tables[name][-1]

    monkeypatch.setattr(token_groups, "written", kept)
    passage = " ".join(f"common{k}" for k in range(900))
    texts = [" ".join(f"own{i}x{k}" for k in range(3_000)) + " " + passage for i in range(24)]
    texts.append(texts[7] + " more")
    rows = similar_components(documents(spark, texts), 5, 80).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [*((k, k) for k in range(24)), (24, 7)]
    asked = [table.count() for table in tables["near-groups"]]
    assert sum(asked) <= 2, asked


def test_connected_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}
    assert {r.node: r.component for r in rows} == expected and len(rows) == len(expected)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# fuzzy lines


def test_repeated_and_similar_lines_go_once(spark):
    rng = random.Random(3)
    words = [prose(rng, "abcdefghij", 6).replace(" ", "") for _ in range(500)]
    long = prose(rng, words, 60)
    near = " ".join([*long.split()[:-1], "changed"])
    texts = [f"first\n{long}", f"{near}\nfresh words here", f"-- {long.upper()}!\nFIRST.", None, ""]
    rows = {r.doc_id: r for r in fuzzy_lines.line_dedup(documents(spark, texts)).collect()}
    assert rows[0].text == texts[0] and rows[0].removed == []
    assert rows[1].text == "fresh words here"
    assert rows[2].removed == [0, 1] and rows[2].text == ""
    assert rows[3].text is None and rows[4].text == ""


def test_simhash_equals_its_definition():
    rng = random.Random(10)
    words = [bytes(rng.choices(b"abcdefgh", k=rng.randint(1, 9))) for _ in range(3_000)]
    lengths = [1, 5, 63, 64, 200, 700, 20_000, 2, *(rng.randint(1, 90) for _ in range(50))]
    lines = [rng.choices(words, k=n) for n in lengths]
    for line, found in zip(lines, fuzzy_lines.SimHasher().hashes(lines)):
        signs = fuzzy_lines.word_bits(line).astype(int) * 2 - 1
        weights = np.array([1 if len(w) <= 3 else 4 for w in line])
        assert np.array_equal(np.packbits(weights @ signs > 0).view(np.int64), found)
    hasher = fuzzy_lines.SimHasher()
    one, other = hasher.hashes([[b"x" * 10**6, b"word"], [b"x" * 10**6 + b"y", b"word"]])
    assert max(map(len, hasher.rows)) <= 64 and not np.array_equal(one, other)
    assert fuzzy_lines.SimHasher().hashes([]).shape == (0, fuzzy_lines.NUMBERS)


def test_line_dedup_of_odd_rows(spark):
    rows = fuzzy_lines.line_dedup(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    # The row without an id comes first; of the equal texts the smaller id keeps its line.
    assert [r.text for r in rows if r.doc_id in (3, 4)] in (["one", ""], ["", "one"])
    assert fuzzy_lines.line_dedup(documents(spark, [])).count() == 0


# top-k


def test_top_k_equals_brute_force_over_several_cells(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, 5) / 64]) for k in range(120)]
    rows += [(200, None), (250, [1.0, None, 0.0]), (300, [float("nan")] * 5), (350, [0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = top_k(df, F.col("vec_id") % 10 == 0, 5, chunk_rows=30, block_rows=4).collect()
    whole = {k: np.floor(256 * np.array(v)) for k, v in rows if k < 120}
    whole[350] = np.array([128.0, 0, 0, 0, 0])
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found}
    for q in (k for k in whole if k % 10 == 0):
        best = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q)[:5]
        assert [got[q, n + 1] for n in range(5)] == [(k, -s) for s, k in best]
    assert top_k(df.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_top_k_of_wide_components_and_of_one_hot_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [100_000.0, 0.0]), (2, [200_000.0, 0.0]), (3, [-300_000.0, 2.0**30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(df, F.col("vec_id") == 0, 2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(2, 65_536 * 200_000), (1, 65_536 * 100_000)]
    # The terms go beyond 64 bits, the sums do not.
    rows = [(0, [2.0**30, 2.0**30]), (1, [2.0**30, -(2.0**30)]), (2, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(df, F.col("vec_id") == 0, 1).collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 0)]
    beyond = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        top_k(beyond, F.col("vec_id") == 0, 1).collect()
    hot = spark.range(4_000).select(F.lit(7).cast("long").alias("vec_id"))
    sizes = [r["count"] for r in topk.dealt_rows(hot, 8).groupBy("chunk").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 700


# byte-level BPE


@pytest.fixture(scope="module")
def codec():
    vocabulary = bpe.Vocabulary.read(RANKS, public_tokenizers.PATTERN)
    ranks = {
        base64.b64decode(a): int(b)
        for a, b in map(bytes.split, open(RANKS, "rb"))
    }
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return *bpe.codec(vocabulary), library


PARTS = [
    "a", "the", "THE", " ", "  ", "\n", "\r\n", "\t", "é", "é", "中", "😀", "́", "12", "²", "'s", "'",
    "!!", "---", "\xa0", "　", "\x1c", "​", "aaaa", " " * 9, "0" * 7, "<|endoftext|>", "ҷ", "࢏",
]


def test_transducer_equals_the_library(codec, monkeypatch):
    encoder, decoder, library = codec
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += ["x" * 5_000, "ab" * 2_000, " \n" * 500]
    for text in texts:
        ids = encoder.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert decoder.decode(ids) == text == "".join(decoder.stream(ids))
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    small = bpe.Encoder(bpe.Vocabulary.read(RANKS, public_tokenizers.PATTERN))
    assert all(small.encode(t).tolist() == library.encode_ordinary(t) for t in texts)


def test_decoder_of_broken_sequences(codec):
    _, decoder, _ = codec
    rng = random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(256) for _ in range(rng.randint(0, 8))]
        data = b"".join(decoder.tokens[k] for k in ids)
        assert decoder.decode(ids) == data.decode("utf-8", "replace")


def test_round_trip_query(spark, codec):
    _, _, library = codec
    rows = queries.op6_byte_bpe(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(texts[row.doc_id].encode()).hexdigest()


# language model


def test_language_model_counts_and_beats_its_base(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = pitman_yor.language_scores(docs.withColumn("chunk", F.lit(0))).collect()
    tokens = {
        r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in docs.collect()
    }
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in tokens}
    counts = Counter(w for k, t in tokens.items() if not held[k] for w in t)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(tokens)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert r.base_score == pytest.approx(base)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > 0.9 * sum(r.base_score for r in unseen)


def following(model):
    """Probabilities of all words, and last of one never seen, in all contexts."""
    words, contexts = model.words.orderBy("word").collect(), model.contexts.orderBy("context").collect()
    chances = np.array([*(r.kept for r in words), model.unseen])
    of_word = {r.word: k for k, r in enumerate(words)}
    pairs = {(r.context, of_word[r.word]): (r.seen, r.tables) for r in model.pairs.collect()}
    found = []
    for r in contexts:
        own = np.array([pairs.get((r.context, k), (0, 0)) for k in range(len(chances))])
        guests, kept = np.full(len(chances), r.guests), np.tile(r.kept, (len(chances), 1))
        found.append(pitman_yor.predictive(own[:, 0], own[:, 1], guests, kept, chances, model.discount))
    return np.array(found)


def test_predictive_probabilities_sum_to_one(spark):
    texts = ["a b a b a c", "b a b a", "c c a", "d e f g h", None, "a " * 50]
    chunks = pitman_yor._chunked(documents(spark, texts), F.lit(True)).persist()
    listed = chunks.select(F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    counts = listed.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("seen"))
    model = pitman_yor.train(chunks, counts)
    assert np.allclose(following(model).sum(axis=1), 1, atol=1e-5)
    assert (following(model) > 0).all()
    rows = pitman_yor.language_scores(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD) and all(r.score <= 0 for r in rows)
    assert pitman_yor.language_scores(documents(spark, [])).count() == 0


def test_language_model_tells_chunks_little_at_once(spark, monkeypatch):
    """The same scores however texts fall into chunks; pair counts go before any scoring."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    rows = spark.createDataFrame(
        [(k, prose(rng, words, rng.randrange(60))) for k in range(120)], "doc_id long, text string"
    )
    found, names = [], []

    def kept(df, name, *replaced):
        if name == "language-scores":
            names.append([path for path in _written_paths(spark) if "pair-counts" in path])
        return written(df, name, *replaced)

    monkeypatch.setattr(pitman_yor, "written", kept)
    for docs in (rows.coalesce(1), rows.repartition(6)):
        remove_written(spark)
        scores = pitman_yor.language_scores(docs).collect()
        found.append(sorted((r.doc_id, r.held_out, r.n_known, round(r.score, 9)) for r in scores))
    assert found[0] == found[1] and len(found[0]) == 120
    assert names == [[]] * 2 * pitman_yor.SCORED_PARTS


def test_pairs_of_a_chunk_are_listed_in_bounded_batches(spark):
    rng = random.Random(21)
    texts = [(k, " ".join(f"w{rng.randrange(2_000)}" for _ in range(300))) for k in range(700)]
    docs = documents(spark, texts).coalesce(1)
    chunks = pitman_yor._chunked(docs, F.expr("doc_id % 2 = 0")).toArrow().combine_chunks().to_batches()[0]
    assert chunks.num_rows == 1
    batches = list(pitman_yor._pair_batches(chunks, 0))
    assert len(batches) > 1 and max(b.num_rows for b in batches) <= pitman_yor.LISTED_PAIRS
    number = {xxhash.xxh3_64_intdigest(f"w{k}".encode()): k for k in range(2_000)}
    number |= {pitman_yor.END: -1, int(pitman_yor.BEGINNING) % 2**64: -2}
    found = {}
    for batch in batches:
        for r in batch.to_pylist():
            assert (r["chunk"], r["at"]) == (0, len(found))
            found[number[r["context"] % 2**64], number[r["word"] % 2**64]] = r["seen"]
    seen, learned = set(), Counter()
    for k, text in texts:
        words = [-2, *(int(w[1:]) for w in text.split()), -1]
        seen.update(zip(words, words[1:]))
        if k % 2 == 0:
            learned.update(zip(words, words[1:]))
    assert found == {pair: learned[pair] for pair in seen}


def test_rare_words_are_contexts(spark):
    rng = random.Random(13)
    # Each of 3,000 words is rare, and always before the same other one.
    pairs = [f"x{k} y{k}" for k in range(3_000)]
    rows = spark.createDataFrame(
        [(k, prose(rng, pairs, 300)) for k in range(100)], "doc_id long, text string"
    )
    found = [r for r in pitman_yor.language_scores(rows).collect() if r.held_out]
    # Half of the words follow surely from the one before.
    assert found and sum(r.score for r in found) > 0.7 * sum(r.base_score for r in found)


# fuzzy lines, candidates


def test_one_changed_letter_is_found_at_any_length(spark):
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(900)]
    lines = [prose(rng, vocabulary, n) for n in range(6, 70) for _ in range(3)]
    docs, twins = [], {}
    for k, line in enumerate(lines):
        letters = list(line)
        place = rng.choice([i for i, c in enumerate(line) if c != " "])
        letters[place] = "z"
        docs += [(2 * k, line), (2 * k + 1, "".join(letters))]
        twins[2 * k + 1] = line
    found = {r.doc_id: list(r.removed) for r in fuzzy_lines.line_dedup(documents(spark, docs)).collect()}
    assert [k for k in twins if found[k] != [0]] == []
    assert all(found[k] == [] for k in found if k not in twins)


def test_word_blocks_cut_whole_lines():
    words = [b"w%d" % k for k in range(100)]
    for n in (4, 6, 20, 63, 64, 100):
        keys = fuzzy_lines.word_blocks(words[:n])
        other = fuzzy_lines.word_blocks([*words[: n - 1], b"x"])
        assert len(set(keys)) == len(keys) <= fuzzy_lines.MAX_PARTS and all(k < 0 for k in keys)
        assert keys[:-1] == other[:-1] and keys[-1] != other[-1]
    assert fuzzy_lines.word_blocks([]) == fuzzy_lines.word_blocks(words[:3]) == []


def plain_distance(one, other):
    row = list(range(len(other) + 1))
    for i, x in enumerate(one, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(other, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edits_within_a_limit_are_exact():
    rng = random.Random(17)
    met = Counter()
    for _ in range(3_000):
        one = rng.choices("abé", k=rng.randrange(90 if rng.random() < 0.1 else 14))
        other = list(one)
        for _ in range(rng.randrange(7)):
            if other and rng.random() < 0.5:
                other.pop(rng.randrange(len(other)))
            else:
                other.insert(rng.randrange(len(other) + 1), rng.choice("abc😀"))
        one, other, allowed = "".join(one), "".join(other), rng.randrange(6)
        within = plain_distance(one, other) <= allowed
        assert fuzzy_lines.within_edits(one, other, allowed) == within
        met[within] += 1
    assert min(met.values()) > 500


def test_edits_of_many_pairs_equal_those_of_each(monkeypatch):
    rng = random.Random(19)
    ones, others, allowed = [], [], []
    for _ in range(1_500):
        one = rng.choices("abcdé 😀", k=rng.choice([0, 1, 20, 63, 64, 65, 128, 129, 200]))
        other = list(one)
        for _ in range(rng.randrange(25)):
            if other and rng.random() < 0.5:
                other.pop(rng.randrange(len(other)))
            else:
                other.insert(rng.randrange(len(other) + 1), rng.choice("abq😀"))
        ones.append("".join(one))
        others.append("".join(other))
        allowed.append(rng.randrange(25))
    want = [fuzzy_lines.within_edits(*pair) for pair in zip(ones, others, allowed)]
    assert 300 < sum(want) < 1_400
    for most in (fuzzy_lines._TABLE, 20_000):
        monkeypatch.setattr(fuzzy_lines, "_TABLE", most)
        assert fuzzy_lines.all_within_edits(ones, others, np.array(allowed)).tolist() == want
    for one, other, most, within in zip(ones, others, allowed, want):
        assert within or not fuzzy_lines._few_words_differ(one, other, most)
    counts = fuzzy_lines._letter_counts(pa.array(["q", "abca 9é", "zz", ""]).slice(1))
    assert counts.sum(axis=1).tolist() == [5, 2, 0] and counts[0, [0, 1, 2, 35]].tolist() == [2, 1, 1, 1]


def test_lines_read_at_once_equal_each_alone():
    texts = [None, "", " \n\t", "One, two\n\nthree-é 4 5 6 7", "a\x0bb\x1cc\rd", "x" * 99 + "\n", "ÀB c " * 70]
    lines = fuzzy_lines.Lines.read(texts)
    want = [(k, n, w) for k, t in enumerate(texts) for n, w in enumerate(fuzzy_lines.normal_lines(t or "")) if w]
    assert [tuple(x) for x in lines.places.tolist()] == [(k, n) for k, n, _ in want]
    assert lines.words().to_pylist() == [x for _, _, w in want for x in w]
    assert lines.normals().tolist() == [fuzzy_lines.normal_id(w) for _, _, w in want]
    assert lines.characters().tolist() == [len(b" ".join(w).decode()) for _, _, w in want]
    keys, counts = lines.word_blocks()
    assert np.split(keys, np.cumsum(counts)[:-1])[1].tolist() == fuzzy_lines.word_blocks(want[1][2])
    assert len(fuzzy_lines.Lines.read([None]).lengths) == 0


def test_a_task_holds_the_bits_of_the_lines_at_hand_only():
    hasher = fuzzy_lines.SimHasher()
    hasher.hashes([[b"one", b"two"], [b"two"]])
    assert sum(x.nbytes for x in vars(hasher).values() if isinstance(x, np.ndarray)) < 10_000


def test_buckets_list_pairs_of_small_ones_and_few_of_large_ones():
    rng = np.random.default_rng(2)
    normals = rng.permutation(2_000)
    keys = np.where(normals < 400, -5, np.where(normals < 405, 7, 1_000 + normals))
    lengths = np.where(normals == 402, 300, 100)
    again = rng.integers(0, 2_000, 500)
    rows = fuzzy_lines._met(*(np.append(x, x[again]) for x in (keys, normals, lengths)))
    key, one, other, _ = rows
    small = {(int(a), int(b)) for a, b in zip(one[key == 7], other[key == 7])}
    assert small == {(a, b) for a in range(400, 405) for b in range(a + 1, 405) if 402 not in (a, b)}
    large = Counter((int(a), int(b)) for a, b in zip(one[key == -5], other[key == -5]))
    assert all((a, a) in large and (0, a) in large and (a, min(a + 8, 399)) in large for a in range(400))
    assert len(large) < 400 * (fuzzy_lines.FOLLOWING + 2) and set(key.tolist()) == {-5, 7}
    assert all(len(x) == 0 for x in fuzzy_lines._met(keys[:0], normals[:0], lengths[:0]))


def test_lines_of_large_buckets_are_compared_with_all(spark):
    """Lines that share a beginning only are apart, those linked through any other are not."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(3_000)]
    start = "one common beginning of"
    unlike = [f"{start} {prose(rng, words, 20)}" for _ in range(60)]
    chains = []
    for _ in range(8):
        tail = rng.choices(words, k=20)
        for k in range(6):
            tail[3 * k] = rng.choice(words)
            chains.append(f"{start} {' '.join(tail)}")
    texts = [*unlike, *chains]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    found = {r.doc_id: r.n_removed for r in fuzzy_lines.line_dedup(documents(spark, docs)).collect()}
    leader = list(range(len(texts)))

    def top(k):
        return k if leader[k] == k else top(leader[k])

    for a, one in docs:
        for b, other in docs[a + 1 :]:
            if fuzzy_lines.within_edits(one, other, max(len(one), len(other)) // 10):
                leader[max(top(a), top(b))] = min(top(a), top(b))
    assert found == {k: int(top(k) != k) for k in leader and range(len(texts))}
    assert 20 < sum(found.values()) < 50


def test_words_of_few_texts_are_held_at_once(monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "_CHARS_AT_ONCE", 10)
    texts = ["abc", None, "", "x" * 30, "abc", "abcdefg", "y"]
    runs = list(fuzzy_lines._runs(pa.array(texts)))
    assert runs == [(0, texts[:4]), (4, texts[4:6]), (6, ["y"])]
    assert list(fuzzy_lines._runs(pa.array([], pa.string()))) == []


def test_buckets_of_lines_are_made_in_parts(spark, monkeypatch):
    """Each part holds its own keys, all parts together every shared one."""
    stored = []

    def kept(df, name, *replaced):
        table = written(df, name, *replaced)
        if name == "line-buckets":
            stored.append([(r.key, r.normal) for r in table.collect()])
        return table

    monkeypatch.setattr(fuzzy_lines, "written", kept)
    rng = random.Random(4)
    lines = [prose(rng, [f"word{k}" for k in range(4_000)], 12) for _ in range(40)]
    texts = [*lines, *(line.replace("word1", "wordy1", 1) for line in lines)]
    rows = fuzzy_lines.line_dedup(documents(spark, texts)).collect()
    assert sum(r.n_removed for r in rows) >= 30
    assert len(stored) == fuzzy_lines.KEY_PARTS and all(stored)
    keys = [{key for key, _ in part} for part in stored]
    assert len(set().union(*keys)) == sum(map(len, keys))
    normals = {fuzzy_lines.normal_id(t.encode().split()): t.encode().split() for t in texts}
    of_words = Counter(k for words in normals.values() for k in fuzzy_lines.word_blocks(words))
    assert {k for k, n in of_words.items() if n > 1} == {k for k in set().union(*keys) if k < 0}


def test_no_task_of_the_last_stage_holds_two_codecs(spark):
    docs = documents(spark, ["one two", None, "three"])
    out = corpus_pipeline.byte_bpe(spark, docs, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert sorted(r.text or "" for r in out.collect()) == ["", "one two", "three"]
    give_back_memory()


def test_superseded_tables_are_deleted(spark):
    one = written(spark.range(3), "one")
    two = written(one.select((F.col("id") + 1).alias("id")), "two", one)
    assert sorted(r.id for r in two.collect()) == [1, 2, 3]
    assert not any(Path(p.removeprefix("file:")).exists() for p in one.inputFiles())
    discard(two, two)


# mixing


def test_rates_meet_the_targets(spark):
    rng = random.Random(8)
    own = {d: [f"{d}{k}" for k in range(40)] for d in ("en", "fr")}
    rows = [(k, prose(rng, own["en" if k % 4 else "fr"], 30), "en" if k % 4 else "fr") for k in range(200)]
    docs = spark.createDataFrame([*rows, (None, None, "en"), (1, "", "xx")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k,) for k in range(100)], "doc_id long")
    found = mixing.mixture(docs, labels, {"en": 0.5, "fr": 0.5}).collect()
    assert len(found) == 202 and all(r.rate >= 0 for r in found)
    tokens = sum(r.n_tokens for r in found)
    for k in range(2):
        assert sum(r.n_tokens * r.shares[k] * r.rate for r in found) == pytest.approx(tokens / 2, rel=1e-3)
    assert mixing.mixture(docs.limit(0), labels, {"en": 0.5, "fr": 0.5}).count() == 0


def test_rates_of_rare_domains_and_of_targets_out_of_reach(spark):
    rng = random.Random(12)
    own = {d: [f"{d}{k}" for k in range(40)] for d in ("en", "fr", "de")}
    lang = ["fr" if k % 100 == 0 else "de" if k % 50 == 1 else "en" for k in range(600)]
    rows = [(k, prose(rng, own[d], rng.randint(5, 60)), d) for k, d in enumerate(lang)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k,) for k in range(300)], "doc_id long")
    targets = {"en": 0.3, "fr": 0.5, "de": 0.2}
    found = mixing.mixture(docs, labels, targets).collect()
    tokens = sum(r.n_tokens for r in found)
    for k, share in enumerate(targets.values()):
        reached = sum(r.n_tokens * r.shares[k] * r.rate for r in found) / tokens
        assert reached == pytest.approx(share, abs=2e-4)
    assert all(r.rate >= 0 and max(map(abs, r.residuals)) < 2e-4 for r in found)
    assert max(r.rate for r in found) > 10
    # Texts of one language cannot come to half of another.
    with pytest.warns(UserWarning, match="miss the target shares"):
        alone = mixing.mixture(docs.where("lang = 'en'"), labels, {"en": 0.5, "fr": 0.5}).collect()
    reached = sum(r.n_tokens * r.shares[1] * r.rate for r in alone) / sum(r.n_tokens for r in alone)
    assert alone[0].residuals[1] == pytest.approx(reached - 0.5, abs=1e-6) and reached < 0.4
    rates = spark.createDataFrame([(1, 25_000.0)], "doc_id long, rate double")
    rates = docs.join(rates, "doc_id").select("doc_id", F.xxhash64("text").alias("text_id"), "rate")
    assert mixing.resampled(docs, rates).count() == 25_000


# id files


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(-(2**62), 2**62, 20_000))
    hashed = PerfectHash.build(keys)
    assert np.array_equal(np.sort(hashed.slots(keys)), np.arange(len(keys)))
    assert len(PerfectHash.build(keys[:0]).slots(keys)) == len(keys)


def test_word_encoder_equals_the_library():
    definition = open(WORDS, "rb").read()
    encoder, library = id_files.WordEncoder(definition), Tokenizer.from_buffer(definition)
    rng = random.Random(9)
    parts = [*PARTS, "S", "'S", "ß", "İ", "ΑΣ", "ς", "ﬁ", "\x85", "<|startoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    for text, packed in zip(texts, encoder.encode_all(texts)):
        ids = np.frombuffer(packed, encoder.dtype).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_word_encoder_holds_the_words_of_few_texts():
    definition = open(WORDS, "rb").read()
    encoder, library = id_files.WordEncoder(definition), Tokenizer.from_buffer(definition)
    split, held = encoder._split, []
    encoder._split = lambda text: held.append(text) or split(text)
    texts = [f"word{k % 7} of {k}, text" for k in range(1_200)]
    rows = encoder.encode_all(texts)
    first = next(rows)
    assert len(held) < len(texts)
    found = [np.frombuffer(packed, encoder.dtype).tolist() for packed in [first, *rows]]
    assert held == texts
    assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_id_files_and_keyed_access(spark):
    library = Tokenizer.from_file(WORDS)
    docs = documents(spark, [*ODD, "two words"])
    rows = id_files.id_files(docs, WORDS, 2).collect()
    assert len(rows) == len(ODD) + 1
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    manifest = id_files.write_id_files(docs, WORDS, 2, shared_folder(spark))
    keys = spark.createDataFrame([(8,), (0,), (99,), (None,)], "doc_id long")
    found = sorted((r.doc_id, r.ids) for r in id_files.read_documents(manifest, keys).collect())
    ids = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in ("", "again", "two words")]
    assert found == sorted([(0, ids[0]), (0, ids[1]), (8, ids[2])])
    assert id_files.id_files(docs.limit(0), WORDS, 2).count() == 0


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).persist()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        assert 0 < after.count()
        if name == "n-gram Jaccard join":
            texts = {r.doc_id: r.text for r in docs.collect()}
            expected = brute_components(texts, 5, 80)
            assert {r.doc_id for r in after.collect()} == {k for k, (_, c) in expected.items() if c == k}
        docs = after
    assert docs.count() <= 2 * rows
    assert docs.where("size(token_ids) = 0 and length(text) > 0").count() == 0


CLASHING = ["removed", "cw_lines", "cw_removed", "cw_text", "cw_score", "cw_rate", "cw_ids", "cw_others", "rate", "token_ids"]


def test_pipeline_of_no_and_odd_rows(spark):
    for texts in ([], ODD):
        docs = documents(spark, texts)
        for name in CLASHING:
            docs = docs.withColumn(name, F.lit("x"))
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF)
            wanted = [c for c in docs.columns if c != "token_ids"]
            if name == corpus_pipeline.STAGES[-1][0]:
                assert found.columns == [*wanted, "token_ids"]
                assert sum(len(r.token_ids) > 0 for r in found.collect()) == sum(bool(t) for t in texts)
            else:
                assert found.columns == docs.columns
                assert {r.removed for r in found.collect()} <= {"x"}
            # Targets out of reach leave the documents as they are.
            assert found.count() == len(texts) if name.startswith("mixing") else found.count() <= len(texts)


def test_mixing_learns_one_text_an_id(spark):
    rows = [(0, "hot word", "en")] * 2000 + [(i, f"bonjour mot{i}", "fr") for i in range(1, 300)]
    rows += [(i, f"hello word{i}", "en") for i in range(300, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i,) for i in range(600)], "doc_id long")
    rates = mixing.mixing_rates(docs, labels, {"en": 0.5, "fr": 0.5})
    found = {r.doc_id: r for r in rates.collect()}
    assert found[5].shares[1] > 0.9 and found[400].shares[0] > 0.9
    tokens = [sum(r.rate * r.copies * r.n_tokens * r.shares[k] for r in found.values()) for k in (0, 1)]
    assert tokens[0] == pytest.approx(tokens[1], rel=0.01)
    made = mixing.resampled(docs, rates).count()
    assert made <= sum(math.ceil(r.rate) * r.copies for r in found.values())


def test_rows_of_one_id_are_dealt_over_shards_and_read_by_several_tasks(spark):
    library = Tokenizer.from_file(WORDS)
    texts = [(7 if k % 3 == 0 else k, f"Text number {k} of Zoë’s list, 中文 xΣ.") for k in range(3000)]
    docs = documents(spark, texts).repartition(8)
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = id_files.write_id_files(docs, WORDS, 2, shared_folder(spark))
        shards = manifest.collect()
        hot = [r for r in shards if r.first_id is not None and r.first_id <= 7 <= r.last_id]
        assert len(hot) > 3 and max(r.docs for r in hot) < 600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    read = id_files.read_all(manifest)
    tasks = read.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 5
    ids = {t: [*library.encode(t, add_special_tokens=False).ids, 2] for _, t in texts}
    want = Counter(
        (k, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for k, t in texts
    )
    rows = read.collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == sorted(k for k, _ in texts)


def test_every_document_has_the_librarys_ids(spark):
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in id_files.id_files(docs, WORDS, 2).collect()}
    for row in docs.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 2]
        assert found[row.doc_id] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), row.doc_id


def test_round_trips_of_odd_rows(spark):
    vocabulary = bpe.Vocabulary.read(RANKS, public_tokenizers.PATTERN)
    docs = documents(spark, [*ODD, "one"]).withColumn("ids", F.lit("x"))
    found = bpe_digests.round_trips(docs, vocabulary).collect()
    assert len(found) == len(ODD) + 1
    nothing = sha256(b"").hexdigest()
    by_text = {r.n_tokens: r for r in found}
    assert (by_text[0].ids_sha256, by_text[0].decoded_sha256) == (nothing, nothing)
    assert sum(r.decoded_sha256 == sha256(b"one").hexdigest() for r in found) == 3
    assert bpe_digests.round_trips(docs.limit(0), vocabulary).count() == 0


def test_tokens_stay_side_by_side_as_merging_says():
    transducer = bpe.Transducer(bpe.Vocabulary.read(RANKS, public_tokenizers.PATTERN).ranks())
    rng, tokens = random.Random(4), list(transducer.ranks)
    short = [t for t in tokens if len(t) <= 3]
    for k in range(6000):
        pair = rng.choice(short if k % 2 else tokens), rng.choice(short if k % 3 else tokens)
        pair = (pair[0], pair[0]) if k % 40 == 0 else pair
        assert transducer._stay(pair) == (transducer.merged(pair[0] + pair[1]) == list(pair)), pair
