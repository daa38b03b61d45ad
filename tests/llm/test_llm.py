"""The operators for training data against plain versions, round trips and odd rows."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from types import ModuleType

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from moodwell.llm import (
    bilinear,
    bytelang,
    chat,
    licenses,
    ordermin,
    pieces,
    postings,
    registry,
    sentences,
    shards,
    winnow,
)
from moodwell.llm.common import likely_among, once_per_process, written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, size long, words string"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def texts(small):
    return pq.read_table(f"{small}/documents.parquet").to_pandas()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"Wort{i % 977} ça" for i in range(20_000)) + ". MIT License."
    rows = [
        (1, None), (2, ""), (3, " \n "), (4, "MIT license, MIT License"), (5, long), (6, long),
        (7, "123 !!"), (7, "123 !!"), (None, "apache license"), (8, "É ÉTÉ\x00 a▁b </s> [INST]"), (9, "one two"),
    ]
    return spark.createDataFrame([(i, t, None, None, None, 5, "k", 1, "w") for i, t in rows], FIELDS)


def run(spark, name, sf_dir):
    return registry.QUERIES[name](spark, sf_dir).toPandas()


def test_pieces_equal_the_library(spark, texts, odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = pieces.read_model(path)
    apart = pieces.decode_ids(pieces.encode_texts(odd, model), model)
    rows = apart.collect()
    both = pieces.encode_and_decode(odd.withColumn("ids", F.lit("x")).repartition(2), model)
    assert both.columns == apart.columns and both.schema.simpleString() == apart.schema.simpleString()
    assert sorted(map(str, both.collect())) == sorted(map(str, rows))
    assert pieces.encode_and_decode(odd.limit(0), model).count() == 0
    for r in rows:
        want = library.encode(r.text or "", add_eos=True)
        assert list(r.ids) == want and r.decoded == library.decode(want)
    codec = pieces.codec_of(model)
    rng = np.random.default_rng(1)
    signs = list("ab é▁ \n\t<s>/xA１😀�日.,the")
    for _ in range(2000):
        text = "".join(rng.choice(signs, rng.integers(0, 40)))
        assert codec.encode(text) == library.encode(text)
        assert codec.decode(codec.encode(text)) == library.decode(library.encode(text))
    codec.compare()


def test_pieces_query(spark, small, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    got = run(spark, "op3_sentencepiece", small).set_index("doc_id")
    for r in texts.itertuples():
        ids = library.encode(r.text, add_eos=True)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (got.n_tokens[r.doc_id], got.ids_sha256[r.doc_id]) == (len(ids), digest)


def phrase_places(text):
    have, out = words(text), []
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        out += [(i, label) for i in range(len(have)) if have[i : i + len(want)] == want]
    return len(have), out


def check_licenses(got, rows):
    want = Counter()
    for doc_id, text in rows:
        n, places = phrase_places(text)
        starts = [i for i, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        first, last = (min(starts), max(starts)) if starts else (None, None)
        want[doc_id, n, len(places), first, last, labels] += 1
    found = Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got
    )
    assert found == want


def test_licenses(spark, small, texts, odd):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check_licenses(licenses.scan_licenses(docs).collect(), zip(texts.doc_id, texts.text))
    check_licenses(licenses.scan_licenses(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    notice = licenses.NOTICES["mit"].split()
    del notice[20]
    changed = spark.createDataFrame([(1, "x " + " ".join(notice)), (2, " ".join(notice[:15]))], "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.n_base) for r in licenses.scan_licenses(changed).collect()}
    assert found == {1: ("mit", 0), 2: ("", 0)}


def contamination(docs, items):
    runs = {}
    for item, text in items:
        w = words(text)
        for i in range(max(0, len(w) - 13) + 1 if w else 0):
            runs.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    sizes = {len(r) for r in runs}
    out = Counter()
    for doc_id, text in docs:
        w, hit, met = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if found := runs.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    met |= found
        out[doc_id, len(w), len(hit), tuple(sorted(met))] += 1
    return out


def test_contamination(spark, small, texts, odd):
    items = pq.read_table(f"{small}/benchmark.parquet").to_pandas()
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    got = winnow.find_contamination(docs, bench).collect()
    want = contamination(zip(texts.doc_id, texts.text), zip(items.item_id, items.text))
    assert any(n for _, _, n, _ in want)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    long = " ".join(words(odd.where("doc_id = 5").first().text)[500:540])
    few = [(1, "mit license"), (1, "mit license"), (2, None), (3, ""), (4, long), (5, "two")]
    short = spark.createDataFrame(few, "item_id long, text string")
    got = winnow.find_contamination(odd, short).collect()
    want = contamination([(r.doc_id, r.text) for r in odd.collect()], few)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    kept = winnow.decontaminate(odd, short)
    assert kept.columns == odd.columns and 4 not in [r.doc_id for r in kept.collect()]


def test_clean_rows_stay_beside_contaminated_ones(spark):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(None, item), (None, "clean one"), (None, None), (1, item), (1, "clean two"), (1, item), (2, "clean one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = winnow.decontaminate(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    want = [(None, "clean one"), (None, None), (1, "clean two"), (2, "clean one")]
    assert Counter(map(tuple, kept.collect())) == Counter(want)


@pytest.mark.parametrize("copies", [0, 3000])
def test_shards(spark, odd, copies):
    many = spark.range(copies).selectExpr("id + 100 AS doc_id", "'the same text' AS text")
    docs = odd.select("doc_id", "text").unionByName(many)
    got = shards.assign_shards(docs).toPandas()
    assert len(got) == 11 + copies and set(got["shard"]) <= set(range(16))
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    sums = got.groupby("shard")["size"].sum().reindex(range(16), fill_value=0)
    assert sums.max() - sums.min() <= 2 * got["size"].max()
    by_id = got.dropna().set_index("doc_id")
    assert by_id["size"][1] == 1 and by_id.text_crc32[9] == zlib.crc32(b"one two")


def test_chat(spark, small):
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(None, None, None, None), (5, 1, "assistant", "<\\s><s>[\\\\INST]é😀"), (5, 0, "us[/INST]er", "x")]
    rows += [(6, 0, "assistant", ""), (6, 0, "assistant", ""), (6, 1, "assistant", "\n a ")]
    rows += [tuple(r) for r in pq.read_table(f"{small}/conversations.parquet").to_pandas().itertuples(index=False)]
    df = spark.createDataFrame([(*map(lambda x: x.item() if hasattr(x, "item") else x, r), 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    ranks, pattern = pieces.read_model(registry.RANKS), public_tokenizers.PATTERN
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df, ranks, pattern), ranks, pattern).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_escapes_go_back():
    rng = np.random.default_rng(2)
    for _ in range(3000):
        text = "".join(rng.choice(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/s>", "INST]", "a"], 8))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_language_scores(spark, small, odd):
    got = run(spark, "op1_lm_score", small)
    docs = pq.read_table(f"{small}/documents.parquet").to_pandas()
    counts = Counter()
    for r in docs.itertuples():
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update([*r.text.encode().lower().split(), b" "])
    total, distinct = sum(counts.values()), len(counts)
    by_id = got.set_index("doc_id")
    for r in docs.itertuples():
        tokens = [*r.text.encode().lower().split(), b" "]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        mine = by_id.loc[r.doc_id]
        assert (mine.n_tokens, mine.n_known) == (len(tokens), sum(t in counts for t in tokens))
        assert mine.train_tokens == total and math.isclose(mine.base_score, base, rel_tol=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    small_dictionary = bilinear.score_texts(odd, bytelang.held_out(F.col("doc_id"), 7, 2), known=5).collect()
    large = bilinear.score_texts(odd, bytelang.held_out(F.col("doc_id"), 7, 2)).collect()
    assert len(large) == 11 and all(r.n_tokens >= 1 for r in large)
    both = [sorted((r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in x) for x in (small_dictionary, large)]
    assert both[0] == both[1]


def test_rare_words_count_as_contexts_and_have_exact_shares(spark):
    """Words without a target of their own, in the dictionary or not, differ as contexts; with all
    others of their target, and one that was never seen, their shares add up to one."""
    often = " ".join(f"c{i}" for i in range(bilinear.TARGETS + 50))
    rare = [f"r{i}" for i in range(40)]
    rows = [(i, often) for i in range(3)] + [(3, " ".join(rare)), (4, " ".join(rare[::2])), (5, " ".join(rare[::-2][::-1]))]
    rows += [(6, " ".join(rare[:9])), (7, " ".join(rare[8::-1]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for known in (5, 1000):
        got = {r.doc_id: r for r in bilinear.score_texts(df, F.col("doc_id") > 5, known=known).collect()}
        assert np.isclose(got[6].base_score, got[7].base_score) and got[6].n_known == got[7].n_known == 10
        assert abs(got[6].score - got[7].score) > 1e-4
    counts = bilinear.count_tokens(df.select("text")).cache()
    made = bilinear.make_dictionary(counts, 1000)
    place, targets = made.lookup()
    assert len(made.log_shares) == bilinear.TARGETS and np.isclose(np.exp(made.log_shares).sum(), 1)
    held = np.ones(bilinear.SHARED)
    for r in counts.collect():
        target = targets[place[bytes(r.token)]] - made.own
        if target >= 0:
            assert target == bilinear.shared_target(bytes(r.token))
            held[target] += r.c + 1
    assert np.allclose(np.log10(held), made.log_shared)
    assert targets[place[b"never"]] == made.own + bilinear.shared_target(b"never")


def _small_dictionary(n, known):
    words = [b" ", *(f"w{i}".encode() for i in range(n))]
    counted = [50, *(1 + 3000 // (i + 1) for i in range(n))]
    dealt = np.zeros((2, bilinear.GROUPS), dtype=np.int64)
    for word, count in zip(words, counted):
        dealt[:, bilinear.group_of(word)] += count, 1
    made = bilinear.Dictionary(words[:known], counted[:known], sum(counted), len(words), dealt)
    return words, counted, made


@pytest.mark.parametrize("known", [20_001, 9000])
def test_words_of_a_shared_target_have_vectors_and_add_up(known):
    """Every word of the dictionary has a leaf of its own at one of two steps; chances of all words within a
    shared target, those outside the dictionary by their counts, add up to one whatever the vectors."""
    words, counted, made = _small_dictionary(20_000, known)
    place, targets = made.lookup()
    leaves = bilinear.Leaves(made.bounds, made.log_leaves)
    rng = np.random.default_rng(5)
    leaves.values[:] = rng.normal(0, 1, leaves.values.shape)
    context = rng.normal(0, 0.5, bilinear.SIZE + 1).astype(np.float32)
    places = bilinear.places_of(words, place)
    tokens, at, met = made.leaves(places)
    assert tokens.tolist() == np.flatnonzero(targets.take(places) >= made.own).tolist()
    logs = np.bincount(tokens[at], leaves.log_probabilities(np.tile(context, (len(tokens), 1)), at, met), len(words))
    logs[places < 0] += np.log(np.array(counted) + 1)[places < 0] - made.log_rest[~places[places < 0]] * np.log(10)
    never = np.zeros(bilinear.SHARED)
    for group in range(bilinear.GROUPS):
        _, at, met = made.leaves(np.array([~group]))
        step = leaves.log_probabilities(context[None], at, met).sum()
        never[group % bilinear.SHARED] += np.exp(step - made.log_rest[group] * np.log(10))
    total = np.bincount(targets.take(places)[tokens] - made.own, np.exp(logs[tokens]), bilinear.SHARED) + never
    assert np.allclose(total, 1, rtol=1e-3)
    own = [tuple(made.steps[:, p]) for p in range(made.own, known)]
    assert len({max(s, key=lambda x: x if x >= 0 else -1) if s[1] < 0 else s[1] for s in own}) == known - made.own


def test_leaves_start_as_counts_and_learn_rare_words(spark):
    """Two rare words of one shared target, told apart by the words before: once, a count was all they had."""
    words = [f"r{i}" for i in range(4000)]
    pair = next((a, b) for a in words for b in words if a < b and bilinear.group_of(a.encode()) == bilinear.group_of(b.encode()))
    often = [f"c{i}" for i in range(bilinear.TARGETS)]
    rng, texts = np.random.default_rng(3), []
    for i in range(600):
        k = i % 2
        texts.append(" ".join(rng.choice(often, 10)) + f" {('left', 'right')[k]}" * 4 + f" {pair[k]}")
    texts += [" ".join(often)] * 40
    probes = ["left left left left " + pair[0], "left left left left " + pair[1]]
    df = spark.createDataFrame(list(enumerate(texts + probes)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.score for r in bilinear.score_texts(df, F.col("doc_id") >= len(texts)).collect()}
    assert got[len(texts)] > got[len(texts) + 1] + 0.2


def test_model_is_normalised():
    model = bilinear.Model(np.log(np.full(7, 1 / 7)))
    before = np.random.default_rng(1).integers(0, 7, (1, bilinear.CONTEXT)).repeat(7, axis=0)
    assert np.isclose(np.exp(model.log_probabilities(before, np.arange(7))).sum(), 1)


def test_model_scores_by_tables_of_fixed_size(monkeypatch):
    """Powers of e are taken for words at places, not for every token and target; results are those of
    plain sums, also where single precision has nothing left."""
    n, rng, taken = 40, np.random.default_rng(4), []
    exp = np.exp
    for size in (0.5, 40):
        model = bilinear.Model(np.log(rng.dirichlet(np.ones(n))))
        for name, part in model.parts.items():
            model.parts[name] = rng.normal(0, size if name == "words" else 1, part.shape).astype(np.float32)
        before, wanted = rng.integers(0, n, (5000, bilinear.CONTEXT)), rng.integers(0, n, 5000)
        p = {k: v.astype(float) for k, v in model.parts.items()}
        made = sum(p["words"][before[:, i]] * p["places"][i] for i in range(bilinear.CONTEXT))
        scores = made @ p["targets"].T + p["bias"]
        top = scores.max(axis=1)
        expected = scores[np.arange(5000), wanted] - top - np.log(exp(scores - top[:, None]).sum(axis=1))
        taken.clear()
        with monkeypatch.context() as patch:
            patch.setattr(np, "exp", lambda x, *a, **k: (taken.append(np.size(x)), exp(x, *a, **k))[1])
            got = model.log_probabilities(before, wanted)
        assert np.allclose(got, expected, rtol=1e-5, atol=1e-4)
        if size < 1:
            assert sum(taken) == bilinear.CONTEXT * n * n


def test_training_step_is_that_of_plain_sums():
    """One step, each drawn word and each place of a token by itself."""
    n, rng = 9, np.random.default_rng(5)
    model, sums = bilinear.Model(np.log(rng.dirichlet(np.ones(n)))), {}
    before, wanted = rng.integers(0, n, (20, bilinear.CONTEXT)), rng.integers(0, n, 20)
    p = {k: v.astype(float) for k, v in model.parts.items()}
    drawn = model.up_to.searchsorted(np.random.default_rng(6).random(bilinear.NOISE), side="right")
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    for context, word in zip(before, wanted):
        made = sum(p["words"][w] * p["places"][i] for i, w in enumerate(context))
        for k, data in [(word, 1), *((d, 0) for d in drawn)]:
            least = np.log(bilinear.NOISE) + model.log_shares[k]
            wrong = 1 / (1 + np.exp(least - made @ p["targets"][k] - p["bias"][k])) - data
            grads["targets"][k] += wrong * made
            grads["bias"][k] += wrong
            for i, w in enumerate(context):
                grads["words"][w] += wrong * p["targets"][k] * p["places"][i]
                grads["places"][i] += wrong * p["targets"][k] * p["words"][w]
    model.train(before, wanted, np.random.default_rng(6), sums)
    for name, g in grads.items():
        assert np.allclose(sums[name], 1e-6 + (g / 20) ** 2, rtol=1e-3, atol=1e-9), name


def test_gradients_of_the_byte_network():
    net = bytelang.ByteTagger(["a", "b", "c"])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(3)
    windows, wanted = rng.integers(0, 257, (3, 6)), np.array([0, 2, 1])
    used = (windows.T != bytelang.PAD)

    def loss():
        p = net.label(windows)[:, np.arange(3), wanted]
        return -(np.log(p) * used).sum() / used.sum()

    grads = net.gradients(windows, wanted)
    for name in ("uf", "ub", "out", "bias"):
        at = tuple(rng.integers(0, s) for s in net.w[name].shape)
        start = net.w[name][at]
        net.w[name][at] = start + 1e-3
        up = loss()
        net.w[name][at] = start - 1e-3
        down = loss()
        net.w[name][at] = start
        assert np.isclose((up - down) / 2e-3, grads[name][at], atol=2e-4)


def test_languages(spark, small, texts, odd):
    got = run(spark, "op4_language_id", small).merge(texts[["doc_id", "lang"]], on="doc_id")
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.9 and got.score.between(0, 1).all()
    tagger = bytelang.train_tagger(odd.where("lang IS NOT NULL"))
    rows = bytelang.identify(odd, tagger).collect()
    assert len(rows) == 11 and {r.lang_pred for r in rows} == {"und"}
    tagger = bytelang.train_tagger(spark.read.parquet(f"{small}/documents.parquet"), per_language=20)
    unknown = {r.doc_id for r in bytelang.identify(odd, tagger).collect() if r.lang_pred == "und"}
    assert unknown == {1, 2, 3, 7}


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(bytelang.ByteTagger, "train", lambda self, windows, wanted: seen.append(windows))
    texts = spark.createDataFrame([(f"text number {i}", "en") for i in range(40)], "text string, lang string")
    first = texts.orderBy(F.xxhash64("text")).first().text
    copies = spark.range(500).select(F.lit(first).alias("text"), F.lit("en").alias("lang"))
    bytelang.train_tagger(texts.unionByName(copies), per_language=20)
    assert len(np.unique(seen[0], axis=0)) == len(seen[0]) == 20


def test_nearest(spark, small):
    rows = pq.read_table(f"{small}/embeddings.parquet").to_pandas()
    x, ids = np.array(rows.embedding.tolist(), dtype=float), rows.vec_id.to_numpy()
    got = run(spark, "op2_nearest_neighbours", small)
    hits = n = 0
    for q in ids[ids % 20 == 0]:
        scores = x @ x[ids == q][0]
        best = [ids[i] for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21))
        hits, n = hits + len(set(best) & set(mine.vec_id)), n + 20
    assert hits / n >= 0.9


def test_nearest_of_many_vectors(spark):
    """Vectors in nearly all directions alike, as in sf0.1, in more than a hundred lists."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 0.009, (10, 64))[rng.integers(0, 10, 20_000)] + rng.normal(0, 0.125, (20_000, 64))
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = postings.nearest(df, F.col("vec_id") % 50 == 0).toPandas().groupby("query_id")["vec_id"].agg(set)
    hits = 0
    for q in range(0, 20_000, 50):
        scores = x @ x[q]
        scores[q] = -2
        assert len(got[q]) == 20
        hits += len(set(np.argpartition(-scores, 20)[:20].tolist()) & got[q])
    assert hits / (20 * 400) >= 0.9


def test_nearest_visits_enough_lists():
    """One vector a list: a query goes on until enough vectors are met."""
    graph = postings.CentroidGraph(np.random.default_rng(1).normal(size=(60, 8)).astype(np.float32))
    visits = graph.visited(graph.centroids[:5], 1.1, postings.HOPS, np.ones(60, dtype=np.int64), 21)
    assert (visits.sum(axis=1) >= 21).all()


def test_nearest_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0])]
    rows += [(6, [2.0, 0.0]), (7, [1.0]), (20, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = postings.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [
        (0, 1, 6, 2.0), (0, 2, 1, 1.0), (0, 3, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0), (20, 3, 6, -2.0),
    ]
    assert postings.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_a_query_is_not_copied_for_each_list(spark):
    """A row per query, with its lists by shelf: rows per list were as many as all pairs where all lists are visited."""
    rng = np.random.default_rng(2)
    graph = postings.CentroidGraph(rng.normal(size=(100, 9)).astype(np.float32))
    df = spark.createDataFrame([(str(i), rng.normal(size=8).tolist()) for i in range(300)], "copy string, vector array<double>")
    for reach, want in ((float("inf"), 100), (1.1, 5)):
        got = postings.visit_lists(df, graph, reach, None, np.ones(100, dtype=np.int64), 5).toPandas()
        assert len(got) == 300 and (got.floor == postings.LEAST).all()
        visits = graph.visited(postings._as_query(np.array(got.vector.tolist()), graph), reach, None, np.ones(100), 5)
        for held, shelves, bits in zip(visits, got.shelf, got.lists):
            lists = [s * postings.SHELF + i for s, b in zip(shelves, bits) for i in range(postings.SHELF) if b >> i & 1]
            assert lists == np.flatnonzero(held).tolist() and len(lists) >= min(want, 5)


def test_blocks_give_the_best_rows(spark):
    """Equal products, copies, ids of several vectors and lists that a query does not visit, against brute force."""
    rng = np.random.default_rng(3)
    x, q = rng.integers(-2, 3, (400, 6)).astype(float), rng.integers(-2, 3, (300, 6)).astype(float)
    ids = [sorted(rng.choice(350, rng.integers(1, 4), replace=False).tolist()) for _ in x]
    x_lists, q_lists = rng.integers(1, 16, 400), rng.integers(0, 16, 300)
    there = pa.table({"ids": ids, "vector": x.tolist(), "lists": x_lists})
    for floor in (postings.LEAST, 3.0):
        asked = pa.table({"asked": [f"q{i}" for i in range(300)], "vector": q.tolist(), "lists": q_lists, "floor": [floor] * 300})
        got = postings.compare(there, asked, 5).to_pandas().groupby("asked")[["score", "vec_id"]].apply(lambda d: d.to_numpy().tolist())
        for i in range(300):
            best = {}
            for held, v, lists in zip(ids, x, x_lists):
                if lists & q_lists[i] and v @ q[i] >= floor:
                    for k in held:
                        best[k] = max(best.get(k, -99), v @ q[i])
            want = sorted((-s, k) for k, s in best.items())[:5]
            assert sorted((-s, k) for s, k in got.get(f"q{i}", [])) == want


def test_nearest_is_the_same_in_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, rng.normal(size=16).tolist()) for i in range(3000)], "vec_id long, embedding array<float>")
    rows = postings.nearest(df, F.col("vec_id") % 20 == 0).toPandas().sort_values(["query_id", "rank"])
    monkeypatch.setattr(postings, "NUMBERS", 16 * 40)
    blocks = postings.nearest(df, F.col("vec_id") % 20 == 0).toPandas().sort_values(["query_id", "rank"])
    assert len(rows) == 3000 and rows.to_numpy().tolist() == blocks.to_numpy().tolist()


def test_passages_go(spark, odd):
    rng = np.random.default_rng(4)

    def prose(n):
        return " ".join(" ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(9)).capitalize() + "." for _ in range(n))

    passage, bare = prose(7), prose(8).replace(".", "").lower()
    rows = [(i, f"{prose(4)}\n{passage} {prose(3)}") for i in range(30)]
    rows += [(100 + i, f"{prose(4)}\n{bare}\n{prose(2)}") for i in range(5)] + [(200, prose(20))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sentences.remove_repeats(df).collect()}
    assert got[0].n_removed == got[100].n_removed == got[200].n_removed == 0
    for i in range(1, 30):
        assert passage not in got[i].text and got[i].text.startswith(rows[i][1][:200])
    for i in range(101, 105):
        assert len(set(bare.split()) & set(got[i].text.split())) < 0.4 * len(bare.split())
    assert got[200].text == rows[-1][1]
    left = sentences.remove_repeats(odd)
    assert left.count() == 11 and left.columns == [*odd.columns, "n_sentences", "n_removed"]
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[1] is None and texts[5] and not texts[6]


@pytest.mark.parametrize("length", [1, 5, 16, 20, 22, 24, 25, 40, 1000])
def test_any_fifty_shared_words_hold_a_run(length):
    """At every offset in sentences of some length, in other words before and after."""
    rng = np.random.default_rng(length)

    def prose(n, at):
        words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n)]
        return [w + "." * ((at + i) % length == length - 1) for i, w in enumerate(words)]

    for offset in range(min(length, 40)):
        passage = prose(50, offset)
        a, b = (" ".join([*prose(37 + k, 0), *passage, *prose(30, offset + 50)]) for k in (0, 5))
        found = [{r[2:]: r[:2] for r in sentences.run_hashes(t)} for t in (a, b)]
        shared = found[0].keys() & found[1].keys()
        assert shared
        for text, runs in zip((a, b), found):
            cut = sentences.cut_sentences(text)
            for place, parts in (runs[h] for h in shared):  # brute force: nothing else is shared
                run = text[cut[place][0] : cut[place + parts - 1][1]].strip()
                assert run in " ".join(passage) and len(run.split()) >= 15


def test_cuts_make_up_the_text(texts):
    for text in texts.text:
        assert "".join(text[a:b] for a, b, _ in sentences.cut_sentences(text)) == text


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment():
    rng = np.random.default_rng(6)
    for _ in range(150):
        a = [str(x) for x in rng.integers(0, 9, rng.integers(5, 50))]
        b = list(a)
        for _ in range(rng.integers(0, 4)):
            b[rng.integers(0, len(b))] = "z"
        x, y = (list(ordermin.shingle_hashes(ordermin.word_list(" ".join(t)))) for t in (a, b))
        n = common(x, y)
        got, want = ordermin.similarity(" ".join(a), " ".join(b)), n / (len(x) + len(y) - n)
        assert (got >= 0.8) == (want >= 0.8)


def test_near_copies(spark, small, texts, odd):
    got = run(spark, "op10_near_duplicates", small).set_index("doc_id")
    root = {i: i for i in range(len(texts))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    shingles = [set(ordermin.shingle_hashes(w).tolist()) if (w := ordermin.word_list(t)) else set() for t in texts.text]
    for i in range(len(texts)):
        for j in range(i):
            both = len(shingles[i] & shingles[j])
            if 2 * both > len(shingles[i]) and ordermin.similarity(texts.text[i], texts.text[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i in range(len(texts)):
        least[find(i)] = min(least.get(find(i), 10**9), texts.doc_id[i])
    assert all(got.class_id[texts.doc_id[i]] == least[find(i)] for i in range(len(texts)))
    rows = {(r.id, r.class_id, r.class_size) for r in ordermin.near_duplicates(odd).collect()}
    assert {(1, 1, 1), (5, 5, 2), (6, 5, 2), (7, 7, 2)} <= rows
    kept = ordermin.keep_one_each(odd)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9]


def test_near_copies_of_many_variants(spark):
    """Variants of variants: many are unlike the centre of a bucket, yet like its other members."""
    rng = np.random.default_rng(12)
    texts = [[f"w{x}" for x in rng.integers(0, 400, 140)]]
    while len(texts) < 1500:
        words = list(texts[rng.integers(0, len(texts))])
        for _ in range(rng.integers(1, 6)):
            words[rng.integers(0, len(words))] = f"w{rng.integers(0, 400)}"
        texts.append(words)
    texts = [" ".join(t) for t in texts]
    hashes = [ordermin.shingle_hashes(ordermin.word_list(t)) for t in texts]
    sets = [set(h.tolist()) for h in hashes]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 110 and find(i) != find(j) and ordermin.similarity(texts[i], texts[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.class_id for r in ordermin.near_duplicates(df).collect()}
    assert got == {i: find(i) for i in range(len(texts))} and len(set(got.values())) > 1


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, small, tmp_path, name):
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        spark.read.parquet(f"{small}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert registry.QUERIES[name](spark, str(tmp_path)).count() == (1 if name.startswith("op9") else 0)


def test_pipeline_decodes(spark, odd, small):
    import corpus_pipeline

    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    out = corpus_pipeline.encode(spark, odd, small).collect()
    assert len(out) == 11
    for r in out:
        assert list(r.ids) == library.encode(r.text or "", add_eos=True)
        assert r.decoded == library.decode(list(r.ids))


def test_pipeline_fills_languages(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    hidden = bytelang.held_out(F.col("doc_id"), 3, 1)
    blank = docs.withColumn("lang", F.when(~hidden, F.col("lang")))
    got = corpus_pipeline.identify_language(spark, blank, small)
    both = got.where(hidden).join(docs.select("doc_id", F.col("lang").alias("given")), "doc_id").collect()
    assert both and sum(r.lang == r.given for r in both) > 0.9 * len(both)
    assert got.where(~hidden).select("doc_id", "lang").exceptAll(docs.select("doc_id", "lang")).isEmpty()


def test_pipeline_keeps_columns_with_names_of_results(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = ["lang_pred", "score", "n_sentences", "n_removed", "_cut_", "class_id"]
    marked = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.drop_repeats):
        out = stage(spark, marked, small)
        assert out.columns == marked.columns
        got = out.select("doc_id", *names)
        assert got.exceptAll(marked.select("doc_id", *names)).isEmpty() and not got.isEmpty()
        plain = stage(spark, docs, small)
        assert out.select(*docs.columns).exceptAll(plain).isEmpty() and out.count() == plain.count()


def test_pipeline(spark, small, texts):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, small).toPandas()
    assert out.doc_id.is_unique and 0 < len(out) < len(texts)
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    for r in out.itertuples():
        assert list(r.ids) == library.encode(r.text, add_eos=True)


@pytest.mark.parametrize("known, words", [(5, 0), (11, 10), (12, 12), (13, 12), (100, 62)])
def test_no_more_words_than_known_are_sent(spark, known, words):
    """Counts with gaps: a frequent count that does not fit ends the dictionary."""
    counted = [(f"a{i}", 5) for i in range(10)] + [("b0", 4), ("b1", 4)] + [(f"c{i}", 2) for i in range(50)]
    counts = spark.createDataFrame([(t.encode(), c) for t, c in counted], "token binary, c long")
    made = bilinear.make_dictionary(counts, known)
    assert len(made.words) == words + 1 and made.words[0] == bilinear.END


def _plain_repeats(rows):
    """Runs by their words themselves, looked up in one dictionary; what is left of every text."""
    seen, left = {}, {}
    held = {}
    for row in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, _spark_hash[r[1]])):
        text = row[1] or ""
        cut = sentences.cut_sentences(text)
        spans = {(place, parts) for place, parts, _, _ in sentences.run_hashes(text)}
        for place, parts in sorted(spans):
            run = tuple(text[cut[place][0] : cut[place + parts - 1][1]].lower().split())
            if run in seen and seen[run] != (row, place):
                held.setdefault(row, set()).update(range(place, place + parts))
            seen.setdefault(run, (row, place))
    for row in set(rows):
        cut = sentences.cut_sentences(row[1] or "")
        gone = held.get(row, set())
        left[row] = "".join((row[1] or "")[a:b] for i, (a, b, _) in enumerate(cut) if i not in gone), len(gone)
    return left


_spark_hash = {}


@pytest.mark.parametrize("partitions", [1, 7])
def test_all_repeats_go_as_in_a_plain_search(spark, partitions):
    """Copies, passages within and across texts, a text of one repeated passage, null and equal ids."""
    rng = np.random.default_rng(11)

    def prose(n, length=9):
        return " ".join(" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(length)).capitalize() + "." for _ in range(n))

    shared = [prose(5), prose(3, 30), prose(2, 60).replace(".", "").lower(), prose(1, 200)]
    rows = [(i, " ".join([prose(int(rng.integers(1, 5))), shared[i % 4], prose(2)])) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(12)] + [(200, " ".join([shared[0]] * 4)), (201, None), (202, "")]
    rows += [(None, prose(4) + shared[1]), (None, prose(3) + shared[1]), (7, rows[7][1]), (8, "x " + rows[7][1])]
    rows += [(300, f"{shared[0]}\n{shared[0].upper()}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    hashes = df.select("text", sentences._text_hash("text").alias("h")).distinct().collect()
    _spark_hash.update({r.text: r.h or 0 for r in hashes})
    plain = _plain_repeats(rows)
    got = sentences.remove_repeats(df).withColumn("was", F.lit(1)).collect()
    assert len(got) == len(rows)
    # Rows with one id are told apart by what is left.
    want = sorted((str(r[0]), plain[r][0], plain[r][1]) for r in rows)
    assert sorted((str(r.doc_id), r.text or "", r.n_removed) for r in got) == want
    assert sum(r.n_removed > 0 for r in got) > 50


def test_likely_among_loses_no_row(spark, tmp_path):
    keys = spark.range(0, 40_000, 7).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("key"))
    keys.write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    rows = spark.range(40_000).select("id", F.unhex(F.md5(F.col("id").cast("string"))).alias("key"))
    got = {r.id for r in likely_among(rows, keys, "key").collect()}
    wanted = set(range(0, 40_000, 7))
    assert wanted <= got and len(got - wanted) < 40_000 // 10
    assert likely_among(rows, keys.limit(0), "key").count() == 0


def test_common_length_of_long_texts_is_exact():
    rng = np.random.default_rng(3)
    for size, values in ((300, 10_000), (300, 40), (80, 3)):
        a = rng.integers(0, values, size).astype(np.uint64)
        b = np.delete(a, rng.integers(0, size, size // 20))
        b[rng.integers(0, len(b), size // 20)] = 99_999
        row = [0] * (len(b) + 1)
        for x in a:
            row = _next_row(row, x, b)
        assert ordermin.common_length(a, b, size) == row[-1]


def _next_row(row, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
    return new


def test_more_labels_than_are_learned(spark):
    rows = [(i, f"abc {i} def" if i % 3 else f"xyz {i} uvw", f"l{i % 3}") for i in range(60)]
    rows += [(100 + i, f"rare {i}", f"r{i:03}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    tagger = bytelang.train_tagger(df, per_language=7, languages=4)
    assert tagger.languages == ["l0", "l1", "l2", "r000"]
    seen = {r.lang_pred for r in bytelang.identify(df, tagger).collect()}
    assert seen <= {"l0", "l1", "l2", "r000"}


def test_a_filter_on_languages_runs_the_network_once(spark, texts):
    df = spark.createDataFrame(texts[["doc_id", "text", "lang"]].head(50))
    found = bytelang.identify(df, bytelang.train_tagger(df)).where(F.col("lang_pred") != bytelang.UNKNOWN)
    plan = found.select("doc_id", "lang_pred")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_contamination_equals_its_sql(spark, small):
    engine = duckdb.connect()
    for name in ("documents", "benchmark"):
        engine.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    said = engine.execute(registry.ORACLES["op6_decontaminate"])
    names = [d[0] for d in said.description]
    wanted = sorted(said.fetchall())
    got = run(spark, "op6_decontaminate", small)
    assert sorted(got.columns) == sorted(names)
    assert sorted(got[names].itertuples(index=False, name=None)) == wanted
    assert any(row[names.index("contaminated")] for row in wanted)


def test_short_chunks_join_as_long_ones_do():
    """The agenda as a list gives what the heap gives, also where pieces have one score."""
    codec = pieces.PieceCodec(pieces.read_model(public_tokenizers.path("piece_bpe_32k.model")))
    assert codec.tied
    rng = random.Random(5)
    tied = sorted({codec.library.id_to_piece(v & ((1 << codec.bits) - 1)) for v in codec.tied})
    plain = list(codec.ids)
    for _ in range(3000):
        chunk = "".join(rng.choice(tied if rng.random() < 0.3 else plain) for _ in range(rng.randint(1, 5)))
        symbols = [codec.ids[c] for c in chunk]
        assert codec._merge_short(list(symbols)) == codec._merge_long(chunk, list(symbols))


def test_a_worker_keeps_things_of_one_kind(monkeypatch):
    monkeypatch.setitem(sys.modules, "_moodwell_held", ModuleType("_moodwell_held"))
    first = once_per_process(("pieces", 1), list)
    assert once_per_process(("pieces", 2), list) is not first
    assert once_per_process(("pieces", 1), list) is first
    once_per_process(("word-hashes",), dict)
    held = [k for k in vars(sys.modules["_moodwell_held"]) if isinstance(k, tuple)]
    assert held == [("word-hashes",)]


def test_kept_chunks_share_their_numbers_and_words():
    """A chunk behind a mark is kept once, as a word, and equal ids are one object."""
    codec = pieces.PieceCodec(pieces.read_model(registry.PIECES))
    first = codec.encode("Theningoux theningoux, theningoux. a\ntheningoux")
    assert [c for c, _ in codec.unchecked].count("▁theningoux") == 1
    assert "theningoux" in codec.words and not any(c[0] == pieces.MARK for c in codec.known)
    codec.compare()
    assert first == codec.library.encode("Theningoux theningoux, theningoux. a\ntheningoux")
    held = [i for kept in (codec.words, codec.known) for ids in kept.values() for i in ids]
    assert len({id(i) for i in held}) == len(set(held))


def test_a_wrong_chunk_among_many_is_named():
    codec = pieces.PieceCodec(pieces.read_model(registry.PIECES))
    words = [f"w{i}ord {chr(228) * (i % 3)}x{i}." for i in range(100)]
    codec.encode(" ".join(words) + "\n\nnext")
    chunk, ids = codec.unchecked[70]
    codec.unchecked[70] = (chunk, ids[::-1] + ids[:1])
    with pytest.raises(ValueError, match=re.escape(repr(chunk))):
        codec.compare()


def test_identify_lets_go_of_what_earlier_steps_held(spark):
    """A worker that encoded texts does not keep their chunks while it reads languages."""
    def held(batches):
        import sys

        import pyarrow as pa

        for batch in batches:
            names = vars(sys.modules["_moodwell_held"]) if "_moodwell_held" in sys.modules else {}
            kinds = [str(k[0]) for k in names if isinstance(k, tuple)]
            yield pa.RecordBatch.from_arrays([pa.array([",".join(kinds)] * batch.num_rows)], ["kinds"])

    df = spark.createDataFrame([(i, "some words here") for i in range(64)], FIELDS.split(", id")[0].split(", lang")[0]).repartition(64)
    assert pieces.piece_digests(df, pieces.read_model(registry.PIECES)).agg(F.sum("n_tokens")).first()[0]
    before = {r.kinds for r in df.select("doc_id").mapInArrow(held, "kinds string").collect()}
    assert "pieces" in before
    tagged = written(bytelang.identify(df, bytelang.ByteTagger(["a", "b"])), "tagged")
    seen = {r.kinds for r in tagged.select("doc_id").repartition(64).mapInArrow(held, "kinds string").collect()}
    assert "pieces" not in seen
