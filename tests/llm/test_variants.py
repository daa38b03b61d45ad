"""Spelling variants against words compared one by one."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from moodwell.llm import registry, variants


def plain_counts(docs, slips=97):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            key = zlib.crc32(f"{doc_id}:{word}".encode())
            if slips and doc_id is not None and key % slips == 0:
                word = word[: key % len(word)] + word[key % len(word) + 1 :]
            counts[word] += 1
    return counts


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_variants(counts, least_letters=5, least_count=3):
    words = sorted(w for w, n in counts.items() if len(w) >= least_letters and n >= least_count)
    # Words one apart agree in their first or in their last half, or nearly so.
    halves = defaultdict(set)
    for w in words:
        for size in (len(w) - 1, len(w), len(w) + 1):
            k = size // 2
            halves[size, "head", w[: k - 1]].add(w)
            halves[size, "tail", w[len(w) - k + 1 :]].add(w)
    near = defaultdict(set)
    for group in halves.values():
        for a in group:
            for b in group:
                if a < b and b not in near[a] and one_apart(a, b):
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None))
    return out


def check(found, counts):
    got = sorted(tuple(r) for r in found.collect())
    assert got == plain_variants(counts)
    return got


def test_letters_apart(spark):
    rng = random.Random(4)
    counts = Counter()
    for _ in range(60):
        stem = "".join(rng.choice("abé") for _ in range(rng.randint(5, 8)))
        counts[stem] += rng.randint(1, 60)
        for _ in range(12):
            i, sign = rng.randrange(len(stem) + 1), rng.choice(["", "a", "b", "é", "ÿ"])
            counts[stem[:i] + sign + stem[i + rng.randint(0, 1) :]] += rng.randint(1, 9)
    counts.update({"aaaaa": 400, "aaaaaa": 100, "aaaaaaa": 25, "aaaaaaab": 9, "aaaaaaabb": 4, "aaaaaaabbb": 3})
    counts["x" * 3000], counts["x" * 3001] = 9, 3
    rows = spark.createDataFrame([(w, n) for w, n in counts.items() if len(w) >= 5], "word string, n long")
    got = check(variants.group_variants(rows), counts)
    assert sum(r[4] for r in got) > 200
    chain = {r[0]: r[2] for r in got}
    assert chain["aaaaaaab"] == chain["aaaaaaa"] == chain["aaaaa"]


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_nodes_are_numbered_once(spark, ranges):
    rng = random.Random(ranges)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(150)} | {"a" * 40})
    table = spark.createDataFrame(list(enumerate(words)), "id long, word string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        paths = {words[r.id]: r.nodes for r in variants.trie_paths(table, "nodes").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    number = {}
    for word, nodes in paths.items():
        assert len(nodes) == len(word) + 1
        for depth, node in enumerate(nodes):
            assert number.setdefault(word[:depth], node) == node
    assert len(paths) == len(words) and len(set(number.values())) == len(number)


def test_odd_rows(spark):
    long = "Wörter×wörter " * 30_000
    rows = [
        (1, None), (2, ""), (3, "1 2"), (4, "ÉTÉéé étéÉÉ ETEee"), (4, "ÉTÉéé étéÉÉ ETEee"), (None, "abcde abcdef abcdef"),
        (None, "abcde abcdef"), (7, "abcde ABCDE abcde"), (8, long),
    ]
    fields = "doc_id long, text string, word int, n string, id int, form int"
    docs = spark.createDataFrame([(i, t, 1, "n", 2, 3) for i, t in rows], fields)
    for slips in (None, 2):
        found = variants.group_variants(variants.count_words(docs, slips=slips))
        check(found, plain_counts(rows, slips))
    empty = docs.limit(0)
    assert variants.group_variants(variants.count_words(empty)).count() == 0


def test_counts_sent_in_parts(spark, small, monkeypatch):
    monkeypatch.setattr(variants, "HELD_WORDS", 50)
    docs = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    counts = plain_counts([(d["doc_id"], d["text"]) for d in docs], 97)
    got = variants.count_words(spark.read.parquet(f"{small}/documents.parquet"), slips=97).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in counts.items() if len(w) >= 5}


def test_query(spark, small):
    docs = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    counts = plain_counts([(d["doc_id"], d["text"]) for d in docs])
    found = registry.QUERIES["op13_spelling_variants"](spark, small)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = check(found, counts)
    assert any(r[1] for r in got)
