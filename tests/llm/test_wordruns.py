"""Runs of repeated words against all periods tried at all places."""

import hashlib
import random
import zlib

import pyarrow.parquet as pq

from moodwell.llm import registry, wordruns


def plain_runs(words):
    found = set()
    for period in range(1, len(words) // 4 + 1):
        first = 0
        while first + period < len(words):
            end = first
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end + period - first
            unit = words[first : first + period]
            powers = any(period % r == 0 and unit == unit[:r] * (period // r) for r in range(1, period))
            if end > first and length >= max(6, 4 * period) and not powers:
                found.add((first, length, period))
            first = max(end, first + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()


def made(rng, signs, size):
    words = [b"%d" % rng.randrange(signs) for _ in range(size)]
    if size and rng.random() < 0.6:
        a = rng.randrange(size)
        period = 1 + rng.randrange(max(1, (size - a) // 3))
        words = [words[i if i < a else a + (i - a) % period] for i in range(size)]
    return words + words[-3:] * rng.randint(0, 5)


def test_all_periods_at_all_places():
    rng = random.Random(5)
    met = 0
    for _ in range(300):
        texts = [made(rng, rng.choice([1, 2, 3, 20]), rng.choice([0, 1, 5, 7, 20, 60, 150])) for _ in range(rng.randint(0, 12))]
        found = wordruns.runs_of(texts)
        assert found == [plain_runs(words) for words in texts]
        met += sum(map(len, found))
    assert met > 500


def test_long_texts():
    assert wordruns.runs_of([[b"a"] * 100_000, [b"%d" % (i % 12_345) for i in range(100_000)]]) == [
        [(0, 100_000, 1)],
        [(0, 100_000, 12_345)],
    ]
    rng = random.Random(6)
    words = [b"%d" % rng.randrange(2) for _ in range(600)]
    assert wordruns.runs_of([words]) == [plain_runs(words)]


def test_equal_sums_are_no_runs(monkeypatch):
    """All sums equal: only words that are equal make a run."""
    monkeypatch.setattr(wordruns, "_scrambled", lambda numbers: numbers.astype("uint64") * 0)
    words = [b"%d" % i for i in range(40)] + [b"x", b"y"] * 5
    assert wordruns.runs_of([words]) == [[(40, 10, 2)]]


def test_odd_rows(spark):
    long = "a b c " * 30_000
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "x " * 6), (4, "x " * 6), (None, "x\x1cx x x x x x x x x"), (5, long), (6, "x"),
    ]
    fields = "doc_id long, text string, runs int, collapsed int, start int, period string"
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "p") for i, t in rows], fields)
    got = wordruns.find_runs(docs).collect()
    want = []
    for i, text in rows:
        words = (text or "").encode().split()
        runs = [(0, 90_000, 3)] if text == long else plain_runs(words)
        want.append((i, runs, plain_collapsed(words, runs), 3, "p"))
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed, r.start, r.period) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert wordruns.find_runs(docs.limit(0)).count() == 0
    same = wordruns.with_planted_runs(docs.where("doc_id IS NULL"), "doc_id", "text").first()
    assert same.text == rows[5][1]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % period] for i in range(n)]


def test_query(spark, small):
    got = {r.doc_id: r for r in registry.QUERIES["op12_periodic_runs"](spark, small).collect()}
    docs = pq.read_table(f"{small}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    with_runs = 0
    for doc in docs:
        words = planted(doc["doc_id"], (doc["text"] or "").encode().split())
        runs = plain_runs(words) if len(words) <= 200 else wordruns.runs_of([words])[0]
        with_runs += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        want = (
            doc["doc_id"], len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
        )
        assert tuple(got[doc["doc_id"]]) == want
    assert with_runs > 5
