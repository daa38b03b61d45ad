"""Near-duplicate classes by order MinHash.

A text's five-word shingles are labelled by occurrence. Under each of some hash functions the
five least labelled shingles, in the order of the text, are one sketch, so that texts agree in
it if they are alike in content and order. Texts that share a sketch are a bucket: all
are held against its centre. In buckets that this leaves with more than one class, all pairs of
different classes are held against each other, in blocks of members, each pair in the first
bucket it shares; what two texts share at most is counted before they are aligned. So any two
that share a sketch are compared, or in one class already. Two texts are linked if a banded
alignment of their shingles (a longest common subsequence) covers at least 0.8 of all their
shingles together; classes are what links connect.

Defined results: equal texts are one class; null texts are classes of their own; texts without
words are alike only if equal; a text of fewer than five words is one shingle; repeated rows
fall in one class; texts are read whole; an empty table gives an empty result; other columns
are not read. Copies are put together first, so that no task holds a group of them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwell.llm.common import likely_among, once_per_process, text_key, written

SHINGLE = 5
SKETCHES = 24
LEAST = 5
SIMILAR = 0.8
MATCHES = 8  # per place of two texts, up to which matches are listed
KNOWN_WORDS = 150_000  # whose hashes a worker keeps
TEXTS = 200  # rows that are read from Arrow at a time
BLOCK = 250  # members of a bucket that are compared at a time

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256)
)
_ODD = (np.random.default_rng(5).integers(0, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def word_list(text: str) -> list[bytes]:
    """Words in lower case: letters, digits and everything beyond ASCII."""
    return text.encode().translate(_TABLE).split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A hash per run of five words, or one of all if there are fewer."""
    known = once_per_process(("word-hashes",), dict)
    if len(known) > KNOWN_WORDS:
        known.clear()
    hashes = []
    for word in words:
        h = known.get(word)
        if h is None:
            h = known[word] = xxhash.xxh3_64_intdigest(word)
        hashes.append(h)
    each = np.array(hashes, dtype=np.uint64)
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += each[k : k + n] * _ODD[k]
    return mix(total + np.uint64(size))


def label_occurrences(hashes: np.ndarray) -> np.ndarray:
    """Hashes in which the second, third ... of equal ones differ from the first."""
    order = np.argsort(hashes, kind="stable")
    inorder = hashes[order]
    starts = np.flatnonzero(np.r_[True, inorder[1:] != inorder[:-1]])
    run = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.r_[starts, len(hashes)]))
    occurrence = np.empty(len(hashes), dtype=np.uint64)
    occurrence[order] = run.astype(np.uint64)
    return mix(hashes + occurrence * np.uint64(0x9E3779B97F4A7C15))


def sketches(text: str) -> tuple[int, list[int]] | None:
    """The number of shingles and the sketches of a text; None without words."""
    words = word_list(text)
    if not words:
        return None
    labelled = label_occurrences(shingle_hashes(words))
    size = min(LEAST, len(labelled))
    values = labelled[None, :] * _ODD[8 : 8 + SKETCHES, None]
    least = np.argpartition(values, size - 1, axis=1)[:, :size] if size < len(labelled) else (
        np.tile(np.arange(size), (SKETCHES, 1))
    )
    least.sort(axis=1)  # back in the order of the text
    total = np.arange(SKETCHES, dtype=np.uint64)
    for k in range(size):
        total = mix(total * _ODD[k] + labelled[least[:, k]])
    return len(labelled), total.view(np.int64).tolist()


def _matches(a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """Places of b that equal a's, by place of a and then from last to first; None if values repeat
    so much that there are more than some per place."""
    values, at = np.unique(b, return_inverse=True)
    counts = np.bincount(at, minlength=len(values))
    found = np.minimum(np.searchsorted(values, a), len(values) - 1)
    each = np.where(values[found] == a, counts[found], 0)
    if each.sum() > MATCHES * (len(a) + len(b)):
        return None
    places = np.lexsort((-np.arange(len(b)), at))  # by value, the last place first
    starts = np.r_[0, np.cumsum(counts)[:-1]][found]
    within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return places[np.repeat(starts, each) + within]


def _longest_rise(places: np.ndarray) -> int:
    """The length of the longest strictly rising subsequence."""
    ends: list[int] = []
    for place in places.tolist():
        at = bisect_left(ends, place)
        if at == len(ends):
            ends.append(place)
        else:
            ends[at] = place
    return len(ends)


def common_length(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The longest common subsequence: as a rising sequence of matches if few values repeat (in time
    about proportional to the length), else on diagonals at most ``band`` off the main one."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n -= head
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    paired = _matches(a, b)
    if paired is not None:
        return head + tail + _longest_rise(paired)
    width = 2 * band + 1
    # Column o of row i stands for place i + o - band of b; what is outside of b matches nothing.
    inside = np.zeros(len(a) + width, dtype=bool)
    padded = np.zeros(len(a) + width, dtype=np.uint64)
    stop = min(len(b), len(padded) - band)
    inside[band : band + stop], padded[band : band + stop] = True, b[:stop]
    row = np.zeros(width + 1, dtype=np.int32)
    for i, value in enumerate(a):
        equal = (padded[i : i + width] == value) & inside[i : i + width]
        row[:-1] = np.maximum.accumulate(np.maximum(row[:-1] + equal, row[1:]))
    return head + tail + int(row.max())


def similarity(a: str, b: str) -> float:
    """Shingles on the best alignment, as a share of all shingles of both texts."""
    left, right = word_list(a), word_list(b)
    if not left or not right:
        return float(a == b)
    x, y = shingle_hashes(left), shingle_hashes(right)
    both = len(x) + len(y)
    values, counts = np.unique(x, return_counts=True)
    others, more = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(values, others, assume_unique=True, return_indices=True)
    most = int(np.minimum(counts[i], more[j]).sum())
    if most < SIMILAR * (both - most):
        return most / (both - most)  # no alignment can cover more
    return aligned_share(x, y)


def aligned_share(x: np.ndarray, y: np.ndarray) -> float:
    """Shingles on the best alignment, as a share of all, right from SIMILAR on."""
    both = len(x) + len(y)
    # At that similarity so many shingles at most stand outside the alignment.
    band = int(both * (1 - SIMILAR) / (1 + SIMILAR)) + 1
    covered = common_length(x, y, band)
    return covered / (both - covered)


def sketch_texts(texts: DataFrame) -> DataFrame:
    """key and its sketches, of each row with words."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches):
            found = [sketches(text) for text in part.column("text").to_pylist()]
            at = [i for i, x in enumerate(found) if x is not None]
            columns = [part.column("key").take(pa.array(at, pa.int64())), pa.array([found[i][0] for i in at], pa.int64())]
            columns.append(pa.array([found[i][1] for i in at], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["key", "size", "sketches"])

    return texts.select("key", "text").mapInArrow(sketched, "key binary, size long, sketches array<long>")


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that few texts stand in memory as Python holds them."""
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            yield batch.slice(start, TEXTS)


def texts_of(keys: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """One text for each of the keys, written. Other texts, but for a few, are not moved, and of
    copies each task sends one."""
    wanted = written(keys.distinct(), f"{name}-keys")
    single = likely_among(texts, wanted, "key").groupBy("key").agg(F.first("text").alias("text"))
    return written(single.join(wanted, "key", "left_semi"), name)


def verify(pairs: DataFrame, stored: DataFrame) -> DataFrame:
    """The pairs (a, b) with ``alike``, from their texts."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches):
            left, right = (part.column(c).to_pylist() for c in ("text_a", "text_b"))
            alike = [similarity(x, y) >= SIMILAR for x, y in zip(left, right, strict=True)]
            columns = [part.column("a"), part.column("b"), pa.array(alike, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "alike"])

    left = stored.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = stored.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(
        aligned, "a binary, b binary, alike boolean"
    )


def find_classes(texts: DataFrame) -> DataFrame:
    """key and root of every text that is like another one. Runs jobs at once."""
    # Copies give the same sketches; the groups are gathered in each task first.
    signed = written(
        sketch_texts(texts)
        .groupBy("key")
        .agg(F.first("size").alias("size"), F.first("sketches").alias("sketches")),
        "sketches",
    )
    members = _with_company(
        signed.select("key", "size", F.posexplode("sketches").alias("last", "sketch")).select(
            "key", "size", "last", F.xxhash64("last", "sketch").alias("bucket")
        )
    )
    held = written(_with_centre(members), "members")
    # Numbers of shingles have to let the two be alike.
    least, most = F.least("size", "size_b"), F.greatest("size", "size_b")
    near = held.where(least >= most * SIMILAR).select(F.col("key").alias("a"), "b")
    pairs = written(near.distinct(), "pairs")
    stored = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("key")), texts, "texts")
    links = written(verify(pairs, stored).where("alike").select("a", "b"), "links")
    roots = connect(links)
    # What is not one class may still hold alike texts, whether like the centre or not.
    more = written(_links_within(held, roots, signed, texts), "more-links")
    return roots if more.isEmpty() else connect(links.unionByName(more))


def _with_company(members: DataFrame) -> DataFrame:
    """Members of buckets of two or more, with how many others each text meets in all of them."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(members.join(sizes, "bucket"), "shared")
    met = shared.groupBy("key").agg(F.sum("n").alias("met"))
    return written(shared.drop("n").join(met, "key"), "ranked")


def _with_centre(members: DataFrame) -> DataFrame:
    """Members of buckets of two or more, with the bucket's centre as ``b``; without the centres.

    The centre is the member that meets most others over all its first buckets: copies
    that differ from an original in places of their own all have that one in common.
    """
    centres = members.groupBy("bucket").agg(
        F.max(F.struct("met", "key", "size")).alias("m"), F.count("*").alias("n")
    )
    centres = centres.where("n > 1").select(
        "bucket", F.col("m.key").alias("b"), F.col("m.size").alias("size_b")
    )
    return members.join(centres, "bucket").where(F.col("key") != F.col("b"))


def _links_within(held: DataFrame, roots: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between classes among the members of each bucket, their centres left out.

    All pairs are held against each other, in blocks, so that no task has a large bucket.
    """
    placed = held.select("bucket", "last", "key").join(roots, "key", "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    mixed = placed.groupBy("bucket").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
        F.min("root").alias("least"), F.max("root").alias("most"),
    ).where("least != most").select("bucket", "blocks")
    open_ = written(placed.join(mixed, "bucket"), "open")
    block = F.pmod(F.xxhash64("key", "bucket"), "blocks").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = open_.select("bucket", "last", "key", "root", block.alias("block"), other).select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "last", "key", "root",
    )
    stored = texts_of(open_.select("key"), texts, "open-texts").join(signed, "key")
    by = ["bucket", "low", "high"]

    def linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _whole_groups(frames, by):
            found = links_of_group(group)
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    met = dealt.join(stored, "key").repartition(*by).sortWithinPartitions(*by)
    return met.mapInPandas(linked, "a binary, b binary")


def _whole_groups(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows equal in ``by``, also those that go on in a further frame."""
    open_: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        marks = frame[by].to_numpy()
        cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(frame)]
        if open_ and (open_[0][by].iloc[0].to_numpy() != marks[0]).any():
            yield pd.concat(open_)
            open_ = []
        for start, stop in zip(edges[:-2], edges[1:-1], strict=True):
            yield pd.concat([*open_, frame.iloc[start:stop]])
            open_ = []
        open_.append(frame.iloc[edges[-2] :])
    if open_:
        yield pd.concat(open_)


def shared_shingles(labelled: list[np.ndarray]) -> np.ndarray:
    """How many labelled shingles each two texts share."""
    flat = np.concatenate(labelled)
    owner = np.repeat(np.arange(len(labelled)), [len(x) for x in labelled])
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    often = counts[column] > 1
    column = (np.cumsum(counts > 1) - 1)[column[often]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[often][order]
    total = np.zeros((len(labelled), len(labelled)), dtype=np.float32)
    width = 4096  # columns at a time
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at = slice(*np.searchsorted(column, [start, start + width]))
        has = np.zeros((len(labelled), width), dtype=np.float32)
        has[owner[at], column[at] - start] = 1
        total += has @ has.T
    return total.astype(np.int64)


def links_of_group(group: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links that join the classes of one bucket's block, or of two of its blocks."""
    last = int(group["last"].iloc[0])
    block = group["block"].to_numpy()
    size = group["size"].to_numpy()
    _, root = np.unique([bytes(r).hex() for r in group["root"]], return_inverse=True)
    sketch = np.array(group["sketches"].tolist())
    wanted = np.triu(root[:, None] != root[None, :], 1)
    wanted &= np.minimum.outer(size, size) >= np.maximum.outer(size, size) * SIMILAR
    if int(group["low"].iloc[0]) != int(group["high"].iloc[0]):
        wanted &= block[:, None] != block[None, :]
    for k in range(last):  # a pair is compared where it meets first
        wanted &= sketch[:, k, None] != sketch[None, :, k]
    if not wanted.any():
        return []
    rows = np.flatnonzero(wanted.any(axis=0) | wanted.any(axis=1))
    wanted, size, root = wanted[np.ix_(rows, rows)], size[rows], root[rows]
    texts, keys = group["text"].iloc[rows], [bytes(k) for k in group["key"].iloc[rows]]
    shingles = [shingle_hashes(word_list(text)) for text in texts]
    shared = shared_shingles([label_occurrences(x) for x in shingles])
    # No alignment covers more than what is shared.
    i, j = np.nonzero(wanted & (shared >= SIMILAR * (np.add.outer(size, size) - shared)))
    classes, out = root.copy(), []
    for at in np.argsort(-shared[i, j] / (size[i] + size[j]), kind="stable"):
        x, y = int(i[at]), int(j[at])
        if classes[x] != classes[y] and aligned_share(shingles[x], shingles[y]) >= SIMILAR:
            classes[classes == classes[y]] = classes[x]
            out.append((keys[x], keys[y]))
    return out


def connect(links: DataFrame) -> DataFrame:
    """key and root (the least key of its class) for every linked key. Runs jobs at once."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.distinct(), "edges")
    roots = written(
        edges.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("key"), F.least("a", "m").alias("root")
        ),
        "roots",
    )
    while True:
        near = edges.join(roots.select(F.col("key").alias("b"), "root"), "b").groupBy("a")
        least = near.agg(F.min("root").alias("near")).withColumnRenamed("a", "key")
        lower = roots.join(least, "key").select(
            "key", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        # One more step along the root's own root halves the way.
        of_root = roots.select(F.col("key").alias("root"), F.col("root").alias("further"))
        step = written(
            lower.join(of_root, "root", "left").select(
                "key", "was", F.least("root", F.coalesce("further", "root")).alias("root")
            ),
            "roots",
        )
        roots = step.select("key", "root")
        if step.where(F.col("was") != F.col("root")).isEmpty():
            return roots


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, key, class_id`` (its least id), ``class_size`` and ``kept`` (has that id) per row."""
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = rows.where("text IS NOT NULL").select(text_key(F.col("text")).alias("key"), "text")
    roots = find_classes(texts)
    own = rows.select("id", text_key(F.col("text")).alias("key"), F.col("text").isNull().alias("none"))
    placed = own.join(roots, "key", "left").select(
        "id", "key", "none", F.coalesce("root", "key").alias("root")
    )
    # Null texts have one key, yet are no class.
    given = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    classes = placed.where("NOT none").groupBy("root").agg(
        F.min(given).alias("first"), F.count("*").alias("class_size")
    )
    found = placed.where("NOT none").join(classes, "root")
    first = F.struct(F.col("id").isNull().alias("last"), "id", "key") == F.col("first")
    alone = placed.where("none")
    return found.select(
        "id", "key", F.col("first.id").alias("class_id"), "class_size", first.alias("kept")
    ).unionByName(
        alone.select(
            "id", "key", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
            F.lit(True).alias("kept"),
        )
    )


def keep_one_each(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` with one row of each class: that of the least id."""
    kept = near_duplicates(df, id_column, text_column).where("kept")
    by = [F.col("id").alias("_kept_id"), F.col("key").alias("_kept_key")]
    rows = written(kept.groupBy(*by).agg(F.count("*").alias("_copies")), "kept")
    same = F.col(id_column).eqNullSafe(F.col("_kept_id")) & (
        text_key(F.col(text_column)) == F.col("_kept_key")
    )
    joined = df.join(rows, same)
    null_text = F.col(text_column).isNull()
    single = joined.where(null_text | (F.col("_copies") == 1)).select(df.columns)
    # Rows equal in id and text, of which the class keeps one.
    several = joined.where(~null_text & (F.col("_copies") > 1)).select(df.columns)
    return single.unionByName(several.dropDuplicates([id_column, text_column]))
