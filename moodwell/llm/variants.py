"""Spelling variants: words one letter apart, by pairs of trie nodes.

All words are put in order and read once: a node of their trie is a prefix that was not met
before, and gets the next number. The same is done with the words reversed, whose nodes are
suffixes. Each range of the order is read by a task of its own; what the first word of a range
shares with the last one before it goes on under the numbers that the range before gave.

A place in a word is a pair of integers: the node of what comes before and the node of what comes
behind. Words that agree in the pair around a *skipped* letter differ in that letter alone; a word
whose pair at a *gap*, with nothing skipped, equals the pair around a skipped letter of another
lacks just that letter. So one grouping by pairs gives exactly the words that are one replaced,
inserted or deleted letter apart: no more, since nodes are numbered and not hashed, and no fewer. Of
equal letters in a row only the first is skipped for a gap, hence each two words meet once. A pair
has at most one word per letter of the alphabet and one for the gap, and travels as three
integers, however long its words are.

A word's form is the near word that occurs most often, if that is often enough; roots are found
by doubling the steps from form to form, a few joins since counts double at each step.

Defined results: null and empty texts have no words; the words of a null id are counted as they
stand; repeated rows count as often as they occur; an empty table gives an empty result; texts are
read whole; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwell.llm.common import written

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A form occurs so many times as often as its variant, at least.
OFTEN = 2
#: Different words that a task counts before it sends their counts on.
HELD_WORDS = 500_000

GAP, SKIPPED, SKIPPED_AGAIN = 0, 1, 2


def _counter(least: int, slips: int | None) -> Callable:
    held = HELD_WORDS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile("[a-zÀ-ÿ]{%d,}" % least).findall
        totals: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"]
            )
            totals.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # As bytes, only A to Z get lower case.
                found = find(text.encode().lower().decode())
                if slips is None or doc_id is None:
                    totals.update(found)
                else:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for word, n in Counter(found).items():
                        key = zlib.crc32(word.encode(), start)
                        if key % slips == 0:
                            at = key % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        totals[word] += n
                if len(totals) >= held:
                    yield flush()
        yield flush()

    return count


def count_words(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = LEAST_LETTERS,
    slips: int | None = None,
) -> DataFrame:
    """``word, n`` of the words with ``least`` letters or more, A to Z in lower case.

    With ``slips``, the words of a text whose checksum that number divides lose the letter that the
    checksum points to, before they are counted.
    """
    read = df.where(F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text")
    )
    partial = read.mapInArrow(_counter(least, slips), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _shared(a: str, b: str) -> int:
    """Letters that two words share at their start."""
    k = 0
    for x, y in zip(a, b):
        if x != y:
            break
        k += 1
    return k


def _numberer(shared: Callable[[str, str], int]) -> Callable:
    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        top = part << 40
        before, path = "", [0]
        for batch in batches:
            nodes = []
            for word in batch["word"]:
                known = shared(before, word)
                new = len(word) - known
                path = path[: known + 1] + list(range(top + 1, top + 1 + new))
                top += new
                before = word
                nodes.append(path)
            yield pd.DataFrame({"part": part, "id": batch["id"], "word": batch["word"], "nodes": nodes})

    return number


def trie_paths(words: DataFrame, name: str) -> DataFrame:
    """``id, nodes``: the numbers of the nodes on the way along each word, from the root, which is 0.

    Runs jobs at once. Of each range of words two words and one path reach the driver.
    """
    fields = "part int, id long, word string, nodes array<long>"
    ordered = words.select("id", "word").repartitionByRange("word").sortWithinPartitions("word")
    numbered = written(ordered.mapInPandas(_numberer(_shared), fields), name)
    edges = numbered.groupBy("part").agg(
        F.min("word").alias("first"), F.max("word").alias("last"), F.max_by("nodes", "word").alias("path")
    )
    goes_on, before, path = [], "", [0]
    for r in sorted(edges.collect(), key=lambda r: r.part):
        taken = path[: _shared(before, r.first) + 1]
        goes_on.append((r.part, taken))
        kept = min(len(taken) - 1, _shared(r.first, r.last))
        before, path = r.last, taken[: kept + 1] + r.path[kept + 1 :]
    # A row for each range.
    taken = words.sparkSession.createDataFrame(goes_on, "part int, taken array<long>")
    own = F.shiftleft(F.col("part").cast("long"), 40)
    # The nodes of a range's first word are those with its first numbers.
    nodes = F.transform(
        "nodes",
        lambda node, depth: F.when(
            (depth < F.size("taken")) & (node == own + depth), F.get("taken", depth)
        ).otherwise(node),
    )
    return numbered.join(F.broadcast(taken), "part").select("id", nodes.alias("nodes"))


def near_words(words: DataFrame) -> DataFrame:
    """``id, n_near, best``: how many words are one letter apart, and the least id of these.

    ``words`` has a unique ``id`` and a unique ``word``. Words without any have no row. Runs jobs.
    """
    heads = trie_paths(words, "prefix-nodes").withColumnRenamed("nodes", "heads")
    turned = words.select("id", F.reverse("word").alias("word"))
    tails = trie_paths(turned, "suffix-nodes").withColumnRenamed("nodes", "tails")
    paths = heads.join(tails, "id").join(words.select("id", "word"), "id")
    length = F.char_length("word")

    def place(i, behind, kind):
        return F.struct(
            F.get("heads", i).alias("head"),
            F.get("tails", (length - behind).cast("int")).alias("tail"),
            kind.cast("byte").alias("kind"),
        )

    gaps = F.transform(F.sequence(F.lit(0), length), lambda i: place(i, i, F.lit(GAP)))
    again = lambda i: (i > 0) & (F.substring("word", i, F.lit(1)) == F.substring("word", i + 1, F.lit(1)))
    skips = F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: place(i, i + 1, F.when(again(i), SKIPPED_AGAIN).otherwise(SKIPPED)),
    )
    places = paths.select("id", F.inline(F.concat(gaps, skips)))
    met = (
        places.groupBy("head", "tail")
        .agg(F.sort_array(F.collect_list(F.struct("id", "kind"))).alias("words"))
        .where(F.size("words") > 1)
    )

    def near(a, b):
        both = (a["kind"] > GAP) & (b["kind"] > GAP) & (a["id"] != b["id"])
        return both | ((a["kind"] == GAP) & (b["kind"] == SKIPPED)) | ((a["kind"] == SKIPPED) & (b["kind"] == GAP))

    found = F.transform(
        "words", lambda a: F.struct(a["id"].alias("id"), F.filter("words", lambda b: near(a, b)).alias("others"))
    )
    ones = met.select(F.inline(found)).select(
        "id", F.size("others").alias("n"), F.get("others", F.lit(0))["id"].alias("best")
    )
    return ones.where("n > 0").groupBy("id").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def follow(links: DataFrame) -> DataFrame:
    """``id, root``: the last id on the way from each ``id`` over ``next``; without circles. Runs jobs."""
    ways = written(links.select("id", F.col("next").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("id").alias("root"), F.col("root").alias("further"))
        step = ways.join(ahead, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        step = written(step, "ways")
        ways = step.drop("moved")
        if step.where("moved").isEmpty():
            return ways


def group_variants(counts: DataFrame, least_count: int = LEAST_COUNT, often: int = OFTEN) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words that occur ``least_count`` times or more.

    ``counts`` has unique words with their ``n``. Runs jobs at once.
    """
    kept = written(counts.where(F.col("n") >= least_count), "word-counts")
    # Numbered in this order, the least of some ids is the word to prefer.
    ranked = kept.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("id"), "word", "n")
    words = written(ranked, "ranked-words")
    near = written(near_words(words), "near-words")
    form = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    told = words.join(near, "id").join(form, "best")
    formed = written(
        told.select(
            "id", "n_near", *[F.when(F.col("form_n") >= often * F.col("n"), F.col(c)).alias(c) for c in ("best", "form", "form_n")]
        ),
        "word-forms",
    )
    roots = follow(formed.where(F.col("best").isNotNull()).select("id", F.col("best").alias("next")))
    named = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("last")), "root").drop("root")
    return words.join(formed, "id", "left").join(named, "id", "left").select(
        "word",
        "form",
        F.coalesce("last", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
