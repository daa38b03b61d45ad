"""SentencePiece encoding and decoding with vocabularies of the merge type.

A text is encoded by an agenda: all adjacent pairs of symbols that make a piece
wait in order of their score, the best pair (the leftmost of equals) is joined,
and its new neighbours join the agenda. Spaces are written as a mark, and no
piece holds that mark behind another character; hence a text falls into chunks,
cut before each run of marks and around characters that no piece holds, and
each chunk is encoded once per worker. Every chunk that is encoded anew is checked
against the sentencepiece library, one Arrow batch at a time.

Defined results: a null text counts as empty; an empty text gives the end id alone;
texts of any length are encoded whole; rows are independent, so repeated rows give
equal results and an empty table an empty one; all columns are kept, and a column
named like a result is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwell.llm.common import once_per_process

MARK = "▁"
#: Chunks kept per worker and generation, and the longest chunk worth keeping.
KEPT_CHUNKS = 150_000
KEPT_LENGTH = 64
TEXTS = 200  # texts that are encoded and decoded at a time
SHORT = 40  # symbols of a chunk up to which its agenda is a plain list
CHECKED = 32  # chunks that the library is given together


class Kept(dict):
    """Results by chunk; when full, only those of the last generation and this one stay."""

    older: dict = {}

    def keep(self, chunk: str, ids: tuple[int, ...]) -> None:
        if len(chunk) <= KEPT_LENGTH:
            if len(self) >= KEPT_CHUNKS:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids


class PieceCodec:
    """Encodes and decodes with the pieces and scores of a sentencepiece model."""

    def __init__(self, model: bytes, check: bool = True):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib, size = self.library, self.library.get_piece_size()
        if any(lib.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not supported")
        special = [i for i in range(size) if lib.is_control(i) or lib.is_unknown(i)]
        self.bytes = {int(lib.id_to_piece(i)[1:-1], 16): i for i in range(size) if lib.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model needs a piece for every byte")
        plain = set(range(size)) - set(special) - set(self.bytes.values())
        self.ids = {lib.id_to_piece(i): i for i in sorted(plain)}
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece goes on over a space")
        self.symbols = {piece: i for piece, i in self.ids.items() if len(piece) == 1}
        self.scores = {piece: lib.get_score(i) for piece, i in self.ids.items()}
        self.end = lib.eos_id()
        self.spelled = [b""] * size
        for piece, i in self.ids.items():
            self.spelled[i] = piece.replace(MARK, " ").encode()
        for byte, i in self.bytes.items():
            self.spelled[i] = bytes([byte])
        self.spelled[lib.unk_id()] = " ⁇ ".encode()
        # One object per id, so that what is kept has no numbers of its own.
        self.numbers = list(range(size))
        if any(x not in self.ids for piece in self.ids for x in piece):
            raise ValueError("a character of a piece is no piece itself")
        self._index_merges()
        self.chunks = re.compile(self._chunk_pattern()).findall
        self.check = check
        self.before = lib.encode("\n") if self.line_alone else []
        self.known, self.words = Kept(), Kept()
        self.unchecked: list[tuple[str, tuple[int, ...]]] = []

    def _index_merges(self) -> None:
        """For each piece, the pieces that it makes with those behind it, under their ranks by score."""
        order = sorted({-score for score in self.scores.values()})
        rank_of = {score: rank for rank, score in enumerate(order)}
        self.bits = len(self.spelled).bit_length()
        # One more row, for characters that are no piece.
        self.joined: list[dict[int, int]] = [{} for _ in range(len(self.spelled) + 1)]
        for piece, i in self.ids.items():
            ranked = rank_of[-self.scores[piece]] << self.bits | i
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    self.joined[left][right] = ranked
        made = {ranked for row in self.joined for ranked in row.values()}
        often = Counter(ranked >> self.bits for ranked in made)
        self.tied = {ranked for ranked in made if often[ranked >> self.bits] > 1}

    def _chunk_pattern(self) -> str:
        """Cuts a text where no piece reaches over: at marks, line feeds and signs after letters."""
        meet = {pair for piece in self.ids for pair in zip(piece, piece[1:], strict=False)}
        signs = {c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "_"}
        signs -= {b for a, b in meet if a.isalpha()}
        # A line feed stands in no piece, so that pairs never reach over it.
        self.line_alone = "\n" not in "".join(self.ids)
        line = r"\n" if self.line_alone else ""
        ends = "".join(map(re.escape, sorted(signs)))
        cuts = [r"\n+"] * self.line_alone
        cuts += [rf"{MARK}*[^\W\d_]+(?=[{ends}])"] if signs else []
        return "|".join([*cuts, f"{MARK}*[^{MARK}{line}]+", f"{MARK}+"])

    def merge(self, chunk: str) -> tuple[int, ...]:
        """The ids of a chunk, by the agenda."""
        symbols = list(map(self.symbols.get, chunk))
        if len(symbols) <= SHORT and None not in symbols:
            return self._merge_short(symbols)
        unknown = len(self.spelled)
        return self._merge_long(chunk, [unknown if s is None else s for s in symbols])

    def _merge_short(self, symbols: list[int]) -> tuple[int, ...]:
        """The agenda as a list by place: what each symbol makes with the next one, under its rank."""
        joined, tied, piece_of = self.joined, self.tied, (1 << self.bits) - 1
        none = len(self.spelled) << self.bits
        agenda = [joined[a].get(b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := min(agenda)) != none:
            i = agenda.index(best)  # the leftmost of equals
            if best in tied:
                rank = best >> self.bits
                i = next(k for k, ranked in enumerate(agenda) if ranked >> self.bits == rank)
                best = agenda[i]
            piece = symbols[i] = best & piece_of
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = joined[piece].get(symbols[i + 1], none)
            if i:
                agenda[i - 1] = joined[symbols[i - 1]].get(piece, none)
        return tuple(symbols)

    def _merge_long(self, chunk: str, symbols: list[int | None]) -> tuple[int, ...]:
        """The agenda as a heap; an entry is a rank and the left symbol's place."""
        joined, bits, unknown = self.joined, self.bits, len(self.spelled)
        piece_of = (1 << bits) - 1
        n = len(symbols)
        shift = n.bit_length()
        places = (1 << shift) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        i, left = 0, symbols[0]
        for right in symbols[1:]:
            ranked = joined[left].get(right)
            if ranked is not None:
                agenda.append(ranked >> bits << shift | i)
            i, left = i + 1, right
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & places
            j = after[i]
            if j == n or symbols[i] is None:
                continue
            ranked = joined[symbols[i]].get(symbols[j])
            if ranked is None or ranked >> bits != entry >> shift:
                continue  # either symbol has been joined to another meanwhile
            piece = ranked & piece_of
            symbols[i], symbols[j] = piece, None
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                longer = joined[piece].get(symbols[j])
                if longer is not None:
                    heappush(agenda, longer >> bits << shift | i)
            j = before[i]
            if j >= 0:
                longer = joined[symbols[j]].get(piece)
                if longer is not None:
                    heappush(agenda, longer >> bits << shift | j)
        if unknown not in symbols:
            return tuple([s for s in symbols if s is not None])
        out: list[int] = []
        for place, symbol in enumerate(symbols):
            if symbol == unknown:
                out += [self.bytes[b] for b in chunk[place].encode()]
            elif symbol is not None:
                out.append(symbol)
        return tuple(out)

    def _anew(self, chunk: str) -> tuple[int, ...]:
        ids = tuple(map(self.numbers.__getitem__, self.merge(chunk)))
        if self.check:
            self.unchecked.append((chunk, ids))
        return ids

    def _of_chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk that holds no place to cut; behind a mark it is a word, and kept as such."""
        kept, key = (self.words, chunk[1:]) if chunk[0] == MARK else (self.known, chunk)
        ids = kept.get(key)
        if ids is None:
            ids = kept.older.get(key) or self._anew(chunk)
            kept.keep(key, ids)
        return ids

    def _of_word(self, word: str) -> tuple[int, ...]:
        """Ids of a space and what follows up to the next space, which this dictionary does not hold."""
        ids = self.words.older.get(word)
        if ids is None:
            # Letters alone hold no place to cut.
            chunks = [MARK + word] if word.isalpha() else self.chunks(MARK + word)
            if len(chunks) == 1:
                ids = self._anew(chunks[0])
            else:
                ids = tuple([i for chunk in chunks for i in self._of_chunk(chunk)])
        self.words.keep(word, ids)
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without the end id."""
        out: list[int] = []
        if not text:
            return out
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            for chunk in self.chunks(MARK + text.replace(" ", MARK)):
                out += self._of_chunk(chunk)
            return out
        known = self.words.get
        for word in text.split(" "):
            out += known(word) or self._of_word(word)
        return out

    def compare(self) -> None:
        """Hold the chunks encoded since the last call against the library."""
        if not self.unchecked:
            return
        if self.line_alone:
            # Nothing reaches over a line feed, so that chunks on lines of their own are told apart.
            line, parts = self.bytes[10], []
            for start in range(0, len(self.unchecked), CHECKED):
                some = self.unchecked[start : start + CHECKED]
                wanted = self.before[:-1]
                for _, ids in some:
                    wanted.append(line)
                    wanted += ids
                parts.append(("\n" + "\n".join([c for c, _ in some]).replace(MARK, " "), wanted, some))
            got = self.library.encode([text for text, _, _ in parts], num_threads=1)
            doubtful = [x for theirs, (_, wanted, some) in zip(got, parts, strict=True) if theirs != wanted for x in some]
        else:
            doubtful = self.unchecked
        lead, skip = "\n" if self.line_alone else "", len(self.before)
        for chunk, ids in doubtful:
            # Where lines do not stand alone the library itself puts a mark in front.
            plain = chunk if self.line_alone else chunk[1:]
            theirs = self.library.encode(lead + plain.replace(MARK, " "))[skip:]
            if tuple(theirs) != ids:
                raise ValueError(f"the library encodes {chunk!r} as {theirs}, not {ids}")
        if doubtful and self.line_alone:
            raise ValueError("the library encodes chunks otherwise where they follow each other")
        self.unchecked = []

    def decode(self, ids: list[int]) -> str:
        """The text of some ids: pieces and bytes joined, without the mark put in front."""
        spelled = self.spelled
        raw = b"".join(map(spelled.__getitem__, ids))
        first = next((i for i in ids if i != self.end), None)
        if raw[:1] == b" " and first not in (None, self.bytes[32]):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self.library.decode(ids)


def codec_of(model: bytes, check: bool = True) -> PieceCodec:
    """The codec of a model, made once per process."""
    key = ("pieces", hashlib.sha256(model).digest(), check)
    return once_per_process(key, lambda: PieceCodec(model, check))


def read_model(path: str) -> bytes:
    """A tokenizer file, read where the job is planned and sent along (below a megabyte)."""
    with open(path, "rb") as file:
        return file.read()


def encode_texts(df: DataFrame, model: bytes, column: str = "text", check: bool = True) -> DataFrame:
    """``df`` with ``ids``: those of the whole text and the end id."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(model, check)
        for texts in batches:
            out = [[*codec.encode(text or ""), codec.end] for text in texts]
            codec.compare()
            yield pd.Series(out)

    return df.withColumn("ids", ids_of(F.col(column)))


def decode_ids(df: DataFrame, model: bytes, column: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the text of its ids; null ids give an empty text."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(model, False)
        for rows in batches:
            yield pd.Series([codec.decode([] if r is None else list(r)) for r in rows], dtype=object)

    return df.withColumn("decoded", text_of(F.col(column)))


def encode_and_decode(
    df: DataFrame, model: bytes, column: str = "text", check: bool = True
) -> DataFrame:
    """``df`` with ``ids`` and ``decoded``, as of ``encode_texts`` and ``decode_ids``, in one step.

    Texts are taken TEXTS at a time, and ids are held as an Arrow array, so that a task needs room for
    those of a few texts only. Columns named like a result are replaced; ``column`` is none of these.
    """
    kept = df.drop("ids", "decoded")
    at = kept.columns.index(column)
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    names = [*kept.columns, "ids", "decoded"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model, check)
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                ids, decoded = [], []
                for text in part.column(at).to_pylist():
                    row = [*codec.encode(text or ""), codec.end]
                    ids.append(np.array(row, dtype=np.int32))
                    decoded.append(codec.decode(row))
                codec.compare()
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.concatenate(ids))
                columns = [*part.columns, lists, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return kept.mapInArrow(coded, T.StructType([*kept.schema.fields, *added]))


def piece_digests(df: DataFrame, model: bytes, column: str = "text", check: bool = True) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoding and decoding.

    Both steps meet in one task here, so that no ids travel.
    """
    fields = T.StructType(
        [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    @F.pandas_udf(fields)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = codec_of(model, check)
        names = [str(i) for i in range(codec.library.get_piece_size())]
        for texts in batches:
            rows = []
            for text in texts:
                ids = [*codec.encode(text or ""), codec.end]
                spelled = " ".join(map(names.__getitem__, ids))
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(spelled.encode()).hexdigest(),
                        hashlib.sha256(codec.decode(ids).encode()).hexdigest(),
                    )
                )
            codec.compare()
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    out = df.withColumn("_digests", digests(F.col(column)))
    for name in fields.names:
        out = out.withColumn(name, F.col(f"_digests.{name}"))
    return out.drop("_digests")
