"""Chat formatting by token-level assembly.

Each turn becomes a start id, the tokens of its role, a separator id, the tokens of
its text and an end id. Role and text are encoded separately by a byte-level vocabulary,
which loses nothing, and the reserved ids are spliced in between. In a role or text, a
control string gets a backslash behind its first character (one more, if
it has some already), so that it is no control string any more; reading removes it. The
loss mask is the prefix sum of +1 where an assistant's text starts and -1 where it ends.

Defined results: null texts and roles count as empty; turns are in order of turn, role and
text, null turns first; repeated rows are turns of their own; a null conversation is
one of its own; an empty table gives an empty result; other columns are not read.
A turn is encoded where it is read, and a conversation's turns meet in one
task, which holds one Arrow batch of them at a time, however long the conversation.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwell.llm.common import once_per_process

START, END, ASKED, ANSWERED = CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]"]
_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")


def escape(text: str) -> str:
    """``text`` without control strings; ``unescape`` gives it back."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def encoding_of(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, made once per process."""

    def make() -> tiktoken.Encoding:
        pairs = map(bytes.split, ranks.splitlines())
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        return tiktoken.Encoding(
            "turns", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )

    return once_per_process(("ranks", hashlib.sha256(ranks).digest(), pattern), make)


def turn_ids(encoding: tiktoken.Encoding, role: str, text: str) -> tuple[list[int], np.ndarray]:
    """Ids of one turn, and which of them count for the loss."""
    first = encoding.n_vocab
    start, end, asked, answered = range(first, first + len(CONTROLS))
    said, by_assistant = encoding.encode_ordinary(escape(text)), role == "assistant"
    head = [start, *encoding.encode_ordinary(escape(role)), answered if by_assistant else asked]
    ids = [*head, *said, end]
    steps = np.zeros(len(ids) + 1, dtype=np.int64)
    if by_assistant:
        steps[len(head)] += 1
        steps[len(head) + len(said)] -= 1
    return ids, np.cumsum(steps)[:-1].astype(bool)


def format_turns(df: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``conv_id, turn, ids, loss_mask`` of each turn, in the order of the rows."""
    kind = df.schema["conv_id"].dataType.simpleString()
    turn = df.schema["turn"].dataType.simpleString()

    def assemble(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = encoding_of(ranks, pattern)
        for frame in frames:
            made = [
                turn_ids(encoding, role, text)
                for role, text in zip(frame["role"], frame["text"], strict=True)
            ]
            frame["ids"] = [ids for ids, _ in made]
            frame["loss_mask"] = [mask for _, mask in made]
            yield frame

    rows = df.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    )
    fields = f"conv_id {kind}, turn {turn}, role string, text string, "
    return rows.mapInPandas(assemble, fields + "ids array<int>, loss_mask array<boolean>")


class Reader:
    """Takes the tokens of one conversation in order and gathers what can be read from them."""

    def __init__(self, encoding: tiktoken.Encoding):
        self.encoding = encoding
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def take(self, ids: np.ndarray, mask: np.ndarray) -> None:
        """The tokens of one or more whole turns."""
        first = self.encoding.n_vocab
        texts, at = [], 0
        for stop in np.flatnonzero(ids >= first):
            segment = self.encoding.decode(ids[at:stop].tolist())
            control, counted = CONTROLS[ids[stop] - first], mask[at:stop].any()
            self.formatted_chars += len(segment) + len(control)
            plain, at = unescape(segment), stop + 1
            if counted:
                self.loss.update(plain.encode())
                self.loss_chars += len(plain)
            if control != START:
                texts.append(plain)
            if control == END:
                role, text = texts
                self.turns.update(f"{role}\n{text}\n".encode())
                self.n_turns, texts = self.n_turns + 1, []


def read_back(turns: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """One row per conversation, read from the tokens and masks of ``format_turns``."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = encoding_of(ranks, pattern)
        reader, current, done = None, None, []

        def finished() -> tuple:
            shown = [reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest()]
            return (current, reader.n_turns, *shown, reader.formatted_chars)

        def as_frame() -> pd.DataFrame:
            frame = pd.DataFrame(done, columns=names)
            frame["conv_id"] = pd.array(frame["conv_id"], dtype="Int64" if whole else object)
            return frame

        for frame in frames:
            missing = frame["missing"].to_numpy()
            convs = frame["conv_id"].tolist()
            for k, (ids, mask) in enumerate(zip(frame["ids"], frame["loss_mask"], strict=True)):
                conv = None if missing[k] else int(convs[k]) if whole else convs[k]
                if reader is None or conv != current:
                    if reader is not None:
                        done.append(finished())
                    reader, current = Reader(encoding), conv
                reader.take(np.asarray(ids), np.asarray(mask))
            if done:
                yield as_frame()
                done = []
        if reader is not None:
            done.append(finished())
            yield as_frame()

    whole = kind in ("bigint", "int", "smallint", "tinyint")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    fields = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    together = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    columns = ["conv_id", F.col("conv_id").isNull().alias("missing"), "ids", "loss_mask"]
    return together.select(*columns).mapInPandas(gather, fields)
