"""Chat formatting: conversations assembled at the level of tokens.

A turn is ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` and a line
feed. Role and text are encoded on their own, with special strings as ordinary
text, and the three marks are reserved ids after the vocabulary, spliced in
between: no content can make a mark. So that the written form is as clear,
control strings in content are escaped: a ``<`` that a ``|`` follows, with any
number of ``\\`` between, gets one more ``\\``. Taking one away gives the
content back.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import BYTE_LETTERS, default_vocabulary, encoder

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
MARKS = (START, SEPARATOR, END)
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


_DECODERS: dict[str, list] = {}


def _decoder(path: str) -> list:
    """The bytes of each id; the reserved ids follow those of the vocabulary."""
    if path not in _DECODERS:
        tokenizer = encoder(path, True).tokenizer
        byte = {c: b for b, c in enumerate(BYTE_LETTERS)}
        size = tokenizer.get_vocab_size()
        special = {i for i, t in tokenizer.get_added_tokens_decoder().items()}
        _DECODERS[path] = [t.encode() if i in special else bytes(byte[c] for c in t) for i in range(size) for t in [tokenizer.id_to_token(i)]]
    return _DECODERS[path]


def format_chat(turns: DataFrame, vocabulary: str | None = None, learn_role: str = "assistant") -> DataFrame:
    """Token ids and loss mask of every turn, in order.

    Takes ``conv_id, turn, role, text``. Returns ``conv_id, turn, start, ids,
    mask_start, mask_length``: ``start`` is the place of the turn's first id in
    its conversation (a running sum of lengths), and the ids under the loss mask
    are the ``mask_length`` ids from place ``mask_start`` of the conversation:
    the text of turns whose role is ``learn_role``, none for others. Turns are
    encoded where they lie, then dealt by conversation and assembled as a
    stream: a task holds a batch of turns, however long a conversation is.

    Null text or role: empty. Null conversation: one of its own. Turns with the
    same number, and repeated rows, stay, in the order of role and text. Empty
    table: no rows. Other columns are ignored.
    """
    path = vocabulary or default_vocabulary()
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def encode(batches):
        import pyarrow as pa

        coder = encoder(path, True)
        first = coder.tokenizer.get_vocab_size()
        start, separator, end = (np.array([first + i], "<u4") for i in range(3))
        line = coder.encoded(pa.array(["\n"]))[0]
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            r, rn = coder.encoded(pa.array(map(escaped, roles), pa.large_string()))
            t, tn = coder.encoded(pa.array(map(escaped, texts), pa.large_string()))
            r_end, t_end = np.cumsum(rn), np.cumsum(tn)
            ids = [np.concatenate([start, r[a - m : a], separator, t[b - n : b], end, line]).astype("<u4").tobytes() for a, m, b, n in zip(r_end, rn, t_end, tn)]
            learn = [x == learn_role for x in roles]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(ids, pa.binary()), pa.array(rn + 2), pa.array(np.where(learn, tn, 0).astype(np.int64))],
                names=["conv_id", "turn", "role", "text", "ids", "before", "mask_length"],
            )

    def assemble(batches):
        import pyarrow as pa

        conv, at = (), 0
        for batch in batches:
            starts = []
            for c, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if (c,) != conv:
                    conv, at = (c,), 0
                starts.append(at)
                at += len(ids) // 4
            starts = np.array(starts, np.int64)
            masks = starts + batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts), batch.column(2), pa.array(masks), batch.column(4)], names=["conv_id", "turn", "start", "ids", "mask_start", "mask_length"])

    pieces = rows.mapInArrow(encode, "conv_id long, turn long, role string, text string, ids binary, before long, mask_length long")
    # The ids of equal turns are equal, so they order ties as role and text would, without carrying these.
    dealt = pieces.select("conv_id", "turn", "ids", "before", "mask_length").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return dealt.mapInArrow(assemble, "conv_id long, turn long, start long, ids binary, mask_start long, mask_length long")


def read_chat(formatted: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Read conversations back from :func:`format_chat`'s ids and masks.

    Returns ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``. Rows must lie as ``format_chat`` returns them: each
    conversation whole and in order within a partition; a turn that does not begin
    where the one before it ended raises an error. The digests are taken
    as the turns go by.
    """
    path = vocabulary or default_vocabulary()

    def read(batches):
        import pyarrow as pa

        table = _decoder(path)
        start, separator, end = range(len(table), len(table) + 3)
        form = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def text(ids) -> str:
            return b"".join([table[i] for i in ids]).decode()

        conv, done, turns, loss, n, loss_chars, chars, place = (), [], None, None, 0, 0, 0, 0

        def close():
            done.append((conv[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def out():
            cols = list(zip(*done))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=form)

        for batch in batches:
            for c, at, raw, mask, length in zip(*(x.to_pylist() for x in batch.columns)):
                if (c,) != conv:
                    if conv:
                        close()
                    conv, turns, loss, n, loss_chars, chars, place = (c,), hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0
                ids = np.frombuffer(raw, "<u4").tolist()
                if at != place:
                    raise ValueError("the turns of a conversation do not follow each other")
                place += len(ids)
                s, e = ids.index(separator), len(ids) - 1 - ids[::-1].index(end)
                if ids[0] != start:
                    raise ValueError("a turn does not begin with its mark")
                role, said = text(ids[1:s]), text(ids[s + 1 : e])
                turns.update(f"{unescaped(role)}\n{unescaped(said)}\n".encode())
                chars += len(START) + len(role) + len(SEPARATOR) + len(said) + len(END) + len(text(ids[e + 1 :]))
                if length:
                    learnt = unescaped(text(ids[mask - at : mask - at + length]))
                    loss.update(learnt.encode())
                    loss_chars += len(learnt)
                n += 1
            if done:
                yield out()
                done = []
        if conv:
            close()
            yield out()

    return formatted.select("conv_id", "start", "ids", "mask_start", "mask_length").mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
