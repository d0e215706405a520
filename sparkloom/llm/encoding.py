"""Exact, memoised encoding with the public vocabularies of ``tokenizers``.

A byte-level pre-tokenizer never makes a token that crosses from a character
that is not white space into one that is. A text may therefore be cut before
any white space that follows something else, and the ids of its parts, put
together, are the ids of the text. Most parts are words that come again and
again: a batch is cut and reduced to its distinct parts by Arrow, and a worker
keeps what the library gave for each part and pre-token, so the library's own
model works on new words only. Other kinds of vocabulary get whole texts.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

from .common import CACHES

#: Two white space characters in a row (any that Python or Unicode calls so): such a text takes the careful cut.
_RUN = r"[\s\p{Z}\x{85}\x{b}\x{1c}-\x{1f}]{2}"
#: The careful cut: before white space that follows something else.
_SAFE = re.compile(r"(?<=\S)(?=\s)")
#: Fixed value: the pre-tokenizer's pattern for byte-level vocabularies, as the vocabulary files' description has it.
_PRE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: ASCII signs that end a word and make one pre-token of their own (not the apostrophe of contractions).
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> str:
    """The letter that stands for each byte: itself where it can be printed, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return "".join(letters[b] for b in range(256))


BYTE_LETTERS = _byte_letters()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def safe_chunks(text: str, size: int):
    """Cut a long text into pieces of about ``size`` code points.

    Each cut is before white space that follows something else; where there is
    none the piece goes on, so a text without white space stays whole.
    """
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Encoder:
    """Ids of texts, as the ``tokenizers`` library gives them.

    ``literal``: strings of special tokens in a text are ordinary text;
    otherwise they are handled as the library does by default.
    ``entries``: about how many pre-tokens are kept. They are in two halves: when the new
    one is full it becomes the old one, and what is met again moves to the new one, so common ones stay.
    """

    def __init__(self, path: str, literal: bool = False, entries: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if literal:
            self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        pre = made.get("pre_tokenizer") or {}
        self.by_parts = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not made.get("normalizer") and not made.get("truncation") and not made.get("padding")
        added = [t["content"] for t in made.get("added_tokens", []) if not (literal and t["special"])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.model, self.pre = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.kept, self.old, self.entries = {}, {}, entries
        import regex

        self.pattern = regex.compile(_PRE)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """Ids of a pre-token that is not among the new ones."""
        ids = self.old.get(word)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(BYTE_LETTERS))]).tobytes()
        if len(word) <= 48:
            self.kept[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        """Ids of any part."""
        if not part:
            return b""
        if self.added and self.added.search(part):
            return self._whole([part])[0]
        if max(part) < "\u0250":  # letters and numbers that every version of Unicode knows
            words = self.pattern.findall(part)
        else:
            words = [part[a:b] for _, (a, b) in self.pre.pre_tokenize_str(part)]
        return b"".join([self.kept.get(w) or self._word(w) for w in words])

    def _values(self, keys: list[str]) -> list[bytes]:
        """Ids of the parts that keys stand for; the common kind, a word with signs after it, is cut here."""
        out = []
        for at in range(0, len(keys), 20_000):
            if len(self.kept) > self.entries // 2:
                self.old, self.kept = self.kept, {}
            self._more(keys[at : at + 20_000], out)
        return out

    def _more(self, keys: list[str], out: list[bytes]) -> None:
        kept = self.kept.get
        for k in keys:
            core = k.rstrip(_SIGNS)
            if core.isalpha() and (core.isascii() or max(core) < "\u0250"):
                word = " " + core
                ids = kept(word) or self._word(word)
                if len(core) < len(k):
                    word = k[len(core) :]
                    ids += kept(word) or self._word(word)
                out.append(ids)
            else:
                head = k[:1]
                out.append(self._part(k if head == "\n" else k[1:] if head == "\r" else " " + k))

    def _cut(self, texts):
        """(which texts take the careful cut or None, offsets of the keys of each text, distinct keys, which of them each key is).

        A key is a part without its leading space, with its leading line feed,
        or, for the first part of a text, with a carriage return before it.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        odd = pc.match_substring_regex(texts, _RUN)
        odd = odd if pc.any(odd).as_py() else None
        plain = texts if odd is None else pc.if_else(odd, pa.scalar("", pa.large_string()), texts)
        marked = pc.binary_join_element_wise(pa.scalar("\r", pa.large_string()), pc.replace_substring(plain, "\n", " \n"), pa.scalar("", pa.large_string()))
        cut = pc.split_pattern(marked, " ")
        keys = cut.values.dictionary_encode()
        return None if odd is None else np.flatnonzero(odd.to_numpy(zero_copy_only=False)), cut.offsets.to_numpy(), keys.dictionary.to_pylist(), keys.indices.to_numpy(zero_copy_only=False)

    def encoded(self, texts):
        """(ids of all texts in a row, number of ids of each text) for an Arrow array of texts without nulls."""
        import pyarrow as pa

        texts = texts.cast(pa.large_string())
        if not len(texts):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        if not self.by_parts:
            ids = self._whole(texts.to_pylist())
            return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)
        odd, offsets, keys, which = self._cut(texts)
        values = self._values(keys)
        size = np.fromiter(map(len, values), np.int64, len(values)) >> 2
        flat = np.frombuffer(b"".join(values), "<u4")
        del keys, values
        sizes = size[which]
        # Places in a batch are small numbers as a rule, and half as wide then.
        ends = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        per_text = ends[offsets[1:]] - ends[offsets[:-1]]
        kind = np.int32 if ends[-1] < 1 << 31 and len(flat) < 1 << 31 else np.int64
        take = np.repeat(((np.cumsum(size) - size)[which] - ends[:-1]).astype(kind), sizes)
        take += np.arange(ends[-1], dtype=kind)
        ids = flat[take]
        if odd is None:
            return ids, per_text
        starts = np.concatenate([[0], np.cumsum(per_text)])
        out, at = [], 0
        for i in odd:
            out.append(ids[starts[at] : starts[i]].tobytes())
            careful = b"".join(map(self._part, _SAFE.split(texts[int(i)].as_py())))
            out.append(careful)
            per_text[i] = len(careful) // 4
            at = i + 1
        out.append(ids[starts[at] :].tobytes())
        return np.frombuffer(b"".join(out), "<u4"), per_text

    def lengths(self, texts) -> np.ndarray:
        """The number of ids of each text, without making the ids of a batch."""
        import pyarrow as pa

        texts = texts.cast(pa.large_string())
        if not len(texts) or not self.by_parts:
            return self.encoded(texts)[1]
        odd, offsets, keys, which = self._cut(texts)
        size = np.fromiter(map(len, self._values(keys)), np.int64, len(keys)) >> 2
        ends = np.concatenate([[0], np.cumsum(size[which])])
        per_text = ends[offsets[1:]] - ends[offsets[:-1]]
        for i in [] if odd is None else odd:
            per_text[i] = sum(len(self._part(p)) for p in _SAFE.split(texts[int(i)].as_py())) // 4
        return per_text


_ENCODERS: dict[tuple, Encoder] = {}
CACHES.append(_ENCODERS)


def encoder(path: str, literal: bool = False) -> Encoder:
    """One encoder for each Python worker and setting; workers are used again."""
    key = (path, literal)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, literal)
    return _ENCODERS[key]


def balanced(sizes: np.ndarray, most: int):
    """Ranges of consecutive rows whose sizes add up to about ``most`` each."""
    start, total = 0, 0
    for i, s in enumerate(sizes.tolist()):
        total += s
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)
