"""Token ids of texts by a public tokenizer, and checksums of id runs. Runs inside tasks.

The byte-level tokenizers used here cut a text at white space before they look for tokens, so a text
is encoded piece by piece: a piece is a run of ASCII spaces with the word that follows, or the word
alone where the tokenizer drops spaces and case. Frequent pieces come from a bounded memo of the
task's process. New pieces are joined, encoded together, and told apart by the bytes their tokens
stand for. Words of letters need neither the tokenizer's normalising nor its pattern: they go to its
merges directly, and a run of punctuation marks after such a word has ids of its own. Texts holding
other white space or the text of a special token are encoded whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer, pre_tokenizers  # noqa: E402
from tokenizers.normalizers import Sequence as Normalizers  # noqa: E402

from rillrank.llm.tasks import on_new_stage  # noqa: E402

MAX_PIECES = 3 << 18
GROUP_CHARS = 1 << 20
JOINED = 256
WORD_END = "</w>"
#: Letters up to U+024F, and runs of marks that every tokenizer here parts from the letters before them. Without the
#: apostrophe, which some take together with letters.
_LETTERS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])++"
_MARKS = rb"[!-&(-/:-@\[-`{-~]*+"
#: A word and the marks after it, where the tokenizer ends words itself, lower-cased, and where spaces begin them.
_ENDED_WORD = re.compile(rb"([a-z]++)" + _MARKS)
_SPACED_WORD = re.compile(rb"( " + _LETTERS + rb")" + _MARKS)

_PIECES = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Where one of these stands beside another space or at an end, pieces are found by pattern.
_ODD_SPACES = (b"  ", b"\n\n", b" \n", b"\n ", b"\t", b"\x0b", b"\x0c", b"\r", b"\x00")
#: White space beyond ASCII, and the ASCII separators that some engines count as white space.
_OTHER_SPACES = ("\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")


class Encoder:
    """Ids of texts. `end_id` is appended to each text; null texts are empty."""

    def __init__(self, path: str, end_id: int) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        self.word_ends = any(t.endswith(WORD_END) for t in names)
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        for token, i in names.items():
            self.bytes_of[i] = len(token.removesuffix(WORD_END) if self.word_ends else token)
        self.space = b" " if self.word_ends else b""
        self.letters = self._for_letters(path)
        self.word = _ENDED_WORD if self.word_ends else _SPACED_WORD
        self.known: dict[bytes, bytes] = {}

    def _for_letters(self, path: str) -> Tokenizer:
        """The tokenizer's merges for words of letters, which its pattern leaves whole."""
        out = Tokenizer.from_file(path)
        if self.word_ends:
            out.normalizer = Normalizers([])
            out.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        else:
            out.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
                pre_tokenizers.Split("\u0120", "merged_with_next")])
        return out

    def _cut(self, text: str | None) -> list[bytes] | None:
        """Pieces of a text; None if it must be encoded whole."""
        if not text:
            return []
        if any(x in text for x in (_OTHER_SPACES[:4] if text.isascii() else _OTHER_SPACES)) or any(
                x in text for x in self.special):
            return None
        raw = text.encode()
        if self.word_ends:
            return raw.lower().split()
        if raw[0] <= 0x20 or raw[-1] <= 0x20 or any(x in raw for x in _ODD_SPACES):
            return _PIECES.findall(raw)
        return raw.replace(b" ", b"\x00 ").replace(b"\n", b"\x00\n").split(b"\x00")

    def _joins(self, piece: bytes) -> bool:
        """Whether a piece keeps its tokens, and they its bytes, between others like it."""
        if not self.word_ends:
            return piece[0] in b" \t\n\x0b\x0c\r" and piece[-1] not in b" \t\n\x0b\x0c\r"
        if piece.isascii():
            return True
        text = piece.decode()
        return text == text.lower() and unicodedata.is_normalized("NFC", text)

    def _learn(self, pieces: list[bytes]) -> None:
        words, marked, joined, alone = [], [], [], []
        for p in pieces:
            if m := self.word.fullmatch(p):
                end = m.end(1)
                if end == len(p):
                    words.append(p)
                else:
                    marked.append((p, p[:end], p[end:]))
            elif self._joins(p):
                joined.append(p)
            else:
                alone.append(p)
        known = self.known
        known.update(self._joined(self.letters, words))
        unmarked = dict(self._joined(self.letters, list({core for _, core, _ in marked}.difference(known))))
        for p, core, marks in marked:
            if marks not in known:
                known[marks] = self._whole(marks.decode())
            known[p] = (unmarked.get(core) or known[core]) + known[marks]
        known.update(self._joined(self.tokenizer, joined))
        got = self.tokenizer.encode_batch_fast([p.decode() for p in alone], add_special_tokens=False)
        known.update(zip(alone, (np.array(x.ids, "<u4").tobytes() for x in got), strict=True))

    def _joined(self, tokenizer: Tokenizer, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Pieces and their ids, encoded in blocks; the bytes of the tokens tell where a piece ends."""
        blocks = [pieces[i:i + JOINED] for i in range(0, len(pieces), JOINED)]
        got = tokenizer.encode_batch_fast([self.space.join(b).decode() for b in blocks], add_special_tokens=False)
        for block, x in zip(blocks, got, strict=True):
            ids = np.array(x.ids, "<u4")
            lengths = np.fromiter(map(len, block), np.int64, len(block))
            ends = (4 * (np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(lengths)) + 1)).tolist()
            yield from zip(block, map(ids.tobytes().__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order, a group of texts at a time: pieces of one group are held at once."""
        group: list[str | None] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        cut = [self._cut(x) for x in texts]
        if len(self.known) > MAX_PIECES:
            self.known.clear()
        used = set().union(*filter(None, cut))
        self._learn(list(used.difference(self.known)))
        known = self.known.__getitem__
        for text, pieces in zip(texts, cut, strict=True):
            raw = self._whole(text) if pieces is None else b"".join(map(known, pieces))
            yield np.frombuffer(raw + self.end, "<u4")


@lru_cache(maxsize=4)
def encoder(path: str, end_id: int) -> Encoder:
    """The task process's encoder, kept between tasks of a stage."""
    return Encoder(path, end_id)


on_new_stage(encoder.cache_clear)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _times(matrix: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


def crc32_joined(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two runs of bytes from the crc32 of each: the first is moved on by the second's zero bytes."""
    matrix = [0xEDB88320, *[1 << i for i in range(31)]]  # one zero bit
    bits = second_bytes * 8
    while bits:
        if bits & 1:
            first = _times(matrix, first)
        matrix = [_times(matrix, row) for row in matrix]
        bits >>= 1
    return first ^ second
