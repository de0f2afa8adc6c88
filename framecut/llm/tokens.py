"""Token ids of whole texts, one encoding per different word of a task.

A text is cut at places where the tokenizer is sure to cut as well: at a
single space or line feed between two characters that are not white space.
The pieces of a batch are dictionary-encoded by Arrow, every different piece
is encoded once, and the ids are gathered back by numpy.  Pieces seen before
in the same Python worker come from a memo of bounded size.  Texts whose
white space is laid out in any other way are encoded as a whole, so the ids
are always those of the tokenizers library for the whole text.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers; about 200 bytes each.
MEMO = 1_000_000
#: Bytes of text encoded at a time.
PORTION = 6 << 20
#: Id that ends a document.
END_ID = 2
#: White space at an end of a text or next to other white space; special tokens; NUL.
_ODD_SPACE = r"\x00|^[\s\p{Z}\x0b\x1c-\x1f\x{85}]|[\s\p{Z}\x0b\x1c-\x1f\x{85}]{2}|[\s\p{Z}\x0b\x1c-\x1f\x{85}]$|\|>"
_TAIL = frozenset(".,;:!?")


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class TextEncoder:
    """Ids of the texts of an Arrow column, by a tokenizer file.

    ``spaced``: a word's piece carries the space before it (byte-level BPE);
    otherwise white space only separates and letters are lower-cased.
    """

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = self.tokenizer.normalizer is None
        self.bytes = _byte_alphabet()
        self.memo: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.most = memo

    def _word(self, word: str) -> bytes:
        """Ids of letters (with a space before them, if spaced) as 32-bit integers."""
        if not self.spaced:
            word = word.lower()
        if word.isascii():  # of these only a space has a stand-in
            mapped = word.replace(" ", self.bytes[32])
        else:
            mapped = word.encode().decode("latin-1").translate(self.bytes)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece as 32-bit integers; Latin words and a mark after them go straight to the model."""
        mark = piece[-1:] if piece[-1:] in _TAIL else ""
        word = piece[:-1] if mark else piece
        body = word[1:] if self.spaced and word[:1] == " " else word
        if body.isalpha() and (body.isascii() or max(body) < "ɐ" and "İ" not in body):
            if not mark:
                return self._word(word)
            ids = self.memo.get(word)
            if ids is None:
                ids = self._word(word)
                if len(self.memo) < self.most:
                    self.memo[word] = ids
            if mark not in self.marks:
                self.marks[mark] = self._word(mark)
            return ids + self.marks[mark]
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the number of ids of each."""
        coded = words.dictionary_encode()
        memo, piece, got = self.memo, self._piece, []
        for word in coded.dictionary.to_pylist():
            ids = memo.get(word)
            if ids is None:
                ids = piece(word)
                if len(memo) < self.most:
                    memo[word] = ids
            got.append(ids)
        if not got:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        begin = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(got), np.uint32)
        which = coded.indices.to_numpy(zero_copy_only=False)
        n = size[which]
        place = np.repeat(begin[which] - (np.cumsum(n) - n), n)
        place += np.arange(len(place))
        return flat[place], n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string())
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if self.spaced:
            odd = pc.match_substring_regex(texts, _ODD_SPACE)
            if pc.any(odd).as_py():
                return self._mixed(texts, odd.to_numpy(zero_copy_only=False))
        return self._regular(texts)

    def _regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.spaced:  # a space moves to the word after it, a line feed is a piece
            texts = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n\x00")
            lists = pc.split_pattern(texts, "\x00")
        else:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ids, n = self._pieces(lists.values)
        upto = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(upto[lists.offsets.to_numpy()])

    def _mixed(self, texts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with other white space are encoded as a whole."""
        ids, n = self._regular(texts.filter(pa.array(~odd)))
        count = np.zeros(len(texts), np.int64)
        count[~odd] = n
        whole = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
                 for t in texts.filter(pa.array(odd)).to_pylist()]
        count[odd] = [len(w) for w in whole]
        out = np.empty(count.sum(), np.uint32)
        mine = np.repeat(odd, count)
        out[~mine] = ids
        if whole:
            out[mine] = np.concatenate(whole)
        return out, count


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str, memo: int = MEMO) -> TextEncoder:
    """The worker's encoder for a tokenizer file (loaded once), which remembers at most ``memo`` pieces."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    _ENCODERS[path].most = memo
    return _ENCODERS[path]


def forget() -> None:
    """Drop what the worker's encoders remember, and give free memory back.

    Workers outlive their tasks: without it the next stage of a job starts
    with the memory of the last.
    """
    for held in _ENCODERS.values():
        held.memo.clear()
    pa.default_memory_pool().release_unused()


def portions(batch: pa.RecordBatch, column: int, size: int = PORTION):
    """Slices of a batch with about ``size`` bytes of text each (one row at least)."""
    upto = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


def with_end(ids: np.ndarray, n: np.ndarray, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Every document's ids followed by the end id, and the new lengths."""
    return np.insert(ids, np.cumsum(n), np.uint32(end)), n + 1


def public_path(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))
