"""Whole-text encoding with the ``tokenizers`` library, one call for each distinct chunk of a Python worker.

The public word-level BPE vocabulary drops white space and splits words from punctuation before it merges, so the
ids of a text are the ids of its white-space chunks one after the other. Every distinct chunk is encoded by the
library and remembered by the worker; beyond ``CACHE`` chunks it forgets those that few slices of text had. The rest is Arrow
and numpy. Chunks of letters up to U+00FF go to the library's model at once: its normalizer only makes them small, its splitters
leave them whole and its byte level writes their UTF-8 bytes as characters, which Python does for many at a time. ASCII letters are lower-cased first and a mark after a plain letter is set apart, which the vocabulary's
own normalizer and splitter do as well. Texts holding ``<|`` could name a special token and are encoded whole.
"""

from __future__ import annotations

import os
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import joined, remembered, slices, strings, texts

VOCABULARY = "word_bpe_49k.json"
CACHE = 1_000_000
#: Chunks longer than this are encoded but not remembered.
LONGEST_KEPT = 64
#: Text encoded together; more of it repeats more chunks.
ENCODED_BYTES = 12 << 20

#: Chunks handed to the library at once.
LEARNED = 4_000
#: Chunks of letters up to U+00FF.
LETTERS = "^[A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+$"
#: A plain letter and a mark; not the apostrophe, which the vocabulary keeps with the letters of a contraction.
MARKS = r"([a-zß-öø-ÿ])([!-&(-/:-@\[-`{-~])"

#: Byte-level vocabularies write these bytes of letters' UTF-8 as other characters.
_BYTES = np.arange(256, dtype="<u4")
_BYTES[0x7F:0xA1] += 0x100 + 33 - 0x7F
_BYTES[0xAD] = 0x143

def _written(letters: str) -> str:
    """Small letters as their UTF-8 bytes, each written as the vocabulary writes it; blanks stay."""
    return letters if letters.isascii() else _BYTES[np.frombuffer(letters.lower().encode(), np.uint8)].tobytes().decode("utf-32-le")


def encoder(name: str = VOCABULARY) -> "Encoder":
    """The worker's encoder of a vocabulary file, given by its public name or by a path."""
    held = remembered("tokens")
    if name not in held:
        held[name] = Encoder(name)
    return held[name]


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array with at least n places."""
    return array if n <= len(array) else np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)])


class Encoder:
    def __init__(self, name: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))
        #: The model alone, for chunks written as it has them.
        self.letters = Tokenizer(self.model.model)
        self.letters.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        #: Ids that end a word.
        self.last = np.zeros(self.model.get_vocab_size(), bool)
        self.last[[i for token, i in self.model.get_vocab().items() if token.endswith(self.model.model.end_of_word_suffix)]] = True
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        #: Slices of text that had a chunk, fewer for those of long ago.
        self.seen = np.zeros(1 << 14, np.int32)
        self.used = self.known = 0

    def _forget(self) -> None:
        """Keep at most half of ``CACHE`` chunks: those that most slices had, and at least two."""
        seen, least = self.seen[: self.known], 2
        while np.count_nonzero(seen >= least) > CACHE // 2:
            least += 1
        kept = seen >= least
        number = np.cumsum(kept) - 1
        self.place = {w: int(number[p]) for w, p in self.place.items() if kept[p]}
        lengths = np.diff(self.starts[: self.known + 1])
        self.ids = self.ids[: self.used][np.repeat(kept, lengths)]
        self.used, self.known = len(self.ids), int(kept.sum())
        self.starts = np.concatenate([[0], np.cumsum(lengths[kept])])
        self.seen = seen[kept] >> 1

    def _encoded(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after the other, and how many each has."""
        plain = pc.match_substring_regex(chunks, LETTERS)
        letters = self.letters.encode_batch_fast([_written(joined(chunks.filter(plain)))], add_special_tokens=False)[0].ids
        rest = self.model.encode(strings(chunks.filter(pc.invert(plain))), is_pretokenized=True, add_special_tokens=False)
        letters, plain = np.array(letters, np.uint32), plain.to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(chunks), np.int64)
        sizes[plain] = np.diff(np.flatnonzero(self.last[letters]), prepend=-1)
        sizes[~plain] = np.bincount(np.array(rest.word_ids, np.int64), minlength=np.count_nonzero(~plain))
        flat, of_plain = np.zeros(int(sizes.sum()), np.uint32), np.repeat(plain, sizes)
        flat[of_plain], flat[~of_plain] = letters, rest.ids
        return flat, sizes

    def _learn(self, chunks: pa.Array, words: list[str]) -> None:
        """Encode and remember chunks, given as an array and as a list."""
        for at in range(0, len(words), LEARNED):
            flat, sizes = self._encoded(chunks[at : at + LEARNED])
            n = len(sizes)
            ends = np.cumsum(sizes)
            self.ids = _room(self.ids, self.used + len(flat))
            self.starts = _room(self.starts, self.known + n + 1)
            self.seen = _room(self.seen, self.known + n)
            self.ids[self.used : self.used + len(flat)] = flat
            self.starts[self.known + 1 : self.known + 1 + n] = self.used + ends
            self.seen[self.known : self.known + n] = 0
            self.place.update(zip(words[at : at + LEARNED], range(self.known, self.known + n)))
            self.used += len(flat)
            self.known += n

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and n + 1 offsets of the texts."""
        column = texts(column)
        special = pc.match_substring(column, "<|")
        odd = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        plain = pc.if_else(special, "", column) if len(odd) else column
        plain = pc.replace_substring_regex(pc.ascii_lower(plain), MARKS, r"\1 \2")
        lists = pc.ascii_split_whitespace(plain)
        del plain
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        coded = lists.flatten().dictionary_encode()
        del lists
        words = strings(coded.dictionary)
        if self.known > CACHE:
            self._forget()
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = coded.dictionary.take(pa.array(unknown))
            names = strings(new)
            at[unknown] = np.arange(self.known, self.known + len(unknown))
            self._learn(new, names)
            for w in [w for w in names if len(w) > LONGEST_KEPT]:
                del self.place[w]
        self.seen[at] += 1  # every chunk of a slice is in ``at`` once
        indices = coded.indices.to_numpy(zero_copy_only=False)
        first = self.starts[at]
        lengths = (self.starts[at + 1] - first)[indices]
        first = first[indices]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        kind = np.int32 if max(self.used, int(ends[-1])) < 2**31 else np.int64
        flat = self.ids[np.repeat((first - ends[:-1]).astype(kind), lengths) + np.arange(ends[-1], dtype=kind)]
        offsets = ends[bounds]
        if len(odd):
            whole = {int(i): np.array(self.model.encode(column[int(i)].as_py(), add_special_tokens=False).ids, np.uint32) for i in odd}
            parts = [whole.get(i, flat[offsets[i] : offsets[i + 1]]) for i in range(len(column))]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            flat = np.concatenate(parts)
        return flat, offsets

    def documents(self, column: pa.Array, end_id: int):
        """Yield (first row, ids, offsets) for runs of rows; every text's ids are followed by ``end_id``."""
        column = texts(column)
        for a, b in slices(column, ENCODED_BYTES):
            flat, offsets = self.encode(column[a:b])
            n = b - a
            out = np.full(len(flat) + n, end_id, np.uint32)
            at = np.ones(len(out), bool)
            offsets = offsets + np.arange(n + 1)
            at[offsets[1:] - 1] = False
            out[at] = flat
            pa.default_memory_pool().release_unused()
            yield a, out, offsets


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
