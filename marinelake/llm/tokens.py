"""Exact ids of whole texts, each distinct space-delimited chunk encoded once.

A space that a non-blank character follows always opens a new token group in the
byte-level model, and no piece of the piece model holds a marker after another
character. Texts are therefore cut at such spaces, the distinct chunks of a task
are encoded once by the library, and their ids are put back by position. A text
with any other blank next to a space is one chunk, so it is encoded as a whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marinelake.llm.common import spread

#: Distinct chunks a task remembers; at more it forgets all and goes on.
REMEMBERED = 700_000
#: The same of an encoder that a Python worker keeps from task to task.
KEPT = 1_000_000
#: A space before a blank, or at the end. Blanks: White_Space and what some
#: regular expression libraries also take for it.
_BLANK = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}\x{180e}\x{200b}\x{feff}]"
IRREGULAR_BYTE_LEVEL = rf" (?:{_BLANK}|$)"
IRREGULAR_PIECES = " (?: |$)|^ |▁"


class ChunkTable:
    """Ids of the distinct chunks seen so far, in one flat array."""

    def __init__(self, encode, limit: int = REMEMBERED):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def places(self, chunks: list[str]) -> np.ndarray:
        """Where each of the distinct ``chunks`` stands in ``starts`` and ``lengths``."""
        new = [c for c in chunks if c not in self.place]
        if len(self.place) + len(new) > self.limit and self.place:
            self.clear()
            new = chunks
        if new:
            flat, lengths = self.encode(new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            starts = len(self.flat) + np.cumsum(lengths) - lengths
            self.flat = np.concatenate([self.flat, flat])
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
        return np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))


def _chunks(texts: pa.StringArray, irregular: str):
    """Codes of all chunks, offsets of the texts in them, the distinct chunks."""
    whole = pc.match_substring_regex(texts, irregular)
    cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
    offsets = cut.offsets.to_numpy().astype(np.int64)
    values = cut.flatten()
    rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    if len(rows):  # such a text was split as an empty one: its one chunk is the text
        at = pa.array(np.isin(np.arange(len(values)), offsets[rows]))
        values = pc.replace_with_mask(values, at, texts.take(pa.array(rows)))
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), offsets, coded.dictionary.to_pylist(), rows


class ByteLevel:
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, limit: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # One character stands for one byte in such a vocabulary.
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.n_bytes[i] = len(piece)
        self.inner = ChunkTable(self._encode_inner, limit)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_inner(self, words: list[str]):
        """Words that follow a space, many per call; token lengths give the edges."""
        texts = ["".join(" " + w for w in words[i : i + 4096]) for i in range(0, len(words), 4096)]
        flat = np.concatenate([np.array(ids, np.uint32) for ids in self._library(texts)])
        ends = np.cumsum(pc.binary_length(pa.array(words, pa.string())).to_numpy().astype(np.int64) + 1)
        edges = np.searchsorted(np.cumsum(self.n_bytes[flat]), ends) + 1
        return flat, np.diff(edges, prepend=0)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offset of each text in it."""
        codes, offsets, words, _ = _chunks(texts, IRREGULAR_BYTE_LEVEL)
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        first = np.zeros(len(codes), bool)
        first[offsets[:-1]] = True
        heads = [words[c] for c in codes[first]]
        head_ids = [np.array(ids, np.uint32) for ids in self._library(heads)]
        head_lengths = np.fromiter(map(len, head_ids), np.int64, len(head_ids))
        inner_codes = codes[~first]
        used = np.flatnonzero(np.bincount(inner_codes, minlength=len(words)))
        places = np.zeros(len(words), np.int64)
        places[used] = self.inner.places([words[c] for c in used.tolist()])
        flat = np.concatenate([self.inner.flat, *head_ids])
        starts, lengths = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
        starts[first] = len(self.inner.flat) + np.cumsum(head_lengths) - head_lengths
        lengths[first] = head_lengths
        if len(used):
            starts[~first] = self.inner.starts[places][inner_codes]
            lengths[~first] = self.inner.lengths[places][inner_codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return flat[spread(starts, lengths)], ends[offsets]


@lru_cache(maxsize=1)
def kept_byte_level(path: str) -> ByteLevel:
    """The encoder that this process keeps: the words of a task before are known to the next."""
    return ByteLevel(path, KEPT)


class Pieces:
    """A BPE model of the sentencepiece library."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        #: Chunks are independent only if no piece crosses a marker and each
        #: chunk is led by one, as the library's added first marker is.
        self.separable = (
            not any("▁" in p.lstrip("▁") for p in pieces)
            and self.model.encode("a b", out_type=str) == self.model.encode("a", out_type=str) + self.model.encode("b", out_type=str)
        )
        self.table = ChunkTable(self._encode)
        self.shown: dict[int, str] = {}

    def _encode(self, words: list[str]):
        ids = self.model.encode(words, num_threads=1)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for word in ids for i in word), np.uint32, int(lengths.sum())), lengths

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        codes, offsets, words, _ = _chunks(texts, IRREGULAR_PIECES if self.separable else "(?s).")
        places = self.table.places(words)[codes]
        lengths = self.table.lengths[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.table.flat[spread(self.table.starts[places], lengths)], ends[offsets]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        listed = ids.tolist()
        return self.model.decode([listed[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], num_threads=1)


def public_tokenizer(name: str) -> str:
    """Where a public tokenizer file lies on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


__all__ = ["ByteLevel", "ChunkTable", "Pieces", "kept_byte_level", "public_tokenizer"]
