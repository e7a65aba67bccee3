"""Byte-pair encoding of whole texts by backtracking, and decoding through an offset table.

For a piece of text an Aho-Corasick automaton over the vocabulary lists the tokens that start at each
place. The encoder takes the longest one that can stand beside the token before it, goes back where
nothing fits, and marks places that lead nowhere, so each place is settled once. Two tokens can stand
side by side when merging their joined text in rank order would not cross their border
(``Vocabulary.fits``); the answers form the pair-compatibility table, filled as pairs come up. The
result equals the merges of the vocabulary taken one by one in rank order.

The vocabulary file is that of a byte-level BPE with a word-end mark, NFC and lower case, as the
``tokenizers`` library reads it; special tokens of the file are found in the raw text. Null and empty
texts have no tokens. Any id values pass through, null and repeated ones too; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.columns import text_of
from tidemark.llm.memory import lean

#: Stands for the word-end mark inside a piece; the byte alphabet has no such character.
END = ""
_CONTROL = regex.compile("[\x1c-\x1f]")
#: Pieces, and words, whose ids a worker remembers, and the longest of them.
MOST_PIECES, LONGEST_PIECE = 400_000, 40
#: Rows of one output batch.
ROWS = 512


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a vocabulary file; small, made once and sent to workers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not self.mark or spec["decoder"] is not None:
            raise ValueError("a BPE file with a word-end mark and no decoder is asked for")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        ids = model["vocab"]
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, k in [*ids.items(), *self.special.items()]:
            self.tokens[k] = token
        self.left, self.right = [-1] * self.size, [-1] * self.size
        self.merged: dict[tuple[int, int], int] = {}
        made = []
        for a, b in model["merges"]:
            whole, pair = ids[a + b], (ids[a], ids[b])
            self.left[whole], self.right[whole] = pair
            self.merged[pair] = whole
            made.append(whole)
        if made != sorted(set(made)) or any(k < made[0] for k in self.left[: made[0]] if k >= 0):
            raise ValueError("ids must follow the rank of the merges")
        self.first_merge = made[0] if made else self.size

    def fits(self, a: int, b: int, before: int | None = None) -> bool:
        """Whether merges of rank below ``before`` (all, if None) leave the border between a and b.

        Merges are undone from the latest one back. At each moment the two tokens at the border
        must have no merge that would have come earlier than the one undone last; of equal merges
        the left one comes first.
        """
        limit = self.size if before is None else before
        while True:
            if self.merged.get((a, b), limit) < limit:
                return False
            if max(a, b) < self.first_merge:
                return True
            if a > b:
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]

    @cached_property
    def reachable(self) -> list[bool]:
        """Tokens that merging their own text gives; others never come out of an encoding."""
        out = [bool(t) for t in self.tokens]
        for k in range(self.first_merge, self.size):
            if (a := self.left[k]) >= 0:
                b = self.right[k]
                out[k] = out[a] and out[b] and self.fits(a, b, k)
        for k in self.special.values():
            out[k] = False
        return out


class Encoder:
    """What a worker needs to encode and decode with a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = v = vocabulary
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.length = [0] * v.size
        for k, token in enumerate(v.tokens):
            if v.reachable[k]:
                key = token[: -len(v.mark)] + END if token.endswith(v.mark) else token
                self.length[k] = len(key)
                self.automaton.add_word(key, k)
        self.automaton.make_automaton()
        self.pieces = regex.compile(v.split_pattern)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None
        self.alphabet = byte_alphabet()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        # Decoding: the texts of all tokens end to end, each followed by the blank that joins tokens.
        texts = [t.encode() + b" " for t in v.tokens]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def _fits(self, pair: tuple[int, int]) -> bool:
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) > 4 * MOST_PIECES:
                self.compatible.clear()
            known = self.compatible[pair] = self.vocabulary.fits(*pair)
        return known

    def piece(self, text: str) -> list[int]:
        """Ids of one piece of normalised text."""
        symbols = "".join([self.alphabet[b] for b in text.encode()]) + END
        n, length = len(symbols), self.length
        starting: list[list[int]] = [[] for _ in range(n)]
        for end, k in self.automaton.iter(symbols):
            starting[end - length[k] + 1].append(k)  # of one start, by growing length
        ids: list[int] = []
        chosen: list[tuple[int, int]] = []
        dead = bytearray(n + 1)
        place, rank = 0, len(starting[0]) - 1
        while place < n:
            while rank >= 0:
                k = starting[place][rank]
                if not dead[place + length[k]] and (not ids or self._fits((ids[-1], k))):
                    break
                rank -= 1
            if rank >= 0:
                ids.append(k)
                chosen.append((place, rank))
                place += length[k]
                rank = len(starting[place]) - 1 if place < n else 0
            else:
                dead[place] = 1
                ids.pop()
                place, rank = chosen.pop()
        return ids

    def _word(self, word: str) -> bytes:
        packed = b"".join([self._packed(x) for x in self.pieces.findall(word)])
        if len(word) <= LONGEST_PIECE:
            if len(self.words) >= MOST_PIECES:
                self.words.clear()
            self.words[word] = packed
        return packed

    def _packed(self, piece: str) -> bytes:
        packed = self.known.get(piece)
        if packed is None:
            packed = np.array(self.piece(piece), "<u4").tobytes()
            if len(piece) <= LONGEST_PIECE:
                if len(self.known) >= MOST_PIECES:
                    self.known.clear()
                self.known[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out = []
        for part in self.specials.split(text) if self.specials and "<|" in text else [text]:
            if part in self.vocabulary.special:
                out.append(np.array([self.vocabulary.special[part]], "<u4").tobytes())
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final sigma
            part = part.lower()
            # No piece has white space inside, so words are remembered whole; str.split() takes four
            # control characters for white space that the vocabulary's pattern does not.
            words = regex.split(r"\s+", part) if _CONTROL.search(part) else part.split()
            known = self.words
            out += [known.get(w) or self._word(w) for w in words]
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """The text of the ids: tokens joined by blanks, in UTF-8."""
        ids = np.frombuffer(packed, "<u4")
        if not len(ids):
            return b""
        begin, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
        return self.bytes[at[:-1]].tobytes()


@lru_cache(maxsize=2)
def _encoder(shared) -> Encoder:
    return Encoder(shared.value)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """Per row: id, ``ids`` (binary, little-endian unsigned 32-bit) and, if asked for, the ``decoded`` text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary file
    rows = docs.select(docs[id_col], text_of(docs, text_col).alias("text"))
    id_type = rows.schema[0].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                ids = [coder.encode(t) for t in batch.column(1).to_pylist()]
                columns = [batch.column(0), pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array([coder.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "decoded"][: len(columns)])

    made = rows.mapInArrow(lean(encode), f"`{id_col}` {id_type}, ids binary" + ", decoded binary" * decode)
    return made.withColumn("decoded", made["decoded"].cast("string")) if decode else made
