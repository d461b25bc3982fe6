"""Byte-pair encoding and decoding with the vocabulary file of a public byte-level tokenizer.

A text is split at special tokens, then into pieces by the fixed pattern of byte-level vocabularies.
A piece starts as one symbol a byte, kept in a doubly linked list; a priority queue holds the rank of
every adjacent pair that can merge. The lowest rank, leftmost first, is merged, new neighbours are
queued, and entries whose symbols have changed meanwhile are skipped. A piece of n bytes takes
O(n log n), however long it is. Decoding concatenates the vocabulary strings, maps them to bytes and
reads those as UTF-8.

Edge cases: a null text encodes to null and decodes to null; an empty text is no tokens; ids that the
vocabulary lacks, and null ids, are skipped by decoding; bytes that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import gc
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern that splits a text before merging.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters for which the pattern means the same to ``regex`` and to the tokenizers library, whose
#: Unicode tables are older. A text with any other is split by that library's own splitter.
SETTLED = r"[\0-՗ -⁯　-〿ぁ-ヾ一-鿕가-힣]*+"

#: Pieces remembered in a task, and the longest piece remembered.
CACHE_PIECES = 300_000
CACHE_CHARS = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else U+0100 and up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file, for use inside a task."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is no byte-level BPE vocabulary")
        if spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path} changes the text before it splits it")
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        self._first = [vocab[c] for c in letters]
        # For each left symbol the rank of its pairs by right symbol, and the symbol that the pair of a rank
        # becomes. The last entry, index -1, is that of no symbol.
        none: dict[int, int] = {}
        self._ranks: list[dict[int, int]] = [none] * (max(vocab.values()) + 2)
        self._joined: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if self._ranks[vocab[left]] is none:
                self._ranks[vocab[left]] = {}
            self._ranks[vocab[left]][vocab[right]] = rank
            self._joined.append(vocab[left + right])
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has special tokens that take in their surroundings")
        longest_first = sorted(map(regex.escape, self._special), key=len, reverse=True)
        self._split = regex.compile(f"({'|'.join(longest_first)})").split if longest_first else None
        self._pieces = regex.compile(PIECE).findall
        self._settled = regex.compile(SETTLED).fullmatch
        self._path = path
        self._foreign = None
        # What was met lately, and what before that.
        self._cache: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        value = {c: b for b, c in enumerate(letters)}
        self._strings: dict[int, bytes] = {
            n: bytes(value[c] for c in s) if all(c in value for c in s) else s.encode()
            for s, n in (vocab | self._special).items()
        }

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or self._settled(text):
            return self._pieces(text)
        if self._foreign is None:
            from tokenizers import Tokenizer

            self._foreign = Tokenizer.from_file(self._path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._foreign.pre_tokenize_str(text)]

    def merged(self, piece: str) -> tuple[int, ...]:
        """Token ids of one piece."""
        ranks, joined_as = self._ranks, self._joined
        symbol = [self._first[b] for b in piece.encode("utf-8")]
        size = len(symbol)
        # An entry is the rank of a pair and, in its low bits, the place of its left symbol.
        bits = max(16, size.bit_length())
        mask = (1 << bits) - 1
        queue = [
            rank << bits | at
            for at, (left, right) in enumerate(zip(symbol, symbol[1:]))
            if (rank := ranks[left].get(right)) is not None
        ]
        if not queue:
            return tuple(symbol)
        # The last place stands for both ends of the list; it and merged places hold no symbol.
        symbol.append(-1)
        after, before = [*range(1, size + 1), size], [size, *range(size)]
        pop, push = heapq.heappop, heapq.heappush
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            rank, at = entry >> bits, entry & mask
            old = after[at]
            # Stale: one of the two symbols was merged since the pair was queued. A rank names its pair.
            if ranks[symbol[at]].get(symbol[old]) != rank:
                continue
            symbol[at] = joined = joined_as[rank]
            symbol[old] = -1
            after[at] = following = after[old]
            before[following] = at
            rank = ranks[joined].get(symbol[following])
            if rank is not None:
                push(queue, rank << bits | at)
            previous = before[at]
            rank = ranks[symbol[previous]].get(joined)
            if rank is not None:
                push(queue, rank << bits | previous)
        return tuple([s for s in symbol if s >= 0])

    def remembered(self, piece: str) -> tuple[int, ...]:
        """Token ids of a piece that was not met lately."""
        ids = self._older.get(piece)
        if ids is None:
            ids = self.merged(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self._cache) >= CACHE_PIECES // 2:
                self._older, self._cache = self._cache, {}
            self._cache[piece] = ids
        return ids

    @contextmanager
    def remembering(self) -> Iterator[Codec]:
        """For the texts of one task: pieces are forgotten at its end, so that idle workers hold none, and
        memory that the worker keeps for later arrays is given back."""
        try:
            yield self
        finally:
            self._cache, self._older = {}, {}
            gc.collect()
            pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self._split(text) if self._split else [text]:
            if part in self._special:
                out.append(self._special[part])
                continue
            for piece in self.pieces(part):
                # The cache may be exchanged while a text is encoded.
                out += self._cache.get(piece) or self.remembered(piece)
        return out

    def decode(self, ids: Iterable[int | None]) -> str:
        strings = self._strings
        return b"".join([strings.get(n, b"") for n in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec a worker process; the file is read where the task runs."""
    return Codec(path)


def _id_lists(parts: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if p is None else len(p) for p in parts]
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    flat = [p for p in parts if p is not None]
    values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32))
    mask = pa.array([p is None for p in parts], type=pa.bool_())
    return pa.ListArray.from_arrays(ends, values, mask=mask)


def encode(text: Column, path: str) -> Column:
    """Token ids of every text, as an array of int."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with codec(path).remembering() as use:
            for texts in batches:
                yield _id_lists(
                    [None if t is None else np.array(use.encode(t), np.int32) for t in texts.to_pylist()]
                )

    # Else a plan that uses the ids several times would encode several times.
    return ids.asNondeterministic()(text)


def decode(ids: Column, path: str) -> Column:
    """Text of every array of token ids."""

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        use = codec(path).decode
        return pa.array(
            [None if n is None else use(n) for n in _rows(lists)], type=pa.string()
        )

    return text(ids)


def round_trip(text: Column, path: str) -> Column:
    """Struct of ``ids`` and ``decoded``: encoding and decoding of every text in one worker, so that the
    ids needn't go back to another one."""

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with codec(path).remembering() as use:
            for texts in batches:
                ids = [None if t is None else use.encode(t) for t in texts.to_pylist()]
                back = pa.array([None if n is None else use.decode(n) for n in ids], pa.string())
                lists = _id_lists([None if n is None else np.array(n, np.int32) for n in ids])
                yield pa.StructArray.from_arrays([lists, back], ["ids", "decoded"])

    return both.asNondeterministic()(text)


def _rows(lists: pa.Array) -> Iterable[Sequence[int | None] | None]:
    for row in lists:
        yield None if not row.is_valid else row.values.to_numpy(zero_copy_only=False).tolist() if (
            row.values.null_count == 0
        ) else row.values.to_pylist()


def encode_frame(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column of token ids; a column of that name is replaced."""
    return df.withColumn(ids, encode(F.col(text), path))


def decode_frame(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with a column of decoded text; a column of that name is replaced."""
    return df.withColumn(text, decode(F.col(ids), path))


def joined_ids(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.concat_ws(",", ids.cast("array<string>"))
