"""Byte-level BPE on Arrow batches with the tokenizers library, and the way back.

The vocabulary is a rank file (base64 token, rank). Its byte strings are written with one printable
character per byte, as the library's byte-level models expect; every split of a token into two
tokens is a merge, in the order of the ranks, so a merge is chosen as by rank alone.

Encoding: a text is cut where a single space stands between two other visible characters. There no
match of the pattern can cross, so the parts are encoded on their own, each different part once
(a bounded cache per worker). A text longer than Arrow's batches allow is not cut off anywhere.

Decoding looks every id up in the byte table and joins the bytes. Token borders can lie inside a
character: ``decode`` gives the bytes, ``decode_pieces`` the text that is complete after each token.

Null and empty texts have no ids. Repeated rows are encoded like any other; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import codecs
import gc
import os
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sediment.llm.base import map_batches
from sediment.llm.words import slices

#: Where a text can be cut without changing a token.
CUT = re.compile(r"(?<=\S)(?= \S)")
#: At most so many parts of either kind are kept by a worker; beyond it the later half goes, as frequent parts come early.
CACHED_PARTS = 600_000
#: Bytes of text that are encoded together.
HELD_BYTES = 4 << 20
#: Parts longer than this are not kept in the cache.
CACHED_LENGTH = 64


@cache
def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in printable]
    characters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [characters[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@cache
def encoder_of_ranks(path: str, pattern: str):
    """A tokenizer of the library for a rank file; the pattern's matches are encoded separately."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = read_ranks(path)
    names = byte_characters()
    name = {token: "".join(names[b] for b in token) for token in ranks}
    merges = [
        (rank, name[token[:i]], name[token[i:]])
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    merges.sort(key=lambda m: m[0])
    model = models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=[m[1:] for m in merges])
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


@cache
def encoder_of_file(path: str):
    """A tokenizer file of the library; the strings of special tokens in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


class PartEncoder:
    """Encodes texts word by word; ids are little-endian 32-bit numbers in a byte string.

    The words of a few texts are told apart by Arrow's dictionary encoding, so that Python sees each
    different word once, and their ids are gathered by numpy from one array. Unknown words are encoded
    as one text, whose ids are then cut by their numbers of bytes.
    """

    def __init__(self, tokenizer, sizes: np.ndarray) -> None:
        self.tokenizer = tokenizer
        #: Bytes of each id's token.
        self.sizes = sizes
        #: Ids of a part as it stands.
        self.heads: dict[str, bytes] = {}
        #: Of a word with one space before it the number of its entry; the entries' ids lie one after the other.
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, "<u4")
        self.bounds = np.zeros(1, np.int64)

    def encode_column(self, column: pa.Array) -> list[bytes]:
        """The ids of each text, worked out a few texts at a time."""
        return [ids for _, part in slices(column, HELD_BYTES) for ids in self.encode(part)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        self._forget()
        texts = pc.fill_null(texts, "")
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        number = coded.indices.to_numpy()
        # Without a space in any, the words come apart again where they are joined by one.
        every = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.string()))
        different = pc.binary_join(every, " ")[0].as_py().split(" ") if len(coded.dictionary) else []
        entry = np.fromiter(map(self.known.get, different, repeat(-1)), np.int64, len(different))
        unknown = np.flatnonzero(entry < 0)
        odd = np.zeros(len(different), bool)
        odd[unknown] = [not w or w[0].isspace() or w[-1].isspace() for w in map(different.__getitem__, unknown.tolist())]
        text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
        plain = np.bincount(text_of, odd[number], len(texts)) == 0
        # The first word has no space before it. A space that does not stand alone between two visible
        # characters makes an odd word; texts with such words, and empty ones, are cut where they can be.
        heads = [[different[number[b]]] if p else CUT.split(texts[i].as_py()) for i, (b, p) in enumerate(zip(bounds, plain))]
        self._learn_heads(set(chain.from_iterable(heads)))
        tail = plain[text_of]
        tail[bounds[:-1][np.diff(bounds) > 0]] = False
        self._learn(different, entry, np.unique(number[tail & (entry < 0)[number]]))
        entry = entry[number[tail]]
        lengths = np.diff(self.bounds)[entry]
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.bounds[entry] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        data = ids.tobytes()
        cuts = 4 * np.concatenate([[0], np.cumsum(np.bincount(text_of[tail], lengths, len(texts)))]).astype(np.int64)
        joined = [b"".join(map(self.heads.__getitem__, head)) + data[i:j] for head, i, j in zip(heads, cuts[:-1], cuts[1:])]
        for part in chain.from_iterable(heads):
            if len(part) > CACHED_LENGTH:
                self.heads.pop(part, None)
        return joined

    def _forget(self) -> None:
        if len(self.heads) > CACHED_PARTS // 5:
            for part in list(islice(self.heads, CACHED_PARTS // 10, None)):
                del self.heads[part]
        if len(self.bounds) > CACHED_PARTS:
            half = CACHED_PARTS // 2
            self.known = {word: k for word, k in self.known.items() if k < half}
            self.bounds = self.bounds[: half + 1].copy()
            self.ids = self.ids[: self.bounds[-1]].copy()

    def _learn_heads(self, parts: set[str]) -> None:
        new = list(parts.difference(self.heads))
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.heads.update((part, np.array(e.ids, "<u4").tobytes()) for part, e in zip(new, found, strict=True))

    def _learn(self, words: list[str], entry: np.ndarray, new: np.ndarray) -> None:
        """Makes entries of the ``new`` ones of ``words``; long ones are not found again."""
        if len(new):
            entry[new] = np.arange(len(new)) + len(self.bounds) - 1
            added = [words[k] for k in new.tolist()]
            ids, ends = self._together(added)
            self.bounds = np.concatenate([self.bounds, ends + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
            self.known.update((w, k) for w, k in zip(added, entry[new].tolist()) if len(w) <= CACHED_LENGTH)

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words with a space before each, and where each word's end."""
        text = " " + " ".join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([1 + len(word.encode()) for word in words])
        return ids, np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1


def token_sizes(tokenizer) -> np.ndarray:
    """Bytes of each id's token: its characters, each of which stands for a byte."""
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for name, i in tokenizer.get_vocab().items():
        sizes[i] = len(name)
    return sizes


@cache
def part_encoder(path: str, pattern: str | None) -> PartEncoder:
    """One per worker, so that its cache outlives a task."""
    gc.freeze()
    tokenizer = encoder_of_ranks(path, pattern) if pattern else encoder_of_file(path)
    return PartEncoder(tokenizer, token_sizes(tokenizer))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and ``ids``, the token ids of the whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoded = part_encoder(path, pattern).encode_column(batch.column(1))
        offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
        ids = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
        return pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), ids)], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>")


def token_offsets(ids: Iterable[int], table: list[bytes]) -> list[tuple[int, int]]:
    """First byte and byte after the last one of each token in the text's UTF-8 form."""
    ends = np.cumsum([0, *(len(table[i]) for i in ids)]).tolist()
    return list(zip(ends[:-1], ends[1:], strict=True))


@cache
def byte_table(path: str) -> list[bytes]:
    """The bytes of each id, read back from the characters that stand for them."""
    back = {c: b for b, c in enumerate(byte_characters())}
    names = {r: "".join(map(byte_characters().__getitem__, t)) for t, r in read_ranks(path).items()}
    return [bytes(back[c] for c in names.get(i, "")) for i in range(max(names) + 1)]


def decode_pieces(ids: Iterable[int], table: list[bytes]) -> Iterator[str]:
    """What each token adds to the text; a split character appears with its last token."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        yield decoder.decode(table[i])
    yield decoder.decode(b"", final=True)


@cache
def packed_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, where each token begins, and its length."""
    table = byte_table(path)
    lengths = np.array([len(t) for t in table], np.int64)
    return np.frombuffer(b"".join(table), np.uint8), np.cumsum(lengths) - lengths, lengths


def joined_bytes(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids one after the other, and where those of each id end."""
    data, begins, lengths = packed_table(path)
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    places = np.repeat(begins[ids] - (ends - sizes), sizes)
    places += np.arange(len(places))
    return data[places], ends


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id column, ``ids`` and ``decoded``, the bytes of the ids. Null ids decode to no bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1)
        if lists.null_count:
            lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32()))
        ids = lists.flatten().to_numpy()
        data, ends = joined_bytes(ids, path)
        starts = np.concatenate([[0], ends])
        bounds = lists.offsets.to_numpy().astype(np.int64)
        offsets = starts[bounds - bounds[0]].astype(np.int32)
        decoded = pa.Array.from_buffers(
            pa.binary(), len(lists), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
        )
        return pa.record_batch([batch.column(0), lists, decoded], [id_col, "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_batches(encoded.select(id_col, ids_col), run, f"`{id_col}` {kind}, ids array<int>, decoded binary")
