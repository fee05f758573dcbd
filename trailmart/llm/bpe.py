"""Operator 2, byte-level BPE encoding and decoding by forced-boundary splitting.

Two bytes that stand side by side in no token of the vocabulary can never be merged, so a text may
be cut between them. The cut is certain if the split into words that precedes the merges does not
look across it either; ``certain_cuts`` says when. The fragments between certain cuts are encoded
one by one with the public tokenizers library and their ids concatenated. Most fragments repeat,
so each Python worker keeps the ids of those it has met in a bounded table.

Null texts are empty and have no ids. Very long texts are cut like others; a text without any
certain cut is one fragment. The string of a special token is that token, as in the library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trailmart.llm.words import held, in_small_batches, mix, slices, text_buffers

#: Fragments kept in a worker's table; past it, the table starts anew. Places are twice as many.
TABLE_ROWS = 1 << 19
#: Fragments up to this many bytes are looked up as two 64-bit words, longer ones as byte strings.
SHORT = 16

_SPACES = frozenset([0x20, *range(0x09, 0x0E)])


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, by the public rule:
    printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def certain_cuts(tokens: Sequence[bytes]) -> np.ndarray:
    """256 x 256 table: whether a text is certain to be cut between two bytes.

    No token holds the pair, and one of these holds for the split into words (runs of letters,
    of digits or of other signs, each with one leading space; contractions; white space):

    - white space begins after something else: a word always ends there;
    - none of both is white space: either the kind changes, so that a word ends there, or a run
      of one kind goes on, and its second part alone is of that kind too.

    Not certain is what follows white space (a space may belong to the next word, and a run of
    white space is split by what follows it), an apostrophe after a sign and a letter after an
    apostrophe (contractions), control bytes, and the inside of a character. That a byte over
    0x7F does not end a character of white space is checked at the place (``fragments``).
    """
    inside = np.zeros((256, 256), bool)
    for token in tokens:
        own = np.frombuffer(token, np.uint8)
        inside[own[:-1], own[1:]] = True
    cut = ~inside
    code = np.arange(256)
    control = ((code < 0x20) & ~np.isin(code, list(_SPACES))) | (code == 0x7F)
    space = np.isin(code, list(_SPACES))
    letter = ((code | 32) >= 97) & ((code | 32) <= 122) & (code < 128)
    word = letter | ((code >= 48) & (code <= 57))
    cut[control | space, :] = False
    cut[:, control | ((code >= 0x80) & (code < 0xC0))] = False
    cut[~word, ord("'")] = False
    cut[ord("'"), letter] = False
    for pair in ("re", "ve", "ll"):
        cut[ord(pair[0]), ord(pair[1])] = False
    return cut


def _ends_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends at these places is white space outside ASCII."""
    a, b, c = data[at], data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    two = (b == 0xC2) & ((a == 0x85) | (a == 0xA0))
    ogham = (c == 0xE1) & (((b == 0x9A) & (a == 0x80)) | ((b == 0xA0) & (a == 0x8E)))
    general = (c == 0xE2) & (
        ((b == 0x80) & ((a <= 0x8B) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF)))
        | ((b == 0x81) & (a == 0x9F))
    )
    return two | ogham | general | ((c == 0xE3) & (b == 0x80) & (a == 0x80))


_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


class _Table:
    """Ids of fragments already met: a bounded open-addressing table over whole batches.

    A short fragment is its bytes in two words and its length, so equal keys are equal bytes.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]) -> None:
        self._encode = encode
        self.clear()

    def clear(self) -> None:
        places = 2 * TABLE_ROWS
        self._first = np.zeros(places, np.uint64)
        self._second = np.zeros(places, np.uint64)
        self._size = np.zeros(places, np.uint8)
        self._row = np.zeros(places, np.int32)
        self._long: dict[bytes, int] = {}
        self._rows = 0
        self._at = np.zeros(1024, np.int64)
        self._count = np.zeros(1024, np.int64)
        self._pool = np.zeros(4096, np.int32)
        self._used = 0

    def _add(self, lists: list[list[int]]) -> int:
        """Store ids; gives the row of the first list."""
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for own in lists for i in own), np.int32, int(count.sum()))
        first, rows = self._rows, self._rows + len(lists)
        while rows > len(self._at):
            self._at, self._count = (np.append(x, np.zeros_like(x)) for x in (self._at, self._count))
        while self._used + len(flat) > len(self._pool):
            self._pool = np.append(self._pool, np.zeros_like(self._pool))
        self._at[first:rows] = self._used + np.cumsum(count) - count
        self._count[first:rows] = count
        self._pool[self._used : self._used + len(flat)] = flat
        self._rows, self._used = rows, self._used + len(flat)
        return first

    def _place(self, first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Where each key is, or the free place where it may go."""
        last = np.uint64(2 * TABLE_ROWS - 1)
        at = (mix(first ^ mix(second + size)) & last).astype(np.int64)
        todo = np.arange(len(at))
        while len(todo):
            here = at[todo]
            taken = self._size[here]
            other = (taken != 0) & (
                (taken != size[todo]) | (self._first[here] != first[todo]) | (self._second[here] != second[todo])
            )
            todo = todo[other]
            at[todo] = (at[todo] + 1) & int(last)
        return at

    def encoded(
        self, raw: bytes, starts: np.ndarray, lists: bool
    ) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each fragment of ``raw``, and the ids of all if asked.

        Fragments are worked on in chunks of at most half the table's rows, and what is asked of a
        chunk is gathered before the table may start anew for the next.
        """
        step = TABLE_ROWS // 2
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        ends = np.append(starts[1:], len(raw))
        for lo in range(0, len(starts), step):
            rows = self.rows(raw, starts[lo : lo + step], ends[lo : lo + step])
            counts.append(self.counts(rows))
            if lists:
                ids.append(self.ids(rows))
        return np.concatenate(counts), np.concatenate(ids)

    def rows(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The row of each fragment of ``raw``, at most ``TABLE_ROWS``; new ones are encoded first."""
        if self._rows > TABLE_ROWS - len(starts):
            self.clear()
        length = ends - starts
        # The words at every byte; bytes past a fragment's end are masked.
        padded = raw + bytes(16)
        word = np.ndarray(len(raw) + 8, "<u8", padded, strides=(1,))
        short = length <= SHORT
        begin, size = starts[short], length[short].astype(np.uint64)
        first = word[begin] & _KEEP[np.minimum(length[short], 8)]
        second = word[np.minimum(begin + 8, len(raw))] & _KEEP[np.maximum(length[short] - 8, 0)]
        at = self._place(first, second, size)
        new = np.flatnonzero(self._size[at] == 0)
        if len(new):
            known: dict[bytes, int] = {}
            for k, s, e in zip(new.tolist(), begin[new].tolist(), ends[short][new].tolist(), strict=True):
                known.setdefault(raw[s:e], k)
            row = self._add(self._encode([f.decode() for f in known]))
            picked = np.fromiter(known.values(), np.int64, len(known))
            for k in picked.tolist():
                where = self._place(first[k : k + 1], second[k : k + 1], size[k : k + 1])[0] if self._size[at[k]] else at[k]
                self._first[where], self._second[where] = first[k], second[k]
                self._size[where], self._row[where] = size[k], row
                row += 1
            at[new] = self._place(first[new], second[new], size[new])
        out = np.empty(len(starts), np.int64)
        out[short] = self._row[at]
        rest = np.flatnonzero(~short)
        if len(rest):
            texts = [raw[s:e] for s, e in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)]
            fresh = list(dict.fromkeys(t for t in texts if t not in self._long))
            row = self._add(self._encode([t.decode() for t in fresh]))
            self._long |= {t: row + k for k, t in enumerate(fresh)}
            out[rest] = [self._long[t] for t in texts]
            for t in fresh:  # a very long one is not kept for others
                if len(t) > 256:
                    del self._long[t]
        return out

    def counts(self, rows: np.ndarray) -> np.ndarray:
        return self._count[rows]

    def ids(self, rows: np.ndarray) -> np.ndarray:
        """The ids of fragments one after another."""
        count = self._count[rows]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self._pool[np.repeat(self._at[rows] - ends + count, count) + np.arange(total)]


def _token_bytes(said: dict) -> dict[int, bytes]:
    """The bytes of every token of a vocabulary file."""
    alphabet = byte_alphabet()
    tokens = {i: bytes(alphabet[c] for c in t) for t, i in said["model"]["vocab"].items()}
    return tokens | {t["id"]: t["content"].encode() for t in said["added_tokens"]}


class Decoder:
    """Ids to text; needs the tokens only, and not the library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            tokens = _token_bytes(json.load(file))
        self._bytes = [tokens.get(i, b"") for i in range(max(tokens) + 1)]

    def decode(self, ids: list[int]) -> str:
        tokens, top = self._bytes, len(self._bytes)
        if ids and (min(ids) < 0 or max(ids) >= top):
            ids = [i for i in ids if 0 <= i < top]
        return b"".join(map(tokens.__getitem__, ids)).decode("utf-8", "replace")


class Codec:
    """Encodes with the vocabulary file at ``path``."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        before = said["pre_tokenizer"] or {}
        model = said["model"]
        plain = (
            said["normalizer"] is None
            and (before.get("type"), before.get("add_prefix_space")) == ("ByteLevel", False)
            and before.get("use_regex", True)
            and model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in said["added_tokens"])
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        special = {t["id"]: t["content"].encode() for t in said["added_tokens"]}
        plain = [t for i, t in _token_bytes(said).items() if i not in special]
        self._certain = certain_cuts(plain).reshape(-1)
        self._added = sorted(set(special.values()), key=len, reverse=True)
        self._table = _Table(self._encode)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def fragments(self, part: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where the fragments of consecutive texts begin; ``begins`` ends with the length."""
        n = len(part)
        if n == 0:
            return np.zeros(0, np.int64)
        pair = (part[:-1].astype(np.uint16) << np.uint16(8)) | part[1:]
        cut = np.zeros(n + 1, bool)
        cut[1:-1] = self._certain[pair]
        late = np.flatnonzero(cut)
        late = late[part[late - 1] >= 0x80]
        cut[late[_ends_space(part, late - 1)]] = False
        raw = part.tobytes()
        for special in self._added:
            at = raw.find(special)
            while at >= 0:
                to = at + len(special)
                inner = np.searchsorted(begins, at, "right") == np.searchsorted(begins, to, "left")
                if inner:
                    cut[at + 1 : to] = False
                    cut[[at, to]] = True
                at = raw.find(special, to if inner else at + 1)
        cut[begins] = True
        cut[n] = False
        return np.flatnonzero(cut)

    def encode(self, column: pa.Array, lists: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of texts: the number of ids of each text, and the ids of all if asked."""
        data, offsets = text_buffers(column)
        for lo, hi in slices(offsets):
            part = data[offsets[lo] : offsets[hi]]
            begins = offsets[lo : hi + 1] - offsets[lo]
            starts = self.fragments(part, begins)
            counts, ids = self._table.encoded(part.tobytes(), starts, lists)
            total = np.append(0, np.cumsum(counts))
            yield np.diff(total[np.searchsorted(starts, begins)]), ids


def decoder(path: str) -> Decoder:
    """The tokens of a vocabulary file, once in each Python worker."""
    return held(Decoder, path)


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, once in each Python worker."""
    return held(Codec, path)


def id_lists(column: pa.Array, path: str) -> pa.Array:
    """The ids of each text of a column."""
    parts = [(np.zeros(1, np.int64), np.zeros(0, np.int32)), *codec(path).encode(column, True)]
    offsets = np.cumsum(np.concatenate([p[0] for p in parts]))
    flat = np.concatenate([p[1] for p in parts])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def id_counts(column: pa.Array, path: str) -> np.ndarray:
    """How many ids each text of a column has."""
    parts = [p[0] for p in codec(path).encode(column, False)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def pieces(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch of rows whose last column is text, in parts of about ``size`` bytes of it."""
    _, offsets = text_buffers(batch.column(batch.num_columns - 1))
    for lo, hi in slices(offsets, size):
        yield batch.slice(lo, hi - lo)


def _with(df: DataFrame, keep: Sequence[str], name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([df.schema[c] for c in keep] + [T.StructField(name, kind)])


def encode(df: DataFrame, keep: Sequence[str], text_col: str, path: str) -> DataFrame:
    """The columns ``keep`` and the token ids of a text column as ``ids``, never null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                ids = id_lists(batch.column(len(keep)), path)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(keep)], ids], [*keep, "ids"]
                )

    schema = _with(df, keep, "ids", T.ArrayType(T.IntegerType()))
    return in_small_batches(df).select(*keep, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, keep: Sequence[str], ids_col: str, path: str) -> DataFrame:
    """The columns ``keep`` and the text of an array of ids as ``text``.

    Null gives null; ids outside the vocabulary and null ids give nothing; bytes that are no
    UTF-8 become U+FFFD, as in the library.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                column = batch.column(len(keep))
                flat, at = column.values, column.offsets.to_pylist()
                valid = column.is_valid().to_pylist()
                texts = [
                    own.decode(flat.slice(s, e - s).drop_null().to_numpy().tolist()) if ok else None
                    for s, e, ok in zip(at, at[1:], valid, strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"]
                )

    return in_small_batches(df).select(*keep, ids_col).mapInArrow(run, _with(df, keep, "text", T.StringType()))
