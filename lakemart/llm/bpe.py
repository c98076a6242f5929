"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

Texts repeat their words, so a batch is first cut into *units* at places where
the split pattern always starts a new match; the library then encodes each
distinct unit once and the ids are put back by index.  The result equals the
encoding of the whole text; only the amount of work differs.

Where a cut is safe, for the split pattern of byte-level BPE
(``'s|'t|... | ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``):
 * before a single blank between two characters that are not white space: no
   alternative holds a blank after its first character, and a match that
   starts at the blank does not look back;
 * between an ASCII letter and an ASCII punctuation character.
Around characters that may be other white space no cut is made; such units
are longer, never wrong.

Most units are letters, digits or punctuation alone, with a blank in front or
not: the pattern takes such a unit as one match.  Those go to the library
already split, in the characters that stand for their bytes, so it has no
pattern to match; the others go through its whole path.

A text that holds one of the vocabulary's added tokens (as ``<|endoftext|>``)
is encoded whole, by the untouched tokenizer, which takes the token's own id.

Defined results: NULL counts as the empty text, which has no ids.  Repeated
rows are encoded alike; an empty batch or table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm import textbatch as tb

SLICE_BYTES = 6 << 20
KNOWN_UNITS = 300_000      # units a task remembers between slices: bounds its memory, not its results
JOINED_UNITS = 1000        # units given to the library as one text

_ODD = np.zeros(256, dtype=bool)                      # may begin or be white space that is not a plain blank
_ODD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_AFTER = ~(tb.BLANK | _ODD)                           # safe first byte after a blank
_BEFORE = ~(tb.BLANK | _ODD)
_BEFORE[0x80:] = False                                # safe ASCII byte before a blank
_ALPHA = np.zeros(256, dtype=bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[0x21:0x7F] = True
_PUNCT[48:58] = False
_PUNCT &= ~_ALPHA
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
# Letters of one byte, and both bytes of letters up to U+027F and of U+0400 to
# U+047F; the two signs among them (times, divide) are taken out where met.
_LETTER = _ALPHA.copy()
_LETTER[0x80:0xC0] = True
_LETTER[0xC3:0xCA] = _LETTER[[0xD0, 0xD1]] = True


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others for the code
    points from 256 on, in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte) if byte in keep else chr(spare))
        spare += byte not in keep
    return out


def tokenizer_from_file(path: str) -> str:
    """The tokenizer of a JSON file, as text that can be sent to tasks."""
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def tokenizer_from_ranks(path: str) -> str:
    """A byte-level BPE tokenizer equal to the ranks of a rank file.

    A rank file merges any two neighbours whose joined bytes have a rank, the
    lowest rank first.  The library merges listed pairs, the first listed
    first; so every split of every token into two tokens is listed, by the
    token's rank.  A piece that is itself a token is taken whole.
    """
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers

    with open(path, "rb") as fh:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in fh if line.strip())}
    char = byte_chars()
    text = {token: "".join(char[x] for x in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        for k in range(1, len(token)):
            if token[:k] in ranks and token[k:] in ranks:
                merges.append((text[token[:k]], text[token[k:]]))
    tok = Tokenizer(models.BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    tok.decoder = decoders.ByteLevel()
    return tok.to_str()


class ByteBpe:
    """Encoder and decoder for Arrow arrays of texts.

    ``spec`` is a tokenizer's JSON text; it must use the byte-level split
    pattern and no normaliser, since the cuts rely on them.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer

        parts = json.loads(spec)
        split = parts.get("pre_tokenizer") or {}
        if parts.get("normalizer") or split.get("type") != "ByteLevel" or not split.get("use_regex", True) \
                or split.get("add_prefix_space"):
            raise ValueError("a byte-level tokenizer without normaliser or prefix space is needed")
        self.tok, self.plain = Tokenizer.from_str(spec), Tokenizer.from_str(spec)
        self.tok.encode_special_tokens = True
        self.model = Tokenizer(self.tok.model)               # takes text that is split already
        self.added = [t["content"] for t in parts.get("added_tokens") or [] if t.get("content")]
        self._stands_for = {k: c for k, c in enumerate(byte_chars()) if k != 0x0A}
        vocabulary = self.tok.get_vocab()
        self._whole = all(c in vocabulary for c in byte_chars())       # no text is lost in ids
        self._line = self.tok.token_to_id(byte_chars()[0x0A])
        self._forget()

    # -- encoding ---------------------------------------------------------

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the n+1 offsets of the texts into them."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for lo, hi in tb.slices(texts, SLICE_BYTES):
            for part, size in self._encode_runs(texts.slice(lo, hi - lo)):
                ids.append(part)
                sizes.append(size)
        return np.concatenate(ids), np.cumsum(np.concatenate(sizes))

    def _encode_runs(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Runs of texts without added tokens together, the others alone."""
        whole = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            whole |= np.asarray(pc.fill_null(pc.match_substring(texts, token), False))
        first = 0
        for k in [*np.flatnonzero(whole).tolist(), len(texts)]:
            if k > first:
                yield self._encode_slice(texts.slice(first, k - first))
            if k < len(texts):
                got = self.plain.encode(texts[k].as_py(), add_special_tokens=False).ids
                yield np.array(got, dtype=np.uint32), np.array([len(got)])
            first = k + 1

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        b, off = tb.byte_view(texts)
        if not len(b):
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        starts = _unit_starts(b, off)
        units = pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(b)).astype(np.int32)), pa.py_buffer(b)]).dictionary_encode()
        unit_of = units.indices.to_numpy()
        first, size, ids = self._ids_of(units.dictionary, unit_of)
        sizes = size[unit_of]
        out = ids[tb.expand(first[unit_of], sizes)]
        total = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=total[1:])
        at = total[np.searchsorted(starts, off)]
        return out, np.diff(at)

    def _ids_of(self, units: pa.Array, unit_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and ids of distinct units, from memory where possible."""
        known = pc.index_in(units, value_set=self._known)
        new = np.flatnonzero(np.asarray(known.is_null()))
        seen = np.asarray(pc.fill_null(known, 0)).astype(np.int64)
        fresh = units.take(pa.array(new)) if len(new) < len(units) else units
        new_ids, new_size = self._encode_units(fresh)
        first, size = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        if len(self._known):
            first[:], size[:] = self._first[seen], self._size[seen]
        new_first = len(self._ids) + np.cumsum(new_size) - new_size
        first[new], size[new] = new_first, new_size
        ids = np.concatenate([self._ids, new_ids])
        room = KNOWN_UNITS - len(self._known)
        if room > 0 and len(new):
            often = np.flatnonzero(np.bincount(unit_of, minlength=len(units))[new] > 1)[:room]
            self._known = pa.concat_arrays([self._known, fresh.take(pa.array(often))])
            self._first = np.append(self._first, len(self._ids) + np.cumsum(new_size[often]) - new_size[often])
            self._size = np.append(self._size, new_size[often])
            kept = new_ids[tb.expand((new_first - len(self._ids))[often], new_size[often])]
            self._ids = np.concatenate([self._ids, kept])
        return first, size, ids

    def _forget(self) -> None:
        self._known = pa.array([], pa.binary())
        self._first, self._size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each unit."""
        b, off = tb.byte_view(units)
        single = _one_match(b, off)
        if not self._whole or not single.any():
            return self._encode_mixed(units)
        at = np.concatenate([np.flatnonzero(single), np.flatnonzero(~single)])
        a_ids, a_size = self._encode_split(units.take(pa.array(np.flatnonzero(single))))
        b_ids, b_size = self._encode_mixed(units.take(pa.array(np.flatnonzero(~single))))
        ids, by_kind = np.concatenate([a_ids, b_ids]), np.concatenate([a_size, b_size])
        size, first = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        size[at], first[at] = by_kind, np.cumsum(by_kind) - by_kind
        return ids[tb.expand(first, size)], size

    def _encode_split(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for units that are one match each.  Ids stand
        for bytes, so their lengths tell where a unit ends."""
        b, off = tb.byte_view(units)
        lines = np.full(len(b) + len(units), 0x0A, dtype=np.uint8)     # no such unit holds a line break
        lines[np.arange(len(b)) + np.repeat(np.arange(len(units)), np.diff(off))] = b
        words = lines.tobytes().decode("latin-1").translate(self._stands_for).split("\n")[:-1]
        got = [np.array(self.model.encode_batch_fast([words[k:k + JOINED_UNITS]], is_pretokenized=True, add_special_tokens=False)[0].ids,
                        dtype=np.uint32) for k in range(0, len(words), JOINED_UNITS)]
        ids = np.concatenate([np.zeros(0, np.uint32), *got])
        ends = np.searchsorted(np.cumsum(np.diff(self._token_table()[1])[ids]), off[1:]) + 1
        return ids, np.diff(np.append(0, ends))

    def _encode_mixed(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for any units.  Plain ones (at most a leading
        blank, no line break) are joined by line breaks, whose id then marks
        the ends; the others are encoded one by one."""
        n = len(units)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        b, off = tb.byte_view(units)
        odd = np.zeros(len(b) + 1, dtype=np.int64)
        np.cumsum(tb.BLANK[b] | _ODD[b], out=odd[1:])
        lead = (b[off[:-1]] == 0x20).astype(np.int64)
        plain = (odd[off[1:]] - odd[off[:-1]] == lead) & (np.diff(off) > lead)
        if self._line is None:
            plain[:] = False
        size = np.zeros(n, dtype=np.int64)
        parts: list[np.ndarray] = []
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        strings = units.take(pa.array(order)).cast(pa.string()).to_pylist()
        n_plain = int(plain.sum())
        joined = ["\n".join(strings[k:min(k + JOINED_UNITS, n_plain)]) + "\n" for k in range(0, n_plain, JOINED_UNITS)]
        for got in self.tok.encode_batch_fast(joined, add_special_tokens=False):
            parts.append(np.array(got.ids, dtype=np.uint32))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        ends = np.flatnonzero(flat == self._line) if n_plain else np.zeros(0, np.int64)
        size[order[:n_plain]] = np.diff(np.append(-1, ends)) - 1
        flat = np.delete(flat, ends)
        odd_ids = [np.array(got.ids, dtype=np.uint32)
                   for got in self.tok.encode_batch_fast(strings[n_plain:], add_special_tokens=False)]
        size[order[n_plain:]] = [len(x) for x in odd_ids]
        flat = np.concatenate([flat, *odd_ids])
        first = np.empty(n, dtype=np.int64)
        first[order] = np.cumsum(size[order]) - size[order]
        return flat[tb.expand(first, size)], size

    # -- decoding ---------------------------------------------------------

    def token_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens, concatenated, and their offsets by id."""
        byte = {c: k for k, c in enumerate(byte_chars())}
        table = [self.tok.id_to_token(k) or "" for k in range(self.tok.get_vocab_size())]
        raw = [bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t in table]
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])

    def _token_table(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_bytes"):
            self._bytes = self.token_bytes()
        return self._bytes

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ids stand for and the n+1 offsets of the texts.  A
        character may be split over ids; its bytes meet again here."""
        flat, at = self._token_table()
        sizes = np.diff(at)[ids]
        total = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(sizes, out=total[1:])
        return flat[tb.expand(at[ids], sizes)], total[offsets]

    def char_offsets(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """For the ids of one text: first and one past the last character
        (code point) that each id touches; ids that share a split character
        overlap in it."""
        b, ends = self.decode(ids, np.arange(len(ids) + 1))
        char = np.cumsum((b & 0xC0) != 0x80) - 1
        return [(int(char[s]), int(char[e - 1]) + 1) if e > s else (0, 0) for s, e in zip(ends[:-1], ends[1:])]


ENCODED_TYPE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))])
DIGEST_TYPE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                            T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def encode_texts(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids of every text, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = of_worker(spec)
        for batch in batches:
            ids, off = bpe.encode(batch.column(1))
            lists = pa.LargeListArray.from_arrays(pa.array(off), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists.cast(pa.list_(pa.int64()))], names=ENCODED_TYPE.names)

    return _rows(docs, id_col, text_col).mapInArrow(run, ENCODED_TYPE)


def decode_ids(encoded: DataFrame, spec: str) -> DataFrame:
    """The text of every row of ``encode_texts``, as bytes (ids may be cut
    inside a character, so they need not be valid text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = of_worker(spec)
        for batch in batches:
            out = []
            for ids in batch.column(1).to_pylist():
                raw, _ = bpe.decode(np.array(ids or [], dtype=np.int64), np.array([0, len(ids or [])]))
                out.append(raw.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return encoded.mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: number of ids, sha256 of the ids (little-endian uint32)
    and sha256 of the bytes that decoding them gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = of_worker(spec)
        for batch in batches:
            for lo, hi in tb.slices(batch.column(1), SLICE_BYTES):
                ids, off = bpe.encode(batch.column(1).slice(lo, hi - lo))
                raw, at = bpe.decode(ids, off)
                raw, packed = memoryview(np.ascontiguousarray(raw)), memoryview(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(np.diff(off)),
                    pa.array([hashlib.sha256(packed[4 * s:4 * e]).hexdigest() for s, e in zip(off[:-1], off[1:])]),
                    pa.array([hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(at[:-1], at[1:])])],
                    names=DIGEST_TYPE.names)

    return _rows(docs, id_col, text_col).mapInArrow(run, DIGEST_TYPE)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _one_match(b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which units the split pattern surely takes as one match: letters, digits
    or ASCII punctuation alone, after at most one blank."""
    lead = (b[off[:-1]] == 0x20).astype(np.int64)
    size = np.diff(off) - lead
    out = np.zeros(len(lead), dtype=bool)
    letter = _LETTER[b]
    sign = np.flatnonzero((b[:-1] == 0xC3) & ((b[1:] == 0x97) | (b[1:] == 0xB7)))
    letter[sign] = False
    for kind in (letter, _DIGIT[b], _PUNCT[b]):
        total = np.zeros(len(b) + 1, dtype=np.int64)
        np.cumsum(kind, out=total[1:])
        out |= (total[off[1:]] - total[off[:-1]] == size) & (size > 0)
    return out


_OF_WORKER: dict[str, ByteBpe] = {}


def of_worker(spec: str) -> ByteBpe:
    """The tokenizer of this Python worker: tasks that follow each other in a
    worker share it, and the bounded table of units it has met."""
    if spec not in _OF_WORKER:
        _OF_WORKER.clear()
        _OF_WORKER[spec] = ByteBpe(spec)
    return _OF_WORKER[spec]


def _unit_starts(b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte positions where units start, ascending."""
    start = np.zeros(len(b) + 1, dtype=bool)
    at = np.flatnonzero(tb.BLANK[b[1:-1]]) + 1
    before = b[at - 1]
    # The byte before the blank must end a character that is surely not white
    # space: ASCII, or two bytes from U+00C0 on.
    two = b[np.maximum(at - 2, 0)]
    safe = _AFTER[b[at + 1]] & (_BEFORE[before] | ((before >= 0x80) & (two >= 0xC3) & (two < 0xE0)))
    start[at[safe]] = True
    start[1:-1] |= _ALPHA[b[:-1]] & _PUNCT[b[1:]]
    start[off] = True
    start[len(b)] = False
    return np.flatnonzero(start)
