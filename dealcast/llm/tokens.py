"""Token ids of whole texts, at the speed of their distinct words.

Both public vocabularies of merges never merge across the start of a run of
white space, so the ids of a text are the ids of its segments in a row: for the
word-level vocabulary, which drops white space, the words between it; for the
byte-level one a run of white space together with the word after it. Each slice
is split and dictionary-encoded by Arrow, only segments that the worker doesn't
remember go through the ``tokenizers`` library, and the ids are gathered by
numpy.

The memory has two generations of a bounded number of bytes. A segment that is
new goes to the young one, and one that is met again in the old one moves to
the young one. When the young one is full it becomes the old one, and the old
one is forgotten: what is met again and again stays, what isn't goes. Long
segments and those with digits hardly come again and are not remembered.

A word of plain Latin letters, with or without sentence marks after it, is one
or two pieces for the merges; it goes to the library's merge model at once,
past the normalizer and the pattern, which leave such pieces as they are (but
for lower case). That is done only if the vocabulary file declares the
normalizer and pattern below; all other words and files take the library's
whole way.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_BYTES = 14 << 20     # of each generation, about
MEMO_LONGEST = 40         # bytes of a segment that is remembered
SLICE_BYTES = 3 << 20

# The declared text rules under which the short ways are exact.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

# Letters of ASCII and Latin-1 have no other composed form and one lower case.
_PLAIN = re.compile("( ?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")
# The byte-level alphabet: printable bytes stand for themselves, the others are
# numbered from 256 upward.
_ODD = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_ALPHABET = {b: 256 + i for i, b in enumerate(_ODD)}
_SPACE = chr(_ALPHABET[32])


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Generation:
    """Distinct segments with their ids: ``first`` and ``count`` say where in
    ``ids`` those of the segment in the same row are. Rows beyond ``names`` are
    fleeting."""

    def __init__(self):
        self.names = pa.array([], pa.string())
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int32)
        self.count = np.zeros(1 << 14, np.int32)
        self.used = 0

    @property
    def bytes(self) -> int:
        return self.names.nbytes + 8 * len(self.names) + 4 * self.used

    def find(self, segments: pa.Array) -> np.ndarray:
        """Row of each segment, or -1."""
        if not len(self.names):
            return np.full(len(segments), -1, np.int32)
        return pc.fill_null(pc.index_in(segments, self.names), -1).to_numpy()

    def _room(self, rows: int, ids: int) -> None:
        while rows > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        while self.used + ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])

    def add(self, segments: pa.Array, ids: np.ndarray, sizes: np.ndarray, keep: np.ndarray) -> np.ndarray:
        """Take in segments with their ids; the row of each, which holds for the
        ``gather`` that follows. Those in ``keep`` are remembered."""
        have, n = len(self.names), len(sizes)
        self._room(have + n, len(ids))
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(~keep, kind="stable")  # the remembered ones first
        ids, _ = _gather(ids, starts, sizes, order)
        self.ids[self.used:self.used + len(ids)] = ids
        self.first[have:have + n] = self.used + np.cumsum(sizes[order]) - sizes[order]
        self.count[have:have + n] = sizes[order]
        self.names = pa.concat_arrays([self.names, segments.filter(pa.array(keep))])
        self.used += int(sizes[keep].sum())
        rows = np.empty(n, np.int32)
        rows[order] = np.arange(have, have + n)
        return rows


def _gather(ids: np.ndarray, first: np.ndarray, count: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the rows in a row, and where each row's begin (and the end)."""
    size = count[rows]
    ends = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    kind = np.int32 if max(ends[-1], len(ids)) < 1 << 31 else np.int64
    at = np.arange(ends[-1], dtype=kind)
    at += np.repeat(first[rows].astype(kind) - ends[:-1].astype(kind), size)
    return ids[at], ends


class Tokenizer:
    """``ids(texts)`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``
    of the library. The path of the vocabulary is a parameter; its file is read
    and probed for the rules that the segments need."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library
        self.model = Library.from_file(path)
        self.merges = self.model.model
        self.marks: dict[str, list[int]] = {"": []}
        self.young, self.old = _Generation(), _Generation()
        with open(path, encoding="utf-8") as f:
            self.check(path, json.load(f))

    def plain_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, segments: list[str]) -> list[list[int]]:
        got: list = [None] * len(segments)
        if self.plain:
            merged = self.merges.tokenize
            for i, w in enumerate(segments):
                if m := _PLAIN.fullmatch(w):
                    space, letters, marks = m.groups()
                    if self.lower:
                        letters = letters.lower()
                    if not w.isascii():
                        letters = letters.encode().decode("latin-1").translate(_ALPHABET)
                    tail = self.marks.get(marks)
                    if tail is None:
                        if len(self.marks) > 4096:  # runs of marks can have any length
                            self.marks = {"": []}
                        tail = self.marks[marks] = [t.id for t in merged(marks)]
                    got[i] = [t.id for t in merged(_SPACE + letters if space else letters)] + tail
        rest = [i for i, x in enumerate(got) if x is None]
        if rest:
            for i, ids in zip(rest, self.plain_ids([segments[i] for i in rest])):
                got[i] = ids
        return got

    def _rows(self, segments: pa.Array) -> np.ndarray:
        """The young generation's row of each distinct segment. What the old one
        has and what is new goes to the young one in one step."""
        rows = self.young.find(segments).copy()
        left = np.flatnonzero(rows < 0)
        if not len(left):
            return rows
        other = segments.take(pa.array(left))
        before = self.old.find(other)
        back, new = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
        names = other.take(pa.array(new))
        got = self._encode(names.to_pylist())
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter((i for x in got for i in x), np.uint32, int(sizes.sum()))
        old_ids, ends = _gather(self.old.ids, self.old.first, self.old.count, before[back])
        stays = pc.and_(pc.less_equal(pc.binary_length(names), MEMO_LONGEST), pc.invert(pc.match_substring_regex(names, "[0-9]")))
        rows[left[np.concatenate([back, new])]] = self.young.add(
            pa.concat_arrays([other.take(pa.array(back)), names]), np.concatenate([old_ids, ids]), np.concatenate([np.diff(ends), sizes]),
            np.concatenate([np.ones(len(back), bool), stays.to_numpy(zero_copy_only=False).astype(bool)]))
        return rows

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32) and the texts' offsets into them.
        A null text has none."""
        segments, offsets = self.segments(pc.fill_null(texts.cast(pa.string()), ""))
        coded = pc.dictionary_encode(segments)  # type: ignore[attr-defined]
        rows = self._rows(coded.dictionary)
        ids, ends = _gather(self.young.ids, self.young.first, self.young.count, rows[coded.indices.to_numpy()])
        if self.young.bytes > self.memo * MEMO_BYTES:
            self.young, self.old = _Generation(), self.young
        return ids, ends[offsets]


class WordTokenizer(Tokenizer):
    """For vocabularies whose pre-tokenizer drops ASCII white space."""

    lower, memo = True, 1

    def check(self, path: str, rules: dict) -> None:
        probe = self.plain_ids(["a b.c", "a", "b.c", "  a \t\n\v\f\r b.c "])
        if probe[0] != probe[1] + probe[2] or probe[3] != probe[0]:
            raise ValueError(f"the tokenizer of {path} doesn't drop white space")
        parts = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.plain = (parts[0].get("pattern") == {"Regex": PATTERN} and len(parts) == 2
                      and parts[1].get("type") == "ByteLevel" and not parts[1].get("add_prefix_space")
                      and [x.get("type") for x in (rules.get("normalizer") or {}).get("normalizers", [])] == NORMALIZERS)

    def segments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        if self.plain and not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)  # as the normalizer does; special tokens have "<|" and keep their case
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy()
        return lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


class ByteTokenizer(Tokenizer):
    """For byte-level vocabularies with the library's own pattern, by which a
    run of white space always begins a piece, and no normalizer."""

    lower, memo = False, 2  # its segments are more, as they differ by the white space before them

    def check(self, path: str, rules: dict) -> None:
        pre = rules.get("pre_tokenizer") or {}
        loose = [t for t in rules.get("added_tokens") or () if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"]]
        if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or rules.get("normalizer") or loose:
            raise ValueError(f"the tokenizer of {path} is none of bytes with the library's pattern")
        self.plain = True

    def segments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        from dealcast.llm.common import text_bytes
        raw, offsets = text_bytes(texts)
        n = len(raw)
        cut = np.zeros(n + 1, bool)
        if n:
            # before a space or line end that follows a character which certainly is no white space
            gap = (raw == 32) | (raw == 10)
            solid = (raw > 32) & (raw < 127)
            high = np.flatnonzero((raw[1:] >= 128) & np.append(gap[2:], False)) + 1  # last byte of a longer character before a gap
            a, b = raw[high - 1], raw[high]
            blank = (((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0x9A) & (b == 0x80)) | ((a == 0x81) & (b == 0x9F))
                     | ((a == 0x80) & ((b <= 0x8A) | (b == 0xA8) | (b == 0xA9) | (b == 0xAF))))
            solid[high[~blank]] = True
            cut[1:n] = gap[1:] & solid[:-1]
        cut[offsets] = True
        at = np.flatnonzero(cut)
        values = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw)))
        return values, np.searchsorted(at, offsets)


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for each path and Python worker."""
    if path not in _LOADED:
        with open(path, encoding="utf-8") as f:
            kind = ByteTokenizer if (json.load(f).get("pre_tokenizer") or {}).get("type") == "ByteLevel" else WordTokenizer
        _LOADED[path] = kind(path)
    return _LOADED[path]


def token_slices(batches: Iterator[pa.RecordBatch], path: str, column: str = "text"):
    """(slice of a batch, ids, offsets) for all batches."""
    from dealcast.llm.common import text_slices
    model = tokenizer(path)
    for batch in batches:
        for part in text_slices(batch, column, SLICE_BYTES):
            yield part, *model.ids(part.column(part.schema.get_field_index(column)))
