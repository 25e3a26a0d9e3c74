"""Token ids of whole texts by a byte-level BPE vocabulary file.

The splitting pattern of such a vocabulary never joins a character that isn't white space with white
space after it, nor a letter with a following mark or digit.  A text can therefore be cut at those
places, the pieces encoded one by one, and the ids put together again; the result is that of encoding
the text as a whole.  Pieces repeat far more often than texts: the pieces of a batch are
dictionary-encoded, only distinct ones reach the tokenizer, and each worker keeps what it has met.
Cuts are made only beside characters whose class is known here (ASCII and the letters of Latin-1);
everything else stays inside longer pieces.

The file's added tokens are matched before the pattern, so a text that holds one is encoded as it is.
"""

from __future__ import annotations

import os
import re
import weakref
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

LONGEST_KEPT = 64
MOST_KEPT = 200_000
BATCH_BYTES = 2 << 20

SPACE, LETTER, MARK, LEAD, OTHER = 1, 2, 3, 4, 0


def _byte_classes() -> np.ndarray:
    classes = np.zeros(256, np.uint8)
    classes[0x21:0x7F] = MARK
    for low, high in ((0x41, 0x5B), (0x61, 0x7B)):
        classes[low:high] = LETTER
    classes[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
    classes[0xC3] = LEAD
    return classes


_CLASSES = _byte_classes()


def _byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in the files of byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_NAMES = _byte_names()
# one space at most and letters only: certainly one unit of the splitting pattern
_ONE_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Offsets at which a piece begins, document starts among them."""
    kind = _CLASSES[data]
    lead = kind[:-1] == LEAD
    after = kind[1:]
    # second bytes of Latin-1 letters; the two signs among them are marks
    after[lead] = LETTER
    sign = lead & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    after[sign] = MARK
    known = (kind == LETTER) | (kind == MARK)
    begin = np.zeros(len(data) + 1, bool)
    begin[1:-1] = (kind[1:] == SPACE) & known[:-1]
    begin[1:-1] |= (kind[:-1] == LETTER) & (kind[1:] == MARK) & ~sign & (data[1:] < 0x80)
    begin[starts] = True
    begin[-1] = False
    return np.flatnonzero(begin)


class Encoder:
    """``encode(texts)`` gives the ids of all texts in one array and where each text's ids begin."""

    def __init__(self, vocabulary: str, dtype: str = "<u2"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype(dtype)
        if self.tokenizer.get_vocab_size() > np.iinfo(self.dtype).max + 1:
            raise ValueError(f"ids of {vocabulary} don't fit {dtype}")
        self.kept: dict[bytes, bytes] = {}
        self.kept_before: dict[bytes, bytes] = {}

    def _new(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as bytes."""
        out: list[bytes] = [b""] * len(pieces)
        # a line for each piece; those that hold a line break are none of the words
        lines = [p if _ONE_WORD.match(p) else b"" for p in pieces]
        words = b"\n".join(lines).decode("latin-1").translate(_NAMES).split(_NAMES[0x0A])
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(w)] if w else () for w in words]
        flat = np.fromiter(chain.from_iterable(found), self.dtype).tobytes()
        width, low = self.dtype.itemsize, 0
        for k, ids in enumerate(found):
            high = low + width * len(ids)
            out[k] = flat[low:high]
            low = high
        rest = [k for k, line in enumerate(lines) if not line]
        if rest:
            texts = [pieces[k].decode() for k in rest]
            for k, x in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[k] = np.array(x.ids, self.dtype).tobytes()
        return out

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        ids = list(map(self.kept.get, pieces))
        missing = [k for k, x in enumerate(ids) if x is None]
        if not missing:
            return ids
        names = [pieces[k] for k in missing]
        before = list(map(self.kept_before.get, names))
        unknown = [k for k, x in enumerate(before) if x is None]
        for k, x in zip(unknown, self._new([names[k] for k in unknown]) if unknown else ()):
            before[k] = x
        for k, x in zip(missing, before):
            ids[k] = x
        self.kept.update((p, x) for p, x in zip(names, before) if len(p) <= LONGEST_KEPT)
        if len(self.kept) > MOST_KEPT:
            # a piece stays if it comes again before as many others have come
            self.kept, self.kept_before = {}, self.kept
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``texts`` without nulls.  Text k has the ids ``ids[bounds[k]:bounds[k + 1]]``."""
        texts = texts.cast(pa.large_binary())
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            whole |= pa.compute.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._cut_and_encode(texts)
        ids, bounds = self._cut_and_encode(pa.compute.if_else(pa.array(whole), pa.scalar(b"", pa.large_binary()), texts))
        parts = [
            np.array(self.tokenizer.encode(texts[k].as_py().decode(), add_special_tokens=False).ids, self.dtype)
            if whole[k]
            else ids[bounds[k] : bounds[k + 1]]
            for k in range(len(texts))
        ]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)

    def _cut_and_encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        if first == last:
            return np.zeros(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
        starts = offsets - first
        cuts = _cuts(data, starts[:-1][starts[:-1] < len(data)])
        bounds = np.append(cuts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        ).dictionary_encode()
        ids = self._ids(pieces.dictionary.to_pylist())
        width = self.dtype.itemsize
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        flat = np.frombuffer(b"".join(ids), self.dtype)
        place = np.concatenate(([0], np.cumsum(length)))
        codes = pieces.indices.to_numpy(zero_copy_only=False)
        n = length[codes]
        ends = np.cumsum(n)
        take = np.arange(int(ends[-1])) + np.repeat(place[codes] - ends + n, n)
        before = np.concatenate(([0], ends))
        return flat[take], before[np.searchsorted(cuts, starts)]


def slices(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column with about ``limit`` bytes each, one row at least."""
    sizes = np.asarray(
        pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64
    )
    total, start = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, row
            total, start = 0, row
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


_encoders: weakref.WeakValueDictionary[tuple[str, str], Encoder] = weakref.WeakValueDictionary()


def encoder(vocabulary: str | None, dtype: str = "<u2") -> Encoder:
    """The worker's encoder of a vocabulary.

    It lives as long as some task holds it; workers are used again, so that one kept for good would take
    its memory from all later stages.
    """
    path = vocabulary or vocabulary_path()
    found = _encoders.get((path, dtype))
    if found is None:
        found = _encoders[path, dtype] = Encoder(path, dtype)
    return found


def encoded(
    batch: pa.RecordBatch, text_col: str, vocabulary: str | None, dtype: str = "<u2"
) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) for every row of a batch; a null text counts as empty."""
    texts = pa.compute.fill_null(batch.column(text_col), "")
    for low, high in slices(texts):
        ids, bounds = encoder(vocabulary, dtype).encode(texts.slice(low, high - low))
        for k in range(high - low):
            yield low + k, ids[bounds[k] : bounds[k + 1]]
