"""Packing documents into training sequences by minimum bin slack.

A document becomes its token ids and one end id. It is cut into pieces of the
sequence length; the last, shorter piece is packed with those of other
documents. Pieces are dealt at random into windows of a bounded number. In a
window, each sequence starts with the longest piece left, and a subset-sum over
the multiset of the other lengths (a bit set as one integer, piece counts split
into powers of two) finds the filling closest to the capacity; walking the
recorded steps back tells how many pieces of each length it took.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed, slices

CAPACITY = 4096
END_ID = 2
#: Pieces in a packing window, and words whose ids a worker keeps at a time.
WINDOW = 8192
CACHED_WORDS = 500_000
TOKENIZER = "word_bpe_49k.json"

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def _tokenizer(name: str):
    """A tokenizer file by path, or by its name among the public vocabularies."""
    from tokenizers import Tokenizer

    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Tokenizer.from_file(name)


class Known:
    """Ids by word in two halves: the full newer one becomes the older, and words met again move back."""

    def __init__(self, limit: int):
        self.most, self.newer, self.older = limit // 2, {}, {}

    def look_up(self, words: list[str], learn: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        found = list(map(self.newer.get, words))
        if None in found:
            unmet = {w for w, ids in zip(words, found) if ids is None}
            self.newer.update((w, self.older[w]) for w in unmet & self.older.keys())
            new = [w for w in unmet if w not in self.newer]
            self.newer.update(zip(new, learn(new)))
            found = [self.newer[w] if ids is None else ids for w, ids in zip(words, found)]
            if len(self.newer) > self.most:
                self.newer, self.older = {}, self.newer
        return found


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    The tokenizer cuts a text into runs of letters, single digits and runs of
    signs, and looks at each by itself; most have been seen before. Texts of
    Latin letters, which have one form only, are cut here in the same way, and
    new words go straight to the tokenizer's model. Other texts are cut at
    blanks, which the tokenizer never joins, and their new parts are encoded by
    the whole tokenizer, apart from each other by a mark with an id of its own.
    """

    MARK = "\x01"
    #: Fixed value: where the tokenizer cuts lower-case text of the characters below U+0180.
    CUTS = re.compile("[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]|'s|'t|'re|'ve|'m|'ll|'d|[^a-zªµºß-öø-ſ0-9²³¹¼½¾\\s]+")
    #: Other characters, and the one letter that has two in lower case.
    ODD = re.compile("[^\t-\r\x20-\x7e\x85\xa0-\u012f\u0131-\u017f]")
    SAMPLE = "It's 2024: O'Neil-Home,\xa0x_y (don't!) 'tis 100%² Ærø-Straße, Œuvre Ω 一二"

    def __init__(self, name: str, limit: int = CACHED_WORDS):
        self.tokenizer = _tokenizer(name)
        self.words, self.parts = Known(limit), Known(limit // 4)
        # The model's alphabet: a visible character for each byte.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + k for k, b in enumerate(hidden)}
        (self.mark,) = self._ids([self.MARK])[0]
        for sample in (self.SAMPLE, self.SAMPLE[: self.SAMPLE.index("Ω")]):
            if self.encode([sample])[0] != np.array(self._ids([sample])[0], "<u4").tobytes():
                raise ValueError(f"{name} does not cut text at blanks, digits and signs")

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, new: list[str]) -> list[bytes]:
        """Ids of words that the tokenizer would not cut or change."""
        tokenize = self.tokenizer.model.tokenize
        shown = [w if w.isascii() else w.encode().decode("latin-1").translate(self.alphabet) for w in new]
        return [np.array([t.id for t in tokenize(w)], "<u4").tobytes() for w in shown]

    def _parts(self, new: list[str]) -> list[bytes]:
        """Ids of parts none of which holds a blank."""
        found: dict[str, bytes] = {}
        odd = [p for p in new if self.MARK in p]
        for part, ids in zip(odd, self._ids(odd)):
            found[part] = np.array(ids, "<u4").tobytes()
        rest = [p for p in new if self.MARK not in p]
        for at in range(0, len(rest), 20_000):
            chunk = rest[at : at + 20_000]
            ids = np.array(self._ids([f" {self.MARK} ".join(chunk)])[0], "<u4")
            flat, ends = ids.tobytes(), [*np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            start = 0
            for part, end in zip(chunk, ends, strict=True):
                found[part] = flat[4 * start : 4 * end]
                start = end + 1
        return [found[p] for p in new]

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if "<|" in text or self.ODD.search(text):  # special tokens start so
                parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                out.append(b"".join(self.parts.look_up(parts, self._parts)))
            else:
                out.append(b"".join(self.words.look_up(self.CUTS.findall(text.lower()), self._words)))
        return out


@lru_cache(maxsize=2)
def _encoder(name: str) -> WordEncoder:
    """One encoder for all tasks of a worker process, which thus learns a part once."""
    return WordEncoder(name)


def _pieces(tokenizer: str, capacity: int, end_id: int, keep_ids: bool) -> Callable:
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(5 + keep_ids)]
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    row = [doc_id, start, len(piece) // 4, zlib.crc32(piece), total]
                    for column, value in zip(out, [*row, piece] if keep_ids else row):
                        column.append(value)
            arrays = [pa.array(c, pa.int64()) for c in out[:5]] + [pa.array(c, pa.binary()) for c in out[5:]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return cut


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length fill one sequence closest to ``capacity``.

    Starts with the longest length in ``counts``; the others follow by subset
    sums. Stops as soon as an exact filling is known.
    """
    longest = max(counts)
    taken = {longest: 1}
    target = capacity - longest
    mask = (1 << (target + 1)) - 1
    sums, steps = 1, []
    for length in sorted((x for x in counts if x <= target), reverse=True):
        left = min(counts[length] - (length == longest), target // length)
        times = 1
        while left > 0 and not sums >> target & 1:
            n = min(times, left)
            steps.append((length, n, sums))
            sums |= sums << (length * n) & mask
            left -= n
            times *= 2
        if sums >> target & 1:
            break
    rest = sums.bit_length() - 1
    for length, n, before in reversed(steps):
        if not before >> rest & 1:
            rest -= length * n
            taken[length] = taken.get(length, 0) + n
    return taken


def pack_window(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of every piece of a window."""
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    pools: dict[int, list[int]] = {}
    number = 0
    for i, length in enumerate(lengths):
        if length == capacity:
            sequence[i] = number
            number += 1
        else:
            pools.setdefault(length, []).append(i)
    counts = {length: len(pool) for length, pool in pools.items()}
    while counts:
        at = 0
        for length, n in fill(counts, capacity).items():
            for _ in range(n):
                i = pools[length].pop()
                sequence[i], offset[i] = number, at
                at += length
            counts[length] -= n
            if not counts[length]:
                del counts[length]
        number += 1
    return sequence, offset


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    window: int = WINDOW,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``, and with ``keep_ids`` its ``ids`` as bytes.

    ``start`` counts the document's ids before the piece, ``offset`` those of
    the sequence. A missing or empty text has the end id alone. Every row of
    ``docs`` is packed by itself, so repeated ids or rows are kept apart. A text
    of any length is cut; an empty table gives no rows. Windows have the same
    expected size at every input size, and each leaves at most a few sequences
    short of full.
    """
    schema = PIECE + ", ids binary" * keep_ids
    cut = _pieces(tokenizer, capacity, end_id, keep_ids)
    pieces = fixed(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema))
    windows = max(1, -(-pieces.count() // window))
    dealt = pieces.withColumn("_window", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(windows)).cast("int"))

    def place(rows: pa.Table) -> pa.Table:
        sequence, offset = pack_window(rows.column("length").to_pylist(), capacity)
        base = rows.column("_window")[0].as_py() << 32
        rows = rows.drop_columns(["_window"])
        rows = rows.append_column("sequence_id", pa.array([base + s for s in sequence], pa.int64()))
        return rows.append_column("offset", pa.array(offset, pa.int64()))

    return dealt.groupBy("_window").applyInArrow(place, schema + ", sequence_id long, offset long")
