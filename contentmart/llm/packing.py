"""Packing tokenised documents into fixed-length sequences by bounded-space online best-fit.

Documents are tokenised, cut into pieces only where they are longer than a sequence, and placed in
arrival order, that of the rows of the corpus, into the open bin that they fill best.  Open bins are kept in a
bitset keyed by free space (bit f is set when an open bin has f tokens free), so the best bin is the lowest set
bit at or above the need.  At most ``open_bins`` bins are open; when one more is needed the fullest closes.

Scale: pieces are dealt evenly to packing tasks by a hash, whatever their source; a task holds the
bitset and its open bins only.  The bins that a task leaves unfilled are packed again as wholes, in
a second round over fewer tasks, so that the loss does not grow with the number of tasks.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Container, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import materialise, pick

if TYPE_CHECKING:  # tasks that need no pandas hold none
    import pandas as pd

SEQUENCE = 4096
OPEN_BINS = 512
#: Pieces aimed at for one packing task.
PIECES_PER_TASK = 16_384
#: Entries of a worker's cache of tokenised words; it is emptied when full.
CACHE_WORDS = 600_000
#: Characters of texts whose words are looked up together.
RUN_CHARS = 1 << 18
#: Lowered words that go through the tokenizer in one text.
JOINED_WORDS = 1024


class BestFit:
    """Bounded-space online best-fit over bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int, first_id: int = 0):
        self.capacity, self.open_bins, self.next_id = capacity, open_bins, first_id
        self.bits, self.n_open, self.n_closed = 0, 0, 0  # closed: by the bound, with space left
        self.bins: dict[int, list[int]] = {}  # free space -> ids of open bins

    def _open(self, free: int, bin_id: int) -> None:
        self.bins.setdefault(free, []).append(bin_id)
        self.bits |= 1 << free
        self.n_open += 1

    def _take(self, free: int) -> int:
        ids = self.bins[free]
        bin_id = ids.pop()
        if not ids:
            del self.bins[free]
            self.bits ^= 1 << free
        self.n_open -= 1
        return bin_id

    def place(self, need: int) -> tuple[int, int]:
        """(bin id, offset) for an item of 1 to ``capacity``."""
        fitting = self.bits >> need
        if fitting:
            free = need + ((fitting & -fitting).bit_length() - 1)
            bin_id = self._take(free)
        else:
            free, bin_id = self.capacity, self.next_id
            self.next_id += 1
        if free > need:
            if self.n_open >= self.open_bins:  # the fullest closes, be it this one
                self.n_closed += 1
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest < free - need:
                    self._take(fullest)
                    self._open(free - need, bin_id)
            else:
                self._open(free - need, bin_id)
        return bin_id, self.capacity - free


# --- tokens -------------------------------------------------------------------

_WORKER: dict = {}
#: Bytes with A to Z lowered and a line feed made a space; no other UTF-8 byte is touched.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 10 else c for c in range(256))
#: Latin letters that lowering and normalising keep one letter each (not the dotted capital I), then ASCII signs
#: and digits without the apostrophe, which the vocabulary joins with letters.
_STEM = re.compile("([a-zß-öø-įıĲ-ɏ]+)([!-&(-@\\[-`{-~]*)")


def _encoder(path: str):
    """The worker's tokenizer and its cache of words, kept between tasks."""
    if _WORKER.get("path") != path:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        last = np.zeros(max(vocabulary.values()) + 1, bool)
        last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        _WORKER.update(path=path, tokenizer=tokenizer, cache={}, last=last)
    return _WORKER["tokenizer"], _WORKER["cache"]


def forget() -> None:
    """Frees the worker's tokenizer and words, for tasks that need neither, and what freed memory it still holds."""
    _WORKER.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def encode(texts: list[str], path: str) -> Iterator[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space, lowers letters and never joins tokens across white space, or
    across an ASCII sign or digit (but the apostrophe) that follows a letter.  So a text's ids are the ids of
    its words in order, and each distinct lowered word is encoded once by the tokenizer itself.  A text that
    could hold a special token's string is encoded as it is.
    """
    tokenizer, _ = _encoder(path)
    for run in _runs(texts):
        split = [None if "<|" in text else text.encode().translate(_LOWER).decode().split(" ") for text in run]
        ids = known_words(set().union(*filter(None, split)), path)
        for text, words in zip(run, split, strict=True):
            if words is None:
                yield _bytes(tokenizer.encode(text, add_special_tokens=False))
            else:
                yield b"".join(map(ids.__getitem__, words))


def _runs(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in runs of about RUN_CHARS characters."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= RUN_CHARS:
            yield run
            run, held = [], 0
    if run:
        yield run


def encode_words(words: list[str], path: str) -> bytes:
    """Ids of lowered words one after another."""
    return b"".join(encoded_words(words, path))


def encoded_words(words: list[str], path: str, kept: int = CACHE_WORDS) -> Iterator[bytes]:
    """Ids of each lowered word; the worker keeps those of at most ``kept`` words."""
    return map(known_words(set(words), path, kept).__getitem__, words)


def known_words(words: set[str], path: str, kept: int = CACHE_WORDS, lasting: Container[str] = ()) -> dict[str, bytes]:
    """The worker's cache, which holds the ids of all ``words`` (lowered) until the next call; when it is full, it
    keeps those of ``lasting`` words only."""
    tokenizer, cache = _encoder(path)
    new = words.difference(cache)
    if len(cache) + 2 * len(new) > kept:
        stay = {w: ids for w, ids in cache.items() if w in lasting}
        cache.clear()
        if len(stay) + 2 * len(new) <= kept:
            cache.update(stay)
        new = words.difference(cache)
    stems, plain, ended = set(), set(), []
    for w in new:
        found = _STEM.fullmatch(w)
        if not found:
            plain.add(w)
        elif found[2]:
            ended.append((w, found[1], found[2]))
            stems.add(found[1])
            plain.add(found[2])
        else:
            stems.add(w)
    _encode_stems(list(stems.difference(cache)), tokenizer, cache)
    _encode_each(list(plain.difference(cache)), tokenizer, cache)
    for w, stem, rest in ended:
        cache[w] = cache[stem] + cache[rest]
    return cache


def _encode_stems(stems: list[str], tokenizer, cache: dict[str, bytes]) -> None:
    """Words of letters only, many in a text: each is cut off where a token ends a word."""
    for i in range(0, len(stems), JOINED_WORDS):
        part = stems[i : i + JOINED_WORDS]
        ids = np.asarray(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(_WORKER["last"][ids]) + 1)).tolist()
        if len(ends) != len(part):  # a vocabulary that doesn't mark the ends of words
            _encode_each(part, tokenizer, cache)
            continue
        raw = ids.tobytes()
        cache.update(zip(part, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))


def _encode_each(words: list[str], tokenizer, cache: dict[str, bytes]) -> None:
    for i in range(0, len(words), 4096):
        part = words[i : i + 4096]
        for w, e in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
            cache[w] = _bytes(e)


def _bytes(encoding) -> bytes:
    return np.asarray(encoding.ids, "<u4").tobytes()


PIECES = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, sequence: int, end_id: int):
    end = np.asarray([end_id], "<u4").tobytes()
    step = 4 * sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid, doc_id = b.column("rid").to_pylist(), b.column("doc_id").to_pylist()
            out = []
            for r, d, ids in zip(rid, doc_id, encode(b.column("text").to_pylist(), path), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    out.append((r, d, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["rid", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, tokenizer_path: str, id_col="doc_id", text_col="text", sequence=SEQUENCE, end_id=1):
    """Tokenised pieces of whole texts: doc_id, piece, start, length, ids_crc32, and rid, the row."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("rid"),
    )
    return rows.mapInArrow(_pieces(tokenizer_path, sequence, end_id), PIECES)


# --- placement ----------------------------------------------------------------


def _pack_group(capacity: int, open_bins: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", ignore_index=True)
        packer = BestFit(capacity, open_bins)
        placed = [packer.place(int(n)) for n in pdf["length"]]
        pdf["bin"] = [b for b, _ in placed]
        pdf["at"] = [o for _, o in placed]
        pdf["grp"] = np.int64(key[0])
        return pdf[["grp", "item", "length", "bin", "at"]]

    return run


def place(items: DataFrame, groups: int, capacity: int, open_bins: int) -> DataFrame:
    """Place ``items`` (item long, length long), which arrive by rising item, into bins: adds grp, bin (within
    grp) and at."""
    keyed = items.select(
        "item",
        "length",
        F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"),
    )
    return keyed.groupBy("grp").applyInPandas(
        _pack_group(capacity, open_bins), "grp long, item long, length long, bin long, at long"
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = 1,
    open_bins: int = OPEN_BINS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids end with ``end_id``, so a null or empty text is one piece of one token.  Only
    documents longer than ``sequence`` are cut.  A task's pieces arrive in the order of their rows;
    equal lengths and repeated rows are separate items.  Offsets in a sequence run from 0 without
    gaps.  A null id is carried through; an empty table gives an empty result; extra columns are
    ignored, whatever their names.
    """
    made, _ = materialise(
        pieces(docs, tokenizer_path, id_col, text_col, sequence, end_id).withColumn(
            "item", F.monotonically_increasing_id()
        ),
        "pack-pieces",
    )
    n = made.count()
    groups = max(1, -(-n // pieces_per_task))
    placed, _ = materialise(place(made.select("item", "length"), groups, sequence, open_bins), "pack-first")

    # Second round: bins that are not full are items of their own; a full bin stays as it is.
    bins = placed.groupBy("grp", "bin").agg(F.sum("length").alias("length"))
    bins = bins.select((F.col("grp") * (1 << 32) + F.col("bin")).alias("item"), "length")
    bins, _ = materialise(bins, "pack-bins")
    loose = bins.filter(F.col("length") <= sequence // 2)
    n_loose = loose.count()
    again = max(1, -(-n_loose // pieces_per_task))
    second, _ = materialise(
        place(loose, again, sequence, open_bins).select(
            F.col("item").alias("first_bin"),
            ((F.col("grp") + groups) * (1 << 32) + F.col("bin")).alias("new_bin"),
            "at",
        ),
        "pack-second",
    )
    first = placed.select("item", (F.col("grp") * (1 << 32) + F.col("bin")).alias("first_bin"), F.col("at").alias("at0"))
    final = first.join(second, "first_bin", "left").select(
        "item",
        F.coalesce("new_bin", "first_bin").alias("sequence_id"),
        (F.col("at0") + F.coalesce("at", F.lit(0))).alias("offset"),
    )
    return made.join(final, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
