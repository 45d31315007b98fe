"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Encoding.  A text becomes flat numpy arrays of symbols, one per character, cut into segments where no
piece of the vocabulary can cross.  In each round every segment takes the smallest rank among its pairs,
all its pairs of that rank merge at once, leftmost first, and the arrays are compacted; a segment without
a pair leaves, and the rounds end when none is left.  Merging one by one, best rank and then leftmost
first, gives the same: a merge makes only pairs of longer pieces, and where such a pair could rank before
the piece that was merged (``early``, known from the vocabulary) a segment merges its leftmost pair only.
Segments of more than ``LONG`` characters would need very many rounds; they are merged one by one from a
queue, which is the same order.

Decoding gathers the pieces' bytes for a whole batch of ids.

Scale: one pass over the rows, no shuffle; a worker holds the vocabulary's tables and a bounded cache of
encoded words.  Text is worked on in slices of ``SLICE_BYTES``.
"""

from __future__ import annotations

import codecs
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import pick, row_runs, text_slices

SPACE = "▁"  # stands for a space in pieces
UNKNOWN_TEXT = " ⁇ "
LONG = 2000
SLICE_BYTES = 1 << 20
#: Characters, or ids, that are worked on at once; a longer word or text is worked on alone.
FLAT = 1 << 16
#: Entries of a worker's cache of encoded words; it is emptied when full.
CACHE_WORDS = 200_000
CACHED_LENGTH = 40

_NONE = np.int32(2**31 - 1)
_CODE_POINTS = 0x110000


class Vocabulary:
    """Tables of one model file: symbols of characters, ranks of pairs, bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        self.end_id, self.unk_id = sp.eos_id(), sp.unk_id()
        self.is_control = np.array([sp.is_control(i) for i in range(size)], bool)
        self.is_byte = np.array([sp.is_byte(i) for i in range(size)], bool)
        if self.is_byte.sum() not in (0, 256) or any(sp.is_unused(i) for i in range(size)):
            raise ValueError(f"{path}: unused pieces or part of the bytes")
        normal = [i for i in range(size) if not (self.is_control[i] or self.is_byte[i] or i == self.unk_id)]
        scores = {i: sp.get_score(i) for i in normal}
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}

        # A character is its piece, else a number of its own beyond the pieces.
        self.char_sym = np.arange(size, size + _CODE_POINTS, dtype=np.int32)
        symbol = {pieces[i]: i for i in normal}
        for p, i in symbol.items():
            if len(p) == 1:
                self.char_sym[ord(p)] = i
        pairs, early = {}, np.zeros(len(rank), bool)
        for i in normal:
            p, r = pieces[i], rank[scores[i]]
            for k in range(1, len(p)):
                ends = [symbol.get(e, size + ord(e) if len(e) == 1 else None) for e in (p[:k], p[k:])]
                if None not in ends:
                    pairs[ends[0] * (size + _CODE_POINTS) + ends[1]] = (r, i)
                    for e in ends:
                        if e < size and len(pieces[e]) > 1 and r <= rank[scores[e]]:
                            early[rank[scores[e]]] = True
        keys = sorted(pairs)
        self.early = early
        self.pair_key = np.array([*keys, 2**62], np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in keys] + [_NONE], np.int32)
        self.pair_piece = np.array([pairs[k][1] for k in keys] + [0], np.int32)

        # Characters that stand beside each other in some piece; segments are cut everywhere else.
        beside = {(a, b) for i in normal for a, b in itertools.pairwise(pieces[i])}
        known = {c: n + 1 for n, c in enumerate(sorted({c for ab in beside for c in ab}))}
        self.char_class = np.zeros(_CODE_POINTS, np.int32)
        for c, n in known.items():
            self.char_class[ord(c)] = n
        self.joined = np.zeros((len(known) + 1, len(known) + 1), bool)
        for a, b in beside:
            self.joined[known[a], known[b]] = True
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in known)
        words = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else "")
        self.words = re.compile(words if not any(b == SPACE != a for a, b in beside) else r"(?s).+")

        self.byte_id = np.zeros(256, np.int32)
        self.byte_id[:] = self.unk_id
        for i in np.flatnonzero(self.is_byte):
            self.byte_id[int(pieces[i][1:-1], 16)] = i
        spelled = [pieces[i].replace(SPACE, " ") for i in range(size)]
        spelled[self.unk_id] = UNKNOWN_TEXT
        raw = [bytes([int(pieces[i][1:-1], 16)]) if self.is_byte[i] else b"" if self.is_control[i] else spelled[i].encode() for i in range(size)]
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_len = np.array([len(r) for r in raw], np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.leads_space = np.array([pieces[i].startswith(SPACE) and i in scores for i in range(size)], bool)
        self.cache: dict[str, bytes] = {}
        probe = f" a  b{SPACE}\n\x00 The endé\U0001f600"
        if [*np.frombuffer(self.encode(probe), "<i4")] != sp.encode(probe):
            raise ValueError(f"{path}: not a BPE model that keeps texts as they are")

    # --- encoding ---

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * (self.size + _CODE_POINTS) + right
        at = np.searchsorted(self.pair_key, key)
        hit = self.pair_key[at] == key
        return np.where(hit, self.pair_rank[at], _NONE), self.pair_piece[at]

    def merge(self, sym: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Symbols after all merges: each character's place holds the piece that begins there, or -1."""
        out = np.full(len(sym), -1, np.int32)
        if not len(sym):
            return out
        pos = np.arange(len(sym))
        lens = np.diff(np.append(starts, len(sym)))
        rank, piece = np.full(len(sym), _NONE, np.int32), np.zeros(len(sym), np.int32)
        rank[:-1], piece[:-1] = self._pairs(sym[:-1], sym[1:])
        rank[starts[1:] - 1] = _NONE  # no pair across segments
        while True:
            best = np.minimum.reduceat(rank, starts)
            done = best == _NONE
            if done.any():
                over = np.repeat(done, lens)
                out[pos[over]] = sym[over]
                sym, pos, rank, piece = (x[~over] for x in (sym, pos, rank, piece))
                best, lens = best[~done], lens[~done]
                if not len(sym):
                    return out
                starts = np.cumsum(lens) - lens
            segment = np.repeat(np.arange(len(lens)), lens)
            at = np.flatnonzero(rank == best[segment])
            new_run = np.diff(at, prepend=-2) != 1
            run_start = at[new_run][np.cumsum(new_run) - 1]
            at = at[(at - run_start) % 2 == 0]  # of overlapping pairs the leftmost, then every other
            later = np.diff(segment[at], prepend=-1) == 0
            at = at[~(later & self.early[rank[at]])]

            sym[at] = piece[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            lens = lens - np.bincount(segment[at], minlength=len(lens))
            starts = np.cumsum(lens) - lens
            sym, pos, rank, piece = (x[stay] for x in (sym, pos, rank, piece))
            at -= np.arange(len(at))
            changed = np.zeros(len(sym) + 1, bool)
            changed[at] = True
            changed[at - 1] = True  # of the pair before as well; the place before the first is the last
            last = starts + lens - 1
            rank[last] = _NONE
            changed[last] = False
            anew = np.flatnonzero(changed[:-1])
            rank[anew], piece[anew] = self._pairs(sym[anew], sym[anew + 1])

    def merge_long(self, sym: np.ndarray) -> np.ndarray:
        """``merge`` for one long segment: pairs from a queue by rank and place."""
        n = len(sym)
        out, end = sym.tolist(), list(range(1, n + 1))  # a symbol and where the next one begins
        before = list(range(-1, n - 1))
        ranks, pieces = self._pairs(sym[:-1], sym[1:])
        queue = [(r, i, i + 1, n2, p) for i, (r, n2, p) in enumerate(zip(ranks.tolist(), range(2, n + 1), pieces.tolist(), strict=True)) if r != _NONE]
        heapq.heapify(queue)

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                key = out[i] * (self.size + _CODE_POINTS) + out[j]
                at = int(np.searchsorted(self.pair_key, key))
                if self.pair_key[at] == key:
                    heapq.heappush(queue, (int(self.pair_rank[at]), i, j, end[j], int(self.pair_piece[at])))

        while queue:
            _, i, j, after, p = heapq.heappop(queue)
            if out[i] < 0 or out[j] < 0 or end[i] != j or end[j] != after:
                continue
            out[i], out[j], end[i] = p, -1, after
            if after < n:
                before[after] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array(out, np.int32)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit bytes; no piece may cross from word to word."""
        ends = np.cumsum([len(w) for w in words])
        cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1], FLAT)))
        bounds = [0, *cuts[cuts > 0].tolist(), len(words)]
        return [ids for a, b in itertools.pairwise(bounds) if b > a for ids in self._encode_flat(words[a:b])]

    def _encode_flat(self, words: list[str]) -> list[bytes]:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(w) for w in words])
        kind = self.char_class[codes]
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.joined[kind[:-1], kind[1:]]
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        lens = np.diff(np.append(starts, len(codes)))
        sym = self.char_sym[codes]
        long = lens > LONG
        if long.any():
            out = np.empty(len(sym), np.int32)
            inside = np.repeat(long, lens)
            short_lens = lens[~long]
            out[~inside] = self.merge(sym[~inside], np.cumsum(short_lens) - short_lens)
            for s, k in zip(starts[long].tolist(), lens[long].tolist(), strict=True):
                out[s : s + k] = self.merge_long(sym[s : s + k])
        else:
            out = self.merge(sym, starts)
        place = np.flatnonzero(out >= 0)
        out = out[place]
        raw = np.flatnonzero(out >= self.size)
        if len(raw):  # characters that are no piece: their bytes, or unknown
            out, place = self._spell(out, place, raw)
        bounds = np.searchsorted(place, ends).tolist()
        whole = out.astype("<i4").tobytes()
        return [whole[4 * a : 4 * b] for a, b in zip([0, *bounds], bounds, strict=False)]

    def _spell(self, out: np.ndarray, place: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.is_byte.any():
            out[raw] = self.unk_id
            return out, place
        code = out[raw] - self.size
        width = np.ones(len(out), np.int64)
        width[raw] += (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        at = (np.cumsum(width) - width)[raw]
        out, place = np.repeat(out, width), np.repeat(place, width)
        spelled = np.frombuffer(code.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        inside = np.repeat(at, width[raw]) + np.arange(len(spelled)) - np.repeat(np.cumsum(width[raw]) - width[raw], width[raw])
        out[inside] = self.byte_id[spelled]
        return out, place

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; each distinct short word is merged once while the cache holds it."""
        split = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        distinct = dict.fromkeys(itertools.chain.from_iterable(split))
        if len(self.cache) + len(distinct) > CACHE_WORDS:
            self.cache = {}
        new = [w for w in distinct if w not in self.cache]
        if new:
            self.cache.update(zip(new, self.encode_words(new), strict=True))
        out = [b"".join(map(self.cache.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > CACHED_LENGTH:
                del self.cache[w]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    # --- decoding ---

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of rows of ids; row k is ids[offsets[k]:offsets[k + 1]]."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError(f"ids beyond the vocabulary of {self.size}")
        at, width = self.piece_at[ids], self.piece_len[ids]
        said = np.flatnonzero(~self.is_control[ids])
        first = np.searchsorted(said, offsets[:-1])
        first = said[first[first < len(said)]]
        first = np.unique(first[self.leads_space[ids[first]]])
        at[first] += 1  # without the space that encoding puts before a text
        width[first] -= 1
        ends = np.cumsum(width)
        flat = self.piece_bytes[np.repeat(at - (ends - width), width) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        bounds = np.concatenate([[0], ends])[offsets].tolist()
        return [
            self._text(flat[a:b])
            for a, b in itertools.pairwise(bounds)
        ]

    def _text(self, raw: bytes) -> str:
        try:
            return raw.decode()
        except UnicodeDecodeError:  # byte pieces that spell no character: one mark for each such byte
            return raw.decode("utf-8", "one_by_one")


codecs.register_error("one_by_one", lambda error: ("\ufffd", error.start + 1))

_WORKER: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's tables of a model file, kept between tasks."""
    if path not in _WORKER:
        _WORKER.clear()
        _WORKER[path] = Vocabulary(path)
    return _WORKER[path]


# --- operators ----------------------------------------------------------------


def _encode(path: str, end: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        tail = np.array([vocab.end_id] if end else [], "<i4").tobytes()
        for b in batches:
            for part in text_slices(b, "text", SLICE_BYTES):
                rows = [ids + tail for ids in vocab.encode_all(part.column("text").to_pylist())]
                offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """Every row as doc_id, ids: its whole text's ids as the sentencepiece library gives them, then the end id.

    A null or empty text has the end id alone.  Repeated rows are encoded alike and all returned; a null
    id is carried through; an empty table gives an empty result; extra columns are ignored, whatever
    their names.  A model that changes texts before it splits them is refused.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(_encode(model_path, end), "doc_id long, ids array<int>")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in batches:
            sizes = b.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for part in row_runs(b, sizes, FLAT):
                lists = part.column("ids")
                ids = lists.flatten()
                if ids.null_count:
                    raise ValueError("a null among the ids")
                offsets = np.zeros(len(lists) + 1, np.int64)
                np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), out=offsets[1:])
                texts = vocab.decode_all(ids.to_numpy(zero_copy_only=False), offsets)
                missing = lists.is_null().to_numpy(zero_copy_only=False)
                text = pa.array(texts, pa.string(), mask=missing)
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "text"])

    return run


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Every row as doc_id, ids, text: the text as the sentencepiece library's decode gives it.

    Null ids give a null text, no ids an empty one; a null among the ids or an id beyond the vocabulary
    is an error.  Other cases as in ``encode``.
    """
    rows = pick(encoded, doc_id=id_col, ids=ids_col)
    return rows.mapInArrow(_decode(model_path), "doc_id long, ids array<int>, text string")
