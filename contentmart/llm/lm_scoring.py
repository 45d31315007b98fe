"""Language-model scoring of whole documents by a causal self-attention model over subword ids.

All counts cover all training documents, whole: those of words (the base score), of ids, and of pairs of
neighbouring ids and of the words that begin between them, from which the model (``lm_model``) has its classes and both of its tables.
The gradient steps go over all windows of all training documents too.  A document
is cut into overlapping windows; each id is the target of one window only, and batches of windows go
through masked attention together.

Scale: both scores are maps over the documents, which are encoded once and written as ids.  The training
documents are dealt to ROUNDS rounds; in each the tasks take their own steps from the same weights, which
are then averaged by Spark.  Word counts are summed map-side before they are
shuffled, and so are pairs of ids, of which there are no more than the vocabulary squared.  The FREQUENT most frequent words, a fixed number, travel with the tasks; every other word
of a document is counted by a join on the word, whose hot words are just those taken out.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.llm import lm_model
from contentmart.llm.common import arrow_rows, materialise, pick, text_slices
from contentmart.llm.packing import _encoder, forget, known_words

#: Words whose counts every task holds, at most.
FREQUENT = 100_000
#: Rounds of gradient steps: a document's windows are in one of them.
ROUNDS = 8
#: Windows of a gradient step.
BATCH = 64
#: Windows that a task puts in random order together.
SHUFFLED = 1 << 14
#: The rate of the first gradient steps.
RATE = 4e-3
#: Rows of the embeddings that are averaged together.
BLOCK = 1024
#: Pairs of neighbouring ids that a task sums at once.
CHUNK_PAIRS = 1_000_000
#: Bytes of the packed model in one row.
PART_BYTES = 1 << 20
#: The end of a document among the words; no word holds a line feed.
END = "\n"
#: Ids that go through the model at once.
CHUNK_IDS = 200_000
#: Words that a worker keeps encoded, at most; the frequent ones stay when others go.
CACHE_WORDS = 200_000
#: Documents that Spark hands to Python at once.
BATCH_ROWS = 1_000
#: Bytes of text that are counted, or encoded, at once.
COUNT_BYTES, ENCODE_BYTES = 8 << 20, 1 << 20

#: Bytes with A to Z lowered and white space made a space; no other UTF-8 byte is touched.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def lowered(text: str | None) -> str:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")


def words(text: str | None) -> list[str]:
    """The lowered words of a text."""
    return list(filter(None, lowered(text).split(" ")))


def in_training(doc_id: Column) -> Column:
    """Four documents in five, by the checksum of the id as text; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) != 1


# --- counts -------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (part for whole in batches for part in text_slices(whole, "text", COUNT_BYTES)):
        n: Counter = Counter()
        for text in b.column("text").to_pylist():
            n.update(words(text))
        n[END] += len(b)
        keys = list(n)
        for at in range(0, len(keys), 50_000):
            part = keys[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([n[w] for w in part], pa.int64())], names=["word", "n"]
            )


def _count_ids(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = _encoder(path)
        n = np.zeros(size, np.int64)
        for b in batches:
            words, times = b.column("word").to_pylist(), b.column("n").to_numpy(zero_copy_only=False)
            for at in range(0, len(words), 4096):
                ids = [e.ids for e in tokenizer.encode_batch_fast(words[at : at + 4096], add_special_tokens=False)]
                times_each = np.repeat(times[at : at + 4096], [len(x) for x in ids])
                flat = np.fromiter((i for x in ids for i in x), np.int64, len(times_each))
                n += np.bincount(flat, weights=times_each, minlength=size).astype(np.int64)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["id", "n"])

    return run


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over all rows (text); the end of a document is the word END."""
    return rows.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def id_counts(counts: DataFrame, path: str, size: int) -> np.ndarray:
    """Counts of the ``size`` - 1 subword ids and the end id, from the counts of words.

    Ids never reach across white space, so a text's ids are its words' ids.
    """
    spread = counts.filter(F.col("word") != END)
    summed = spread.mapInArrow(_count_ids(path, size), "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    got = summed.toPandas()  # as many rows as the vocabulary has ids at most
    out = np.zeros(size)
    out[got["id"].to_numpy(int)] = got["n"].to_numpy(float)
    out[size - 1] = counts.filter(F.col("word") == END).agg(F.sum("n")).first()[0] or 0
    return out


def _ids(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, and for each but the first whether a new word begins with it."""
    texts = _Words([words])
    return next(texts.ids(known_words(set(texts.distinct[1:]), path, CACHE_WORDS)))


class _Words:
    """The words of some texts, each text's END last, as places among the ``distinct`` ones, of which END is the first."""

    def __init__(self, split: list[list[str]]):
        self.lengths = np.fromiter(map(len, split), np.int64, len(split)) + 1
        self.ends = np.cumsum(self.lengths)
        at = dict.fromkeys(chain([END], *split))
        self.distinct = list(at)
        at = dict(zip(self.distinct, range(len(at)), strict=True))
        self.at = np.zeros(self.ends[-1] if len(split) else 0, np.int32)
        word = np.ones(len(self.at), bool)
        word[self.ends - 1] = False
        self.at[word] = np.fromiter(map(at.__getitem__, chain(*split)), np.int32, len(self.at) - len(split))

    def ids(self, known: dict[str, bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each text's ids, and for each but the first whether a new word begins with it; a word without ids
        begins nowhere of its own."""
        parts = [b"", *map(known.__getitem__, self.distinct[1:])]
        each, n = np.frombuffer(b"".join(parts), "<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        first, n = (np.cumsum(n) - n)[self.at], n[self.at]
        past = np.cumsum(n)
        ids = each[np.repeat(first + n - past, n) + np.arange(past[-1] if len(past) else 0)]
        begins = np.zeros(len(ids) + 1, bool)
        begins[past] = True
        start = 0
        for end in past[self.ends - 1].tolist():
            yield ids[start:end], begins[start + 1 : end]
            start = end

    def counted(self, top: dict[str, float]) -> tuple[np.ndarray, list[float], list[pa.Array]]:
        """Of each text how many words are in ``top``, their sum there, and its other words with their times."""
        value = np.fromiter(map(top.get, self.distinct, repeat(np.nan)), np.float64, len(self.distinct))[self.at]
        miss = np.isnan(value)
        value[miss] = 0
        text = np.repeat(np.arange(len(self.ends)), self.lengths)
        sums = [math.fsum(value[e - n : e].tolist()) for e, n in zip(self.ends.tolist(), self.lengths.tolist(), strict=True)]
        key, times = np.unique(text[miss] * len(self.distinct) + self.at[miss], return_counts=True)
        offsets = pa.array(np.searchsorted(key, np.arange(len(self.ends) + 1) * len(self.distinct)).astype(np.int32))
        used, place = np.unique(key % len(self.distinct), return_inverse=True)
        rare = pa.array([self.distinct[i] for i in used.tolist()], pa.string()).take(pa.array(place))
        lists = [pa.ListArray.from_arrays(offsets, c) for c in (rare, pa.array(times.astype(np.int32)))]
        return self.lengths - np.bincount(text[miss], minlength=len(self.ends)), sums, lists


def _summed(keys: list[np.ndarray], times: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often (or with what sum of ``times``) each occurs."""
    if times is None:
        return np.unique(np.concatenate(keys), return_counts=True)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, weights=np.concatenate(times), minlength=len(key)).astype(np.int64)


def _kind(size: int) -> str:
    """The numbers that hold ``size`` ids."""
    return "<u2" if size <= 1 << 16 else "<u4"


def _packed(one: list[tuple[np.ndarray, np.ndarray]], size: int) -> list[pa.Array]:
    """Columns ids and begins of documents' ``_ids``."""
    kind = _kind(size)
    return [
        pa.array([ids.astype(kind).tobytes() for ids, _ in one], pa.binary()),
        pa.array([np.packbits(begins).tobytes() for _, begins in one], pa.binary()),
    ]


def _unpacked(b: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_ids`` of each document of a batch (ids, begins)."""
    kind = _kind(size)
    for ids, begins in zip(b.column("ids"), b.column("begins"), strict=True):
        ids = np.frombuffer(ids.as_buffer(), kind).astype(np.int64)
        yield ids, np.unpackbits(np.frombuffer(begins.as_buffer(), np.uint8), count=max(0, len(ids) - 1)).astype(bool)


def _encode_texts(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in text_slices(whole, "text", ENCODE_BYTES)):
            texts = _Words(list(map(words, b.column("text").to_pylist())))
            cols = _packed(list(texts.ids(known_words(set(texts.distinct[1:]), path, CACHE_WORDS))), size)
            yield pa.RecordBatch.from_arrays([b.column("rid"), *cols], names=["rid", "ids", "begins"])

    return run


def encoded(rows: DataFrame, path: str, size: int) -> DataFrame:
    """(rid, ids, begins) of rows (text)."""
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encode_texts(path, size), "rid long, ids binary, begins binary")


def _count_pairs(size: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        end = np.array([size - 1], np.int64)
        keys: list[np.ndarray] = []
        gaps: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            key, n = _summed(keys)
            new, times = _summed(gaps)
            gap = np.zeros(len(key), np.int64)
            gap[np.searchsorted(key, new)] = times
            return pa.RecordBatch.from_arrays(
                [pa.array((key // size).astype(np.int32)), pa.array((key % size).astype(np.int32)), pa.array(n), pa.array(gap)],
                names=["before", "id", "n", "gaps"],
            )

        for b in batches:
            for inner, begins in _unpacked(b, size):
                ids = np.concatenate([end, inner, end])
                keys.append(ids[:-1] * size + ids[1:])
                gaps.append(keys[-1][1:-1][begins])
                held += len(ids)
                if held >= chunk:
                    yield flush()
                    keys, gaps, held = [], [], 0
        if keys:
            yield flush()

    return run


def _pairs(docs: DataFrame, size: int) -> DataFrame:
    """``pair_counts`` of encoded documents (ids, begins)."""
    pairs = docs.select("ids", "begins").mapInArrow(_count_pairs(size, CHUNK_PAIRS), "before int, id int, n long, gaps long")
    return pairs.groupBy("before", "id").agg(F.sum("n").alias("n"), F.sum("gaps").alias("gaps"))


def pair_counts(rows: DataFrame, path: str, size: int) -> DataFrame:
    """(before, id, n, gaps): how often each id follows each over all rows (text), and how often as the first
    of a word; the end id stands around a text."""
    return _pairs(encoded(rows, path, size), size)


def pair_id_counts(pairs: DataFrame, size: int) -> np.ndarray:
    """``id_counts`` from the counts of pairs: every id, and the end of each document, comes second in one pair."""
    got = pairs.groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # a row per id at most
    out = np.zeros(size)
    out[got["id"].to_numpy(int)] = got["n"].to_numpy(float)
    return out


def gap_odds(pairs: DataFrame, size: int) -> np.ndarray:
    """(2, ids): log-odds that a new word begins after each id, and before each id beyond those of any id."""
    inner = pairs.filter((F.col("before") != size - 1) & (F.col("id") != size - 1))
    sums = np.zeros((2, 2, size))
    for k, c in enumerate(("before", "id")):  # a row per id at most
        got = inner.groupBy(c).agg(F.sum("n").alias("n"), F.sum("gaps").alias("gaps")).toPandas()
        sums[k][:, got[c].to_numpy(int)] = got[["n", "gaps"]].to_numpy(float).T
    n, gaps = sums[0].sum(axis=1)
    share = (gaps + 0.5) / (n + 1)
    odds = lambda part: np.log(part / (1 - part))
    out = odds((sums[:, 1] + share) / (sums[:, 0] + 1))
    out[1] -= odds(share)
    return out


def _class_sums(cls: np.ndarray):
    """(leads, id, class, n) of id pairs: how often an id follows a class, and how often it leads to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            before, ids, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("before", "id", "n"))
            for leads, one, other in ((False, ids, before), (True, before, ids)):
                key, total = _summed([one.astype(np.int64) * lm_model.CLASSES + cls[other]], [n])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(key), leads)),
                        pa.array((key // lm_model.CLASSES).astype(np.int32)),
                        pa.array((key % lm_model.CLASSES).astype(np.int32)),
                        pa.array(total),
                    ],
                    names=["leads", "id", "class", "n"],
                )

    return run


def _filled(table: np.ndarray, b: pa.RecordBatch, where: np.ndarray) -> None:
    """Sets the rows ``where`` of a batch (id, at, n) in a table (ids, columns)."""
    part = b.filter(pa.array(where))
    if len(part):
        at, n = part.column("at"), part.column("n")
        rows = np.repeat(part.column("id").to_numpy(zero_copy_only=False), np.diff(at.offsets.to_numpy()))
        table[rows, at.flatten().to_numpy(zero_copy_only=False)] = n.flatten().to_numpy(zero_copy_only=False)


def _classes(counts: np.ndarray):
    """The class of each id, in one task, from a row per id (id, at, n) of the counts of the heads before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        feat = np.zeros((len(counts), len(lm_model.heads(counts, lm_model.CLASSES))), np.float32)
        for b in batches:
            _filled(feat, b, np.ones(len(b), bool))
        cls = lm_model.classes(counts, feat, np.random.default_rng(5), lm_model.CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array([cls.tobytes()], pa.binary())], names=["cls"])

    return run


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def _tables(counts: np.ndarray, cls: np.ndarray, gap: np.ndarray):
    """The model before its gradient steps, made in one task from rows of counts (leads, id, at, n); gives it as
    rows of at most PART_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        follows, leads = np.zeros((2, len(counts), lm_model.CLASSES), np.float32)
        for b in batches:
            kind = b.column("leads").to_numpy(zero_copy_only=False)
            _filled(follows, b, ~kind)
            _filled(leads, b, kind)
        model = lm_model.tables(counts, cls, follows, leads)
        model.gap = gap.astype(np.float32)
        del follows, leads
        packed = lm_model.dumps(model)
        del model
        for k, at in enumerate(range(0, len(packed), PART_BYTES)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([packed[at : at + PART_BYTES]], pa.binary())], names=["part", "model"]
            )

    return run


MOVED = "name string, block int, ids binary, n binary, value binary"


def _descend(shared, moved, size: int, least: int, spread: tuple[float, float], seed: int):
    """The weights that a task has after steps over all windows of its documents, from those that all begin
    with: rows of BLOCK embeddings that moved, with the steps that moved them, and of each other weight whole,
    with the targets it has seen.  The rate falls from the first to the second of ``spread``.  A task of up to
    ``least`` batches goes over them until it has taken so many steps."""
    most = max(SHUFFLED, least * BATCH + 1)  # so few windows stay together

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        forget()
        direct, cls = shared.value
        fitting = lm_model.Descent({"direct": direct, **{k: v.copy() for k, v in moved.value.items()}}, cls)
        task = TaskContext.get()
        rng = np.random.default_rng([seed, task.partitionId() if task else 0])
        xs, ys, held = [], [], 0
        rate = lambda at: spread[0] + (spread[1] - spread[0]) * at
        for b in batches:
            for ids, _ in _unpacked(b, size):
                x, y = lm_model.windows(np.append(ids.astype(np.int32), size - 1), np.array([len(ids) + 1]), size - 1)
                xs.append(x), ys.append(y)
                held += len(x)
                if held >= most:
                    fitting.run(np.concatenate(xs), np.concatenate(ys), rng, least, BATCH, rate)
                    xs, ys, held = [], [], 0
        if xs:
            fitting.run(np.concatenate(xs), np.concatenate(ys), rng, least, BATCH, rate)
        if fitting.steps:
            yield _moved(fitting)

    return run


def _moved(fitting: lm_model.Descent) -> pa.RecordBatch:
    out = []
    for name in fitting.moments:
        value = fitting.w[name]
        if name != "emb":
            out.append((name, 0, np.zeros(1, "<i8"), np.array([fitting.targets], "<i8"), value))
            continue
        for at in range(0, len(value), BLOCK):
            ids = at + np.flatnonzero(fitting.touched[at : at + BLOCK])
            if len(ids):
                out.append((name, at // BLOCK, ids.astype("<i8"), fitting.touched[ids].astype("<i8"), value[ids]))
    name, block, *arrays = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(name, pa.string()), pa.array(block, pa.int32()), *(pa.array([a.tobytes() for a in c], pa.binary()) for c in arrays)],
        names=["name", "block", "ids", "n", "value"],
    )


def _averaged(table: pa.Table) -> pa.Table:
    """One row from the rows of a weight, or of a block of embeddings, each weighed by what moved it."""
    rows = [[np.frombuffer(r[c], k) for c, k in (("ids", "<i8"), ("n", "<i8"), ("value", "<f4"))] for r in table.to_pylist()]
    ids = np.unique(np.concatenate([i for i, _, _ in rows]))
    n, total = np.zeros(len(ids), np.int64), None
    for i, times, value in rows:
        at = np.searchsorted(ids, i)
        value = value.reshape(len(i), -1).astype(np.float64)
        total = np.zeros((len(ids), value.shape[1])) if total is None else total
        total[at] += value * times[:, None]
        n[at] += times
    mean = (total / n[:, None]).astype("<f4")
    cols = [table.column(c)[:1] for c in ("name", "block")]
    cols += [pa.array([a.tobytes()], pa.binary()) for a in (ids.astype("<i8"), n.astype("<i8"), mean)]
    return pa.table(cols, names=["name", "block", "ids", "n", "value"])


def _trained(model: lm_model.Model, docs: DataFrame, steps: int) -> None:
    """Takes gradient steps over all windows of ``docs`` (rid, ids, begins), ``steps`` at the least.

    Up to ``steps`` batches, a fixed number, are gone over by one task, as often as it takes.  More are dealt
    to ROUNDS rounds, in which every task takes steps over the windows of its own documents.
    """
    spark, size = docs.sparkSession, len(model.cls)
    lengths = docs.agg(F.sum(F.floor((F.length("ids") / np.dtype(_kind(size)).itemsize + lm_model.NEW) / lm_model.NEW))).first()
    few = (lengths[0] or 0) <= steps * BATCH
    rounds = 1 if few else ROUNDS
    docs = docs.select("rid", "ids", "begins")
    shared = spark.sparkContext.broadcast((model.weights["direct"], model.cls))
    for r in range(rounds):
        begin = spark.sparkContext.broadcast({k: v for k, v in model.weights.items() if k != "direct"})
        part = docs.repartition(1) if few else docs.filter(F.pmod(F.xxhash64("rid"), F.lit(rounds)) == r)
        spread = RATE * (1 - r / rounds), RATE * (1 - (r + 1) / rounds)
        run = _descend(shared, begin, size, steps if few else 0, spread, r)
        ended = part.mapInArrow(run, MOVED).groupBy("name", "block").applyInArrow(_averaged, MOVED)
        for row in ended.toArrow().to_pylist():  # the weights that moved, once
            ids, value = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["value"], "<f4")
            w = model.weights[row["name"]]
            if row["name"] == "emb":
                w[ids] = value.reshape(len(ids), -1)
            else:
                w[...] = value.reshape(w.shape)
        begin.unpersist()
    shared.unpersist()


def _learned(docs: DataFrame, n_docs: int, size: int, steps: int) -> lm_model.Model:
    """The model from ``docs`` (rid, ids, begins), all the training documents: counts of all ids and id pairs,
    and gradient steps over all windows.

    Counts by class are bounded, so one task makes the tables, with an executor's memory and not the driver's.
    """
    spark = docs.sparkSession
    if not n_docs:
        end = np.array([size - 1], np.int32)
        return lm_model.train(end, np.array([1]), np.zeros(size), steps=steps)
    pairs, _ = materialise(_pairs(docs, size), "lm-pairs")
    counts = pair_id_counts(pairs, size)
    listed = lambda df, at, *by: df.groupBy(*by).agg(F.collect_list(F.struct(F.col(at).alias("at"), "n")).alias("p"))
    top = lm_model.heads(counts, lm_model.CLASSES)
    spots = spark.createDataFrame([(int(i), k) for k, i in enumerate(top)], "before int, spot int")
    near = listed(pairs.join(F.broadcast(spots), "before"), "spot", "id").select("id", "p.at", "p.n")
    found = near.repartition(1).mapInArrow(_classes(counts), "cls binary").collect()  # a row per id at most
    cls = np.frombuffer(found[0]["cls"], np.int16)

    by_class = pairs.mapInArrow(_class_sums(cls), "leads boolean, id int, class int, n long")
    by_class = by_class.groupBy("leads", "id", "class").agg(F.sum("n").alias("n"))
    listed_by_class = listed(by_class, "class", "leads", "id").select("leads", "id", "p.at", "p.n")
    made = listed_by_class.repartition(1).mapInArrow(_tables(counts, cls, gap_odds(pairs, size)), "part int, model binary")
    written, _ = materialise(made, "lm-model")  # collected in parts, which the driver never holds twice over
    got = written.toArrow().sort_by("part")
    model = lm_model.loads(b"".join(p.as_py() for p in got.column("model")))
    _trained(model, docs, steps)
    return model


def _documents(words: DataFrame) -> int:
    return words.filter(F.col("word") == END).agg(F.sum("n")).first()[0] or 0


def fit(training: DataFrame, words: DataFrame, path: str, sample_ids: int | None = None, sample_docs: int | None = None, steps: int = 800) -> bytes:
    """The model from ``training`` (doc_id, text) and its word counts, packed.

    ``sample_ids`` and ``sample_docs`` bounded the windows once and do nothing: all are used.
    """
    size = vocabulary_size(path) + 1
    docs, _ = materialise(encoded(training, path, size), "lm-encoded")
    return lm_model.dumps(_learned(docs, _documents(words), size, steps))


# --- scoring ------------------------------------------------------------------

ENCODED = (
    "rid long, doc_id long, n_tokens long, n_top long, top_score double, rare array<string>, times array<int>, ids binary, begins binary"
)


def _encode(shared, path: str, size: int):
    """Each document's words counted, scored where they are frequent, and encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        for b in (part for whole in batches for part in text_slices(whole, "text", ENCODE_BYTES)):
            texts = _Words(list(map(words, b.column("text").to_pylist())))
            n_top, base, rare = texts.counted(top)
            ids = list(texts.ids(known_words(set(texts.distinct[1:]), path, CACHE_WORDS, top)))
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), pa.array(texts.lengths), pa.array(n_top), pa.array(base), *rare, *_packed(ids, size)],
                names=["rid", "doc_id", "n_tokens", "n_top", "top_score", "rare", "times", "ids", "begins"],
            )

    return run


SCORED = "rid long, doc_id long, n_tokens long, n_top long, top_score double, score double"


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = shared.value
        end = model.end
        for b in batches:
            scores = np.zeros(len(b))
            pending: list[np.ndarray] = []
            owner: list[int] = []
            held = 0

            def flush():
                lengths = np.array([len(p) for p in pending])
                x, y = lm_model.windows(np.concatenate(pending), lengths, end)
                sums = lm_model.log_probs(model, x, y).sum(axis=1, dtype=np.float64)
                steps = -(-lengths // lm_model.NEW)
                np.add.at(scores, np.repeat(owner, steps), sums)  # noqa: B023

            for i, (ids, begins) in enumerate(_unpacked(b, len(model.cls))):
                scores[i] += lm_model.gap_log_prob(model, ids, begins)
                one = np.append(ids.astype(np.int32), end)
                pending.append(one), owner.append(i)
                held += len(one)
                if held >= CHUNK_IDS:
                    flush()
                    pending, owner, held = [], [], 0
            if pending:
                flush()
            kept = ["rid", "doc_id", "n_tokens", "n_top", "top_score"]
            yield pa.RecordBatch.from_arrays([*map(b.column, kept), pa.array(scores / math.log(10))], names=[*kept, "score"])

    return run


def score(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    sample_ids: int | None = None,
    sample_docs: int | None = None,
    steps: int = 800,
) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are split at ASCII white space after lowering A to Z; each document ends with one end token.
    base_score is the smoothed unigram log10 probability under the counts of all training documents;
    score is the model's log10 probability of the text: of its subword ids and its end, and between each
    two ids of whether a new word begins there, given both, from counts over all training documents.  So
    texts that differ in their words differ in score also where they have the same ids ("foo,bar" and
    "foo , bar").  All windows of all training documents are trained on, in ``steps`` gradient steps at the
    least; ``sample_ids`` and ``sample_docs`` bounded them once and do nothing.

    A null text is empty and scores its end only.  Without training documents all counts are 0 and the
    model is fitted on an empty document.  Rows that repeat an id are separate rows.  An empty table
    gives an empty result; extra columns are ignored, whatever their names.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _scored(docs, tokenizer_path, id_col, text_col, frequent, steps)


def _scored(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, frequent: int, steps: int) -> DataFrame:
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    training = rows.filter(in_training(F.col("doc_id")))
    counts, _ = materialise(word_counts(training), "lm-words")
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    spread = total + 0.5 * (distinct + 1)
    logp = lambda n: F.log10((n + 0.5) / F.lit(spread))
    common = counts.orderBy(F.desc("n"), "word").limit(frequent).toPandas()
    top = dict(zip(common["word"], np.log10((common["n"].to_numpy(float) + 0.5) / spread).tolist(), strict=True))
    del common
    size = vocabulary_size(tokenizer_path) + 1
    frequent_words = spark.sparkContext.broadcast(top)
    docs, _ = materialise(
        rows.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(_encode(frequent_words, tokenizer_path, size), ENCODED),
        "lm-documents",
    )
    frequent_words.unpersist()
    del top
    # The arrays themselves are sent, so that a worker holds them once.
    model = _learned(docs.filter(in_training(F.col("doc_id"))), _documents(counts), size, steps)
    shared = spark.sparkContext.broadcast(model)
    del model

    scored, _ = materialise(docs.drop("rare", "times").mapInArrow(_score(shared), SCORED), "lm-scored")
    shared.unpersist()
    rare = docs.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    rare = rare.select("rid", F.col("w.rare").alias("word"), F.col("w.times").alias("k"))
    found = rare.join(counts, "word", "left").select("rid", "k", F.coalesce("n", F.lit(0)).alias("n"))
    per_doc = found.groupBy("rid").agg(
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("known"), F.sum(F.col("k") * logp(F.col("n"))).alias("rare_score")
    )
    return scored.join(per_doc, "rid", "left").select(
        "doc_id",
        (~in_training(F.col("doc_id"))).alias("held_out"),
        "n_tokens",
        (F.col("n_top") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("top_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score",
    )
