"""Language identification by mixture inference over character n-grams.

Each language is a distribution over hashed character trigrams, counted over all labelled training
documents.  A document is a mixture: expectation-maximisation estimates how much of it each language
of a set has written, and the set grows, from the best single language, as long as another language
raises the penalised likelihood (half the logarithm of the trigrams for each proportion; a character
stands in three trigrams, so the likelihood counts a third).

Scale: counting sends at most BUCKETS rows a language and input batch into one aggregation; the model
(languages x BUCKETS numbers, 128 KB for each label there is) is all that leaves it and is broadcast.
Prediction is a map over the documents, whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import pick, place, positional

BUCKETS = 1 << 14
#: Languages that are tried beside the chosen ones at once.
TRIED = 64
UNKNOWN = "und"
#: Log-odds below which a text is in no learned language: some ten million to one.
REJECT_BELOW = -16.0
_SMOOTH = 0.5
_EM_ROUNDS = 12
_WORKER: dict = {}


def _letters() -> np.ndarray:
    """Whether each code point is a letter (or a mark, which only stands within words)."""
    if "letters" not in _WORKER:
        _WORKER["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _WORKER["letters"]


def trigram_buckets(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased letters, each run of other characters being one space."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.where(letter, code, np.uint32(32))[keep]
    code = np.concatenate([[np.uint32(32)], code, [np.uint32(32)]]).astype(np.uint32)
    h = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77) + code[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(18)).astype(np.int64)


# --- training -----------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            if lang not in sums:
                sums[lang] = np.zeros(BUCKETS, np.int64)
            sums[lang] += np.bincount(trigram_buckets(text), minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                names=["lang", "bucket", "n"],
            )


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities of the buckets) from ``labelled`` (text, lang), nulls left out; every
    label is a language."""
    rows = labelled.select("text", "lang").dropna()
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((0, BUCKETS))
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    listed = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("p")).select("lang", "p.bucket", "p.n")
    table = np.full((len(langs), BUCKETS), _SMOOTH)
    row = {lang: i for i, lang in enumerate(langs)}
    for part in listed.toArrow().to_batches():  # a row for each label
        for lang, bucket, n in zip(part.column("lang").to_pylist(), part.column("bucket"), part.column("n"), strict=True):
            table[row[lang], bucket.values.to_numpy()] += n.values.to_numpy()
    table /= table.sum(axis=1, keepdims=True)
    return langs, np.log(table, out=table)


# --- inference ----------------------------------------------------------------


def _em(p: np.ndarray, k: np.ndarray, rounds: int = _EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihoods for a batch of language sets: p (sets, languages, grams)."""
    theta = np.full(p.shape[:2], 1.0 / p.shape[1])
    n = k.sum()
    for _ in range(rounds):
        mix = np.einsum("sl,slg->sg", theta, p)
        theta = theta * np.einsum("slg,sg->sl", p, k / mix) / n
    return theta, np.log(np.einsum("sl,slg->sg", theta, p)) @ k


def infer(buckets: np.ndarray, logp: np.ndarray) -> tuple[dict[int, float], float]:
    """(proportions of the chosen languages, nats by which they explain the text better than an even spread)."""
    n = len(buckets)
    counts = np.bincount(buckets, minlength=BUCKETS)
    grams = np.flatnonzero(counts)
    k, lp = counts[grams].astype(float), logp[:, grams]
    single = lp @ k
    best = int(single.argmax())
    chosen, theta, reached = [best], np.ones(1), single[best]
    p = np.exp(lp)
    while len(chosen) < len(logp):
        mix = theta @ p[chosen]
        rest = [m for m in range(len(logp)) if m not in chosen]
        # The likelihood is concave in a new language's share: no rise at zero, no rise at all.
        slope = p[rest] @ (k / mix)
        rest = [m for m, s in zip(rest, slope, strict=True) if s > n]
        if not rest:
            break
        tried = []
        for at in range(0, len(rest), TRIED):
            thetas, ll = _em(np.stack([p[[*chosen, m]] for m in rest[at : at + TRIED]]), k)
            top = int(ll.argmax())
            tried.append((ll[top], rest[at + top], thetas[top]))
        most, new, shares = max(tried, key=lambda x: x[0])
        if (most - reached) / 3 <= 0.5 * np.log(n):
            break
        chosen, theta, reached = [*chosen, new], shares, most
    return dict(zip(chosen, theta.tolist(), strict=True)), float(reached + n * np.log(BUCKETS))


def _predict(model, text_col: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logp = model.value
        for b in batches:
            pred, score, fit, mix = [], [], [], []
            for text in b.column(b.schema.get_field_index(text_col)).to_pylist():
                buckets = trigram_buckets(text or "")
                if not len(buckets) or not langs:
                    pred.append(UNKNOWN), score.append(0.0), fit.append(0.0), mix.append([])
                    continue
                shares, gain = infer(buckets, logp)
                top = max(shares, key=lambda m: (shares[m], -m))
                pred.append(langs[top]), score.append(min(1.0, shares[top])), fit.append(gain)
                mix.append([(langs[m], s) for m, s in sorted(shares.items(), key=lambda x: (-x[1], x[0]))])
            names = [c for c in b.schema.names if keep_text or c != text_col]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(b.schema.get_field_index(c)) for c in names),
                    pa.array(pred, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(fit, pa.float64()),
                    pa.array(mix, pa.map_(pa.string(), pa.float64())),
                ],
                names=[*names, "lang_pred", "score", "fit", "mixture"],
            )

    return run


def predict(
    rows: DataFrame, langs: list[str], logp: np.ndarray, text_col: str = "text", keep_text: bool = False
) -> DataFrame:
    """``rows``, with or without the text, plus lang_pred, score, fit and mixture."""
    model = rows.sparkSession.sparkContext.broadcast((langs, logp.astype(np.float64)))
    carried = [f.simpleString().replace(":", " ", 1) for f in rows.schema.fields if keep_text or f.name != text_col]
    return rows.mapInArrow(
        _predict(model, text_col, keep_text), ", ".join([*carried, "lang_pred string, score double, fit double, mixture map<string,double>"])
    )


def held_out(doc_id: Column) -> Column:
    """One document in five, by the checksum of its id as text; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every row with its language: doc_id, held_out, lang_pred, score, fit, mixture.

    Learns from the text and label of documents that are not held out and whose label is not null;
    predicts from the text alone.  lang_pred is the language with the largest share, score that share;
    mixture holds all shares.  fit is the log-odds, in nats, of the best mixture against an even spread of
    trigrams: far below zero, the text is like no learned language.

    A null text, or one without letters, is ``und`` with score and fit 0, as is everything if no
    labelled document exists.  Equal shares fall to the language first in order.  Rows that repeat an
    id are separate rows.  An empty table gives an empty result; extra columns are ignored, whatever
    their names.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")
    )
    langs, logp = train(rows.filter(~held_out(F.col("doc_id"))))
    return predict(rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), langs, logp)


def filter_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in a learned language.

    Rejected: texts that are null or have no letter, and texts whose trigrams speak against every
    mixture (fit below REJECT_BELOW, so that a short text is not rejected by chance).  Learns from all
    labelled rows, none held out.  Other cases as in ``identify``.
    """
    flat = positional(docs)
    text_at, lang_at = (f"__c{place(docs, c)}" for c in (text_col, lang_col))
    langs, logp = train(flat.select(F.col(text_at).alias("text"), F.col(lang_at).cast("string").alias("lang")))
    kept = predict(flat, langs, logp, text_at, keep_text=True)
    kept = kept.filter((F.col("lang_pred") != UNKNOWN) & (F.col("fit") >= REJECT_BELOW))
    return kept.select(*[F.col(c) for c in flat.columns]).toDF(*docs.columns)
