"""Fill-in-the-middle transformation of whole texts, cut at token or code-point boundaries.

Texts are worked on as UTF-8 bytes, as they lie in an Arrow batch.  Almost all characters are single
bytes, so code points are byte numbers but for a few exceptions: ``ExceptionIndex`` records where the
multibyte characters begin and how many bytes each has in excess of one.  A cut's code points (or a code
point's byte) come from one ``searchsorted`` in that list; the ASCII spans in between stay arithmetic.

Scale: one pass over the rows, no shuffle, nothing broadcast.  A batch is worked on in slices of
``SLICE_BYTES`` of text, so memory follows the slice and the longest single text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentmart.llm.common import pick, text_slices

# Fixed values of the contract: the marks, and the shares of transformed and suffix-first documents.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT, SPM_PERCENT = 50, 80
SEED = 42

SLICE_BYTES = 4 << 20
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class ExceptionIndex:
    """Byte and code-point places of UTF-8 ``data``, by its multibyte characters alone."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)  # bytes that lead a multibyte character
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0) + (lead >= 0xF0).astype(np.int64)
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.at_chars = self.at - self.excess[:-1]

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut; cuts lie between characters."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.excess[np.searchsorted(self.at_chars, cuts)]


def token_ends(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Byte places where tokens end: white space and the word after it, or white space that ends a text.

    ``ends`` are the ends of the texts that lie one after another in ``data``.
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.zeros(len(data), bool)
    last[:-1] = space[1:] & ~space[:-1]
    last[ends[ends > 0] - 1] = True
    return np.flatnonzero(last) + 1


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The four numbers that decide a document's form and cuts."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _assemble(form: str, pre: bytes, mid: bytes, suf: bytes) -> bytes:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    return p + pre + s + suf + m + mid if form == "psm" else s + suf + p + pre + m + mid


def transform_texts(ids: list[int | None], texts: pa.Array, seed: int, unit: str, fim: int, spm: int) -> pa.RecordBatch:
    """The transformed rows of one slice."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])  # a copy that begins at offset zero
    _, offsets, raw = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1)
    data = np.frombuffer(raw, np.uint8, offsets[-1]) if raw is not None else np.zeros(0, np.uint8)
    starts, ends = offsets[:-1], offsets[1:]
    index = ExceptionIndex(data)
    if unit == "word":
        marks = token_ends(data, ends[ends > starts])
        first = np.searchsorted(marks, starts, "right")  # a token ends after its text's start
        n = np.searchsorted(marks, ends, "right") - first
    else:
        n = index.chars(ends) - index.chars(starts)
    h = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    units = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    if unit == "word":
        at = np.concatenate([marks, [0]])[first[:, None] + units - 1]
        cuts = np.where(units == 0, starts[:, None], at)
    else:
        cuts = index.bytes((index.chars(starts)[:, None] + units).ravel()).reshape(-1, 2)
    chars = index.chars(np.concatenate([starts[:, None], cuts], axis=1).ravel()).reshape(-1, 3)
    forms = np.where(h[:, 2] % 100 >= fim, "plain", np.where(h[:, 3] % 100 < spm, "spm", "psm")).tolist()

    marks_of_form = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    whole = data.tobytes()
    out = []
    for i, (s, a, b, e) in enumerate(zip(starts.tolist(), cuts[:, 0].tolist(), cuts[:, 1].tolist(), ends.tolist(), strict=True)):
        text = whole[s:e]
        if not text or any(m in text for m in marks_of_form):
            forms[i] = "plain"
        out.append(text if forms[i] == "plain" else _assemble(forms[i], whole[s:a], whole[a:b], whole[b:e]))
    sizes = np.diff(chars, axis=1)
    plain = np.array([f == "plain" for f in forms], bool)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(n, pa.int64()),
            pa.array(forms, pa.string()),
            pa.array(sizes[:, 0], pa.int64(), mask=plain),
            pa.array(sizes[:, 1], pa.int64(), mask=plain),
            pa.array(out, pa.binary()).cast(pa.string()),
        ],
        names=[f.split()[0] for f in OUT.split(", ")],
    )


def _run(seed: int, unit: str, fim: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in text_slices(b, "text", SLICE_BYTES):
                yield transform_texts(part.column("doc_id").to_pylist(), part.column("text"), seed, unit, fim, spm)

    return run


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    unit: str = "word",
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """Every row as doc_id, n (units of its text), form, prefix_chars, middle_chars, output.

    Units are tokens (``word``: white space with the word after it) or code points (``char``).  Form
    psm is prefix, suffix, middle; spm is suffix, prefix, middle, each behind its mark.  A text that is
    null or empty is the empty plain text; one that holds a mark stays plain; a plain row's prefix and
    middle are null.  The cuts depend on the id alone, so repeated rows give the same output; a null id
    draws as an empty one.  Long texts are cut as a whole.  An empty table gives an empty result; extra
    columns are ignored, whatever their names.
    """
    if unit not in ("word", "char"):
        raise ValueError("unit is word or char")
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(_run(seed, unit, fim_percent, spm_percent), OUT)


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from, by its marks.

    A transformed text holds each mark once: it had none before, and no mark can arise where parts
    meet, because marks begin with the one and end with the other angle bracket.
    """
    middle = F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(output, MIDDLE, 1)
    psm = F.concat(_tail(F.substring_index(head, SUFFIX, 1)), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, _tail(F.substring_index(head, PREFIX, 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def _tail(part: Column) -> Column:
    """What follows the mark that the output begins with."""
    return F.substring(part, len(PREFIX) + 1, 2**31 - 1)


#: DuckDB form of the contract's digests.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {docs}),
k AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
             sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM d),
r AS (SELECT doc_id, t, w, len(w) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM k),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid,
             array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
