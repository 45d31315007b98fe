"""Conversation structure repair by alignment to the alternating grammar, at least cost.

A repaired conversation's role initials read ``(s?(ua)+)?``.  For each length there is one such string at
most, so a repair is a Wagner-Fischer alignment of the turns to the string of some feasible length: keep a
turn, change its role, delete it, insert an empty one.  All strings end alike, so one table over (turn,
letters that remain) serves every length.  A greedy repair gives an incumbent cost; what it costs beyond
the costs that no repair avoids bounds the insertions and deletions, and with them the diagonals that are
computed (Ukkonen's band).  Each length of least cost is traced back, and of their audits the ASCII-least
stays.

Long conversations are aligned in blocks of ``BLOCK`` turns, once for each pair of grammar states at a
block's ends; the best repair of a conversation is the cheapest chain of blocks.  That is exact, ties
included: of two audits of equal cost over the same turns neither begins the other (it would have
insertions to spare), so least audits are made of least audits.

Scale: a turn's faults are found by aggregates and windows over digests, spread over (conversation, role,
text).  Then each conversation's turns pass through one task in order, as a stream: first as small rows
without texts, to be aligned, then with their texts, to be repaired.  Memory holds one block, and one
byte a turn for the audit, which is one value of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentmart.llm.common import WHITESPACE, pick

# Fixed values of the contract: costs of the edits, and of a truncated turn that stays.
RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
BLOCK = 1024
#: Block results that a worker keeps, by their turns; emptied when full.
KEPT_RESULTS = 20_000

# A turn's code is 4 * letter + fault.
LETTERS = "sua?"
FINE, CUT_OFF, DOOMED = 0, 1, 2  # fault: none, truncated, must be deleted
# Grammar states between turns: nothing yet, after s, a is due, u is due after a pair.
START, AFTER_S, DUE_A, DUE_U = range(4)


# --- alignment of one block ---------------------------------------------------


class Block:
    """Least repairs of ``codes`` from grammar state to grammar state."""

    def __init__(self, codes: bytes):
        self.n = len(codes)
        self.letter = [LETTERS[c >> 2] for c in codes]
        self.fault = [c & 3 for c in codes]
        self.stay = [TRUNCATED if f == CUT_OFF else 0 for f in self.fault]
        self.doomed = sum(f == DOOMED for f in self.fault)
        self.cut_off = sum(f == CUT_OFF for f in self.fault)
        self.least = DELETE * self.doomed + TRUNCATED * self.cut_off  # no repair costs less
        self.left = [0] * (self.n + 1)  # turns from i on that may stay
        for i in range(self.n - 1, -1, -1):
            self.left[i] = self.left[i + 1] + (self.fault[i] != DOOMED)

    def greedy(self, state: int, last: int) -> int:
        """The cost of a repair that reads on, changing each role that does not fit."""
        cost = self.least
        for letter, fault in zip(self.letter, self.fault, strict=True):
            if fault == DOOMED:
                continue
            if state == START and letter == "s":
                state = AFTER_S
                continue
            due = "a" if state == DUE_A else "u"
            cost += 0 if letter == due else RETYPE
            state = DUE_U if due == "a" else DUE_A
        missing = 0 if state == last else 1 if {state, last} == {DUE_A, DUE_U} or last == DUE_A else 2
        return cost + INSERT * missing

    def table(self, last: int, incumbent: int) -> tuple[np.ndarray, int]:
        """g[i, r - left[i] + down]: least cost of turns i on against the r letters that end in ``last``.

        Only the diagonals that a repair of at most ``incumbent`` can reach are there.
        """
        spare = incumbent - self.least
        up = spare // INSERT
        cheap = min(spare, self.cut_off)  # a truncated turn costs 4 deleted and 3 kept
        down = min(self.left[0], cheap + (spare - cheap) // DELETE)
        width = down + up + 1
        far = np.int64(1 << 40)
        column = np.arange(width)
        g = np.full((self.n + 1, width + 1), far, np.int64)  # one column more, never reached
        g[self.n, down:width] = INSERT * np.arange(up + 1)
        odd = "a" if last == DUE_U else "u"
        for i in range(self.n - 1, -1, -1):
            after = g[i + 1]
            if self.fault[i] == DOOMED:
                best = after[:width] + DELETE
            else:
                r = self.left[i] + column - down
                fits = np.full(width, self.letter[i] == odd)
                fits[r % 2 == 0] = self.letter[i] == ("u" if odd == "a" else "a")
                change = np.where(fits, 0, RETYPE) + self.stay[i]
                best = np.minimum(after[1:] + DELETE, np.where(r >= 1, after[:width] + change, far))
            lowest = max(0, down - self.left[i])  # the column where no letter remains
            best[:lowest] = far
            best[lowest:] = np.minimum.accumulate(best[lowest:] - INSERT * column[lowest:]) + INSERT * column[lowest:]
            g[i, :width] = best
        return g, down

    def trace(self, g: np.ndarray, down: int, last: int, i: int, r: int) -> str:
        """The ASCII-least audit among the least alignments from turn ``i`` and ``r`` letters on."""
        odd, even = ("a", "u") if last == DUE_U else ("u", "a")
        audit = []
        while i < self.n or r:
            here = g[i, r - self.left[i] + down]
            if i < self.n:
                at = r - self.left[i + 1] + down
                if 0 <= at < g.shape[1] and g[i + 1, at] + DELETE == here:
                    audit.append("D")
                    i += 1
                    continue
            at = r - 1 - self.left[i] + down
            if r and at >= 0 and g[i, at] + INSERT == here:
                audit.append("I")
            else:
                audit.append("K" if self.letter[i] == (odd if r % 2 else even) else "R")
                i += 1
            r -= 1
        return "".join(audit)

    def repairs(self, entries: list[int], last: int) -> dict[int, tuple[int, str]]:
        """For each entry state the least (cost, audit) that ends in state ``last``."""
        out: dict[int, tuple[int, str]] = {}
        if last in (START, AFTER_S):
            if last in entries:  # nothing is read
                out[last] = (DELETE * self.n, "D" * self.n)
            if last == AFTER_S and START in entries:
                s_turns = [(self.stay[i], -i) for i in self._s_turns()]
                if s_turns:
                    stay, i = min(s_turns)
                    out[START] = (DELETE * (self.n - 1) + stay, "D" * -i + "K" + "D" * (self.n - 1 + i))
            return out
        incumbent = max(self.greedy(e, last) for e in entries)
        g, down = self.table(last, incumbent)
        even_first = "u" if last == DUE_U else "a"
        for entry in entries:
            due = "a" if entry == DUE_A else "u"
            parity = 0 if due == even_first else 1
            least = 0 if entry not in (START, AFTER_S) else 1  # these still need a pair
            starts = [(0, 0, "")]
            if entry == START:
                starts += [(i + 1, DELETE * i + self.stay[i], "D" * i + "K") for i in self._s_turns()]
            found: list[tuple[int, int, int, str]] = []  # cost, turn, letters, audit so far
            for i, paid, head in starts:
                r = np.arange(g.shape[1] - 1) - down + self.left[i]
                costs = np.where((r % 2 == parity) & (r >= least), g[i, : len(r)], 1 << 40)
                cost = int(costs.min()) + paid
                if cost <= incumbent:
                    found += [(cost, i, int(r[c]), head) for c in np.flatnonzero(costs + paid == cost)]
            cost = min(f[0] for f in found)
            audits = (head + self.trace(g, down, last, i, r) for c, i, r, head in found if c == cost)
            out[entry] = (cost, min(audits))
        return out

    def _s_turns(self) -> list[int]:
        return [i for i in range(self.n) if self.letter[i] == "s" and self.fault[i] != DOOMED]


_RESULTS: dict = {}


def _repairs(codes: bytes, entries: tuple[int, ...], lasts: tuple[int, ...]) -> dict[int, dict[int, tuple[int, str]]]:
    key = (codes, entries, lasts)
    if key not in _RESULTS:
        if len(_RESULTS) >= KEPT_RESULTS:
            _RESULTS.clear()
        block = Block(codes)
        found = {last: block.repairs(list(entries), last) for last in lasts}
        if len(codes) > 64:
            return found
        _RESULTS[key] = found
    return _RESULTS[key]


class Repair:
    """The least repair of a conversation whose codes come block by block."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.codes = bytearray()
        self.best: dict[int, tuple[int, str]] = {START: (0, "")}

    def add(self, code: int, times: int = 1) -> None:
        while times > 0:
            if len(self.codes) == self.block:
                self._close((START, AFTER_S, DUE_A, DUE_U))
            some = min(times, self.block - len(self.codes))
            self.codes += bytes([code]) * some
            times -= some

    def _close(self, lasts: tuple[int, ...]) -> None:
        made = _repairs(bytes(self.codes), tuple(sorted(self.best)), lasts)
        self.codes.clear()
        best = {}
        for last, by_entry in made.items():
            ways = [(self.best[e][0] + cost, self.best[e][1] + audit) for e, (cost, audit) in by_entry.items()]
            if ways:
                best[last] = min(ways)
        self.best = best

    def result(self) -> tuple[int, str]:
        """(cost, audit) of the whole conversation."""
        if self.codes:
            self._close((START, DUE_U))
        return min(self.best[s] for s in (START, DUE_U) if s in self.best)


# --- conversations in order ---------------------------------------------------

_FAULT_COLS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
AUDITS = f"conv_id long, {_FAULT_COLS}"
REPAIRED = "conv_id long, position long, edit string, turn long, role string, text string"
DIGESTS = f"{AUDITS}, repaired_sha256 string"


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[f for f, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _in_batches(rows: Iterator[tuple], ddl: str, size: int = 4096, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, length = [], 0
    for row in rows:
        held.append(row)
        length += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == size or length >= chars:
            yield _batch(held, ddl)
            held, length = [], 0
    yield _batch(held, ddl)


def _audit(conv_id: int | None, units: Iterator[tuple], block: int) -> tuple:
    repair = Repair(block)
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    illegal, before, turns, low, high, seen = 0, None, 0, None, None, None
    for _, turn, letter, n, blank, cut_off, first in units:
        if not n:
            continue
        if turn is not None and turn != seen:
            low, high, seen, turns = turn if low is None else low, turn, turn, turns + 1
        initial = LETTERS[letter]
        legal = {"su", "ua", "au"}
        illegal += (before is not None and before + initial not in legal) + (n - 1 if initial * 2 not in legal else 0)
        before = initial
        if blank:
            counts["blank"] += n
            repair.add(4 * letter + DOOMED, n)
            continue
        if first:
            counts["truncated"] += cut_off
            repair.add(4 * letter + (CUT_OFF if cut_off else FINE))
        again = n - first
        counts["duplicate"] += again
        repair.add(4 * letter + DOOMED, again)
    cost, audit = repair.result()
    gaps = 0 if low is None else high - low + 1 - turns
    return (conv_id, gaps, *counts.values(), illegal, cost, audit)


def _audit_all(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (_audit(conv_id, units, block) for conv_id, units in groupby(_rows(batches), key=lambda u: u[0]))
        return _in_batches(made, AUDITS)

    return run


def _edited(rows: Iterator[tuple], audit: str) -> Iterator[tuple]:
    """The edits in order as (edit, turn, role, text); what is deleted is passed over."""
    due = "u"
    for edit in audit:
        turn = role = text = None
        if edit != "I":
            turn, role, text = next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES[due]
        yield edit, turn, role, text or ""
        due = "a" if role[0] == "u" else "u"


def _conversations(batches: Iterator[pa.RecordBatch]):
    """Each conversation as (its audit row, its turns in order)."""
    for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
        head = next(rows)
        yield (head[0], *head[5:]), (r[2:5] for r in rows)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for head, turns in _conversations(batches):
            for position, edit in enumerate(_edited(turns, head[-1])):
                yield (head[0], position, *edit)

    return _in_batches(rows(), REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for head, turns in _conversations(batches):
            digest, gap = hashlib.sha256(), ""
            for _, _, role, text in _edited(turns, head[-1]):
                digest.update(f"{gap}{role}:{text}".encode("utf-8", "surrogatepass"))
                gap = "\n"
            yield (*head, digest.hexdigest())

    return _in_batches(rows(), DIGESTS)


# --- operators ----------------------------------------------------------------


def _turns(turns: DataFrame) -> DataFrame:
    rows = pick(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    blank = F.lit(" ")
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    ).withColumn("digest", F.unhex(F.md5("text")))


def _order(*first: str) -> list[Column]:
    """A conversation's order: by turn, nulls first; ties by role and the text's digest."""
    return [*map(F.col, first), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def audits(turns: DataFrame, ids: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """One row per conversation: gaps, counts of faults, illegal neighbours, and the least repair.

    ``turns`` has conv_id, turn, role and text; ``ids`` (conv_id) names conversations that count even
    without turns, which have zeros and an empty audit.  A turn's first fault counts: blank (no
    character but ASCII white space), duplicate (role and text seen earlier), truncated (its last such
    character is none of ``.!?``).  A null role or text is one space; a null conv_id is a conversation
    of its own; turns with the same number follow each other by role and digest of the text, repeated
    rows side by side.  A role that begins with none of s, u and a, or is empty, fits nowhere in the
    grammar.  An empty table gives an empty result; extra columns are ignored, whatever their names.
    """
    rows = _turns(turns)
    stripped = F.rtrim(F.col("text"), F.lit(WHITESPACE))
    initial = F.substring("role", 1, 1)
    units = (
        rows.select(
            "conv_id",
            "turn",
            "role",
            "digest",
            (stripped == "").alias("blank"),
            (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut_off"),
        )
        .groupBy("conv_id", "turn", "role", "digest")
        .agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut_off").alias("cut_off"))
    )
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    units = units.withColumn("first", F.row_number().over(same) == 1)
    if ids is not None:
        named = pick(ids, conv_id="conv_id").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        units = units.unionByName(named.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    ordered = units.repartition("conv_id").sortWithinPartitions(*_order("conv_id"))
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    codes = ordered.select("conv_id", "turn", letter.alias("letter"), "n", "blank", "cut_off", "first")
    return codes.mapInArrow(_audit_all(block), AUDITS)


def _with_audits(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit row, then its turns in order, side by side in one partition."""
    rows = _turns(turns).withColumn("kind", F.lit(1))
    both = audited.withColumn("kind", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    counted = [f.split()[0] for f in _FAULT_COLS.split(", ")]
    ordered = both.repartition("conv_id").sortWithinPartitions(*_order("conv_id", "kind"))
    return ordered.select("conv_id", "kind", "turn", "role", "text", *counted)


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired turns: conv_id, position (from 0), edit (K, R, I), turn, role, text.

    A kept turn is as it was, one whose role changes has its text, an inserted one has an empty text
    and no number.  Cases as in ``audits``; a conversation that keeps nothing has no row.
    """
    return _with_audits(turns, audits(turns, block=block)).mapInArrow(_repaired, REPAIRED)


def repair_digests(turns: DataFrame, ids: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """The rows of ``audits`` with the SHA-256 of the repaired conversation.

    That is of its turns as ``role:text``, joined by line feeds, hashed as they stream by; the hash of
    the empty string where no turn is left.
    """
    return _with_audits(turns, audits(turns, ids, block)).mapInArrow(_digests, DIGESTS)


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damage: each (conversation, turn) is left alone or has one fault, by its checksum."""
    rows = _turns(turns)
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(text[0], F.lit(":"), text[1])) % 20
    return (
        rows.withColumn("fate", fate)
        .filter("fate != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(True), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )
