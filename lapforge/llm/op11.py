"""Periodic runs of words in texts: a sparse diagonal DP over lags, worked off word by word.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends.  On the diagonal of lag q it is a stretch of ``length - q`` matches.

*The DP.*  At every word its earlier occurrence continues the match length of the lag between the two; a lag that the next
word does not continue ends, and emits its run at once if the match was long enough.

*Why it stays sparse.*  Taking all earlier occurrences of a frequent word costs the square of its count.  Words are
therefore looked up with context: on level k a position stands for the ``L = 2**k`` words that end there, and serves the
lags ``L / 2 < q <= L`` alone.  If a stretch of smallest period q holds such a context twice at a lag d < q, it has
both periods over ``L + d >= q + d`` words, hence (Fine and Wilf) the period gcd(d, q) throughout, against q
being its smallest.  So the *nearest* earlier occurrence is the only one that matters: a level has one active lag per
word, a text of n words costs O(n log n) time and O(n) memory whatever its words are, and a run is found with its
smallest period on one level only.  Contexts that do not occur twice within a quarter of the text are in no run of four
periods and drop out of all further levels, which leaves few positions in prose.

Words are numbered exactly (as bytes); contexts are compared by 64-bit hashes and every run is verified on the words.
Texts are worked off in pieces of about ``PIECE`` bytes; a text longer than that is a piece of its own.

Defined results: a null or empty text has no words and no runs; a text of any length is read whole; every row gives
one row, repeated rows included; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import WORD
from .words import mix

PIECE = 1 << 20
#: A run has at least this many words, and this many periods (three or more, see above).
LEAST, PERIODS = 6, 4

_STEP = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start: long, length: long, period: long>>"


def nearest_lags(code: np.ndarray, at: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the ascending positions ``at``: the lag to the nearest earlier one with the same code, or 0, and
    whether any, earlier or later, has it within ``room``."""
    own = code[at]
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    later, earlier = order[1:][same], order[:-1][same]
    lag = np.zeros(len(at), np.int64)
    lag[later] = at[later] - at[earlier]
    near = (lag > 0) & (lag <= room[at])
    near[earlier[near[later]]] = True
    return lag, near


def emitted(at: np.ndarray, lag: np.ndarray, level: int) -> np.ndarray:
    """Rows (start, length, period) of the diagonals on which the active lag goes on from word to word until it ends."""
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    start = at[begin] - level + 1 - lag[begin]
    return np.stack([start, at[end] - start + 1, lag[begin]], axis=1)


def runs_of(words: np.ndarray, owner: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """Rows (start, length, period), by start, then period, of all runs in the numbered words of several texts.

    ``owner`` is the text of each word, ascending; starts count from the first word of all texts.
    """
    if periods < 3:
        raise ValueError("a run needs three periods or more")
    n = len(words)
    room = (np.bincount(owner) // periods)[owner] if n else np.zeros(0, np.int64)
    # a word of another text is another word, so no diagonal leaves a text
    code = mix(words.astype(np.uint64) + (owner.astype(np.uint64) << np.uint64(32)) + _STEP)
    at, found, level = np.arange(n), [np.zeros((0, 3), np.int64)], 1
    while len(at) and level < 2 * int(room.max()):
        lag, near = nearest_lags(code, at, room)
        at, lag = at[near], lag[near]
        served = (2 * lag > level) & (lag <= level)
        if served.any():
            runs = emitted(at[served], lag[served], level)
            found.append(runs[runs[:, 1] >= np.maximum(least, periods * runs[:, 2])])
        # the next level joins neighbouring contexts of which both recur
        recurs = np.zeros(n, bool)
        recurs[at] = True
        at = at[at >= level]
        at = at[recurs[at - level]]
        longer = np.zeros(n, np.uint64)
        longer[at] = mix(code[at - level] * _STEP + code[at] + np.uint64(level))
        code, level = longer, 2 * level
    runs = np.concatenate(found)
    sure = [np.array_equal(words[s : s + m - q], words[s + q : s + m]) for s, m, q in runs.tolist()]
    runs = runs[np.array(sure, bool)]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each text) for consecutive texts of about ``PIECE`` bytes."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.as_py() or b""
        held.append(raw.split())  # bytes split at space, tab, LF, VT, FF and CR only
        size += len(raw)
        if size >= PIECE:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _rows(piece: list[list[bytes]], least: int, periods: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(number of words, runs, kept words joined by a space) of every text of a piece."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in piece], np.int64)
    words = np.array([numbers.setdefault(w, len(numbers)) for own in piece for w in own], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    runs = runs_of(words, np.repeat(np.arange(len(piece)), sizes), least, periods)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(cover)[:-1] == 0
    text = np.searchsorted(bounds, runs[:, 0], side="right") - 1
    kept = list(piece)
    for i in np.unique(text).tolist():
        kept[i] = [w for w, k in zip(piece[i], keep[bounds[i] : bounds[i + 1]].tolist(), strict=True) if k]
    fields = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - bounds[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(piece) + 1)).astype(np.int32)), fields)
    return pa.array(sizes), lists, pa.array([b" ".join(w) for w in kept], pa.binary()).view(pa.string())


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, periods: int = PERIODS
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``.

    ``runs`` are (start, length, period) by start, then period.  ``collapsed`` is the text without the words that a
    run contains after its first period, one space between words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, piece in _pieces(batch.column("text").cast(pa.large_binary())):
                own = batch.column("doc_id").slice(first, len(piece))
                yield pa.RecordBatch.from_arrays([own, *_rows(piece, least, periods)], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def digest(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    lines = F.transform(runs, lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))


def greatest(runs: Column) -> Column:
    """The longest run; of several the one that starts first, then the one of least period; null without any."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period"))


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """Text whose words from a place on repeat a stretch of it, for the ids whose crc32 ends in 0; null ids keep theirs.

    With the n words of the text and g the crc32 without its last digit, word ``i >= a`` becomes word
    ``a + (i - a) % p``, where ``a = g % n`` and ``p = 1 + (n - a) // (3 + g % 8)``.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n = F.size(words).cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
    block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), (n - a).cast("int"))
    longer = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.rlike(WORD), longer).otherwise(text)
