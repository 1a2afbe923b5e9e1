"""Periodic runs of words, from the maximal pairs of each text.

Two places of a text whose words agree for exactly ``L`` words, with different words before and behind,
are a maximal pair. Where they lie ``q`` apart and ``q`` is at most half of ``L``, the stretch of
``q + L`` words from the first place has period ``q`` and no neighbouring word continues it: it is a
run as it stands. The pairs come from the tree of LCP intervals of the suffix array, taken bottom
up: an interval holds the places of its suffixes in order, each with the class of its left word, and
where a child joins its interval only neighbouring places of different classes are looked at. The two
places of a run are neighbours, as a place between them would give the run a smaller period.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass
from hashlib import sha256
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm import arrow

Run = tuple[int, int, int]  # start, length and period, in words


@dataclass(frozen=True)
class Rules:
    min_length: int = 24  # words of a run
    min_exponent: int = 3  # periods of a run

    @property
    def shortest(self) -> int:
        """The fewest words that the two places of a run have in common."""
        over = self.min_exponent - 1
        return min(max(self.min_length - q, over * q) for q in range(1, self.min_length + 1))


def _repeated(flat: np.ndarray, room: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Places whose ``n`` words may stand at another place of the same text.

    Equal words have equal hashes, so none is missed. ``room`` is the number of words from a place
    to the end of its text.
    """
    if len(flat) < n:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        value = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
        last = len(flat) - n + 1
        sums = text[:last].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        for step in range(n):
            sums = sums * np.uint64(0xD6E8FEB86659FD93) + value[step : step + last]
    places = np.flatnonzero(room[:last] >= n)
    order = places[np.argsort(sums[places], kind="stable")]
    ordered = sums[order]
    twice = np.zeros(len(order), bool)
    twice[1:] = ordered[1:] == ordered[:-1]
    twice[:-1] |= twice[1:]
    return np.sort(order[twice])


def _stretches(flat: np.ndarray, text: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The words that places of ``places`` reach, stretch by stretch, and where each stands in ``flat``.

    A number of its own closes every stretch; words of different texts get different numbers.
    """
    reach = np.zeros(len(flat) + 1, np.int64)
    np.add.at(reach, places, 1)
    np.add.at(reach, places + n, -1)
    at = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
    apart = np.ones(len(at), bool)
    apart[:-1] = (np.diff(at) != 1) | (np.diff(text[at]) != 0)
    slot = np.arange(len(at)) + np.cumsum(apart) - apart
    size = len(at) + int(apart.sum())
    words = np.zeros(size, np.int64)
    words[slot] = text[at] * (int(flat.max()) + 1) + flat[at]
    closing = np.ones(size, bool)
    closing[slot] = False
    words[closing] = -1 - np.arange(size - len(at))
    where = np.full(size, -1, np.int64)
    where[slot] = at
    return words, where


def _suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and how many words each suffix shares with the one before."""
    n = len(words)
    ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    width = 1
    while ranks[-1].max() + 1 < n:
        behind = np.zeros(n, np.int64)
        behind[:-width] = ranks[-1][width:] + 1
        found = np.unique(ranks[-1] * (n + 1) + behind, return_inverse=True)[1]
        ranks.append(found.astype(np.int64))
        width *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n - 1, np.int64)
    # The last ranks are all different; from wide to narrow each width fits at most once.
    for level in range(len(ranks) - 2, -1, -1):
        step = np.append(ranks[level], -1)
        same = step[a] == step[b]
        for values in (a, b, shared):
            values[same] += 1 << level
    return order, shared


def _join(one: list[int], other: list[int], shared: int, left: dict[int, int], rules: Rules, found: dict) -> list[int]:
    """Places of two children of an interval in order; maximal pairs between them go to ``found``."""
    if len(one) < len(other):
        one, other = other, one
    most = shared // (rules.min_exponent - 1)
    size = len(one)
    for place in other:
        at = bisect_left(one, place)
        for neighbour in (one[at - 1] if at else None, one[at] if at < size else None):
            if neighbour is None:
                continue
            period = abs(place - neighbour)
            if period <= most and period + shared >= rules.min_length and left[place] != left[neighbour]:
                run = min(place, neighbour), period + shared
                found[run] = min(period, found.get(run, period))
    if len(other) == 1:
        insort(one, other[0])
        return one
    return sorted(one + other)


def _intervals(places: list[int], shared: list[int], left: dict[int, int], rules: Rules, found: dict) -> None:
    """The LCP intervals of neighbouring suffixes, bottom up; ``shared[i]`` belongs to ``places[i]`` and the next."""
    open_intervals: list[tuple[int, list[int]]] = []
    for place, depth in zip(places, [*shared, -1], strict=True):
        node = [place]
        while open_intervals and open_intervals[-1][0] > depth:
            inner, members = open_intervals.pop()
            node = _join(members, node, inner, left, rules, found)
        if open_intervals and open_intervals[-1][0] == depth:
            node = _join(open_intervals.pop()[1], node, depth, left, rules, found)
        open_intervals.append((depth, node))


def runs(texts: list[np.ndarray], rules: Rules = Rules()) -> list[list[Run]]:
    """All runs of each text, given as word numbers, by start and then period."""
    out: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(words) for words in texts], np.int64)
    if not sizes.sum():
        return out
    flat = np.concatenate(texts)
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)
    room = np.repeat(begin + sizes, sizes) - np.arange(len(flat))
    n = rules.shortest
    places = _repeated(flat, room, text, n)
    if not len(places):
        return out
    words, where = _stretches(flat, text, places, n)
    order, shared = _suffixes(words)
    # Suffixes that share fewer words are in no interval that holds a run.
    near = shared >= n
    inside = np.zeros(len(order), bool)
    inside[1:] = near
    inside[:-1] |= near
    group = np.cumsum(np.append(True, ~near))[inside]
    at = where[order[inside]]
    depth = np.append(shared, 0)[inside]
    # Intervals whose places all lie too far apart for their longest agreement hold no run.
    by_place = np.lexsort((at, group))
    gap = np.diff(at[by_place])
    gap[np.diff(group[by_place]) != 0] = len(flat)
    edges = np.flatnonzero(np.diff(group, prepend=-1))
    closest = np.minimum.reduceat(np.append(gap, len(flat)), edges)
    deepest = np.maximum.reduceat(np.where(np.append(np.diff(group) == 0, False), depth, 0), edges)
    found: dict[tuple[int, int], int] = {}
    before = np.where(at == begin[text[at]], -1, flat[at - 1])
    ends = np.append(edges[1:], len(at))
    for i in np.flatnonzero(closest * (rules.min_exponent - 1) <= deepest):
        part = slice(edges[i], ends[i])
        members = at[part].tolist()
        left = dict(zip(members, before[part].tolist(), strict=True))
        _intervals(members, depth[part][:-1].tolist(), left, rules, found)
    for (start, length), period in found.items():
        of = text[start]
        out[of].append((start - int(begin[of]), length, period))
    for rows in out:
        rows.sort(key=lambda run: (run[0], run[2]))
    return out


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a text that is made to repeat part of itself, or None where it stays as it is.

    A fixed rule by the CRC-32 of the decimal id, so that tables without runs exercise the operator too.
    """
    code = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or not n or code % 10:
        return None
    code //= 10
    first = code % n
    period = 1 + (n - first) // (3 + code % 8)
    index = np.arange(n)
    index[first:] = first + (index[first:] - first) % period
    return index


def longest(found: list[Run]) -> Run | None:
    """The run with the greatest exact exponent; ties go to the smallest start, then period."""
    best = None
    for run in sorted(found, key=lambda run: (run[0], run[2])):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], found: list[Run]) -> list[bytes]:
    """Words without those that a run holds behind its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


REPORT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_runs", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("period", pa.int64()),
        ("exponent_milli", pa.int64()),
        ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)


def periodic_runs(docs: DataFrame, rules: Rules = Rules(), loop: bool = False) -> DataFrame:
    """Runs of every whole text: their number, the one of the greatest exponent, and digests.

    One row per input row, repeated rows included. Words are what stands between ASCII blanks. Null,
    empty and blank texts have no words and no runs, their digests are those of the empty string, and
    the four columns of a text's best run are null where it has none. ``collapsed_sha256`` is the digest
    of the words left when each run keeps its first period. With ``loop`` the texts that ``looped`` picks by
    ``doc_id`` are changed first; a row without an id is not. Columns other than ``doc_id`` and ``text``
    are not read. There is no shuffle: a task holds one slice of text, or one longer text.
    """

    def report(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        texts, coded = [], []
        ids = batch.column("doc_id").to_pylist()
        for doc_id, text in zip(ids, arrow.texts(batch).cast(pa.binary()).to_pylist(), strict=True):
            words = text.split()
            codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            index = looped(doc_id, len(words)) if loop else None
            if index is not None:
                codes = codes[index]
                words = [words[i] for i in index.tolist()]
            texts.append(words)
            coded.append(codes)
        rows = []
        for doc_id, words, found in zip(ids, texts, runs(coded, rules), strict=True):
            best = longest(found)
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
            rows.append(
                (
                    doc_id,
                    len(found),
                    *(best or (None, None, None)),
                    1000 * best[1] // best[2] if best else None,
                    sha256(listed.encode()).hexdigest(),
                    sha256(b" ".join(collapse(words, found))).hexdigest(),
                )
            )
        columns = zip(*rows, strict=True)
        return arrow.table(REPORT, **{name: list(values) for name, values in zip(REPORT.names, columns, strict=True)})

    return arrow.map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), report, REPORT)


def sql(rules: Rules = Rules()) -> str:
    """The report with ``loop`` for DuckDB, by comparing every two equal words of a text."""
    # CRC-32, a bit at a time.
    turned = "xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {turned})"
    code = f"xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(s)::BIGINT for s in string_split(doc_id::VARCHAR, '')]), lambda c, b: {byte}), 4294967295)"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, words, len(words) AS n, {code} AS h
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)),
rule AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM docs),
looped AS (
  SELECT row_no, doc_id, n, words, generate_series AS i,
    CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END AS j
  FROM rule, LATERAL generate_series(0, n - 1) AS t(generate_series), LATERAL (SELECT generate_series AS i) AS u),
w AS (SELECT row_no, n, i, words[j + 1] AS word FROM looped),
equal AS (
  SELECT x.row_no, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.row_no = y.row_no AND x.word = y.word AND y.i > x.i
    AND (y.i - x.i) * {rules.min_exponent} <= x.n),
islands AS (
  SELECT row_no, q, i, i - row_number() OVER (PARTITION BY row_no, q ORDER BY i) AS island FROM equal),
periodic AS (
  SELECT row_no, min(i) AS start, count(*) + q AS length, q FROM islands GROUP BY row_no, q, island
  HAVING count(*) + q >= greatest({rules.min_length}, {rules.min_exponent} * q)),
runs AS (SELECT row_no, start, length, min(q) AS period FROM periodic GROUP BY row_no, start, length),
listed AS (
  SELECT row_no, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM runs GROUP BY row_no),
greatest_runs AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs s WHERE s.row_no = r.row_no AND (s.length * r.period > r.length * s.period
      OR s.length * r.period = r.length * s.period AND (s.start, s.period) < (r.start, r.period)))),
dropped AS (
  SELECT DISTINCT w.row_no, w.i FROM w JOIN runs r ON w.row_no = r.row_no AND w.i >= r.start + r.period AND w.i < r.start + r.length),
kept AS (
  SELECT w.row_no, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM w LEFT JOIN dropped d ON w.row_no = d.row_no AND w.i = d.i WHERE d.i IS NULL GROUP BY w.row_no)
SELECT d.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
  b.period::BIGINT AS period, (1000 * b.length // b.period)::BIGINT AS exponent_milli,
  sha256(coalesce(l.runs, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON d.row_no = l.row_no LEFT JOIN greatest_runs b ON d.row_no = b.row_no
LEFT JOIN kept k ON d.row_no = k.row_no
"""
