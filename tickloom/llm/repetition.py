"""Quality rules on the repetition inside a text, found with a suffix array over its words.

For every text: plain counts, then the suffix array of its word sequence and the longest common prefixes of
neighbouring suffixes. An interval of the array whose suffixes share ``l`` words is a repeated substring; those that
cannot be extended to the left are the maximal ones. The union of their places is the covered part of the text.

A text fails the method's rule if the repeats of at least ``least_words`` words cover more than ``most_covered`` of its
words, or if the longest of them is longer than ``longest_share`` of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import only, slices

SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_CONTINUED = bytes(range(0x80, 0xC0))
SCHEMA = (
    "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "covered_words long, longest_repeat long, n_repeats long, spans string, kept boolean"
)


@dataclass(frozen=True)
class Rules:
    """Limits of the method's own rule; ``least_words`` is the shortest repeat that counts."""

    least_words: int = 10
    most_covered: float = 0.4
    longest_share: float = 0.3


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, in order of first appearance."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def windows_repeated(numbers: np.ndarray, width: int) -> np.ndarray:
    """For every start of a window of ``width`` words whether the same window starts elsewhere too."""
    n = len(numbers) - width + 1
    if n < 2:
        return np.zeros(max(n, 0), bool)
    rank = numbers
    done = 1
    while done < width:  # ranks of windows of done words become ranks of windows of up to twice as many
        step = min(done, width - done)
        left, right = rank[: len(rank) - step], rank[step:]
        rank = np.unique(left * (rank.max() + 1) + right, return_inverse=True)[1]
        done += step
    return np.bincount(rank)[rank] > 1


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    edge = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + lengths, minlength=n + 1)[: n + 1]
    return np.cumsum(edge)[:n] > 0


def suffix_array(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by doubling, and the longest common prefix of each suffix with the one before it (0 for the first)."""
    n = len(numbers)
    rank = np.unique(numbers, return_inverse=True)[1] + 1
    levels, width = [rank], 1
    while rank.max() < n and width < n:
        later = np.zeros(n, np.int64)
        later[: n - width] = rank[width:]
        rank = np.unique(rank * (n + 1) + later, return_inverse=True)[1] + 1
        levels.append(rank)
        width *= 2
    order = np.empty(n, np.int64)
    order[rank - 1] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):  # ranks of 2^k words are equal only if these words are
        inside = (a + (1 << k) <= n) & (b + (1 << k) <= n)
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        a, b = a + (same << k), b + (same << k)
        lcp[1:] += same << k
    return order, lcp


def maximal_repeats(numbers: np.ndarray, least: int) -> list[tuple[int, list[int]]]:
    """(length, sorted starts) of the repeated substrings of ``least`` words or more that extend neither way."""
    order, lcp = suffix_array(numbers)
    found, stack = [], []  # the stack holds open intervals: (common prefix, first index)
    for i in range(1, len(order) + 1):
        here = int(lcp[i]) if i < len(order) else 0
        first = i - 1
        while stack and stack[-1][0] > here:
            length, first = stack.pop()
            starts = np.sort(order[first:i])
            before = np.where(starts > 0, numbers[starts - 1], -1)
            if starts[0] == 0 or (before != before[0]).any():
                found.append((length, starts.tolist()))
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, first))
    return found


def repeat_spans(numbers: np.ndarray, least: int) -> tuple[np.ndarray, int, int]:
    """Covered words, the longest repeat's length and the number of maximal repeats."""
    n = len(numbers)
    if not windows_repeated(numbers, least).any():
        return np.zeros(n, bool), 0, 0
    order, lcp = suffix_array(numbers)
    best = np.zeros(n + 1, np.int64)  # the longest repeat that starts at each word
    best[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    best = best[:n]
    # A repeat that starts one word earlier covers what starts here unless this one reaches further.
    opens = (best >= least) & (best > np.append(0, best[:-1]) - 1)
    starts = np.flatnonzero(opens)
    return covered(starts, best[starts], n), int(best.max()), len(starts)


def measure(text: str, rules: Rules = Rules()) -> tuple:
    """The columns after ``doc_id`` for one text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    numbers = word_numbers(words)
    word_chars = sum(map(len, words)) - (0 if raw.isascii() else len(raw) - len(raw.translate(None, _CONTINUED)))
    seen, dup_lines = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(b" \t\n\r\x0b\x0c"):
            seen.add(line)
    starts = np.flatnonzero(windows_repeated(numbers, 3))
    repeat_words = int(covered(starts, np.full(len(starts), 3), n).sum()) if len(starts) else 0
    inside, longest, repeats = repeat_spans(numbers, rules.least_words)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
    spans = ",".join(f"{a}:{b}" for a, b in edges.reshape(-1, 2).tolist())
    base_failed = n < 50 or 100 * repeat_words > 50 * n
    failed = inside.sum() > rules.most_covered * n or longest > rules.longest_share * n
    return n, word_chars, len(raw.translate(None, _NOT_SYMBOLS)), dup_lines, repeat_words, base_failed, int(inside.sum()), longest, repeats, spans, not (base_failed or failed)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs`` with the columns of ``SCHEMA``; ``spans`` lists the covered words, from 0, end exclusive.

    A null or empty text has no words and fails the base rule; identifiers may be null or repeated; an empty table
    gives an empty one; other columns are not looked at. Memory is a small multiple of the longest text.
    """
    rows = only(docs, id_col, text_col)
    schema = SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            measured = list(zip(*(measure(t, rules) for t in batch.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in measured)], names=names)

    names = [part.split()[0] for part in schema.split(", ")]
    return rows.mapInArrow(run, schema)


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that pass both rules; nothing is shuffled."""
    names = docs.columns
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    text = f"c{names.index(text_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield batch.filter(pa.array([measure(t or "", rules)[-1] for t in batch.column(text).to_pylist()], pa.bool_()))

    kept = inner.mapInArrow(run, inner.schema)
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
