"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared on their letters and digits alone, in lower case. A window is any
stretch of ``WINDOW`` characters of a benchmark item, from every place of it, or a shorter
item whole. A text holds an item if a stretch of it is within ``edit_budget`` edits of one
of the item's windows: so any copied part of ``WINDOW`` characters counts, wherever it begins.

If a stretch of a text is within ``k`` edits of a window of ``m`` characters, the two share
at least ``m - q + 1 - q * k`` q-grams, and these lie on diagonals (place in the text less
place in the item) at most ``k`` apart. Bands of ``2 * (k + 1)`` diagonals that overlap by
half hold every such group whole. So an item's q-grams are counted per band, the windows
whose own q-grams reach the bound are kept, and each is verified by alignment within the band.

An item of fewer than ``SHORT`` letters and digits says little by its letters alone, which also run
over the words of other sentences. It is found where its words stand one after another as whole
words, without edits; scripts without spaces are one word up to the next sign.

Where many items share a passage, a text's q-grams are looked up for about ``POSTINGS_AT_ONCE``
places of items at a time, in ranges of pieces, and windows of equal characters are aligned
once for a band of a text, however many items they are of.

Items are cut into pieces of at most ``STARTS`` windows, so that each window is in one
piece. Every text is read whole and against every piece, in blocks of about
``WINDOWS_AT_ONCE`` pieces.

Defined results: a null or empty text has no leaks, and neither have items without
letters and digits. Repeated items and rows are each reported. Of equally
good places in a text the first is reported. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.llm.memory import trimmed

WINDOW = 50  # letters and digits
STARTS = 207  # windows that begin in a piece
Q = 6
SHORT = 30  # letters and digits; shorter items are found as whole words only
EDIT_SHARE = 0.12  # edits a window may have, as a share of its length
WINDOWS_AT_ONCE = 20_000  # pieces
CHARS_AT_ONCE = 400_000
ALIGNED_AT_ONCE = 2048
POSTINGS_AT_ONCE = 2_000_000  # places in pieces of a text's q-grams, though always one whole piece

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22  # of the slots of q-grams, at most
_COUNT_BITS = 20  # of the slots of a count, at most
_MIX = 0x9E3779B1  # spreads pieces over the slots of a count
_WORD = re.compile(r"[^\W_]+")
_BREAK = "￿"  # stands between texts; equals nothing in an item


def _fold_table() -> np.ndarray:
    """Code point -> its lower case when a letter or digit, else 0."""
    table = np.zeros(0x10000, np.uint32)
    for code in range(0x10000):
        c = chr(code)
        if c.isalnum():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    table[ord(_BREAK)] = ord(_BREAK)
    return table


def folded(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters that count, and their places in ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = table[np.minimum(codes, 0xFFFE)]
    low[codes == 0xFFFF] = 0xFFFF
    if len(codes) and codes.max() > 0xFFFF:
        low = np.where(codes > 0xFFFF, codes, low)
    places = np.flatnonzero(low)
    return low[places], places


def edit_budget(length: int) -> int:
    """Edits allowed in a window, never so many that it could share no q-gram."""
    return max(0, min(int(EDIT_SHARE * length), (length - Q) // Q))


def _grams(seq: np.ndarray) -> np.ndarray:
    """A hash of each Q consecutive characters."""
    if len(seq) < Q:
        return np.zeros(0, np.uint64)
    h, width = seq.astype(np.uint64), 1
    done, total = None, 0  # hash of the first `total` characters from each place
    for bit in range(Q.bit_length()):
        if Q >> bit & 1:
            if done is None:
                done = h
            else:
                n = len(seq) - total - width + 1
                done = done[:n] * _power(width) + h[total : total + n]
            total += width
        n = len(seq) - 2 * width + 1
        if n > 0:
            h = h[:n] * _power(width) + h[width : width + n]
        width *= 2
    return done[: len(seq) - Q + 1]


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _slot(h: np.ndarray, slots: int) -> np.ndarray:
    """A place for each hash among ``slots``, a power of two."""
    return ((h ^ (h >> np.uint64(29))) * _BASE) >> np.uint64(65 - slots.bit_length())


@dataclass(frozen=True)
class Index:
    """The q-grams of some pieces of benchmark items."""

    table: np.ndarray
    items: list[list]  # of each piece
    codes: np.ndarray  # all pieces, one behind the other
    offsets: np.ndarray  # of each piece in `codes`, and the end
    widths: np.ndarray  # of each piece's windows
    budgets: np.ndarray
    bounds: np.ndarray  # q-grams a match shares at least
    bitmap: np.ndarray  # whether a slot has a gram
    gram_at: np.ndarray  # one gram of each slot, as its number
    grams: np.ndarray  # sorted, distinct
    starts: np.ndarray  # of each gram's places in `piece`, `place` and `key`
    piece: np.ndarray
    place: np.ndarray
    step: int  # 1 << step diagonals are a step of a count, more than any budget
    key: np.ndarray  # less `place`, and steps that tell pieces apart
    short: dict[str, list[tuple[list[str], list]]]  # first word -> words and items that have them


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """The pieces of every item that hold its windows, as rows of item and folded text.

    Of a short item (``short``) the pattern is its words instead.
    """
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    schema = T.StructType(
        [rows.schema["item"], T.StructField("pattern", T.StringType()), T.StructField("short", T.BooleanType())]
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _fold_table()
        for batch in trimmed(batches):
            out = []
            for name, value in zip(batch["item"], batch["text"]):
                seq, _ = folded((value or "").replace(_BREAK, " "), table)
                if len(seq) < SHORT:
                    if len(seq):
                        out.append((name, " ".join(_WORD.findall(value.lower())), True))
                    continue
                for at in range(0, max(1, len(seq) - WINDOW + 1), STARTS):
                    part = seq[at : at + STARTS + WINDOW - 1]
                    out.append((name, part.tobytes().decode("utf-32-le", "surrogatepass"), False))
            yield pd.DataFrame(out, columns=["item", "pattern", "short"])

    return rows.mapInPandas(cut, schema).distinct()


def build_index(rows: list) -> Index:
    by_pattern: dict[str, list] = {}
    by_words: dict[str, list] = {}
    for item, pattern, is_short in rows:
        (by_words if is_short else by_pattern).setdefault(pattern, []).append(item)
    short: dict[str, list] = {}
    for pattern, items in by_words.items():
        if words := pattern.split():
            short.setdefault(words[0], []).append((words, items))
    pieces = [
        np.frombuffer(p.encode("utf-32-le", "surrogatepass"), np.uint32) for p in sorted(by_pattern)
    ]
    lengths = np.array([len(p) for p in pieces], np.int64)
    widths = np.minimum(lengths, WINDOW)
    budgets = np.array([edit_budget(int(m)) for m in widths], np.int64)
    hashes = [_grams(p) for p in pieces]
    flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(h) for h in hashes])
    place = np.concatenate([np.zeros(0, np.int32), *[np.arange(len(h), dtype=np.int32) for h in hashes]])
    order = np.argsort(flat, kind="stable")
    grams, starts = np.unique(flat[order], return_index=True)
    slots = 1 << min(_BITS, max(10, (len(grams) * 32).bit_length()))
    bitmap = np.zeros(slots, np.bool_)
    bitmap[_slot(grams, slots)] = True
    gram_at = np.zeros(slots, np.int32)
    gram_at[_slot(grams, slots)] = np.arange(len(grams), dtype=np.int32)
    step = int(budgets.max(initial=0)).bit_length()
    key = (piece.astype(np.uint32) * np.uint32(_MIX) << np.uint32(step)) - place.astype(np.uint32)
    return Index(
        _fold_table(),
        [by_pattern[p] for p in sorted(by_pattern)],
        np.concatenate([np.zeros(0, np.uint32), *pieces]),
        np.concatenate([[0], np.cumsum(lengths)]),
        widths,
        budgets,
        widths - Q + 1 - Q * budgets,
        bitmap,
        gram_at,
        grams,
        np.append(starts, len(flat)),
        piece[order],
        place[order],
        step,
        key[order],
        short,
    )


def short_leaks(index: Index, text: str) -> dict:
    """Of the short items that a text holds as whole words: (first place, number of places)."""
    found: dict = {}
    words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
    for i, (word, start, _) in enumerate(words):
        for own, items in index.short.get(word, ()):
            if [w for w, _, _ in words[i : i + len(own)]] == own:
                for item in items:
                    place, n = found.get(item, ((0, start, words[i + len(own) - 1][2]), 0))
                    found[item] = (place, n + 1)
    return found


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., n[0] of them, then those of first[1], ..."""
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _postings(index: Index, seq: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place in the index and place in the text of each q-gram in common, in ranges of pieces."""
    grams = _grams(seq)
    slot = _slot(grams, len(index.bitmap))
    hits = np.flatnonzero(index.bitmap[slot])
    grams = grams[hits]
    at = index.gram_at[slot[hits]].astype(np.int64)
    other = np.flatnonzero(index.grams[at] != grams)  # not in the index, or one of several in a slot
    if len(other):
        at[other] = np.minimum(np.searchsorted(index.grams, grams[other]), len(index.grams) - 1)
        true = np.ones(len(hits), np.bool_)
        true[other] = index.grams[at[other]] == grams[other]
        hits, at = hits[true], at[true]
    first = index.starts[at]
    n = index.starts[at + 1] - first

    def expanded(hits: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _ranges(first, n), np.repeat(hits, n)

    if n.sum() <= POSTINGS_AT_ONCE:
        yield expanded(hits, first, n)
        return
    # What each piece has in common with the texts; those below their bound hold no window.
    pieces = len(index.items)
    shared = np.zeros(pieces, np.int64)
    before = np.cumsum(n) // POSTINGS_AT_ONCE
    for lo, hi in itertools.pairwise([0, *np.flatnonzero(np.diff(before)) + 1, len(n)]):
        shared += np.bincount(index.piece[_ranges(first[lo:hi], n[lo:hi])], minlength=pieces)
    shared[shared < index.bounds] = 0
    share = np.cumsum(shared) // POSTINGS_AT_ONCE
    # A q-gram's places are in order of their pieces.
    number = np.repeat(np.arange(len(index.grams)), np.diff(index.starts)) * pieces + index.piece
    for low, high in itertools.pairwise([0, *np.flatnonzero(np.diff(share)) + 1, pieces]):
        if shared[low:high].any():
            start = np.searchsorted(number, at * pieces + low)
            yield expanded(hits, start, np.searchsorted(number, at * pieces + high) - start)


def _candidates(
    index: Index, post: np.ndarray, hit: np.ndarray, breaks: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Piece, start in the piece, band and text of each window that reaches its bound."""
    # A match's diagonals are of two adjacent steps. Steps may share a slot: it never counts too few.
    slots = 1 << min(_COUNT_BITS, max(10, len(post).bit_length()))
    slot = index.key[post]
    slot += hit.astype(np.uint32)
    slot >>= np.uint32(index.step)
    slot &= np.uint32(slots - 1)
    count = np.bincount(slot, minlength=slots)
    count += np.roll(count, -1)
    both = np.maximum(count, np.roll(count, 1))
    keep = np.flatnonzero((both >= index.bounds.min())[slot])
    keep = keep[both[slot[keep]] >= index.bounds[index.piece[post[keep]]]]
    post, hit = post[keep], hit[keep]
    piece, place = index.piece[post].astype(np.int64), index.place[post].astype(np.int64)
    band = (hit - place) // (index.budgets[piece] + 1)
    text = np.searchsorted(breaks, hit)

    # Each hit is in the band that begins with its diagonals and in the one a step before.
    piece, place, text = (np.concatenate([x, x]) for x in (piece, place, text))
    band = np.concatenate([band, band - 1])
    order = np.lexsort((place, text, band, piece))
    piece, place, text, band = piece[order], place[order], text[order], band[order]
    new = np.ones(len(piece), np.bool_)
    new[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1]) | (band[1:] != band[:-1])
    # A place counts once for a band, on however many of its diagonals its q-gram lies.
    once = new.copy()
    once[1:] |= place[1:] != place[:-1]
    piece, place, text, band, new = piece[once], place[once], text[once], band[once], new[once]
    group = np.cumsum(new) - 1
    # From one hit to the one that completes the bound, if a window holds both.
    last = np.arange(len(piece)) + index.bounds[piece] - 1
    end = np.minimum(last, max(0, len(piece) - 1))
    reach = index.widths[piece] - Q
    full = np.flatnonzero((last == end) & (group[end] == group) & (place[end] - place <= reach))
    windows = np.diff(index.offsets)[piece] - index.widths[piece] + 1
    low = np.maximum(place[end] - reach, 0)[full]
    high = np.minimum(place, windows - 1)[full]
    if len(full):  # each window once
        again = group[full[1:]] == group[full[:-1]]
        low[1:] = np.where(again, np.maximum(low[1:], high[:-1] + 1), low[1:])
    n = np.maximum(high - low + 1, 0)
    return np.repeat(piece[full], n), _ranges(low, n), np.repeat(band[full], n), np.repeat(text[full], n)


def _alike(
    index: Index, begins: np.ndarray, m: int, first: np.ndarray, text: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of windows equal in characters, band and text one that stands for them; for each window which."""
    h = np.zeros(len(begins), np.uint64)
    for j in range(m):
        h = h * _BASE + index.codes[begins + j]
    order = np.lexsort((h, first, text))
    new = np.ones(len(order), np.bool_)
    new[1:] = np.any([np.diff(x[order]) != 0 for x in (h, first, text)], axis=0)
    which = np.zeros(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    stands = order[new]
    model = begins[stands[which]]
    same = np.ones(len(begins), np.bool_)
    for j in range(m):
        same &= index.codes[begins + j] == index.codes[model + j]
    other = np.flatnonzero(~same)  # of the same hash by chance
    which[other] = len(stands) + np.arange(len(other))
    return np.concatenate([stands, other]), which


def _align(
    patterns: np.ndarray, seq: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits, start and end of each pattern within its band of ``width`` diagonals.

    ``first`` is the band's first diagonal; only places from ``low`` up to ``high`` count.
    """
    n, m = patterns.shape
    patterns = np.ascontiguousarray(patterns.T)  # a column per pattern
    at = first + np.arange(m + width - 1)[:, None]
    text = seq[np.clip(at, 0, len(seq) - 1)]
    outside = (at < low) | (at >= high)
    text[outside] = 0  # equals nothing in an item

    edits = np.zeros(n, np.int32)
    diagonal = np.full(n, -1)
    for d in reversed(range(width)):  # of equal stretches the first
        diagonal[(text[d : d + m] == patterns).all(axis=0)] = d
    start, end = first + diagonal, first + m + diagonal
    rest = np.flatnonzero(diagonal < 0)
    if len(rest):
        far = outside[:, rest] if outside[:, rest].any() else None
        row = first[rest] + np.arange(width)[:, None]
        barred = (row < low[rest]) | (row > high[rest])
        edits[rest], begun, ended = _edits(patterns[:, rest], text[:, rest], barred, far)
        start[rest], end[rest] = first[rest] + begun, first[rest] + m + ended
    return edits, start, end


def _edits(
    patterns: np.ndarray, text: np.ndarray, barred: np.ndarray, outside: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each column's pattern in a band of its text, first and last diagonal.

    No match begins on a ``barred`` diagonal or uses a character ``outside``. A cell is one number:
    edits less its diagonal, from high to low bits, then what wins among equals, then the first diagonal.
    """
    m, width = len(patterns), len(barred)
    bits = width.bit_length()
    column = np.arange(width, dtype=np.int32)[:, None]
    one = np.int32(1 << 2 * bits + 1)  # edit
    own = (width - column) << np.int32(bits + 1)  # of equal cells the later diagonal's
    skipped = np.int32(1 << bits)  # after those that are not
    clear = -one | np.int32(skipped - 1)
    far = np.int32((m + 2 * width) * one)  # more edits than any cell's
    cell = column - column * one + np.where(barred, far, np.int32(0))
    for i in range(m):
        take = (text[i : i + width] != patterns[i]) * one
        take += cell
        if outside is not None:
            take[outside[i : i + width]] = far
        skip = cell[1:] + (2 * one + skipped)  # an edit, and a diagonal less
        np.minimum(take[:-1], skip, out=take[:-1])
        take |= own
        for c in range(1, width):  # a character of the text that the pattern lacks
            before = take[c - 1] if outside is None else np.where(outside[i + c], far, take[c - 1])
            np.minimum(take[c], before, out=take[c])
        take &= clear
        cell = take
    cell += column * one
    edits = cell >> np.int32(2 * bits + 1)
    last = edits.argmin(axis=0)
    best = np.arange(len(last))
    return edits[last, best], cell[last, best] & (skipped - 1), last


def _find(index: Index, texts: list[str]) -> list[dict]:
    """Of each text, piece -> (edits, start, end) of its best window, and windows found."""
    found: list[dict] = [{} for _ in texts]
    joined = _BREAK.join(t.replace(_BREAK, " ") for t in texts)
    seq, places = folded(joined, index.table)
    breaks = np.flatnonzero(seq == ord(_BREAK))
    begin = np.concatenate([[0], breaks + 1])
    stop = np.append(breaks, len(seq))
    offset = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    if len(seq) < Q:
        return found
    rows = []
    for postings in _postings(index, seq):
        piece, at, band, text = _candidates(index, *postings, breaks)
        for m in np.unique(index.widths[piece]):
            own = np.flatnonzero(index.widths[piece] == m)
            k = edit_budget(int(m))
            begins = index.offsets[piece[own]] + at[own]
            first = band[own] * (k + 1) + at[own]
            stands, which = _alike(index, begins, int(m), first, text[own])
            aligned = [
                _align(
                    index.codes[begins[part][:, None] + np.arange(m)],
                    seq,
                    first[part],
                    begin[text[own[part]]],
                    stop[text[own[part]]],
                    2 * (k + 1),
                )
                for part in np.array_split(stands, math.ceil(len(stands) / ALIGNED_AT_ONCE))
            ]
            edits, start, end = (np.concatenate(x)[which] for x in zip(*aligned))
            good = edits <= k
            hit = own[good]
            rows.append((text[hit], piece[hit], at[hit], edits[good], start[good], end[good]))
    if not rows:
        return found
    text, piece, at, edits, start, end = (np.concatenate(x) for x in zip(*rows))
    order = np.lexsort((end, start, edits, piece, text))
    text, piece, at, edits, start, end = (x[order] for x in (text, piece, at, edits, start, end))
    groups = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(piece, prepend=-1) != 0))
    for i, j in zip(groups, np.append(groups[1:], len(text))):
        t = int(text[i])
        place = (int(edits[i]), int(places[start[i]] - offset[t]), int(places[end[i] - 1] - offset[t] + 1))
        found[t][int(piece[i])] = (place, len(np.unique(at[i:j])))
    return found


def scan(index: Index, texts: list[str | None]) -> list[list[tuple]]:
    """Of each text, the items it holds: item, start, end, edits, windows found.

    The span and the edits are those of the item's best window.
    """
    out: list[list[tuple]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and size < CHARS_AT_ONCE:
            if texts[at]:
                part.append(at)
                size += len(texts[at])
            at += 1
        if not part:
            continue
        own = [texts[i] for i in part]
        for i, found in zip(part, _find(index, own) if index.items else [{}] * len(own)):
            by_item: dict = short_leaks(index, texts[i]) if index.short else {}
            for p, (place, windows) in found.items():
                for item in index.items[p]:
                    best, n = by_item.get(item, (place, 0))
                    by_item[item] = (min(best, place), n + windows)
            out[i] = _in_order((item, p[1], p[2], p[0], n) for item, (p, n) in by_item.items())
    return out


def _in_order(rows: Iterable[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda x: x[1:] + (str(x[0]),))


def _merged(parts: Iterable[list[tuple]]) -> list[tuple]:
    """What several blocks found in one text: an item's best place, and all its windows."""
    by_item: dict = {}
    for item, start, end, edits, n in itertools.chain.from_iterable(parts):
        place = (edits, start, end)
        best, m = by_item.get(item, (place, 0))
        by_item[item] = (min(best, place), m + n)
    return _in_order((item, p[1], p[2], p[0], n) for item, (p, n) in by_item.items())


def indexes(
    benchmark: DataFrame, item: str = "item_id", text: str = "text", short_items: bool = True
) -> tuple[list[Broadcast], T.DataType]:
    """Indexes over all items, each of about WINDOWS_AT_ONCE pieces, and the items' type.

    ``short_items=False`` leaves out those that any text may hold by chance.
    """
    windows = benchmark_windows(benchmark, item, text)
    if not short_items:
        windows = windows.filter("not short")
    blocks = max(1, math.ceil(windows.count() / WINDOWS_AT_ONCE))
    share = windows.sparkSession.sparkContext.broadcast
    out = []
    for b in range(blocks):
        rows = windows.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b).collect()
        if rows:
            out.append(share(vars(build_index([tuple(r) for r in rows]))))
    return out, windows.schema["item"].dataType


def leaks(blocks: tuple[list[Broadcast], T.DataType], text: Column) -> Column:
    """An array of the leaked items of each text: item_id, start, end, edits, windows."""
    shared, item_type = blocks
    one = T.StructType(
        [T.StructField("item_id", item_type)]
        + [T.StructField(c, T.IntegerType()) for c in ("start", "end", "edits", "windows")]
    )
    kind = T.ArrayType(one)

    if not shared:
        return F.array().cast(kind)

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = [f.name for f in one.fields]
        blocks = [Index(**block.value) for block in shared]
        for texts in trimmed(batches):
            rows = texts.tolist()
            found = map(_merged, zip(*[scan(index, rows) for index in blocks]))
            yield pd.Series([[dict(zip(names, x)) for x in row] for row in found], dtype=object)

    # Else Spark also runs it in a filter that it makes of a later inline.
    return run.asNondeterministic()(text)


def leaked_rows(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text and item found in it."""
    found = leaks(indexes(benchmark), F.col("text"))
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("text")).select(key, found.alias("leaks"))
    return rows.select(key, F.inline("leaks"))
