"""SentencePiece encoding by suffix-array matching, and decoding.

A batch's texts are cut where no piece can reach across: in front of each space mark and
around line breaks. Its distinct words are written one after the other and indexed by a
suffix array (sorted by as many characters as the longest piece has). Every piece of
the vocabulary is searched for in it, which gives a range of occurrences; each occurrence
is an edge from where the piece begins to where it ends. Edges are sorted by the place
where they end and relaxed in that order.

For a model of merges (BPE) relaxation is exact: the encoding of each prefix of a word
ends in one certain piece, namely the edge whose piece keeps its border with the piece
that ends where the edge begins. Two pieces keep their border if undoing their merges,
latest first, never shows a merge across the border that would have come earlier. So
ids are those of the sentencepiece library, whatever the text.

Words of a batch are relaxed together, all edges of one depth and length in a step. A word of
``LONG_WORD`` characters or more would take a step for each of its places, with few edges in
it; its edges are relaxed one by one instead, in windows of its text that take in what reaches
over their end, so that time grows with the word's length and memory by some bytes a character.

Characters that are no piece become their UTF-8 bytes. Runs of spaces are merged last,
from the left. The model has to be of this kind: identity normalization, a space mark
put in front, pieces with the mark only as first character or of nothing else.

Defined results: null and empty texts have no ids and decode to the empty text. Each
row is encoded on its own; other columns are not looked at. A space mark (U+2581) in a
text counts as a space, as in the library.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.memory import trimmed

SPACE = "▁"
LINE = "\n"
CUT = "\ud800"  # stands in no text
LONGEST = 16  # characters of a piece
CHARS_AT_ONCE = 250_000  # of text, though always one whole text
TEXTS_AT_ONCE = 1000
WORD_CHARS_AT_ONCE = 100_000  # of distinct words in a suffix array
WORDS_KEPT = 250_000  # in a task, before its table of known words starts anew ...
IDS_KEPT = 4_000_000  # ... or before their ids take more than this
LONG_WORD = 1000  # characters; such a word is relaxed edge by edge, in windows of its text
BORDERS_KEPT = 1_000_000  # pairs of pieces in long words whose border is known
_NEVER = np.int64(1) << 40


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]  # by id
    surface: list[bytes]  # what an id stands for
    is_byte: np.ndarray
    byte_ids: list[int]  # byte -> id
    alphabet: dict[str, int]  # character -> code from 1 on
    char_ids: np.ndarray  # code -> id
    codes: np.ndarray  # one row per searched piece, LONGEST codes, filled up with 0
    ids: np.ndarray  # of the searched pieces
    length: np.ndarray  # id -> characters
    rank: np.ndarray  # id -> place of its last merge, -1 if it is a character
    left: np.ndarray  # id -> its last merge's parts
    right: np.ndarray
    pairs: np.ndarray  # sorted left * len(pieces) + right that merge ...
    pair_rank: np.ndarray  # ... and when
    runs: dict[int, list[int]]  # spaces in a row -> ids, up to LONGEST


def load(model_file: str) -> Vocabulary:
    """Read the vocabulary of a merge model; nothing of it is trained or changed."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    if model.normalize("  a  ﬁ") != SPACE * 3 + "a" + SPACE * 2 + "ﬁ":
        raise ValueError("the model normalizes texts")
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    is_byte = np.array([model.is_byte(i) for i in range(n)])
    plain = [
        i
        for i in range(n)
        if not (is_byte[i] or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    by_text = {pieces[i]: i for i in plain}
    runs_of = {p for p in by_text if len(p) > 1 and not p.strip(SPACE)}
    words = {p: i for p, i in by_text.items() if p not in runs_of}
    if any(SPACE in p[1:] or LINE in p or len(p) > LONGEST for p in words):
        raise ValueError("pieces reach over a space or a line")
    if any(c not in words for p in words for c in p):
        raise ValueError("a piece has a character that is no piece")
    merged = sorted((i for p, i in words.items() if len(p) > 1), key=lambda i: (-model.get_score(i), i))
    if len({model.get_score(i) for i in merged}) != len(merged):
        raise ValueError("scores do not order the merges")
    rank = np.full(n, -1, np.int64)
    rank[merged] = np.arange(len(merged))
    order = {pieces[i]: int(rank[i]) for i in merged}
    left, right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    kept = [i for p, i in words.items() if len(p) == 1]
    for i in merged:
        parts = _last_merge(pieces[i], order)
        if parts:  # else no text is ever merged to this piece
            left[i], right[i] = words[parts[0]], words[parts[1]]
            kept.append(i)
    reached = set(kept)
    pairs = {}
    for p, i in words.items():
        for k in range(1, len(p)):
            a, b = words.get(p[:k]), words.get(p[k:])
            if a in reached and b in reached:
                pairs[a * n + b] = int(rank[i])
    chars = sorted(p for p in words if len(p) == 1)
    alphabet = {c: k for k, c in enumerate(chars, 1)}
    codes = np.zeros((len(kept), LONGEST), np.int64)
    for row, i in enumerate(kept):
        codes[row, : len(pieces[i])] = [alphabet[c] for c in pieces[i]]
    by_codes = np.lexsort(codes.T[::-1])  # neighbours are searched for near each other
    byte_ids = [0] * 256
    surface = [b""] * n
    for i in range(n):
        if is_byte[i]:
            byte_ids[int(pieces[i][3:5], 16)] = i
            surface[i] = bytes([int(pieces[i][3:5], 16)])
        elif not model.is_control(i):
            surface[i] = pieces[i].replace(SPACE, " ").encode()
    keys = np.array(sorted(pairs), np.int64)
    return Vocabulary(
        pieces,
        surface,
        is_byte,
        byte_ids,
        alphabet,
        np.array([0] + [words[c] for c in chars], np.int64),
        codes[by_codes],
        np.array(kept, np.int64)[by_codes],
        np.array([len(p) for p in pieces], np.int64),
        rank,
        left,
        right,
        keys,
        np.array([pairs[k] for k in keys.tolist()], np.int64),
        {m: [by_text[p] for p in _space_run(m, runs_of)] for m in range(1, 4 * LONGEST)},
    )


def _last_merge(piece: str, order: dict[str, int]) -> tuple[str, str] | None:
    """The parts that merge last into ``piece``, if its characters merge into it at all."""
    parts, last = list(piece), None
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda k: (order.get(parts[k] + parts[k + 1], _NEVER), k))
        if parts[best] + parts[best + 1] not in order:
            return None
        last = (parts[best], parts[best + 1])
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return last


def _space_run(m: int, runs: set[str]) -> list[str]:
    """How ``m`` space marks merge: always the leftmost pair that makes a piece."""
    parts = [SPACE] * m
    while True:
        k = next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in runs), None)
        if k is None:
            return parts
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, rank = np.unique(keys, return_inverse=True)
    return distinct, rank.astype(np.int64)


def _pack(codes: np.ndarray) -> np.ndarray:
    """Four codes of 16 bits as a number that sorts as they do."""
    out = codes[..., 0].astype(np.uint64)
    for j in range(1, 4):
        out = (out << np.uint64(16)) | codes[..., j].astype(np.uint64)
    return out


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[: len(x) - by] = x[by:]
    return out


def occurrences(v: Vocabulary, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and piece of every occurrence of every piece in coded text.

    The suffix array comes from ranks of 4, 8 and 16 characters; a piece's range from
    binary searches for its first 4, 8 and 16.
    """
    text = np.concatenate([text, np.zeros(LONGEST, np.int64)])
    packed = _pack(np.stack([_shifted(text, j) for j in range(4)], axis=-1))
    four, r4 = _ranks(packed)
    eight, r8 = _ranks((r4 << 32) | _shifted(r4, 4))
    sixteen = (r8 << 32) | _shifted(r8, 8)
    suffixes = np.argsort(sixteen)
    sorted16 = sixteen[suffixes]
    length = v.length[v.ids]

    def span4(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the fours that begin with the first n (0 to 4) of some codes."""
        low = _pack(codes)
        width = (np.uint64(16) * (4 - np.clip(n, 0, 4)).astype(np.uint64))
        high = low + np.where(n > 0, np.uint64(1) << np.minimum(width, np.uint64(48)), np.uint64(0))
        a = np.searchsorted(four, low)
        b = np.where(n > 0, np.searchsorted(four, high), len(four))
        return a, b

    def span8(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the eights that begin with the first n (0 to 8) of some codes."""
        a, b = span4(codes[:, :4], np.minimum(n, 4))
        c, d = span4(codes[:, 4:8], np.maximum(n - 4, 0))
        far = n > 4  # then the first four are one rank, a
        low = np.where(far, (a << 32) + c, a << 32)
        high = np.where(far, np.where(b > a, (a << 32) + d, (a << 32) + c), b << 32)
        return np.searchsorted(eight, low), np.where(n > 0, np.searchsorted(eight, high), len(eight))

    a, b = span8(v.codes[:, :8], np.minimum(length, 8))
    c, d = span8(v.codes[:, 8:], np.maximum(length - 8, 0))
    far = length > 8
    low = np.where(far, (a << 32) + c, a << 32)
    high = np.where(far, np.where(b > a, (a << 32) + d, low), b << 32)
    first, stop = np.searchsorted(sorted16, low), np.searchsorted(sorted16, high)
    n = stop - first
    at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return suffixes[at], np.repeat(v.ids, n)


def portions(texts: list[str | None]) -> Iterator[list[str]]:
    """Whole texts in order, some at a time, so that their words and ids take bounded memory."""
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= CHARS_AT_ONCE or len(part) >= TEXTS_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


class Encoder:
    """Encodes texts with a vocabulary, keeping what it learned about words and borders."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.slots = 1 << 20
        self.known = np.full(self.slots, -1, np.int64)  # pairs of pieces, by hash ...
        self.keeps = np.zeros(self.slots, bool)  # ... and whether they keep their border
        self.borders: dict[int, bool] = {}  # the same of pairs in long words, by key
        self.pair_rank: dict[int, int] = {}  # the vocabulary's pairs and parts, once a long word asks
        self.parts: list[tuple[int, int, int]] = []
        self._forget()

    def _forget(self) -> None:
        self.word_at: dict[str, int] = {"": 0}
        self.start = np.zeros(1 << 16, np.int64)  # of each word's ids in `flat`
        self.count = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0

    def border_kept(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b, side by side, stay apart when they are merged anew."""
        key = a * len(self.v.pieces) + b
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out = self.keeps[slot]
        new = np.flatnonzero(self.known[slot] != key)
        if len(new):
            out[new] = self._undo(a[new], b[new])
            self.known[slot[new]] = key[new]
            self.keeps[slot[new]] = out[new]
            # Two new pairs may meet in a slot: only the last one written may stay.
            lost = new[self.known[slot[new]] != key[new]]
            self.known[slot[lost]] = -1
        return out

    def _undo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        v, n = self.v, len(self.v.pieces)
        out = np.zeros(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _NEVER)
        while len(live):
            key = a * n + b
            at = np.minimum(np.searchsorted(v.pairs, key), len(v.pairs) - 1)
            merged = np.where(v.pairs[at] == key, v.pair_rank[at], _NEVER)
            crossed = merged < limit
            ra, rb = v.rank[a], v.rank[b]
            out[live[~crossed & (ra < 0) & (rb < 0)]] = True
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            of_a = ra > rb
            limit = np.where(of_a, ra, rb + 1)
            a, b = np.where(of_a, v.right[a], a), np.where(of_a, b, v.left[b])
        return out

    def _coded(self, chars: np.ndarray) -> np.ndarray:
        return np.array([self.v.alphabet.get(chr(c), 0) for c in chars.tolist()], np.int64)

    def _solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words, one after the other, and how many each has."""
        v, cut = self.v, np.array([len(w) for w in words])
        joined = "\x00".join(words) + "\x00"
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        seen, which = np.unique(chars, return_inverse=True)
        codes = self._coded(seen)[which]
        ends = np.cumsum(cut + 1) - 1
        codes[ends] = 0  # between words
        begins = ends - cut
        # last[p]: the piece that the encoding of a word up to place p ends in.
        last = np.full(len(codes) + 1, -1, np.int64)
        start, piece = occurrences(v, codes)
        lengths = v.length[piece]
        fresh = np.zeros(len(codes) + 1, bool)
        fresh[begins] = True
        # A character that is no piece stands alone, and what follows begins anew.
        alone = np.flatnonzero(codes == 0)
        fresh[alone + 1] = True
        fresh[alone] = True
        base = np.zeros(len(codes) + 1, np.int64)  # of each place, where its stretch begins
        marks = np.flatnonzero(fresh)
        base[marks] = marks
        base = np.maximum.accumulate(base)
        depth = start + lengths - base[start]
        # At most LONG_WORD * (LONGEST + 1), which numpy sorts by counting.
        turn = (depth * (LONGEST + 1) + (LONGEST - lengths)).astype(np.uint16)
        order = np.argsort(turn, kind="stable")
        start, piece, lengths, turn = start[order], piece[order], lengths[order], turn[order]
        first = np.flatnonzero(np.diff(turn.astype(np.int32), prepend=-1))
        for lo, hi in zip(first, np.append(first[1:], len(turn))):
            s, p = start[lo:hi], piece[lo:hi]
            end = s + lengths[lo]
            todo = last[end] < 0
            s, p, end = s[todo], p[todo], end[todo]
            good = fresh[s]
            rest = np.flatnonzero(~good)
            if len(rest):
                good = good.copy()
                good[rest] = self.border_kept(last[s[rest]], p[rest])
            last[end[good]] = p[good]
        # Follow the pieces back from each word's end.
        out_word, out_place, out_id = [], [], []
        word, at = np.arange(len(words)), ends.copy()
        while True:
            on = at > begins[word]
            word, at = word[on], at[on]
            if not len(word):
                break
            unknown = codes[at - 1] == 0
            ids = np.where(unknown, -1 - chars[at - 1].astype(np.int64), last[at])
            at = at - np.where(unknown, 1, v.length[np.maximum(last[at], 0)])
            out_word.append(word)
            out_place.append(at)
            out_id.append(ids)
        if not out_word:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, place, ids = (np.concatenate(x) for x in (out_word, out_place, out_id))
        order = np.argsort(place, kind="stable")
        word, ids = word[order], ids[order]
        spelled = np.flatnonzero(ids < 0)
        if len(spelled):
            as_bytes = [[v.byte_ids[x] for x in chr(-1 - c).encode("utf-8", "surrogatepass")] for c in ids[spelled].tolist()]
            times = np.ones(len(ids), np.int64)
            times[spelled] = [len(x) for x in as_bytes]
            at = np.concatenate([[0], np.cumsum(times)[:-1]])
            word, ids = np.repeat(word, times), np.repeat(ids, times)
            for p, x in zip(at[spelled], as_bytes):
                ids[p : p + len(x)] = x
        return ids.astype(np.int32), np.bincount(word, minlength=len(words))

    def _stays(self, a: int, b: int) -> bool:
        """``border_kept`` of one pair."""
        key = a * len(self.v.pieces) + b
        out = self.borders.get(key)
        if out is None:
            if len(self.borders) >= BORDERS_KEPT:
                self.borders.clear()
            out = self.borders[key] = self._undo_pair(a, b)
        return out

    def _undo_pair(self, a: int, b: int) -> bool:
        if not self.pair_rank:
            v = self.v
            self.pair_rank = dict(zip(v.pairs.tolist(), v.pair_rank.tolist()))
            self.parts = list(zip(v.rank.tolist(), v.left.tolist(), v.right.tolist()))
        n, limit = len(self.v.pieces), int(_NEVER)
        while True:
            if self.pair_rank.get(a * n + b, limit) < limit:
                return False
            (ra, _, right), (rb, left, _) = self.parts[a], self.parts[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, right
            else:
                limit, b = rb + 1, left

    def _solve_long(self, word: str) -> np.ndarray:
        """Ids of one long word."""
        v, n = self.v, len(word)
        chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        seen = np.unique(chars)
        coded = self._coded(seen)
        # last[p]: as in `_solve`; -1 where a stretch begins.
        last = array("i", [-1]) * (n + 1)
        for at in range(0, n, WORD_CHARS_AT_ONCE):
            stop = min(n, at + WORD_CHARS_AT_ONCE)
            window = coded[np.searchsorted(seen, chars[at : stop + LONGEST])]
            start, piece = occurrences(v, window)
            own = start < stop - at
            start, piece = start[own], piece[own]
            end = start + v.length[piece]
            order = np.argsort(end * n + start)  # the longest first
            edges = zip((start[order] + at).tolist(), piece[order].tolist(), (end[order] + at).tolist())
            for s, p, e in edges:
                if last[e] < 0 and (last[s] < 0 or self._stays(last[s], p)):
                    last[e] = p
        out, at = array("i"), n  # from the word's end back
        length = v.length.tolist()
        while at:
            p = last[at]
            if p < 0:  # no piece ends with a character that is none
                out.extend([v.byte_ids[x] for x in reversed(word[at - 1].encode("utf-8", "surrogatepass"))])
                at -= 1
            else:
                out.append(p)
                at -= length[p]
        return np.array(out, np.int32)[::-1]

    def _learn(self, words: list[str]) -> None:
        self._keep(words, *self._solve(words))

    def _learn_long(self, word: str) -> None:
        ids = self._solve_long(word)
        self._keep([word], ids, np.array([len(ids)]))

    def _keep(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        base = len(self.word_at)
        need = base + len(words)
        if need > len(self.start):
            size = max(need, 2 * len(self.start))
            self.start, self.count = (np.resize(x, size) for x in (self.start, self.count))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, max(self.used + len(ids), 2 * len(self.flat)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[base:need] = self.used + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.count[base:need] = counts
        self.used += len(ids)
        self.word_at.update(zip(words, range(base, need)))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [ids for part in portions(texts) for ids in self._encode(part)]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        words: list[str] = []
        counts = []
        spaced = []
        for text in texts:
            if text:
                marked = SPACE + text.replace(" ", SPACE)
                own = marked.replace(SPACE, CUT + SPACE).replace(LINE, CUT + LINE + CUT).split(CUT)
                words += own
                counts.append(len(own))
                spaced.append(SPACE * 2 in marked or SPACE + LINE in marked or marked[-1] == SPACE)
            else:
                counts.append(0)
                spaced.append(False)
        if len(self.word_at) > WORDS_KEPT or self.used > IDS_KEPT:
            self._forget()
        new, size = [], 0
        for w in dict.fromkeys(words):
            if w in self.word_at:
                continue
            if len(w) >= LONG_WORD:
                self._learn_long(w)
            else:
                new.append(w)
                size += len(w) + 1
                if size >= WORD_CHARS_AT_ONCE:
                    self._learn(new)
                    new, size = [], 0
        if new:
            self._learn(new)
        at = np.fromiter(map(self.word_at.__getitem__, words), np.int64, len(words))
        n = self.count[at]
        before = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.start[at] - before[:-1], n) + np.arange(before[-1])]
        cuts = before[np.cumsum(counts)] if len(counts) else []
        out = np.split(ids, cuts[:-1])
        space = int(self.v.char_ids[self.v.alphabet[SPACE]]) if SPACE in self.v.alphabet else -1
        for i, s in enumerate(spaced):
            if s:
                out[i] = self._merge_spaces(out[i], space)
        return out

    def _merge_spaces(self, ids: np.ndarray, space: int) -> np.ndarray:
        """Runs of single space marks merge last, when nothing else can take them."""
        is_space = np.concatenate([[0], (ids == space).astype(np.int8), [0]])
        edge = np.diff(is_space)
        first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        parts, at = [], 0
        for a, b in zip(first, stop):
            if b - a > 1:
                parts += [ids[at:a], np.array(self._run(int(b - a)), np.int32)]
                at = b
        return np.concatenate([*parts, ids[at:]]) if parts else ids

    def _run(self, m: int) -> list[int]:
        runs = self.v.runs
        if m in runs:
            return runs[m]
        longest = runs[2 * LONGEST][0]  # a long run begins with as many of these as fit
        width = int(self.v.length[longest])
        whole = (m - LONGEST) // width
        return [longest] * whole + runs[m - whole * width]


def decode(v: Vocabulary, ids: list[int]) -> str:
    """The text that ids stand for, without the space put in front."""
    text = b"".join([v.surface[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def shared(spark: SparkSession, model_file: str) -> Broadcast:
    """The vocabulary for use in tasks; its size is the model's, whatever the data."""
    return spark.sparkContext.broadcast(vars(load(model_file)))


def encoded(vocabulary: Broadcast, text: Column) -> Column:
    """An array of the ids of each whole text."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(Vocabulary(**vocabulary.value))
        for texts in trimmed(batches):
            for part in portions(texts.tolist()):
                yield pd.Series(encoder.encode(part), dtype=object)

    return run(text)


def decoded(vocabulary: Broadcast, ids: Column) -> Column:
    """The text of each array of ids."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = Vocabulary(**vocabulary.value)
        for rows in trimmed(batches):
            yield pd.Series(["" if x is None else decode(v, list(x)) for x in rows], dtype=object)

    return run(ids)


def round_trip(vocabulary: Broadcast, text: Column) -> Column:
    """A struct of the ids, and whether decoding them gives the text again."""

    @F.pandas_udf("ids array<int>, same boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = Vocabulary(**vocabulary.value)
        encoder = Encoder(v)
        for texts in trimmed(batches):
            for part in portions(texts.tolist()):
                rows = encoder.encode(part)
                same = [decode(v, x.tolist()) == t.replace(SPACE, " ") for x, t in zip(rows, part)]
                yield pd.DataFrame({"ids": rows, "same": same})

    return run(text)
