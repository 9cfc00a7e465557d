"""Evaluation texts leaking into training text.

Both sides are reduced to letters and digits. Windows of the corpus, laid without gaps, and windows of the items at
every position are embedded by the CGK random walk, which turns edit distance into Hamming distance. Positions of the
embedding are sampled again and again; each sample is the key of one hash table, and there are as many tables as the
recall aimed at needs for windows some edits apart. Every collision is verified by the edit distance of the windows, and
every pair of document and item by what the verified windows grow to: the exact common passages, and the edit distance
of the item to the item-sized stretch of the document around them.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest common passage that counts, by the item's language, and the share of an item that passages must cover.
PASSAGE = {"ja": 25, "en": 45}
SHARE = 0.4
#: An item is found as a whole, however altered, if at most this share of it must be edited.
EDITED = 0.1
#: Characters of items that one broadcast index may hold; more items make further indexes.
BLOCK_CHARS = 2_000_000
#: Steps of the walk for each character, positions sampled for a key, keys sampled from one walk, the recall aimed at and
#: the edits within a window for which it is aimed at. Shorter windows than SHORT must be equal.
STRETCH, SAMPLED, PER_WALK, RECALL, EDITS, SHORT = 3, 12, 4, 0.95, 1, 10
#: A window that more items than this hold counts only for items that have something else in the document, or need nothing else.
HOT = 16
#: Characters of documents worked on at a time.
CHUNK_CHARS = 600_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _kept() -> np.ndarray:
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def reduced(text: str | None) -> np.ndarray:
    """Code points of the letters and digits of `text`, case and width folded."""
    if not text:
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(unicodedata.normalize("NFKC", text).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes[_kept()[codes]]


@lru_cache(64)
def tables_for(window: int, recall: float = RECALL, edits: int = EDITS) -> int:
    """Hash tables so that windows within `edits` edits collide in one of them with probability `recall`, by trying: random
    windows, edited at random, until the share that met is there."""
    if not edits or window < SHORT:
        return 1
    random = np.random.default_rng(window)
    one = random.integers(100, 164, (1500, window + edits)).astype(np.uint32)
    other = one.copy()
    for row in other:
        for _ in range(edits):
            at, kind = random.integers(window), random.integers(3)
            if kind == 0:
                row[at] = 99
            elif kind == 1:
                row[at + 1 :] = row[at:-1].copy()
                row[at] = 99
            else:
                row[at:-1] = row[at + 1 :].copy()
    a, b, met = one[:, :window], other[:, :window], np.zeros(len(one), bool)
    for walk in range(100):
        for t, (x, y) in enumerate(zip(_walk(a, walk, range(PER_WALK)), _walk(b, walk, range(PER_WALK)))):
            met |= x == y
            if met.mean() >= recall:
                return walk * PER_WALK + t + 1
    raise ValueError(f"windows of {window} are too short for {edits} edits")


def _walk(windows: np.ndarray, walk: int, tables: range, seed: int = 1) -> np.ndarray:
    """Keys of some samplings of one walk. A sign moves the walk on or not by the bit that its own random word has for the
    step; behind the window it stands still."""
    n, width = windows.shape
    steps, keys = STRETCH * width, np.zeros((len(tables), n), np.uint64)
    at, word = (np.arange(n) * (width + 1)).astype(np.int64), None
    places = [set(np.random.default_rng([seed, width, walk, t]).choice(steps, min(SAMPLED, steps), replace=False).tolist()) for t in tables]
    for step in range(max(map(max, places)) + 1):
        if step % 64 == 0:
            word = np.zeros((n, width + 1), np.uint64)
            word[:, :width] = windows
            word[:, :width] += np.random.default_rng([seed, walk, step]).integers(1, 1 << 62, dtype=np.uint64)
            word[:, :width] *= _MIX
            word[:, :width] ^= word[:, :width] >> np.uint64(31)
            word[:, :width] *= _MIX
            word[:, :width] ^= word[:, :width] >> np.uint64(29)
            word = word.ravel()
        symbol = word[at]
        for key, sampled in zip(keys, places):
            if step in sampled:
                key ^= symbol
                key *= _MIX
                key ^= key >> np.uint64(29)
        at += ((symbol >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
    return keys


def walk_keys(windows: np.ndarray, tables: int, seed: int = 1) -> np.ndarray:
    """One key for each table and window (row): sampled positions of the window's CGK embedding, hashed. PER_WALK tables
    sample the same embedding."""
    return np.concatenate([_walk(windows, first // PER_WALK, range(min(PER_WALK, tables - first)), seed) for first in range(0, tables, PER_WALK)])


@dataclass
class Index:
    """Items of one passage length: their characters with a mark after each, and the sorted keys of their different
    windows. `first[k]` is a place of window k, and its places are places[bounds[k] : bounds[k + 1]]."""

    passage: int
    edits: int
    ids: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray
    places: np.ndarray
    bounds: np.ndarray
    first: np.ndarray
    hot: np.ndarray
    alone: np.ndarray
    keys: list[np.ndarray]
    windows: list[np.ndarray]

    @classmethod
    def of(cls, items: list[tuple[int, np.ndarray]], passage: int, share: float = SHARE, edits: int = EDITS, hot: int = HOT) -> Index:
        window = window_of(passage)
        lengths = np.array([len(x) for _, x in items], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1].astype(np.int64)
        codes = np.concatenate([np.append(x, np.uint32(1)) for _, x in items] + [np.ones(window, np.uint32)])
        at = np.concatenate([np.zeros(0, np.int64)] + [s + np.arange(max(0, n - window + 1)) for s, n in zip(starts, lengths)]).astype(np.int64)
        views = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, window)[at])
        _, first, which = np.unique(views.view(f"V{4 * window}").ravel(), return_index=True, return_inverse=True)
        order = np.argsort(which, kind="stable")
        bounds = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(first)))]).astype(np.int64)
        item = np.searchsorted(starts, at, "right") - 1
        holders = np.bincount(np.unique(np.stack([which, item]), axis=1)[0], minlength=len(first)) if len(at) else np.zeros(0, int)
        # at most what lies in hot windows and less than a window around them can be common without another window
        near = np.zeros(len(codes) + 1, np.int64)
        for place in at[(holders > hot)[which]] if len(at) else []:
            i = np.searchsorted(starts, place, "right") - 1
            near[max(starts[i], place - window + 1)] += 1
            near[min(starts[i] + lengths[i], place + 2 * window - 1)] -= 1
        covered = np.concatenate([[0], np.cumsum(np.cumsum(near) > 0)])
        alone = covered[starts + lengths] - covered[starts] >= share * lengths
        keys, windows = [], []
        for k in walk_keys(views[first], tables_for(window, RECALL, edits)) if len(at) else []:
            by = np.argsort(k, kind="stable")
            keys.append(k[by])
            windows.append(by)
        return cls(passage, edits if window >= SHORT else 0, np.array([i for i, _ in items], np.int64), starts, lengths, codes, at[order], bounds, at[first], holders > hot, alone, keys, windows)

    @cached_property
    def filters(self) -> list[np.ndarray]:
        """For each table which low bits of keys occur."""
        out = []
        for k in self.keys:
            seen = np.zeros(1 << max(10, (16 * len(k) - 1).bit_length()), bool)
            seen[(k & np.uint64(len(seen) - 1)).astype(np.int64)] = True
            out.append(seen)
        return out

    @cached_property
    def seen(self) -> dict[int, tuple[np.ndarray, dict[int, int]]]:
        return {}

    def shape(self, item: int) -> tuple[np.ndarray, dict[int, int]]:
        """How often pairs of neighbours occur in an item, and at which places its characters do, as bits."""
        if item not in self.seen:
            x, bits = self.codes[self.starts[item] : self.starts[item] + self.lengths[item]], {}
            for i, c in enumerate(x.tolist()):
                bits[c] = bits.get(c, 0) | 1 << i
            self.seen[item] = (_pairs(x), bits)
        return self.seen[item]


def _pairs(codes: np.ndarray) -> np.ndarray:
    """Counts of pairs of neighbours, by hash. One edit takes away at most two of them."""
    return np.bincount((codes[:-1] * np.uint32(31) + codes[1:]) & np.uint32(1023), minlength=1024)


def window_of(passage: int) -> int:
    """Of windows of half a passage, laid without gaps, every passage holds a whole one, wherever it begins."""
    return (passage + 1) // 2


def _within(doc: np.ndarray, at: np.ndarray, item: np.ndarray, there: np.ndarray, width: int, edits: int) -> np.ndarray:
    """Edit distance of each item window and the nearest stretch of the document that begins at `at`; edits + 1 if above."""
    band, out = 2 * edits + 1, edits + 1
    row = np.full((band + 2, len(at)), out, np.int16)
    for k in range(edits, band):
        row[k + 1] = k - edits
    for i in range(1, width + 1):
        sign, now = item[there + i - 1], np.full_like(row, out)
        for k in range(band):
            j = i + k - edits
            if j == 0:
                now[k + 1] = min(i, out)
            elif j > 0:
                differ = doc[np.minimum(at + j - 1, len(doc) - 1)] != sign
                now[k + 1] = np.minimum(np.minimum(row[k + 1] + differ, np.minimum(row[k + 2], now[k]) + 1), out)
        row = now
    return row[1:-1].min(axis=0)


def infix_distance(bits: dict[int, int], length: int, text: list[int]) -> int:
    """Edit distance of a pattern, given as places of its characters, and the nearest stretch of `text` (Myers, one row of
    bits for the whole pattern)."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score, best = full, 0, length, length
    for c in text:
        equal = bits.get(c, 0)
        zero = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | ~(zero | plus) & full, plus & zero
        score += bool(up & top) - bool(down & top)
        best = min(best, score)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(zero | up) & full, zero & up
    return best


def _grown(codes: np.ndarray, at: np.ndarray, other: np.ndarray, there: np.ndarray, step: int) -> np.ndarray:
    """How far both sides stay equal beyond at and there, in the direction of step."""
    far, open_ = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(open_):
        a, b = at[open_] + step * (far[open_] + 1), there[open_] + step * (far[open_] + 1)
        ok = (a >= 0) & (b >= 0) & (a < len(codes)) & (b < len(other))
        open_, a, b = open_[ok], a[ok], b[ok]
        same = codes[a] == other[b]
        open_ = open_[same]
        far[open_] += 1
    return far


@dataclass
class Corpus:
    """Some documents: their characters with a mark after each, and the keys of their windows of one width."""

    codes: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    at: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, docs: list[np.ndarray], window: int, tables: int) -> Corpus:
        codes = np.concatenate([np.append(x, np.uint32(0)) for x in docs] + [np.zeros(window, np.uint32)])
        lengths = np.array([len(x) for x in docs], np.int64)
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1].astype(np.int64)
        n = lengths // window
        at = np.repeat(begins, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * window
        keys = np.zeros((tables, len(at)), np.uint64)
        for lo in range(0, len(at), 8192):  # what fits into the processor's cache
            keys[:, lo : lo + 8192] = walk_keys(np.lib.stride_tricks.sliding_window_view(codes, window)[at[lo : lo + 8192]], tables)
        return cls(codes, begins, lengths, at, keys)


def _hits(corpus: Corpus, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Places in the corpus and windows of the index that met in some table and are within the edits."""
    met, n = [np.zeros(0, np.int64)], len(index.first)
    for k, sorted_keys, windows, seen in zip(corpus.keys, index.keys, index.windows, index.filters):
        maybe = np.flatnonzero(seen[(k & np.uint64(len(seen) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(sorted_keys, k[maybe], "left"), np.searchsorted(sorted_keys, k[maybe], "right")
        many = hi - lo
        which = np.repeat(maybe, many)
        place = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        met.append(corpus.at[which] * n + windows[place])
    a, w = np.divmod(np.unique(np.concatenate(met)), n)
    near = _within(corpus.codes, a, index.codes, index.first[w], window_of(index.passage), index.edits) <= index.edits
    return a[near], w[near]


def _unfolded(a: np.ndarray, w: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    many = index.bounds[w + 1] - index.bounds[w]
    place = np.repeat(index.bounds[w], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(a, many), index.places[place]


def _search(corpus: Corpus, index: Index, share: float, edited: float) -> list[tuple[int, int, float, float | None]]:
    """(place of the document, item id, share of the item in exact common passages, share left by edits or None)."""
    if not len(corpus.at) or not index.keys:
        return []
    a, w = _hits(corpus, index)
    if not len(a):
        return []
    of = lambda x: np.searchsorted(corpus.begins, x, "right") - 1
    item_of = lambda x: np.searchsorted(index.starts, x, "right") - 1
    hot = index.hot[w]
    at, there = _unfolded(a[~hot], w[~hot], index)
    if hot.any():
        known: dict[int, set[int]] = {}
        for d, i in zip(of(at).tolist(), item_of(there).tolist()):
            known.setdefault(d, set()).add(i)
        more = []
        for x, k, d in zip(a[hot].tolist(), w[hot].tolist(), of(a[hot]).tolist()):
            places = index.places[index.bounds[k] : index.bounds[k + 1]]
            items = item_of(places)
            wanted = index.alone[items] | (np.isin(items, list(known[d])) if d in known else False)
            more.append(np.stack([np.full(wanted.sum(), x), places[wanted]]))
        at, there = np.concatenate([np.stack([at, there]), *more], axis=1)
    doc, item = of(at), item_of(there)
    same = corpus.codes[at] == index.codes[there]
    right, left = np.full(len(at), -1), np.zeros(len(at), np.int64)
    right[same], left[same] = _grown(corpus.codes, at[same], index.codes, there[same], 1), _grown(corpus.codes, at[same], index.codes, there[same], -1)
    long = left + right + 1 >= index.passage
    order = np.lexsort((there - left, item, doc))
    cuts = np.flatnonzero(np.diff(doc[order]) | np.diff(item[order])) + 1
    out = []
    for part in np.split(order, cuts) if len(order) else []:
        d, i = int(doc[part[0]]), int(item[part[0]])
        covered, reach, n = 0, -1, int(index.lengths[i])
        for p in part[long[part]]:
            lo, hi = int(there[p] - left[p]), int(there[p] + right[p] + 1)
            covered += max(0, hi - max(lo, reach))
            reach = max(reach, hi)
        room = int(edited * n)
        begin, end = int(corpus.begins[d]), int(corpus.begins[d] + corpus.lengths[d])
        diagonals = at[part] - (there[part] - index.starts[i])
        stretch = corpus.codes[max(begin, int(diagonals.min()) - room) : min(end, int(diagonals.max()) + n + room)]
        counts, bits = index.shape(i)
        left_over = None
        if len(stretch) >= n - room and np.maximum(counts - _pairs(stretch), 0).sum() <= 2 * room and (distance := infix_distance(bits, n, stretch.tolist())) <= room:
            left_over = 1 - distance / n
        if covered and covered >= share * n or left_over is not None:
            out.append((d, int(index.ids[i]), covered / n, left_over))
    return out


def matches(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", item_lang: str = "lang", passage: dict[str, int] | None = None, share: float = SHARE, edited: float = EDITED, edits: int = EDITS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, share, edit_share for each document that contains at least `share` of an item's letters and digits
    within exact common passages of at least passage[lang of the item] of them, or the item as a whole with at most `edited`
    of it edited. edit_share is 1 - edit distance to the nearest stretch of the document / length of the item, and null if
    more would have to be edited or the document was not met by this item's windows on that stretch.

    Pairs of the first sort are all found, since equal windows always collide. Those of the second are found if one of their
    windows with at most `edits` edits collides, each with probability RECALL. Items of a language without a passage length
    get the longest. Items and documents without id, or with texts that are null, empty or shorter than half a passage, leak
    nothing. Repeated documents each come out, repeated rows of one id once, with the greatest values. The corpus is read and
    embedded once, and no row of it is shuffled; the items are split into indexes of bounded size.
    """
    passage = passage or PASSAGE
    spark = docs.sparkSession
    picked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"), F.col(item_lang).alias("lang")).where("item_id is not null and length(text) > 0").distinct()
    size = picked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(1.3 * size / block_chars))
    sent = []
    for block in range(blocks):
        by_length: dict[int, list] = {}
        for i, text, lang in picked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():
            by_length.setdefault(passage.get(lang, max(passage.values())), []).append((i, reduced(text)))
        sent.append(spark.sparkContext.broadcast([Index.of(sorted(x, key=lambda y: y[0]), n, share, edits) for n, x in sorted(by_length.items())]))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found, ids, texts, chars = [], [], [], 0
            for i, text in [*zip(pdf.doc_id, pdf.text), (None, None)]:
                if i is not None:
                    ids.append(i)
                    texts.append(reduced(text))
                    chars += len(texts[-1])
                if texts and (i is None or chars >= CHUNK_CHARS):
                    embedded: dict[int, Corpus] = {}
                    for index in (x for b in sent for x in b.value):
                        if index.passage not in embedded:
                            embedded[index.passage] = Corpus.of(texts, window_of(index.passage), tables_for(window_of(index.passage), RECALL, edits))
                        found += [(ids[d], *rest) for d, *rest in _search(embedded[index.passage], index, share, edited)]
                    ids, texts, chars = [], [], 0
            yield pd.DataFrame(found, columns=["doc_id", "item_id", "share", "edit_share"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).alias("text")).where("doc_id is not null and length(text) > 0")
    out = rows.mapInPandas(search, "doc_id long, item_id long, share double, edit_share double")
    return out.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"), F.max("edit_share").alias("edit_share"))


def leaked(docs: DataFrame, items: DataFrame, *, share: float = SHARE, **options) -> DataFrame:
    """doc_id, item_id, share of the pairs of matches() that hold `share` of the item in exact common passages."""
    return matches(docs, items, share=share, **options).where(F.col("share") >= share).select("doc_id", "item_id", "share")
